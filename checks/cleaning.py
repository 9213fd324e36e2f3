from pyspark.sql import functions as F

from checks import check, ctes
from tillwise.functions.exprs import round_to
from tillwise.operators import cleaning as c

COLS = ("total_amount", "discount_amount", "subtotal")
ctes.register(amounts="SELECT order_id, total_amount, discount_amount, subtotal FROM s_orders",
              holders="SELECT user_id, gender, phone, birth_year, CAST(CASE WHEN user_id % 7 = 0 THEN NULL ELSE user_id * 1.5 END AS DOUBLE) AS score FROM s_users")


def holders(s):
    score = F.when(F.col("user_id") % 7 != 0, F.col("user_id") * F.lit(1.5))
    return s.users.select("user_id", "gender", "phone", "birth_year", score.alias("score"))


def amounts(s):
    return s.orders.select("order_id", *COLS)


def rounded(df, cols, d=4):
    return df.withColumns({x: round_to(x, d) for x in cols})


def mode(col):
    return f"(SELECT {col} FROM holders WHERE {col} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, {col} LIMIT 1)"


def fill(numbers, gender=mode("gender"), phone=mode("phone")):
    nums = ", ".join(f"round(coalesce({n}, {e}), 4) AS {n}" for n, e in numbers.items())
    return f"SELECT user_id, coalesce(gender, {gender}) AS gender, coalesce(phone, {phone}) AS phone, {nums} FROM holders"


MEDIANS = {n: f"(SELECT quantile_cont({n}, 0.5) FROM holders)" for n in ("birth_year", "score")}
MEANS = {n: f"(SELECT avg({n}) FROM holders)" for n in ("birth_year", "score")}


@check("d01_missing_auto", fill(MEDIANS))
def _(s, spark):
    return rounded(c.handle_missing(holders(s)), ("birth_year", "score"))


@check("d01_missing_mean", fill(MEANS))
def _(s, spark):
    return rounded(c.handle_missing(holders(s), "mean"), ("birth_year", "score"))


@check("d01_missing_mode", f"""SELECT user_id, coalesce(gender, {mode('gender')}) AS gender, coalesce(phone, {mode('phone')}) AS phone,
    coalesce(birth_year, {mode('birth_year')}) AS birth_year, round(coalesce(score, {mode('score')}), 4) AS score FROM holders""")
def _(s, spark):
    return rounded(c.handle_missing(holders(s), "mode"), ("score",))


@check("d01_missing_drop", """SELECT user_id, gender, phone, birth_year, round(score, 4) AS score FROM holders
    WHERE gender IS NOT NULL AND phone IS NOT NULL AND birth_year IS NOT NULL AND score IS NOT NULL""")
def _(s, spark):
    return rounded(c.handle_missing(holders(s), "drop"), ("score",))


Q = "(SELECT quantile_cont({c}, {p}) FROM amounts)"


def fence(col, m=1.5):
    q1, q3 = Q.format(c=col, p=0.25), Q.format(c=col, p=0.75)
    return f"({q1} - {m} * ({q3} - {q1}))", f"({q3} + {m} * ({q3} - {q1}))"


def clipped(bounds):
    return "SELECT order_id, " + ", ".join(f"round(greatest(least({x}, {bounds(x)[1]}), {bounds(x)[0]}), 4) AS {x}" for x in COLS) + " FROM amounts"


def zbound(k):
    return lambda x: (f"(SELECT avg({x}) - {k} * stddev_samp({x}) FROM amounts)", f"(SELECT avg({x}) + {k} * stddev_samp({x}) FROM amounts)")


@check("d02_clip_iqr", clipped(lambda x: fence(x, 0.5)))
def _(s, spark):
    return rounded(c.clip_iqr(amounts(s), COLS, 0.5), COLS)


@check("d03_clip_zscore", clipped(zbound(1.5)))
def _(s, spark):
    return rounded(c.clip_zscore(amounts(s), COLS, 1.5), COLS)


LEVELS = ("FURNITURE", "HOUSEHOLD", "MACHINERY")


@check("d04_one_hot", """SELECT user_id, """ + ", ".join(
    f"CASE WHEN member_level = '{v}' THEN 1 ELSE 0 END AS \"member_level_{v}\"" for v in ("BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")) + " FROM s_users")
def _(s, spark):
    return c.one_hot(s.users.select("user_id", "member_level"), ["member_level"])


@check("d05_ordinal", """SELECT user_id, CAST(coalesce(g, -1) AS INTEGER) AS gender, CAST(coalesce(p, -1) AS INTEGER) AS province FROM (
    SELECT user_id, CASE WHEN gender IS NOT NULL THEN dense_rank() OVER (PARTITION BY gender IS NULL ORDER BY gender) - 1 END AS g,
           dense_rank() OVER (ORDER BY province) - 1 AS p FROM s_users)""")
def _(s, spark):
    return c.ordinal(s.users.select("user_id", "gender", "province"), ["gender", "province"])


SCALED = {"standard": "(x - avg(x) OVER ()) / stddev_pop(x) OVER ()", "minmax": "(x - min(x) OVER ()) / (max(x) OVER () - min(x) OVER ())",
          "robust": "(x - quantile_cont(x, 0.5) OVER ()) / (quantile_cont(x, 0.75) OVER () - quantile_cont(x, 0.25) OVER ())"}
for _m, _e in SCALED.items():
    check(f"d06_scale_{_m}", "SELECT order_id, " + ", ".join(f"round({_e.replace('(x', '(' + x).replace('x)', x + ')')}, 6) AS {x}" for x in COLS) + " FROM amounts")(
        lambda s, spark, m=_m: rounded(c.scale_features(amounts(s), m, COLS), COLS, 6))

CORR = " UNION ALL ".join(f"SELECT '{b}' AS feature, (SELECT corr({a}, {b}) FROM amounts) AS r" for a, b in
                          (("total_amount", "discount_amount"), ("total_amount", "subtotal"), ("discount_amount", "subtotal")))


@check("d07_correlated_features", f"SELECT DISTINCT feature FROM ({CORR}) WHERE abs(r) > 0.9")
def _(s, spark):
    return c.correlated_features(amounts(s), 0.9, COLS)


@check("d08_flat_features", """SELECT 'flag' AS feature, round(v, 6) AS variance FROM (SELECT var_samp(CAST(is_default AS DOUBLE)) AS v
    FROM (SELECT CASE WHEN user_id >= 0 THEN 1 ELSE 0 END AS is_default FROM s_users)) WHERE v < 0.01""")
def _(s, spark):
    return c.flat_features(s.users.select("user_id", (F.col("user_id") >= 0).cast("int").alias("flag")))


@check("d09_prepare", f"""
    WITH f AS (SELECT CAST(user_id AS DOUBLE) AS user_id, coalesce(gender, {mode('gender')}) AS gender,
                      coalesce(birth_year, {MEDIANS['birth_year']}) AS birth_year, coalesce(score, {MEDIANS['score']}) AS score
               FROM holders),
         b AS (SELECT *, quantile_cont(score, 0.25) OVER () AS q1, quantile_cont(score, 0.75) OVER () AS q3,
                      quantile_cont(birth_year, 0.25) OVER () AS y1, quantile_cont(birth_year, 0.75) OVER () AS y3,
                      quantile_cont(user_id, 0.25) OVER () AS u1, quantile_cont(user_id, 0.75) OVER () AS u3 FROM f),
         k AS (SELECT greatest(least(user_id, u3 + 1.5 * (u3 - u1)), u1 - 1.5 * (u3 - u1)) AS user_id,
                      CAST(dense_rank() OVER (ORDER BY gender) - 1 AS DOUBLE) AS gender,
                      greatest(least(birth_year, y3 + 1.5 * (y3 - y1)), y1 - 1.5 * (y3 - y1)) AS birth_year,
                      greatest(least(score, q3 + 1.5 * (q3 - q1)), q1 - 1.5 * (q3 - q1)) AS score FROM b)
    SELECT """ + ", ".join(f"round(({x} - min({x}) OVER ()) / (max({x}) OVER () - min({x}) OVER ()), 6) AS {x}"
                           for x in ("user_id", "gender", "birth_year", "score")) + " FROM k")
def _(s, spark):
    out = c.prepare(holders(s).drop("phone"), {"missing": "auto", "outliers": "iqr", "encode": "ordinal", "scale": "minmax"})
    return rounded(out, out.columns, 6)


@check("d10_iqr_outliers", "SELECT order_id, coalesce(discount_amount < {0} OR discount_amount > {1}, false) AS is_outlier FROM amounts".format(*fence("discount_amount")))
def _(s, spark):
    return c.iqr_outliers(amounts(s), "discount_amount").select("order_id", "is_outlier")


@check("d11_zscore_outliers", """SELECT order_id, abs(discount_amount - (SELECT avg(discount_amount) FROM amounts)) / (SELECT stddev_samp(discount_amount) FROM amounts) > 2
    AS is_outlier FROM amounts""")
def _(s, spark):
    return c.zscore_outliers(amounts(s), "discount_amount", 2.0).select("order_id", "is_outlier")


@check("d12_standardize", """SELECT order_id, round((total_amount - (SELECT avg(total_amount) FROM amounts)) / (SELECT stddev_samp(total_amount) FROM amounts), 6) AS z FROM amounts""")
def _(s, spark):
    return c.standardize(amounts(s), "total_amount", "z").select("order_id", round_to("z", 6).alias("z"))


@check("d13_quantiles", " UNION ALL ".join(f"SELECT 'p{int(p * 100)}' AS name, round(quantile_cont(total_amount, {p}), 4) AS value FROM amounts"
                                           for p in (0, 0.25, 0.5, 0.75, 0.9, 1)))
def _(s, spark):
    return rounded(c.quantile_table(amounts(s), "total_amount", [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]), ["value"])
