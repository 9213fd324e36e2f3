from pyspark.sql import functions as F

from checks import check, ctes
from tillwise.operators import baskets as b

BANDS = (1400.0, 3000.0)
KINDS = {
    "sku": "SELECT DISTINCT order_id, CAST(sku_id AS VARCHAR) AS item FROM (SELECT *, count(*) OVER (PARTITION BY order_id) AS k FROM fact_order_item "
           "WHERE sku_id IN (SELECT sku_id FROM fact_order_item GROUP BY 1 ORDER BY count(*) DESC, sku_id LIMIT 80)) WHERE k >= 2",
    "cat": "SELECT DISTINCT order_id, category_name AS item FROM fact_order_item i JOIN dim_product d ON d.sku_id = i.sku_id "
           "QUALIFY count(DISTINCT category_name) OVER (PARTITION BY order_id) >= 2",
    "band": "SELECT * FROM (SELECT DISTINCT order_id, CASE WHEN unit_price < 1400 THEN 'low' WHEN unit_price <= 3000 THEN 'mid' ELSE 'high' END AS item "
            "FROM fact_order_item) QUALIFY count(*) OVER (PARTITION BY order_id) >= 2",
}
KINDS["cat"] = ("SELECT * FROM (SELECT DISTINCT order_id, category_name AS item FROM fact_order_item i JOIN dim_product d ON d.sku_id = i.sku_id) "
                "QUALIFY count(*) OVER (PARTITION BY order_id) >= 2")
SUPPORT = {"sku": 0.002, "cat": 0.01, "band": 0.01}
CONF = {"sku": (0.02, 0.1), "cat": (0.15, 0.9), "band": (0.1, 0.5)}

for kind, body in KINDS.items():
    ctes.register(**{
        f"{kind}_b": body,
        f"{kind}_n": f"SELECT count(DISTINCT order_id) AS total FROM {kind}_b",
        f"{kind}_i1": f"SELECT item AS a, count(*) AS n FROM {kind}_b GROUP BY 1 HAVING count(*) >= {SUPPORT[kind]} * (SELECT total FROM {kind}_n)",
        f"{kind}_i2": f"SELECT x.item AS a, y.item AS b, count(*) AS n FROM {kind}_b x JOIN {kind}_b y ON x.order_id = y.order_id AND x.item < y.item GROUP BY 1, 2 HAVING count(*) >= {SUPPORT[kind]} * (SELECT total FROM {kind}_n)",
        f"{kind}_i3": f"SELECT x.item AS a, y.item AS b, z.item AS c, count(*) AS n FROM {kind}_b x JOIN {kind}_b y ON x.order_id = y.order_id AND x.item < y.item JOIN {kind}_b z ON x.order_id = z.order_id AND y.item < z.item GROUP BY 1, 2, 3 HAVING count(*) >= {SUPPORT[kind]} * (SELECT total FROM {kind}_n)",
        f"{kind}_sets": f"SELECT a AS items, 1 AS length, n, n / total AS support FROM {kind}_i1, {kind}_n UNION ALL SELECT a || '|' || b, 2, n, n / total FROM {kind}_i2, {kind}_n UNION ALL SELECT a || '|' || b || '|' || c, 3, n, n / total FROM {kind}_i3, {kind}_n",
        f"{kind}_split": " UNION ALL ".join([f"SELECT {l} AS l, {r} AS r, a || '|' || b AS items FROM {kind}_i2" for l, r in (("a", "b"), ("b", "a"))] +
            [f"SELECT {l} AS l, {r} AS r, a || '|' || b || '|' || c AS items FROM {kind}_i3" for x, y in (("a", "b || '|' || c"), ("b", "a || '|' || c"), ("c", "a || '|' || b"))
             for l, r in ((x, y), (y, x))]),
        f"{kind}_rules": f"""SELECT * FROM (SELECT l AS antecedents, r AS consequents, round(s.support, 6) AS support, round(s.support / x.support, 4) AS confidence,
            round(s.support / x.support / y.support, 4) AS lift, round(s.support - x.support * y.support, 6) AS leverage,
            round((1 - y.support) / nullif(1 - s.support / x.support, 0), 4) AS conviction
            FROM {kind}_split p JOIN {kind}_sets s ON s.items = p.items JOIN {kind}_sets x ON x.items = l JOIN {kind}_sets y ON y.items = r
            WHERE s.support / x.support >= {CONF[kind][0]}) WHERE lift > {CONF[kind][1]}""",
    })


def text(df, *cols):
    return df.withColumns({c: F.array_join(c, "|") for c in cols})


def baskets(s, kind):
    if kind == "sku":
        return b.sku_baskets(s.order_items)
    if kind == "cat":
        return b.category_baskets(s.order_items, s.dim_product)
    return b.price_band_baskets(s.order_items, *BANDS)


def rules(s, kind):
    return b.association_rules(b.frequent_itemsets(baskets(s, kind), SUPPORT[kind]), *CONF[kind])


def ruletext(df):
    return text(df, "antecedents", "consequents")


BASKET_SQL = "SELECT order_id, string_agg(item, '|' ORDER BY item) AS items FROM {}_b GROUP BY 1"
for _name, _kind in (("k01_sku_baskets", "sku"), ("k02_category_baskets", "cat"), ("k03_price_band_baskets", "band")):
    check(_name, BASKET_SQL.format(_kind))(lambda s, spark, k=_kind: text(baskets(s, k), "items"))

for _kind in KINDS:
    check(f"k04_frequent_itemsets_{_kind}", f"SELECT items, length, n, round(support, 6) AS support FROM {_kind}_sets")(
        lambda s, spark, k=_kind: text(b.frequent_itemsets(baskets(s, k), SUPPORT[k]), "items").withColumn("support", b.round_to("support", 6)))
    check(f"k05_association_rules_{_kind}", f"SELECT * FROM {_kind}_rules")(lambda s, spark, k=_kind: ruletext(rules(s, k)))


def top(kind, where, order, n):
    return f"SELECT * FROM {kind}_rules WHERE {where} ORDER BY {order}, string_split(antecedents, '|'), string_split(consequents, '|') LIMIT {n}"


@check("k06_bundles", top("sku", "lift >= 1.5 AND confidence >= 0.4", "lift DESC", 20))
def _(s, spark):
    return ruletext(b.bundles(rules(s, "sku")))


@check("k07_cross_sell", top("cat", "true", "lift DESC", 20))
def _(s, spark):
    return ruletext(b.cross_sell(rules(s, "cat")))


@check("k08_add_ons", top("sku", "true", "lift DESC, confidence DESC", 20))
def _(s, spark):
    return ruletext(b.add_ons(rules(s, "sku")))


@check("k09_unsuitable_rules", top("sku", "lift > 2 AND support < 0.005", "lift DESC", 10))
def _(s, spark):
    return ruletext(b.unsuitable(rules(s, "sku")))


@check("k10_recommendations", """SELECT item, rank, recommend, confidence, lift FROM (SELECT item, recommend, confidence, lift, CAST(row_number() OVER (PARTITION BY item
    ORDER BY lift DESC, confidence DESC, string_split(recommend, '|'), string_split(antecedents, '|')) AS INTEGER) AS rank
    FROM (SELECT unnest(string_split(antecedents, '|')) AS item, consequents AS recommend, antecedents, confidence, lift FROM sku_rules)) WHERE rank <= 10""")
def _(s, spark):
    return text(b.recommendations(rules(s, "sku")), "recommend")


@check("k11_basket_run")
def _(s, spark):
    out = b.run(s.order_items, s.dim_product)
    counts = None
    for name, df in out.items():
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("part"), "n")
        counts = one if counts is None else counts.union(one)
    return counts
