"""Data-quality checks. Every check is a row: category, name, status, detail, metrics.

``metrics`` maps a measure to its text, ``detail`` is the same in one line. Each
table is aggregated once per group of checks; a check never collects rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from tillwise.functions.exprs import round_to, safe_divide, stock

# fixed values: report categories
COMPLETE, UNIQUE, ACCURATE, TIMELY, CONSISTENT, LOGIC, SPREAD = (
    "完整性", "唯一性", "准确性", "时效性", "一致性", "业务逻辑", "分布")
# fixed values: expected row counts of the reference-size shop
ROW_BOUNDS = {"users": (18000, 22000), "orders": (90000, 130000), "page_events": (600000, 1200000),
              "sku": (700, 1000), "campaigns": (40, 70), "order_items": (200000, 300000), "refunds": (5000, 15000)}
EXPECTED_ROWS = {"users": 20000, "orders": 100000, "page_events": 700000, "sku": 864, "campaigns": 50}
STAGES = ("view_home", "view_product", "add_to_cart", "checkout", "pay_success")


def _text(v) -> Column:
    return F.coalesce(v.cast("string") if isinstance(v, Column) else F.lit(str(v)), F.lit(""))


def _rate(a, b) -> Column:
    return F.format_string("%.4f", safe_divide(a, b))


def _check(category: str, name, status: Column, **metrics) -> Column:
    keys = F.array(*[F.lit(k) for k in metrics])
    values = F.array(*[_text(v) for v in metrics.values()])
    line = F.concat_ws(", ", *[F.concat(F.lit(f"{k}="), _text(v)) for k, v in metrics.items()])
    return F.struct(F.lit(category).alias("category"), (name if isinstance(name, Column) else F.lit(name)).alias("name"),
                    status.alias("status"), line.alias("detail"), F.map_from_arrays(keys, values).alias("metrics"))


def _rows(aggregated: DataFrame, *checks: Column) -> DataFrame:
    return aggregated.select(F.inline(F.array(*checks)))


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


class Pass(NamedTuple):
    """Plain aggregates over one table and the checks made of them."""

    table: DataFrame
    aggregates: dict[str, Column]
    checks: Callable[[Callable[[str], Column]], list[Column]]


def run(passes: Sequence[Pass]) -> DataFrame:
    """Rows of all passes; passes over the same table share one scan and one aggregate."""
    by_table: dict[int, list[tuple[int, Pass]]] = {}
    for i, p in enumerate(passes):
        by_table.setdefault(id(p.table), []).append((i, p))
    parts = []
    for group in by_table.values():
        agg = group[0][1].table.agg(*[a.alias(f"a{i}_{k}") for i, p in group for k, a in p.aggregates.items()])
        parts.append(_rows(agg, *[c for i, p in group for c in p.checks(lambda k, i=i: F.col(f"a{i}_{k}"))]))
    return _union(parts)


def _pass(ok: Column, other: str = "fail") -> Column:
    return F.when(ok, "pass").otherwise(other)


def _count_if(cond: Column) -> Column:
    return F.count_if(F.coalesce(cond, F.lit(False)))


# ---- completeness ------------------------------------------------------------
def row_count_passes(tables: Mapping[str, DataFrame], bounds: Mapping[str, tuple[int, int]] = ROW_BOUNDS) -> list[Pass]:
    return [Pass(tables[t], {"n": F.count(F.lit(1))}, lambda c, t=t, lo=lo, hi=hi: [
        _check(COMPLETE, f"{t} 行数", _pass(c("n").between(lo, hi), "warn"), actual=c("n"), min=lo, max=hi)])
        for t, (lo, hi) in bounds.items()]


def row_counts(tables: Mapping[str, DataFrame], bounds: Mapping[str, tuple[int, int]] = ROW_BOUNDS) -> DataFrame:
    """Row count within [lo, hi] per table, else warn."""
    return run(row_count_passes(tables, bounds))


def quick_report(tables: Mapping[str, DataFrame], expected: Mapping[str, int], tolerance: float = 0.3) -> DataFrame:
    """Row counts within a tolerance of the expected, and no negative paid amount."""
    bounds = {t: (round(n * (1 - tolerance)), round(n * (1 + tolerance))) for t, n in expected.items()}
    return run([*row_count_passes(tables, bounds), negative_pass(tables["orders"], ("paid_amount",))])


def missing_pass(df: DataFrame, table: str, columns: Sequence[str], warn: float, fail: float | None = None) -> Pass:
    """NULL share per column: pass below ``warn``, then warn, then fail from ``fail`` up."""
    def checks(c):
        out = []
        for name in columns:
            rate = safe_divide(c(name), c("total"))
            status = F.when(rate < warn, "pass")
            status = status.when(rate < fail, "warn").otherwise("fail") if fail else status.otherwise("warn")
            out.append(_check(COMPLETE, f"{table}.{name} 缺失率", status, missing=c(name), total=c("total"), rate=_rate(c(name), c("total"))))
        return out

    return Pass(df, {"total": F.count(F.lit(1)), **{name: _count_if(F.col(name).isNull()) for name in columns}}, checks)


USER_COLUMNS = ("phone", "gender", "birth_year", "province")
AMOUNT_COLUMNS = ("paid_amount", "subtotal", "total_amount", "discount_amount")


def user_missing(users: DataFrame) -> DataFrame:
    return run([missing_pass(users, "users", USER_COLUMNS, 0.1, 0.3)])


def amount_missing(orders: DataFrame) -> DataFrame:
    return run([missing_pass(orders, "orders", AMOUNT_COLUMNS, 0.01)])


def anonymous_pass(events: DataFrame) -> Pass:
    blank = F.col("user_id").isNull() | (F.col("user_id").cast("string") == "")
    return Pass(events, {"total": F.count(F.lit(1)), "n": _count_if(blank)}, lambda c: [
        _check(COMPLETE, "page_events 匿名流量", _pass(safe_divide(c("n"), c("total")) < 0.5, "warn"), anonymous=c("n"),
               total=c("total"), rate=_rate(c("n"), c("total")))])


def anonymous_share(events: DataFrame) -> DataFrame:
    return run([anonymous_pass(events)])


def completeness_passes(tables: Mapping[str, DataFrame], bounds=ROW_BOUNDS) -> list[Pass]:
    return [*row_count_passes(tables, bounds), missing_pass(tables["users"], "users", USER_COLUMNS, 0.1, 0.3),
            missing_pass(tables["orders"], "orders", AMOUNT_COLUMNS, 0.01), anonymous_pass(tables["page_events"])]


def completeness(tables: Mapping[str, DataFrame], bounds=ROW_BOUNDS) -> DataFrame:
    return run(completeness_passes(tables, bounds))


# ---- uniqueness --------------------------------------------------------------
PRIMARY_KEYS = {"users": "user_id", "orders": "order_id", "sku": "sku_id", "campaigns": "campaign_id"}


def uniqueness(tables: Mapping[str, DataFrame], keys: Mapping[str, str] = PRIMARY_KEYS) -> DataFrame:
    parts = []
    for t, k in keys.items():
        agg = tables[t].agg(F.count(F.lit(1)).alias("n"), F.count_distinct(k).alias("d"))
        parts.append(_rows(agg, _check(UNIQUE, f"{t}.{k}", _pass(F.col("n") == F.col("d")), total=F.col("n"),
                                       distinct=F.col("d"), duplicates=F.col("n") - F.col("d"))))
    return _union(parts)


def repeated_keys(tables: Mapping[str, DataFrame], keys: Mapping[str, str]) -> DataFrame:
    """Number of key values that occur more than once."""
    parts = []
    for t, k in keys.items():
        agg = tables[t].groupBy(k).count().agg(_count_if(F.col("count") > 1).alias("n"))
        parts.append(_rows(agg, _check(COMPLETE, f"{t} 重复主键", _pass(F.col("n") == 0), duplicateCount=F.col("n"))))
    return _union(parts)


# ---- accuracy ----------------------------------------------------------------
def negative_pass(orders: DataFrame, columns: Sequence[str] = ("paid_amount", "subtotal")) -> Pass:
    return Pass(orders, {name: _count_if(F.col(name) < 0) for name in columns}, lambda c: [
        _check(ACCURATE, f"{name} 负数", _pass(c(name) == 0), negative_count=c(name)) for name in columns])


def negative_amounts(orders: DataFrame) -> DataFrame:
    return run([negative_pass(orders)])


def header_against_lines(orders: DataFrame, items: DataFrame, tolerance: float = 1.0, share: float = 0.05) -> DataFrame:
    """Paid orders whose total differs from their line sum by more than ``tolerance``."""
    lines = items.groupBy("order_id").agg(F.sum(F.col("unit_price") * F.col("quantity") - F.col("discount_amount")).alias("calc"))
    m = orders.where(F.col("status").isin("paid", "completed")).select("order_id", "total_amount").join(lines, "order_id")
    agg = m.agg(F.count(F.lit(1)).alias("n"), _count_if(F.abs(F.col("total_amount") - F.col("calc")) > tolerance).alias("bad"))
    return _rows(agg, _check(ACCURATE, "订单行金额 vs 订单头金额", _pass(F.col("bad") < F.col("n") * share, "warn"),
                             inconsistent=F.col("bad"), total=F.col("n")))


def refunds_over_paid(orders: DataFrame, refunds: DataFrame) -> DataFrame:
    r = refunds.where(F.col("status") == "approved").groupBy("order_id").agg(F.sum("amount").alias("refund"))
    o = orders.where(F.col("status").isin("paid", "completed", "refunded")).select("order_id", "paid_amount")
    agg = o.join(r, "order_id").agg(_count_if(F.col("refund") > F.col("paid_amount")).alias("n"))
    return _rows(agg, _check(ACCURATE, "退款超支付金额", _pass(F.col("n") == 0), over_refund=F.col("n")))


def negative_stock(movements: DataFrame, raw_sign: bool = False) -> DataFrame:
    agg = (movements.groupBy("sku_id").agg(stock(raw_sign=raw_sign).alias("s"))
           .agg(F.count(F.lit(1)).alias("n"), _count_if(F.col("s") < 0).alias("bad")))
    return _rows(agg, _check(ACCURATE, "SKU 库存负数", _pass(F.col("bad") == 0), negative_stock_skus=F.col("bad"),
                             total_skus=F.col("n")))


def price_pass(sku: DataFrame) -> Pass:
    return Pass(sku, {"n": F.count(F.lit(1)), "bad": _count_if(F.col("price") < F.col("cost"))}, lambda c: [
        _check(ACCURATE, "price < cost", _pass(c("bad") == 0), invalid_count=c("bad"), total=c("n"))])


def price_below_cost(sku: DataFrame) -> DataFrame:
    return run([price_pass(sku)])


def accuracy(t: Mapping[str, DataFrame]) -> DataFrame:
    return _union([negative_amounts(t["orders"]), header_against_lines(t["orders"], t["order_items"]),
                   refunds_over_paid(t["orders"], t["refunds"]), negative_stock(t["inventory_movements"]),
                   price_below_cost(t["sku"])])


# ---- timeliness, consistency, logic -------------------------------------------
def span_pass(df: DataFrame, name: str, column: str, low: str = "min", high: str = "max") -> Pass:
    day = F.to_date(column)
    return Pass(df, {"a": F.min(day), "b": F.max(day)}, lambda c: [
        _check(TIMELY, f"{name} 时间范围", F.lit("pass"), **{low: c("a"), high: c("b")})])


def timeliness_passes(tables: Mapping[str, DataFrame], as_of=None) -> list[Pass]:
    spans_ = [span_pass(tables[t], t, c) for t, c in (("orders", "created_at"), ("page_events", "created_at"), ("ads_spend", "spend_date"))]

    def age(c):
        days = F.datediff(F.lit(as_of).cast("date") if as_of else c("d"), c("d"))
        return [_check(TIMELY, "最新订单距今天数", _pass(days < 365, "warn"), latest_date=c("d"), days_ago=days)]

    return [*spans_, Pass(tables["orders"], {"d": F.max(F.to_date("created_at"))}, age)]


def timeliness(tables: Mapping[str, DataFrame], as_of=None) -> DataFrame:
    """Date span per table and days from the last order to ``as_of`` (default: the last order itself)."""
    return run(timeliness_passes(tables, as_of))


FOREIGN_KEYS = (("orders", "user_id", "users", "user_id"), ("order_items", "sku_id", "sku", "sku_id"),
                ("ads_spend", "campaign_id", "campaigns", "campaign_id"))


def orphans(tables: Mapping[str, DataFrame], keys=FOREIGN_KEYS) -> DataFrame:
    """Child rows without a parent. Children are counted per key before the anti join."""
    parts = []
    for child, ck, parent, pk in keys:
        per_key = tables[child].where(F.col(ck).isNotNull()).groupBy(F.col(ck).alias("k")).agg(F.count(F.lit(1)).alias("n"))
        lost = per_key.join(tables[parent].select(F.col(pk).alias("k")), "k", "left_anti")
        agg = lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
        parts.append(_rows(agg, _check(CONSISTENT, f"{child}.{ck} → {parent}.{pk}", _pass(F.col("n") == 0), orphans=F.col("n"))))
    return _union(parts)


def _distribution(counts: DataFrame, category: str, name: str, value: str) -> DataFrame:
    """One check whose metrics are the counts per value of a small coded domain."""
    entries = F.array_sort(F.collect_list(F.struct(F.col(value).alias("k"), F.col("n").cast("string").alias("v"))))
    return (counts.where(F.col(value).isNotNull()).agg(entries.alias("e"))
            .select(F.lit(category).alias("category"), F.lit(name).alias("name"), F.lit("pass").alias("status"),
                    F.array_join(F.transform("e", lambda x: F.concat(x["k"], F.lit("="), x["v"])), ", ").alias("detail"),
                    F.map_from_entries("e").alias("metrics")))


def status_distribution(orders: DataFrame, category: str = LOGIC, name: str = "订单状态分布") -> DataFrame:
    return _distribution(orders.groupBy("status").agg(F.count(F.lit(1)).alias("n")), category, name, "status")


def paid_before_created(payments: DataFrame, orders: DataFrame) -> DataFrame:
    """Payments have no creation time, so it comes from their order."""
    m = payments.select("order_id", "paid_at").join(orders.select("order_id", "created_at"), "order_id")
    agg = m.agg(_count_if(F.col("paid_at") < F.col("created_at")).alias("n"))
    return _rows(agg, _check(LOGIC, "paid_at < created_at", _pass(F.col("n") == 0), bad_count=F.col("n")))


def funnel_pass(events: DataFrame, stages: Sequence[str] = STAGES) -> Pass:
    def checks(c):
        falls = reduce(lambda a, b: a & b, [c(a) >= c(b) for a, b in zip(stages, stages[1:])])
        return [_check(LOGIC, "流量漏斗事件分布", F.lit("pass"), **{st: c(st) for st in stages}, decreasing=falls.cast("int"))]

    return Pass(events, {st: _count_if(F.col("event_type") == st) for st in stages}, checks)


def funnel_events(events: DataFrame, stages: Sequence[str] = STAGES) -> DataFrame:
    """Events per stage, and whether they decrease from stage to stage (reported, never failed)."""
    return run([funnel_pass(events, stages)])


def business_logic(t: Mapping[str, DataFrame]) -> DataFrame:
    return _union([status_distribution(t["orders"]), paid_before_created(t["payments"], t["orders"]),
                   funnel_events(t["page_events"])])


def full_report(t: Mapping[str, DataFrame], bounds=ROW_BOUNDS, as_of=None) -> DataFrame:
    """All checks. Those that are plain aggregates share one scan per table."""
    plain = run([*completeness_passes(t, bounds), negative_pass(t["orders"]), price_pass(t["sku"]), *timeliness_passes(t, as_of),
                 funnel_pass(t["page_events"])])
    return _union([plain, uniqueness(t), header_against_lines(t["orders"], t["order_items"]), refunds_over_paid(t["orders"], t["refunds"]),
                   negative_stock(t["inventory_movements"]), orphans(t), status_distribution(t["orders"]),
                   paid_before_created(t["payments"], t["orders"])])


def status_totals(report: DataFrame) -> DataFrame:
    return report.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(F.col("status") == s).alias(s)
                                                          for s in ("pass", "warn", "fail", "error")])


# ---- the extraction service's own report ---------------------------------------
def expected_passes(tables: Mapping[str, DataFrame], expected: Mapping[str, int] = EXPECTED_ROWS) -> list[Pass]:
    return [Pass(tables[t], {"n": F.count(F.lit(1))}, lambda c, t=t, n=n: [
        _check(COMPLETE, f"{t} 行数", _pass(c("n") >= n * 0.8, "warn"), actual=c("n"), expected=n)]) for t, n in expected.items()]


def expected_rows(tables: Mapping[str, DataFrame], expected: Mapping[str, int] = EXPECTED_ROWS) -> DataFrame:
    return run(expected_passes(tables, expected))


def blank_pass(users: DataFrame) -> Pass:
    blank = lambda name: F.col(name).isNull() | (F.col(name) == "")
    return Pass(users, {name: _count_if(F.col(name).isNull() if name == "birth_year" else blank(name)) for name in USER_COLUMNS}, lambda c: [
        _check(COMPLETE, "users 关键字段缺失值", F.lit("pass"), **{f"{name}_missing": c(name) for name in USER_COLUMNS})])


def user_blanks(users: DataFrame) -> DataFrame:
    """Missing user values; empty text counts as missing except for the birth year."""
    return run([blank_pass(users)])


def amount_pass(orders: DataFrame) -> Pass:
    v = F.col
    return Pass(orders, {"p": _count_if(v("paid_amount") < 0), "s": _count_if(v("subtotal") < 0), "t": _count_if(v("total_amount") < 0),
                         "o": _count_if(v("paid_amount") > v("total_amount") * 1.5)}, lambda c: [
        _check(ACCURATE, "orders 金额异常", _pass(c("p") + c("s") + c("t") == 0), negative_paid=c("p"), negative_subtotal=c("s"),
               negative_total=c("t"), paid_over_total=c("o"))])


def amount_anomalies(orders: DataFrame) -> DataFrame:
    return run([amount_pass(orders)])


def paid_against_lines(orders: DataFrame, items: DataFrame, tolerance: float = 0.01) -> DataFrame:
    lines = items.groupBy("order_id").agg(F.sum("line_amount").alias("s"))
    m = orders.select("order_id", "paid_amount").join(lines, "order_id")
    agg = m.agg(_count_if(F.abs(F.col("paid_amount") - F.col("s")) > tolerance).alias("n"))
    return _rows(agg, _check(CONSISTENT, "order_items 行金额与订单金额差异", _pass(F.col("n") == 0, "warn"), mismatchCount=F.col("n")))


def refund_anomalies(refunds: DataFrame, orders: DataFrame) -> DataFrame:
    m = refunds.select("order_id", "amount").join(orders.select("order_id", "paid_amount"), "order_id")
    agg = m.agg(_count_if(F.col("amount") < 0).alias("n"), _count_if(F.col("amount") > F.col("paid_amount")).alias("o"))
    return _rows(agg, _check(ACCURATE, "refunds 退款金额异常", _pass(F.col("n") + F.col("o") == 0, "warn"),
                             negative_amount=F.col("n"), overpaid_refund=F.col("o")))


def stock_pass(sku: DataFrame) -> Pass:
    return Pass(sku, {"n": _count_if(F.col("stock") < 0)}, lambda c: [
        _check(ACCURATE, "sku 负库存检查", _pass(c("n") == 0), negativeStockCount=c("n"))])


def negative_stock_column(sku: DataFrame) -> DataFrame:
    return run([stock_pass(sku)])


def ratio_pass(events: DataFrame) -> Pass:
    return Pass(events, {"t": F.count(F.lit(1)), "n": _count_if(F.col("user_id").isNull())}, lambda c: [
        _check(COMPLETE, "page_events 匿名流量比例", F.lit("pass"), anonymous=c("n"), total=c("t"), ratio=_rate(c("n"), c("t")))])


def coupon_pass(coupons: DataFrame) -> Pass:
    return Pass(coupons, {"t": F.count(F.lit(1)), "n": _count_if(F.col("used_count") > 0)}, lambda c: [
        _check(LOGIC, "coupons 整体使用状态", F.lit("pass"), usedTemplates=c("n"), totalTemplates=c("t"))])


def coupons_used(coupons: DataFrame) -> DataFrame:
    return run([coupon_pass(coupons)])


def service_spans(t: Mapping[str, DataFrame]) -> list[Pass]:
    return [span_pass(t[n], n, "created_at", "minDate", "maxDate") for n in ("orders", "page_events")]


def state_span_anonymous(t: Mapping[str, DataFrame]) -> DataFrame:
    return status_distribution(t["orders"], SPREAD, "orders 状态分布").unionByName(run([*service_spans(t), ratio_pass(t["page_events"])]))


def service_report(t: Mapping[str, DataFrame], expected=EXPECTED_ROWS) -> DataFrame:
    """The service's checks. Those that are plain aggregates share one scan per table."""
    plain = run([*expected_passes(t, expected), blank_pass(t["users"]), amount_pass(t["orders"]), *service_spans(t),
                 ratio_pass(t["page_events"]), stock_pass(t["sku"]), coupon_pass(t["coupons"])])
    return _union([plain, repeated_keys(t, {k: PRIMARY_KEYS[k] for k in ("users", "orders", "sku")}),
                   paid_against_lines(t["orders"], t["order_items"]), status_distribution(t["orders"], SPREAD, "orders 状态分布"),
                   refund_anomalies(t["refunds"], t["orders"])])


def missing_summary(df: DataFrame) -> DataFrame:
    """Missing count and rate of every column, one pass; NaN counts as missing."""
    def gone(f):
        c = F.col(f.name)
        return c.isNull() | F.isnan(c) if f.dataType.simpleString() in ("double", "float") else c.isNull()

    agg = df.agg(F.count(F.lit(1)).alias("_n"), *[_count_if(gone(f)).alias(f.name) for f in df.schema.fields])
    rows = F.array(*[F.struct(F.lit(f.name).alias("column"), F.col(f.name).alias("missing_count"),
                              round_to(safe_divide(f.name, "_n"), 4).alias("missing_rate"),
                              F.lit(f.dataType.simpleString()).alias("dtype")) for f in df.schema.fields])
    return agg.select(F.inline(rows)).orderBy(F.desc("missing_rate"), "column")
