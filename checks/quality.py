from checks import check
from tillwise.operators import quality as q

TABLES = ("users", "orders", "page_events", "sku", "campaigns", "order_items", "refunds", "ads_spend", "payments",
          "inventory_movements", "coupons")
BOUNDS = {"users": (1000, 2000), "orders": (10000, 14000), "page_events": (9000, 11000), "sku": (700, 1000),
          "campaigns": (40, 700), "order_items": (20000, 90000), "refunds": (5000, 15000)}
EXPECTED = {"users": 1500, "orders": 100000, "page_events": 10000, "sku": 864, "campaigns": 50}


class Tables(dict):
    """Opens a source table when a check asks for it."""

    def __init__(self, shop):
        super().__init__()
        self.shop = shop

    def __missing__(self, name):
        return getattr(self.shop, name)


def flat(df):
    return df.drop("metrics")


def row(cat, name, status, source, **metrics):
    """SQL of one check row; metrics are expressions over the one-row ``source``."""
    detail = " || ', ' || ".join(f"'{k}=' || coalesce(CAST({e} AS VARCHAR), '')" for k, e in metrics.items())
    return f"SELECT '{cat}' AS category, '{name}' AS name, {status} AS status, {detail} AS detail FROM ({source})"


def union(*parts):
    return " UNION ALL ".join(parts)


def ok(cond, other="fail"):
    return f"CASE WHEN {cond} THEN 'pass' ELSE '{other}' END"


def rate(a, b):
    return f"printf('%.4f', {a} / {b})"


def n_rows(t):
    return f"SELECT count(*) AS n FROM s_{t}"


def counted(table, **conds):
    return f"SELECT count(*) AS total, " + ", ".join(f"count(*) FILTER (WHERE {c}) AS {k}" for k, c in conds.items()) + f" FROM {table}"


C01 = union(*[row("完整性", f"{t} 行数", ok(f"n BETWEEN {lo} AND {hi}", "warn"), n_rows(t), actual="n", min=lo, max=hi)
              for t, (lo, hi) in BOUNDS.items()])
QUICK = {"users": 1500, "orders": 11000, "order_items": 60000}
NEG = row("准确性", "paid_amount 负数", ok("n = 0"), counted("s_orders", n="paid_amount < 0"), negative_count="n")
C02 = union(*[row("完整性", f"{t} 行数", ok(f"n BETWEEN {round(e * 0.7)} AND {round(e * 1.3)}", "warn"), n_rows(t), actual="n",
                  min=round(e * 0.7), max=round(e * 1.3)) for t, e in QUICK.items()], NEG)
C03 = union(*[row("完整性", f"users.{c} 缺失率", "CASE WHEN n / total < 0.1 THEN 'pass' WHEN n / total < 0.3 THEN 'warn' ELSE 'fail' END",
                  counted("s_users", n=f"{c} IS NULL"), missing="n", total="total", rate=rate("n", "total"))
              for c in ("phone", "gender", "birth_year", "province")])
C04 = union(*[row("完整性", f"orders.{c} 缺失率", ok("n / total < 0.01", "warn"), counted("s_orders", n=f"{c} IS NULL"), missing="n",
                  total="total", rate=rate("n", "total")) for c in ("paid_amount", "subtotal", "total_amount", "discount_amount")])
C05 = row("完整性", "page_events 匿名流量", ok("n / total < 0.5", "warn"), counted("s_page_events", n="user_id IS NULL"),
          anonymous="n", total="total", rate=rate("n", "total"))
C07 = union(*[row("唯一性", f"{t}.{k}", ok("n = d"), f"SELECT count(*) AS n, count(DISTINCT {k}) AS d FROM s_{t}", total="n",
                  distinct="d", duplicates="n - d") for t, k in q.PRIMARY_KEYS.items()])
C08 = union(NEG, row("准确性", "subtotal 负数", ok("n = 0"), counted("s_orders", n="subtotal < 0"), negative_count="n"))
C09 = row("准确性", "订单行金额 vs 订单头金额", ok("bad < total * 0.05", "warn"), """
    SELECT count(*) AS total, count(*) FILTER (WHERE abs(total_amount - calc) > 1) AS bad FROM s_orders o
    JOIN (SELECT order_id, sum(unit_price * quantity - discount_amount) AS calc FROM s_order_items GROUP BY 1) l ON l.order_id = o.order_id
    WHERE status IN ('paid', 'completed')""", inconsistent="bad", total="total")
C10 = row("准确性", "退款超支付金额", ok("n = 0"), """SELECT count(*) AS n FROM s_orders o
    JOIN (SELECT order_id, sum(amount) AS a FROM s_refunds WHERE status = 'approved' GROUP BY 1) r ON r.order_id = o.order_id
    WHERE a > paid_amount""", over_refund="n")
C11 = row("准确性", "SKU 库存负数", ok("bad = 0"), """SELECT count(*) AS total, count(*) FILTER (WHERE s < 0) AS bad FROM
    (SELECT sku_id, sum(CASE WHEN movement_type = 'in' THEN quantity ELSE -abs(quantity) END) AS s FROM s_inventory_movements GROUP BY 1)""",
          negative_stock_skus="bad", total_skus="total")
C12 = row("准确性", "price < cost", ok("bad = 0"), counted("s_sku", bad="price < cost"), invalid_count="bad", total="total")
SPAN = "SELECT CAST(min({c}) AS DATE) AS a, CAST(max({c}) AS DATE) AS b FROM s_{t}"
C13 = union(*[row("时效性", f"{t} 时间范围", "'pass'", SPAN.format(t=t, c=c), min="a", max="b")
              for t, c in (("orders", "created_at"), ("page_events", "created_at"), ("ads_spend", "spend_date"))],
            row("时效性", "最新订单距今天数", ok("DATE '2003-01-01' - b < 365", "warn"), SPAN.format(t="orders", c="created_at"),
                latest_date="b", days_ago="DATE '2003-01-01' - b"))
C14 = union(*[row("一致性", f"{c}.{ck} → {p}.{pk}", ok("n = 0"),
                  f"SELECT count(*) AS n FROM s_{c} x LEFT JOIN s_{p} y ON x.{ck} = y.{pk} WHERE x.{ck} IS NOT NULL AND y.{pk} IS NULL",
                  orphans="n") for c, ck, p, pk in q.FOREIGN_KEYS])


def spread(cat, name):
    return f"""SELECT '{cat}' AS category, '{name}' AS name, 'pass' AS status, string_agg(status || '=' || n, ', ' ORDER BY status) AS detail
        FROM (SELECT status, count(*) AS n FROM s_orders GROUP BY 1)"""


C15 = spread("业务逻辑", "订单状态分布")
C16 = row("业务逻辑", "paid_at < created_at", ok("n = 0"), """SELECT count(*) AS n FROM s_payments p JOIN s_orders o ON o.order_id = p.order_id
    WHERE paid_at < o.created_at""", bad_count="n")
C17 = row("业务逻辑", "流量漏斗事件分布", "'pass'", counted("s_page_events", **{s: f"event_type = '{s}'" for s in q.STAGES}),
          **{s: s for s in q.STAGES}, decreasing="CASE WHEN view_home >= view_product AND view_product >= add_to_cart AND add_to_cart >= checkout AND checkout >= pay_success THEN 1 ELSE 0 END")
FULL = union(C01, C03, C04, C05, C07, C08, C09, C10, C11, C12, C13, C14, C15, C16, C17)
C19 = union(*[row("完整性", f"{t} 行数", ok(f"n >= {e} * 0.8", "warn"), n_rows(t), actual="n", expected=e) for t, e in EXPECTED.items()])
C20 = row("完整性", "users 关键字段缺失值", "'pass'", counted("s_users", phone="phone IS NULL OR phone = ''", gender="gender IS NULL OR gender = ''",
          birth_year="birth_year IS NULL", province="province IS NULL OR province = ''"),
          phone_missing="phone", gender_missing="gender", birth_year_missing="birth_year", province_missing="province")
KEYS3 = {k: q.PRIMARY_KEYS[k] for k in ("users", "orders", "sku")}
C21 = union(*[row("完整性", f"{t} 重复主键", ok("n = 0"), f"SELECT count(*) AS n FROM (SELECT {k} FROM s_{t} GROUP BY 1 HAVING count(*) > 1)",
                  duplicateCount="n") for t, k in KEYS3.items()])
C21L = row("完整性", "order_items 重复主键", ok("n = 0"), "SELECT count(*) AS n FROM (SELECT order_item_id FROM s_order_items GROUP BY 1 HAVING count(*) > 1)",
           duplicateCount="n")
C22 = row("准确性", "orders 金额异常", ok("p + s + t = 0"), counted("s_orders", p="paid_amount < 0", s="subtotal < 0", t="total_amount < 0",
          o="paid_amount > total_amount * 1.5"), negative_paid="p", negative_subtotal="s", negative_total="t", paid_over_total="o")
C23 = row("一致性", "order_items 行金额与订单金额差异", ok("n = 0", "warn"), """SELECT count(*) AS n FROM s_orders o
    JOIN (SELECT order_id, sum(line_amount) AS a FROM s_order_items GROUP BY 1) l ON l.order_id = o.order_id WHERE abs(paid_amount - a) > 0.01""",
          mismatchCount="n")
C24 = row("准确性", "refunds 退款金额异常", ok("n + o = 0", "warn"), """SELECT count(*) FILTER (WHERE amount < 0) AS n,
    count(*) FILTER (WHERE amount > paid_amount) AS o FROM s_refunds r JOIN s_orders s ON s.order_id = r.order_id""", negative_amount="n", overpaid_refund="o")
C25 = row("准确性", "sku 负库存检查", ok("n = 0"), counted("s_sku", n="stock < 0"), negativeStockCount="n")
C26 = row("业务逻辑", "coupons 整体使用状态", "'pass'", counted("s_coupons", n="used_count > 0"), usedTemplates="n", totalTemplates="total")
C28 = union(spread("分布", "orders 状态分布"), *[row("时效性", f"{t} 时间范围", "'pass'", SPAN.format(t=t, c="created_at"), minDate="a", maxDate="b")
            for t in ("orders", "page_events")], row("完整性", "page_events 匿名流量比例", "'pass'", counted("s_page_events", n="user_id IS NULL"),
            anonymous="n", total="total", ratio=rate("n", "total")))
SERVICE = union(C19, C20, C21, C22, C23, C28, C24, C25, C26)
TOTALS = "SELECT count(*) AS total, " + ", ".join(f"count(*) FILTER (WHERE status = '{s}') AS {s}" for s in ("pass", "warn", "fail", "error"))

for name, sql, fn in (
    ("c01_row_counts", C01, lambda t: q.row_counts(t, BOUNDS)),
    ("c02_quick_report", C02, lambda t: q.quick_report(t, QUICK)),
    ("c03_user_missing_rates", C03, lambda t: q.user_missing(t["users"])),
    ("c04_amount_missing_rates", C04, lambda t: q.amount_missing(t["orders"])),
    ("c05_anonymous_share", C05, lambda t: q.anonymous_share(t["page_events"])),
    ("c06_completeness_report", union(C01, C03, C04, C05), lambda t: q.completeness(t, BOUNDS)),
    ("c07_key_uniqueness", C07, lambda t: q.uniqueness(t)),
    ("c08_negative_amounts", C08, lambda t: q.negative_amounts(t["orders"])),
    ("c09_header_against_lines", C09, lambda t: q.header_against_lines(t["orders"], t["order_items"])),
    ("c10_refunds_over_paid", C10, lambda t: q.refunds_over_paid(t["orders"], t["refunds"])),
    ("c11_negative_stock", C11, lambda t: q.negative_stock(t["inventory_movements"])),
    ("c12_price_below_cost", C12, lambda t: q.price_below_cost(t["sku"])),
    ("c13_timeliness", C13, lambda t: q.timeliness(t, "2003-01-01")),
    ("c14_orphan_keys", C14, lambda t: q.orphans(t)),
    ("c15_status_distribution", C15, lambda t: q.status_distribution(t["orders"])),
    ("c16_paid_before_created", C16, lambda t: q.paid_before_created(t["payments"], t["orders"])),
    ("c17_funnel_events", C17, lambda t: q.funnel_events(t["page_events"])),
    ("c18_full_report", FULL, lambda t: q.full_report(t, BOUNDS, "2003-01-01")),
    ("c19_expected_rows", C19, lambda t: q.expected_rows(t, EXPECTED)),
    ("c20_user_blanks", C20, lambda t: q.user_blanks(t["users"])),
    ("c21_repeated_keys", C21, lambda t: q.repeated_keys(t, KEYS3)),
    ("c21_repeated_line_keys", C21L, lambda t: q.repeated_keys(t, {"order_items": "order_item_id"})),
    ("c22_amount_anomalies", C22, lambda t: q.amount_anomalies(t["orders"])),
    ("c23_paid_against_lines", C23, lambda t: q.paid_against_lines(t["orders"], t["order_items"])),
    ("c24_refund_anomalies", C24, lambda t: q.refund_anomalies(t["refunds"], t["orders"])),
    ("c25_negative_stock_column", C25, lambda t: q.negative_stock_column(t["sku"])),
    ("c26_coupons_used", C26, lambda t: q.coupons_used(t["coupons"])),
    ("c28_state_span_anonymous", C28, lambda t: q.state_span_anonymous(t)),
    ("c29_service_report", SERVICE, lambda t: q.service_report(t, EXPECTED)),
):
    check(name, sql)(lambda s, spark, fn=fn: flat(fn(Tables(s))))


@check("c18_full_report_totals", f"{TOTALS} FROM ({FULL})")
def _(s, spark):
    return q.status_totals(q.full_report(Tables(s), BOUNDS, "2003-01-01"))


@check("c29_service_report_totals", f"{TOTALS} FROM ({SERVICE})")
def _(s, spark):
    return q.status_totals(q.service_report(Tables(s), EXPECTED))


USER_TYPES = {"user_id": "bigint", **dict.fromkeys(("name", "email", "phone", "province", "city", "register_channel", "segment", "gender"), "string"),
              "birth_year": "int", "member_level": "string", "status": "string", "created_at": "timestamp_ntz"}


@check("c27_missing_summary", union(*[f"""SELECT '{c}' AS "column", count(*) - count({c}) AS missing_count,
    round((count(*) - count({c})) / count(*), 4) AS missing_rate, '{t}' AS dtype FROM s_users""" for c, t in USER_TYPES.items()]))
def _(s, spark):
    return q.missing_summary(s.users)
