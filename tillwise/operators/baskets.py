"""Market baskets, frequent itemsets up to three items, and association rules.

Equal baskets are merged into one row with a count before any combination is
made, so a basket copied a million times costs as much as one. Combinations are
limited to three frequent items, and triples are only counted where all their
pairs are frequent.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tillwise.functions.exprs import price_band, round_to
from tillwise.functions.scale import durable, stats


def _baskets(pairs: DataFrame, min_items: int) -> DataFrame:
    """(order_id, item) rows to sorted item sets; items come from a bounded list of names."""
    return (pairs.groupBy("order_id").agg(F.sort_array(F.collect_set("item")).alias("items"))
            .where(F.size("items") >= min_items))


def sku_baskets(lines: DataFrame, min_items: int = 2, top_n: int = 80) -> DataFrame:
    """Baskets over the ``top_n`` SKUs with most lines; an order needs ``min_items`` such LINES."""
    top = (lines.groupBy("sku_id").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "sku_id").limit(top_n)
           .select("sku_id"))
    # top has top_n rows
    kept = lines.select("order_id", "sku_id").join(F.broadcast(top), "sku_id", "left_semi")
    g = kept.groupBy("order_id").agg(F.count(F.lit(1)).alias("n"),
                                     F.sort_array(F.collect_set(F.col("sku_id").cast("string"))).alias("items"))
    return g.where(F.col("n") >= min_items).drop("n")


def category_baskets(lines: DataFrame, products: DataFrame, min_items: int = 2) -> DataFrame:
    pairs = (lines.select("order_id", "sku_id").join(products.select("sku_id", "category_name"), "sku_id")
             .select("order_id", F.col("category_name").alias("item")))
    return _baskets(pairs, min_items)


def price_band_baskets(lines: DataFrame, low: float = 100.0, high: float = 500.0, min_items: int = 2) -> DataFrame:
    """Bands by line price; a price equal to ``high`` is mid here."""
    return _baskets(lines.select("order_id", price_band("unit_price", low, high, high_inclusive=True).alias("item")), min_items)


def _pairs(items: str) -> Column:
    c = F.col(items)
    return F.flatten(F.transform(c, lambda x, i: F.transform(F.slice(c, i + 2, F.size(c)), lambda y: F.array(x, y))))


def frequent_itemsets(baskets: DataFrame, min_support: float = 0.01, max_len: int = 3) -> DataFrame:
    """Itemsets of one to three items with support >= ``min_support``: (items, length, n, support)."""
    merged = baskets.groupBy("items").agg(F.count(F.lit(1)).alias("n"))
    merged = durable(merged)
    total = stats(merged, t=F.sum("n"))["t"] or 0
    enough = F.col("n") >= F.lit(min_support * total - 1e-9)

    def shape(df):
        return df.select("items", F.size("items").alias("length"), "n",
                         (F.col("n") / F.lit(float(total or 1))).alias("support"))

    ones = (merged.select(F.explode("items").alias("item"), "n").groupBy("item").agg(F.sum("n").alias("n")).where(enough))
    levels = [shape(ones.select(F.array("item").alias("items"), "n"))]
    if max_len >= 2:
        # at most (mean basket size / min_support) items are frequent
        frequent = [r["item"] for r in ones.select("item").orderBy("item").collect()]
        if frequent:
            kept = F.array_intersect("items", F.array(*[F.lit(i) for i in frequent]))
            slim = (merged.select(kept.alias("items"), "n").where(F.size("items") >= 2)
                    .groupBy("items").agg(F.sum("n").alias("n")))
            pairs = durable(slim.select(F.explode(_pairs("items")).alias("items"), "n")
                            .groupBy("items").agg(F.sum("n").alias("n")).where(enough))
            levels.append(shape(pairs))
            if max_len >= 3:
                levels.append(shape(_triples(slim, pairs).where(enough)))
    return reduce(DataFrame.unionByName, levels)


def _triples(slim: DataFrame, pairs: DataFrame) -> DataFrame:
    """Counts of triples whose three pairs are all frequent."""
    p = pairs.select(F.col("items")[0].alias("a"), F.col("items")[1].alias("b"))
    grown = (p.join(p.select("a", F.col("b").alias("c")), "a").where(F.col("b") < F.col("c"))
             .join(p.select(F.col("a").alias("b"), F.col("b").alias("c")), ["b", "c"], "left_semi"))
    held = (slim.where(F.size("items") >= 3)
            .select(F.explode(_pairs("items")).alias("pair"), "items", "n")
            .select(F.col("pair")[0].alias("a"), F.col("pair")[1].alias("b"), "items", "n"))
    return (held.join(grown, ["a", "b"]).where(F.array_contains("items", F.col("c")))
            .groupBy(F.array("a", "b", "c").alias("items")).agg(F.sum("n").alias("n")))


def association_rules(itemsets: DataFrame, min_confidence: float = 0.3, min_lift: float = 1.2) -> DataFrame:
    """Rules for EVERY split of each itemset into two non-empty sides.

    Kept when confidence >= ``min_confidence`` and the rounded lift > ``min_lift``.
    Conviction is NULL where confidence is 1.
    """
    power = F.pow(F.lit(2.0), F.col("length")).cast("int")
    split = (itemsets.where(F.col("length") >= 2)
             .withColumn("mask", F.explode(F.sequence(F.lit(1), power - 2))))

    def side(bit):
        return F.filter("items", lambda x, i: F.pmod(F.floor(F.col("mask") / F.pow(F.lit(2.0), i)), F.lit(2)) == bit)

    parts = split.select(side(1).alias("antecedents"), side(0).alias("consequents"), "support")
    known = itemsets.select("items", F.col("support").alias("s"))
    m = (parts.join(known.select(F.col("items").alias("antecedents"), F.col("s").alias("sa")), "antecedents")
         .join(known.select(F.col("items").alias("consequents"), F.col("s").alias("sc")), "consequents"))
    m = m.withColumn("conf", F.col("support") / F.col("sa")).where(F.col("conf") >= min_confidence - 1e-12)
    out = m.select("antecedents", "consequents", round_to("support", 6).alias("support"), round_to("conf", 4).alias("confidence"),
                   round_to(F.col("conf") / F.col("sc"), 4).alias("lift"),
                   round_to(F.col("support") - F.col("sa") * F.col("sc"), 6).alias("leverage"),
                   round_to(F.try_divide(1 - F.col("sc"), F.when(F.col("conf") < 1 - 1e-12, 1 - F.col("conf"))), 4).alias("conviction"))
    return out.where(F.col("lift") > min_lift)


def _best(rules: DataFrame, top_n: int, *order: Column) -> DataFrame:
    return rules.orderBy(*order, "antecedents", "consequents").limit(top_n)


def bundles(rules: DataFrame, top_n: int = 20) -> DataFrame:
    return _best(rules.where((F.col("lift") >= 1.5) & (F.col("confidence") >= 0.4)), top_n, F.desc("lift"))


def cross_sell(rules: DataFrame, top_n: int = 20) -> DataFrame:
    return _best(rules.where(~F.arrays_overlap("antecedents", "consequents")), top_n, F.desc("lift"))


def add_ons(rules: DataFrame, top_n: int = 20) -> DataFrame:
    return _best(rules, top_n, F.desc("lift"), F.desc("confidence"))


def unsuitable(rules: DataFrame, top_n: int = 10) -> DataFrame:
    """Strong lift on very rare baskets."""
    return _best(rules.where((F.col("lift") > 2) & (F.col("support") < 0.005)), top_n, F.desc("lift"))


def recommendations(rules: DataFrame, item: str | None = None, top_n: int = 10) -> DataFrame:
    """Best consequents for one item, or for every item that occurs on a left side."""
    r = rules.select(F.explode("antecedents").alias("item"), F.col("consequents").alias("recommend"), "antecedents",
                     "confidence", "lift")
    if item is not None:
        r = r.where(F.col("item") == str(item))
    rank = F.row_number().over(W.partitionBy("item").orderBy(F.desc("lift"), F.desc("confidence"), "recommend", "antecedents"))
    return r.withColumn("rank", rank).where(F.col("rank") <= top_n).select("item", "rank", "recommend", "confidence", "lift")


def run(lines: DataFrame, products: DataFrame, sku_support=0.0005, category_support=0.01, confidence=0.15, lift=1.05) -> dict:
    """The whole basket analysis as named frames."""
    sku_sets = frequent_itemsets(sku_baskets(lines), sku_support)
    cat_sets = frequent_itemsets(category_baskets(lines, products), category_support)
    sku_rules = durable(association_rules(sku_sets, confidence, lift))
    cat_rules = association_rules(cat_sets, confidence, lift)
    return {"sku_itemsets": sku_sets, "sku_rules": sku_rules, "category_itemsets": cat_sets, "category_rules": cat_rules,
            "bundles": bundles(sku_rules, 10), "cross_sell": cross_sell(cat_rules, 10), "add_ons": add_ons(sku_rules, 10),
            "unsuitable": unsuitable(sku_rules)}


def prune_redundant(rules: DataFrame) -> DataFrame:
    """Drop a rule when fewer items on its left side give the same right side at least as surely."""
    simple = rules.select(F.col("antecedents").alias("_a"), F.col("consequents").alias("_c"), F.col("confidence").alias("_f"))
    worse = ((F.col("consequents") == F.col("_c")) & (F.size("_a") < F.size("antecedents"))
             & (F.size(F.array_except("_a", "antecedents")) == 0) & (F.col("_f") >= F.col("confidence")))
    return rules.join(simple, worse, "left_anti")


def bundle_revenue(rules: DataFrame, baskets: DataFrame, products: DataFrame, discount: float = 0.1) -> DataFrame:
    """Revenue and margin of selling each rule's items together at a discount, at the rule's basket count."""
    n = baskets.agg(F.count(F.lit(1)).alias("n")).scalar()
    price = products.select(F.col("sku_id").cast("string").alias("item"), "price", "cost")
    lines = (rules.select("antecedents", "consequents", "support", F.explode(F.concat("antecedents", "consequents")).alias("item"))
             .join(price, "item"))
    g = lines.groupBy("antecedents", "consequents", "support").agg(F.sum("price").alias("p"), F.sum("cost").alias("c"))
    orders = F.col("support") * n
    return g.select("antecedents", "consequents", round_to("p").alias("bundle_price"), round_to(orders, 1).alias("expected_orders"),
                    round_to(orders * F.col("p") * (1 - discount)).alias("expected_revenue"),
                    round_to(orders * (F.col("p") * (1 - discount) - F.col("c"))).alias("expected_margin"))
