"""Exact top-k search over binary codes by incremental multi-index hashing.

A code of b bits is cut into m segments and indexed once per segment. Codes within Hamming distance m (r + 1) - 1 of a
query differ by at most r bits in some segment, so probing all segments with radii 0, 1, ... and verifying whole codes
proves a query's answer complete once its k-th distance is covered. Queries that are complete leave the search.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tillwise.llm.common import joined, stored

WIDEST = 20  # bits of a segment at most: bounds the masks of one radius (184,756) that are formed in one value


def segment_widths(bits: int, rows: int) -> list[int]:
    """About log2(rows) bits each, so that a bucket holds about one code."""
    m = math.ceil(bits / min(WIDEST, max(4, math.log2(max(2, rows)))))
    return [bits // m + (j < bits % m) for j in range(m)]


def _segments(vector: Column, widths: list[int]) -> list[Column]:
    """Sign bits (null, NaN and components beyond the end: 0) of the components, packed into one integer a segment."""
    out, at = [], 0
    for width in widths:
        bits = [F.when((F.get(vector, F.lit(at + i)) > 0) & ~F.isnan(F.get(vector, F.lit(at + i))), F.lit(1 << i)).otherwise(F.lit(0)) for i in range(width)]
        value = bits[0]
        for b in bits[1:]:
            value = value + b
        out.append(value)
        at += width
    return out


def _distance(left: str, right: str, m: int) -> Column:
    d = F.bit_count(F.col(f"{left}0").bitwiseXOR(F.col(f"{right}0")))
    for j in range(1, m):
        d = d + F.bit_count(F.col(f"{left}{j}").bitwiseXOR(F.col(f"{right}{j}")))
    return d


def search(vectors: DataFrame, queries: DataFrame | None = None, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, neighbour_id, distance``: the ``k`` nearest other rows of every query, by distance and then id.

    ``queries``: rows of the same shape (default: rows whose id is divisible by 50). The code of a vector is the signs of its
    components, as many bits as the longest vector has; what a shorter vector lacks counts as 0. Rows without an id or with a
    null vector take no part; ids are taken as unique, a repeated row counts once. Fewer rows than ``k`` give fewer neighbours.

    Equal codes are one code with its k + 1 least ids, so a vector that is repeated endlessly costs as much as one.
    """
    def rows_of(df: DataFrame) -> DataFrame:
        return df.select(df[id_col].cast("long").alias("id"), df[vector_col].alias("vector")).where("id is not null and vector is not null")

    table = rows_of(vectors)
    shape = table.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("bits")).first()
    bits = shape["bits"] or 0
    spark = vectors.sparkSession
    if bits == 0:
        return spark.createDataFrame([], "query_id long, rank int, neighbour_id long, distance int")
    widths = segment_widths(bits, shape["n"])
    m, columns = len(widths), [f"s{j}" for j in range(len(widths))]
    asked = [f"q{j}" for j in range(m)]

    def coded(df: DataFrame, names: list[str]) -> DataFrame:
        return df.select("id", *[c.alias(n) for n, c in zip(names, _segments(F.col("vector"), widths))])

    first = F.row_number().over(W.partitionBy(*columns).orderBy("id"))
    codes = stored(coded(table, columns).distinct().withColumn("rn", first).where(F.col("rn") <= k + 1)
                   .groupBy(*columns).agg(F.sort_array(F.collect_list("id")).alias("ids")), "codes")  # at most k + 1 ids a code
    chosen = stored(coded(rows_of(queries) if queries is not None else table.where("id % 50 = 0"), asked).distinct(), "queries")
    index = stored(codes.select("*", F.explode(F.array(*[F.struct(F.lit(j).alias("seg"), F.col(c).alias("value")) for j, c in enumerate(columns)])).alias("at"))
                   .select(*columns, "ids", "at.seg", "at.value"), "segment-index")
    open_queries = stored(chosen.select(*asked).distinct().withColumn("bound", F.lit(bits)), "open-queries")
    found, done = None, None
    for radius in range(max(widths) + 1):
        masks = spark.range(1 << max(widths)).where(F.bit_count("id") == radius).agg(F.collect_list(F.col("id").cast("int"))).scalar()
        buckets = F.array(*[F.struct(F.lit(j).alias("seg"), F.when(F.col("mask") < (1 << w), F.col(f"q{j}").bitwiseXOR(F.col("mask"))).alias("value"))
                            for j, w in enumerate(widths)])
        probed = open_queries.withColumn("mask", F.explode(masks)).select(*asked, "bound", F.explode(buckets).alias("at")).select(
            *asked, "bound", "at.seg", "at.value").where("value is not null")
        hit = joined(probed, index, ["seg", "value"]).withColumn("distance", _distance("q", "s", m)).where("distance <= bound")
        new = hit.select(*asked, "distance", *columns, "ids")
        pool = (new if found is None else new.unionByName(joined(found, open_queries.select(*asked), asked, "left_semi"))).dropDuplicates(asked + columns)
        ranked = pool.withColumn("id", F.explode("ids")).withColumn("rn", F.row_number().over(W.partitionBy(*asked).orderBy("distance", "id"))).where(
            F.col("rn") <= k + 1)
        found = stored(ranked.groupBy(*asked, "distance", *columns).agg(F.sort_array(F.collect_list("id")).alias("ids")), "found")
        covered = m * (radius + 1) - 1
        state = found.groupBy(*asked).agg(F.sum(F.size("ids")).alias("have"), F.max("distance").alias("kth"))
        state = joined(open_queries.drop("bound"), state, asked, "left").withColumn("full", F.coalesce(F.col("have") > k, F.lit(False)))
        closed = F.lit(True) if covered >= bits else F.col("full") & (F.col("kth") <= covered)
        state = stored(state.withColumn("closed", closed), "search-state")
        answers = joined(found, state.where("closed").select(*asked), asked, "left_semi").select(*asked, "distance", "ids")
        done = answers if done is None else done.unionByName(answers)
        open_queries = stored(state.where("not closed").select(*asked, F.when(F.col("full"), F.col("kth")).otherwise(F.lit(bits)).alias("bound")), "open-queries")
        if covered >= bits or open_queries.isEmpty():
            break
    out = joined(chosen, done, asked).select(F.col("id").alias("query_id"), "distance", F.explode("ids").alias("neighbour_id")).where("query_id <> neighbour_id")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy("distance", "neighbour_id"))
    return out.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "neighbour_id", "distance")
