"""Exact whole-table statistics that never gather a table in one task.

A ``percentile`` aggregate and an unpartitioned running window both end in a
single task. The helpers here give the same numbers from partial aggregates,
bounded slice tables and windows over evenly sized slices.
"""

from __future__ import annotations

import math
import tempfile
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

BRACKET = 0.0005  # half width of a quantile bracket, above the sketch's rank error of 1/10000


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only in local runs that name none."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="tillwise-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """Cut lineage in the shared checkpoint folder, so executor loss costs no recompute."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def one_row(spark: SparkSession, **columns: Column) -> DataFrame:
    """One row of scalar-subquery columns: combines one-row results without a join."""
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()])


def scalars(df: DataFrame, **aggregates: Column) -> Column:
    """Several whole-table aggregates as one scalar-subquery struct."""
    return df.agg(F.struct(*[a.alias(n) for n, a in aggregates.items()])).scalar()


def stats(df: DataFrame, **aggregates: Column) -> dict:
    """Whole-table aggregates as one row on the driver, for steps that build on each other."""
    return df.agg(*[a.alias(n) for n, a in aggregates.items()]).first().asDict()


def _slice_of(value: Column, edges: Sequence[float], first: int = 0) -> Column:
    """Index of the first edge >= value, as a balanced CASE (log2 comparisons per row)."""
    if not edges:
        return F.lit(first)
    mid = len(edges) // 2
    return F.when(value <= edges[mid], _slice_of(value, edges[:mid], first)).otherwise(
        _slice_of(value, edges[mid + 1:], first + mid + 1))


def exact_quantiles(df: DataFrame, columns: Sequence[str],
                    probs: Sequence[float]) -> dict[tuple[str, float], float | None]:
    """Linear-interpolation quantiles of whole columns, keyed (column, p).

    1. a sketch brackets every wanted rank closely (0.1 % of the rows);
    2. exact counts per slice tell which slices hold the wanted ranks;
    3. only those slices are counted per value (equal values, however many, become
       one row) and ordered.
    A few rows per column and point reach the driver. The sketch only sets the
    slice borders; a poor one makes slices larger, never the result wrong.
    """
    points = sorted({min(max(p + d, 0.0), 1.0) for p in probs for d in (-BRACKET, BRACKET)})
    sketch = stats(df, **{c: F.percentile_approx(F.col(c).cast("double"), points, 10000) for c in columns})
    edges = {c: sorted(set(sketch[c] or [])) for c in columns}
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"),
                               _slice_of(F.col(c).cast("double"), edges[c]).alias("slice")) for c in columns])
    long = (df.select(F.explode(pairs).alias("kv")).select("kv.*")
            .where(F.col("value").isNotNull() & ~F.isnan("value")))
    counts: dict[str, list] = {c: [] for c in columns}
    for r in long.groupBy("column", "slice").agg(F.count(F.lit(1)).alias("n")).orderBy("column", "slice").collect():
        counts[r["column"]].append((r["slice"], r["n"]))

    wanted = []  # (column, slice, rank inside the slice)
    ranks = {}
    for c in columns:
        total = sum(n for _, n in counts[c])
        for p in probs:
            if total:
                rank = p * (total - 1)
                ranks[c, p] = (math.floor(rank), math.ceil(rank), rank - math.floor(rank))
        before = 0
        for number, n in counts[c]:
            for k in {k for (cc, _), v in ranks.items() if cc == c for k in v[:2]}:
                if before <= k < before + n:
                    wanted.append((c, number, k - before, k))
            before += n
    found = {}
    if wanted:
        target = df.sparkSession.createDataFrame(wanted, "column string, slice int, k_in long, k long")
        inside = W.partitionBy("column", "slice").orderBy("value")
        held = reduce(lambda a, b: a | b, [(F.col("column") == c) & (F.col("slice") == i)
                                           for c, i in {(w[0], w[1]) for w in wanted}])
        per_value = (long.where(held).groupBy("column", "slice", "value").agg(F.count(F.lit(1)).alias("n"))
                     .withColumn("to", F.sum("n").over(inside)))
        # target has at most two rows per column and point
        hits = per_value.join(F.broadcast(target), ["column", "slice"]).where(
            (F.col("k_in") >= F.col("to") - F.col("n")) & (F.col("k_in") < F.col("to")))
        found = {(r["column"], r["k"]): r["value"] for r in hits.select("column", "k", "value").collect()}
    out: dict[tuple[str, float], float | None] = {}
    for c in columns:
        for p in probs:
            if (c, p) in ranks:
                low, high, frac = ranks[c, p]
                a, b = found[c, low], found[c, high]
                out[c, p] = a + (b - a) * frac
            else:
                out[c, p] = None
    return out


def running_totals(df: DataFrame, order: Sequence[Column], **values: Column) -> DataFrame:
    """Add running sums of ``values`` in a global ``order`` (which must have no ties),
    and each whole sum as ``total_{name}``.

    Rows are range-placed on the whole order, so equal leading values still
    spread over partitions; each partition is summed on its own and shifted by
    the totals of the partitions before it. The placement is checkpointed, as a
    second run of the range sampling could place rows differently.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.select("*", *[v.alias(f"_v_{n}") for n, v in values.items()])
    placed = durable(placed.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()))
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = (placed.groupBy("_part").agg(*[F.sum(f"_v_{n}").alias(f"_s_{n}") for n in values])
              .select("_part", *[F.coalesce(F.sum(f"_s_{n}").over(earlier), F.lit(0)).alias(f"_o_{n}") for n in values],
                      *[F.sum(f"_s_{n}").over(W.partitionBy()).alias(f"total_{n}") for n in values]))
    inside = W.partitionBy("_part").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    # starts has one row per shuffle partition
    return (placed.join(F.broadcast(starts), "_part")
            .select(*df.columns, *[(F.sum(f"_v_{n}").over(inside) + F.col(f"_o_{n}")).alias(n) for n in values],
                    *[f"total_{n}" for n in values]))
