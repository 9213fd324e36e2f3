"""Mixing sources to target weights by Poisson replication.

Each source gets a mean repetition rate from its target share of the output; each document draws its number of copies
by inverting the Poisson distribution at a hash of seed and id; copies are shuffled globally by another hash.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

PIECE = 64.0   # a rate is drawn as a sum of Poisson draws of at most this mean, so that exp(-rate) stays a normal number
TAIL = 160     # counts looked at per draw: the chance of more than 160 at mean 64 is below 1e-20


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from an MD5 of the parts: the first 52 bits."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts).cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def poisson_cdf(rate: Column) -> Column:
    """Array of P(N <= 0), P(N <= 1), ... for one draw, by the recurrence of its terms."""
    start = F.struct(F.exp(-rate).alias("term"), F.array(F.exp(-rate)).alias("cdf"))
    step = lambda acc, k: F.struct((acc["term"] * rate / k).alias("term"),
                                   F.concat(acc["cdf"], F.array(F.element_at(acc["cdf"], -1) + acc["term"] * rate / k)).alias("cdf"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(TAIL)), start, step, lambda acc: acc["cdf"])


def source_rates(docs: DataFrame, weights: Mapping[str, float] | None, total_ratio: float, temperature: float, source_col: str, text_col: str) -> DataFrame:
    """One row per source: ``bytes``, ``target_share``, ``rate`` and the tables for drawing.

    Shares: ``weights`` (others 0), or bytes to the power 1/``temperature``. ``rate`` = share x output bytes / bytes,
    output bytes being ``total_ratio`` times the input's.
    """
    size = (F.coalesce(F.octet_length(docs[text_col]), F.lit(0)) + 1).cast("long")
    per = docs.select(docs[source_col].alias("source"), size.alias("size")).groupBy("source").agg(F.sum("size").alias("bytes"))
    if weights is None:
        wanted = F.pow(F.col("bytes").cast("double"), F.lit(1.0 / temperature))
    else:
        wanted = F.lit(0.0)
        for name, w in weights.items():  # as many branches as the caller named weights
            wanted = F.when(F.col("source") == name, F.lit(float(w))).otherwise(wanted)
    per = per.withColumn("wanted", wanted)
    totals = per.agg(F.struct(F.sum("bytes").alias("bytes"), F.sum("wanted").alias("wanted"))).scalar()
    share = F.coalesce(F.try_divide(F.col("wanted"), totals["wanted"]), F.lit(0.0))
    return (per.withColumn("target_share", share)
            .withColumn("rate", F.round(F.col("target_share") * F.lit(total_ratio) * totals["bytes"] / F.col("bytes"), 9))
            .withColumn("pieces", F.greatest(F.ceil(F.col("rate") / PIECE), F.lit(1)).cast("int"))
            .withColumn("cdf", poisson_cdf(F.col("rate") / F.col("pieces")))
            .drop("wanted"))


def mix(docs: DataFrame, weights: Mapping[str, float] | None = None, total_ratio: float = 1.0, temperature: float = 2.0, seed: int = 11,
        keep: tuple[str, ...] = (), id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``doc_id, source, rate, copies, copy, position`` for every copy; the input columns named in ``keep`` as the struct ``kept``.

    Ordered by ``position``, a hash of seed, id and copy: rows of one range of positions lie in one output partition, so the
    files in order are the shuffled corpus. A null source is a source of its own; null ids share one draw. A source with
    weight 0 gives no rows. Repeated rows draw alike, as copies are decided by id.
    """
    rates = source_rates(docs, weights, total_ratio, temperature, source_col, text_col).select(
        F.col("source").alias("__s"), F.col("rate").alias("__rate"), F.col("pieces").alias("__pieces"), F.col("cdf").alias("__cdf"))
    rows = docs.select(docs[id_col].alias("__id"), docs[source_col].alias("__source"), *([F.struct(*[docs[c] for c in keep]).alias("__kept")] if keep else []))
    # One row per source on the right; adaptive execution broadcasts it when small and splits a hot source when not.
    rows = rows.join(rates, F.col("__source").eqNullSafe(F.col("__s")))
    one = lambda k: _count_at(F.col("__cdf"), uniform(F.lit(f"{seed}:draw"), F.coalesce(F.col("__id").cast("string"), F.lit("null")), k.cast("string")))
    rows = rows.withColumn("__copies", F.when(F.col("__pieces") == 1, one(F.lit(1))).otherwise(
        F.aggregate(F.sequence(F.lit(1), F.col("__pieces")), F.lit(0), lambda a, k: a + one(k))))
    rows = rows.where("__copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
    rows = rows.withColumn("__position", uniform(F.lit(f"{seed}:place"), F.coalesce(F.col("__id").cast("string"), F.lit("null")), F.col("__copy").cast("string")))
    out = rows.select(F.col("__id").alias("doc_id"), F.col("__source").alias("source"), F.col("__rate").alias("rate"), F.col("__copies").alias("copies"),
                      F.col("__copy").alias("copy"), F.col("__position").alias("position"), *([F.col("__kept").alias("kept")] if keep else []))
    return out.orderBy("position", "doc_id", "copy")


def _count_at(cdf: Column, u: Column) -> Column:
    """How many entries of the table are at most ``u``: the inverse of the distribution at ``u``.

    An expression named inside a lambda is computed anew for every entry; as the element of an array ``u`` is computed once.
    """
    return F.transform(F.array(u), lambda at: F.size(F.filter(cdf, lambda p: p <= at)))[0]
