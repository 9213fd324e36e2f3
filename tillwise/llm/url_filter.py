"""URL filter: allow and block rules, and boosted trees on lexical features for the URLs no rule fits.

Everything on the way from URL to verdict is a DataFrame expression or Spark ML on the JVM.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from tillwise.llm.common import stored

FIT_ROWS = 20_000     # labelled URLs used for fitting: a hash sample of about this many where there are more
SUFFIX_BINS = 16_384  # host suffixes are counted in this many hash bins: bounds what is broadcast
SMOOTHING = 20.0      # pseudo-observations at the overall rate, for rare suffixes
FEATURES = ("url_len", "host_len", "path_len", "host_depth", "path_depth", "digit_ratio", "host_digit_ratio", "hyphens",
            "entropy", "params", "query_len", "fragment", "escapes", "https", "suffix_rate", "domain_rate")


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str  # allow or block

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; null or no ``://``: empty."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def fitting_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Text of the longest rule whose host is the url's host or a parent of it and whose path starts the url's path."""
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.lit(r.text)).otherwise(out)
    return out


def _chars(s: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(s, pattern, "")).cast("double")


def lexical(urls: DataFrame) -> DataFrame:
    """Adds the lexical features to rows with ``url``, ``host`` and ``path``; null urls count as empty."""
    url = F.coalesce("url", F.lit(""))
    n = F.greatest(F.length(url), F.lit(1)).cast("double")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    parts = F.transform(F.array_distinct(F.split(url, "")), lambda c: (F.length(url) - F.length(F.replace(url, c, F.lit("")))) / n)
    entropy = F.aggregate(F.filter(parts, lambda p: p > 0), F.lit(0.0), lambda a, p: a - p * F.log2(p))
    host_n = F.greatest(F.length("host"), F.lit(1)).cast("double")
    return urls.withColumns({
        "url_len": F.log1p(F.length(url).cast("double")), "host_len": F.length("host").cast("double"),
        "path_len": F.log1p(F.length("path").cast("double")), "host_depth": _chars(F.col("host"), r"[^.]"),
        "path_depth": _chars(F.col("path"), r"[^/]"), "digit_ratio": _chars(url, r"[^0-9]") / n,
        "host_digit_ratio": _chars(F.col("host"), r"[^0-9]") / host_n, "hyphens": _chars(F.col("host"), r"[^-]"), "entropy": entropy,
        "params": F.when(query == "", 0.0).otherwise(1.0 + _chars(query, r"[^&]")), "query_len": F.log1p(F.length(query).cast("double")),
        "fragment": F.contains(url, F.lit("#")).cast("double"), "escapes": _chars(url, r"[^%]"),
        "https": F.startswith(url, F.lit("https:")).cast("double"),
        "suffix_bin": _bin(F.substring_index("host", ".", -1)), "domain_bin": _bin(F.substring_index("host", ".", -2)),
    })


def _bin(suffix: Column) -> Column:
    return F.pmod(F.xxhash64(suffix), F.lit(SUFFIX_BINS)).cast("int")


@dataclass(frozen=True)
class UrlModel:
    """``rates``: share of blocked URLs per suffix bin (at most 2 x SUFFIX_BINS rows); ``trees``: None where the
    labelled URLs were of one class or none, so that ``prior`` decides."""
    rates: DataFrame
    trees: GBTClassificationModel | None
    prior: float


def fit(labelled: DataFrame, fit_rows: int = FIT_ROWS, rounds: int = 20, depth: int = 4) -> UrlModel:
    """``labelled``: url, host, path, label (1.0 block, 0.0 allow). Suffix statistics come from all of it, trees from a
    sample of about ``fit_rows`` rows, drawn by a hash of the url."""
    spark = labelled.sparkSession
    totals = labelled.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0.0)).alias("blocked")).first()
    prior = totals["blocked"] / totals["n"] if totals["n"] else 0.0
    rows = lexical(labelled)
    rates = stored(rows.select(F.explode(F.array(*[F.struct(F.lit(k).alias("level"), F.col(c).alias("bin")) for k, c in
                                                   enumerate(("suffix_bin", "domain_bin"))])).alias("s"), "label")
                   .groupBy("s.level", "s.bin").agg(((F.sum("label") + F.lit(SMOOTHING * prior)) / (F.count("*") + F.lit(SMOOTHING))).alias("rate")),
                   "url-rates")
    if not 0 < totals["blocked"] < totals["n"]:
        return UrlModel(rates, None, prior)
    share = min(1.0, fit_rows / totals["n"])
    kept = F.pmod(F.xxhash64("url", F.lit("fit")), F.lit(1_000_000)) < int(share * 1_000_000)
    sample = stored(with_rates(rows.where(kept), rates, prior).select("label", *FEATURES), "url-fit")
    if sample.select("label").distinct().count() < 2:
        return UrlModel(rates, None, prior)
    parts = max(1, min(8, spark.sparkContext.defaultParallelism))
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="vector").transform(sample).coalesce(parts)
    trees = GBTClassifier(featuresCol="vector", labelCol="label", maxIter=rounds, maxDepth=depth, stepSize=0.2, seed=7).fit(vectors)
    return UrlModel(rates, trees, prior)


def with_rates(rows: DataFrame, rates: DataFrame, prior: float) -> DataFrame:
    for level, (column, name) in enumerate((("suffix_bin", "suffix_rate"), ("domain_bin", "domain_rate"))):
        side = rates.where(F.col("level") == level).select(F.col("bin").alias(column), F.col("rate").alias(name))
        rows = rows.join(F.broadcast(side), column, "left").fillna({name: prior})  # at most SUFFIX_BINS rows
    return rows


def judge(pages: DataFrame, rules: list[Rule], labelled: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``block_score`` for every row.

    A fitting rule decides; else the trees (block from a probability of 0.5). ``labelled`` has url and label (1 block,
    0 allow); without it the URLs that a rule decides are the labelled ones. Null and malformed urls have empty host
    and path and are judged by the model. With no labelled URL, or of one class only, its share decides.
    """
    spark = pages.sparkSession
    urls = pages.select(pages[id_col].alias("page_id"), pages[url_col].alias("url")).withColumns(
        {"host": host_of(F.col("url")), "path": path_of(F.col("url"))}).fillna("", ["host", "path"])
    rule = fitting_rule(F.col("host"), F.col("path"), rules)
    verdict = F.coalesce(*[F.when(F.col("rule") == r.text, F.lit(r.verdict)) for r in rules], F.lit(None).cast("string")) if rules else F.lit(None).cast("string")
    urls = urls.withColumn("rule", rule).withColumn("ruled", verdict)
    if labelled is None:
        known = urls.where(F.col("ruled").isNotNull()).select("url", "host", "path", (F.col("ruled") == "block").cast("double").alias("label"))
    else:
        known = labelled.select("url", F.col("label").cast("double").alias("label")).where("label is not null").withColumns(
            {"host": host_of(F.col("url")), "path": path_of(F.col("url"))}).fillna("", ["host", "path"])
    model = fit(known)
    if model.trees is None:
        scored = urls.withColumn("block_score", F.lit(float(model.prior)))
    else:
        ready = with_rates(lexical(urls), model.rates, model.prior)
        ready = VectorAssembler(inputCols=list(FEATURES), outputCol="vector").transform(ready)
        scored = model.trees.transform(ready).withColumn("block_score", vector_to_array("probability")[1])
    return scored.select("page_id", "host", "path", "rule",
                         F.coalesce("ruled", F.when(F.col("block_score") >= 0.5, "block").otherwise("allow")).alias("verdict"), "block_score")
