"""Cleaning and preparation: missing values, outliers, encoding, scaling, selection.

A step first computes its statistics (one row, or one value per column) and then
is a projection with those numbers in it, so steps chain without nesting plans.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tillwise.functions.exprs import clip, round_to
from tillwise.functions.scale import exact_quantiles, running_totals, stats


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


# ---- missing values ------------------------------------------------------------
def _modes(df: DataFrame, columns: Sequence[str]) -> dict:
    """Most frequent value per column, the smallest on ties."""
    out = {}
    for c in columns:
        counts = df.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("v")).agg(F.count(F.lit(1)).alias("n"))
        best = counts.agg(F.min(F.struct((-F.col("n")).alias("n"), "v")).alias("m")).first()["m"]
        out[c] = best["v"] if best else None
    return out


def handle_missing(df: DataFrame, strategy: str = "auto", columns: Sequence[str] | None = None) -> DataFrame:
    """drop | mean | median | mode | auto.

    mean and median fill numbers; other columns (and every text column under
    auto) get their mode, or 'unknown' when nothing is known. auto fills numbers
    with the median. Filled integer columns become doubles under mean and median.
    """
    columns = list(columns or df.columns)
    if strategy == "drop":
        return df.dropna(subset=columns)
    holes = stats(df, **{c: F.count_if(F.col(c).isNull()) for c in columns})
    gaps = [c for c in columns if holes[c]]
    numbers = [c for c in numeric_columns(df) if c in gaps] if strategy in ("mean", "median", "auto") else []
    fill: dict = {}
    if numbers:
        if strategy == "mean":
            fill = stats(df, **{c: F.avg(c) for c in numbers})
        else:
            q = exact_quantiles(df, numbers, [0.5])
            fill = {c: q[c, 0.5] for c in numbers}
    text = set(text_columns(df))
    for c, v in _modes(df, [c for c in gaps if c not in fill]).items():
        fill[c] = v if v is not None else ("0" if strategy == "mode" else "unknown") if c in text else None
    return df.withColumns({c: F.coalesce(F.col(c).cast("double") if c in numbers else F.col(c), F.lit(fill[c])) for c in gaps})


# ---- outliers --------------------------------------------------------------------
def _fences(df: DataFrame, columns: Sequence[str], multiplier: float) -> dict[str, tuple[Column, Column]]:
    q = exact_quantiles(df, columns, [0.25, 0.75])
    out = {}
    for c in columns:
        q1, q3 = q[c, 0.25], q[c, 0.75]
        known = q1 is not None
        out[c] = tuple(F.lit(v).cast("double") for v in (
            (q1 - (q3 - q1) * multiplier, q3 + (q3 - q1) * multiplier) if known else (None, None)))
    return out


def clip_iqr(df: DataFrame, columns: Sequence[str] | None = None, multiplier: float = 1.5) -> DataFrame:
    """Pull values outside [q1 - m·iqr, q3 + m·iqr] to the nearer bound."""
    columns = columns or numeric_columns(df)
    fences = _fences(df, columns, multiplier)
    return df.withColumns({c: clip(F.col(c).cast("double"), *fences[c]) for c in columns})


def clip_zscore(df: DataFrame, columns: Sequence[str] | None = None, threshold: float = 3.0) -> DataFrame:
    """Pull values beyond mean ± threshold sample deviations to the bound; constant columns stay."""
    columns = columns or numeric_columns(df)
    st = _moments(df, columns, F.stddev_samp)
    fixed = {c: clip(F.col(c).cast("double"), F.lit(mu - sd * threshold), F.lit(mu + sd * threshold))
             for c, (mu, sd) in st.items() if sd}
    return df.withColumns(fixed)


def iqr_outliers(df: DataFrame, column: str, multiplier: float = 1.5, flag: str = "is_outlier") -> DataFrame:
    low, high = _fences(df, [column], multiplier)[column]
    return df.withColumn(flag, F.coalesce((F.col(column) < low) | (F.col(column) > high), F.lit(False)))


def zscore_outliers(df: DataFrame, column: str, threshold: float = 3.0, flag: str = "is_outlier") -> DataFrame:
    mu, sd = _moments(df, [column], F.stddev_samp)[column]
    if not sd:
        return df.withColumn(flag, F.lit(False))
    return df.withColumn(flag, F.coalesce(F.abs(F.col(column) - mu) / sd > threshold, F.lit(False)))


def _moments(df: DataFrame, columns: Sequence[str], deviation) -> dict[str, tuple[float, float]]:
    st = stats(df, **{f"{c}_mu": F.avg(c) for c in columns}, **{f"{c}_sd": deviation(c) for c in columns})
    return {c: (st[f"{c}_mu"], st[f"{c}_sd"]) for c in columns}


def standardize(df: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """(x - mean) / sample deviation; x - mean when the deviation is 0."""
    mu, sd = _moments(df, [column], F.stddev_samp)[column]
    return df.withColumn(out or column, (F.col(column) - F.lit(mu)) / F.lit(sd or 1.0))


def quantile_table(df: DataFrame, column: str, points: Sequence[float] = (0.0, 0.25, 0.5, 0.75, 1.0)) -> DataFrame:
    """Rows (name, value), name p0, p25, ..."""
    q = exact_quantiles(df, [column], points)
    return df.sparkSession.createDataFrame([(f"p{int(p * 100 + 1e-9)}", q[column, p]) for p in points], "name string, value double")


# ---- encoding ----------------------------------------------------------------------
def one_hot(df: DataFrame, columns: Sequence[str] | None = None, max_levels: int = 1000) -> DataFrame:
    """One 0/1 column per level in sorted order, the first level dropped.

    Levels become columns, so a column with more than ``max_levels`` is an error.
    """
    columns = list(columns or text_columns(df))
    made: list[Column] = []
    for c in columns:
        levels = [r[0] for r in df.where(F.col(c).isNotNull()).select(c).distinct().orderBy(c).limit(max_levels + 1).collect()]
        if len(levels) > max_levels:
            raise ValueError(f"column {c} has more than {max_levels} levels; use ordinal codes")
        made += [F.coalesce(F.col(c) == v, F.lit(False)).cast("int").alias(f"{c}_{v}") for v in levels[1:]]
    return df.select(*[c for c in df.columns if c not in columns], *made)


def ordinal(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Codes 0, 1, ... in sorted level order, -1 for NULL. Works for any number of levels."""
    columns = list(columns or text_columns(df))
    out = df
    for c in columns:
        levels = df.where(F.col(c).isNotNull()).select(F.col(c).alias("_level")).distinct()
        codes = running_totals(levels, [F.asc("_level")], _rank=F.lit(1)).select(
            "_level", (F.col("_rank") - 1).cast("int").alias("_code"))
        out = (out.join(codes, F.col(c) == F.col("_level"), "left").drop("_level")
               .withColumn(c, F.coalesce("_code", F.lit(-1))).drop("_code"))
    return out


# ---- scaling -----------------------------------------------------------------------
def scale_features(df: DataFrame, method: str = "standard", columns: Sequence[str] | None = None) -> DataFrame:
    """standard (population deviation), minmax or robust (median and IQR); a spread of 0 divides by 1."""
    columns = list(columns or numeric_columns(df))
    if method == "minmax":
        st = stats(df, **{f"{c}_a": F.min(c) for c in columns}, **{f"{c}_b": F.max(c) for c in columns})
        shape = {c: (st[f"{c}_a"], st[f"{c}_b"] - st[f"{c}_a"]) for c in columns if st[f"{c}_a"] is not None}
    elif method == "robust":
        q = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
        shape = {c: (q[c, 0.5], q[c, 0.75] - q[c, 0.25]) for c in columns if q[c, 0.5] is not None}
    else:
        shape = {c: v for c, v in _moments(df, columns, F.stddev_pop).items() if v[0] is not None}
    return df.withColumns({c: (F.col(c) - F.lit(centre)).cast("double") / F.lit(float(spread) or 1.0)
                           for c, (centre, spread) in shape.items()})


# ---- selection ---------------------------------------------------------------------
def correlations(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows (i, j, feature1, feature2, r) for every pair i < j, from one aggregate."""
    columns = list(columns or numeric_columns(df))
    pairs = [(i, j) for i in range(len(columns)) for j in range(i + 1, len(columns))]
    wide = df.agg(*[F.corr(F.col(columns[i]).cast("double"), F.col(columns[j]).cast("double")).alias(f"r_{i}_{j}")
                    for i, j in pairs])
    rows = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(columns[i]).alias("feature1"),
                              F.lit(columns[j]).alias("feature2"), F.col(f"r_{i}_{j}").alias("r")) for i, j in pairs])
    return wide.select(F.inline(rows))


def correlated_features(df: DataFrame, threshold: float = 0.9, columns: Sequence[str] | None = None) -> DataFrame:
    """Features to drop: the later one of any pair with abs(r) above the threshold."""
    return (correlations(df, columns).where(F.abs("r") > threshold)
            .select(F.col("feature2").alias("feature")).distinct())


def flat_features(df: DataFrame, threshold: float = 0.01, columns: Sequence[str] | None = None) -> DataFrame:
    """Features whose sample variance is below the threshold."""
    columns = list(columns or numeric_columns(df))
    wide = df.agg(*[F.var_samp(c).alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("variance")) for c in columns])
    return wide.select(F.inline(rows)).where(F.col("variance") < threshold).select("feature", round_to("variance", 6).alias("variance"))


def prepare(df: DataFrame, config: Mapping[str, str | None] | None = None) -> DataFrame:
    """missing -> outliers -> encode -> scale; a step without a setting is skipped."""
    config = dict(config or {})
    df = handle_missing(df, config.get("missing") or "auto")
    outliers = {"iqr": clip_iqr, "zscore": clip_zscore}.get(config.get("outliers"))
    if outliers:
        df = outliers(df)
    encode = {"onehot": one_hot, "ordinal": ordinal}.get(config.get("encode"))
    if encode:
        df = encode(df)
    if config.get("scale"):
        df = scale_features(df, config["scale"])
    return df
