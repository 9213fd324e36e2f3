"""Reading: source resolution, paged lookups, catalogs, CSV scans, range scans."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tillwise.operators.quality import missing_summary
from tillwise.plans.star import PUBLIC_VIEWS, SOURCE_TABLES, VIEWS, Shop



def table_type(name: str) -> str:
    """dimension / fact / summary / source, or unknown for a name outside the whitelist."""
    if name.startswith("dim_"):
        return "dimension"
    if name.startswith("fact_"):
        return "fact"
    if name in VIEWS:
        return "summary"
    return "source" if name in SOURCE_TABLES else "unknown"


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, infer: bool = False, quoted_breaks: bool = False) -> DataFrame:
    """CSV with header; text columns named like a date or time become timestamps.

    ``infer`` types the other columns by their values. ``quoted_breaks`` is for files whose quoted texts hold line
    breaks: such files are read whole by one task each, so it is off by default.

    A column is converted only if every non-empty value parses, which one
    aggregate over all such columns decides.
    """
    reader = spark.read.option("header", True).option("multiLine", quoted_breaks).option("inferSchema", infer).option("escape", '"')
    df = reader.schema(schema).csv(path) if schema else reader.csv(path)
    dated = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)
             and ("date" in f.name.lower() or "time" in f.name.lower())]
    if not dated:
        return df
    bad = df.agg(*[F.count_if(F.col(c).isNotNull() & F.try_to_timestamp(F.col(c)).isNull()).alias(c)
                   for c in dated]).first()
    good = [c for c in dated if bad[c] == 0]
    return df.withColumns({c: F.try_to_timestamp(F.col(c)) for c in good})


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _hadoop_path(spark, path)
    return bool(fs.exists(p))


def read_csv_folder(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Every ``*.csv`` file or directory in a folder, by stem. Only names are listed on the driver."""
    p, fs = _hadoop_path(spark, folder)
    names = sorted(s.getPath().getName() for s in fs.listStatus(p))
    return {n[:-4]: read_csv(spark, f"{folder}/{n}") for n in names if n.endswith(".csv")}


def load_table(spark: SparkSession, name: str, parquet: str | None = None, csv: str | None = None,
               jdbc: Mapping[str, str] | None = None, offset: int = 0, limit: int | None = None,
               key: str | None = None) -> DataFrame:
    """First available source: Parquet folder, CSV folder, JDBC options.

    JDBC options may carry partitionColumn, lowerBound, upperBound and
    numPartitions so that a large table is read by many tasks.
    """
    if parquet and path_exists(spark, f"{parquet}/{name}.parquet"):
        df = spark.read.parquet(f"{parquet}/{name}.parquet")
    elif csv and path_exists(spark, f"{csv}/{name}.csv"):
        df = read_csv(spark, f"{csv}/{name}.csv")
    elif jdbc:
        df = spark.read.format("jdbc").options(**{**jdbc, "dbtable": name}).load()
    else:
        raise FileNotFoundError(f"no source has table {name}")
    if key:
        df = df.orderBy(key)
    df = df.offset(offset) if offset else df
    return df if limit is None else df.limit(limit)


def fetch_all(df: DataFrame, filters: Mapping[str, object] | None = None) -> DataFrame:
    """A whole filtered table. Scan tasks replace the batches of a paged download."""
    return _filtered(df, filters)


def _filtered(df: DataFrame, filters: Mapping[str, object] | None) -> DataFrame:
    for name, value in (filters or {}).items():
        df = df.where(F.col(name) == F.lit(value))
    return df


def query_table(df: DataFrame, key: str, limit: int = 100, offset: int = 0, order_by: str | None = None,
                descending: bool = False, filters: Mapping[str, object] | None = None) -> DataFrame:
    """One page of a table. ``key`` breaks ties, so pages never overlap."""
    out = _filtered(df, filters)
    order = [F.col(key)]
    if order_by:
        order.insert(0, F.desc(order_by) if descending else F.asc(order_by))
    return out.orderBy(*order).offset(max(offset, 0)).limit(limit)


def page_total(df: DataFrame, filters: Mapping[str, object] | None = None) -> DataFrame:
    """Number of rows the same filters select."""
    return _filtered(df, filters).agg(F.count(F.lit(1)).alias("total"))


def table_schema(df: DataFrame, name: str, primary_key: Iterable[str] = ()) -> DataFrame:
    """One row per column: name, type, nullability, key flag and the table's type tag."""
    keys = set(primary_key)
    rows = [(name, table_type(name), i, f.name, f.dataType.simpleString(), not f.nullable, f.name in keys)
            for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(
        rows, "table_name string, table_type string, position int, name string, type string, not_null boolean, pk boolean")


def table_profile(df: DataFrame, name: str, primary_key: Iterable[str] = ()) -> DataFrame:
    """``table_schema`` with the missing values that the table holds in each column, counted in one pass."""
    held = missing_summary(df).select(F.col("column").alias("name"), "missing_count", "missing_rate")  # one row a column
    return table_schema(df, name, primary_key).join(held, "name")


def catalog(shop: Shop, names: Iterable[str] = (*SOURCE_TABLES, *PUBLIC_VIEWS)) -> DataFrame:
    """Row count and type tag per table, one count per table in a single plan."""
    out = None
    for n in names:
        one = getattr(shop, n).agg(F.count(F.lit(1)).alias("record_count")).select(
            F.lit(n).alias("table_name"), F.lit(table_type(n)).alias("table_type"), "record_count")
        out = one if out is None else out.union(one)
    return out


RANGE_SOURCE = {"fact_order": ("orders", "created_at"), "fact_order_item": ("orders", "created_at"),
                "fact_traffic": ("page_events", "created_at")}


def load_range(shop: Shop, view: str, start: str | None = None, end: str | None = None,
               channels: Iterable[str] | None = None) -> DataFrame:
    """A fact view for an inclusive date range and channel list.

    The range is put on the source's own time column, so it reaches the Parquet
    scan; a filter on the view's date would stop at its cast.
    """
    table, column = RANGE_SOURCE[view]

    def source(name: str) -> DataFrame:
        df = getattr(shop, name)
        if name != table:
            return df
        kind = df.schema[column].dataType
        if start:
            df = df.where(F.col(column) >= F.lit(start).cast(kind))
        if end:
            df = df.where(F.col(column) < F.date_add(F.lit(end).cast("date"), 1).cast(kind))
        return df.where(F.col("channel").isin(*channels)) if channels else df

    return getattr(Shop(source, shop.price_edges), view)


def in_range(df: DataFrame, date_column: str, start: str | None = None, end: str | None = None,
             channels: Iterable[str] | None = None) -> DataFrame:
    """Inclusive date range and channel list over any frame with a date column."""
    d = F.col(date_column)
    if start:
        df = df.where(d >= F.lit(start).cast("date"))
    if end:
        df = df.where(d <= F.lit(end).cast("date"))
    if channels:
        df = df.where(F.col("channel").isin(*channels))
    return df


def latest_summary(summary: DataFrame, days: int = 120) -> DataFrame:
    return summary.orderBy(F.desc("summary_date"), "channel").limit(days)


def consistency(a: DataFrame, b: DataFrame, name: str) -> DataFrame:
    """Row counts, shared columns and rows found on one side only (with multiplicity).

    Both sides are stacked and counted with opposite signs: one aggregate with
    map-side combine instead of two EXCEPT ALL passes.
    """
    shared = [c for c in a.columns if c in b.columns]
    both = (a.select(*shared, F.lit(1).alias("_a"), F.lit(0).alias("_b"))
            .unionByName(b.select(*shared, F.lit(0).alias("_a"), F.lit(1).alias("_b"))))
    rows = both.groupBy(*shared).agg(F.sum("_a").alias("na"), F.sum("_b").alias("nb"))
    return rows.agg(
        F.lit(name).alias("table_name"), F.sum("na").alias("rows_a"), F.sum("nb").alias("rows_b"),
        F.lit(len(shared)).alias("shared_columns"),
        F.sum(F.greatest(F.col("na") - F.col("nb"), F.lit(0))).alias("only_a"),
        F.sum(F.greatest(F.col("nb") - F.col("na"), F.lit(0))).alias("only_b"))
