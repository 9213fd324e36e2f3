"""What the operators share: stored intermediate tables, Arrow batches in tasks, span digests, words."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

WORD = re.compile(r"\w+")
ROWS_PER_BATCH = 500       # rows of an Arrow batch that become Python objects at once,
BYTES_PER_BATCH = 4 << 20  # and their bytes, but for a single longer row


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a session that leaves it unset (tests) gets one of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="tillwise-llm-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/llm-{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage ends there, and a lost executor costs
    no more than the tasks it was running."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def joined(left: DataFrame, right: DataFrame, on: Column | str | list[str], how: str = "inner") -> DataFrame:
    """A join by sorting, whatever the estimated sizes: they are those of compressed files and do not see the rows that an
    explode or a map over batches adds, so that such a side would be broadcast through the driver's memory."""
    return left.join(right.hint("merge"), on, how)


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS_PER_BATCH, size: int = BYTES_PER_BATCH) -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches (64 MB at most by Spark's own setting) in parts that bound what a worker holds as Python objects."""
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            n = min(rows, batch.num_rows - at)
            while n > 1 and batch.slice(at, n).nbytes > size:
                n //= 2
            yield batch.slice(at, n)
            at += n


def map_rows(df: DataFrame, fn: Callable[[list[list]], dict[str, list]], schema: str) -> DataFrame:
    """``fn`` gets the columns of one Arrow batch as Python lists and returns the output columns."""
    out = pa.schema(_arrow_fields(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            got = fn([c.to_pylist() for c in batch.columns])
            yield pa.RecordBatch.from_arrays([pa.array(got[f.name], type=f.type) for f in out], schema=out)

    return df.mapInArrow(run, schema)


def _arrow_fields(schema: str) -> list[pa.Field]:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return list(to_arrow_schema(_parse_datatype_string(schema)))


def words(text: str) -> list[str]:
    """Words of a text: runs of letters, digits and underscores, in lower case."""
    return WORD.findall(text.lower())


SPANS = "array<struct<kind:string,start:int,end:int,base:boolean,score:double>>"


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined in the order of the array."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def span_digest(found: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Counts per base kind (``kinds``: column name to kind), hash of the base spans, and all spans as text."""
    def count(name: str, kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(name)

    base = F.filter("spans", lambda s: s["base"])
    counts = [count(name, kind) for name, kind in kinds.items()]
    return found.select("doc_id", *counts, F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"),
                        F.transform("spans", lambda s: F.round(s["score"], 3)).alias("scores"))
