"""Writing: table export, wide tables, and the operator action log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

ACTION_SCHEMA = ("log_id string, admin_name string, action_type string, entity_type string, entity_id string, "
                 "detail string, created_at timestamp")


def export_table(df: DataFrame, path: str, fmt: str = "csv", limit: int | None = None) -> str:
    """CSV (quotes doubled, as RFC 4180) or JSON lines; ``limit`` is the caller's row cap."""
    out = df if limit is None else df.limit(limit)
    writer = out.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    elif fmt == "json":
        writer.json(path)
    else:
        raise ValueError(f"format {fmt} is neither csv nor json")
    return path


def write_wide(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    else:
        writer.parquet(path)
    return path


def append_actions(actions: DataFrame, path: str) -> None:
    """Append rows (action_type, entity_type, entity_id, detail) with an id and the current time."""
    have = set(actions.columns)
    (actions.select(F.expr("uuid()").alias("log_id"),
                    (F.col("admin_name") if "admin_name" in have else F.lit("system")).alias("admin_name"),
                    F.col("action_type").cast("string"),
                    (F.col("entity_type") if "entity_type" in have else F.lit("target")).alias("entity_type"),
                    F.col("entity_id").cast("string"), F.col("detail").cast("string"),
                    F.current_timestamp().alias("created_at"))
     .write.mode("append").parquet(path))


def create_action(spark: SparkSession, path: str, action_type: str, target_id: str, detail: str,
                  priority: str | None = "P1") -> None:
    """Log one action; a priority is put in front of the text."""
    text = f"[{priority}] {detail}" if priority else detail
    append_actions(spark.createDataFrame([(action_type, target_id, text)],
                                         "action_type string, entity_id string, detail string"), path)


def tag_users(users: DataFrame, tag: str, path: str) -> None:
    """Log a tag for every user of a frame, however many."""
    append_actions(users.select(F.lit("tag_user").alias("action_type"), F.lit("user").alias("entity_type"),
                                F.col("user_id").cast("string").alias("entity_id"), F.lit(tag).alias("detail")), path)


def latest_actions(log: DataFrame, action_type: str | None = None, newest: int = 50, filter_first: bool = True) -> DataFrame:
    """The newest actions of a type. ``filter_first=False`` takes the newest of all types and filters them."""
    typed = lambda df: df.where(F.col("action_type") == action_type) if action_type else df
    order = (F.desc("created_at"), F.desc("log_id"))
    return typed(log).orderBy(*order).limit(newest) if filter_first else typed(log.orderBy(*order).limit(newest))
