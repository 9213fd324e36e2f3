"""Registered queries and their SQL twins, one module per business area."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks import ctes
from tillwise.plans.star import Shop
from tillwise.sources.tpch_shop import open_shop

RUN: dict[str, Callable[[Shop, SparkSession], DataFrame]] = {}
SQL: dict[str, str] = {}
AREAS = ("tables", "star", "quality", "cleaning", "features", "sales", "funnel", "segments", "propensity",
         "clusters", "baskets", "forecast", "marketing", "fulfilment", "inventory", "scorecard", "helpers",
         "planned")


def check(name: str, sql: str | None = None):
    """Register ``fn(shop, spark)`` under ``name``; ``sql`` may use any CTE of ``ctes``."""
    def wrap(fn):
        assert name not in RUN, name
        RUN[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return wrap


def load() -> None:
    for area in AREAS:
        importlib.import_module(f"checks.{area}")


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    load()
    return {n: (lambda spark, folder, fn=fn: fn(open_shop(spark, folder), spark)) for n, fn in RUN.items()}


def sql_queries() -> dict[str, str]:
    load()
    return {n: ctes.expand(q) for n, q in SQL.items()}  # after every area has added its CTEs
