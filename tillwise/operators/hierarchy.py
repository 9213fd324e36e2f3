"""Ward clusters over all rows, merged from bounded summaries."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tillwise.functions.scale import stats

SUMMARIES = 2000  # summaries that reach the driver, whatever the number of rows
HALVINGS = 16


def _cell(values: str, low: list[float], side: list[float], halvings: int):
    return F.array(*[F.floor((F.col(values)[i] - F.lit(lo)) / F.lit(s) * 2 ** halvings) for i, (lo, s) in enumerate(zip(low, side))])


def summarise(points: DataFrame, values: str = "x", limit: int = SUMMARIES):
    """(expression of a row's group, rows (group, n, sums)) with at most ``limit`` groups.

    Groups are the different rows themselves where there are few enough, so small tables
    lose nothing; otherwise cells of the finest grid that stays within the limit (every
    halving is counted in one scan; one cell always fits).
    """
    d = points.agg(F.max(F.size(values))).first()[0] or 0
    x = F.col(values)
    if not d:
        return x, []
    ends = stats(points, **{f"lo{i}": F.min(x[i]) for i in range(d)}, **{f"hi{i}": F.max(x[i]) for i in range(d)})
    low = [ends[f"lo{i}"] for i in range(d)]
    side = [((ends[f"hi{i}"] - lo) or 1.0) * (1 + 1e-9) for i, lo in enumerate(low)]
    ways = [_cell(values, low, side, h) for h in range(HALVINGS + 1)] + [x]
    seen = stats(points, **{f"n{i}": F.approx_count_distinct(F.xxhash64(w)) for i, w in enumerate(ways)})
    for i in range(len(ways) - 1, -1, -1):
        if i and seen[f"n{i}"] > limit * 1.2:
            continue
        sums = F.array(*[F.sum(x[j]) for j in range(d)])
        groups = points.groupBy(ways[i].cast("array<double>").alias("g")).agg(F.count(F.lit(1)).alias("n"), sums.alias("sums"))
        rows = groups.limit(limit + 1).collect()  # bounded; one more than the limit tells that the grid is too fine
        if len(rows) <= limit:
            return ways[i].cast("array<double>"), sorted(rows, key=lambda r: r["g"])
    raise AssertionError("one cell always fits")


def merges(n: np.ndarray, centres: np.ndarray) -> list[tuple[int, int, float]]:
    """Ward merges of weighted centres as (a, b, height), lowest first, by chains of nearest neighbours.

    ``a`` and ``b`` are one summary of either side. The height of two single rows is their distance.
    """
    n, centres = n.astype(float).copy(), centres.copy()
    alive, chain, out = np.ones(len(n), bool), [], []
    while len(out) < len(n) - 1:
        if not chain:
            chain.append(int(np.argmax(alive)))
        while True:
            last = chain[-1]
            cost = ((centres - centres[last]) ** 2).sum(axis=1) * (n * n[last] / (n + n[last]))
            cost[~alive] = np.inf
            cost[last] = np.inf
            best = int(np.argmin(cost))
            if len(chain) > 1 and cost[chain[-2]] <= cost[best]:
                break
            chain.append(best)
        before = chain[-2]
        a, b = sorted((last, before))
        out.append((a, b, float(np.sqrt(2 * cost[before]))))
        del chain[-2:]
        centres[a] = (centres[a] * n[a] + centres[b] * n[b]) / (n[a] + n[b])
        n[a] += n[b]
        alive[b] = False
    return sorted(out, key=lambda m: m[2])


def cut(count: int, joined: list[tuple[int, int, float]], k: int) -> list[int]:
    """Group number per summary after all but the last ``k - 1`` merges."""
    up = list(range(count))

    def top(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for a, b, _ in joined[:max(count - k, 0)]:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    return [top(i) for i in range(count)]


def _summaries(points: DataFrame, values: str, limit: int):
    group, rows = summarise(points, values, limit)
    n = np.array([r["n"] for r in rows], float)
    sums = np.array([r["sums"] for r in rows], float).reshape(len(rows), -1) if rows else np.zeros((0, 1))
    return group, rows, n, sums / n[:, None]


def ward(points: DataFrame, k: int = 5, values: str = "x", limit: int = SUMMARIES) -> DataFrame:
    """All rows with their ``cluster`` of a Ward hierarchy cut at ``k`` (0 is the largest; ties: smallest summary first).

    Rows become at most ``limit`` summaries (count, sums) in one aggregate; merging them costs the
    same at any table size, and rows find their cluster again by a join with that bounded
    list. With up to ``limit`` different rows the result is the plain pairwise hierarchy.
    ``values`` must hold arrays of one length without NULLs. An empty table gives no rows.
    """
    group, rows, n, centres = _summaries(points, values, limit)
    tops = cut(len(rows), merges(n, centres), k)
    weight = {}
    for t, w in zip(tops, n):
        weight[t] = weight.get(t, 0) + w
    number = {t: i for i, t in enumerate(sorted(weight, key=lambda t: (-weight[t], t)))}
    spark = points.sparkSession
    found = spark.createDataFrame([(r["g"], number[t]) for r, t in zip(rows, tops)], "_g array<double>, cluster int")
    return points.withColumn("_g", group).join(F.broadcast(found), "_g").drop("_g")


def ward_heights(points: DataFrame, values: str = "x", limit: int = SUMMARIES) -> DataFrame:
    """Merges from the lowest to the highest: (step, height, clusters left)."""
    _, rows, n, centres = _summaries(points, values, limit)
    out = [(i + 1, round(h, 6), len(rows) - i - 1) for i, (_, _, h) in enumerate(merges(n, centres))]
    return points.sparkSession.createDataFrame(out, "step int, height double, clusters int")
