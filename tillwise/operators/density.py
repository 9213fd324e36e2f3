"""Density clusters (core rows, border rows, noise) over all rows, decided by boxes before rows.

Equal rows are one spot with a count. Spots lie in a grid whose cells are narrower than
``eps`` across, and each cell is cut into finer boxes that know their own extent. A pair
of boxes is decided as a whole when its farthest corners are within ``eps`` or its nearest
ones are not; only undecided pairs go on to the next level, the last of which are spots.

Pairs are many more than the rows they come from, which size estimates do not see, so
every join here is sorted (``_join``): an estimate would broadcast them by the driver.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tillwise.functions.scale import durable

FINER = (2, 6)  # boxes a cell side, level by level below the cells; spots follow


def density(points: DataFrame, key: str, values: str = "x", eps: float = 1.0, min_points: int = 50) -> DataFrame:
    """DBSCAN of all rows: (key, cluster), cluster -1 for noise.

    A row is core if at least ``min_points`` rows, itself included, lie within ``eps``
    of it (Euclidean, border included). Core rows within ``eps`` of each other share a
    cluster; another row within ``eps`` of a core row joins the cluster with the lowest
    number among those in reach. Clusters are numbered by their smallest cell. Rows with a
    NULL, a NaN, an infinite value or fewer values than the longest row are noise.

    Pairs of cells come first: a cell with ``min_points`` rows in cells wholly within ``eps``
    holds core rows only, one with fewer rows in all cells in reach holds none, and rows are
    only compared for the others. Two cells that other links join already are not compared.
    """
    rows = points.select(key, F.transform(values, lambda v: v.cast("double")).alias("x"))
    d = rows.agg(F.max(F.size("x"))).first()[0] or 0
    if d < 1:
        return rows.select(key, F.lit(-1).alias("cluster"))
    finite = F.coalesce((F.size("x") == d) & F.forall("x", lambda v: F.abs(v) < F.lit(float("inf"))), F.lit(False))
    side = eps / d ** 0.5 * 0.999  # the spare part keeps rounded distances inside a cell below eps
    found = durable(rows.where(finite).groupBy("x").agg(F.count(F.lit(1)).alias("n")))
    # numbers in the order of the boxes
    cells = durable(found.groupBy(_box("x", side, 1).alias("box")).agg(*_extent(d)).orderBy("box")
                    .withColumn("cell", F.monotonically_increasing_id()))
    spots = durable(_join(found.withColumn("box", _box("x", side, 1)), cells.select("box", "cell"), "box")
                    .select(F.monotonically_increasing_id().alias("spot"), "x", "n", "cell"))
    near = durable(_near(cells, d, eps, side))

    close = F.col("most") <= eps * eps
    known = near.groupBy("a").agg(F.sum(F.when(close, F.col("n")).otherwise(0)).alias("sure"), F.sum("n").alias("all"))
    known = durable(known.withColumnRenamed("a", "cell"))
    full = known.where(F.col("sure") >= min_points).select("cell")
    hopeful = known.where((F.col("sure") < min_points) & (F.col("all") >= min_points)).select("cell", "sure")
    asked = durable(_join(spots.select(F.col("spot").alias("q"), "x", "cell"), hopeful, "cell"))
    open_ = _join(asked, near.where(~close).select(F.col("a").alias("cell"), "b", "n"), "cell").select("q", "x", "b", "n")
    crowded = _reached(open_, asked.select("q", F.col("sure").alias("n")), spots, side, eps, d, min_points)
    core = durable(_join(spots, full, "cell", "left_semi").unionByName(
        _join(spots, crowded.withColumnRenamed("q", "spot"), "spot", "left_semi")))

    homes = durable(core.select("cell").distinct())
    both = _join(_join(near, homes.withColumnRenamed("cell", "a"), "a", "left_semi"), homes.withColumnRenamed("cell", "b"), "b", "left_semi")
    labels = _joined(homes, both.where("a < b").select("a", "b"), core, side, eps, d)

    # a row that is not core asks the cells with core rows near its own
    edge = _join(_join(spots, core.select("spot"), "spot", "left_anti").withColumnRenamed("cell", "a"), near.select("a", "b"), "a")
    edge = _join(edge.select(F.col("spot"), "x", "b"), homes.withColumnRenamed("cell", "b"), "b", "left_semi")
    edge = edge.select(F.struct("spot", "b").alias("q"), "x", "b")
    inner = core.groupBy("cell").agg(*_extent(d)).withColumnRenamed("cell", "b")
    least, most = _squares(("x", "x"), ("lo", "hi"), d)
    edge = durable(_join(edge, inner, "b").select("q", "x", "b", "n", least.alias("least"), most.alias("most")).where(F.col("least") <= eps * eps))
    border = _reached(edge.where(~close).select("q", "x", "b", "n"), edge.where(close).select("q", "n"), core, side, eps, d, 1)
    border = (_join(border.select(F.col("q.spot").alias("spot"), F.col("q.b").alias("cell")), labels, "cell")
              .groupBy("spot").agg(F.min("label").alias("label")))
    placed = _join(core, labels, "cell").select("spot", "label").unionByName(border)
    numbers = labels.select("label").distinct().withColumn("cluster", F.row_number().over(W.orderBy("label")) - 1)  # one row per cluster
    placed = _join(_join(placed, numbers, "label"), spots.select("spot", "x"), "spot").select("x", "cluster")
    return _join(rows, placed, "x", "left").select(key, F.coalesce("cluster", F.lit(-1)).alias("cluster"))


def _join(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    return left.join(right.hint("merge"), on, how)


def _box(x: str, side: float, finer: int) -> Column:
    return F.transform(x, lambda v: F.floor(v / F.lit(side) * finer).cast("double"))


def _extent(d: int) -> list[Column]:
    lo, hi = [F.array(*[f(F.col("x")[i]) for i in range(d)]) for f in (F.min, F.max)]
    return [lo.alias("lo"), hi.alias("hi"), F.sum("n").alias("n")]


def _levels(spots: DataFrame, side: float, d: int):
    """Level by level below the cells (up, id, lo, hi, n): the box above, the box, its extent, its rows; spots last."""
    held = spots.select("spot", "x", "n", F.col("cell").alias("up"))
    for finer in FINER:
        inner = held.withColumn("box", _box("x", side, finer))
        level = durable(inner.groupBy("up", "box").agg(*_extent(d)).withColumn("id", F.monotonically_increasing_id()))
        yield level.select("up", "id", "lo", "hi", "n")
        held = durable(_join(inner, level.select("up", "box", "id"), ["up", "box"]).select("spot", "x", "n", F.col("id").alias("up")))
    yield held.select("up", F.col("spot").alias("id"), F.col("x").alias("lo"), F.col("x").alias("hi"), "n")


def _near(cells: DataFrame, d: int, eps: float, side: float) -> DataFrame:
    """Pairs of cells that may hold rows within eps, each cell with itself too: (a, b, rows of b, least and most squared distance).

    One dimension at a time: pairs of prefixes of boxes, each numbered by its smallest cell, so that prefixes that many
    cells have are paired once. The next step meets by strips as wide as the reach; gaps out of reach end there.
    """
    reach = (eps / side) ** 2
    widest = int(reach ** 0.5) + 1
    front = cells.agg(F.min("cell").alias("a")).where("a is not null").select("a", F.col("a").alias("b"), F.lit(0.0).alias("gap"))
    for i in range(d):
        # a prefix and the one before it; both are the same number where it is the first below
        kids = cells.groupBy(F.slice("box", 1, i + 1).alias("key")).agg(F.min("cell").alias("id"))
        above = cells.groupBy(F.slice("box", 1, i).alias("up_key")).agg(F.min("cell").alias("up"))
        kids = _join(kids.select("id", F.slice("key", 1, i).alias("up_key"), F.col("key")[i].alias("at")), above, "up_key").select(
            "up", "id", "at", F.floor(F.col("at") / widest).alias("strip"))
        mine = kids.select(F.col("up").alias("a"), F.col("id").alias("a_id"), F.col("at").alias("a_at"),
                           F.explode(F.array(F.col("strip") - 1, F.col("strip"), F.col("strip") + 1)).alias("strip"))
        theirs = kids.select(F.col("up").alias("b"), F.col("id").alias("b_id"), F.col("at").alias("b_at"), "strip")
        apart = F.greatest(F.abs(F.col("a_at") - F.col("b_at")) - 1, F.lit(0.0))
        front = (_join(_join(front, mine, "a"), theirs, ["b", "strip"]).withColumn("gap", F.col("gap") + apart * apart)
                 .where(F.col("gap") <= reach).select(F.col("a_id").alias("a"), F.col("b_id").alias("b"), "gap"))
    mine = cells.select(F.col("cell").alias("a"), F.col("lo").alias("a_lo"), F.col("hi").alias("a_hi"))
    theirs = cells.select(F.col("cell").alias("b"), "lo", "hi", "n")
    met = _join(_join(front.select("a", "b"), theirs, "b"), mine, "a")
    least, most = _squares(("a_lo", "a_hi"), ("lo", "hi"), d)
    return met.select("a", "b", "n", least.alias("least"), most.alias("most")).where(F.col("least") <= eps * eps)


def _squares(a: tuple[str, str], b: tuple[str, str], d: int) -> tuple[Column, Column]:
    """Smallest and largest squared distance of two boxes, each given by its low and high column."""
    nearest, farthest = [], []
    for i in range(d):
        ahead, behind = F.col(b[0])[i] - F.col(a[1])[i], F.col(a[0])[i] - F.col(b[1])[i]
        short = F.greatest(ahead, behind, F.lit(0.0))
        long = F.greatest(F.abs(F.col(b[1])[i] - F.col(a[0])[i]), F.abs(F.col(a[1])[i] - F.col(b[0])[i]))
        nearest.append(short * short)
        farthest.append(long * long)
    return reduce(add, nearest), reduce(add, farthest)


def _reached(pairs: DataFrame, sure: DataFrame, spots: DataFrame, side: float, eps: float, d: int, enough: int) -> DataFrame:
    """The q that have at least ``enough`` rows within eps: ``sure`` (q, n) and those of the undecided cells b of ``pairs`` (q, x, b, n)."""
    nearest, farthest = _squares(("x", "x"), ("lo", "hi"), d)
    seen, open_ = durable(sure.groupBy("q").agg(F.sum("n").alias("n"))), durable(pairs)
    levels = _levels(spots, side, d)
    while True:
        # a q with enough is done, and one that all its undecided boxes cannot bring there is given up
        hope = open_.groupBy("q").agg(F.sum("n").alias("more"))
        hope = _join(hope, seen, "q", "left").select("q", F.coalesce("n", F.lit(0)).alias("n"), "more")
        hope = hope.where((F.col("n") < enough) & (F.col("n") + F.col("more") >= enough)).select("q")
        open_ = durable(_join(open_, hope, "q", "left_semi"))
        level = None if open_.isEmpty() else next(levels, None)
        if level is None:
            return seen.where(F.col("n") >= enough).select("q")
        met = durable(_join(open_.select("q", "x", F.col("b").alias("up")), level, "up").select(
            "q", "x", F.col("id").alias("b"), "n", nearest.alias("least"), farthest.alias("most")).where(F.col("least") <= eps * eps))
        inside = met.where(F.col("most") <= eps * eps).select("q", "n")
        seen = durable(seen.unionByName(inside).groupBy("q").agg(F.sum("n").alias("n")))
        open_ = met.where(F.col("most") > eps * eps).select("q", "x", "b", "n")


def _joined(homes: DataFrame, pairs: DataFrame, core: DataFrame, side: float, eps: float, d: int) -> DataFrame:
    """(cell, label) of cells with core rows; label is the smallest cell of the cluster."""
    labels = durable(homes.withColumn("label", F.col("cell")))
    nearest, farthest = _squares(("a_lo", "a_hi"), ("b_lo", "b_hi"), d)
    open_ = pairs.select("a", "b", F.col("a").alias("a_up"), F.col("b").alias("b_up"))
    level, levels = core.groupBy("cell").agg(*_extent(d)).select(F.col("cell").alias("up"), F.col("cell").alias("id"), "lo", "hi"), _levels(core, side, d)
    while level is not None:
        mine, theirs = [level.select(F.col("up").alias(f"{s}_up"), F.col("id").alias(f"{s}_id"), F.col("lo").alias(f"{s}_lo"),
                                     F.col("hi").alias(f"{s}_hi")) for s in "ab"]
        met = durable(_join(_join(open_, mine, "a_up"), theirs, "b_up").select("a", "b", F.col("a_id").alias("a_up"), F.col("b_id").alias("b_up"),
                      nearest.alias("least"), farthest.alias("most")).where(F.col("least") <= eps * eps))
        labels = _spread(labels, met.where(F.col("most") <= eps * eps).select("a", "b").distinct())
        of = [labels.select(F.col("cell").alias(s), F.col("label").alias(f"{s}_label")) for s in "ab"]
        open_ = durable(_join(_join(met.where(F.col("most") > eps * eps), of[0], "a"), of[1], "b").where("a_label != b_label")
                        .select("a", "b", "a_up", "b_up"))
        level = None if open_.isEmpty() else next(levels, None)
    return labels


def _spread(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Smallest label over linked cells; each round also takes the label of the label, so rounds grow with the logarithm."""
    # links are between labels, so that cells of one cluster move together
    a, b = [labels.select(F.col("cell").alias(s), F.col("label").alias(f"{s}_label")) for s in "ab"]
    tied = _join(_join(links, a, "a"), b, "b").select(F.col("a_label").alias("a"), F.col("b_label").alias("b")).where("a != b").distinct()
    tied = durable(tied.unionByName(tied.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    if tied.isEmpty():
        return labels
    roots = durable(tied.select(F.col("a").alias("cell")).distinct().withColumn("root", F.col("cell")))
    while True:
        low = (_join(tied, roots.withColumnRenamed("cell", "b"), "b").select(F.col("a").alias("cell"), "root").unionByName(roots)
               .groupBy("cell").agg(F.min("root").alias("root")))
        jump = low.select(F.col("cell").alias("root"), F.col("root").alias("next"))
        new = durable(_join(low, jump, "root").select("cell", F.col("next").alias("root")))
        if _join(new, roots.withColumnRenamed("root", "old"), "cell").where(F.col("root") != F.col("old")).isEmpty():
            break
        roots = new
    renamed = roots.select(F.col("cell").alias("label"), "root")
    return durable(_join(labels, renamed, "label", "left").select("cell", F.coalesce("root", "label").alias("label")))
