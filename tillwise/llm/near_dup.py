"""Near duplicates by Order MinHash.

Five-word shingles labelled by occurrence are the k-mers. Each sketch takes the two smallest k-mers under one hash in their
text order, so that it is sensitive to edits and moves; ``ROWS`` sketches make a band, texts that share a band are
candidates, and a banded alignment of the k-mer sequences verifies them: matched / (n + m - matched) >= 0.8.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import OrderedDict
from functools import reduce
from operator import add, and_

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tillwise.llm.common import map_rows, stored, words

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 20, 2   # at similarity 0.8 a sketch agrees with chance 0.64 or so; one of 20 bands of two with 0.99997
MARKS = 256           # bits of the bitmaps that bound the difference of two texts of one hub
SIZE_CLASS = 1.01     # ratio of the sizes that are summed up as one where texts of a hub are held against each other
CELLS = 1 << 20       # hashed k-mers held at once while a text is sketched
_rng = np.random.default_rng(20)
_MULTIPLY = _rng.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FLIP = _rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)
_STEP = _rng.integers(1, 1 << 63, SHINGLE + 3, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def kmers(text: str) -> np.ndarray:
    """Hashes of the shingles of a text in order, made distinct by their occurrence numbers; none for under five words."""
    w = words(text)
    n = len(w) - SHINGLE + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, w), np.uint64, len(w))
    x = np.zeros(n, np.uint64)
    for i in range(SHINGLE):
        x += h[i:i + n] * _STEP[i]
    x = _mixed(x)
    order = np.argsort(x, kind="stable")
    new = np.concatenate(([True], x[order][1:] != x[order][:-1]))
    if not new.all():
        first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        occurrence = np.empty(n, np.uint64)
        occurrence[order] = (np.arange(n) - first).astype(np.uint64)
        x = _mixed(x + occurrence * _STEP[SHINGLE])
    return x


def bands(x: np.ndarray) -> list[int]:
    """Band hashes of one text's k-mers; empty without k-mers."""
    n = len(x)
    if n == 0:
        return []
    sketches = np.empty(BANDS * ROWS, np.uint64)
    step = max(1, CELLS // n)
    for a in range(0, BANDS * ROWS, step):
        y = (x[None, :] ^ _FLIP[a:a + step, None]) * _MULTIPLY[a:a + step, None]
        rows = np.arange(len(y))
        one = y.argmin(axis=1)
        y[rows, one] = np.uint64(0xFFFFFFFFFFFFFFFF)
        two = y.argmin(axis=1) if n > 1 else one
        sketches[a:a + step] = _mixed(x[np.minimum(one, two)] * _STEP[SHINGLE + 1] + x[np.maximum(one, two)])
    s = sketches.reshape(BANDS, ROWS)
    out = np.arange(1, BANDS + 1, dtype=np.uint64) * _STEP[SHINGLE + 2]
    for r in range(ROWS):
        out = _mixed(out + s[:, r])
    return out.astype(np.int64).tolist()


def _matches(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the common k-mers in both texts."""
    _, at_a, at_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    return at_a, at_b


def similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY, found: tuple[np.ndarray, np.ndarray] | None = None) -> float:
    """Aligned k-mers over all k-mers of the two texts; 0 where it can't reach ``least``.

    K-mers are distinct within a text, so the best alignment is the longest increasing run of matched positions. At
    ``least`` or more the unmatched k-mers bound how far aligned positions can lie apart: others are outside the band.
    """
    n, m = len(a), len(b)
    needed = least * (n + m) / (1 + least)
    if min(n, m) < needed - 1e-9:
        return 0.0
    pa, pb = found or _matches(a, b)
    inside = np.abs(pa - pb) <= n + m - 2 * needed + 1
    pa, pb = pa[inside], pb[inside]
    if len(pa) < needed - 1e-9:
        return 0.0
    pb = pb[np.argsort(pa)]
    if (np.diff(pb) > 0).all():
        matched = len(pb)
    else:
        tails: list[int] = []
        for p in pb.tolist():
            at = bisect_left(tails, p)
            tails[at:at + 1] = [p]
        matched = len(tails)
    return matched / (n + m - matched)


def differences(hub: np.ndarray, x: np.ndarray, least: float, found: tuple[np.ndarray, np.ndarray]) -> dict:
    """What a text has that its hub lacks (D, ``d``), and the first k-mers of the hub that it lacks (M, ``lacks``).

    Texts x and y of one hub H with similarity s have s / (1 + s) (|x| + |y|) k-mers in common or more. In H they have |x| - |D of x|
    of them at most, so they share at least |D of x| - (1 - s)|x| of D, and |D of x| - (1 - s) / (1 + s) |x| if x is the shorter
    one. One of the first |D| - that + 1 in any common order is then shared: ``take`` of each text, ``probe`` of the shorter.
    If nothing of D is shared, |D| is at most (1 - s)|x|, and all they have in common is in H: of M they share all but
    (1 / s - 1)|x|, and all but (1 - s) / (1 + s) |x| - |D of x| if x has the larger |x| / (1 + s) - |D|. Of M so many, and one,
    are kept (``lacks``), of which the first ``lack_probe`` are for the case that x is that one.
    ``marks``: D and M as bitmaps of ``MARKS`` bits by hash, which bound from below what one text has and another has not.
    """
    at_hub, at_x = found
    own, lost = np.ones(len(x), bool), np.ones(len(hub), bool)
    own[at_x], lost[at_hub] = False, False
    d, m = np.sort(x[own].astype(np.int64)), np.sort(hub[lost].astype(np.int64))
    most = lambda share: math.floor(share + 1e-9) + 1
    nearer = (1 - least) / (1 + least) * len(x)
    inside = len(d) <= (1 - least) * len(x) + 1e-9
    return {"d": d.tolist(), "take": min(len(d), most((1 - least) * len(x))), "probe": min(len(d), most(nearer)),
            "lacks": m[:most((1 / least - 1) * len(x))].tolist() if inside else [], "lack_probe": max(0, most(nearer - len(d))),
            "marks": [w for part in (d, m) for w in _bitmap(part)]}


def _bitmap(x: np.ndarray) -> list[int]:
    bits = np.zeros(MARKS, np.uint8)
    bits[x.astype(np.uint64) % np.uint64(MARKS)] = 1
    return np.packbits(bits).view(np.int64).tolist()


def sketch(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``key`` (hash of the words, or of the raw text where there are none), ``n`` k-mers and ``bands``."""
    def run(c: list[list]) -> dict[str, list]:
        xs = [kmers(t or "") for t in c[1]]
        keys = [xxhash.xxh3_128_digest(" ".join(words(t or "")) or f"\n{t or ''}") for t in c[1]]
        return {"doc_id": c[0], "key": keys, "n": [len(x) for x in xs], "bands": [bands(x) for x in xs]}

    return map_rows(docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")), run, "doc_id long, key binary, n int, bands array<long>")


def texts_of(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The rows of ``texts`` that a pair names. The ids are written first, so that Spark knows their size: few are
    broadcast and no text is shuffled, many make it one shuffle."""
    ends = stored(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "pair-ends")
    return texts.join(ends, "doc_id", "left_semi")


def _with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    a = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b")


class _Recent:
    """K-mers of the hubs met last: they come again and again."""

    def __init__(self) -> None:
        self.kept: OrderedDict[int, np.ndarray] = OrderedDict()

    def of(self, doc: int, text: str | None) -> np.ndarray:
        if doc not in self.kept:
            self.kept[doc] = kmers(text or "")
            if len(self.kept) > 64:
                self.kept.popitem(last=False)
        return self.kept[doc]


def verify(pairs: DataFrame, texts: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The pairs (``a``, ``b``) whose alignment reaches ``least``. ``texts``: ``doc_id``, ``text``."""
    def run(c: list[list]) -> dict[str, list]:
        recent = _Recent()
        got = [(x, y) for x, y, s, t in zip(*c) if similarity(recent.of(x, s), kmers(t or ""), least) >= least]
        return {"a": [p[0] for p in got], "b": [p[1] for p in got]}

    return map_rows(_with_texts(pairs, texts_of(pairs, texts)), run, "a long, b long")


def compare_with_hubs(pairs: DataFrame, texts: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """For every pair (hub ``a``, text ``b``): whether they are ``linked``, the k-mers of ``b``, and how ``b`` differs."""
    def run(c: list[list]) -> dict[str, list]:
        recent, out = _Recent(), {k: [] for k in ("a", "b", "linked", "n", "d", "take", "probe", "lacks", "lack_probe", "marks")}
        for x, y, s, t in zip(*c):
            hub, own = recent.of(x, s), kmers(t or "")
            found = _matches(hub, own)
            row = {"a": x, "b": y, "linked": similarity(hub, own, least, found) >= least, "n": len(own), **differences(hub, own, least, found)}
            for k, v in row.items():
                out[k].append(v)
        return out

    return map_rows(_with_texts(pairs, texts), run, "a long, b long, linked boolean, n int, d array<long>, take int, "
                    "probe int, lacks array<long>, lack_probe int, marks array<long>")


def components(links: DataFrame) -> DataFrame:
    """``id``, ``root`` (least id) for every end of a link: alternating large-star and small-star rounds, each a minimum
    per node and a join, until only stars are left. Hubs are split by adaptive skew joins; no group is collected."""
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")
    while not _only_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = stored(large, "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("s")).select(
            F.col("s.v").alias("u"), F.col("s.m").alias("v")).where("u <> v").distinct()
        edges = stored(small, "small-star")
    return edges.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct())


def _only_stars(edges: DataFrame) -> bool:
    """Whether every ``u`` has one ``v`` and no ``v`` has another above it: the state that the rounds leave unchanged."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up + down > 1 and up > 0").count() == 0


def joined_by(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``id``, ``root`` of ``components`` after further ``links``: components of the links between roots, so that only
    what they join is worked on."""
    def of(end: str) -> DataFrame:
        return roots.select(F.col("id").alias(end), F.col("root").alias(f"root_{end}"))

    between = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))
    new = components(between).select(F.col("id").alias("root"), F.col("root").alias("renewed"))
    first_met = new.join(roots.select(F.col("id").alias("root")), "root", "left_anti").select(F.col("root").alias("id"), F.col("renewed").alias("root"))
    return roots.join(new, "root", "left").select("id", F.coalesce("renewed", "root").alias("root")).unionByName(first_met)


def classes(docs: DataFrame, least: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, class_id, class_size`` for every document: classes are the components of the graph that links equal texts
    and texts of similarity ``least`` or more among the candidates; ``class_id`` is the least id of the class.

    Texts of under five words are linked only to texts of equal words, texts without words (null counts as empty) to equal
    ones. Rows that repeat an id are one document, in the least class of theirs; rows without an id are left out.

    1. Equal texts are one text from here on. 2. In each band bucket every text is compared with one hub, that with most
    copies. 3. Texts of one hub that are still in different components can only be alike if they share a k-mer that the
    hub lacks, or lack common ones (``differences``). They are compared with one text of theirs that is not linked to the hub
    (``_pairs_with_leads``), and those whose size and differences fit no other go (``_with_partners``). Then texts that share
    such a k-mer form buckets of their own: again each is compared with one hub first, and only then what is still apart is
    compared pair by pair. A group of copies costs a few comparisons per text, however large it is, and no link that joins
    two components is lost.
    """
    own = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).where("doc_id is not null")
    sketches = stored(sketch(own), "sketches")
    reps = stored(sketches.groupBy("key").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "equal-texts")
    buckets = sketches.join(reps.select(F.col("rep").alias("doc_id"), F.col("copies")), "doc_id").where("n > 0").select(
        F.explode("bands").alias("band"), F.col("doc_id").alias("id"), "copies")
    hubs = buckets.groupBy("band").agg(F.count("*").alias("members"), F.min(F.struct(-F.col("copies"), "id")).alias("hub")).where("members > 1")
    stars = buckets.join(hubs.select("band", F.col("hub.id").alias("a")), "band").where("id <> a").select("a", F.col("id").alias("b")).distinct()
    stars = stored(stars, "stars")
    texts = stored(texts_of(stars, own), "texts-of-pairs")  # all later pairs are among these texts
    compared = stored(compare_with_hubs(stars, texts, least), "hub-pairs")
    roots = stored(components(compared.where("linked").select("a", "b")), "roots")
    met = compared.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    apart = stored(_rows_apart(compared, roots), "apart")
    if not apart.isEmpty():
        pairs = stored(_pairs_with_leads(apart, least).join(met, ["a", "b"], "left_anti"), "lead-pairs")
        roots = stored(joined_by(roots, verify(pairs, texts, least)), "lead-roots")
        apart = stored(_rows_apart(compared, roots), "apart-left")
        roots = _roots_of_apart(apart, met.unionByName(pairs), texts, roots, least)
    grouped = reps.join(roots, F.col("rep") == F.col("id"), "left").select("key", F.coalesce("root", "rep").alias("class_id"))
    per = sketches.select("doc_id", "key").join(grouped, "key").groupBy("doc_id").agg(F.min("class_id").alias("class_id"))
    sizes = per.groupBy("class_id").agg(F.count("*").alias("class_size"))
    return per.join(sizes, "class_id").select("doc_id", "class_id", "class_size")


def _rows_apart(compared: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows of ``compared`` whose hub has texts of more than one component among its own, with the component of ``b``."""
    rows = compared.join(roots.withColumnRenamed("id", "b"), "b", "left").withColumn("root", F.coalesce("root", "b"))
    mixed = rows.groupBy("a").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("a")
    return rows.join(mixed, "a")


def _pairs_with_leads(apart: DataFrame, least: float) -> DataFrame:
    """Pairs of each hub's lead and its texts of other components: the lead is, of those that are not linked to the hub, the one
    with the most room in it. Texts that share a long part beside tails of their own meet here, before all that they lack of
    the hub puts them into the same buckets."""
    rows = apart.select("a", F.col("b").alias("id"), "n", "root", "marks", F.lit(0).alias("only"), "linked", (F.col("n") / least - (1 + 1 / least) * F.size("d")).alias("room"))
    leads = rows.where("not linked").groupBy("a").agg(F.min(F.struct(-F.col("room"), "id", "n", "root", "marks", "only")).alias("lead")).select("a", "lead.*")
    apart_yet = (F.col("x.a") == F.col("y.a")) & (F.col("x.root") != F.col("y.root")) & _can_match(least)
    return rows.alias("x").join(leads.alias("y"), apart_yet).select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()


def _roots_of_apart(apart: DataFrame, met: DataFrame, texts: DataFrame, roots: DataFrame, least: float) -> DataFrame:
    """``roots`` after the links between texts of one hub that lie in different components.

    The k-mers that a hub lacks are ordered by how many of its texts have them. Those of one text come first, and they can't
    be shared; where they fill the prefix, the text has no partner. ``only`` counts them: two texts with similarity s match
    min(n - only) k-mers at most, and leave both counts unmatched, so the sum of the two is at most (1 / s - 1) of that.
    Texts under one k-mer form a bucket. Each is compared with the bucket's own hub; what is still apart meets pair by pair,
    one of the two by its short prefix (``probes``).
    """
    mine = apart.select("a", F.col("b").alias("id"), "n", "root", "take", "probe", "d", "marks")
    shared = mine.select("a", F.explode("d").alias("kmer")).groupBy("a", "kmer").agg(F.count("*").alias("texts")).where("texts > 1")
    per = mine.select("a", "id", F.explode("d").alias("kmer")).join(shared, ["a", "kmer"]).groupBy("a", "id").agg(
        F.sort_array(F.collect_list(F.struct("texts", "kmer"))).alias("order"))  # as many as the text has
    possible = F.col("only") <= (1 / least - 1) * (F.col("n") - F.col("only")) + 1e-9
    mine = mine.join(per, ["a", "id"]).withColumn("only", F.size("d") - F.size("order")).where(possible & (F.col("take") > F.col("only")))
    mine = stored(mine.select("a", "id", "n", "only", "root", "marks", "probe", F.slice("order", F.lit(1), F.col("take") - F.col("only")).alias("order")), "prefixes")
    # As ``take``, for the shortest text that can match instead of the shortest possible one.
    longest = F.greatest(F.floor((F.col("n") - least * F.col("partner_n")) / (1 + least) + 1e-9).cast("int") + 1 - F.col("only"), F.lit(0))
    own = _with_partners(mine, least).select("a", "id", "n", "only", "room", "root", "marks", F.col("n").cast("double").alias("turn"), "probe",
                                             F.posexplode(F.slice("order", F.lit(1), longest))).select(
        "a", F.col("col.kmer").alias("kmer"), F.lit(True).alias("own"), "id", "n", "only", "room", "root", "marks", "turn", (F.col("pos") < F.col("probe") - F.col("only")).alias("probes"))
    # Texts that share nothing the hub lacks leave all of that unmatched.
    lacking = _with_partners(apart.withColumnRenamed("b", "id").withColumn("only", F.size("d")).where(possible), least)
    # No text that probes has more room than the widest of its hub, so the others' lists need be no longer than for that.
    widest = lacking.where("lack_probe > 0").groupBy("a").agg(F.max(F.col("n") / (1 + least) - F.col("only")).alias("widest"))
    lacking = lacking.join(widest, "a").withColumn("lacks", F.slice("lacks", F.lit(1), F.greatest(
        "lack_probe", F.floor(F.col("widest") - least / (1 + least) * F.col("n") + 1e-9).cast("int") + 1, F.lit(0))))
    lacking = lacking.select("a", "id", "n", "only", "room", "root", "marks", (F.col("only") - F.col("n") / (1 + least)).alias("turn"), "lack_probe", F.posexplode("lacks")).select(
        "a", F.col("col").alias("kmer"), F.lit(False).alias("own"), "id", "n", "only", "room", "root", "marks", "turn", (F.col("pos") < F.col("lack_probe")).alias("probes"))
    bucket = ["a", "kmer", "own"]
    same = reduce(and_, [F.col(f"x.{c}") == F.col(f"y.{c}") for c in bucket]) & (F.col("x.root") != F.col("y.root")) & _can_match(least)
    extra = stored(_several_roots(own.unionByName(lacking), bucket, least), "extra-kmers")
    second = extra.groupBy(*bucket).agg(F.min(F.struct("only", "id", "n", "root", "marks")).alias("hub")).select(*bucket, "hub.*")
    pairs = extra.alias("x").join(second.alias("y"), same).select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()
    pairs = stored(pairs.join(met, ["a", "b"], "left_anti"), "second-pairs")
    roots = stored(joined_by(roots, verify(pairs, texts, least)), "second-roots")
    renewed = extra.drop("root").join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    renewed = stored(_several_roots(renewed, bucket, least), "extra-kmers-left")
    first = F.struct("x.turn", "x.id") < F.struct("y.turn", "y.id")
    left = renewed.where("probes").alias("x").join(renewed.alias("y"), same & first).select(
        F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct().join(
        pairs.unionByName(met), ["a", "b"], "left_anti")
    return joined_by(roots, verify(stored(left, "third-pairs"), texts, least))


def _with_partners(rows: DataFrame, least: float) -> DataFrame:
    """Rows (texts of hubs ``a``) for which a text of another component has a fitting size, with the least such size (``partner_n``)
    and the largest size that the text can match (``room``).

    Of similarity s, texts x and y have s / (1 + s) (|x| + |y|) k-mers in common, and none of the ``only`` of either: |y| is at most
    (1 + 1 / s)(|x| - only) - |x|, and |x| at most that of y. The texts of a hub are summed up by classes of sizes; the component
    with most of them is held against the others alone, the rest against all.
    """
    rows = rows.withColumn("room", (1 + 1 / least) * (F.col("n") - F.col("only")) - F.col("n") + 1e-9)
    sized = rows.select("a", "root", "n", "room", F.floor(F.log("n") / math.log(SIZE_CLASS)).alias("class"))
    beside = F.col("root") != F.col("main")
    main = sized.groupBy("a", "root").agg(F.count("*").alias("texts")).groupBy("a").agg(F.max(F.struct("texts", "root"))["root"].alias("main"))
    of = sized.groupBy("a", "root", "class").agg(F.min("n").alias("n"), F.max("room").alias("room")).join(main, "a").groupBy("a", "main", "class").agg(
        F.struct(F.min("n").alias("n"), F.max("room").alias("room")).alias("all"),
        F.struct(F.min(F.when(beside, F.col("n"))).alias("n"), F.max(F.when(beside, F.col("room"))).alias("room")).alias("others"))
    hubs = of.groupBy("a", "main").agg(F.collect_list("all").alias("all"), F.collect_list("others").alias("others"))  # one entry a class
    fitting = F.filter(F.when(F.col("root") == F.col("main"), F.col("others")).otherwise(F.col("all")),
                       lambda y: (y["n"] <= F.col("room")) & (F.col("n") <= y["room"]))
    found = rows.join(hubs, "a").withColumn("partner_n", F.array_min(F.transform(fitting, lambda y: y["n"])))
    return found.where("partner_n is not null").drop("main", "all", "others")


def _several_roots(rows: DataFrame, bucket: list[str], least: float) -> DataFrame:
    """Rows of the buckets in which more than one component is found, as far as sizes, unshared k-mers and turns let them match
    a text of another component, one of the two being one that probes. For the component with most rows of a bucket the others
    are taken alone; for the rest, the whole bucket stands for them. ``room`` is the largest size that a text can match, where
    rows name none by its own size."""
    asks = lambda c: F.when(F.col("probes"), F.col(c))
    rows = rows if "room" in rows.columns else rows.withColumn("room", F.col("n") / least + 1e-9)
    kinds = {"only": F.min, "short": F.min, "room": F.max, "ask_only": F.min, "ask_short": F.min, "ask_room": F.max, "ask_turn": F.min}
    columns = [F.col("only"), F.col("n"), F.col("room"), asks("only"), asks("n"), asks("room"), asks("turn")]
    per = rows.groupBy(*bucket, "root").agg(F.count("*").alias("rows"), *[f(c).alias(k) for (k, f), c in zip(kinds.items(), columns)])
    main = per.groupBy(*bucket).agg(F.count("*").alias("roots"), F.max(F.struct("rows", "root")).alias("main")).where("roots > 1").select(
        *bucket, F.col("main.root").alias("main"))
    met = per.join(main, bucket).groupBy(*bucket, "main").agg(
        F.struct(*[f(k).alias(k) for k, f in kinds.items()]).alias("all"),
        F.struct(*[f(F.when(F.col("root") != F.col("main"), F.col(k))).alias(k) for k, f in kinds.items()]).alias("others"))
    other = {k: F.when(F.col("x.root") == F.col("m.main"), F.col(f"m.others.{k}")).otherwise(F.col(f"m.all.{k}")) for k in kinds}
    n, only = F.col("x.n"), F.col("x.only")

    def fits(of: str) -> Column:
        return ((other[f"{of}short"] <= F.col("x.room")) & (n <= other[f"{of}room"])
                & (only + other[f"{of}only"] <= (1 / least - 1) * (n - only) + 1e-9))

    asked = fits("ask_") & (other["ask_turn"] <= F.col("x.turn"))
    return rows.alias("x").join(met.alias("m"), reduce(and_, [F.col(f"x.{c}") == F.col(f"m.{c}") for c in bucket])
                                & (asked | (F.col("x.probes") & fits("")))).select("x.*")


def _can_match(least: float) -> Column:
    """Whether sizes, unshared k-mers and bitmaps let two texts (x, y) of one hub reach the similarity."""
    half = MARKS // 64

    def beyond(x: str, y: str) -> Column:
        """A lower bound of the k-mers that ``x`` has and ``y`` has not: outside the hub, and in it."""
        both = [(f"{x}.marks", f"{y}.marks", i) for i in range(half)] + [(f"{y}.marks", f"{x}.marks", i) for i in range(half, 2 * half)]
        return reduce(add, [F.bit_count(F.col(p)[i].bitwiseAND(F.bitwise_not(F.col(q)[i]))) for p, q, i in both])

    sizes = F.least("x.n", "y.n") >= F.lit(least) * F.greatest("x.n", "y.n") - 1e-9
    most = F.least(F.col("x.n") - F.col("x.only"), F.col("y.n") - F.col("y.only"))
    u, v = beyond("x", "y"), beyond("y", "x")
    return (sizes & (F.col("x.only") + F.col("y.only") <= (1 / least - 1) * most + 1e-9)
            & (u + least * v <= (1 - least) * F.col("x.n") + 1e-9) & (v + least * u <= (1 - least) * F.col("y.n") + 1e-9))
