"""Benchmark decontamination by templates: numbers, names and units become typed placeholders, windows of template words
are joined by hash, and the values behind the placeholders have to fit together.

A document is contaminated by an item if it holds at least ``MIN_WINDOWS`` successive-word windows of it (13 words in a
row with the defaults, or spread over the item), or all windows of a shorter item. A window counts if its words are the
item's, letter case aside, or if its template is the item's and none of its values stands for two document values on that
alignment. Numbers may do so where the whole item is there. Re-parameterised questions are caught, sentences of like shape
are not.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tillwise.llm.common import slices, stored

WIDTH = 8               # template words in a window
MIN_WIDTH = 5           # items of fewer words have no template; of fewer than WIDTH they are one window
MIN_LITERAL = 3         # items of MIN_LITERAL words with a number, and of more words, are compared literally; shorter ones with whole documents
MIN_WINDOWS = 6
FILTER_WINDOWS = 2_000_000  # benchmarks of up to this many windows (16 MB) are sent to the tasks as a first filter
KNOWN_WORDS = 300_000   # word hashes a Python worker remembers

# Unit words that count as units after a number.
UNITS = frozenset("mm cm m km in inch inches ft foot feet yd yards mile miles mg g kg t oz lb lbs pound pounds ton tons ml cl l liter liters "
                  "litre litres s sec second seconds min minute minutes h hour hours day days week weeks month months year years ms hz khz mhz "
                  "ghz w kw mw v kv a ma k c f pa kpa bar n j kj cal kcal b kb mb gb tb dollar dollars euro euros cent cents percent mph kmh".split())
NUMBER, UNIT, NAME = "<number>", "<unit>", "<name>"
_TOKEN = re.compile(r"\d+(?:[.,]\d+)*|[^\W\d_]+|[.!?:\n]")
_FACTORS = np.asarray([pow(0x9E3779B97F4A7C15, i + 1, 1 << 64) | 1 for i in range(64)], np.uint64)
_known: dict[str, int] = {}


def template(text: str | None) -> tuple[list[str], list[str | None]]:
    """Template words, and for each the value behind a placeholder (None for plain words).

    A capitalised word inside a sentence is a name; words all in capitals and those that open a sentence are plain.
    """
    keys, values, opening = [], [], True
    for t in _TOKEN.findall(text or ""):
        c = t[0]
        if c in ".!?:\n":
            opening = True
            continue
        if c.isdigit():
            key, value = NUMBER, t
        elif keys and keys[-1] is NUMBER and t.lower() in UNITS:
            key, value = UNIT, t.lower()
        elif not opening and c.isupper() and len(t) > 1 and not t.isupper():
            key, value = NAME, t
        else:
            key, value = t.lower(), None
        keys.append(key)
        values.append(value)
        opening = False
    return keys, values


def _hashes(keys: list[str]) -> np.ndarray:
    out = []
    for k in keys:
        h = _known.get(k)
        if h is None:
            h = xxhash.xxh64_intdigest(k)
            if len(_known) < KNOWN_WORDS:
                _known[k] = h
        out.append(h)
    return np.asarray(out, np.uint64)


def _sums(h: np.ndarray, width: int) -> np.ndarray:
    n = len(h) - width + 1
    total = np.full(n, width, np.uint64)
    for i in range(width):
        total += h[i:i + n] * _FACTORS[i]
    return total


def window_keys(keys: list[str], values: list[str | None], width: int, leads: bool) -> list[tuple[np.ndarray, np.ndarray, bool]]:
    """Starts and hashes of windows by template, then by their lower-cased words.

    By template: the windows of which at least half of the words are plain (``leads``: a name in front counts as plain).
    By words: the windows with a placeholder, the others have the same key in both forms.
    """
    n = len(keys) - width + 1
    if n < 1:
        return []
    h = _hashes(keys)
    slot = np.asarray([v is not None for v in values])
    filled = np.concatenate(([0], np.cumsum(slot)))
    filled = filled[width:] - filled[:-width]
    lead = np.asarray([k is NAME for k in keys[:n]]) if leads else 0
    starts = np.flatnonzero(2 * (width - filled + lead) >= width)
    out = [(starts, _sums(h, width)[starts], False)]
    if slot.any():
        h[slot] = _hashes([v.lower() for v in values if v is not None])
        starts = np.flatnonzero(filled)
        out.append((starts, _sums(h, width)[starts], True))
    return out


def _entire(keys: list[str], values: list[str | None]) -> tuple[str, int]:
    """All words of a text that has few, marked as all, and their hash."""
    words = "all: " + " ".join(k if v is None else v.lower() for k, v in zip(keys, values))
    return words, xxhash.xxh64_intdigest(words) - (1 << 63)


WINDOWS = "id long, hash long, width int, pos int, template string, slots array<string>, leads boolean, templated boolean, n_templates int, n_windows int"


def _item_windows(keys: list[str], values: list[str | None], largest: int) -> Iterator[tuple]:
    """Keys of an item: the template of a window and its words; the first word, plain as it opens the item, also as a name."""
    n = len(keys)
    if n < MIN_LITERAL or n == MIN_LITERAL and NUMBER not in keys:
        if n:
            words, h = _entire(keys, values)
            yield h, n, 0, words, [], False, False, 0, 1
        return
    width = min(n, largest)
    found = window_keys(keys, values, width, leads=False)
    templates = found[0][0] if n >= MIN_WIDTH else found[0][0][:0]
    templated = set(templates.tolist())
    for starts, hashes, literal in found:
        for s, h in zip(starts.tolist(), hashes.astype(np.int64).tolist()):
            own, held = keys[s:s + width], [v for v in values[s:s + width] if v is not None]
            if literal or not held:
                words = [k if v is None else v.lower() for k, v in zip(own, values[s:s + width])]
                yield h, width, s, " ".join(words), held, False, s in templated, len(templated), n - width + 1
            elif s in templated:
                yield h, width, s, " ".join(own), held, False, True, len(templated), n - width + 1
    if 0 in templated and values[0] is None and len(keys[0]) > 1:
        led = [NAME, *keys[1:width]]
        h = int(_sums(_hashes(led), width).astype(np.int64)[0])
        yield h, width, 0, " ".join(led), [v for v in (keys[0], *values[1:width]) if v is not None], True, True, len(templated), n - width + 1


def windows(texts: DataFrame, widths: list[int], whole: bool, among: np.ndarray | None = None) -> DataFrame:
    """Windows of rows with ``id`` and ``text``. ``whole``: an item of fewer words than the largest width gives one window of
    its own length. ``among``: sorted hashes to which the result is limited. ``slots`` is null for a document's window by words."""
    largest = max(widths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coarse = None
        if among is not None:
            coarse = np.zeros(1 << 22, bool)
            coarse[among & np.uint64((1 << 22) - 1)] = True
        for batch in slices(batches):
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                keys, values = template(text)
                if whole:
                    rows += [(doc, *r) for r in _item_windows(keys, values, largest)]
                    continue
                if 0 < len(keys) <= MIN_LITERAL:
                    words, h = _entire(keys, values)
                    rows.append((doc, h, len(keys), 0, words, None, None, None, None, None))
                for width in widths:
                    for starts, hashes, literal in window_keys(keys, values, width, leads=True):
                        if among is not None:
                            maybe = coarse[hashes & np.uint64((1 << 22) - 1)]
                            starts, hashes = starts[maybe], hashes[maybe]
                            at = np.minimum(np.searchsorted(among, hashes), len(among) - 1)
                            starts, hashes = starts[among[at] == hashes], hashes[among[at] == hashes]
                        for s, h in zip(starts.tolist(), hashes.astype(np.int64).tolist()):
                            own = values[s:s + width]
                            text_key = " ".join(k if v is None or not literal else v.lower() for k, v in zip(keys[s:s + width], own))
                            rows.append((doc, h, width, s, text_key, None if literal else [v for v in own if v is not None], None, None, None, None))
            columns = list(zip(*rows)) or [()] * 10
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.list_(pa.string()), pa.bool_(), pa.bool_(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds)],
                                             names=["id", "hash", "width", "pos", "template", "slots", "leads", "templated", "n_templates", "n_windows"])

    return texts.mapInArrow(run, WINDOWS)


def find_leaks(docs: DataFrame, benchmark: DataFrame, min_windows: int = MIN_WINDOWS, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row for each contaminated document and item: ``doc_id, item_id, matched, item_windows, coverage, slots, changed, kind``.

    ``matched``: distinct windows of the item found; ``slots``: placeholder values compared, ``changed`` those that differ;
    ``kind``: reparameterised where any value differs, be it one of two equal numbers of the item, else exact. Items of few
    words (``MIN_LITERAL``) match documents of the same words and no others. Null and empty texts match nothing; a null id is kept as null; repeated rows count as
    one document; an empty benchmark gives no rows.
    """
    spark = docs.sparkSession
    items = stored(windows(benchmark.select(benchmark[item_col].alias("id"), benchmark[item_text_col].alias("text")), [width], whole=True), "item-windows")
    bounds = items.agg(F.count("*").alias("n"), F.collect_set("width").alias("widths")).first()  # at most WIDTH widths
    widths = sorted(bounds["widths"]) or [width]
    among = None
    if bounds["n"] <= FILTER_WINDOWS:  # larger benchmarks go without the first filter; the join below decides in either case
        among = np.sort(np.asarray([r["hash"] for r in items.select("hash").distinct().collect()], np.int64).astype(np.uint64))
        among = among if len(among) else np.zeros(1, np.uint64)
    found = windows(docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")), widths, whole=False, among=among)
    d, b = found.alias("d"), items.alias("b")
    # A window by words has no values of its own, and meets the item's only where they are equal.
    mine = F.when(F.coalesce(F.size("d.slots"), F.lit(0)) > 0, F.col("d.slots")).otherwise(F.col("b.slots"))
    rest = lambda c: F.when(F.col("b.leads"), F.slice(c, 2, F.size(c))).otherwise(c)
    pairs = d.join(b, (F.col("d.hash") == F.col("b.hash")) & (F.col("d.width") == F.col("b.width")) & (F.col("d.template") == F.col("b.template"))).where(
        ~F.col("b.leads") | (F.lower(F.get("d.slots", F.lit(0))) == F.get("b.slots", F.lit(0)))).select(
        F.col("d.id").alias("doc_id"), F.col("b.id").alias("item_id"), (F.col("d.pos") - F.col("b.pos")).alias("shift"), F.col("b.pos").alias("pos"),
        F.col("b.templated").alias("templated"), F.col("b.n_templates").alias("n_templates"), F.col("b.n_windows").alias("n_windows"),
        rest(mine).alias("mine"), rest(F.col("b.slots")).alias("theirs"))
    pairs = stored(pairs.distinct(), "template-matches")
    one = ["doc_id", "item_id", "shift"]
    on = lambda x, y, names: reduce(and_, [F.col(f"{x}.{n}").eqNullSafe(F.col(f"{y}.{n}")) for n in names])
    zipped = F.explode(F.arrays_zip("theirs", "mine")).alias("s")
    torn = pairs.select(*one, zipped).groupBy(*one, F.col("s.theirs").alias("value")).agg(F.min("s.mine").alias("low"), F.max("s.mine").alias("high")).where(
        "low <> high").groupBy(*one).agg(F.collect_set("value").alias("torn"), F.max(~F.col("value").rlike("^[0-9]")).alias("names"))
    seen = pairs.where("templated").groupBy(*one).agg((F.count_distinct("pos") == F.max("n_templates")).alias("entire"))
    torn = torn.alias("t").join(seen.alias("e"), on("t", "e", one), "left").select("t.*", (F.coalesce("entire", F.lit(False)) & ~F.col("names")).alias("only_numbers"))
    good = pairs.alias("p").join(torn.alias("f"), on("p", "f", one), "left").where(
        F.col("f.torn").isNull() | F.col("f.only_numbers") | (F.col("mine") == F.col("theirs")) | ~F.arrays_overlap("theirs", "f.torn")).select("p.*")
    both = ["doc_id", "item_id"]
    slots = good.select(*one, zipped).groupBy(*one, F.col("s.theirs").alias("value")).agg(F.max(F.col("s.mine") != F.col("s.theirs")).alias("changed")).groupBy(
        *one).agg(F.count("*").alias("slots"), F.sum(F.col("changed").cast("int")).alias("changed")).groupBy(*both).agg(
        F.max("slots").alias("slots"), F.max("changed").alias("changed"))
    counts = good.groupBy(*both, "pos").agg(*(F.max(c).alias(c) for c in ("templated", "n_templates", "n_windows"))).groupBy(*both).agg(
        F.count("*").alias("matched"), F.count_if("templated").alias("by_template"), F.max("n_templates").cast("long").alias("n_templates"),
        F.max("n_windows").cast("long").alias("n_windows"))
    enough = lambda found, n: F.col(found) >= F.least(F.lit(min_windows), F.col(n))
    out = counts.where(enough("matched", "n_windows") | (F.col("n_templates") > 0) & enough("by_template", "n_templates"))
    out = out.alias("c").join(slots.alias("s"), on("c", "s", both), "left").select(
        "c.*", F.coalesce("slots", F.lit(0)).alias("slots"), F.coalesce("changed", F.lit(0)).alias("changed"))
    # Where values differ, a window without a template can't be told from a lost one: those not found are left out.
    item_windows = F.when(F.col("changed") > 0, F.col("n_templates") + F.col("matched") - F.col("by_template")).otherwise(F.col("n_windows"))
    return out.withColumn("item_windows", item_windows).select(
        "doc_id", "item_id", "matched", "item_windows", F.round(F.col("matched") / F.col("item_windows"), 4).alias("coverage"), "slots", "changed",
        F.when(F.col("changed") > 0, "reparameterised").otherwise("exact").alias("kind"))
