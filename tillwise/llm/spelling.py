"""Spelling variants by pivotal grams: words one edit apart, and the frequent form that each rare word leads to.

Bigrams are ordered from rare to frequent over the vocabulary. Of a word's bigrams in that order the first three, and those
tied with the third, are its prefix; two disjoint ones of it, chosen by dynamic programming for the least total frequency,
are its pivots. One edit destroys one pivot at most, and of two near words the pivots of the one whose prefix ends earlier
are met in the prefix of the other. So pivots are joined with prefixes, and what meets is verified by its edit distance.

Position limit: the edit lies on one side of a bigram that both words keep, so its place counted from the other end of the
word is the same, and so are all letters on that side. The side with the edit is cut in the middle: one of its halves is the
same as well. Place, length and all letters known to agree form the join key, which keeps buckets small.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tillwise.llm.common import joined, map_rows, slices, stored

RUN = re.compile("[A-Za-zÀ-ÿ]+")
SHORTEST = 5           # code points; shorter words have too few bigrams for the lemma
LEAST_COUNT = 3
DAMAGED = 97           # one run in so many loses a letter
PREFIX = 3             # bigrams: one edit destroys two at most
BLOCK_ENTRIES = 200_000


def runs(doc_id: int | None, text: str) -> Counter:
    """Words of one text with their counts: runs of letters, A-Z in lower case, some with a letter deleted by their hash."""
    seen = Counter(RUN.findall(text.encode().lower().decode()))
    start, out = zlib.crc32(f"{'null' if doc_id is None else doc_id}:".encode()), Counter()
    for run, n in seen.items():
        h = zlib.crc32(run.encode(), start)
        if h % DAMAGED == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        if len(run) >= SHORTEST:
            out[run] += n
    return out


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word``, ``n`` of all words with ``LEAST_COUNT`` occurrences or more. Map tasks add up before the shuffle."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Counter = Counter()
        for batch in slices(batches):
            for doc, text in zip(*(c.to_pylist() for c in batch.columns)):
                if text:
                    block.update(runs(doc, text))
            if len(block) >= BLOCK_ENTRIES:
                yield pa.RecordBatch.from_arrays([pa.array(list(block)), pa.array(list(block.values()), pa.int64())], names=["word", "n"])
                block = Counter()
        yield pa.RecordBatch.from_arrays([pa.array(list(block), pa.string()), pa.array(list(block.values()), pa.int64())], names=["word", "n"])

    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(count, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def prefix(word: str, rank: dict[str, int]) -> list[int]:
    """Positions of the bigrams up to the third in the common order, with all that tie with it."""
    ranks = [rank[word[i:i + 2]] for i in range(len(word) - 1)]
    last = sorted(ranks)[PREFIX - 1]
    return [i for i, r in enumerate(ranks) if r <= last]


def pivots(word: str, places: list[int], frequency: dict[str, int]) -> tuple[int, int]:
    """Two disjoint bigrams of the prefix with the least total frequency. ``one``: the cheapest bigram that ends before the
    next; ``two``: the cheapest pair so far."""
    one: tuple[int, int] | None = None
    two: tuple[int, int, int] | None = None
    ended = 0
    for at in places:
        while places[ended] + 2 <= at:
            cost = (frequency[word[places[ended]:places[ended] + 2]], places[ended])
            one = cost if one is None else min(one, cost)
            ended += 1
        if one is not None:
            cost = (one[0] + frequency[word[at:at + 2]], one[1], at)
            two = cost if two is None else min(two, cost)
    return two[1], two[2]


def agreed(word: str, at: int, length: int) -> Iterator[int]:
    """Hashes of what ``word`` and a near word of ``length`` letters agree on if both keep the bigram at ``at``: read from the
    start or from the end, the letters up to the bigram's end and the first or second half of the rest."""
    for way, w, p in (("<", word, at), (">", word[::-1], len(word) - 2 - at)):
        if p + 2 <= length:
            cut = (p + 2 + length) // 2  # as the word of that length counts; the edit is behind it or before it
            yield xxhash.xxh3_64_intdigest(f"{way}{p},{length},{w[:cut]}") - (1 << 63)
            if cut > p + 2:
                yield xxhash.xxh3_64_intdigest(f"{way}{p},{length},{w[:p + 2]},{w[cut + len(word) - length:]}") - (1 << 63)


def near_pairs(words: DataFrame) -> DataFrame:
    """``word``, ``n``, ``near``, ``near_n``: every ordered pair of words one insertion, deletion or replacement apart.
    ``words``: distinct ``word`` of ``SHORTEST`` code points or more, ``n``."""
    grams = words.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.col("word").substr(i, F.lit(2)))).alias("gram"))
    frequency = {r["gram"]: r["n"] for r in grams.groupBy("gram").agg(F.count("*").alias("n")).collect()}  # at most 90 x 90 letters
    rank = {g: i for i, g in enumerate(sorted(frequency, key=lambda g: (frequency[g], g)))}

    def keys(of_pivots: bool) -> DataFrame:
        def sign(c: list[list]) -> dict[str, list]:
            out = {"word": [], "n": [], "last": [], "key": []}
            for word, n in zip(*c):
                places = prefix(word, rank)
                last = max(rank[word[at:at + 2]] for at in places)
                for at in pivots(word, places, frequency) if of_pivots else places:
                    for length in range(max(SHORTEST, len(word) - 1), len(word) + 2) if of_pivots else [len(word)]:
                        for key in agreed(word, at, length):
                            for column, value in zip(out.values(), (word, n, last, key)):
                                column.append(value)
            return out

        return map_rows(words.select("word", "n"), sign, "word string, n long, last int, key long")

    a, b = keys(True).alias("a"), keys(False).alias("b")
    near = ((F.col("a.key") == F.col("b.key")) & (F.col("a.last") <= F.col("b.last")) & (F.col("a.word") != F.col("b.word"))
            & (F.levenshtein("a.word", "b.word", 1) == 1))
    found = joined(a, b, near).select(F.array(F.struct("a.word", "a.n", F.col("b.word").alias("near"), F.col("b.n").alias("near_n")),
                                           F.struct("b.word", "b.n", F.col("a.word").alias("near"), F.col("a.n").alias("near_n"))).alias("both"))
    return found.select(F.inline("both")).distinct()


def roots(links: DataFrame) -> DataFrame:
    """``word``, ``root``: the last word that the links (``word``, ``form``) lead to. Rounds double the steps; a form has
    twice the count at least, so there are six rounds at most for counts of 64 bits."""
    now = stored(links.select("word", F.col("form").alias("root"), F.lit(True).alias("open")), "forms")
    while not now.where("open").isEmpty():
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        now = stored(joined(now, ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("open")),
                     "forms")
    return now.select("word", "root")


def group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n, n_near, form, form_n, root`` for every word of the vocabulary.

    ``form``: the near word with the largest count (of equal ones the first in code-point order) if that is twice the word's
    or more, else null; ``root``: where the forms end, the word itself if it has none. Null and empty texts have no words,
    a null id is written ``null`` in the hash that damages words, and repeated rows count again. Other columns are not read.
    An empty table gives no rows.
    """
    words = stored(vocabulary(docs, id_col, text_col), "vocabulary")
    best = near_pairs(words).groupBy("word", "n").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best"))
    formed = F.when(-F.col("best.m") >= 2 * F.col("n"), F.col("best"))
    forms = stored(best.select("word", "n_near", formed["near"].alias("form"), (-formed["m"]).alias("form_n")), "near-words")
    ends = roots(forms.where("form is not null"))
    return joined(joined(words, forms, "word", "left"), ends, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form", "form_n", F.coalesce("root", "word").alias("root"))
