"""Repeated passages by super-k-mers: runs of 35-word windows that share a minimiser travel as one packed string.

The minimiser of a window is the least hash among its runs of ``MER`` words. Consecutive windows with one minimiser form a
super-k-mer: their words once, instead of 35 words a window. Equal windows have equal minimisers, so a bucket per minimiser
sees all of them, and windows are sorted and counted there, on the words themselves.

1. Count how often each minimiser is chosen; one that is chosen once can't lie in a repeated window.
2. Documents get the list of their shared minimisers and send only those super-k-mers, zstd-packed, equal ones of a block of
   documents once. A minimiser chosen more than ``HOT`` times sends single windows instead, dealt out by the window.
3. Buckets come sorted; equal strings need no look inside, and of the others the windows are sorted.
4. Documents drop the words of their repeated windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tillwise.llm.common import slices, stored

WINDOW = 35
MER = 8                   # words of a minimiser: longer ones are rarely shared by chance
HOT = 20_000              # choices of a minimiser beyond which its windows are dealt out one by one
BLOCK_WORDS = 1_000_000   # words of a map task between which equal strings are sent once
POOL_WORDS = 250_000      # words of complete buckets that are sorted together
_STEP = np.random.default_rng(13).integers(1, 1 << 63, WINDOW + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def split(text: str | None) -> list[bytes]:
    """Words of a text: runs of bytes other than space and the controls 9 to 13."""
    return (text or "").encode().split()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _rolled(h: np.ndarray, width: int) -> np.ndarray:
    """A hash of every run of ``width`` values."""
    n = max(0, len(h) - width + 1)
    out = np.zeros(n, np.uint64)
    for j in range(width):
        out += h[j:j + n] * _STEP[j]
    return _mixed(out)


def _sliding(x: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` (minimum or maximum) over every run of ``width`` values, by doubling."""
    have = 1
    n = len(x) - width + 1
    if n < 1:
        return x[:0]
    while 2 * have <= width:
        x = pick(x[:-have], x[have:])
        have *= 2
    return pick(x[:n], x[width - have:width - have + n])


def minimisers(words: list[bytes], window: int = WINDOW, mer: int = MER) -> tuple[np.ndarray, np.ndarray]:
    """The minimiser of every window, and the hash of every run of ``mer`` words."""
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    x = _rolled(h, mer)
    return _sliding(x, window - mer + 1, np.minimum), x


def chosen(words: list[bytes], window: int = WINDOW, mer: int = MER) -> tuple[np.ndarray, np.ndarray]:
    """Minimisers of a document and at how many places each is chosen: two equal windows always choose two places."""
    least, x = minimisers(words, window, mer)
    if not len(least):
        return least, np.zeros(0, np.int64)
    reach = window - mer
    padded = np.concatenate((np.zeros(reach, np.uint64), least, np.zeros(reach, np.uint64)))
    return np.unique(x[x == _sliding(padded, reach + 1, np.maximum)], return_counts=True)


def super_kmers(least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First window and end of every run of windows with one minimiser."""
    at = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    return at, np.append(at[1:], len(least))


def repeated_windows(strings: list[list[bytes]], weights: list[int], window: int = WINDOW) -> list[np.ndarray]:
    """For each string of words a flag per window: whether its word sequence occurs again in any of the strings, or in a
    string that stands for several (``weights``). Windows are sorted by hash and equal ones compared word by word."""
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for s in strings for w in s), np.uint64, sum(map(len, strings)))
    length = np.asarray([len(s) for s in strings])
    start = np.cumsum(length) - length
    count = np.maximum(length - window + 1, 0)
    offset = np.cumsum(count) - count
    at = np.repeat(start - offset, count) + np.arange(count.sum())
    hashes = _rolled(_mixed(ids + np.uint64(1)), window)[at]
    weight = np.repeat(np.asarray(weights), count)
    order = np.argsort(hashes, kind="stable")
    same = hashes[order][1:] == hashes[order][:-1]
    flags = weight > 1
    if same.any():
        rows = np.lib.stride_tricks.sliding_window_view(ids, window)
        left, right = at[order[:-1][same]], at[order[1:][same]]
        if (rows[left] == rows[right]).all():
            flags[order[:-1][same]] = True
            flags[order[1:][same]] = True
        else:  # two word sequences under one hash: sort the sequences themselves
            inside = np.union1d(order[:-1][same], order[1:][same])
            _, back, n = np.unique(rows[at[inside]], axis=0, return_inverse=True, return_counts=True)
            flags[inside] |= n[back.ravel()] > 1
    return np.split(flags, offset[1:]) if len(strings) > 1 else [flags]


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate(([False], flags, [False])).astype(np.int8)))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


_SENT = pa.schema([("key", pa.int64()), ("packed", pa.binary()), ("weight", pa.int32()), ("doc", pa.int64()), ("hash", pa.int64()), ("first", pa.int32()),
                   ("end", pa.int32())])
_MARKS = pa.schema([("doc", pa.int64()), ("hash", pa.int64()), ("first", pa.int32()), ("end", pa.int32())])


def _packer():
    import zstandard

    pack = zstandard.ZstdCompressor(level=1, write_checksum=False, write_dict_id=False)
    return pack.compress, zstandard.ZstdDecompressor().decompress


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _spread(doc: int | None, first: int) -> int:
    """A bucket for a mark, which may go anywhere: copies of one text have many."""
    return xxhash.xxh3_64_intdigest(b"%d %d" % (doc or 0, first)) - (1 << 63)


def _send(batches: Iterator[pa.RecordBatch], window: int, mer: int, hot: int) -> Iterator[pa.RecordBatch]:
    """Super-k-mers of the documents' shared minimisers. A string that a block of documents holds more than once is repeated
    for sure: its places leave as marks (no ``packed``), and the string counts for two."""
    pack, _ = _packer()
    block: dict[bytes, list] = {}
    seen = 0

    def sent() -> list[tuple]:
        out = []
        for string, (key, places) in block.items():
            single = len(places) == 1
            out.append((key, pack(string), 1 if single else 2, *(places[0] if single else (None, None, None, None))))
            if not single:
                out += [(_spread(p[0], p[2]), None, 0, *p) for p in places]
        block.clear()
        return out

    for batch in slices(batches):
        for doc, mark, text, mins, counts in zip(*(c.to_pylist() for c in batch.columns)):
            words = split(text)
            least, _ = minimisers(words, window, mer)
            shared = np.asarray(mins, np.int64).view(np.uint64)
            order = np.argsort(shared)
            place = np.minimum(np.searchsorted(shared[order], least), len(shared) - 1)
            found, many = shared[order][place] == least, np.asarray(counts)[order][place] > hot
            for a, b in zip(*(x.tolist() for x in super_kmers(least))):
                if not found[a]:
                    continue
                for first, end in [(i, i + 1) for i in range(a, b)] if many[a] else [(a, b)]:
                    string = b" ".join(words[first:end + window - 1])
                    entry = block.get(string)
                    if entry is None:
                        key = xxhash.xxh3_64_intdigest(string) if many[a] else int(least[a])
                        entry = block[string] = (key - (1 << 64) * (key >> 63), [])
                    entry[1].append((doc, mark, first, end))
                seen += b - a + window - 1
            if seen >= BLOCK_WORDS:
                yield _batch(sent(), _SENT)
                seen = 0
    yield _batch(sent(), _SENT)


def _count(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Marks of the repeated windows from rows in the order of (key, packed): equal strings stand together."""
    _, unpack = _packer()
    pool: list[list] = []   # [packed, weight, place] of complete buckets and the one that is open
    size, last, marks = 0, None, []

    def settled() -> None:
        strings = [unpack(p).split() for p, _, _ in pool]
        for flags, (_, _, place) in zip(repeated_windows(strings, [w for _, w, _ in pool], window) if pool else [], pool):
            if place is not None:
                marks.extend((place[0], place[1], place[2] + a, place[2] + b) for a, b in _runs(flags))
        pool.clear()

    for batch in slices(batches):
        for key, packed, weight, *place in zip(*(c.to_pylist() for c in batch.columns)):
            if packed is None:
                marks.append(tuple(place))
                continue
            if key != last:
                if size >= POOL_WORDS:
                    settled()
                    size = 0
                last = key
            elif pool and pool[-1][0] == packed:  # both places are repeated
                if weight == 1:
                    marks.append(tuple(place))
                if pool[-1][2] is not None:
                    marks.append(tuple(pool[-1][2]))
                pool[-1][1:] = [2, None]
                continue
            pool.append([packed, weight, place if weight == 1 else None])
            size += window + place[3] - place[2] if weight == 1 else 2 * window
        if marks:
            yield _batch(marks, _MARKS)
            marks = []
    settled()
    yield _batch(marks, _MARKS)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(docs[text_col], F.lit(""))
    return docs.select(docs[id_col].cast("long").alias("doc"), F.xxhash64(text).alias("hash"), text.alias("text"))


def _same_document(left: str, right: str) -> Column:
    return F.col(f"{left}.doc").eqNullSafe(F.col(f"{right}.doc")) & (F.col(f"{left}.hash") == F.col(f"{right}.hash"))


def repeated(docs: DataFrame, window: int = WINDOW, mer: int = MER, hot: int = HOT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc``, ``hash`` (of the text) and ``places``: runs (first window, end) of windows that start again anywhere."""
    text = _keyed(docs, id_col, text_col)

    def choices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            got = [chosen(split(t), window, mer) for t in batch.column("text").to_pylist()]
            rows = pa.array(np.repeat(np.arange(len(got)), [len(m) for m, _ in got]))
            mins = np.concatenate([m for m, _ in got]).view(np.int64) if got else np.zeros(0, np.int64)
            n = np.concatenate([c for _, c in got]) if got else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc").take(rows), batch.column("hash").take(rows), pa.array(mins), pa.array(n)],
                                             names=["doc", "hash", "mer", "n"])

    pairs = stored(text.mapInArrow(choices, "doc long, hash long, mer long, n long"), "minimisers")
    counts = pairs.groupBy("mer").agg(F.sum("n").alias("all")).where(F.col("all") > 1)
    lists = pairs.select("doc", "hash", "mer").join(counts, "mer").groupBy("doc", "hash").agg(
        F.collect_list("mer").alias("mers"), F.collect_list("all").alias("counts"))  # as many as the document has
    sending = text.alias("t").join(lists.alias("l"), _same_document("t", "l")).select("t.doc", "t.hash", "t.text", "l.mers", "l.counts")
    sent = sending.mapInArrow(lambda b: _send(b, window, mer, hot), "key long, packed binary, weight int, doc long, hash long, first int, end int")
    dealt = sent.repartition("key").sortWithinPartitions("key", "packed")
    marks = dealt.mapInArrow(lambda b: _count(b, window), "doc long, hash long, first int, end int")
    return marks.groupBy("doc", "hash").agg(F.collect_list(F.struct("first", "end")).alias("places"))


def remove_repeats(docs: DataFrame, window: int = WINDOW, mer: int = MER, hot: int = HOT, keep_text: bool = False,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` for every row, and ``kept`` (the words left, one space apart) on demand.

    A window whose word sequence starts anywhere else, in the same document or another, loses its words, in every place.
    Null and empty texts have no words; texts shorter than ``window`` words lose none. Rows that repeat an id are documents
    of their own, so a repeated row of ``window`` words or more loses every word; a null id stays null. Other columns
    are not read. An empty table gives no rows.
    """
    found = repeated(docs, window, mer, hot, id_col, text_col)
    rows = _keyed(docs, id_col, text_col).alias("t").join(found.alias("f"), _same_document("t", "f"), "left").select("t.doc", "t.text", "f.places")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * keep_text

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = {"n_words": [], "n_removed": [], "kept_sha256": [], "kept": []}
            for text, places in zip(batch.column("text").to_pylist(), batch.column("places").to_pylist()):
                words = split(text)
                n = len(words)
                if places:
                    edge = np.zeros(n + 1, np.int64)
                    at = np.asarray([(p["first"], p["end"] + window - 1) for p in places])
                    np.add.at(edge, at[:, 0], 1)
                    np.add.at(edge, at[:, 1], -1)
                    words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:n]) == 0).tolist()]
                kept = b" ".join(words)
                for name, value in (("n_words", n), ("n_removed", n - len(words)), ("kept_sha256", hashlib.sha256(kept).hexdigest()),
                                    ("kept", kept.decode() if keep_text else None)):
                    out[name].append(value)
            names = ["n_words", "n_removed", "kept_sha256"] + ["kept"] * keep_text
            yield pa.RecordBatch.from_arrays([batch.column("doc"), *(pa.array(out[c], pa.string() if c[0] == "k" else pa.int64()) for c in names)],
                                             names=["doc_id", *names])

    return rows.mapInArrow(strip, schema)
