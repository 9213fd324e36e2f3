"""Token output: documents as Parquet rows with a list column of token ids, in document order.

Ids are delta encoded or dictionary encoded, row groups and pages have fixed sizes and page indexes are written, so a
reader that wants a few documents or only the metadata columns reads little of a file.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window as W, functions as F

from tillwise.llm.common import new_path, slices, stored

END_ID = 2
KEPT_PIECES = 500_000    # pieces of text whose ids a Python worker remembers (about 120 MB); more only costs time
ROWS_TOGETHER = 2_000    # documents whose pieces are looked up together; their bytes are bounded as everywhere
PART_BYTES = 32 << 20    # text bytes aimed at per output file
ROW_GROUP = 16 << 20
PAGE_ROWS = 256          # documents per page: what a selective read has to decode

# A space before a character that is surely no white space ends a piece: the vocabulary's pattern always starts a new
# token there, so pieces can be encoded on their own.
_SPACES = r"\s\x00-\x20\x7f-\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u206f\u3000\ufeff"
_CUT = re.compile(rf"\x20(?=[^{_SPACES}])")
_UNSURE = re.compile(rf"\x20(?:[{_SPACES}]|$)")
_LETTERS_MARKS = re.compile(r"([^\W\d_]+)([^\w\s']+)")
_LINES = re.compile(r"(\S+)\n(\S+)")
_MARKS = ".,;:!?"
_encoders: dict[str, "Encoder"] = {}


class Letters(dict):
    """For ``str.translate``: letters as the byte level vocabulary writes them; whatever its pattern does not join to a letter becomes a space."""

    def __init__(self, level) -> None:
        self.level = level

    def __missing__(self, code: int) -> str:
        split = self.level.pre_tokenize_str("a" + chr(code))
        self[code] = split[0][0][1:] if len(split) == 1 else " "
        return self[code]


class Encoder:
    """A tokenizer that remembers the ids of the pieces it has met. Ids are bytes, little-endian unsigned 32-bit each."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.special = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.known: dict[str, bytes] = {}
        self.bare: dict[str, bytes] = {}
        level = self.tokenizer.pre_tokenizer
        self.letters = self.model = None
        if (isinstance(level, ByteLevel) and level.use_regex and not level.add_prefix_space and self.tokenizer.normalizer is None
                and self.tokenizer.truncation is None):
            self.letters, self.model = Letters(level), self.tokenizer.model
            self.space = level.pre_tokenize_str(" ")[0][0]

    def whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def ids(self, text: str) -> bytes:
        """One text, also one whose spaces don't all end a piece."""
        if any(s in text for s in self.special):
            return self.whole(text)
        first, *rest = _CUT.split(text)
        known, out = self.known, [self._bare(first)]
        for piece in rest:
            out.append(known.get(piece) or self._spaced(piece))
        return b"".join(out)

    def batch(self, texts: pa.Array) -> pa.ListArray:
        """The ids of every text, null as empty. Arrow splits the texts and numbers the pieces, so that each is looked up once a batch."""
        strings = [t or "" for t in texts.to_pylist()]
        odd = [_UNSURE.search(t) is not None or any(s in t for s in self.special) for t in strings]
        lists = pc.split_pattern(pc.if_else(pa.array(odd, pa.bool_()), "", texts.fill_null("")), " ")
        at = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        numbered = lists.flatten().dictionary_encode()
        n, places = len(numbered.dictionary), np.array(numbered.indices, np.int64)
        places[at[:-1]] = n + np.arange(len(strings))  # no space before the first piece; an odd text is one piece
        spaced = np.bincount(places, minlength=n)[:n] > 0
        pieces = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()  # to_pylist takes ten times as long
        found = [self.known.get(p) or self._spaced(p) if s else b"" for p, s in zip(pieces, spaced.tolist())]
        found += [self.ids(t) if o else self._bare(t.partition(" ")[0]) for t, o in zip(strings, odd)]
        ends = np.cumsum(np.fromiter(map(len, [b"", *found]), np.int64)) // 4
        ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(found), "<i4"))).take(pa.array(places))
        return pa.ListArray.from_arrays(ids.offsets.take(pa.array(at)), ids.values)

    def _spaced(self, piece: str) -> bytes:
        """Ids of a piece with the space before it. A run of letters, a run of marks after it and a single line break are
        tokenized apart by the vocabulary's pattern, so the parts are looked up by themselves and only they are remembered."""
        head = piece.rstrip(_MARKS)
        if len(head) < len(piece) and head[-1:].isalnum():
            return (self.known.get(head) or self._spaced(head)) + self._bare(piece[len(head):])
        if "\n" in piece and (m := _LINES.fullmatch(piece)):
            return (self.known.get(m[1]) or self._spaced(m[1])) + self._bare("\n") + self._bare(m[2])
        if (got := self._merged(piece, True)) is None:
            if m := _LETTERS_MARKS.fullmatch(piece):
                return (self.known.get(m[1]) or self._spaced(m[1])) + self._bare(m[2])
            got = self.whole(" " + piece)
        return self._keep(self.known, piece, got)

    def _bare(self, piece: str) -> bytes:
        if (got := self.bare.get(piece)) is None:
            got = self._merged(piece, False)
            got = self._keep(self.bare, piece, self.whole(piece) if got is None else got)
        return got

    def _merged(self, piece: str, spaced: bool) -> bytes | None:
        """Ids of a run of letters, which the pattern leaves whole, straight from the tokenizer's merges; None for other pieces."""
        if self.model is None or " " in (run := piece.translate(self.letters)):
            return None
        return array("I", [t.id for t in self.model.tokenize(self.space + run if spaced else run)]).tobytes()

    def _keep(self, where: dict[str, bytes], piece: str, got: bytes) -> bytes:
        most = KEPT_PIECES // 10 if where is self.bare else KEPT_PIECES * 9 // 10  # room for marks, however many words there are
        if len(where) < most and len(piece) < 24:
            where[piece] = got
        return got


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encode(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``tokens`` (with the end id) of rows with ``doc_id`` and ``text``; null text counts as empty."""
    end = int(np.uint32(end_id).view(np.int32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in slices(batches, ROWS_TOGETHER):
            ids = enc.batch(batch.column("text"))
            starts = ids.offsets.to_numpy()
            values = np.insert(ids.values.to_numpy(), starts[1:], end)
            starts = starts + np.arange(len(starts), dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(starts), pa.array(values))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(starts).astype(np.int64)), lists], names=["doc_id", "n_tokens", "tokens"])

    return docs.mapInArrow(run, "doc_id long, n_tokens long, tokens array<int>")


def write(docs: DataFrame, path: str, tokenizer: str, encoding: str = "delta", end_id: int = END_ID, part_bytes: int = PART_BYTES,
          id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write ``doc_id, part, n_tokens, tokens`` in ascending id order: ``part`` numbers the files in order.

    Rows are split by id ranges of about ``part_bytes`` of text each and encoded there, so only text is shuffled. Null
    ids come first, rows that repeat an id follow each other by text. ``encoding``: delta (binary packed) or dictionary.
    """
    if encoding not in ("delta", "dictionary"):
        raise ValueError(encoding)
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()["bytes"]
    parts = max(1, -(-total // part_bytes))
    ordered = rows.repartitionByRange(int(parts), F.col("doc_id").asc_nulls_first(), F.xxhash64("text")).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    writer = encode(ordered, tokenizer, end_id).withColumn("part", F.spark_partition_id()).write
    (writer.option("parquet.enable.dictionary", str(encoding == "dictionary").lower()).option("parquet.writer.version", "v2")
     .option("parquet.block.size", ROW_GROUP).option("parquet.page.row.count.limit", PAGE_ROWS).option("parquet.page.size", 1 << 20)
     .option("compression", "zstd").parquet(path))


def read(spark, path: str, columns: tuple[str, ...] = ("doc_id", "part", "n_tokens", "tokens")) -> DataFrame:
    """The written columns asked for; metadata reads leave the list column untouched in the files."""
    return spark.read.schema("doc_id long, n_tokens long, tokens array<int>, part int").parquet(path).select(*columns)


def index(spark, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` from the files: ``start`` counts the ids of all documents before, ``ids_crc32`` is
    taken over the ids as little-endian unsigned 32-bit integers.

    Offsets are summed per file, then over files (one row each), then within each file.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            lists = batch.column("tokens")
            values, offsets = np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<i4"), lists.offsets.to_numpy()
            crc = [zlib.crc32(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("part"), batch.column("doc_id"), batch.column("n_tokens"), pa.array(crc, pa.int64()),
                                              pa.array(np.diff(offsets).astype(np.int64))], names=["part", "doc_id", "n_tokens", "ids_crc32", "n_ids"])

    # One row a document without its ids; n_ids is the true length of the list.
    rows = stored(read(spark, path).mapInArrow(run, "part int, doc_id long, n_tokens long, ids_crc32 long, n_ids long"), "token-index")
    before = rows.groupBy("part").agg(F.sum("n_ids").alias("ids")).withColumn(
        "before", F.coalesce(F.sum("ids").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))  # one row a file
    within = W.partitionBy("part").orderBy(F.col("doc_id").asc_nulls_first(), "ids_crc32", "n_ids").rowsBetween(W.unboundedPreceding, -1)
    placed = rows.withColumn("inside", F.coalesce(F.sum("n_ids").over(within), F.lit(0)))
    return placed.join(before.select("part", "before"), "part").select(
        "doc_id", (F.col("before") + F.col("inside")).alias("start"), F.col("n_ids").alias("n_tokens"), "ids_crc32", "part")


def write_and_index(docs: DataFrame, tokenizer: str, path: str | None = None, **options) -> DataFrame:
    spark = docs.sparkSession
    path = path or new_path(spark, "tokens")
    write(docs, path, tokenizer, **options)
    return index(spark, path)
