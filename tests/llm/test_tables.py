"""URL filter, sharding, mixing, token files and top-k against plain Python."""

import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from compare import connect, differences
from llm.conftest import TEXTS
from tillwise.llm import mixing, registry, sharding, tokens, topk, url_filter
from tillwise.llm.common import new_path

SF = "/root/testdata/sf0.001"


def plain_rule(url):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        at = min((i for i, c in enumerate(rest) if c in "/?#"), default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:at])
        path = rest[at:].split("?")[0].split("#")[0]
    fits = [r for r in registry.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, best and best.text, best and best.verdict


def test_urls(spark):
    urls = ["http://A.Example.COM/en/x?q#f", "https://www.example.com/en/", "net", None, "", "x://com/", "x://com", "http://a.net/fr/?", "ftp://é.Net#/es/",
            "http://example.com:80/en/", "http://h.net?a=/es/", "a://b://c.com/", "http://" + "a" * 50_000 + ".com/", "http://x.net/es/\nnew"]
    rows = [(i, u, 1, "r") for i, u in enumerate(urls)] + [(1, urls[1], None, None), (None, urls[0], 1, "r")]
    got = url_filter.judge(spark.createDataFrame(rows, "page_id long, url string, bin int, rule string"), registry.RULES).collect()
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    whole = registry.op2_url_filter(spark, SF).collect()
    assert len(got) == len(rows) and len(whole) == len(pages)
    for r, url in [*((r, urls[r.page_id or 0]) for r in got), *((r, pages[r.page_id]) for r in whole)]:
        host, path, rule, verdict = plain_rule(url)
        assert (r.host, r.path, r.rule) == (host, path, rule), url
        assert r.verdict in ("allow", "block") and (verdict is None or r.verdict == verdict)
    empty = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge(empty, registry.RULES).count() == 0


def test_url_model_learns_from_labels(spark):
    rows = [(i, f"http://{'spam' if i % 2 else 'good'}{i % 7}.{'biz' if i % 2 else 'edu'}/{'9' * (12 * (i % 2) + 1)}/{i}", float(i % 2)) for i in range(400)]
    table = spark.createDataFrame(rows, "page_id long, url string, label double")
    got = url_filter.judge(table, [], labelled=table.where("page_id % 4 < 2")).join(table.select("page_id", "label"), "page_id").where("page_id % 4 >= 2").collect()
    assert sum((r.verdict == "block") == (r.label == 1) for r in got) >= 0.95 * len(got)


def test_shards(spark, odd_docs, no_docs):
    got = registry.op8_sharding(spark, SF).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in got) == sorted(texts)
    places, sizes = defaultdict(list), Counter()
    for r in got:
        raw = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        places[r.shard].append(r.slot)
        sizes[r.shard] += r["size"]
    assert all(sorted(v) == list(range(len(v))) for v in places.values()) and set(places) <= set(range(16))
    largest = max(len((t or "").encode()) + 1 for t in texts.values())
    assert max(sizes.values()) - min(sizes.values()) <= largest
    odd = sharding.assign(odd_docs, shards=3).collect()
    assert len(odd) == odd_docs.count() and all(0 <= r.shard < 3 for r in odd)
    assert sharding.assign(no_docs, shards=3).count() == 0


def test_map_edits_move_little(spark):
    sizes = {s: 100 + s % 7 for s in range(sharding.SLOTS)}
    first = sharding.new_map(sizes, 16)
    grown = sharding.edited_map(first, sizes, 17)
    moved = [s for s in first if first[s] != grown[s]]
    load = Counter()
    for s, k in grown.items():
        load[k] += sizes[s]
    assert all(grown[s] == 16 for s in moved) and len(moved) <= 1.1 * sharding.SLOTS / 17
    assert max(load.values()) - min(load.values()) <= 2 * max(sizes.values())
    back = sharding.edited_map(grown, sizes, 16)
    assert set(back.values()) == set(range(16))
    path = new_path(spark, "map-test")
    sharding.write_map(spark, first, 1, path)
    sharding.write_map(spark, grown, 2, path)
    assert {r.virtual_slot: r.shard for r in sharding.read_map(spark, path).collect()} == grown
    assert {r.virtual_slot: r.shard for r in sharding.read_map(spark, path, 1).collect()} == first


def test_a_stored_map_is_read_and_edited(spark, odd_docs):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), (F.col("id") % 90).cast("int")).alias("text"))
    path = new_path(spark, "map-kept")
    versions = lambda: sorted(r.version for r in spark.read.parquet(path).select("version").distinct().collect())
    first = sorted(sharding.assign(docs, shards=4, map_path=path).collect())
    assert versions() == [1, 2] and len(first) == 400
    assert sorted(sharding.assign(docs, shards=4, map_path=path).collect()) == first and versions() == [1, 2]
    grown = sharding.assign(docs, shards=5, map_path=path).collect()  # what version 2 foresaw
    assert versions() == [1, 2, 3] and {r.map_version for r in grown} == {2} and len(grown) == 400
    assert {(r.doc_id, r.shard) for r in grown} == {(r.doc_id, r.moved_shard) for r in first}
    more = docs.withColumn("text", F.when(F.col("doc_id") < 40, F.repeat(F.lit("y"), 500)).otherwise(F.col("text")))
    drifted = sharding.assign(more, shards=4, map_path=path).collect()
    assert len(drifted) == 400 and {r.map_version for r in drifted} == {4}
    with pytest.raises(ValueError):
        sharding.assign(docs, shards=4, slots=64, map_path=path)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_sql(spark, name):
    df = registry.queries()[name](spark, SF)
    res = connect(SF).execute(registry.oracle_sql()[name])
    assert differences(df.columns, df.collect(), [d[0] for d in res.description], res.fetchall()) is None


def test_mixing_reaches_its_weights(spark, odd_docs, no_docs):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("x" * 99).alias("text"), F.when(F.col("id") % 10 < 8, "big").otherwise("small").alias("source"))
    got = Counter(r.source for r in mixing.mix(docs, {"big": 1, "small": 3}, total_ratio=2.0).select("source").collect())
    assert abs(got["big"] - 10_000) < 400 and abs(got["small"] - 30_000) < 700
    heavy = mixing.mix(docs.where("source = 'small'").limit(200), {"small": 1}, total_ratio=150.0).groupBy("doc_id").count().collect()
    mean = sum(r["count"] for r in heavy) / len(heavy)
    assert abs(mean - 150) < 5 and 6 < math.sqrt(sum((r["count"] - mean) ** 2 for r in heavy) / len(heavy)) < 19
    rows = mixing.mix(odd_docs, keep=("spans", "n")).collect()
    assert [r.position for r in rows] == sorted(r.position for r in rows) and all(r.kept.spans == "spans" for r in rows)
    assert mixing.mix(no_docs).count() == 0 and mixing.mix(odd_docs, {"nowhere": 1}).count() == 0


@pytest.mark.parametrize("encoding", ["delta", "dictionary"])
def test_token_files(spark, odd_docs, encoding):
    from tokenizers import Tokenizer

    path = registry.tokenizer_path()
    own = Tokenizer.from_file(path)
    odd = [*TEXTS, "a  b", " lead", "trail ", "a \n b", "tab\t x", "nb\u00a0sp \u00a0x", "<|endoftext|> a <|endoftext|>", "it's we'll  3 4", "\u2028 x \u200b y"]
    docs = spark.createDataFrame([(i, t, 5) for i, t in enumerate(odd)] + [(None, "null id", 5)], "doc_id long, text string, part int")
    docs = docs.unionByName(spark.read.parquet(f"{SF}/documents.parquet").select((F.col("doc_id") + 100).alias("doc_id"), "text", F.lit(1).alias("part")))
    folder = new_path(spark, "tokens-test")
    got = {r.doc_id: r for r in tokens.write_and_index(docs, path, folder, encoding=encoding, part_bytes=100_000).collect()}
    ids = {r.doc_id: r.tokens for r in tokens.read(spark, folder).collect()}
    start = 0
    for row in sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0)):
        want = own.encode(row.text or "", add_special_tokens=False).ids + [2]
        r = got[row.doc_id]
        assert ids[row.doc_id] == want
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(want), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in want)))
        start += len(want)
    assert tokens.write_and_index(docs.where("false"), path).count() == 0


def test_tokens_of_a_batch_meet_the_tokenizer_once(monkeypatch, tmp_path):
    import pyarrow as pa
    from tokenizers import Tokenizer, normalizers

    own = Tokenizer.from_file(registry.tokenizer_path())
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdeilnorstuvw\u00e9\u00df\u0416\u4e2d", k=7)) for _ in range(400)]
    texts = ["Of " + " ".join(w + rng.choice(["", "", ",", ".", "!?", "\nAnd"]) for w in rng.choices(words, k=60)) for _ in range(200)]
    texts += [None, "", " ", "a  b", "x\u00b2, \u0915\u093f. e\u0301, \u2167! _. '. it's.", "<|endoftext|>, a", "\u2028 x \u200b, y", "z" * 5000]
    want = [own.encode(t or "", add_special_tokens=False).ids for t in texts]
    monkeypatch.setattr(tokens, "KEPT_PIECES", 200)  # most words are not remembered, yet each is looked up once a batch
    enc, whole, merged = tokens.Encoder(registry.tokenizer_path()), [], Counter()
    monkeypatch.setattr(enc, "whole", lambda t, f=enc.whole: whole.append(t) or f(t))
    monkeypatch.setattr(enc, "_merged", lambda p, s, f=enc._merged: merged.update([(p, s)]) or f(p, s))
    assert enc.batch(pa.array(texts)).to_pylist() == want
    assert len(whole) < 60 and not set(words) & {t.strip() for t in whole}  # letters never take the tokenizer's long way
    assert max(merged[w, True] for w in words) <= 6  # 60 times a word on average: at most once with each ending
    assert enc.batch(pa.array(texts).slice(3, 90)).to_pylist() == want[3:93]
    own.normalizer = normalizers.Lowercase()  # another kind of tokenizer
    own.save(path := str(tmp_path / "lower.json"))
    assert tokens.Encoder(path).batch(pa.array(["AbC deF, Gh.", "XyZ"])).to_pylist() == [own.encode(t, add_special_tokens=False).ids for t in ("AbC deF, Gh.", "XyZ")]


def test_file_layout(spark):
    import glob

    import pyarrow.parquet as pq

    folder = new_path(spark, "tokens-layout")
    tokens.write(spark.read.parquet(f"{SF}/documents.parquet"), folder, registry.tokenizer_path(), part_bytes=200_000)
    last = -1
    for f in sorted(glob.glob(f"{folder}/part-*.parquet")):
        meta = pq.ParquetFile(f).metadata
        columns = [meta.row_group(0).column(i) for i in range(meta.num_columns)]
        assert any("DELTA_BINARY_PACKED" in c.encodings for c in columns if c.path_in_schema.startswith("tokens")) and columns[0].has_offset_index
        own = pq.read_table(f, columns=["doc_id"])["doc_id"].to_pylist()
        assert own == sorted(own) and own[0] > last
        last = own[-1]


def test_topk_odd_vectors(spark):
    rows = [(i, [float((i * j) % 7 - 3) for j in range(1, 17)], 0, "q") for i in range(120)]
    rows += [(i, [1.0] * 16, 0, "q") for i in range(200, 260)] + [(300, None, 0, "q"), (350, [1.0], 0, "q"), (400, [float("nan")] + [None] * 15, 0, "q"), (None, [1.0] * 16, 0, "q")]
    rows.append(rows[3])
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, seg int, ids string")
    code = {r[0]: "".join("1" if x is not None and x > 0 else "0" for x in r[1]) for r in rows if r[0] is not None and r[1] is not None}
    code = {i: c.ljust(16, "0") for i, c in code.items()}
    want = set()
    for q in (i for i in code if i % 50 == 0):
        near = sorted((sum(a != b for a, b in zip(code[q], code[i])), i) for i in code if i != q)[:10]
        want |= {(q, k + 1, i, d) for k, (d, i) in enumerate(near)}
    assert {tuple(r) for r in topk.search(table).collect()} == want
    assert topk.search(table.where("false")).count() == 0
    longer = table.select("vec_id", "embedding").unionByName(spark.createDataFrame([(500, [1.0] * 17)], "vec_id long, embedding array<float>"))
    got = {tuple(r) for r in topk.search(longer).collect()}  # one long vector takes no row from the others
    code = {**{i: c + "0" for i, c in code.items()}, 500: "1" * 17}
    assert {r[0] for r in got} == {i for i in code if i % 50 == 0} and all(d == sum(a != b for a, b in zip(code[q], code[i])) for q, _, i, d in got)
    few = topk.search(table.where("vec_id < 4")).collect()
    assert len(few) == 3


def test_topk_broadcasts_nothing(spark, monkeypatch):
    """Probes are many more than the rows that size estimates see."""
    plans = []

    def watched(df, label, stored=topk.stored):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, label)

    monkeypatch.setattr(topk, "stored", watched)
    table = spark.createDataFrame([(i, [float((i * j) % 7 - 3) for j in range(1, 9)]) for i in range(60)], "vec_id long, embedding array<float>")
    plans.append(topk.search(table, k=3)._jdf.queryExecution().executedPlan().toString())
    assert sum("SortMergeJoin" in p for p in plans) >= 3 and not any("Broadcast" in p for p in plans)
