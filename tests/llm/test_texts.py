"""Quality, decontamination, near duplicates and the pipeline against plain Python."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm.conftest import TEXTS
from tillwise.llm import decontaminate, near_dup, quality, registry
from tillwise.llm.common import stored, words

SF = "/root/testdata/sf0.001"


def test_quality_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in registry.op6_quality(spark, folder).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for i, r in got.items())
    held = [(got[i].predicted, q) for i, q in labels.items() if got[i].held_out]
    assert sum(p == q for p, q in held) >= 0.95 * len(held)


def test_quality_of_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(i, i % 2, 1) for i in range(12)] + [(3, None, 1), (None, 1, 1), (4, 0, 0)], "doc_id long, quality int, x int")
    got = quality.score(odd_docs, labels).collect()
    assert len(got) == odd_docs.count() and all(0 <= r.score <= 1 for r in got)
    one_class = quality.score(odd_docs, labels.where("quality = 1")).collect()
    assert {r.score for r in one_class} == {1.0}
    assert {r.score for r in quality.score(odd_docs, labels.where("false")).collect()} == {0.5}
    assert quality.score(no_docs, labels).count() == 0


def test_discriminant_is_the_textbook_one():
    rng = np.random.default_rng(3)
    p = len(quality.FEATURES)
    x = rng.normal(size=(50, p))
    c = [np.cov(rng.normal(size=(200, p)).T) for _ in range(2)]
    m = rng.normal(size=(2, p))
    model = quality.Discriminant(np.zeros(p), np.ones(p), m, tuple(np.linalg.cholesky(k) for k in c),
                                 tuple(float(np.log(0.5) - 0.5 * np.linalg.slogdet(k)[1]) for k in c), 0.5)
    d = [-0.5 * np.linalg.slogdet(c[k])[1] - 0.5 * np.einsum("ij,jk,ik->i", x - m[k], np.linalg.inv(c[k]), x - m[k]) for k in (0, 1)]
    assert np.allclose(model.score(x), 1 / (1 + np.exp(d[0] - d[1])))


def plain_leaks(docs, items):
    """Windows as tuples, alignment by alignment: ``matched`` per document and item, by the rules of the module's first lines."""
    lower = lambda keys, values: [k if v is None else v.lower() for k, v in zip(keys, values)]
    held = lambda values: tuple(v for v in values if v is not None)
    by_template, by_words, total, short = defaultdict(list), defaultdict(list), {}, defaultdict(list)
    for item, text in items:
        keys, values = decontaminate.template(text)
        n, said = len(keys), lower(keys, values)
        if n < 3 or n == 3 and decontaminate.NUMBER not in keys:
            if n:
                short[tuple(said)].append(item)
            continue
        width = min(n, decontaminate.WIDTH)
        starts = range(n - width + 1)
        templated = {i for i in starts if n >= decontaminate.MIN_WIDTH and 2 * values[i:i + width].count(None) >= width}
        total[item] = len(templated), len(starts)
        for i in starts:
            entry = item, i, held(values[i:i + width]), i in templated
            by_words[tuple(said[i:i + width])].append(entry)
            if i in templated:
                by_template[tuple(keys[i:i + width])].append((*entry, None))
        if 0 in templated and values[0] is None and len(keys[0]) > 1:
            by_template[(decontaminate.NAME, *keys[1:width])].append((item, 0, held(values[:width]), True, keys[0]))
    widths = {len(k) for k in by_words}
    found = defaultdict(set)  # (doc, item, shift) -> (pos, values of the document, values of the item, templated)
    out = {}
    for doc, text in docs:
        keys, values = decontaminate.template(text)
        said = lower(keys, values)
        for item in short.get(tuple(said), ()):
            out[doc, item] = 1
        for width in widths:
            for i in range(len(keys) - width + 1):
                for item, j, theirs, templated in by_words.get(tuple(said[i:i + width]), ()):
                    found[doc, item, i - j].add((j, theirs, theirs, templated))
                plain = values[i:i + width].count(None) + (keys[i] is decontaminate.NAME)
                if 2 * plain >= width:
                    for item, j, theirs, templated, lead in by_template.get(tuple(keys[i:i + width]), ()):
                        mine = held(values[i:i + width])
                        if lead is None or mine[0].lower() == lead:
                            found[doc, item, i - j].add((j, mine[lead is not None:], theirs, templated))
    good = defaultdict(set)
    for (doc, item, _), windows in found.items():
        seen = defaultdict(set)
        for _, mine, theirs, _ in windows:
            for m, t in zip(mine, theirs):
                seen[t].add(m)
        torn = {t for t, m in seen.items() if len(m) > 1}
        whole = total[item][0] > 0 and len({j for j, *_, templated in windows if templated}) == total[item][0]
        numbers = whole and all(t[0] in "0123456789" for t in torn)
        good[doc, item] |= {(j, templated) for j, mine, theirs, templated in windows if numbers or mine == theirs or not torn & set(theirs)}
    for (doc, item), windows in good.items():
        least = lambda n: min(decontaminate.MIN_WINDOWS, n)
        if len(windows) >= least(total[item][1]) or total[item][0] and sum(t for _, t in windows) >= least(total[item][0]):
            out[doc, item] = len(windows)
    return out


def test_leaks_of_documents(spark):
    folder = "/root/testdata/sf0.01"
    rows = lambda name: [tuple(r)[:2] for r in spark.read.parquet(f"{folder}/{name}.parquet").collect()]
    want = plain_leaks(rows("documents"), rows("benchmark"))
    got = {(r.doc_id, r.item_id): r.matched for r in registry.op7_decontaminate(spark, folder).collect()}
    assert got == want and len(got) > 5


def test_templates_and_slots(spark, odd_docs, no_docs):
    item = "A train leaves the station at 40 km per hour with Alice on board and after 3 hours Alice has gone 120 km along the river."
    variant = "Once more. A train leaves the station at 60 km per hour with Robert on board and after 3 hours Robert has gone 180 km along the river. The end."
    broken = variant.replace("and after 3 hours Robert", "and after 3 hours Susan")
    short, tiny = "what is the colour of", "is it so"
    items = spark.createDataFrame([(1, item, "h"), (1, item, "h"), (2, short, "h"), (3, tiny, "h"), (4, None, "h"), (None, "", "h")], "item_id long, text string, hash string")
    docs = spark.createDataFrame([(10, variant, 0), (10, variant, 0), (11, broken, 0), (12, item, 0), (13, "So what is the colour of it", 0), (14, "is it so", 0),
                                  (None, item, 0), (15, "the station at 40 km per hour with Alice", 0)], "doc_id long, text string, pos int")
    got = {(r.doc_id, r.item_id): (r.kind, r.coverage) for r in decontaminate.find_leaks(docs, items).collect()}
    assert got == {(10, 1): ("reparameterised", 1.0), (12, 1): ("exact", 1.0), (None, 1): ("exact", 1.0), (13, 2): ("exact", 1.0), (14, 3): ("exact", 1.0)}
    before = decontaminate.FILTER_WINDOWS
    try:
        decontaminate.FILTER_WINDOWS = 0  # the way without the first filter
        assert {(r.doc_id, r.item_id): (r.kind, r.coverage) for r in decontaminate.find_leaks(docs, items).collect()} == got
    finally:
        decontaminate.FILTER_WINDOWS = before
    assert decontaminate.find_leaks(odd_docs, items).count() == 0 and decontaminate.find_leaks(no_docs, items).count() == 0
    assert decontaminate.find_leaks(docs, items.where("false")).count() == 0


def test_leaks_beside_one_changed_value_and_without_template(spark):
    plain = "the old mill by the quiet river was sold to a young baker who wanted to grind rye for the village and its many small farms"
    twice = f"In 1931 {plain} and in 1931 the miller went away to the coast"
    item = {1: twice, 2: "Tom has 5 apples and 5 pears. How many pieces of fruit does he have in all?", 3: "48 / 2 = 24; 48 + 24 = 72", 4: "48 / 2 = 24",
            5: "What is the sum of 3 numbers if each of them is 7", 6: "Tell Alice that Robert met Susan near Old Berlin on the way to Paris", 7: "is it so"}
    text = {10: twice.replace("1931 the miller", "1947 the miller"), 11: item[2].replace("5 apples", "7 apples").replace("5 pears", "9 pears"),
            12: "So 48 / 2 = 24; 48 + 24 = 72 and no more", 13: "the user asked What is the sum of 4 numbers if each of them is 9", 14: item[6].upper(),
            15: "the user asked Which is the sum of 4 numbers if each of them is 9", 18: "Is it SO?", 16: "it is so that 48 and 24 are 72", 17: item[6].replace("Robert", "Peter")}
    items = spark.createDataFrame(list(item.items()), "item_id long, text string")
    docs = spark.createDataFrame(list(text.items()), "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.find_leaks(docs, items).collect()}
    assert set(got) == {(10, 1), (11, 2), (12, 3), (12, 4), (13, 5), (14, 6), (17, 6), (18, 7)}
    assert {k: r.kind for k, r in got.items() if r.kind != "exact"} == {(10, 1): "reparameterised", (11, 2): "reparameterised", (13, 5): "reparameterised", (17, 6): "reparameterised"}
    assert {k: r.matched for k, r in got.items()} == plain_leaks(list(text.items()), list(item.items()))
    assert all(r.matched <= r.item_windows and 0 < r.coverage <= 1 for r in got.values()) and got[14, 6].coverage == 1


def plain_classes(docs):
    """Components over all pairs of k-mer sequences by quadratic alignment."""
    root = {i: i for i, _ in docs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    def seq(t):
        seen, out, w = Counter(), [], words(t or "")
        for i in range(len(w) - 4):
            k = tuple(w[i:i + 5])
            out.append((k, seen[k]))
            seen[k] += 1
        return out

    def aligned(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
        return row[-1]

    keys = {i: (" ".join(words(t or "")) or f"\n{t or ''}") for i, t in docs}
    seqs = {i: seq(t) for i, t in docs}
    sets = {i: set(s) for i, s in seqs.items()}
    for a, _ in docs:
        for b, _ in docs:
            if a < b and find(a) != find(b):
                common, total = len(sets[a] & sets[b]), len(sets[a] | sets[b])
                same = keys[a] == keys[b]
                if not same and total and common / total >= 0.8:
                    m = aligned(seqs[a], seqs[b])
                    same = m / (len(seqs[a]) + len(seqs[b]) - m) >= 0.8
                if same:
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return {i: find(i) for i, _ in docs}


def test_classes_of_documents(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r.doc_id: r.class_id for r in registry.op10_near_dup(spark, SF).collect()}
    assert got == plain_classes(docs) and len(set(got.values())) < len(got)


def linked_pairs(docs, asked):
    """Pairs (asked, other) of similarity 0.8 or more, by an index of all k-mers."""
    seqs = {i: near_dup.kmers(t or "") for i, t in docs}
    index = defaultdict(list)
    for i, x in seqs.items():
        for k in x.tolist():
            index[k].append(i)
    for i in asked:
        common = Counter(j for k in seqs[i].tolist() for j in index[k] if j != i)
        for j, c in common.items():
            if c / (len(seqs[i]) + len(seqs[j]) - c) >= 0.8 and near_dup.similarity(seqs[i], seqs[j]) >= 0.8:
                yield i, j


def test_recall_over_all_documents(spark):
    folder = "/root/testdata/sf0.1"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: r.class_id for r in registry.op10_near_dup(spark, folder).collect()}
    pairs = list(linked_pairs(docs, [i for i, _ in docs if i % 10 == 0]))
    assert len(pairs) > 300 and sum(got[i] == got[j] for i, j in pairs) >= 0.99 * len(pairs)


def test_group_of_near_copies_below_the_threshold(spark):
    """Texts that differ from one original by edits of their own, most of them too many: no link may be lost between them."""
    rng = np.random.default_rng(4)
    origin = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(120):
        w = list(origin)
        for at in rng.choice(300, int(rng.integers(2, 14)), replace=False):
            w[at] = f"own{i}x{at}"
        rows.append((i, " ".join(w)))
    rows += [(200 + i, " ".join([*origin[:200], *(f"tail{i // 3}x{j}" for j in range(120 + i % 3))])) for i in range(30)]
    got = {r.doc_id: r.class_id for r in near_dup.classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    pairs = list(linked_pairs(rows, [i for i, _ in rows]))
    root = {i: i for i, _ in rows}
    for _ in root:
        for i, j in pairs:
            root[i] = root[j] = min(root[i], root[j])
    assert got == root and len(set(root.values())) > 20


def test_texts_of_equal_size_too_far_from_their_hub_make_no_bucket_rows(spark, monkeypatch):
    """Of equal size and with edits of their own, texts that are not linked to the hub can't match those that are; texts with tails
    of their own behind one long part can."""
    rng, rows, made = np.random.default_rng(9), [(0, " ".join(f"w{i}" for i in range(304)))] * 2, {}
    for i in range(1, 81):
        w = rows[0][1].split()
        for at in rng.choice(60, 1 if i <= 40 else int(rng.integers(8, 10)), replace=False):
            w[5 * at] = f"own{i}x{at}"
        rows.append((i, " ".join(w)))
    monkeypatch.setattr(near_dup, "stored", lambda df, label: made.update({label: stored(df, label)}) or made[label])
    got = {r.doc_id: r.class_id for r in near_dup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: 0 if i <= 40 else i for i in range(81)} and made["apart"].count() > 60
    assert made["extra-kmers"].count() == 0
    parts = [" ".join([*(f"v{i}" for i in range(300)), *(f"tail{j}x{i}" for i in range(10 + 4 * j))]) for j in range(20)]
    got = {r.doc_id: r.class_id for r in near_dup.classes(spark.createDataFrame(list(enumerate(parts)), "doc_id long, text string")).collect()}
    linked = {j for i, j in linked_pairs(list(enumerate(parts)), [0])} | {0}
    assert {j for j in got if got[j] == 0} >= linked and got == plain_classes(list(enumerate(parts)))


def test_bucket_rows_that_no_other_component_can_match_are_left_out(spark):
    rng = np.random.default_rng(7)
    rows = [(0, i, 100, 0, 1, 100.0, True) for i in range(3)] + [(0, 3, 100, 18, 1, 100.0, False), (0, 4, 100, 9, 2, 100.0, True)]
    rows += [(b, 10 * i, int(rng.integers(80, 130)), int(rng.integers(0, 20)), int(rng.integers(1, 4)) * 10, float(rng.integers(0, 9)), bool(rng.random() < .3))
             for b in range(1, 30) for i in range(1, 7)]
    table = spark.createDataFrame(rows, "a long, id long, n int, only int, root long, turn double, probes boolean")
    kept = {(r.a, r.id) for r in near_dup._several_roots(table, ["a"], 0.8).collect()}
    assert {i for a, i in kept if a == 0} == {0, 1, 2, 4}  # 18 and 9 that nobody shares are too many; the copies of 3 are its own component
    for a, i, n, o, root, turn, probes in rows:
        for b, j, m, p, other, later, _ in rows:
            if a == b and probes and root != other and (turn, i) < (later, j) and min(n, m) >= 0.8 * max(n, m) and o + p <= 0.25 * min(n - o, m - p):
                assert {(a, i), (a, j)} <= kept
    assert len(kept) < len(rows)


def test_classes_of_odd_rows(spark, odd_docs, no_docs):
    base = [f"w{i}" for i in range(100)]
    edit = lambda *at: " ".join("other" if i in at else w for i, w in enumerate(base))
    rows = [(100, edit()), (101, edit(50)), (102, edit(50, 20)), (103, edit(50, 20, 80)), (104, edit(5, 15, 25, 35, 45, 55, 65, 75)),
            (105, edit().upper() + "!"), (106, " ".join(base[50:] + base[:50]))]
    docs = odd_docs.unionByName(spark.createDataFrame(rows, "doc_id long, text string"), allowMissingColumns=True)
    got = {r.doc_id: (r.class_id, r.class_size) for r in near_dup.classes(docs).collect()}
    assert {i: got[i][0] for i in range(100, 107)} == {100: 100, 101: 100, 102: 100, 103: 100, 104: 104, 105: 100, 106: 106}
    assert got[0][0] == got[1][0] == 0 and got[5] == (5, 1) and None not in got and len(got) == len(TEXTS) + 7
    assert near_dup.classes(no_docs).count() == 0


def test_similarity_is_symmetric_and_ordered():
    a = np.arange(100, dtype=np.uint64)
    assert near_dup.similarity(a, a) == 1 and near_dup.similarity(a, np.roll(a, 50)) == 0 and near_dup.similarity(a, a[:70]) == 0
    b = np.concatenate([a[:40], a[45:]])
    assert near_dup.similarity(a, b) == near_dup.similarity(b, a) == 95 / 100
    c = a.copy()
    c[[10, 11]] = c[[11, 10]]
    assert near_dup.similarity(a, c) == 99 / 101


def test_long_chains_are_one_component(spark):
    links = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = near_dup.components(links.unionByName(spark.createDataFrame([(1000, 1000), (1001, 1005), (1005, 1001)], "a long, b long"))).collect()
    assert {r.root for r in got if r.id <= 300} == {0} and {r.root for r in got if r.id > 1000} == {1001}
    assert near_dup.components(links.where("false")).count() == 0


@pytest.fixture(scope="module")
def stage_rows(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, SF)
        rows = got.collect()
        out.append((name, docs.collect(), rows, docs.columns, got.columns))
        docs = spark.createDataFrame(rows, got.schema)
    return out


def test_stages(spark, stage_rows):
    for _, before, after, columns, new in stage_rows[:4]:
        assert columns == new and {tuple(r) for r in after} <= {tuple(r) for r in before}
    (_, a0, a1, *_), (_, b0, b1, *_), (_, c0, c1, *_), (_, d0, d1, *_), (_, e0, e1, *_) = stage_rows
    classes = plain_classes([(r.doc_id, r.text) for r in b0])
    assert sorted(r.doc_id for r in b1) == sorted(i for i, c in classes.items() if i == c)
    items = [tuple(r)[:2] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaks = {d for d, _ in plain_leaks([(r.doc_id, r.text) for r in c0], items)}
    assert sorted(r.doc_id for r in c1) == sorted({r.doc_id for r in c0} - leaks)
    assert len(d1) > 0.5 * len(d0) and len(e1) == len(e0)
    assert sorted(r.doc_id for r in e1) == sorted(r.doc_id for r in e0)


def test_stages_take_odd_documents(spark, odd_docs, no_docs):
    for frame in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES[:4]:
            got = stage(spark, frame, SF)
            assert got.columns == frame.columns
            assert name == "mixing" or got.where("doc_id is null").count() == frame.where("doc_id is null").count()
        assert corpus_pipeline.STAGES[4][1](spark, frame, SF).count() == frame.count()
