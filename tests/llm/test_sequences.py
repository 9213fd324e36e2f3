"""Repeated passages, prefix tries and spelling variants against plain Python."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest

from llm.conftest import TEXTS
from tillwise.llm import repeats, spelling, trie


def plain_repeats(texts, k=35):
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(b" ".join(w[i:i + k]) for w in words for i in range(len(w) - k + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - k + 1):
            if seen[b" ".join(w[i:i + k])] > 1:
                gone[i:i + k] = [True] * k
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def repeat_rows():
    """Common passages in changing surroundings, texts that repeat themselves, texts of one word."""
    rng = random.Random(5)
    word = lambda: rng.choice("abcdefgh") + str(rng.randrange(40))
    passage = [word() for _ in range(60)]
    texts = [" ".join([*(word() for _ in range(rng.randrange(50))), *passage[rng.randrange(20):40 + rng.randrange(20)], *(word() for _ in range(30))]) for _ in range(60)]
    line = " ".join(word() for _ in range(12))
    return texts + ["x " * 200, "x y " * 40, "\n".join([line] * 9), " \t".join(passage[:35]), " ".join(passage[:34]), texts[0], None, "", "\x1f".join("ab" * 50)]


def test_repeats_are_those_of_brute_force(spark):
    texts = repeat_rows()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    want = {i: row for i, row in enumerate(plain_repeats(texts))}
    for options in ({}, {"hot": 3}, {"mer": 3, "hot": 40}):
        got = {r[0]: tuple(r)[1:] for r in repeats.remove_repeats(docs, **options).collect()}
        assert got == want
    small = dict(enumerate(plain_repeats(texts, 6)))
    got = {r.doc_id: r for r in repeats.remove_repeats(docs, window=6, mer=2, hot=50, keep_text=True).collect()}
    assert {i: tuple(r)[1:4] for i, r in got.items()} == small
    assert all(hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256 for r in got.values())


def test_small_blocks_and_pools_change_nothing(spark, monkeypatch):
    texts = repeat_rows()
    batch = repeats._batch([(i, i, t) for i, t in enumerate(texts)], repeats.pa.schema([("doc", "int64"), ("hash", "int64"), ("text", "string")]))
    picks = [repeats.chosen(repeats.split(t)) for t in texts]
    every = {}
    for mins, n in picks:
        for m, c in zip(mins.view(np.int64).tolist(), n.tolist()):
            every[m] = every.get(m, 0) + c
    lists = [[(m, every[m]) for m in mins.view(np.int64).tolist() if every[m] > 1] for mins, _ in picks]
    batch = repeats._batch([(i, i, t, [m for m, _ in x], [c for _, c in x]) for i, (t, x) in enumerate(zip(texts, lists)) if x],
                           repeats.pa.schema([("doc", "int64"), ("hash", "int64"), ("text", "string"), ("mers", repeats.pa.list_(repeats.pa.int64())),
                                              ("counts", repeats.pa.list_(repeats.pa.int64()))]))
    want = {i: r[1] for i, r in enumerate(plain_repeats(texts))}
    for block, pool in ((1, 1), (300, 100), (10**6, 10**6)):
        monkeypatch.setattr(repeats, "BLOCK_WORDS", block)
        monkeypatch.setattr(repeats, "POOL_WORDS", pool)
        sent = sorted((tuple(r.values()) for b in repeats._send(iter([batch]), 35, 8, 5) for r in b.to_pylist()), key=lambda r: (r[0], r[1] is not None, r[1] or b""))
        gone = {}
        for b in repeats._count(iter([repeats._batch(sent, repeats._SENT)]), 35):
            for r in b.to_pylist():
                gone.setdefault(r["doc"], set()).update(range(r["first"], r["end"] + 34))
        assert {i: len(gone.get(i, ())) for i in want} == want


def test_windows_under_one_hash_are_compared(monkeypatch):
    monkeypatch.setattr(repeats, "_rolled", lambda h, width: np.zeros(max(0, len(h) - width + 1), np.uint64))
    a, b = [b"a", b"b", b"c", b"d"], [b"x", b"b", b"c", b"y"]
    got = repeats.repeated_windows([a, b], [1, 1], 2)
    assert [g.tolist() for g in got] == [[False, True, False], [False, True, False]]


def test_repeats_of_odd_rows(spark, odd_docs, no_docs):
    got = repeats.remove_repeats(odd_docs).collect()
    rows = odd_docs.collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    want = [(r.doc_id, *x) for r, x in zip(rows, plain_repeats([r.text for r in rows]))]
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert repeats.remove_repeats(no_docs).count() == 0
    twice = spark.createDataFrame([(1, "w " * 40), (1, "w " * 40), (None, "v1 " + "u t s r " * 10), (None, "v2 " + "u t s r " * 10)], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.n_removed) for r in repeats.remove_repeats(twice).collect()) == [(0, 40), (0, 40), (1, 40), (1, 40)]


def plain_near(words):
    """Words one edit apart, by their texts with one letter deleted."""
    near, shorter = defaultdict(set), defaultdict(list)
    for w in words:
        for i in range(len(w)):
            rest = w[:i] + w[i + 1:]
            shorter[i, rest].append(w)
            if rest in words:
                near[w].add(rest)
                near[rest].add(w)
    for group in shorter.values():
        for x in group:
            near[x] |= {y for y in group if y != x}
    return near


def plain_groups(docs):
    n = Counter()
    for doc, text in docs:
        n.update(spelling.runs(doc, text or ""))
    n = {w: c for w, c in n.items() if c >= 3}
    near, form = plain_near(n), {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {w: (c, len(near[w]), form[w], form[w] and n[form[w]], root(w)) for w, c in n.items()}


def test_spelling_groups_are_those_of_brute_force(spark):
    rng = random.Random(3)
    stems = ["".join(rng.choice("abcàÿ") for _ in range(rng.randrange(5, 9))) for _ in range(40)]

    def changed(w):
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(w))
            w = w[:at] + rng.choice(["", "a", "ba", "ÿ"]) + w[at + rng.randrange(2):]
        return w if rng.randrange(5) else w.capitalize()

    docs = [(i, " ".join(changed(rng.choice(stems)) for _ in range(400)) + "1aaaaa_aaaaa aaaaaa aaaaaaa") for i in range(40)] + [(None, "aaaaa " * 9), (3, None)]
    want = plain_groups(docs)
    got = spelling.group(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()
    assert {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in got} == want and len(got) == len(want)
    assert any(w[4] not in (w[2], k) for k, w in want.items())  # a chain of forms


def test_pivots_are_the_cheapest_disjoint_pair():
    rng = random.Random(9)
    for _ in range(300):
        word = "".join(rng.choice("abc") for _ in range(rng.randrange(5, 12)))
        frequency = {word[i:i + 2]: rng.randrange(9) for i in range(len(word) - 1)}
        places = spelling.prefix(word, {g: i for i, g in enumerate(sorted(frequency, key=lambda g: (frequency[g], g)))})
        a, b = spelling.pivots(word, places, frequency)
        cost = lambda p: sum(frequency[word[i:i + 2]] for i in p)
        assert b - a >= 2 and {a, b} <= set(places)
        assert cost((a, b)) == min(cost(p) for p in combinations(places, 2) if p[1] - p[0] >= 2)


def test_spelling_of_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in spelling.group(odd_docs).collect()}
    assert got == plain_groups(rows) and "three" in got and "x" * 200_000 not in got and len(TEXTS) == 13
    assert spelling.group(no_docs).count() == 0
    assert spelling.group(spark.createDataFrame([(1, "alone alone alone")], "doc_id long, text string")).collect() == [("alone", 3, 0, None, None, "alone")]
    tied = spark.createDataFrame([(1, "brand " * 8 + "brend " * 8 + "brind " * 4)], "doc_id long, text string")
    assert {r.word: (r.form, r.n_near) for r in spelling.group(tied).collect()} == {"brand": (None, 2), "brend": (None, 2), "brind": ("brand", 2)}


def test_roots_of_long_chains(spark):
    links = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(70)] + [("x", "y")], "word string, form string")
    assert {r.word: r.root for r in spelling.roots(links).collect()} == {**{f"w{i}": "w70" for i in range(70)}, "x": "y"}


def plain_trie(rows):
    """Nodes of the rebuilt conversations, prefix by prefix. ``rows``: conv_id, turn, role, text."""
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            turns[c].append((turn is not None, turn or 0, digest, role, text))
    own = {c: [x[3:] for x in sorted(t)] for c, t in turns.items()}
    base = lambda c: c - int(np.fmod(c, 20))
    h = {c: zlib.crc32(str(c).encode()) % 4 for c in own}
    built = {c: tuple(own.get(base(c), [])[:h[c]] + own[c][h[c]:]) for c in own}
    members = defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[built[c][:d]].append(c)
    out = set()
    for p, found in members.items():
        under = [q for q in members if q[:len(p)] == p]
        kids = {q: [r for r in members if r[:-1] == q and len(r) == len(q) + 1] for q in under}
        count = lambda q: len(q[-1][1].encode().split()) if q else 0
        ends = ",".join(str(c) for c in found if len(built[c]) == len(p))
        out.add((found[0], len(p), members[p[:-1]][0] if p else None, len(found), len(kids[p]), sum(not k for k in kids.values()),
                 sum((len(members[q]) - 1) * count(q) for q in under), hashlib.sha256(ends.encode()).hexdigest()))
    return out


def trie_rows(spark, rows, chunk_turns=trie.CHUNK_TURNS, parts=3):
    frame = spark.createDataFrame([(*r, "seq", 1) for r in rows], "conv_id long, turn long, role string, text string, seq string, depth int")
    got = trie.prefix_trie(frame.repartition(parts), chunk_turns).collect()
    fields = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    out = {tuple(r[f] for f in fields) for r in got}
    assert len(out) == len(got)
    return out


@pytest.mark.parametrize("chunk_turns", [1, 7, 40, 10**6])
def test_trie_is_that_of_brute_force(spark, chunk_turns):
    rng = random.Random(chunk_turns)
    rows = [(c, t, rng.choice(["user", "bot", None]), rng.choice(["a b", "c", "", None])) for c in range(70) for t in range(rng.randrange(1, 6))]
    rows += [(c, t, "user", "same words here") for c in range(200, 260) for t in range(4)]  # one conversation many times
    rows += [(300, t, "user", f"turn {t % 3}") for t in range(60)]
    assert trie_rows(spark, rows, chunk_turns) == plain_trie(rows)


def test_trie_of_odd_rows(spark):
    rows = [(None, 1, "user", "x"), (-3, None, None, None), (-3, None, None, None), (-3, 2, "user", "word " * 60_000), (41, 5, "a", "b"), (41, 5, "ab", ""), (40, 5, "ab", ""),
            (41, None, "user", "\t\x0b \x1f\x85\u2003 y"), (7, 0, "", ""), (10**17, 1, "user", "x"), (0, 1, "user", "x"), (0, 1, "user", "x")]
    assert trie_rows(spark, rows) == plain_trie(rows)
    turnless = [(21, 1, "user", "x"), (22, 1, "user", "x"), (35, 1, "user", "x")]  # no conversation 20
    assert trie_rows(spark, turnless) == plain_trie(turnless) and any(r[1] == 0 and r[7] != trie.EMPTY_SHA for r in plain_trie(turnless))
    assert trie_rows(spark, []) == set()


def test_long_member_lists_are_hashed_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(trie, "PIECE", 3)
    rows = [(20 * c, 1, "user", "same") for c in range(100)]
    for part in trie.chunk_nodes([r[0] for r in rows], [b"x" * 16] * 100, [[1]] * 100, 0, 0):
        assert part["kind"] != "ends" or part["ids"].count(",") < 3
    assert trie_rows(spark, rows, 30) == plain_trie(rows)


def test_range_minimum():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 5, 37)
    table = trie.RangeMinimum(values)
    a = rng.integers(0, 37, 200)
    b = np.minimum(a + rng.integers(0, 37, 200), 36)
    assert table.least(a, b).tolist() == [values[x:y + 1].min() for x, y in zip(a, b)]
    for at, depth in zip(range(37), rng.integers(0, 5, 37)):
        right = next((i - 1 for i in range(at + 1, 37) if values[i] < depth), 36)
        left = next((i for i in range(at, 0, -1) if values[i] < depth), 0)
        assert table.right(np.array([at]), np.array([depth])) == right and table.left(np.array([at]), np.array([depth])) == left


def test_spelling_broadcasts_nothing(spark, monkeypatch):
    """Keys of words are many more than the rows that size estimates see."""
    plans = []

    def watched(df, label, stored=spelling.stored):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, label)

    monkeypatch.setattr(spelling, "stored", watched)
    docs = spark.createDataFrame([(1, "brand " * 9 + "brend " * 4 + "trend " * 3)], "doc_id long, text string")
    plans.append(spelling.group(docs)._jdf.queryExecution().executedPlan().toString())
    assert sum("SortMergeJoin" in p for p in plans) >= 3 and not any("Broadcast" in p for p in plans)
