"""Encoding, packing and nearest neighbours, against public tokenizers and brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from lodegraph.llm import hnsw, neighbours, packing, tokens

VOCAB = tokens.vocabulary_path()


@pytest.fixture(scope="module")
def reference():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=tokens.ranks(VOCAB), special_tokens={}).encode_ordinary


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'a1é한²　​.,"), st.characters(codec="utf-8")), max_size=60))
def test_exact_encoding(reference, s):
    assert tokens.encoder(VOCAB, None).encode([s, None, ""]).to_pylist() == [reference(s), [], []]


def test_long_words(reference):
    for w in ("ab" * 4000, "가" * 2000, "=" * 3000, " " * 500 + "x"):
        assert tokens.merge(w.encode(), tokens.ranks(VOCAB)) is not None
        assert tokens.encoder(VOCAB, None).encode([w]).to_pylist() == [reference(w)]


def test_lexicon_is_a_minimal_automaton(tmp_path):
    words = {w.encode(): [i, i + 1] for i, w in enumerate(["car", "cars", "cat", "cats", "bar", "bars", "한글", "한국"])}
    p = tmp_path / "l.npy"
    p.write_bytes(tokens.compile_lexicon(words))
    lex = tokens.Lexicon(str(p))
    got = lex.find([*words, b"ca", b"carss", b"", b"zzz"])
    assert got == [*words.values(), None, None, None, None]
    # suffixes are shared: fewer states than a trie has
    trie = {w[:i] for w in words for i in range(len(w) + 1)}
    assert len(lex.final) < len(trie)
    empty = tmp_path / "e.npy"
    empty.write_bytes(tokens.compile_lexicon({}))
    assert tokens.Lexicon(str(empty)).find([b"a"]) == [None]


def test_encode_ids(spark, reference):
    rows = [(1, "흑관 3kg <|endoftext|> the pipe"), (2, None), (3, ""), (4, "the pipe the pipe"), (4, "the pipe the pipe"), (5, "a" * 30_000)]
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit(1)).withColumn("n_tokens", F.lit(1))
    got = tokens.encode_ids(d).collect()
    assert sorted((r.doc_id, list(r.ids)) for r in got) == sorted((i, reference(t) if t else []) for i, t in rows)
    assert sorted((r.doc_id, r.n_tokens) for r in tokens.encode_sizes(d, "doc_id", "text").collect()) == sorted((i, len(reference(t)) if t else 0) for i, t in rows)
    assert tokens.encode_ids(d.limit(0)).count() == 0


def test_best_fill_against_brute_force():
    r = random.Random(1)
    for _ in range(60):
        cap = r.randint(10, 60)
        h = Counter(r.randint(1, cap) for _ in range(r.randint(1, 9)))
        sizes = sorted(h, reverse=True)
        items = list(h.elements())
        items.remove(sizes[0])
        sums = {0}
        for x in items:
            sums |= {s + x for s in sums}
        want = max(s for s in sums if s + sizes[0] <= cap) + sizes[0]
        fill = packing.best_fill(sizes, dict(h), cap)
        assert sum(s * k for s, k in fill.items()) == want and all(k <= h[s] for s, k in fill.items())


def test_plan_uses_every_item_once():
    r = random.Random(2)
    h = Counter(int(r.paretovariate(1.1) * 20) % 512 + 1 for _ in range(20_000))
    fills = packing.plan(h, 512)
    used = Counter()
    for times, fill in fills:
        assert sum(s * k for s, k in fill.items()) <= 512
        for s, k in fill.items():
            used[s] += k * times
    assert used == h
    total = sum(s * n for s, n in h.items())
    assert sum(t for t, _ in fills) <= -(-total // 512) * 1.01 + 1
    assert packing.plan({}, 512) == []


def test_pack(spark):
    sizes = [0, None, 5, 5, 5, 7, 10, 25, 3, 3, 1]
    d = spark.createDataFrame([(i, s) for i, s in enumerate(sizes)] + [(2, 5)], "doc_id long, n_tokens int").withColumn("container", F.lit(1)).repartition(3)
    got = packing.pack(d, capacity=10).collect()
    assert Counter(r.doc_id for r in got) == Counter({**{i: 1 for i in range(11)}, 7: 3, 2: 2})
    fill = Counter()
    for r in got:
        fill[r.container] += r.size
    assert max(fill.values()) <= 10 and sum(fill.values()) == 69 and len(fill) == 7
    assert sorted(r.size for r in got if r.doc_id == 7) == [5, 10, 10]
    assert packing.pack(d.limit(0), capacity=10).count() == 0


def _unit(r, n, d=16):
    x = r.normal(size=(n, d)).astype("f4")
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_graph_recall():
    r = np.random.default_rng(0)
    x = _unit(r, 1500)
    g = hnsw.Graph(x, 10, 48)
    list(g.build(0, 2.0))
    got = {}
    for a, b, _ in g.query(x[:200], 6, 2.0):
        for p, q in zip(a, b):
            got.setdefault(p, set()).add(q)
    s = x[:200] @ x.T
    want = np.argsort(-s, axis=1)[:, :6]
    assert np.mean([len(got[i] & set(want[i])) / 6 for i in range(200)]) > 0.9


def test_dense_groups_are_found_whole():
    r = np.random.default_rng(1)
    x = np.concatenate([_unit(r, 300), np.repeat(_unit(r, 1), 80, axis=0) + r.normal(size=(80, 16)).astype("f4") * 0.01])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    pairs = set()
    for a, b, _ in hnsw.Graph(x, 4, 8).build(0, 0.9):
        pairs |= {(min(p, q), max(p, q)) for p, q in zip(a.tolist(), b.tolist())}
    want = {(i, j) for i, j in zip(*np.nonzero(np.triu(x @ x.T >= 0.9, 1)))}
    assert len(want & pairs) / len(want) > 0.97


def test_similar(spark):
    r = np.random.default_rng(3)
    x = _unit(r, 400, 8)
    rows = [("t", f"n-{i}", [float(v) for v in row * (i % 5 + 1)]) for i, row in enumerate(x)]
    rows += [("t", "near", [float(v) for v in x[0] + 0.01]), ("t", "copy", rows[1][2]), ("t", "copy2", rows[1][2]), rows[2], ("u", "n-0", rows[0][2])]
    rows += [("t", "null", None), ("t", "short", [1.0]), ("t", "zero", [0.0] * 8), ("t", "nan", [float("nan")] + [1.0] * 7), ("t", None, rows[3][2]), ("t", "inner", [None] + [1.0] * 7)]
    d = spark.createDataFrame(rows, "table_name string, id string, embedding array<float>")
    got = {(q.id_a, q.id_b) for q in neighbours.similar(d, 0, 0.9, probes=999, dim=8, cell=100).filter("table_name = 't'").collect()}
    y = np.concatenate([x, [(x[0] + 0.01) / np.linalg.norm(x[0] + 0.01)]])
    names = [f"n-{i}" for i in range(400)] + ["near"]
    want = {tuple(sorted((names[i], names[j]))) for i, j in zip(*np.nonzero(np.triu(y @ y.T >= 0.9, 1)))}
    assert want <= got
    extra = got - want
    # copies hang on one of them, not on each other in all pairs
    assert {v for p in extra for v in p} >= {"copy", "copy2"} and all({"copy", "copy2"} & set(p) for p in extra)
    asked = spark.createDataFrame([("t", "n-7"), ("t", "absent")], "table_name string, id string")
    top = neighbours.top_k(neighbours.similar(d, 5, 2.0, probes=999, queries=asked, m=12, ef=64, dim=8, cell=200), 5).filter("id = 'n-7'").orderBy("rank").collect()
    best = [names[j] for j in np.argsort(-(y @ x[7])) if j != 7][:5]
    assert [t.other for t in top] == best
    assert neighbours.similar(d.limit(0), 5, 0.9, dim=8).count() == 0


def test_copies_of_asked_vectors_have_all_their_neighbours(spark):
    r = np.random.default_rng(4)
    x = _unit(r, 300, 8)
    rows = [(f"n-{i:03}", x[i]) for i in range(300)]
    # copies of one that is not asked first, of one more than k times, and an id of two vectors
    rows += [(f"c-{j:02}", x[7]) for j in range(9)] + [(f"d-{j}", x[8]) for j in range(2)] + [("n-005", x[9]), ("n-010", x[10])]
    d = spark.createDataFrame([("t", i, [float(e) for e in v]) for i, v in rows], "table_name string, id string, embedding array<float>").repartition(3)
    names = ["c-03", "c-08", "n-007", "d-1", "n-005", "n-010", "n-100"]
    asked = spark.createDataFrame([("t", n) for n in [*names, "absent"]], "table_name string, id string")
    got = {}
    for q in neighbours.nearest(d, 5, asked, probes=999, m=12, ef=64, dim=8, cell=100).orderBy("id", "rank").collect():
        got.setdefault(q.id, []).append(q.other)
    ids, y = [i for i, _ in rows], np.array([v for _, v in rows])
    for n in names:
        best = {}
        for i in np.nonzero(np.array(ids) == n)[0]:
            for j, c in zip(ids, y @ y[i]):
                best[j] = max(best.get(j, -2.0), round(float(c), 5))
        best.pop(n)
        assert got[n] == sorted(best, key=lambda j: (-best[j], j))[:5]
    assert set(got) == set(names)


def test_measured_probes():
    r = np.random.default_rng(6)
    x = _unit(r, 4000, 16)
    c = hnsw.centroids(x, 40)
    p = neighbours.needed_probes(x, c, 5)
    s = x @ x.T
    np.fill_diagonal(s, -2)
    near = np.argsort(-s, axis=1)[:, :5]
    own, ranks = (x @ c.T).argmax(1), np.argsort(np.argsort(-(x @ c.T), axis=1), axis=1)
    assert 0.96 < (np.take_along_axis(ranks, own[near], 1) < p).mean() and 1 < p < 40
    assert neighbours.needed_probes(x[:3], c, 5) == 40 and neighbours.needed_probes(x, c[:1], 5) == 1
