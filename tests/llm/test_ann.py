import numpy as np

from tabulon.llm import ann


def test_hadamard_and_axes():
    x = np.random.default_rng(0).normal(size=(5, 8))
    h = np.array([[1.0]])
    for _ in range(3):
        h = np.block([[h, h], [h, -h]])
    assert np.allclose(ann.hadamard(x), x @ h)
    y = ann.rotated(x[:, :6], 2)
    near, top = ann.axes(x[:, :6], 2, 3), np.argmax(np.abs(y), axis=1)
    assert near.shape == (5, 3) and (near[:, 0] // 2 == top).all()
    assert ((near[:, 0] % 2 == 1) == (y[np.arange(5), top] < 0)).all()


def brute(rows, asked, k=5):
    out = {}
    for q, v in asked:
        a = np.array(v, float)
        scored = sorted((-float(a @ b / np.sqrt(a @ a) / np.sqrt(b @ b)), i) for i, b in ((i, np.array(w, float)) for i, w in rows) if i != q)
        out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def as_lists(got):
    out = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


def test_recall_copies_and_order(spark, monkeypatch):
    monkeypatch.setattr(ann, "STORED", 64)
    monkeypatch.setattr(ann, "ASKED", 4)
    g = np.random.default_rng(1)
    x = g.normal(size=(500, 16)).astype(np.float32).tolist()
    rows = [(i, v) for i, v in enumerate(x)] + [(600 + i, x[0]) for i in range(40)] + [(700 + i, x[1]) for i in range(3)]
    vectors = spark.createDataFrame([(i, v, "e") for i, v in rows], "vec_id long, embedding array<float>, v string")
    asked = [r for r in rows if r[0] % 25 == 0]
    got = as_lists(ann.nearest(vectors, vectors.where("vec_id % 25 = 0")).collect())
    want = brute(rows, asked)
    assert set(got) == set(want) and all(len(v) == 5 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    assert [i for i, _ in got[0]] == [600, 601, 602, 603, 604] and [i for i, _ in got[625]] == [0, 600, 601, 602, 603]
    for q, found in got.items():
        a = np.array(dict(rows)[q])
        for i, s in found:
            b = np.array(dict(rows)[i])
            assert abs(s - a @ b / np.linalg.norm(a) / np.linalg.norm(b)) < 1e-12


def test_odd_rows_and_few_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.0, 2.0]), (2, [-1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [1.0, None]), (6, [nan, 1.0]), (7, [inf, 1.0]), (None, [1.0, 1.0]), (8, []), (9, [1.0, 0.0, 0.0]), (0, [1.0, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = as_lists(ann.nearest(vectors, vectors).collect())
    assert {q: [i for i, _ in v] for q, v in got.items()} == {0: [1, 2], 1: [0, 2], 2: [1, 0]}
    assert ann.nearest(vectors.limit(0), vectors).collect() == [] and ann.nearest(vectors, vectors.limit(0)).collect() == []


def test_more_hashes_for_more_vectors(spark):
    assert [ann.hashes_for(n, 64) for n in (10, 128 * 4096, 128 * 4096 + 1, 128**2 * 4096 + 1)] == [1, 1, 2, 3]
    g = np.random.default_rng(3)
    x = g.normal(size=(5, 6))
    one, two = ann.axes(x, 4), ann.axes(x, 5)
    assert (ann.buckets(x, 2, 2)[:, 0] == one[:, 0] * 16 + two[:, 0]).all() and (ann.buckets(x, 2, 2, 9)[:, 0] == ann.buckets(x, 2, 2)[:, 0]).all()
    assert all(len(set(row)) == 9 for row in ann.buckets(x, 2, 2, 9).tolist())
    x = g.normal(size=(400, 16)).tolist()
    vectors = spark.createDataFrame(list(enumerate(x)), "vec_id long, embedding array<double>")
    got, want = as_lists(ann.nearest(vectors, vectors.where("vec_id % 40 = 0"), hashes=2, tables=8, probes=64).collect()), brute(list(enumerate(x)), [(i, v) for i, v in enumerate(x) if i % 40 == 0])
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)
