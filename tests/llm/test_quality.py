import math

import numpy as np

from tabulon.llm import quality


def test_word_hashes_do_not_depend_on_place():
    a = quality._words(np.frombuffer(b"one two  one", np.uint8))
    b = quality._words(np.frombuffer("é two\tone".encode(), np.uint8))
    assert a[1][0] == a[1][2] == b[1][2] and a[1][1] == b[1][1] and a[1][0] != a[1][1]
    assert list(a[0]) == [0, 4, 9]


def test_long_texts_are_seamless(monkeypatch):
    texts = [b"a b c d e f g h " * 40, b"", b"x y", b"  ", b"abc " * 100]
    whole = [np.concatenate([o * 10**6 + c for o, c in quality.grams([t])] or [np.zeros(0, int)]) for t in texts]
    monkeypatch.setattr(quality, "STEP", 50)
    parts = [np.concatenate([o * 10**6 + c for o, c in quality.grams([t])] or [np.zeros(0, int)]) for t in texts]
    for a, b in zip(whole, parts):
        assert sorted(a) == sorted(b)


def test_kth_largest(spark):
    values = [0.5, 3.0, 3.0, -2.0, 1e9, 7.25, 3.0000001]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for k in range(1, 8):
        assert quality.kth_largest(df, "x", k) == sorted(values, reverse=True)[k - 1]
    assert quality.kth_largest(df, "x", 8) is None and quality.kth_largest(df.where("x > 1e10"), "x", 1) is None


def corpus(spark):
    good = [(i, " ".join(f"word{(i * 7 + j) % 50} and the" for j in range(30))) for i in range(60)]
    bad = [(100 + i, " ".join(f"BUY{(i * 3 + j) % 40}!!! ###" for j in range(30))) for i in range(30)]
    docs = spark.createDataFrame(good + bad + [(200, None), (201, ""), (202, " \n"), (None, good[0][1])], "doc_id long, text string")
    docs = docs.selectExpr("doc_id", "text", "'a' as _n", "'b' as _text", "1 as row")
    labels = spark.createDataFrame([(i, 1) for i in range(40)] + [(100 + i, 0) for i in range(15)] + [(7, None)], "doc_id long, quality int")
    return docs, labels


def test_good_rows_stay(spark):
    docs, labels = corpus(spark)
    got = {r["doc_id"]: r for r in quality.resampled(docs, labels).collect()}
    assert all(got[i]["kept"] for i in range(60)) and not any(got[100 + i]["kept"] for i in range(30))
    assert all(got[i]["log_weight"] is None and not got[i]["kept"] for i in (200, 201, 202)) and got[None]["kept"]
    kept = quality.sample(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 61


def test_against_brute_force(spark):
    docs, labels = corpus(spark)
    rows = [(r["doc_id"], (r["text"] or "").encode()) for r in docs.collect()]
    count = lambda texts: sum((np.bincount(c, minlength=quality.CELLS) for t in texts for _, c in quality.grams([t])), np.zeros(quality.CELLS))
    target, raw = count([t for i, t in rows if i is not None and i < 40]), count([t for _, t in rows])
    ratio = np.zeros(quality.CELLS)
    for part in (slice(0, quality.WORD_CELLS), slice(quality.WORD_CELLS, quality.CELLS)):
        add = raw[part].sum() / target[part].sum()
        p, q = target[part] + 1, raw[part] + add
        ratio[part] = np.log(p / p.sum()) - np.log(q / q.sum())
    model = quality.fit(docs, labels)
    assert np.allclose(model.ratio, ratio)
    got = {r["doc_id"]: r for r in quality.resampled(docs, labels).collect()}
    for i, t in rows:
        cells = [c for _, c in quality.grams([t])]
        if cells and i is not None:
            c = np.concatenate(cells)
            assert math.isclose(got[i]["log_weight"], (ratio[c].mean() - model.limit) / quality.TEMPERATURE, rel_tol=1e-9, abs_tol=1e-7)
    k = sum(r["log_weight"] is not None and r["log_weight"] >= 0 for r in got.values())
    last = sorted((r["key"] for r in got.values() if r["key"] is not None), reverse=True)[k - 1]
    assert all(r["kept"] == (r["key"] is not None and r["key"] >= last) for r in got.values())


def test_no_rows_and_no_labels(spark):
    docs, labels = corpus(spark)
    assert quality.resampled(docs.limit(0), labels).collect() == []
    got = quality.resampled(docs, labels.limit(0)).collect()
    assert sum(r["kept"] for r in got) == 91


def test_a_sample_follows_the_weights(spark):
    docs, labels = corpus(spark)
    model, kept = quality.fit(docs, labels), []
    rows = docs.where("doc_id is not null").select("doc_id", "text")
    weight = {r["doc_id"]: r["_weight"] for r in quality.weighed(rows, model, temperature=1.0).collect() if r["_weight"] is not None}
    times = dict.fromkeys(weight, 0)
    for seed in range(12):
        keys = quality.weighed(rows, model, temperature=1.0, seed=seed)
        kept.append({r["doc_id"] for r in keys.where(keys["_key"] >= quality._last(keys, 30)).collect()})
        assert len(kept[-1]) == 30
        for i in kept[-1]:
            times[i] += 1
    assert len({frozenset(k) for k in kept}) == 12
    good, bad = (np.mean([times[i] for i in weight if (i < 100) == side]) for side in (True, False))
    low, high = (np.mean([weight[i] for i in weight if (i < 100) == side]) for side in (False, True))
    # Drawing 30 of 60 and 30 rows whose weights differ by e to the power of (high - low).
    g = np.random.default_rng(1).gumbel(size=(4000, 90)) + np.repeat([high, low], [60, 30])
    want = (np.argsort(-g, axis=1)[:, :30] < 60).sum(axis=1).mean() / 60 * 12
    assert abs(good - want) < 1.0 and good > bad
    assert quality.resampled(docs, labels, size=10**6).where("kept").count() == 91
    assert quality.sample(docs, labels, size=0).count() == 0
