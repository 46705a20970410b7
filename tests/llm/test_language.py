import math
import random

import numpy as np
import pytest

from tabulon.llm import language
from tabulon.llm.pieces import Vocabulary, read_model


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(read_model(language.MODEL))


def test_forward_sums_all_segmentations(vocabulary):
    log_p = np.stack([vocabulary.weight, np.full(vocabulary.size, -math.log(vocabulary.size))], axis=1)

    def brute(unit):
        edges, todo, out = vocabulary.edges(unit), [(0, np.zeros(2))], []
        while todo:
            at, score = todo.pop()
            if at == len(edges):
                out.append(score)
            else:
                todo += [(j, score + log_p[k]) for j, k in edges[at]]
        return np.logaddexp.reduce(np.array(out), axis=0)

    units = ["▁the", "▁hello", "▁éau", "▁ñ😀x", "▁日本"]
    assert np.allclose(language.forward(vocabulary, units, log_p), [brute(u) for u in units])
    long = language.forward(vocabulary, ["▁" + "qz" * 60], log_p)
    assert np.isfinite(long).all()


def test_expected_counts_against_all_segmentations(vocabulary):
    unit, edges = "▁then", vocabulary.edges("▁then")
    paths, todo = [], [(0, 0.0, ())]
    while todo:
        at, score, ids = todo.pop()
        if at == len(edges):
            paths.append((score, ids))
        else:
            todo += [(j, score + vocabulary.weight[k], (*ids, k)) for j, k in edges[at]]
    p = np.exp([s for s, _ in paths])
    want = np.zeros(vocabulary.size)
    for share, (_, ids) in zip(p / p.sum(), paths):
        for k in ids:
            want[k] += 3 * share
    assert np.allclose(language.expected(vocabulary, [unit], np.array([3.0]), vocabulary.weight), want)


def test_held_out_accuracy_and_odd_rows(spark):
    r = random.Random(2)
    parts = {"aa": ["the", "ing", "of", "th", "er", "sh"], "bb": ["ung", "ß", "sch", "ein", "über", "ich"]}
    rows = [(i, " ".join("".join(r.choice(parts[x]) for _ in range(2)) for _ in range(8)), x) for i in range(120) for x in [("aa", "bb")[i % 2]]]
    odd = [(900, None, "aa"), (901, "", "bb"), (902, "123 !!", "aa"), (903, "THE OF", None), (903, "THE OF", None)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string").selectExpr("*", "'q' as row", "'q' as score")
    model = language.fit(docs.where("doc_id % 3 > 0"))
    assert model.languages == ["aa", "bb"]
    got = language.predict(docs.drop("score"), model, ["doc_id", "lang"]).collect()
    assert len(got) == 125 and all(x["lang_pred"] == x["lang"] for x in got if x["doc_id"] < 120)
    assert all(x["lang_pred"] == "und" and x["score"] == 0 for x in got if x["doc_id"] in (900, 901, 902))
    assert all(0 <= x["score"] <= 1 for x in got) and [x["lang_pred"] for x in got if x["doc_id"] == 903] == ["aa", "aa"]
    empty = language.fit(docs.limit(0))
    assert {x["lang_pred"] for x in language.predict(docs, empty, ["doc_id"]).collect()} == {"und"}
    assert language.predict(docs.limit(0), model, ["doc_id"]).collect() == []


def test_long_words_are_summed_like_short_ones(vocabulary, monkeypatch):
    log_p = np.stack([vocabulary.weight, np.full(vocabulary.size, -math.log(vocabulary.size))], axis=1)
    units = ["▁internationalization" * 3, "▁then", "▁日本語のテキストñ", "▁" + "a" * 60]
    sums, counts = language.forward(vocabulary, units, log_p), language.expected(vocabulary, units, np.arange(1.0, 5.0), vocabulary.weight)
    monkeypatch.setattr("tabulon.llm.pieces.TOGETHER", 2)
    assert np.allclose(language.forward(vocabulary, units, log_p), sums)
    assert np.allclose(language.expected(vocabulary, units, np.arange(1.0, 5.0), vocabulary.weight), counts)
    alone = language.expected(vocabulary, ["▁internationalization"], np.ones(1), vocabulary.weight).sum()
    assert counts.sum() < 3.3 * alone + 4 * 61 + 3 * 14 + 2 * 3
