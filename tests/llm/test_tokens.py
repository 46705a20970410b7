import numpy as np
import pytest

from tabulon.llm import tokens
from tabulon.llm.pieces import UNITS, Vocabulary, marked, n_best, read_model

TEXTS = [
    "", "a", " ", "  two  spaces ", "Hello, world.", "tab\tnew\n\nline ", "▁literal▁ mark", "日本語のテキスト ñandú 😀", "x" * 300,
    "\udbff".encode("utf-8", "replace").decode(), "the the the", "\x00\x07 control", " \n", "aé" * 40, "▁", "\n",
]


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(read_model(tokens.MODEL))


def all_paths(edges, weight):
    out, todo = [], [(0, 0.0, ())]
    while todo:
        at, score, ids = todo.pop()
        if at == len(edges):
            out.append((score, ids))
        else:
            todo += [(j, score + weight[k], (*ids, k)) for j, k in edges[at]]
    return sorted(out, key=lambda p: (-p[0], p[1]))


def test_units_take_part_in_no_common_piece():
    assert "".join(UNITS.findall(marked("a  b\nc ▁d"))) == marked("a  b\nc ▁d")


@pytest.mark.parametrize("unit", ["▁the", "▁▁ab,c", "▁ñ😀x", "\n", "▁x\udc81y", "▁éauou."])
def test_n_best_against_all_segmentations(vocabulary, unit):
    edges = vocabulary.edges(unit)
    paths = all_paths(edges, vocabulary.weight)
    found = n_best(edges, vocabulary.weight, 4)
    assert np.allclose([s for s, _ in found], [s for s, _ in paths[:4]]) and len({k for _, k in found}) == len(found)
    assert {k for _, k in found} <= {k for _, k in paths}
    if vocabulary.simple(unit):
        score, loss, ids = tokens.viterbi(vocabulary, [unit.encode()])
        assert np.isclose(score[0], paths[0][0]) and (len(paths) < 2 or np.isclose(loss[0], paths[0][0] - paths[1][0]))
        assert np.isclose(vocabulary.weight[np.frombuffer(ids[0], "<i4")].sum(), paths[0][0])


def test_texts_n_best_against_all_segmentations(vocabulary):
    for best in (1, 2, 4):
        encoder = tokens.Encoder(vocabulary, best)
        for text, found in zip(["ab ab", "it is so", "no\nto", "é ü"], encoder.encode(["ab ab", "it is so", "no\nto", "é ü"])):
            paths = all_paths(vocabulary.edges(marked(text)), vocabulary.weight)
            assert np.allclose([s for s, _ in found], [s for s, _ in paths[:best]])
            assert len({k for _, k in found}) == len(found)
            for score, ids in found:
                ids = np.frombuffer(ids, "<i4")
                assert np.isclose(vocabulary.weight[ids].sum(), score) and tokens.decode_ids(vocabulary, ids) == text.encode()


def test_forgetting_changes_nothing(vocabulary, monkeypatch):
    texts = [f"word{i} and text{i % 3}" for i in range(50)]
    whole = list(tokens.Encoder(vocabulary).encode(texts))
    monkeypatch.setattr(tokens, "KEPT", 3)
    encoder = tokens.Encoder(vocabulary)
    assert [f for t in texts for f in encoder.encode([t])] == whole


def test_round_trip_in_frames(spark):
    rows = [(k, t, "z") for k, t in enumerate(TEXTS)] + [(None, None, "z"), (3, TEXTS[3], "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, found string")
    done = tokens.encode(docs)
    assert done.columns == ["doc_id", "text", "found", "segmentations"]
    back = tokens.decode(done.selectExpr("text as was", "segmentations[0].ids as ids", "row_number() over (order by doc_id) as row")).collect()
    assert len(back) == len(rows) and all(r["text"] == (r["was"] or "") for r in back)
    got = tokens.digests(docs).collect()
    assert all(r["round_trip"] for r in got) and len(got) == len(rows)
    assert len({tuple(r)[1:] for r in got if r["doc_id"] == 3}) == 1
    assert tokens.digests(docs.limit(0)).collect() == [] and tokens.encode(docs.limit(0)).collect() == []
    assert tokens.decode(spark.createDataFrame([([5, -1],), (None,)], "ids array<int>")).where("text is null").count() == 2


def test_long_units_end_and_equal_their_parts(vocabulary):
    import base64
    import random
    import time

    r = random.Random(1)
    units = ["▁" + "a" * 20_000, "_" * 20_000, base64.b64encode(r.randbytes(30_000)).decode(), "▁internationalization" * 1 + "日本語😀" * 500]
    began = time.time()
    for unit in units:
        parts = vocabulary.parts(unit)
        assert "".join(parts) == unit
        found = next(iter(tokens.Encoder(vocabulary).encode([unit.replace("▁", " ")])))
        assert tokens.decode_ids(vocabulary, np.frombuffer(found[0][1], "<i4")).decode() == unit.replace("▁", " ")
    assert time.time() - began < 60
    # No piece crosses a cut: the best score of the whole is the sum of the parts'.
    unit = "▁then" + "qzx" * 30 + "é😀" + "ing" * 20
    best = lambda u: n_best(vocabulary.edges(u), vocabulary.weight, 3)
    assert len(vocabulary.parts(unit)) > 2 and np.isclose(best(unit)[0][0], sum(best(p)[0][0] for p in vocabulary.parts(unit)))
    assert np.allclose([s for s, _ in best("a" * 12)], [s for s, _ in all_paths(vocabulary.edges("a" * 12), vocabulary.weight)[:3]])


def test_pieces_found_together_and_in_long_data_are_all_there_are(vocabulary):
    import random

    r = random.Random(3)
    units = ["".join(r.choices("aeinrstlodñéß.,▁1", k=r.randint(1, 20))) for _ in range(400)] + ["▁internationalization", "▁▁▁▁"]
    for unit in units:
        want = {(i, j, k) for i, own in enumerate(vocabulary.edges(unit)) for j, k in own}
        code = unit.encode()
        spans = [(i, j, k) for i, j, rows, ids in vocabulary.spans([code, code]) for n, k in zip(rows.tolist(), ids.tolist()) if n == 1]
        assert set(spans) == want and len(spans) == len(want)
        for start, end, ids in (vocabulary.matches(code), vocabulary.lattice(unit)[1:]):
            found = list(zip(start.tolist(), end.tolist(), ids.tolist()))
            assert set(found) == want and found == sorted(found, key=lambda f: (f[1], f[0]))


def test_texts_of_new_words_cost_little(vocabulary):
    """In CPU time against a loop of plain look-ups, as machines differ."""
    import random
    import time

    def least(work):
        times = []
        for _ in range(3):
            began = time.process_time()
            work()
            times.append(time.process_time() - began)
        return min(times)

    def loop():
        own = {k: k for k in range(1000)}
        return sum(own[k % 1000] for k in range(2_000_000))

    r = random.Random(5)
    texts = [" ".join("".join(r.choices(["er", "in", "le", "sh", "ion", "a", "te", "ñ", "ung", "x"], k=5)) for _ in range(4)) for _ in range(1000)]
    assert least(lambda: list(tokens.Encoder(vocabulary).encode(texts))) < 3 * least(loop)
