import random
import re

from tabulon.llm import mixing


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    target, open_, left = {}, set(order), sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] >= 3 * sizes[s]}
        if not full:
            return target | {s: level * weight[s] for s in open_}
        for s in full:
            target[s] = 3 * sizes[s]
            left -= 3 * sizes[s]
        open_ -= full
    return target


def corpus(spark):
    r = random.Random(4)
    rows = []
    for k in range(240):
        source = "hot" if k % 3 == 0 else r.choice(["a", "b", "B", "é", None, "tiny"]) if k % 40 else "zero"
        n = 2000 if k == 9 else r.randint(0, 60)
        text = None if source == "zero" else " \n".join(f"w{r.randint(0, 99)}" for _ in range(n if source != "tiny" else 1))
        rows.append((k, text, source, len(text or ""), "x"))
    rows += [(500, "one two three", "a", 13, "x")] * 2 + [(None, "p q", "b", 3, "x")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars int, row string")


def test_targets_and_takes(spark):
    rows, docs = corpus(spark)
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = {}
    for r in rows:
        sizes[r[2]] = sizes.get(r[2], 0) + count(r[1])
    want = brute_targets(sizes)
    got = mixing.mixed(docs).collect()
    again = mixing.mixed(docs.repartition(5)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str) and len(got) == len(rows)
    by_id = {r[0]: r for r in rows}
    taken = {}
    for g in got:
        source = by_id[g["doc_id"]][2]
        assert g["size"] == count(by_id[g["doc_id"]][1]) and g["source_size"] == sizes[source]
        assert abs(g["target"] - want[source]) < 1e-6 and 0 <= g["taken"] <= 3 * g["size"]
        taken[source] = taken.get(source, 0) + g["taken"]
    for source, n in taken.items():
        assert abs(n - want[source]) <= 3 * mixing.BLOCK, (source, n, want[source])


def test_schedule_is_even_everywhere(spark):
    sources = spark.createDataFrame([(0, 5000.0), (1, 3000.0), (2, 0.0), (3, 2000.0)], "source_no int, target double")
    slots = sorted(map(tuple, mixing.schedule(sources, 10000, 10).collect()))
    assert [s for s, _, _ in slots] == list(range(1000))
    seen = {}
    for slot, source, block in slots:
        assert block == seen.get(source, 0)
        seen[source] = block + 1
        assert abs(seen[source] - {0: 0.5, 1: 0.3, 3: 0.2}[source] * (slot + 1)) < 4


def test_mix_has_the_words_taken(spark):
    rows, docs = corpus(spark)
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    got = mixing.mix(docs)
    assert got.columns == docs.columns
    out = got.collect()
    texts = {r[0]: r[1] for r in rows}
    words = {}
    for r in out:
        assert texts[r["doc_id"]].startswith(r["text"]) and r["text"] and r["n_chars"] == len(r["text"])
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + count(r["text"])
    want = {}
    for g in mixing.mixed(docs).collect():
        want[g["doc_id"]] = want.get(g["doc_id"], 0) + g["taken"]
    assert words == {k: v for k, v in want.items() if v}
    assert mixing.mix(docs.limit(0)).collect() == [] and mixing.mixed(docs.limit(0)).collect() == []
    assert [r["taken"] for r in mixing.mixed(docs.where("text is null")).collect()] == [0] * docs.where("text is null").count()
