import random

import numpy as np
import xxhash

from tabulon.llm import simhash


def brute(rows):
    marks = {}
    for i, t in rows:
        w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").encode().split()
        grams = [b" ".join(w[k : k + 4]) for k in range(max(1, len(w) - 3))] if w else []
        hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        marks[i] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) if hs else 0
    ids, comp = list(marks), {i: i for i in marks}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if comp[a] > comp[b] and bin(marks[a] ^ marks[b]).count("1") <= 4:
                    comp[a], changed = comp[b], True
    return {(i, f"{marks[i]:016x}", comp[i]) for i in ids}


def texts():
    r = random.Random(5)
    base = [" ".join(r.choice("abcdefghij") * r.randint(1, 6) for _ in range(60)) for _ in range(12)]
    out = [None, "", " \t\n", "One", "one", "a b c", "é ünï x y z", "A\x0bB\x0cC D"]
    for t in base:
        out += [t, t.upper()]
        w = t.split()
        for _ in range(3):
            w = list(w)
            w[r.randrange(60)] = "new"
            out.append("  ".join(w))
    return list(enumerate(out))


def test_against_brute_force(spark):
    rows = texts()
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, fp string")
    got = simhash.near_duplicates(docs).collect()
    assert {tuple(x) for x in got} == brute(rows) and len(got) == len(rows)


def test_long_texts_are_seamless(monkeypatch):
    texts = [b"", b" ", b"a b c", b"a b c d", b"One\ttwo  " * 30, b"x" * 200, b"p q " + b"y" * 90 + b" r s t u"]
    whole = [(simhash.fingerprint(t), simhash.long_fingerprints(t)) for t in texts]
    monkeypatch.setattr(simhash, "_BYTES", 7)
    assert [(simhash.fingerprint(t), simhash.long_fingerprints(t)) for t in texts] == whole


def test_dense_buckets_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "DENSE", 6)
    monkeypatch.setattr(simhash, "FEW", 2)
    monkeypatch.setattr(simhash, "BLOCK", 16)
    r = random.Random(1)
    seeds = [r.getrandbits(64) for _ in range(4)]
    marks = sorted({s ^ sum({1 << r.randrange(64) for _ in range(r.randint(0, 5))}) for s in seeds for _ in range(60)})
    df = spark.createDataFrame([(int(np.uint64(m).view(np.int64)),) for m in marks], "fp long")
    got = {tuple(x) for x in simhash.components(simhash.links(df)).collect()}
    signed = [int(np.uint64(m).view(np.int64)) for m in marks]
    comp = dict(zip(marks, signed))
    for _ in range(20):
        for a in marks:
            comp[a] = min(comp[b] for b in marks if bin(a ^ b).count("1") <= 4)
    linked = {s: comp[m] for m, s in zip(marks, signed) if any(a != m and bin(a ^ m).count("1") <= 4 for a in marks)}
    assert dict(got) == linked


def test_nulls_repeats_and_empty(spark):
    schema = "doc_id long, text string"
    docs = spark.createDataFrame([(None, "q w e r t"), (3, "q w e r t"), (3, "q w e r t"), (1, None)], schema)
    got = sorted(map(tuple, simhash.near_duplicates(docs).collect()), key=str)
    assert len(got) == 4 and {x[2] for x in got if x[0] != 1} == {3}
    assert sorted(x["doc_id"] or 0 for x in simhash.keep_one(docs).collect()) == [0, 1, 3]
    assert simhash.near_duplicates(spark.createDataFrame([], schema)).collect() == []


def shingles(text):
    w = text.lower().split()
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}


def test_similar_texts_are_found_and_others_left(spark, monkeypatch):
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 9)))
    texts = []
    for _ in range(25):
        w = [word() for _ in range(300)]
        texts.append(" ".join(w))
        for edits in (1, 2, 3, 40):
            v = list(w)
            for k in r.sample(range(300), edits):
                v[k] = word()
            texts.append(" ".join(v))
    sets = [shingles(t) for t in texts]
    alike = lambda i, j: len(sets[i] & sets[j]) / len(sets[i] | sets[j])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for dense in (1024, 3):
        monkeypatch.setattr(simhash, "DENSE", dense)
        monkeypatch.setattr(simhash, "FEW", 2)
        comp = {x["doc_id"]: x["component_id"] for x in simhash.similar(docs).collect()}
        sure = [(i, j) for i in range(len(texts)) for j in range(i) if alike(i, j) >= 0.85]
        assert sum(comp[i] == comp[j] for i, j in sure) >= 0.97 * len(sure) and len(sure) > 80
        assert all(comp[i] != comp[j] for i in range(len(texts)) for j in range(i) if alike(i, j) < 0.4 and i // 5 != j // 5)
        assert all(comp[5 * k + 4] == 5 * k + 4 for k in range(25))


def test_one_of_each_group_stays(spark):
    schema = "doc_id long, text string, row string, node string, _kept string"
    long = " ".join(f"word{k}" for k in range(50))
    rows = [(5, long), (4, long + " end"), (4, long + " end"), (9, "short one"), (None, long), (None, None), (7, None), (8, " ")]
    docs = spark.createDataFrame([(*x, "r", "n", "k") for x in rows], schema)
    got = simhash.keep_one(docs)
    assert got.columns == docs.columns
    assert sorted((x["doc_id"] or 0) for x in got.collect()) == [0, 0, 4, 7, 9]
    assert simhash.keep_one(docs.limit(0)).collect() == [] and simhash.similar(docs.limit(0)).collect() == []


def test_links_are_exact_for_cut_and_appended_passages(spark, monkeypatch):
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 9)))
    line, texts = " ".join(word() for _ in range(12)), []
    for size in (12, 30, 60, 200):
        for _ in range(12):
            w = [word() for _ in range(size)]
            new = [word() for _ in range(size)]
            texts.append(" ".join(w))
            for share in (0.15, 0.19, 0.22, 0.25, 0.28, 0.33):
                k = int(share * size)
                texts += [" ".join(w + new[:k]), " ".join(new[:k] + w), " ".join(w[k:]), line + " " + " ".join(w[: size - k])]
    sets = [shingles(t) for t in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    comp, near = list(range(len(texts))), []
    for i in range(len(texts)):
        near += [(i, j) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    for _ in range(40):
        for i, j in near:
            comp[i] = comp[j] = min(comp[i], comp[j])
    for dense, frequent in ((32, 16), (3, 4)):
        monkeypatch.setattr(simhash, "DENSE", dense)
        monkeypatch.setattr(simhash, "FREQUENT", frequent)
        monkeypatch.setattr(simhash, "SETS", 8000)
        monkeypatch.setattr(simhash, "NEAR", 64)
        assert {x["doc_id"]: x["component_id"] for x in simhash.similar(docs).collect()} == dict(enumerate(comp))


def test_texts_below_the_similarity_stay(spark):
    r = random.Random(10)
    words = iter(sorted({"".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(9000)}, key=lambda _: r.random()))
    texts = []
    for size in [104] * 30:  # 100 shingles; 126 with those of the new words: 0.794
        w = [next(words) for _ in range(size)]
        texts += [" ".join(w), " ".join(w + [next(words) for _ in range(26)])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {x["doc_id"]: x["component_id"] for x in simhash.similar(docs).collect()} == {i: i for i in range(len(texts))}
    assert simhash.keep_one(docs).count() == len(texts)
    assert simhash.keep_one(docs, 0.79).count() == len(texts) // 2


def test_components_by_rounds_and_in_one_task(spark, monkeypatch):
    from tabulon.llm import graph

    r = random.Random(4)
    links = [(i, i + 1) for i in range(0, 60)] + [tuple(sorted((r.randrange(100, 400), r.randrange(100, 400)))) for _ in range(150)]
    links = [(a, b) for a, b in links if a < b]
    df = spark.createDataFrame(links, "a long, b long")
    one = {tuple(x) for x in graph.components(df).collect()}
    monkeypatch.setattr(graph, "FEW_LINKS", -1)
    assert {tuple(x) for x in graph.components(df).collect()} == one and len(one) == len({x for link in links for x in link})
    assert graph.components(df.limit(0)).collect() == []
