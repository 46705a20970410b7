"""The pipeline's stages, one after the other on the smallest documents, each against a brute-force version."""

import re

import corpus_pipeline
import numpy as np
from pyspark.sql import functions as F

from tabulon.llm import mixing, pii, quality, simhash, tokens
from tabulon.llm.pieces import Vocabulary, read_model

SF = "/root/testdata/sf0.001"


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, out = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        out[name] = (docs, spark.read.parquet(str(tmp_path / str(k))))
        docs = out[name][1]
        assert name == "pieces" or docs.columns == columns

    before, after = out["quality"]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = {r["doc_id"] for r in quality.resampled(before, labels).where("kept").collect()}
    assert {r["doc_id"] for r in after.collect()} == kept and 0.7 < len(kept) / before.count() < 1

    before, after = out["near_duplicates"]
    texts = {r["doc_id"]: r["text"] for r in before.collect()}
    left = {r["doc_id"]: r["text"] for r in after.collect()}
    sets = {i: shingles(t) for i, t in texts.items()}
    alike = lambda i, j: len(sets[i] & sets[j]) / len(sets[i] | sets[j])
    assert all(texts[i] == t for i, t in left.items())
    assert not [(i, j) for i in left for j in left if i < j and alike(i, j) >= 0.85]
    gone = set(texts) - set(left)
    comp = {r["doc_id"]: r["component_id"] for r in simhash.similar(before).collect()}
    assert all(comp[i] == i for i in left) and all(comp[i] in left for i in gone)
    assert all(any(alike(i, j) >= 0.72 for j in texts if j != i and comp[j] == comp[i]) for i in gone)

    before, after = out["personal_data"]
    old = {r["doc_id"]: r["text"] for r in before.collect()}
    new = {r["doc_id"]: (r["text"], r["n_chars"]) for r in after.collect()}
    assert set(old) == set(new) and all(n == len(t) for t, n in new.values())
    spans = {r["doc_id"]: r["spans"] for r in pii.spans(before).collect()}
    for i, text in old.items():
        done, at = "", 0
        for s in spans[i]:
            if s["start"] >= at:
                done += text[at : s["start"]] + f"[{pii.KINDS[s['kind']].upper()}]"
            at = max(at, s["stop"])
        assert new[i][0] == done + text[at:]
        assert not re.search(r"@mail\d", new[i][0])

    before, after = out["mixing"]
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    taken = {r["doc_id"]: r["taken"] for r in mixing.mixed(before).where("taken > 0").collect()}
    words = {}
    for r in after.collect():
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + count(r["text"])
    assert words == taken

    before, after = out["pieces"]
    vocabulary = Vocabulary(read_model(tokens.MODEL))
    decoded = sorted((r["doc_id"], tokens.decode_ids(vocabulary, np.array(r["ids"])).decode()) for r in after.collect())
    assert decoded == sorted((r["doc_id"], r["text"]) for r in before.collect())
    assert after.where(F.size("ids") != F.col("n_pieces")).count() == 0


def test_run_is_the_stages_in_a_row(spark):
    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "lang", "source", "n_pieces", "ids", "score", "second_loses"]


def test_odd_documents_pass_every_stage(spark, tmp_path):
    """Nulls, empty and very long texts, repeated rows, ties, clashing column names; and tables without rows."""
    extra = ["row", "node", "_n", "_text", "base", "spans", "key", "taken", "found", "doc", "size", "component_id"]
    given = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    text = given.first()["text"]
    odd = [(9001, None, "en", "a", 0), (9002, "", None, None, 0), (9003, text, "en", "a", 1), (9003, text, "en", "a", 1), (None, text + " more words here", "en", None, 2), (9004, "a" * 300_000, "en", "b", 3), (9005, "word and more " * 20_000, None, "b", 4), (9006, " \n\t ", "en", "a", 5)]
    docs = given.unionByName(spark.createDataFrame(odd, given.schema))
    docs = docs.select("*", *(F.lit(c).alias(c) for c in extra))
    docs.write.parquet(str(tmp_path / "in"))
    docs = spark.read.parquet(str(tmp_path / "in"))
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        assert stage(spark, docs.limit(0), SF).count() == 0
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        after = spark.read.parquet(str(tmp_path / str(k)))
        assert name == "pieces" or after.columns == docs.columns
        if name == "near_duplicates":
            assert after.where("doc_id = 9003").count() <= 1
        elif name in ("personal_data", "pieces"):
            assert after.count() == docs.count()
        docs = after
