"""Language identification by segmentation-marginalised unigram models over a fixed public vocabulary.

Every language has a probability for each piece of the vocabulary. A word's probability is the sum over all its
segmentations of the product of their pieces' probabilities, by a forward pass over its lattice; a text's is the product over its
words. Models are trained here: pieces are counted in the words' segmentations, each weighted by its share under a
Zipf prior over the vocabulary (one round of expectation by forward and backward sums), and smoothed.

Texts are lower-cased and only letters count.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, in_arrow
from .pieces import MARK, Vocabulary, by_length, read_model
from .tokens import MODEL

#: At most so many documents of each language, by hash of the id, train its model; added counts for smoothing.
FIT_ROWS, ADDED = 2000, 0.1
#: Log weight that a byte of a short part gains, which keeps products of many small probabilities in range.
SHIFT = 2.0
SEED = 8
#: Distinct words kept from one group of texts to the next, and characters in a group.
KEPT, STEP = 400_000, 1 << 20
_OTHER = re.compile(r"[\W\d_]+")


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def words(text: str) -> list[str]:
    return [MARK + w for w in _OTHER.sub(" ", text.lower()).split()]


def _places(start: np.ndarray, end: np.ndarray, size: int, log_p: np.ndarray) -> np.ndarray:
    """(size + 1, models): log of the sum over all ways from 0 to each place; pieces come by end."""
    total = np.full((size + 1, log_p.shape[1]), -np.inf)
    total[0] = 0.0
    into = np.searchsorted(end, np.arange(size + 2)).tolist()
    for j in range(1, size + 1):
        if into[j] < into[j + 1]:
            total[j] = np.logaddexp.reduce(total[start[into[j] : into[j + 1]]] + log_p[into[j] : into[j + 1]], axis=0)
    return total


def _batches(vocabulary: Vocabulary, parts: list[str]) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """(places, bytes) of the short parts of known characters, those of one length together."""
    simple = np.array([n for n, u in enumerate(parts) if vocabulary.simple(u)], np.int64)
    for positions, codes in by_length([parts[n] for n in simple]):
        for k in range(0, len(codes), 8192):
            yield simple[positions[k : k + 8192]], codes[k : k + 8192]


def forward(vocabulary: Vocabulary, units: list[str], log_p: np.ndarray) -> np.ndarray:
    """(units, languages): log of the sum over all segmentations of each unit; ``log_p`` is (pieces, languages).

    A unit's sum is the product of its parts', as no piece crosses them.
    """
    if not units:
        return np.zeros((0, log_p.shape[1]))
    parts, flat, begin = vocabulary.in_parts(units)
    out = np.full((len(parts), log_p.shape[1]), -np.inf)
    for own, codes in _batches(vocabulary, parts):
        length = len(codes[0])
        total = np.zeros((length + 1, len(codes), log_p.shape[1]))
        total[0] = 1.0
        for i, j, rows, ids in vocabulary.spans(codes):
            total[j, rows] += total[i, rows] * np.exp(log_p[ids] + SHIFT * (j - i))
        with np.errstate(divide="ignore"):
            out[own] = np.log(total[length]) - SHIFT * length
    for n in np.flatnonzero(~np.isfinite(out).all(axis=1)):
        size, start, end, ids = vocabulary.lattice(parts[n])
        out[n] = _places(start, end, size, log_p[ids])[size]
    return np.add.reduceat(out[flat], begin, axis=0)


def expected(vocabulary: Vocabulary, units: list[str], times: np.ndarray, log_p: np.ndarray) -> np.ndarray:
    """Expected count of each piece in ``units``, each seen so many ``times``, under one model ``log_p`` (pieces)."""
    out = np.zeros(vocabulary.size)
    if not units:
        return out
    parts, flat, begin = vocabulary.in_parts(units)
    seen = np.bincount(flat, weights=np.repeat(times, np.diff(begin, append=len(flat))), minlength=len(parts))
    done = np.zeros(len(parts), bool)
    for own, codes in _batches(vocabulary, parts):
        length = len(codes[0])
        spans = vocabulary.spans(codes)
        weights = [np.exp(log_p[ids] + SHIFT * (j - i)) for i, j, _, ids in spans]
        before, after = np.zeros((length + 1, len(codes))), np.zeros((length + 1, len(codes)))
        before[0], after[length] = 1.0, 1.0
        for (i, j, rows, _), w in zip(spans, weights):
            before[j, rows] += before[i, rows] * w
        for (i, j, rows, _), w in zip(reversed(spans), reversed(weights)):
            after[i, rows] += after[j, rows] * w
        fine = (before[length] > 0) & np.isfinite(before[length])
        scale = np.where(fine, seen[own] / np.where(fine, before[length], 1.0), 0.0)
        for (i, j, rows, ids), w in zip(spans, weights):
            out += np.bincount(ids, weights=before[i, rows] * w * after[j, rows] * scale[rows], minlength=vocabulary.size)
        done[own] = fine
    for n in np.flatnonzero(~done):
        size, start, end, ids = vocabulary.lattice(parts[n])
        own = log_p[ids][:, None]
        before = _places(start, end, size, own)[:, 0]
        back = np.lexsort((size - end, size - start))  # the same lattice from its other end
        after = _places((size - end)[back], (size - start)[back], size, own[back])[::-1, 0]
        if np.isfinite(before[size]):
            share = np.exp(before[start] + own[:, 0] + after[end] - before[size])
            out += np.bincount(ids, weights=share * seen[n], minlength=vocabulary.size)
    return out


def _counter(pieces: list):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(pieces)
        prior = vocabulary.weight - np.log(np.exp(vocabulary.weight).sum())
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            seen: dict[str, Counter] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen.setdefault(lang, Counter()).update(words(text or ""))
            for lang, counts in seen.items():
                got = expected(vocabulary, list(counts), np.array(list(counts.values()), float), prior)
                total[lang] = total.get(lang, 0) + got
        for lang, got in total.items():
            used = np.flatnonzero(got)
            # Whole numbers add up the same in any order.
            n = np.rint(got[used] * 1024).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used)), pa.array(used.astype(np.int32)), pa.array(n)], ["lang", "piece", "n"])

    return run


class Model:
    """Languages by code point and the (pieces, languages) log probabilities."""

    def __init__(self, languages: list[str], log_p: np.ndarray, pieces: list):
        self.languages, self.log_p, self.pieces = languages, log_p, pieces


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", model: str = MODEL) -> Model:
    """Models of all languages of ``docs``, from at most ``FIT_ROWS`` of each one's ids.

    Rows with a null language don't count. Ids are first cut down by hash to about three times as many as are wanted, by
    an approximate count, so that no language's rows have to meet in one task. The driver gets one count for each
    language and piece.
    """
    pieces = read_model(model)
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang")).where("lang is not null")
    sizes = rows.groupBy("lang").agg(F.approx_count_distinct("id").alias("ids"))
    h = F.xxhash64("id", F.lit(SEED))
    few = F.shiftrightunsigned(h, 11).cast("double") / float(1 << 53) * F.col("ids") < 3.0 * FIT_ROWS
    rows = rows.join(F.broadcast(sizes), "lang").where(few).select("id", "lang").distinct()
    place = F.row_number().over(Window.partitionBy("lang").orderBy(h, "id"))
    chosen = cut(rows.withColumn("n", place).where(F.col("n") <= FIT_ROWS).select("id", "lang"))
    texts = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).cast("string").alias("text"))
    known = texts.join(F.broadcast(chosen), ["id", "lang"]).select("lang", "text")
    got = in_arrow(known, _counter(pieces), "lang string, piece int, n long").groupBy("lang", "piece").agg(F.sum("n").alias("n")).collect()
    languages = sorted({r["lang"] for r in got})
    counts = np.full((len(pieces), len(languages)), ADDED)
    for r in got:
        counts[r["piece"], languages.index(r["lang"])] += r["n"] / 1024
    return Model(languages, np.log(counts / counts.sum(axis=0)), pieces)


def _predictor(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, place, known = Vocabulary(model.pieces), {}, np.zeros((0, len(model.languages)))
        for batch in batches:
            langs, scores = [], []
            group, size = [], 0
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for n, t in enumerate(texts):
                group.append(t)
                size += len(t)
                if size < STEP and n < len(texts) - 1:
                    continue
                if len(place) > KEPT:
                    place, known = {}, known[:0]
                new, where = [], []
                for text in group:
                    own = words(text) if model.languages and has_letter(text) else []
                    for w in own:
                        if w not in place:
                            place[w] = len(place)
                            new.append(w)
                    where.append(np.array([place[w] for w in own], np.int64))
                if new:
                    known = np.concatenate([known, forward(vocabulary, new, model.log_p)])
                for own in where:
                    if not len(own):
                        langs.append("und")
                        scores.append(0.0)
                        continue
                    total = known[own].sum(axis=0)
                    best = int(np.argmax(total))
                    langs.append(model.languages[best])
                    scores.append(float(1.0 / np.exp(total - total[best]).sum()))
                group, size = [], 0
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["row", "lang_pred", "score"])

    return run


def predict(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` of every row of ``docs``, lang_pred and score, its share of all languages' probability.

    Texts that are null or without a letter, and all texts where no language was learned, are ``und`` with score 0.
    Of equally likely languages the first by code point is named. Repeated rows give equal results.
    """
    from pyspark.sql import types as T

    rows = docs.select(F.struct(*(docs[c] for c in keep)).alias("row"), docs[text_col].cast("string").alias("text"))
    schema = T.StructType([rows.schema["row"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return in_arrow(rows, _predictor(model), schema).select("row.*", "lang_pred", "score")
