"""Encoding texts to pieces and back, with the n best segmentations.

A segmentation's score is the sum of its pieces' log weights, which follow Zipf's law over the vocabulary's merge
order. Within a unit, or a part of a long one, the n best come from a forward Viterbi pass and a backward A-star search
(``pieces.best_paths``). A text's n best are put together from its units': all but the n - 1 units that lose least by their second best
segmentation keep their best one, as any other change loses at least as much as n better texts do.

Encoding is lossless: spaces are marks, characters outside the vocabulary are byte pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_arrow
from .pieces import UNITS, Vocabulary, best_paths, by_length, marked, read_model

#: Distinct units kept from one group of texts to the next, and bytes of text in a group.
KEPT, STEP = 200_000, 1 << 21
#: The vocabulary's place, and how many segmentations are found.
MODEL, BEST = "/opt/tokenizers/piece_bpe_32k.model", 3


def viterbi(vocabulary: Vocabulary, units: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(score, loss, ids) of units of one length: the best segmentation's score, what the second best loses against
    it (infinite if there is none), and the best one's ids as 32-bit bytes."""
    n, length = len(units), len(units[0])
    weight = vocabulary.weight
    spans = [(i, j, rows, ids, weight.take(ids)) for i, j, rows, ids in vocabulary.spans(units)]
    forward = np.full((length + 1, n), -np.inf)
    back, piece = np.zeros((length + 1, n), np.int32), np.zeros((length + 1, n), np.int32)
    forward[0] = 0.0
    for i, j, rows, ids, w in spans:
        score = forward[i].take(rows) + w
        better = np.flatnonzero(score > forward[j].take(rows))
        won = rows.take(better)
        forward[j][won], back[j][won], piece[j][won] = score.take(better), i, ids.take(better)
    backward = np.full((length + 1, n), -np.inf)
    backward[length] = 0.0
    for i, j, rows, _, w in reversed(spans):
        backward[i][rows] = np.maximum(backward[i].take(rows), backward[j].take(rows) + w)
    on_path = np.zeros((length + 1, n), bool)
    at, all_ = np.full(n, length), np.arange(n)
    columns = []
    while at.any():
        on_path[at, all_] = True
        columns.append(np.where(at > 0, piece[at, all_], -1))
        at = np.where(at > 0, back[at, all_], 0)
    second = np.full(n, -np.inf)
    back[~on_path] = -1
    for i, j, rows, _, w in spans:
        other = np.flatnonzero(back[j].take(rows) != i)
        rows = rows.take(other)
        second[rows] = np.maximum(second.take(rows), forward[i].take(rows) + w.take(other) + backward[j].take(rows))
    table = np.stack(columns[::-1], axis=1)
    flat, ends = table[table >= 0].astype("<i4").tobytes(), np.cumsum((table >= 0).sum(axis=1)) * 4
    starts = np.concatenate([[0], ends[:-1]])
    return forward[length], forward[length] - second, [flat[a:b] for a, b in zip(starts.tolist(), ends.tolist())]


class Encoder:
    """Segments texts, remembering distinct units."""

    def __init__(self, vocabulary: Vocabulary, best: int = BEST):
        self.vocabulary, self.best = vocabulary, best
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.cuts: dict[str, list[str]] = {}
        self.names: list[str] = []
        self.ids: list[bytes] = []
        self.score, self.loss = np.zeros(0), np.zeros(0)
        self.more: dict[str, list[tuple[float, bytes]]] = {}

    def _best(self, part: str, n: int) -> list[tuple[float, bytes]]:
        return [(s, np.array(k, "<i4").tobytes()) for s, k in best_paths(*self.vocabulary.lattice(part), self.vocabulary.weight, n)]

    def _several(self, place: int) -> list[tuple[float, bytes]]:
        """The n best of a part; of those that tie for the first place, the one in use comes first."""
        part, used = self.names[place], self.ids[place]
        if part not in self.more:
            found = self._best(part, self.best)
            others = [f for f in found if f[1] != used]
            self.more[part] = [(found[0][0], used), *others][: self.best]
        return self.more[part]

    def _learn(self, parts: list[str]) -> None:
        score, loss, ids = np.zeros(len(parts)), np.full(len(parts), np.inf), [b""] * len(parts)
        simple = list(map(self.vocabulary.simple, parts))
        fast = [n for n, s in enumerate(simple) if s]
        for positions, codes in by_length([parts[n] for n in fast]):
            for k in range(0, len(codes), 8192):
                own = [fast[p] for p in positions[k : k + 8192]]
                score[own], loss[own], found = viterbi(self.vocabulary, codes[k : k + 8192])
                for n, x in zip(own, found):
                    ids[n] = x
        for n, s in enumerate(simple):
            if not s:
                found = self._best(parts[n], 2)
                score[n], ids[n] = found[0]
                loss[n] = found[0][0] - found[1][0] if len(found) > 1 else np.inf
        self.ids += ids
        self.names += parts
        self.score, self.loss = np.concatenate([self.score, score]), np.concatenate([self.loss, loss])

    def _places(self, text: str, new: list[str]) -> list[int]:
        """The places of a text's parts; those seen for the first time are put on the list."""
        place, units = self.place, UNITS.findall(marked(text))
        where = list(map(place.get, units))
        if None not in where:
            return where
        for u in dict.fromkeys(u for u, p in zip(units, where) if p is None):
            parts = self.cuts.get(u)
            if parts is None:
                parts = self.vocabulary.parts(u)
                if len(parts) > 1:
                    self.cuts[u] = parts
            for x in parts:
                if x not in place:
                    place[x] = len(place)
                    new.append(x)
        where = list(map(place.get, units))
        if None in where:
            where = [q for u, p in zip(units, where) for q in ([p] if p is not None else map(place.__getitem__, self.cuts[u]))]
        return where

    def encode(self, texts: list[str]) -> Iterator[list[tuple[float, bytes]]]:
        """The best segmentations (score, ids as 32-bit bytes) of each text, best first."""
        if len(self.place) + len(self.cuts) > KEPT:
            self.forget()
        new: list[str] = []
        split = [self._places(t, new) for t in texts]
        self._learn(new)
        ids = self.ids
        for where in split:
            if not where:
                yield [(0.0, b"")]
                continue
            own = np.array(where, np.int64)
            loss, total = self.loss[own], float(self.score[own].sum())
            few = min(self.best - 1, len(where))
            near = np.argpartition(loss, few - 1)[:few] if few and few < len(where) else np.arange(len(where))[: self.best - 1]
            near = [int(n) for n in sorted(near, key=lambda n: (loss[n], n)) if loss[n] < np.inf]
            parts = list(map(ids.__getitem__, where))
            choices: list[tuple[float, dict[int, bytes]]] = [(0.0, {})]
            for n in near:
                options = self._several(where[n])
                choices = [(d + options[0][0] - s, {**c, n: x} if k else c) for d, c in choices for k, (s, x) in enumerate(options)]
                choices = sorted(choices, key=lambda c: c[0])[: self.best]
            out = []
            for lost, changed in choices:
                for n, x in changed.items():
                    parts[n] = x
                out.append((total - lost, b"".join(parts)))
                for n in changed:
                    parts[n] = ids[where[n]]
            yield out


def decode_ids(vocabulary: Vocabulary, ids: np.ndarray) -> bytes:
    """The text of a sequence of ids, as UTF-8 bytes."""
    whole = b"".join(map(vocabulary.text.__getitem__, ids.tolist()))
    return whole[1:] if whole[:1] == b" " else whole


def _groups(texts: list[str]) -> Iterator[list[str]]:
    group, size = [], 0
    for t in texts:
        group.append(t)
        size += len(t)
        if size >= STEP:
            yield group
            group, size = [], 0
    if group:
        yield group


def encode(docs: DataFrame, text_col: str = "text", model: str = MODEL, best: int = BEST, into: str = "segmentations") -> DataFrame:
    """``docs`` with its text's best segmentations as an array of structs (score, ids), best first.

    There are fewer than ``best`` where the text has fewer. A null or empty text has one, of no pieces and score 0.
    The column replaces one of the same name; all others stay as they are.
    """
    pieces = read_model(model)
    kind = pa.list_(pa.struct([("score", pa.float64()), ("ids", pa.list_(pa.int32()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary(pieces), best)
        for batch in batches:
            at = 0
            for group in _groups([t or "" for t in batch.column(1).to_pylist()]):
                found = [[{"score": s, "ids": np.frombuffer(x, "<i4")} for s, x in f] for f in encoder.encode(group)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(group)), pa.array(found, kind)], ["row", "found"])
                at += len(group)

    rest = [docs[c] for c in docs.columns if c.lower() != into.lower()]
    rows = docs.select(F.struct(*rest).alias("row"), docs[text_col].cast("string").alias("text"))
    row_type = rows.schema["row"].dataType.simpleString()
    done = in_arrow(rows, run, _schema(rows, row_type))
    return done.select("row.*", F.col("found").alias(into))


def _schema(rows: DataFrame, row_type: str):
    from pyspark.sql import types as T

    found = T.ArrayType(T.StructType([T.StructField("score", T.DoubleType()), T.StructField("ids", T.ArrayType(T.IntegerType()))]))
    return T.StructType([rows.schema["row"], T.StructField("found", found)])


def decode(df: DataFrame, ids_col: str = "ids", model: str = MODEL, into: str = "text") -> DataFrame:
    """``df`` with the text of each row's array of ids; null for null ids or ids outside the vocabulary."""
    pieces = read_model(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(pieces)
        for batch in batches:
            out = []
            for ids in batch.column(1).to_pylist():
                fine = ids is not None and all(k is not None and 0 <= k < vocabulary.size for k in ids)
                out.append(decode_ids(vocabulary, np.array(ids, np.int64)).decode("utf-8", "replace") if fine else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["row", "text"])

    from pyspark.sql import types as T

    rest = [df[c] for c in df.columns if c.lower() != into.lower()]
    rows = df.select(F.struct(*rest).alias("row"), df[ids_col].cast("array<int>").alias("ids"))
    done = in_arrow(rows, run, T.StructType([rows.schema["row"], T.StructField("text", T.StringType())]))
    return done.select("row.*", F.col("text").alias(into))


_DIGEST = "doc_id long, n_bytes long, n_pieces long, score double, ids_sha256 string, decoded_sha256 string, round_trip boolean, others string"


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL, best: int = BEST) -> DataFrame:
    """For every row of ``docs``, what its best segmentation and the text decoded from it amount to.

    ``others`` lists score:sha256 of the further ones, best first. A null text counts as empty, which has no pieces.
    Equal texts give equal values; no rows give none.
    """
    pieces = read_model(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(pieces)
        encoder, sha = Encoder(vocabulary, best), lambda b: hashlib.sha256(b).hexdigest()
        for batch in batches:
            at = 0
            for group in _groups([t or "" for t in batch.column(1).to_pylist()]):
                rows = []
                for text, found in zip(group, encoder.encode(group)):
                    score, ids = found[0]
                    raw, back = text.encode(), decode_ids(vocabulary, np.frombuffer(ids, "<i4"))
                    others = ",".join(f"{s:.6f}:{sha(x)}" for s, x in found[1:])
                    rows.append((len(raw), len(ids) // 4, score, sha(ids), sha(back), back == raw, others))
                types = [pa.int64(), pa.int64(), pa.float64(), pa.string(), pa.string(), pa.bool_(), pa.string()]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                names = [p.split()[0] for p in _DIGEST.split(", ")]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(group)), *columns], names)
                at += len(group)

    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return in_arrow(rows, run, _DIGEST)
