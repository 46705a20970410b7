"""Quality by importance resampling: hashed n-gram models of target and raw text, sampled by Gumbel top-k.

A text is a bag of hashed n-grams of two views: its words (1 and 2 in a row), and their shapes (1 to 3 in a row),
where a shape says which kinds of characters a word has, how long it is and whether it repeats one of the two words
before. The target model counts the n-grams of labelled good rows, the raw model those of all rows. A row's log weight
is the mean of its n-grams' log ratios, less the cut that best parts good from bad labelled rows, over a temperature: the
sum itself grows with the length of a text and would leave nothing to chance. A sample of a given size is drawn without
replacement by Gumbel top-k: the rows of the largest log weight plus standard Gumbel noise. The default size is the number
of rows above the cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, in_arrow

#: Hash cells of the words' and of the shapes' n-grams; added counts for smoothing.
WORD_CELLS, SHAPE_CELLS, ADDED = 1 << 16, 1 << 13, 1.0
CELLS = WORD_CELLS + SHAPE_CELLS
#: At most so many labelled rows of each label, by hash of the id, fit the target model and the cut.
FIT_ROWS = 4000
SEED = 11
#: How much worse it is to lose a good row than to keep a bad one, and the temperature: a mean log ratio that lies so far
#: above another makes a row e times as likely to be drawn.
LOSS, TEMPERATURE = 3.0, 0.2
#: Bytes hashed together.
STEP = 1 << 19

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Bits of a byte's kind: lower-case letter or part of a non-ASCII one, capital, digit, sentence mark, other mark.
_KIND = np.full(256, 16, np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = 0
_KIND[97:123] = 1
_KIND[128:] = 1
_KIND[65:91] = 2
_KIND[48:58] = 4
_KIND[[ord(c) for c in ".,;:?!'\"()-"]] = 8
_PRIME = 0x9E3779B97F4A7C15
_INVERSE = pow(_PRIME, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, hash, shape) of each word of a buffer."""
    space = _SPACE[data]
    start = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    stop = np.flatnonzero(~space & np.concatenate([space[1:], [True]])) + 1
    if not len(start):
        return start, start.astype(np.uint64), start.astype(np.uint64)
    up, down = _powers(_PRIME, len(data)), _powers(_INVERSE, len(data))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up, dtype=np.uint64)])
    hashes = _mix((sums[stop] - sums[start]) * down[start])
    kind = _KIND[data]
    kinds = np.bitwise_or.reduceat(kind, start)
    marks = np.add.reduceat((kind == 16).astype(np.int32), start) + np.add.reduceat((data == 33).astype(np.int32), start)
    capitals = np.add.reduceat((kind == 2).astype(np.int32), start)
    length = stop - start
    size = np.searchsorted([2, 4, 8, 13, 21], length, side="right")
    shape = kinds.astype(np.uint64) | (np.minimum(marks, 3).astype(np.uint64) << np.uint64(5)) | (np.minimum(capitals, 2).astype(np.uint64) << np.uint64(7)) | (size.astype(np.uint64) << np.uint64(9))
    return start, hashes, shape


def _pieces(texts: list[bytes]) -> Iterator[tuple[bytes, np.ndarray, np.ndarray]]:
    """Buffers of about ``STEP`` bytes, with the offset and the number of the text that each part is of.

    Long texts are cut at white space, or in a word of more than ``STEP`` bytes.
    """
    buffer, offsets, owners, size = [], [], [], 0
    for n, text in enumerate(texts):
        at = 0
        while at < len(text):
            end = len(text)
            if end - at > STEP:
                end = at + STEP
                space = max(text.rfind(c, at + 1, end) for c in (b" ", b"\n", b"\t"))
                end = space if space > at else end
            buffer.append(text[at:end])
            offsets.append(size)
            owners.append(n)
            size += end - at + 1
            at = end
            if size >= STEP:
                yield b"\n".join(buffer), np.array(offsets), np.array(owners)
                buffer, offsets, owners, size = [], [], [], 0
    if buffer:
        yield b"\n".join(buffer), np.array(offsets), np.array(owners)


def grams(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(number of the text, cell) arrays of all n-grams of ``texts``, those of neighbouring texts together."""
    tail = (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64))
    for data, offsets, owners in _pieces(texts):
        start, words, shape = _words(np.frombuffer(data, np.uint8))
        owner = owners[np.searchsorted(offsets, start, side="right") - 1]
        # Words carried over from the buffer before only begin n-grams; a text that goes on is seamless.
        old = len(tail[0])
        owner, words, shape = (np.concatenate([a, b]) for a, b in zip(tail, (owner, words, shape)))
        if len(owner) == 0:
            continue
        same1 = np.concatenate([[False], owner[1:] == owner[:-1]])
        same2 = np.concatenate([[False, False], owner[2:] == owner[:-2]])[: len(owner)]
        again = (same1 & (words == np.roll(words, 1))) | (same2 & (words == np.roll(words, 2)))
        shape = shape & np.uint64(0xFFF) | (again.astype(np.uint64) << np.uint64(12))
        shape[:old] = tail[2] & np.uint64(0x1FFF)
        one, two = np.roll(shape, 1), np.roll(shape, 2)
        views = [
            (words, None, WORD_CELLS, 0),
            (_mix(words * np.uint64(3) + np.roll(words, 1)), same1, WORD_CELLS, 0),
            (_mix(shape + np.uint64(1)), None, SHAPE_CELLS, WORD_CELLS),
            (_mix(shape + one * np.uint64(1 << 16) + np.uint64(1 << 40)), same1, SHAPE_CELLS, WORD_CELLS),
            (_mix(shape + one * np.uint64(1 << 16) + two * np.uint64(1 << 32) + np.uint64(1 << 50)), same2, SHAPE_CELLS, WORD_CELLS),
        ]
        new = np.arange(len(owner)) >= old
        for values, whole, cells, base in views:
            keep = new if whole is None else new & whole
            yield owner[keep], ((values[keep] >> np.uint64(20)) % np.uint64(cells)).astype(np.int64) + base
        tail = owner[-2:], words[-2:], shape[-2:]


def _texts(column: pa.Array) -> list[bytes]:
    return [t.as_py() or b"" for t in column.cast(pa.large_binary())]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(CELLS, np.int64)
    for batch in batches:
        for _, cells in grams(_texts(batch.column(0))):
            total += np.bincount(cells, minlength=CELLS)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["cell", "n"])


def counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """How often each cell occurs in all rows; the result has a fixed number of cells."""
    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    got = in_arrow(texts, _count, "cell int, n long")
    out = np.zeros(CELLS)
    for cell, n in got.groupBy("cell").agg(F.sum("n")).collect():
        out[cell] = n
    return out


def _scorer(ratio: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, total = np.zeros(len(batch), np.int64), np.zeros(len(batch))
            for owner, cells in grams(_texts(batch.column("_text"))):
                n += np.bincount(owner, minlength=len(batch))
                total += np.bincount(owner, weights=ratio[cells], minlength=len(batch))
            rest = [batch.column(k) for k in range(batch.num_columns - 1)]
            names = batch.schema.names[:-1]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(n), pa.array(total)], [*names, "_n", "_sum"])

    return run


def _scored(docs: DataFrame, text: Column, ratio: np.ndarray) -> DataFrame:
    """``docs`` and _n, _sum: the number of n-grams and the sum of their log ratios."""
    rows = docs.withColumn("_text", text.cast("string"))
    schema = docs.withColumn("_n", F.lit(0).cast("long")).withColumn("_sum", F.lit(0.0)).schema
    return in_arrow(rows, _scorer(ratio), schema)


def best_cut(good: np.ndarray, bad: np.ndarray) -> float:
    """The value that best parts ``good`` from ``bad``, midway between neighbours: the least sum of both error shares,
    that of the good ones counted ``LOSS`` times.

    Without both kinds there is nothing to part: minus infinity, which keeps all.
    """
    if not len(good) or not len(bad):
        return -np.inf
    values = np.unique(np.concatenate([good, bad]))
    lost = np.searchsorted(np.sort(good), values) / len(good)
    passed = 1 - np.searchsorted(np.sort(bad), values) / len(bad)
    k = int(np.argmin(LOSS * lost + passed))
    return float((values[k - 1] + values[k]) / 2) if k else -np.inf


class Model:
    """Log ratio of each cell, and the cut on their mean."""

    def __init__(self, ratio: np.ndarray, limit: float):
        self.ratio, self.limit = ratio, limit


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """The model of ``docs`` and of the labelled rows among them, of which at most ``FIT_ROWS`` of each label count.

    Labels other than 0 and 1 don't count. Without good rows all ratios are zero.
    """
    sampled = []
    for label in (1, 0):
        own = labels.where(F.col(label_col) == label).select(F.col(id_col).alias("_id")).distinct()
        sampled.append(own.orderBy(F.xxhash64("_id", F.lit(SEED)), "_id").limit(FIT_ROWS).withColumn("_label", F.lit(label)))
    chosen = F.broadcast(cut(sampled[0].unionByName(sampled[1])))
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text"))
    known = rows.join(chosen, "_id")
    target, raw = counts(known.where("_label = 1")), counts(docs, text_col)
    ratio = np.zeros(CELLS)
    if target.sum():
        for part in (slice(0, WORD_CELLS), slice(WORD_CELLS, CELLS)):
            p, q = target[part] + ADDED, raw[part] + ADDED * raw[part].sum() / max(1.0, target[part].sum())
            ratio[part] = np.log(p / p.sum()) - np.log(q / q.sum())
    scored = _scored(known.select("_id", "_label", "text"), F.col("text"), ratio).where("_n > 0").groupBy("_id", "_label")
    means = scored.agg((F.sum("_sum") / F.sum("_n")).alias("mean")).select("_label", "mean")
    got = np.array([tuple(r) for r in means.collect()], float).reshape(-1, 2)  # at most 2 * FIT_ROWS ids
    return Model(ratio, best_cut(got[got[:, 0] == 1, 1], got[got[:, 0] == 0, 1]))


def gumbel(key: Column, seed: int = SEED) -> Column:
    """Standard Gumbel noise of a hash of ``key``."""
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(seed)), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(-F.log(u))


def kth_largest(df: DataFrame, value: str, k: int) -> float | None:
    """The k-th largest of a column of doubles, exactly; None if there are fewer.

    Each round counts the values in 65,536 cells of the range that is left and goes on in the cell of the k-th, so the
    driver gets that many counts at most, and a few rounds suffice.
    """
    low, high = df.agg(F.min(value), F.max(value)).first()
    if k <= 0 or low is None:
        return None
    rest = k
    while True:
        if low == high:
            return low
        width = (high - low) / 65536
        cell = F.least(F.floor((F.col(value) - F.lit(low)) / F.lit(width)).cast("int"), F.lit(65535)) if width > 0 else (F.col(value) > low).cast("int")
        inside = df.where((F.col(value) >= F.lit(low)) & (F.col(value) <= F.lit(high)))
        found = inside.groupBy(cell.alias("cell")).agg(F.count("*").alias("n"), F.min(value).alias("a"), F.max(value).alias("b")).collect()
        for row in sorted(found, key=lambda r: -r["cell"]):
            if rest <= row["n"]:
                low, high = row["a"], row["b"]
                break
            rest -= row["n"]
        else:
            return None


def weighed(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", temperature: float = TEMPERATURE, seed: int = SEED) -> DataFrame:
    """``docs`` with _n, _weight (its log importance weight) and _key (that plus standard Gumbel noise).

    A row without words weighs nothing: its weight and key are null.
    """
    limit = model.limit if np.isfinite(model.limit) else -1e6
    scored = _scored(docs, F.col(text_col), model.ratio)
    weight = F.when(F.col("_n") > 0, (F.col("_sum") / F.col("_n") - F.lit(float(limit))) / F.lit(temperature))
    return scored.withColumn("_weight", weight).withColumn("_key", F.col("_weight") + gumbel(F.col(id_col), seed)).drop("_sum")


def rows_of(docs: DataFrame, id_col: str, text_col: str) -> list[Column]:
    return [docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text")]


def _last(keys: DataFrame, size: int | None) -> float:
    """The smallest key that is sampled, of ``size`` or of as many as lie above the cut."""
    k = keys.where("_weight >= 0").count() if size is None else size
    last = kth_largest(keys.where("_key is not null"), "_key", k)
    return last if last is not None else float("inf") if k <= 0 else float("-inf")


def resampled(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int | None = None, temperature: float = TEMPERATURE, seed: int = SEED) -> DataFrame:
    """(doc_id, n_grams, log_weight, key, kept) for every row of ``docs``.

    ``size`` rows are sampled, all with a word if there are fewer. Null and empty texts have no n-gram, a null weight and
    are not kept. Rows that tie with the last one sampled are kept as well. Repeated rows have equal keys. Without labels
    of both kinds every row lies above the cut.
    """
    model = fit(docs, labels, id_col, text_col)
    keys = cut(weighed(docs.select(*rows_of(docs, id_col, text_col)), model, temperature=temperature, seed=seed).drop("text"))
    kept = F.coalesce(F.col("_key") >= _last(keys, size), F.lit(False))
    return keys.select("doc_id", F.col("_n").alias("n_grams"), F.col("_weight").alias("log_weight"), F.col("_key").alias("key"), kept.alias("kept"))


def sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int | None = None, temperature: float = TEMPERATURE, seed: int = SEED) -> DataFrame:
    """The rows of ``docs`` that importance resampling keeps, with their own columns.

    Texts are scored twice instead of being shuffled: once for the last key sampled, once to hold them against it.
    """
    model = fit(docs, labels, id_col, text_col)
    last = _last(cut(weighed(docs.select(*rows_of(docs, id_col, text_col)), model, temperature=temperature, seed=seed).drop("text")), size)
    whole = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), *(rows_of(docs, id_col, text_col)))
    return weighed(whole, model, temperature=temperature, seed=seed).where(F.col("_key") >= last).select("row.*")
