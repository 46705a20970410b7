"""SimHash near-duplicates found by multi-index hashing.

A document's fingerprint has 64 bits, each the majority of that bit over the XXH64 hashes of its four-word
shingles. Fingerprints that differ in at most four bits are linked. To find links, a fingerprint is cut into three
segments of 22, 22 and 20 bits. Four differing bits cannot put two into each of the first two segments and one into
the third, so a linked pair agrees in the third segment or differs by at most one bit in one of the others: each
fingerprint is stored under its three segment values and looks up the Hamming ball of radius 1, 1 and 0 around
them. Of a pair that differs in one bit of a segment, only the side that has a zero there looks up the other.

Equal fingerprints are one row in this search, so exact copies never make pairs. A bucket whose rows and look-ups
would make more than ``DENSE`` pairs is not joined pair by pair: both are dealt into blocks, and each pair of blocks
reports only a spanning forest of its links.
"""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, in_arrow, small, written
from .graph import components

BITS, SHINGLE, SEED, DISTANCE = 64, 4, 42, 4
#: (first bit, width, radius) of each segment.
SEGMENTS = ((0, 22, 1), (22, 22, 1), (44, 20, 0))
#: Buckets of at least ``FEW`` rows whose rows and look-ups make more than ``DENSE`` pairs are searched in blocks of
#: ``BLOCK`` rows and look-ups, so what is joined pair by pair stays in proportion to rows and look-ups.
FEW, DENSE, BLOCK = 2, 32, 8192
#: Fingerprints with at least this share of all documents are joined back by broadcast; there are at most 500.
HOT_SHARE = 500
#: Hashes counted together, and bytes of text split together.
_STEP, _BYTES = 4096, 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def word_lists(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text with A-Z lower-cased, in lists of about ``_BYTES`` bytes; ASCII white space parts them."""
    at = 0
    while at < len(text):
        found = _SPACE.search(text, at + _BYTES)
        end = found.start() if found else len(text)
        yield text[at:end].translate(_LOWER).split()
        at = end


def fingerprint(text: bytes) -> int:
    """The 64-bit majority fingerprint of UTF-8 ``text``; zero when it has no word. Long texts are hashed in parts."""
    ones, n, last, digest = np.zeros(BITS, np.int64), 0, [], xxhash.xxh64_intdigest
    for words in word_lists(text):
        w = last + words
        if len(w) >= SHINGLE:
            hashes = [digest(b"%b %b %b %b" % x, SEED) for x in zip(w, w[1:], w[2:], w[3:])]
            ones += _bit_counts(hashes)
            n += len(hashes)
        last = w[1 - SHINGLE :]
    if n == 0 and last:
        ones, n = _bit_counts([digest(b" ".join(last), SEED)]), 1
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def _bit_counts(hashes: list[int]) -> np.ndarray:
    return np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = batch.column("text").cast(pa.large_binary())
        marks = np.fromiter((fingerprint(x.as_py() or b"") for x in text), np.uint64, len(text))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(marks.view(np.int64))], ["doc_id", "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, fp long) for every row of ``docs``; a null text counts as empty."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return in_arrow(rows, _fingerprints, "doc_id long, fp long")


def _segment(first: int, width: int) -> str:
    return f"(shiftrightunsigned(fp, {first}) & {(1 << width) - 1}L)"


def _stored(marks: DataFrame) -> DataFrame:
    keys = [f"struct({k}Y as seg, {_segment(a, w)} as key)" for k, (a, w, _) in enumerate(SEGMENTS)]
    return marks.selectExpr("fp", f"inline(array({', '.join(keys)}))")


def _lookups(marks: DataFrame) -> DataFrame:
    """The segment values each fingerprint looks up: its own, and those with one of their zero bits set."""
    balls = []
    for k, (a, w, radius) in enumerate(SEGMENTS):
        own = _segment(a, w)
        balls.append(f"array(struct({k}Y as seg, {own} as key))")
        if radius:
            flips = f"filter(transform(sequence(0, {w - 1}), i -> shiftleft(1L, i)), b -> ({own} & b) = 0)"
            balls.append(f"transform({flips}, b -> struct({k}Y as seg, {own} | b as key))")
    return marks.selectExpr("fp", f"inline(concat({', '.join(balls)}))")


def forest(marks: np.ndarray, stored: np.ndarray, wanted: np.ndarray, distance: int = DISTANCE) -> list[tuple[int, int]]:
    """Pairs of rows that join the same rows as all links between ``stored`` and ``wanted`` rows would.

    ``marks`` is (rows, words of 64 bits); there is at most one pair fewer than rows. A stored row is compared only
    with wanted rows that aren't joined to it yet, so a tight group takes one comparison with each of its rows, and
    what is compared further are the rows that stand apart.
    """
    group, links = np.arange(len(marks)), []
    for i in stored:
        apart = wanted[group[wanted] != group[i]]
        far = np.bitwise_count(marks[apart] ^ marks[i]).sum(axis=1, dtype=np.int64)
        near = apart[far <= distance]
        if len(near):
            joined, first = np.unique(group[near], return_index=True)
            links += [(int(i), int(j)) for j in near[first]]
            group[np.isin(group, joined)] = group[i]
    return links


def _forest_of(distance: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        one = rows.drop_duplicates("node").sort_values("node")
        node = one["node"].to_numpy(np.int64)
        marks = np.stack([np.asarray(m, np.int64) for m in one["mark"]]).view(np.uint64)
        place = np.searchsorted(node, rows["node"].to_numpy(np.int64))
        asks = rows["asks"].to_numpy(bool)
        pairs = node[np.array(forest(marks, np.unique(place[~asks]), np.unique(place[asks]), distance), np.int64).reshape(-1, 2)]
        return pd.DataFrame({"a": pairs.min(axis=1), "b": pairs.max(axis=1)})

    return run


def _dense(stored: DataFrame, wanted: DataFrame) -> DataFrame:
    """(seg, key, n, m) of buckets of ``FEW`` rows and more whose n rows and m look-ups make over ``DENSE`` pairs."""
    sizes = small(cut(stored.groupBy("seg", "key").agg(F.count("*").alias("n")).where(F.col("n") >= FEW)))
    asked = wanted.select("seg", "key").join(sizes, ["seg", "key"]).groupBy("seg", "key")
    asked = asked.agg(F.first("n").alias("n"), F.count("*").alias("m"))
    return small(cut(asked.where(F.col("n") * F.col("m") > DENSE)))


def _crowded(stored: DataFrame, wanted: DataFrame, dense: DataFrame, marks: DataFrame, distance: int) -> DataFrame:
    """(a, b): links of dense buckets. Rows and look-ups are dealt into blocks, and every block of rows meets every
    block of look-ups once. ``marks`` is (node, mark), the words of the bits that are compared."""
    parts = dense.selectExpr("seg", "key", f"cast(ceil(n / {BLOCK}) as int) as rows", f"cast(ceil(m / {BLOCK}) as int) as asks_in")
    deal = "cast(pmod(xxhash64(node), {}) as int) as {}"
    every = "explode(sequence(0, {} - 1)) as {}"
    left = stored.join(parts, ["seg", "key"]).selectExpr("seg", "key", "node", "false as asks", deal.format("rows", "p"), every.format("asks_in", "q"))
    right = wanted.join(parts, ["seg", "key"]).selectExpr("seg", "key", "node", "true as asks", every.format("rows", "p"), deal.format("asks_in", "q"))
    met = left.unionByName(right).join(marks, "node")
    return met.groupBy("seg", "key", "p", "q").applyInPandas(_forest_of(distance), "a long, b long")


def _ordered(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def links(marks: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b), a < b: links between the distinct fingerprints ``marks`` (fp) that join all that are linked."""
    stored, wanted = cut(_stored(marks)), _lookups(marks)
    dense = _dense(stored, wanted)
    thin = stored.join(dense, ["seg", "key"], "left_anti").withColumnRenamed("fp", "other")
    met = wanted.join(thin, ["seg", "key"]).where(f"fp != other and bit_count(fp ^ other) <= {distance}")
    own = marks.select(F.col("fp").alias("node"), F.array("fp").alias("mark"))
    return met.select(*_ordered("fp", "other")).union(
        _crowded(stored.withColumnRenamed("fp", "node"), wanted.withColumnRenamed("fp", "node"), dense, own, distance)
    )


def _components_of(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """``rows`` (doc_id, node, ...) with the smallest doc_id of their component of nodes.

    Nodes with a large share of all rows are joined back by broadcast; there are at most ``HOT_SHARE`` of them.
    """
    marks = cut(rows.groupBy("node").agg(F.min("doc_id").alias("low"), F.count("*").alias("n")))
    roots = components(edges)
    joined = marks.join(roots, "node")
    lows = joined.groupBy("root").agg(F.min("low").alias("component_id"))
    joined = joined.join(lows, "root").select("node", "component_id", "n")
    single = marks.join(roots, "node", "left_anti").select("node", F.col("low").alias("component_id"), "n")
    known = cut(joined.union(single.where("n > 1")))
    total = marks.agg(F.sum("n")).first()[0] or 0
    least = max(2, -(-total // HOT_SHARE))
    hot = F.broadcast(known.where(F.col("n") >= least).drop("n"))
    rest = rows.join(hot.select("node"), "node", "left_anti").join(known.where(F.col("n") < least).drop("n"), "node", "left")
    rest = rest.withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return rows.join(hot, "node").unionByName(rest)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    component_id is the smallest document id reachable through links, the row's own included. Null or empty texts
    have the zero fingerprint and are linked like any other. Repeated rows give repeated results. Rows with a null
    id keep it and take their component's smallest id, null if it has none. No rows give no rows.
    """
    rows = cut(fingerprints(docs, id_col, text_col))
    edges = links(cut(rows.select("fp").distinct()))
    out = _components_of(rows.withColumnRenamed("fp", "node"), edges)
    return out.select("doc_id", F.lower(F.lpad(F.hex("node"), 16, "0")).alias("fingerprint"), "component_id")


#: Words in a shingle of the similarity search, the seed of its hash, and words of 64 bits in its fingerprint.
GRAM, _GRAM_SEED, WORDS = 5, 9, 4
#: Shingles that at least ``FREQUENT`` texts, and one in ``RARE_SHARE`` of all, have in their prefix are ordered by
#: their number of texts, behind all others. A prefix has about a fifth of a text's shingles, so there are at most as
#: many frequent ones as ``RARE_SHARE`` texts have in their prefixes. Texts are counted for each ``HELD`` shingles of a
#: partition, where those of one text don't count: the order need only be roughly by number, and the same for all.
FREQUENT, RARE_SHARE, HELD = 16, 5000, 1 << 20
#: Fingerprints and shingles that are compared in one block with as many others; bits of the largest map of wanted texts.
NEAR, SETS, MAP_BITS = 4096, 1 << 18, 1 << 27
#: Standard deviations that a distance may lie above what its similarity makes likely.
SIGMAS = 6.5
_MIX = 0x9E3779B97F4A7C15
_TURNS = np.array([(_MIX * (2 * k + 1)) & ((1 << 64) - 1) for k in range(1, 64)], np.uint64)
_BITS_OF = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def long_fingerprints(text: bytes) -> tuple[int, bytes]:
    """(mark, shingles) of UTF-8 ``text``: the sorted 64-bit hashes of its distinct five-word shingles, and their hash.

    A text of fewer words has one shingle, a text without words none.
    """
    grams, last, digest = set(), [], xxhash.xxh64_intdigest
    for words in word_lists(text):
        last += words
        grams.update(digest(b" ".join(last[k : k + GRAM]), _GRAM_SEED) for k in range(len(last) - GRAM + 1))
        last = last[1 - GRAM :]
    if not grams and last:
        grams.add(digest(b" ".join(last), _GRAM_SEED))
    shingles = np.sort(np.fromiter(grams, np.uint64, len(grams)).view(np.int64)).tobytes()
    return int(np.uint64(digest(shingles, _GRAM_SEED)).view(np.int64)), shingles


def majority(shingles: np.ndarray, words: int = WORDS) -> np.ndarray:
    """The fingerprint of a set of 64-bit hashes, as ``words`` signed words: the majority of each bit of the hashes and
    of what further multiplications make of them."""
    n, columns = len(shingles), 8 * words
    votes = np.zeros(columns * 256, np.int64)
    for at in range(0, n, _STEP):
        h = shingles[at : at + _STEP, None].view(np.uint64) * _TURNS[None, :words]
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        own = h.view(np.uint8) + (np.arange(columns) * 256)[None, :]
        votes += np.bincount(own.ravel(), minlength=columns * 256)
    return np.packbits((votes.reshape(columns, 256) @ _BITS_OF) * 2 > n).view(np.int64)


def farthest(similarity: float, bits: int = 64 * WORDS) -> int:
    """The most differing bits that fingerprints of sets of this Jaccard similarity have, but for one pair in 10^10.

    A bit differs with the angle of the two sets over pi; in sets of a few hashes, whose votes tie often, with up to
    3 / 16 at a similarity of 0.8, a quarter more.
    """
    share = 1.25 * math.acos(2 * similarity / (1 + similarity)) / math.pi
    return math.ceil(bits * share + SIGMAS * math.sqrt(bits * share * (1 - share)))


def _prefixes(similarity: float, frequent: np.ndarray, texts_with: np.ndarray):
    """An Arrow function to (doc_id, node, n, mark, prefix): sets that are similar share a shingle of their prefixes.

    A set's shingles are ordered by how many texts have them and by hash; the first n - ceil(similarity n) + 1 are
    its prefix. ``frequent`` is sorted; shingles that are not in it count as rare.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = lambda arrays: pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, arrays)]), pa.int32()), pa.array(np.concatenate([*arrays, np.empty(0, np.int64)])))
        for batch in batches:
            nodes, sizes, marks, prefixes = [], [], [], []
            for x in batch.column("text").cast(pa.large_binary()):
                node, shingles = long_fingerprints(x.as_py() or b"")
                own = np.frombuffer(shingles, np.int64)
                n = len(own)
                order = np.argsort(own.view(np.uint64) * np.uint64(_MIX))
                if len(frequent):
                    at = np.minimum(np.searchsorted(frequent, own), len(frequent) - 1)
                    order = order[np.argsort(np.where(frequent[at] == own, texts_with[at], 0)[order], kind="stable")]
                nodes.append(node)
                sizes.append(n)
                marks.append(majority(own))
                prefixes.append(own[order[: n - math.ceil(similarity * n - 1e-9) + 1 if n else 0]])
            names = ["doc_id", "node", "n", "mark", "prefix"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int32()), listed(marks), listed(prefixes)], names)

    return run


def _often(similarity: float):
    """An Arrow function to (key, c): shingles that several prefixes of a partition have, and how many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                for x in batch.column("text").cast(pa.large_binary()):
                    own = np.frombuffer(long_fingerprints(x.as_py() or b"")[1], np.int64)
                    n = len(own)
                    parts.append(own[np.argsort(own.view(np.uint64) * np.uint64(_MIX))][: n - math.ceil(similarity * n - 1e-9) + 1 if n else 0])
                    held += len(parts[-1])
            if parts and (batch is None or held >= HELD):
                key, c = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key[c > 1]), pa.array(c[c > 1].astype(np.int64))], ["key", "c"])
                parts, held = [], 0

    return run


def _sets(wanted: np.ndarray, bits: int):
    """An Arrow function to (node, shingles) of the texts on the map ``wanted``, each at most once a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            nodes, sets = [], []
            for x in batch.column("text").cast(pa.large_binary()):
                node, shingles = long_fingerprints(x.as_py() or b"")
                at = node & bits - 1
                if wanted[at >> 3] >> (at & 7) & 1 and node not in seen:
                    seen.add(node)
                    nodes.append(node)
                    sets.append(np.frombuffer(shingles, np.int64))
            flat = np.concatenate([*sets, np.empty(0, np.int64)])
            listed = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, sets)]), pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), listed], ["node", "shingles"])

    return run


def _bits_of(nodes: DataFrame, column: str) -> tuple[DataFrame, int]:
    """(part, set): a map with the bit of each of ``nodes`` set, by its last bits, in parts of 32,768 bits; and its length,
    at most ``MAP_BITS`` bits whatever their number."""
    bits = min(MAP_BITS, 1 << max(15, (32 * nodes.count()).bit_length()))
    at = nodes.select((F.col(column).bitwiseAND(F.lit(bits - 1))).alias("at"))
    return at.groupBy(F.expr("at div 32768").alias("part")).agg(F.bitmap_construct_agg(F.col("at") % 32768).alias("set")), bits


def _map_of(nodes: DataFrame, column: str = "node") -> tuple[np.ndarray, int]:
    """The map of ``nodes`` as bytes."""
    parts, bits = _bits_of(nodes, column)
    out = np.zeros(bits // 8, np.uint8)
    for part, own in parts.collect():
        out[part * 4096 : (part + 1) * 4096] = np.frombuffer(own, np.uint8)
    return out, bits


def _on_map(wanted: np.ndarray, bits: int):
    """An Arrow function to (key, node, m0, ...) of the prefixes' shingles that are on the map ``wanted``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("prefix")
            key = lists.flatten().to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(len(batch)), np.diff(lists.offsets.to_numpy()))
            at = key & bits - 1
            on = (wanted[at >> 3] >> (at & 7) & 1).astype(bool)
            marks = batch.column("mark").flatten().to_numpy(zero_copy_only=False).reshape(-1, WORDS)[owner[on]]
            node = batch.column("node").to_numpy(zero_copy_only=False)[owner[on]]
            columns = [pa.array(key[on]), pa.array(node), *(pa.array(np.ascontiguousarray(marks[:, k])) for k in range(WORDS))]
            yield pa.RecordBatch.from_arrays(columns, ["key", "node", *_MARK])

    return run


_MARK = [f"m{k}" for k in range(WORDS)]
_DIFFER = " + ".join(f"bit_count({m} ^ other_{m})" for m in _MARK)


def _known(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, shingles) of the distinct nodes ``wanted``."""
    found = in_arrow(texts.select("text"), _sets(*_map_of(wanted)), "node long, shingles array<bigint>")
    return written(found.dropDuplicates(["node"]).join(wanted, "node", "left_semi"), "sets")


def set_forest(sets: list[np.ndarray], stored: np.ndarray, wanted: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """Pairs of rows that join the same rows as all links between ``stored`` and ``wanted`` rows would. Shared elements
    are counted over lists of the rows of each."""
    sizes, group, links = np.array([len(s) for s in sets]), np.arange(len(sets)), []
    _, element = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    holders = np.repeat(np.arange(len(sets)), sizes)[np.argsort(element, kind="stable")]
    firsts = np.concatenate([[0], np.cumsum(np.bincount(element))])
    for i in stored:
        apart = wanted[group[wanted] != group[i]]
        apart = apart[(sizes[apart] >= similarity * sizes[i] - 1e-9) & (sizes[i] >= similarity * sizes[apart] - 1e-9)]
        if len(apart):
            own = element[starts[i] : starts[i + 1]]
            both = np.bincount(np.concatenate([holders[firsts[e] : firsts[e + 1]] for e in own]), minlength=len(sets))[apart]
            near = apart[both / (sizes[i] + sizes[apart] - both) >= similarity]
            joined, first = np.unique(group[near], return_index=True)
            links += [(int(i), int(j)) for j in near[first]]
            group[np.isin(group, joined)] = group[i]
    return links


def _set_forest_of(similarity: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        one = rows.drop_duplicates("node").sort_values("node")
        node = one["node"].to_numpy(np.int64)
        place, asks = np.searchsorted(node, rows["node"].to_numpy(np.int64)), rows["asks"].to_numpy(bool)
        sets = [np.asarray(x, np.int64) for x in one["shingles"]]
        pairs = node[np.array(set_forest(sets, np.unique(place[~asks]), np.unique(place[asks]), similarity), np.int64).reshape(-1, 2)]
        return pd.DataFrame({"a": pairs.min(axis=1), "b": pairs.max(axis=1)})

    return run


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """``rows`` (key, node, n, ...) with asks, p and q, dealt so that any two of a key meet in a block (key, p, q), where
    rows that don't ask are held against rows that do. The n of a block's rows of either kind sum up to about ``size``."""
    sizes = rows.groupBy("key").agg(F.ceil(F.sum("n") / size).cast("int").alias("_parts"))
    own = rows.join(sizes.where("_parts > 0"), "key").withColumn("_own", F.expr("cast(pmod(xxhash64(node), _parts) as int)"))
    every = F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))
    left = own.select(*rows.columns, F.lit(False).alias("asks"), F.col("_own").alias("p"), every.alias("q")).where("p <= q")
    right = own.select(*rows.columns, F.lit(True).alias("asks"), every.alias("p"), F.col("_own").alias("q")).where("p <= q")
    return left.unionByName(right)


def _meeting(stored: DataFrame, similarity: float) -> DataFrame:
    """(a, b): pairs that connect all that share a shingle of their prefixes and have near fingerprints.

    ``stored`` is (key, node, m0, ...). Keys of up to ``DENSE`` texts give their near pairs; those of more are compared in
    blocks, each of which gives a spanning forest.
    """
    sizes = written(stored.groupBy("key").agg(F.count("*").alias("m")).where("m > 1"), "sizes")
    thin = stored.join(sizes.where(F.col("m") <= DENSE).select("key"), "key")
    other = thin.select("key", *(F.col(c).alias(f"other_{c}") for c in ("node", *_MARK)))
    near_by = F.expr(f"node < other_node and {_DIFFER} <= {farthest(similarity)}")
    pairs = thin.join(other, (thin["key"] == other["key"]) & near_by).select(F.col("node").alias("a"), F.col("other_node").alias("b"))
    dense = stored.join(sizes.where(F.col("m") > DENSE).select("key"), "key").select("key", "node", F.lit(1).alias("n"), *_MARK)
    return pairs.union(_blocks(dense, NEAR).groupBy("key", "p", "q").applyInPandas(_mark_forest_of(farthest(similarity)), "a long, b long")).distinct()


def _mark_forest_of(distance: int):
    run = _forest_of(distance)
    return lambda rows: run(rows.assign(mark=list(rows[_MARK].to_numpy(np.int64))))


def _close(nodes: DataFrame) -> DataFrame:
    """(a, b): nodes whose first 64 bits differ in at most ``DISTANCE`` places, as many as join all such, found by
    multi-index hashing. ``nodes`` is (node, mark)."""
    first = nodes.select("node", F.get("mark", F.lit(0)).alias("fp"))
    low = cut(first.groupBy("fp").agg(F.min("node").alias("low")))
    same = first.join(low, "fp").where("node != low").select(F.col("low").alias("a"), F.col("node").alias("b"))
    ends = links(low.select("fp"))
    ends = ends.join(low.toDF("a", "low_a"), "a").join(low.toDF("b", "low_b"), "b")
    return same.union(ends.select(*_ordered("low_a", "low_b"))).distinct()


def similar(docs: DataFrame, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, component_id) for every row of ``docs``: groups of texts linked by similar sets of five-word shingles.

    Two texts are linked if and only if their sets have a Jaccard similarity of at least ``similarity``, but for
    collisions of 64-bit hashes and one pair in 10^10 (see ``farthest``). Multi-index hashing of the sets' fingerprints
    finds the closest texts. A fixed distance of 64 bits can't find all pairs of the similarity, so texts also meet by a
    shingle of their prefixes, which similar sets share, and by the complete distance of fingerprints of ``WORDS`` words.
    What has met makes families, and within a family every link is settled by the exact similarity, in blocks, each of
    which gives a spanning forest of its links. Equal sets are one node. Null, empty and repeated rows count as in
    ``near_duplicates``.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    columns = "doc_id long, node long, n int, mark array<bigint>, prefix array<bigint>"
    counts = in_arrow(texts.select("text"), _often(similarity), "key long, c long").groupBy("key").agg(F.sum("c").alias("c")).where(F.col("c") >= FREQUENT)
    least = max(FREQUENT, docs.count() // RARE_SHARE)
    got = sorted(map(tuple, counts.where(F.col("c") >= least).collect()))
    frequent = np.array(got, np.int64).reshape(-1, 2)
    rows = written(in_arrow(texts, _prefixes(similarity, frequent[:, 0].copy(), frequent[:, 1].copy()), columns), "prefixes")
    nodes = written(rows.drop("doc_id").dropDuplicates(["node"]), "nodes")
    keys = nodes.select(F.explode("prefix").alias("key")).groupBy("key").agg(F.count("*").alias("m")).where("m > 1").select("key")
    stored = in_arrow(nodes.select("node", "mark", "prefix"), _on_map(*_map_of(written(keys, "keys"), "key")), f"key long, node long, {', '.join(f'{m} long' for m in _MARK)}")
    met = cut(_close(nodes.select("node", "mark")).union(_meeting(stored, similarity)))
    families = cut(components(met))
    known = _known(texts, families.select("node"))
    members = families.join(known, "node").select(F.col("root").alias("key"), "node", F.size("shingles").alias("n"), "shingles")
    linked = _blocks(members, SETS).groupBy("key", "p", "q").applyInPandas(_set_forest_of(similarity), "a long, b long")
    return _components_of(rows.select("doc_id", "node"), cut(linked)).select("doc_id", "component_id")


def keep_one(docs: DataFrame, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without all but the smallest document id of each group of ``similar`` texts.

    Rows that repeat the id that stays are reduced to one; rows with a null id stay, as none of them can be told
    to be the copy of another. Rows whose id is on no map of the ids that go or repeat stay where they are; only the others
    are joined, so that most texts are not shuffled.
    """
    groups = similar(docs, similarity, id_col, text_col).groupBy("doc_id").agg(F.count("*").alias("rows"), F.max(F.col("doc_id") == F.col("component_id")).alias("stays"))
    marked = cut(groups.where("doc_id is not null and (not stays or rows > 1)").withColumn("hash", F.xxhash64("doc_id")))
    parts, bits = _bits_of(marked, "hash")
    parts = F.broadcast(cut(parts.select(F.col("part").alias("_part"), F.col("set").alias("_set"))))
    at = F.xxhash64(docs[id_col].cast("long")).bitwiseAND(F.lit(bits - 1))
    placed = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("_row"), docs[id_col].cast("long").alias("_id"), at.alias("_at"), F.floor(at / 32768).alias("_part"))
    byte = F.conv(F.hex(F.expr("substring(_set, cast((_at % 32768) div 8 as int) + 1, 1)")), 16, 10).cast("int")
    placed = placed.join(parts, "_part", "left").withColumn("_on", F.coalesce(F.col("_id").isNotNull() & (F.expr("1 << cast(_at % 8 as int)").bitwiseAND(byte) != 0), F.lit(False)))
    odd = placed.where("_on").join(marked.select(F.col("doc_id").alias("_id"), "rows", "stays"), "_id", "left").where("stays is null or stays")
    once = odd.where("rows > 1").dropDuplicates(["_id"]).unionByName(odd.where("rows is null or rows = 1"))
    return placed.where("not _on").select("_row.*").unionByName(once.select("_row.*"))
