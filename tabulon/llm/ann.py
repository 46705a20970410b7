"""Approximate nearest neighbours by cross-polytope hashing.

Each table turns unit vectors by a pseudo-rotation (three rounds of random signs and a fast Hadamard transform) and
assigns them to the nearest signed axis. Where there are so many vectors that a bucket for each axis would hold more than
``STORED``, several rotations make up a table and a bucket stands for an axis of each. Every vector is stored in one bucket
of each table; a query looks into the buckets of the axes nearest to it, those of one hash or the best combinations of
several. All that it meets is ranked by exact cosine.

Buckets are searched in blocks of bounded size, vectors against queries, and only each block's best leave it. Equal
query vectors are searched once. Of equal stored vectors the ``k + 1`` smallest ids are kept, as no other can be
among the ``k`` nearest of any query. A query that met too few vectors is searched against all, in blocks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, lookup, small

#: Tables and probes of a table, by the number of hashes in one; the last entry stands for more.
SIZES, SEED = ((8, 16), (16, 128), (32, 1024)), 20
#: Vectors and queries that meet in one task.
STORED, ASKED = 4096, 1024
#: Scores this near the last place are settled by the exact measure.
SLACK = 1e-9


def hadamard(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of each row; the width is a power of two."""
    n, width = x.shape
    step = 1
    while step < width:
        y = x.reshape(n, -1, 2, step)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, width)
        step *= 2
    return x


def rotated(x: np.ndarray, table: int) -> np.ndarray:
    """Rows padded to a power of two and pseudo-rotated for ``table``."""
    width = 1 << max(0, x.shape[1] - 1).bit_length()
    y = np.zeros((len(x), width))
    y[:, : x.shape[1]] = x
    signs = np.random.default_rng((SEED, table, width)).choice([-1.0, 1.0], size=(3, width))
    for s in signs:
        y = hadamard(y * s)
    return y


def axes(x: np.ndarray, table: int, probes: int = 1) -> np.ndarray:
    """The ``probes`` nearest signed axes of each row, nearest first; axis j and its opposite are 2j and 2j + 1."""
    y = rotated(x, table)
    top = np.argsort(-np.abs(y), axis=1, kind="stable")[:, :probes]
    return 2 * top + (np.take_along_axis(y, top, axis=1) < 0)


def hashes_for(n: int, width: int) -> int:
    """How many hashes make up a table, so that buckets of ``n`` vectors hold about ``STORED`` at most."""
    k = 1
    while n > STORED * (2 << max(0, width - 1).bit_length()) ** k:
        k += 1
    return k


def buckets(x: np.ndarray, table: int, hashes: int = 1, probes: int = 1) -> np.ndarray:
    """The ``probes`` best buckets of each row in a table of so many hashes, best first: those whose axes lose least, as
    squared differences to the nearest ones' lengths. With one hash they are the nearest axes."""
    width = 1 << max(0, x.shape[1] - 1).bit_length()
    if hashes == 1:
        return axes(x, table, probes)
    m = min(width, 1 if probes == 1 else int(3 * probes ** (1 / hashes)) + 1)
    out = []
    for at in range(0, len(x), 64):
        loss, code = np.zeros((len(x[at : at + 64]), 1)), np.zeros((len(x[at : at + 64]), 1), np.int64)
        for h in range(hashes):
            y = rotated(x[at : at + 64], table * hashes + h)
            top = np.argsort(-np.abs(y), axis=1, kind="stable")[:, :m]
            long = np.take_along_axis(y, top, axis=1)
            own = (np.abs(long[:, :1]) - np.abs(long)) ** 2
            loss = (loss[:, :, None] + own[:, None, :]).reshape(len(y), -1)
            code = (code[:, :, None] * (2 * width) + (2 * top + (long < 0))[:, None, :]).reshape(len(y), -1)
        best = np.argsort(loss, axis=1, kind="stable")[:, :probes]
        out.append(np.take_along_axis(code, best, axis=1))
    return np.concatenate(out)


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise cosines in double precision, the same for the same two vectors wherever they are computed."""
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in column])


def _assign(n: int, hashes: int | None, tables: int | None, probes: int | None):
    """To (id, v, cell): each vector with its buckets, the best ``probes`` of each table or as many as the size asks for."""

    def run(batches):
        for rows in batches:
            for width, own in rows.groupby(rows["v"].map(len)):
                x = _matrix(own["v"])
                k = hashes or hashes_for(n, width)
                usual = SIZES[min(k, len(SIZES)) - 1]
                for t in range(tables or usual[0]):
                    found = buckets(x, t, k, probes or usual[1])
                    base = np.int64(t * (2 << max(0, width - 1).bit_length()) ** k)
                    for j in range(found.shape[1]):
                        yield pd.DataFrame({"id": own["id"], "v": own["v"], "cell": (found[:, j] + base) << 16 | width & 0xFFFF})

    return run


def _best(k: int):
    """The k best stored vectors of each query among the rows of one block."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        asked, stored = rows[rows["asks"]], rows[~rows["asks"]]
        out = {"query": [], "id": [], "score": []}
        if len(asked) and len(stored):
            a, b = _matrix(asked["v"]), _matrix(stored["v"])
            ids = stored["id"].to_numpy()
            rough = (a / np.linalg.norm(a, axis=1, keepdims=True)) @ (b / np.linalg.norm(b, axis=1, keepdims=True)).T
            for i, (query, row) in enumerate(zip(asked["id"], rough)):
                pick = np.arange(len(row))
                if len(row) > k:
                    pick = np.flatnonzero(row >= np.partition(row, -k)[-k] - SLACK)
                score = cosines(np.broadcast_to(a[i], (len(pick), a.shape[1])), b[pick])
                top = np.lexsort((ids[pick], -score))[:k]
                out["query"] += [query] * len(top)
                out["id"] += ids[pick][top].tolist()
                out["score"] += score[top].tolist()
        return pd.DataFrame(out).astype({"query": "int64", "id": "int64", "score": "float64"})

    return run


def _meet(stored: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """(query, id, score): the best k of each block; both sides have (id, v, cell).

    A cell's vectors and queries are dealt into parts of bounded size, and every part of one meets every part of the
    other. Only cells that a query looks into count; their counts are broadcast if they are few.
    """
    n = stored.groupBy("cell").agg(F.ceil(F.count("*") / STORED).cast("int").alias("parts"))
    m = asked.groupBy("cell").agg(F.ceil(F.count("*") / ASKED).cast("int").alias("asks_parts"))
    sizes = small(cut(n.join(m, "cell")))
    part = lambda of: F.pmod(F.xxhash64("id"), F.col(of)).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    left = stored.join(sizes, "cell").select("cell", "id", "v", F.lit(False).alias("asks"), part("parts").alias("p"), every("asks_parts").alias("q"))
    right = asked.join(sizes, "cell").select("cell", "id", "v", F.lit(True).alias("asks"), every("parts").alias("p"), part("asks_parts").alias("q"))
    return left.unionByName(right).groupBy("cell", "p", "q").applyInPandas(_best(k), "query long, id long, score double")


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", hashes: int | None = None, tables: int | None = None, probes: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row of ``queries`` among the rows of ``vectors``
    with another id, by largest cosine, ties to the smaller id; all of them where there are fewer. ``hashes``, ``tables``
    and ``probes`` follow from the number of vectors unless they are given.

    Only vectors of a query's own width are compared. Rows whose id or vector is null, zero or holds a null or
    non-finite component take no part. Rows that repeat an id and a vector count once. No rows give none.
    """

    def clean(df: DataFrame) -> DataFrame:
        rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
        fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        return rows.where(F.col("id").isNotNull() & F.col("v").isNotNull() & fine & F.exists("v", lambda x: x != 0)).distinct()

    first = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    stored = cut(clean(vectors).withColumn("_n", first).where(F.col("_n") <= k + 1).drop("_n"))
    asked = cut(clean(queries))
    groups = asked.groupBy("v").agg(F.min("id").alias("lead"))
    asked = cut(lookup(asked, groups, "v").withColumn("own", F.col("id") == F.col("lead")))
    leads = cut(asked.where("own").select("id", "v"))
    members = asked.select("id", "lead")

    cells = "id long, v array<double>, cell long"
    n = stored.count()
    met = cut(_meet(stored.mapInPandas(_assign(n, hashes, tables, 1), cells), leads.mapInPandas(_assign(n, hashes, tables, probes), cells), k + 1))
    enough = met.groupBy("query").agg(F.countDistinct("id").alias("n")).where(F.col("n") > k)
    short = cut(leads.join(enough, leads["id"] == enough["query"], "left_anti"))
    if not short.isEmpty():
        whole = F.size("v").cast("long").alias("cell")
        met = met.unionByName(_meet(stored.select("id", "v", whole), short.select("id", "v", whole), k + 1))
    place = Window.partitionBy("query").orderBy(F.col("score").desc(), "id")
    best = met.distinct().withColumn("_n", F.row_number().over(place)).where(F.col("_n") <= k + 1)
    lists = best.groupBy(F.col("query").alias("lead")).agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("less"), F.col("id").alias("vec_id")))).alias("found"))
    found = lookup(members, lists, "lead")
    others = F.slice(F.filter("found", lambda f: f["vec_id"] != F.col("id")), 1, k)
    rows = found.select(F.col("id").alias("query_id"), F.posexplode(others).alias("rank", "f"))
    return rows.select("query_id", (F.col("rank") + 1).alias("rank"), F.col("f")["vec_id"].alias("vec_id"), (-F.col("f")["less"]).alias("score"))
