"""Shared helpers of the text operators."""

from __future__ import annotations

import re
import sys
import tempfile
import uuid
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Worker processes need not have this package on their path: its functions travel by value.
cloudpickle.register_pickle_by_value(sys.modules["tabulon.llm"])

#: A word is a run of bytes other than these six white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names in ``spark.checkpoint.dir``. A temporary one is used where that is unset and
    Spark runs on this machine alone, as in tests; on a cluster other machines would not see it."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = context.getConf().get("spark.checkpoint.dir")
        if not folder and not re.fullmatch(r"local(\[[^,]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="tabulon-checkpoint-"))
    return context._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder, so that lost executors cost no recomputation."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def lookup(left: DataFrame, right: DataFrame, key: str, share: int = 500) -> DataFrame:
    """``left`` with the columns of its row of ``right``, which has each value of ``key`` once; nulls where none.

    Values that make up at least one in ``share`` of the left rows are joined by broadcast, so there are at most
    ``share`` of them; the rest is joined by shuffle, where no value can crowd a task. Null keys find nothing.
    """
    counts = left.groupBy(key).agg(F.count("*").alias("_rows"))
    total = counts.agg(F.sum("_rows")).first()[0] or 0
    hot = cut(counts.where((F.col("_rows") >= max(2, -(-total // share))) & F.col(key).isNotNull()).select(key))
    known = F.broadcast(hot.join(right, key, "left"))
    rest = left.join(F.broadcast(hot), key, "left_anti").join(right, key, "left")
    return left.join(known, key).unionByName(rest)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared checkpoint folder and read again."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: A table of at most so many narrow rows, counted first, is broadcast.
SMALL_ROWS = 100_000


def small(df: DataFrame) -> DataFrame:
    """``df``, marked for broadcast if it has few rows. It should be materialised, as its rows are counted."""
    return F.broadcast(df) if df.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS else df


#: Rows and bytes in an Arrow batch: texts are long, and a batch is held by the JVM and by Python, several times over.
BATCH_ROWS, BATCH_BYTES = 1000, 1 << 26
_LIMITS = {"spark.sql.execution.arrow.maxRecordsPerBatch": BATCH_ROWS, "spark.sql.execution.arrow.maxBytesPerBatch": BATCH_BYTES}


def in_arrow(df: DataFrame, function: Callable, schema) -> DataFrame:
    """``df.mapInArrow`` with batches of at most ``BATCH_ROWS`` rows and about ``BATCH_BYTES`` bytes. Spark reads these
    limits from the session when the result is computed, so the session keeps them."""
    conf = df.sparkSession.conf
    for name, most in _LIMITS.items():
        given = re.match("[0-9]+b?$", conf.get(name) or "")
        if not given or not 0 < int(given[0].rstrip("b")) <= most:
            conf.set(name, most)
    return df.mapInArrow(function, schema)
