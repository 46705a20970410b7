"""Mixing sources to target weights by a low-discrepancy schedule.

Each source's documents are shuffled by a hash and laid end to end as one stream of words, repeated up to
``REPEATS`` times and cut into blocks of equal length. The mix is a schedule of slots of one block each: slot i is
mapped to the golden-ratio point frac(i * phi) and through the cumulative target weights to a source, and the r-th
slot of a source takes its r-th block. The points are spread so evenly that every stretch of the schedule has close to
its share of each source.

Streams and slots are numbered in two levels, within chunks and over chunks, so that a source with most of the words
never sits in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, cut, lookup

#: Weights of the sources by code point, repeating; the most times that a source is repeated.
WEIGHTS, REPEATS = (1, 2, 3), 3
#: Words in a block, slots numbered together, and the cells that points and weights meet in.
BLOCK, RUN, CELLS = 64, 65536, 4096
PHI = 0.6180339887498949
SEED = "mix"


def words(text: Column) -> Column:
    """The number of words of a text; null has none."""
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(WORD)).cast("long")


def targets(sources: DataFrame, weights: tuple = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """``sources`` (source, source_size) with source_no, their rank by code point with null last, and target.

    The sources weigh ``weights`` by rank, repeating, and share the sum of all sizes. A target stops at ``repeats``
    times its source's size and the excess is shared again by weight among the rest, until none is above.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*(F.lit(float(w)) for w in weights)), F.col("source_no") % len(weights))
    rows = sources.withColumn("source_no", rank).withColumn("weight", weight)
    rows = cut(rows.withColumn("most", (F.col("source_size") * repeats).cast("double")))
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    level, before = 0.0, None
    while level != before:
        open_ = F.lit(True) if before is None else F.col("most") > F.lit(level) * F.col("weight")
        share, capped = rows.agg(F.sum(F.when(open_, F.col("weight"))), F.sum(F.when(~open_, F.col("most")))).first()
        before, level = level, (total - (capped or 0.0)) / share if share else level
        if not share:
            break
    return rows.withColumn("target", F.least("most", F.lit(level) * F.col("weight"))).drop("weight", "most")


def schedule(sources: DataFrame, total: int, block: int = BLOCK) -> DataFrame:
    """(slot, source_no, block): the mix of ``sources`` (source_no, target) as one row for each of its blocks.

    ``block`` counts a source's slots from 0. There are as many slots as it takes blocks to hold ``total`` words.
    """
    spark = sources.sparkSession
    slots = -(-total // block)
    running = F.sum("target").over(Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, 0))
    ends = sources.select("source_no", "target", (running / float(max(1, total))).alias("end"))
    steps = ends.where("target > 0").withColumn("start", F.coalesce(F.lag("end").over(Window.orderBy("source_no")), F.lit(0.0)))
    # The last step ends where the points do, whatever the sums' rounding.
    steps = steps.withColumn("end", F.when(F.lead("end").over(Window.orderBy("source_no")).isNull(), 1.0).otherwise(F.col("end")))
    cell = F.explode(F.sequence(F.floor(F.col("start") * CELLS), F.least(F.floor(F.col("end") * CELLS), F.lit(CELLS - 1)))).alias("cell")
    steps = steps.select("source_no", "start", "end", cell)
    point = F.pmod(F.col("id") * F.lit(PHI), F.lit(1.0))
    points = spark.range(slots).select(F.col("id").alias("slot"), point.alias("point")).withColumn("cell", F.floor(F.col("point") * CELLS))
    found = points.join(steps, "cell").where("point >= start and point < end")
    rows = cut(found.select("slot", F.floor(F.col("slot") / RUN).alias("run"), "source_no"))
    counts = rows.groupBy("run", "source_no").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("source_no").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    inside = F.row_number().over(Window.partitionBy("run", "source_no").orderBy("slot")) - 1
    ranked = rows.withColumn("inside", inside).join(counts, ["run", "source_no"])
    return ranked.select("slot", "source_no", (F.col("inside") + F.col("before")).alias("block"))


def streams(rows: DataFrame) -> DataFrame:
    """``rows`` (row, doc_id, source_no, size) with the word position ``at`` of each in its source's shuffled stream."""
    key = F.md5(F.concat(F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    rows = rows.withColumn("key", key).withColumn("chunk", F.substring("key", 1, 3))
    sums = rows.groupBy("source_no", "chunk").agg(F.sum("size").alias("sum"))
    earlier = Window.partitionBy("source_no").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("sum").over(earlier), F.lit(0))).drop("sum")
    inside = Window.partitionBy("source_no", "chunk").orderBy("key", "doc_id", "size", "row").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return rows.join(sums, ["source_no", "chunk"]).withColumn("at", F.col("inside") + F.col("before")).drop("key", "chunk", "inside", "before")


def takes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", extra: dict | None = None, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(rows, takes): the rows of ``docs`` (row, doc_id, size, source_size, target, and ``extra`` columns), and how
    many of its words the mix takes in each repeat of its source (row, repeat, taken), where it takes any.

    Of every repeat the mix takes a document whole, or its first words only, or nothing.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), words(F.col(text_col)).alias("size"), F.col(source_col).cast("string").alias("source"), *(c.alias(k) for k, c in (extra or {}).items()))
    rows = cut(own.withColumn("row", F.monotonically_increasing_id()))
    sources = cut(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size"))))
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    named = sources.withColumn("name", F.struct("source")).drop("source")
    rows = cut(lookup(rows.withColumn("name", F.struct("source")).drop("source"), named, "name").drop("name"))
    slots = cut(schedule(sources, total, block))
    counts = slots.groupBy("source_no").agg(F.count("*").alias("blocks"))
    laid = lookup(streams(rows.select("row", "doc_id", "source_no", "size", "source_size").where("size > 0")), counts, "source_no")
    # A document lies in up to REPEATS places of the repeated stream; blocks past its source's slots aren't cut.
    placed = laid.select("row", "source_no", "size", "blocks", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(REPEATS - 1)), lambda e: F.col("at") + e * F.col("source_size"))).alias("repeat", "from"))
    placed = placed.where(F.col("from") < F.col("blocks") * block)
    first, last = F.floor(F.col("from") / block), F.least(F.floor((F.col("from") + F.col("size") - 1) / block), F.col("blocks") - 1)
    pieces = placed.select("row", "source_no", "size", "repeat", "from", F.explode(F.sequence(first, last)).alias("block"))
    overlap = F.least(F.col("from") + F.col("size"), (F.col("block") + 1) * block) - F.greatest(F.col("from"), F.col("block") * block)
    joined = pieces.join(slots, ["source_no", "block"])
    return rows, joined.groupBy("row", "repeat").agg(F.sum(overlap).alias("taken"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every row of ``docs``.

    A null text has no words, a null source is one like any other and comes last. Documents of the same id are laid
    out by size. No rows, or no words, give zeros.
    """
    rows, taken = takes(docs, id_col, text_col, source_col)
    sums = taken.groupBy("row").agg(F.sum("taken").alias("taken"))
    return rows.join(sums, "row", "left").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", length_col: str | None = "n_chars") -> DataFrame:
    """The mix itself: a row of ``docs`` for every repeat that takes words of it, its text cut after the words taken.

    A text taken whole is unchanged. ``length_col``, if there is one, is set to the text's length. Documents without
    words are in no mix.
    """
    key = F.xxhash64(F.col(id_col), F.col(source_col), F.col(text_col))
    rows, taken = takes(docs, id_col, text_col, source_col, {"key": key})
    rows = rows.select("row", F.struct("key", "doc_id").alias("key"), "size")
    parts = taken.groupBy("row").agg(F.collect_list("taken").alias("parts")).join(rows, "row")
    names = [docs[c] for c in docs.columns]
    own = docs.select(F.struct(*names).alias("doc"), F.struct(key.alias("key"), docs[id_col].alias("doc_id")).alias("key"))
    if rows.groupBy("key").count().where("count > 1").isEmpty():
        joined = own.join(parts, "key")
    else:  # equal rows are told apart by number
        number = F.row_number().over(Window.partitionBy("key").orderBy("key"))
        numbered = rows.select("row", "key", number.alias("no")).join(parts.drop("key"), "row")
        joined = own.withColumn("no", number).join(numbered, ["key", "no"])
    joined = joined.select("doc", "size", F.explode("parts").alias("taken"))
    text = F.col("doc")[text_col]
    begin = F.regexp_extract(text, r"^[\x20\x09-\x0D]*", 0)
    units = F.regexp_extract_all(text, F.lit(rf"{WORD}[\x20\x09-\x0D]*"), F.lit(0))
    piece = F.concat(begin, F.array_join(F.slice(units, 1, F.col("taken").cast("int")), ""))
    joined = joined.withColumn("piece", F.when(F.col("taken") < F.col("size"), piece).otherwise(text))
    out = {c: F.col("doc")[c] for c in docs.columns} | {text_col: F.col("piece")}
    if length_col in docs.columns:
        out[length_col] = F.length("piece").cast(docs.schema[length_col].dataType)
    return joined.select(*(c.alias(name) for name, c in out.items()))


#: ``mixed`` over the table documents.
SQL = f"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         md5('{SEED}' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS key
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS no FROM s),
c AS (SELECT *, CAST(no % 3 + 1 AS DOUBLE) AS weight, CAST(3 * source_size AS DOUBLE) AS most FROM w),
r AS (SELECT *, most / weight AS ratio,
        (SELECT CAST(sum(source_size) AS DOUBLE) FROM s) AS total,
        coalesce(sum(most) OVER (ORDER BY most / weight, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
        (SELECT sum(weight) FROM c) - coalesce(sum(weight) OVER (ORDER BY most / weight, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS share
      FROM c),
l AS (SELECT (total - capped) / share AS level FROM r WHERE ratio > (total - capped) / share ORDER BY ratio, no LIMIT 1),
t AS (SELECT c.*, least(most, (SELECT level FROM l) * weight) AS target FROM c),
e AS (SELECT *, sum(target) OVER (ORDER BY no) / (SELECT sum(source_size) FROM s) AS "end" FROM t WHERE target > 0),
f AS (SELECT *, coalesce(lag("end") OVER (ORDER BY no), 0) AS start,
        CASE WHEN lead("end") OVER (ORDER BY no) IS NULL THEN 1.0 ELSE "end" END AS stop FROM e),
n AS (SELECT f.no, count(*) AS blocks
      FROM range((SELECT CAST(ceil(sum(source_size) / {BLOCK}) AS BIGINT) FROM s)) p(i)
      JOIN f ON (p.i * {PHI}) % 1.0 >= f.start AND (p.i * {PHI}) % 1.0 < f.stop GROUP BY f.no),
o AS (SELECT d.doc_id, d.size, t.source_size, t.target, coalesce(n.blocks, 0) * {BLOCK} AS words,
        coalesce(sum(d.size) OVER (PARTITION BY t.no ORDER BY d.key, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN n ON n.no = t.no)
SELECT doc_id, size, source_size, target, CAST(
         greatest(0, least(size, words - pos)) + greatest(0, least(size, words - pos - source_size))
         + greatest(0, least(size, words - pos - 2 * source_size)) AS BIGINT) AS taken
FROM o"""
