"""Operator 9, mixing sources to target weights by capped water-filling.

A source's target is its weight's share of all words, clamped at ``max_epochs``
times what it has; the excess is shared again by weight among the others until
no target is above its cap. Every document is then taken
``floor(target / source size)`` whole times, and a seeded hash order picks the
documents that are taken once more for the fractional rest.

The order is cut without sorting a source in one task: sums per (source, hash
prefix) find the prefix in which the target falls, and only the documents of
that one prefix are put in order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickmart.llm.common import shuffle_partitions, stage, text_of, word_count

MAX_EPOCHS = 3
SEED = "mix-1"
#: Hex digits of the hash prefix: one prefix of a source holds 1/4096 of its documents.
PREFIX = 3


def ranked_sources(sources: DataFrame) -> DataFrame:
    """``sources`` (source, source_size) with ``place``: 0, 1, ... by code point, NULL last.

    Ranks are counted per range of sources and shifted by the ranges before,
    so no task orders all of them.
    """
    spark = sources.sparkSession
    ranged = sources.repartitionByRange(shuffle_partitions(spark), F.col("source").asc_nulls_last())
    ranged = stage(ranged.withColumn("part", F.spark_partition_id()), "sources")
    before, total = {}, 0
    for r in ranged.groupBy("part").count().orderBy("part").toLocalIterator():  # one row a partition
        before[r["part"]], total = total, total + r["count"]
    shifts = spark.createDataFrame(list(before.items()) or [(0, 0)], "part int, shift long")
    inside = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())) - 1
    return ranged.withColumn("place", inside).join(F.broadcast(shifts), "part").select("source", "source_size", (F.col("place") + F.col("shift")).alias("place"))


def water_fill(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``sources`` (source, source_size, weight) with ``target``.

    Each round sums what is capped and what is not (one row to the driver) and
    raises the level; targets only grow, so a capped source stays capped. All
    sums are whole numbers, so the level does not depend on the row order.
    """
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    cap = max_epochs * F.col("source_size")
    while True:
        full = cap <= F.lit(level) * F.col("weight") if capped >= 0 else F.lit(False)
        row = sources.agg(
            F.sum(F.when(full, cap).otherwise(0)).alias("held"), F.sum(F.when(full, 0).otherwise(F.col("weight"))).alias("weight"), F.count(F.when(full, 1)).alias("capped")
        ).first()
        if row.capped == capped or not row.weight:
            break
        capped, level = row.capped, (total - row.held) / row.weight
    target = F.when(cap <= F.lit(level) * F.col("weight"), cap.cast("double")).otherwise(F.lit(level) * F.col("weight"))
    return sources.withColumn("target", target)


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """Rows of ``docs`` with ``size``, ``source_size``, ``target``, ``copies`` and ``taken``.

    ``size`` is the number of words (NULL text: 0). Sources are weighted in
    code-point order with ``weights`` repeating, NULL as a source of its own,
    last. ``copies`` (0 to ``max_epochs``) is how often the mix takes the
    document and ``taken = copies * size``. A source's taken words miss its
    target by less than one document (rows that repeat an id share one draw and
    count as one document). Sources without words have target 0 and every
    document of size 0 is taken as often as whole repetitions say. Extra columns
    pass through; those with the names above are replaced. Reruns agree: the
    draw is a hash of the seed and ``doc_id``.
    """
    docs = docs.drop("size", "source_size", "target", "copies", "taken")
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    sized = docs.select(F.struct(*docs.columns).alias("row"), "source", word_count(text_of()).alias("size"), draw.alias("_draw"))
    small = stage(sized.select("source", "size", "_draw"), "sizes")  # all later sums read this, not the texts

    by_source = small.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = ranked_sources(by_source)
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    targets = stage(water_fill(stage(place.withColumn("weight", weight.cast("long")), "weights"), max_epochs), "targets")
    # The fractional rest, as words: documents in draw order are taken once more while their words fit into it.
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    targets = targets.withColumn("whole", F.floor(ratio)).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))

    prefix = F.substring("_draw", 1, PREFIX)
    same = F.col("source").eqNullSafe(F.col("t_source"))
    t = F.broadcast if _few(targets) else (lambda x: x)
    rest = targets.select(F.col("source").alias("t_source"), "rest")
    by_prefix = small.groupBy("source", prefix.alias("prefix")).agg(F.sum("size").alias("words"))
    w = Window.partitionBy("source").orderBy("prefix")
    run = by_prefix.withColumn("after", F.sum("words").over(w)).withColumn("before", F.col("after") - F.col("words"))
    at = run.join(t(rest), same).where((F.col("before") <= F.col("rest")) & (F.col("after") > F.col("rest"))).select("t_source", F.col("prefix").alias("t_prefix"), "before", "rest")
    inside = small.join(at, same & (prefix == F.col("t_prefix"))).groupBy("source", "before", "rest", "_draw").agg(F.sum("size").alias("words"))
    wd = Window.partitionBy("source").orderBy("_draw")
    inside = inside.withColumn("end", F.col("before") + F.sum("words").over(wd))
    # The document that straddles the target is taken if that comes nearer to it.
    fits = F.col("end") - F.col("words") / 2 <= F.col("rest")
    last = inside.groupBy("source").agg(F.max(F.when(fits, F.col("_draw"))).alias("last"), F.min("_draw").alias("first"))
    cuts = targets.join(last.withColumnRenamed("source", "l_source"), F.col("source").eqNullSafe(F.col("l_source")), "left").select(
        F.col("source").alias("t_source"), "source_size", "target", "whole", "rest", "last", "first"
    )
    out = sized.join(F.broadcast(cuts) if _few(targets) else cuts, same, "left")
    # No document straddles (first is NULL) when the rest is nothing or the whole source; else all draws up to the cut.
    once = F.when(F.col("first").isNull(), F.col("rest") > 0).otherwise((F.col("_draw") <= F.col("last")) | (F.col("_draw") < F.col("first")))
    once = F.coalesce(once, F.lit(False)) & (F.col("rest") > 0)  # nothing more where whole repetitions are all
    copies = (F.col("whole") + once.cast("int")).cast("long")
    out = out.withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size"))
    return out.select(*(F.col("row").getField(c).alias(c) for c in docs.columns), "size", "source_size", "target", "copies", "taken")


#: Largest table of sources, in rows, that is broadcast; above it Spark joins by shuffle.
FEW_SOURCES = 100_000


def _few(sources: DataFrame) -> bool:
    return sources.count() <= FEW_SOURCES


def query(docs: DataFrame) -> DataFrame:
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
  md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null')) AS draw FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
p AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM s),
o AS (SELECT *, sum(3 * source_size) OVER q - 3 * source_size AS held, sum(weight) OVER () - (sum(weight) OVER q - weight) AS open_weight,
  sum(source_size) OVER () AS total
  FROM p WINDOW q AS (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
v AS (SELECT max((total - held)::DOUBLE / open_weight::DOUBLE) FILTER (3 * source_size > (total - held)::DOUBLE / open_weight::DOUBLE * weight) AS level FROM o),
t AS (SELECT source, source_size, CASE WHEN 3 * source_size <= coalesce(level, 3e18) * weight THEN (3 * source_size)::DOUBLE ELSE level * weight END AS target FROM p, v),
r AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole FROM t),
x AS (SELECT d.*, r.source_size, r.target, r.whole, r.target - r.whole * r.source_size AS rest,
  sum(d.size) OVER (PARTITION BY d.source ORDER BY d.draw) AS ending FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, target,
  ((whole + CASE WHEN rest > 0 AND (ending - size / 2.0 <= rest OR ending <= rest) THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM x
"""
