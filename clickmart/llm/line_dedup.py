"""Operator 10, line dedup: drop lines that many documents share.

Lines are exploded with their positions, normalised and hashed to 128 bits;
distinct documents are counted per hash; the positions of frequent lines come
back to their document, and the kept lines are joined again by position. The
text itself moves once, in the join with the positions to drop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmart.llm.common import SPACES, ascii_lower, row_key, stage, text_of

MIN_DOCS = 10
MIN_CHARS = 1


def line_key(line: Column) -> Column:
    """The line without white space at its ends and with A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """The rows of ``docs`` with ``text`` less its frequent lines, and ``n_lines``, ``n_dropped``.

    A line goes, in every document, if its key has ``min_chars`` code points or
    more and occurs in ``min_docs`` documents or more. Texts split at ``\\n``; a
    NULL or empty text is one empty line and becomes the empty text. Rows that
    share a ``doc_id`` count as one document (rows without an id together as
    one); each row keeps its own text, and repeated rows stay. Other columns
    pass through; own columns named ``n_lines`` or ``n_dropped`` are replaced.
    An empty table gives an empty table.
    """
    docs = docs.drop("n_lines", "n_dropped")
    k1, k2 = row_key(F.col("doc_id"), text_of())
    lines = F.split(text_of(), "\n", -1)
    keys = F.transform(lines, line_key)
    exploded = docs.select("doc_id", k1.alias("k1"), k2.alias("k2"), F.posexplode(keys).alias("pos", "key"))
    h1, h2 = row_key(F.col("key"))
    hashed = stage(
        exploded.where(F.length("key") >= max(1, min_chars)).select("doc_id", "k1", "k2", "pos", h1.alias("h1"), h2.alias("h2")).distinct(),
        "lines",
    )
    frequent = (
        hashed.select("h1", "h2", F.struct("doc_id").alias("doc")).distinct()
        .groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_docs).select("h1", "h2")
    )
    drop = hashed.join(frequent, ["h1", "h2"], "left_semi").groupBy("k1", "k2").agg(F.sort_array(F.collect_set("pos")).alias("drop"))

    rows = docs.select(F.struct(*docs.columns).alias("row"), k1.alias("k1"), k2.alias("k2"))
    out = rows.join(drop, ["k1", "k2"], "left").select("row", "drop", F.split(F.coalesce(F.col("row.text").cast("string"), F.lit("")), "\n", -1).alias("lines"))
    ends = F.concat(F.array(F.lit(-1)), F.col("drop"), F.array(F.size("lines")))
    out = out.withColumn("ends", ends)
    # What lies between two dropped positions stays: linear in the lines, however many go.
    kept = F.flatten(
        F.transform(
            F.sequence(F.lit(1), F.size("drop") + 1),
            lambda i: F.slice(F.col("lines"), F.get(F.col("ends"), i - 1) + 2, F.get(F.col("ends"), i) - F.get(F.col("ends"), i - 1) - 1),
        )
    )
    left = F.when(F.col("drop").isNull(), F.array_join("lines", "\n")).otherwise(F.array_join(kept, "\n"))
    return out.select(
        *(left.alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns),
        F.size("lines").cast("long").alias("n_lines"),
        F.when(F.col("drop").isNull(), 0).otherwise(F.size("drop")).cast("long").alias("n_dropped"),
    )


def query(docs: DataFrame) -> DataFrame:
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM d),
k AS (SELECT doc_id, pos, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
m AS (SELECT k.*, f.key IS NOT NULL AS dropped FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
