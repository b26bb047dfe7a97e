"""Operator 12, source divergence audit: how far the sources of a language differ in their words.

Terms are counted per (language, source) in one pass. The kept terms of a
language get bit numbers, and each (group, count) gets the set of the terms it
has that often, as a bitmap of 64-bit words of which only the words that are
not zero are stored. For two groups the AND of two bitmaps and a population
count is one joint cell: the terms that one has ``a`` and the other ``b`` times.
It is multiplied by the difference of the two smoothed rates. What a group lacks
is the complement of its bitmaps within the language's terms.

All arithmetic is on whole numbers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmart.llm.common import stage

#: A term is kept in a language that has it in this many documents.
MIN_DOCS = 30
#: Parts in a whole, and what is added to every count (both fixed by the measure).
SCALE, SMOOTH = 1_000_000_000, 5
#: Terms listed a group.
TOP_TERMS = 50
#: A task handles 2 to the power of SPAN bitmap words together, and compares so many sources with as many others.
SPAN, SOURCES = 6, 32
#: Counters are handed on when they hold this many terms.
FLUSH = 200_000

#: Bytes of a text's UTF-8 form: letters A-Z become a-z, other ASCII characters than letters become blanks.
_FOLD = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256)).lower()

_COUNTED = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def terms(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and of characters beyond ASCII, with A-Z lower-cased."""
    return text.translate(_FOLD).split()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each (lang, source, term) of a partition, in parts; a group itself is a row without a term."""
    groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def rows() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in groups.items():
            words = list(n)
            k = len(words) + 1
            term = pa.array([None, *words], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * k),
                    pa.array([source] * k),
                    term,
                    pa.array([0, *n.values()], pa.int64()),
                    pa.array([0, *(docs[w] for w in words)], pa.int64()),
                ],
                schema=_COUNTED,
            )
        groups.clear()

    held = 0
    for batch in batches:
        lang, source = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        texts = batch.column(2).cast(pa.binary())
        for i, key in enumerate(zip(lang, source, strict=True)):
            n, docs = groups.setdefault(key, (Counter(), Counter()))
            found = terms(texts[i].as_py())
            held -= len(n)
            n.update(found)
            docs.update(set(found))
            held += len(n)
            if held > FLUSH:
                yield from rows()
                held = 0
    yield from rows()


def count_terms(docs: DataFrame) -> DataFrame:
    """lang, source, term, n, docs: occurrences of a term in a group and documents that have it; each group also has a row without a term."""
    plain = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    parts = plain.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def rate(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (n + SMOOTH) / (total + SMOOTH * kept)), in decimals wide enough for any count."""
    wide = F.lit(SCALE).cast("decimal(10,0)") * (n + SMOOTH).cast("decimal(19,0)")
    return F.expr("1L") + F.call_function("div", wide, (total + SMOOTH * kept).cast("decimal(19,0)"))


def number_terms(kept: DataFrame) -> DataFrame:
    """The kept terms with ``word`` and ``bit``: their place in the bitmaps.

    Terms are put in order of language and count over ranges of partitions, so
    no task holds a language; terms of like counts share words, which keeps the
    number of different counts in a word small.
    """
    ordered = kept.repartitionByRange("lang", F.desc("n"), "term").sortWithinPartitions("lang", F.desc("n"), "term")
    place = F.monotonically_increasing_id()
    return ordered.select("lang", "term", "n", F.shiftright(place, 6).alias("word"), F.pmod(place, F.lit(64)).cast("int").alias("bit"))


def bitmaps(numbered: DataFrame, *keys: str) -> DataFrame:
    """keys..., bits: the terms of each key as a bitmap; ``word`` is one of the keys."""
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))
    return numbered.groupBy(*keys).agg(F.bit_or(one).alias("bits"))


def _rates(levels: np.ndarray, total: int, kept: int) -> np.ndarray:
    """The rate of each count, in whole numbers of any size."""
    below = total + SMOOTH * kept
    return np.array([1 + SCALE * (int(n) + SMOOTH) // below for n in levels], dtype=np.int64)


class Profiles:
    """Bitmaps of some sources over one span of words, by word: bits, rates and where each source begins."""

    def __init__(self, rows: pd.DataFrame, all_bits: dict[int, int]):
        rows = rows.sort_values("source", kind="stable")
        self.sources = rows["source"].tolist()
        self.words: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        cells: dict[int, list[tuple[list[int], list[int]]]] = {w: [] for w in all_bits}
        totals = rows["total"].tolist()
        for entries in rows["cells"]:
            own: dict[int, tuple[list[int], list[int]]] = {}
            for e in entries if entries is not None else ():
                bits, levels = own.setdefault(e["word"], ([], []))
                bits.append(e["bits"])
                levels.append(e["n"])
            for w, full in all_bits.items():
                bits, levels = own.get(w, ([], []))
                lacking = full
                for b in bits:
                    lacking &= ~b
                cells[w].append((bits + [lacking], levels + [0]))  # zeros by complement
        kept = int(rows["kept"].iloc[0])
        for w, parts in cells.items():
            starts = np.cumsum([0] + [len(b) for b, _ in parts[:-1]])
            bits = np.array([b for part, _ in parts for b in part], dtype=np.int64).view(np.uint64)
            rates = np.concatenate([_rates(levels, total, kept) for (_, levels), total in zip(parts, totals, strict=True)])
            self.words[w] = bits, rates, starts


def compare(a: Profiles, b: Profiles) -> np.ndarray:
    """The sum over the span's terms of the rates' differences, for each source of ``a`` and of ``b``."""
    out = np.zeros((len(a.sources), len(b.sources)), np.int64)
    for w, (bits_a, rates_a, starts_a) in a.words.items():
        bits_b, rates_b, starts_b = b.words[w]
        joint = np.bitwise_count(bits_a[:, None] & bits_b[None, :]).astype(np.int64)
        joint *= np.abs(rates_a[:, None] - rates_b[None, :])
        out += np.add.reduceat(np.add.reduceat(joint, starts_a, axis=0), starts_b, axis=1)
    return out


def _compare_blocks(rows: pd.DataFrame) -> pd.DataFrame:
    """All pairs of different sources of two blocks (or of one block) over one span of words."""
    left, right = int(rows["left"].iloc[0]), int(rows["right"].iloc[0])
    masks = {int(e["word"]): int(e["bits"]) for e in rows["masks"].iloc[0]}
    a = Profiles(rows[rows["block"] == left], masks)
    b = a if left == right else Profiles(rows[rows["block"] == right], masks)
    sums = compare(a, b)
    i, j = np.triu_indices(len(a.sources), 1) if left == right else np.indices(sums.shape).reshape(2, -1)
    names_a, names_b = np.array(a.sources, object), np.array(b.sources, object)
    return pd.DataFrame({"lang": rows["lang"].iloc[0], "a": names_a[i], "b": names_b[j], "value": sums[i, j]})


def pair_sums(groups: DataFrame, numbered: DataFrame, cells: DataFrame) -> DataFrame:
    """lang, a, b, value: the summed difference of every two sources of a language that has kept terms.

    ``groups`` has lang, source, total, kept. One task takes up to two blocks of
    sources and one span of words, a few megabytes at most. A source without a
    term in a span takes part with the complement alone.
    """
    span = F.shiftright("word", SPAN)
    masks = bitmaps(numbered, "lang", "word").groupBy("lang", span.alias("span")).agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("masks"))
    own = cells.groupBy("lang", "source", span.alias("span")).agg(F.sort_array(F.collect_list(F.struct("word", "n", "bits"))).alias("cells"))
    sizes = groups.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / SOURCES).alias("blocks"))
    blocked = groups.join(sizes, "lang").withColumn("block", F.pmod(F.xxhash64("source"), F.col("blocks")))
    profiles = blocked.join(masks, "lang").join(own, ["lang", "source", "span"], "left")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    units = profiles.withColumn("other", other).withColumn("left", F.least("block", "other")).withColumn("right", F.greatest("block", "other"))
    units = units.select("lang", "source", "total", "kept", "block", "left", "right", "span", "masks", "cells")
    parts = units.groupBy("lang", "span", "left", "right").applyInPandas(_compare_blocks, "lang string, a string, b string, value long")
    return parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank for every (lang, source) of ``docs``.

    Part ``pair``: each other source of the language with the summed difference
    of the two groups' rates over the language's kept terms (0 without any).
    Part ``term``: up to ``top_terms`` kept terms that the group uses more than
    its language does, with the difference. Ranks run by descending value and,
    on ties, ascending item (by UTF-8 bytes).

    NULL text, lang and source are empty strings; an empty text has no terms but
    its group counts. A row is a document, repeated rows and ids included. Long
    texts are taken whole. Other columns are not looked at. An empty table gives
    an empty one.
    """
    counted = stage(count_terms(docs), "term-counts")
    terms_of = counted.where("term is not null")
    kept = terms_of.groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs)
    numbered = stage(number_terms(kept.select("lang", "term", "n")), "term-bits")
    mine = stage(terms_of.select("lang", "source", "term", "n").join(numbered.withColumnRenamed("n", "lang_n"), ["lang", "term"]), "kept-counts")

    langs = numbered.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count(F.lit(1)).alias("kept"))
    totals = mine.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = counted.where("term is null").select("lang", "source").join(langs, "lang", "left").join(totals, ["lang", "source"], "left")
    groups = stage(groups.na.fill(0, ["lang_total", "kept", "total"]), "groups")

    by_group = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    cells = bitmaps(mine, "lang", "source", "word", "n")  # the terms that a group has exactly n times
    sums = pair_sums(groups.where("kept > 0").select("lang", "source", "total", "kept"), numbered, cells)
    bare = groups.where("kept = 0").select("lang", "source")
    bare = bare.join(bare.withColumnRenamed("source", "item"), "lang").where(F.col("source") != F.col("item"))
    pairs = (
        sums.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value")
        .unionByName(sums.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value"))
        .unionByName(bare.select("lang", "source", "item", F.lit(0).cast("long").alias("value")))
    )
    pairs = pairs.withColumn("rank", F.row_number().over(by_group)).withColumn("part", F.lit("pair"))

    p, q = rate(F.col("n"), F.col("total"), F.col("kept")), rate(F.col("lang_n"), F.col("lang_total"), F.col("kept"))
    over = mine.join(groups, ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), (p - q).alias("value")).where(F.col("value") > 0)
    over = over.withColumn("rank", F.row_number().over(by_group)).where(F.col("rank") <= top_terms).withColumn("part", F.lit("term"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select(*columns).unionByName(over.select(*columns))


def query(docs: DataFrame) -> DataFrame:
    return audit(docs)


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
t AS (SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT id) >= 30),
v AS (SELECT lang, count(*) AS kept, CAST(sum(n) AS HUGEINT) AS total FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT t.lang, t.source, t.term, count(*) AS n FROM t JOIN k USING (lang, term) GROUP BY ALL),
s AS (SELECT lang, source, CAST(sum(n) AS HUGEINT) AS total FROM c GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (coalesce(s.total, 0) + 5 * v.kept) AS p,
    1 + (1000000000::HUGEINT * (k.n + 5)) // (v.total + 5 * v.kept) AS q
  FROM g JOIN v USING (lang) JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
  LEFT JOIN s ON s.lang = g.lang AND s.source = g.source),
pair AS (
  SELECT a.lang, a.source, b.source AS item, CAST(coalesce(x.value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT l.lang, l.source, r.source AS item, sum(abs(l.p - r.p)) AS value
    FROM p l JOIN p r ON l.lang = r.lang AND l.term = r.term AND l.source <> r.source GROUP BY ALL) x
  ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
rows AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pair
  UNION ALL
  SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM rows)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""
