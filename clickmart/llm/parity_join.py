"""Operator 8, n-gram Jaccard join by parity sketches.

A document's shingle set of size n is XOR-hashed into a sketch of B blocks:
every shingle flips one bit of one block, and each block also keeps the XOR of
its shingles' hashes. A shingle that two sets do not share changes one block
at most, so the sketches' Hamming distance lower-bounds the symmetric
difference. Two sets with Jaccard ``>= t`` differ in
``d = (a + b) * (1 - t) / (1 + t)`` shingles at most, so of the first ``d + 1``
non-empty blocks of either, one must agree: these blocks are the keys of the
join. Sketch lengths are fixed per size band; sets near a band's end are put in
two bands, so every pair with possible sizes meets in one.

Equal sets are one node. Sketches decide first which pairs are looked at
closer. A key's members are compared with one member, links make components;
this is done again with other members for keys that still hold several
components, and at last all members of one key in different components are
compared with each other, in common keys by 32 bits of every shingle's hash as
well. So groups of copies cost a few pairs a member, and no pair that a key
brings together is left out.

Hashes have 64 bits (classes 128). With 6 to 11 shingles two linked sets miss
each other with a chance below 1e-8, else below 1e-15.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmart.llm.common import discard, stage, staged_as, text_batches, text_of
from clickmart.llm.tokens import worker_kept
from clickmart.llm.vectors import sweep

WORDS, PERCENT = 4, 85
#: A band's largest size against its smallest.
BAND = 1.5
#: Fewest 64-bit words of the sketch that pairs are sifted by; larger sets have a bit a shingle or more.
SKETCH_WORDS = 4
#: Rounds in which a key's members are compared with one of them, before the rest are compared in pairs.
ROUNDS = 2
#: Pairs up to which they are broadcast to the table of sets, first bare and then with a sketch (about 300 bytes each).
FEW_PAIRS = 50_000
#: Documents to compare closely, up to which their ids are broadcast to the scan (8 bytes each).
FEW_IDS = 1_000_000
#: Members of a key up to which they are joined with themselves in SQL; more are dealt into blocks of so many.
FEW_MEMBERS, BLOCK_MEMBERS = 64, 4_096
#: Shingles of a block's members together, beyond which there are more blocks.
BLOCK_MARKS = 1 << 22
#: Sketch words that are compared at once.
TILE = 1 << 22
CACHE_WORDS = 300_000
_ALL = (1 << 64) - 1
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of the splitmix64 generator."""
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words, and how many each text has. Words end at ASCII white space; A-Z count as a-z."""
    known = worker_kept("word_hashes", dict)
    lists = [t.encode("utf-8", "surrogatepass").lower().split() for t in texts]
    new = set().union(*lists).difference(known)
    if len(known) + len(new) > CACHE_WORDS:
        known.clear()
        new = set().union(*lists)
    known.update((w, xxhash.xxh3_64_intdigest(w)) for w in new)
    counts = np.array([len(x) for x in lists], dtype=np.int64)
    return np.fromiter((known[w] for x in lists for w in x), dtype=np.uint64, count=int(counts.sum())), counts


def forget_words() -> None:
    """At a task's end its words go: a worker without a task would hold them while the next step's workers run."""
    worker_kept("word_hashes", dict).clear()
    pa.default_memory_pool().release_unused()


def shingle_sets(texts: list[str], words: int) -> list[np.ndarray]:
    """Per text its distinct shingle hashes, ascending: runs of ``words`` words, or all words if there are fewer."""
    hashes, counts = word_hashes(texts)
    rolled = hashes.copy()
    for i in range(1, min(words, len(rolled))):  # all texts together may have fewer words
        rolled[: len(rolled) - i] = rolled[: len(rolled) - i] * _M1 + hashes[i:]
    rolled = mix64(rolled)
    out, at = [], 0
    for n in counts.tolist():
        if n >= words:
            out.append(np.unique(rolled[at : at + n - words + 1]))
        elif n:
            short = n
            for h in hashes[at : at + n].tolist():
                short = (short * int(_M1) + h) & _ALL
            out.append(mix64(np.array([short ^ int(_M2)], dtype=np.uint64)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
        at += n
    return out


def most_apart(a: int, b: int, percent: int) -> int:
    """Largest symmetric difference of linked sets of these sizes."""
    return (a + b) * (100 - percent) // (100 + percent)


def bands(n: int, percent: int) -> list[tuple[int, int, int]]:
    """(band, blocks, keys needed) for a set of ``n`` shingles.

    Band k holds sizes from ``BAND ** k`` to what may link to the smallest of band k + 1.
    """
    largest = n * 100 // percent
    need = most_apart(n, largest, percent) + 1
    if need == 1:
        return []  # only equal sets link
    out = []
    k = int(np.floor(np.log(n) / np.log(BAND) + 1e-9))
    for band in (k - 1, k, k + 1):
        low, next_low = int(np.ceil(BAND**band)), int(np.ceil(BAND ** (band + 1)))
        top = (next_low - 1) * 100 // percent  # the largest partner of the largest set that has this band as its own
        if low <= n <= top:
            apart = most_apart(top, top, percent)
            out.append((band, max(-(-top // 4), apart + 25, 64 if low < 12 else 0), need))
    return out


def block_keys(s: np.ndarray, percent: int) -> np.ndarray:
    """The join keys of one set: a hash of band, block number and block for its first non-empty blocks."""
    out = []
    for band, blocks, need in bands(len(s), percent):
        block = ((s >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)  # ascending, as the set is
        first = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
        end = first[need] if need < len(first) else len(s)
        first = first[:need]
        bits = np.bitwise_xor.reduceat(np.uint64(1) << (s[:end] & np.uint64(63)), first)
        held = np.bitwise_xor.reduceat(mix64(s[:end] ^ _M1), first)
        out.append(mix64((bits * _M3) ^ held ^ ((block[first] + np.uint64(1)) * _M1 + np.uint64((band + 1000) * int(_M2) & _ALL))))
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def sketch(s: np.ndarray) -> np.ndarray:
    """A parity sketch whose length is a power of two, as the set's size asks for.

    The XOR of its halves is the sketch of half the length, so any two can be compared.
    """
    words = max(SKETCH_WORDS, 1 << max(0, (len(s) - 1) // 64).bit_length())
    out = np.zeros(words, dtype=np.uint64)
    at = mix64(s + _M2)
    np.bitwise_xor.at(out, (at >> np.uint64(32)) & np.uint64(words - 1), np.uint64(1) << (at & np.uint64(63)))
    return out


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.zeros(0, dtype=np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


def _long(values: list) -> pa.Array:
    return pa.array(np.array(values, dtype=np.uint64).view(np.int64))


def shingled(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """doc_id, n, c1, c2 (hashes of the set), its sketch and join keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                sets = shingle_sets(part.column("text").to_pylist(), words)
                c1 = [np.add.reduce(mix64(s ^ _M3)) for s in sets]
                c2 = [np.add.reduce(mix64(s + _M1)) for s in sets]
                columns = [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), _long(c1), _long(c2)]
                columns += [_lists([sketch(s) for s in sets]), _lists([block_keys(s, percent) for s in sets])]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "c1", "c2", "sketch", "keys"])
        forget_words()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, c1 long, c2 long, sketch array<long>, keys array<long>")


def with_sets(docs: DataFrame, words: int) -> DataFrame:
    """id and shingle hashes of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                sets = shingle_sets(part.column("text").to_pylist(), words)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), _lists(sets)], ["id", "shingles"])
        forget_words()

    return docs.mapInArrow(run, "id long, shingles array<long>")


def sketch_distance(one: str, other: str) -> Column:
    """Bits that differ, at the length of the shorter sketch (NULL for lengths further apart than twofold: such sets never link)."""

    def folded(own: str, to: str) -> Column:
        half = F.shiftright(F.size(own), 1)
        halves = F.zip_with(F.slice(own, F.lit(1), half), F.slice(own, half + 1, half), lambda p, q: p.bitwiseXOR(q))
        return F.when(F.size(own) > F.size(to), halves).otherwise(F.col(own))

    bits = F.zip_with(folded(one, other), folded(other, one), lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    return F.aggregate(bits, F.lit(0), lambda s, v: s + v)


def may_link(n1: str, n2: str, sketch1: str, sketch2: str, percent: int) -> Column:
    """Whether sizes and sketches leave room for the similarity."""
    sizes = 100 * F.least(n1, n2) >= percent * F.greatest(n1, n2)
    return sizes & (sketch_distance(sketch1, sketch2) * (100 + percent) <= (F.col(n1) + F.col(n2)) * (100 - percent))


def linked(pairs: DataFrame, docs: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) of representatives whose sets have the similarity."""

    def side(c: str) -> DataFrame:
        return classes.select(F.col("rep").alias(c), F.col("n").alias(f"n{c}"), F.col("sketch").alias(f"sketch{c}"))

    spark = docs.sparkSession
    pairs, looked_at = staged_as(pairs, "candidates")
    small = F.broadcast if pairs.count() <= FEW_PAIRS else (lambda x: x)
    near = side("b").join(small(side("a").join(small(pairs), "a")), "b").where(may_link("na", "nb", "sketcha", "sketchb", percent))
    near = stage(near.select("a", "b").distinct(), "pairs")
    discard(spark, looked_at)
    if not near.take(1):
        return near
    ids = stage(near.select(F.col("a").alias("doc_id")).union(near.select(F.col("b").alias("doc_id"))).distinct(), "ids")
    few = ids.count() <= FEW_IDS
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")
    with text_batches(spark):
        sets, heavy = staged_as(with_sets(texts, words), "sets")  # rows that repeat an id meet as equal links
    a = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    both = near.join(b, "b").join(a, "a").withColumn("common", F.size(F.array_intersect("sa", "sb")))
    links = stage(both.where(100 * F.col("common") >= percent * (F.size("sa") + F.size("sb") - F.col("common"))).select("a", "b").distinct(), "links")
    discard(spark, heavy)
    return links


class Members:
    """Members of a common key, with sketches at the length of the shortest and, where given, 32 bits of each shingle's hash."""

    def __init__(self, table: pa.Table | pa.RecordBatch):
        self.ids, self.groups, self.n = (table[c].to_numpy() for c in ("id", "group", "n"))
        self.marks = None
        if "marks" in table.schema.names:
            chunks = table["marks"].chunks if isinstance(table, pa.Table) else [table["marks"]]
            self.marks = np.concatenate([c.flatten().to_numpy() for c in chunks]).view(np.uint32).astype(np.uint64)
            self.held = np.concatenate([c.value_lengths().to_numpy() for c in chunks]).astype(np.int64)
            self.starts = np.cumsum(self.held) - self.held
        lists = [np.asarray(v.values, dtype=np.int64).view(np.uint64) for v in table["sketch"]]
        self.words = min(map(len, lists))
        self.sketches = np.stack([self.folded(v, self.words) for v in lists])

    @staticmethod
    def folded(sketch: np.ndarray, words: int) -> np.ndarray:
        return np.bitwise_xor.reduce(sketch.reshape(-1, words), axis=0)

    def at(self, words: int) -> np.ndarray:
        return np.bitwise_xor.reduce(self.sketches.reshape(len(self.ids), -1, words), axis=1)

    def marks_of(self, chosen: np.ndarray) -> np.ndarray:
        """Marks of the chosen members, each with its place among them in the upper half."""
        n = self.held[chosen]
        at = np.repeat(self.starts[chosen] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return (np.repeat(np.arange(len(chosen), dtype=np.uint64), n) << np.uint64(32)) | self.marks[at]


def marks_apart(one: Members, i: np.ndarray, other: Members, j: np.ndarray) -> np.ndarray:
    """Per pair of a member of ``one`` and one of ``other``, how many marks only one of them has (never more than shingles)."""
    out = np.zeros(len(i), dtype=np.int64)
    ends = np.cumsum(one.held[i] + other.held[j])
    at = 0
    while at < len(i):
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + TILE, side="right")))
        both = np.sort(np.concatenate([one.marks_of(i[at:end]), other.marks_of(j[at:end])]))
        first = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]]))
        odd = np.diff(np.append(first, len(both))) % 2 == 1
        out[at:end] = np.bincount((both[first[odd]] >> np.uint64(32)).astype(np.int64), minlength=end - at)
        at = end
    return out


def _near_members(percent: int):
    """Pairs of members in different groups whose sizes, sketches and marks leave room for the similarity."""

    def answer(block: Members, batch: pa.RecordBatch) -> pa.RecordBatch:
        asked = Members(batch)
        words = min(block.words, asked.words)
        own, other = block.at(words), asked.at(words)
        low, high = np.minimum, np.maximum
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        step = max(1, TILE // (len(own) * words))
        for at in range(0, len(other), step):
            part = slice(at, at + step)
            n, m = asked.n[part, None], block.n[None, :]
            apart = np.bitwise_count(other[part, None, :] ^ own[None, :, :]).sum(axis=2, dtype=np.int64)
            near = (asked.ids[part, None] < block.ids[None, :]) & (asked.groups[part, None] != block.groups[None, :])
            near &= (100 * low(n, m) >= percent * high(n, m)) & (apart * (100 + percent) <= (n + m) * (100 - percent))
            i, j = np.nonzero(near)
            if block.marks is not None and len(i):
                # Sketches of few bits let pairs just beyond the limit pass: in a large group, a share of all its pairs.
                close = marks_apart(asked, i + at, block, j) * (100 + percent) <= (asked.n[i + at] + block.n[j]) * (100 - percent)
                i, j = i[close], j[close]
            a.append(asked.ids[part][i])
            b.append(block.ids[j])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

    return answer


def with_marks(members: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """``members`` with 32 bits of the hash of each shingle (marks), which are looked up by rep and n."""
    ids, spark = stage(members.select(F.col("rep").alias("doc_id")).distinct(), "common-ids"), docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    texts = texts.join(F.broadcast(ids) if ids.count() <= FEW_IDS else ids, "doc_id", "left_semi")
    marks = F.transform("shingles", lambda h: h.bitwiseAND(0xFFFFFFFF))
    marks = F.transform(marks, lambda h: F.when(h >= 1 << 31, h - (1 << 32)).otherwise(h).cast("int"))  # no overflow in ANSI mode
    sets = with_sets(texts, words).select(F.col("id").alias("rep"), F.size("shingles").cast("long").alias("n"), marks.alias("marks"))
    # Repeated rows have equal sets; an id with several texts has each of their sets.
    sets = sets.withColumn("mark", F.xxhash64("marks")).dropDuplicates(["rep", "n", "mark"]).drop("mark")
    with text_batches(spark):
        sets = stage(sets, "marks")
    return members.join(sets, ["rep", "n"])


def near_pairs(members: DataFrame, percent: int, marked: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """a, b: members (key, size of the key, rep, group, n, sketch) of one key in different groups that may link.

    Keys of few members are joined with themselves. Members of a common key are
    dealt into blocks, which all of its members pass in Arrow batches: no task
    holds more than a block and a batch of it. ``marked`` adds their marks: with
    them, nearly all pairs that are left do link, however large the group.
    """
    few = members.where(F.col("size") <= FEW_MEMBERS)
    x, y = (few.select("key", *(F.col(c).alias(f"{c}{i}") for c in ("rep", "group", "n", "sketch"))) for i in (1, 2))
    near = (F.col("rep1") < F.col("rep2")) & (F.col("group1") != F.col("group2")) & may_link("n1", "n2", "sketch1", "sketch2", percent)
    pairs = x.join(y, (x["key"] == y["key"]) & near).select(F.col("rep1").alias("a"), F.col("rep2").alias("b"))
    many = members.where(F.col("size") > FEW_MEMBERS).withColumnRenamed("rep", "id").withColumn("blocks", F.ceil(F.col("size") / BLOCK_MEMBERS))
    largest = many.agg(F.max("size")).first()[0]
    if largest is None:
        return pairs
    if marked is not None:
        held = many.groupBy("key").agg(F.ceil(F.sum("n") / BLOCK_MARKS).alias("held"))
        many = many.join(held, "key").withColumn("blocks", F.greatest("blocks", "held")).drop("held")
        many = marked(many.withColumnRenamed("id", "rep")).withColumnRenamed("rep", "id")
    index = many.withColumn("block", F.pmod(F.xxhash64("id"), "blocks")).drop("blocks", "size")
    asked = many.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).drop("blocks", "size")
    return pairs.union(sweep(index, asked, ["key", "block"], largest, Members, _near_members(percent), "a long, b long"))


def components(links: DataFrame) -> DataFrame:
    """``id``, ``component`` (the smallest id reachable) for every end of ``links`` (a, b), by alternating stars.

    Every round each node hangs its larger neighbours, then its smaller ones, under
    the smallest; groups end as stars after few rounds. Edges stay in Spark.
    """
    edges = stage(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    mark = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        edges = stage(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        new = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if new == mark:
            break
        mark = new
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def jaccard_groups(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id for every row of ``docs`` (doc_id, text).

    ``component_id`` is the smallest doc_id reachable by links of similarity
    ``percent`` / 100 or more, the document itself included. Texts without words
    (NULL and empty ones too) have no shingles and link with nothing. A row without
    an id takes no part in links and has no component. Repeated rows are equal
    sets, and rows of one id with several texts are one document with the links of
    them all. Extra columns are left out; an empty table gives an empty table.
    """
    spark = docs.sparkSession
    with text_batches(spark):
        whole, heavy = staged_as(shingled(docs, words, percent), "shingled")
    some = whole.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    classes = stage(some.groupBy("c1", "c2").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch")), "classes")

    # Copies have equal keys: they are posted by class, and keys of one class bring nothing together.
    posted = some.select("c1", F.explode("keys").alias("key"))
    w = Window.partitionBy("key")
    shared = posted.withColumns({"low": F.min("c1").over(w), "high": F.max("c1").over(w)}).where("low <> high").select("key", "c1").distinct()
    members = stage(shared.join(classes.select("c1", "rep"), "c1").select("key", "rep"), "members")
    nodes = stage(whole.select("doc_id", "n", "c1", "c2"), "nodes")
    discard(spark, heavy)  # sketches are with the classes, keys with the members

    edges = found = None
    for r in range(ROUNDS + 1):
        if found is None:
            grouped = members.withColumn("group", F.col("rep"))
        else:
            grouped = members.join(found, F.col("rep") == F.col("id"), "left").select("key", "rep", F.coalesce("component", "rep").alias("group"))
        # At first one member for all keys it is in, as far as can be; then another one a key.
        draw = F.xxhash64(F.lit(r), "rep") if r == 0 else F.xxhash64(F.lit(r), "key", "rep")
        first = F.min(F.struct(draw.alias("draw"), F.col("rep").alias("a"), "group"))
        open_keys = grouped.groupBy("key").agg(F.min("group").alias("low"), F.max("group").alias("high"), F.count(F.lit(1)).alias("size"), first.alias("first"))
        open_keys = open_keys.where((F.col("low") != F.col("high")) & (F.col("size") > (1 if r == 0 else 2)))  # the first round has seen pairs
        grouped = grouped.join(open_keys.select("key", "first", "size"), "key")
        if r < ROUNDS:
            pairs = grouped.where(F.col("group") != F.col("first.group")).select("first.a", F.col("rep").alias("b"))
            pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        else:
            full = stage(grouped.select("key", "rep", "group", "size").join(classes.select("rep", "n", "sketch"), "rep"), "mixed")
            pairs = near_pairs(full, percent, lambda common: with_marks(common, docs, words)).distinct()
        links = linked(pairs, docs, classes, words, percent)
        edges = links if edges is None else found.select(F.col("id").alias("a"), F.col("component").alias("b")).union(links)
        if found is None or links.take(1):
            found = stage(components(edges), "components")

    rep = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("rep"))
    out = nodes.join(classes.select("c1", "c2", "rep"), ["c1", "c2"], "left").withColumn("rep", rep)
    out = out.join(found, F.col("rep") == F.col("id"), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep", "doc_id").alias("component_id"))


def query(docs: DataFrame) -> DataFrame:
    return jaccard_groups(docs)


SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(generate_series(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * p.c >= 85 * (x.n + y.n - p.c)),
r AS (SELECT doc_id, doc_id AS root FROM documents UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.doc_id)
SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r.root) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN r ON r.doc_id = d.doc_id GROUP BY d.doc_id
"""
