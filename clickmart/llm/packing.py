"""Operator 2, packing by non-negative least squares.

A document's ids fill whole windows first; what remains (shorter than a
window) goes into a histogram of lengths. All combinations of two or three
lengths that fill a window exactly are the columns of ``A``; repeat counts ``x >= 0``
minimise ``|A x - histogram|``, are rounded down so that no length is
overdrawn, and are raised again one by one while stock lasts. What is left is
packed greedily in one run, cutting the piece that crosses a window's end.

The driver sees the histogram (one number a length) and the counts; documents
find their place by their rank within their length, which is counted per
partition and shifted by the partitions before.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickmart.llm.common import running_before, stage, text_batches, text_of
from clickmart.llm.tokens import batch_chunks, encoder, tokenizer_path

WINDOW = 1024
END_ID = 0
ROUNDS = 400
#: Above this window only pairs are enumerated: triples grow with its square.
TRIPLES_UP_TO = 2048
#: Pieces that were cut, up to which the join with the ids is a broadcast (about 40 bytes each).
FEW_CUTS = 100_000


class Packed(NamedTuple):
    """``pieces``: doc_id, part, row, start, length, ids_crc32, doc_tokens, sequence_id, offset.
    ``tokens``: part, row, doc_id, ids (little-endian unsigned 32-bit), one row a document."""

    pieces: DataFrame
    tokens: DataFrame


def tokenise(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """One row a document: ids, their number, the checksum of each window, and the document's rank in its
    partition among documents whose last piece has the same length."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, row, full = encoder(tokenizer), TaskContext.get().partitionId(), 0, 0
        seen = np.zeros(window, dtype=np.int64)
        for doc_ids, texts in ((some.column("doc_id"), some.column("text")) for batch in batches for some in batch_chunks(batch, "text")):
            out = []
            for ids in enc.encode_all(texts):
                ids += end
                n = len(ids) // 4
                rest = n % window
                sums = np.array([zlib.crc32(ids[i : i + 4 * window]) for i in range(0, len(ids), 4 * window)], dtype="<u4").tobytes()
                out.append((n, part, row, int(seen[rest]), full, sums, ids))
                seen[rest] += 1
                full += n // window
                row += 1
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [doc_ids, *(pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True))],
                ["doc_id", "n", "part", "row", "rank", "full_before", "sums", "ids"],
            )
        enc.forget()

    rows = docs.select("doc_id", text_of().alias("text"))
    return rows.mapInArrow(run, f"doc_id {id_type}, n long, part int, row long, rank long, full_before long, sums binary, ids binary")


def combinations(window: int) -> np.ndarray:
    """Columns of A: rows of three ascending lengths with sum ``window``; a pair has 0 first."""
    first = np.arange(1, window // 2 + 1)
    pairs = np.stack([np.zeros_like(first), first, window - first], axis=1)
    if window > TRIPLES_UP_TO:
        return pairs
    a, b = np.meshgrid(np.arange(1, window // 3 + 1), first, indexing="ij")
    c = window - a - b
    ok = (a <= b) & (b <= c)
    return np.concatenate([pairs, np.stack([a[ok], b[ok], c[ok]], axis=1)])


def solve(histogram: np.ndarray, window: int = WINDOW, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Combinations and how often each is used: accelerated projected gradient, rounded within stock."""
    histogram = histogram.astype(np.float64)
    combos = combinations(window)
    has = histogram > 0
    has[0] = True
    combos = combos[has[combos].all(axis=1)]  # a length that does not occur can't be used
    if not len(combos):
        return combos, np.zeros(0, dtype=np.int64)

    def used(x: np.ndarray) -> np.ndarray:
        u = sum(np.bincount(combos[:, j], x, minlength=window) for j in range(3))
        u[0] = 0
        return u

    degree = used(np.ones(len(combos)))
    step = 1.0 / (3.0 * degree.max())
    x = y = np.zeros(len(combos))
    t = 1.0
    for _ in range(rounds):
        residual = used(y) - histogram
        residual[0] = 0
        z = np.maximum(0.0, y - step * residual[combos].sum(axis=1))
        s = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y, x, t = z + (t - 1) / s * (z - x), z, s
    # Where least squares overdraws a length, its combinations shrink in proportion; then round down.
    over = np.where(used(x) > histogram, histogram / np.maximum(used(x), 1e-12), 1.0)
    over[0] = 1.0
    scaled = x * over[combos].min(axis=1)
    counts = np.floor(scaled + 1e-9).astype(np.int64)
    stock = histogram.astype(np.int64) - used(counts.astype(np.float64)).astype(np.int64)
    stock[0] = np.iinfo(np.int64).max // 2
    for i in np.argsort(counts - scaled, kind="stable"):
        lengths, need = np.unique(combos[i][combos[i] > 0], return_counts=True)
        more = int((stock[lengths] // need).min())
        if more > 0:
            counts[i] += more
            stock[lengths] -= more * need
    keep = counts > 0
    return combos[keep], counts[keep]


class Layout(NamedTuple):
    """Where the pieces go. Entry i takes ranks ``keys[i] % 2**40 ..`` of length ``keys[i] >> 40``."""

    keys: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    planned: np.ndarray  # per length, how many ranks the combinations take
    left_at: np.ndarray  # per length, where its left-over pieces begin in the greedy run
    left_total: int
    left_sequence: int


def layout(histogram: np.ndarray, first_sequence: int, window: int = WINDOW) -> Layout:
    combos, counts = solve(histogram, window)
    at = first_sequence + np.concatenate([[0], np.cumsum(counts)])[:-1]
    taken = np.zeros(window, dtype=np.int64)
    keys, sequence, offset = [], [], []
    for combo, count, seq in zip(combos.tolist(), counts.tolist(), at.tolist(), strict=True):
        pos = 0
        for length in combo:
            if length:
                keys.append((length << 40) + int(taken[length]))
                sequence.append(seq)
                offset.append(pos)
                taken[length] += count
                pos += length
    order = np.argsort(np.array(keys, dtype=np.int64), kind="stable")
    lengths = np.arange(window)
    left = (histogram.astype(np.int64) - taken) * lengths
    return Layout(
        *(np.array(v, dtype=np.int64)[order] for v in (keys, sequence, offset)),
        taken,
        np.concatenate([[0], np.cumsum(left[::-1])])[:-1][::-1],  # long pieces first
        int(left.sum()),
        first_sequence + int(counts.sum()),
    )


def greedy_run(pos: np.ndarray, plan: Layout, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequence, offset and room for positions in the greedy run. Its tail, shorter than a window, is cut into
    powers of two, which need no padding."""
    whole, tail = divmod(plan.left_total, window)
    sizes = [1 << b for b in range(window.bit_length() - 1, -1, -1) if tail >> b & 1]
    starts = whole * window + np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    in_tail = pos >= whole * window
    k = np.clip(np.searchsorted(starts, pos, side="right") - 1, 0, max(0, len(sizes) - 1))
    size = np.array(sizes or [window], dtype=np.int64)[k]
    seq = np.where(in_tail, whole + k, pos // window)
    off = np.where(in_tail, pos - starts[k], pos % window)
    return plan.left_sequence + seq, off, np.where(in_tail, size, window) - off


def place(meta: DataFrame, plan: Layout, full_before: dict[int, tuple[int, ...]], window: int) -> DataFrame:
    """Pieces of every document: ``meta`` has doc_id, n, part, row, rank (global), full_before, sums."""
    id_type = meta.schema["doc_id"].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            n, part = f["n"].to_numpy(), f["part"].to_numpy()
            rank, rest, full = f["rank"].to_numpy(), n % window, n // window
            first = f["full_before"].to_numpy() + np.array([full_before[p][0] for p in part.tolist()], dtype=np.int64)
            sums = [np.frombuffer(s, dtype="<u4") for s in f["sums"]]
            out = []

            def add(at, start, length, sequence, offset, crc, f=f, n=n, out=out):
                out.append(
                    pd.DataFrame(
                        {"doc_id": f["doc_id"].to_numpy()[at], "part": f["part"].to_numpy()[at], "row": f["row"].to_numpy()[at], "start": start, "length": length}
                        | {"ids_crc32": pd.array(crc, dtype="Int64"), "doc_tokens": n[at], "sequence_id": sequence, "offset": offset}
                    )
                )

            # Whole windows are sequences of their own.
            at = np.repeat(np.arange(len(f)), full)
            k = np.arange(len(at)) - np.repeat(np.cumsum(full) - full, full)
            crc = np.concatenate([s[:w] for s, w in zip(sums, full, strict=True)] or [np.zeros(0)]).astype(np.int64)
            add(at, k * window, np.full(len(at), window), first[at] + k, np.zeros(len(at), dtype=np.int64), crc)
            last = np.array([int(s[-1]) for s in sums], dtype=np.int64)
            # Remainders that the solved combinations take.
            at = np.flatnonzero((rest > 0) & (rank < plan.planned[rest]))
            i = np.searchsorted(plan.keys, (rest[at] << 40) + rank[at], side="right") - 1
            if len(at):
                add(at, full[at] * window, rest[at], plan.sequence[i] + (rest[at] << 40) + rank[at] - plan.keys[i], plan.offset[i], last[at])
            # The others lie end to end; a window's end cuts.
            at = np.flatnonzero((rest > 0) & (rank >= plan.planned[rest]))
            pos = plan.left_at[rest[at]] + (rank[at] - plan.planned[rest[at]]) * rest[at]
            start, todo = full[at] * window, rest[at].copy()
            while len(at):
                sequence, offset, room = greedy_run(pos, plan, window)
                length = np.minimum(todo, room)
                crc = pd.array(last[at], dtype="Int64")
                crc[length != rest[at]] = pd.NA
                add(at, start, length, sequence, offset, crc)
                more = todo > length
                at, pos, start, todo = at[more], (pos + length)[more], (start + length)[more], (todo - length)[more]
            yield pd.concat(out)

    return meta.mapInPandas(run, f"doc_id {id_type}, part int, row long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID) -> Packed:
    """Pack every row of ``docs`` (doc_id, text) into sequences of at most ``window`` ids.

    A row's ids are its text's plus ``end_id``; NULL and empty texts are just that
    id. Every id lies in one piece; sequences are gapless from offset 0. All are
    full but at most ``log2(window)`` of power-of-two length. Repeated rows and
    NULL ids are rows like any other; extra columns are left out. An empty table
    has no pieces.
    """
    with text_batches(docs.sparkSession):
        tokens = stage(tokenise(docs, tokenizer, window, end_id), "token-ids")
    meta = tokens.select("doc_id", "n", "part", "row", "rank", "full_before", "sums")
    rest = (F.col("n") % window).cast("int")
    by_length = meta.groupBy(rest.alias("rest"), "part").agg(F.count(F.lit(1)).alias("docs"), F.sum(F.floor(F.col("n") / window)).alias("windows"))
    by_length = stage(by_length, "lengths")
    histogram = np.zeros(window, dtype=np.int64)
    for r in by_length.groupBy("rest").agg(F.sum("docs").alias("docs")).collect():  # at most one row a length
        histogram[r.rest] = r.docs
    histogram[0] = 0
    full_before = running_before(by_length.groupBy("part").agg(F.sum("windows").alias("windows")), "part", ["windows"])
    windows = by_length.agg(F.sum("windows")).first()[0] or 0
    plan = layout(histogram, int(windows), window)

    earlier = Window.partitionBy("rest").orderBy("part")
    shift = by_length.select("rest", F.col("part").alias("p"), (F.sum("docs").over(earlier) - F.col("docs")).alias("shift"))
    ranked = meta.join(shift, (rest == shift["rest"]) & (F.col("part") == F.col("p"))).withColumn("rank", F.col("rank") + F.col("shift"))
    placed = stage(place(ranked.select(*meta.columns), plan, full_before, window), "pieces")

    # Only pieces that were cut need a look at their ids again.
    cut = placed.where(F.col("ids_crc32").isNull()).drop("ids_crc32")
    if cut.count() <= FEW_CUTS:
        cut = F.broadcast(cut)
    ids = F.substring(F.col("ids"), (F.col("start") * 4 + 1).cast("int"), (F.col("length") * 4).cast("int"))
    cut = tokens.select("part", "row", "ids").join(cut, ["part", "row"]).withColumn("ids_crc32", F.crc32(ids)).drop("ids")
    pieces = placed.where(F.col("ids_crc32").isNotNull()).unionByName(cut)
    return Packed(pieces, tokens)


def with_ids(packed: Packed) -> DataFrame:
    """The pieces with their ids, for writing out sequences."""
    ids = F.substring(F.col("ids"), (F.col("start") * 4 + 1).cast("int"), (F.col("length") * 4).cast("int"))
    return packed.pieces.join(packed.tokens.select("part", "row", "ids"), ["part", "row"]).withColumn("ids", ids)


def query(docs: DataFrame) -> DataFrame:
    pieces = pack(docs, tokenizer_path("byte_bpe_50k.json")).pieces
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
