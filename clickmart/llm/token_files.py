"""Operator 7, token-id files with a shared zstandard dictionary.

A dictionary is trained on the serialised ids of a bounded sample; every
document's ids are compressed on their own with it, so one short document can
be read without its neighbours. A shard holds documents in ascending ``doc_id``
order and is self-contained bytes::

    magic "TIDZ0001" | id width, 4 | documents n, 4 | ids before in block, 8 | dictionary SHA-256, 32
    | n bytes: id present | n * 8 doc_ids | n * 4 id counts | (n + 1) * 8 offsets | frames

Executors reach the shared store only through Spark's writers, so shards are
the rows of a Parquet folder (``block, shard, docs, ids, bytes``), beside a
folder with the dictionary.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmart.llm.common import block_of, range_cuts, running_before, shuffle_partitions, text_of
from clickmart.llm.tokens import batch_chunks, encoder, tokenizer_path
from clickmart.session import staging_path

MAGIC = b"TIDZ0001"
HEAD = "<8sIIQ32s"
END_ID = 2
#: The dictionary is trained on about this many documents, and on this many bytes of ids of each at most, in blocks from all of it.
SAMPLE_DOCS, SAMPLE_BYTES, SAMPLE_BLOCK, DICTIONARY_BYTES = 2_000, 65_536, 4_096, 65_536
SHARD_BYTES = 4 << 20
LEVEL = 3


def train_dictionary(docs: DataFrame, tokenizer: str, end_id: int = END_ID, sample_docs: int = SAMPLE_DOCS) -> bytes:
    """Dictionary bytes from documents chosen by a hash of their id; raw content if there is too little to train on."""
    share = min(1.0, sample_docs / max(1, docs.count()))
    chosen = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))).limit(2 * sample_docs)
    texts = chosen.select(text_of().alias("text")).mapInArrow(_encode_with(tokenizer, end_id, None, SAMPLE_BYTES), "n long, frame binary")
    samples = [bytes(r.frame) for r in texts.select("n", "frame").collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # tables too small for training
        return (b"".join(samples) or b"\0" * 16)[-DICTIONARY_BYTES:].ljust(16, b"\0")


def sample_blocks(data: bytes, limit: int, block: int = SAMPLE_BLOCK) -> bytes:
    """At most ``limit`` bytes from all over ``data``: its blocks with the smallest hashes, in order. Shorter data whole."""
    if len(data) <= limit:
        return data
    starts = range(0, len(data), block)
    chosen = sorted(starts, key=lambda at: (zlib.crc32(data[at : at + block], at & 0xFFFFFFFF), at))[: limit // block]
    return b"".join(data[at : at + block] for at in sorted(chosen))


def _dictionary(raw: bytes) -> zstandard.ZstdCompressionDict:
    return zstandard.ZstdCompressionDict(raw)


def _encode_with(tokenizer: str, end_id: int, raw: bytes | None, limit: int = SAMPLE_BYTES):
    """Arrow batches of texts to id counts and frames; without a dictionary, to at most ``limit`` bytes of the serialised ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        width = 2 if max(enc.vocabulary, end_id + 1) <= 1 << 16 else 4
        end = int(end_id).to_bytes(4, "little")
        pack = None if raw is None else zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(raw))
        for batch in (some for batch in batches for some in batch_chunks(batch, "text")):
            n, frames = [], []
            for ids in enc.encode_all(batch.column("text")):
                ids += end
                n.append(len(ids) // 4)
                data = np.frombuffer(ids, dtype="<u4").astype(f"<u{width}").tobytes()
                frames.append(sample_blocks(data, limit) if pack is None else pack.compress(data))
            kept = [batch.column(c) for c in batch.schema.names if c != "text"]
            names = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(n, pa.int64()), pa.array(frames, pa.binary())], [*names, "n", "frame"])
        enc.forget()

    return run


def shard_bytes(width: int, before: int, digest: bytes, doc_ids: list[int | None], counts: list[int], frames: list[bytes]) -> bytes:
    n = len(doc_ids)
    offsets = np.concatenate([[0], np.cumsum([len(f) for f in frames])]).astype("<u8")
    present = bytes(d is not None for d in doc_ids)
    ids = np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes()
    return b"".join([struct.pack(HEAD, MAGIC, width, n, before, digest), present, ids, np.array(counts, dtype="<u4").tobytes(), offsets.tobytes(), *frames])


class Shard:
    """Reads one shard; ``ids(i)`` touches that document's frame alone."""

    def __init__(self, data: bytes, raw: bytes):
        magic, self.width, n, self.before, digest = struct.unpack_from(HEAD, data)
        if magic != MAGIC or digest != hashlib.sha256(raw).digest():
            raise ValueError("not a token shard, or written with another dictionary")
        at = struct.calcsize(HEAD)
        present = data[at : at + n]
        at += n
        self.doc_ids = [d if p else None for d, p in zip(np.frombuffer(data, "<i8", n, at).tolist(), present, strict=True)]
        self.counts = np.frombuffer(data, "<u4", n, at + 8 * n)
        self.offsets = np.frombuffer(data, "<u8", n + 1, at + 12 * n).astype(np.int64) + at + 12 * n + 8 * (n + 1)
        self.data = data
        self.unpack = zstandard.ZstdDecompressor(dict_data=_dictionary(raw))

    def ids(self, i: int) -> np.ndarray:
        frame = self.data[self.offsets[i] : self.offsets[i + 1]]
        return np.frombuffer(self.unpack.decompress(frame), dtype=f"<u{self.width}")


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, shard_bytes_target: int = SHARD_BYTES) -> None:
    """Write all rows of ``docs`` (doc_id integer, text) to ``path``.

    NULL and empty texts are just the end id. Documents lie in ascending
    ``doc_id`` order (NULL first, ties by their frame): key ranges are the blocks,
    a block's documents are sorted in one task and shards are cut by size. Very
    long texts are encoded whole, as one frame. Extra columns are left out. An empty table writes no shards.
    """
    spark = docs.sparkSession
    raw = train_dictionary(docs, tokenizer, end_id)
    digest = hashlib.sha256(raw).digest()
    spark.createDataFrame([(digest.hex(), bytearray(raw))], "sha256 string, dictionary binary").coalesce(1).write.parquet(f"{path}/dictionary")

    blocks = 4 * shuffle_partitions(spark)
    cuts = range_cuts(docs, "doc_id", blocks)
    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(block_of(doc_id, cuts).cast("int").alias("block"), doc_id.alias("doc_id"), text_of().alias("text"))
    frames = rows.mapInArrow(_encode_with(tokenizer, end_id, raw), "block int, doc_id long, n long, frame binary")
    frames = frames.repartition(shuffle_partitions(spark), "block").sortWithinPartitions("block", F.col("doc_id").asc_nulls_first(), "n", "frame")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        width = 2 if max(enc.vocabulary, end_id + 1) <= 1 << 16 else 4
        block, shard, before, size, ids, counts, parts = None, 0, 0, 0, [], [], []

        def flush():
            data = shard_bytes(width, before, digest, ids, counts, parts)
            return pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in ((block, pa.int32()), (shard, pa.int64()), (len(ids), pa.int64()), (sum(counts), pa.int64()), (data, pa.binary()))],
                ["block", "shard", "docs", "ids", "bytes"],
            )

        for batch in batches:
            for b, d, n, f in zip(*(batch.column(c).to_pylist() for c in ("block", "doc_id", "n", "frame")), strict=True):
                if ids and (b != block or size >= shard_bytes_target):
                    yield flush()
                    shard, before, size = shard + 1, before + sum(counts), 0
                    ids, counts, parts = [], [], []
                if b != block:
                    block, shard, before = b, 0, 0
                ids.append(d)
                counts.append(n)
                parts.append(f)
                size += len(f)
        if ids:
            yield flush()

    frames.mapInArrow(build, "block int, shard long, docs long, ids long, bytes binary").write.parquet(f"{path}/shards")


def read_token_files(spark: SparkSession, path: str, digest_only: bool = False) -> DataFrame:
    """Documents of a token folder: doc_id, start (ids of all documents before), n_tokens, and ``ids``
    (little-endian unsigned 32-bit bytes) or, with ``digest_only``, just their ``ids_crc32``."""
    raw = bytes(spark.read.parquet(f"{path}/dictionary").first().dictionary)
    shards = spark.read.schema("block int, shard long, docs long, ids long, bytes binary").parquet(f"{path}/shards")
    sums = shards.groupBy("block").agg(F.sum("ids").alias("ids"))
    base = running_before(sums, "block", ["ids"])  # one number a block
    last = ("ids_crc32", pa.int64()) if digest_only else ("ids", pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data in zip(batch.column("block").to_pylist(), batch.column("bytes").to_pylist(), strict=True):
                s = Shard(data, raw)
                starts = base[block][0] + s.before + np.concatenate([[0], np.cumsum(s.counts, dtype=np.int64)])[:-1]
                n, out = [], []
                for i in range(len(s.doc_ids)):
                    ids = s.ids(i).astype("<u4")
                    n.append(len(ids))
                    out.append(zlib.crc32(ids.tobytes()) if digest_only else ids.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s.doc_ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(n, pa.int64()), pa.array(out, last[1])],
                    ["doc_id", "start", "n_tokens", last[0]],
                )

    kind = "long" if digest_only else "binary"
    return shards.select("block", "bytes").mapInArrow(run, f"doc_id long, start long, n_tokens long, {last[0]} {kind}")


def query(docs: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    path = staging_path(spark, "token-files")
    write_token_files(docs, path, tokenizer_path("word_bpe_49k.json"))
    return read_token_files(spark, path, digest_only=True)
