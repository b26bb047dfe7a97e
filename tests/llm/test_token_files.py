import zlib

import numpy as np
import pytest

from clickmart.llm import token_files
from clickmart.llm.tokens import tokenizer_path
from clickmart.session import staging_path

from .edge import edge_docs, empty_docs, rows
from .test_packing import whole_ids

BPE = tokenizer_path("word_bpe_49k.json")


def test_round_trip_of_edge_rows(spark):
    path = staging_path(spark, "t-tokens")
    token_files.write_token_files(edge_docs(spark, ("block", "n", "frame")), path, BPE, shard_bytes_target=64)
    got = token_files.read_token_files(spark, path).collect()
    texts = [(d, t or "") for d, t, *_ in rows()]
    want = sorted(((d, ids + [2]) for (d, _), ids in zip(texts, whole_ids([t for _, t in texts], BPE))), key=lambda r: (r[0] is not None, r[0] or 0, len(r[1])))
    got.sort(key=lambda r: r.start)
    assert [(r.doc_id, np.frombuffer(bytes(r.ids), "<u4").tolist()) for r in got] == want
    assert [r.start for r in got] == np.concatenate([[0], np.cumsum([len(i) for _, i in want])])[:-1].tolist()
    crc = {(r.doc_id, r.start): r.ids_crc32 for r in token_files.read_token_files(spark, path, digest_only=True).collect()}
    assert all(crc[(r.doc_id, r.start)] == zlib.crc32(bytes(r.ids)) for r in got)


def test_one_document_is_read_alone_and_dictionary_is_checked():
    raw = b"dictionary bytes of some length, raw content"
    comp = token_files.zstandard.ZstdCompressor(dict_data=token_files._dictionary(raw))
    docs = [np.arange(n, dtype="<u2") for n in (3, 0, 500)]
    digest = token_files.hashlib.sha256(raw).digest()
    data = token_files.shard_bytes(2, 7, digest, [4, None, 9], [len(d) for d in docs], [comp.compress(d.tobytes()) for d in docs])
    shard = token_files.Shard(data, raw)
    assert shard.before == 7 and shard.doc_ids == [4, None, 9] and shard.ids(2).tolist() == list(range(500)) and shard.ids(1).tolist() == []
    with pytest.raises(ValueError):
        token_files.Shard(data, raw + b"!")


def test_generated_table_and_empty_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_files.query(docs.repartition(3)).collect()}
    rows_ = sorted(docs.select("doc_id", "text").collect(), key=lambda r: r.doc_id)
    start = 0
    for r, ids in zip(rows_, whole_ids([r.text for r in rows_], BPE)):
        ids = np.array(ids + [2], dtype="<u4")
        assert got[r.doc_id] == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert token_files.query(empty_docs(spark)).count() == 0


def test_sample_of_a_long_document_is_from_all_of_it():
    data = np.arange(100_000, dtype="<u4").tobytes()
    got = token_files.sample_blocks(data, 16_384)
    assert len(got) == 16_384 and got == token_files.sample_blocks(data, 16_384)
    places = [data.find(got[i : i + 4_096]) // 4_096 for i in range(0, len(got), 4_096)]
    assert len(set(places)) == 4 and all(p >= 0 for p in places) and max(places) > 40
    assert token_files.sample_blocks(data[:16_384], 16_384) == data[:16_384]
    assert token_files.sample_blocks(b"", 16_384) == b""


def test_words_are_cut_and_looked_up_by_arrow():
    """Blanks and line feeds cut words; every text has the ids that the tokenizer gives for the whole of it."""
    from clickmart.llm import tokens

    parts, counts = tokens._cut(tokens._strings(["a b", "", None, " c ", "dé"]))
    assert parts.to_pylist() == ["a", "b", "", "", "c", "", "dé"] and counts.tolist() == [2, 1, 0, 3, 1]
    texts = ["", "\n", " ", "one two", "One\ntwo  one", "  lead", "tail ", "a\tb c", "é È\n漢字 x", "one", "x " * 300]
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        enc = tokens.Encoder(tokens.tokenizer_path(name))
        assert enc.encode_all(texts) == enc._plain(texts) == enc.encode_all(texts)
        assert enc.encode_all([]) == []


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_a_known_word_with_marks_behind_it_is_not_encoded_again(name):
    from clickmart.llm.tokens import Encoder

    texts = ["x thesis föhn. ä!", "x thesis. föhn, thesis?). ä...", "x thesis!?!?! thésis... don't a.b ÷. ª. ÉÀ. İ. 3.\n."]
    enc = Encoder(tokenizer_path(name))
    assert enc.encode_all(texts[:1]) == enc._plain(texts[:1])
    asked = []
    enc._encode_letters, letters = lambda words: asked.extend(words) or letters(words), enc._encode_letters
    assert enc.encode_all(texts[1:2]) == enc._plain(texts[1:2]) and asked == []
    if enc.drops_space:  # nor one in upper case
        assert enc.encode_all(["THESIS, Föhn"]) == enc._plain(["THESIS, Föhn"]) and asked == []
    assert enc.encode_all(texts) == enc._plain(texts) and asked


def test_chunks_are_cut_by_bytes():
    import pyarrow as pa

    from clickmart.llm.tokens import chunks

    texts = pa.array(["a" * 10, "b" * 25, None, "", "c" * 5, "d" * 5, "e"])
    got = [c.to_pylist() for c in chunks(texts, 10)]
    assert got == [["a" * 10], ["b" * 25], [None, "", "c" * 5, "d" * 5], ["e"]] and list(chunks(texts.slice(0, 0))) == []
