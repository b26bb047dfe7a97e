import zlib

import numpy as np
import pytest

from clickmart.llm import packing
from clickmart.llm.tokens import encoder, tokenizer_path

from .edge import edge_docs, empty_docs, rows

BPE = tokenizer_path("byte_bpe_50k.json")


def whole_ids(texts, name=BPE):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(name)
    t.encode_special_tokens = True
    return [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def check(pieces, want, window):
    """Every id in one piece, checksums right, sequences gapless; returns the sequences' lengths."""
    got, ends = {}, {}
    for r in pieces:
        got.setdefault((r.part, r.row), []).append(r)
        ends.setdefault(r.sequence_id, []).append((r.offset, r.length))
    seen = []
    for rs in got.values():
        rs.sort(key=lambda r: r.start)
        assert rs[0].start == 0 and all(a.start + a.length == b.start for a, b in zip(rs, rs[1:]))
        assert rs[-1].start + rs[-1].length == rs[0].doc_tokens
        seen.append((rs[0].doc_id, rs[0].doc_tokens, tuple((r.start, r.length, r.ids_crc32) for r in rs)))
    left = list(want)
    for doc_id, n, parts in seen:
        match = next(i for i, (d, ids) in enumerate(left) if d == doc_id and len(ids) == n)
        ids = np.array(left.pop(match)[1], dtype="<u4")
        assert all(zlib.crc32(ids[s : s + k].tobytes()) == c for s, k, c in parts)
    assert not left
    lengths = []
    for spans in ends.values():
        at = 0
        for o, k in sorted(spans):
            assert o == at
            at += k
        lengths.append(at)
    assert max(lengths, default=0) <= window
    assert all(n == window or n & (n - 1) == 0 for n in lengths)  # the others need no padding
    return lengths


@pytest.mark.parametrize("window", [64, 1024])
def test_edge_rows(spark, window):
    docs = edge_docs(spark, ("n", "part", "row", "ids", "rest"))
    packed = packing.pack(docs, BPE, window)
    texts = [(d, t or "") for d, t, *_ in rows()]
    want = [(d, ids + [0]) for (d, _), ids in zip(texts, whole_ids([t for _, t in texts]))]
    lengths = check(packed.pieces.collect(), want, window)
    assert sum(lengths) == sum(len(i) for _, i in want)
    with_ids = {(r.part, r.row, r.start): bytes(r.ids) for r in packing.with_ids(packed).collect()}
    for r in packed.pieces.collect():
        assert zlib.crc32(with_ids[(r.part, r.row, r.start)]) == r.ids_crc32 and len(with_ids[(r.part, r.row, r.start)]) == 4 * r.length


def test_generated_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows_ = docs.select("doc_id", "text").collect()
    want = [(r.doc_id, ids + [0]) for r, ids in zip(rows_, whole_ids([r.text for r in rows_]))]
    lengths = check(packing.pack(docs.repartition(5), BPE).pieces.collect(), want, 1024)
    assert len(lengths) <= sum(len(i) for _, i in want) // 1024 + 11


def test_empty_table(spark):
    assert packing.query(empty_docs(spark)).count() == 0


def test_solver_fills_windows_from_stock():
    rng = np.random.default_rng(1)
    histogram = rng.integers(0, 400, 1024)
    histogram[0] = 0
    combos, counts = packing.solve(histogram)
    assert (combos.sum(axis=1) == 1024).all() and (counts > 0).all()
    used = np.bincount(combos.ravel(), np.repeat(counts, 3), minlength=1024)
    used[0] = 0
    assert (used <= histogram).all()
    assert (used * np.arange(1024)).sum() > 0.6 * (histogram * np.arange(1024)).sum()


@pytest.mark.parametrize("lengths", [[600] * 50, [1], [1023, 1], [512, 512, 512], [300] * 7 + [724] * 3, list(range(1, 1024))])
def test_layout_places_every_rank_once(lengths):
    histogram = np.bincount(lengths, minlength=1024)
    plan = packing.layout(histogram, 5)
    assert (plan.planned <= histogram).all() and plan.left_total == sum((n - plan.planned[k]) * k for k, n in enumerate(histogram))
    pos = np.arange(plan.left_total)
    seq, off, room = packing.greedy_run(pos, plan, 1024)
    ends = {s: int((seq == s).sum()) for s in set(seq.tolist())}
    assert all(n == 1024 or n & (n - 1) == 0 for n in ends.values())
    assert all(off[seq == s].tolist() == list(range(n)) for s, n in ends.items()) and (room >= 1).all()


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_cached_pieces_give_the_ids_of_the_whole_text(name):
    enc = encoder(tokenizer_path(name))
    texts = [t or "" for _, t, *_ in rows()] + [
        "a  b\n\n c\t d", "it's we'll 'tis can't,won't", "x́, ý. é", "1,000.5 a1,b2;", " lead", "trail ", "\n", "  \n  ", "a b 　 c",
        "ÀÉÎ straße, ΑΒΓΣ. İstanbul!", "|a|b |c", "!?.,;:", "word.Next ,word", "a = ̸ b", "\x1c\x1d a\x1cb",
    ]
    for t, ids in zip(texts, whole_ids(texts, tokenizer_path(name))):
        assert np.frombuffer(enc.encode(t), "<u4").tolist() == ids, repr(t[:40])
