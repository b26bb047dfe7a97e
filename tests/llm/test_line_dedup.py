import hashlib
import re
from collections import defaultdict

import pytest

from clickmart.llm import line_dedup

from .edge import edge_docs, empty_docs, rows

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, min_docs, min_chars):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)

    found = defaultdict(set)
    for d, t in docs:
        for line in (t or "").split("\n"):
            found[key(line)].add(d)
    drop = {k for k, v in found.items() if len(v) >= min_docs and len(k) >= min_chars}
    out = []
    for d, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in drop]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def key(r):
    return (r[0] is None, r[0] or 0, *r[1:])


@pytest.mark.parametrize("min_docs,min_chars", [(2, 1), (3, 1), (2, 12), (1, 1)])
def test_equals_brute_force(spark, min_docs, min_chars):
    got = line_dedup.dedup_lines(edge_docs(spark, ("n_lines", "_drop", "key", "pos")), min_docs, min_chars)
    assert got.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    rows_got = [(r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got.collect()]
    want = brute([(r[0], r[1]) for r in rows()], min_docs, min_chars)
    assert sorted(rows_got, key=key) == sorted(want, key=key)


def test_hot_line_and_many_dropped_lines(spark):
    docs = [(i, "\n".join(["HOT line", f"own {i}", "  hot LINE\t"] + [f"c{j}" for j in range(50)])) for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in line_dedup.dedup_lines(df).collect()}
    assert got == {i: (53, 52, f"own {i}") for i in range(40)}


def test_empty_table_and_query_columns(spark):
    out = line_dedup.query(empty_docs(spark))
    assert out.columns == ["doc_id", "n_lines", "n_dropped", "kept_sha256"] and out.count() == 0
    one = line_dedup.query(spark.createDataFrame([(1, None)], "doc_id long, text string")).first()
    assert (one.n_lines, one.n_dropped, one.kept_sha256) == (1, 0, hashlib.sha256(b"").hexdigest())
    assert re.fullmatch("[0-9a-f]{64}", one.kept_sha256)
