"""Source divergence audit against a plain count of every term."""

import random
import re
from collections import Counter, defaultdict

import pandas as pd
import pytest
from pyspark.sql import functions as F

from clickmart.llm import divergence

from .edge import SCHEMA, edge_docs, empty_docs

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
FOLD = {c: c + 32 for c in range(65, 91)}


def brute(rows, min_docs, top):
    """Result rows from (text, lang, source) rows."""
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        found = TERM.findall((text or "").translate(FOLD))
        counts[lang or "", source or ""].update(found)
        docs[lang or ""].update(set(found))
    out = set()
    for lang in {k[0] for k in counts}:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        groups = {s: c for (x, s), c in counts.items() if x == lang}
        whole = sum(groups.values(), Counter())

        def rates(c):
            below = sum(c[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 5) // below for t in kept}

        p, q = {s: rates(c) for s, c in groups.items()}, rates(whole)
        for s in groups:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in groups if o != s]
            words = [(t, p[s][t] - q[t]) for t in kept if groups[s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", words, top)):
                items = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
                out |= {(lang, s, part, item, value, i) for i, (item, value) in enumerate(items, 1)}
    return out


def result(df):
    rows = [(r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def made(n, sources, words, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{chr(97 + i % 26)}{'ÄäéZ😀x'[i % 6]}{'q' * (i // 26)}" for i in range(words)]
    out = []
    for _ in range(n):
        text = " ".join(vocabulary[min(int(rng.expovariate(0.03)), words - 1)] for _ in range(rng.randint(0, 80)))
        # one source holds a third of all rows
        out.append((text, rng.choice(["en", "de", None]), "hot" if rng.random() < 0.33 else f"s{rng.randrange(sources)}"))
    return out


@pytest.mark.parametrize(("sources", "words", "min_docs"), [(4, 300, 3), (75, 120, 2)])
def test_against_brute_force(spark, sources, words, min_docs):
    """Several blocks of sources and several words of the bitmaps."""
    rows = made(500, sources, words, sources)
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(5)
    assert result(divergence.audit(df, min_docs, 7)) == brute(rows, min_docs, 7)


def test_edge_rows_and_clashing_columns(spark):
    names = ["n", "term", "value", "rank", "part", "item", "word", "bit", "bits", "total", "kept", "block", "left"]
    df = edge_docs(spark, names)
    rows = [(r.text, r.lang, r.source) for r in df.collect()]
    for least in (1, 2, 30):
        assert result(divergence.audit(df, least)) == brute(rows, least, 50)


def test_groups_without_terms_and_empty_table(spark):
    df = spark.createDataFrame([(i, "12 34", "xx", s, 5) for i, s in enumerate(["b", "a", None])], SCHEMA)
    assert result(divergence.query(df)) == brute([("", "xx", s) for s in ("b", "a", "")], 30, 50)
    assert divergence.query(empty_docs(spark)).collect() == []


def test_terms_are_ascii_letters_and_all_beyond():
    text = "It's A_b [C] 3D x\u0085Ünï\x7f\x00z ÀÉ"
    assert [t.decode() for t in divergence.terms(text.encode())] == TERM.findall(text.translate(FOLD))


def test_joint_cells_of_wide_counts():
    """Counts beyond 32 bits keep their exact rates."""
    n = 2**40
    rows = pd.DataFrame(
        {
            "source": ["a", "b"],
            "total": [3 * n, 7],
            "kept": [3, 3],
            "cells": [[{"word": 0, "n": n, "bits": 1}, {"word": 0, "n": 2 * n, "bits": -(2**63)}], None],
        }
    )
    got = divergence.compare(divergence.Profiles(rows, {0: 3 - 2**63}), divergence.Profiles(rows, {0: 3 - 2**63}))

    def p(c, total):
        return 1 + 10**9 * (c + 5) // (total + 15)

    want = sum(abs(p(c, 3 * n) - p(0, 7)) for c in (n, 2 * n, 0))
    assert got.tolist() == [[0, want], [want, 0]]


def test_no_window_holds_a_language(spark):
    """Bit numbers come from sorted ranges, not from one window a language."""
    df = spark.createDataFrame(made(50, 3, 40, 1), "text string, lang string, source string")
    counted = divergence.count_terms(df).where("term is not null").groupBy("lang", "term").agg(F.sum("n").alias("n"))
    plan = divergence.number_terms(counted)._jdf.queryExecution().toString()
    assert "Window" not in plan and "rangepartitioning" in plan
