import hashlib
import re

from pyspark.ml.feature import VectorAssembler

from clickmart.llm import personal_data

from .edge import edge_docs, empty_docs

PATTERNS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def luhn(d):
    s = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        s += x - 9 if x > 9 else x
    return s % 10 == 0


def ok(kind, m):
    d = re.sub("[^0-9]", "", m)
    return {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m.split(".")), "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]


def base(text):
    out = []
    for k, (kind, p) in enumerate(PATTERNS):
        out += [(m.start(), k, m.end()) for m in re.finditer(p, text or "") if ok(kind, m.group())]
    out.sort()
    return [f"{PATTERNS[k][0]}:{s}:{e}" for s, k, e in out]


TEXTS = [
    "mail a.b+c@x-y.example.com, or q@w.e_x@d.e.f and @no, a@b no.",
    "ip 1.2.3.4.5.6.7.8 256.1.1.1 255.255.255.255 007.0.0.01 1.2.3 00000000000000000000000000000255.1.1.1",
    "card 4111 1111 1111 1111 and 4111-1111-1111-1112, 4111  1111 1111 1111 5500005555555559",
    "call +1 (415) 555-0100. or +44 20 7946 0958) +12 34 +1 234 567 890 123 456 7",
    "😀é +1 (415) 555-0100 😀 x@y.zz 10.0.0.1 4111111111111111 +4111111111111111",
    "1" * 5000 + " " + "1 " * 6000 + "a" * 20000 + "@" + "b." * 9000 + "c",
    "+1 2 3 4 5 6 7 8 9 0@x.yy1.2.3.4@z.w", "", None, "nothing here", "12-34-56-78-90-12-34-5 1.1.1.1.1",
]


def test_base_spans_equal_the_rules(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for r in personal_data.query(df).collect():
        want = base(TEXTS[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), (r, want[:5])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k) for s in want) for k, _ in PATTERNS]
        assert set(want) <= set(r.spans.split(",") if r.spans else [])


def test_trees_add_spelled_out_spans_and_leave_plain_text(spark):
    docs = []
    for i in range(400):
        plain = f"Words and words {i} then mail user{i}.x@mail{i % 7}.example.com or call +1 ({200 + i}) 555-{1000 + i} from 10.{i % 250}.3.{i % 200} now"
        docs.append((i, plain))
    docs += [(1000 + i, f"On page {i} of 20{i % 10:02d}, number 4111 1111 1111 {1000 + i} is no card, nor 300.2.3.{i}") for i in range(200)]
    docs.append((5000, "write to jane.doe (at) mail3.example (dot) com please"))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r for r in personal_data.query(df).collect()}
    text = dict(docs)
    for d, r in got.items():
        want = base(text[d])
        if d < 2000:
            assert r.spans == ",".join(want), (text[d], r.spans)
    s, e = text[5000].index("jane"), text[5000].index(" please")
    assert got[5000].spans == f"email:{s}:{e}" and got[5000].n_email == 0


def test_generated_table_and_edge_rows(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    text = {r.doc_id: r.text for r in df.collect()}
    got = personal_data.query(df).collect()
    assert len(got) == len(text)
    for r in got:
        want = base(text[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        for span in set(r.spans.split(",")) - {"", *want}:  # e.g. two cards side by side, which the rules read as one long number
            kind, start, end = span.split(":")
            assert ok(kind, text[r.doc_id][int(start) : int(end)]), (span, text[r.doc_id][int(start) : int(end)])
    edge = personal_data.query(edge_docs(spark, ("kind", "start", "match", "features", "m_email_True"))).collect()
    assert len(edge) == 11 and personal_data.query(empty_docs(spark)).count() == 0


def test_plan_is_native(spark):
    plan = personal_data.query(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_phones_without_a_prefix_are_scored_and_numbers_are_left(spark):
    docs = [(i, f"Words {i} then call +1 ({200 + i}) 555-{1000 + i}, or +49 {30 + i % 60} {1234567 + 31 * i}, from 10.{i % 250}.3.{i % 200} now") for i in range(400)]
    phones = ["(415) 555-0100", "030 1234567", "030/1234567", "+49/30/1234567"]
    docs += [(1000 + i, f"please phone {x} today") for i, x in enumerate(phones)]
    others = ["2024-03-15 12", "8412345678", "300.200.300.150"]
    docs += [(2000 + i, f"it was order {x} again") for i, x in enumerate(others)]
    docs += [(3000, "call 2024-03-15 12 again"), (3001, "call 555 0100 12 now")]
    got = {r.doc_id: r for r in personal_data.query(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for i, x in enumerate(phones):
        s = len("please phone ")
        assert got[1000 + i].spans == f"phone:{s}:{s + len(x)}" and got[1000 + i].n_phone == 0, (x, got[1000 + i].spans)
    assert [got[i].spans for i in got if i >= 2000 and i != 3001] == [""] * 4, [got[i].spans for i in got if i >= 2000]


def test_an_added_span_stays_if_it_touches_none_that_stays(spark):
    """Chains of overlapping spans of two texts, against taking them one by one."""
    spans = [(1, "phone", 0, 5, 0.9), (1, "card", 4, 10, 0.95), (1, "phone", 9, 15, 0.8), (1, "card", 14, 20, 0.7), (1, "ip", 30, 34, 0.5)]
    spans += [(2, "email", 3, 9, 1.0), (2, "phone", 8, 12, 1.0), (2, "card", 11, 16, 0.9), (2, "ip", 15, 18, 0.6), (2, "ip", 15, 19, 0.6), (2, "card", 0, 3, 0.4)]
    base_spans = {(2, "email", 3, 9), (2, "phone", 8, 12)}
    rows = [(k, k, kind, s, e, (k, kind, s, e) in base_spans, p) for k, kind, s, e, p in spans]
    want = set()
    for k, _, kind, s, e, b, _ in sorted(rows, key=lambda r: (not r[5], -r[6], r[3], -r[4], r[2])):
        if b or not any(k == o[0] and o[2] < e and s < o[3] for o in want):
            want.add((k, kind, s, e, b))
    df = spark.createDataFrame(rows, "k1 long, k2 long, kind string, start long, end long, base boolean, score double")
    got = [(r.k1, r.kind, r.start, r.end, r.base) for r in personal_data.apart(df).collect()]
    assert set(got) == want and len(got) == len(want) == 7


def test_a_rare_kind_has_its_threshold(spark):
    """Cards beside masses of numbers, with hashes that no small sample takes, still calibrate."""
    many = spark.range(180_000).selectExpr("'phone' as kind", "id * 7919 as k2", "cast(id % 3 > 0 as int) as fold", "cast(id % 2 as int) as y", "true as made")
    few = spark.range(90).selectExpr("'card' as kind", "(1L << 30) - 1 as k2", "cast(id % 3 > 0 as int) as fold", "1 as y", "true as made")
    rows = many.unionByName(few).selectExpr("*", "cast(kind = 'card' as double) as a", "cast(y as double) as b")
    rows = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows)
    _, limits = personal_data.train(rows)
    assert set(limits) == {"card", "phone"}
