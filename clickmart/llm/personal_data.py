"""Operator 5, personal data by gradient-boosted candidates.

Strict rules find the plain spans (emails, IP addresses, payment cards, phone
numbers). Loose generators propose many more, overlapping ones: spelled-out
emails, phones without a prefix, cards and addresses with other separators.
Boosted trees score every proposal by its format, written plainly, and by its
context. They learn from strict spans, from the same spans rewritten into loose
spellings, and from proposals that are surely none (see ``labelled``). A
threshold per kind, calibrated on rows not trained on, is all that picks what
is added; strict spans always stay.

All steps are SQL expressions and Spark ML on DataFrames.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmart.llm.common import row_key, stage, text_of

KINDS = ("email", "ip", "card", "phone")

# The strict patterns. Possessive quantifiers and the look at the
# character before change no match; they keep long runs linear and off the stack.
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Loose patterns: they may overlap each other and the strict ones.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+(?:@| ?[(\[{] ?(?:at|AT|@) ?[)\]}] ?| at )[A-Za-z0-9-]{1,63}+(?:(?:\.| ?[(\[{] ?(?:dot|DOT|\.) ?[)\]}] ?| dot )[A-Za-z0-9-]{1,63}+){1,8}+",
    "ip": r"(?<![0-9.,])[0-9]{1,3}+(?: ?[.,] ?[0-9]{1,3}+| ?[(\[] ?(?:dot|\.) ?[)\]] ?[0-9]{1,3}+){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9](?:[ ._/-]?[0-9]){11,18}+(?![0-9])",
    "phone": r"(?<![0-9A-Za-z])(?:\+|00)?[0-9(](?:[ ()./-]{0,3}[0-9]){6,18}+(?![0-9A-Za-z])",
}
#: Words near a span that tell what it is, as a context feature.
HINTS = {"email": "mail|contact|correo|courriel|write", "ip": "ip|addr|host|server", "card": "card|visa|credit|karte|carte|tarjeta", "phone": "tel|phone|call|fax|fon|mobil|cell"}
#: Dates, which look like phone numbers without a prefix.
DATE = r"^(?:(?:19|20)[0-9]{2}[ ./-]?[01][0-9][ ./-]?[0-3][0-9](?:[^0-9].*)?|[0-3]?[0-9][./-][01]?[0-9][./-](?:19|20)[0-9]{2}(?:[^0-9].*)?)$"
CONTEXT = 24
#: About how many labelled rows train the trees, in equal parts a kind and label; all of the other fold calibrate.
TRAIN_ROWS = 20_000
TREES, DEPTH, SEED = 20, 4, 17
#: What a kind's threshold must reach on calibration rows.
PRECISION = 0.99
FEATURES = (
    "is_email", "is_ip", "is_card", "is_phone", "length", "n_digits", "n_letters", "n_groups", "n_seps", "n_kinds_of_seps", "plus", "parens", "at_signs", "dots",
    "plain_form", "valid_form", "hint", "other_hint", "glued_before", "glued_after", "quoted",
    "check", "bare", "dated", "like_ip",
)


def found(text: Column, matches: Column, pattern: str) -> Column:
    """Matches with what lies around them: structs of the match, the gap before it, and both contexts."""
    gaps = F.split(text, pattern, -1)

    def near(m: Column, i: Column) -> Column:
        before, after = F.get(gaps, i), F.get(gaps, i + 1)
        return F.struct(i.alias("pos"), m.alias("match"), F.length(before).cast("long").alias("gap"), F.right(before, F.lit(CONTEXT)).alias("before"), F.substring(after, 1, CONTEXT).alias("after"))

    return F.transform(matches, near)


def luhn(digits: Column) -> Column:
    """Whether the digits have a right check digit."""
    doubled = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5).cast("int")))
    return F.aggregate(doubled, F.lit(0), lambda s, d: s + d) % 10 == 0


def valid(kind: Column, match: Column) -> Column:
    """Whether a strict match holds: the parts of an address, the length and check digit of a card, the length of a phone number."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    n = F.length(digits)
    parts = F.forall(F.split(match, "\\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.coalesce(F.substring(F.ltrim(p, F.lit("0")), 1, 3).try_cast("int"), F.lit(0)) <= 255))
    card = n.between(12, 19) & F.when(n.between(12, 19), luhn(digits)).otherwise(F.lit(False))
    return F.when(kind == "email", F.lit(True)).when(kind == "ip", parts).when(kind == "card", card).otherwise(n.between(9, 15))


def proposals(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Keys of all rows (doc_id, k1, k2), and every match: k1, k2, kind, strict, start, end, match, before, after."""
    k1, k2 = row_key(F.col("doc_id"), text_of())
    names = [(kind, strict, p) for strict, table in ((True, STRICT), (False, LOOSE)) for kind, p in table.items()]
    rows = docs.select("doc_id", text_of().alias("text")).withColumns({"k1": row_key(F.col("doc_id"), F.col("text"))[0], "k2": row_key(F.col("doc_id"), F.col("text"))[1]})
    rows = rows.withColumns({f"m_{kind}_{strict}": F.regexp_extract_all("text", F.lit(p), F.lit(0)) for kind, strict, p in names})
    around = [
        F.struct(F.lit(kind).alias("kind"), F.lit(strict).alias("strict"), F.when(F.size(f"m_{kind}_{strict}") > 0, found(F.col("text"), F.col(f"m_{kind}_{strict}"), p)).alias("found"))
        for kind, strict, p in names
    ]
    some = F.filter(F.array(*around), lambda g: g["found"].isNotNull())
    rows = stage(rows.select("doc_id", "k1", "k2", some.alias("groups")), "matches")
    groups = rows.where(F.size("groups") > 0).select("k1", "k2", F.explode("groups").alias("g"))
    flat = groups.select("k1", "k2", "g.kind", "g.strict", F.explode("g.found").alias("f")).select("k1", "k2", "kind", "strict", "f.*")
    flat = flat.dropDuplicates(["k1", "k2", "kind", "strict", "pos"])  # repeated rows
    w = Window.partitionBy("k1", "k2", "kind", "strict").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    size = F.length("match").cast("long")
    end = F.sum(F.col("gap") + size).over(w)
    flat = flat.withColumn("end", end).withColumn("start", F.col("end") - size)
    return rows.select("doc_id", "k1", "k2"), stage(flat.select("k1", "k2", "kind", "strict", "start", "end", "match", "before", "after"), "proposals")


def features(spans: DataFrame) -> DataFrame:
    """Format features of the plainly written match, and context features."""
    m = F.col("match")
    at = F.regexp_replace(m, r" ?[(\[{] ?(?:at|AT|@) ?[)\]}] ?| at ", "@")
    mail = F.regexp_replace(at, r" ?[(\[{] ?(?:dot|DOT|\.) ?[)\]}] ?| dot ", ".")
    ip = F.regexp_replace(m, r" ?(?:[.,]|[(\[] ?(?:dot|\.) ?[)\]]) ?", ".")
    plain = F.when(F.col("kind") == "email", mail).when(F.col("kind") == "ip", ip).when(F.col("kind") == "card", F.regexp_replace(m, "[ ._/-]", "")).otherwise(F.regexp_replace(m, "^00", "+"))
    spans = spans.withColumn("plain", plain)
    p = F.col("plain")
    whole = reduce(lambda c, k: c.when(F.col("kind") == k, p.rlike(f"^(?:{STRICT[k]})$")), KINDS[1:], F.when(F.col("kind") == KINDS[0], p.rlike(f"^(?:{STRICT[KINDS[0]]})$")))
    digits = F.length(F.regexp_replace(p, "[^0-9]", ""))
    seps = F.regexp_replace(m, "[0-9A-Za-z]", "")
    hint = reduce(lambda c, k: c.when(F.col("kind") == k, F.lower("before").rlike(HINTS[k])), KINDS[1:], F.when(F.col("kind") == KINDS[0], F.lower("before").rlike(HINTS[KINDS[0]])))
    other = F.lower("before").rlike("|".join(HINTS.values())) & ~hint
    flags = {
        **{f"is_{k}": F.col("kind") == k for k in KINDS},
        "plus": F.startswith(p, F.lit("+")),
        "parens": F.contains(m, F.lit("(")),
        "plain_form": whole,
        "valid_form": whole & valid(F.col("kind"), p),
        "check": valid(F.col("kind"), p),  # without the form: phones need no prefix
        "bare": p.rlike("^[0-9]+$"),
        "dated": m.rlike(DATE),
        "like_ip": m.rlike(f"^(?:{STRICT['ip']})$") & valid(F.lit("ip"), m),
        "hint": hint,
        "other_hint": other,
        "glued_before": F.col("before").rlike("[0-9A-Za-z]$"),
        "glued_after": F.col("after").rlike("^[0-9A-Za-z]"),
        "quoted": F.col("before").rlike("[\"'=]$"),
    }
    numbers = {
        "length": F.length(p),
        "n_digits": digits,
        "n_letters": F.length(F.regexp_replace(p, "[^A-Za-z]", "")),
        "n_groups": F.regexp_count(m, F.lit("[0-9]+")),
        "n_seps": F.length(seps),
        "n_kinds_of_seps": F.size(F.array_distinct(F.split(seps, ""))),
        "at_signs": F.regexp_count(p, F.lit("@")),
        "dots": F.regexp_count(p, F.lit("\\.")),
    }
    out = spans.withColumns({k: F.coalesce(v, F.lit(False)).cast("double") for k, v in flags.items()} | {k: F.coalesce(v, F.lit(0)).cast("double") for k, v in numbers.items()})
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(out)


def rewritten(spans: DataFrame) -> DataFrame:
    """Strict spans in the loose spellings that people use, with their contexts: k1, k2, kind, match, before, after.

    Some become what is no phone number: dates, and digits without a prefix or a word for them.
    """
    m, before = F.col("match"), F.col("before")
    digits = F.regexp_replace(m, "[^0-9]", "")

    def made(match: Column, context: str = "") -> Column:
        return F.struct(match.alias("match"), (F.lit(context) if context else before).alias("before"))

    def mail(at: str, dot: str) -> Column:
        return made(F.regexp_replace(F.regexp_replace(m, r"\.(?=[^@]*$)", dot), "@", at))

    def each_four(sep: str) -> Column:
        return made(F.regexp_replace(digits, "([0-9]{4})(?=[0-9])", f"$1{sep}"))

    own = F.regexp_replace(m, r"^\+(?:[0-9]{1,3}(?![0-9])|[0-9])[ .-]*", "")  # without the country's code
    trunk = F.concat(F.lit("0"), F.translate(own, "()", ""))
    alone = F.regexp_replace(own, "[^0-9]", "")
    date = F.concat(F.lit("20"), F.substring(digits, -2, 2), F.lit("-0"), F.substring(digits, -3, 1), F.lit("-1"), F.substring(digits, -4, 1), F.lit(" 1"), F.substring(digits, -5, 1))
    forms = {
        "email": [mail(" at ", " dot "), mail(" (at) ", " (dot) "), mail("[at]", "[dot]"), mail(" [at] ", "."), mail(" at ", ".")],
        "ip": [made(F.regexp_replace(m, r"\.", x)) for x in (" . ", ",", "(dot)", " [.] ")],
        "card": [each_four(x) for x in (".", "/", "_", "-", " ")],
        "phone": [
            made(own), made(own, "call "), made(trunk), made(trunk, "tel "), made(F.regexp_replace(trunk, "^([0-9]+)[ .-]+", "$1/"), "tel "),
            made(F.regexp_replace(trunk, "^([0-9]+)[ .-]+", "$1/")), made(F.regexp_replace(m, r"[ ().-]+", "/")), made(F.regexp_replace(m, r"^\+", "00")),
            made(F.regexp_replace(own, r"[ ().-]+", "-")), made(alone), made(alone, "phone "), made(alone, "number "), made(date), made(date, "call "),
        ],
    }
    lists = reduce(lambda c, k: c.when(F.col("kind") == k, F.array(*forms[k])), KINDS[1:], F.when(F.col("kind") == KINDS[0], F.array(*forms[KINDS[0]])))
    out = spans.select("k1", "k2", "kind", "after", F.explode(lists).alias("f")).select("k1", "k2", "kind", F.ltrim("f.match").alias("match"), F.right("f.before", F.lit(CONTEXT)).alias("before"), "after")
    like = reduce(lambda c, k: c.when(F.col("kind") == k, F.col("match").rlike(f"^(?:{LOOSE[k]})$")), KINDS[1:], F.when(F.col("kind") == KINDS[0], F.col("match").rlike(f"^(?:{LOOSE[KINDS[0]]})$")))
    return out.where(like)


def labelled(loose: DataFrame, made: DataFrame) -> DataFrame:
    """Rows that are known to be personal data or not: kind, features, k2, fold, y, ``made`` (rewritten).

    Strict spans are, and so are their rewritten forms. What fails its kind's check is not, nor are dates,
    addresses and lone digits without a word for them as phone numbers. All other proposals
    (spelled-out mails, numbers without a prefix) are unknown: the trees are for them, so they are no rows here.
    """
    wrong = (F.col("check") == 0.0) | ((F.col("kind") == "phone") & ((F.col("dated") == 1.0) | (F.col("like_ip") == 1.0) | ((F.col("bare") == 1.0) & (F.col("hint") == 0.0))))
    known = loose.withColumn("y", F.when(F.col("y") == 1, 1).when(wrong, 0)).where(F.col("y").isNotNull()).withColumn("made", F.lit(False))
    other = made.withColumn("y", F.when(wrong, 0).otherwise(1)).withColumn("made", F.lit(True))
    columns = ["kind", "features", "k2", "fold", "y", "made"]
    return known.select(columns).unionByName(other.select(columns))


def train(spans: DataFrame) -> tuple[GBTClassificationModel | None, dict[str, float]]:
    """Trees and a threshold per kind. ``spans``: the columns of ``labelled``; fold 0 trains, 1 calibrates.

    The training rows are a sample by a hash, of bounded size for each kind and label; thresholds come from
    every row of the other fold. Without both answers among the training rows there
    is no model; a kind for which no threshold is precise enough has none.
    """
    sizes = spans.where("fold = 0").groupBy("kind", "y").count().collect()  # two a kind
    most = TRAIN_ROWS / (2 * len(KINDS))
    share = F.lit(0)
    for r in sizes:
        share = F.when((F.col("kind") == r.kind) & (F.col("y") == r.y), int(min(1.0, most / r["count"]) * (1 << 30))).otherwise(share)
    sample = spans.where((F.col("fold") == 0) & (F.pmod(F.col("k2"), F.lit(1 << 30)) < share))
    rows = stage(sample.select("features", F.col("y").cast("double").alias("label")), "training")
    if rows.select("label").distinct().count() < 2:
        return None, {}
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED).fit(rows)
    scored = with_score(spans.where("fold = 1 and (made or y = 0)"), model)  # strict spans are never added
    bins = scored.groupBy("kind", F.floor(F.col("score") * 100).cast("int").alias("bin")).agg(F.sum("y").alias("hits"), F.count(F.lit(1)).alias("n")).collect()  # 101 a kind
    limits = {}
    for kind in KINDS:
        hits = n = 0
        for r in sorted((r for r in bins if r.kind == kind), key=lambda r: -r["bin"]):
            hits, n = hits + r.hits, n + r.n
            if hits >= PRECISION * n:
                limits[kind] = r["bin"] / 100
            else:
                break
    return model, limits


def with_score(spans: DataFrame, model: GBTClassificationModel) -> DataFrame:
    return model.transform(spans).withColumn("score", vector_to_array("probability")[1])


def apart(spans: DataFrame) -> DataFrame:
    """All base spans, and added ones that touch none of them and no better added span that stays.

    ``spans``: k1, k2, kind, start, end, base, score. Ties go to the earlier, then longer span. A text falls into
    islands of spans that overlap in a chain; each takes its spans from the best on.
    """
    w = Window.partitionBy("k1", "k2").orderBy("start", "end", "kind")
    far = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("new", (far.isNull() | (F.col("start") >= far)).cast("int")).withColumn("island", F.sum("new").over(w))
    one = F.struct((~F.col("base")).alias("added"), (-F.col("score")).alias("rank"), "start", (-F.col("end")).alias("far"), "kind")
    islands = spans.groupBy("k1", "k2", "island").agg(F.array_sort(F.collect_list(one)).alias("found"))

    def take(kept: Column, s: Column) -> Column:
        touched = F.exists(kept, lambda k: (k["start"] < -s["far"]) & (s["start"] < -k["far"]))
        return F.when(s["added"] & touched, kept).otherwise(F.concat(kept, F.array(s)))

    kept = F.aggregate("found", F.filter("found", lambda s: F.lit(False)), take)
    rows = islands.select("k1", "k2", F.explode(F.when(F.size("found") == 1, F.col("found")).otherwise(kept)).alias("s"))
    return rows.select("k1", "k2", "s.kind", "s.start", (-F.col("s.far")).alias("end"), (~F.col("s.added")).alias("base"), (-F.col("s.rank")).alias("score"))


def redactions(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Keys of all rows, and their spans: k1, k2, kind, start, end (code points, end exclusive), base, score.

    Strict spans have ``base`` true. An added span touches no strict one and no
    better added one. NULL and empty texts have no spans. A row's spans follow
    from its own text; repeated rows share a key and have equal spans. Extra columns are ignored.
    """
    keys, matches = proposals(docs)
    base = matches.where("strict").where(valid(F.col("kind"), F.col("match"))).select("k1", "k2", "kind", "start", "end", F.lit(True).alias("base"), F.lit(1.0).alias("score"))
    base = stage(base, "base-spans")
    loose = features(matches.where("not strict")).drop("strict")
    true = base.select("k1", "k2", "kind", "start", "end", F.lit(1).alias("y"))
    loose = stage(loose.join(true, ["k1", "k2", "kind", "start", "end"], "left").fillna({"y": 0}).withColumn("fold", F.pmod("k1", F.lit(2))), "loose-spans")
    strict = matches.where("strict").where(valid(F.col("kind"), F.col("match")))
    made = features(rewritten(strict)).withColumn("fold", F.pmod("k1", F.lit(2)))
    model, limits = train(stage(labelled(loose, made), "labelled"))
    if model is None or not limits:
        return keys, base
    limit = reduce(lambda c, k: c.when(F.col("kind") == k, limits[k]), list(limits)[1:], F.when(F.col("kind") == list(limits)[0], limits[list(limits)[0]]))
    added = with_score(loose.where("y = 0"), model).where(F.col("score") >= limit)
    return keys, apart(base.unionByName(added.select("k1", "k2", "kind", "start", "end", F.lit(False).alias("base"), "score")))


def joined(spans: str) -> Column:
    """Spans as kind:start:end by start, then kind as listed, comma-joined."""
    return F.array_join(F.transform(F.array_sort(F.col(spans)), lambda s: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), s["order"] + 1), s["start"], s["end"])), ",")


def query(docs: DataFrame) -> DataFrame:
    keys, spans = redactions(docs)
    order = reduce(lambda c, i: c.when(F.col("kind") == KINDS[i], i), range(1, len(KINDS)), F.when(F.col("kind") == KINDS[0], 0))
    one = F.struct("start", order.alias("order"), "end")
    each = spans.groupBy("k1", "k2").agg(
        *(F.count(F.when(F.col("base") & (F.col("kind") == k), 1)).alias(f"n_{k}") for k in KINDS),
        F.collect_list(F.when(F.col("base"), one)).alias("base_spans"),
        F.collect_list(one).alias("all_spans"),
    )
    out = keys.join(each, ["k1", "k2"], "left")
    none = F.array().cast("array<struct<start:bigint,order:int,end:bigint>>")
    out = out.withColumns({"base_spans": F.coalesce("base_spans", none), "all_spans": F.coalesce("all_spans", none)})
    return out.select("doc_id", *(F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS), F.sha2(joined("base_spans"), 256).alias("base_sha256"), joined("all_spans").alias("spans"))
