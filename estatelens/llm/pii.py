"""Personal data: patterns propose, checksums confirm, context adjusts. DataFrame functions only.

For each kind the matches and the text between them give every position without
a search: a match starts after all gaps and matches before it. Their running totals
are taken in rounds of doubled reach, and context and masked text are cut from blocks
of the text, so the time of a text grows with its length and n log n of its spans.
Patterns are
written so that Java's matcher needs no recursion and no second scan of a run:
repeated groups are possessive, and a run may only begin at its first character
or where the last match ended (\\G).

Base kinds are email, ip, card (Luhn) and phone; they are reported by rule alone.
Added kinds are iban (mod-97) and ssn; their score is a prior, raised by a
confirmed checksum and by words nearby, and they are reported from
``MIN_SCORE``. Base spans carry a score too.

Defined results: null text counts as empty; spans of different kinds may overlap
and are all reported; ``redact`` covers overlapping spans by the first one's mark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Length of an IBAN by country, from the registry.
IBAN_LENGTH = {
    15: "NO", 16: "BE", 18: "DK FK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "HR LV LI CH", 22: "BH BG CR GE DE IE ME RS GB VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ MD PK RO SA SK ES SE TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO SV GT HU LB NI PL",
    29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC", 33: "RU"}
KNOWN = "|".join(IBAN_LENGTH.values()).replace(" ", "|")
#: Fixed length by country; else an unspaced run, or groups of four and a shorter last one.
IBAN = "|".join([rf"(?:{c.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}+(?![A-Za-z0-9])" for n, c in IBAN_LENGTH.items()]
                + [rf"[A-Z]{{2}}[0-9]{{2}}(?:[A-Z0-9]{{11,30}}+|(?:\x20(?!(?:{KNOWN})[0-9]{{2}})[A-Z0-9]{{4}}(?![A-Za-z0-9])){{2,7}}+(?:\x20[A-Z0-9]{{1,3}})?+)(?![A-Za-z0-9])"])
#: Kinds in the order of the report, and their patterns.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": rf"(?<![A-Za-z0-9])(?:{IBAN})",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
BASE = ("email", "ip", "card", "phone")
#: Cheap test for texts in which a kind can't occur.
NEEDS = {"email": "@", "ip": ".", "phone": "+", "ssn": "-"}
#: Score of a kind before checksum and context.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.5, "phone": 0.6, "iban": 0.4, "ssn": 0.4}
CHECKED = {"card": 0.35, "iban": 0.4}
CONTEXT_BONUS = 0.3
#: Code points before and after a span that are searched for context words.
CONTEXT_CHARS = 48
CONTEXT = {
    "email": r"\b(e-?mail|contact|write|reply)\b",
    "ip": r"\b(ip|address|host|server|login)\b",
    "card": r"\b(card|visa|mastercard|amex|credit|debit|payment|pay)\b",
    "phone": r"\b(phone|tel|telephone|call|mobile|fax)\b",
    "iban": r"\b(iban|account|bank|transfer|konto|compte|cuenta)\b",
    "ssn": r"\b(ssn|social|security)\b",
}
MIN_SCORE = 0.7


def luhn(digits: Column) -> Column:
    """Every second digit from the right doubled, its digits summed; the total ends in 0."""
    d = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5)))
    return F.aggregate(d, F.lit(0).cast("bigint"), lambda s, x: s + x) % 10 == 0


def mod97(code: Column) -> Column:
    """Country and check digits to the end, letters as 10 to 35, remainder 1."""
    c = F.regexp_replace(code, r"\x20", "")
    chars = F.split(F.concat(F.substring(c, 5, 64), F.substring(c, 1, 4)), "")
    value = lambda x: F.when(x.between("A", "Z"), F.ascii(x) - 55).otherwise(F.expr("0") + F.ascii(x) - 48)
    return F.aggregate(chars, F.lit(0).cast("bigint"), lambda r, x: (r * F.when(x.between("A", "Z"), 100).otherwise(10) + value(x)) % 97) == 1


def confirmed(kind: str, x: Column) -> Column:
    """The rule of the kind on a whole match; a failing match is dropped and not tried shorter."""
    if kind == "ip":
        return x.rlike(r"^(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])?(?<=[0-9])(?:\.|$)){4}$")
    if kind == "card":
        digits = F.regexp_replace(x, r"[\x20-]", "")
        return F.when(F.length(digits).between(16, 19), luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(F.regexp_replace(x, r"[^0-9]", "")).between(8, 15)
    if kind == "iban":
        return F.when(F.length(F.regexp_replace(x, r"\x20", "")).between(15, 34), mod97(x)).otherwise(F.lit(False))
    return F.lit(True)


FOUND = "array<struct<kind:string,start:int,end:int>>"
SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"
#: Code points of a block; a text is cut into blocks so that a place in it is reached without reading what is before it.
BLOCK = 512


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def running(values: Column, combine) -> Column:
    """Running total of an array under ``combine(value, earlier or null)``, in rounds of doubled reach: n log n steps for n values."""
    def rounds(v: Column) -> Column:
        reach = F.transform(F.sequence(F.lit(0), F.length(F.bin(F.size(v))) - 1), lambda k: F.pow(F.lit(2.0), k).cast("int"))
        return F.aggregate(reach, v, lambda got, r: F.transform(got, lambda x, i: combine(x, F.get(got, i - r))))
    return let(values, rounds)


def cut(blocks: Column, start: Column, end: Column) -> Column:
    """Code points start to end of a text in blocks; reads the blocks that hold them, not the text from its first character."""
    first, last = F.floor(start / BLOCK).cast("int"), F.floor((end - 1) / BLOCK).cast("int")
    inside = F.array_join(F.slice(blocks, first + 1, F.greatest(F.lit(0), last - first + 1)), "")
    return F.substring(inside, (start - first * BLOCK + 1).cast("int"), (end - start).cast("int"))


def find(text: Column, kind: str) -> Column:
    """Confirmed spans of one kind in ``text``, in order (code points, end exclusive), without their scores."""
    pattern = PATTERNS[kind]
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    both = F.arrays_zip(gaps.alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"))

    def placed(m: Column) -> Column:
        ends = running(F.transform(m, lambda x: x["gap"] + F.coalesce(F.length(x["found"]), F.lit(0))), lambda x, before: x + F.coalesce(before, F.lit(0)))
        return F.zip_with(m, ends, lambda x, end: F.struct(x["found"].alias("found"), end.alias("end")))
    real = F.filter(let(both, placed), lambda x: x["found"].isNotNull() & confirmed(kind, x["found"]))
    spans = F.transform(real, lambda x: F.struct(F.lit(kind).alias("kind"), (x["end"] - F.length(x["found"])).alias("start"), x["end"].alias("end")))
    possible = text.contains(NEEDS[kind]) if kind in NEEDS else text.rlike("[0-9]")
    return F.when(possible, spans.cast(FOUND)).otherwise(F.array().cast(FOUND))


def scored(spans: Column, blocks: Column) -> Column:
    """Spans with their scores; those of added kinds below ``MIN_SCORE`` go."""
    def score(x: Column) -> Column:
        around = F.lower(F.concat_ws(" ", cut(blocks, F.greatest(F.lit(0), x["start"] - CONTEXT_CHARS), x["start"]), cut(blocks, x["end"], x["end"] + CONTEXT_CHARS)))
        of_kind = lambda value: F.coalesce(*[F.when(x["kind"] == k, value(k)) for k in PATTERNS])
        near = F.when(of_kind(lambda k: around.rlike(CONTEXT[k])), CONTEXT_BONUS).otherwise(0.0)
        return F.least(F.lit(1.0), of_kind(lambda k: F.lit(PRIOR[k] + CHECKED.get(k, 0.0))) + near)
    all_spans = F.transform(spans, lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"), score(x).alias("score")))
    return F.filter(all_spans, lambda x: x["kind"].isin(*BASE) | (x["score"] >= MIN_SCORE)).cast(SPANS)


def blocks_of(text: Column) -> Column:
    """Bind it by ``let``: as a column of its own it may be put, by the optimizer, where it is computed for every span."""
    return F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{BLOCK}}}+"), F.lit(0))


def detect(docs: DataFrame, text: str = "text") -> DataFrame:
    """row (a struct of all columns of ``docs``), whole (its text) and pii (its spans by kind, then start). One pass, no shuffle."""
    whole = F.col("whole")
    found = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(text), F.lit("")).alias("whole"))
    with_scores = lambda f: F.when(F.size(f) > 0, let(blocks_of(whole), lambda b: scored(f, b))).otherwise(F.array().cast(SPANS))
    return found.withColumn("pii", let(F.concat(*[find(whole, k) for k in PATTERNS]), with_scores))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, a count for each base kind, base_sha256 and spans, from ``detect``."""
    count = lambda k: F.size(F.filter("pii", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    base = F.filter("pii", lambda x: x["kind"].isin(*BASE))
    return detect(docs.select("doc_id", "text")).select("row.doc_id", *[count(k) for k in BASE], F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("pii")).alias("spans"))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets; texts without spans, null ones too, stay as they are."""
    order = F.array_sort(F.transform("pii", lambda x: F.struct(x["start"].alias("start"), (-x["end"]).alias("back"), x["kind"].alias("kind"))))

    def marked(spans: Column, blocks: Column) -> Column:
        # a span that begins before the end of an earlier one is under that one's mark
        reached = running(F.transform(spans, lambda x: -x["back"]), lambda x, before: F.greatest(x, before))
        pieces = let(reached, lambda r: F.transform(spans, lambda x, i: let(F.coalesce(F.get(r, i - 1), F.lit(0)), lambda at: F.when(
            x["start"] >= at, F.concat(cut(blocks, at, x["start"]), F.lit("<"), F.upper(x["kind"]), F.lit(">"))).otherwise(F.lit("")))))
        return F.concat(F.array_join(pieces, ""), cut(blocks, F.array_max(F.transform(spans, lambda x: -x["back"])), F.length("whole")))
    return detect(docs, text).select(*[F.when(F.size("pii") > 0, let(blocks_of(F.col("whole")), lambda b: let(order, lambda o: marked(o, b)))).otherwise(F.col(f"row.`{c}`")).alias(c) if c == text else F.col(f"row.`{c}`") for c in docs.columns])
