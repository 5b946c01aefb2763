"""Personal data by patterns, checksums and context, in DataFrame functions only.

Regular expressions propose spans: email, ip, card and phone (the base kinds) and iban. Luhn's
sum confirms cards and mod-97 confirms ibans; wrong ones are dropped. An iban is searched from
each place where one can start: of the groups that follow, up to each space, the longest that
mod-97 confirms is taken, and one that starts inside another is dropped. A span's score starts from
its kind, rises if a checksum confirmed it, and rises if a context word of its kind stands within
``NEAR`` characters before or after it. Base spans stay whatever their score; ibans need
``LEAST``.

Places come without a user function: the text is split at a kind's matches, and a match starts
at the summed length of what stands before it. Sums are taken in blocks of ``BLOCK`` matches, so
that a text with very many matches stays cheap. Patterns are written so that Java's matcher takes
one pass: a run is entered at its start only (or where the last match ended), and what can't help
by backtracking is possessive.

Defined cases: null and empty texts have no spans; whole texts are searched; repeated rows are
searched each; null ids stay null; empty tables give empty results; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vocalstat.llm.common import load, whole_text

BLOCK = 64
NEAR = 40
LEAST = 0.5

_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=(?:\x20?[A-Z0-9]{4}){2})",
}
#: All groups that an iban's first four characters (its match above) may have after them.
GROUPS = r"^[A-Z0-9]{4}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
#: Characters and groups that the longest has at most, and characters that the shortest has at least.
LONGEST, MOST, SHORTEST = 43, 9, 12
BASE = ("email", "ip", "card", "phone")
#: Score of a kind by its form, what a checksum adds, and words that speak for it.
FORM = {"email": 0.8, "ip": 0.6, "card": 0.3, "phone": 0.6, "iban": 0.3}
CHECKED = {"card": 0.4, "iban": 0.4}
CONTEXT = 0.2
WORDS = {
    "email": "e-?mail|contact|write|mailto|correo|courriel",
    "ip": "ip|host|server|login|address|adresse",
    "card": "card|visa|mastercard|credit|payment|karte|carte|tarjeta",
    "phone": "phone|tel|call|mobile|fax|telefon|t[ée]l[ée]phone|tel[ée]fono",
    "iban": "iban|bank|account|konto|compte|cuenta",
}


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def luhn(digits: Column) -> Column:
    """Luhn's sum of a string of digits is a multiple of ten."""
    def part(i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0)).cast("long")

    return _sum(F.transform(F.sequence(F.lit(0), F.length(digits) - 1), part)) % 10 == 0


def mod97(iban: Column) -> Column:
    """The number of an iban (first four characters last, letters as 10 to 35) leaves 1."""
    plain = F.regexp_replace(iban, " ", "")
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))
    chars = F.transform(F.sequence(F.lit(1), F.length(turned)), lambda i: F.substring(turned, i, F.lit(1)))
    value = lambda c: F.conv(c, 36, 10).cast("long")
    step = lambda a, c: (a * F.when(value(c) > 9, 100).otherwise(10) + value(c)) % 97
    return F.aggregate(chars, F.lit(0).cast("long"), step) == 1


def _longest_iban(text: Column, start: Column) -> Column:
    """The longest valid iban from a place on that ends at the end of its groups or at a space, or null."""
    groups = F.split(F.regexp_extract(F.substring(text, (start + 1).cast("int"), F.lit(LONGEST + 1)), GROUPS, 0), " ")
    cuts = F.transform(F.sequence(F.size(groups), F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(groups, F.lit(1), n), " "))
    return F.get(F.filter(cuts, lambda c: (F.length(F.regexp_replace(c, " ", "")) >= SHORTEST) & mod97(c)), 0)


def _apart(spans: Column) -> Column:
    """Spans in order without those that start inside one before; ``MOST`` start within the longest."""
    def free(s: Column, i: Column) -> Column:
        before = F.slice(spans, F.greatest(F.lit(1), i + 1 - MOST), F.least(i, F.lit(MOST)))
        return ~F.exists(before, lambda p: p["end"] > s["start"])

    return F.filter(spans, free)


def _valid(kind: str, value: Column) -> Column:
    n = F.length(_digits(value))
    if kind == "ip":
        short = lambda p: F.regexp_replace(p, "^0+(?=.)", "")
        return F.forall(F.split(value, r"\."), lambda p: (F.length(short(p)) <= 3) & (F.substring(short(p), 1, 4).cast("int") <= 255))
    if kind == "card":
        return n.between(13, 19) & F.when(n.between(13, 19), luhn(_digits(value))).otherwise(False)
    if kind == "phone":
        return n.between(9, 15)
    if kind == "iban":
        return value.isNotNull()
    return F.lit(True)


def _starts(gaps: Column, found: Column) -> Column:
    """Where each match starts: the length of the gaps up to it and of the matches before it."""
    n = F.size(found)
    steps = F.transform(found, lambda m, i: F.length(F.get(gaps, i)) + F.when(i > 0, F.length(F.get(found, i - 1))).otherwise(0))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / BLOCK).cast("int")), lambda b: _sum(F.slice(steps, b * BLOCK + 1, F.lit(BLOCK))))
    before = F.aggregate(blocks, F.array(F.lit(0).cast("long")), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
    return F.struct(steps.alias("steps"), before.alias("before"))


def _spans(kind: str, text: Column, sums: Column, found: Column) -> Column:
    def place(i: Column) -> Column:
        block = F.floor(i / BLOCK).cast("int")
        return F.get(sums["before"], block) + _sum(F.slice(sums["steps"], block * BLOCK + 1, i - block * BLOCK + 1))

    def at(value: Column, i: Column) -> Column:
        return F.struct(place(i).alias("start"), value.alias("value"))

    def whole(m: Column) -> Column:
        return F.struct(m["start"].alias("start"), _longest_iban(text, m["start"]).alias("value"))

    def span(m: Column) -> Column:
        start, value = m["start"], m["value"]
        around = F.substring(text, F.greatest(F.lit(1), start + 1 - NEAR).cast("int"),
                             (F.least(start, F.lit(NEAR)) + F.length(value) + NEAR).cast("int"))
        near = around.rlike(rf"(?i)(?<![\p{{L}}])(?:{WORDS[kind]})(?![\p{{L}}])")
        score = F.lit(FORM[kind] + CHECKED.get(kind, 0.0)) + F.when(near, CONTEXT).otherwise(0.0)
        return F.struct(F.lit(kind).alias("kind"), start.alias("start"), (start + F.length(value)).alias("end"),
                        value.alias("value"), F.least(score, F.lit(1.0)).alias("score"))

    matches = F.transform(found, at)
    if kind == "iban":
        matches = F.filter(F.transform(matches, whole), lambda m: m["value"].isNotNull())
    return F.filter(F.transform(matches, span), lambda s: _valid(kind, s["value"]) & (F.lit(kind in BASE) | (s["score"] >= LEAST)))


def find_pii(docs: DataFrame) -> DataFrame:
    """(doc_id, spans): spans of every row by kind, then place, each (kind, start, end, value, score)."""
    d = docs.select("doc_id", whole_text().alias("text"))
    d = d.withColumns({f"m_{k}": F.regexp_extract_all("text", F.lit(p), F.lit(0)) for k, p in PATTERNS.items()})
    some = lambda k, c: F.when(F.size(f"m_{k}") > 0, c)
    d = d.withColumns({f"g_{k}": some(k, F.split("text", p, -1)) for k, p in PATTERNS.items()})
    d = d.withColumns({f"s_{k}": some(k, _starts(F.col(f"g_{k}"), F.col(f"m_{k}"))) for k in PATTERNS})
    none = F.expr("cast(array() as array<struct<kind:string,start:bigint,end:bigint,value:string,score:double>>)")
    d = d.withColumns({f"x_{k}": F.coalesce(some(k, _spans(k, F.col("text"), F.col(f"s_{k}"), F.col(f"m_{k}"))), none) for k in PATTERNS})
    d = d.withColumn("x_iban", _apart(F.col("x_iban")))
    return d.select("doc_id", F.concat(*[f"x_{k}" for k in PATTERNS]).alias("spans"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document, over the whole ``documents``."""
    d = find_pii(load(spark, sf_dir, "documents"))
    named = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    of = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    counts = {f"n_{k}": F.size(of(k)).cast("long") for k in (*BASE, "iban")}
    return d.withColumns(counts | {"base_sha256": F.sha2(named(of(*BASE)), 256)}).withColumns(
        {"score": F.array_max(F.transform("spans", lambda s: s["score"])), "spans": named(F.col("spans"))})
