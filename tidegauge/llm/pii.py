"""Personal data in texts, by DataFrame functions alone.

A pattern proposes spans, a validator confirms them, and words nearby adjust the
score. Positions come from one more pass of the same pattern: what lies between
the matches, added to the matches' own lengths, gives every start.

Patterns are written so that their cost is linear in the text. Repeats that never
have to give anything back are possessive, which also keeps them off the stack,
and a run of characters is tried from its first character, or from where the last
match ended, as a later start in the run could only fail in the same place.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import set_apart

BLOCK = 256  # matches that one fold of running positions takes


@dataclass(frozen=True)
class Kind:
    """A kind of personal data: how it looks, what confirms it, its score with and without context, who may miss it."""

    name: str
    pattern: str
    hint: str  # a text without a match of this has none of the kind
    score: float
    context: str
    lift: float = 0.3
    base: bool = True
    reach: int = 0  # if any, a match is the beginning of a span, and so many characters decide where that ends


#: Characters of an IBAN by country, as registered.
IBAN_SIZES = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_REGISTERED = "|".join(IBAN_SIZES.values()).replace(" ", "|")
_IBAN = "^(?:" + "|".join(f"(?:{codes.replace(' ', '|')})[0-9]{{2}}(?:[ ]?[A-Z0-9]){{{size - 4}}}" for size, codes in IBAN_SIZES.items()) + ")(?![A-Za-z0-9])"
_GROUPS = rf"^(?!{_REGISTERED})[A-Z]{{2}}[0-9]{{2}}[A-Z0-9]*+(?![a-z])(?: [A-Z0-9]++(?![a-z]))*+"
IBAN_REACH = 2 * 34  # characters and spaces between them, and one that follows

KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 0.9, "mail|contact|write", 0.1),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}", ".", 0.6, "ip|addr|host|server"),
    # Shorter runs of digits fail the validator whole, so asking for 14 finds the same cards.
    Kind("card", r"[0-9](?:[ -]?[0-9]){13,}+", "", 0.6, "card|visa|master|credit|pay"),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", "+", 0.7, "phone|tel|call|mobile|fax", 0.2),
    # Only the first four characters, as what follows may be another one's beginning.
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=(?:[ ]?[A-Z0-9]){11})", "", 0.7, "iban|account|bank|konto", base=False, reach=IBAN_REACH),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "-", 0.3, "ssn|social|security|tax", base=False),
)
THRESHOLD = 0.5
SPAN = "array<struct<start:int,rank:int,stop:int,kind:string,score:double>>"


def _luhn(digits: Column) -> Column:
    turned = F.reverse(digits)
    places = F.sequence(F.lit(1), F.length(digits))
    digit = F.transform(places, lambda i: F.ascii(turned.substr(i, F.lit(1))) - 48)
    doubled = F.transform(digit, lambda d, i: F.when(i % 2 == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0)))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def _mod_97(text: Column) -> Column:
    """The number of an IBAN, letters as 10 to 35, is 1 modulo 97."""
    turned = F.concat(text.substr(F.lit(5), F.length(text)), text.substr(F.lit(1), F.lit(4)))
    codes = F.transform(F.split(turned, ""), lambda c: F.ascii(c))
    step = lambda a, c: F.when(c < 58, a * 10 + c - 48).otherwise(a * 100 + c - 55) % 97
    return F.aggregate(F.filter(codes, lambda c: c > 0), F.lit(0), step) == 1


def _iban_within(ahead: Column) -> Column:
    """The IBAN that a text begins with, or the empty text: as long as its country's are.

    Where the country is not registered, it is the longest that ends with a group and passes.
    """
    groups = F.split(F.regexp_extract(ahead, _GROUPS, 0), " ")
    ends = F.transform(F.sequence(F.lit(1), F.size(groups)), lambda k: F.array_join(F.slice(groups, 1, k), " "))
    passing = F.filter(ends, lambda e: _valid("iban", e))
    known = F.regexp_extract(ahead, _IBAN, 0)
    return F.when(ahead.rlike(rf"^(?:{_REGISTERED})"), known).otherwise(F.coalesce(F.get(passing, F.size(passing) - 1), F.lit("")))


def _within_byte(part: Column) -> Column:
    plain = F.ltrim(part, F.lit("0"))
    return (F.length(plain) < 3) | ((F.length(plain) == 3) & (plain <= "255"))


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(match, r"\."), _within_byte)
    if kind == "card":
        digits = F.translate(match, " -", "")
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(F.translate(match, "+ ().-", "")).between(10, 15)
    if kind == "iban":
        plain = F.translate(match, " ", "")
        return F.when(F.length(plain).between(15, 34), _mod_97(plain)).otherwise(False)
    if kind == "ssn":
        return ~match.rlike("^(000|666|9)") & ~match.rlike("-00-") & ~match.rlike("0000$")
    return F.lit(True)


def _running(gaps: Column, sizes: Column) -> Column:
    """Where each of many matches starts: fold within blocks, then over blocks, so that no fold copies long arrays."""
    moves = F.zip_with(gaps, sizes, lambda g, s: F.struct(g.alias("gap"), s.alias("size")))

    def fold(rows: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        add = lambda a, r: F.struct((a["at"] + r["gap"] + r["size"]).alias("at"), F.concat(a["out"], F.array(a["at"] + r["gap"])).alias("out"))
        return F.aggregate(rows, start, add)

    firsts = F.sequence(F.lit(1), F.greatest(F.size(sizes), F.lit(1)), F.lit(BLOCK))
    blocks = F.transform(firsts, lambda i: fold(F.slice(moves, i, BLOCK)))
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<array<int>>").alias("out"))
    shift = lambda a, b: F.struct((a["at"] + b["at"]).alias("at"), F.concat(a["out"], F.array(F.transform(b["out"], lambda x: x + a["at"]))).alias("out"))
    return F.flatten(F.aggregate(blocks, begin, shift)["out"])


def _confirmed(k: Kind, rank: int, threshold: float) -> Column:
    """The spans of a kind's matches that its validator, and for added kinds their score, lets pass."""
    match, between, start = (F.col(f"_{x}_{k.name}") for x in ("match", "between", "start"))

    def following(i: Column) -> Column:
        """At least `reach` + 20 characters after match i, if there are: texts between matches and the matches, which are five apart."""
        far = k.reach + 20
        parts = far // 5 + 1
        pairs = F.zip_with(F.slice(between, i + 2, parts), F.slice(match, i + 2, parts), lambda b, m: F.concat(F.substring(b, 1, far), F.coalesce(m, F.lit(""))))
        return F.array_join(pairs, "")

    def judged(m: Column, after: Column, i: Column) -> Column:
        before = F.lower(F.substring(F.get(between, i), -40, 40))
        near = before.rlike(rf"\b({k.context})") | F.lower(after).rlike(rf"\b({k.context})")
        score = F.when(near, F.lit(min(1.0, k.score + k.lift))).otherwise(F.lit(k.score))
        at = F.get(start, i)
        valid = _valid(k.name, m) if k.base else _valid(k.name, m) & (score >= threshold)
        return F.when(valid, F.struct(at.alias("start"), F.lit(rank).alias("rank"), (at + F.length(m)).alias("stop"), F.lit(k.name).alias("kind"), score.alias("score")))

    def span(m: Column, i: Column) -> Column:
        if not k.reach:
            return judged(m, F.substring(F.get(between, i + 1), 1, 20), i)
        # An array of one, so that what lies ahead is put together once.
        ahead = F.transform(F.array(F.concat(m, following(i))), lambda a: F.struct(a.alias("a"), _iban_within(a).alias("m")))
        return F.get(F.transform(ahead, lambda a: judged(a["m"], a["a"].substr(F.length(a["m"]) + 1, F.lit(20)), i)), F.lit(0))

    return F.filter(F.transform(match, span), lambda s: s.isNotNull()).cast(SPAN)


def find_spans(docs: DataFrame, text: str = "text", kinds: tuple[Kind, ...] = KINDS, threshold: float = THRESHOLD) -> DataFrame:
    """docs with `pii_spans`: spans of personal data, by start and then kind, in code points, the end exclusive.

    A span is struct(start, rank, stop, kind, score); rank is the kind's place in
    `kinds`. Base kinds stay whatever their score; others need `threshold`. A null
    text has none. Rows stay as they are, repeated ones too, with all other columns
    whatever their names; a column pii_spans is replaced.
    """
    docs, given = set_apart(docs.drop("pii_spans"), [f"_{x}_{k.name}" for x in ("match", "between", "start") for k in kinds])
    empty = F.array().cast("array<string>")
    out = docs
    for k in kinds:
        found = F.regexp_extract_all(F.col(text), F.lit(k.pattern), F.lit(0))
        # The hint is looked for before the pattern is run.
        out = out.withColumn(f"_match_{k.name}", F.when(F.contains(F.col(text), F.lit(k.hint)), found).otherwise(empty) if k.hint else F.coalesce(found, empty))
    for k in kinds:
        between = F.split(F.col(text), k.pattern, -1)
        out = out.withColumn(f"_between_{k.name}", F.when(F.size(f"_match_{k.name}") > 0, between).otherwise(empty))
    for k in kinds:
        gaps = F.transform(F.slice(F.col(f"_between_{k.name}"), 1, F.size(f"_match_{k.name}")), F.length)
        start = _running(gaps, F.transform(f"_match_{k.name}", F.length))
        out = out.withColumn(f"_start_{k.name}", F.when(F.size(f"_match_{k.name}") > 0, start).otherwise(F.array().cast("array<int>")))
    every = [_confirmed(k, rank, threshold) for rank, k in enumerate(kinds)]
    spans = F.array_sort(F.concat(*every))
    none = F.array().cast(SPAN)
    any_match = F.lit(False)
    for k in kinds:
        any_match |= F.size(f"_match_{k.name}") > 0
    found = out.select(*docs.columns, F.when(any_match, spans).otherwise(none).alias("pii_spans"))
    return found.withColumnsRenamed(given) if given else found


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def _of_kind(spans: Column, name: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == name)).cast("long")


def span_report(found: DataFrame, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """Per row of find_spans: doc_id, counts of the base kinds, the digest of base spans, and all spans as text."""
    spans = F.col("pii_spans")
    base = [k.name for k in kinds if k.base]
    counts = [_of_kind(spans, n).alias(f"n_{n}") for n in base]
    own = F.filter(spans, lambda s: s["kind"].isin(base))
    return found.select("doc_id", *counts, F.sha2(_joined(own).cast("binary"), 256).alias("base_sha256"), _joined(spans).alias("spans"))


def masked(text: Column, spans: Column) -> Column:
    """The text with every span, or run of overlapping spans, replaced by the first one's kind in brackets."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(a: Column, s: Column) -> Column:
        kept = text.substr(a["at"] + 1, s["start"] - a["at"])
        fresh = F.concat(a["out"], F.array(kept, F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))))
        return F.struct(F.greatest(a["at"], s["stop"]).alias("at"), F.when(s["start"] < a["at"], a["out"]).otherwise(fresh).alias("out"))

    whole = F.aggregate(spans, start, step, lambda a: F.concat(F.array_join(a["out"], ""), text.substr(a["at"] + 1, F.length(text))))
    return F.when(F.size(spans) == 0, text).otherwise(whole)
