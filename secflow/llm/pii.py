"""Personal data: regular expressions propose spans, checksums confirm them, context words adjust their score.

Four base kinds have fixed rules: e-mail, IP address, card number (Luhn) and phone number. Two more are proposed with
care: IBANs, confirmed by their length and mod 97, and social security numbers, which need a context word nearby.
Positions are code points, ends exclusive. Only Spark's own functions are used; no Python runs on the executors.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values. The base patterns, in the order of their kinds. Runs are possessive and start where no earlier
#: start can reach the same end, so that a long run is read once; the matches are those of the plain patterns
#:   email  [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
#:   ip     [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
#:   card   [0-9]([\x20-]?[0-9])+
#:   phone  \+[0-9][\x20().0-9-]+[0-9]
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?=[0-9])(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
#: Characters before and behind a span that are searched for context words.
NEARBY = 40
#: A span counts from this score on.
ENOUGH = 0.5


@dataclass(frozen=True)
class Kind:
    """``hint``: what a text must contain to be searched. ``score``: without context; a context word adds 0.3."""

    name: str
    pattern: str
    hint: str
    score: float
    words: str


KINDS = (
    Kind("email", EMAIL, "@", 0.7, "mail|contact|write"),
    Kind("ip", IP, ".", 0.6, "ip|host|server|addr"),
    Kind("card", CARD, "", 0.7, "card|visa|credit|pay"),
    Kind("phone", PHONE, "+", 0.6, "phone|call|tel|mobile|fax"),
    Kind("iban", IBAN, "", 0.6, "iban|account|bank|konto|compte|cuenta"),
    Kind("ssn", SSN, "-", 0.3, "ssn|social|security"),
)
BASE = ("email", "ip", "card", "phone")


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def mod97(x: Column) -> Column:
    """The remainder of an IBAN by 97: its first four characters behind the rest, A to Z as 10 to 35."""
    plain = F.replace(x, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(plain, F.lit(5)), F.substring(plain, 1, 4))

    def step(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code >= 65, (rest * 100 + code - 55) % 97).otherwise((rest * 10 + code - 48) % 97)

    return F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), step)


def confirmed(kind: str, x: Column) -> Column:
    """Whether the checks of a kind hold for a match."""
    if kind == "ip":
        return F.forall(F.split(x, r"\."), lambda p: F.coalesce(p.try_cast("int") <= 255, F.lit(False)))
    if kind == "card":
        n = F.length(_digits(x))
        return (n >= 14) & (n <= 19) & F.call_function("luhn_check", _digits(x))
    if kind == "phone":
        n = F.length(_digits(x))
        return (n >= 10) & (n <= 15)
    if kind == "iban":
        n = F.length(F.replace(x, F.lit(" "), F.lit("")))
        return (n >= 15) & (n <= 34) & (mod97(x) == 1)
    if kind == "ssn":
        return ~x.rlike("^(000|666|9)") & ~x.rlike("^...-00") & ~x.rlike("0000$")
    return F.lit(True)


#: Sorted as they should be: by start, then by the order of kinds.
_SPAN = "array<struct<start:int,kind:int,stop:int,name:string,score:double>>"


def _spans(rank: int, kind: Kind, text: Column, matches: Column, gaps: Column) -> Column:
    """The confirmed spans of one kind, from its matches and the text between them."""
    empty = F.array().cast(_SPAN)
    start = F.struct(F.lit(0).alias("at"), empty.alias("found"))

    def step(state: Column, pair: Column) -> Column:
        begin = state["at"] + F.length(pair["gap"])
        end = begin + F.length(pair["match"])
        before = F.substring(text, F.greatest(begin + 1 - NEARBY, F.lit(1)), F.least(begin, F.lit(NEARBY)))
        near = F.concat(before, F.lit(" "), F.substring(text, end + 1, F.lit(NEARBY)))
        score = kind.score + F.when(F.lower(near).rlike(rf"(?<![a-z])(?:{kind.words})"), 0.3).otherwise(0.0)
        span = F.struct(begin.alias("start"), F.lit(rank).alias("kind"), end.alias("stop"), F.lit(kind.name).alias("name"), score.alias("score"))
        keep = confirmed(kind.name, pair["match"]) & (score >= ENOUGH)
        return F.struct(end.alias("at"), F.when(keep, F.concat(state["found"], F.array(span).cast(_SPAN))).otherwise(state["found"]).alias("found"))

    pairs = F.zip_with(F.slice(gaps, 1, F.size(matches)), matches, lambda g, m: F.struct(g.alias("gap"), m.alias("match")))
    return F.when(F.size(matches) > 0, F.aggregate(pairs, start, step)["found"]).otherwise(empty)


def with_spans(docs: DataFrame, text_col: str = "text", name: str = "spans") -> DataFrame:
    """``docs`` with an array of structs ``start, kind, stop, name, score``, by start, then by the order of kinds.

    A null text counts as empty and has no span. Spans of different kinds may overlap. Whole texts are read; a text
    that lacks what every match of a kind contains is not searched for it. ``name`` replaces a column of that name;
    all others stay as they are, whatever they are called.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), text.alias("text"))
    none = F.array().cast("array<string>")
    row = row.select("row", "text", *[
        F.when(F.contains("text", F.lit(k.hint)) if k.hint else F.lit(True), F.regexp_extract_all("text", F.lit(k.pattern), F.lit(0))).otherwise(none).alias(f"m{i}")
        for i, k in enumerate(KINDS)
    ])
    row = row.select("row", "text", *[f"m{i}" for i in range(len(KINDS))], *[
        F.when(F.size(f"m{i}") > 0, F.split("text", k.pattern)).otherwise(none).alias(f"g{i}") for i, k in enumerate(KINDS)
    ])
    found = [_spans(i, k, F.col("text"), F.col(f"m{i}"), F.col(f"g{i}")) for i, k in enumerate(KINDS)]
    row = row.select("row", F.array_sort(F.concat(*found)).alias("spans"))
    return row.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns if c != name], F.col("spans").alias(name))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["name"], s["start"], s["stop"])), ",")


def _is(kind: str):
    return lambda s: s["name"] == kind


def digest(found: DataFrame, id_col: str = "doc_id", name: str = "spans") -> DataFrame:
    """Counts of the base kinds, a digest of their spans, and all spans as a text."""
    spans = F.col(name)
    counts = [F.size(F.filter(spans, _is(k))).cast("long").alias(f"n_{k}") for k in BASE]
    base = F.filter(spans, lambda s: s["kind"] < len(BASE))
    return found.select(F.col(id_col).alias("doc_id"), *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed(spans).alias("spans"))


def masked(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; of overlapping spans the first one that starts.

    What a later span covers beyond the first goes with it.
    """
    text = F.coalesce(text, F.lit(""))
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(state: Column, s: Column) -> Column:
        fresh = s["start"] >= state["at"]
        between = F.substring(text, state["at"] + 1, s["start"] - state["at"])
        mark = F.concat(between, F.lit("["), F.upper(s["name"]), F.lit("]"))
        return F.struct(
            F.greatest(state["at"], s["stop"]).alias("at"),
            F.when(fresh, F.concat(state["parts"], F.array(mark))).otherwise(state["parts"]).alias("parts"),
        )

    done = F.aggregate(spans, begin, step, lambda s: F.concat(F.array_join(s["parts"], ""), F.substr(text, s["at"] + 1)))
    return F.when(F.size(spans) > 0, done).otherwise(text)
