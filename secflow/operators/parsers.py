"""Device logs to field maps.

Each parser is a column expression returning ``MAP<STRING,STRING>``; ``parse_logs`` picks one
per row.  Keys with several values (multi-line audit records) go to ``multi``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from secflow.functions.grok import parse_grok
from secflow.functions.text import clean_map, last_wins_map, let, once

# Firewall message ids that have a pattern of their own.
ASA_IDS = [
    "113004", "113012", "113015", "605005", "611101", "111008", "111010", "106023", "710003",
    "104001", "104002", "105005", "105008", "105009", "106001", "106006", "106007", "106011",
    "106014",
]
# Network-device mnemonics and their patterns.
IOS_PATTERN_OF = {
    "login_failed": "CISCO_IOS_ISR_LOGIN",
    "login_success": "CISCO_IOS_ISR_LOGIN",
    "ssh2_userauth": "CISCO_IOS_ISR_SSH2",
    "logout": "CISCO_IOS_ISR_LOGOUT",
    "config_i": "CISCO_IOS_ISR_CONFIG_I",
}
# Every firewall line starts with a five-character priority such as "<189>".
PRIORITY_LENGTH = 5

EMPTY_MAP = "map<string,string>"
ENTRY = "array<struct<k:string,v:string>>"


def _empty() -> Column:
    return F.create_map().cast(EMPTY_MAP)


def _pairs_regex(quote: str) -> str:
    q = "\\" + quote if quote == '"' else quote
    return rf"(?:^|(?<= ))([^ =]+)=({q}[^{q}]*{q}|[^ ]*)"


def _unquote(values: Column, quote: str) -> Column:
    edges = f"^{quote}|{quote}$"
    return F.transform(
        values,
        lambda v: F.when(F.startswith(v, F.lit(quote)), F.regexp_replace(v, edges, "")).otherwise(v),
    )


def parse_kv(text: Column, quote: str = '"', skip: int = PRIORITY_LENGTH) -> Column:
    """``key=value`` words separated by blanks; values may be quoted; a repeated key keeps its last value."""
    body = F.substr(text, F.lit(skip + 1)) if skip else text
    regex = F.lit(_pairs_regex(quote))
    keys = F.regexp_extract_all(body, regex, F.lit(1))
    values = _unquote(F.regexp_extract_all(body, regex, F.lit(2)), quote)
    pairs = F.struct(keys.alias("k"), values.alias("v"))
    return clean_map(let(pairs, lambda p: last_wins_map(p["k"], p["v"])))


def parse_asa(text: Column) -> Column:
    """The message id selects the pattern; an unknown id gives an empty map."""

    def by_id(message: Column) -> Column:
        fields = F.when(F.lit(False), _empty())
        for known in ASA_IDS:
            fields = fields.when(message == known, parse_grok(text, f"%{{CISCOASA_{known}}}"))
        return fields.otherwise(_empty())

    found = parse_grok(text, "%{CISCOASA_ID}")
    return let(F.try_element_at(found, F.lit("id")), by_id)


def parse_ios(text: Column) -> Column:
    """The mnemonic of the header selects the pattern; header fields win over its captures."""
    header = parse_grok(text, "%{CISCO_IOS_ISR_HEADER}")

    def whole(head: Column) -> Column:
        kind = F.try_element_at(head, F.lit("eventType"))
        body = F.when(F.lit(False), _empty())
        for mnemonic, pattern in IOS_PATTERN_OF.items():
            body = body.when(kind == mnemonic, parse_grok(text, f"%{{{pattern}}}"))
        own = F.map_keys(head)
        merged = F.map_concat(
            F.map_filter(body, lambda k, _: ~F.array_contains(own, k)), head
        )
        return F.when(kind.isin(list(IOS_PATTERN_OF)), merged).otherwise(_empty())

    return let(header, whole)


def _audit_line(line: Column) -> Column:
    """Entries of one audit line: its words, those nested in ``msg='…'`` and the header numbers."""

    def words(text: Column) -> Column:
        return F.map_entries(parse_kv(text, quote="'", skip=0))

    def entries(fields: Column) -> Column:
        kind = F.try_element_at(fields, F.lit("type"))
        header = F.when(kind == "AVC", parse_grok(line, "%{AUDITD_AVC}")).otherwise(
            parse_grok(line, "%{AUDITD_HEADER}")
        )
        own = F.map_entries(F.map_filter(fields, lambda k, _: k != "msg"))
        nested = words(F.try_element_at(fields, F.lit("msg")))
        empty = F.array().cast(ENTRY)
        as_entries = [F.coalesce(part.cast(ENTRY), empty) for part in
                      (own, nested, F.map_entries(header))]
        return F.concat(*as_entries)

    raw = F.map_from_entries(words(line))
    return let(raw, entries)


def parse_audit(text: Column) -> Column:
    """All values of every key of an audit record as ``MAP<STRING,ARRAY<STRING>>``.

    The entries of all lines are sorted by key and place and folded where the key changes, so the
    work grows with the length of a record, whatever number of keys a sender makes up.
    """
    entries = F.flatten(F.transform(F.split(text, "\n"), _audit_line))
    placed = F.array_sort(F.transform(entries, lambda e, i: F.struct(e["k"].alias("k"), i.alias("at"), _strip_quotes(e["v"]).alias("v"))))

    def folded(ordered: Column) -> Column:
        size = F.size(ordered)

        def key(i: Column) -> Column:
            return F.get(ordered, i)["k"]

        def groups(starts: Column) -> Column:
            values = F.transform(starts, lambda i, n: F.transform(
                F.slice(ordered, i + 1, F.coalesce(F.get(starts, n + 1), size) - i), lambda e: e["v"]))
            return F.map_from_arrays(F.transform(starts, key), values)

        starts = F.filter(F.sequence(F.lit(0), size - 1), lambda i: (i == 0) | (key(i) != key(i - 1)))
        return F.when(size > 0, let(starts, groups)).otherwise(F.create_map().cast("map<string,array<string>>"))

    return let(placed, folded)


def _strip_quotes(value: Column) -> Column:
    inner = F.substring(value, F.lit(2), F.greatest(F.length(value) - 2, F.lit(0)))
    return F.when(F.startswith(value, F.lit('"')), inner).otherwise(value)


def single_values(multi: Column) -> Column:
    """The keys of a multi-valued map that have exactly one value."""
    singles = F.map_filter(multi, lambda _, v: F.size(v) == 1)
    return F.transform_values(singles, lambda _, v: F.get(v, F.lit(0)))


def repeated_values(multi: Column) -> Column:
    return F.map_filter(multi, lambda _, v: F.size(v) > 1)


def parse_json_fields(text: Column) -> Column:
    """A flat JSON object; NULLs and null synonyms are dropped, texts trimmed."""
    return clean_map(F.from_json(text, EMPTY_MAP))


def parse_antivirus(text: Column) -> Column:
    """JSON that follows free text, plus user and domain dug out of three of its fields.

    ``username`` outranks ``account``, which outranks ``detail``, when they disagree.
    """
    json = F.regexp_replace(text, r"^[^{]*", "")

    def enriched(fields: Column) -> Column:
        def of(name: str) -> Column:
            return F.try_element_at(fields, F.lit(name))

        found = [
            F.coalesce(parse_grok(of(name), f"%{{{pattern}}}"), _empty())
            for name, pattern in (("detail", "ESET_AUDIT_EVENT"), ("account", "ESET_USER_AND_DOMAIN"),
                                  ("username", "ESET_USER_AND_DOMAIN"))
        ]
        keys = F.concat(F.map_keys(fields), *[F.map_keys(f) for f in found])
        values = F.concat(F.map_values(fields), *[F.map_values(f) for f in found])
        return last_wins_map(keys, values)

    fields = F.map_filter(F.from_json(json, EMPTY_MAP), lambda _, v: v.isNotNull())
    return F.when(fields.isNotNull(), let(fields, enriched))


def parse_fail2ban(text: Column) -> Column:
    return parse_grok(text, "%{FAIL_2_BAN}")


# Parser name and version -> kind of payload it accepts and the expression that reads it.
PARSERS: dict[tuple[str, int], tuple[str, Callable[[Column], Column]]] = {
    ("fortigate", 1): ("string", parse_kv),
    ("asa00401", 1): ("string", parse_asa),
    ("ios/isr00401", 1): ("string", parse_ios),
    ("reassembledAuditD01", 1): ("string", parse_audit),
    ("esetnode02701", 1): ("string", parse_antivirus),
    ("fail2ban02901", 1): ("string", parse_fail2ban),
    ("windows_security", 1): ("object", parse_json_fields),
    ("unicon", 1): ("object", parse_json_fields),
}
MULTI_VALUED = ("reassembledAuditD01", 1)


def parse_logs(
    df: DataFrame, parsers: Iterable[tuple[str, int]] | None = None
) -> DataFrame:
    """Add ``fields``, ``multi`` and ``parse_error`` by the row's (parser_name, parser_version).

    ``parsers`` limits the plan to the formats a job really receives.  A payload of the wrong
    kind, an unknown parser or unreadable JSON ends in ``parse_error`` and never fails the job.
    """
    chosen = list(parsers) if parsers is not None else list(PARSERS)

    def when_parser(key: tuple[str, int]) -> Column:
        return (F.col("parser_name") == key[0]) & (F.col("parser_version") == key[1])

    fields, multi = F.when(F.lit(False), _empty()), F.lit(None).cast("map<string,array<string>>")
    error = F.when(F.col("envelope_error").isNotNull(), F.col("envelope_error"))
    known = F.lit(False)
    for key in chosen:
        kind, parser = PARSERS[key]
        here = when_parser(key) & (F.col("raw_kind") == kind)
        known = known | when_parser(key)
        error = error.when(when_parser(key) & (F.col("raw_kind") != kind),
                           F.lit(f"expected a payload of kind {kind}"))
        if key == MULTI_VALUED:
            multi = F.when(here, parser(F.col("raw")))
        else:
            fields = fields.when(here, parser(F.col("raw")))
    error = error.when(F.col("parser_name").isNotNull() & ~known, F.lit("parser is not known"))
    if MULTI_VALUED in chosen:
        df = once(df, _all=multi, _fields=fields)
        df = df.withColumns({
            "fields": F.coalesce(F.col("_fields"), single_values(F.col("_all"))),
            "multi": repeated_values(F.col("_all")),
        }).drop("_all", "_fields")
    else:
        df = once(df, fields=fields).withColumn("multi", multi)
    unreadable = F.when(
        F.col("parser_name").isNotNull() & F.col("fields").isNull(), "payload is not readable")
    return df.withColumn("parse_error", F.coalesce(error, unreadable))
