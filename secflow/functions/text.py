"""String and map helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Texts that mean "no value" in device logs.
NULL_SYNONYMS = ["unknown", "n/a", "-", "", "?"]

# Patterns for metric names, index names and Windows paths.
METRIC_SEPARATORS = r"\.| "
METRIC_FORBIDDEN = r"[^a-zA-Z\d\-_]"
INDEX_FORBIDDEN = r'\s|"|\*|\\|<|\||,|>|\?|/'
PATH_SEPARATOR = r"(:\\)|(\\+)"
PATH_PREFIXES = ["\\\\*\\", "\\??\\"]

ANY = "*"
UNKNOWN = "unknown"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use the result many times in ``body``.

    Without it an expression tree that mentions the same sub-expression in several places
    grows with every level of nesting.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed exactly once per row.

    Plain projections may be copied into every later filter and expression that mentions them, so
    a parsed document would be parsed again for each of its fields.  The output of a generator is
    never copied; one over a single-element array adds no rows.
    """
    for name, column in columns.items():
        df = df.select("*", F.explode(F.array(column)).alias(name))
    return df


def means_null(value: Column) -> Column:
    return F.lower(value).isin(NULL_SYNONYMS)


def clean_map(fields: Column) -> Column:
    """Trim values, then drop NULLs and texts that mean "no value"."""
    trimmed = F.transform_values(fields, lambda _, v: F.trim(v))
    return F.map_filter(trimmed, lambda _, v: v.isNotNull() & ~means_null(v))


def last_wins_map(keys: Column, values: Column) -> Column:
    """Map from parallel arrays where a repeated key keeps its last value.

    The plain ``map_from_arrays`` is used whenever keys are unique; it would raise on duplicates.
    """
    entries = F.arrays_zip(keys.alias("k"), values.alias("v"))
    newest_first = F.reverse(keys)
    kept = F.filter(
        entries,
        lambda e, i: F.array_position(newest_first, e["k"]) == (F.size(keys) - i).cast("bigint"),
    )
    deduplicated = F.map_from_arrays(
        F.transform(kept, lambda e: e["k"]), F.transform(kept, lambda e: e["v"])
    )
    return F.when(
        F.size(F.array_distinct(keys)) == F.size(keys), F.map_from_arrays(keys, values)
    ).otherwise(deduplicated)


def split_host(fqdn: Column | None, hostname: Column | None) -> tuple[Column, Column]:
    """Untangle fully qualified and short names: devices put either into either field."""
    null = F.lit(None).cast("string")
    if fqdn is None and hostname is None:
        return null, null

    def qualified(name: Column) -> Column:
        return F.when(F.instr(name, ".") > 1, name)

    def short(name: Column) -> Column:
        return F.when(F.instr(name, ".") > 1, F.substring_index(name, ".", 1)).otherwise(name)

    names = [c for c in (fqdn, hostname) if c is not None]
    return F.coalesce(*[qualified(n) for n in names]), F.coalesce(*[short(n) for n in names])


def metric_name(value: Column) -> Column:
    joined = F.regexp_replace(value, METRIC_SEPARATORS, "_")
    return F.regexp_replace(joined, METRIC_FORBIDDEN, "")


def index_title(value: Column) -> Column:
    return F.regexp_replace(F.lower(value), INDEX_FORBIDDEN, "_")


def path_segments(path: Column) -> Column:
    """Lower-cased path parts; an absent path is the single wildcard part."""
    prefixed = F.lit(False)
    for prefix in PATH_PREFIXES:
        prefixed = prefixed | F.startswith(path, F.lit(prefix))
    body = F.when(prefixed, F.substr(path, F.lit(5))).otherwise(path)
    parts = F.split(F.lower(body), PATH_SEPARATOR)
    # A trailing separator leaves no part behind it; a leading one does leave an empty part.
    trimmed = F.when(
        (F.size(parts) > 1) & (F.element_at(parts, -1) == ""),
        F.slice(parts, F.lit(1), F.size(parts) - 1),
    ).otherwise(parts)
    only_separators = (F.size(trimmed) == 1) & (F.get(trimmed, F.lit(0)) == "") & (path != "")
    return F.when(path.isNull() | only_separators, F.array(F.lit(ANY))).otherwise(trimmed)
