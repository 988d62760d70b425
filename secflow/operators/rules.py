"""Wildcard access rules matched to events by equi-joins on their exact keys and on nodes of their ranges.

A rule has layers (organization, domain, …).  For one event each layer gives a rule a rank: the
position of the event key that hits it, or the last position for a wildcard.  The rule with the
smallest rank vector wins, ties going to the smallest rule id.

``prepare`` turns rules into a table with one row for each combination of exact keys, path node and
range nodes: the best rule there.  A range of points is cut into the aligned segments of a tree with
16 children a node, its canonical cover; a point lies in one segment of each level.  All rules of
one row have the same exact and path ranks for every event that meets it, so only the one with the
least range ranks and id can win, and the others are left out.  No event ever sees a list of rules.

An event is looked up by its distinct keys and points: they are expanded to the wildcard masks that
occur (at most 36), then to the path shapes and segment levels that rules with these keys have, and
the least rank vector of the rows they meet wins.  All joins are equi-joins, and events themselves
are never multiplied.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from secflow.functions.text import ANY, path_segments
from secflow.session import dimension_side, keyed_join

MARK = "\x01"
ABSENT = "\x02"

#: Children of a segment as a power of two, and levels; points are whole numbers below 2**32.
BITS, LEVELS = 4, 8
LAST_POINT = (1 << BITS * LEVELS) - 1
#: Level (and node) of the rules that are open on an axis.
OPEN = -1


@dataclass
class ExactLayer:
    """Event keys in order of preference, and the rule columns holding the key it must equal."""

    name: str
    event_keys: list[Column]
    rule_keys: list[Column]


@dataclass
class RangeLayer:
    """A point of the event and the closed ranges of the rule that should contain it."""

    name: str
    point: Column
    ranges: Column


@dataclass
class Layers:
    exact: list[ExactLayer]
    ranges: list[RangeLayer] = field(default_factory=list)
    event_path: Column | None = None
    rule_path: Column | None = None
    #: The parts of the event path, where they are not those of ``event_path``.
    event_segments: Column | None = None

    @property
    def parts(self) -> Column | None:
        if self.event_segments is not None:
            return F.transform(self.event_segments, _unmarked)
        return None if self.event_path is None else path_segments(_unmarked(self.event_path))


def _joined_keys(columns: list[str]) -> Column:
    """Several keys as one text; the path joins its segments with marks, other keys have none."""
    return F.concat_ws(MARK, *[F.coalesce(F.col(c), F.lit(ABSENT)) for c in columns])


def _unmarked(key: Column) -> Column:
    """A key without the separating character, with which a sender could feign another key."""
    return F.translate(key, MARK, " ")


def keyed_rules(rules: DataFrame, layers: Layers, payload: list[str]) -> DataFrame:
    """One row per rule and combination of its exact keys; absent keys are the wildcard."""
    out = rules.select(
        "*", *[layer.ranges.alias(f"_{layer.name}") for layer in layers.ranges])
    for layer in layers.exact:
        keys = F.array_compact(F.array(*layer.rule_keys))
        out = out.withColumn(
            f"k_{layer.name}",
            F.explode(F.array_distinct(F.when(F.size(keys) == 0, F.array(F.lit(ANY))).otherwise(keys))),
        )
    return out.select("rule_id", *payload, *[f"_{layer.name}" for layer in layers.ranges],
                      *[f"k_{layer.name}" for layer in layers.exact])


def wildcard_mask(layers: Layers) -> Column:
    """One digit per exact layer: 1 where the key is the wildcard."""
    return F.concat(*[
        F.when(F.col(f"k_{layer.name}") == ANY, "1").otherwise("0") for layer in layers.exact
    ])


# Ranges ---------------------------------------------------------------------------------------


def range_spans(ranges: str, compat_zero_is_any: bool = True) -> str:
    """SQL of the points of a rule's ranges as structs (low, stop), and one from ``OPEN`` where it is open.

    Ranges are closed; one that ends at 0 ends at midnight, and one whose end is smaller than its
    start wraps around.  No range at all is the point 0.  A rule whose ranges hold the wildcard's
    point 0 as their start is open; NULL ranges never apply.
    """
    def span(low: str, stop: str) -> str:
        return f"named_struct('low', cast({low} as bigint), 'stop', cast({stop} as bigint))"

    stop = f"if(r.low > r.high, {LAST_POINT + 1}, least(cast(r.high as bigint), {LAST_POINT}) + 1)"
    inside = f"if(r.low is not null and r.high is not null, {span('greatest(r.low, 0)', stop)}, null)"
    wrapped = f"if(r.low > r.high and r.high <> 0, {span('0', 'r.high + 1')}, null)"
    opened = f"if(r.low = 0 and r.high {'>=' if compat_zero_is_any else '='} 0, {span(OPEN, OPEN)}, null)"
    known = f"if(size({ranges}) = 0, array(named_struct('low', 0, 'high', 0)), {ranges})"
    return f"array_distinct(flatten(transform({known}, r -> array_compact(array({inside}, {wrapped}, {opened})))))"


def _with_edges(rules: DataFrame, ranges: str, i: int, compat_zero_is_any: bool) -> DataFrame:
    """One row for each range of a rule on axis ``i`` and level ``l{i}`` with the ends ``_e`` of its segments there.

    Levels are joined, not exploded.  Catalyst takes a join to be as large as the product of its
    sides, but an explode to make one row of each: it would broadcast rules by the size of their
    files, of which the segments are many hundred times.  So only AQE broadcasts them, by measure.
    """
    kept = [c for c in rules.columns if c != ranges]
    spans = rules.selectExpr(*kept, f"explode({range_spans(ranges, compat_zero_is_any)}) as _s")
    rows = ", ".join(f"({n}, {n * BITS}, {(n + 1) * BITS}, {str(n == LEVELS - 1).lower()})" for n in (OPEN, *range(LEVELS)))
    levels = rules.sparkSession.sql(f"select * from values {rows} as t(l{i}, _here, _above, _top)")
    cut = spans.join(F.broadcast(levels), F.expr(f"(l{i} = {OPEN}) = (_s.low = {OPEN})"))

    def ceiling(bits: str) -> str:
        return f"shiftright(_s.low + shiftleft(1L, {bits}) - 1, {bits})"

    # Segments of this level that none of the next level holds lie left and right of those.
    return cut.selectExpr(*kept, f"l{i}", f"""explode(array(named_struct(
        'first', {ceiling("_here")}, 'stop', shiftright(_s.stop, _here),
        'inner', if(not _top, shiftleft({ceiling("_above")}, {BITS}), null),
        'outer', if(not _top, shiftleft(shiftright(_s.stop, _above), {BITS}), null)))) as _e""")


def with_nodes(rules: DataFrame, ranges: str, i: int, compat_zero_is_any: bool = True) -> DataFrame:
    """One row for each segment of a rule's ranges on axis ``i``: level ``l{i}``, node ``n{i}``, rank ``q{i}``.

    The segments are the largest aligned ones that make up the ranges.  Steps are generators, whose
    output is computed once and never copied into what follows.
    """
    kept = [c for c in rules.columns if c != ranges]
    edges = _with_edges(rules, ranges, i, compat_zero_is_any)

    def between(low: str, stop: str) -> str:
        return f"if({low} < {stop}, sequence({low}, {stop} - 1), cast(array() as array<bigint>))"

    nodes = f"""case when l{i} = {OPEN} then array(cast({OPEN} as bigint))
        when coalesce(_e.inner < _e.outer, false) then concat({between("_e.first", "_e.inner")}, {between("_e.outer", "_e.stop")})
        else {between("_e.first", "_e.stop")} end"""
    return edges.selectExpr(*kept, f"l{i}", f"if(l{i} = {OPEN}, 1, 0) as q{i}", f"explode({nodes}) as n{i}")


def with_levels(rules: DataFrame, ranges: str, i: int, compat_zero_is_any: bool = True) -> DataFrame:
    """One row for each level ``l{i}`` on which a range of a rule has segments."""
    kept = [c for c in rules.columns if c != ranges]
    edges = _with_edges(rules, ranges, i, compat_zero_is_any)
    return edges.where(f"""case when l{i} = {OPEN} then true
        when coalesce(_e.inner < _e.outer, false) then _e.first < _e.inner or _e.outer < _e.stop
        else _e.first < _e.stop end""").select(*kept, f"l{i}")


def point_node(point: str, level: str) -> str:
    """SQL of the segment of a level that holds a point; NULL if the point is absent, but open rules need none."""
    return (f"case when {level} = {OPEN} then cast({OPEN} as bigint) "
            f"when {point} between 0 and {LAST_POINT} then shiftright({point}, {level} * {BITS}) end")


# Paths ----------------------------------------------------------------------------------------


def path_nodes(rules: DataFrame, rule_path: Column) -> DataFrame:
    """Every prefix of every rule path: its shape, whether it is a leaf, and the rules in force.

    A prefix without rules of its own takes those of its nearest ancestor that has some.
    """
    paths = rules.select("rule_id", path_segments(rule_path).alias("segments"))
    prefixes = paths.select(
        "segments", "rule_id",
        F.explode(F.sequence(F.lit(1), F.size("segments"))).alias("depth"),
    )
    node = F.array_join(F.slice("segments", F.lit(1), F.col("depth")), MARK)
    whole = F.col("depth") == F.size("segments")
    nodes = prefixes.groupBy(node.alias("node"), "depth").agg(
        F.min(whole.cast("int")).alias("leaf"),
        F.max(whole.cast("int")).alias("owns"),
    )
    owned = prefixes.where(whole).select(node.alias("owner"), F.col("depth").alias("owner_depth"),
                                         "rule_id")
    ancestors = nodes.select(
        "node", "depth", "leaf",
        F.explode(F.sequence(F.lit(1), F.col("depth"))).alias("owner_depth"),
    ).withColumn("owner", F.array_join(
        F.slice(F.split("node", MARK), F.lit(1), F.col("owner_depth")), MARK))
    nearest = ancestors.join(
        nodes.where("owns = 1").select(F.col("node").alias("owner")), "owner"
    ).groupBy("node", "depth", "leaf").agg(F.max("owner_depth").alias("owner_depth"))
    in_force = nearest.withColumn("owner", F.array_join(
        F.slice(F.split("node", MARK), F.lit(1), F.col("owner_depth")), MARK)
    ).join(owned.drop("owner_depth"), "owner")
    stars = F.transform(F.split("node", MARK), lambda s: F.when(s == ANY, "1").otherwise("0"))
    return in_force.select("node", "depth", (F.col("leaf") == 1).alias("leaf"), "rule_id",
                           F.array_join(stars, "").alias("shape"))


def _path_node(shape: Column) -> Column:
    """The event path with wildcards where the shape has them; it joins its segments with marks."""
    parts = F.transform(
        F.slice(F.split("e_path", MARK), F.lit(1), F.length(shape)),
        lambda s, i: F.when(F.substring(shape, i + 1, F.lit(1)) == "1", F.lit(ANY)).otherwise(s),
    )
    return F.array_join(parts, MARK)


# Prepared rules -------------------------------------------------------------------------------


@dataclass
class Prepared:
    """Rules of one kind, ready to be looked up.

    ``best``: the exact keys as one text ``_k``, the path ``node`` and a node ``n{i}`` of each axis,
    and the best rule there.  ``keys``: each ``_k`` with its ``mask`` and the ``forms`` (path shape
    and levels) that its rules have.
    """

    best: DataFrame
    keys: DataFrame

    def write(self, folder: str) -> None:
        self.best.write.mode("overwrite").parquet(f"{folder}/best")
        self.keys.write.mode("overwrite").parquet(f"{folder}/keys")

    @staticmethod
    def read(spark: SparkSession, folder: str) -> Prepared:
        """Written tables; they are broadcast if they are small, for now their own size is known."""
        return Prepared(dimension_side(spark.read.parquet(f"{folder}/best")),
                        dimension_side(spark.read.parquet(f"{folder}/keys")))


def prepare(rules: DataFrame, layers: Layers, payload: list[str], compat_zero_is_any: bool = True) -> Prepared:
    """The best rule for each combination of exact keys, path node and range nodes."""
    keyed = keyed_rules(rules, layers, payload)
    exact = [f"k_{layer.name}" for layer in layers.exact]
    keyed = keyed.withColumns({"_k": _joined_keys(exact), "mask": wildcard_mask(layers)}).drop(*exact)
    if layers.rule_path is not None:
        keyed = keyed.join(path_nodes(rules, layers.rule_path), "rule_id")
    else:
        keyed = keyed.withColumns({"node": F.lit(""), "leaf": F.lit(True), "shape": F.lit("")})
    axes = range(len(layers.ranges))
    spots = levels = keyed
    for i, layer in enumerate(layers.ranges):
        spots = with_nodes(spots, f"_{layer.name}", i, compat_zero_is_any)
        levels = with_levels(levels, f"_{layer.name}", i, compat_zero_is_any)
    # Rows of one spot have equal exact and path ranks, so range ranks and id decide.
    spot = [f"{part}{i}" for i in axes for part in "ln"]
    best = spots.groupBy("_k", "node", "leaf", "shape", *spot).agg(
        F.min(F.struct(*[f"q{i}" for i in axes], "rule_id", *payload)).alias("rule"))
    forms = F.collect_set(F.struct("shape", *[f"l{i}" for i in axes]))
    return Prepared(best, levels.groupBy("_k", "mask").agg(forms.alias("forms")))


def _event_columns(layers: Layers) -> dict[str, Column]:
    columns = {
        f"e_{layer.name}_{i}": _unmarked(key)
        for layer in layers.exact for i, key in enumerate(layer.event_keys)
    }
    if layers.parts is not None:
        columns["e_path"] = F.array_join(layers.parts, MARK)
    columns |= {f"p{i}": layer.point.cast("bigint") for i, layer in enumerate(layers.ranges)}
    return columns


def _probes(lookups: DataFrame, layers: Layers) -> DataFrame:
    """Lookups expanded to every exact key that a rule can carry, with the rank of each layer."""
    out = lookups
    for layer in layers.exact:
        n = len(layer.event_keys)
        keys = [f"e_{layer.name}_{i}" for i in range(n)]
        candidates = [f"if({key} is not null, named_struct('key', {key}, 'rank', {i}), null)" for i, key in enumerate(keys)]
        candidates.append(f"named_struct('key', '{ANY}', 'rank', {n})")
        out = out.selectExpr("*", f"explode(array_compact(array({', '.join(candidates)}))) as c_{layer.name}")
    return out


def find_rules(lookups: DataFrame, prepared: Prepared, layers: Layers, payload: list[str], by: str) -> DataFrame:
    """(by, rule) for those lookups that a rule fits; ``lookups`` has the columns of an event's keys and points."""
    axes, path = range(len(layers.ranges)), layers.parts is not None
    names = [layer.name for layer in layers.exact]
    key = F.concat_ws(MARK, *[f"c_{n}.key" for n in names])
    mask = F.concat(*[F.when(F.col(f"c_{n}.key") == ANY, "1").otherwise("0") for n in names])
    masks = prepared.keys.agg(F.collect_set("mask")).scalar()
    probes = _probes(lookups, layers).where(F.array_contains(masks, mask)).select(
        by, *["e_path"] * path, *[f"p{i}" for i in axes], *[F.col(f"c_{n}.rank").alias(f"r_{n}") for n in names], key.alias("_k"))
    ranks = [f"r_{n}" for n in names]
    # An outer join never broadcasts the probes, whose size Catalyst cannot tell either.
    met = probes.join(prepared.keys.select("_k", "forms"), "_k", "left").selectExpr(
        *probes.columns, "explode(coalesce(forms, array())) as _f")
    spots = [f"_f.l{i}" for i in axes] + [f"{point_node(f'p{i}', f'_f.l{i}')} as n{i}" for i in axes]
    if path:
        met = met.withColumns({"node": _path_node(F.col("_f.shape")), "_depth": F.size(F.split("e_path", MARK))})
        met = met.where("length(_f.shape) <= _depth")
        spots += ["node", "_f.shape as r_path", "length(_f.shape) = _depth as _whole"]
        ranks = [*ranks, "r_path"]
    else:
        spots += ["'' as node"]
    on = ["_k", "node", *[f"{part}{i}" for i in axes for part in "ln"]]
    hits = met.selectExpr(by, "_k", *[f"r_{n}" for n in names], *spots).join(prepared.best.drop("shape"), on)
    if path:
        hits = hits.where("_whole or leaf")
    vector = F.struct(*ranks, *[f"rule.q{i}" for i in axes], *[f"rule.{n}" for n in ("rule_id", *payload)])
    best = hits.groupBy(by).agg(F.min(vector).alias("_best"))
    return best.select(by, F.struct(*[F.col(f"_best.{n}").alias(n) for n in ("rule_id", *payload)]).alias("rule"))


def match_rules(
    events: DataFrame, rules: DataFrame | Prepared, layers: Layers, payload: list[str],
    eligible: Column | None = None, compat_zero_is_any: bool = True,
    probe: DataFrame | None = None, by: str | None = None,
) -> DataFrame:
    """Add ``rule``: the winning rule (struct of ``rule_id`` and ``payload``) or NULL.

    In a range layer a wildcard is probed as the point 0, so with ``compat_zero_is_any`` a range
    that starts at 0 also fits every other point, with the rank of a wildcard.  Points are whole
    numbers from 0 to 2**32 - 1; for others only open rules apply.  ``rules`` may be prepared
    already.  ``probe`` is a frame with the same event column to take the keys from (see
    ``geo_lookup``).  Events that are not eligible go round the join.  ``by`` names a column that is
    unique and never NULL, if there is one; what was found is then joined by it.
    """
    prepared = rules if isinstance(rules, Prepared) else prepare(rules, layers, payload, compat_zero_is_any)
    wanted = F.lit(True) if eligible is None else F.coalesce(eligible, F.lit(False))
    columns = _event_columns(layers)
    asked = (events if probe is None else probe).where(wanted)
    if by is not None:
        found = find_rules(asked.select(by, *[c.alias(n) for n, c in columns.items()]), prepared, layers, payload, by)
        return events.join(found, by, "left")
    key = F.concat_ws(MARK, *[F.coalesce(c.cast("string"), F.lit(ABSENT)) for c in columns.values()])
    lookups = asked.select(key.alias("_lookup"), *[c.alias(n) for n, c in columns.items()]).dropDuplicates(["_lookup"])
    found = find_rules(lookups, prepared, layers, payload, "_lookup")
    return keyed_join(events, found, {"_lookup": F.when(wanted, key)})
