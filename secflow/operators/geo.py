"""Longest-prefix geo lookup as one sorted sweep over networks and addresses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from secflow.functions.net import ip_number, is_private_number, network_range
from secflow.functions.text import once
from secflow.schema import with_leaves
from secflow.session import keyed_join

ATTRIBUTES = ["city", "country", "org", "org_id"]

#: Kinds of rows at one place, in the order of the sweep.
OPENS, ADDRESS, CLOSES = 0, 1, 2


def _networks(layers: dict[str, DataFrame]) -> DataFrame:
    """One row per layer and distinct CIDR; of several rows for one CIDR the greatest attributes count."""
    rows = None
    for layer, geo in layers.items():
        columns = [F.col(a) if a in geo.columns else F.lit(None).cast("string").alias(a) for a in ATTRIBUTES]
        own = geo.select(F.lit(layer).alias("layer"), *columns, "network")
        rows = own if rows is None else rows.unionByName(own)
    length = F.substring_index("network", "/", -1).try_cast("int")
    parsed = once(rows, _n=ip_number(F.substring_index("network", "/", 1)))
    keyed = parsed.select("layer", *ATTRIBUTES, "network", network_range(F.col("_n"), length).alias("range"))
    found = keyed.groupBy("layer", "range").agg(F.max(F.struct(*ATTRIBUTES, "network")).alias("info"))
    return found.where(F.col("range").isNotNull()).select("layer", "range.*", "info")


def _top(family: Column, high: Column, low: Column) -> Column:
    """The leading 62 bits of an address as one number, IPv4 before IPv6."""
    return F.when(family == 4, F.shiftleft(low, 30)).otherwise(F.shiftright(high, 2) + 3 * (1 << 61))


def _bucket(top: Column) -> Column:
    """The range that holds an address, by the column of bounds."""
    return F.size(F.filter("_bounds", lambda b: b <= top))


def innermost(addresses: DataFrame, networks: DataFrame, buckets: int) -> DataFrame:
    """(ip, layer, info) of the innermost network of each layer that holds an address.

    ``addresses`` has ``ip, family, high, low``; ``networks`` has ``layer``, a range and ``info``.
    Networks are nested or apart.  Networks and addresses are cut into ranges at quantiles of the
    addresses; a network that reaches over a cut is opened again behind it, which at most 33 or 129
    networks do for each cut, however many there are.  In each range one sweep in address order
    counts how many networks are open; the innermost one is the last that was opened at that depth.
    """
    places = addresses.withColumn("top", _top(F.col("family"), F.col("high"), F.col("low")))
    cuts = F.array(*[F.lit(k / buckets) for k in range(1, buckets)])
    bounds = F.coalesce(
        places.agg(F.percentile_approx("top", cuts, 100 * buckets)).scalar() if buckets > 1 else F.lit(None),
        F.array().cast("array<bigint>"))
    asked = places.withColumn("_bounds", bounds).select(
        "ip", _bucket(F.col("top")).alias("bucket"), F.explode(F.array(F.lit("city"), F.lit("country"))).alias("layer"),
        "family", "high", "low", F.lit(ADDRESS).alias("kind"), F.lit(0).alias("nesting"), F.lit(0).alias("step"),
        F.lit(None).cast(networks.schema["info"].dataType).alias("info"))
    spans = networks.withColumn("_bounds", bounds).withColumns({
        "_first": _bucket(_top(F.col("family"), F.col("high"), F.col("low"))),
        "_last": _bucket(_top(F.col("family"), F.col("last_high"), F.col("last_low")))}).drop("_bounds")
    nobody = F.lit(None).cast("string").alias("ip")
    # Behind a cut a network is open from the start, which sorts before every address.
    start = F.col("bucket") == F.col("_first")
    opened = spans.withColumn("bucket", F.explode(F.sequence("_first", "_last"))).select(
        nobody, "bucket", "layer", *[F.when(start, F.col(c)).otherwise(0).alias(c) for c in ("family", "high", "low")],
        F.lit(OPENS).alias("kind"), F.col("length").alias("nesting"), F.lit(1).alias("step"), "info")
    closed = spans.select(
        nobody, F.col("_last").alias("bucket"), "layer", "family", F.col("last_high").alias("high"), F.col("last_low").alias("low"),
        F.lit(CLOSES).alias("kind"), (-F.col("length")).alias("nesting"), F.lit(-1).alias("step"),
        F.lit(None).cast(networks.schema["info"].dataType).alias("info"))
    rows = asked.unionByName(opened).unionByName(closed)
    order = ["family", "high", "low", "kind", "nesting"]
    so_far = (Window.unboundedPreceding, Window.currentRow)
    depth = F.sum("step").over(Window.partitionBy("bucket", "layer").orderBy(*order).rowsBetween(*so_far))
    last = F.last("info", ignorenulls=True).over(
        Window.partitionBy("bucket", "layer", "depth").orderBy(*order).rowsBetween(*so_far))
    swept = rows.withColumn("depth", depth).withColumn("found", last)
    return swept.where(F.col("ip").isNotNull() & (F.col("depth") > 0)).select("ip", "layer", F.col("found").alias("info"))


def lookup_ips(ips: DataFrame, cities: DataFrame, countries: DataFrame, buckets: int | None = None) -> DataFrame:
    """(ip) -> ``local`` and ``geo``; NULL geo where no network contains the address.

    The work grows with addresses and networks, not with how deep or long these are.  A city hit is
    completed from the country hit.  ``buckets`` ranges are swept side by side, by default as many as
    there are shuffle partitions.
    """
    if buckets is None:
        buckets = int(ips.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    networks = _networks({"city": cities, "country": countries})
    distinct = ips.select("ip").where(F.col("ip").isNotNull()).distinct()
    known = once(distinct, _n=ip_number(F.col("ip"))).select("ip", "_n.*", is_private_number(F.col("_n")).alias("local"))
    inside = innermost(known.where(~F.col("local")).drop("local"), networks, buckets)
    best = inside.groupBy("ip").agg(*[
        F.max(F.when(F.col("layer") == layer, F.col("info"))).alias(layer) for layer in ("city", "country")])
    hit = F.coalesce(F.col("city"), F.col("country"))
    geo = F.when(hit.isNotNull(), F.struct(
        hit["city"].alias("city"),
        *[F.coalesce(hit[a], F.col("country")[a]).alias(a) for a in ATTRIBUTES[1:]],
        hit["network"].alias("network"),
    ))
    return known.select("ip", "local").join(best, "ip", "left").select(
        "ip", "local", geo.alias("geo")
    )


def geo_lookup(df: DataFrame, ip_cols: list[str], cities: DataFrame, countries: DataFrame,
               probe: DataFrame | None = None) -> DataFrame:
    """Add ``{col}_geo`` and ``{col}_local`` for every address column.

    Only distinct addresses are looked up; the result is joined back per column.  ``probe`` is a
    frame with the same address columns to take them from: a job that has already joined
    something to ``df`` passes its input here, so that those joins are not planned twice.
    """
    source = df if probe is None else probe
    ips = source.select(F.explode(F.array_distinct(F.array(*ip_cols))).alias("ip"))
    found = lookup_ips(ips, cities, countries)
    for name in ip_cols:
        side = found.select(
            F.col("ip").alias("_ip"), F.col("geo").alias(f"{name}_geo"),
            F.col("local").alias(f"{name}_local"),
        )
        df = keyed_join(df, side, {"_ip": F.col(name)})
    return df


SIDES = ("source", "destination")


def geo_columns(df: DataFrame, cities: DataFrame, countries: DataFrame, event: str = "event",
                probe: DataFrame | None = None) -> DataFrame:
    """Add ``{side}_ip_geo`` and ``{side}_ip_local`` for both ends of canonical events."""
    names = {f"{side}_ip": F.col(f"{event}.{side}.ip") for side in SIDES}
    source = (df if probe is None else probe).select(*[c.alias(n) for n, c in names.items()])
    return geo_lookup(df.withColumns(names), list(names), cities, countries, source).drop(*names)


def geo_leaves() -> dict[str, Column]:
    """Event leaves filled from the columns of :func:`geo_columns`."""
    leaves: dict[str, Column] = {}
    for side in SIDES:
        geo = F.col(f"{side}_ip_geo")
        leaves |= {f"{side}.enrichment.geo.{a}": geo[a] for a in ("city", "country", "org")}
        leaves[f"{side}.enrichment.network"] = geo["network"]
        leaves[f"{side}.enrichment.isNetworkLocal"] = F.col(f"{side}_ip_local")
    return leaves


GEO_COLUMNS = [f"{side}_ip_{part}" for side in SIDES for part in ("geo", "local")]


def enrich_geo(df: DataFrame, cities: DataFrame, countries: DataFrame, event: str = "event") -> DataFrame:
    """Fill the network enrichment of both endpoints of canonical events."""
    found = geo_columns(df, cities, countries, event)
    return with_leaves(found, event, geo_leaves()).drop(*GEO_COLUMNS)
