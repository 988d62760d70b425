"""Document fingerprints: Merkle trees over paragraphs and sections.

A text falls into sections at blank lines and these into paragraphs at line ends; both splits can be undone, so no two
texts share a tree. A paragraph's hash is the SHA-256 of its text, a section's that of its paragraphs' hashes, and the
root that of the sections' hashes. Roots tell equality; equal branches need not be opened, and the branches that differ
locate an edit. For likeness a fingerprint also lists its leaves: the sentences of the text, pieces of at most 208
characters, each as a number of 56 hash bits and 8 bits of size.

Everything is built from Spark's own functions; no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from secflow.llm.common import hex64

LEAF = r"[^.!?\n]{1,200}[.!?\n]{0,8}|[.!?\n]{1,8}"
#: Rows that a task should sort at once.
BUCKET = 4000


def sections(text: Column) -> Column:
    """Sections of a text, each an array of the hashes of its paragraphs. A null text counts as empty."""
    parts = F.split(F.coalesce(text, F.lit("")), "\n\n")
    return F.transform(parts, lambda s: F.transform(F.split(s, "\n"), lambda p: F.sha2(p, 256)))


def section_hashes(tree: Column) -> Column:
    return F.transform(tree, lambda s: F.sha2(F.array_join(s, ","), 256))


def root(tree: Column) -> Column:
    """The root of the tree that ``sections`` gave."""
    return F.sha2(F.array_join(section_hashes(tree), ","), 256)


def leaves(text: Column) -> Column:
    """The leaves of a text, in order; together they hold each of its characters once."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(LEAF), F.lit(0))
    return F.transform(found, lambda x: F.xxhash64(x).bitwiseAND(F.lit(-256)).bitwiseOR(F.length(x).cast("long")))


def fingerprint(tree_root: Column, leaf_list: Column) -> Column:
    """The root, a colon, and 16 hex digits for each leaf."""
    return F.concat(tree_root, F.lit(":"), F.array_join(F.transform(leaf_list, hex64), ""))


def _size(leaf_list: Column) -> Column:
    return F.aggregate(leaf_list, F.lit(0).cast("long"), lambda n, x: n + x.bitwiseAND(F.lit(255)))


def likeness(a_root: Column, a: Column, b_root: Column, b: Column) -> Column:
    """How much two fingerprints share, from 0 to 1: characters in common leaves, of those in all distinct leaves.

    1 if the roots are equal, two empty texts included; less than 1 otherwise.
    """
    a, b = F.array_distinct(a), F.array_distinct(b)
    shared = _size(F.array_intersect(a, b))
    whole = _size(a) + _size(b)
    part = F.when(whole > 0, F.least(2.0 * shared / whole, F.lit(0.999999))).otherwise(F.lit(0.0))
    return F.when(a_root == b_root, F.lit(1.0)).otherwise(part)


def differences(a: Column, b: Column) -> Column:
    """Where two trees differ: structs of section and paragraph (from 0), in order.

    Sections whose hashes are equal are not opened. A section or paragraph that only one tree has differs.
    """
    joined = F.zip_with(a, b, lambda x, y: F.struct(F.coalesce(x, F.array().cast("array<string>")).alias("x"), F.coalesce(y, F.array().cast("array<string>")).alias("y")))

    def inside(pair: Column, i: Column) -> Column:
        marked = F.transform(
            F.zip_with(pair["x"], pair["y"], lambda p, q: ~p.eqNullSafe(q)),
            lambda differs, j: F.struct(i.alias("section"), j.alias("paragraph"), differs.alias("differs")),
        )
        return F.when(pair["x"] == pair["y"], F.slice(marked, 1, 0)).otherwise(F.filter(marked, lambda m: m["differs"]))

    found = F.flatten(F.transform(joined, inside))
    return F.transform(found, lambda m: F.struct(m["section"].alias("section"), m["paragraph"].alias("paragraph")))


def with_next(docs: DataFrame, bucket_rows: int = BUCKET) -> DataFrame:
    """``docs`` (doc_id, text, payload struct ``own``) with ``next_text`` and ``next_own`` of the next row.

    The next row is that of the next smaller doc_id, null ids after all others; after the last comes the first. Rows of
    equal id follow each other by text. Rows are dealt into buckets of consecutive ids at quantiles, with one exchange;
    what follows a bucket is the first row of the bucket below, one row for each bucket.
    """
    n, low = docs.agg(F.count("*"), F.min("doc_id")).first()
    buckets, cuts = max(1, -(-n // bucket_rows)), []
    if buckets > 1:
        found = docs.agg(F.percentile_approx("doc_id", [k / buckets for k in range(1, buckets)], 20 * buckets)).first()[0]
        cuts = sorted(x for x in set(found or []) if x > low)
    edges = F.array(*[F.lit(x).cast("long") for x in cuts]) if cuts else F.array().cast("array<long>")
    bucket = F.size(F.filter(edges, lambda x: x <= F.coalesce(F.col("doc_id"), F.lit(low))))
    dealt = docs.withColumn("bucket", bucket)
    order = Window.partitionBy("bucket").orderBy(F.col("doc_id").desc_nulls_last(), "text")
    after = F.struct(F.col("text").alias("next_text"), F.col("own").alias("next_own"))
    rows = dealt.withColumn("follows", F.lead(after).over(order)).withColumn("place", F.row_number().over(order))
    heads = rows.filter("place = 1").select(((F.col("bucket") + 1) % (len(cuts) + 1)).alias("bucket"), after.alias("head"))
    joined = rows.join(heads, "bucket").withColumn("follows", F.coalesce("follows", "head"))
    return joined.select("doc_id", "text", "own", "follows.next_text", "follows.next_own")


def compare_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_rows: int = BUCKET) -> DataFrame:
    """Fingerprints of each text, of its edited text and of the next row's text, and their likeness.

    The edited text has its last half replaced by as much of the start of the next row's text. Null texts count as
    empty. Equal rows stay, each as a row. An empty table gives none. Further columns of ``docs`` are not read.
    """
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    treed = plain.withColumn("own", F.struct(root(sections(F.col("text"))).alias("root"), leaves(F.col("text")).alias("leaves")))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = (
        with_next(treed, bucket_rows)
        .withColumn("n_chars", F.length("text").cast("long"))
        .withColumn("edited", F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substring("next_text", F.lit(1), half)))
        .withColumn("after", F.struct(root(sections(F.col("edited"))).alias("root"), leaves(F.col("edited")).alias("leaves")))
    )
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("own.root"), F.col("own.leaves")).alias("fingerprint"),
        fingerprint(F.col("after.root"), F.col("after.leaves")).alias("edited_fingerprint"),
        likeness(F.col("own.root"), F.col("own.leaves"), F.col("after.root"), F.col("after.leaves")).alias("near_edited"),
        likeness(F.col("own.root"), F.col("own.leaves"), F.col("next_own.root"), F.col("next_own.leaves")).alias("near_next"),
    )
