"""Merkle manifest of a dataset, labelled by nested intervals.

A row's leaf is the hash of its fields. Leaves are ranked inside their group, and every node of a
group's tree is labelled with the interval of leaf ranks it covers. ``FANOUT`` consecutive nodes have one
parent, so a node of level ``k`` that starts at rank ``lo`` lies in bucket ``lo div FANOUT ** (k + 1)`` of
the level above: ancestors are attached by an equality join on (tree, bucket) whose condition is that one
interval contains the other, and the siblings on a path are the children of the parent less the node's
own interval. The roots of the groups are the leaves of one more tree of the same kind.

Everything is DataFrame functions. A group of any size spreads: rows are dealt by ranges of (group, key),
ranks are local places plus the sums of earlier ranges (one row per range and group), and a parent gathers
``FANOUT`` digests at most. The only loop is over levels, whose number grows with the logarithm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipstat.llm.common import hold, release

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: A proof's levels: what stands left and right of the path.
_STEPS = "array<struct<left:string,right:string>>"


def field_code(value: Column) -> Column:
    """``-`` for null, else the byte count, a colon and the value."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(columns: dict[str, Column]) -> Column:
    return F.sha2(F.concat(*[field_code(columns[f]) for f in FIELDS]).cast("binary"), 256)


def tampered(doc_id: Column) -> Column:
    """Rows whose text an attacker lower-cased: a fifth by a checksum of the id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def lowered(text: Column) -> Column:
    """A-Z only, whatever the locale."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def leaves(df: DataFrame) -> DataFrame:
    """Per row: doc_id, source, leaf, and claimed, the leaf a reader of the tampered table would compute."""
    own = {f: F.col(f) for f in FIELDS}
    changed = tampered(F.col("doc_id")) & F.col("text").isNotNull()
    rows = df.select(*[F.col(f).cast("bigint" if f in ("doc_id", "n_chars") else "string").alias(f) for f in FIELDS])
    return rows.select(
        "doc_id", "source", leaf_digest(own).alias("leaf"),
        F.when(changed, leaf_digest(own | {"text": lowered(F.col("text"))})).alias("claimed"),
    ).withColumn("claimed", F.coalesce("claimed", "leaf"))


def ranked(df: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """Adds lo (the place inside the tree, from 0) and n (the tree's rows); held, so a range keeps its number."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(parts, tree, *order).sortWithinPartitions(tree, *order)
    placed = hold(placed.withColumn("_at", F.monotonically_increasing_id()), "ranges")
    part = F.shiftright("_at", 33)
    sums = placed.groupBy(tree, part.alias("_part")).agg(F.count("*").alias("_n"), F.min("_at").alias("_from"))
    of_tree = Window.partitionBy(tree)
    earlier = of_tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        tree, "_part", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_from")).alias("_shift"), F.sum("_n").over(of_tree).alias("n")
    )
    out = placed.withColumn("_part", part).join(sums, [tree, "_part"]).withColumn("lo", F.col("_at") + F.col("_shift"))
    out = hold(out.drop("_at", "_part", "_shift"), "ranked")
    release(placed)
    return out


def _bucket(level: int) -> Column:
    """The node of ``level`` in which the interval that starts at ``lo`` lies."""
    return F.expr(f"lo div {FANOUT ** level}L")


def levels(base: DataFrame) -> list[DataFrame]:
    """Held tables (tree, lo, hi, n, digest, children) of every level above ``base(tree, lo, n, digest)``.

    A level has the parents of all nodes of trees that had more than one node left.
    """
    most = base.agg(F.max("n")).first()[0] or 0
    nodes, found = base.select("tree", "lo", F.col("lo").alias("hi"), "n", "digest"), []
    while FANOUT ** len(found) < most:
        level = len(found)
        several = nodes.filter(F.col("n") > FANOUT ** level)
        grouped = several.groupBy("tree", _bucket(level + 1).alias("_bucket"), "n").agg(F.array_sort(F.collect_list(F.struct("lo", "hi", "digest"))).alias("children"))
        digest = F.sha2(F.array_join("children.digest", "").cast("binary"), 256)
        nodes = hold(
            grouped.select("tree", F.col("children")[0]["lo"].alias("lo"), F.array_max("children.hi").alias("hi"), "n", digest.alias("digest"), "children"),
            f"level-{level + 1}",
        )
        found.append(nodes)
    return found


def _beside() -> Column:
    """Digests of the parent's children outside the node's own interval, to its left and right."""

    def joined(keep) -> Column:
        return F.array_join(F.transform(F.filter("children", keep), lambda c: c["digest"]), "")

    return F.struct(joined(lambda c: c["hi"] < F.col("lo")).alias("left"), joined(lambda c: c["lo"] > F.col("hi")).alias("right"))


def _attached(nodes: DataFrame, parents: DataFrame, level: int) -> DataFrame:
    """Nodes with the path of the parent that contains them, one step longer."""
    above = parents.select("tree", F.expr(f"lo div {FANOUT ** (level + 1)}L").alias("_bucket"), F.col("lo").alias("_plo"), F.col("hi").alias("_phi"), "children", "steps")
    inside = (F.col("_plo") <= F.col("lo")) & (F.col("hi") <= F.col("_phi"))
    met = nodes.withColumn("_bucket", _bucket(level + 1)).join(above, ["tree", "_bucket"]).filter(inside)
    return met.withColumn("steps", F.concat(F.array(_beside()), F.col("steps"))).drop("_bucket", "_plo", "_phi", "children")


def paths(base: DataFrame, above: list[DataFrame], roots: DataFrame) -> DataFrame:
    """``base`` with steps: the siblings from each leaf up through its tree's root to the end of ``roots(tree, steps)``."""
    whole = (F.col("lo") == 0) & (F.col("hi") == F.col("n") - 1)
    known = None  # nodes of the level above with their steps and children
    for level in range(len(above), -1, -1):
        nodes = (above[level - 1] if level else base.withColumn("hi", F.col("lo"))).withColumnRenamed("children", "_own")
        tops = nodes.filter(whole).join(roots, "tree")
        if known is not None:
            tops = tops.unionByName(_attached(nodes.filter(~whole), known, level))
        known = tops.withColumnRenamed("_own", "children")
        if level:
            known = hold(known, f"paths-{level}")
    return known


def roots_of(base: DataFrame, above: list[DataFrame]) -> DataFrame:
    """The last node of each tree: tree, digest."""
    nodes = base.withColumn("hi", F.col("lo")).select("tree", "lo", "hi", "n", "digest")
    for more in above:
        nodes = nodes.unionByName(more.select("tree", "lo", "hi", "n", "digest"))
    return nodes.filter((F.col("lo") == 0) & (F.col("hi") == F.col("n") - 1)).select("tree", "digest")


def folded(leaf: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate("steps", leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]).cast("binary"), 256))


def proof_digest() -> Column:
    """Hash of all siblings, level by level, left to right."""
    parts = F.transform("steps", lambda s: F.concat(s["left"], s["right"]))
    return F.sha2(F.array_join(parts, "").cast("binary"), 256)


def manifest(df: DataFrame) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Rows are leaves of their source's tree in order of doc_id; the sources, null first and then by their
    bytes, are leaves of the dataset's tree. Null fields are coded ``-``; a null doc_id comes first in its
    source and is not tampered with; rows that share a doc_id stand in order of their digests, so equal
    rows are interchangeable. A tree of one leaf is that leaf; a table without rows has no manifest rows.
    Columns other than ``FIELDS`` are not read.
    """
    tree = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    rows = hold(leaves(df).select("doc_id", tree.alias("tree"), F.col("leaf").alias("digest"), "claimed"), "leaves")
    base = ranked(rows, "tree", ["doc_id", "digest"])
    release(rows)
    above = levels(base)
    subroots = hold(roots_of(base, above), "subroots")

    top = subroots.select(F.lit("all").alias("tree"), F.col("tree").alias("source"), "digest")
    top = ranked(top, "tree", ["source"])
    over = levels(top)
    ends = roots_of(top, over).select("tree", F.col("digest").alias("root"))
    start = ends.select("tree", F.array().cast(_STEPS).alias("steps"), "root")
    upper = paths(top, over, start.drop("root")).join(ends, "tree")
    upper = hold(upper.select(F.col("source").alias("tree"), "steps", F.col("digest").alias("subroot"), "root"), "upper")

    named = paths(base, above, upper.select("tree", "steps"))
    named = named.join(upper.select("tree", "subroot", "root"), "tree")
    return named.select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", "root",
        proof_digest().alias("proof_sha256"), folded(F.col("claimed")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


#: The same rows by plain levels: a recursive step hashes every run of 16 until each tree has one node, and
#: proofs collect the run's others. DuckDB has no crc32, so it is folded from the bits of the digits.
MANIFEST_SQL = r"""
WITH RECURSIVE base AS (
  SELECT doc_id, source, text,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
    list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(range(1, len(CAST(doc_id AS VARCHAR)) + 1), lambda i: ascii(CAST(doc_id AS VARCHAR)[i])::BIGINT)),
      lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
        lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END)) AS crc
  FROM documents),
leaf AS (
  SELECT doc_id, coalesce('=' || source, '') AS tree,
    sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS digest,
    sha256(head || coalesce(strlen(text) || ':' || CASE WHEN xor(crc, 4294967295::BIGINT) % 5 = 0
      THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END, '-')) AS claimed
  FROM base),
base_nodes AS (
  SELECT tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS place,
    count(*) OVER (PARTITION BY tree) AS n, digest, doc_id, claimed FROM leaf),
nodes AS (
  SELECT 0 AS level, tree, place, n, digest FROM base_nodes
  UNION ALL
  SELECT level + 1, tree, place // 16, (any_value(n) + 15) // 16, sha256(string_agg(digest, '' ORDER BY place))
  FROM nodes WHERE n > 1 GROUP BY level, tree, place // 16),
subroots AS (SELECT tree, digest FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, row_number() OVER (ORDER BY encode(tree)) - 1 AS place, count(*) OVER () AS n, digest, tree FROM subroots),
upper_nodes AS (
  SELECT level, place, n, digest FROM tops
  UNION ALL
  SELECT level + 1, place // 16, (any_value(n) + 15) // 16, sha256(string_agg(digest, '' ORDER BY place))
  FROM upper_nodes WHERE n > 1 GROUP BY level, place // 16),
walk AS (
  SELECT b.doc_id, b.digest AS leaf, b.tree, 0 AS level, b.place, b.n, '' AS proof, b.claimed AS fold, false AS top
  FROM base_nodes b
  UNION ALL
  SELECT w.doc_id, w.leaf, w.tree, w.level + 1, w.place // 16, (w.n + 15) // 16,
    w.proof || coalesce((SELECT string_agg(x.digest, '' ORDER BY x.place) FROM nodes x
      WHERE x.level = w.level AND x.tree = w.tree AND x.place // 16 = w.place // 16 AND x.place <> w.place), ''),
    sha256((SELECT string_agg(CASE WHEN x.place = w.place THEN w.fold ELSE x.digest END, '' ORDER BY x.place) FROM nodes x
      WHERE x.level = w.level AND x.tree = w.tree AND x.place // 16 = w.place // 16)), false
  FROM walk w WHERE w.n > 1),
upper_walk AS (
  SELECT w.doc_id, w.leaf, w.tree, w.proof, w.fold, t.place, t.n, 0 AS level
  FROM walk w JOIN tops t ON t.tree = w.tree WHERE w.n = 1
  UNION ALL
  SELECT w.doc_id, w.leaf, w.tree,
    w.proof || coalesce((SELECT string_agg(x.digest, '' ORDER BY x.place) FROM upper_nodes x
      WHERE x.level = w.level AND x.place // 16 = w.place // 16 AND x.place <> w.place), ''),
    sha256((SELECT string_agg(CASE WHEN x.place = w.place THEN w.fold ELSE x.digest END, '' ORDER BY x.place) FROM upper_nodes x
      WHERE x.level = w.level AND x.place // 16 = w.place // 16)),
    w.place // 16, (w.n + 15) // 16, w.level + 1
  FROM upper_walk w WHERE w.n > 1)
SELECT w.doc_id, w.leaf, s.digest AS subroot, r.digest AS root, sha256(w.proof) AS proof_sha256,
  w.fold AS folded_root, w.fold = r.digest AS verified
FROM upper_walk w JOIN subroots s ON s.tree = w.tree, (SELECT digest FROM upper_nodes WHERE n = 1) r
WHERE w.n = 1
"""
