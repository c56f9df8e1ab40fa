"""MinHash near-duplicates with fast similarity sketches.

A document's set is hashed into ``BINS`` bins in rounds. In round ``r < BINS`` every element falls into
one hashed bin; in round ``BINS + j`` every element falls into bin ``j``, so after ``2 * BINS`` rounds no
bin can be empty, and large sets fill all bins in their first rounds. A bin keeps its least
``(round, value)``. The share of bins in which two sketches agree estimates their similarity with the
concentration of independent samples.

Bins are joined to bands; documents that share a band are candidates, and every link is confirmed on
the full sets. Inside a band bucket nothing is compared all against all. Documents meet the bucket's
first member. Members of buckets that then still hold several components are joined on rare shingles:
each set in order of its shingles' frequency among all such members, rarest first, of which two sets at the
threshold share one of the first few. That join is exact, whichever bands they share, and what a crowd has
in common enters it only where it makes up three quarters of a text. Two members meet only where what either shares
with other components from there on is enough for a link. Under a shingle members meet the first one again, and then those outside the largest component meet the members of other components.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipstat.llm.common import WordHashes, arrow_map, byte_texts, hold, lists, mixed, release, seeds, texts_of
from clipstat.llm.components import components
from clipstat.session import ship_package

SHINGLE = 5
#: Two sets are linked when 100 * intersection >= PERCENT * union.
PERCENT = 75
#: A pair at the threshold shares no band with probability (1 - 0.75 ** ROWS) ** BANDS = 2e-6.
BANDS, ROWS = 48, 5
BINS = BANDS * ROWS

_ROUND = seeds(2 * BINS, 1)
_BAND = seeds(BANDS, 2)
_PLACE = seeds(SHINGLE, 3) | np.uint64(1)
_LOW = np.uint64((1 << 40) - 1)


def shingle_set(text: bytes | None, hashes: WordHashes) -> np.ndarray:
    """Sorted hashes of the distinct five-word shingles of a whole text, A-Z lower-cased.

    Fewer than five words make one shingle; no word (or no text) makes an empty set.
    """
    words = hashes.of((text or b"").lower().split())
    n = len(words)
    if n == 0:
        return words
    if n < SHINGLE:
        return mixed(np.array([(words * _PLACE[:n]).sum(dtype=np.uint64) + np.uint64(n)], np.uint64))
    total = words[: n - SHINGLE + 1] * _PLACE[0]
    for j in range(1, SHINGLE):
        total = total + words[j : n - SHINGLE + 1 + j] * _PLACE[j]
    return np.unique(mixed(total))


def sketch(items: np.ndarray) -> np.ndarray:
    """``BINS`` filled coordinates of a non-empty set."""
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    bins = np.full(BINS, empty, np.uint64)
    step = max(1, min(BINS, 3 * BINS // len(items)))
    for start in range(0, BINS, step):
        rounds = np.arange(start, min(BINS, start + step), dtype=np.uint64)
        h = mixed(items[None, :] ^ _ROUND[start : start + len(rounds), None])
        value = (h & _LOW) | (rounds[:, None] << np.uint64(40))
        np.minimum.at(bins, ((h >> np.uint64(40)) % np.uint64(BINS)).astype(np.int64).ravel(), value.ravel())
        if not (bins == empty).any():
            return bins
    for j in np.flatnonzero(bins == empty):
        h = mixed(items ^ _ROUND[BINS + j])
        bins[j] = (h & _LOW).min() | np.uint64((BINS + int(j)) << 40)
    return bins


def bands(coordinates: np.ndarray) -> np.ndarray:
    key = _BAND.copy()
    for column in coordinates.reshape(BANDS, ROWS).T:
        key = mixed(key ^ column)
    return key.view(np.int64)


def text_mark(text: str = "text") -> Column:
    """Tells rows that share a doc_id."""
    return F.xxhash64(text)


def sketches(df: DataFrame) -> DataFrame:
    """One row per document: doc_id, mark, n_shingles, set_id (digest of the full set), bands."""
    ship_package(df.sparkSession)
    hashes = WordHashes()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, ids, keys = [], [], []
        for text in byte_texts(batch.column("text")):
            items = shingle_set(text, hashes)
            sizes.append(len(items))
            ids.append(xxhash.xxh3_128_digest(items.tobytes()) if len(items) else None)
            keys.append(bands(sketch(items)) if len(items) else np.zeros(0, np.int64))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("mark"), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()), lists(keys, pa.int64())],
            ["doc_id", "mark", "n_shingles", "set_id", "bands"],
        )

    return arrow_map(df.withColumn("mark", text_mark()), run, "doc_id bigint, mark bigint, n_shingles bigint, set_id binary, bands array<bigint>")


def sets_of(df: DataFrame) -> DataFrame:
    """Full shingle sets as packed bytes, with their digest."""
    hashes = WordHashes()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        packed = [shingle_set(t, hashes).tobytes() for t in byte_texts(batch.column("text"))]
        ids = [xxhash.xxh3_128_digest(p) for p in packed]
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array(packed, pa.binary())], ["set_id", "items"])

    return arrow_map(df, run, "set_id binary, items binary")


def _compare(pairs: DataFrame) -> DataFrame:
    """``a, b, items_a, items_b`` to exact intersection and union sizes."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        common, union, last, first = [], [], None, None
        for left, right in zip(batch.column("items_a").to_pylist(), batch.column("items_b").to_pylist()):
            if right is not last:
                last, first = right, np.frombuffer(right, np.uint64)
            other = np.frombuffer(left, np.uint64)
            both = np.concatenate([first, other])
            both.sort(kind="stable")
            same = int((both[1:] == both[:-1]).sum())
            common.append(same)
            union.append(len(both) - same)
        return pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), pa.array(common, pa.int64()), pa.array(union, pa.int64())],
            ["a", "b", "common", "total"],
        )

    return arrow_map(pairs, run, "a bigint, b bigint, common bigint, total bigint")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    left = sets.select(F.col("node").alias("a"), F.col("items").alias("items_a"))
    right = sets.select(F.col("node").alias("b"), F.col("items").alias("items_b"))
    return _compare(pairs.join(left, "a").join(right, "b").select("a", "b", "items_a", "items_b"))


def _linked() -> Column:
    return F.lit(100) * F.col("common") >= F.lit(PERCENT) * F.col("total")


def _still_split(rows: DataFrame) -> DataFrame:
    """Rows of buckets that hold more than one component, with its largest one and the members outside it."""
    sizes = rows.groupBy("key", "c").agg(F.count("*").alias("_n"))
    whole = sizes.groupBy("key").agg(
        F.max_by("c", F.struct("_n", "c")).alias("main"), (F.sum("_n") - F.max("_n")).alias("outside")
    )
    return rows.join(whole.filter("outside > 0"), "key")


def _with_outsiders(rows: DataFrame, may_link: Column, *carried: str) -> DataFrame:
    """Pairs of each member outside the largest component with all members of other components."""
    columns = ("node", "n", "c", *carried)
    ours = rows.filter("c <> main").select("key", *[F.col(c).alias(f"{c}_b") for c in columns])
    met = rows.select("key", *[F.col(c).alias(f"{c}_a") for c in columns]).join(ours, "key")
    return met.filter((F.col("c_a") != F.col("c_b")) & may_link).select(
        F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")
    )


def _listed(sets: DataFrame) -> DataFrame:
    """Packed sets as one row per shingle: node, key."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        items = [np.frombuffer(x, np.int64) for x in batch.column("items").to_pylist()]
        nodes = np.repeat(np.asarray(batch.column("node")), [len(x) for x in items])
        keys = np.concatenate(items) if items else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(keys, pa.int64())], ["node", "key"])

    return arrow_map(sets.select("node", "items"), run, "node bigint, key bigint")


def _rare_prefixes(members: DataFrame, sets: DataFrame) -> DataFrame:
    """The rarest shingles of each member as key, node, n, c, left: its shingles from this one on that another component has.

    Two linked sets have at least 3/7 of the sum of their sizes in common. In one order of all shingles, whatever it is, what they
    have in common begins at one shingle and is no more than either has left from there; so the pair meets under that
    shingle with enough left, and at least 3/4 of each set. Shingles of one component alone are common to no such pair.
    """
    rows = _listed(sets.join(members.select("node"), "node")).join(members, "node")
    seen = rows.groupBy("key").agg(F.count("*").alias("f"), F.min("c").alias("_lo"), F.max("c").alias("_hi"))
    whole = Window.partitionBy("node")
    spec = whole.orderBy("f", "key")
    upto = spec.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    shared = F.col("_lo") < F.col("_hi")
    left = F.count_if(shared).over(whole) - F.count_if(shared).over(upto) + 1
    ranked = rows.join(seen, "key").withColumns({"at": F.row_number().over(spec), "left": left})
    first = ranked.filter(shared & (4 * F.col("left") >= 3 * F.col("n")) & (4 * (F.col("at") - 1) <= F.col("n")))
    return first.select("key", "node", "n", "c", "left")


def _may_agree() -> Column:
    """What both sets have left from a shared shingle leaves a link possible, if it is the first they share."""
    return F.lit(7) * F.least("left_a", "left_b") >= F.lit(3) * (F.col("n_a") + F.col("n_b"))


def _by_rare_shingles(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Confirmed links between components among ``members(node, n, c)`` that connect all that are near."""
    prefixes = hold(_rare_prefixes(members, sets), "prefixes")
    head = prefixes.groupBy("key").agg(F.min("node").alias("head")).withColumnRenamed("head", "node")
    sides = [prefixes.select("key", *[F.col(c).alias(f"{c}_{s}") for c in ("node", "n", "c", "left")]) for s in "ab"]
    met = sides[0].join(sides[1].join(head.withColumnRenamed("node", "node_b"), ["key", "node_b"]), "key")
    met = met.filter((F.col("c_a") != F.col("c_b")) & _may_agree()).select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()
    first = hold(_verified(met, sets).filter(_linked()).select("a", "b"), "first")
    of = [members.select(F.col("node").alias(s), F.col("c").alias(f"c_{s}")) for s in "ab"]
    joined = components(first.join(of[0], "a").join(of[1], "b").select(F.col("c_a").alias("a"), F.col("c_b").alias("b")))
    moved = prefixes.join(joined.select(F.col("node").alias("c"), "component"), "c", "left").withColumn("c", F.coalesce("component", "c")).drop("component")
    pairs = _with_outsiders(_still_split(moved), _may_agree(), "left").distinct()
    found = hold(first.unionByName(_verified(pairs, sets).filter(_linked()).select("a", "b")), "links")
    release(prefixes, first)
    return found


def links(reps: DataFrame, texts: DataFrame) -> DataFrame:
    """Confirmed edges ``(a, b)`` that connect every component of ``reps(node, rep, set_id, n_shingles, bands)``.

    A pair that shares a band is compared, or already connected, or has no common rare shingle and so no link.
    """
    rows = reps.select(F.explode("bands").alias("band"), "node", F.col("n_shingles").alias("n"))
    first = rows.groupBy("band").agg(F.min("node").alias("head"), F.max("node").alias("_last")).filter("head < _last")
    members = hold(rows.join(first.select("band", "head"), "band"), "members")
    involved = reps.join(members.select("node").distinct(), "node", "left_semi").select("node", "rep", "set_id")
    involved = hold(involved, "involved")
    wanted = texts.join(involved.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
    sets = hold(sets_of(wanted).join(involved.select("set_id", "node").distinct(), "set_id").select("node", "items"), "sets")

    to_head = members.filter("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b")).distinct()
    compared = hold(_verified(to_head, sets), "compared")
    edges = compared.filter(_linked()).select("a", "b")
    tagged = members.select(F.col("band").alias("key"), "node", "n").join(components(edges), "node", "left")
    split = _still_split(tagged.select("key", "node", "n", F.coalesce("component", "node").alias("c")))
    crowd = hold(split.groupBy("node").agg(F.first("n").alias("n"), F.first("c").alias("c")), "crowd")
    found = hold(edges.unionByName(_by_rare_shingles(crowd, sets)), "links")
    release(members, involved, sets, compared, crowd)
    return found


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", marked: bool = False) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept; with ``marked`` also the text's mark and near_group.

    ``near_group`` names the rows of a component whatever their ids: a null doc_id is in the group of the
    documents with its set, or of the other rows without an id that have it; without shingles it is null.

    Equal sets (exact copies, and copies that differ in A-Z case or spacing) form a class that is
    compared once. Null, empty and blank texts have no shingles and stay alone. Rows that share a
    doc_id are judged each by its own text; a null doc_id is no document of any class: it has a null
    component and is kept.
    """
    texts = texts_of(df, doc_id, text)
    base = hold(sketches(texts), "sketches")
    known = base.filter("doc_id is not null and set_id is not null")
    classes = known.groupBy("set_id").agg(F.min("doc_id").alias("rep")).withColumn("node", F.monotonically_increasing_id())
    classes = hold(classes, "classes")
    reps = known.join(classes, ["set_id"]).filter("doc_id = rep")
    found = components(links(reps, texts.filter("doc_id is not null")))
    grouped = classes.join(found, "node", "left").select("set_id", "rep", F.coalesce("component", "node").alias("c"))
    least = grouped.groupBy("c").agg(F.min("rep").alias("component_id"))
    labelled = grouped.join(least, "c").select("set_id", "component_id", "c")
    out = base.select("doc_id", "mark", "n_shingles", "set_id").join(labelled, "set_id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    group = F.coalesce(F.col("c").cast("string"), F.hex("set_id")).alias("near_group")
    out = out.select("doc_id", "n_shingles", component.alias("component_id"), *(["mark", group] if marked else []))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
