"""Repeated passages by prefix-partitioned suffix trees over words.

Suffixes are word positions with at least ``WINDOW`` words to go. Only those that can lie in a repeat
are made: the least 16-word hash inside a window is its anchor, equal windows have equal anchors, so a
window whose anchor stands in one document only repeats nowhere. The others are cut into groups by
their prefix: 16 words, or all ``WINDOW`` words where a 16-word prefix has too many suffixes. Each
group is sorted as a suffix tree lists its leaves, and read as a stream; an inner node at least
``WINDOW`` words deep is a run of leaves with equal symbols, its first leaf the smallest document. A
group that is still too large at full depth is a single deep node: it needs no tree but its smallest
document, which is combined before the shuffle. Deep nodes at neighbouring positions chain to the
maximal repeats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipstat.llm.common import WordHashes, arrow_map, byte_texts, hold, lists, mixed, release, texts_of
from clipstat.session import ship_package

WINDOW = 50
PREFIX = 16
#: Prefixes are counted in so many buckets, whatever the size of the input.
BUCKETS = 65_536
#: Suffixes of a bucket that one task sorts without a longer prefix; more where the mean bucket is larger.
GROUP_ROWS, UNEVEN = 100_000, 8

_BASE = 0xD6E8FEB86659FD93
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


class Powers:
    """Powers of the hash base and of its inverse modulo 2**64, grown to the longest document."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 4096, 2 * len(self.up))
            self.up = self._grown(_BASE, size)
            self.down = self._grown(_BASE_INVERSE, size)
        return self.up[:n], self.down[:n]

    @staticmethod
    def _grown(base: int, size: int) -> np.ndarray:
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        return np.multiply.accumulate(steps)


class Hashed:
    """Hashes of every run of words of one document."""

    def __init__(self, words: np.ndarray, powers: Powers) -> None:
        up, self.down = powers.to(len(words) + 1)
        self.sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * up[: len(words)], out=self.sums[1:])

    def runs(self, start: int, length: int, count: int) -> np.ndarray:
        """Hashes of ``length`` words from positions ``start`` to ``start + count - 1``."""
        part = self.sums[start + length : start + length + count] - self.sums[start : start + count]
        return mixed(part * self.down[start : start + count])


def anchors(hashed: Hashed, n: int) -> np.ndarray:
    """The anchor of every window: the least hash of 16 words inside it."""
    least = hashed.runs(0, PREFIX, n - PREFIX + 1)
    span, width = WINDOW - PREFIX + 1, 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = span - width
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def _scan(texts: DataFrame) -> DataFrame:
    """Per row: doc_id, n_words, digest of the word sequence, distinct anchors (none below a window)."""
    hashes, powers = WordHashes(), Powers()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, digests, found = [], [], []
        for text in byte_texts(batch.column("text")):
            words = (text or b"").split()
            n = len(words)
            sizes.append(n)
            if n < WINDOW:
                digests.append(None)
                found.append(np.zeros(0, np.int64))
                continue
            coded = hashes.of(words)
            digests.append(xxhash.xxh3_128_digest(coded.tobytes()))
            found.append(np.unique(anchors(Hashed(coded, powers), n)).view(np.int64))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), lists(found, pa.int64())],
            ["doc_id", "n_words", "sequence", "anchors"],
        )

    return arrow_map(texts, run, "doc_id bigint, n_words bigint, sequence binary, anchors array<bigint>")


def _suffixes(listed: DataFrame) -> DataFrame:
    """Suffixes whose window has a repeated anchor: doc_id, place, prefix, rest."""
    hashes, powers = WordHashes(), Powers()

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        wanted = batch.column("anchors")
        for k, text in enumerate(byte_texts(batch.column("text"))):
            words = (text or b"").split()
            count = len(words) - WINDOW + 1
            if count < 1:
                continue
            hashed = Hashed(hashes.of(words), powers)
            known = np.sort(np.asarray(wanted[k].values).view(np.uint64))
            own = anchors(hashed, len(words))
            at = np.minimum(np.searchsorted(known, own), len(known) - 1)
            keep = np.flatnonzero(known[at] == own)
            if not len(keep):
                continue
            prefix = hashed.runs(0, PREFIX, count)[keep]
            rest = hashed.runs(PREFIX, WINDOW - PREFIX, count)[keep]
            doc = np.full(len(keep), batch.column("doc_id")[k].as_py(), np.int64)
            place = (batch.column("mark")[k].as_py() << 32) + keep.astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc), pa.array(place), pa.array(prefix.view(np.int64)), pa.array(rest.view(np.int64))],
                ["doc_id", "place", "prefix", "rest"],
            )

    schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "place", "prefix", "rest")])

    def joined(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts = list(run(batch))
        if not parts:
            return pa.RecordBatch.from_pylist([], schema)
        return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]

    return arrow_map(listed, joined, "doc_id bigint, place bigint, prefix bigint, rest bigint")


def _leaves(grouped: DataFrame) -> DataFrame:
    """Leaves of deep nodes that a smaller document shares, from sorted suffixes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            prefix, rest, doc = (np.asarray(batch.column(c)) for c in ("prefix", "rest", "doc_id"))
            new = np.ones(len(doc), bool)
            new[1:] = (prefix[1:] != prefix[:-1]) | (rest[1:] != rest[:-1])
            first = doc[np.maximum.accumulate(np.where(new, np.arange(len(doc)), 0))]
            if last is not None and (prefix[0], rest[0]) == last[:2]:
                upto = np.flatnonzero(new)[1] if new.sum() > 1 else len(doc)
                first[:upto] = last[2]
            last = (prefix[-1], rest[-1], first[-1])
            repeat = pa.array(doc > first)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(repeat) for c in ("doc_id", "place")], ["doc_id", "place"])

    return grouped.mapInArrow(run, "doc_id bigint, place bigint")


def _bucket(*columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(BUCKETS)).alias("bucket")


def _crowded(suffixes: DataFrame, *columns: str) -> DataFrame:
    """Buckets of prefixes with too many suffixes: at most ``BUCKETS`` rows, so they may be broadcast."""
    counts = suffixes.groupBy(_bucket(*columns)).agg(F.count("*").alias("n"))
    limit = counts.agg(F.greatest(F.lit(GROUP_ROWS), F.lit(UNEVEN) * F.sum("n") / F.lit(BUCKETS))).first()[0]
    return counts.filter(F.col("n") > (limit or 0)).select("bucket")


def repeated_windows(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """Positions of windows that also start in a smaller document, and the documents that equal one.

    Returns ``(doc_id, place)`` with the position in the low half of ``place`` and a mark of the row's
    text in the high half (rows may share a doc_id), and ``(doc_id, sequence)`` of documents of at
    least ``WINDOW`` words whose whole word sequence is that of a smaller document. Such copies are
    one path of the tree and take no further part. Both read the held tables of the list.
    """
    ship_package(df.sparkSession)
    texts = texts_of(df, doc_id, text).filter("doc_id is not null").withColumn("mark", _mark())
    scanned = hold(_scan(texts).filter("sequence is not null"), "scanned")
    least = scanned.groupBy("sequence").agg(F.min("doc_id").alias("least"))
    told = scanned.select("doc_id", "sequence", "anchors").join(least, "sequence")
    copies = told.filter("doc_id > least").select("doc_id", "sequence").distinct()
    rows = told.filter("doc_id = least").select("doc_id", F.explode("anchors").alias("anchor"))
    rows = hold(rows, "anchors")
    shared = rows.groupBy("anchor").agg(F.min("doc_id").alias("_lo"), F.max("doc_id").alias("_hi")).filter("_lo < _hi")
    listed = rows.join(shared, "anchor").groupBy("doc_id").agg(F.collect_list("anchor").alias("anchors"))
    suffixes = hold(_suffixes(texts.join(listed, "doc_id").select("doc_id", "text", "mark", "anchors")), "suffixes")
    release(rows)

    wide = suffixes.withColumn("bucket", _bucket("prefix")).join(
        F.broadcast(_crowded(suffixes, "prefix").withColumn("long", F.lit(True))), "bucket", "left"
    )
    wide = wide.withColumn("long", F.coalesce("long", F.lit(False)))
    short = wide.filter("not long").select("doc_id", "place", "prefix", "rest")
    full = wide.filter("long").select("doc_id", "place", "prefix", "rest")
    crowded = F.broadcast(_crowded(full, "prefix", "rest"))
    full = full.withColumn("bucket", _bucket("prefix", "rest"))
    single = full.join(crowded, "bucket", "left_semi").drop("bucket")
    full = full.join(crowded, "bucket", "left_anti").drop("bucket")

    keyed = short.withColumn("key", F.xxhash64("prefix")).unionByName(full.withColumn("key", F.xxhash64("prefix", "rest")))
    trees = _leaves(keyed.repartition("key").sortWithinPartitions("prefix", "rest", "doc_id").select("doc_id", "place", "prefix", "rest"))
    node = single.groupBy("prefix", "rest").agg(F.min("doc_id").alias("least"))
    alone = single.join(node, ["prefix", "rest"]).filter("doc_id > least").select("doc_id", "place")
    return trees.unionByName(alone), copies, [scanned, suffixes]


def _mark() -> Column:
    """31 bits of a row's text, to tell rows that share a doc_id."""
    return F.coalesce(F.hash("text"), F.lit(0)).bitwiseAND(F.lit(0x7FFFFFFF)).cast("bigint")


def covered(n: int, starts: np.ndarray) -> np.ndarray:
    """Which of ``n`` words a window from one of ``starts`` covers."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + WINDOW, n), -1)
    return np.cumsum(edge[:n]) > 0


def without_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text", carry: tuple[str, ...] = (), rejoin: bool = True) -> DataFrame:
    """Per row: doc_id, the columns of ``carry``, n_words, n_removed, kept_text.

    The kept words are joined by one space; with ``rejoin=False`` a text that loses nothing stays as it is.

    A word is removed when a window of ``WINDOW`` words of its document covers it and the same window
    also starts in a document with a smaller doc_id. Null, empty and short texts lose nothing; a row
    with a null doc_id loses nothing and counts as no earlier document; rows that share a doc_id don't
    remove each other's words.
    """
    spark = df.sparkSession
    marks, copies, held = repeated_windows(df, doc_id, text)
    marks = hold(marks.groupBy("doc_id").agg(F.collect_list("place").alias("places")), "marks")
    whole = hold(copies.groupBy("doc_id").agg(F.collect_set("sequence").alias("sequences")), "copies")
    release(*held)
    notes = marks.join(whole, "doc_id", "full_outer")
    rows = df.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"), F.struct(*carry).alias("rest") if carry else F.lit(None).cast("string").alias("rest"))
    rows = rows.withColumn("mark", _mark())
    rows = rows.join(notes, "doc_id", "left").select("doc_id", "text", "mark", "places", "sequences", "rest")
    hashes = WordHashes()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, gone, kept = [], [], []
        places, copied = batch.column("places"), batch.column("sequences").to_pylist()
        for k, text in enumerate(byte_texts(batch.column("text"))):
            words = (text or b"").split()
            n = len(words)
            sizes.append(n)
            if copied[k] and n >= WINDOW and xxhash.xxh3_128_digest(hashes.of(words).tobytes()) in copied[k]:
                words, removed = [], n
            elif places[k].is_valid and n >= WINDOW:
                own = np.asarray(places[k].values)
                own = own[(own >> 32) == batch.column("mark")[k].as_py()] & 0xFFFFFFFF
                out = covered(n, own)
                removed = int(out.sum())
                words = [w for w, drop in zip(words, out.tolist()) if not drop] if removed else words
            else:
                removed = 0
            gone.append(removed)
            kept.append(b" ".join(words) if removed or rejoin else text)
        told = [pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("rest"), *told], ["doc_id", "rest", "n_words", "n_removed", "kept_text"]
        )

    ship_package(spark)
    rest = dict(rows.dtypes)["rest"]
    out = arrow_map(rows, run, f"doc_id bigint, rest {rest}, n_words bigint, n_removed bigint, kept_text string")
    return out.select("doc_id", *[F.col("rest")[c].alias(c) for c in carry], "n_words", "n_removed", "kept_text")

