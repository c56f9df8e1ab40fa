"""Repeated byte strings by a column-wise multi-document suffix construction.

The order of all suffixes of a collection of strings is built from its end: round ``j`` inserts, for every
string at once, the suffix of ``j`` symbols, that is one symbol per string. The state is the collection's
Burrows-Wheeler transform and the common prefixes of neighbours, two columns that a round reads and
rewrites front to back. Where a suffix goes follows from the transform alone: behind all suffixes with a
smaller first symbol, after as many as carry its symbol before the place of the suffix it extends. Its
common prefixes are one more than the least common prefix between that place and the neighbours'.

A repeat is ``WINDOW`` equal bytes, so whole documents need not be one string, and the strings of one
collection only those that can share one. Every window of a text has an anchor, the least hash of ``GRAM``
bytes inside it; equal windows have equal anchors. A text falls into overlapping segments, each the windows
in a row that have one anchor; segments are dealt by their anchor, so all equal windows meet in one
collection, and a string is at most ``WINDOW + SPAN - 1`` bytes. The external files between the steps are
Spark tables: anchors that stand in one text only go first, equal segments are combined before the
shuffle, and collections are built one after another in bounded pieces of a partition. An anchor with
very many different segments needs no suffix order but a count: its windows are compared by their hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipstat.llm.common import arrow_map, byte_texts, hold, mixed, release, texts_of
from clipstat.llm.substring_dedup import Powers
from clipstat.session import ship_package

WINDOW, GRAM = 50, 20
#: Windows of a segment at most: one bit each of a signed 64-bit number.
SPAN = 62
#: Bytes of texts hashed together; anchors summed before they are sent on; anchors of a bucket.
BLOCK, FLUSH, PER_BUCKET = 1 << 20, 1 << 20, 1 << 20
#: Segments of a collection, and buckets of anchors that are counted for crowds.
COLLECTION, BUCKETS = 4_000, 65_536
#: A bucket with more different segments is compared by window hashes; more where the mean bucket is larger.
GROUP_ROWS, UNEVEN = 20_000, 8

_FROM_ELSEWHERE = np.int64(-1)


# ---- segments -------------------------------------------------------------------------------


def blocks(texts: list[bytes | None]) -> Iterator[list[tuple[int, int, bytes]]]:
    """Groups of ``(row, offset, bytes)`` of about ``BLOCK`` bytes whose windows are those of the texts."""
    group, size = [], 0
    for row, text in enumerate(texts):
        last = len(text or b"") - WINDOW
        for offset in range(0, last + 1, BLOCK):
            piece = text[offset : offset + BLOCK + WINDOW - 1]
            group.append((row, offset, piece))
            size += len(piece)
            if size >= BLOCK:
                yield group
                group, size = [], 0
    if group:
        yield group


def _least(values: np.ndarray, span: int) -> np.ndarray:
    """The least of every ``span`` values in a row."""
    width = 1
    while 2 * width <= span:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    rest = span - width
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


class Runs:
    """The segments of a group of blocks: start in the joined bytes, windows, anchor, row and offset in its text."""

    def __init__(self, group: list[tuple[int, int, bytes]], powers: Powers) -> None:
        self.raw = b"".join(piece for _, _, piece in group)
        sizes = np.array([len(piece) for _, _, piece in group], np.int64)
        ends = np.cumsum(sizes)
        up, down = powers.to(len(self.raw) + 1)
        sums = np.zeros(len(self.raw) + 1, np.uint64)
        np.cumsum((np.frombuffer(self.raw, np.uint8).astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
        grams = mixed((sums[GRAM:] - sums[:-GRAM]) * down[: len(self.raw) - GRAM + 1])
        anchor = _least(grams, WINDOW - GRAM + 1)
        piece = np.repeat(np.arange(len(group)), sizes)[: len(anchor)]
        valid = np.arange(len(anchor)) + WINDOW <= ends[piece]
        opens = np.ones(len(anchor), bool)
        opens[1:] = (anchor[1:] != anchor[:-1]) | (piece[1:] != piece[:-1])
        at = np.arange(len(anchor))
        since = at - np.maximum.accumulate(np.where(opens, at, 0))
        opens |= since % SPAN == 0
        starts = np.flatnonzero(opens & valid)
        # Windows of a piece stand in a row, so a segment ends where the next one opens or the piece's windows end.
        limit = ends[piece[starts]] - WINDOW + 1
        following = np.append(starts[1:], len(anchor))
        self.start, self.windows = starts, np.minimum(following, limit) - starts
        self.anchor = anchor[starts].view(np.int64)
        rows, offsets = (np.array([g[k] for g in group], np.int64) for k in (0, 1))
        self.row = rows[piece[starts]]
        self.place = starts - (ends - sizes)[piece[starts]] + offsets[piece[starts]]

    def bytes_of(self, k: int) -> bytes:
        return self.raw[self.start[k] : self.start[k] + self.windows[k] + WINDOW - 1]


def _short(anchor: np.ndarray) -> np.ndarray:
    """The half of an anchor that does not choose its bucket. Anchors alike in both only ask for segments in vain."""
    return (anchor.view(np.uint64) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _digest() -> Column:
    return F.xxhash64("text")


def _posted(texts: DataFrame, buckets: int) -> DataFrame:
    """Distinct (anchor, text) pairs as packed arrays by bucket.

    An anchor that stands in several texts of one flush is known to be shared: its texts go to any bucket
    (``known``), and its own bucket only hears of it once. So no bucket gets more of an anchor than flushes.
    """
    powers = Powers()

    def packed(bucket: np.ndarray, known: bool, anchor: np.ndarray, text: np.ndarray) -> Iterator[tuple]:
        order = np.argsort(bucket, kind="stable")
        bucket, anchor, text = bucket[order], anchor[order], text[order]
        cuts = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            yield int(bucket[lo]), known, _short(anchor[lo:hi]).tobytes(), text[lo:hi].tobytes()

    def flushed(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        anchor, text = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((text, anchor))
        anchor, text = anchor[order], text[order]
        new = np.ones(len(anchor), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
        anchor, text = anchor[new], text[new]
        first = np.ones(len(anchor), bool)
        first[1:] = anchor[1:] != anchor[:-1]
        several = np.diff(np.append(np.flatnonzero(first), len(anchor))) > 1
        shared = np.repeat(several, np.diff(np.append(np.flatnonzero(first), len(anchor))))
        told = np.where(shared, _FROM_ELSEWHERE, text)[first]
        rows = list(packed(anchor[first].view(np.uint64) % np.uint64(buckets), False, anchor[first], told))
        if shared.any():
            rows += packed(mixed(text[shared].view(np.uint64)) % np.uint64(buckets), True, anchor[shared], text[shared])
        kinds = (pa.int64(), pa.bool_(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["bucket", "known", "anchors", "texts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            digests = np.asarray(batch.column("digest"))
            for group in blocks(byte_texts(batch.column("text"))):
                runs = Runs(group, powers)
                held.append((runs.anchor, digests[runs.row]))
                size += len(runs.anchor)
                if size >= FLUSH:
                    yield flushed(held)
                    held, size = [], 0
        if size:
            yield flushed(held)

    return texts.mapInArrow(run, "bucket bigint, known boolean, anchors binary, texts binary")


def _shared_anchors(posted: DataFrame, parts: int) -> DataFrame:
    """``digest, anchor`` of anchors that stand in at least two texts."""

    def told(text: np.ndarray, anchor: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(text), pa.array(anchor)], ["digest", "anchor"])

    def answered(held: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
        anchor, text = (np.frombuffer(b"".join(x), kind) for x, kind in zip(zip(*held), (np.int32, np.int64)))
        order = np.lexsort((text, anchor))
        anchor, text = anchor[order], text[order]
        starts = np.flatnonzero(np.diff(anchor, prepend=~anchor[0]) != 0)
        counts = np.diff(np.append(starts, len(anchor)))
        alike = np.minimum.reduceat(text, starts) == np.maximum.reduceat(text, starts)
        elsewhere = np.repeat(~alike, counts) & (text != _FROM_ELSEWHERE)
        return told(text[elsewhere], anchor[elsewhere])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("bucket", "known", "anchors", "texts"))
            for bucket, known, anchors, texts in zip(*columns):
                if known:
                    yield told(np.frombuffer(texts, np.int64), np.frombuffer(anchors, np.int32))
                    continue
                if bucket != last and held:
                    yield answered(held)
                    held = []
                last = bucket
                held.append((anchors, texts))
        if held:
            yield answered(held)

    return posted.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(run, "digest bigint, anchor int")


def _segments(listed: DataFrame) -> DataFrame:
    """Segments with a shared anchor: doc_id, place (a mark of the text above the offset), windows, anchor, key, bytes."""
    powers = Powers()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                yield from cut(batch.slice(start, 500))

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        wanted = batch.column("anchors")
        ids, marks = np.asarray(batch.column("doc_id")), np.asarray(batch.column("mark"))
        salt = mixed(np.arange(1, batch.num_rows + 1, dtype=np.uint64))
        known = [np.asarray(wanted[k].values).view(np.uint32) ^ salt[k] for k in range(batch.num_rows)]
        known = np.sort(np.concatenate(known)) if known else np.zeros(0, np.uint64)
        if not len(known):
            return
        for group in blocks(byte_texts(batch.column("text"))):
            runs = Runs(group, powers)
            own = _short(runs.anchor).view(np.uint32) ^ salt[runs.row]
            keep = np.flatnonzero(known[np.minimum(np.searchsorted(known, own), len(known) - 1)] == own)
            cuts = [runs.bytes_of(k) for k in keep.tolist()]
            keys = np.array([xxhash.xxh3_64_intdigest(c) for c in cuts], np.uint64).view(np.int64)
            arrays = (ids[runs.row[keep]], (marks[runs.row[keep]] << 32) + runs.place[keep], runs.windows[keep], runs.anchor[keep], keys)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(a, pa.int64()) for a in arrays), pa.array(cuts, pa.binary())], ["doc_id", "place", "windows", "anchor", "key", "bytes"]
            )

    return listed.mapInArrow(run, "doc_id bigint, place bigint, windows bigint, anchor bigint, key bigint, bytes binary")


# ---- the column-wise construction -------------------------------------------------------------


class Collection:
    """Burrows-Wheeler transform and capped common prefixes of strings, built one column per round."""

    def __init__(self, strings: list[bytes]) -> None:
        self.strings = strings
        self.sizes = np.array([len(s) for s in strings], np.int64)
        self.count = len(strings)
        flat = np.frombuffer(b"".join(strings), np.uint8)
        codes = np.zeros(256, np.uint16)
        used = np.flatnonzero(np.bincount(flat, minlength=256))
        codes[used] = np.arange(1, len(used) + 1)
        self.symbols = codes[flat].astype(np.uint8 if len(used) < 256 else np.uint16)
        self.ends = np.cumsum(self.sizes)
        self._build()

    def _before(self, strings: np.ndarray, size: int) -> np.ndarray:
        """The symbols that stand before the suffixes of ``size`` symbols, 0 before a whole string."""
        at = self.ends[strings] - size - 1
        return np.where(self.sizes[strings] > size, self.symbols[np.maximum(at, 0)], 0).astype(self.symbols.dtype)

    def _build(self) -> None:
        # Round 0: the empty suffixes, in order of the strings.
        here = np.arange(self.count)
        strings = here.copy()
        self.transform = self._before(strings, 0)
        self.common = np.zeros(self.count, np.uint8)
        for size in range(1, int(self.sizes.max(initial=0)) + 1):
            going = self.sizes[strings] >= size
            strings, here = strings[going], here[going]
            here, strings = self._insert(here, strings, size)

    def _insert(self, here: np.ndarray, strings: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """One symbol per string: the suffixes at ``here``, ascending, grow by the symbol before them."""
        by_symbol = np.argsort(self.transform, kind="stable")
        ended = len(by_symbol) - np.count_nonzero(self.transform)
        by_symbol = by_symbol[ended:]
        place = np.empty(len(self.transform), np.int64)
        place[by_symbol] = np.arange(len(by_symbol))
        new = place[here]
        symbol = self.transform[here]
        previous, following = by_symbol[np.maximum(new - 1, 0)], by_symbol[np.minimum(new + 1, len(by_symbol) - 1)]
        same_before = (new > 0) & (self.transform[previous] == symbol)
        same_after = (new + 1 < len(by_symbol)) & (self.transform[following] == symbol)
        least = _RangeMinima(self.common, max(int((here - previous)[same_before].max(initial=0)), int((following - here)[same_after].max(initial=0))))
        common_before, common_after = np.zeros(len(new), np.int64), np.zeros(len(new), np.int64)
        common_before[same_before] = 1 + least.of(previous[same_before] + 1, here[same_before] + 1)
        common_after[same_after] = 1 + least.of(here[same_after] + 1, following[same_after] + 1)

        order = np.argsort(new)
        new, strings = new[order] + self.count, strings[order]
        old = np.ones(self.count + len(by_symbol), bool)
        old[new] = False
        transform = np.empty(len(old), self.transform.dtype)
        common = np.empty(len(old), np.uint8)
        transform[old], common[old] = self.transform, self.common
        transform[new] = self._before(strings, size)
        common[new] = np.minimum(common_before[order], WINDOW)
        after = new[same_after[order]] + 1
        common[after] = np.minimum(common_after[order][same_after[order]], WINDOW)
        self.transform, self.common = transform, common
        return new, strings

    def places(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """The strings that have a suffix of each size and its place in the final order, by extending from the empty ones."""
        by_symbol = np.argsort(self.transform, kind="stable")
        ended = len(by_symbol) - np.count_nonzero(self.transform)
        place = np.empty(len(by_symbol), np.int64)
        place[by_symbol] = np.arange(len(by_symbol)) - ended + self.count
        strings = np.arange(self.count)
        at = strings.copy()
        for size in range(1, int(self.sizes.max(initial=0)) + 1):
            going = self.sizes[strings] >= size
            strings, at = strings[going], place[at[going]]
            yield size, strings, at

    def earlier(self, owner: np.ndarray) -> np.ndarray:
        """Per string one bit per window: a string with a smaller owner has the same window."""
        deep = [(size, strings, at) for size, strings, at in self.places() if size >= WINDOW]
        bits = np.zeros(self.count, np.int64)
        if not deep:
            return bits
        node = np.cumsum(self.common < WINDOW)
        least = np.full(int(node[-1]) + 1, np.iinfo(np.int64).max)
        for _, strings, at in deep:
            np.minimum.at(least, node[at], owner[strings])
        for size, strings, at in deep:
            told = least[node[at]] < owner[strings]
            bits[strings] |= told.astype(np.int64) << (self.sizes[strings] - size)
        return bits


class _RangeMinima:
    """Least common prefixes of ranges up to a length, from minima of spans that double."""

    def __init__(self, values: np.ndarray, longest: int) -> None:
        levels = max(1, int(longest).bit_length())
        self.table = np.zeros((levels, len(values)), values.dtype)
        self.table[0] = values
        for k in range(1, levels):
            half, last = 1 << (k - 1), self.table[k - 1]
            np.minimum(last[:-half], last[half:], out=self.table[k, :-half])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        level = np.frexp((stop - start).astype(np.float64))[1] - 1
        return np.minimum(self.table[level, start], self.table[level, stop - (1 << level)]).astype(np.int64)


def _ordered(segments: DataFrame) -> DataFrame:
    """``key, bits`` of segments with a window that a smaller document has; rows come sorted by anchor."""

    def judged(rows: list[tuple[int, bytes, int]]) -> pa.RecordBatch:
        bits = Collection([b for _, b, _ in rows]).earlier(np.array([d for _, _, d in rows], np.int64))
        keep = np.flatnonzero(bits)
        keys = np.array([k for k, _, _ in rows], np.int64)
        return pa.RecordBatch.from_arrays([pa.array(keys[keep]), pa.array(bits[keep])], ["key", "bits"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A segment that is alone with its anchor has no other to compare with.
        held, group, last = [], [], None
        for batch in batches:
            for anchor, *row in zip(*(batch.column(c).to_pylist() for c in ("anchor", "key", "bytes", "least"))):
                if anchor != last:
                    held += group if len(group) > 1 else []
                    group, last = [], anchor
                    if len(held) >= COLLECTION:
                        yield judged(held)
                        held = []
                group.append(row)
        held += group if len(group) > 1 else []
        if held:
            yield judged(held)

    return segments.mapInArrow(run, "key bigint, bits bigint")


def _by_window(segments: DataFrame) -> DataFrame:
    """The same for crowded anchors: every window by its hashes, the least document combined before the shuffle."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for key, text, least in zip(*(batch.column(c).to_pylist() for c in ("key", "bytes", "least"))):
            for k in range(len(text) - WINDOW + 1):
                digest = xxhash.xxh3_128_intdigest(text[k : k + WINDOW])
                rows.append((key, least, k, (digest >> 64) - (1 << 63), (digest & 0xFFFFFFFFFFFFFFFF) - (1 << 63)))
        columns = zip(*rows) if rows else [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["key", "least", "k", "high", "low"])

    windows = arrow_map(segments.select("key", "bytes", "least"), run, "key bigint, least bigint, k bigint, high bigint, low bigint")
    first = windows.groupBy("high", "low").agg(F.min("least").alias("_first"))
    late = windows.join(first, ["high", "low"]).filter("_first < least")
    return late.groupBy("key").agg(F.bit_or(F.expr("shiftleft(1L, cast(k as int))")).alias("bits"))


def _crowded(segments: DataFrame) -> DataFrame:
    """Buckets of anchors with too many segments: at most ``BUCKETS`` rows, so they may be broadcast."""
    counts = segments.groupBy("bucket").agg(F.count("*").alias("n"))
    limit = counts.agg(F.greatest(F.lit(GROUP_ROWS), F.lit(UNEVEN) * F.sum("n") / F.lit(BUCKETS))).first()[0]
    return counts.filter(F.col("n") > (limit or 0)).select("bucket")


def repeats(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From ``doc_id, text``: held ``doc_id, place, bits`` of windows that a smaller document has, and ``doc_id, digest`` of texts that equal a smaller document's."""
    spark = df.sparkSession
    ship_package(spark)
    texts = df.filter("doc_id is not null").filter(F.octet_length("text") >= WINDOW)
    texts = texts.withColumn("digest", _digest()).withColumn("mark", _mark())
    first = texts.groupBy("digest", F.xxhash64(F.lit(1), "text").alias("second")).agg(F.min("doc_id").alias("first"), F.sum(F.octet_length("text")).alias("size"))
    first = hold(first, "first")
    found = texts.select("doc_id", "digest", F.xxhash64(F.lit(1), "text").alias("second")).join(first, ["digest", "second"])
    copies = hold(found.filter("doc_id > first").select("doc_id", "digest").distinct(), "copies")

    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // (7 * PER_BUCKET)))
    shared = _shared_anchors(_posted(texts.select("text", "digest"), 4 * parts), parts)
    shared = shared.groupBy("digest").agg(F.collect_set("anchor").alias("anchors"))
    listed = shared.join(first.select("digest", F.col("first").alias("doc_id")), "digest")
    own = texts.join(listed, ["digest", "doc_id"]).select("doc_id", "text", "mark", "anchors")
    segments = hold(_segments(own), "segments")

    kinds = segments.groupBy("key").agg(F.min("doc_id").alias("least"), F.first("anchor").alias("anchor"), F.first("bytes").alias("bytes"))
    kinds = hold(kinds.withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(BUCKETS))), "kinds")
    crowded = F.broadcast(_crowded(kinds))
    few = kinds.join(crowded, "bucket", "left_anti").select("anchor", "key", "bytes", "least")
    ordered = _ordered(few.repartition("anchor").sortWithinPartitions("anchor"))
    bits = ordered.unionByName(_by_window(kinds.join(crowded, "bucket", "left_semi")))
    known = kinds.select("key", "least").join(bits, "key", "left")
    late = segments.select("doc_id", "place", "windows", "key").join(known, "key")
    whole = F.expr("shiftleft(1L, cast(windows as int)) - 1")
    told = F.when(F.col("doc_id") > F.col("least"), whole).otherwise(F.coalesce("bits", F.lit(0)))
    marks = hold(late.select("doc_id", "place", told.alias("bits")).filter("bits <> 0"), "marks")
    release(first, segments, kinds)
    return marks, copies


def _mark() -> Column:
    """31 bits of a row's text, to tell rows that share a doc_id."""
    return F.coalesce(F.hash("text"), F.lit(0)).bitwiseAND(F.lit(0x7FFFFFFF)).cast("bigint")


def removed(n: int, places: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which of ``n`` bytes a marked window covers."""
    edge = np.zeros(n + 1, np.int64)
    for lo in range(0, len(places), BLOCK):
        row, shift = np.nonzero((bits[lo : lo + BLOCK, None] >> np.arange(SPAN)) & 1)
        starts = places[lo : lo + BLOCK][row] + shift
        edge += np.bincount(starts, minlength=n + 1) - np.bincount(starts + WINDOW, minlength=n + 1)
    return np.cumsum(edge)[:n] > 0


def without_repeated_bytes(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes).

    A byte goes when a window of ``WINDOW`` bytes of its document covers it and the same bytes also start in
    a document with a smaller doc_id. Null and empty texts have no bytes, shorter ones lose none; a row with
    a null doc_id loses nothing and counts as no earlier document; rows that share a doc_id don't remove
    each other's bytes. Other columns are not read.
    """
    rows = texts_of(df, doc_id, text)
    marks, copies = repeats(rows)
    listed = marks.groupBy("doc_id").agg(F.collect_list("place").alias("places"), F.collect_list("bits").alias("bits"))
    whole = copies.groupBy("doc_id").agg(F.collect_set("digest").alias("digests"))
    notes = listed.join(whole, "doc_id", "full_outer")
    rows = rows.withColumn("mark", _mark()).withColumn("digest", _digest())
    rows = rows.join(notes, "doc_id", "left").select("doc_id", "text", "mark", F.coalesce(F.array_contains("digests", F.col("digest")), F.lit(False)).alias("copy"), "places", "bits")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, gone, spans, kept = [], [], [], []
        places, bits = batch.column("places"), batch.column("bits")
        marks, copied = batch.column("mark").to_pylist(), batch.column("copy").to_pylist()
        for k, raw in enumerate(byte_texts(batch.column("text"))):
            raw = raw or b""
            sizes.append(len(raw))
            if copied[k] and len(raw) >= WINDOW:
                out = (len(raw), 1, b"")
            elif places[k].is_valid and len(raw) >= WINDOW:
                at = np.asarray(places[k].values)
                own = (at >> 32) == marks[k]
                drop = removed(len(raw), at[own] & 0xFFFFFFFF, np.asarray(bits[k].values)[own])
                out = (int(drop.sum()), int(np.count_nonzero(np.diff(drop.astype(np.int8), prepend=0) == 1)), np.frombuffer(raw, np.uint8)[~drop].tobytes())
            else:
                out = (0, 0, raw)
            for column, value in zip((gone, spans, kept), out):
                column.append(value)
        told = [pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *told], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    ship_package(df.sparkSession)
    return arrow_map(rows, run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
