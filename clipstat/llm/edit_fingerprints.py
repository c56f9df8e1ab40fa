"""Document fingerprints by a randomised edit embedding.

A walk reads a text with a random function per step that all texts share: each step writes the character
under the reader and moves on by zero or one characters, as that function says for the character. Texts at
a small edit distance fall into step again soon after an edit, so their walks differ in few places. The
walk is not kept: 64 of its steps are sampled from each doubling of the step number and each sampled
character is hashed to one of 15 values (the 16th stands for the end), so fingerprints of any two texts
can be compared step by step. Weighted by the steps they stand for, the agreeing samples estimate the
agreement of the whole walks.

Near texts are found by bands of sampled positions of the last doublings, and verified on the fingerprint.
A row goes to each of its bands once, with a sketch of its last samples, and the members of a bucket are compared there:
what lengths and sketches don't tell apart is a group, named by its members, so the same group of many bands is one.
Groups, mostly pairs, are verified on whole fingerprints; both steps keep what connects a group, not its pairs. A bucket of
many members is cut into slots; members outside its largest component then meet all others, in tiles of a bounded size
that spread over tasks, so two near texts that share a band are always linked, however many others share it.
Bands are dealt in slices, one after the other, so a slice's shuffles are gone before the next one's.
All walks of a group of texts advance together in numpy.
"""

from __future__ import annotations

import hashlib
import os.path
from collections.abc import Callable, Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipstat.llm.common import arrow_map, hold, is_empty_table, lists, mixed, release, short_batches
from clipstat.llm.components import components
from clipstat.session import ship_package

#: Samples per doubling, distinct step functions before they repeat, characters walked at a time.
SAMPLES, PERIOD, GROUP_CHARS = 64, 8191, 6_000_000
VALUES, END = 15, 15
BANDS, ROWS = 24, 6
NEAR = 0.75
#: Members of a bucket in a slot and on each side of a tile; members of a bucket compared pair by pair; rows compared at a time.
TILE, FEW, ROWS_AT_ONCE = 512, 32, 16_000
#: Ranges of ids per shuffle partition.
RANGES = 4
#: Parts of the bands that are worked on one after the other.
SLICES = 4

_RNG = np.random.default_rng(20_240_601)
_MOVES = np.zeros((PERIOD, 257), np.int64)
_MOVES[:, :256] = _RNG.integers(0, 2, (PERIOD, 256))
_WRITES = np.full((PERIOD, 257), END, np.uint8)
_WRITES[:, :256] = _RNG.integers(0, VALUES, (PERIOD, 256))
_HEX = np.frombuffer(b"0123456789abcdef", np.uint8)


def sampled_steps(block: int) -> np.ndarray:
    """The sampled steps of a block: steps 0 to 63, then one step of every 64th of each doubling."""
    if block == 0:
        return np.arange(SAMPLES)
    width = 1 << (block - 1)
    inside = np.random.default_rng(block).integers(0, width, SAMPLES)
    return SAMPLES * width + np.arange(SAMPLES) * width + inside


def symbols(text: str) -> np.ndarray:
    """One of 256 symbols per code point."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return ((code ^ (code >> 8) ^ (code >> 16)) & 255).astype(np.uint16)


def fingerprints(coded: list[np.ndarray]) -> list[str]:
    """Fingerprints of texts given as symbols; equal texts have equal ones, the empty text the empty one."""
    count = len(coded)
    lengths = np.array([len(c) for c in coded], np.int64)
    order = np.argsort(-lengths, kind="stable")
    starts = np.zeros(count, np.int64)
    starts[1:] = np.cumsum(lengths + 1)[:-1]
    end = np.full(1, 256, np.uint16)
    flat = np.concatenate([x for c in coded for x in (c, end)]) if count else end
    out: list[list[np.ndarray]] = [[] for _ in range(count)]
    alive = order[lengths[order] > 0]
    at, stop = starts[alive], starts[alive] + lengths[alive]
    begin, block = 0, 0
    while len(alive):
        wanted = sampled_steps(block)
        finish = SAMPLES << block if block else SAMPLES
        taken = np.full((SAMPLES, len(alive)), END, np.uint8)
        lane = np.arange(len(alive))
        k = 0
        for step in range(begin, finish):
            row = step % PERIOD
            char = flat.take(at)
            if k < SAMPLES and step == wanted[k]:
                taken[k, lane] = _WRITES[row].take(char)
                k += 1
            at += _MOVES[row].take(char)
            if step % 256 == 255:
                going = at < stop
                if not going.all():
                    at, stop, lane = at[going], stop[going], lane[going]
                    if not len(lane):
                        break
        written = _HEX[taken.T]
        for i, doc in enumerate(alive):
            out[doc].append(written[i])
        going = at < stop
        alive, at, stop = alive[lane[going]], at[going], stop[going]
        begin, block = finish, block + 1
    return [b"".join(p.tobytes() for p in parts).decode().rstrip("f") for parts in out]


def _weights(n: int) -> np.ndarray:
    block = np.arange(n) // SAMPLES
    return np.where(block == 0, 1.0, 2.0 ** (block - 1))


def _total(n: np.ndarray) -> np.ndarray:
    """Weight of all of ``n`` samples."""
    return np.where(n < SAMPLES, n, (SAMPLES + n % SAMPLES) * 2.0 ** (n // SAMPLES - 1))


def likeness(a: str, b: str) -> float:
    """0 to 1: share of steps in which two walks agree, less what chance gives."""
    if a == b:
        return 1.0
    n = max(len(a), len(b))
    left, right = (np.frombuffer(x.ljust(n, "f").encode(), np.uint8) for x in (a, b))
    both = _weights(n) * ~((left == _HEX[END]) & (right == _HEX[END]))
    share = float((both * (left == right)).sum() / both.sum()) if both.any() else 0.0
    return max(0.0, (share - 1 / VALUES) / (1 - 1 / VALUES))


@lru_cache
def _picks(name: int | str, low: int, stop: int, seed: int) -> list[tuple[str, list[int]]]:
    rows = np.random.default_rng(seed).integers(low, stop, (BANDS, ROWS)).tolist()
    return [(f"{name}|{b}|", row) for b, row in enumerate(rows)]


def bands(fingerprint: str) -> np.ndarray:
    """Keys of bit-sampled bands over the last two whole blocks, and over those one block shorter.

    Texts of nearly the same length on both sides of a block's edge so still share keys. Under two blocks
    the positions are those of the largest power of two that the samples fill, and of half of it. Under
    four samples a text is near no other.
    """
    whole = len(fingerprint) // SAMPLES
    found = [_picks(top, (top - 2) * SAMPLES, top * SAMPLES, top) for top in (whole, whole - 1) if top >= 2]
    if whole <= 2:
        filled = len(fingerprint).bit_length() - 1
        powers = (filled - 1,) if whole == 2 else (filled, filled - 1)
        found += [_picks(f"first {k}", 0, 1 << k, 1000 + k) for k in powers if k >= 2]
    keys = [xxhash.xxh3_64_intdigest(name + "".join([fingerprint[i] for i in row])) for picks in found for name, row in picks]
    return np.array(keys, np.uint64).view(np.int64)


def _ranged(df: DataFrame) -> DataFrame:
    """Rows cut into ranges of ids, each with the first row of the next range behind it.

    The ranges' edges and first ids are a few numbers per shuffle partition. ``look`` marks the row that
    only serves the one before it.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = parts * RANGES
    df = df.withColumn("key", F.coalesce("doc_id", F.lit((1 << 63) - 1)))
    edges = df.agg(F.percentile_approx("key", [k / n for k in range(1, n)], 50 * n).alias("e")).first()["e"]
    edges = sorted(set(edges or []))
    part = F.size(F.filter(F.array(*[F.lit(e).cast("bigint") for e in edges]), lambda e: e <= F.col("key"))) if edges else F.lit(0)
    df = df.withColumn("part", part.cast("int"))
    firsts = sorted((r["part"], r["k"]) for r in df.groupBy("part").agg(F.min("key").alias("k")).collect())
    before = {key: firsts[k - 1][0] for k, (_, key) in enumerate(firsts)}
    serves = F.create_map(*[x for key, k in before.items() for x in (F.lit(key).cast("bigint"), F.lit(k))])[F.col("key")] if before else F.lit(None).cast("int")
    both = F.array(F.struct(F.col("part"), F.lit(0).alias("look")), F.struct(serves.alias("part"), F.lit(1).alias("look")))
    copies = df.select("doc_id", "text", "key", F.explode(F.filter(both, lambda x: x["part"].isNotNull())).alias("at"))
    return copies.select("doc_id", "text", "key", "at.part", "at.look").repartition(parts, "part").sortWithinPartitions("part", "look", "key", "text")


#: A row as it is held: fingerprints in half their bytes, of the edited one only what follows the samples in common.
_OUT = "doc_id bigint, n_chars bigint, edited_sha256 binary, packed binary, shared int, packed_tail binary, near_edited double, near_next double"


def _pack(fingerprint: str) -> bytes:
    """A fingerprint in half its bytes; none ends in the digit that fills it up."""
    return bytes.fromhex(fingerprint + "f" * (len(fingerprint) % 2))


def _unpacked(column: pa.Array) -> list[str]:
    return [x.hex().rstrip("f") for x in column.to_pylist()]


def _finished(rows: list[tuple], spare: list[tuple]) -> pa.RecordBatch | None:
    """Results of rows ``(doc_id, part, look, text)``; each has its next row behind it, the last in ``spare``."""
    chain = rows + spare
    own = [k for k, r in enumerate(rows) if not r[2]]
    if not own:
        return None
    following = {k: k + 1 if k + 1 < len(chain) and chain[k + 1][1] == rows[k][1] else k for k in own}
    edited = []
    for k in own:
        text = rows[k][3]
        cut = len(text) // 4
        edited.append(text[: len(text) - cut] + chain[following[k]][3][:cut])
    prints = fingerprints([symbols(t) for t in [r[3] for r in chain] + edited])
    plain, changed = prints[: len(chain)], prints[len(chain) :]
    shared = [len(os.path.commonprefix([plain[k], c])) for k, c in zip(own, changed)]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([rows[k][0] for k in own], pa.int64()),
            pa.array([len(rows[k][3]) for k in own], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).digest() for t in edited], pa.binary()),
            pa.array([_pack(plain[k]) for k in own], pa.binary()),
            pa.array(shared, pa.int32()),
            pa.array([_pack(c[n:]) for c, n in zip(changed, shared)], pa.binary()),
            pa.array([likeness(plain[k], c) for k, c in zip(own, changed)], pa.float64()),
            pa.array([likeness(plain[k], plain[following[k]]) for k in own], pa.float64()),
        ],
        ["doc_id", "n_chars", "edited_sha256", "packed", "shared", "packed_tail", "near_edited", "near_next"],
    )


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    size = 0
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("doc_id", "part", "look", "text"))
        for doc, part, look, text in zip(*columns):
            rows.append((doc, part, look, text or ""))
            size += len(text or "")
            if size > GROUP_CHARS:
                out = _finished(rows[:-1], rows[-1:])
                rows, size = rows[-1:], len(rows[-1][3])
                if out:
                    yield out
    out = _finished(rows, [])
    if out:
        yield out


def _walked(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    ship_package(df.sparkSession)
    short_batches(df.sparkSession)
    rows = df.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return _ranged(rows).select("doc_id", "part", "look", "text").mapInArrow(_walk, _OUT)


def _hex(packed: str) -> Column:
    return F.expr(f"trim(TRAILING 'f' FROM lower(hex({packed})))")


def _spelled(walked: DataFrame, *more: str) -> DataFrame:
    """Rows of ``_walked`` with fingerprints and digests as text, and the columns ``more``."""
    edited = F.concat(F.substring(_hex("packed"), F.lit(1), F.col("shared")), _hex("packed_tail"))
    sha = F.lower(F.hex("edited_sha256")).alias("edited_sha256")
    return walked.select("doc_id", "n_chars", sha, _hex("packed").alias("fingerprint"), edited.alias("edited_fingerprint"), "near_edited", "near_next", *more)


def fingerprinted(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, bands.

    The edited text ends in the first quarter of the next row by doc_id (nulls last, then by text; after
    the last the first; a single row follows itself). Null texts are empty; two empty texts are alike (1).
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.append_column("bands", lists([bands(f) for f in batch.column("fingerprint").to_pylist()], pa.int64()))

    rows = _spelled(_walked(df, doc_id, text))
    return arrow_map(rows, run, ", ".join(f"{n} {t}" for n, t in rows.dtypes) + ", bands array<bigint>")


def _least(near: float) -> float:
    """Share of steps that near walks agree in, at least."""
    return near * (1 - 1 / VALUES) + 1 / VALUES - 1e-9


def _first_sample(n: int) -> int:
    """Where the sketch of a fingerprint of ``n`` samples begins: a whole block before its last, unfinished one.

    These samples have half of the weight at least.
    """
    return max(n // SAMPLES - 1, 0) * SAMPLES


def _keyed(nodes: DataFrame) -> DataFrame:
    """``(node, packed)``, with ``bands`` or without, to node, n (samples), sketch (the last ones of them), bands."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints = _unpacked(batch.column("packed"))
        sketches = [_pack(f[_first_sample(len(f)) :]) for f in prints]
        keys = batch.column("bands") if "bands" in batch.schema.names else lists([bands(f) for f in prints], pa.int64())
        n = pa.array([len(f) for f in prints], pa.int32())
        return pa.RecordBatch.from_arrays([batch.column("node"), n, pa.array(sketches, pa.binary()), keys], ["node", "n", "sketch", "bands"])

    return arrow_map(nodes, run, "node bigint, n int, sketch binary, bands array<bigint>")


def _laid(sketches: list[bytes], lengths: list[int], width: int) -> np.ndarray:
    """Sketches as digits, one column per sample from the first on; 0 before a sketch's begin."""
    lines = (b"\0" * _first_sample(n) + x.hex().encode() for x, n in zip(sketches, lengths))
    return np.frombuffer(b"".join(x[:width].ljust(width, b"f") for x in lines), np.uint8).reshape(len(sketches), width)


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Weight of the samples in which sketches laid out differ: the whole fingerprints differ by as much at least."""
    return ((a != b) & (a != 0) & (b != 0)) @ _weights(a.shape[1])


def _words(sketches: pa.Array) -> np.ndarray:
    """Sketches as eight 64-bit words, four per block."""
    offsets = np.frombuffer(sketches.buffers()[1], np.int32)[sketches.offset : sketches.offset + len(sketches) + 1].astype(np.int64)
    sizes = np.diff(offsets)
    laid = np.full(len(sketches) * SAMPLES, 0xFF, np.uint8)
    if len(sketches) and offsets[-1] > offsets[0]:
        data = np.frombuffer(sketches.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        laid[np.arange(len(data)) + np.repeat(np.arange(len(sketches)) * SAMPLES - (offsets[:-1] - offsets[0]), sizes)] = data
    return laid.view(np.uint64).reshape(len(sketches), SAMPLES // 8)


def _unlike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of digits in which lines of words differ."""
    x = a ^ b
    x |= x >> np.uint64(1)
    x |= x >> np.uint64(2)
    return np.bitwise_count(x & np.uint64(0x1111111111111111)).sum(1, dtype=np.int64)


class _Sketches:
    """Rows that meet: which pairs of them lengths and sketches don't tell apart; see ``likeness`` and ``_apart``."""

    def __init__(self, sketches: pa.Array, n: np.ndarray, c: np.ndarray, near: float) -> None:
        self.words, self.c, self.least = _words(sketches), c, _least(near)
        self.block, self.total = np.maximum(n // SAMPLES - 1, 0), _total(n)

    def possible(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether rows ``i`` and ``j``, of different components, may be near."""
        ti, tj = self.total[i], self.total[j]
        out = (self.c[i] != self.c[j]) & (np.minimum(ti, tj) >= self.least * np.maximum(ti, tj))
        at = np.flatnonzero(out)
        out[at] = self.apart(i[at], j[at]) <= (1 - self.least) * np.maximum(ti, tj)[at]
        return out

    def apart(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Weight of the samples in which the sketches differ. Those of like lengths begin one block apart at most."""
        turned = self.block[i] > self.block[j]
        i, j = np.where(turned, j, i), np.where(turned, i, j)
        half, block = SAMPLES // 16, self.block[j]
        a, b = self.words[i], self.words[j]
        later = self.block[i] < block
        a[later, :half] = a[later, half:]
        a[later, half:] = ~np.uint64(0)
        return _unlike(a[:, :half], b[:, :half]) * 2.0 ** np.maximum(block - 1, 0) + _unlike(a[:, half:], b[:, half:]) * 2.0**block


def _spread(count: int, linked: Callable[[int, np.ndarray], np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
    """``(root, rows)``: the first row of a component and rows linked to one of its rows that none before it reached."""
    unseen = np.arange(count)
    while len(unseen) > 1:
        root, unseen = int(unseen[0]), unseen[1:]
        ahead = [root]
        while ahead and len(unseen):
            row = ahead.pop()
            hit = linked(row, unseen)
            if hit.any():
                yield root, unseen[hit]
                ahead.extend(unseen[hit].tolist())
                unseen = unseen[~hit]


def _labels(rows: _Sketches, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Per row the first row of its tile that it is connected with by pairs that may be near."""
    label = np.arange(int(sizes.sum()))
    size_of, left = np.repeat(sizes, sizes), np.repeat(starts + sizes, sizes) - label
    few = size_of <= FEW
    pairs = [np.zeros((2, 0), np.int64)]
    for k in range(1, int(sizes[sizes <= FEW].max(initial=1))):
        i = np.flatnonzero(few & (left > k))
        i = i[rows.possible(i, i + k)]
        pairs.append(np.stack([i, i + k]))
    i, j = np.concatenate(pairs, axis=1)
    while len(i):
        least = np.minimum(label[i], label[j])
        if (label[i] == label[j]).all():
            break
        np.minimum.at(label, i, least)
        np.minimum.at(label, j, least)
    for start, size in zip(starts[sizes > FEW].tolist(), sizes[sizes > FEW].tolist()):
        for root, hit in _spread(size, lambda row, others: rows.possible(np.full(len(others), start + row), start + others)):
            label[start + hit] = start + root
    return label


def _met(near: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Groups of rows of a tile that may be near, over rows sorted by tile: the group's name, made from its members, and each member."""

    def groups(rows: pa.Table) -> pa.RecordBatch:
        tile = np.asarray(rows["tile"])
        starts = np.flatnonzero(np.append(True, tile[1:] != tile[:-1]))
        sizes = np.diff(np.append(starts, len(tile)))
        rows = rows.filter(pa.array(np.repeat(sizes > 1, sizes))).combine_chunks()
        sizes = sizes[sizes > 1]
        if not len(sizes):
            return _members_of(np.zeros(0, np.int64), np.zeros(0, np.int64))
        starts, node = np.cumsum(sizes) - sizes, np.asarray(rows["node"])
        c = np.asarray(rows["c"]) if "c" in rows.schema.names else node
        met = _Sketches(rows["sketch"].chunk(0), np.asarray(rows["n"], np.int64), c, near)
        return _members_of(_labels(met, starts, sizes), node)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, count = [], 0
        for batch in batches:
            waiting.append(batch)
            count += batch.num_rows
            if count < ROWS_AT_ONCE:
                continue
            rows = pa.Table.from_batches(waiting)
            tile = np.asarray(rows["tile"])
            whole = int(np.flatnonzero(np.append(True, tile[1:] != tile[:-1]))[-1])
            if whole:
                yield groups(rows.slice(0, whole))
                waiting = rows.slice(whole).combine_chunks().to_batches()
                count -= whole
        if count:
            yield groups(pa.Table.from_batches(waiting))

    return run


def _members_of(label: np.ndarray, node: np.ndarray) -> pa.RecordBatch:
    """Members of the groups of two nodes or more, once each."""
    order = np.lexsort((node, label))
    label, node = label[order], node[order]
    new = np.append(True, (label[1:] != label[:-1]) | (node[1:] != node[:-1]))[: len(label)]
    label, node = label[new], node[new]
    starts = np.flatnonzero(np.append(True, label[1:] != label[:-1])[: len(label)])
    sizes = np.diff(np.append(starts, len(label)))
    names = mixed(np.add.reduceat(mixed(node.view(np.uint64)), starts)).view(np.int64) if len(starts) else node
    kept = np.repeat(sizes > 1, sizes)
    return pa.RecordBatch.from_arrays([pa.array(np.repeat(names, sizes)[kept], pa.int64()), pa.array(node[kept], pa.int64())], ["g", "node"])


def _grouped(rows: DataFrame, near: float) -> DataFrame:
    """``(tile, node, n, sketch)``, with ``c`` or without, to groups ``(g, node)``."""
    return rows.repartition("tile").sortWithinPartitions("tile").mapInArrow(_met(near), "g bigint, node bigint")


def _connected(nodes: list[int], prints: list[str], near: float) -> Iterator[tuple[int, int]]:
    """Pairs that connect all near nodes of a group: the first one of a component with each other one.

    Groups of the same texts in many buckets so give the same pairs over and over, not a tree each.
    """
    if len(nodes) == 2:
        if likeness(*prints) >= near:
            yield nodes[0], nodes[1]
        return
    width = max(map(len, prints))
    laid = np.frombuffer("".join(x.ljust(width, "f") for x in prints).encode(), np.uint8).reshape(len(prints), width)
    weights, ended = _weights(width), laid == _HEX[END]

    def linked(row: int, others: np.ndarray) -> np.ndarray:
        both = ~(ended[others] & ended[row])
        all_of = both @ weights
        share = ((laid[others] == laid[row]) & both) @ weights / np.maximum(all_of, 1)
        return (share - 1 / VALUES) / (1 - 1 / VALUES) >= near

    for root, hit in _spread(len(nodes), linked):
        for other in hit.tolist():
            yield nodes[root], nodes[other]


def _verified(groups: DataFrame, nodes: DataFrame, near: float) -> DataFrame:
    """Pairs ``(a, b)`` that connect the near ones in groups ``(g, node)``, judged by their whole fingerprints."""

    def found(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, members, prints = None, [], []
        for batch in batches:
            pairs: list[tuple[int, int]] = []
            for g, node, fingerprint in zip(batch.column("g").to_pylist(), batch.column("node").to_pylist(), _unpacked(batch.column("packed"))):
                if g != group:
                    if members:
                        pairs.extend(_connected(members, prints, near))
                    group, members, prints = g, [], []
                members.append(node)
                prints.append(fingerprint)
            yield found(pairs)
        if members:
            yield found(list(_connected(members, prints, near)))

    rows = groups.join(nodes.select("node", "packed"), "node").select("g", "node", "packed")
    return rows.repartition("g").sortWithinPartitions("g", "node").mapInArrow(run, "a bigint, b bigint").distinct()


def _slot(sides: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("slot"), "band", "node"), sides).cast("int")


def _sides(count: str) -> Column:
    return F.ceil(F.col(count) / F.lit(TILE)).cast("int")


def _still_split(members: DataFrame) -> DataFrame:
    """Rows of buckets of more than one component, as tiles: tile, node, c.

    Members outside the largest component stand in slots i, all in slots j; a tile is one slot of each.
    """
    sizes = members.groupBy("band", "c").agg(F.count("*").alias("_n"))
    whole = sizes.groupBy("band").agg(F.max_by("c", F.struct("_n", "c")).alias("main"), F.sum("_n").alias("all"), F.max("_n").alias("most"))
    rows = members.join(whole.filter("most < all"), "band").withColumn("outside", F.col("all") - F.col("most"))
    outside, every, zero = _sides("outside"), _sides("all"), F.lit(0)
    tile = F.xxhash64("band", "i", "j").alias("tile")
    ours = rows.filter("c <> main").select("band", _slot(outside).alias("i"), F.explode(F.sequence(zero, every - 1)).alias("j"), "node", "c")
    theirs = rows.select("band", F.explode(F.sequence(zero, outside - 1)).alias("i"), _slot(every).alias("j"), "node", "c")
    return ours.unionByName(theirs).select(tile, "node", "c").distinct()


def _links(nodes: DataFrame, keys: DataFrame, near: float) -> DataFrame:
    """Edges that connect all nodes which share a band and are near."""
    each = F.explode(F.array_distinct("bands")).alias("band")
    large = hold(keys.select(each).groupBy("band").agg(F.count("*").alias("size")).filter(F.col("size") > TILE), "large")
    members = hold(keys.select(each, "node").join(large, "band").select("band", "node"), "members")
    split, groups = not is_empty_table(members), []
    for part in range(SLICES):
        rows = keys.select(each, "node", "n", "sketch").filter(F.pmod("band", F.lit(SLICES)) == part)
        tile = F.col("band")
        if split:
            rows = rows.join(large, "band", "left")
            tile = F.when(F.col("size").isNull(), tile).otherwise(F.xxhash64("band", _slot(_sides("size"))))
        groups.append(hold(_grouped(rows.select(tile.alias("tile"), "node", "n", "sketch"), near), "groups"))
    edges = hold(_verified(reduce(DataFrame.unionByName, groups).distinct(), nodes, near), "edges")
    release(large, *groups)
    if not split:
        return edges
    found = components(edges)
    tagged = hold(members.join(found, "node", "left").select("band", "node", F.coalesce("component", "node").alias("c")), "tagged")
    release(members)
    more = hold(_grouped(_still_split(tagged).join(keys.select("node", "n", "sketch"), "node"), near), "groups")
    stars = found.select(F.col("component").alias("a"), F.col("node").alias("b"))
    links = hold(stars.unionByName(_verified(more.distinct(), nodes, near)), "links")
    release(edges, tagged, more)
    return links


def _classes(prints: DataFrame, near: float) -> DataFrame:
    """``(node, doc_id, packed)``, with ``bands`` or without, to one row per node: node, class_id, bands."""
    ship_package(prints.sparkSession)
    short_batches(prints.sparkSession)
    once = [F.first(c).alias(c) for c in prints.columns if c not in ("node", "doc_id")]
    nodes = hold(prints.groupBy("node").agg(F.min("doc_id").alias("least"), *once), "nodes")
    keys = hold(_keyed(nodes.drop("least")), "keys")
    found = components(_links(nodes, keys, near))
    known = hold(nodes.select("node", "least").join(found, "node", "left").select("node", F.coalesce("component", "node").alias("c"), "least"), "known")
    release(nodes)
    least = known.groupBy("c").agg(F.min("least").alias("class_id"))
    return known.join(least, "c").select("node", "class_id").join(keys.select("node", "bands"), "node")


def classified(prints: DataFrame, near: float = NEAR) -> DataFrame:
    """Rows with ``doc_id``, ``fingerprint`` and ``bands``, and class_id: the least doc_id of the texts linked to this one.

    Two texts are linked if they share a band and their likeness is ``near`` at least. Equal fingerprints are
    one node, named by a 64-bit hash. A class of rows without ids has a null class_id.
    """
    packed = F.unhex(F.when(F.length("fingerprint") % 2 == 1, F.concat("fingerprint", F.lit("f"))).otherwise(F.col("fingerprint")))
    prints = hold(prints.withColumn("node", F.xxhash64("fingerprint")), "prints")
    classes = _classes(prints.select("node", "doc_id", packed.alias("packed"), "bands"), near)
    return prints.join(classes.drop("bands"), "node").drop("node")


def near_classes(prints: DataFrame, near: float = NEAR) -> DataFrame:
    """``(doc_id, fingerprint, bands)`` to ``(doc_id, class_id)``, see ``classified``."""
    return classified(prints.select("doc_id", "fingerprint", "bands"), near).select("doc_id", "class_id")


def fingerprinted_classes(df: DataFrame, doc_id: str = "doc_id", text: str = "text", near: float = NEAR) -> DataFrame:
    """Rows of ``fingerprinted`` with the class_id of ``classified``; what is held between is packed and without bands."""
    prints = hold(_walked(df, doc_id, text).withColumn("node", F.xxhash64("packed")), "prints")
    return _spelled(prints.join(_classes(prints.select("node", "doc_id", "packed"), near), "node"), "bands", "class_id")
