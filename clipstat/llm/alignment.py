"""Alignment of two tokenizers by interval coalescing.

Tokens of both vocabularies are byte intervals of the same text. All intervals are sorted by start; the
running maximum of their ends says how far the text is covered, and a group ends where the next start
reaches it, which is where both tokenizers have a border. Inside a group the tokens overlap, and its last
A and B token end together: they are linked.

Both tokenizers always cut at a plain space after a character that is no white space: the byte-level
pattern starts a new piece there, and no piece of the other vocabulary holds its space mark after another
character (checked when the file is read). So a group never crosses such a border, the stretches between
are aligned on their own, all new ones of a batch at once, and remembered up to a bound. Texts with
white space on which regular expression libraries differ, and texts with a stretch that does not come
back byte for byte, go to both libraries whole.

Two linked tokens end together, so one's bytes are the end of the other's. That bounds the number of
different pairs by the vocabularies (``most_pairs``), whatever the corpus: the corpus-wide counts of
pairs are summed by Spark and handed to the tasks as one array.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipstat.llm.common import arrow_map, hold, texts_of
from clipstat.llm.tokens import ODD_SPACE
from clipstat.session import ship_package

#: A stretch: white space, other characters, and what follows up to a plain space.
_STRETCH = re.compile(r"\s*\S+(?:(?! )\s+(?:\S+|\Z))*|\s+")
_ODD = re.compile(ODD_SPACE)
_ODD_BORDER = re.compile(r"\s ")
#: Characters of a text that are cut into stretches at a time, and characters of texts that are aligned together.
PART, GROUP = 1 << 20, 1 << 21
#: Stretches remembered per worker, and the longest one remembered.
REMEMBERED, LONGEST = 150_000, 200
#: Distinct links of a task that are summed before the next are taken in.
SUMMED = 4_000_000
#: A pair of ids as one number: the A id above the B id.
B_BITS = 15


class Vocabularies:
    """Both libraries with the bytes of every token; needs at most ``2 ** B_BITS`` B ids."""

    def __init__(self, path_a: str, path_b: str) -> None:
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        shown = {c: bytes([b]) for b, c in _shown_bytes().items()}
        named = {i: t for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.bytes_a = [b"".join(shown.get(c, c.encode()) for c in named.get(i, "")) for i in range(max(named) + 1)]
        self.pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [self._piece_bytes(i, p) for i, p in enumerate(self.pieces)]
        self.size_a, self.size_b = (np.array([len(t) for t in v], np.int64) for v in (self.bytes_a, self.bytes_b))
        #: Whether no piece crosses a space after another character.
        self.cut_at_spaces = not any(re.search("[^▁]▁", p) for p in self.pieces)
        if len(self.bytes_b) > 1 << B_BITS or len(self.bytes_a) > 1 << (32 - B_BITS):
            raise ValueError("too many ids for a pair in 32 bits")

    def _piece_bytes(self, i: int, piece: str) -> bytes:
        if self.b.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return b"" if self.b.is_control(i) else piece.replace("▁", " ").encode()

    def encoded(self, stretches: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of each stretch, which stands after the space that A is given and B adds."""
        a = [e.ids for e in self.a.encode_batch_fast([" " + s for s in stretches], add_special_tokens=False)]
        return a, self.b.encode(stretches, num_threads=1)


def _shown_bytes() -> dict[int, str]:
    """How a byte-level vocabulary writes bytes: printable ones as they are, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


@lru_cache(maxsize=2)
def vocabularies(path_a: str, path_b: str) -> Vocabularies:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Vocabularies(path_a, path_b)


def most_pairs(path_a: str, path_b: str) -> int:
    """How many pairs of ids can ever end together: one token's bytes are the end of the other's."""
    v = vocabularies(path_a, path_b)
    found = set()
    for one, other, flip in ((v.bytes_a, v.bytes_b, False), (v.bytes_b, v.bytes_a, True)):
        ids: dict[bytes, list[int]] = {}
        for i, token in enumerate(other):
            ids.setdefault(token, []).append(i)
        for i, token in enumerate(one):
            for k in range(len(token)):
                for j in ids.get(token[k:], ()):
                    found.add((j, i) if flip else (i, j))
    return len(found)


def coalesced(start_a: np.ndarray, end_a: np.ndarray, start_b: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of every A and every B interval, numbered from 0."""
    start, end = np.concatenate([start_a, start_b]), np.concatenate([end_a, end_b])
    order = np.lexsort((end, start))
    reach = np.maximum.accumulate(end[order])
    opens = np.zeros(len(order), np.int64)
    opens[1:] = start[order][1:] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(opens)
    return group[: len(start_a)], group[len(start_a) :]


@lru_cache(maxsize=4)
def _digits(n: int) -> np.ndarray:
    """Ids in decimal, one row each, padded with zero bytes and with room for a sign."""
    return np.array([str(i).encode() for i in range(n)], f"S{len(str(n)) + 1}").view(np.uint8).reshape(n, -1)


def _written(v: Vocabularies, ids_a, group_a, ids_b, group_b) -> tuple[bytes, np.ndarray]:
    """All groups as text, each with its last sign, and the ends of the groups in it."""
    width = _digits(max(len(v.bytes_a), len(v.bytes_b)))
    ids, group = np.concatenate([ids_a, ids_b]), np.concatenate([group_a, group_b])
    side = np.repeat([0, 1], [len(ids_a), len(ids_b)])
    order = np.argsort(2 * group + side, kind="stable")
    group, side = group[order], side[order]
    last = np.ones(len(order), bool)
    last[:-1] = (group[1:] != group[:-1]) | (side[1:] != side[:-1])
    rows = width[ids[order]].copy()
    size = (rows != 0).sum(1)
    rows[np.arange(len(rows)), size] = np.where(last, np.where(side == 0, ord("|"), ord(";")), ord(","))
    ends = np.cumsum(size + 1)[last & (side == 1)]
    return rows[rows != 0].tobytes(), ends


#: What is known of a stretch: A tokens, B tokens, groups, the groups as text, its links as packed numbers.
Aligned = tuple[int, int, int, bytes, bytes]


def aligned(v: Vocabularies, stretches: list[str]) -> list[Aligned | None]:
    """Each stretch's alignment; None where the tokens' bytes are not the text's."""
    listed_a, listed_b = v.encoded(stretches)
    good = []
    for s, a, b in zip(stretches, listed_a, listed_b):
        raw = b" " + s.encode()
        good.append(b"".join(map(v.bytes_a.__getitem__, a)) == raw and b"".join(map(v.bytes_b.__getitem__, b)) == raw)
    n_a = np.array([len(x) * g for x, g in zip(listed_a, good)], np.int64)
    n_b = np.array([len(x) * g for x, g in zip(listed_b, good)], np.int64)
    ids_a = np.array([i for x, g in zip(listed_a, good) if g for i in x], np.int64)
    ids_b = np.array([i for x, g in zip(listed_b, good) if g for i in x], np.int64)
    if not len(ids_a):
        return [None] * len(stretches)
    end_a, end_b = np.cumsum(v.size_a[ids_a]), np.cumsum(v.size_b[ids_b])
    group_a, group_b = coalesced(end_a - v.size_a[ids_a], end_a, end_b - v.size_b[ids_b], end_b)
    last_a = np.append(np.flatnonzero(np.diff(group_a)), len(group_a) - 1)
    last_b = np.append(np.flatnonzero(np.diff(group_b)), len(group_b) - 1)
    links = ((ids_a[last_a] << B_BITS) | ids_b[last_b]).astype("<u4").tobytes()
    text, ends = _written(v, ids_a, group_a, ids_b, group_b)
    upto = np.zeros(len(stretches) + 1, np.int64)  # groups before each stretch
    upto[1:] = np.append(group_a, -1)[np.cumsum(n_a) - 1] + 1
    at = np.append(0, ends)[upto]
    out: list[Aligned | None] = []
    for k, fine in enumerate(good):
        lo, hi = int(upto[k]), int(upto[k + 1])
        out.append((int(n_a[k]), int(n_b[k]), hi - lo, text[at[k] : at[k + 1] - 1], links[4 * lo : 4 * hi]) if fine else None)
    return out


class Stretches(dict):
    """Alignments by stretch, up to a bound."""

    def learn(self, v: Vocabularies, wanted: set[str]) -> dict[str, Aligned | None]:
        """Aligns what is new, all at once; returns what is too long to remember."""
        new = [s for s in wanted if s not in self]
        if len(self) + len(new) > REMEMBERED:
            self.clear()
            new = list(wanted)
        found = dict(zip(new, aligned(v, new))) if new else {}
        self.update((s, x) for s, x in found.items() if len(s) <= LONGEST)
        return {s: x for s, x in found.items() if len(s) > LONGEST}


def parts_of(text: str) -> Iterator[str]:
    """A text in parts of about ``PART`` characters, cut at (and without) plain spaces after other characters."""
    start = 0
    while len(text) - start > PART:
        cut = text.find(" ", start + PART)
        while cut > 0 and text[cut - 1].isspace():
            cut = text.find(" ", cut + 1)
        if cut < 0:
            break
        yield text[start:cut]
        start = cut + 1
    yield text[start:]


def stretches_of(part: str) -> list[str]:
    """Stretches of a part without the plain space before each."""
    if part[:1] == " " or _ODD_BORDER.search(part):
        return [s[1:] for s in _STRETCH.findall(" " + part)]
    return part.split(" ")


class Summary:
    """What one document's stretches add up to."""

    def __init__(self) -> None:
        self.n_a = self.n_b = self.n_groups = 0
        self.text, self.links = hashlib.sha256(), []

    def add(self, found: list[Aligned]) -> None:
        n_a, n_b, n_groups, texts, links = zip(*found)
        if self.n_groups:
            self.text.update(b";")
        self.n_a += sum(n_a)
        self.n_b += sum(n_b)
        self.n_groups += sum(n_groups)
        self.text.update(b";".join(texts))
        pairs, times = np.unique(np.frombuffer(b"".join(links), "<u4"), return_counts=True)
        self.links.append((pairs, times))

    def row(self) -> tuple[int, int, int, str, bytes, bytes]:
        if not self.n_groups:
            return 0, 0, 0, "", b"", b""
        pairs, times = self.links[0] if len(self.links) == 1 else summed(self.links)
        return self.n_a, self.n_b, self.n_groups, self.text.hexdigest(), pairs.astype("<u4").tobytes(), times.astype("<u4").tobytes()


def summed(counted: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Several counts as one."""
    pairs, place = np.unique(np.concatenate([p for p, _ in counted]), return_inverse=True)
    times = np.zeros(len(pairs), np.int64)
    np.add.at(times, place, np.concatenate([t for _, t in counted]))
    return pairs, times


def _whole(v: Vocabularies, text: str) -> Summary:
    out = Summary()
    found = aligned(v, [text])
    if found[0]:
        out.add(found)
    return out


def summaries(texts: list[str | None], v: Vocabularies, known: Stretches) -> list[Summary]:
    """One summary per text; texts are taken in groups of about ``GROUP`` characters."""
    out, group, size = [Summary() for _ in texts], [], 0

    def flush() -> None:
        longer = known.learn(v, set().union(*(s for _, s in group)))
        get = (lambda s: longer[s] if s in longer else known[s]) if longer else known.__getitem__
        for k, stretches in group:
            found = list(map(get, stretches)) if out[k] is not None else [None]
            if None in found:
                out[k] = None
            else:
                out[k].add(found)
        group.clear()

    for k, text in enumerate(texts):
        if not text:
            continue
        if not v.cut_at_spaces or _ODD.search(text):
            out[k] = None
            continue
        for part in parts_of(text):
            group.append((k, stretches_of(part)))
            size += len(part)
            if size >= GROUP:
                flush()
                size = 0
    if group:
        flush()
    return [_whole(v, texts[k]) if s is None else s for k, s in enumerate(out)]


def alignments(df: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, groups_sha256, and the distinct links with how often each occurs, packed."""
    ship_package(df.sparkSession)
    known = Stretches()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = summaries(batch.column("text").to_pylist(), vocabularies(path_a, path_b), known)
        columns = zip(*(s.row() for s in found)) if found else [[]] * 6
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary())
        names = ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "times"]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds))], names)

    return arrow_map(df, run, "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, pairs binary, times binary")


def pair_counts(found: DataFrame) -> DataFrame:
    """Corpus-wide: pair, n. Tasks sum before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for pairs, times in zip(batch.column("pairs").to_pylist(), batch.column("times").to_pylist()):
                held.append((np.frombuffer(pairs, "<u4"), np.frombuffer(times, "<u4").astype(np.int64)))
                size += len(held[-1][0])
                if size > SUMMED:
                    held = [summed(held)]
                    size = len(held[0][0])
        if held:
            pairs, times = summed(held)
            yield pa.RecordBatch.from_arrays([pa.array(pairs.astype(np.int64)), pa.array(times)], ["pair", "n"])

    return found.select("pairs", "times").mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))


def aligned_documents(df: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Null and empty texts, and texts that a tokenizer does not give back byte for byte, have no tokens:
    zeros and an empty ``groups_sha256``. Repeated rows count each; a null doc_id is kept as it is.
    Extra columns are not read. Very long texts are aligned in parts that end at stretches.
    """
    found = hold(alignments(texts_of(df, doc_id, text), path_a, path_b), "aligned")
    counts = pair_counts(found).toArrow()
    if counts.num_rows > most_pairs(path_a, path_b):
        raise ValueError("linked tokens that do not end alike")
    order = np.argsort(counts.column("pair").to_numpy())
    pairs, n = counts.column("pair").to_numpy()[order], counts.column("n").to_numpy()[order]
    most = np.zeros(1 << B_BITS, np.int64)
    np.maximum.at(most, pairs & ((1 << B_BITS) - 1), n)
    best = n == most[pairs & ((1 << B_BITS) - 1)]
    pairs = pairs.astype("<u4")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sums, firsts = [], []
        for packed, counted in zip(batch.column("pairs").to_pylist(), batch.column("times").to_pylist()):
            at, times = np.searchsorted(pairs, np.frombuffer(packed, "<u4")), np.frombuffer(counted, "<u4").astype(np.int64)
            sums.append(int((n[at] * times).sum()))
            firsts.append(int(times[best[at]].sum()))
        told = [batch.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "groups_sha256")]
        return pa.RecordBatch.from_arrays(
            [*told, pa.array(firsts, pa.int64()), pa.array(sums, pa.int64())],
            ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "n_best", "count_sum"],
        )

    out = arrow_map(found, run, "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, n_best bigint, count_sum bigint")
    return out.select("doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best", "count_sum", "groups_sha256")
