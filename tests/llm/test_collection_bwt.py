import random

import numpy as np
import pytest

from clipstat.llm import collection_bwt as C


def plain(rows):
    """Sorted (doc_id, bytes, removed, spans, kept) of rows (doc_id, text)."""
    first, raws = {}, [(d, (t or "").encode()) for d, t in rows]
    for d, raw in raws:
        for i in range(len(raw) - 49 if d is not None else 0):
            w = raw[i : i + 50]
            first[w] = min(d, first.get(w, d))
    out = []
    for d, raw in raws:
        gone = np.zeros(len(raw) + 1, bool)
        for i in range(len(raw) - 49 if d is not None else 0):
            if first[raw[i : i + 50]] < d:
                gone[i : i + 50] = True
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((d, len(raw), int(gone.sum()), int((gone[1:] > gone[:-1]).sum() + gone[0]), kept))
    return sorted(out, key=repr)


def as_rows(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in df.collect()), key=repr)


def test_suffix_order_and_common_prefixes():
    rng = random.Random(3)
    strings = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(0, 9))) for _ in range(40)] + [b"", b"abab", b"abab"]
    c = C.Collection(strings)
    suffixes = sorted((s[len(s) - n :], k) for k, s in enumerate(strings) for n in range(len(s) + 1))
    # Empty suffixes stand in order of the strings; equal suffixes in order of what ends them, which is the string.
    assert len(c.transform) == len(suffixes)
    places = {(int(k), size): int(p) for size, ks, at in c.places() for k, p in zip(ks, at)}
    found = sorted((p, strings[k][len(strings[k]) - size :]) for (k, size), p in places.items())
    assert [s for _, s in found] == [s for s, _ in suffixes if s]
    assert [p for p, _ in found] == list(range(len(strings), len(suffixes)))
    texts = [s for s, _ in suffixes]
    for i in range(1, len(texts)):
        n = 0
        while n < min(len(texts[i]), len(texts[i - 1])) and texts[i][n] == texts[i - 1][n]:
            n += 1
        assert c.common[i] == n, i


def test_segments_hold_every_window_once():
    rng = random.Random(8)
    texts = [bytes(rng.choice(b"abc d") for _ in range(n)) for n in (0, 49, 50, 51, 300, 2000)] + [b"=" * 500, None]
    seen = {k: [] for k in range(len(texts))}
    for group in C.blocks(texts):
        runs = C.Runs(group, C.Powers())
        for i in range(len(runs.start)):
            row, place, n = int(runs.row[i]), int(runs.place[i]), int(runs.windows[i])
            assert 1 <= n <= C.SPAN and runs.bytes_of(i) == texts[row][place : place + n + 49]
            seen[row] += range(place, place + n)
    assert all(sorted(found) == list(range(max(0, len(texts[k] or b"") - 49))) for k, found in seen.items())


def test_given_documents_equal_brute_force(documents, rows_of):
    assert as_rows(C.without_repeated_bytes(documents)) == plain(list(rows_of.items()))


@pytest.fixture(scope="module")
def repeated(prose):
    passage, rows = prose(40, 77), []
    for i in range(60):
        rows.append((i % 50, prose(20, 200 + i) + " " + passage[i % 5 :] + " " + prose(15, 300 + i % 7)))
    return rows + [(60, "=" * 400), (61, "x" + "=" * 120), (62, "ab" * 90), (63, "b" + "ab" * 60), (64, passage), (65, passage)]


@pytest.mark.parametrize("crowd", [0, 20_000])
def test_small_blocks_and_crowds_give_the_same(spark, repeated, monkeypatch, crowd):
    for name, value in (("BLOCK", 64), ("FLUSH", 50), ("PER_BUCKET", 40), ("COLLECTION", 5), ("GROUP_ROWS", crowd), ("UNEVEN", 0)):
        monkeypatch.setattr(C, name, value)
    df = spark.createDataFrame(repeated, "doc_id bigint, text string")
    assert as_rows(C.without_repeated_bytes(df)) == plain(repeated)


def test_odd_rows(odd, odd_rows):
    assert as_rows(C.without_repeated_bytes(odd)) == plain([(r[0], r[1]) for r in odd_rows])


def test_empty(none):
    assert C.without_repeated_bytes(none).count() == 0
