import hashlib

import pytest

from clipstat.llm import edit_fingerprints as E
from tests.llm.conftest import SF
from clipstat.llm import queries


def expected(rows):
    """(doc_id, text) in order -> doc_id -> (n_chars, digest of the edited text)."""
    out = {}
    for i, (d, t) in enumerate(rows):
        k = len(t) // 4
        out[d] = (len(t), hashlib.sha256((t[: len(t) - k] + rows[(i + 1) % len(rows)][1][:k]).encode()).hexdigest())
    return out


def prints(*texts):
    return E.fingerprints([E.symbols(t) for t in texts])


def test_given_documents(spark, rows_of):
    rows = queries.op5_fingerprints(spark, SF).collect()
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in rows} == expected(sorted(rows_of.items()))
    own = dict(zip(rows_of, prints(*rows_of.values())))
    assert all(r.fingerprint == own[r.doc_id] for r in rows)
    order = {d: sorted(own)[(k + 1) % len(own)] for k, d in enumerate(sorted(own))}
    for r in rows:
        assert r.near_next == E.likeness(own[r.doc_id], own[order[r.doc_id]]) and r.near_edited == E.likeness(own[r.doc_id], r.edited_fingerprint)
    long = [r for r in rows if r.n_chars > 300]
    assert min(r.near_edited for r in long) > 0.6 and sorted(r.near_next for r in long)[len(long) // 2] < 0.2


def test_small_groups_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(E, "GROUP_CHARS", 1)
    first = next(E._walk(iter(_batches())))
    monkeypatch.setattr(E, "GROUP_CHARS", 10**9)
    assert first.column("edited_sha256")[0] == next(E._walk(iter(_batches()))).column("edited_sha256")[0]


def _batches():
    import pyarrow as pa

    yield pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3], "part": [0, 0, 0], "look": [0, 0, 1], "text": ["abcd" * 9, "xyz" * 9, "mmm"]})


def test_edits_cost_little_and_equal_texts_nothing(prose):
    a = prose(600, 1)
    words = a.split()
    inserted = " ".join(words[:100] + ["new", "words"] + words[100:])
    one, two, three, other, none = prints(a, a, inserted, prose(600, 2), "")
    assert one == two and E.likeness(one, two) == 1 and none == "" and E.likeness("", "") == 1
    assert E.likeness(one, three) > 0.7 > 0.3 > E.likeness(one, other) and E.likeness(one, none) == 0


@pytest.mark.parametrize("ranges", [1, 4])
def test_odd_rows(odd, odd_rows, none, monkeypatch, ranges):
    monkeypatch.setattr(E, "RANGES", ranges)
    rows = E.fingerprinted(odd).collect()
    assert len(rows) == len(odd_rows)
    chain = sorted(((r[0] is None, r[0], r[1] or "") for r in odd_rows), key=lambda r: (r[0], r[1] or 0, r[2]))
    texts = [t for _, _, t in chain]
    want = []
    for i, t in enumerate(texts):
        k = len(t) // 4
        want.append((len(t), hashlib.sha256((t[: len(t) - k] + texts[(i + 1) % len(texts)][:k]).encode()).hexdigest()))
    assert sorted((r.n_chars, r.edited_sha256) for r in rows) == sorted(want)
    assert E.fingerprinted(none).count() == 0


def test_one_row_follows_itself(spark):
    row = E.fingerprinted(spark.createDataFrame([(3, "abcdefgh")], "doc_id bigint, text string")).first()
    assert row.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and row.near_next == 1


def test_near_classes(spark, prose):
    base = prose(500, 1)
    texts = {1: base, 2: base, 3: base.replace(" kan", " kon", 2), 4: prose(500, 2), 5: "", 6: prose(3, 1)}
    df = E.fingerprinted(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string"))
    got = {r.doc_id: r.class_id for r in E.near_classes(df.select("doc_id", "fingerprint", "bands")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 6}


def brute_classes(rows):
    """(doc_id, fingerprint) -> doc_id -> least doc_id reached over all pairs that share a band and are near."""
    up = {d: d for d, _ in rows}

    def root(d):
        while up[d] != d:
            d = up[d]
        return d

    keys = {d: set(E.bands(f).tolist()) for d, f in rows}
    for k, (a, fa) in enumerate(rows):
        for b, fb in rows[:k]:
            if fa == fb or keys[a] & keys[b] and E.likeness(fa, fb) >= E.NEAR:
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {d: root(d) for d, _ in rows}


def test_query_returns_classes(spark):
    rows = queries.op5_fingerprints(spark, SF).collect()
    assert {r.doc_id: r.class_id for r in rows} == brute_classes([(r.doc_id, r.fingerprint) for r in rows])


@pytest.mark.parametrize("tile", [3, 512])
def test_groups_around_a_far_head_are_linked(spark, monkeypatch, tile):
    """Buckets of one common key: a head far from all, pairs of near copies, a chain, a large component, loners."""
    import random

    monkeypatch.setattr(E, "TILE", tile)
    rng = random.Random(3)
    fresh = lambda n: "".join(rng.choice("0123456789abcde") for _ in range(n))
    changed = lambda f, n: "".join(rng.choice("0123456789abcde") if i in rng.sample(range(len(f)), n) else x for i, x in enumerate(f))
    prints = [fresh(200) for _ in range(25)]
    prints += [x for f in prints[:8] for x in (changed(f, 1), changed(f, 1))]
    big = fresh(180)
    prints += [changed(big, 1) for _ in range(12)] + [fresh(n) for n in (5, 40, 90, 400)]
    rows = list(enumerate(prints))
    keys = {d: [7] for d, _ in rows}
    df = spark.createDataFrame([(d, f, keys[d]) for d, f in rows], "doc_id bigint, fingerprint string, bands array<bigint>")
    monkeypatch.setattr(E, "bands", lambda f: E.np.array([7]))
    want = brute_classes(rows)
    assert {r.doc_id: r.class_id for r in E.near_classes(df).collect()} == want
    assert len(set(want.values())) == 25 + 1 + 4


def test_short_texts_share_bands(spark):
    texts = {k: t for k, t in enumerate(["good morning to all of you", "good morning to all of yov", "see you", "see yoo", "entirely other words here now", "good morning to all of you!", "a", "b", "ab", ""])}
    rows = list(zip(texts, prints(*texts.values())))
    assert all(len(f) < 128 for _, f in rows)
    near = [(a, b) for a, fa in rows for b, fb in rows if a < b and fa != fb and E.likeness(fa, fb) >= E.NEAR]
    of = dict(rows)
    assert (0, 1) in near and all(set(E.bands(of[a]).tolist()) & set(E.bands(of[b]).tolist()) for a, b in near)
    df = E.fingerprinted(spark.createDataFrame(list(texts.items()) + [(None, texts[0]), (None, "an own text without id")], "doc_id bigint, text string"))
    got = E.near_classes(df).collect()
    assert {r.doc_id: r.class_id for r in got if r.doc_id is not None} == brute_classes(rows)
    assert sorted((r.class_id is None, r.class_id) for r in got if r.doc_id is None) == [(False, 0), (True, None)]


def _fresh(rng, n):
    return "".join(rng.choice("0123456789abcde") for _ in range(n))


def test_sketches_tell_no_near_texts_apart():
    import random

    rng, np = random.Random(11), E.np
    near = far = dropped = 0
    for _ in range(3000):
        n = rng.choice([1, 3, 20, 63, 64, 65, 120, 128, 150, 191, 192, 193, 300, 447, 448, 449, 520])
        a = _fresh(rng, n)
        m = rng.choice([0, 0.1, 0.2, 0.23, 0.3, 1])
        b = "".join(rng.choice("0123456789abcde") if rng.random() < m else x for x in a)[: max(1, n - rng.choice([0, 0, 1, 9, 40]))] + _fresh(rng, rng.choice([0, 0, 5, 30]))
        lengths = [len(a), len(b)]
        laid = [E._laid([E._pack(f[E._first_sample(len(f)) :])], [len(f)], max(lengths)) for f in (a, b)]
        possible = E._apart(*laid)[0] <= (1 - E._least(E.NEAR)) * E._total(np.int64(max(lengths)))
        whole = E._total(np.array(lengths))
        assert whole.tolist() == [E._weights(k).sum() for k in lengths]
        if E.likeness(a, b) >= E.NEAR:
            near += 1
            assert possible and min(whole) >= E._least(E.NEAR) * max(whole)
        elif m == 1 and min(lengths) > 200:
            far += 1
            dropped += not possible
    assert near > 500 and far > 100 and dropped > 0.97 * far


def test_unlike_texts_that_share_a_band_carry_no_whole_fingerprints(spark, monkeypatch):
    import random

    rng, seen, whole = random.Random(12), [], E._verified
    monkeypatch.setattr(E, "_verified", lambda pairs, *more: (seen.append(pairs.count()), whole(pairs, *more))[1])
    rows = [(d, _fresh(rng, 250), [7]) for d in range(150)]
    rows += [(d, rows[d - 150][1][:-1] + "0", [7]) for d in range(150, 153)]
    df = spark.createDataFrame(rows, "doc_id bigint, fingerprint string, bands array<bigint>")
    got = {r.doc_id: r.class_id for r in E.near_classes(df).collect()}
    assert got == {d: d if d < 150 else d - 150 for d, *_ in rows} and sum(seen) <= 10


def test_held_rows_are_packed_and_without_bands(spark, monkeypatch):
    held, hold = {}, E.hold
    monkeypatch.setattr(E, "hold", lambda df, name: (held.setdefault(name, dict(df.dtypes)), hold(df, name))[1])
    rows = queries.op5_fingerprints(spark, SF)
    assert rows.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "bands", "class_id"]
    assert not set(held["prints"].values()) & {"string", "array<bigint>"} and "packed" not in held["members"]
    r = rows.filter("n_chars > 300").first()
    assert r.bands == E.bands(r.fingerprint).tolist()


def _near(rng, f, n):
    at = rng.sample(range(len(f)), n)
    return "".join(rng.choice("0123456789abcde") if i in at else x for i, x in enumerate(f))


@pytest.mark.parametrize("tile", [16, 512])
def test_near_copies_away_from_the_first_member_stay_as_many_rows(spark, monkeypatch, tile):
    """60 copies that are near each other, not the least of their bucket: rows for verification and edges grow with them, not with their square."""
    import random

    import xxhash

    rng, seen, whole, linked, components = random.Random(13), [], E._verified, [], E.components
    monkeypatch.setattr(E, "TILE", tile)
    monkeypatch.setattr(E, "_verified", lambda pairs, *more: (seen.append(pairs.count()), whole(pairs, *more))[1])
    monkeypatch.setattr(E, "components", lambda edges: (linked.append(edges.count()), components(edges))[1])
    base = _fresh(rng, 250)
    copies = list({_near(rng, base, 3) for _ in range(60)})
    node = lambda f: E.np.uint64(xxhash.xxh64_intdigest(f.encode(), 42)).astype(E.np.int64)
    head = _fresh(rng, 250)
    while node(head) > min(map(node, copies)):
        head = _fresh(rng, 250)
    rows = list(enumerate([*copies, head]))
    df = spark.createDataFrame([(d, f, [7, 8, 9]) for d, f in rows], "doc_id bigint, fingerprint string, bands array<bigint>")
    got = {r.doc_id: r.class_id for r in E.near_classes(df).collect()}
    assert got == {d: 0 if f != head else d for d, f in rows}
    assert sum(seen) <= 4 * len(rows) and max(linked) <= 4 * len(rows)


def test_words_tell_what_digits_tell():
    """Pairs of like lengths, sketches packed in words, against the plain form; trees of a group against all its pairs."""
    import random

    import pyarrow as pa

    rng, np = random.Random(14), E.np
    texts = [_fresh(rng, rng.choice([1, 5, 63, 64, 65, 127, 128, 129, 191, 192, 200, 255, 256, 300])) for _ in range(80)]
    texts += [_near(rng, f, len(f) // 6) + _fresh(rng, rng.choice([0, 0, 3, 20])) for f in texts]
    packed, n = [E._pack(f[E._first_sample(len(f)) :]) for f in texts], np.array([len(f) for f in texts])
    rows = E._Sketches(pa.array([b"x", *packed], pa.binary())[1:], n, np.arange(len(n)), E.NEAR)
    i, j = (x.ravel() for x in np.indices((len(n), len(n))))
    total = E._total(n)
    like = np.minimum(total[i], total[j]) >= E._least(E.NEAR) * np.maximum(total[i], total[j])
    i, j = i[like], j[like]
    laid = E._laid(packed, n.tolist(), 320)
    assert (rows.apart(i, j) == E._apart(laid[i], laid[j])).all()
    near = {(a, b) for a, b in zip(i.tolist(), j.tolist()) if a != b and E.likeness(texts[a], texts[b]) >= E.NEAR}
    assert len(near) > 50 and all(rows.possible(np.array([a]), np.array([b]))[0] for a, b in near)
    up = dict(enumerate(range(len(n))))
    for a, b in E._connected(list(up), texts, E.NEAR):
        assert up[a] == a and up[b] == b
        up[b] = a
    want = {d: d for d in up}
    for _ in up:
        for a, b in near:
            want[a] = want[b] = min(want[a], want[b])
    assert up == want
