import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clipstat.llm import near_dedup as N
from clipstat.llm.common import WordHashes
from clipstat.llm.components import components
from tests.llm.plain import near_components, shingles


def as_dict(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_given_documents_equal_brute_force(documents, rows_of):
    out = N.near_duplicates(documents)
    assert as_dict(out) == near_components(rows_of)
    assert all(r.kept == (r.doc_id == r.component_id) for r in out.collect())


def test_odd_rows(odd, odd_rows):
    out = N.near_duplicates(odd).collect()
    assert len(out) == len(odd_rows)
    want = near_components({r[0]: r[1] for r in odd_rows if r[0] is not None})
    for r in out:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id]
    assert want[6][1] == 4 and want[7][1] == 4 and want[9][1] == 8 and want[2] == (0, 2)


def test_empty(none):
    assert N.near_duplicates(none).count() == 0


@pytest.fixture(scope="module")
def chain(prose):
    """Texts around one passage, and a chain of texts each near the next but not the first."""
    passage = prose(90, 50)
    rows = [(i, prose(60, 100 + i) + " " + passage) for i in range(90)]
    text = prose(100, 300).split()
    for i in range(12):
        rows.append((1000 + i, " ".join(text)))
        text[8 * i + 3] = f"changed{i}"
    return rows


def test_crowded_buckets_lose_no_link(spark, chain):
    assert as_dict(N.near_duplicates(spark.createDataFrame(chain, "doc_id bigint, text string"))) == near_components(dict(chain))


def test_a_crowd_round_one_passage_equals_brute_force(spark, prose):
    """Texts whose similarity lies on both sides of the threshold, all through one passage: no link needs a shared band."""
    rows = []
    for i in range(300):
        passage = prose(100, 900 + i % 3)
        rows.append((i, prose(4 + i % 23, 5000 + i // 2) + " " + passage))
    split = spark.createDataFrame(rows, "doc_id bigint, text string")
    sets = N.sets_of(split).join(N.sketches(split).select("set_id", F.col("doc_id").alias("node"), F.col("n_shingles").alias("n")), "set_id")
    members = N.hold(sets.select("node", "n", F.col("node").alias("c")), "members")
    found = N._by_rare_shingles(members, N.hold(sets.select("node", "items"), "sets"))
    got = {r.node: r.component for r in components(found).collect()}
    want = {d: c for d, (_, c) in near_components(dict(rows)).items()}
    assert {d: got.get(d, d) for d in want} == want and len(set(want.values())) > 3
    prefixes = N._rare_prefixes(members, sets.select("node", "items"))
    assert prefixes.count() < 300 * 60


def drawn(n, seed):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(900)}" for _ in range(n))


def linked_and_compared(spark, monkeypatch, rows):
    """Components by rare shingles alone, every text a component before, and how many pairs were compared."""
    split = spark.createDataFrame(rows, "doc_id bigint, text string")
    sizes = N.sketches(split).select("set_id", F.col("doc_id").alias("node"), F.col("n_shingles").alias("n"))
    sets = N.sets_of(split).dropDuplicates(["set_id"]).join(sizes, "set_id")
    members = N.hold(sets.select("node", "n", F.col("node").alias("c")), "members")
    compared, verified = [], N._verified

    def counted(pairs, sets):
        compared.append(pairs.count())
        return verified(pairs, sets)

    monkeypatch.setattr(N, "_verified", counted)
    found = components(N._by_rare_shingles(members, N.hold(sets.select("node", "items"), "sets")))
    got = {r.node: r.component for r in found.collect()}
    return {d: got.get(d, d) for d, _ in rows}, sum(compared)


def test_a_crowd_with_words_of_their_own_is_not_compared(spark, monkeypatch):
    """One passage makes up over three quarters of each text, but no two of them are linked."""
    passage = drawn(100, 70)
    rows = [(i, drawn(20 + i % 11, 9000 + i) + " " + passage) for i in range(120)]
    assert {d: c for d, (_, c) in near_components(dict(rows)).items()} == {i: i for i in range(120)}
    assert linked_and_compared(spark, monkeypatch, rows) == ({i: i for i in range(120)}, 0)


def test_crowds_on_both_sides_of_the_threshold_equal_brute_force(spark, monkeypatch):
    """Own words before, inside and behind one of three passages; some own words are another text's too."""
    rows = []
    for i in range(240):
        passage = drawn(100, 40 + i % 3).split()
        passage[50 + i % 7 : 50 + i % 7] = drawn(i % 5, 700 + i).split()
        rows.append((i, " ".join([drawn(3 + i % 29, 5000 + i // 2), *passage, drawn(i % 4, 800 + i)])))
    want = {d: c for d, (_, c) in near_components(dict(rows)).items()}
    assert 10 < len(set(want.values())) < 200
    assert linked_and_compared(spark, monkeypatch, rows)[0] == want


def test_sketch_fills_every_bin_and_estimates(prose):
    hashes = WordHashes()
    rng = np.random.default_rng(1)
    for n in (1, 3, 40, 5000):
        items = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        sketch = N.sketch(items)
        assert len(sketch) == N.BINS and (sketch != np.uint64(0xFFFFFFFFFFFFFFFF)).all()
    a = rng.integers(0, 1 << 63, 1000).astype(np.uint64)
    b = np.concatenate([a[:800], rng.integers(0, 1 << 63, 200).astype(np.uint64)])
    same = (N.sketch(np.unique(a)) == N.sketch(np.unique(b))).mean()
    assert abs(same - 800 / 1200) < 0.12
    text = prose(80, 9)
    assert len(N.shingle_set(text.encode(), hashes)) == len(shingles(text))


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(40)] + [(7, 7), (200, 199)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert {found[i] for i in range(31)} == {0} and {found[100 + i] for i in range(40)} == {100}
    assert found[200] == 199 and 300 not in found
