import re

import numpy as np
import pytest

from clipstat.llm import license_scan as L
from clipstat.llm import queries
from clipstat.llm.common import WordHashes
from clipstat.llm.license_texts import TEMPLATES
from tests.llm.conftest import SF


def plain(text):
    """All three-word shingles of a text, by a plain statement of the rule."""
    w = re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().lower())
    return {tuple(w[i : i + 3]) for i in range(len(w) - 2)} or ({tuple(w)} if w else set())


def expected(text, templates):
    own = plain(text)
    found = [(k, len(plain(t)), len(plain(t) & own)) for k, t in templates.items()]
    return sorted(x for x in found if 100 * x[2] >= 80 * x[1])


def held(rows):
    return sorted((r.doc_id is None, r.doc_id or 0, [tuple(x) for x in r.licenses]) for r in rows)


def test_given_documents_equal_brute_force(spark, rows_of):
    rows = queries.op2_licenses(spark, SF).collect()
    assert len(rows) == len(rows_of)
    assert held(rows) == sorted((False, d, expected(t, TEMPLATES)) for d, t in rows_of.items())
    assert sum(bool(r.licenses) for r in rows) == len([t for t in rows_of.values() if "icense" in t])


def test_texts_inside_long_documents(spark, odd, odd_rows, prose):
    """At every offset, edited, as comments, twice, spread over a text, and together."""
    mit, bsd, apache = TEMPLATES["MIT"], TEMPLATES["BSD-3-Clause"], TEMPLATES["Apache-2.0 header"]
    cut = mit.split()
    texts = [prose(k, 60) + "\n" + mit + "\n" + prose(7, 61) for k in range(40, 75)] + [
        prose(20_000, 62) + " " + bsd + " " + prose(3_000, 63),
        "\n".join("# " + line for line in mit.upper().splitlines()),
        " ".join(w for k, w in enumerate(cut) if k % 40),
        " ".join(w for k, w in enumerate(cut) if k % 6),
        " ".join(cut[: len(cut) // 2]) + " " + prose(900, 64) + " " + " ".join(cut[len(cut) // 2 :]),
        mit + mit + bsd + apache, apache, "Released under the MIT License.", "released", None, "",
    ]
    rows = [(100 + k, t) for k, t in enumerate(texts)] + [(100, bsd), (None, mit)] + [(r[0], r[1]) for r in odd_rows]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = held(L.licenses(df, L.given_templates(spark)).collect())
    assert got == sorted((d is None, d or 0, expected(t, TEMPLATES)) for d, t in rows)
    assert sum("MIT" in [x[0] for x in found] for _, _, found in got) > 38


def test_own_templates_of_every_size(spark, prose, none):
    templates = {f"t{n}": prose(n, 70 + n) for n in (1, 2, 3, 4, 5, 9, 33, 700, 3000)} | {"none": " # "}
    docs = {k: prose(50, 90) + " " + t + " " + prose(5, 91) for k, t in enumerate(templates.values())} | {99: templates["t1"]}
    given = spark.createDataFrame(list(templates.items()), "license string, text string")
    got = held(L.licenses(spark.createDataFrame(list(docs.items()), "doc_id bigint, text string"), given).collect())
    templates.pop("none")
    assert got == sorted((False, d, expected(t, templates)) for d, t in docs.items())
    assert L.licenses(none, given).count() == 0


def test_no_template_finds_nothing(spark, odd, odd_rows):
    rows = L.licenses(odd, L.given_templates(spark).limit(0)).collect()
    assert len(rows) == len(odd_rows) and not any(r.licenses for r in rows)


@pytest.mark.parametrize("cells", [1, 1 << 20])
@pytest.mark.parametrize("m", [1, 2, 4, 8])
def test_windows_are_whole_and_keys_those_of_their_minima(monkeypatch, cells, m):
    monkeypatch.setattr(L, "CELLS", cells)
    items = L.mixed(np.arange(1, 24, dtype=np.uint64))
    stride = max(1, m // 2)
    starts = range(0, max(1, 23 - m), stride)
    windows = [items[s : s + m + stride] for s in starts]
    assert {int(x) for w in windows for x in w} == set(map(int, items))
    assert all(any(set(map(int, items[i : i + m])) <= set(map(int, w)) for w in windows) for i in range(24 - m))
    want = set()
    for w in windows:
        want |= set(map(int, L._keys(L.mixed(w[None, :] ^ L._PERMUTED[:, None]).min(1), np.arange(L.BANDS), m).view(np.int64)))
    assert set(map(int, L.window_keys(items, items, m))) == want


def test_miss_probability_and_hashes():
    assert max(L.miss_probability(n) for n in range(1, 5000)) < 7e-7
    text = TEMPLATES["BSD-3-Clause"]
    assert len(np.unique(L.shingles(text.encode(), WordHashes()))) == len(plain(text))
