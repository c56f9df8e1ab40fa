import hashlib
from collections import Counter

import numpy as np
import pytest

from clipstat.llm import alignment as G
from clipstat.llm.tokens import tokenizer_path

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


def plain(texts):
    """Row by row: whole texts to both libraries, offsets as sets, links and counts in dictionaries."""
    v, rows, linked = G.vocabularies(A, B), [], []
    for text in texts:
        a = v.a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = v.b.encode(text) if text else []
        raw = b" " + (text or "").encode()
        if b"".join(v.bytes_a[i] for i in a) != raw or b"".join(v.bytes_b[i] for i in b) != raw:
            a, b = [], []
        ends_a, ends_b = np.cumsum([len(v.bytes_a[i]) for i in a]).tolist(), np.cumsum([len(v.bytes_b[i]) for i in b]).tolist()
        cuts = sorted(set(ends_a) & set(ends_b))
        groups, links, low = [], [], 0
        for cut in cuts:
            ours = [i for i, e in zip(a, ends_a) if low < e <= cut], [i for i, e in zip(b, ends_b) if low < e <= cut]
            groups.append("|".join(",".join(map(str, x)) for x in ours))
            low = cut
        links = [(i, j) for i, e in zip(a, ends_a) for j, f in zip(b, ends_b) if e == f]
        linked.append(links)
        rows.append((len(a), len(b), len(groups), len(links), hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    counts = Counter(x for links in linked for x in links)
    most = Counter()
    for (_, j), n in counts.items():
        most[j] = max(most[j], n)
    return [r[:4] + (sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), r[4]) for r, links in zip(rows, linked)]


def as_rows(df):
    return sorted(tuple(r[1:]) for r in df.collect())


def test_given_documents_equal_brute_force(documents, rows_of):
    texts = [t if t is None or len(t) < 30_000 else t[:30_000] for _, t in sorted(rows_of.items())]
    assert all(t == w for t, (_, w) in zip(texts, sorted(rows_of.items())))
    assert as_rows(G.aligned_documents(documents, A, B)) == sorted(plain(texts))


HARD = [
    "", None, " ", "  ", " x", "x ", "x  ", "a  b", "a\n b", "a \n b", "a\n\n  b\t\n", "\n", "\nfoo", "x\r\ny \r z", "tab\t tab", "<|endoftext|> and <s> </s> <unk>",
    "x\xa0y", "漢字 🙂 é ​ z", "▁under ▁ score", "ﬁ ligature Å ①", "\x00 zero \x7f", "x" * 3000, "1234567 89,00.5", "don't it's we'LL", "a b 　 c", "q " * 700,
]


def test_hard_texts(spark, monkeypatch):
    df = spark.createDataFrame(list(enumerate(HARD)), "doc_id bigint, text string")
    want = sorted(plain(HARD))
    assert as_rows(G.aligned_documents(df, A, B)) == want
    monkeypatch.setattr(G, "PART", 3)
    monkeypatch.setattr(G, "GROUP", 10)
    monkeypatch.setattr(G, "REMEMBERED", 5)
    v, known = G.vocabularies(A, B), G.Stretches()
    got = [s.row()[:4] for s in G.summaries(HARD, v, known)]
    assert sorted(got) == sorted((r[0], r[1], r[2], r[6]) for r in want)


def test_groups_of_intervals():
    a, b = G.coalesced(*map(np.array, ([0, 2, 5], [2, 5, 9], [0, 3, 5, 7], [3, 5, 7, 9])))
    assert a.tolist() == [0, 0, 1] and b.tolist() == [0, 0, 1, 1]


def test_pairs_are_bounded_by_the_vocabularies(documents):
    v, bound = G.vocabularies(A, B), G.most_pairs(A, B)
    assert bound <= sum(v.size_a) + sum(v.size_b)
    counts = G.pair_counts(G.alignments(documents.select("doc_id", "text"), A, B)).collect()
    assert 0 < len(counts) <= bound
    for r in counts[:2000]:
        a, b = v.bytes_a[r.pair >> G.B_BITS], v.bytes_b[r.pair & ((1 << G.B_BITS) - 1)]
        assert a.endswith(b) or b.endswith(a)


def test_odd_rows(odd, odd_rows):
    assert as_rows(G.aligned_documents(odd, A, B)) == sorted(plain([r[1] for r in odd_rows]))


def test_empty(none):
    assert G.aligned_documents(none, A, B).count() == 0
