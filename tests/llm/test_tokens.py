import zlib
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from clipstat.llm import packing as K
from clipstat.llm import token_counts as C
from clipstat.llm import tokens as T

BYTES, WORDS = T.tokenizer_path("byte_bpe_50k.json"), T.tokenizer_path("word_bpe_49k.json")
BITS = ["a", "B", "the", "é", "e\u0301", " ", "  ", "\n", "\t", "\r\n", "'s", "'", "'ll", ".", ",", "...", "|", "23", "漢字", "\xa0", "\u2003", "\x1c",
        "<|endoftext|>", "<|startoftext|>", "🙂", "İ", "#", "\u200d"]
TEXTS = st.lists(st.one_of(st.sampled_from(BITS), st.text(max_size=4)), max_size=40).map("".join)


def library(text, path):
    return T.tokenizer(path).encode(text, add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(TEXTS)
def test_ids_and_counts_equal_the_library(text):
    assert T.packed_ids([text, "", text], BYTES) == [np.array(library(t, BYTES), "<u4").tobytes() for t in (text, "", text)]
    assert T.word_counts([text], WORDS) == [len(library(text, WORDS))]


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXTS, min_size=3, max_size=12).map("".join), st.sampled_from([24, 60, 100]), st.sampled_from([4, 10]))
def test_splices_equal_the_whole(text, chunk, overlap):
    assert [t[0] for t in C.spliced(text, WORDS, chunk, overlap)] == library(text, WORDS)


def test_a_word_longer_than_the_chunk_widens_the_overlap():
    text = "start " + "abc" * 400 + " end " + "x y " * 300
    assert [t[0] for t in C.spliced(text, WORDS, 200, 8)] == library(text, WORDS)


def test_counts_of_odd_rows(odd, odd_rows, none, monkeypatch):
    monkeypatch.setattr(C, "HUGE", 5_000)
    out = C.token_counts(odd, WORDS, limit=3)
    assert sorted((r.n_bytes, r.n_tokens, r.over_limit) for r in out.collect()) == sorted(
        (len((t or "").encode()), len(library(t or "", WORDS)), len(library(t or "", WORDS)) > 3) for _, t, *_ in odd_rows
    )
    assert C.token_counts(none, WORDS).count() == 0


def check_packing(rows, texts, capacity):
    """rows: all pieces; texts: the packed documents."""
    by, place = defaultdict(list), defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
        place[r.sequence_id].append((r.offset, r.length))
    for spans in place.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    for doc, text in texts.items():
        ids = library(text or "", BYTES) + [K.END_ID]
        own = sorted(by[doc], key=lambda r: r.piece)
        assert sum(r.length for r in own) == len(ids) and len(own) == -(-len(ids) // capacity)
        for r in own:
            assert r.piece == 0 or r.length == capacity
            assert zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32
    return len(place)


def test_given_documents_pack_tightly(documents, rows_of):
    rows = K.packed(documents, BYTES).collect()
    used = check_packing(rows, rows_of, K.CAPACITY)
    assert used <= 1.02 * sum(r.length for r in rows) / K.CAPACITY + 1


def test_packing_of_odd_rows(odd, odd_rows, none):
    rows = K.packed(odd, BYTES, capacity=64, with_ids=True).collect()
    once = Counter(r[0] for r in odd_rows)
    check_packing(rows, {r[0]: r[1] for r in odd_rows if once[r[0]] == 1}, 64)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in rows)
    assert K.packed(none, BYTES).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(0, 20), max_size=30))
def test_plan_places_every_piece_once(counts):
    use, seen = defaultdict(list), Counter()
    for length, rank, count, first, offset in K.plan(counts, 30):
        assert rank == seen[length]
        seen[length] += count
        for i in range(count):
            use[first + i].append((offset, length))
    assert seen == Counter({n: c for n, c in counts.items() if c})
    for spans in use.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 30
        assert sum(3 * length > 30 for _, length in spans) <= 2
