"""Token ids and token counts with a library's tokenizer file, word by word where that is proven equal.

A byte-level vocabulary cuts a text at fixed places before it merges: a unit made of one white-space
character and the characters up to the next white space, or of a white-space run without its last
character, is always encoded as it is alone. Units repeat, so their ids are remembered up to a bound.
Texts with white space on whose definition libraries differ, or with an added token's string, are
given to the library whole.
"""

from __future__ import annotations

import json
import os
import re
import struct
from functools import lru_cache

import numpy as np

#: White space that not every regular expression library counts as such, and format characters.
ODD_SPACE = "[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028\u2029\u202f\u205f\u2060\u3000\ufeff]"
_LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
#: Latin words and plain punctuation that end at white space or meet each other; else up to white space.
_UNIT = re.compile(rf" ?[{_LATIN}]++(?![^\s.,;:|!?])| ?[.,;:|!?]++(?!\S)|\s?\S+|\s+(?!\S)|\s")
#: A unit that is a single piece.
_PIECE = re.compile(rf" ?[{_LATIN}]+| ?[.,;:|!?]+").fullmatch
#: Texts whose words are looked up together.
GROUP = 500


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file, the same on every machine of the cluster."""
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=4)
def _whole_only(path: str) -> re.Pattern:
    with open(path, encoding="utf-8") as file:
        added = [re.escape(t["content"]) for t in json.load(file).get("added_tokens", [])]
    return re.compile("|".join([ODD_SPACE, *added]))


class UnitIds(dict):
    """Packed ids of units, up to a bound.

    A unit that is one Latin word or one run of plain signs is one piece for the library's pre-tokenizer,
    so its model is asked directly; any other unit goes through the whole library.
    """

    #: About 100 MB of a worker. Rare words come back: a smaller bound learns half of the units twice.
    BOUND = 500_000

    def __init__(self, path: str) -> None:
        super().__init__()
        self.library = tokenizer(path)
        self.model = self.library.model
        spelled = self.library.pre_tokenizer.pre_tokenize_str
        plain = [c for c in map(chr, range(0x20, 0x100)) if _PIECE(c) or c == " "]
        self.spelling = {ord(c): spelled(c)[0][0] for c in plain}

    def __missing__(self, unit: str) -> bytes:
        if len(self) >= self.BOUND:
            self.clear()
        if _PIECE(unit):
            ids = [t.id for t in self.model.tokenize(unit.translate(self.spelling))]
            found = self[unit] = struct.pack(f"<{len(ids)}I", *ids)
        else:
            found = self[unit] = self.of_library(unit)
        return found

    def of_library(self, text: str) -> bytes:
        return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4").tobytes()


class WordCounts(dict):
    """Token counts of words, up to a bound."""

    BOUND = 200_000

    def __init__(self, path: str) -> None:
        super().__init__()
        self.library = tokenizer(path)

    def learn(self, words: set[str]) -> None:
        if len(self) + len(words) > self.BOUND:
            self.clear()
        new = list(words.difference(self))
        for start in range(0, len(new), 20_000):
            part = new[start : start + 20_000]
            found = self.library.encode_batch_fast(part, add_special_tokens=False)
            self.update(zip(part, map(len, found)))


@lru_cache(maxsize=4)
def _ids_by_unit(path: str) -> UnitIds:
    return UnitIds(path)


@lru_cache(maxsize=4)
def _count_by_word(path: str) -> WordCounts:
    return WordCounts(path)


def packed_ids(texts: list[str], path: str) -> list[bytes]:
    """Ids of whole texts as little-endian unsigned 32-bit bytes, added tokens' strings as the library's default."""
    known, odd = _ids_by_unit(path), _whole_only(path)
    return [known.of_library(t) if odd.search(t) else b"".join(map(known.__getitem__, _UNIT.findall(t))) for t in texts]


def word_counts(texts: list[str], path: str) -> list[int]:
    """Token counts of whole texts for a vocabulary whose tokens never touch white space."""
    known, odd = _count_by_word(path), _whole_only(path)
    split = [None if odd.search(t) else t.split() for t in texts]
    out = []
    for start in range(0, len(texts), GROUP):
        group = split[start : start + GROUP]
        known.learn(set().union(*(words for words in group if words)))
        for text, words in zip(texts[start : start + GROUP], group):
            if words is None:
                out.append(len(known.library.encode_batch_fast([text], add_special_tokens=False)[0]))
            else:
                out.append(sum(map(known.__getitem__, words)))
    return out
