"""Words and word shingles of many texts at once, as 64-bit hashes in arrays.

A word is a run of ASCII letters, digits and of any characters beyond ASCII, in lower case;
``divided`` texts have their words told apart in all scripts. All texts of a slice are handled as one byte array: word bounds are where the kind of byte changes, and the hash
of a word is a difference of running sums, so no Python code runs per word.
"""

from __future__ import annotations

import sys
import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SHINGLE = 5
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
#: Scripts written without spaces; each of their characters is a word in a divided text.
_UNSPACED = r"([\p{Han}\p{Hiragana}\p{Katakana}\p{Bopomofo}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}\p{Tibetan}\x{30FC}\x{FF70}])"
#: Marks beyond ASCII that end a sentence or quote, and those that only divide words.
_QUOTES = "[" + "".join(rf"\x{{{ord(c):X}}}" for c in "。．｡！？：；…‘’‚‛“”„‟«»‹›「」『』") + "]"
_DIVIDERS: list[str] = []
_POWERS: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}
#: Fixed odd numbers, one per place in a shingle.
_PLACES = np.array([0xA24BAED4963EE407, 0x9FB21C651E98DF25, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93],
                   np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values: equal values stay equal, near ones fall far apart."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(kind: str, n: int) -> np.ndarray:
    if len(_POWERS[kind]) < n:
        step = _BASE if kind == "up" else _INVERSE
        filled = np.full(max(n, 1 << 21), step, np.uint64)
        filled[0] = 1
        _POWERS[kind] = np.multiply.accumulate(filled)
    return _POWERS[kind][:n]


class Hashed:
    """A byte array any stretch of which can be hashed at once."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers("up", n), out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        inverse = _powers("down", len(self.sums))
        return mix((self.sums[ends] - self.sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


@dataclass
class Words:
    """The words of a slice of texts: hash, text number, and byte bounds in ``data``."""

    data: np.ndarray
    hashes: np.ndarray
    text: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    text_at: np.ndarray  # where each text begins in ``data``
    first: np.ndarray  # for each text the place of its first word, and the number of words at the end
    hashed: Hashed


def _dividers() -> str:
    """White space, punctuation, and signs of money and mathematics beyond ASCII, as a class of ranges."""
    if not _DIVIDERS:
        use = [c for c in range(128, sys.maxunicode + 1) if unicodedata.category(chr(c))[0] in "PZ"
               or unicodedata.category(chr(c)) in ("Sc", "Sm") or c in (0x85, 0x200B, 0x2060, 0xFEFF)]
        ends = [i for i, c in enumerate(use) if i + 1 == len(use) or use[i + 1] != c + 1]
        firsts = [0] + [i + 1 for i in ends[:-1]]
        _DIVIDERS.append("[" + "".join(rf"\x{{{use[i]:X}}}-\x{{{use[j]:X}}}" for i, j in zip(firsts, ends)) + "]")
    return _DIVIDERS[0]


def divided(texts: pa.Array) -> pa.Array:
    """The texts with their words divided in ASCII: marks beyond it become spaces or quotes, and a character of a script
    written without spaces stands alone."""
    if pc.all(pc.string_is_ascii(texts)).as_py() is not False:
        return texts
    marks = f"{_dividers()}|{_UNSPACED}"
    if not pc.any(pc.match_substring_regex(texts, marks)).as_py():
        return texts
    texts = pc.replace_substring_regex(pc.replace_substring_regex(texts, _QUOTES, '"'), _dividers(), " ")
    return pc.replace_substring_regex(texts, _UNSPACED, r" \1 ")


def bounds_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of a slice, where each text begins in them and the last one ends, and where words start and end."""
    closed = pc.binary_join_element_wise(texts, pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string()))
    offsets = np.frombuffer(closed.buffers()[1], np.int64)[closed.offset:closed.offset + len(closed) + 1]
    raw = closed.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    at = offsets - offsets[0]
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = _WORD[data]
    edge = np.diff(inside)
    return data, at, np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def words_of(texts: pa.Array, lower: bool = True) -> Words:
    """The words of a slice; ``texts`` is a large-string array without nulls."""
    data, at, starts, ends = bounds_of(pc.utf8_lower(texts) if lower else texts)
    hashed = Hashed(data)
    first = np.searchsorted(starts, at)
    return Words(data, hashed.of(starts, ends), np.repeat(np.arange(len(texts)), np.diff(first)), starts, ends, at[:-1],
                 first, hashed)


def shingles_of(words: Words, hashes: np.ndarray | None = None, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of ``n`` words and their text numbers, in order; a text of fewer words has one of all its words."""
    h = words.hashes if hashes is None else hashes
    total = np.zeros(max(len(h) - n + 1, 0), np.uint64)
    for j in range(n if len(total) else 0):
        total += h[j:j + len(total)] * _PLACES[j % len(_PLACES)]
    same = words.text[:len(total)] == words.text[n - 1:] if len(total) else np.zeros(0, bool)
    out, text = mix(total[same]), words.text[:len(total)][same]
    count = np.diff(words.first)
    few = np.flatnonzero((count > 0) & (count < n))
    if len(few):
        short = np.zeros(len(few), np.uint64)
        for j in range(n - 1):
            has = count[few] > j
            short[has] += h[words.first[few[has]] + j] * _PLACES[j % len(_PLACES)]
        out, text = np.concatenate([out, mix(short + count[few].astype(np.uint64))]), np.concatenate([text, few])
        order = np.argsort(text, kind="stable")
        out, text = out[order], text[order]
    return out, text
