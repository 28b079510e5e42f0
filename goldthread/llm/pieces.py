"""Ids of a public tokenizer, by way of pieces of texts.

The tokenizer file lower-cases, drops white space and never forms a token across it, or between a letter and a mark behind
it. So the ids of a text are the ids of its pieces, one after the other: what white space divides, with a single mark behind
a final letter as a piece of its own. Pieces repeat, whole texts do not: each Python worker keeps the ids of the pieces it
has met and asks the tokenizers library for new ones only. All pieces of a slice are found, hashed, looked up and
replaced by their ids in arrays. Texts with a special string of the tokenizer go to the library whole.
"""

from __future__ import annotations

import os
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from goldthread.llm.common import stretches
from goldthread.llm.words import Hashed, mix

#: The special strings of the tokenizer file, and the id of the last one.
SPECIAL, BETWEEN, BETWEEN_ID = (b"<|startoftext|>", b"<|endoftext|>"), "<|endoftext|>", 49407
#: Pieces that a worker keeps, bytes of the longest one kept, and characters that the library is given at once.
CACHE_PIECES, LONG, JOINED_CHARS = 400_000, 256, 4_000
#: Bytes of a single text from which it is cut, at white space.
STRETCH, _WHITE = 4 << 20, re.compile(rb"[\x20\x09-\x0D]")
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_MARK = np.zeros(256, bool)
_MARK[[*b".,;:!?"]] = True


def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _within(counts: np.ndarray) -> np.ndarray:
    """0, 1, .. for each of the counts, one after the other."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


class Split:
    """The pieces of a slice of texts: byte bounds in ``data``, lower-cased beyond ASCII by the library only, and two keys each.

    The second key holds the length and the first and last eight bytes, so pieces of up to 16 bytes are told apart by themselves,
    longer ones by their hash as well. Pieces of more than ``LONG`` bytes are never kept.
    """

    def __init__(self, texts: pa.Array):
        closed = pc.binary_join_element_wise(texts, pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string()))
        at = np.frombuffer(closed.buffers()[1], np.int64)[closed.offset:closed.offset + len(closed) + 1]
        raw = closed.buffers()[2]
        data = _LOWER[np.frombuffer(raw, np.uint8)[at[0]:at[-1]]] if raw is not None else np.zeros(0, np.uint8)
        self.data, self.at = data, at - at[0]
        #: Texts with a special string, which have no pieces.
        self.whole = []
        lower = data.tobytes()
        if any(s in lower for s in SPECIAL):
            for i, (a, b) in enumerate(zip(self.at.tolist(), self.at[1:].tolist())):
                if any(s in lower[a:b] for s in SPECIAL):
                    self.whole.append(i)
                    data[a:b] = 32
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = ~_SPACE[data]
        begins, ends = inside[1:] & ~inside[:-1], inside[:-1] & ~inside[1:]
        last = np.flatnonzero(ends) - 1
        last = last[(last > 0) & _MARK[data[last]]]
        last = last[_LETTER[data[last - 1]]]
        begins[last] = ends[last] = True
        self.starts, self.ends = np.flatnonzero(begins), np.flatnonzero(ends)
        self.key = Hashed(data).of(self.starts, self.ends) if len(self.starts) else np.zeros(0, np.uint64)
        padded = np.concatenate([np.zeros(8, np.uint8), data, np.zeros(8, np.uint8)])
        eight = np.lib.stride_tricks.sliding_window_view(padded, 8)
        sizes = self.ends - self.starts
        spare = (8 * np.maximum(8 - sizes, 0)).astype(np.uint64)
        first = np.ascontiguousarray(eight[self.starts + 8]).view("<u8").reshape(-1) << spare
        final = np.ascontiguousarray(eight[self.ends]).view("<u8").reshape(-1) >> spare
        self.check = mix(mix(first) + final) + sizes.astype(np.uint64)
        #: The first piece of each text, and the number of pieces at the end.
        self.first = np.searchsorted(self.starts, self.at)

    def pieces(self, places: np.ndarray) -> list[bytes]:
        raw = self.data.tobytes()
        return [raw[a:b] for a, b in zip(self.starts[places].tolist(), self.ends[places].tolist())]

    def simple(self, places: np.ndarray) -> np.ndarray:
        """Whether a piece is lower-case Latin letters only, accents included: one pre-token, and its own normal form."""
        data = self.data
        good = _LETTER[data]
        accent = (data[:-1] == 0xC3) & (data[1:] >= 0x9F) & (data[1:] <= 0xBF) & (data[1:] != 0xB7)
        good[:-1] |= accent
        good[1:] |= accent
        bad = np.concatenate([[0], np.cumsum(~good)])
        return bad[self.ends[places]] == bad[self.starts[places]]


class Library:
    """The tokenizer, asked for many pieces at once."""

    def __init__(self, path: str):
        self.tokenizer = load_tokenizer(path)
        from tokenizers.pre_tokenizers import ByteLevel

        spell = ByteLevel(add_prefix_space=False, use_regex=False)
        #: How the merges spell the letters beyond ASCII of simple pieces.
        self.spelled = {ord(c): spell.pre_tokenize_str(c)[0][0] for c in map(chr, range(0xDF, 0x100)) if c != "÷"}

    def _groups(self, pieces: list[str]) -> list[np.ndarray]:
        joined, group, chars = [], [], 0
        for piece in pieces:
            group.append(piece)
            chars += len(piece) + 1
            if chars > JOINED_CHARS:
                joined.append(BETWEEN.join(group))
                group, chars = [], 0
        if group:
            joined.append(BETWEEN.join(group))
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)]

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def of(self, pieces: list[bytes], simple: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces, one after the other, and how many each has.

        Simple pieces go to the merges at once. All others are joined, told apart by a special string between them.
        """
        texts = np.array([p.decode() for p in pieces], object)
        out, counts, order = [], np.zeros(len(pieces), np.int64), []
        for kind in (True, False):
            places = np.flatnonzero(simple == kind)
            if not len(places):
                continue
            own = texts[places].tolist()
            if kind:
                merge, spelled = self.tokenizer.model.tokenize, self.spelled
                ids = [[token.id for token in merge(x if x.isascii() else x.translate(spelled))] for x in own]
                counts[places] = [len(x) for x in ids]
                ids = np.array([i for x in ids for i in x], np.uint32)
            else:
                ids = np.concatenate([x for g in self._groups(own) for x in (g, np.array([BETWEEN_ID], np.uint32))])
                counts[places] = np.diff(np.flatnonzero(ids == BETWEEN_ID), prepend=-1) - 1
                ids = ids[ids != BETWEEN_ID]
            out.append(ids)
            order.append(places)
        flat, order = np.concatenate(out), np.concatenate(order)
        begin = np.zeros(len(pieces), np.int64)
        begin[order] = np.cumsum(counts[order]) - counts[order]
        return flat[np.repeat(begin, counts) + _within(counts)], counts


@dataclass
class Table:
    """Known pieces in the order of their key: check, number of ids and where these begin in the pool."""

    key: np.ndarray
    check: np.ndarray
    count: np.ndarray
    begin: np.ndarray
    met: np.ndarray

    @staticmethod
    def empty() -> Table:
        return Table(*[np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, bool)])

    def find(self, key: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each piece its place, and whether it is there."""
        place = np.minimum(np.searchsorted(self.key, key), max(len(self.key) - 1, 0))
        if not len(self.key):
            return place, np.zeros(len(key), bool)
        return place, (self.key[place] == key) & (self.check[place] == check)

    def add(self, other: Table) -> Table:
        place = np.searchsorted(self.key, other.key)
        return Table(*[np.insert(a, place, b) for a, b in zip(vars(self).values(), vars(other).values())])

    def only(self, keep: np.ndarray) -> Table:
        return Table(*[a[keep] for a in vars(self).values()])


class Pieces:
    """Ids of pieces, or with ``counts`` their number only, of about ``most`` pieces and of the given ``frequent`` ones.

    When there are more, those that were not met since the last time are forgotten, or all if that leaves too many.
    """

    def __init__(self, path: str, counts: bool = False, frequent: Table | None = None, most: int = CACHE_PIECES):
        self.library, self.counts, self.most = Library(path), counts, most
        self.frequent, self.table = frequent or Table.empty(), Table.empty()
        self.pool = np.zeros(1 << 16, np.uint32)
        self.used = 0

    def _keep(self, ids: np.ndarray) -> int:
        begin, self.used = self.used, self.used + len(ids)
        if self.used > len(self.pool):
            self.pool = np.concatenate([self.pool[:begin], np.zeros(max(self.used, len(self.pool)), np.uint32)])
        self.pool[begin:self.used] = ids
        return begin

    def _forget(self) -> None:
        table = self.table
        if len(table.key) > self.most:
            table = table.only(table.met)
            table = Table.empty() if len(table.key) > self.most // 2 else table
        begin = np.cumsum(table.count) - table.count
        ids = self.pool[np.repeat(table.begin, table.count) + _within(table.count)] if not self.counts else self.pool[:0]
        self.used = 0
        self._keep(ids)
        self.table = Table(table.key, table.check, table.count, begin, np.zeros(len(table.key), bool))

    def _known(self, split: Split, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids, and where they begin in the pool, of different pieces at ``places``; new ones are learned."""
        key, check = split.key[places], split.check[places]
        count, begin = np.zeros(len(places), np.int64), np.zeros(len(places), np.int64)
        place, there = self.frequent.find(key, check)
        count[there] = self.frequent.count[place[there]]
        rest = np.flatnonzero(~there)
        place, there = self.table.find(key[rest], check[rest])
        self.table.met[place[there]] = True
        count[rest[there]], begin[rest[there]] = self.table.count[place[there]], self.table.begin[place[there]]
        new = rest[~there]
        if len(new):
            ids, own = self.library.of(split.pieces(places[new]), split.simple(places[new]))
            at = 0 if self.counts else self._keep(ids)
            count[new], begin[new] = own, at + np.cumsum(own) - own
            # A key that another piece has already is not taken.
            keep = (split.ends - split.starts)[places[new]] <= LONG
            keep &= np.append(True, key[new][1:] != key[new][:-1])
            if len(self.table.key):
                keep &= self.table.key[place[~there]] != key[new]
            new = new[keep]
            self.table = self.table.add(Table(key[new], check[new], count[new], begin[new], np.ones(len(new), bool)))
        return count, begin

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (without nulls), one after the other, or none with ``counts``; and where each text's end."""
        if len(texts) == 1 and pc.binary_length(texts)[0].as_py() > STRETCH:
            cuts = pa.array([*stretches(texts[0].as_py().encode(), _WHITE, STRETCH)], pa.large_binary()).cast(pa.large_string())
            ids, ends = zip(*(self._of(cuts.slice(i, 1)) for i in range(len(cuts))))
            return np.concatenate(ids), np.array([0, sum(e[-1] for e in ends)])
        return self._of(texts)

    def _of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if len(self.table.key) > self.most or self.used > 16 * self.most:
            self._forget()
        split = Split(texts)
        order = np.argsort(split.key)
        key, check = split.key[order], split.check[order]
        if ((key[1:] == key[:-1]) & (check[1:] != check[:-1])).any():
            order = np.lexsort((split.check, split.key))
            key, check = split.key[order], split.check[order]
        new = np.append(True, (key[1:] != key[:-1]) | (check[1:] != check[:-1]))[:len(order)]
        number = np.zeros(len(order), np.int64)
        number[order] = np.cumsum(new) - 1
        count, begin = self._known(split, order[new]) if len(order) else (np.zeros(0, np.int64),) * 2
        counts = count[number]
        ends = np.concatenate([[0], np.cumsum(counts)])[split.first]
        ids = self.pool[np.repeat(begin[number], counts) + _within(counts)] if not self.counts else self.pool[:0]
        if split.whole:
            own = {i: self.library.whole(texts[i].as_py()) for i in split.whole}
            sizes = np.diff(ends)
            if not self.counts:
                ids = np.concatenate([own[i] if i in own else ids[ends[i]:ends[i + 1]] for i in range(len(texts))])
            sizes[split.whole] = [len(x) for x in own.values()]
            ends = np.concatenate([[0], np.cumsum(sizes)])
        return ids, ends


def counted(path: str, pieces: list[str]) -> Table:
    """A table of the number of ids of different pieces, to be given to workers."""
    split = Split(pa.array(pieces, pa.large_string()))
    alone = np.flatnonzero(np.diff(split.first) == 1)
    places = split.first[alone]
    _, count = Library(path).of(split.pieces(places), split.simple(places)) if len(places) else (None, np.zeros(0, np.int64))
    _, some = np.unique(split.key[places], return_index=True)
    return Table(split.key[places][some], split.check[places][some], count[some], np.zeros(len(some), np.int64), np.zeros(len(some), bool))


_KEPT: dict[str, Pieces] = {}


def encoded(path: str, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts, and where each text's begin, with the end of the last."""
    if path not in _KEPT:
        _KEPT[path] = Pieces(path)
    return _KEPT[path].of(texts)


def packed_ids(path: str, texts: pa.Array) -> list[bytes]:
    """The ids of each text as little-endian unsigned 32-bit integers."""
    ids, ends = encoded(path, texts)
    packed, ends = ids.astype("<u4").tobytes(), (4 * ends).tolist()
    return [packed[a:b] for a, b in zip(ends, ends[1:])]
