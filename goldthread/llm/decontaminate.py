"""Benchmark passages in documents, also with other numbers, names and units."""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldthread.llm.common import bound_batches, slices, text_of, unused, written
from goldthread.llm.words import SHINGLE, Hashed, Words, bounds_of, divided, mix, shingles_of, words_of

BLOCK_BYTES, COVERED, LITERALS = 4 << 20, 0.8, 2
FOUND = "__found"
# Units of measure and money.
UNITS = """mm cm m km inch inches foot feet ft yard yards mile miles g mg kg gram grams kilogram kilograms ounce ounces oz
pound pounds lb lbs ton tons tonne tonnes ml l litre litres liter liters gallon gallons second seconds sec minute minutes min
hour hours day days week weeks month months year years percent degree degrees celsius fahrenheit dollar dollars cent cents euro
euros eur usd pence yen mph kmh watt watts kw volt volts amp amps joule joules calorie calories byte bytes kb mb gb tb""".split()
NUMBER, UNIT, NAME = 1, 2, 3
_PLACEHOLDERS = mix(np.arange(4, dtype=np.uint64) + np.uint64(77))
_UNITS: list[np.ndarray] = []


def _unit_hashes() -> np.ndarray:
    if not _UNITS:
        _UNITS.append(np.sort(words_of(pa.array([" ".join(UNITS)], pa.large_string())).hashes))
    return _UNITS[0]


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def canonical(texts: pa.Array) -> tuple[Words, np.ndarray]:
    """The words of a slice and the kind of slot that each of them is: 0 for a literal word.

    A number begins with a digit; parts that only a point, comma, colon or slash divides are one. A unit
    is a word of the list, behind a number or not ("how many miles"). A name begins with a capital and goes on in small letters inside a sentence.
    """
    texts = divided(texts)
    words = words_of(texts)
    # The same words before they were put in lower case, which may change the length of a letter.
    raw, text_at, own, own_ends = bounds_of(texts)
    data, starts, ends = words.data, words.starts, words.ends
    number = (data[starts] >= 48) & (data[starts] <= 57)
    if len(starts) > 1:
        tight = np.zeros(len(starts), bool)
        between = data[np.minimum(ends[:-1], len(data) - 1)]
        tight[1:] = number[1:] & number[:-1] & (starts[1:] == ends[:-1] + 1) & np.isin(between, np.frombuffer(b".,:/", np.uint8))
        if tight.any():
            # The parts of a number become one word.
            head = np.flatnonzero(~tight)
            last = np.append(head[1:], len(starts)) - 1
            starts, ends, own, own_ends = starts[head], ends[last], own[head], own_ends[last]
            kept = np.concatenate([[0], np.cumsum(~tight)])
            words = Words(data, words.hashed.of(starts, ends), words.text[head], starts, ends, words.text_at,
                          kept[words.first], words.hashed)
            number = number[head]
    kinds = np.where(number, NUMBER, 0).astype(np.int8)
    if len(starts):
        kinds[~number & _among(words.hashes, _unit_hashes())] = UNIT
        second = raw[np.minimum(own + 1, len(raw) - 1)]
        capital = (raw[own] >= 65) & (raw[own] <= 90) & (own_ends - own > 1) & (second >= 97)
        before, far = raw[np.maximum(own - 1, 0)], raw[np.maximum(own - 2, 0)]
        inside = (before == 32) & ~np.isin(far, np.frombuffer(b".!?:;|\n\"'", np.uint8)) & (own - 2 >= text_at[words.text])
        kinds[capital & inside] = NAME
    return words, kinds


@dataclass
class Templates:
    """Stretches of words with slots: hash, number of the window, first word, and the word behind the last."""

    hashes: np.ndarray
    windows: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def windows_of(words: Words, kinds: np.ndarray) -> tuple[np.ndarray, Templates, np.ndarray]:
    """Literal windows and their text numbers, and the templates of the windows with slots.

    A window with fewer than ``LITERALS`` literal words is widened to the right, and to the left, until it holds so many;
    both are its templates. It has none where its text ends before.
    """
    literal, text = shingles_of(words)
    slots, fixed = (np.concatenate([[0], np.cumsum(use)]) for use in (kinds > 0, kinds == 0))
    at = np.append(np.flatnonzero(kinds == 0), [0] * LITERALS)
    low, high = words.first[text], words.first[text + 1]
    begin = window_starts(words)
    end = np.minimum(begin + SHINGLE, high)
    some = slots[end] > slots[begin]
    few = fixed[end] - fixed[begin] < LITERALS
    right = np.flatnonzero(some & few & (fixed[high] - fixed[begin] >= LITERALS))
    left = np.flatnonzero(some & few & (fixed[end] - fixed[low] >= LITERALS))
    full = np.flatnonzero(some & ~few)
    starts = np.concatenate([begin[full], begin[right], at[fixed[end[left]] - LITERALS]])
    ends = np.concatenate([end[full], at[fixed[begin[right]] + LITERALS - 1] + 1, end[left]])
    hashed = Hashed(np.where(kinds > 0, _PLACEHOLDERS[kinds], words.hashes))
    return literal, Templates(hashed.of(starts, ends), np.concatenate([full, right, left]), starts, ends), text


def window_starts(words: Words) -> np.ndarray:
    """The first word of each window, in the order of ``shingles_of``."""
    count = np.diff(words.first)
    n = np.where(count > 0, np.maximum(count - SHINGLE + 1, 1), 0)
    ends = np.cumsum(n)
    return np.arange(ends[-1] if len(n) else 0) - np.repeat(ends - n, n) + np.repeat(words.first[:-1], n)


@dataclass
class Block:
    """Windows and templates of some benchmark items, sorted by hash."""

    items: list
    windows: np.ndarray  # windows of each item
    tables: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # for literal and template: hash, item, window or template
    first: np.ndarray
    templates: Templates
    hashes: np.ndarray
    kinds: np.ndarray

    @classmethod
    def of(cls, items: list, texts: list[str]) -> "Block":
        words, kinds = canonical(pa.array(texts, pa.large_string()))
        literal, templates, text = windows_of(words, kinds)
        tables = []
        for h, item in ((literal, text), (templates.hashes, text[templates.windows])):
            order = np.argsort(h, kind="stable")
            tables.append((h[order], item[order], order))
        return cls(items, np.bincount(text, minlength=len(items)), tables, words.first, templates, words.hashes, kinds)


def _hits(h: np.ndarray, table: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each equal pair: the window or template here, the item and its one."""
    ordered, item, window = table
    low, high = np.searchsorted(ordered, h, "left"), np.searchsorted(ordered, h, "right")
    n = high - low
    some = np.flatnonzero(n)
    at = np.repeat(low[some], n[some]) + np.arange(n[some].sum()) - np.repeat(np.cumsum(n[some]) - n[some], n[some])
    return np.repeat(some, n[some]), item[at], window[at]


def _consistent(pairs: list[tuple[int, int, list[tuple[int, int, int]]]]) -> set[int]:
    """The item windows whose slots fit one assignment of values: an item's value stands for one value here.

    The assignment takes the pairs seen most often first; for names and numbers it is one to one.
    """
    seen = Counter(p for _, _, slots in pairs for p in set(slots))
    to, back = {}, {}
    for kind, own, here in sorted(seen, key=lambda p: (-seen[p], p)):
        if (kind, own) not in to and (kind == UNIT or (kind, here) not in back):
            to[kind, own], back[kind, here] = here, own
    return {w for w, _, slots in pairs if all(to.get((k, own)) == here for k, own, here in slots)}


def _best(pairs: list[tuple[int, int, list[tuple[int, int, int]]]], literal: set[int], span: int, least: float) -> set[int]:
    """The most windows of an item in one place: the literal ones, and templates that fit one assignment there.

    ``pairs`` are window, place in the document minus that in the item, and slots. A place is one such difference, or all
    from one up to ``span``, the item's length, as words may be put in or left out; so other copies nearby or chance
    hits far away have values of their own. Places with fewer than ``least`` windows are passed over.
    """
    pairs = sorted(pairs, key=lambda p: p[1])
    best = literal | _consistent(pairs)
    held: Counter = Counter()
    low = high = 0
    while low < len(pairs):
        place, same = pairs[low][1], low
        while same < len(pairs) and pairs[same][1] == place:
            same += 1
        while high < len(pairs) and pairs[high][1] < place + span:
            held[pairs[high][0]] += pairs[high][0] not in literal
            high += 1
        most = len(literal) + len(+held) if len(literal) + len(held) > len(best) else 0
        if most > len(best) and most >= least:
            best = max([best, *(literal | _consistent(pairs[low:end]) for end in {same, high})], key=len)
        for w, _, _ in pairs[low:same]:
            held[w] -= w not in literal
            if not held[w]:
                del held[w]
        low = same
    return best


def items_found(block: Block, texts: pa.Array, covered: float) -> list[list[tuple[object, float]]]:
    """For each text the items of which it holds the share ``covered`` of the windows, with that share."""
    words, kinds = canonical(texts)
    literal, templates, text = windows_of(words, kinds)
    out: list[list[tuple[object, float]]] = [[] for _ in range(len(texts))]
    got: dict[tuple[int, int], set[int]] = defaultdict(set)
    slotted = defaultdict(list)
    for here, item, window in zip(*[x.tolist() for x in _hits(literal, block.tables[0])]):
        got[int(text[here]), item].add(window)
    for here, item, there in zip(*[x.tolist() for x in _hits(templates.hashes, block.tables[1])]):
        a, b = int(block.templates.starts[there]), int(templates.starts[here])
        slots = [(int(block.kinds[a + j]), int(block.hashes[a + j]), int(words.hashes[b + j]))
                 for j in range(int(block.templates.ends[there]) - a) if block.kinds[a + j]]
        slotted[int(text[templates.windows[here]]), item].append((int(block.templates.windows[there]), b - a, slots))
    for key, pairs in slotted.items():
        item = key[1]
        got[key] = _best(pairs, got[key], int(block.first[item + 1] - block.first[item]), covered * block.windows[item])
    for (t, item), windows in got.items():
        share = len(windows) / block.windows[item]
        if share >= covered:
            out[t].append((block.items[item], float(share)))
    return [sorted(x, key=lambda p: (p[0] is None, p[0])) for x in out]


def with_items(docs: DataFrame, benchmark: DataFrame, covered: float = COVERED, block_bytes: int = BLOCK_BYTES,
               name: str = FOUND) -> DataFrame:
    """``docs`` with a column of the benchmark items it holds: ``array<struct<item_id, share>>`` under a new ``name``.

    Windows of five words are taken twice: as they are, and as templates in which numbers, units and names
    are typed placeholders. Both are joined by hash, on the map side: the windows of the benchmark are
    broadcast, in blocks of ``block_bytes`` of text, one pass for each block, so a benchmark of any size is
    handled and no document is shuffled. Template windows count if their slots fit one assignment of values in one place.
    An item with fewer than ``LITERALS`` words outside slots has no templates and is found as it is only.

    Null and empty texts hold nothing, and null or empty items are found nowhere; an item of fewer than five
    words is found only in a text that consists of it. Repeated rows and items count each on its own; other
    columns pass through; empty tables give no rows, or rows without items.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    items = benchmark.select("item_id", "text").filter(F.length("text") > 0)
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).head()[0]
    n_blocks = max(1, math.ceil(size / block_bytes))
    kind = benchmark.schema["item_id"].dataType.simpleString()
    place = docs.columns.index("text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    schema += f", {name} array<struct<item_id:{kind},share:double>>"
    for number in range(n_blocks):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == number).collect()
        shared = spark.sparkContext.broadcast(Block.of([r.item_id for r in rows], [r.text for r in rows]))
        first = number == 0

        def find(batches, shared=shared, first=first):
            for batch in batches:
                for part in slices(batch, docs_text):
                    found = items_found(shared.value, text_of(part, docs_text), covered)
                    found = [[{"item_id": i, "share": s} for i, s in f] for f in found]
                    if not first:
                        found = [a + b for a, b in zip(part.column(name).to_pylist(), found)]
                        part = part.drop_columns([name])
                    yield part.append_column(name, pa.array(found, pa.list_(pa.struct([("item_id", item_type), ("share", pa.float64())]))))

        docs_text, item_type = docs.columns[place], _arrow_type(kind)
        docs = docs.mapInArrow(find, schema)
        if number < n_blocks - 1:
            docs = written(docs, "decontaminated")
    return docs


def _arrow_type(kind: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]


def contamination(docs: DataFrame, benchmark: DataFrame, covered: float = COVERED) -> DataFrame:
    """``doc_id, contaminated, item_ids, share`` for every row: the items found and the largest share."""
    return with_items(docs.select("doc_id", "text"), benchmark, covered).select(
        "doc_id", (F.size(FOUND) > 0).alias("contaminated"), F.col(f"{FOUND}.item_id").alias("item_ids"),
        F.array_max(f"{FOUND}.share").alias("share"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, covered: float = COVERED) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, see ``with_items``."""
    found = unused(docs, FOUND)
    return with_items(docs, benchmark, covered, name=found).filter(F.size(found) == 0).drop(found)
