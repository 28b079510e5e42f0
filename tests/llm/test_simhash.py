"""SimHash classes and the index in Gray order against brute force."""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from goldthread.llm import simhash
from goldthread.llm.gray_index import GrayIndex, gray_rank
from fixtures import odd_documents, prose


def plain_fingerprint(text: str | None) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    grams = [" ".join(words[i:i + 4]) for i in range(max(len(words) - 3, min(1, len(words))))]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(codes, most: int = 4) -> list[int]:
    """For each code the place of the first one in its component."""
    codes, root = np.array(codes, np.uint64), list(range(len(codes)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(codes)):
        for j in np.flatnonzero(np.bitwise_count(codes ^ codes[i]) <= most):
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(codes))]


def crowd(seed: int, n: int, centres: int, bits: int, flips: int) -> np.ndarray:
    """Codes around a few centres that differ from them in some of a few bits, in Gray order."""
    rng = np.random.default_rng(seed)
    codes = rng.choice(rng.integers(0, 1 << 63, centres, dtype=np.uint64), n)
    for _ in range(flips):
        codes ^= np.uint64(1) << rng.choice(rng.choice(64, bits, replace=False), n).astype(np.uint64)
    codes = np.unique(codes)
    return codes[np.argsort(gray_rank(codes))]


def same_partition(a, b) -> bool:
    ways = defaultdict(set)
    for x, y in zip(a, b):
        ways[x].add(y)
    return all(len(v) == 1 for v in ways.values()) and len(ways) == len(set(b))


@pytest.mark.parametrize("stretch", [1, 7, 50])
def test_long_texts_are_taken_in_stretches(monkeypatch, stretch):
    monkeypatch.setattr(simhash, "_STRETCH", stretch)
    for text in ("", " ", "a", "A b", "a  b\tc ", "one two three four", " one two three four five", prose(3, 90), "x" * 200 + " y", "é 漢字 ß\n" * 9):
        assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


def test_gray_neighbours_differ_in_one_bit():
    codes = np.arange(1024, dtype=np.uint64)
    ordered = codes[np.argsort(gray_rank(codes))]
    assert set(np.bitwise_count(ordered[1:] ^ ordered[:-1]).tolist()) == {1}


@pytest.mark.parametrize("seed", range(8))
def test_index_joins_what_is_near(seed):
    groups = [crowd(seed * 10 + i, n, 1 + i, 20 + 10 * i, 5) for i, n in enumerate((1, 17, 300, 700))]
    index = GrayIndex(np.concatenate(groups), np.array([len(g) for g in groups]))
    index.join_within(4)
    at = 0
    for group in groups:
        assert (index.label[at:at + len(group)] - at).tolist() == classes(group)
        at += len(group)


@pytest.mark.parametrize("blocks", [5, 6, 7, 8])
def test_close_codes_agree_below_a_pattern(blocks):
    rng = np.random.default_rng(blocks)
    masks = simhash.block_masks(blocks, 4)
    for _ in range(500):
        flipped = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
        assert any(flipped & m == 0 for m in masks)


def test_blocks_grow_with_the_codes():
    assert [simhash.blocks_for(n, 4) for n in (0, 400_000, 500_000, 10**8, 10**9, 10**11, 10**13)] == [5, 5, 6, 6, 7, 8, 8]


@pytest.mark.parametrize("tile,held", [(16, 64), (64, 100), (50, 10_000)])
def test_cut_groups_are_joined_by_tiles(monkeypatch, tile, held):
    """Tasks that hold little, and tiles of few codes: what one task cannot see is found between tiles."""
    monkeypatch.setattr(simhash, "TILE", tile)
    monkeypatch.setattr(simhash, "_HELD", held)
    codes = crowd(5, 900, 3, 22, 4)
    parts = np.array_split(codes, 3)
    out = []
    for part in parts:
        batches = [pa.RecordBatch.from_pydict({
            "code": pa.array(p.view(np.int64)), "pattern": pa.array(np.zeros(len(p), np.int64)), "value": pa.array(np.zeros(len(p), np.int64))})
            for p in np.array_split(part, 7)]
        out += [row for b in simhash._index(4)(batches) for row in b.to_pylist()]
    links = [(r["a"], r["b"]) for r in out if r["a"] is not None]
    tiles = [r for r in out if r["tile"] is not None]
    assert sum(len(r["codes"]) // 8 for r in tiles) == len(codes) and len({r["tile"] for r in tiles}) == len(tiles)
    pairs = [{f"{c}_{s}": x[c] for s, x in (("a", a), ("b", b)) for c in ("codes", "labels")} for a in tiles for b in tiles if a["tile"] < b["tile"]]
    across = simhash._join_tiles(4)([pa.RecordBatch.from_pylist(pairs)]) if pairs else []
    links += [tuple(r.values()) for b in across for r in b.to_pylist()]
    place = {c: i for i, c in enumerate(codes.view(np.int64).tolist())}
    root = list(range(len(codes)))
    for _ in range(len(codes)):
        before = list(root)
        for a, b in links:
            low = min(root[place[a]], root[place[b]])
            root[place[a]] = root[place[b]] = low
        if root == before:
            break
    assert same_partition(root, classes(codes))


def test_links_of_a_crowd_larger_than_a_tile(spark):
    codes = np.concatenate([crowd(9, 16_000, 1, 26, 6), crowd(10, 300, 300, 64, 2)])
    frame = spark.createDataFrame([(c,) for c in codes.view(np.int64).tolist()], "code long").repartition(3)
    from goldthread.llm.components import components
    found = {r.node: r.component for r in components(simhash.code_links(frame)).collect()}
    got = [found.get(c, c) for c in codes.view(np.int64).tolist()]
    assert len(codes) > 8192 and same_partition(got, classes(codes))


def test_classes_equal_brute_force(spark):
    base = prose(21, 60)
    words = base.split()
    copies = [" ".join(words[:i] + ["other"] + words[i + 1:]) for i in range(0, 60, 7)] + [base, base.upper(), base.replace(" ", " \t\n")]
    docs = odd_documents(spark, *copies, "ein zwei", "EIN  ZWEI", "a b c d", "a b c d e", "\x1c \x1d", "  x")
    rows = [r.asDict() for r in docs.select("doc_id", "text").collect()]
    codes = [plain_fingerprint(r["text"]) for r in rows]
    least = defaultdict(list)
    for row, c in zip(rows, classes(codes)):
        least[c] += [row["doc_id"]] * (row["doc_id"] is not None)
    want = sorted((str(r["doc_id"]), f"{code:016x}", min(least[c], default=None))
                  for r, code, c in zip(rows, codes, classes(codes)))
    got = sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in simhash.simhash_classes(docs).collect())
    assert got == want and any(x[0] == "None" for x in got)


def test_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, code long, component string")
    out = simhash.simhash_classes(empty)
    assert out.columns == ["doc_id", "fingerprint", "component_id"] and out.count() == 0
