"""Near-duplicates by SimHash fingerprints, linked through a hierarchical index in Gray order."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldthread.llm.common import bound_batches, slices, stretches, text_of, written
from goldthread.llm.components import components
from goldthread.llm.gray_index import TILE, GrayIndex, gray_rank, shared_bits

#: Words of a shingle, the seed of its hash, and bits in which linked fingerprints may differ.
SHINGLE, SEED, DIFFERING = 4, 42, 4
#: Fingerprints that a value of a block pattern holds on average before patterns of more blocks are taken.
CROWD = 64
#: A fingerprint of more than this share of all rows is joined to its rows by broadcast; so there are fewer than ``1 / HOT`` of them.
HOT = 0.001
#: Fingerprints of whole groups that a task handles at once.
_HELD = 1 << 16
#: Bytes of a text whose words are told apart at once.
_STRETCH, _SPACE = 1 << 20, re.compile(rb"[\x20\x09-\x0D]")


def _add_votes(votes: np.ndarray, words: list[bytes]) -> int:
    """Count the set bits of the hashes of all shingles of these words, one of all if they are few; how many there are."""
    flat = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *ends[:-1].tolist()]
    last = (ends - 1).tolist()[min(SHINGLE, len(words)) - 1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(flat[a:b], SEED) for a, b in zip(starts, last)), np.uint64, len(last))
    for low in range(0, len(hashes), 1 << 16):
        part = hashes[low:low + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return len(hashes)


def fingerprint(data: bytes) -> int:
    """The SimHash of one text: a bit is set if it is set in over half of the shingles' hashes."""
    votes, n, words = np.zeros(64, np.int64), 0, []
    for part in stretches(data, _SPACE, _STRETCH):
        words += part.lower().split()
        if len(words) >= SHINGLE:
            n += _add_votes(votes, words)
            words = words[1 - SHINGLE:]
    if n == 0 and words:
        n = _add_votes(votes, words)
    return int.from_bytes(np.packbits(2 * votes > n).tobytes(), "big")


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, code`` for every row of ``docs``; the fingerprint as a signed long."""
    def sign(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                codes = [fingerprint(d) for d in pc.cast(text_of(part), pa.large_binary()).to_pylist()]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id"), "code": pa.array(np.array(codes, np.uint64).view(np.int64))})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(sign, f"doc_id {kind}, code long")


def block_masks(blocks: int, differing: int) -> list[int]:
    """Masks of all choices of ``blocks - differing`` of so many blocks of bits: codes that close agree in one of them."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    ones = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(ones, blocks - differing)]


def blocks_for(codes: int, differing: int) -> int:
    """The least number of blocks with which a value of a pattern holds ``CROWD`` evenly spread codes at the most."""
    blocks = differing + 1
    while codes > CROWD * 2.0 ** (64 * (blocks - differing) / blocks) and blocks < 2 * differing:
        blocks += 1
    return blocks


def _index(differing: int):
    """Codes ordered by pattern, its value and Gray rank: their groups linked, and what may go on in another task as tiles."""
    def handle(codes: np.ndarray, pattern: np.ndarray, value: np.ndarray) -> Iterator[pa.RecordBatch]:
        codes = np.ascontiguousarray(codes).view(np.uint64)
        new = np.flatnonzero(np.append(True, (pattern[1:] != pattern[:-1]) | (value[1:] != value[:-1])))
        sizes = np.diff(np.append(new, len(codes)))
        # The first group may have begun before, and the last one may go on.
        cut = (sizes > TILE) | np.isin(np.arange(len(sizes)), [0, len(sizes) - 1])
        parts = -(-sizes // TILE)
        owner = np.repeat(np.arange(len(sizes)), parts)
        place = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        starts = new[owner] + place * TILE
        counts = np.minimum(TILE, sizes[owner] - place * TILE)
        index = GrayIndex(codes, counts)
        index.join_within(differing)
        linked = np.flatnonzero(index.label != np.arange(len(codes)))
        signed = codes.view(np.int64)
        yield _rows(a=signed[linked], b=signed[index.label[linked]])
        for i in np.flatnonzero(cut[owner]).tolist():
            own = slice(starts[i], starts[i] + counts[i])
            mask, bits = shared_bits(codes[own])
            yield _rows(pattern=[pattern[starts[i]]], value=[value[starts[i]]], tile=[signed[starts[i]]], mask=[mask.view(np.int64)],
                        bits=[bits.view(np.int64)], codes=[codes[own].tobytes()],
                        labels=[(index.label[own] - starts[i]).astype("<i4").tobytes()])

    def index(batches) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        n = 0
        for batch in batches:
            held.append(np.stack([batch.column(c).to_numpy() for c in ("code", "pattern", "value")]))
            n += batch.num_rows
            if n >= _HELD:
                now = np.concatenate(held, 1)
                other = np.flatnonzero((now[1:] != now[1:, -1:]).any(0))
                # Up to the last group, or, if there is but one, whole tiles of it.
                cut = int(other[-1]) + 1 if len(other) else n // TILE * TILE
                yield from handle(*now[:, :cut])
                held, n = [now[:, cut:]], n - cut
        if n:
            yield from handle(*np.concatenate(held, 1))

    return index


_COLUMNS = {"a": pa.int64(), "b": pa.int64(), "pattern": pa.int64(), "value": pa.int64(), "tile": pa.int64(), "mask": pa.int64(),
            "bits": pa.int64(), "codes": pa.binary(), "labels": pa.binary()}


def _rows(**columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_pydict({
        c: pa.array(columns[c], kind) if c in columns else pa.nulls(n, kind) for c, kind in _COLUMNS.items()})


def _join_tiles(differing: int):
    """For each pair of tiles of a group: links between their components."""
    def join(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                sides = [np.frombuffer(row[c], np.uint64) for c in ("codes_a", "codes_b")]
                labels = [np.frombuffer(row[c], "<i4").astype(np.int64) for c in ("labels_a", "labels_b")]
                n = len(sides[0])
                index = GrayIndex(np.concatenate(sides), np.array([n, len(sides[1])]))
                index.label = np.concatenate([labels[0], labels[1] + n])
                index.join(np.arange(n), np.ones(n, np.int64), differing)
                # One leaf of each old component tells of all of it.
                roots = np.flatnonzero(np.concatenate([labels[0], labels[1] + n]) == np.arange(len(index.label)))
                roots = roots[index.label[roots] != roots]
                signed = index.codes.view(np.int64)
                yield pa.RecordBatch.from_pydict({"a": pa.array(signed[roots]), "b": pa.array(signed[index.label[roots]])})

    return join


def code_links(codes: DataFrame, differing: int = DIFFERING) -> DataFrame:
    """Links ``a, b`` that join all of the distinct ``code`` within ``differing`` bits of each other into components.

    The upper nodes of the index are patterns of masked bits: bits are cut into blocks, and codes that differ in so few
    bits agree in all but ``differing`` of them, so each pair meets below one pattern. The codes below a pattern are in
    Gray order, sorted by all tasks together, so that a crowded pattern is shared by several. Each task builds the trees of its
    groups and links within them; groups that are cut, by size or between tasks, are tiles of at most ``TILE`` codes, and
    pairs of tiles whose shared bits do not differ too much are linked by way of one tile's tree. A task emits a link per code and pattern
    at the most, not one per pair.
    """
    spark = codes.sparkSession
    masks = block_masks(blocks_for(codes.count(), differing), differing)
    rank = F.col("code")
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
        codes = codes.withColumn("rank", rank)
        rank = F.col("rank")
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    below = codes.select("code", "rank", F.posexplode(F.array(*[F.col("code").bitwiseAND(F.lit(m).cast("long")) for m in signed]))
                         .alias("pattern", "value")).withColumn("pattern", F.col("pattern").cast("long"))
    ordered = below.repartitionByRange("pattern", "value", "rank").sortWithinPartitions("pattern", "value", "rank")
    schema = ", ".join(f"{c} {'binary' if k == pa.binary() else 'long'}" for c, k in _COLUMNS.items())
    found = written(ordered.select("code", "pattern", "value").mapInArrow(_index(differing), schema), "gray-index")
    tiles = found.filter("tile IS NOT NULL").drop("a", "b")
    several = tiles.groupBy("pattern", "value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    heads = tiles.drop("codes", "labels").join(several, ["pattern", "value"])
    sides = [heads.select("pattern", "value", *[F.col(c).alias(f"{c}_{s}") for c in ("tile", "mask", "bits")]) for s in "ab"]
    near = sides[0].join(sides[1], ["pattern", "value"]).filter("tile_a < tile_b").filter(
        F.bit_count(F.expr("(bits_a ^ bits_b) & mask_a & mask_b")) <= differing).select("pattern", "value", "tile_a", "tile_b")
    for s in "ab":
        side = tiles.select("pattern", "value", *[F.col(c).alias(f"{c}_{s}") for c in ("tile", "codes", "labels")])
        near = near.join(side, ["pattern", "value", f"tile_{s}"])
    across = near.select(*[f"{c}_{s}" for s in "ab" for c in ("codes", "labels")]).mapInArrow(
        _join_tiles(differing), "a long, b long")
    return found.filter("a IS NOT NULL").select("a", "b").union(across)


def simhash_classes(docs: DataFrame, differing: int = DIFFERING) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs`` (``doc_id``, ``text``).

    Fingerprints of at most ``differing`` differing bits are linked, and ``component_id`` is the smallest ``doc_id`` that
    can be reached over links, the row's own included. A null or empty text, or one without a word, has fingerprint zero and is
    linked like any other. A null ``doc_id`` stays null; it takes the class of its component, null where all lack one. Repeated
    rows are rows of one component; other columns are ignored; an empty table gives no rows.
    """
    bound_batches(docs.sparkSession)
    signed = written(fingerprints(docs), "fingerprints")
    codes = written(signed.groupBy("code").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("rows")), "codes")
    joined = components(code_links(codes.select("code"), differing)).select(F.col("node").alias("code"), "component")
    of_code = codes.join(joined, "code", "left").withColumn("component", F.coalesce("component", "code"))
    least = of_code.groupBy("component").agg(F.min("least").alias("component_id"))
    named = written(of_code.join(least, "component").select("code", "rows", "component_id"), "named")
    total = named.agg(F.sum("rows")).head()[0] or 0
    # Fewer than 1 / HOT rows, so that no task gets all rows of a common fingerprint.
    hot = F.broadcast(named.filter(F.col("rows") > HOT * total).select("code", F.lit(True).alias("hot"), "component_id"))
    marked = signed.join(hot, "code", "left")
    rest = marked.filter("hot IS NULL").select("doc_id", "code").join(named.select("code", "component_id"), "code")
    rows = marked.filter("hot").select("doc_id", "code", "component_id").unionByName(rest.select("doc_id", "code", "component_id"))
    return rows.select("doc_id", F.lpad(F.lower(F.hex("code")), 16, "0").alias("fingerprint"), "component_id")
