"""Near-duplicates by consistent weighted sampling of TF-IDF shingles, in bands, verified by weighted Jaccard similarity."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from goldthread.llm.common import ROW, bound_batches, shared_path, slices, text_of, unused, with_rows, written
from goldthread.llm.components import components
from goldthread.llm.phrases import seen_filter
from goldthread.llm.words import Words, divided, mix, shingles_of, words_of

SIMILAR, BANDS, DRAWS = 0.8, 16, 4
#: The table of document frequencies: rows and slots, and parts in which it is added up.
SKETCH_ROWS, SKETCH_BITS, SKETCH_PARTS = 2, 18, 64
#: Weight up to which all elements take part in every draw; from ``SIMILAR`` of it on they are dealt to bins.
LIGHT = 128.0
#: Members of a bucket up to which all pairs across components are compared at once; rounds through larger ones before
#: they are settled.
SMALL, MOST_TURNS, REACH = 12, 4, 4
#: Links, as a share of the members of large buckets, that a round has to find for another one.
WORTH = 0.05
#: Documents of a bucket that are chained, or settled, together; beyond, groups and pairs of groups are.
GROUP = 4096
#: Candidate texts per bucket of their table.
PLACED_ROWS = 4096
#: Bins in which the shingles of a text are added up for a bound on its similarity, and how many of a coarser bound.
BINS, COARSE = 512, 64
_SEED = mix(np.arange(4096, dtype=np.uint64) + np.uint64(0xC0FFEE))
_WIDTH = 1 << SKETCH_BITS


def elements(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct shingles of each text: hash, text number, how often; texts in order."""
    h, text = shingles_of(words)
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    return h[at], text[at], np.diff(np.append(at, len(h)))


def _slots(h: np.ndarray) -> list[np.ndarray]:
    return [((h >> np.uint64(64 - SKETCH_BITS * (r + 1))) & np.uint64(_WIDTH - 1)).astype(np.int64) for r in range(SKETCH_ROWS)]


class Weights:
    """Inverse document frequencies from a table of fixed size, in proportion to the largest.

    A shingle's frequency is the least of its slots, at most too high by what else fell into them: a fixed
    share of all documents, whatever their number. So rare shingles weigh nearly alike, and those that a
    noticeable share of all documents hold weigh less.
    """

    def __init__(self, counts: np.ndarray, documents: int):
        self.idf = (np.log1p(documents / np.maximum(counts, 1)) / np.log1p(max(documents, 1))).astype(np.float64)

    def of(self, h: np.ndarray, times: np.ndarray) -> np.ndarray:
        return times * np.max([row[s] for row, s in zip(self.idf, _slots(h))], axis=0)


def document_frequencies(docs: DataFrame) -> Weights:
    """Count all shingles of all documents: tables of fixed size per task, added up part by part."""
    size = _WIDTH // SKETCH_PARTS
    schema = "part int, documents long, counts binary"

    def pack(documents: int, tables: dict[int, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({
            "part": pa.array(list(tables), pa.int32()), "documents": pa.array([documents] * len(tables), pa.int64()),
            "counts": pa.array([t.astype("<i8").tobytes() for t in tables.values()], pa.binary())})

    def count(batches) -> Iterator[pa.RecordBatch]:
        table, documents = np.zeros((SKETCH_ROWS, _WIDTH), np.int64), 0
        for batch in batches:
            for part in slices(batch):
                h, _, _ = elements(words_of(divided(text_of(part))))
                documents += len(part)
                for row, slot in zip(table, _slots(h)):
                    row += np.bincount(slot, minlength=_WIDTH)
        if documents:
            yield pack(documents, {p: table[:, p * size:(p + 1) * size] for p in range(SKETCH_PARTS)})

    def add(batches) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        documents: dict[int, int] = {}
        for batch in batches:
            for row in batch.to_pylist():
                own = np.frombuffer(row["counts"], "<i8").reshape(SKETCH_ROWS, size)
                sums[row["part"]] = sums.get(row["part"], 0) + own
                documents[row["part"]] = documents.get(row["part"], 0) + row["documents"]
        for part, table in sums.items():
            yield pack(documents[part], {part: table})

    rows = (docs.select("text").mapInArrow(count, schema).repartition(SKETCH_PARTS // 4, "part")
            .mapInArrow(add, schema).collect())
    table = np.zeros((SKETCH_ROWS, _WIDTH), np.int64)
    for row in rows:
        table[:, row.part * size:(row.part + 1) * size] = np.frombuffer(row.counts, "<i8").reshape(SKETCH_ROWS, size)
    return Weights(table, rows[0].documents if rows else 0)


def draw(h: np.ndarray, log_weight: np.ndarray, seed: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Improved consistent weighted sampling: for each element its rank, and the hash of element and level.

    The element with the least rank is the sample of its set. Two sets draw the same element at the same level
    with a chance equal to their weighted Jaccard similarity.
    """
    a = mix(h ^ seed)
    b = mix(a + np.uint64(0x9E3779B97F4A7C15))
    c = mix(b + np.uint64(0x9E3779B97F4A7C15))
    half, unit = np.uint64(32), 2.0 ** -32

    def uniform(x: np.ndarray) -> np.ndarray:
        return ((x & np.uint64(0xFFFFFFFF)).astype(np.float64) + 0.5) * unit

    r = -np.log(uniform(a) * uniform(a >> half))
    level = np.floor(log_weight / r + uniform(c))
    log_y = r * (level - uniform(c))
    rank = np.log(-np.log(uniform(b) * uniform(b >> half))) - log_y - r
    return rank, mix(h + mix(level.astype(np.int64).view(np.uint64)))


def band_keys(h: np.ndarray, text: np.ndarray, weight: np.ndarray, n_texts: int) -> tuple[list[list[int]], np.ndarray]:
    """The band keys of each text and its weight.

    A heavy text deals its elements to ``BANDS`` bins, anew for each of ``DRAWS`` draws, and draws one
    element from each bin; a band is the same bin of all draws. In a light text bins would be empty, so all its
    elements take part in every draw. Texts whose weights allow them to be similar have at least one way in common.
    """
    total = np.bincount(text, weight, minlength=n_texts)
    log_weight = np.log(weight)
    keys: list[list[int]] = [[] for _ in range(n_texts)]

    def close(samples: np.ndarray, use: np.ndarray, salt: int) -> None:
        band = mix((samples * _SEED[:DRAWS, None]).sum(axis=1) ^ (_SEED[100 + salt:100 + salt + BANDS])).view(np.int64)
        for t in np.flatnonzero(use).tolist():
            keys[t] += band[t].tolist()

    own = total[text] >= SIMILAR * LIGHT * 0.999
    if own.any():
        eh, et, ew = h[own], text[own], log_weight[own]
        samples = np.zeros((n_texts, DRAWS, BANDS), np.uint64)
        for d in range(DRAWS):
            slot = et * BANDS + (mix(eh ^ _SEED[10 + d]) % np.uint64(BANDS)).astype(np.int64)
            rank, sample = draw(eh, ew, _SEED[20 + d])
            least = np.full(n_texts * BANDS, np.inf)
            np.minimum.at(least, slot, rank)
            best = rank == least[slot]
            flat = np.zeros(n_texts * BANDS, np.uint64)
            flat[slot[best]] = sample[best]
            samples[:, d] = flat.reshape(n_texts, BANDS)
        close(samples, total >= SIMILAR * LIGHT * 0.999, 0)
    own = (total[text] <= LIGHT)
    if own.any():
        eh, et, ew = h[own], text[own], log_weight[own]
        first = np.flatnonzero(np.append(True, et[1:] != et[:-1]))
        samples = np.zeros((n_texts, DRAWS, BANDS), np.uint64)
        for d in range(DRAWS):
            for b in range(BANDS):
                rank, sample = draw(eh, ew, _SEED[200 + d * BANDS + b])
                least = np.minimum.reduceat(rank, first)
                best = rank == np.repeat(least, np.diff(np.append(first, len(et))))
                samples[et[best], d, b] = sample[best]
        close(samples, (total > 0) & (total <= LIGHT), 50)
    return keys, total


def signatures(rows: DataFrame, weights: Weights) -> DataFrame:
    """For each row the 128-bit hash of its words in order, its weight, and its band keys; null keys without words."""
    shared = rows.sparkSession.sparkContext.broadcast(weights)

    def sign(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                words = words_of(divided(text_of(part)))
                h, text, times = elements(words)
                n = len(part)
                keys, total = band_keys(h, text, shared.value.of(h, times), n) if len(h) else ([[]] * n, np.zeros(n))
                place = np.arange(len(words.hashes)) - words.first[words.text]
                some = np.flatnonzero(np.diff(words.first))
                ids = []
                for salt in _SEED[1000:1002]:
                    own = np.zeros(n, np.uint64)
                    if len(some):
                        own[some] = np.add.reduceat(mix(words.hashes + (place.astype(np.uint64) + np.uint64(1)) * salt), words.first[some])
                    ids.append(pa.array(own.view(np.int64), mask=np.diff(words.first) == 0))
                yield pa.RecordBatch.from_pydict({
                    ROW: part.column(ROW), "doc_id": part.column("doc_id"), "k1": ids[0], "k2": ids[1],
                    "weight": pa.array(total, pa.float64()), "bands": pa.array(keys, pa.list_(pa.int64()))})

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select(ROW, "doc_id", "text").mapInArrow(
        sign, f"{ROW} long, doc_id {kind}, k1 long, k2 long, weight double, bands array<long>")


def similarities(pairs: DataFrame, weights: Weights) -> DataFrame:
    """``a, b, similarity`` of pairs of texts (``a``, ``b``, ``text_a``, ``text_b``): their exact Jaccard similarity.

    It is the weighted one, or that of the plain shingle sets where this is larger: a pair that counts as a
    near-copy by either is one.
    """
    shared = pairs.sparkSession.sparkContext.broadcast(weights)

    def compare(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text_a", 1 << 20):
                sides = [elements(words_of(divided(text_of(part, c)))) for c in ("text_a", "text_b")]
                h, pair = (np.concatenate([s[i] for s in sides]) for i in (0, 1))
                w = np.concatenate([shared.value.of(s[0], s[2]) for s in sides])
                order = np.lexsort((h, pair))
                h, pair, w = h[order], pair[order], w[order]
                same = np.flatnonzero((h[1:] == h[:-1]) & (pair[1:] == pair[:-1])) if len(h) else np.zeros(0, np.int64)
                both = np.bincount(pair[same], np.minimum(w[same], w[same + 1]), minlength=len(part))
                either = np.bincount(pair, w, minlength=len(part)) - both
                shared_n = np.bincount(pair[same], minlength=len(part))
                plain = shared_n / np.maximum(np.bincount(pair, minlength=len(part)) - shared_n, 1)
                yield pa.RecordBatch.from_pydict({
                    "a": part.column("a"), "b": part.column("b"), "similarity": pa.array(np.maximum(both / np.maximum(either, 1e-300), plain))})

    return pairs.mapInArrow(compare, "a long, b long, similarity double")


def _distinct_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.filter("y IS NOT NULL AND x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _likely(rows: DataFrame, members: DataFrame) -> DataFrame:
    """``node, text`` of the rows that are among ``members`` (``node``) and of few others: a filter of bounded size, no shuffle."""
    shared = rows.sparkSession.sparkContext.broadcast(seen_filter(members.select(F.col("node").alias("gram")), 64))

    def let_through(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(shared.value.has(batch.column("node").to_numpy().astype(np.uint64))))

    return rows.select(F.col(ROW).alias("node"), "text").mapInArrow(let_through, "node long, text string")


@contextmanager
def placed(texts: DataFrame, rows: int) -> Iterator[DataFrame]:
    """``texts``, some ``rows``, as a table bucketed by ``node`` for as long as the block lasts: joins on ``node`` do not shuffle it.

    The files are in the shared folder.
    """
    spark = texts.sparkSession
    parts, name = max(1, math.ceil(rows / PLACED_ROWS)), f"placed_{uuid.uuid4().hex}"
    texts.repartition(parts, "node").write.bucketBy(parts, "node").option("path", shared_path(spark, "candidates")).saveAsTable(name, format="parquet")
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs ``a, b`` with ``text_a`` and ``text_b``, from ``placed`` texts: pairs are shuffled, once with a text."""
    for c in "ab":
        pairs = pairs.join(texts.select(F.col("node").alias(c), F.col("text").alias(f"text_{c}")), c)
    return pairs


def _grouped(turn: int):
    """The group of a member in its bucket, of about ``GROUP`` members at the most; another one in each bucket and turn."""
    return F.pmod(F.xxhash64("node", "band", F.lit(turn)), F.ceil(F.col("n") / GROUP))


def _neighbours(buckets: DataFrame, order, reach: int = 1, turn: int = -1) -> DataFrame:
    """Pairs ``x, y`` of members of a bucket that are at most ``reach`` places apart in an order.

    Neighbours are taken in groups, dealt anew for each bucket and turn, and the heads of a bucket's groups are
    neighbours too, so no task holds a whole hot bucket.
    """
    salted = buckets.withColumns({"group": _grouped(turn), "at": F.struct(order, "node")})
    ahead = Window.partitionBy("band", "group").orderBy("at")
    met = salted.select(F.col("node").alias("x"), F.array(*[F.lead("node", d).over(ahead) for d in range(1, reach + 1)]).alias("met"))
    near = met.select("x", F.explode("met").alias("y"))
    heads = salted.filter(F.col("n") > GROUP).groupBy("band", "group").agg(F.min("at").alias("head"))
    heads = heads.select(F.col("head.node").alias("x"), F.lead("head.node").over(
        Window.partitionBy("band").orderBy("head")).alias("y"))
    return near.union(heads)


def _distinct_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.filter("y IS NOT NULL AND x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _open_members(buckets: DataFrame, joined: DataFrame) -> DataFrame:
    """Members, with their component, of the buckets that lie in several components."""
    members = buckets.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    parts = members.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return members.join(parts.filter("low <> high").select("band"), "band")


def _across(members: DataFrame) -> DataFrame:
    """All pairs of members of a bucket that are in different components, for buckets of at most ``SMALL`` members."""
    small = members.filter(F.col("n") <= SMALL)
    one = small.select("band", F.col("node").alias("x"), F.col("component").alias("cx"))
    other = small.select("band", F.col("node").alias("y"), F.col("component").alias("cy"))
    return one.join(other, "band").filter("x < y AND cx <> cy").select("x", "y")


def sketches(texts: DataFrame, weights: Weights) -> DataFrame:
    """``node, sketch``: the weights of a text's shingles, and their number, added up in ``BINS`` bins by hash."""
    shared = texts.sparkSession.sparkContext.broadcast(weights)

    def sketch(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                h, text, times = elements(words_of(divided(text_of(part))))
                slot = text * BINS + (mix(h ^ _SEED[3000]) % np.uint64(BINS)).astype(np.int64)
                sums = [np.bincount(slot, w, minlength=len(part) * BINS).reshape(-1, BINS)
                        for w in (shared.value.of(h, times), np.ones(len(h)))]
                yield pa.RecordBatch.from_pydict({"node": part.column("node"), "sketch": pa.array(
                    [row.tobytes() for row in np.stack(sums, 1).astype("<f4")], pa.binary())})

    return texts.select("node", "text").mapInArrow(sketch, "node long, sketch binary")


def _settled(similar: float):
    """For a pair of groups of a bucket, or one with itself: each member with those of other components that may be similar.

    What two texts share is at most what their bins share, so no pair with similarity ``similar`` is left out.
    """
    def settle(key, table):
        low, high = key[1].as_py(), key[2].as_py()
        node, component, group = (table.column(c).to_numpy() for c in ("node", "component", "group"))
        bins = np.frombuffer(b"".join(table.column("sketch").to_pylist()), "<f4").reshape(len(node), 2, BINS)
        total = bins.sum(2, dtype=np.float64)
        levels = [total[:, :, None], bins.reshape(len(node), 2, COARSE, -1).sum(3), bins]
        x, met = [], []
        for i in np.flatnonzero(group == low).tolist():
            other = np.flatnonzero((group == high) & (component != component[i]))
            other = other[other > i] if low == high else other
            for level in levels:
                both = np.minimum(level[other], level[i]).sum(2)
                # The margin covers the rounding of the sums.
                other = other[(both >= (similar - 1e-3) * (total[other] + total[i] - both)).any(1)]
            if len(other):
                x.append(node[i])
                met.append(node[other])
        return pa.table({"x": pa.array(x, pa.int64()), "met": pa.array(met, pa.list_(pa.int64()))})

    return settle


def _possible(members: DataFrame, texts: DataFrame, weights: Weights, similar: float) -> DataFrame:
    """All pairs ``x, y`` of members of a bucket that are in different components, but those that cannot be similar.

    A bucket is dealt to groups, and every pair of its groups is settled as one: a task holds two groups at the most.
    """
    known = written(sketches(texts.join(members.select("node").distinct(), "node", "left_semi"), weights), "sketches")
    dealt = (members.select("node", "band", "n", "component").withColumn("group", _grouped(MOST_TURNS))
             .withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("n") / GROUP) - 1)))
             .select("node", "component", "band", "group", F.least("group", "with").alias("low"), F.greatest("group", "with").alias("high")))
    met = dealt.join(known, "node").groupBy("band", "low", "high").applyInArrow(_settled(similar), "x long, met array<long>")
    return met.select("x", F.explode("met").alias("y"))


def near_duplicate_classes(rows: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """``__row, doc_id, component`` for every row: rows of a component are linked by pairs with similarity ``similar``.

    Texts with the same words in the same order are one node. Nodes that share a band key are candidates. First
    neighbours in each bucket, ordered by weight, are compared: a bucket of copies costs as many pairs as it has
    members and is then one component. For what is not, all pairs across components are compared in buckets
    of at most ``SMALL`` members. Larger buckets are gone through again, in another random order each time,
    as long as that finds many links and ``MOST_TURNS`` times at the most; this only joins components cheaply. What is still
    open is then settled: all pairs across components are held against a bound, and those that it lets pass are compared.
    So every candidate pair ends in one component or was found too different.
    """
    weights = document_frequencies(rows)
    signed = written(signatures(rows, weights), "signatures")
    nodes = written(signed.filter("k1 IS NOT NULL").groupBy("k1", "k2").agg(
        F.min(F.struct(ROW, "weight", "bands")).alias("x")).select(
        "k1", "k2", F.col(f"x.{ROW}").alias("node"), "x.weight", "x.bands"), "nodes")
    banded = nodes.select("node", "weight", F.explode("bands").alias("band"))
    sizes = banded.groupBy("band").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    buckets = written(banded.join(sizes, "band"), "buckets")
    members = written(buckets.select("node").distinct(), "members")
    with placed(_likely(rows, members).join(members, "node", "left_semi"), members.count()) as texts:
        joined = _joined(buckets, texts, weights, similar)
    owners = signed.select(ROW, "doc_id", "k1", "k2").join(nodes.select("k1", "k2", "node"), ["k1", "k2"], "left")
    return owners.join(joined, "node", "left").select(
        ROW, "doc_id", F.coalesce("component", "node", ROW).alias("component"))


def _joined(buckets: DataFrame, texts: DataFrame, weights: Weights, similar: float) -> DataFrame:
    """``node, component`` of the members of buckets that have a link; ``texts`` are read here only."""
    def compared(pairs: DataFrame) -> DataFrame:
        return written(similarities(with_texts(pairs, texts), weights), "compared")

    seen = compared(_distinct_pairs(_neighbours(buckets, "weight")))
    def links() -> DataFrame:
        return components(seen.filter(F.col("similarity") >= similar).select("a", "b"))

    def unseen(pairs: DataFrame, members: DataFrame) -> DataFrame:
        parts = [members.select(F.col("node").alias(c), F.col("component").alias(f"c{c}")).distinct() for c in "ab"]
        return (_distinct_pairs(pairs).join(parts[0], "a").join(parts[1], "b").filter("ca <> cb").select("a", "b")
                .join(seen.select("a", "b"), ["a", "b"], "left_anti"))

    joined = links()
    open_ = written(_open_members(buckets, joined), "open-buckets")
    for turn in range(MOST_TURNS):
        large = open_.filter(F.col("n") > SMALL)
        pairs = _neighbours(large, F.xxhash64("node", F.lit(turn)), REACH, turn)
        pairs = pairs.union(_across(open_)) if turn == 0 else pairs
        more = compared(unseen(pairs, open_))
        seen = seen.union(more)
        found = more.filter(F.col("similarity") >= similar).count()
        if found:
            joined = links()
            members, open_ = large.count(), written(_open_members(buckets, joined), "open-buckets")
        if not found or found < WORTH * members:
            break
    rest = open_.filter(F.col("n") > SMALL)
    if not rest.isEmpty():
        more = compared(unseen(_possible(rest, texts, weights, similar), rest))
        seen = seen.union(more)
        if not more.filter(F.col("similarity") >= similar).isEmpty():
            joined = links()
    return joined


def near_duplicates(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """``doc_id, class_id, class_size`` for every row: the class is the smallest ``doc_id`` of its members.

    A null or empty text, or one without a word, is alone in its class. Repeated rows are one class. A null ``doc_id``
    stays null, and the class of rows that all lack one is null; other columns are ignored; an empty table gives no rows.
    Texts of fewer than five words are compared as one shingle of all their words.
    """
    bound_batches(docs.sparkSession)
    classes = written(near_duplicate_classes(with_rows(docs, "doc_id", "text"), similar), "classes")
    named = classes.groupBy("component").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    return classes.join(named, "component").select("doc_id", "class_id", "class_size")


def without_near_duplicates(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """The rows of ``docs`` with one row of each class: that with the smallest ``doc_id``, nulls last, and of these the first."""
    bound_batches(docs.sparkSession)
    row = unused(docs, ROW)
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    classes = written(near_duplicate_classes(with_rows(docs, "doc_id", "text"), similar), "classes")
    first = classes.groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", ROW)).alias("kept"), F.count(F.lit(1)).alias("n"))
    dropped = classes.join(first.filter("n > 1"), "component").filter(F.col(ROW) != F.col(f"kept.{ROW}")).select(ROW)
    dropped = written(dropped, "dropped").withColumnRenamed(ROW, row)
    return numbered.join(dropped, row, "left_anti").select(*[f"`{c}`" for c in docs.columns])
