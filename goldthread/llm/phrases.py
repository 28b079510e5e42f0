"""Collocations: phrases of two to four words that occur more often than their parts explain, counted in stripes."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from goldthread.llm.common import bound_batches, slices, stretches, text_of, written
from goldthread.llm.words import Hashed, mix

#: Occurrences from which a phrase is a candidate, words of the longest one, and phrases returned per language.
LEAST, LONGEST, TOP = 30, 4, 2000
#: Bytes of text that are counted together before their stripes are given out; a worker needs some 150 MB for them.
BLOCK = 1 << 20
#: Words per part of the hashes of phrases, fewest parts, and bits of a hash within a part.
PART_WORDS, FEWEST_PARTS, IN_PART = 1 << 20, 64, 32
#: Bits of a filter per phrase, and bounds of its size (as powers of two): 64 MB at the most.
FILTER_BITS, FILTER_LEAST, FILTER_MOST, FILTER_PARTS = 12, 16, 29, 16
#: Words of more than this share of all words have their stripes cut into ``PARTS``; there are fewer than ``1 / WIDE`` of them.
WIDE, PARTS = 0.001, 32
#: Words of text per part of the packed stripes, bounds of the number of parts, and rows that are unpacked together.
PACKED_WORDS, PACKED_LEAST, PACKED_MOST, UNPACKED_ROWS = 1 << 22, 32, 1024, 5000
_STOP = re.compile(rb"[.,;:!?\x0A-\x0D]")
_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?\n\x0b\x0c\r"]] = True
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Tokens:
    """The words of a block of texts: one blank between two of a piece, so a phrase is a stretch of bytes."""

    def __init__(self, texts: pa.Array, langs: list[str]):
        closed = pc.binary_join_element_wise(texts, pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string()))
        at = np.frombuffer(closed.buffers()[1], np.int64)[closed.offset:closed.offset + len(closed) + 1]
        data = _LOWER[np.frombuffer(closed.buffers()[2], np.uint8)[at[0]:at[-1]]]
        at = at - at[0]
        blank = _BLANK[data]
        kept = ~blank
        kept[1:] |= blank[1:] & ~blank[:-1]
        shift = np.concatenate([[0], np.cumsum(kept)])
        data = np.where(blank, np.uint8(32), data)[kept]
        stop = _BREAK[data]
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = ~stop & (data != 32)
        edge = np.diff(inside)
        self.data, self.starts, self.ends = data, np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        #: Words that end at a blank behind which their piece goes on.
        n = len(self.starts)
        self.goes_on = np.zeros(n + LONGEST, bool)
        self.goes_on[:max(n - 1, 0)] = (self.starts[1:] - self.ends[:-1] == 1) & (data[self.ends[:-1]] == 32)
        self.names = sorted(set(langs))
        codes = {name: i for i, name in enumerate(self.names)}
        text = np.searchsorted(shift[at], self.starts, "right") - 1
        self.lang = np.array([codes[x] for x in langs], np.int64)[text] if n else np.zeros(0, np.int64)
        salts = np.array([xxhash.xxh64_intdigest(name.encode()) for name in self.names], np.uint64)
        self.salt = salts[self.lang] if n else np.zeros(0, np.uint64)
        self.hashed = Hashed(data)

    def whole(self, words: int) -> np.ndarray:
        """The words at which a phrase of so many words begins, as a mask."""
        ok = np.ones(len(self.starts), bool)
        for j in range(words - 1):
            ok &= self.goes_on[j:j + len(ok)]
        return ok

    def hashes(self, at: np.ndarray, words: int) -> np.ndarray:
        """Of the phrases of so many words at ``at``, with their language."""
        return mix(self.hashed.of(self.starts[at], self.ends[at + words - 1]) ^ self.salt[at])

    def langs(self, at: np.ndarray) -> pa.Array:
        return pa.array(self.names, pa.string()).take(pa.array(self.lang[at]))

    def frequent(self, seen: Seen) -> np.ndarray:
        """The words that the filter lets through, as a mask with room behind it."""
        ok = np.zeros(len(self.starts) + LONGEST, bool)
        ok[:len(self.starts)] = seen.has(self.hashes(np.arange(len(self.starts)), 1))
        return ok

    def phrases(self, ok: np.ndarray, words: int) -> np.ndarray:
        """Places of the phrases of so many words all of which are among ``ok``."""
        good = self.whole(words)
        for j in range(words):
            good &= ok[j:j + len(good)]
        return np.flatnonzero(good)

    def texts(self, at: np.ndarray, words: int) -> pa.Array:
        starts, sizes = self.starts[at], self.ends[at + words - 1] - self.starts[at]
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        places = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], sizes)
        return pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(self.data[places])])


class Seen:
    """A filter of bounded size: phrases of whose hash it was given the first ``short`` bits are always found, others now and then."""

    def __init__(self, bits: np.ndarray, short: int):
        self.bits, self.size, self.short = bits, 8 * len(bits), short

    def has(self, hashes: np.ndarray) -> np.ndarray:
        slot = mix(hashes >> np.uint64(64 - self.short)) % np.uint64(self.size)
        return (self.bits[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _grouped(tokens: Tokens, at: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Phrases of so many words at ``at`` by equality: a number for each, and for each number the first place.

    Equal hashes of different phrases are told apart by a second hash, made of the phrase's first and last halves.
    """
    first, number = np.unique(tokens.hashes(at, words), return_index=True, return_inverse=True)[1:]
    sizes = tokens.ends[at + words - 1] - tokens.starts[at]
    half = tokens.starts[at] + sizes // 2
    check = tokens.hashed.of(tokens.starts[at], half) * np.uint64(31) + tokens.hashed.of(half, tokens.ends[at + words - 1])
    if not np.array_equal(check, check[first][number]):
        both = np.stack([tokens.hashes(at, words), check], 1)
        first, number = np.unique(both, axis=0, return_index=True, return_inverse=True)[1:]
    return number.reshape(-1), at[first]


def _is_wide(tokens: Tokens, at: np.ndarray, wide: set) -> np.ndarray:
    """Whether the words at ``at`` are among the very common ones of their language."""
    if not wide:
        return np.zeros(len(at), bool)
    hashes = np.array(sorted(wide), np.uint64)
    own = tokens.hashes(at, 1)
    place = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
    return hashes[place] == own


def _stripes(tokens: Tokens, words: int, at: np.ndarray, wide: set) -> pa.RecordBatch | None:
    """The stripes of prefixes of so many words: for each the words that follow it, with counts.

    ``at`` has the places of the prefixes whose next word counts.
    """
    if not len(at):
        return None
    number, first = _grouped(tokens, at, words)
    whole, place = _grouped(tokens, at, words + 1)
    counts = np.bincount(whole, minlength=len(place))
    owner = np.zeros(len(place), np.int64)
    owner[whole] = number
    cut = _is_wide(tokens, first + words - 1, wide)
    part = np.where(cut[owner], 1 + (tokens.hashes(place + words, 1) % np.uint64(PARTS)).astype(np.int64), 0)
    order = np.lexsort((part, owner))
    owner, part, counts, place = owner[order], part[order], counts[order], place[order]
    new = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (part[1:] != part[:-1])))
    offsets = pa.array(np.append(new, len(owner)), pa.int32())
    nexts = tokens.texts(place + words, 1).cast(pa.string())
    row = first[owner[new]]
    return pa.RecordBatch.from_pydict({
        "lang": tokens.langs(row), "words": pa.array(np.full(len(row), words), pa.int32()),
        "prefix": tokens.texts(row, words).cast(pa.string()), "part": pa.array(part[new], pa.int32()),
        "stripe": pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([nexts, pa.array(counts, pa.int64())], ["word", "n"]))})


_STRIPE = "lang string, words int, prefix string, part int, stripe array<struct<word:string,n:bigint>>"
_STRIPE_SCHEMA = pa.schema([
    ("lang", pa.string()), ("words", pa.int32()), ("prefix", pa.string()), ("part", pa.int32()),
    ("stripe", pa.list_(pa.struct([("word", pa.string()), ("n", pa.int64())])))])


def _packed(batch: pa.RecordBatch, parts: int) -> pa.RecordBatch:
    """Stripes in one compressed value for each part of the hashes of their prefixes."""
    prefix = batch.column("prefix")
    at = np.frombuffer(prefix.buffers()[1], np.int32)[prefix.offset:prefix.offset + len(prefix) + 1].astype(np.int64)
    own = mix(Hashed(np.frombuffer(prefix.buffers()[2], np.uint8)).of(at[:-1], at[1:]) ^ batch.column("part").to_numpy().astype(np.uint64)) % np.uint64(parts)
    order = np.argsort(own, kind="stable")
    own, batch = own[order].astype(np.int64), batch.take(pa.array(order))
    starts = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
    raw = [batch.slice(a, b - a).serialize() for a, b in zip(starts, np.append(starts[1:], len(own)))]
    codec = pa.Codec("zstd", 3)
    return pa.RecordBatch.from_pydict({
        "packed": pa.array(own[starts]), "size": pa.array([x.size for x in raw], pa.int64()),
        "rows": pa.array([codec.compress(x, asbytes=True) for x in raw], pa.binary())})


def _unpacked(batches) -> Iterator[pa.RecordBatch]:
    """The stripes of ``_packed``, some thousand rows at a time."""
    codec, held, rows = pa.Codec("zstd"), [], 0
    for batch in batches:
        for size, packed in zip(batch.column("size").to_pylist(), batch.column("rows")):
            held.append(pa.ipc.read_record_batch(codec.decompress(packed.as_buffer(), size), _STRIPE_SCHEMA))
            rows += held[-1].num_rows
            if rows >= UNPACKED_ROWS:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, rows = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _blocks(batches) -> Iterator[Tokens]:
    """Texts of one task, taken together until they are a block."""
    held, langs, size = [], [], 0
    for batch in batches:
        for part in slices(batch, most=BLOCK):
            texts = text_of(part)
            own = pc.sum(pc.binary_length(texts)).as_py() or 0
            if len(texts) == 1 and own > BLOCK:
                # A long text is cut where a piece ends.
                for cut in stretches(texts[0].as_py().encode(), _STOP, BLOCK):
                    yield Tokens(pa.array([cut], pa.large_binary()).cast(pa.large_string()), ["und" if x is None else x for x in part.column("lang").to_pylist()])
                continue
            if held and size + own > BLOCK:
                yield Tokens(pa.concat_arrays(held), langs)
                held, langs, size = [], [], 0
            held.append(texts)
            langs += ["und" if x is None else x for x in part.column("lang").to_pylist()]
            size += own
    if held:
        yield Tokens(pa.concat_arrays(held), langs)


def _cut(batch: pa.RecordBatch | None, rows: int = 20_000) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows if batch is not None else 0, rows):
        yield batch.slice(at, rows)


def word_counts(docs: DataFrame) -> DataFrame:
    """``lang, word, n``: the stripe of the empty prefix."""
    def count(batches) -> Iterator[pa.RecordBatch]:
        for tokens in _blocks(batches):
            at = np.arange(len(tokens.starts))
            if len(at):
                number, first = _grouped(tokens, at, 1)
                yield from _cut(pa.RecordBatch.from_pydict({
                    "lang": tokens.langs(first), "word": tokens.texts(first, 1).cast(pa.string()), "n": pa.array(np.bincount(number), pa.int64())}))

    return docs.select("text", F.col("lang").cast("string")).mapInArrow(count, "lang string, word string, n long").groupBy(
        "lang", "word").agg(F.sum("n").alias("n"))


def _phrase_hash(langs: list[str], phrases: list[str]) -> np.ndarray:
    raw = [p.encode() for p in phrases]
    ends = np.cumsum([len(p) for p in raw], dtype=np.int64) if raw else np.zeros(0, np.int64)
    hashed = Hashed(np.frombuffer(b"".join(raw), np.uint8))
    salts = {x: xxhash.xxh64_intdigest(x.encode()) for x in set(langs)}
    return mix(hashed.of(np.concatenate([[0], ends[:-1]]), ends) ^ np.array([salts[x] for x in langs], np.uint64)) if raw else np.zeros(0, np.uint64)


def seen_filter(hashes: DataFrame, short: int) -> Seen:
    """A filter of the hashes ``gram`` of ``short`` bits: as large as their number asks for, up to a bound; beyond, it lets more through."""
    rows = hashes.count()
    power = min(FILTER_MOST, max(FILTER_LEAST, int(rows * FILTER_BITS).bit_length()))
    size, width = 1 << power, (1 << power) // FILTER_PARTS

    def place(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = mix(batch.column("gram").to_numpy().astype(np.uint64)) % np.uint64(size)
            yield pa.RecordBatch.from_pydict({"slot": pa.array(slot.astype(np.int64)), "part": pa.array((slot // np.uint64(width)).astype(np.int64))})

    def fill(batches) -> Iterator[pa.RecordBatch]:
        parts: dict[int, np.ndarray] = {}
        for batch in batches:
            slot, part = batch.column("slot").to_numpy(), batch.column("part").to_numpy()
            for p in np.unique(part).tolist():
                own = parts.setdefault(p, np.zeros(width, np.uint8))
                own[slot[part == p] - p * width] = 1
        for p, own in parts.items():
            yield pa.RecordBatch.from_pydict({"part": pa.array([p], pa.int64()), "bits": pa.array([np.packbits(own, bitorder="little").tobytes()], pa.binary())})

    bits = np.zeros(size // 8, np.uint8)
    for row in hashes.select("gram").mapInArrow(place, "slot long, part long").repartition(FILTER_PARTS, "part").mapInArrow(
            fill, "part long, bits binary").toLocalIterator():
        bits[row.part * width // 8:(row.part + 1) * width // 8] = np.frombuffer(row.bits, np.uint8)
    return Seen(bits, short)


def word_hashes(words: DataFrame, short: int) -> DataFrame:
    """The first ``short`` bits ``gram`` of the hash of each ``lang, word``."""
    def hashed(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = _phrase_hash(batch.column("lang").to_pylist(), batch.column("word").to_pylist())
            yield pa.RecordBatch.from_pydict({"gram": pa.array((h >> np.uint64(64 - short)).astype(np.int64))})

    return words.select("lang", "word").mapInArrow(hashed, "gram long")


def frequent_hashes(docs: DataFrame, words: Seen, least: int, short: int) -> DataFrame:
    """The first ``short`` bits ``gram`` of the hashes of all phrases of frequent words that occur ``least`` times, and of few others.

    Phrases of equal bits are counted as one, so none is missed. Most phrases are rare: tasks send the bits and counts of a block's phrases
    as arrays, one for each part of the hashes; a part is added up as a whole and has about as many phrases whatever the input.
    """
    shared = docs.sparkSession.sparkContext.broadcast(words)
    # A count of ``least`` says all there is to say.
    kind = "<u1" if least < 256 else "<u4"

    def count(batches) -> Iterator[pa.RecordBatch]:
        for tokens in _blocks(batches):
            ok = tokens.frequent(shared.value)
            hashes = np.concatenate([tokens.hashes(tokens.phrases(ok, m), m) for m in range(2, LONGEST + 1)])
            gram, n = np.unique(hashes >> np.uint64(64 - short), return_counts=True)
            n = np.minimum(n, least).astype(kind)
            part = (gram >> np.uint64(IN_PART)).astype(np.int64)
            starts = np.flatnonzero(np.append(True, part[1:] != part[:-1]))[:len(part)]
            gram, ends = gram.astype("<u4"), np.append(starts, len(part))
            yield from _cut(pa.RecordBatch.from_pydict({
                "part": pa.array(part[starts]), "grams": pa.array([gram[a:b].tobytes() for a, b in zip(ends, ends[1:])], pa.binary()),
                "counts": pa.array([n[a:b].tobytes() for a, b in zip(ends, ends[1:])], pa.binary())}), 1000)

    def total(part: int, grams: list[bytes], counts: list[bytes]) -> pa.RecordBatch:
        gram, n = np.frombuffer(b"".join(grams), "<u4"), np.frombuffer(b"".join(counts), kind)
        order = np.argsort(gram)
        gram = gram[order]
        first = np.flatnonzero(np.append(True, gram[1:] != gram[:-1]))
        found = gram[first[np.add.reduceat(n[order].astype(np.int64), first) >= least]]
        return pa.RecordBatch.from_pydict({"gram": pa.array(found.astype(np.int64) + (part << IN_PART))})

    def add(batches) -> Iterator[pa.RecordBatch]:
        now, grams, counts = None, [], []
        for batch in batches:
            for part, gram, n in zip(*(batch.column(c).to_pylist() for c in ("part", "grams", "counts"))):
                if part != now and grams:
                    yield from _cut(total(now, grams, counts))
                    grams, counts = [], []
                now = part
                grams.append(gram)
                counts.append(n)
        if grams:
            yield from _cut(total(now, grams, counts))

    counted = docs.select("text", F.col("lang").cast("string")).mapInArrow(count, "part long, grams binary, counts binary")
    return counted.repartition("part").sortWithinPartitions("part").mapInArrow(add, "gram long")


def merged(packed: DataFrame, least: int) -> DataFrame:
    """Stripes merged element by element: ``lang, words, prefix, word, n`` of what occurs ``least`` times.

    Stripes are shuffled as they are packed, and added up within a task; then only different elements are shuffled.
    """
    stripes = packed.repartition("packed").select("size", "rows").mapInArrow(_unpacked, _STRIPE)
    return (stripes.select("lang", "words", "prefix", "part", F.inline("stripe"))
            .groupBy("lang", "prefix", "part", "word").agg(F.first("words").alias("words"), F.sum("n").alias("n")).filter(F.col("n") >= least)
            .select("lang", "words", "prefix", "word", "n"))


def stripes(docs: DataFrame, words: Seen, grams: Seen, wide: set, parts: int) -> DataFrame:
    """The stripes of prefixes of one to three words, with those next words that make a frequent phrase, packed in so many parts."""
    shared = docs.sparkSession.sparkContext.broadcast((words, grams, wide))

    def count(batches) -> Iterator[pa.RecordBatch]:
        single, longer, common = shared.value
        for tokens in _blocks(batches):
            ok = tokens.frequent(single)
            made = []
            for m in range(1, LONGEST):
                at = tokens.phrases(ok, m + 1)
                made.append(_stripes(tokens, m, at[longer.has(tokens.hashes(at, m + 1))], common))
            made = [batch for batch in made if batch is not None]
            if made:
                yield _packed(pa.Table.from_batches(made).combine_chunks().to_batches()[0], parts)

    return docs.select("text", F.col("lang").cast("string")).mapInArrow(count, "packed long, size long, rows binary")


def _score():
    """``floor(2000000 * a / (l + r))`` in decimals, as the product may pass 64 bits."""
    return F.expr("cast(2000000 * cast(a AS decimal(20,0)) div (cast(l AS decimal(20,0)) + r) AS long)")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` collocations of each language of ``docs`` (``text``, ``lang``).

    Stripes pattern: each prefix keys a stripe, the words that follow it with their counts. Tasks count stripes of blocks of text; stripes of
    one prefix are merged element by element. Very common words have stripes of many words, these are cut by the hash of the next
    word. The stripe of the empty prefix, all words, is counted first; then the hashes of the phrases of frequent words are, so that
    stripes hold what may be a candidate only: a part of a candidate is as frequent as it is. From the merged stripes come the
    candidates, the total of a prefix, its element in the stripe of the prefix before it, and for each phrase the most frequent one-word
    extension: a longer candidate that subsumes a phrase lies within such an extension, which is as frequent or more.

    A null or empty text has no words; a null ``lang`` is ``und``; repeated rows count as often as they occur; other columns are ignored;
    an empty table gives no rows. Ties of score and count are in the order of the bytes of the phrase.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    words = written(word_counts(docs), "words")
    sizes = words.groupBy("lang").agg(F.sum("n").alias("total"))
    frequent = words.filter(F.col("n") >= least)
    all_words = words.agg(F.sum("n")).head()[0] or 0
    # Fewer than 1 / WIDE rows.
    common = frequent.filter(F.col("n") > WIDE * all_words).select("lang", "word").collect()
    wide = set(_phrase_hash([r.lang for r in common], [r.word for r in common]).tolist())
    short = IN_PART + (max(FEWEST_PARTS, all_words // PART_WORDS) - 1).bit_length()
    single = seen_filter(word_hashes(frequent, short), short)
    grams = seen_filter(written(frequent_hashes(docs, single, least, short), "frequent"), short)
    parts = min(PACKED_MOST, max(PACKED_LEAST, all_words // PACKED_WORDS))
    candidates = written(merged(stripes(docs, single, grams, wide, parts), least).select(
        "lang", "prefix", "word", F.concat_ws(" ", "prefix", "word").alias("phrase"), F.expr("words + 1").alias("m"), F.col("n").alias("a")), "candidates")
    counts = frequent.select("lang", F.col("word").alias("phrase"), F.col("n").alias("f")).union(
        candidates.select("lang", "phrase", F.col("a").alias("f")))
    behind = F.expr("substring_index(phrase, ' ', 1 - m)")
    extended = candidates.filter("m > 2")
    subsumed = extended.select("lang", F.col("prefix").alias("phrase"), "a").union(extended.select("lang", behind.alias("phrase"), "a")).groupBy(
        "lang", "phrase").agg(F.max("a").alias("most"))
    kept = candidates.join(subsumed, ["lang", "phrase"], "left").filter(
        F.col("most").isNull() | (F.col("most").cast("decimal(20,0)") * 100 < F.col("a").cast("decimal(20,0)") * 80)).select("lang", "phrase", "m", "a")
    cuts = kept.select("*", F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", F.expr("substring_index(phrase, ' ', k)").alias("left"), F.expr("substring_index(phrase, ' ', k - m)").alias("right"))
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(counts.select("lang", F.col("phrase").alias(side), F.col("f").alias(name)), ["lang", side])
    best = cuts.select("lang", "phrase", "a", F.struct(_score().alias("score"), "k", "l", "r").alias("cut")).groupBy("lang", "phrase", "a").agg(
        F.min("cut").alias("cut"))
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"),
        F.col("total").alias("n"), F.col("cut.score").alias("score"))
