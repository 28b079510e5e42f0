"""Exact removal of byte strings that occur more than once, by sorting the suffixes around content-chosen anchors."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldthread.llm.anchors import anchored, slice_bytes
from goldthread.llm.common import ROW, bound_batches, slices, text_of, with_rows, written
from goldthread.llm.words import Hashed

LENGTH, SHALLOW = 200, 32
#: Rows up to which a side is broadcast after a count; runs per anchor up to which they are sorted in one task.
BROADCAST_ROWS, SORTED_RUNS = 1_000_000, 4_096
SORT_BYTES = 2 << 20
RUN = ["gram", "bytes", "windows", "lead"]


def checked(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """A written table, marked for broadcast if it has no more than ``most`` rows; else joins shuffle it."""
    return F.broadcast(df) if df.count() <= most else df


def runs_of(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """The runs of windows of every text, see ``anchored``."""
    def find(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = anchored(*slice_bytes(text_of(part)), length)
                yield pa.RecordBatch.from_pydict({
                    ROW: part.column(ROW).take(pa.array(found["text"])), "start": pa.array(found["start"]),
                    **{c: pa.array(found[c]) for c in RUN}})

    return rows.select(ROW, "text").mapInArrow(
        find, f"{ROW} long, start long, gram long, bytes long, windows long, lead long")


def _words_at(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Eight bytes from each place as one number that orders like the bytes."""
    eight = np.lib.stride_tricks.as_strided(data, (max(len(data) - 7, 0), 8), (1, 1))
    return eight[at].view(">u8").ravel().astype(np.uint64)


def repeated_windows(data: np.ndarray, at: np.ndarray, group: np.ndarray, weight: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Whether each window occurs again within its group; a window with ``weight`` over 1 stands for several.

    Deep-shallow sorting of the suffixes at ``at``. Shallow: multikey quicksort, all groups at once and eight bytes as a
    key, down to ``SHALLOW`` bytes; a suffix left alone in its part is unique and leaves. Deep: parts that still
    agree are ordered as blind tries are built: members are held against the path of one suffix, where only the place
    and the byte of the branch matter, and split by these. Those that never branch off are equal to the end.
    """
    repeated = weight > 1
    live = np.arange(len(at))
    part = group.copy()
    depth = 0
    while len(live) and depth < min(SHALLOW, length - length % 8):
        key = _words_at(data, at[live] + depth)
        order = np.lexsort((key, part))
        live, part, key = live[order], part[order], key[order]
        new = np.ones(len(live), bool)
        new[1:] = (part[1:] != part[:-1]) | (key[1:] != key[:-1])
        part = np.cumsum(new)
        kept = np.bincount(part)[part] > 1
        live, part = live[kept], part[kept]
        depth += 8
    known = np.full(len(live), depth)  # bytes in which the members of a part agree
    while len(live):
        head = np.ones(len(live), bool)
        head[1:] = part[1:] != part[:-1]
        pivot = live[np.flatnonzero(head)][np.cumsum(head) - 1]
        lcp = known.copy()
        open_ = np.flatnonzero(~head)
        while len(open_):
            step = np.minimum(lcp[open_], length - 8)
            differs = _words_at(data, at[live[open_]] + step) ^ _words_at(data, at[pivot[open_]] + step)
            same = _equal_bytes(differs)
            lcp[open_] = np.minimum(step + same, length)
            open_ = open_[(same == 8) & (lcp[open_] < length)]
        lcp[head] = length
        full = lcp >= length
        # The trie's path is shared by the pivot and all that never branch off.
        copies = np.bincount(np.cumsum(head)[full], minlength=head.sum() + 1)[np.cumsum(head)]
        repeated[live[full & (copies > 1)]] = True
        branch = ~full
        live, lcp, part = live[branch], lcp[branch], part[branch]
        if not len(live):
            break
        byte = data[at[live] + lcp].astype(np.int64)
        order = np.lexsort((byte, lcp, part))
        live, lcp, part, byte = live[order], lcp[order], part[order], byte[order]
        new = np.ones(len(live), bool)
        new[1:] = (part[1:] != part[:-1]) | (lcp[1:] != lcp[:-1]) | (byte[1:] != byte[:-1])
        part = np.cumsum(new)
        kept = np.bincount(part)[part] > 1
        live, part, known = live[kept], part[kept], lcp[kept] + 1
    return repeated


def _equal_bytes(differs: np.ndarray) -> np.ndarray:
    """How many leading bytes of eight are equal, from the exclusive or of both."""
    same = np.zeros(len(differs), np.int64)
    for shift in range(56, -8, -8):
        same += (differs >> np.uint64(shift)) == 0
    return same


def _windows(lengths: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For byte strings laid end to end the run of each window, and where it begins."""
    run = np.repeat(np.arange(len(counts)), counts)
    begin = np.cumsum(lengths) - lengths
    return run, begin[run] + np.arange(len(run)) - np.repeat(np.cumsum(counts) - counts, counts)


def sorted_runs(runs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Windows that occur again, for the distinct runs of anchors that have several: ``RUN`` and the flags as bytes.

    ``runs`` has ``RUN``, ``copies`` and ``data``. Runs with one gram come to one task in a row; a task sorts as
    many grams at once as ``SORT_BYTES`` hold.
    """
    def sort(tables: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(tables).combine_chunks()
        texts = table.column("data").cast(pa.large_binary()).combine_chunks()
        texts = texts.chunk(0) if isinstance(texts, pa.ChunkedArray) else texts
        data, bounds = slice_bytes(texts)
        data = np.append(data, np.zeros(8, np.uint8))
        counts, copies = table.column("windows").to_numpy(), table.column("copies").to_numpy()
        run, at = _windows(np.diff(bounds), counts)
        gram = np.unique(table.column("gram").to_numpy(), return_inverse=True)[1]
        flags = repeated_windows(data, at, gram[run], copies[run], length).astype(np.uint8)
        cuts = np.cumsum(counts)
        own = [flags[b - n:b].tobytes() for b, n in zip(cuts.tolist(), counts.tolist())]
        return pa.RecordBatch.from_pydict({**{c: table.column(c).combine_chunks() for c in RUN}, "flags": pa.array(own, pa.binary())})

    def stream(batches) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in filter(len, batches):
            held.append(batch)
            size += batch.nbytes
            if size >= SORT_BYTES:
                # The last gram may go on in the next batch.
                whole = pa.Table.from_batches(held).combine_chunks()
                grams = whole.column("gram").to_numpy()
                cut = int(np.flatnonzero(grams != grams[-1])[-1]) + 1 if grams[0] != grams[-1] else 0
                if cut:
                    yield sort(whole.slice(0, cut).to_batches())
                    held = whole.slice(cut).to_batches()
                    size = sum(b.nbytes for b in held) if cut < len(grams) else 0
        if held:
            yield sort(held)

    return runs.repartition("gram").sortWithinPartitions("gram").mapInArrow(
        stream, "gram long, bytes long, windows long, lead long, flags binary")


def hashed_runs(runs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The same for anchors with too many distinct runs for one task: windows meet by two 64-bit hashes.

    One row for each window, aggregated before it is shuffled, so no task holds an anchor's runs.
    """
    def explode(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "data", 1 << 19):
                data, bounds = slice_bytes(part.column("data").cast(pa.large_binary()))
                run, at = _windows(np.diff(bounds), part.column("windows").to_numpy())
                first = np.cumsum(part.column("windows").to_numpy()) - part.column("windows").to_numpy()
                forward = Hashed(data).of(at, at + length)
                # Of other bytes: a table of odd steps.
                other = Hashed((data.astype(np.uint32) * 167 + 13 & 0xFF).astype(np.uint8) ^ np.uint8(0x5A)).of(at, at + length)
                yield pa.RecordBatch.from_pydict({
                    **{c: part.column(c).take(pa.array(run)) for c in (*RUN, "copies")},
                    "place": pa.array(np.arange(len(run)) - first[run]), "h1": pa.array(forward.view(np.int64)),
                    "h2": pa.array(other.view(np.int64))})

    windows = written(runs.mapInArrow(
        explode, "gram long, bytes long, windows long, lead long, copies long, place long, h1 long, h2 long"), "hot-windows")
    again = windows.groupBy("h1", "h2").agg(F.sum("copies").alias("n")).filter("n > 1").select("h1", "h2")
    return windows.join(again, ["h1", "h2"]).select(*RUN, "place")


def repeated_spans(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """For each row with repeated strings of ``length`` bytes the maximal spans they cover, as ``spans``.

    ``rows`` has ``__row`` and ``text``. Every window of ``length`` bytes is put to the anchor it chooses by
    content; equal windows choose alike, wherever they stand. Runs of an anchor that
    occurs once are unique. Runs that are equal as a whole are only counted, before the shuffle: a passage in a third of
    all documents is one row for each task. What is left, distinct runs of one anchor, is sorted.
    """
    runs = written(runs_of(rows, length), "runs")
    grams = written(runs.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram"), "grams")
    shared = runs.join(checked(grams), "gram", "left_semi")
    distinct = written(shared.groupBy(*RUN).agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct(ROW, "start")).alias("first")),
                       "distinct-runs")
    per_gram = distinct.groupBy("gram").agg(F.count(F.lit(1)).alias("runs"))
    mixed = written(per_gram.filter("runs > 1"), "mixed-grams")
    chosen = distinct.join(checked(mixed), "gram").select(*RUN, "copies", "runs", "first.*")
    chosen = written(chosen, "mixed-runs")
    texts = rows.select(ROW, F.encode("text", "UTF-8").alias("whole"))
    with_data = texts.join(checked(chosen), ROW).select(
        *RUN, "copies", "runs",
        F.substring("whole", F.col("start").cast("int") + 1, (F.col("windows") + length - 1).cast("int")).alias("data"))
    with_data = written(with_data, "mixed-data")
    flagged = sorted_runs(with_data.filter(F.col("runs") <= SORTED_RUNS).drop("runs"), length)
    places = F.expr("filter(sequence(0L, windows - 1), i -> substring(flags, int(i) + 1, 1) = X'01')")
    hot = with_data.filter(F.col("runs") > SORTED_RUNS).drop("runs")
    hot = hashed_runs(hot, length).groupBy(*RUN).agg(F.sort_array(F.collect_list("place")).alias("places"))
    sorted_places = flagged.select(*RUN, places.alias("places")).unionByName(hot)
    # Only what the sort adds: runs that occur twice as a whole are known.
    parts = F.expr("""transform(filter(transform(places, (p, i) -> struct(p AS p, i AS i)),
        x -> x.i = 0 OR places[x.i - 1] <> x.p - 1), x -> x.p)""")
    ends = F.expr("""transform(filter(transform(places, (p, i) -> struct(p AS p, i AS i)),
        x -> x.i = size(places) - 1 OR places[x.i + 1] <> x.p + 1), x -> x.p)""")
    found = written(sorted_places.filter("size(places) > 0").select(*RUN, parts.alias("from"), ends.alias("to")), "repeated-windows")
    whole = shared.join(checked(distinct.filter("copies > 1").select(*RUN)), RUN, "left_semi").select(
        ROW, F.col("start").alias("s"), (F.col("start") + F.col("windows") + (length - 1)).alias("e"))
    some = shared.join(checked(found), RUN).select(
        ROW, "start", F.explode(F.arrays_zip("from", "to")).alias("x")).select(
        ROW, (F.col("start") + F.col("x.from")).alias("s"), (F.col("start") + F.col("x.to") + length).alias("e"))
    covered = whole.unionByName(some).groupBy(ROW).agg(F.sort_array(F.collect_set(F.struct("s", "e"))).alias("all"))
    merge = F.expr("""aggregate(all, CAST(array() AS array<struct<s: bigint, e: bigint>>), (a, x) ->
        CASE WHEN size(a) > 0 AND element_at(a, -1).e >= x.s
             THEN concat(slice(a, 1, size(a) - 1),
                         array(struct(element_at(a, -1).s AS s, greatest(element_at(a, -1).e, x.e) AS e)))
             ELSE concat(a, array(struct(x.s AS s, x.e AS e))) END)""")
    return covered.select(ROW, merge.alias("spans"))


def repeated_digest(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` after removal of every repeated string of ``length`` bytes.

    Every byte covered by a string that also starts anywhere else, in the same document too, goes; overlaps count, and
    strings are judged on the input. A null text counts as the empty text; a text under ``length`` bytes loses
    nothing; repeated rows are repeats of each other; a null ``doc_id`` stays null; other columns are ignored; an
    empty table gives no rows.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    rows = with_rows(docs, "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    spans = written(repeated_spans(rows, length), "spans")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def digest(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                data = pc.cast(text_of(part), pa.large_binary()).to_pylist()
                out = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": []}
                for raw, cut in zip(data, part.column("spans").to_pylist()):
                    kept, at, gone = hashlib.sha256(), 0, 0
                    for span in cut or ():
                        kept.update(raw[at:span["s"]])
                        gone, at = gone + span["e"] - span["s"], span["e"]
                    kept.update(raw[at:])
                    for name, value in zip(out, (len(raw), gone, len(cut or ()), kept.hexdigest())):
                        out[name].append(value)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id"),
                    **{c: pa.array(v, pa.string() if c == "kept_sha256" else pa.int64()) for c, v in out.items()}})

    return rows.join(checked(spans, BROADCAST_ROWS // 4), ROW, "left").drop(ROW).mapInArrow(
        digest, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
