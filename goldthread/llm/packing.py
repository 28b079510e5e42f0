"""Harmonic packing of token sequences."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from goldthread.llm.common import bound_batches, slices, text_of, written
from goldthread.llm.pieces import packed_ids

CAPACITY, WHOLE_CLASSES = 4096, 16


def cut_lengths(n: int, capacity: int = CAPACITY, classes: int = WHOLE_CLASSES) -> list[int]:
    """Cut ``n`` tokens into pieces of ``capacity // k`` tokens, the largest first, and a short rest.

    Pieces of the first ``classes`` reciprocal classes have exactly the size of their class, so a bin
    of ``k`` such pieces is full but for ``capacity % k`` tokens. The rest is shorter than the last of
    these sizes and stays whole.
    """
    pieces = [capacity] * (n // capacity)
    n %= capacity
    for k in range(2, classes + 1):
        size = capacity // k
        if size and n >= size:
            pieces += [size] * (n // size)
            n %= size
    return pieces + [n] * (n > 0)


def tokenized_pieces(docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = CAPACITY,
                     keep_ids: bool = False) -> DataFrame:
    """The documents cut for packing: one row per piece with its class and its place in class and task."""
    bound_batches(docs.sparkSession)
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches):
        task = TaskContext.get().partitionId()
        seen: Counter = Counter()
        for batch in batches:
            for part in slices(batch):
                out = {k: [] for k in ("row", "start", "length", "ids_crc32", "doc_tokens", "class", "place")}
                ids = []
                for row, packed in enumerate(packed_ids(tokenizer, text_of(part))):
                    packed += end
                    total, start = len(packed) // 4, 0
                    for length in cut_lengths(total, capacity):
                        own = packed[4 * start:4 * (start + length)]
                        k = capacity // length
                        for name, value in zip(out, (row, start, length, zlib.crc32(own), total, k, seen[k])):
                            out[name].append(value)
                        if keep_ids:
                            ids.append(np.frombuffer(own, "<u4").astype(np.int64))
                        seen[k] += 1
                        start += length
                made = {"doc_id": part.column("doc_id").take(pa.array(out.pop("row"), pa.int64()))}
                made |= {k: pa.array(v, pa.int64()) for k, v in out.items()}
                made["task"] = pa.array([task] * len(made["start"]), pa.int64())
                if keep_ids:
                    made["ids"] = pa.array(ids, pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(made)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        cut, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, class long, place long, "
             f"task long" + ", ids array<long>" * keep_ids)


def _fill_rest(capacity: int):
    """First fit, longest first, for the pieces that fill no bin of their class."""
    def fill(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "class", "rank"], ascending=[False, True, True], kind="stable")
        room: list[int] = []
        first = 0
        bins, offsets = [], []
        for length in rows["length"]:
            while first < len(room) and room[first] == 0:
                first += 1
            at = next((i for i in range(first, len(room)) if room[i] >= length), len(room))
            if at == len(room):
                room.append(capacity)
            bins.append(at)
            offsets.append(capacity - room[at])
            room[at] -= length
        return rows[["class", "rank"]].assign(bin=bins, offset=offsets)

    return fill


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Every document's ids, closed by ``end_id``, laid into sequences of at most ``capacity`` tokens.

    Harmonic packing: a piece of more than ``capacity / (k + 1)`` and at most ``capacity / k`` tokens is
    of class ``k``, and each bin of class ``k`` takes exactly ``k`` pieces. Tasks number their pieces per
    class on their own; the counts per task and class, summed up in task order, turn that into a number
    within the class, and ``number div k`` is the bin. No class is ever gathered in one task: a class
    that holds a third of all pieces is only counted. What fills no bin, fewer than ``k`` pieces of a
    class and so less than ``sum(k)`` over the classes (about 26,000 pieces for 4,096 tokens) whatever the
    input, is packed by first fit in one task.

    Returns ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` and, with ``keep_ids``,
    the ids. A null text is the empty text, one end id. A null ``doc_id`` stays null; repeated rows are
    packed each on its own; an empty table gives no rows; other columns are ignored.
    """
    pieces = written(tokenized_pieces(docs, tokenizer, end_id, capacity, keep_ids), "pieces")
    per_task = pieces.groupBy("task", "class").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("class").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_task.select("task", "class", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    # One row per class: at most 2 * sqrt(capacity) of them.
    classes = pieces.groupBy("class").agg(F.count(F.lit(1)).alias("n")).select(
        "class", F.expr("n div class").alias("full"))
    bins = classes.select(
        "class", "full",
        F.coalesce(F.sum("full").over(Window.orderBy("class").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("first_bin"))
    placed = (pieces.join(starts, ["task", "class"]).withColumn("rank", F.col("before") + F.col("place"))
              .join(F.broadcast(bins), "class").withColumn("bin", F.expr("rank div class")))
    in_bin = Window.partitionBy("class", "bin").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * keep_ids
    filled = (placed.filter("bin < full")
              .withColumn("offset", F.coalesce(F.sum("length").over(in_bin), F.lit(0)))
              .withColumn("sequence_id", F.col("first_bin") + F.col("bin")).select(columns))
    rest = placed.filter("bin >= full")
    where = rest.select("class", "rank", "length").groupBy().applyInPandas(
        _fill_rest(capacity), "class long, rank long, bin long, offset long")
    total = F.broadcast(bins.agg(F.sum("full").alias("all_full")))
    packed_rest = (rest.drop("bin").join(where, ["class", "rank"]).crossJoin(total)
                   .withColumn("sequence_id", F.col("all_full") + F.col("bin")).select(columns))
    return filled.unionByName(packed_rest)
