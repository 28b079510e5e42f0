"""Tokens per document by a two-tier lookup on the map side."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldthread.llm.common import bound_batches, slices, text_of
from goldthread.llm.pieces import LONG, SPECIAL, Pieces, Split, Table, counted

#: Entries of the broadcast table; documents from which it is drawn; entries that one task proposes.
FREQUENT, SEED_DOCUMENTS, PROPOSED = 30_000, 20_000, 60_000

_TIERS: dict[str, Pieces] = {}


def frequent_lengths(docs: DataFrame, tokenizer: str, seed_documents: int = SEED_DOCUMENTS, size: int = FREQUENT) -> Table:
    """Token counts of the most frequent pieces of a random sample of ``seed_documents`` documents.

    The table only saves work: a piece it lacks is encoded by the worker that meets it, so the
    sample has no influence on any count. It holds ``size`` entries whatever the input.
    """
    rows = docs.count()
    sample = docs.select("text").sample(min(1.0, seed_documents / max(rows, 1)), seed=1)

    def propose(batches):
        seen: Counter = Counter()
        for batch in batches:
            for part in slices(batch):
                split = Split(text_of(part))
                seen.update(split.pieces(np.arange(len(split.starts))))
            if len(seen) > 4 * PROPOSED:
                seen = Counter(dict(seen.most_common(PROPOSED)))
        top = [(p, n) for p, n in seen.most_common(PROPOSED) if len(p) <= LONG and not any(s in p for s in SPECIAL)]
        yield pa.RecordBatch.from_pydict({
            "piece": pa.array([p for p, _ in top], pa.string()), "n": pa.array([n for _, n in top], pa.int64())})

    top = (sample.coalesce(16).mapInArrow(propose, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "piece").limit(size).collect())
    return counted(tokenizer, [r.piece for r in top])


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 2048, seed_documents: int = SEED_DOCUMENTS) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs`` (``doc_id``, ``text``).

    First tier: a broadcast table of frequent pieces and their token counts. Second tier: pieces that
    it lacks are encoded once per Python worker and kept there, up to a bound. No piece is shuffled,
    each document is handled where it is read.

    A null text counts as the empty text: no bytes, no tokens. A null ``doc_id`` stays null, repeated
    rows are counted each on its own, other columns are ignored, an empty table gives no rows.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    table = spark.sparkContext.broadcast(frequent_lengths(docs, tokenizer, seed_documents))
    run = f"{tokenizer}#{table.id if hasattr(table, 'id') else id(table)}"

    def count(batches):
        if run not in _TIERS:
            _TIERS.clear()
            _TIERS[run] = Pieces(tokenizer, True, table.value)
        tiers = _TIERS[run]
        for batch in batches:
            for part in slices(batch):
                texts = text_of(part)
                n = pa.array(np.diff(tiers.of(texts)[1]))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id"), "n_bytes": pc.binary_length(texts).cast(pa.int64()),
                    "n_tokens": n, "over_limit": pc.greater(n, limit)})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        count, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
