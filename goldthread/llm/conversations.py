"""Repair of the structure of conversations: faults of rows, and the cheapest edits that give a well-formed sequence of roles."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldthread.llm.auction import (
    BLANK, CLOSED, CLOSING, DUPLICATE, FINE, INITIALS, KEPT, OTHER, TRUNCATED, TURNED, Lattice, behind, cheapest, crossing)
from goldthread.llm.common import bound_batches, written

#: Rows of a conversation that one stretch holds.
STRETCH = 4096
_SPACE = " \\u0009\\u000a\\u000b\\u000c\\u000d"
_ORDER = ("known", "turn", "row")
_ROLES = {2: "user", 3: "assistant"}
_GOOD = {(0, 1), (1, 2), (2, 1)}


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` (``conv_id, turn, role, text``), each dropped, emptied, cut short, doubled or re-roled by the checksum of its place.

    Returns ``conv_id, known, turn, row, role, text, copies``: ``row`` numbers the rows of the table, ``known`` tells that
    there is a turn, and a dropped row has no copies. Nulls become one space, but for ``conv_id`` and ``turn`` themselves.
    """
    place = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(place.cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    return rows.select(
        "conv_id", F.col("turn").isNotNull().alias("known"), "turn", F.monotonically_increasing_id().alias("row"),
        F.when(kind == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def as_given(rows: DataFrame) -> DataFrame:
    """``rows`` (``conv_id, turn, role, text``) in the form of ``damaged``, without damage."""
    return rows.select(
        "conv_id", F.col("turn").isNotNull().alias("known"), "turn", F.monotonically_increasing_id().alias("row"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), F.lit(1).alias("copies"))


def _sketched(rows: DataFrame) -> DataFrame:
    """One small row per row, its text reduced to what its faults need, and before it one that marks the first of its role and text."""
    tail = F.substring(F.expr(f"trim(TRAILING '{_SPACE}' FROM text)"), -1, 1)
    place = F.expr(f"locate(substring(role, 1, 1), '{INITIALS}')")
    initial = F.when((F.col("role") == "") | (place == 0), OTHER).otherwise(place - 1)
    small = rows.select(
        "conv_id", *_ORDER, "copies", initial.cast("int").alias("initial"),
        F.when(tail == "", BLANK).when(~tail.isin(".", "!", "?"), TRUNCATED).otherwise(FINE).alias("fault"),
        F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit(7), "text", "role").alias("h2"))
    first = small.filter(f"copies > 0 AND fault <> {BLANK}").groupBy("conv_id", "h1", "h2").agg(F.min(F.struct(*_ORDER)).alias("at"))
    marks = first.select("conv_id", *[F.col(f"at.{c}").alias(c) for c in _ORDER], *[F.lit(None).cast("int").alias(c) for c in ("copies", "initial", "fault")])
    return marks.union(small.select(*marks.columns))


class _Stretch:
    """Consecutive rows of one conversation, one byte each, and what else its report needs."""

    def __init__(self, conv, at: tuple):
        self.conv, self.at, self.rows = conv, at, bytearray()
        self.turns, self.first, self.last = 0, None, None

    def add(self, turn, codes: bytes) -> None:
        if turn is not None and codes:
            self.turns += turn != self.last
            self.first = turn if self.first is None else self.first
            self.last = turn
        self.rows += codes

    def report(self) -> dict:
        """Faults and gaps; turns come in order, so the first and last known ones are the least and the largest."""
        faults = [code // 4 for code in self.rows]
        return {
            "conv_id": self.conv, **dict(zip(_ORDER, self.at)), "blank": faults.count(BLANK), "duplicate": faults.count(DUPLICATE),
            "truncated": faults.count(TRUNCATED), "illegal": illegal(self.rows), "turns": self.turns, "low": self.first, "high": self.last}


def illegal(rows: bytes) -> int:
    return sum((a % 4, b % 4) not in _GOOD for a, b in zip(rows, rows[1:]))


def gaps(turns: int, low: int | None, high: int | None) -> int:
    return 0 if low is None else high - low + 1 - turns


def _stretches(sorted_rows) -> Iterator[tuple[_Stretch, bool]]:
    """The stretches of sorted rows, and for each whether it surely is its whole conversation."""
    now, mark, whole, first = None, None, True, True
    for batch in sorted_rows:
        for row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", *_ORDER, "copies", "initial", "fault"))):
            conv, at, (copies, initial, fault) = row[0], row[1:4], row[4:]
            if now is None or conv != now.conv or len(now.rows) >= STRETCH:
                same = now is not None and conv == now.conv
                if now is not None:
                    # The first conversation of a task may have begun in the task before.
                    yield now, whole and not same and not first
                    first = first and same
                now, whole = _Stretch(conv, at), not same
            if copies is None:
                mark = at
                continue
            repeat = fault if fault == BLANK else DUPLICATE
            own = fault if fault == BLANK or mark == at else DUPLICATE
            now.add(at[1], bytes([initial + 4 * f for f in [own, repeat][:copies]]))
    if now is not None:
        yield now, False


_REPORT = "conv_id {kind}, known boolean, turn {turn}, row long, blank long, duplicate long, truncated long, illegal long, turns long, low {turn}, high {turn}"


def _batches(rows: Iterator[dict], schema: pa.Schema, most: int = 1000) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= most:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def plans(rows: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit`` of each conversation of ``damaged`` rows.

    Rows reduced to a few bytes are sorted by conversation and turn over all tasks. A conversation that lies within a task is
    repaired there. One that goes over a task's edge or over ``STRETCH`` rows is cut into stretches; each yields the
    costs of crossing it from state to state, an auction over the stretches of a conversation then gives the prices behind each, and
    with these its stretches are traced each on its own. So a conversation with a third of all rows is shared by many tasks.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    report = _REPORT.format(kind=kinds["conv_id"], turn=kinds["turn"])
    text = f"{report}, rows binary, first int, last int, crossing array<long>, cost long, audit string"
    schema = to_arrow_schema(_parse_datatype_string(text))
    far = 1 << 60

    def repair(batches):
        def found():
            for stretch, whole in _stretches(batches):
                row = stretch.report()
                if whole:
                    row["cost"], row["audit"] = cheapest(bytes(stretch.rows))
                elif stretch.rows:
                    costs = [min(c, far) for way in crossing(bytes(stretch.rows)) for c in way]
                    row |= {"rows": bytes(stretch.rows), "crossing": costs, "first": stretch.rows[0], "last": stretch.rows[-1]}
                yield row

        return _batches(found(), schema)

    ordered = _sketched(rows).repartitionByRange("conv_id", *_ORDER).sortWithinPartitions("conv_id", *_ORDER, F.col("copies").asc_nulls_first())
    done = written(ordered.mapInArrow(repair, text), "stretches")
    whole = done.filter("cost IS NOT NULL")
    sums = ["blank", "duplicate", "truncated", "illegal"]
    reported = whole.select("conv_id", F.when(F.col("low").isNull(), 0).otherwise(F.col("high") - F.col("low") + 1 - F.col("turns")).alias("gaps"),
                            *sums, "cost", "audit")
    parts = written(done.filter("cost IS NULL").select(F.monotonically_increasing_id().alias("part"), "*"), "parts")
    chain_text = (f"conv_id {kinds['conv_id']}, part long, place long, exits array<long>, gaps long, blank long, duplicate long, truncated long, "
                  "illegal long, cost long")
    chain_schema = to_arrow_schema(_parse_datatype_string(chain_text))

    def chain(table: pa.Table) -> pa.Table:
        """The prices behind each stretch of one conversation, and at its first one its report."""
        own = sorted(table.to_pylist(), key=lambda r: (r["known"], r["turn"] if r["known"] else 0, r["row"]))
        full = [r for r in own if r["first"] is not None] or own[:1]
        ways = [[[c if c < far else float("inf") for c in r["crossing"][4 * s:4 * s + 4]] for s in range(4)] for r in full if r["crossing"]]
        exits = behind(ways) or [CLOSED]
        total = {c: sum(r[c] for r in full) for c in sums}
        total["illegal"] += sum((a["last"] % 4, b["first"] % 4) not in _GOOD for a, b in zip(full, full[1:]))
        known = [r for r in full if r["low"] is not None]
        turns = sum(r["turns"] for r in known) - sum(a["high"] == b["low"] for a, b in zip(known, known[1:]))
        cost = min((c + x for c, x in zip(ways[0][0], exits[0])), default=0) if ways else 0
        out = [{"conv_id": r["conv_id"], "part": r["part"], "place": i, "exits": list(x)} for i, (r, x) in enumerate(zip(full, exits))]
        out[0] |= total | {"gaps": gaps(turns, known[0]["low"] if known else None, known[-1]["high"] if known else None), "cost": cost}
        return pa.Table.from_pylist(out, chain_schema)

    chained = written(parts.drop("rows", "cost", "audit").groupBy("conv_id").applyInArrow(chain, chain_text), "chains")

    def trace(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ways = []
            for rows_, exits in zip(batch.column("rows").to_pylist(), batch.column("exits").to_pylist()):
                lattice = Lattice(rows_ or b"", tuple(exits))
                ways.append([dict(zip(("edits", "ahead"), lattice.trace(s) if lattice.cost(s) < far else ("", s))) for s in range(4)])
            yield pa.RecordBatch.from_pydict({"part": batch.column("part"), "ways": pa.array(
                ways, pa.list_(pa.struct([("edits", pa.string()), ("ahead", pa.int32())])))})

    ways = parts.select("part", "rows").join(chained.select("part", "exits"), "part").mapInArrow(
        trace, "part long, ways array<struct<edits:string,ahead:int>>")
    # One path per conversation: from stretch to stretch by the state behind it; as long as the audit that is returned.
    end = F.array(*[F.lit(edits) for _, edits in CLOSING])
    walked = chained.join(ways, "part").groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("place", "ways"))).alias("steps"), *[F.max(c).alias(c) for c in ("gaps", *sums, "cost")])
    start = F.struct(F.array().cast("array<string>").alias("edits"), F.lit(0).alias("state"))
    walked = walked.withColumn("path", F.aggregate("steps", start, lambda path, step: F.struct(
        F.concat(path["edits"], F.array(step["ways"][path["state"]]["edits"])).alias("edits"),
        step["ways"][path["state"]]["ahead"].alias("state"))))
    audit = F.concat(F.array_join("path.edits", ""), F.element_at(end, F.col("path.state") + 1))
    return reported.union(walked.select("conv_id", "gaps", *sums, "cost", audit.alias("audit")))


def _replayed(batches, columns: tuple[str, ...]) -> Iterator[tuple[dict, Iterator[tuple[str | None, str | None, str]]]]:
    """For each plan of sorted rows the plan and its edits, ``role, text, edit`` each; the latter are to be read to their end."""
    rows = (dict(zip(batch.schema.names, row)) for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
    row = next(rows, None)

    def edits(plan):
        nonlocal row
        state, at, audit = 0, 0, plan["audit"]
        while row is not None and row["audit"] is None:
            for _ in range(row["copies"]):
                while audit[at] == "I":
                    state, at = TURNED[state], at + 1
                    yield _ROLES[state], "", "I"
                edit, at = audit[at], at + 1
                if edit == "D":
                    yield None, None, edit
                    continue
                initial = INITIALS.find(row["role"][:1]) if row["role"] else OTHER
                state = TURNED[state] if edit == "R" else KEPT[state][initial]
                yield (_ROLES[state] if edit == "R" else row["role"]), row["text"], edit
            row = next(rows, None)
        for _ in audit[at:]:
            state = TURNED[state]
            yield _ROLES[state], "", "I"

    while row is not None:
        plan, row = row, next(rows, None)
        yield {c: plan[c] for c in columns}, edits(plan)


_PLAN = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def _beside(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """The rows of each conversation in order, in one task, behind its plan; tasks read them as a stream."""
    wide = [c for c in _PLAN if c != "conv_id"]
    kinds = {f.name: f.dataType for f in [*rows.schema.fields, *plan.schema.fields]}
    texts = rows.select("conv_id", *_ORDER, "role", "text", "copies", *[F.lit(None).cast(kinds[c]).alias(c) for c in wide])
    heads = plan.select("conv_id", *[F.lit(None).cast(kinds[c]).alias(c) for c in (*_ORDER, "role", "text", "copies")], *wide)
    return heads.unionByName(texts).repartition("conv_id").sortWithinPartitions("conv_id", F.col("audit").isNull(), *_ORDER)


def repair_conversations(rows: DataFrame) -> DataFrame:
    """``conv_id, place, role, text, edit`` of each row of the repaired conversations of ``rows`` (``damaged`` or ``as_given``)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    bound_batches(rows.sparkSession)
    text = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, place long, role string, text string, edit string"
    schema = to_arrow_schema(_parse_datatype_string(text))

    def repair(batches):
        def out():
            for plan, edits in _replayed(batches, ("conv_id",)):
                place = 0
                for role, own, edit in edits:
                    if role is not None:
                        yield plan | {"place": place, "role": role, "text": own, "edit": edit}
                        place += 1

        return _batches(out(), schema, 200)

    return _beside(rows, plans(rows)).mapInArrow(repair, text)


def repair_digest(conversations: DataFrame, damage: bool = True) -> DataFrame:
    """For every ``conv_id`` of ``conversations`` its faults, the cost and the edits of its repair, and a digest of what that gives.

    Rows are first damaged by the checksum of ``conv_id:turn``. A conversation is its rows by turn, nulls first, and those of one turn
    in the order of the table, which has to be files or a written table. Null roles and texts are one space; a role that does not begin
    with s, u or a cannot be kept. Repeated rows are duplicates. A null ``conv_id`` is a conversation of its own. A conversation
    without rows has zeros, no edits and the digest of the empty text. Other columns are ignored; an empty table gives no rows.

    The digest is one SHA-256 of the whole repaired text: a conversation is read for it as a stream by one task, a batch at a time.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    bound_batches(conversations.sparkSession)
    rows = (damaged if damage else as_given)(conversations)
    text = (f"conv_id {conversations.schema['conv_id'].dataType.simpleString()}, gaps long, blank long, duplicate long, truncated long, illegal long, "
            "cost long, audit string, repaired_sha256 string")
    schema = to_arrow_schema(_parse_datatype_string(text))

    def digest(batches):
        def out():
            for plan, edits in _replayed(batches, _PLAN):
                sha, between = hashlib.sha256(), b""
                for role, own, _ in edits:
                    if role is not None:
                        sha.update(between + f"{role}:{own}".encode())
                        between = b"\n"
                yield plan | {"repaired_sha256": sha.hexdigest()}

        return _batches(out(), schema)

    return _beside(rows, plans(rows)).mapInArrow(digest, text)
