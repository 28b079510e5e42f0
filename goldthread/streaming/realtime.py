"""The realtime job: event key, row lookup, two mapped shapes, two sinks."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from goldthread.functions.calendar import PARTITIONS, WINDOW_MONTH
from goldthread.functions.extract import extract_paths, with_json_value
from goldthread.operators.cells import documents_of_keys, has_text, join_by_key, key_counts
from goldthread.operators.mapping import MappingRow, Shapes, map_shapes
from goldthread.operators.normalize import Formats, fill_columns, ignore_unknown, normalize_to_schema
from goldthread.operators.sizing import BROADCAST_ROWS, semi_join
from goldthread.sources.sinks import dead_letter_lines
from goldthread.streaming.messages import KEY_PATH, with_event_key
from goldthread.streaming.refresh import MappingRefresh
from goldthread.streaming.sinks import with_window_partitions, write_batch

# Columns of the append table.
TABLE_COLUMNS = (
    "accountId", "dateOfBirth", "gender", "hasEmail", "hasMobile",
    "languagePrefer", "memberId", "nationalityId", "profileId", "updated_date",
)
REQUIRED_COLUMN = "memberId"
PASSED_ON = ("message_id", "publish_time")
KEY, REQUIRED = "persona_id", "__required"


@dataclass(frozen=True)
class RealtimeJob:
    """Where the job writes and which table's mapping rows it applies.

    ``file_schema`` fixes the columns of the window files. Without it they are the mapping's
    columns as text, which is only safe while the mapping keeps its columns.
    """

    table_path: str
    files_path: str
    mapped_table: str
    dead_letter_path: str | None = None
    families: Sequence[str] = ("profiles",)
    member_id: Sequence[str] = ("profiles", "memberId")
    key_path: Sequence[str] = KEY_PATH
    table_columns: Sequence[str] = TABLE_COLUMNS
    required: str | None = REQUIRED_COLUMN
    file_schema: T.StructType | None = None
    formats: Formats = field(default_factory=Formats)
    window: str = "5 minutes"
    month: str = WINDOW_MONTH
    broadcast_rows: int = BROADCAST_ROWS
    # Parts of a batch: a key that has more than one of them is joined by as many tasks.
    spread: int = 200


def look_up(counts: DataFrame, cells: DataFrame, mapping: Sequence[MappingRow], job: RealtimeJob) -> Shapes:
    """The mapped values of the counted keys' rows, one row per key, without rows that lack a member id.

    A document is parsed once here, however many messages ask for it.
    """
    found = documents_of_keys(cells, counts, KEY, job.families, job.broadcast_rows)
    family, *below = job.member_id
    with_member = has_text(with_json_value(found, "__member", F.col(family), below, scalar=False), F.col("__member"))
    return map_shapes(with_member.drop("__member"), mapping, job.mapped_table, keep=[KEY])


def table_rows(shapes: Shapes, job: RealtimeJob) -> DataFrame:
    """Shape of the append table: the columns it has, each filled from the path that ends in its name."""
    mapped = shapes.by_segment()
    return fill_columns(ignore_unknown(mapped, [*PASSED_ON, *job.table_columns]), job.table_columns, keep=PASSED_ON)


def file_rows(shapes: Shapes, mapping: Sequence[MappingRow], job: RealtimeJob) -> DataFrame:
    """Shape of the window files: every column of the mapping, or of the fixed schema."""
    mapped = shapes.by_column()
    filled = fill_columns(mapped, [row.dest for row in mapping], keep=PASSED_ON)
    if job.file_schema is None:
        return filled
    passed = T.StructType([mapped.schema[c] for c in PASSED_ON if c not in job.file_schema.names])
    target = T.StructType([*passed.fields, *job.file_schema.fields])
    # Missing text stays null in the files; only the batch job turns it into "".
    return normalize_to_schema(filled, target, job.formats, null_text=None)


def run_batch(
    messages: DataFrame, batch_id: int, cells: DataFrame, mapping: Sequence[MappingRow], job: RealtimeJob,
) -> None:
    """Process one micro-batch and write both sinks; a replay replaces what the first try wrote.

    The documents found are parsed once per key, for the paths of both shapes. What is kept are the parsed values of the keys;
    they are joined with the messages for each sink.
    """
    keyed = with_event_key(messages, KEY, job.key_path).persist()
    asking = keyed.filter(F.col(KEY) != "").select(*PASSED_ON, KEY)
    counts = key_counts(asking, KEY).persist()
    kept = [keyed, counts]
    try:
        of_keys = look_up(counts, cells, mapping, job)
        kept.append(of_keys.flat.persist())
        shapes = of_keys.joined(join_by_key(asking, of_keys.flat, counts, KEY, job.spread), PASSED_ON)
        rows = table_rows(shapes, job)
        checked = job.required if job.required in rows.columns else None
        accepted = rows.filter(F.col(checked).isNotNull()) if checked else rows
        write_batch(accepted, job.table_path, batch_id, drop=PASSED_ON)
        windowed = with_window_partitions(file_rows(shapes, mapping, job), "publish_time", job.window, job.month)
        write_batch(windowed, job.files_path, batch_id, PARTITIONS, drop=PASSED_ON)
        if job.dead_letter_path:
            refused = refused_messages(keyed, of_keys, checked, job) if checked else keyed.limit(0)
            write_batch(dead_letter_lines(dead_letters(keyed, refused)), job.dead_letter_path, batch_id)
    finally:
        for frame in reversed(kept):
            frame.unpersist()


def refused_messages(keyed: DataFrame, of_keys: Shapes, required: str, job: RealtimeJob) -> DataFrame:
    """Messages whose row lacks the required column.

    Whether it does is a matter of the key, unless the column is read from the message itself, so the messages are cut down
    by the keys of such rows.
    """
    source = of_keys.segments.get(required)
    path = [required] if required in PASSED_ON else of_keys.paths.get(source)
    of_message = path is not None and path[0] in PASSED_ON
    lacking = of_keys.flat if path is None or of_message else of_keys.flat.filter(F.col(source).isNull())
    refused = semi_join(keyed, lacking.select(KEY), KEY, job.broadcast_rows)
    if not of_message:
        return refused
    read = extract_paths(refused, {REQUIRED: path}, keep=refused.columns, parse_embedded=False, filtered=[REQUIRED])
    return read.filter(F.col(REQUIRED).isNull()).drop(REQUIRED)


def dead_letters(keyed: DataFrame, refused: DataFrame) -> DataFrame:
    """Messages without a usable key, and those that are ``refused``, whole and with the reason.

    Payload, key and attributes are kept, so a message can be sent again.
    """
    without = keyed.filter(F.col(KEY).isNull() | (F.col(KEY) == "")).withColumn("error", F.lit("no key in the message"))
    rejected = refused.withColumn("error", F.lit("a required column is null"))
    return without.unionByName(rejected).select(
        "message_id", "publish_time", KEY, "data", "attributes", "error",
        F.lit("processing_error").alias("error_type"))


def start_realtime(
    messages: DataFrame,
    read_cells: Callable[[], DataFrame],
    mapping: MappingRefresh,
    job: RealtimeJob,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Run the job on a message stream.

    Cells are read anew for every micro-batch and the mapping when its interval has passed, so
    later batches are planned with the columns it then has.
    """
    def process(batch: DataFrame, batch_id: int) -> None:
        run_batch(batch, batch_id, read_cells(), mapping.current(), job)

    return (messages.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "10 seconds"})).start())
