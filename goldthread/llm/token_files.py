"""Token ids in seekable zstandard files, and the reader of single documents.

A file is a run of independent zstandard frames, one per document, each holding the ids as
little-endian unsigned 32-bit integers, followed by two skippable frames that any zstandard reader
passes over:

* the document index: for each frame ``doc_id`` (signed 64 bits) and a byte that is 1 where the id is null;
* the seek table in the public seekable format: for each frame its compressed size, its decompressed size
  and a checksum (the low 32 bits of XXH64 of the decompressed bytes), each unsigned 32 bits, then the
  number of frames (32 bits), a descriptor byte (128: checksums are there) and the magic number.

The reader loads the end of the file, looks documents up and decompresses only theirs.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from goldthread.llm.common import bound_batches, shared_path, slices, text_of, written
from goldthread.llm.pieces import packed_ids

#: Fixed values of the public seekable format.
SKIPPABLE, SEEKABLE, CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 128
INDEX_SKIPPABLE = 0x184D2A50
ENTRY, INDEX_ENTRY, HEADER, FOOTER = struct.Struct("<III"), struct.Struct("<qB"), struct.Struct("<II"), struct.Struct("<IBI")
MOST_FRAMES, READ_TASKS = 1_000_000, 20_000


def file_at(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of an address and the path in it; a plain path is a local or mounted one."""
    return pafs.FileSystem.from_uri(uri) if ":" in uri else (pafs.LocalFileSystem(), uri)


class FrameWriter:
    """Writes one file under a name of its own and gives it its final name when it is whole."""

    def __init__(self, uri: str, attempt: str, level: int):
        self.fs, self.path = file_at(uri)
        self.part = f"{self.path}.{attempt}"
        self.fs.create_dir(self.path.rsplit("/", 1)[0], recursive=True)
        self.out = self.fs.open_output_stream(self.part)
        self.zstd = zstandard.ZstdCompressor(level=level)
        self.entries, self.index = bytearray(), bytearray()

    @property
    def frames(self) -> int:
        return len(self.entries) // ENTRY.size

    def add(self, doc_id: int | None, packed: bytes) -> None:
        frame = self.zstd.compress(packed)
        self.out.write(frame)
        self.entries += ENTRY.pack(len(frame), len(packed), xxhash.xxh64_intdigest(packed) & 0xFFFFFFFF)
        self.index += INDEX_ENTRY.pack(doc_id or 0, doc_id is None)

    def close(self) -> None:
        self.out.write(HEADER.pack(INDEX_SKIPPABLE, len(self.index)) + self.index)
        self.out.write(HEADER.pack(SKIPPABLE, len(self.entries) + FOOTER.size) + self.entries
                       + FOOTER.pack(self.frames, CHECKSUMS, SEEKABLE))
        self.out.close()
        self.fs.move(self.part, self.path)


class FrameReader:
    """Random access to the documents of a file."""

    def __init__(self, uri: str):
        fs, path = file_at(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        frames, flags, magic = FOOTER.unpack(self._at(size - FOOTER.size, FOOTER.size))
        if magic != SEEKABLE or flags != CHECKSUMS:
            raise ValueError(f"{uri} does not end in a seek table with checksums")
        table = size - FOOTER.size - frames * ENTRY.size
        self.entries = np.frombuffer(self._at(table, frames * ENTRY.size), "<u4").reshape(-1, 3)
        index = table - HEADER.size - frames * INDEX_ENTRY.size
        self.index = np.frombuffer(self._at(index, frames * INDEX_ENTRY.size), [("doc_id", "<i8"), ("null", "u1")])
        self.offsets = np.concatenate([[0], np.cumsum(self.entries[:, 0], dtype=np.int64)])
        self.zstd = zstandard.ZstdDecompressor()

    def _at(self, offset: int, size: int) -> bytes:
        return self.file.read_at(size, offset) if size else b""

    def frame(self, i: int) -> bytes:
        """The ids of one document, held against its checksum."""
        packed = self.zstd.decompress(self._at(int(self.offsets[i]), int(self.entries[i, 0])),
                                      max_output_size=int(self.entries[i, 1]))
        if xxhash.xxh64_intdigest(packed) & 0xFFFFFFFF != self.entries[i, 2]:
            raise ValueError(f"frame {i} is damaged")
        return packed

    def document(self, doc_id: int | None) -> list[np.ndarray]:
        """The ids of the documents with this number; several where it repeats."""
        found = self.index["null"] == 1 if doc_id is None else (self.index["doc_id"] == doc_id) & (self.index["null"] == 0)
        return [np.frombuffer(self.frame(int(i)), "<u4") for i in np.flatnonzero(found)]


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, level: int = 3) -> DataFrame:
    """Encode the documents and write their files in ascending ``doc_id`` order; gives one row per file.

    The rows ``part, piece, file, frames`` in the order of ``(part, piece)`` list the files in the order of
    their documents. A task writes a range of documents and begins another file after ``MOST_FRAMES``.
    It keeps one document and its seek table in memory. A repeated attempt writes the same
    documents under a name of its own and then takes the final name.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    end = np.array([end_id], "<u4").tobytes()
    # Rows with one doc_id are told apart by their text, so that a repeated number does not fill one task.
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
               .repartitionByRange(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text")))

    def write(batches):
        task = TaskContext.get()
        part, attempt, made, files = task.partitionId(), f"attempt-{task.taskAttemptId()}", None, []
        for batch in batches:
            for piece in slices(batch):
                for doc_id, packed in zip(piece.column("doc_id").to_pylist(),
                                          packed_ids(tokenizer, text_of(piece))):
                    if made is None:
                        name = f"{path}/part-{part:06d}-{len(files):04d}.tok.zst"
                        made = FrameWriter(name, attempt, level)
                    made.add(doc_id, packed + end)
                    if made.frames == MOST_FRAMES:
                        made.close()
                        files.append((name, made.frames))
                        made = None
        if made:
            made.close()
            files.append((name, made.frames))
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([part] * len(files), pa.int64()), "piece": pa.array(range(len(files)), pa.int64()),
            "file": pa.array([f for f, _ in files], pa.string()), "frames": pa.array([n for _, n in files], pa.int64())})

    return written(ordered.mapInArrow(write, "part long, piece long, file string, frames long"), "token-manifest")


def read_token_files(spark: SparkSession, manifest: DataFrame, step: int = 2000) -> DataFrame:
    """Every document of the files with ``doc_id, part, piece, frame, ids``, from tasks of ``step`` documents."""
    # By number, for adaptive execution would merge these few bytes into one task.
    tasks = manifest.agg(F.coalesce(F.sum(F.ceil(F.col("frames") / step)), F.lit(0))).head()[0]
    jobs = (manifest.withColumn("first", F.explode(F.expr(f"sequence(0L, frames - 1, {step}L)")))
            .repartition(max(1, min(int(tasks), READ_TASKS)), "file", "first"))

    def read(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for job in batch.to_pylist():
                reader = FrameReader(job["file"])
                for low in range(job["first"], min(job["first"] + step, job["frames"]), 200):
                    these = range(low, min(low + 200, job["first"] + step, job["frames"]))
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array([None if reader.index["null"][i] else int(reader.index["doc_id"][i])
                                            for i in these], pa.int64()),
                        "part": pa.array([job["part"]] * len(these), pa.int64()),
                        "piece": pa.array([job["piece"]] * len(these), pa.int64()),
                        "frame": pa.array(list(these), pa.int64()),
                        "packed": pa.array([reader.frame(i) for i in these], pa.binary())})

    return jobs.mapInArrow(read, "doc_id long, part long, piece long, frame long, packed binary")


def token_file_digest(docs: DataFrame, tokenizer: str, end_id: int = 1, path: str | None = None) -> DataFrame:
    """Write token files, read them back, and give ``doc_id, start, n_tokens, ids_crc32`` per document.

    ``start`` counts the ids of all documents before it, in the order of the files. A null text is the
    empty text, one end id. Null numbers come first and stay null; repeated rows follow each other; an
    empty table writes no file and gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    manifest = write_token_files(docs, path or shared_path(spark, "token-files"), tokenizer, end_id)

    def digest(batches):
        for batch in batches:
            packed = batch.column("packed").to_pylist()
            yield pa.RecordBatch.from_pydict({
                **{c: batch.column(c) for c in ("doc_id", "part", "piece", "frame")},
                "n_tokens": pa.array([len(p) // 4 for p in packed], pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(p) for p in packed], pa.int64())})

    read = written(read_token_files(spark, manifest).mapInArrow(
        digest, "doc_id long, part long, piece long, frame long, n_tokens long, ids_crc32 long"), "token-digest")
    # One row per file goes through the single partition of this window.
    files = read.groupBy("part", "piece").agg(F.sum("n_tokens").alias("n"))
    order = Window.orderBy("part", "piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("part", "piece", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"))
    in_file = Window.partitionBy("part", "piece").orderBy("frame").rowsBetween(Window.unboundedPreceding, -1)
    return (read.join(starts, ["part", "piece"])
            .withColumn("start", F.col("before") + F.coalesce(F.sum("n_tokens").over(in_file), F.lit(0)))
            .select("doc_id", "start", "n_tokens", "ids_crc32"))
