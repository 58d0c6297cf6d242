"""Token ids in files of independent zstandard frames with a trailing seek table.

A file is a run of frames, each compressed on its own; a skippable frame with the document index; and the seek table
of the public seekable format: per frame its compressed size, its size and the lower 32 bits of its XXH64, then the
number of frames, a flag byte and the format's magic number. Decoders that know nothing of the tables still read all
frames in a row. A frame ends with a document unless a document alone exceeds ``frame_bytes``.

Documents are dealt by range of doc_id (and hash of the text, so that a repeated id spreads too); each partition
writes one file, under a name of its own for every attempt. The manifest, a Parquet table that Spark commits, names
the files that count; files of lost attempts are never read.

Defined cases: a null or empty text has the end id alone; null doc_ids come first; repeated rows are written as often
as they come; an empty table gives a manifest without rows.
"""

from __future__ import annotations

import struct
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyguard.llm.common import file_system, plain
from tallyguard.llm.tokens import END, encoded, vocabulary_path

#: fixed values of the public seekable format
SKIPPABLE_INDEX = 0x184D2A50
SKIPPABLE_TABLE = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

MANIFEST = "shard int, file string, documents long, ids long, bytes long, frames long"
DOCUMENT = "shard int, position long, doc_id long, start long, n_tokens long, ids binary"


class FrameWriter:
    """Writes documents to an open binary file."""

    def __init__(self, out, frame_bytes: int, level: int):
        import xxhash
        import zstandard

        self.out, self.frame_bytes = out, frame_bytes
        self.compress = zstandard.ZstdCompressor(level=level).compress
        self.checksum = lambda b: xxhash.xxh64_intdigest(b) & 0xFFFFFFFF
        self.buffer, self.held, self.frames, self.index, self.ids = [], 0, [], [], 0

    def _flush(self) -> None:
        if self.held:
            raw = b"".join(self.buffer)
            packed = self.compress(raw)
            self.out.write(packed)
            self.frames.append((len(packed), len(raw), self.checksum(raw)))
            self.buffer, self.held = [], 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        if self.held + len(ids) > self.frame_bytes:
            self._flush()
        self.index.append((doc_id is not None, doc_id or 0, len(ids) // 4))
        self.ids += len(ids) // 4
        for at in range(0, len(ids), self.frame_bytes):
            part = ids[at : at + self.frame_bytes]
            if self.held + len(part) > self.frame_bytes:
                self._flush()
            self.buffer.append(part)
            self.held += len(part)

    def close(self) -> None:
        self._flush()
        known, ids, sizes = zip(*self.index) if self.index else ((), (), ())
        body = struct.pack("<Q", len(ids)) + np.array(ids, "<i8").tobytes()
        body += np.array(sizes, "<u8").tobytes() + np.array(known, "u1").tobytes()
        self.out.write(struct.pack("<II", SKIPPABLE_INDEX, len(body)) + body)
        table = b"".join(struct.pack("<III", *f) for f in self.frames)
        footer = struct.pack("<IBI", len(self.frames), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_TABLE, len(table) + len(footer)) + table + footer)


class FrameReader:
    """Reads single documents of an open, seekable binary file; every frame is checked against its checksum."""

    def __init__(self, source, size: int):
        self.source = source
        source.seek(size - 9)
        count, flag, magic = struct.unpack("<IBI", source.read(9))
        if magic != SEEKABLE_MAGIC or not flag & CHECKSUM_FLAG:
            raise ValueError("no seek table with checksums at the end of the file")
        at = size - 9 - 12 * count
        source.seek(at)
        table = np.frombuffer(source.read(12 * count), "<u4").reshape(-1, 3).astype(np.int64)
        self.places = np.concatenate([[0], np.cumsum(table[:, 0])])
        self.starts = np.concatenate([[0], np.cumsum(table[:, 1])])
        self.sums = table[:, 2]
        source.seek(int(self.places[-1]))
        kind, length = struct.unpack("<II", source.read(8))
        if kind != SKIPPABLE_INDEX or int(self.places[-1]) + 8 + length + 8 != at:
            raise ValueError("no document index before the seek table")
        body = source.read(length)
        n = struct.unpack_from("<Q", body)[0]
        self.doc_ids = np.frombuffer(body, "<i8", n, 8)
        self.sizes = np.frombuffer(body, "<u8", n, 8 + 8 * n).astype(np.int64)
        self.known = np.frombuffer(body, "u1", n, 8 + 16 * n)
        self.offsets = np.concatenate([[0], np.cumsum(self.sizes)])
        self.frame = (-1, b"")

    def _frame(self, k: int) -> bytes:
        if self.frame[0] != k:
            import xxhash
            import zstandard

            self.source.seek(int(self.places[k]))
            packed = self.source.read(int(self.places[k + 1] - self.places[k]))
            size = int(self.starts[k + 1] - self.starts[k])
            raw = zstandard.ZstdDecompressor().decompress(packed, max_output_size=size)
            if len(raw) != size or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.sums[k]:
                raise ValueError(f"frame {k} does not match its checksum")
            self.frame = (k, raw)
        return self.frame[1]

    def ids(self, position: int) -> bytes:
        """The ids of the document at ``position`` of the file, decompressing only the frames it lies in."""
        first, last = 4 * int(self.offsets[position]), 4 * int(self.offsets[position + 1])
        k = int(np.searchsorted(self.starts, first, "right")) - 1
        parts = []
        while first < last:
            at = first - int(self.starts[k])
            part = self._frame(k)[at : at + last - first]
            parts.append(part)
            first += len(part)
            k += 1
        return b"".join(parts)


def write_ids(
    docs: DataFrame,
    folder: str,
    vocabulary: str | None = None,
    end: int | None = END,
    frame_bytes: int = 1 << 18,
    level: int = 3,
) -> DataFrame:
    """Write the ids of all documents, ascending by doc_id, to files in ``folder``; returns the committed manifest."""
    path = vocabulary or vocabulary_path()

    def run(batches):
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        found = encoded(batches, path, end)
        first = next(found, None)
        if first is None:
            return
        system, base = file_system(folder)
        system.create_dir(base, recursive=True)
        name = f"{shard:07d}-{uuid.uuid4().hex}.ids.zst"
        with system.open_output_stream(f"{base}/{name}", compression=None) as out:
            writer = FrameWriter(out, frame_bytes, level)
            writer.add(*first)
            for doc_id, ids in found:
                writer.add(doc_id, ids)
            writer.close()
            size = out.tell()
        row = [[shard], [name], [len(writer.index)], [writer.ids], [size], [len(writer.frames)]]
        kinds = (pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
        names = [x.split()[0] for x in MANIFEST.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(row, kinds)], names)

    ordered = plain(docs).withColumn("_tie", F.xxhash64("text"))
    ordered = ordered.repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie").drop("_tie")
    ordered.mapInArrow(run, MANIFEST).write.parquet(f"{folder}/manifest")
    return manifest(docs.sparkSession, folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """One row per file, with the ids in all files before it as ``base``."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    files = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    return files.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read_ids(spark: SparkSession, folder: str, doc_ids: set[int] | None = None) -> DataFrame:
    """The documents of all files, or those named, with the ids before each (``start``) and their own."""
    files = manifest(spark, folder).select("shard", "file", "base")
    spread = max(1, files.count())

    def run(batches):
        names = [x.split()[0] for x in DOCUMENT.split(", ")]
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        for batch in batches:
            for shard, file, base in zip(*(batch.column(i).to_pylist() for i in range(3))):
                system, root = file_system(folder)
                place = f"{root}/{file}"
                with system.open_input_file(place) as source:
                    reader = FrameReader(source, source.size())
                    rows, held = [], 0
                    for k in range(len(reader.sizes)):
                        doc_id = int(reader.doc_ids[k]) if reader.known[k] else None
                        if doc_ids is not None and doc_id not in doc_ids:
                            continue
                        ids = reader.ids(k)
                        rows.append((shard, k, doc_id, base + int(reader.offsets[k]), int(reader.sizes[k]), ids))
                        held += len(ids)
                        if held > 8_000_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    return files.repartitionByRange(spread, "shard").mapInArrow(run, DOCUMENT)
