"""Token-id files with directly addressable codes: any id is read without decoding those before it.

An id is split into chunks, one for each level. Level 0 holds the low chunk of every id and a bitmap that tells which ids go on;
level 1 holds the next chunk of only those, and so on. The place of an id on the next level is the rank of its
bit, found through a directory of counts before each block of BLOCK bits.

A file is a Parquet table of segments: consecutive documents, ascending by id, with header columns (part, nth, n_docs, n_ids)
and a binary payload: `RSDAC1`, counts, the id and first token of each document, then for each level its width, chunks, bitmap
and directory; little-endian. Spark writes and reads it, so it may lie in any store that Spark reaches.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._shared import Scratch, gathered, release, slices
from .tokens import crc, encoder, vocabulary, with_ends

MAGIC = b"RSDAC1\0\0"
WIDTHS = (8, 8, 16)
BLOCK = 512
SEGMENT = "part int, nth int, n_docs long, n_ids long, payload binary"


class Codes:
    """One sequence of ids below 2 ** sum(widths)."""

    def __init__(self, levels: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]], n: int):
        self.levels, self.n = levels, n

    @classmethod
    def encode(cls, ids: np.ndarray, widths=WIDTHS) -> Codes:
        rest, levels = np.asarray(ids, np.uint64), []
        for k, w in enumerate(widths):
            chunk = (rest & np.uint64((1 << w) - 1)).astype(f"<u{w // 8}")
            more = rest >> np.uint64(w)
            on = more > 0 if k < len(widths) - 1 else np.zeros(len(rest), bool)
            padded = np.zeros(-(-len(on) // BLOCK) * BLOCK, bool)
            padded[: len(on)] = on
            counts = padded.reshape(-1, BLOCK).sum(1)
            levels.append((w, chunk, np.packbits(padded, bitorder="little"), np.concatenate(([0], np.cumsum(counts))).astype("<u4")))
            rest = more[on]
            if not len(rest):
                break
        return cls(levels, len(ids))

    @staticmethod
    def _rank(bitmap: np.ndarray, directory: np.ndarray, at: int) -> int:
        """Bits set before at."""
        block = at // BLOCK
        bits = int.from_bytes(bitmap[block * BLOCK // 8 : (at + 7) // 8].tobytes(), "little") & ((1 << (at - block * BLOCK)) - 1)
        return int(directory[block]) + bits.bit_count()

    def __getitem__(self, at: int) -> int:
        """The id at a place, by one rank for each of its further levels."""
        if not 0 <= at < self.n:
            raise IndexError(at)
        value, shift = 0, 0
        for w, chunk, bitmap, directory in self.levels:
            value |= int(chunk[at]) << shift
            if not bitmap[at >> 3] >> (at & 7) & 1:
                break
            shift += w
            at = self._rank(bitmap, directory, at)
        return value

    def read(self, first: int, end: int) -> np.ndarray:
        """The ids from first to end; only their chunks are touched."""
        first, end = max(0, first), min(self.n, end)
        out = np.zeros(max(0, end - first), np.uint32)
        where, shift = np.arange(len(out)), 0
        for w, chunk, bitmap, directory in self.levels:
            if end <= first:
                break
            out[where] |= chunk[first:end].astype(np.uint32) << np.uint32(shift)
            low = first & ~7
            on = np.unpackbits(bitmap[low >> 3 : (end + 7) >> 3], bitorder="little")[first - low : end - low].astype(bool)
            where, shift = where[on], shift + w
            first = self._rank(bitmap, directory, first)
            end = first + len(where)
        return out

    def to_bytes(self) -> bytes:
        parts = [struct.pack("<QI", self.n, len(self.levels))]
        for w, chunk, bitmap, directory in self.levels:
            parts += [struct.pack("<IQ", w, len(chunk)), chunk.tobytes(), bitmap.tobytes(), directory.tobytes()]
        return b"".join(parts)

    @classmethod
    def from_bytes(cls, data: memoryview) -> Codes:
        n, many = struct.unpack_from("<QI", data)
        at, levels = 12, []
        for _ in range(many):
            w, size = struct.unpack_from("<IQ", data, at)
            at += 12
            blocks = -(-size // BLOCK)
            got = []
            for kind, count in ((f"<u{w // 8}", size), (np.uint8, blocks * BLOCK // 8), ("<u4", blocks + 1)):
                got.append(np.frombuffer(data, kind, count, at))
                at += got[-1].nbytes
            levels.append((w, *got))
        return cls(levels, n)


def segment(doc_ids: pa.Array, ids: np.ndarray, first: np.ndarray) -> bytes:
    null = np.asarray(doc_ids.is_null()).astype(np.uint8)
    own = np.asarray(doc_ids.fill_null(0), "<i8")
    return b"".join([MAGIC, struct.pack("<Q", len(own)), own.tobytes(), null.tobytes(), first.astype("<u8").tobytes(), Codes.encode(ids).to_bytes()])


class Segment:
    """A segment's payload, opened without decoding."""

    def __init__(self, payload: bytes):
        data = memoryview(payload)
        if data[:8] != MAGIC:
            raise ValueError("not a segment of token ids")
        (n,) = struct.unpack_from("<Q", data, 8)
        at = 16
        self.doc_ids = np.frombuffer(data, "<i8", n, at)
        self.null = np.frombuffer(data, np.uint8, n, at + 8 * n).astype(bool)
        self.first = np.frombuffer(data, "<u8", n + 1, at + 9 * n).astype(np.int64)
        self.codes = Codes.from_bytes(data[at + 9 * n + 8 * (n + 1) :])

    def document(self, k: int) -> np.ndarray:
        return self.codes.read(int(self.first[k]), int(self.first[k + 1]))


def write(docs: DataFrame, scratch_path: str, path: str | None = None, text: str = "text", doc_id: str = "doc_id") -> None:
    """Write the ids of every row, with end ids, as segments in ascending order of the ids (null first)."""
    path = path or vocabulary()
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = rows.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, part, nth = encoder(path), TaskContext.get().partitionId(), 0
        for batch in gathered(batches, 1, 14 << 20):
            for f, e in slices(batch.column(1), 18 << 20):
                own = batch.slice(f, e - f)
                ids, first = with_ends(*enc.encode(own.column(1)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([nth], pa.int32()), pa.array([e - f]), pa.array([len(ids)]), pa.array([segment(own.column(0), ids, first)])],
                    names=["part", "nth", "n_docs", "n_ids", "payload"],
                )
                nth += 1
                release()

    rows.mapInArrow(run, SEGMENT).write.option("compression", "none").parquet(scratch_path)


def read(spark, at: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document of the files below at."""
    stored = spark.read.schema(SEGMENT).parquet(at)
    heads = stored.select("part", "nth", "n_ids")
    parts = heads.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    # one row for each written file
    parts = parts.select("part", F.coalesce(F.sum("n").over(before.partitionBy(F.lit(0)).orderBy("part")), F.lit(0)).alias("base"))
    inner = F.coalesce(F.sum("n_ids").over(before.partitionBy("part").orderBy("nth")), F.lit(0))
    starts = heads.select("part", "nth", inner.alias("inner")).join(parts, "part").select("part", "nth", (F.col("base") + F.col("inner")).alias("begin"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, nth, payload in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                seg = Segment(payload)
                n = len(seg.doc_ids)
                sums = [crc(seg.document(k)) for k in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part] * n, pa.int32()), pa.array([nth] * n, pa.int32()), pa.array(seg.doc_ids, pa.int64(), mask=seg.null),
                        pa.array(seg.first[:-1]), pa.array(np.diff(seg.first)), pa.array(sums, pa.int64()),
                    ],
                    names=["part", "nth", "doc_id", "local", "n_tokens", "ids_crc32"],
                )

    decoded = stored.select("part", "nth", "payload").mapInArrow(run, "part int, nth int, doc_id long, local long, n_tokens long, ids_crc32 long")
    return decoded.join(starts, ["part", "nth"]).select("doc_id", (F.col("begin") + F.col("local")).cast("long").alias("start"), "n_tokens", "ids_crc32")


def digest(docs: DataFrame) -> DataFrame:
    """Write the files to the shared folder and read them back.

    Null and empty texts have the end id only; repeated rows and ids are stored each, ties in any order; a null id stays
    null and comes first; an empty table gives an empty result; other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "tokens")
    write(docs, f"{scratch.root}/ids")
    return read(docs.sparkSession, f"{scratch.root}/ids")
