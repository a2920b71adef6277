"""What the corpus operators share: scratch tables in the shared folder, connected components, ragged arrays."""

from __future__ import annotations

import atexit
import ctypes
import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, as a Java/RE2 character class and as plain characters.
SPACE_CLASS = r"[\x20\x09-\x0D]"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; a local one only where spark.checkpoint.dir is unset and they are one process."""
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        at = sc._jsc.sc().getCheckpointDir()
        if at.isEmpty():
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="riskspark-"))
            at = sc._jsc.sc().getCheckpointDir()
        folder = at.get()
    return folder.rstrip("/")


BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession, limit: int = 4 << 20) -> None:
    """From now on Arrow batches hold at most so many bytes, however long the texts are; a smaller setting stays."""
    now = str(spark.conf.get(BATCH, "64m")).rstrip("b")
    if not now.isdigit() or not 0 < int(now) <= limit:
        spark.conf.set(BATCH, str(limit))


def release() -> None:
    """Give freed memory back to the system: workers are reused by later stages."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        pass


class Scratch:
    """Tables written below the shared folder: they cut lineage, survive lost executors, and go when dropped or at exit."""

    #: Those whose tables are not removed yet.
    live: list[Scratch] = []

    def __init__(self, spark: SparkSession, name: str):
        bounded_batches(spark)
        Scratch.live.append(self)
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        self.made = 0
        atexit.register(self.clear)

    def table(self, df: DataFrame) -> DataFrame:
        """Write df as Parquet and read it again."""
        self.made += 1
        path = f"{self.root}/{self.made:04d}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, df: DataFrame) -> None:
        """Remove the table that table() has returned as df; other frames are left alone."""
        path = getattr(df, "_scratch_path", None)
        if path and path.startswith(f"{self.root}/"):
            self._delete(path)

    def free_shuffles(self) -> None:
        """Let Spark's cleaner remove the shuffle files of plans that are done."""
        self.spark.sparkContext._jvm.System.gc()

    def clear(self) -> None:
        if self in Scratch.live:
            Scratch.live.remove(self)
        try:
            self._delete(self.root)
        except Exception:  # noqa: BLE001  the session may have ended before
            pass

    def _delete(self, path: str) -> None:
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def clear_scratch() -> None:
    """Remove all scratch tables of this process: for long sessions, once the results that read them are written."""
    for scratch in list(Scratch.live):
        scratch.clear()


def packed(docs: DataFrame):
    """All columns as one struct, so that names of an operator's own cannot clash with them; unpacked() turns it back."""
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")


def unpacked(columns: list[str], put: dict | None = None) -> list:
    """The columns of a packed row, some of them replaced."""
    return [((put or {})[c] if c in (put or {}) else F.col(f"row.`{c}`")).alias(c) for c in columns]


def row_key(doc_id: str, text: str) -> list:
    """Two longs, 128 bits of a SHA-256 of id and text: rows alike in both are alike in id and text."""
    whole = F.concat(F.coalesce(F.col(doc_id).cast("long").cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.col(text), F.lit("")))
    digest = F.sha2(whole, 256)
    return [F.conv(F.substring(digest, at, 16), 16, -10).cast("long") for at in (1, 17)]


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, component) of every node of the undirected edges (a, b); component is the smallest id reachable.

    Each round hooks every node to its smallest neighbour, jumps once, and relabels the edges; a round's
    tables are written to the shared folder, and the loop ends when no edge is left. Nothing is collected.
    """
    left = scratch.table(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )
    labels = None
    while not left.isEmpty():
        ends = left.select(F.inline(F.expr("array(struct(a AS id, b AS o), struct(b AS id, a AS o))")))
        up = ends.groupBy("id").agg(F.min("o").alias("o")).select("id", F.least("id", "o").alias("up"))
        tops = up.select(F.col("id").alias("up"), F.col("up").alias("top"))
        jump = scratch.table(up.join(tops, "up").select("id", "top"))
        if labels is None:
            labels = jump.select("id", F.col("top").alias("component"))
        else:
            step = jump.select(F.col("id").alias("component"), "top")
            labels = labels.join(step, "component", "left").select("id", F.coalesce("top", "component").alias("component"))
        ja = jump.select(F.col("id").alias("a"), F.col("top").alias("ta"))
        jb = jump.select(F.col("id").alias("b"), F.col("top").alias("tb"))
        after = scratch.table(
            left.join(ja, "a")
            .join(jb, "b")
            .where("ta <> tb")
            .select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b"))
            .distinct()
        )
        scratch.drop(left)
        left = after
    if labels is None:
        return left.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return scratch.table(labels)


def ragged_take(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The pieces values[starts[i]:starts[i] + lengths[i]] for i in order, joined."""
    n = lengths[order]
    total = int(n.sum())
    if not total:
        return values[:0]
    # 32-bit places, where they do, halve the largest arrays of an encoder
    kind = np.int32 if max(total, len(values)) < 2**31 else np.int64
    at = np.arange(total, dtype=kind)
    at += np.repeat((starts[order] - (np.cumsum(n) - n)).astype(kind), n)
    return values[at]


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Component labels (the smallest index reachable) of nodes 0..n-1 under edges a-b; vectorised hooking and jumping."""
    label = np.arange(n)
    while len(a):
        low, high = np.minimum(a, b), np.maximum(a, b)
        np.minimum.at(label, high, low)
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label = up
        a, b = label[low], label[high]
        keep = a != b
        a, b = a[keep], b[keep]
    return label


def gathered(batches, column: int, limit: int):
    """Arrow batches joined until their column has about limit bytes: the executor's buffers stay small, the worker's runs long."""
    import pyarrow as pa

    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.column(column).nbytes
        if size >= limit:
            joined = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
            yield joined
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def slices(column, limit: int):
    """(first, end) of runs of rows whose texts have about limit bytes, from an Arrow string or binary array."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    total, first = np.cumsum(sizes), 0
    while first < len(sizes):
        base = total[first - 1] if first else 0
        end = max(first + 1, int(np.searchsorted(total, base + limit, "right")))
        yield first, end
        first = end
