"""Sharding: size-weighted sampled splitters, range partitioning, and subdivision of overfull ranges; DataFrame functions only.

The law is `bytes`: rows are laid out along one key order (text digest, then id), equal texts next to each
other, and shard s takes the records whose first byte lies in [s, s + 1) / shards of all bytes. Sizes differ by at
most about one record. The splitters only deal the rows out, so the sample decides the speed and not the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._shared import Scratch, packed, unpacked

#: Expected number of sampled keys for each range, and the share of the mean above which a range is subdivided.
SAMPLE_PER_RANGE = 32
OVERFULL = 2.0
#: Rows of a range, and the least and most ranges: what a task sorts, and what splitters the driver holds (32 of them a range).
ROWS, RANGES, RANGES_MOST = 100_000, 256, 4096
#: Bytes of texts in one written file.
FILE = 128 << 20

Bound = tuple[str, int, int]


def _range_of(bounds: list[Bound]):
    """The number of bounds that are not above the key: a search in blocks, then in the one block."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    triple = lambda b: f"struct('{b[0]}' AS g, CAST({b[1]} AS BIGINT) AS i, CAST({b[2]} AS BIGINT) AS n)"
    blocks = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    heads = f"array({', '.join(triple(b[0]) for b in blocks)})"
    inner = f"array({', '.join('array(' + ', '.join(map(triple, b)) + ')' for b in blocks)})"
    block = F.expr(f"size(filter({heads}, b -> b <= key))")
    within = F.expr(f"CASE WHEN blk = 0 THEN 0 ELSE (blk - 1) * {step} + size(filter(get({inner}, blk - 1), b -> b <= key)) END")
    return block, within


def _dealt(rows: DataFrame, bounds: list[Bound]) -> DataFrame:
    keyed = rows.withColumn("key", F.expr("struct(g AS g, i AS i, n AS n)"))
    if not bounds:
        return keyed.withColumn("rng", F.lit(0))
    block, within = _range_of(bounds)
    return keyed.withColumn("blk", block).withColumn("rng", within).drop("blk")


def _splitters(sample: DataFrame, ranges: int) -> list[Bound]:
    """Quantile boundaries of a size-weighted sample whose expected size is SAMPLE_PER_RANGE * ranges rows."""
    got = sorted((r.g, r.i, r.n) for r in sample.select("g", "i", "n").distinct().collect())
    if len(got) <= 1:
        return []
    return sorted({got[len(got) * k // ranges] for k in range(1, ranges)})


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """What is laid out of each row; n is the row's own number, which must be on docs."""
    t = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(doc_id).cast("long"), F.lit(-(2**63))).alias("i"),
        (F.octet_length(t) + F.lit(1)).cast("long").alias("size"), F.crc32(t).alias("crc"), F.md5(t).alias("g"), "n",
    )


def _placed(rows: DataFrame, shards: int, ranges: int | None, scratch: Scratch) -> DataFrame:
    """rows with shard and slot; they are read several times and should be a written table."""
    head = rows.agg(F.sum("size").alias("s"), F.count("*").alias("n")).first()
    total, ranges = head.s, ranges or max(RANGES, min(RANGES_MOST, head.n // ROWS))
    bounds: list[Bound] = []
    if total:
        # a row is drawn with probability size * rate, by a hash of its key and not by chance: reruns draw alike
        chance = "(xxhash64(g, i, n) & 1073741823) / 1073741824.0D"
        rate = SAMPLE_PER_RANGE * ranges / total
        bounds = _splitters(rows.where(F.expr(f"{chance} < size * {rate!r}D")), ranges)
        sums = _dealt(rows, bounds).groupBy("rng").agg(F.sum("size").alias("s"), F.count("*").alias("n")).collect()
        over = [r.rng for r in sums if r.s > OVERFULL * total / ranges and r.n > 1]
        if over:
            many = min(ranges, 1 + int(sum(r.s for r in sums if r.rng in set(over)) * ranges / total)) * SAMPLE_PER_RANGE
            heavy = sum(r.s for r in sums if r.rng in set(over))
            again = _dealt(rows, bounds).where(F.col("rng").isin(over)).where(F.expr(f"{chance} < size * {many / heavy!r}D"))
            fine = _splitters(again, max(2, many // SAMPLE_PER_RANGE * 2))
            bounds = sorted({*bounds, *fine})
    placed = _dealt(rows, bounds)
    by = placed.groupBy("rng").agg(F.sum("size").alias("s"), F.count("*").alias("n"))
    # one row for each range, so this window holds as many rows as there are ranges
    w = Window.partitionBy(F.lit(0)).orderBy("rng").rowsBetween(Window.unboundedPreceding, -1)
    starts = by.select(
        "rng", F.coalesce(F.sum("s").over(w), F.lit(0)).alias("s0"), F.coalesce(F.sum("n").over(w), F.lit(0)).alias("n0")
    )
    inside = Window.partitionBy("rng").orderBy("g", "i", "n").rowsBetween(Window.unboundedPreceding, -1)
    along = placed.join(F.broadcast(starts), "rng").select(
        "id", "size", "crc", "n",
        (F.col("s0") + F.coalesce(F.sum("size").over(inside), F.lit(0))).alias("at"),
        (F.col("n0") + F.coalesce(F.count("*").over(inside), F.lit(0))).alias("nth"),
    )
    whole = int(total or 1)
    put = scratch.table(along.withColumn("shard", F.expr(f"CAST(least({shards - 1}, floor(at * CAST({shards} AS DECIMAL(20,0)) / {whole})) AS INT)")))
    firsts = put.groupBy("shard").agg(F.min("nth").alias("first"))
    return put.join(F.broadcast(firsts), "shard").select("id", "size", "crc", "n", "at", "shard", (F.col("nth") - F.col("first")).cast("long").alias("slot"))


def shard(
    docs: DataFrame, shards: int = 16, doc_id: str = "doc_id", text: str = "text", ranges: int | None = None
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row.

    Size is the UTF-8 length plus 1 (null text: 1, checksum 0, as an empty text). Equal texts lie side by side and
    share a shard save where a boundary of bytes falls within them. A shard's bytes differ from total / shards by less than the largest
    size, as it begins and ends with the first row at or after a boundary. Rows alike in text and id are in any order. A null id sorts
    first within its text. An empty table gives an empty result. Other columns are not read.
    """
    # texts are read once; the rows that the splitters are drawn from, counted and laid out by are short
    scratch = Scratch(docs.sparkSession, "sharding")
    rows = scratch.table(_rows(docs.select(doc_id, text).withColumn("n", F.monotonically_increasing_id()), doc_id, text))
    return _placed(rows, shards, ranges, scratch).select(
        F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, path: str, shards: int = 16, doc_id: str = "doc_id", text: str = "text") -> None:
    """Write whole records, one folder for each shard, in slot order within each file and from file to file.

    Every row is written once, whatever its id: rows are numbered in a written copy, and places are joined by that number. A file has about
    FILE bytes of texts. Columns keep their names, save that the folders add `shard`; a column of that name is refused.
    """
    if "shard" in docs.columns:
        raise ValueError("the records have a column shard already")
    scratch = Scratch(docs.sparkSession, "sharding")
    held = scratch.table(docs.select(packed(docs)).withColumn("n", F.monotonically_increasing_id()))
    rows = scratch.table(_rows(held.select(F.col(f"row.`{doc_id}`").alias("id"), F.col(f"row.`{text}`").alias("t"), "n"), "id", "t"))
    places = _placed(rows, shards, None, scratch).select("n", "shard", "slot", "at")
    files = max(shards, int((rows.agg(F.sum("size").alias("s")).first().s or 0) // FILE) + 1)
    own = held.join(places, "n").repartitionByRange(files, "at").sortWithinPartitions("shard", "slot")
    own.select(*unpacked(docs.columns), "shard").write.partitionBy("shard").parquet(path)


def oracle(shards: int = 16) -> str:
    """shard() for DuckDB over the view documents, the checksum spelled out byte by byte."""
    return f"""
WITH tab AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS tab),
d AS (SELECT doc_id, t, CAST(octet_length(encode(t)) + 1 AS BIGINT) AS size, md5(t) AS g, coalesce(doc_id, -9223372036854775808) AS i FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)),
c AS (SELECT *, xor(list_reduce(list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda h: CAST('0x' || h AS BIGINT)), lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) AS crc FROM d, tab),
p AS (SELECT *, coalesce(sum(size) OVER (ORDER BY g, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begin_at, sum(size) OVER () AS total FROM c),
s AS (SELECT *, CAST(least({shards - 1}, begin_at * {shards} // total) AS INTEGER) AS shard FROM p)
SELECT doc_id, size, CAST(crc AS BIGINT) AS text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY g, i) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM s"""
