"""SimHash near-dedup: 64-bit fingerprints of word shingles, joined by a binary trie walked against itself.

Fingerprints within LIMIT bits of each other agree on at least one of LIMIT + 1 blocks of their bits. So one trie is
built for each block, with that block rotated to its root, and only node pairs on the diagonal below the root
block are walked: pairs of nodes are split together, bit by bit, each differing bit is charged to the pair, and
a pair whose charge exceeds LIMIT is dropped with all that lies under it. The tries are dealt out by block value, so no
fingerprint meets more of the others than share a block with it. A cell, a block value, of more than CELL fingerprints is split by the same
rule: what is left of the bits falls into LIMIT + 1 blocks again, of which a linked pair shares one. Copies of one fingerprint are one leaf.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import Scratch, components, forest, packed, release, row_key, unpacked

SHINGLE = 4
SEED = 42
LIMIT = 4
#: Node pairs that a walk holds at once.
PAIRS = 400_000
#: Fingerprints of a cell that is walked whole, and the shared bits beyond which cells are not split further.
CELL, DEEP = 1 << 18, 44
#: Fingerprints, once for each cell, that a task walks: tasks grow with the table.
PER_TASK = 1 << 21
#: Shingles hashed at once.
HASHED = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The fingerprint as an unsigned number; null, empty and blank texts have zero."""
    import xxhash

    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    whole = b" ".join(words)
    h = xxhash.xxh64_digest
    if len(words) <= shingle:
        return int.from_bytes(h(whole, seed), "big")
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts, stops = np.concatenate(([0], ends[:-1]))[: len(words) - shingle + 1], ends[shingle - 1 :] - 1
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), HASHED):
        digests = b"".join([h(whole[a:b], seed) for a, b in zip(starts[at : at + HASHED].tolist(), stops[at : at + HASHED].tolist())])
        ones += np.unpackbits(np.frombuffer(digests, np.uint8)).reshape(-1, 64).sum(0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * ones > len(starts)).tobytes(), "big")


def fingerprint_column(text, shingle: int = SHINGLE, seed: int = SEED):
    """A column of fingerprints as signed 64-bit numbers."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        out = np.array([fingerprint(t, shingle, seed) for t in texts], np.uint64).view(np.int64)
        release()
        return pd.Series(out)

    return of(text)


def block_widths(limit: int, bits: int = 64) -> list[int]:
    """Widths of limit + 1 blocks of so many bits, as even as can be."""
    k = limit + 1
    return [bits // k + (i < bits % k) for i in range(k)]


def _bits(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def walk(keys: np.ndarray, root: int, limit: int, label: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of sorted distinct keys that share their first root bits and differ in at most limit bits.

    The trie is implicit: a node is a run of keys with a common prefix, and a level's running count of ones
    splits it. Pairs of nodes all of whose keys have one label are skipped, as they are linked already.
    """
    n = len(keys)
    if n < 2:
        return
    ones: dict[int, np.ndarray] = {}

    def count(depth: int) -> np.ndarray:
        if depth not in ones:
            ones[depth] = np.concatenate(([0], np.cumsum(((keys >> np.uint64(63 - depth)) & np.uint64(1)).astype(np.int32))))
        return ones[depth]

    turns = np.concatenate(([0], np.cumsum(label[1:] != label[:-1])))
    first = np.flatnonzero(np.concatenate(([True], (keys[1:] ^ keys[:-1]) >> np.uint64(64 - root) != 0)))
    ends = np.append(first[1:], n)
    big = ends - first > 1
    # roots go on the stack a few at a time, the last first
    lo, hi = first[big].astype(np.int64), ends[big].astype(np.int64)
    stack = [(root, lo[i : i + PAIRS], hi[i : i + PAIRS], lo[i : i + PAIRS], hi[i : i + PAIRS], np.zeros(len(lo[i : i + PAIRS]), np.int8)) for i in range(0, len(lo), PAIRS)]
    while stack:
        depth, a0, a1, b0, b1, charge = stack.pop()
        if not len(a0):
            continue
        if len(a0) > PAIRS:
            half = len(a0) // 2
            stack += [(depth, *(x[:half] for x in (a0, a1, b0, b1, charge))), (depth, *(x[half:] for x in (a0, a1, b0, b1, charge)))]
            continue
        # leaves are compared at once: nothing branches below them
        leaf = (a1 - a0 == 1) & (b1 - b0 == 1)
        if leaf.any():
            i, j = a0[leaf], b0[leaf]
            near = (i != j) & (_bits(keys[i] ^ keys[j]) <= limit)
            if near.any():
                yield i[near], j[near]
            inner = ~leaf
            a0, a1, b0, b1, charge = a0[inner], a1[inner], b0[inner], b1[inner], charge[inner]
        if not len(a0) or depth == 64:
            continue
        c = count(depth)
        am, bm = a1 - (c[a1] - c[a0]), b1 - (c[b1] - c[b0])
        same = a0 == b0
        other = ~same
        parts = [
            (a0, am, b0, bm, charge),
            (am, a1, bm, b1, charge),
            (a0, am, bm, b1, charge + 1),
            (am[other], a1[other], b0[other], bm[other], charge[other] + 1),
        ]
        merged = [np.concatenate(x) for x in zip(*parts, strict=True)]
        x0, x1, y0, y1, e = merged
        keep = (x1 > x0) & (y1 > y0) & (e <= limit)
        x0, x1, y0, y1, e = (x[keep] for x in (x0, x1, y0, y1, e))
        known = (turns[x1 - 1] == turns[x0]) & (turns[y1 - 1] == turns[y0]) & (label[x0] == label[y0])
        keep = ~known
        stack.append((depth + 1, *(x[keep] for x in (x0, x1, y0, y1, e))))


def linked(keys: np.ndarray, root: int, limit: int) -> np.ndarray:
    """Labels of the components of sorted distinct keys; budgets grow, so that dense groups are one label before the costly walk."""
    label = np.arange(len(keys))
    for budget in dict.fromkeys((min(1, limit), min(2, limit), limit)):
        a, b, held = [], [], 0
        start = label.copy()

        def settle():
            nonlocal label, a, b, held
            if a:
                i, j = np.concatenate(a), np.concatenate(b)
                label = forest(label[i], label[j], len(keys))[label]
                a, b, held = [], [], 0

        for i, j in walk(keys, root, budget, start):
            a.append(i)
            b.append(j)
            held += len(i)
            if held > 1_000_000:
                settle()
        settle()
    return label


def _turned(rows: DataFrame, shared: int, limit: int) -> DataFrame:
    """rows (fp, path, key, w = shared) once for each block of the bits after the first shared ones, with that block next to them."""
    rest = 64 - shared
    widths = block_widths(limit, rest)
    low, high = (1 << rest) - 1, ~((1 << rest) - 1)
    turns, o = [], 0
    for nth, w in enumerate(widths):
        turned = f"(key & {high}L) | (((shiftleft(key & {low}L, {o}) | shiftrightunsigned(key & {low}L, {rest - o}))) & {low}L)" if o else "key"
        if o and not shared:
            turned = f"shiftleft(key, {o}) | shiftrightunsigned(key, {rest - o})"
        turns.append(f"struct(path * {limit + 2} + {nth + 1} AS path, {turned} AS key, {shared + w} AS w)")
        o += w
    return rows.select("fp", F.expr(f"inline(array({', '.join(turns)}))"))


def links(fps: DataFrame, limit: int = LIMIT, scratch: Scratch | None = None) -> DataFrame:
    """(a, b): a spanning forest, for each trie, of the pairs of distinct fingerprints (column fp) within limit bits.

    Every linked pair shares a cell at each depth of splitting, since limit differing bits leave one of limit + 1 blocks alike.
    """
    scratch = scratch or Scratch(fps.sparkSession, "simhash")
    open_, depths, done = fps.select("fp", F.lit(0).cast("long").alias("path"), F.col("fp").alias("key"), F.lit(0).alias("w")), [0], []
    while depths:
        turned = [_turned(open_.where(f"w = {w}"), w, limit) for w in depths]
        depths = sorted({w + x for w in depths for x in block_widths(limit, 64 - w)})
        rows = turned[0]
        for more in turned[1:]:
            rows = rows.unionByName(more)
        rows = rows.withColumn("cell", F.expr("shiftrightunsigned(key, 64 - w)"))
        # at most one in CELL of the rows: small enough to be sent around
        hot = rows.where(f"w < {DEEP}").groupBy("path", "cell").agg(F.count("*").alias("n")).where(f"n > {CELL}").select("path", "cell", F.lit(True).alias("hot"))
        hot = scratch.table(hot)
        if hot.isEmpty():
            done.append(rows)
            break
        rows = scratch.table(rows.join(hot, ["path", "cell"], "left"))
        done.append(rows.where("hot IS NULL").drop("hot"))
        open_ = rows.where("hot").drop("hot", "cell")
    dealt = done[0]
    for more in done[1:]:
        dealt = dealt.unionByName(more)
    # a task holds its cells, and a split cell's rows stand in place of it LIMIT + 1 times; by the counts of written tables
    tasks = -(-sum(x.count() for x in done) // PER_TASK)
    cells = ["path", "cell"]
    least = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = (dealt.repartition(tasks, *cells) if tasks > least else dealt.repartition(*cells)).select("path", "w", "key", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [[np.asarray(c) for c in b.columns] for b in batches if b.num_rows]
        if not got:
            return
        path, shared, key, fp = (np.concatenate(x) for x in zip(*got, strict=True))
        by = np.lexsort((key.view(np.uint64), path))
        edges = np.flatnonzero(np.concatenate(([True], path[by][1:] != path[by][:-1], [True])))
        for f, z in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            own = by[f:z]
            keys = key[own].view(np.uint64)
            label = linked(keys, int(shared[own[0]]), limit)
            child = np.flatnonzero(label != np.arange(len(keys)))
            yield pa.RecordBatch.from_arrays([pa.array(fp[own[child]]), pa.array(fp[own[label[child]]])], names=["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def _named(classes: DataFrame, limit: int, scratch: Scratch) -> DataFrame:
    """classes, one row for each fingerprint fp, with the component of each, a fingerprint."""
    comps = components(links(classes.select("fp"), limit, scratch), scratch)
    return classes.join(comps.select(F.col("id").alias("fp"), "component"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))


def near_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", limit: int = LIMIT) -> DataFrame:
    """doc_id, fp (signed) and component_id for every row.

    Rows with null or blank texts have fingerprint zero and are linked as any other; repeated rows are linked by
    distance 0. component_id is the smallest id of the component; null ids count only if a component has no other.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    rows = scratch.table(docs.select(F.col(doc_id).alias("doc_id"), fingerprint_column(F.col(text)).alias("fp")))
    classes = scratch.table(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    named = _named(classes, limit, scratch)
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = scratch.table(named.join(least, "component").select("fp", "component_id"))
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def digest(docs: DataFrame) -> DataFrame:
    return near_groups(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame) -> DataFrame:
    """docs with one row of each component: that of the smallest id, null ids last, and of rows alike in id that of the smallest row key."""
    scratch = Scratch(docs.sparkSession, "simhash")
    key = [k.alias(f"_k{i}") for i, k in enumerate(row_key("doc_id", "text"))]
    own = F.col("doc_id").cast("long")
    rows = docs.select(F.struct(own.isNull().alias("without"), own.alias("id"), *key).alias("head"), fingerprint_column(F.col("text")).alias("fp"))
    classes = scratch.table(rows.groupBy("fp").agg(F.min("head").alias("head")))
    first = _named(classes, LIMIT, scratch).groupBy("component").agg(F.min("head").alias("head")).select("head._k0", "head._k1")
    # rows alike in their key are alike in id and text; the rows stay where the join has put them
    kept = docs.select(packed(docs), *key).join(first, ["_k0", "_k1"], "left_semi").dropDuplicates(["_k0", "_k1"])
    return kept.select(*unpacked(docs.columns))
