"""Best-fit packing whose bin counts are certified by dual-feasible-function lower bounds.

Each partition packs its pieces by best-fit decreasing and holds its number of bins against the largest lower bound
of a family of dual feasible functions. Where the two agree the packing is optimal for that partition and is settled. Where
bins are left over, the partition keeps its full bins and gives up the documents of the others; those are exchanged
among all partitions with such gaps and packed again, until none is left. What is left after ROUNDS, or in one partition, which has no
other to exchange with, is packed a second time, bins filled exactly where sums allow; the better packing stands, and its pieces tell by
`certified` whether it meets the bound.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import Scratch, bounded_batches, gathered, release, slices
from .tokens import crc, encoder, vocabulary, with_ends

CAPACITY = 1024
#: Pieces for each partition of a round: what one task holds.
PER_TASK = 150_000
ROUNDS = 5

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def lower_bound(sizes: np.ndarray, capacity: int = CAPACITY) -> int:
    """The largest lower bound on the number of bins, over dual feasible functions, in integers only."""
    if not len(sizes):
        return 0
    n = np.bincount(sizes, minlength=capacity + 1).astype(np.int64)
    x = np.arange(capacity + 1, dtype=np.int64)
    best = -(-int((n * x).sum()) // capacity)
    count, mass = np.cumsum(n), np.cumsum(n * x)
    half = capacity // 2
    # threshold family: sizes below a count nothing, sizes over capacity - a a whole bin
    a = np.arange(1, half + 1)
    whole = count[capacity] - count[capacity - a]
    middle = count[capacity - a] - count[half]
    spare = middle * capacity - (mass[capacity - a] - mass[half])
    small = mass[half] - mass[a - 1]
    best = max(best, int((whole + middle + np.maximum(0, -(-(small - spare) // capacity))).max()))
    # rounding family: u_k(x) = x where (k + 1) x / capacity is whole, else floor of it over k
    for k in range(1, 33):
        steps = (k + 1) * x
        value = np.where(steps % capacity == 0, k * x, steps // capacity * capacity)
        best = max(best, -(-int((n * value).sum()) // (k * capacity)))
    return best


def best_fit(sizes: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset, room): best-fit decreasing. The bin and place of each size, and what is left in each bin."""
    order = np.argsort(-sizes, kind="stable")
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, n = 0, 0
    for at, size in zip(order.tolist(), sizes[order].tolist(), strict=True):
        fits = mask >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = free[room].pop()
            if not free[room]:
                mask ^= 1 << room
        else:
            room, b, n = capacity, n, n + 1
        bins[at], offsets[at] = b, capacity - room
        rest = room - size
        if not free[rest]:
            mask |= 1 << rest
        free[rest].append(b)
    left = np.zeros(n, np.int64)
    for room, held in enumerate(free):
        left[held] = room
    return bins, offsets, left


def exact_fill(sizes: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """The bin of each size: every bin starts with the largest size left, and others are added whose sum comes closest to what remains."""
    held: dict[int, list[int]] = {}
    for at, size in enumerate(sizes.tolist()):
        held.setdefault(size, []).append(at)
    out, n, order = np.empty(len(sizes), np.int64), 0, sorted(held, reverse=True)
    while order:
        first = order[0]
        target, take = capacity - first, [first]
        # sums[k] has the bits of all sums of the first k sizes tried
        sums, tried, within = [1], [], (1 << (target + 1)) - 1
        for size in order:
            if size > target:
                continue
            for _ in range(min(len(held[size]) - (size == first), target // size)):
                after = (sums[-1] | (sums[-1] << size)) & within
                if after == sums[-1]:
                    break
                sums.append(after)
                tried.append(size)
            if sums[-1] >> target:
                break
        rest = sums[-1].bit_length() - 1
        for k in range(len(tried) - 1, -1, -1):
            if not (sums[k] >> rest) & 1:
                take.append(tried[k])
                rest -= tried[k]
        for size in take:
            out[held[size].pop()] = n
        n += 1
        order = [s for s in order if held[s]] if any(not held[s] for s in take) else order
    return out


#: Bins that are packed a second time.
AGAIN = 4000


def refit(sizes: np.ndarray, bins: np.ndarray, left: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset, room) with the emptiest bins, and as many full ones of many pieces, filled anew; as before where that saves none."""
    n = len(left)
    many = np.bincount(bins, minlength=n)
    chosen = np.lexsort((-many, -left))[: min(AGAIN, max(64, 2 * int((left > 0).sum())))]
    own = np.flatnonzero(np.isin(bins, chosen))
    again = exact_fill(sizes[own], capacity)
    if again.max(initial=-1) + 1 < len(chosen):
        names = np.concatenate((chosen, [n]))
        bins = bins.copy()
        bins[own] = names[again]
    used, bins = np.unique(bins, return_inverse=True)
    by = np.argsort(bins, kind="stable")
    ends = np.cumsum(sizes[by])
    starts = np.concatenate(([True], bins[by][1:] != bins[by][:-1]))[: len(by)]
    offsets = np.empty(len(sizes), np.int64)
    offsets[by] = ends - sizes[by] - np.repeat((ends - sizes[by])[starts], np.bincount(bins))
    return bins, offsets, capacity - np.bincount(bins, sizes, len(used)).astype(np.int64)


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The pieces of every row: longer documents are cut into capacity tokens, the first piece takes the remainder."""
    path = path or vocabulary()
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in gathered(batches, 1, 8 << 20):
            for f, e in slices(batch.column(1), 10 << 20):
                part = batch.slice(f, e - f)
                ids, first = with_ends(*enc.encode(part.column(1)))
                n = np.diff(first)
                many = -(-n // capacity)
                doc = np.repeat(np.arange(len(n)), many)
                nth = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
                head = (n - (many - 1) * capacity)[doc]
                start = np.where(nth == 0, 0, head + (nth - 1) * capacity)
                length = np.where(nth == 0, head, capacity)
                begin = first[:-1][doc] + start
                sums = [crc(ids[b : b + m]) for b, m in zip(begin.tolist(), length.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(doc)), pa.array(nth, pa.int32()), pa.array(start), pa.array(length), pa.array(sums, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )
                release()

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, PIECE)


def _round(rows: DataFrame, nth: int, last: bool, capacity: int) -> DataFrame:
    """Pack each partition; settled is false for what it gives up, certified is true where the bins meet the bound."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        table = pa.Table.from_batches(list(batches)) if (batches := [b for b in batches if b.num_rows]) else None
        if table is None:
            return
        sizes = table["length"].to_numpy().astype(np.int64)
        bins, offsets, left = best_fit(sizes, capacity)
        bound = lower_bound(sizes, capacity)
        settled = np.ones(len(sizes), bool)
        if len(left) > bound and last:
            bins, offsets, left = refit(sizes, bins, left, capacity)
        elif len(left) > bound:
            settled = (left == 0)[bins]
        # full bins that a partition keeps while it gives up others have no gap either
        certified = np.full(len(sizes), len(left) == bound) | ~settled | (left == 0)[bins]
        base = (nth << 56) | (TaskContext.get().partitionId() << 28)
        out = table.append_column("sequence_id", pa.array(base + bins)).append_column("offset", pa.array(offsets)).append_column("settled", pa.array(settled)).append_column("certified", pa.array(certified))
        yield from out.to_batches(50_000)

    return rows.mapInArrow(run, f"{PIECE}, sequence_id long, offset long, settled boolean, certified boolean")


def pack(rows: DataFrame, capacity: int = CAPACITY, per_task: int = PER_TASK, rounds: int = ROUNDS) -> DataFrame:
    """rows (as pieces() gives them, lengths 1 to capacity) with sequence_id, offset and certified.

    A sequence is certified if it is full or if the partition that it was settled in has as few bins as any packing of its pieces.
    """
    scratch = Scratch(rows.sparkSession, "packing")
    # every row has a number of its own to be dealt by, whatever its id
    rows = scratch.table(rows.withColumn("nth", F.monotonically_increasing_id()))
    cols = [c.strip().split(" ")[0] for c in PIECE.split(",")]
    whole = rows.where(f"length = {capacity}").select(
        *cols, (F.lit(1 << 62) + F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.lit(True).alias("certified")
    )
    done, open_ = [whole], rows.where(f"length < {capacity}").select(*cols, "nth")
    before = open_.count()
    for nth in range(rounds):
        if not before:
            break
        # what is left over is less each time, so that a task may hold twice as many; one partition has no other to exchange with
        tasks = -(-before // (per_task << nth))
        last = nth == rounds - 1 or tasks == 1
        state = scratch.table(_round(open_.repartition(tasks, "nth").drop("nth"), nth, last, capacity))
        done.append(state.where("settled").select(*cols, "sequence_id", "offset", "certified"))
        open_ = state.where("NOT settled").select(*cols, F.monotonically_increasing_id().alias("nth"))
        before = 0 if last else open_.count()
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset, certified.

    Null and empty texts are one piece of the end id; repeated rows are packed each; a null id stays null; an empty
    table gives an empty result; other columns are not read.
    """
    return pack(pieces(docs))
