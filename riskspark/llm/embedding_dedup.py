"""Embedding near-dedup by spherical-cap filters with structured random product codes.

A vector is rotated and cut into BLOCKS parts. Each part has its own random code of unit vectors, and every choice
of one code word for each part is a filter direction. List decoding finds all directions whose inner product with
the vector exceeds the cap's height: the words of a part that can reach the height with the best of the other parts are
combined part by part, and what can no longer reach it is dropped. The height is set for each vector, a margin below its best
inner product: at one height for all, a product code lists hundreds of filters for some vectors and none for half of the
others. TABLES rotations are listed side by side. The code grows with the table, by the cube root of the number of vectors, so that the vectors
which share a filter by chance stay about as few for each vector at any size.

Joining on filters moves numbers only. Each filter names a leader, one vector that exceeds it, and a vector goes to the leaders of its
filters: all that share a filter meet at its leader, and their embeddings are sent once for each leader, not once for each filter. There cosines
are computed in double precision; a pair counts at the smallest leader that both have, so it counts once. Filters that a bounded
sample shows to be frequent have their leader from that sample, and their vectors go to it without a join.
Equal vectors are one class with a weight.

Groups above CELL members are hot. Members within half the angle of a leader form its ball: any
two of a ball are linked, by the triangle inequality, so a ball's links are its size and are not compared. What is
left of a hot group is split into blocks, by ball first, and each pair of blocks that is not within one ball is a cell of its own. Blocks
grow with the root of the group, so m loose members are sent about 2 * sqrt(m / CELL) times each, in some 4 * m / CELL cells.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._shared import Scratch, components, forest

COSINE = 0.95
BLOCKS = 3
TABLES = 3
SEED = 20
#: Code words of a part of at least 5 components, if no number of vectors is given; shorter parts take the unit vectors of both signs.
WORDS = 64
#: A cap's height lies this much, over the root of the number of components, below the vector's best inner product.
MARGIN = 0.25
#: The same for codes of unit vectors, which are coarse.
MARGIN_COARSE = 0.5
#: Vectors that the frequent filters are found from (expected), and the number of them that makes a filter frequent.
SAMPLE, FREQUENT = 4096, 12
#: Members that make a group hot, and the most of a block of the largest groups.
CELL, CELL_MOST = 4096, 16384
SMALL = 48


def words_for(vectors: int) -> int:
    """Code words of a part: with them, a vector shares a filter by chance with about one in two others, whatever the number of vectors."""
    return max(24, min(8192, round((1400 * vectors) ** (1 / 3))))


@lru_cache(maxsize=16)
def code(dim: int, words: int, seed: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(rotation, words, slack) for vectors of dim components, padded to a multiple of BLOCKS.

    Parts of few components have fewer words: theirs would lie so densely that a vector exceeded thousands of filters.
    """
    size = -(-dim // BLOCKS) * BLOCKS
    draw = np.random.default_rng([seed, dim])
    rotation = np.linalg.qr(draw.standard_normal((size, size)))[0]
    part = size // BLOCKS
    if part < 5:
        book, margin = np.tile(np.concatenate((np.eye(part), -np.eye(part))), (BLOCKS, 1, 1)), MARGIN_COARSE
    else:
        book, margin = draw.standard_normal((BLOCKS, min(words, round(24 * 1.45 ** (min(part, 40) - 5))), part)), MARGIN
        book /= np.linalg.norm(book, axis=2, keepdims=True)
    return rotation.astype(np.float32), book.astype(np.float32), margin * math.sqrt(BLOCKS / size)


def _decode(unit: np.ndarray, words: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    n, dim = unit.shape
    rotation, book, slack = code(dim, words, seed)
    x = np.zeros((n, rotation.shape[0]), np.float32)
    x[:, :dim] = unit
    parts = (x @ rotation).reshape(n, BLOCKS, -1)
    # what a choice of words lacks to the best choice is the sum of what each word lacks to the best of its part
    row, ids, lack = np.arange(n), np.zeros(n, np.int64), np.zeros(n, np.float32)
    for b in range(BLOCKS):
        dots = parts[:, b] @ book[b].T
        dots = dots.max(1, keepdims=True) - dots
        at, word = np.nonzero(dots <= slack)
        short = dots[at, word]
        first = np.searchsorted(at, np.arange(n + 1))
        many = np.diff(first)[row]
        pick = np.repeat(first[row] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
        row, ids, lack = np.repeat(row, many), np.repeat(ids, many) * book.shape[1] + word[pick], np.repeat(lack, many) + short[pick]
        over = lack <= slack
        row, ids, lack = row[over], ids[over], lack[over]
    return row, ids


def decode(unit: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(row, filter) of every filter direction that a row of unit vectors exceeds, in all tables; sorted by both."""
    step = max(16, 3_000_000 // words)
    got = []
    for t in range(TABLES):
        for at in range(0, len(unit), step):
            row, ids = _decode(unit[at : at + step], words, SEED + t)
            got.append((row + at, ids + (t << 40)))
    none = np.zeros(0, np.int64)
    rows = np.concatenate([none, *(r for r, _ in got)])
    ids = np.concatenate([none, *(f for _, f in got)])
    by = np.lexsort((ids, rows))
    return rows[by], ids[by]


def units(column: pa.Array) -> np.ndarray:
    """Rows of an Arrow list column of one length, as doubles of norm 1; scaled first, so that no square overflows."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(len(column), -1)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _by_size(batch: pa.RecordBatch, name: str):
    """The rows of a batch, those of each vector length apart."""
    lengths = np.diff(batch.column(name).offsets.to_numpy())
    for n in np.unique(lengths):
        yield int(n), batch.take(pa.array(np.flatnonzero(lengths == n)))


def entries(classes: DataFrame, words: int, leads: np.ndarray | None = None) -> DataFrame:
    """(flt, cid) for each filter of each class; the vector's length is part of a filter's number.

    leads holds frequent filters and their leaders, by filter; in their place stands -1 - leader.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                for n, batch in _by_size(whole.slice(at, 2048), "embedding"):
                    rows, ids = decode(units(batch.column("embedding")), words)
                    ids += n << 44
                    if leads is not None and len(leads):
                        spot = np.minimum(np.searchsorted(leads[:, 0], ids), len(leads) - 1)
                        known = leads[spot, 0] == ids
                        # several filters of one vector may have one leader
                        direct = np.unique(np.stack((rows[known], leads[spot[known], 1])), axis=1)
                        rows, ids = np.concatenate((rows[~known], direct[0])), np.concatenate((ids[~known], -1 - direct[1]))
                    yield pa.RecordBatch.from_arrays([pa.array(ids), batch.column("cid").take(pa.array(rows))], names=["flt", "cid"])

    return classes.select("cid", "embedding").mapInArrow(run, "flt long, cid long")


def _leads(classes: DataFrame, many: int, words: int) -> np.ndarray:
    """Frequent filters and a leader of each, from about SAMPLE classes drawn by a hash; at most SAMPLE / FREQUENT times the filters of a vector."""
    share = max(1, round(min(1.0, SAMPLE / max(1, many)) * 1048576))
    drawn = entries(classes.where(f"(xxhash64(cid) & 1048575) < {share}"), words)
    got = drawn.groupBy("flt").agg(F.count("*").alias("m"), F.min("cid").alias("leader")).where(f"m >= {FREQUENT}").select("flt", "leader").toArrow()
    leads = np.stack([got[c].to_numpy() for c in ("flt", "leader")], axis=1).astype(np.int64) if got.num_rows else np.zeros((0, 2), np.int64)
    return leads[np.argsort(leads[:, 0])]


def leaders(classes: DataFrame, many: int) -> DataFrame:
    """(cid, flts): the sorted leaders of each class that shares a filter with another, itself among them if it leads."""
    words = words_for(many)
    flat = entries(classes, words, _leads(classes, many, words))
    # a filter without a known leader takes its first class; the window holds numbers only, and no filter of it is frequent
    own = Window.partitionBy("flt", "apart").orderBy("cid")
    named = flat.withColumn("apart", F.expr("IF(flt < 0, cid, 0L)")).withColumn("first", F.first("cid").over(own.rowsBetween(Window.unboundedPreceding, Window.currentRow))).withColumn("next", F.lead("cid").over(own))
    kept = named.where("flt < 0 OR cid <> first OR next IS NOT NULL").select("cid", F.expr("IF(flt < 0, -1 - flt, first)").alias("leader"))
    return kept.groupBy("cid").agg(F.sort_array(F.collect_set("leader")).alias("flts"))


class _Bucket:
    """Members of the cells of one run; links are counted once, edges make a forest. flt is a leader, flts are all leaders of a member."""

    def __init__(self, table: pa.Table, cosine: float):
        self.cid = table["cid"].to_numpy()
        self.weight = table["weight"].to_numpy()
        self.flt, self.ci, self.cj, self.blk = (table[c].to_numpy() for c in ("flt", "ci", "cj", "blk"))
        lists = table["flts"].combine_chunks()
        self.all, ends = lists.flatten().to_numpy(), lists.offsets.to_numpy().astype(np.int64)
        ends -= ends[0]
        self.start, self.size = ends[:-1], np.diff(ends)
        # (row, filter) as one sorted number: lists are sorted, and so are the rows
        self.names, self.rank = np.unique(self.all, return_inverse=True)
        self.key = np.repeat(np.arange(len(self.size)), self.size) * len(self.names) + self.rank
        self.ball = table["ball"].to_numpy()
        self.unit = units(table["embedding"].combine_chunks())
        self.cosine = cosine
        self.n = np.zeros(table.num_rows, np.int64)
        self.a: list[np.ndarray] = []
        self.b: list[np.ndarray] = []

    def take(self, i: np.ndarray, j: np.ndarray, first: np.ndarray) -> None:
        np.add.at(self.n, i[first], self.weight[j[first]])
        np.add.at(self.n, j[first], self.weight[i[first]])
        label = forest(*(np.searchsorted(own := np.unique(np.concatenate((i, j))), x) for x in (i, j)), len(own)) if len(i) else np.zeros(0, int)
        if len(i):
            child = label != np.arange(len(own))
            self.a.append(own[child])
            self.b.append(own[label[child]])

    def first_shared(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether the filter of rows i and j, which are of one cell, is the smallest that both have: the lists of i are looked up
        among those of j, a few filters at a time, as most pairs share one of the first."""
        base = len(self.names)
        at, stop = self.start[i].copy(), np.searchsorted(self.key, i * base + np.searchsorted(self.names, self.flt[i]))
        out, live, step = np.ones(len(i), bool), np.arange(len(i)), 4
        while True:
            live = live[at[live] < stop[live]]
            if not len(live):
                return out
            spots = at[live][:, None] + np.arange(step)
            inside = spots < stop[live][:, None]
            asked = (j[live] * base)[:, None] + self.rank[np.minimum(spots, len(self.rank) - 1)]
            found = self.key[np.minimum(np.searchsorted(self.key, asked), len(self.key) - 1)] == asked
            hit = (found & inside).any(1)
            out[live[hit]] = False
            at[live] += step
            live, step = live[~hit], min(step * 2, 64)

    def small(self, first: np.ndarray, end: np.ndarray) -> None:
        """All cells of at most SMALL members at once, by their distance in the sorted run."""
        size = np.zeros(len(self.cid), np.int64)
        for f, e in zip(first, end, strict=True):
            size[f:e] = e - np.arange(f, e)
        for gap in range(1, int((end - first).max(initial=0))):
            i = np.flatnonzero(size > gap)
            for s in range(0, len(i), 50_000):
                x = i[s : s + 50_000]
                y = x + gap
                near = np.einsum("nk,nk->n", self.unit[x], self.unit[y]) >= self.cosine
                near &= (self.ci[x] == self.cj[x]) | (self.blk[x] != self.blk[y])
                near &= (self.ball[x] < 0) | (self.ball[x] != self.ball[y])
                x, y = x[near], y[near]
                if len(x):
                    self.take(x, y, self.first_shared(x, y))

    def large(self, f: int, e: int) -> None:
        """One cell, in square pieces; pairs that share a smaller filter are found by a product of incidence matrices."""
        flt, rows = self.flt[f], np.arange(f, e)
        early, seen, step = None, np.zeros(0, np.int64), 512
        for s in range(0, len(rows), step):
            for t in range(s, len(rows), step):
                x, y = rows[s : s + step], rows[t : t + step]
                near = self.unit[x] @ self.unit[y].T >= self.cosine
                near &= (self.ci[f] == self.cj[f]) | (self.blk[x][:, None] != self.blk[y][None, :])
                near &= (self.ball[x] < 0)[:, None] | (self.ball[x][:, None] != self.ball[y][None, :])
                if s == t:
                    near = np.triu(near, 1)
                if not near.any():
                    continue
                if early is None:
                    early = [v[v < flt] for v in (self.all[a : a + n] for a, n in zip(self.start[f:e], self.size[f:e], strict=True))]
                    seen, times = np.unique(np.concatenate(early), return_counts=True)
                    seen = seen[times > 1]
                shared = np.zeros(near.shape, np.float32)
                for c in range(0, len(seen), 2048):
                    cols = seen[c : c + 2048]
                    shared += self._has(early, x - f, cols) @ self._has(early, y - f, cols).T
                i, j = np.nonzero(near)
                self.take(x[i], y[j], shared[i, j] == 0)

    @staticmethod
    def _has(early, rows, cols) -> np.ndarray:
        out = np.zeros((len(rows), len(cols)), np.float32)
        for k, r in enumerate(rows):
            at = np.searchsorted(cols, early[r])
            ok = at < len(cols)
            ok[ok] = cols[at[ok]] == early[r][ok]
            out[k, at[ok]] = 1
        return out

    def result(self) -> pa.RecordBatch:
        at = np.flatnonzero(self.n)
        a = np.concatenate([at, *self.a]).astype(np.int64)
        b = np.concatenate([at, *self.b]).astype(np.int64)
        n = np.zeros(len(a), np.int64)
        n[: len(at)] = self.n[at]
        return pa.RecordBatch.from_arrays([pa.array(self.cid[a]), pa.array(self.cid[b]), pa.array(n)], names=["cid", "other", "n"])


def verified(members: DataFrame, cosine: float) -> DataFrame:
    """(cid, other, n): link counts (cid = other) and forest edges, from members dealt out and sorted by cell."""

    def flush(held: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        table = pa.concat_tables(held).combine_chunks()
        run = _Bucket(table, cosine)
        new = np.flatnonzero((run.flt[1:] != run.flt[:-1]) | (run.ci[1:] != run.ci[:-1]) | (run.cj[1:] != run.cj[:-1])) + 1
        first, end = np.concatenate(([0], new)), np.append(new, len(run.flt))
        size = end - first
        # vectors of one bucket have one length, but a run may hold buckets of several
        tiny = (size <= SMALL) & (size > 1)
        run.small(first[tiny], end[tiny])
        for f, e in zip(first[size > SMALL].tolist(), end[size > SMALL].tolist(), strict=True):
            run.large(f, e)
        yield run.result()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        rows = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [batch.column(c).to_numpy() for c in ("flt", "ci", "cj")]
            if held:
                last = [held[-1][c][-1].as_py() for c in ("flt", "ci", "cj")]
                change = np.flatnonzero(np.any([k != v for k, v in zip(keys, last, strict=True)], axis=0))
            else:
                change = np.array([0])
            length = held[-1]["dim"][-1].as_py() if held else -1
            # a run ends with a cell, when it is long enough or vectors of another length follow
            if held and len(change) and (rows >= 20_000 or batch.column("dim")[batch.num_rows - 1].as_py() != length):
                head = int(change[0])
                if head:
                    held.append(pa.Table.from_batches([batch.slice(0, head)]))
                yield from flush(held)
                held, rows, batch = [], 0, batch.slice(head)
            start = 0
            sizes = batch.column("dim").to_numpy()
            for cut in [*(np.flatnonzero(sizes[1:] != sizes[:-1]) + 1).tolist(), batch.num_rows]:
                held.append(pa.Table.from_batches([batch.slice(start, cut - start)]))
                rows += cut - start
                start = cut
                if cut < batch.num_rows:
                    yield from flush(held)
                    held, rows = [], 0
        if held:
            yield from flush(held)

    cells = members.repartition("flt", "ci", "cj").sortWithinPartitions("dim", "flt", "ci", "cj", "cid")
    return cells.mapInArrow(work, "cid long, other long, n long")


def _cosine(a: str, b: str):
    """The cosine of two array columns, in double precision; both are scaled by their largest component first, so that no square overflows or vanishes."""
    scaled = lambda c: f"get(transform(array(array_max(transform({c}, v -> abs(CAST(v AS DOUBLE))))), m -> transform({c}, v -> CAST(v AS DOUBLE) / m)), 0)"
    sums = "aggregate(zip_with(x, y, (u, v) -> struct(u * v AS a, u * u AS b, v * v AS c)), struct(0D AS a, 0D AS b, 0D AS c), (s, z) -> struct(s.a + z.a AS a, s.b + z.b AS b, s.c + z.c AS c), s -> s.a / sqrt(s.b) / sqrt(s.c))"
    return F.expr(f"get(transform(transform(array(struct({scaled(a)} AS x, {scaled(b)} AS y)), p -> {sums.replace('(x, y,', '(p.x, p.y,')}), c -> c), 0)")


#: Members of a hot group that are held against its leader in one task.
SALT = 200_000


def _hot_cells(flat: DataFrame, hot: DataFrame, classes: DataFrame, cosine: float, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(cells, balls) of hot leaders: (cid, flt, blk, ci, cj), and (cid, ball) of the members of balls."""
    members = flat.join(hot.withColumn("salts", F.expr(f"CAST((m - 1) DIV {SALT} + 1 AS INT)")), "flt")
    vectors = classes.select("cid", "embedding")
    lead = hot.join(vectors.withColumnRenamed("cid", "flt").withColumnRenamed("embedding", "lead"), "flt")
    lead = lead.select("flt", "lead", F.explode(F.expr(f"sequence(0, CAST((m - 1) DIV {SALT} AS INT))")).alias("salt"))
    half = math.cos(math.acos(cosine) / 2) + 1e-9
    asked = members.select("cid", "flt", F.expr("CAST(pmod(xxhash64(cid), salts) AS INT)").alias("salt")).join(vectors, "cid")
    close = asked.join(lead, ["flt", "salt"]).where(_cosine("embedding", "lead") >= half)
    balls = scratch.table(close.groupBy("cid").agg(F.min("flt").alias("ball")))
    held = scratch.table(members.drop("salts").join(balls, "cid", "left").select("cid", "flt", F.coalesce("ball", F.lit(-1)).alias("ball"), "m"))
    block = f"least({max(CELL, CELL_MOST)}, {CELL} * greatest(1, sqrt(max(m) / {CELL}) / 2))"
    parts = held.groupBy("flt", "ball").agg(F.expr(f"CAST(ceil(count(*) / {block}) AS INT) AS parts"))
    blocks = parts.select("flt", "ball", "parts", F.explode(F.expr("sequence(0, parts - 1)")).alias("part"))
    blocks = scratch.table(blocks.withColumn("blk", F.row_number().over(Window.partitionBy("flt").orderBy("ball", "part"))))
    parts, blocks = blocks.where("part = 0").select("flt", "ball", "parts"), blocks.drop("parts")
    a = blocks.select("flt", F.col("ball").alias("ball_a"), F.col("blk").alias("a"))
    b = blocks.select("flt", F.col("ball").alias("ball_b"), F.col("blk").alias("b"))
    pairs = a.join(b, "flt").where("a <= b AND (ball_a <> ball_b OR ball_a < 0)")
    sides = pairs.select("flt", F.col("a").alias("blk"), F.col("a").alias("ci"), F.col("b").alias("cj"))
    sides = sides.unionByName(pairs.where("a < b").select("flt", F.col("b").alias("blk"), F.col("a").alias("ci"), F.col("b").alias("cj")))
    placed = held.join(parts, ["flt", "ball"]).withColumn("part", F.expr("CAST(pmod(xxhash64(cid), parts) AS INT)")).drop("parts")
    return placed.join(blocks, ["flt", "ball", "part"]).join(sides, ["flt", "blk"]).select("cid", "flt", "blk", "ci", "cj"), balls


def _same_vector() -> list:
    """Two longs, 128 bits of hashes of the embedding, which name its class."""
    return [F.xxhash64(F.lit(1), "embedding"), F.xxhash64(F.lit(2), "embedding")]


def near_vectors(table: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row.

    Null and empty vectors, those of norm zero and those with null or non-finite components link with nothing, nor do
    vectors of different length. Components of any finite size are taken, as floats or doubles. Equal vectors and repeated rows link with each
    other. Null ids count only if a component has no other. Other columns are not read.
    """
    scratch = Scratch(table.sparkSession, "embeddings")
    e = F.col("embedding")
    good = (F.size(e) > 0) & F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))) & F.exists(e, lambda v: v != 0)
    rows = table.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("embedding"))
    k1, k2 = _same_vector()
    fit = rows.where(e.isNotNull() & good)
    classes = fit.groupBy("embedding").agg(F.min("vec_id").alias("least"), F.count("*").alias("weight"))
    classes = scratch.table(classes.withColumn("cid", F.monotonically_increasing_id()).withColumn("k1", k1).withColumn("k2", k2))
    listed = scratch.table(leaders(classes, classes.count()))
    flat = listed.select("cid", F.explode("flts").alias("flt"))
    hot = scratch.table(flat.groupBy("flt").agg(F.count("*").alias("m")).where(f"m > {CELL}"))
    zero = F.lit(0)
    cells = flat.select("cid", "flt", zero.alias("blk"), zero.alias("ci"), zero.alias("cj"))
    members = listed.join(classes.select("cid", "weight", "embedding"), "cid").withColumn("ball", F.lit(-1).cast("long"))
    balls = None
    if not hot.isEmpty():
        split, balls = _hot_cells(flat, hot, classes, cosine, scratch)
        cells = cells.join(hot, "flt", "left_anti").unionByName(split)
        members = members.drop("ball").join(balls, "cid", "left").withColumn("ball", F.coalesce("ball", F.lit(-1)))
        members = cells.join(members, "cid")
    else:
        # each member goes to its leaders, and its embedding is joined once
        members = members.withColumn("flt", F.explode("flts")).withColumn("blk", zero).withColumn("ci", zero).withColumn("cj", zero)
    members = members.select("cid", "flt", "ci", "cj", "blk", "ball", "weight", F.size("embedding").alias("dim"), "flts", "embedding")
    found = scratch.table(verified(members, cosine))
    counts = found.where("cid = other").select("cid", "n")
    edges = found.where("cid <> other").select(F.col("cid").alias("a"), F.col("other").alias("b"))
    nodes = classes.select("cid", "k1", "k2", "weight", "least").withColumn("node", F.col("cid"))
    if balls is not None:
        # a ball is one node: its members take its place in the links, so that no node has as many links as a ball has members
        for end in ("a", "b"):
            edges = edges.join(balls.select(F.col("cid").alias(end), "ball"), end, "left").withColumn(end, F.coalesce("ball", end)).drop("ball")
        nodes = nodes.drop("node").join(balls, "cid", "left").withColumn("node", F.coalesce("ball", "cid"))
        sizes = nodes.where("ball IS NOT NULL").groupBy("ball").agg(F.sum("weight").alias("size"))
        counts = counts.unionByName(nodes.join(sizes, "ball").select("cid", (F.col("size") - F.col("weight")).alias("n")))
    counts = counts.groupBy("cid").agg(F.sum("n").alias("n"))
    comps = components(edges, scratch).withColumnRenamed("id", "node")
    nodes = nodes.join(comps, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = nodes.groupBy("component").agg(F.min("least").alias("component_id"))
    own = nodes.join(least, "component").join(counts, "cid", "left")
    own = own.select("k1", "k2", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id")
    linked = fit.select("vec_id", k1.alias("k1"), k2.alias("k2")).join(own, ["k1", "k2"]).select("vec_id", "n_links", "component_id")
    lone = rows.where(e.isNull() | ~good).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(lone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def digest(table: DataFrame) -> DataFrame:
    return near_vectors(table)


def oracle(cosine: float = COSINE) -> str:
    """The digest for DuckDB over the view embeddings, from all pairs; for small tables."""
    return f"""
WITH RECURSIVE v AS (SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (SELECT r, e, len(e) AS n FROM v WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
pair AS (SELECT a.r AS a, b.r AS b FROM ok a JOIN ok b ON a.r <> b.r AND a.n = b.n WHERE list_cosine_similarity(a.e, b.e) >= {cosine}),
reach AS (SELECT r AS a, r AS b FROM v UNION SELECT reach.a, pair.b FROM reach JOIN pair ON reach.b = pair.a),
comp AS (SELECT reach.a AS r, min(vec_id) AS component_id FROM reach JOIN v ON v.r = reach.b GROUP BY 1),
n AS (SELECT a AS r, count(*) AS n FROM pair GROUP BY 1)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept FROM v JOIN comp USING (r) LEFT JOIN n USING (r)"""
