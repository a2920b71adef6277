"""Exact removal of repeated strings of LENGTH bytes by a sparse, distributed suffix array.

Sampling. Of every LENGTH-byte string one suffix start is an anchor: among its first WINDOW places that of the smallest
hashed 8-byte gram, the first of equals. Equal strings have their anchor at the same place, so it suffices to
compare suffixes that start at anchors, rightwards from the anchor and leftwards before it. A run of starts [s, e] has one anchor a.

Candidates. Anchors meet by a hash of the CORE bytes that every string of theirs holds after the anchor. Anchors whose whole
reach (s to e + LENGTH) is alike by a further 64 bits are repeated at every start of the run; an anchor with a core of its own is not
repeated at all. For the rest, suffixes and left contexts are fetched from the texts.

Suffix sorting. Splitters sampled from the anchors of some documents range-partition the suffixes by their leading tokens (8 bytes);
equal leading tokens are never parted, so suffixes on two sides of a boundary differ in their first token and share no string,
which settles the comparison across boundaries. A bucket sorts locally by multikey quicksort, token by token on the groups still
tied, finds the common prefixes of neighbours, and does likewise for the reversed left contexts. The string of distance d
before an anchor is repeated if another suffix lies in the same d-block on the left and the same (LENGTH - d)-block on the right.

Hot passages. Cores that are frequent in the sampled documents are known to be repeated; their anchors are dealt by reach, and their
suffixes by ranges of d: the strings of one range [low, high) hold low bytes before the anchor and LENGTH - high + 1 after it, and a suffix is
dealt by these. Where they are frequent in the sample too, the range is parted into finer ones of FINE; and where those are, as at the
end of a passage that a third of all documents hold, strings are dealt one by one, by a 128-bit hash of the whole string. Strings that the
sample holds twice are known to be repeated and are not dealt at all. What decides is always something that equal strings share, so they meet.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import Scratch, packed, release, row_key, slices, unpacked

LENGTH = 200
#: A power of two; every string's anchor is among its first WINDOW places.
WINDOW = 128
CORE = LENGTH - WINDOW + 1
#: Documents that hot passages and the splitters of a small table are sampled from (expected), and buckets for each partition.
SAMPLE = 2000
BUCKETS = 4
#: Suffixes of a bucket, and sampled leading tokens for each splitter: partitions, buckets and the sample of the splitters grow with the suffixes.
PER_BUCKET, PER_SPLITTER = 50_000, 32
#: A core is hot if it occurs in HOT_SHARE of the sampled documents, and HOT_LEAST of them at least.
HOT_SHARE, HOT_LEAST = 0.004, 8
SIDE = WINDOW // 2
#: Buckets that suffixes of hot cores are dealt to, for each bucket of the others.
HOT_BUCKETS = 1
#: Distances of a fine range, and the most frequent keys and strings of the sample that workers are told of; they set the speed only.
FINE, TOLD = 16, 200_000

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def anchors(raw: np.ndarray, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, a, s, e): each anchor of texts raw[first:end], and its run of starts."""
    none = np.zeros(0, np.int64)
    count = np.maximum(end - first - LENGTH + 1, 0)
    if not count.any():
        return none, none, none, none
    gram = np.ndarray((len(raw) - 7,), "<u8", raw, strides=(1,)) * _A
    gram ^= gram >> np.uint64(31)
    gram *= _B
    # the hash keeps its upper half and the place takes the lower one, so that a choice depends on the bytes alone and not on the batch
    low = np.uint64(0xFFFFFFFF)
    best = (gram & ~low) | np.arange(len(gram), dtype=np.uint64)
    k = 1
    while k < WINDOW:
        best = np.minimum(best[:-k], best[k:])
        k *= 2
    text = np.repeat(np.arange(len(first)), count)
    p = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
    at = (best[p] & low).astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (text[1:] != text[:-1]))))
    last = np.append(new[1:], len(p)) - 1
    return text[new], at[new], p[new], p[last]


def _raw(column: pa.Array) -> tuple[memoryview, np.ndarray, np.ndarray, np.ndarray]:
    x = pc.fill_null(column, "").cast(pa.large_binary())
    at = np.frombuffer(x.buffers()[1], np.int64)[x.offset : x.offset + len(x) + 1]
    data = memoryview(x.buffers()[2] or b"")[int(at[0]) : int(at[-1])] if len(x) else memoryview(b"")
    at = at - at[0]
    return data, np.frombuffer(data, np.uint8), at[:-1], at[1:]


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """id and tag, the key of a row, and its text."""
    own, tag = row_key(doc_id, text)
    return docs.select(own.alias("id"), tag.alias("tag"), F.col(text).alias("text"))


def _anchor_rows(keyed: DataFrame) -> DataFrame:
    """(core, reach, id, tag, place, n): place packs a, a - s and a - e; n is 1, or 2 for one row that stands for several.

    Anchors of one core and reach that a few megabytes of text hold more than once are repeated, whatever else there is: their
    joined spans go on as rows of n 0, the span in reach, and one row of n 2 goes on for all of them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest as h

        for batch in batches:
            for f, z in slices(batch.column(2), 2 << 20):
                own = batch.slice(f, z - f)
                data, raw, first, end = _raw(own.column(2))
                doc, a, s, e = anchors(raw, first, end)
                if not len(a):
                    continue
                to, back, fore = a.tolist(), a - s, a - e
                core = np.array([h(data[x : x + CORE]) for x in to], np.uint64).view(np.int64)
                reach = np.array(
                    [h(data[x:y], k) for x, y, k in zip(s.tolist(), (e + LENGTH).tolist(), ((back << 8) + fore).tolist(), strict=True)], np.uint64
                ).view(np.int64)
                place = ((a - first[doc]) << 14) | (back << 7) | fore
                by = np.lexsort((reach, core))
                same = (core[by][1:] == core[by][:-1]) & (reach[by][1:] == reach[by][:-1])
                lead, follow = np.concatenate(([True], ~same)), np.concatenate((same, [False]))
                twice = np.zeros(len(a), bool)
                twice[by[follow | ~lead]] = True
                one = np.sort(by[lead])
                # anchors come in order of text and start, so that joined spans are runs
                spot = np.flatnonzero(twice)
                new = np.concatenate(([True], (doc[spot][1:] != doc[spot][:-1]) | (s[spot][1:] > e[spot][:-1] + LENGTH)))[: len(spot)]
                head = np.flatnonzero(new)
                tail = np.append(head[1:], len(spot))[: len(head)] - 1
                at = doc[spot][head]
                span = ((s[spot][head] - first[at]) << 32) + e[spot][tail] + LENGTH - first[at]
                texts = pa.array(np.concatenate((doc[one], at)))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate((core[one], span * np.int64(-7046029254386353131) + np.arange(len(at))))), pa.array(np.concatenate((reach[one], span))),
                        own.column(0).take(texts), own.column(1).take(texts), pa.array(np.concatenate((place[one], np.zeros(len(at), np.int64)))),
                        pa.array(np.concatenate((np.where(twice[one], 2, 1), np.zeros(len(at), np.int64))), pa.int32()),
                    ],
                    names=["core", "reach", "id", "tag", "place", "n"],
                )
            release()

    return keyed.mapInArrow(run, "core long, reach long, id long, tag long, place long, n int")


FULL, PART, PEER, SPAN = 1, 2, 4, 8


def _candidates(rows: DataFrame, hot: np.ndarray) -> DataFrame:
    """(id, tag, place, kind, span): FULL runs are repeated throughout; PART runs must be compared, with one PEER of each other reach;
    SPAN rows are spans that are known already.

    Rows of one core meet in one task, in order of their reach; those of hot cores, which are known to be repeated and to have
    other reaches, only meet those of the same reach.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the last row waits for its successor; before is the core of the row ahead of its run of equal (core, reach)
        wait: pa.RecordBatch | None = None
        prior, ahead = None, None  # (core, reach) of the row before wait; whether wait's run has another reach of its core before it
        last = False
        source = iter(batches)
        while not last:
            batch = next(source, None)
            last = batch is None
            if not last:
                known = pc.equal(batch.column(5), 0)
                spans = batch.filter(known)
                if spans.num_rows:
                    kinds = pa.array(np.full(spans.num_rows, SPAN), pa.int32())
                    yield pa.RecordBatch.from_arrays([spans.column(2), spans.column(3), spans.column(4), kinds, spans.column(1)], names=["id", "tag", "place", "kind", "span"])
                    batch = batch.filter(pc.invert(known))
                if not batch.num_rows:
                    continue
            parts = [x for x in (wait, batch) if x is not None]
            if not parts:
                return
            t = pa.Table.from_batches(parts).combine_chunks()
            core, reach = t["core"].to_numpy(), t["reach"].to_numpy()
            n = len(core)
            same_core = np.concatenate(([prior is not None and prior[0] == core[0]], core[1:] == core[:-1]))
            same = same_core & np.concatenate(([prior is not None and prior[1] == reach[0]], reach[1:] == reach[:-1]))
            start = np.maximum.accumulate(np.where(same, -1, np.arange(n)))
            # a run that began before this batch keeps what was known of it
            led = np.where(start >= 0, same_core[np.maximum(start, 0)], bool(ahead))
            use = n if last else n - 1
            next_core, next_same = np.append(same_core[1:], False), np.append(same[1:], False)
            full = same | next_same | (t["n"].to_numpy() > 1)
            known = np.isin(core, hot)
            repeated = same_core | next_core | known
            others = led | (next_core & ~next_same) | known
            kind = np.where(full, FULL, 0) | np.where(~full & repeated, PART, 0) | np.where(full & ~next_same & others, PEER, 0)
            keep = np.flatnonzero(kind[:use])
            if len(keep):
                at = pa.array(keep)
                yield pa.RecordBatch.from_arrays(
                    [*(t[c].combine_chunks().take(at) for c in ("id", "tag", "place")), pa.array(kind[keep], pa.int32()), pa.array(np.zeros(len(keep), np.int64))],
                    names=["id", "tag", "place", "kind", "span"],
                )
            if not last:
                prior = (core[n - 2], reach[n - 2]) if n > 1 else prior
                ahead = bool(led[n - 1])
                wait = t.slice(n - 1).combine_chunks().to_batches()[0]

    deal = F.when(F.col("core").isin(hot.tolist()), F.col("reach")).otherwise(F.col("core")) if len(hot) else F.col("core")
    dealt = rows.withColumn("deal", deal).repartition("deal").sortWithinPartitions("core", "reach").drop("deal")
    return dealt.mapInArrow(run, "id long, tag long, place long, kind int, span long")


def _tokens(rows: np.ndarray) -> np.ndarray:
    """Bytes as big-endian tokens, whose order is that of the bytes."""
    pad = -rows.shape[1] % 8
    return np.ascontiguousarray(np.pad(rows, ((0, 0), (0, pad)))).view(">u8").astype(np.uint64)


def multikey_sort(rows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, common): the order of padded byte rows, and the common prefix of each with its predecessor.

    Multikey quicksort by levels: rows still tied after a token are sorted by the next one within their group only.
    """
    n = len(rows)
    tokens = _tokens(rows)
    order, group = np.arange(n), np.zeros(n, np.int64)
    open_ = np.arange(n)  # positions of the order that are tied
    for k in range(tokens.shape[1]):
        if not len(open_):
            break
        own, key = group[open_], tokens[order[open_], k]
        by = np.lexsort((key, own))
        order[open_] = order[open_][by]
        key = key[by]
        new = np.concatenate(([True], (own[1:] != own[:-1]) | (key[1:] != key[:-1])))
        group[open_] = open_[np.maximum.accumulate(np.where(new, np.arange(len(open_)), 0))]
        size = np.bincount(np.cumsum(new) - 1)
        open_ = open_[np.repeat(size > 1, size)]
    common = np.zeros(n, np.int64)
    for s in range(1, n, 1 << 15):
        x, y = order[s - 1 : min(n, s + (1 << 15)) - 1], order[s : s + (1 << 15)]
        differ = rows[x] != rows[y]
        most = np.minimum(lengths[x], lengths[y])
        common[s : s + len(y)] = np.where(differ.any(1), np.minimum(differ.argmax(1), most), most)
    return order, common


def _matrix(column: pa.Array, width: int, backwards: bool = False) -> tuple[np.ndarray, np.ndarray]:
    x = column.cast(pa.large_binary())
    at = np.frombuffer(x.buffers()[1], np.int64)[x.offset : x.offset + len(x) + 1]
    raw = np.frombuffer(x.buffers()[2] or b"", np.uint8)
    n = np.diff(at)
    out = np.zeros((len(x), width), np.uint8)
    for f in range(0, len(x), 4096):
        m = n[f : f + 4096]
        row = np.repeat(np.arange(f, f + len(m)), m)
        col = np.arange(int(m.sum())) - np.repeat(np.cumsum(m) - m, m)
        out[row, (np.repeat(m, m) - 1 - col) if backwards else col] = raw[np.repeat(at[f : f + len(m)], m) + col]
    return out, n


def repeated_starts(right: pa.Array, left: pa.Array, back: np.ndarray, fore: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, d): the strings that start d before a row's anchor, fore <= d <= back, and that another row holds too."""
    n = len(back)
    order, common = multikey_sort(*_matrix(right, LENGTH))
    rorder, rcommon = multikey_sort(*_matrix(left, WINDOW - 1, True))
    none = np.zeros(0, np.int64)

    def nearest(order, common):
        most = np.empty(n, np.int64)
        most[order] = np.maximum(common, np.append(common[1:], 0))
        return most

    most, rmost = nearest(order, common), nearest(rorder, rcommon)
    rows, ds = [none], [none]
    for d in range(int(fore.min(initial=WINDOW)), int(back.max(initial=-1)) + 1):
        own = np.flatnonzero((fore <= d) & (d <= back) & (most >= LENGTH - d) & (rmost >= d))
        if len(own) < 2:
            continue
        block, rblock = np.empty(n, np.int64), np.empty(n, np.int64)
        block[order] = np.cumsum(common < LENGTH - d)
        rblock[rorder] = np.cumsum(rcommon < d)
        key = block[own] * (n + 1) + rblock[own]
        by = np.argsort(key, kind="stable")
        same = key[by][1:] == key[by][:-1]
        hit = own[by][np.concatenate((same, [False])) | np.concatenate(([False], same))]
        rows.append(hit)
        ds.append(np.full(len(hit), d))
    return np.concatenate(rows), np.concatenate(ds)


def _hot_least(many: int) -> int:
    return max(HOT_LEAST, round(HOT_SHARE * min(SAMPLE, many)))


def _marks(drawn: DataFrame) -> DataFrame:
    """(lead, core) of the anchors of drawn documents: their leading tokens and the hashes of their cores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest as h

        for batch in batches:
            for f, z in slices(batch.column(2), 2 << 20):
                data, raw, first, end = _raw(batch.column(2).slice(f, z - f))
                _, a, _, _ = anchors(raw, first, end)
                lead = np.array([int.from_bytes(data[x : x + 8], "big") for x in a.tolist()], np.uint64)
                core = np.array([h(data[x : x + CORE]) for x in a.tolist()], np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array(lead.view(np.int64)), pa.array(core.view(np.int64))], names=["lead", "core"])

    return drawn.mapInArrow(run, "lead long, core long")


def _hot_cores(marks: DataFrame, many: int) -> np.ndarray:
    hot = marks.groupBy("core").agg(F.count("*").alias("n")).where(F.col("n") >= _hot_least(many)).orderBy(F.desc("n")).limit(4096)
    return np.sort(hot.select("core").toArrow()["core"].to_numpy())


def _quarter(marks: DataFrame) -> DataFrame:
    return marks.where("(xxhash64(core) & 3) = 0").select("lead")


def _splitters(marks: DataFrame, buckets: int) -> np.ndarray:
    """Quantiles of the leading tokens."""
    got = np.sort(_quarter(marks).toArrow()["lead"].to_numpy().view(np.uint64))
    return np.unique(got[np.arange(1, buckets) * len(got) // buckets]) if len(got) else got


def _drawn(keyed: DataFrame, many: int, docs: int) -> DataFrame:
    """About so many of many documents, drawn by a hash of the row: reruns draw alike."""
    share = max(1, round(min(1.0, docs / max(1, many)) * (1 << 40)))
    return keyed.where(f"(xxhash64(id, tag) & {(1 << 40) - 1}) < {share}")


def _ranges(low: int, high: int, width: int) -> list[tuple[int, int]]:
    """The ranges [x, x + width) that low to high fall into."""
    return [(x, x + width) for x in range(low // width * width, high + 1, width)]


def _range_key(context: bytes, suffix: bytes, low: int, high: int) -> int:
    """A hash of the bytes that all strings of the range [low, high) of distances hold."""
    from xxhash import xxh3_64_intdigest as h

    return h(context[len(context) - low :] + suffix[: LENGTH - high + 1], low << 8 | high)


def _string_key(context: bytes, suffix: bytes, d: int) -> bytes:
    from xxhash import xxh3_128_digest as h

    return h(context[len(context) - d :] + suffix[: LENGTH - d], d)


def _told(drawn: DataFrame, many: int, hot: np.ndarray) -> tuple[frozenset[int], frozenset[bytes]]:
    """Of drawn documents: the keys of ranges that are frequent among suffixes of hot cores, and the strings of such fine ranges that occur twice."""
    if not len(hot):
        return frozenset(), frozenset()

    def spots(batches: Iterator[pa.RecordBatch]):
        from xxhash import xxh3_64_intdigest as h

        for batch in batches:
            for f, z in slices(batch.column(2), 2 << 20):
                data, raw, first, end = _raw(batch.column(2).slice(f, z - f))
                doc, a, s, e = anchors(raw, first, end)
                for n, at, begin, stop in zip(doc.tolist(), a.tolist(), s.tolist(), e.tolist(), strict=True):
                    core = np.uint64(h(data[at : at + CORE])).view(np.int64)
                    k = np.searchsorted(hot, core)
                    if k < len(hot) and hot[k] == core:
                        yield data[max(at - WINDOW + 1, int(first[n])) : at].tobytes(), data[at : min(at + LENGTH, int(end[n]))].tobytes(), at - stop, at - begin

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = [_range_key(c, x, f, z) for c, x, low, high in spots(batches) for w in (SIDE, FINE) for f, z in _ranges(low, high, w)]
        yield pa.RecordBatch.from_arrays([pa.array(np.array(keys, np.uint64).view(np.int64))], names=["key"])

    seen = drawn.mapInArrow(ranges, "key long").groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") >= _hot_least(many))
    frequent = frozenset(seen.orderBy(F.desc("n")).limit(TOLD).select("key").toArrow()["key"].to_numpy().view(np.uint64).tolist())

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = []
        for c, x, low, high in spots(batches):
            for f, z in _ranges(low, high, FINE):
                if _range_key(c, x, f, z) in frequent:
                    keys += [_string_key(c, x, d) for d in range(max(f, low), min(z - 1, high) + 1)]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary())], names=["key"])

    twice = drawn.mapInArrow(strings, "key binary").groupBy("key").agg(F.count("*").alias("n")).where("n > 1").orderBy(F.desc("n")).limit(TOLD)
    return frequent, frozenset(twice.select("key").toArrow()["key"].to_pylist())


#: Buckets below zero: spans that are known, and strings that are dealt one by one, whose place is their span and whose suffix is their key.
KNOWN, STRING = -1, -2


def _suffixes(wanted: DataFrame, keyed: DataFrame, cuts: np.ndarray, hot: np.ndarray, frequent: frozenset[int], twice: frozenset[bytes]) -> DataFrame:
    """(bucket, id, tag, place, kind, low, high, suffix, context) of the wanted anchors, fetched from their texts; low to high: the d to compare."""
    spread = HOT_BUCKETS * (len(cuts) + 1)
    asked = wanted.groupBy("id", "tag").agg(F.sort_array(F.collect_set(F.expr("place * 8 + kind"))).alias("asked"))
    joined = keyed.join(asked, ["id", "tag"])

    def deal(context: bytes, suffix: bytes, low: int, high: int):
        """(bucket, first d, last d, key): where the strings of a hot suffix go; the key of a string that goes alone."""
        for f, z in _ranges(low, high, SIDE):
            key = _range_key(context, suffix, f, z)
            if key not in frequent:
                yield len(cuts) + 1 + key % spread, max(f, low), min(z - 1, high), b""
                continue
            for g, y in _ranges(max(f, low), min(z - 1, high), FINE):
                key = _range_key(context, suffix, g, y)
                own = max(g, low), min(y - 1, high)
                if key not in frequent:
                    yield len(cuts) + 1 + key % spread, *own, b""
                    continue
                for d in range(own[0], own[1] + 1):
                    key = _string_key(context, suffix, d)
                    yield (KNOWN if key in twice else STRING), d, d, key

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest as h

        for batch in batches:
            for f, z in slices(batch.column(2), 4 << 20):
                own = batch.slice(f, z - f)
                data, _, first, end = _raw(own.column(2))
                ask = own.column(3)
                many = np.diff(ask.offsets.to_numpy())
                doc = np.repeat(np.arange(own.num_rows), many)
                packed = ask.flatten().to_numpy()
                place, kind = packed >> 3, packed & 7
                a = ((place >> 14) & 0x7FFFFFFF) + first[doc]
                stop = np.minimum(a + LENGTH, end[doc])
                begin = np.maximum(a - (WINDOW - 1), first[doc])
                suffix = [data[x:y].tobytes() for x, y in zip(a.tolist(), stop.tolist(), strict=True)]
                lead = np.array([int.from_bytes(x[:8], "big") for x in suffix], np.uint64)
                context = [data[x:y].tobytes() for x, y in zip(begin.tolist(), a.tolist(), strict=True)]
                bucket = np.searchsorted(cuts, lead, "right")
                low, high = place & 127, (place >> 7) & 127
                rows = np.arange(len(place))
                put, before = place, [context, suffix]
                if len(hot):
                    core = np.array([h(x[:CORE]) for x in suffix], np.uint64).view(np.int64)
                    spots = np.flatnonzero(np.isin(core, hot))
                    more: list[tuple] = []
                    for i in spots.tolist():
                        at, part, held = int(a[i] - first[doc[i]]), bool(kind[i] & PART), None
                        for where, d0, d1, key in deal(context[i], suffix[i], int(low[i]), int(high[i])):
                            if where == KNOWN:
                                # of known strings, runs of distances go on as one span
                                if held and held[1] + 1 == d0:
                                    held[1] = d1
                                    continue
                                if held and part:
                                    more.append((i, KNOWN, held[0], held[1], (at - held[1]) << 32 | at - held[0] + LENGTH, b"", b""))
                                held = [d0, d1]
                            elif where == STRING:
                                more.append((i, STRING, d0, d1, (at - d1) << 32 | at - d0 + LENGTH, b"", key))
                            else:
                                more.append((i, where, d0, d1, int(place[i]), context[i], suffix[i]))
                        if held and part:
                            more.append((i, KNOWN, held[0], held[1], (at - held[1]) << 32 | at - held[0] + LENGTH, b"", b""))
                    calm = np.setdiff1d(rows, spots)
                    rows = np.concatenate((calm, np.array([m[0] for m in more], np.int64)))
                    bucket, low, high, put = (
                        np.concatenate((x[calm], np.array([m[k] for m in more], np.int64))) for k, x in ((1, bucket), (2, low), (3, high), (4, place))
                    )
                    before = [[x[i] for i in calm.tolist()] + [m[k] for m in more] for k, x in ((5, context), (6, suffix))]
                texts = pa.array(doc[rows])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(bucket, pa.int32()), own.column(0).take(texts), own.column(1).take(texts), pa.array(put), pa.array(kind[rows], pa.int32()),
                        pa.array(low, pa.int32()), pa.array(high, pa.int32()), pa.array(before[1], pa.binary()), pa.array(before[0], pa.binary()),
                    ],
                    names=["bucket", "id", "tag", "place", "kind", "low", "high", "suffix", "context"],
                )
            release()

    return joined.select("id", "tag", "text", "asked").mapInArrow(run, "bucket int, id long, tag long, place long, kind int, low int, high int, suffix binary, context binary")


def _compared(suffixes: DataFrame, tasks: int | None = None) -> DataFrame:
    """(id, tag, span): spans of repeated bytes, packed as first * 2 ** 32 + end, of PART runs; a task holds its buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        whole = pa.Table.from_batches(got).combine_chunks()
        bucket = whole["bucket"].to_numpy()
        alone = np.flatnonzero(bucket == STRING)
        told = np.flatnonzero(bucket == KNOWN)
        if len(alone):
            own = whole["suffix"].combine_chunks().take(pa.array(alone)).dictionary_encode().indices.to_numpy()
            repeated = np.bincount(own)[own] > 1
            told = np.concatenate((told, alone[repeated & ((whole["kind"].to_numpy()[alone] & PART) > 0)]))
        if len(told):
            t = whole.select(["id", "tag", "place"]).take(pa.array(told)).combine_chunks()
            yield pa.RecordBatch.from_arrays([t["id"].chunk(0), t["tag"].chunk(0), t["place"].chunk(0)], names=["id", "tag", "span"])
        by = np.argsort(bucket, kind="stable")
        by = by[bucket[by] >= 0]
        if not len(by):
            release()
            return
        edges = np.flatnonzero(np.concatenate(([True], bucket[by][1:] != bucket[by][:-1], [True])))
        for f, z in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            t = whole.take(pa.array(by[f:z])).combine_chunks()
            place, kind = t["place"].to_numpy(), t["kind"].to_numpy()
            row, d = repeated_starts(t["suffix"].chunk(0), t["context"].chunk(0), t["high"].to_numpy(), t["low"].to_numpy())
            part = (kind[row] & PART) > 0
            row, d = row[part], d[part]
            if not len(row):
                continue
            start = ((place[row] >> 14) & 0x7FFFFFFF) - d
            by_start = np.lexsort((start, row))
            row, start = row[by_start], start[by_start]
            new = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1))))
            stop = np.append(new[1:], len(row)) - 1
            yield pa.RecordBatch.from_arrays(
                [
                    t["id"].combine_chunks().take(pa.array(row[new])), t["tag"].combine_chunks().take(pa.array(row[new])),
                    pa.array((start[new] << 32) + start[stop] + LENGTH),
                ],
                names=["id", "tag", "span"],
            )
        release()

    deal = F.when(F.col("bucket") == STRING, F.xxhash64("suffix")).when(F.col("bucket") == KNOWN, F.xxhash64("id", "tag")).otherwise(F.col("bucket").cast("long"))
    dealt = suffixes.withColumn("deal", deal)
    dealt = dealt.repartition(tasks, "deal") if tasks else dealt.repartition("deal")
    return dealt.drop("deal").mapInArrow(run, "id long, tag long, span long")


def repeated_spans(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(id, tag, spans): for each row that has any, spans of repeated bytes (they may overlap), packed as first * 2 ** 32 + end."""
    scratch = Scratch(docs.sparkSession, "suffixes")
    keyed = _keyed(docs, doc_id, text)
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = keyed.count()
    drawn = scratch.table(_drawn(keyed, many, SAMPLE))
    marks = scratch.table(_marks(drawn))
    hot = _hot_cores(marks, many)
    frequent, twice = _told(drawn, many, hot)
    found = scratch.table(_candidates(_anchor_rows(keyed), hot))
    scratch.free_shuffles()
    wanted = found.where(f"(kind & {PART | PEER}) > 0").select("id", "tag", "place", "kind")
    # a task holds so many suffixes, whatever the number of all
    tasks = -(-wanted.count() // (PER_BUCKET * BUCKETS))
    buckets = BUCKETS * max(least, tasks)
    if tasks > least:
        each = max(1.0, _quarter(marks).count() / max(1, drawn.count()))
        marks = _marks(_drawn(keyed, many, max(SAMPLE, int(PER_SPLITTER * buckets / each))))
    cuts = _splitters(marks, buckets)
    part = scratch.table(_compared(_suffixes(wanted, keyed, cuts, hot, frequent, twice), tasks if tasks > least else None))
    scratch.free_shuffles()
    a = "((place >> 14) & 2147483647)"
    full = found.where(f"(kind & {FULL}) > 0").selectExpr(
        "id", "tag", f"({a} - ((place >> 7) & 127)) * 4294967296 + {a} - (place & 127) + {LENGTH} AS span"
    )
    spans = found.where(f"(kind & {SPAN}) > 0").select("id", "tag", "span")
    return full.unionByName(part).unionByName(spans).groupBy("id", "tag").agg(F.collect_set("span").alias("spans"))


def merged(spans: np.ndarray | None) -> list[tuple[int, int]]:
    """Packed spans as maximal ones, in order."""
    out: list[tuple[int, int]] = []
    for x in np.sort(np.asarray(spans if spans is not None else [], np.int64)).tolist():
        f, e = x >> 32, x & 0xFFFFFFFF
        if out and f <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((f, e))
    return out


def kept_bytes(text: str | None, spans: list[tuple[int, int]]) -> bytes:
    raw = (text or "").encode("utf-8", "replace")
    ends = [0, *(e for _, e in spans)]
    return b"".join(raw[a:b] for a, b in zip(ends, [*(f for f, _ in spans), len(raw)], strict=True))


def _with_spans(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    key, tag = row_key(doc_id, text)
    own = docs.select(packed(docs), F.col(text).alias("_text"), key.alias("_id"), tag.alias("_tag"))
    spans = repeated_spans(docs, text, doc_id).select(F.col("id").alias("_id"), F.col("tag").alias("_tag"), F.col("spans").alias("_spans"))
    return own.join(spans, ["_id", "_tag"], "left")


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row.

    Null texts are as empty; texts shorter than LENGTH lose nothing; repeated rows are copies of each other and lose all if
    they are long enough; null ids are rows as any other; an empty table gives an empty result; other columns are not read.
    """

    @F.pandas_udf("n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    def of(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
        out = []
        for t, packed in zip(texts, spans, strict=True):
            t = t if isinstance(t, str) else ""
            own = merged(packed)
            rest = kept_bytes(t, own)
            gone = sum(e - f for f, e in own)
            out.append((len(rest) + gone, gone, len(own), hashlib.sha256(rest).hexdigest()))
        release()
        return pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"])

    rows = _with_spans(docs.select("doc_id", "text"), "text", "doc_id")
    return rows.select(F.col("row.doc_id").alias("doc_id"), of("_text", "_spans").alias("r")).select("doc_id", "r.*")


def cut_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """docs with repeated bytes cut from the text; n_chars, where present, follows. A text with nothing left goes.

    Characters of which a part is cut go whole. Null texts stay null.
    """

    @F.pandas_udf("string")
    def of(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = pd.Series([kept_bytes(t, merged(s)).decode("utf-8", "ignore") for t, s in zip(texts, spans, strict=True)])
        release()
        return out

    rows = _with_spans(docs, text, doc_id)
    cut = rows.withColumn("_cut", F.when(F.col("_spans").isNull(), F.col("_text")).otherwise(of(F.col("_text"), F.col("_spans"))))
    kept = cut.where("_spans IS NULL OR _cut <> ''")
    put = {text: F.col("_cut")}
    if "n_chars" in docs.columns:
        put["n_chars"] = F.when(F.col("_spans").isNull(), F.col("row.n_chars")).otherwise(F.length("_cut").cast("long"))
    return kept.select(*unpacked(docs.columns, put))


def oracle(length: int = LENGTH) -> str:
    """The digest for DuckDB over the view documents: every string of length bytes is counted by its md5."""
    return f"""
WITH n AS (SELECT r, doc_id, b, CAST(octet_length(b) AS BIGINT) AS n FROM (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents)),
w AS (SELECT r, i, md5(b[i + 1:i + {length}]) AS h FROM (SELECT r, b, unnest(range(0, n - {length - 1})) AS i FROM n WHERE n >= {length})),
dup AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY h) AS c FROM w) WHERE c > 1),
new AS (SELECT r, i, (coalesce(i - lag(i) OVER (PARTITION BY r ORDER BY i), {length + 1}) > {length})::INT AS new FROM dup),
grp AS (SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS g FROM new),
span AS (SELECT r, min(i) AS a, max(i) + {length} AS e FROM grp GROUP BY r, g),
piece AS (SELECT r, coalesce(lag(e) OVER (PARTITION BY r ORDER BY a), 0) AS f, a AS t FROM span UNION ALL SELECT r, max(e), max(n) FROM span JOIN n USING (r) GROUP BY r),
cut AS (SELECT r, string_agg(hex(b[f + 1:t]), '' ORDER BY f) AS hx FROM piece JOIN n USING (r) WHERE t > f GROUP BY r),
gone AS (SELECT r, CAST(sum(e - a) AS BIGINT) AS removed, count(*) AS spans FROM span GROUP BY r)
SELECT doc_id, n AS n_bytes, coalesce(removed, 0) AS n_removed, coalesce(spans, 0) AS n_spans, sha256(CASE WHEN spans IS NULL THEN b ELSE unhex(coalesce(hx, '')) END) AS kept_sha256
FROM n LEFT JOIN gone USING (r) LEFT JOIN cut USING (r)"""
