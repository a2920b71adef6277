"""SentencePiece encoding and decoding by a batched Viterbi search in numpy.

A text is a space followed by its bytes; a word is a run of spaces and what follows up to the next one, and no piece
crosses the start of a word; where a model has pieces with a space after other characters, a text is one word. Distinct words of
one length advance together: at each place, the hash of every substring that ends there is looked up among the sorted piece
keys, and the best of score and predecessor is kept as back pointer. The result is the segmentation with the largest sum of
piece scores, the longest last piece winning ties; bytes that no piece covers are spelled with byte pieces. Words beyond LONG
bytes, such as runs of CJK characters, seldom have one length: TOGETHER or more of nearly one length advance together as well, each up to
its own end. Fewer have all their substrings looked up at once in the same tables, and their places visited in order, in linear time.

The ids are those of the best-scoring segmentation. They are not the library's ids for a model made by merging, whose scores are ranks of merges.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import bounded_batches, gathered, ragged_take, release, slices
from .tokens import crc, vocabulary

SPACE = "▁"
LONG = 64
#: Long words that advance together, and the bytes of such a batch.
TOGETHER, CELLS = 200, 1 << 20
#: Score of a byte piece: below that of any piece, of which the public model's spaces have the least, -1e9; sums of whole scores
#: stay exact up to four million byte pieces.
BYTE_SCORE = -2e9
REMEMBERED = 300_000
#: Two odd bases: a substring is a piece if the hashes of both agree.
BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def _prefixes(rows: np.ndarray, base: np.uint64) -> np.ndarray:
    """Polynomial hashes of all prefixes of byte rows."""
    out = np.zeros((rows.shape[0], rows.shape[1] + 1), np.uint64)
    x = rows.astype(np.uint64) + np.uint64(1)
    for k in range(rows.shape[1]):
        out[:, k + 1] = out[:, k] * base + x[:, k]
    return out


class Codec:
    """Encodes with the pieces and scores of a model file; its merge order is not used."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.byte_ids = np.zeros(256, np.uint32)
        plain, self.piece_bytes = [], []
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.piece_bytes.append(bytes([int(piece[3:5], 16)]))
                continue
            special = model.is_control(i) or model.is_unknown(i) or model.is_unused(i)
            own = b"" if special else piece.replace(SPACE, " ").encode()
            self.piece_bytes.append(own)
            if own:
                plain.append((own, i, model.get_score(i)))
        if min(s for _, _, s in plain) <= BYTE_SCORE:
            raise ValueError(f"pieces of {path} score no more than a byte piece")
        self.parted = not any(b" " in b.lstrip(b" ") for b, _, _ in plain)
        self.start = np.concatenate(([0], np.cumsum([len(b) for b in self.piece_bytes])))
        self.flat = np.frombuffer(b"".join(self.piece_bytes), np.uint8)
        self.tables = {}
        for size in sorted({len(b) for b, _, _ in plain}):
            own = [x for x in plain if len(x[0]) == size]
            rows = np.frombuffer(b"".join(b for b, _, _ in own), np.uint8).reshape(-1, size)
            first, second = (_prefixes(rows, base)[:, -1] for base in BASES)
            by = np.argsort(first)
            ids, scores = np.array([i for _, i, _ in own], np.uint32), np.array([s for _, _, s in own])
            self.tables[size] = first[by], second[by], ids[by], scores[by]
        self.powers = [[np.uint64(pow(int(base), k, 1 << 64)) for k in range(max(self.tables) + 1)] for base in BASES]
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids: list[np.ndarray] = []
        self.lengths: list[np.ndarray] = []
        self._store = None

    def _probe(self, size: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(score, id) of substrings of one size by their two hashes; minus infinity where there is no piece."""
        first, second, ids, scores = self.tables[size]
        at = np.minimum(np.searchsorted(first, a), len(first) - 1)
        hit = (first[at] == a) & (second[at] == b)
        return np.where(hit, scores[at], -np.inf), ids[at]

    def _batch(self, rows: np.ndarray, sizes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids, lengths) of words of one length, or of padded words of the given sizes."""
        n, size = rows.shape
        pre = [_prefixes(rows, base) for base in BASES]
        best = np.full((n, size + 1), -np.inf)
        best[:, 0] = 0
        back, piece = np.ones((n, size + 1), np.int16), np.zeros((n, size + 1), np.uint32)
        for end in range(1, size + 1):
            top = best[:, end - 1] + BYTE_SCORE
            step, which = np.ones(n, np.int16), self.byte_ids[rows[:, end - 1]]
            for k in self.tables:
                if k > end:
                    break
                h = [p[:, end] - p[:, end - k] * w[k] for p, w in zip(pre, self.powers, strict=True)]
                score, ids = self._probe(k, *h)
                total = best[:, end - k] + score
                better = total >= top
                better &= score > -np.inf
                top = np.where(better, total, top)
                step[better], which[better] = k, ids[better]
            best[:, end], back[:, end], piece[:, end] = top, step, which
        out = np.zeros((n, size), np.uint32)
        used = np.zeros(n, np.int64)
        at = np.full(n, size) if sizes is None else sizes.copy()
        live = np.arange(n)
        while len(live):
            used[live] += 1
            out[live, size - used[live]] = piece[live, at[live]]
            at[live] -= back[live, at[live]]
            live = live[at[live] > 0]
        return out[np.arange(size)[None, :] >= size - used[:, None]], used

    def _single(self, word: bytes) -> np.ndarray:
        """Ids of one long word: all substrings of a size are looked up at once, then places are visited in order."""
        rows = np.frombuffer(word, np.uint8)[None, :]
        pre = [_prefixes(rows, base)[0] for base in BASES]
        size = len(word)
        arcs: list[list[tuple[int, float, int]]] = [[] for _ in range(size + 1)]
        for k in self.tables:
            if k > size:
                break
            score, ids = self._probe(k, *(p[k:] - p[:-k] * w[k] for p, w in zip(pre, self.powers, strict=True)))
            for f in np.flatnonzero(score > -np.inf).tolist():
                arcs[f + k].append((k, float(score[f]), int(ids[f])))
        best, back = [0.0] * (size + 1), [(1, 0)] * (size + 1)
        for end in range(1, size + 1):
            top, way = best[end - 1] + BYTE_SCORE, (1, int(self.byte_ids[word[end - 1]]))
            for k, score, i in arcs[end]:
                if best[end - k] + score >= top:
                    top, way = best[end - k] + score, (k, i)
            best[end], back[end] = top, way
        out, at = [], size
        while at:
            out.append(back[at][1])
            at -= back[at][0]
        return np.array(out[::-1], np.uint32)

    def _learn(self, words: list[bytes]) -> None:
        sizes = np.array([len(w) for w in words])

        def put(own: list[bytes], ids: np.ndarray, lengths: np.ndarray) -> None:
            base = len(self.known)
            self.known.update((w, base + k) for k, w in enumerate(own))
            self.ids.append(ids)
            self.lengths.append(lengths)

        for size in np.unique(sizes[sizes <= LONG]).tolist():
            at = np.flatnonzero(sizes == size)
            for f in range(0, len(at), 20_000):
                own = [words[i] for i in at[f : f + 20_000].tolist()]
                put(own, *self._batch(np.frombuffer(b"".join(own), np.uint8).reshape(-1, size)))
        order = np.flatnonzero(sizes > LONG)
        order = order[np.argsort(sizes[order], kind="stable")]
        ranked, f = sizes[order], 0
        while f < len(order):
            # as many as are at most a quarter longer than the first and fit into one batch
            e = min(int(np.searchsorted(ranked, ranked[f] * 5 // 4, "right")), f + max(1, CELLS // int(ranked[f] * 5 // 4)))
            own = [words[i] for i in order[f:e].tolist()]
            if len(own) >= TOGETHER:
                rows = np.frombuffer(b"".join(w.ljust(int(ranked[e - 1]), b"\0") for w in own), np.uint8).reshape(len(own), -1)
                put(own, *self._batch(rows, ranked[f:e]))
            else:
                got = [self._single(w) for w in own]
                put(own, np.concatenate(got), np.array([len(g) for g in got]))
            f = e
        self._store = None

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, first): the ids of text k are ids[first[k]:first[k + 1]]; null and empty texts have none."""
        n = len(texts)
        x = pc.replace_substring(pc.fill_null(texts, "").cast(pa.large_string()), SPACE, " ")
        x = pc.if_else(pc.equal(x, ""), "", pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), x, pa.scalar("", pa.large_string()))).cast(pa.large_binary())
        at = np.frombuffer(x.buffers()[1], np.int64)[x.offset : x.offset + n + 1] if n else np.zeros(1, np.int64)
        if at[-1] == at[0]:
            return np.zeros(0, np.uint32), np.zeros(n + 1, np.int64)
        data = x.buffers()[2]
        space = np.frombuffer(data, np.uint8)[at[0] : at[-1]] == 32
        begins = np.zeros(len(space), bool)
        if self.parted:
            begins[1:] = space[1:] & ~space[:-1]
        begins[at[:-1][at[1:] > at[:-1]] - at[0]] = True
        cuts = np.flatnonzero(begins) + at[0]
        offsets = np.append(cuts, at[-1]).astype(np.int64)
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts), [None, pa.py_buffer(offsets), data]).dictionary_encode()
        words = pieces.dictionary.to_pylist()
        fresh = [w for w in words if w not in self.known]
        if len(self.known) + len(fresh) > REMEMBERED:
            self._forget()
            fresh = words
        if fresh:
            self._learn(fresh)
        if self._store is None:
            self.ids, self.lengths = [np.concatenate(self.ids)], [np.concatenate(self.lengths)]
            self._store = np.concatenate(([0], np.cumsum(self.lengths[0])[:-1])).astype(np.int64)
        known = self.known
        order = np.fromiter((known[w] for w in words), np.int64, len(words))[pieces.indices.to_numpy()]
        ids = ragged_take(self.ids[0], self._store, self.lengths[0], order)
        ends = np.concatenate(([0], np.cumsum(self.lengths[0][order])))
        return ids, ends[np.searchsorted(cuts, at)]

    def decode(self, ids: np.ndarray, first: np.ndarray) -> list[bytes]:
        """The texts' bytes, without the space put before each."""
        at = ids.astype(np.int64)
        size = np.diff(self.start)
        raw = ragged_take(self.flat, self.start[:-1], size, at).tobytes()
        ends = np.concatenate(([0], np.cumsum(size[at])))[first].tolist()
        return [raw[a + 1 : b] if b > a else b"" for a, b in zip(ends[:-1], ends[1:], strict=True)]


_CODECS: dict[str, Codec] = {}


def codec(path: str | None = None) -> Codec:
    path = path or vocabulary("piece_bpe_32k.model")
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def encode(docs: DataFrame, path: str | None = None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, ids (array of int) for every row."""
    path = path or vocabulary("piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for f, e in slices(batch.column(1), 8 << 20):
                own = batch.slice(f, e - f)
                ids, first = codec(path).encode(own.column(1))
                yield pa.RecordBatch.from_arrays([own.column(0), pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids, pa.int32()))], names=["doc_id", "ids"])

    bounded_batches(docs.sparkSession)
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, text of rows as encode() gives them."""
    path = path or vocabulary("piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(1)
            ids = own.flatten().to_numpy(zero_copy_only=False).astype(np.uint32)
            first = own.offsets.to_numpy().astype(np.int64)
            texts = codec(path).decode(ids, first - first[0])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([t.decode("utf-8", "replace") for t in texts], pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_pieces, n_byte_pieces, ids_crc32 (little-endian unsigned 32-bit ids), round_trip for every row.

    Null and empty texts have no pieces; repeated rows are encoded each; a null id stays null; other columns are not
    read. round_trip: the decoded ids give the text again, with U+2581, the pieces' mark of a space, read as a space.
    """
    path = vocabulary("piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, 1, 8 << 20):
            for f, e in slices(batch.column(1), 10 << 20):
                own = batch.slice(f, e - f)
                c = codec(path)
                ids, first = c.encode(own.column(1))
                texts = pc.replace_substring(pc.fill_null(own.column(1), ""), SPACE, " ").cast(pa.binary()).to_pylist()
                spelled = np.concatenate(([0], np.cumsum(np.isin(ids, c.byte_ids))))
                at = first.tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        own.column(0), pa.array(np.diff(first)), pa.array(spelled[first[1:]] - spelled[first[:-1]]),
                        pa.array([crc(ids[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)], pa.int64()),
                        pa.array([a == b for a, b in zip(c.decode(ids, first), texts, strict=True)]),
                    ],
                    names=["doc_id", "n_pieces", "n_byte_pieces", "ids_crc32", "round_trip"],
                )
            release()

    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n_pieces long, n_byte_pieces long, ids_crc32 long, round_trip boolean")
