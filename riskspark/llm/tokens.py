"""Batched encoding with a public byte-level BPE vocabulary: each distinct piece of a batch is encoded once.

The vocabulary's splitting pattern never lets a token cross from a non-space character to the white space after it, and it
looks behind nothing. So texts are cut before white space that follows a non-space character, equal pieces are encoded once, and
the ids of a text are those of its pieces, joined: the same as the library's for the whole text.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ._shared import ragged_take

END = 2
#: Bytes of distinct pieces that the library encodes as one text.
JOINED = 1 << 15
_SPACES = np.zeros(256, bool)
_SPACES[[32, *range(9, 14)]] = True


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids of texts, by the tokenizers library with add_special_tokens=False: a special token that a text spells out is that token's id."""

    def __init__(self, path: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path or vocabulary())
        # a token of this vocabulary has one character for each byte
        self.bytes_of = np.zeros(self.library.get_vocab_size(), np.int64)
        for token, i in self.library.get_vocab().items():
            self.bytes_of[i] = len(token)

    def _ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, counts) of texts, by the library."""
        got = [np.array(e.ids, np.uint32) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        return np.concatenate([np.zeros(0, np.uint32), *got]), np.array([len(g) for g in got], np.int64)

    def _pieces(self, words: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, starts, counts) of distinct pieces.

        Pieces that start with white space and end with a solid character may stand next to each other in one text, which
        saves a call for each; the bytes that its tokens stand for tell where a piece ends.
        """
        at = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
        raw = np.frombuffer(words.buffers()[2], np.uint8)
        sizes, last = np.diff(at), raw[at[1:] - 1]
        before = raw[np.maximum(at[1:] - 2, at[:-1])]
        clean = _SPACES[raw[at[:-1]]] & (((last > 32) & (last < 127)) | ((last >= 128) & (before == 0xC3)))
        easy, hard = np.flatnonzero(clean), np.flatnonzero(~clean)
        joined = ragged_take(raw, at[:-1], sizes, easy).tobytes()
        ends = np.cumsum(sizes[easy])
        cuts = np.unique(np.searchsorted(ends, np.arange(JOINED, len(joined) + JOINED, JOINED), "left").clip(max=len(ends) - 1)) if len(ends) else ends
        stops = [0, *ends[cuts].tolist()]
        ids, _ = self._ids([joined[a:b].decode("utf-8") for a, b in zip(stops[:-1], stops[1:], strict=True)])
        spelled = np.cumsum(self.bytes_of[ids])
        upto = np.searchsorted(spelled, ends) + 1
        if len(ends) and not np.array_equal(spelled[upto - 1], ends):
            raise ValueError("tokens cross the pieces of this vocabulary")
        counts = np.zeros(len(words), np.int64)
        counts[easy] = np.diff(np.concatenate(([0], upto)))
        more, counts[hard] = self._ids([raw[at[i] : at[i + 1]].tobytes().decode("utf-8", "replace") for i in hard.tolist()])
        order = np.concatenate((easy, hard))
        starts = np.empty(len(words), np.int64)
        starts[order] = np.cumsum(counts[order]) - counts[order]
        return np.concatenate((ids, more)), starts, counts

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, first): the ids of text k are ids[first[k]:first[k + 1]]; null is as empty."""
        texts = pc.fill_null(texts, "").cast(pa.large_binary())
        n = len(texts)
        if not n:
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
        data = texts.buffers()[2]
        if data is None or at[-1] == at[0]:
            return np.zeros(0, np.uint32), np.zeros(n + 1, np.int64)
        cuts = _cuts(np.frombuffer(data, np.uint8), at)
        offsets = np.append(cuts, at[-1])
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts), [None, pa.py_buffer(offsets), data]).dictionary_encode()
        ids, starts, counts = self._pieces(pieces.dictionary)
        order = pieces.indices.to_numpy()
        ends = np.concatenate(([0], np.cumsum(counts[order])))
        return ragged_take(ids, starts, counts, order), ends[np.searchsorted(cuts, at)]


def _cuts(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Starts of pieces: those of texts that are not empty, and white space after an ASCII non-space character or a letter of U+00C0 to U+00FF."""
    low = int(at[0])
    x = raw[low : int(at[-1])]
    solid = (x > 32) & (x < 127)
    solid[1:] |= (x[1:] >= 128) & (x[:-1] == 0xC3)
    cut = _SPACES[x]
    cut[1:] &= solid[:-1]
    cut[at[:-1][at[1:] > at[:-1]] - low] = True
    return np.flatnonzero(cut) + low


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each vocabulary and worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def with_ends(ids: np.ndarray, first: np.ndarray, end: int = END) -> tuple[np.ndarray, np.ndarray]:
    """The same with the end id after each text."""
    n = len(first) - 1
    out = np.empty(len(ids) + n, np.uint32)
    ends = first[1:] + np.arange(n)
    mask = np.ones(len(out), bool)
    mask[ends] = False
    out[mask] = ids
    out[ends] = end
    return out, first + np.arange(n + 1)


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, "<u4"))
