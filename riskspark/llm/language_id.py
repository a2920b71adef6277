"""Language ID as mixture inference: a document is a mixture of learned languages over byte n-grams.

Learning counts hashed n-grams of the labelled texts by language. For a document, expectation-maximisation
finds the proportions of all languages that make its n-grams likeliest, until no proportion moves by more than NEAR in a
round; languages ordered by proportion give nested sets of any size; each set is fitted again, and the set with the best likelihood
less a penalty for each member is taken.
The prediction is the language with the largest proportion in that set, the score is the proportion.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import bounded_batches, packed, release, unpacked

UNKNOWN = "und"
BUCKETS = 1 << 16
SMOOTH = 0.5
#: Proportions that move by less in a round of expectation and maximisation are found.
NEAR = 1e-4
#: A language below SHARE joins no set.
SHARE = 0.05
#: Penalty for each language of a set: PENALTY * log(number of n-grams).
PENALTY = 2.0
#: The most languages that are learned: a table of so many times BUCKETS numbers is sent to every worker.
MOST = 1024
#: n-gram rows times languages of one fit.
CELLS = 1_500_000

#: ASCII bytes that are no letters are spaces; letters are lower-cased before.
_TABLE = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def normal(text: str | None) -> bytes:
    """Lower-cased words of letters (and of all beyond ASCII), each with a space around it; empty without a letter."""
    if not text:
        return b""
    words = text.lower().encode("utf-8", "replace").translate(_TABLE).split()
    if not words:
        return b""
    whole = b" ".join(words)
    if not any(97 <= c <= 122 for c in whole[:64]) and not any(c.isalpha() for c in text):
        return b""
    return b" " + whole + b" "


def grams(whole: bytes) -> np.ndarray:
    """Hashes of the three-byte windows, 0 to BUCKETS - 1."""
    x = np.frombuffer(whole, np.uint8).astype(np.uint32)
    code = (x[:-2] << np.uint32(16)) | (x[1:-1] << np.uint32(8)) | x[2:]
    return ((code * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.uint16)


def is_held_out(doc_id):
    """crc32 of the id as text, modulo 3, is 1; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


class Model:
    """Languages in order of name, and the probability of each bucket under each."""

    def __init__(self, names: list[str], counts: np.ndarray):
        self.names = names
        self.prob = ((counts + SMOOTH) / (counts + SMOOTH).sum(0, keepdims=True)).astype(np.float32) if names else counts

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Predictions and scores; und and 0 without a letter or without a learned language."""
        whole = [normal(t) for t in texts]
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not self.names:
            return names, scores
        room = max(1, CELLS // len(self.names))
        batch, rows = [], 0
        for k, w in enumerate(whole):
            if not w:
                continue
            codes = np.sort(grams(w))
            cut = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
            batch.append((k, codes[cut], np.diff(np.append(cut, len(codes)))))
            rows += len(cut)
            if rows > room:
                self._fit(batch, names, scores)
                batch, rows = [], 0
        if batch:
            self._fit(batch, names, scores)
        return names, scores

    def _em(self, p, count, start, doc, total, share):
        """Proportions from share (zeros stay zero) until no round moves them by NEAR, and their log likelihood.

        Documents that are settled leave the rounds, half of those that are left at a time.
        """
        share = share.copy()
        live = np.arange(len(total))
        own_p, own_count, own_start, own_doc = p, count, start, doc
        sizes = np.diff(np.append(start, len(count)))
        moves = np.full(len(total), np.inf)
        while len(live):
            now = share[live]
            w = own_p * now[own_doc]
            w *= (own_count / w.sum(1))[:, None]
            after = np.add.reduceat(w, own_start, axis=0) / total[live][:, None]
            open_ = moves[live] >= NEAR
            moves[live[open_]] = np.abs(after - now).max(1)[open_]
            share[live[open_]] = after[open_]
            left = moves[live] >= NEAR
            if left.sum() <= len(live) // 2:
                rows = np.repeat(left, sizes[live])
                live = live[left]
                own_p, own_count = own_p[rows], own_count[rows]
                own_start = np.cumsum(sizes[live]) - sizes[live]
                own_doc = np.repeat(np.arange(len(live)), sizes[live])
        return share, np.add.reduceat(count * np.log((p * share[doc]).sum(1)), start)

    def _fit(self, batch, names, scores) -> None:
        at = np.array([k for k, _, _ in batch])
        sizes = np.array([len(c) for _, c, _ in batch])
        start = np.cumsum(sizes) - sizes
        doc = np.repeat(np.arange(len(batch)), sizes)
        count = np.concatenate([n for _, _, n in batch]).astype(np.float64)
        p = self.prob[np.concatenate([c for _, c, _ in batch])].astype(np.float64)
        total = np.add.reduceat(count, start)
        k = p.shape[1]
        share, _ = self._em(p, count, start, doc, total, np.full((len(batch), k), 1 / k))
        order = np.argsort(-share, axis=1, kind="stable")
        # one language: the likeliest by itself
        alone = np.add.reduceat(count[:, None] * np.log(p), start, axis=0)
        pick, best = alone.argmax(1), alone.max(1) - PENALTY * np.log(total)
        score = np.ones(len(batch))
        ranked = np.take_along_axis(share, order, 1)
        for size in range(2, k + 1):
            docs = np.flatnonzero(ranked[:, size - 1] >= SHARE)
            if not len(docs):
                break
            rows = np.isin(doc, docs)
            own = np.searchsorted(docs, doc[rows])
            inner = np.cumsum(sizes[docs]) - sizes[docs]
            begin = np.zeros((len(docs), k))
            np.put_along_axis(begin, order[docs, :size], 1 / size, 1)
            part, fit = self._em(p[rows], count[rows], inner, own, total[docs], begin)
            fit -= PENALTY * size * np.log(total[docs])
            better = fit > best[docs]
            won = docs[better]
            best[won], pick[won], score[won] = fit[better], part[better].argmax(1), part[better].max(1)
        for i, lang, s in zip(at.tolist(), pick.tolist(), score.tolist(), strict=True):
            names[i], scores[i] = self.names[lang], min(1.0, s)


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Counts of all labelled rows; what reaches the driver is one table of languages times BUCKETS.

    More than MOST labels are refused with an error, before any text is read: such a column does not hold languages.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if w := normal(t):
                    held = sums.setdefault(name, np.zeros(BUCKETS, np.int64))
                    codes = grams(w)
                    if len(codes) > 20_000:
                        held += np.bincount(codes, minlength=BUCKETS)
                    else:
                        np.add.at(held, codes, 1)
        release()
        for name, held in sums.items():
            seen = np.flatnonzero(held)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(seen)), pa.array(seen.astype(np.int32)), pa.array(held[seen])], names=["lang", "gram", "n"])

    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    # without a condition on the texts, so that this pass reads labels only
    if docs.select(F.col(lang).alias("lang")).where("lang IS NOT NULL").distinct().limit(MOST + 1).count() > MOST:
        raise ValueError(f"column {lang} has more than {MOST} labels to learn from")
    got = rows.mapInArrow(run, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(set(got["lang"].to_pylist()))
    counts = np.zeros((BUCKETS, len(names)))
    if names:
        where = {x: i for i, x in enumerate(names)}
        counts[got["gram"].to_numpy(), [where[x] for x in got["lang"].to_pylist()]] = got["n"].to_numpy()
    return Model(names, counts)


def predicted(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with _lang: struct(lang_pred, score)."""
    bounded_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def of(texts: pd.Series) -> pd.DataFrame:
        names, scores = held.value.predict([t if isinstance(t, str) else None for t in texts])
        release()
        return pd.DataFrame({"lang_pred": names, "score": scores})

    return docs.withColumn("_lang", of(F.col(text)))


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row.

    Null texts and texts without a letter are und with score 0, and so is every text if no row can be learned from;
    repeated rows are predicted each; rows with a null id are not learned from; other columns are not read.
    """
    rows = docs.select("doc_id", "text", "lang", is_held_out(F.col("doc_id")).alias("held_out"))
    model = learn(rows.where("NOT held_out AND doc_id IS NOT NULL"))
    return predicted(rows.select("doc_id", "text", "held_out"), model).select("doc_id", "held_out", "_lang.lang_pred", "_lang.score")


def keep_known(docs: DataFrame) -> DataFrame:
    """docs without those that are und; columns as they are."""
    model = learn(docs.where(~is_held_out(F.col("doc_id"))).where("doc_id IS NOT NULL"))
    rows = predicted(docs.select(packed(docs), F.col("text").alias("text")), model)
    return rows.where(F.col("_lang.lang_pred") != UNKNOWN).select(*unpacked(docs.columns))
