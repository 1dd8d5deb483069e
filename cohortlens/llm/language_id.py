"""Language ID by prediction by partial matching (operator 10).

Each language owns a tree of byte contexts of order 0 to ``ORDER`` with the
symbol counts seen after them.  A byte costs what PPM with escape method C and
full exclusion would spend on it: from the longest context down, an escape is
paid in each context that never saw the byte, symbols of longer contexts are
excluded below, and order -1 is uniform over the bytes the language never
saw.  Statistics are frozen, so the cost of a byte depends on the ``ORDER``
bytes before it alone, and a text's code length is a sum of table lookups.

Cases: a null text, or one without a letter, is ``und`` with score 0; ties go
to the language first in code point order; without training rows every text
is ``und``; repeated rows are scored alike; rows with a null ``doc_id`` are
scored but never learned from.  Texts start after ``ORDER`` line feeds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import give_back, seeded, small_batches, with_computed

#: Longest context, in bytes.
ORDER = 4
#: Expected number of labelled documents that a language's statistics are
#: fitted on; the sample is a seeded draw over all labelled rows.
SAMPLE_DOCS = 600
#: Bytes scored at once.
WINDOW = 1 << 18

UNKNOWN = "und"
_MULT = np.uint64(0x9E3779B97F4A7C15)


def _grams(data: bytes) -> np.ndarray:
    """The code of each byte of ``data`` past the first ORDER with its ORDER predecessors."""
    b = np.frombuffer(data, np.uint8).astype(np.uint64)
    n = len(b) - ORDER
    out = np.zeros(n, np.uint64)
    for k in range(ORDER + 1):
        out = (out << np.uint64(8)) | b[k : k + n]
    return out


def _found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where ``wanted`` stands in the sorted ``keys``, and whether it does."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


class Tree:
    """Context statistics of one language, as sorted arrays per order."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        self.grams, self.counts, self.contexts, self.total, self.distinct, self.below = [], [], [], [], [], []
        for j in range(ORDER + 1):
            g, inv = np.unique(grams & _mask(j + 1), return_inverse=True)
            c = np.bincount(inv, weights=counts, minlength=len(g))
            ctx, inv = np.unique(g >> np.uint64(8), return_inverse=True)
            self.grams.append(g)
            self.counts.append(c)
            self.contexts.append(ctx)
            self.total.append(np.bincount(inv, weights=c, minlength=len(ctx)))
            self.distinct.append(np.bincount(inv, minlength=len(ctx)).astype(float))
            # counts that the next shorter context holds for the symbols seen here
            shorter = self.counts[j - 1][_found(self.grams[j - 1], g & _mask(j))[0]] if j else np.zeros(len(g))
            self.below.append(np.bincount(inv, weights=shorter, minlength=len(ctx)))

    def bits(self, grams: np.ndarray) -> np.ndarray:
        """Exact code length of the last byte of each gram, given the others."""
        out, done = np.zeros(len(grams)), np.zeros(len(grams), bool)
        gone_n = gone_q = np.zeros(len(grams))
        for j in range(ORDER, -1, -1):
            at, known = _found(self.contexts[j], (grams & _mask(j + 1)) >> np.uint64(8))
            n = np.where(known, self.total[j][at] - gone_n, 0.0)
            q = np.where(known, self.distinct[j][at] - gone_q, 0.0)
            g, seen = _found(self.grams[j], grams & _mask(j + 1))
            here = seen & ~done
            escape = ~seen & ~done & known & (n > 0)
            out[here] += np.log2(n[here] + q[here]) - np.log2(self.counts[j][g[here]])
            out[escape] += np.log2(n[escape] + q[escape]) - np.log2(q[escape])
            done |= here
            gone_n, gone_q = np.where(known, self.below[j][at], 0.0), np.where(known, self.distinct[j][at], 0.0)
        out[~done] += np.log2(256.0 - len(self.grams[0]))
        return out


def _mask(n_bytes: int) -> np.uint64:
    return np.uint64((1 << (8 * n_bytes)) - 1)


@dataclass
class Model:
    """All languages' trees, and a hash table with the costs of the grams seen
    in training (the rest are worked out from the trees when they turn up)."""

    langs: list[str]
    trees: list[Tree]
    keys: np.ndarray
    slots: np.ndarray
    costs: np.ndarray
    shift: int

    @staticmethod
    def fit(counts: pd.DataFrame) -> Model:
        """From the summed ``(lang, gram, n)`` of the sample."""
        langs = sorted(counts["lang"].unique())
        trees = []
        for x in langs:
            own = counts[counts["lang"] == x]
            trees.append(Tree(own["gram"].to_numpy().astype(np.uint64), own["n"].to_numpy().astype(float)))
        keys = np.unique(np.concatenate([t.grams[ORDER] for t in trees])) if trees else np.zeros(0, np.uint64)
        costs = np.stack([t.bits(keys) for t in trees], axis=1).astype(np.float32) if trees else np.zeros((0, 0), np.float32)
        for t in trees:  # the table has the longest grams of all languages, so no tree is asked for one
            t.grams[ORDER], t.counts[ORDER] = t.grams[ORDER][:0].copy(), t.counts[ORDER][:0].copy()
        size = max(10, int(np.ceil(np.log2(max(1, len(keys)) * 3))))
        slots = np.full(1 << size, -1, np.int32)
        shift = 64 - size
        left, at = np.arange(len(keys), dtype=np.int32), (keys * _MULT) >> np.uint64(shift)
        while len(left):  # open addressing with linear probing, all keys a round
            free = slots[at] < 0
            slots[at[free]] = left[free]  # of several keys for a slot the last stays
            out = slots[at] != left
            left, at = left[out], (at[out] + np.uint64(1)) & np.uint64(len(slots) - 1)
        return Model(langs, trees, keys, slots, costs, shift)

    def lookup(self, grams: np.ndarray) -> np.ndarray:
        """Row of each gram in ``costs``, -1 if it was not seen in training."""
        out = np.full(len(grams), -1, np.int32)
        left, at = np.arange(len(grams)), (grams * _MULT) >> np.uint64(self.shift)
        while len(left):
            row = self.slots[at]
            hit = (row >= 0) & (self.keys[row] == grams[left]) if len(self.keys) else row >= 0
            out[left[hit]] = row[hit]
            go = (row >= 0) & ~hit
            left, at = left[go], (at[go] + np.uint64(1)) & np.uint64(len(self.slots) - 1)
        return out

    def bits(self, grams: np.ndarray) -> np.ndarray:
        """(grams, languages) code lengths."""
        row = self.lookup(grams)
        out = self.costs[row]
        new = np.flatnonzero(row < 0)
        if len(new):
            distinct, inv = np.unique(grams[new], return_inverse=True)
            out[new] = np.stack([t.bits(distinct) for t in self.trees], axis=1)[inv]
        return out

    def texts(self, texts: list[bytes]) -> np.ndarray:
        """(texts, languages) code lengths of whole texts."""
        out = np.zeros((len(texts), len(self.langs)))
        pad = b"\n" * ORDER
        held: list[int] = []

        def flush() -> None:
            lens = np.array([len(texts[i]) for i in held])
            cost = self.bits(_grams(pad + pad.join(texts[i] for i in held)))
            ends = np.cumsum(lens + ORDER) - ORDER
            sums = np.vstack([np.zeros(len(self.langs)), np.cumsum(cost, axis=0, dtype=np.float64)])
            out[held] += sums[ends] - sums[ends - lens]
            held.clear()

        size = 0
        for i, t in enumerate(texts):
            if len(t) > 4 * WINDOW:  # a very long text in overlapping windows
                whole = pad + t
                for k in range(0, len(t), WINDOW):
                    out[i] += self.bits(_grams(whole[k : k + WINDOW + ORDER])).sum(axis=0, dtype=np.float64)
                continue
            held.append(i)
            size += len(t)
            if size >= WINDOW:
                flush()
                size = 0
        if held:
            flush()
        return out


def _remainder(id_col: str):
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS, seed: int = 10) -> Model:
    """Learn the trees from about ``sample_docs`` documents a language: a
    seeded draw over all rows with a language and a crc32 remainder other
    than 0, by a share per language (one broadcast row each).  Byte grams are counted and summed by Spark; the driver gets the
    sums, bounded by the sample."""
    known = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.coalesce(_remainder("id"), F.lit(0)) != 0))
    share = known.groupBy("lang").agg((F.lit(float(sample_docs)) / F.count("*")).alias("share"))
    sample = known.withColumn("u", seeded(seed, "id")).join(F.broadcast(share), "lang").where("u < share").select("lang", "text")

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            for (lang, _), own in df.groupby(["lang", np.arange(len(df)) // 256]):
                g, n = np.unique(np.concatenate([_grams(b"\n" * ORDER + t.encode()) for t in own["text"]]), return_counts=True)
                yield pd.DataFrame({"lang": lang, "gram": g.astype(np.int64), "n": n})
        give_back()

    small_batches(docs.sparkSession)
    counts = sample.mapInPandas(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    return Model.fit(counts.toPandas())


def predict(docs: DataFrame, model: Broadcast, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns of every row with ``lang_pred``, ``score`` (the best
    language's share of the posterior under equal priors) and
    ``bits_per_byte``; only ``text_col`` is looked at."""

    def score(texts: list[str | None]) -> list:
        m: Model = model.value
        rows = [i for i, t in enumerate(texts) if t is not None and any(map(str.isalpha, t))] if m.langs else []
        lang, best, per_byte = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.full(len(texts), np.nan)
        if rows:
            whole = [texts[i].encode() for i in rows]
            bits = m.texts(whole)
            for i, k in zip(rows, bits.argmin(axis=1), strict=True):
                lang[i] = m.langs[k]
            best[rows] = 1 / np.exp2(np.maximum(bits.min(axis=1)[:, None] - bits, -1000)).sum(axis=1)
            per_byte[rows] = bits.min(axis=1) / [len(t) for t in whole]
        return [lang, best, per_byte]

    return with_computed(docs, keep, [text_col], {"lang_pred": "string", "score": "double", "bits_per_byte": "double"}, score)


def identify(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``held_out`` (not learned
    from), ``lang_pred``, ``score``, ``bits_per_byte``."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, sample_docs=sample_docs))
    out = predict(docs, model, ["doc_id"])
    return out.select("doc_id", F.coalesce(_remainder("doc_id") == 0, F.lit(False)).alias("held_out"), "lang_pred", "score", "bits_per_byte")


def keep_identified(docs: DataFrame, min_score: float = 0.5, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """The rows of ``docs``, with their own columns, whose language is known
    with a score of at least ``min_score``."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, sample_docs=sample_docs))
    own = docs.columns
    named = docs.toDF(*[f"d{i}" for i in range(len(own))])
    verdicts = predict(named, model, named.columns, text_col=f"d{own.index('text')}")
    known = verdicts.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score))
    return known.select(*named.columns).toDF(*own)
