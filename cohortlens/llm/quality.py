"""Quality rules by hashed n-gram likelihood ratio (operator 1).

Word unigrams and bigrams are hashed into ``buckets`` cells.  Two multinomials
over the cells are estimated, one of the raw corpus (every document) and one
of trusted target documents, smoothed towards the raw one.  A document's
score is its log-likelihood ratio divided by its number of n-grams; it is kept
when it passes the base rules and its score reaches a threshold, which is set
on trusted documents that the target model never saw: ``slack`` spreads below
the score under which ``miss`` of them lie.

Cases: null text counts as empty and fails the base rules; a document without
words scores 0; rows with a null ``doc_id`` are scored like others and are
never trusted; repeated rows are judged alike; without any trusted document
every score is 0 and the base rules alone decide; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import seeded, with_computed, written
from cohortlens.operators.groups import exact_quantiles

#: Cells of the hashed multinomials.
BUCKETS = 1 << 17
#: Trusted documents that the target model is fitted on, at most about half of
#: this many and half of all: a seeded draw over all trusted rows.  The
#: threshold comes from all other trusted rows.
TRUSTED_DOCS = 20_000
#: Pseudo-count of the raw model in the target model.
SMOOTHING = 50_000.0
#: Share of trusted documents that lie below the low quantile, and how far
#: below it, in distances from the median to it, the threshold is set.
MISS, SLACK = 0.002, 1.0

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT = 50, 0.5


def word_ids(text: str) -> tuple[list[bytes], np.ndarray]:
    """The distinct words of a text and the position of each word in them."""
    order: dict[bytes, int] = {}
    ids = [order.setdefault(w, len(order)) for w in text.encode().split()]
    return list(order), np.array(ids, np.int64)


def grams(words: list[bytes], ids: np.ndarray, buckets: int) -> np.ndarray:
    """Cells of all unigrams and bigrams."""
    h = np.fromiter(map(crc32, words), np.uint64, len(words))[ids]
    pairs = (h[:-1] * np.uint64(0x9E3779B1) + h[1:] * np.uint64(0x85EBCA77)) >> np.uint64(13)
    return np.concatenate([h, pairs]).astype(np.int64) & (buckets - 1)


def repeat_words(ids: np.ndarray) -> int:
    """Words that lie in a 3-word window found twice or more."""
    if len(ids) < 4:
        return 0
    n = int(ids.max()) + 1
    pair = ids[:-1] * n + ids[1:]
    if n >= 1 << 20:  # keep the codes of windows within 63 bits
        pair = np.unique(pair, return_inverse=True)[1]
    _, inv, counts = np.unique(pair[:-1] * n + ids[2:], return_inverse=True, return_counts=True)
    at = np.flatnonzero(counts[inv] > 1)
    covered = np.zeros(len(ids), bool)
    for k in range(3):
        covered[at + k] = True
    return int(covered.sum())


def base_counts(text: str | None) -> tuple[list[int], list[bytes], np.ndarray]:
    """``[n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words]`` and the words."""
    text = text or ""
    words, ids = word_ids(text)
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    counts = [len(ids), len(text) - sum(map(text.count, SPACE)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeat_words(ids)]
    return counts, words, ids


def _fit(docs: DataFrame, half: DataFrame, buckets: int) -> np.ndarray:
    """The cells' log ratios.  Each task sums its documents' cells; Spark adds
    the sums up; the driver gets one row a cell."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((2, buckets), np.int64)
        for df in frames:
            for text, trusted in zip(df["text"], df["trusted"], strict=True):
                cells = grams(*word_ids(text or ""), buckets)
                np.add.at(total[0], cells, 1)
                if trusted:
                    np.add.at(total[1], cells, 1)
        at = np.flatnonzero(total[0])
        yield pd.DataFrame({"cell": at, "raw": total[0, at], "target": total[1, at]})

    marked = docs.join(F.broadcast(half.withColumn("trusted", F.lit(True))), "doc_id", "left").select("text", F.coalesce("trusted", F.lit(False)).alias("trusted"))
    sums = marked.mapInPandas(count, "cell long, raw long, target long").groupBy("cell").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()
    raw, target = np.zeros(buckets), np.zeros(buckets)
    raw[sums["cell"]], target[sums["cell"]] = sums["raw"], sums["target"]
    if not target.sum():
        return np.zeros(buckets)
    p_raw = (raw + 1) / (raw.sum() + buckets)
    p_target = (target + SMOOTHING * p_raw) / (target.sum() + SMOOTHING)
    return np.log(p_target / p_raw)


def judge(documents: DataFrame, labels: DataFrame, buckets: int = BUCKETS, trusted_docs: int = TRUSTED_DOCS, miss: float = MISS, slack: float = SLACK, seed: int = 1) -> DataFrame:
    """One row per row of ``documents (doc_id, text)``: the base counts,
    ``base_failed``, ``kept``, ``llr`` and ``threshold``.  ``labels (doc_id,
    quality, toxic)`` names the trusted documents: quality 1 and not toxic."""
    spark = documents.sparkSession
    docs = documents.select("doc_id", "text")
    trusted = labels.where((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    share = min(1.0, trusted_docs / max(1, trusted.count()))
    drawn = written(trusted.withColumn("u", seeded(seed, "doc_id")), "trusted")
    ratio = spark.sparkContext.broadcast(_fit(docs, drawn.where(F.col("u") < share / 2).select("doc_id"), buckets))

    def score(texts: list[str | None]) -> list:
        rows, llr = [], []
        for t in texts:
            counts, words, ids = base_counts(t)
            rows.append(counts)
            llr.append(float(ratio.value[grams(words, ids, buckets)].mean()) if len(ids) else 0.0)
        return [*np.array(rows, np.int64).reshape(-1, 5).T, llr]

    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    scored = with_computed(docs, ["doc_id"], ["text"], dict.fromkeys(names, "long") | {"llr": "double"}, score)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > int(100 * MAX_REPEAT) * F.col("n_words"))
    scored = written(scored.withColumn("base_failed", failed), "scored")

    unseen = drawn.where(F.col("u") >= share / 2).select("doc_id")
    held = scored.where(~F.col("base_failed")).join(unseen, "doc_id").select("llr")
    marks = exact_quantiles(held, [], "llr", {"low": miss, "middle": 0.5}).first()
    low, middle = (marks["low"], marks["middle"]) if marks else (0.0, 0.0)
    threshold = float(low - slack * (middle - low))
    return scored.withColumn("threshold", F.lit(threshold)).select("doc_id", *names, "base_failed", (~F.col("base_failed") & (F.col("llr") >= threshold)).alias("kept"), "llr", "threshold")
