"""Spelling variants by bidirectional FM-index search schemes (operator 12).

Spark counts the words of all texts.  Two words one error apart agree exactly
in the first half of either or in the rest of it, so a search matches one half
exactly and extends across the other, allowing one error:

* *forward*: delimiter and first half exactly, then to the right;
* *backward*: second half and delimiter exactly, then to the left; finds whose
  first half is exact too are left to the forward search, so no pair is found
  twice.

The vocabulary is sorted by (length, word) for the forward search, by (length,
reversed word) for the backward one, and cut into shards of about
``SHARD_WORDS``.  All words that can share a half with a word lie next to each
other in that order, so a word visits the few shards that hold its half at its
own length, one less and one more.  A task indexes one shard at a time and
searches it by suffix-rank intervals.  A bidirectional index is one FM-index of
the delimited words read from left to right and one of them read from right to
left; as every search starts at a delimiter and keeps its direction, a shard
builds the one of the two that its searches move in.  Words that visit are read
in batches, and all searches of a batch take their steps together in numpy.

Cases: null and empty texts have no words; a null ``doc_id`` counts as an empty
one in the hash; repeated rows count each; ties of ``n`` go to the word that is
smallest in code-point order; an empty table gives an empty result; columns
other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import written

LEAST_LENGTH, LEAST_COUNT, RATIO, DAMAGED = 6, 5, 5, 199
#: Words a shard, and most shards (their first words are collected; beyond
#: that shards hold more words).
SHARD_WORDS, MAX_SHARDS = 20_000, 100_000
#: Words searched together; an interval of at most ``NARROW`` ranks is read
#: rank by rank for the symbols that can follow, a wider one symbol by symbol.
BATCH, NARROW = 8192, 48


# --- the vocabulary -----------------------------------------------------------


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``(word, n)`` of the distinct words, some of them damaged as the
    contract says, a written table."""
    # a run of at least the least length is matched from its start to its end, and damage only shortens
    run = F.explode(F.regexp_extract_all(F.col("text"), F.lit(f"[A-Za-zÀ-ÿ]{{{least_length},}}"), F.lit(0)))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), run.alias("run"))
    ascii_only = F.octet_length("run") == F.char_length("run")
    rows = rows.withColumn("run", F.when(ascii_only, F.lower("run")).otherwise(F.translate("run", ascii_uppercase, ascii_lowercase)))
    rows = rows.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = F.pmod(F.col("h"), F.char_length("run")).cast("int")
    damaged = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    words = rows.select(F.when(F.col("h") % DAMAGED == 0, damaged).otherwise(F.col("run")).alias("word"))
    counts = words.where(F.char_length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n"))
    return written(counts.where(F.col("n") >= least_count), "vocabulary")


# --- the index ------------------------------------------------------------------


class FMIndex:
    """Suffix ranks of a cyclic text of small integers: ``step`` prepends a
    symbol to the strings of an interval."""

    def __init__(self, text: np.ndarray):
        n = len(text)
        rank, k = np.unique(text, return_inverse=True)[1].astype(np.int64), 1
        order = np.argsort(rank, kind="stable")
        while k < 2 * n:
            key = rank * n + np.roll(rank, -k)
            order = np.argsort(key, kind="stable")
            new = np.zeros(n, np.int64)
            new[order[1:]] = np.cumsum(np.diff(key[order]) > 0)
            rank, k = new, 2 * k
            if rank[order[-1]] == n - 1:
                break
        self.size, self.order = n, order
        self.before = text[order - 1]
        # positions of each symbol in `before`, all in one sorted list: counting is searching
        at = np.argsort(self.before, kind="stable")
        self.places = self.before[at].astype(np.int64) * n + at

    def step(self, symbols: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        base = symbols.astype(np.int64) * self.size
        return np.searchsorted(self.places, base + lo), np.searchsorted(self.places, base + hi)

    def symbols(self, lo: np.ndarray, hi: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
        """The symbols (but the delimiter 0) that can be prepended, as (number
        of the interval, symbol) pairs."""
        width = hi - lo
        narrow = np.flatnonzero(width <= NARROW)
        w = width[narrow]
        owner = np.repeat(narrow, w)
        ranks = np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w) + np.repeat(lo[narrow], w)
        pairs = np.unique(owner * (top + 1) + self.before[ranks])
        wide = np.flatnonzero(width > NARROW)
        if len(wide):
            every = (wide[:, None] * (top + 1) + np.arange(1, top + 1)[None, :]).ravel()
            a, b = self.step(every % (top + 1), lo[every // (top + 1)], hi[every // (top + 1)])
            pairs = np.concatenate([pairs, every[b > a]])
        owner, symbol = pairs // (top + 1), pairs % (top + 1)
        real = symbol > 0
        return owner[real], symbol[real]


class Shard:
    """The words of a shard and the index of both reading directions."""

    def __init__(self, words: list[str], counts: list[int], backward: bool):
        # read in the direction of the search, words are in the order of their suffix ranks
        self.read = (lambda w: w[::-1]) if backward else (lambda w: w)
        pairs = sorted(zip(map(self.read, words), words, counts, strict=True))
        self.backward = backward
        self.words = np.array([p[1] for p in pairs], object)
        self.counts = np.array([p[2] for p in pairs], np.int64)
        letters = sorted(set("".join(words)))
        self.code = {c: i + 1 for i, c in enumerate(letters)}
        self.top = len(letters)
        # extending to the right prepends to the text read from right to left, and the reverse
        text = [0]
        for p in pairs:
            text.extend([self.code[c] for c in p[0]])
            text.append(0)
        reverse = np.array(text[:-1], np.int64)[::-1]
        self.index = FMIndex(np.ascontiguousarray(reverse))
        # the ranks of complete words ("delimiter, word, delimiter" read back) number them
        starts = np.cumsum([0] + [len(p[0]) + 1 for p in pairs])[:-1]
        rank_of = np.empty(len(reverse), np.int64)
        rank_of[self.index.order] = np.arange(len(reverse))
        ends = (starts + np.array([len(p[0]) + 1 for p in pairs])) % len(reverse)  # the delimiter behind each word
        self.word_at = np.full(len(reverse), -1, np.int64)
        self.word_at[rank_of[len(reverse) - 1 - ends]] = np.arange(len(pairs))

    def near(self, queries: list[str], halves: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (number of the query, number of the word) with exactly one
        error, in the part of the query behind its exact half."""
        read = [self.read(q) for q in queries]
        exact = np.array([len(q) - h if self.backward else h for q, h in zip(queries, halves, strict=True)])
        size = np.array([len(q) for q in read])
        width = size.max() + 1 if len(size) else 1
        codes = np.zeros((len(read), width), np.int64)  # the delimiter closes each word
        for i, q in enumerate(read):
            codes[i, : len(q)] = [self.code.get(c, -1) for c in q]
        lo, hi = np.zeros(len(read), np.int64), np.full(len(read), self.index.size, np.int64)
        lo, hi = self.index.step(np.zeros(len(read), np.int64), lo, hi)
        for k in range(int(exact.max()) if len(exact) else 0):
            on = np.flatnonzero((k < exact) & (hi > lo))
            lo[on], hi[on] = self._advance(codes[on, k], lo[on], hi[on])
        found_q, found_w = [], []
        # intervals without an error, one a query, and those with one, all at the same place of their query
        q0 = np.flatnonzero(hi > lo)
        place, lo, hi = exact[q0].copy(), lo[q0], hi[q0]
        err: dict[str, np.ndarray] = {k: np.zeros(0, np.int64) for k in ("q", "place", "lo", "hi")}
        while len(q0) or len(err["q"]):
            # 1. errors that start here
            new = []
            if len(q0):
                inside = place < size[q0]
                new.append((q0[inside], place[inside] + 1, lo[inside], hi[inside]))  # the query's symbol is left out
                owner, symbol = self.index.symbols(lo, hi, self.top)
                a, b = self.index.step(symbol, lo[owner], hi[owner])
                new.append((q0[owner], place[owner], a, b))  # a symbol more
                other = (place[owner] < size[q0[owner]]) & (symbol != codes[q0[owner], np.minimum(place[owner], width - 1)])
                new.append((q0[owner][other], place[owner][other] + 1, a[other], b[other]))  # another symbol
            # 2. those with an error go on exactly, up to and with the delimiter
            states = [np.concatenate([err[k], *[n[i] for n in new]]) for i, k in enumerate(("q", "place", "lo", "hi"))]
            eq, ep, el, eh = states
            el, eh = self._advance(codes[eq, ep], el, eh)
            alive = eh > el
            eq, ep, el, eh = eq[alive], ep[alive] + 1, el[alive], eh[alive]
            ended = ep > size[eq]
            found_q.append(eq[ended])
            found_w.append(self.word_at[el[ended]])
            err = {"q": eq[~ended], "place": ep[~ended], "lo": el[~ended], "hi": eh[~ended]}
            # 3. those without one, too
            on = place < size[q0]
            q0, place, lo, hi = q0[on], place[on], lo[on], hi[on]
            lo, hi = self._advance(codes[q0, place], lo, hi)
            alive = hi > lo
            q0, place, lo, hi = q0[alive], place[alive] + 1, lo[alive], hi[alive]
        pairs = np.unique(np.concatenate(found_q or [np.zeros(0, np.int64)]) * max(1, len(self.words)) + np.concatenate(found_w or [np.zeros(0, np.int64)]))
        return pairs // max(1, len(self.words)), pairs % max(1, len(self.words))

    def _advance(self, symbols: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.index.step(np.maximum(symbols, 0), lo, hi)
        return a, np.where(symbols < 0, a, b)  # a letter that no word of the shard has

    def answers(self, queries: list[str], halves: list[int]) -> pd.DataFrame:
        """Per query with near words here: how many, and the best of them."""
        q, w = self.near(queries, halves)
        words = np.array(queries, object)
        same = words[q] == self.words[w]  # a query is not its own near word
        if self.backward:
            half = np.array(halves)
            same |= np.array([a[:h] == b[:h] for a, b, h in zip(words[q], self.words[w], half[q], strict=True)], bool)
        q, w = q[~same], w[~same]
        found = pd.DataFrame({"word": words[q], "near": self.words[w], "near_n": self.counts[w]})
        found = found.sort_values(["word", "near_n", "near"], ascending=[True, False, True], kind="stable")
        best = found.groupby("word", sort=False).agg(n_near=("near", "size"), near=("near", "first"), near_n=("near_n", "first"))
        return best.reset_index()[["word", "n_near", "near", "near_n"]]


# --- the jobs ---------------------------------------------------------------------


def _shards(vocab: DataFrame, backward: bool, n: int) -> DataFrame:
    """The vocabulary with the number of each word's shard, a written table."""
    key = F.reverse("word") if backward else F.col("word")
    keyed = vocab.select(F.char_length("word").alias("len"), key.alias("key"), "word", "n")
    return written(keyed.repartitionByRange(n, "len", "key").withColumn("shard", F.spark_partition_id()), "shards")


def _visits(vocab: DataFrame, shards: DataFrame, backward: bool, least_length: int) -> DataFrame:
    """``(shard, word)``: the shards where a word's exact half can be found."""
    firsts = sorted((r["low"]["len"], r["low"]["key"], r["shard"]) for r in shards.groupBy("shard").agg(F.min(F.struct("len", "key")).alias("low")).collect())
    lows, numbers = [f[:2] for f in firsts], [f[2] for f in firsts]

    def visit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            words, to = [], []
            for w in df["word"]:
                half = len(w) // 2
                head = w[half:][::-1] if backward else w[:half]
                seen: set[int] = set()
                for m in range(max(least_length, len(w) - 1), len(w) + 2):
                    a = max(0, bisect_right(lows, (m, head)) - 1)
                    b = max(0, bisect_right(lows, (m, head + "\U0010ffff")) - 1)
                    seen.update(range(a, b + 1))
                words += [w] * len(seen)
                to += [numbers[i] for i in seen]
            yield pd.DataFrame({"shard": to, "word": words})

    return vocab.select("word").mapInPandas(visit, "shard int, word string")


def _search(frames: Iterator[pd.DataFrame], backward: bool, batch: int) -> Iterator[pd.DataFrame]:
    """Rows sorted by (shard, visiting): a shard's own words, then its visitors."""
    shard, own, index = None, [], None
    for df in frames:
        for number, rows in df.groupby("shard", sort=False):
            if number != shard:
                shard, own, index = number, [], None
            mine, visiting = rows[~rows["visiting"]], rows[rows["visiting"]]
            if len(mine):
                own.append(mine)
            if not len(visiting) or not own:
                continue
            if index is None:
                words = pd.concat(own)
                index = Shard(words["word"].tolist(), words["n"].tolist(), backward)
            for at in range(0, len(visiting), batch):
                words = visiting["word"].iloc[at : at + batch].tolist()
                yield index.answers(words, [len(w) // 2 for w in words])


def near_words(vocab: DataFrame, least_length: int = LEAST_LENGTH, shard_words: int = SHARD_WORDS, batch: int = BATCH) -> DataFrame:
    """``(word, n_near, near, near_n)`` of words with near words: how many, and
    the one of largest ``n``, then smallest.  ``vocab (word, n)`` is a written
    table."""
    size = vocab.count()
    n = min(MAX_SHARDS, max(1, -(-size // shard_words)))
    found = None
    for backward in (False, True):
        shards = _shards(vocab, backward, n)
        visits = _visits(vocab, shards, backward, least_length)
        rows = shards.select("shard", F.lit(False).alias("visiting"), "word", "n").unionByName(visits.withColumns({"visiting": F.lit(True), "n": F.lit(0).cast("long")}))
        rows = rows.repartition("shard").sortWithinPartitions("shard", "visiting")
        part = rows.mapInPandas(lambda frames, b=backward: _search(frames, b, batch), "word string, n_near long, near string, near_n long")
        found = part if found is None else found.unionByName(part)
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))


def variants(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, ratio: int = RATIO, shard_words: int = SHARD_WORDS, batch: int = BATCH) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of every word of ``docs
    (doc_id, text)``."""
    vocab = vocabulary(docs, least_length, least_count)
    all_words = vocab.join(near_words(vocab, least_length, shard_words, batch), "word", "left")
    has = F.col("near_n") >= ratio * F.col("n")
    words = written(all_words.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(has, F.col("near")).alias("form"), F.when(has, F.col("near_n")).alias("form_n")), "forms")
    # a form has at least `ratio` times the count, so chains are short; following what has been followed halves them
    roots = words.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        roots = written(roots, "roots")
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = roots.join(on, "root", "left")
        if further.where("next is not null").isEmpty():
            break
        roots = further.select("word", F.coalesce("next", "root").alias("root"))
    return words.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


SQL = r"""
WITH RECURSIVE table_256 AS (
  SELECT list(list_reduce(list_concat([i::UBIGINT], [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]),
                          lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END) ORDER BY i) AS crc
  FROM range(256) r(i)),
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id,
         translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents),
bytes AS (
  SELECT run, list_transform(range(length(hex(encode(id || ':' || run))) // 2),
                             lambda k: ('0x' || substr(hex(encode(id || ':' || run)), 2 * k + 1, 2))::UBIGINT) AS b
  FROM runs WHERE length(run) >= 6),
hashed AS (
  SELECT run, xor(list_reduce(list_concat([4294967295::UBIGINT], b),
                              lambda c, x: xor(c >> 8, crc[(xor(c & 255, x) + 1)::BIGINT])), 4294967295::UBIGINT) AS h
  FROM bytes, table_256),
words AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word
  FROM hashed),
vocab AS (SELECT word, count(*) AS n FROM words WHERE length(word) >= 6 GROUP BY word HAVING count(*) >= 5),
cut AS (SELECT word, n, p, substr(word, 1, p) || substr(word, p + 2) AS rest FROM vocab, range(30) r(p) WHERE p < length(word)),
near AS (
  SELECT a.word, b.word AS other FROM cut a JOIN cut b ON a.p = b.p AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word FROM cut a JOIN vocab b ON a.rest = b.word
  UNION SELECT b.word, a.word FROM cut a JOIN vocab b ON a.rest = b.word),
best AS (
  SELECT v.word, v.n, count(x.word) AS n_near, first(x.word ORDER BY x.n DESC, x.word) AS top, max(x.n) AS top_n
  FROM vocab v LEFT JOIN near ON near.word = v.word LEFT JOIN vocab x ON x.word = near.other GROUP BY v.word, v.n),
forms AS (SELECT word, n, n_near, CASE WHEN top_n >= 5 * n THEN top END AS form, CASE WHEN top_n >= 5 * n THEN top_n END AS form_n FROM best),
chain AS (
  SELECT word, word AS root FROM forms
  UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL),
ends AS (SELECT c.word, c.root FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NULL)
SELECT f.word, f.form, e.root, f.n, f.n_near, f.form_n FROM forms f JOIN ends e ON e.word = f.word
"""
