"""Best-fit packing into several sequence lengths (operator 8).

A document longer than the largest capacity is cut into pieces of it, nothing
is dropped.  Pieces go to shards of bounded size by a seeded hash.  In a
shard, longest first, a piece goes into the open bin that it leaves the least
room in; if none has room, a bin of the least-cost size opens: its cost less
the worth of the room that later pieces can still fill.  At last each bin
shrinks to the smallest permitted length that holds its contents.

Cases: a document without words (null or empty text) gets one row without a
bin; rows that agree in id and size are numbered as copies and packed
separately, so a repeated id does not swell one shard; an empty table gives
an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import by_group, n_words, ticket, with_computed, written

#: Permitted sequence lengths, in words.
CAPACITIES = (512, 1024, 2048, 4096)
#: What a sequence costs besides its length, in words.
OVERHEAD = 64
#: Pieces a shard, about.
SHARD_PIECES = 50_000
SEED = 8


def best_fit(sizes: np.ndarray, capacities: tuple[int, ...] = CAPACITIES, overhead: int = OVERHEAD) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each piece, then capacity and contents of each bin.

    ``sizes`` are positive and at most the largest capacity.  Ties keep the
    given order.
    """
    caps = sorted(capacities)
    price = min((c + overhead) / c for c in caps)  # of a word of room in the cheapest size
    order = np.argsort(-sizes, kind="stable")
    later = int(sizes.sum())
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    opened: list[int] = []
    used: list[int] = []
    room: dict[int, list[int]] = {}  # open bins by the room they have left
    rooms = 0  # bit r is set if a bin has r words left
    for at in order:
        s = int(sizes[at])
        later -= s
        fits = rooms >> s
        if fits:
            r = s + (fits & -fits).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                rooms ^= 1 << r
        else:
            c = min((c for c in caps if c >= s), key=lambda c: (c + overhead - price * min(c - s, later), c))
            b, r = len(opened), c
            opened.append(c)
            used.append(0)
        bins[at], offsets[at] = b, used[b]
        used[b] += s
        if r > s:
            room.setdefault(r - s, []).append(b)
            rooms |= 1 << (r - s)
    held = np.array(used, np.int64)
    shrunk = np.array(caps, np.int64)[np.searchsorted(caps, held)]
    return bins, offsets, shrunk, held


def pieces(sized: DataFrame, ids: list[str], largest: int) -> DataFrame:
    """``ids, size, copy, piece, start, length`` of each piece; a size of 0 has
    a piece of length 0."""
    numbered = sized.groupBy(*ids, "size").agg(F.count("*").alias("n"))
    numbered = numbered.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    last = F.greatest(F.ceil(F.col("size") / F.lit(largest)) - 1, F.lit(0)).cast("int")
    cut = numbered.withColumn("piece", F.explode(F.sequence(F.lit(0), last)))
    start = F.col("piece").cast("long") * largest
    return cut.select(*ids, "size", "copy", "piece", start.alias("start"), F.least(F.lit(largest), F.col("size") - start).cast("long").alias("length"))


def pack_sizes(sized: DataFrame, ids: list[str], capacities: tuple[int, ...] = CAPACITIES, overhead: int = OVERHEAD, shard_pieces: int = SHARD_PIECES, seed: int = SEED) -> DataFrame:
    """Placement of every piece of ``sized`` (``ids`` and ``size``): ``ids, size,
    copy, piece, start, length, bin_id, position, capacity, bin_used``;
    ``bin_id`` is ``shard:bin``, positions are words from the bin's start."""
    cut = written(pieces(sized, ids, max(capacities)), "pieces")
    n = cut.where("length > 0").count()
    shards = max(1, -(-n // shard_pieces))
    order = [*ids, "size", "copy", "piece"]
    # ids pass through pandas as text, so that long ids next to nulls stay exact
    texts = cut.where("length > 0").withColumns({c: F.col(c).cast("string") for c in ids})
    dealt = texts.withColumn("shard", F.pmod(ticket(seed, *order), F.lit(shards))).repartition("shard").sortWithinPartitions("shard", *order)

    def fill(df: pd.DataFrame) -> Iterator[pd.DataFrame]:
        bins, offsets, capacity, used = best_fit(df["length"].to_numpy(), capacities, overhead)
        names = [f"{s}:{b}" for s, b in zip(df.pop("shard"), bins, strict=True)]
        yield df.assign(bin_id=names, position=offsets, capacity=capacity[bins], bin_used=used[bins])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return by_group(frames, ["shard"], fill)

    out = dealt.mapInPandas(run, ", ".join([f"{c} string" for c in ids] + ["size long, copy int, piece int, start long, length long, bin_id string, position long, capacity long, bin_used long"]))
    out = out.withColumns({c: F.col(c).cast(cut.schema[c].dataType) for c in ids})
    none = cut.where("length = 0").withColumns({"bin_id": F.lit(None).cast("string")} | {c: F.lit(None).cast("long") for c in ("position", "capacity", "bin_used")})
    return out.unionByName(none)


def pack(documents: DataFrame, **options) -> DataFrame:
    """``pack_sizes`` of the word counts of ``documents (doc_id, text)``."""
    return pack_sizes(documents.select("doc_id", n_words(F.col("text")).alias("size")), ["doc_id"], **options)


def _cut_text(largest: int):
    word = re.compile(r"[^\x20\x09-\x0D]+")

    def cut(texts: list[str | None], starts: list[int], lengths: list[int], sizes: list[int]) -> list:
        out = []
        for t, start, length, size in zip(texts, starts, lengths, sizes, strict=True):
            if t is None or size <= largest:
                out.append(t or "")
                continue
            at = [m.start() for m in word.finditer(t)] + [len(t)]
            out.append(t[at[start] if start else 0 : at[min(start + length, size)]])
        return [out]

    return cut


def sequences(documents: DataFrame, capacities: tuple[int, ...] = CAPACITIES, **options) -> DataFrame:
    """The packed sequences of ``documents (doc_id, text)``: ``bin_id``,
    ``capacity``, ``bin_used``, and in order of position ``doc_ids``,
    ``starts``, ``lengths`` and ``texts``.  A document's pieces, joined in
    order of ``starts``, are its text.  A bin holds a bounded number of words,
    so no row grows with the table.  Documents without words are in no bin."""
    docs = documents.select("doc_id", "text", F.md5(F.col("text").cast("binary")).alias("digest"), n_words(F.col("text")).alias("size"))
    ids = ["doc_id", "digest"]
    placed = pack_sizes(docs.select(*ids, "size"), ids, capacities, **options).where("length > 0")
    texts = docs.where("size > 0").groupBy(*ids).agg(F.first("text").alias("text"))  # equal rows once
    a, b = placed.alias("a"), texts.alias("b")
    joined = a.join(b, F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.digest") == F.col("b.digest"))).select("a.*", "b.text")
    keep = ["doc_id", "bin_id", "capacity", "bin_used", "position", "start", "length"]
    cut = with_computed(joined, keep, ["text", "start", "length", "size"], {"part": "string"}, _cut_text(max(capacities)))
    rows = F.array_sort(F.collect_list(F.struct("position", "doc_id", "start", "length", "part"))).alias("rows")
    return cut.groupBy("bin_id", "capacity", "bin_used").agg(rows).select(
        "bin_id", "capacity", "bin_used", F.col("rows.doc_id").alias("doc_ids"), F.col("rows.start").alias("starts"), F.col("rows.length").alias("lengths"), F.col("rows.part").alias("texts"))
