"""Helpers shared by the training-data operators: tables, scratch tables, seeded
order, linked components."""

from __future__ import annotations

import ctypes
import ctypes.util
import os
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.session import ensure_checkpoint_dir

#: A word, as every operator here counts them.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """The named columns of a given table; other columns are never read, so
    extra columns whose names clash with an operator's own are harmless."""
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return df.select(*cols) if cols else df


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder that ``spark.checkpoint.dir`` names."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}/{name}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read back: the work
    is done once, its lineage ends, and a lost executor loses nothing of it."""
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ticket(seed: int | str, *cols: Column | str) -> Column:
    """A repeatable 52-bit draw per row: the leading hex digits of an md5 of the
    seed and the columns as text (null: empty), so DuckDB can state the same."""
    own = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in cols]
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), *own).cast("binary")), 1, 13), 16, 10).cast("long")


def seeded(seed: int | str, *cols: Column | str) -> Column:
    """The ticket as a number in [0, 1)."""
    return ticket(seed, *cols) / F.lit(float(2**52))


def n_words(text: Column) -> Column:
    """Number of words of a whole text (null: 0), without Python."""
    pieces = F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", -1)
    edge = lambda i: F.when(F.element_at(pieces, i) == "", 1).otherwise(0)
    return F.when(F.size(pieces) == 1, 1 - edge(1)).otherwise(F.size(pieces) - edge(1) - edge(-1)).cast("long")


_ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()), "array<string>": pa.list_(pa.string())}


#: Rows of an Arrow batch that are Python objects at a time.
SLICE_ROWS = 256
#: Bytes of an Arrow batch, where the session sets none.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of whole texts by bytes: for each task the JVM
    holds a batch twice, and the worker once, outside the heap."""
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(limit, None) is None:
        spark.conf.set(limit, str(BATCH_BYTES))


def give_back() -> None:
    """Return memory that Arrow and the C library hold but no longer use: a
    worker lives on for the tasks of later stages."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.util.find_library("c")
    trim = getattr(ctypes.CDLL(libc), "malloc_trim", None) if libc else None
    if trim:
        trim(0)


def with_computed(df: DataFrame, keep: list[str], use: list[str], added: dict[str, str], make: Callable[..., list]) -> DataFrame:
    """``keep`` columns of ``df`` untouched, then the ``added`` ones (name to
    type), which ``make`` works out from the ``use`` columns' Python lists,
    one Arrow batch at a time.  Names are replaced on the way, so columns
    that share a name with another, or with an added one, do no harm."""
    own = df.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], *[F.col(c).alias(f"u{i}") for i, c in enumerate(use)])
    kept = [f.simpleString().split(":", 1) for f in own.schema.fields[: len(keep)]]
    kinds = [_ARROW[t] for t in added.values()]
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):  # few texts at a time are Python objects
                b = whole.slice(at, SLICE_ROWS)
                new = make(*[b.column(len(keep) + i).to_pylist() for i in range(len(use))])
                arrays = [b.column(i) for i in range(len(keep))] + [pa.array(x, t) for x, t in zip(new, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, [f"k{i}" for i in range(len(keep))] + [f"a{i}" for i in range(len(new))])
        whole = b = arrays = new = None
        give_back()

    schema = ", ".join([f"{n} {t}" for n, t in kept] + [f"a{i} {t}" for i, t in enumerate(added.values())])
    out = own.mapInArrow(run, schema)
    return out.toDF(*keep, *added)


#: Most rows of ids that are broadcast; a row takes some 60 bytes in memory.
SMALL_ROWS = 1_000_000


def if_small(ids: DataFrame) -> DataFrame:
    """``ids``, a written table of a few narrow columns, marked for broadcast
    if its counted rows are few, so that the texts it is joined with need no
    shuffle; beyond that Spark joins by shuffle, with the same result."""
    return F.broadcast(ids) if ids.count() <= SMALL_ROWS else ids


def by_group(frames: Iterator[pd.DataFrame], key: list[str], do: Callable[[pd.DataFrame], Iterator[pd.DataFrame] | None]) -> Iterator[pd.DataFrame]:
    """``do`` on each run of equal ``key`` in a partition sorted by it; groups
    may span Arrow batches."""
    held: list[pd.DataFrame] = []
    for df in frames:
        if df.empty:
            continue
        keys = df[key].to_numpy()
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        if held and (held[-1][key].to_numpy()[-1] != keys[0]).any():
            yield from do(pd.concat(held, ignore_index=True)) or ()
            held = []
        parts = np.split(np.arange(len(df)), cuts)
        for i, part in enumerate(parts):
            held.append(df.iloc[part])
            if i < len(parts) - 1:
                yield from do(pd.concat(held, ignore_index=True)) or ()
                held = []
    if held:
        yield from do(pd.concat(held, ignore_index=True)) or ()


def in_blocks(rows: DataFrame, group: list[str], node: str, counts: DataFrame, size: int) -> DataFrame:
    """Spread the all-against-all work of each group over tasks of bounded
    size: a group is dealt into blocks of about ``size`` rows by a hash of
    ``node``, and each pair of blocks ``(bi, bj)``, ``bi <= bj``, becomes a
    unit of work.  Adds ``blk`` (the row's block), ``bi`` and ``bj``; a row
    appears once for each unit that its block is part of.  ``counts`` has
    ``group`` and its number of rows, ``m``."""
    blocks = F.ceil(F.col("m") / F.lit(size)).cast("int")
    dealt = rows.join(counts, group).withColumn("nb", blocks).drop("m").withColumn("blk", F.pmod(F.hash(node), F.col("nb")))
    units = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1))).drop("nb")
    return units.withColumns({"bi": F.least("blk", "other"), "bj": F.greatest("blk", "other")}).drop("other")


class UnionFind:
    """Smallest-member union-find over the rows 0..n-1 of one block."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def find(self, i: int) -> int:
        p = self.parent
        while p[i] != i:
            p[i] = p[p[i]]
            i = p[i]
        return i

    def join(self, i: int, j: int) -> None:
        a, b = self.find(i), self.find(j)
        if a != b:
            self.parent[max(a, b)] = min(a, b)

    def join_all(self, rows: np.ndarray, cols: np.ndarray) -> None:
        """Join all listed pairs, the only ones of this structure, by repeated
        smallest-label passes."""
        p = self.parent
        while len(rows):
            low = np.minimum(p[rows], p[cols])
            old = p.copy()
            np.minimum.at(p, rows, low)
            np.minimum.at(p, cols, low)
            np.minimum.at(p, old[rows], low)
            np.minimum.at(p, old[cols], low)
            p[:] = p[p]
            if (p == old).all():
                break

    def roots(self) -> np.ndarray:
        p = self.parent
        while (p[p] != p).any():
            p = p[p]
        self.parent = p
        return p


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components of an edge table: ``(node, component)`` with the
    smallest node as component, for every node that has an edge.

    Alternates the large-star and small-star steps of Kiveris et al. (2014):
    joins and partial aggregates only, each step a written table, until no
    edge changes; the driver sees one sum a step.  Self-loops give their node
    its own component.  Null ends are dropped.
    """
    spark = edges.sparkSession
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull())
    pairs = written(pairs.distinct(), "pairs")

    def state(df: DataFrame) -> tuple:
        row = df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return tuple(row)

    def star(df: DataFrame, large: bool) -> DataFrame:
        """Large: link each larger neighbour to the smallest one; small: each
        smaller neighbour and the node itself."""
        both = df.union(df.select("v", "u")).where("u <> v") if large else df.where("u <> v")
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        joined = both.join(least, "u")
        if large:
            return joined.where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()
        down = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return down.union(least.select("u", F.col("m").alias("v"))).distinct()

    nodes = pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct()
    links, before = pairs.where("u <> v"), None
    while True:
        links = written(star(star(links, True), False), "links")
        now = state(links)
        if now == before:
            break
        before = now
    root = links.groupBy("u").agg(F.min("v").alias("component"))
    out = nodes.join(root, nodes.node == root.u, "left")
    return out.select("node", F.coalesce("component", "node").alias("component"))
