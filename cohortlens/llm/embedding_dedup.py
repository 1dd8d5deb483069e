"""Near-duplicate vectors by spherical k-means cells (operator 3).

Equal vectors are folded into one class.  Spherical k-means, fitted per label
on a bounded sample, gives each class a home cell.  Two unit vectors of
cosine ``c`` are ``sqrt(2 - 2c)`` apart, so if they have different homes, one of
them lies within half of that of the plane between both cells: such a vector
also visits the other cell.  Comparing within cells, homes and visitors
together, therefore finds every link; a pair that meets in two cells counts
in the first.  Large cells are compared block by block.

Cases: vectors that are null, empty, zero, or hold null or non-finite values,
and vectors with a null label, link with nothing and are their own component;
vectors of different lengths never link; a null ``vec_id`` links with nothing
and is not kept; repeated rows count as separate vectors, linked with each
other; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import SLICE_ROWS, UnionFind, by_group, components, in_blocks, seeded, with_computed, written

COSINE = 0.98
#: Classes that a cell should hold, and most cells in all (their centres are
#: broadcast; beyond that cells get larger, which blocks bear).
CELL_ROWS, MAX_CELLS = 4000, 4096
#: Vectors a cell that k-means is fitted on, and its rounds.
SAMPLE_PER_CELL, ROUNDS = 30, 10
#: Classes a block.
BLOCK = 2000


def _units(vectors: list) -> tuple[list, list]:
    """Digest and unit vector (float64 bytes) of each usable vector."""
    digests, units = [], []
    for v in vectors:
        x = np.array([np.nan if e is None else e for e in v], np.float64) if v else np.zeros(0)
        top = np.abs(x).max() if len(x) else 0.0
        if not np.isfinite(top) or top == 0 or not np.isfinite(x).all():
            digests.append(None)
            units.append(None)
            continue
        digests.append(blake2b((x + 0.0).tobytes(), digest_size=16).hexdigest())
        x = x / top
        units.append((x / np.sqrt(x @ x)).tobytes())
    return digests, units


def _matrix(units: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(units), np.float64).reshape(len(units), -1)


def centres(sample: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Spherical k-means: farthest-first seeds, then rounds of assignment by
    cosine and renormalised means.  A cell that empties keeps its centre."""
    c = sample[:1]
    near = sample @ c[0]
    while len(c) < min(k, len(sample)) and near.min() < 1 - 1e-12:
        c = np.vstack([c, sample[near.argmin()]])
        near = np.maximum(near, sample @ c[-1])
    for _ in range(rounds):
        home = (sample @ c.T).argmax(axis=1)
        for i in range(len(c)):
            total = sample[home == i].sum(axis=0)
            norm = np.sqrt(total @ total)
            if norm > 1e-9:
                c[i] = total / norm
    return c


def _fit(classes: DataFrame, cell_rows: int, seed: int) -> dict[str, np.ndarray]:
    """Centres per kind (label and vector length)."""
    sizes = classes.groupBy("kind").agg(F.count("*").alias("members"))
    total = sizes.agg(F.sum("members")).first()[0] or 0
    rows = max(cell_rows, total / MAX_CELLS)
    wanted = sizes.withColumn("k", F.ceil(F.col("members") / F.lit(float(rows))).cast("int"))
    drawn = classes.join(wanted, "kind").where((F.col("k") > 1) & (seeded(seed, "node") < F.col("k") * SAMPLE_PER_CELL / F.col("members"))).select("kind", "k", "node", "unit")

    def fit(df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values("node")
        c = centres(_matrix(df["unit"]).copy(), int(df["k"].iloc[0]))
        return pd.DataFrame({"kind": df["kind"].iloc[0], "centres": [c.tobytes()], "cells": [len(c)]})

    fitted = drawn.groupBy("kind").applyInPandas(fit, "kind string, centres binary, cells int").toPandas()
    return {r.kind: np.frombuffer(r.centres, np.float64).reshape(r.cells, -1) for r in fitted.itertuples()}


def cells_of(units: np.ndarray, c: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """Home of each vector, and (vectors, cells) whether it visits a cell."""
    near = units @ c.T
    home = near.argmax(axis=1)
    gap = near[np.arange(len(units)), home][:, None] - near  # u . (c_home - c_cell)
    apart = np.sqrt(np.maximum(0, 2 - 2 * c @ c.T))[home]
    visits = gap <= reach * apart + 1e-9
    visits[np.arange(len(units)), home] = False
    return home, visits


def _compare(df: pd.DataFrame, cosine: float) -> Iterator[pd.DataFrame]:
    """Links of one pair of blocks of a cell, summed per class, and a forest
    of them."""
    left, right = df[df["blk"] == df["bi"].iloc[0]], df[df["blk"] == df["bj"].iloc[0]]
    same = df["bi"].iloc[0] == df["bj"].iloc[0]
    if left.empty or right.empty:
        return
    cell = int(df["cell"].iloc[0])
    found = _matrix(left["unit"]) @ _matrix(right["unit"]).T >= cosine
    if same:
        found = np.triu(found, 1)
    at_home = (left["home"].to_numpy() == cell, right["home"].to_numpy() == cell)
    found &= at_home[0][:, None] | at_home[1][None, :]
    i, j = np.nonzero(found)
    mixed = at_home[0][i] != at_home[1][j]
    if mixed.any():  # a pair that also meets in the visitor's own, earlier cell counts there
        for owner, guest, o, g, owns in ((left, right, i, j, at_home[0][i]), (right, left, j, i, at_home[1][j])):
            where = np.flatnonzero(mixed & owns)
            calls = {(r, c) for r in np.unique(o[where]) for c in owner["visits"].iat[r]}
            homes = guest["home"].to_numpy()
            again = [k for k in where if homes[g[k]] < cell and (o[k], homes[g[k]]) in calls]
            mixed[where] = False
            found[i[again], j[again]] = False
        i, j = np.nonzero(found)
    if not len(i):
        return
    nodes = np.concatenate([left["node"], right["node"]])
    copies = (left["n"].to_numpy(), right["n"].to_numpy())
    links = np.concatenate([found @ copies[1], copies[0] @ found])
    forest = UnionFind(len(nodes))
    at = len(left)
    both = np.arange(at if same else 0)  # then both halves hold the same classes
    forest.join_all(np.concatenate([i, both]), np.concatenate([j, both]) + at)
    some = np.flatnonzero(links > 0)
    yield pd.DataFrame({"node": nodes[some], "links": links[some], "root": nodes[forest.roots()[some]]})


def deduplicate(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = COSINE, cell_rows: int = CELL_ROWS, block: int = BLOCK, seed: int = 3) -> DataFrame:
    """One row per row: ``vec_id``, ``n_links``, ``component_id``, ``kept``."""
    spark = embeddings.sparkSession
    own = embeddings.select(F.col(id_col).alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).alias("v"))
    ready = with_computed(own, ["vec_id", "label"], ["v"], {"digest": "string", "unit": "binary"}, _units)
    kind = F.concat_ws(":", F.octet_length("unit").cast("string"), "label")
    usable = F.col("label").isNotNull() & F.col("vec_id").isNotNull() & F.col("digest").isNotNull()
    ready = written(ready.withColumns({"kind": F.when(usable, kind), "node": F.when(usable, F.concat_ws(":", "digest", kind))}), "vectors")
    classes = ready.where(F.col("node").isNotNull()).groupBy("node", "kind").agg(F.min("vec_id").alias("low"), F.count("*").alias("n"), F.first("unit").alias("unit"))
    classes = written(classes, "classes")

    fitted = spark.sparkContext.broadcast(_fit(classes, cell_rows, seed))
    reach = float(np.sqrt(2 - 2 * cosine)) / 2

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            for kind, part in df.groupby("kind", sort=False):
                c = fitted.value.get(kind)
                if c is None:  # one cell
                    yield part.assign(home=0, cell=0, visits=[[] for _ in range(len(part))])
                    continue
                for at in range(0, len(part), SLICE_ROWS):  # a few vectors against all centres at a time
                    some = part.iloc[at : at + SLICE_ROWS]
                    home, visits = cells_of(_matrix(some["unit"]), c, reach)
                    some = some.assign(home=home, visits=[np.flatnonzero(v).tolist() for v in visits])
                    yield some.assign(cell=home)
                    row, cell = np.nonzero(visits)
                    if len(row):
                        yield some.iloc[row].assign(cell=cell)

    placed = classes.select("kind", "node", "n", "unit").mapInPandas(assign, "kind string, node string, n long, unit binary, home int, cell int, visits array<int>")
    placed = written(placed, "cells")
    counts = placed.groupBy("kind", "cell").agg(F.count("*").alias("m")).where("m > 1")
    unit = ["kind", "cell", "bi", "bj"]
    dealt = in_blocks(placed, ["kind", "cell"], "node", counts, block).repartition(*unit).sortWithinPartitions(*unit)

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return by_group(frames, unit, lambda df: _compare(df, cosine))

    found = written(dealt.mapInPandas(compare, "node string, links long, root string"), "links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    component = components(found, "node", "root").withColumnRenamed("component", "part")
    known = classes.select("node", "low", "n").join(links, "node", "left").join(component, "node", "left").withColumn("part", F.coalesce("part", "node"))
    lowest = known.groupBy("part").agg(F.min("low").alias("component_id"))
    facts = known.join(lowest, "part").select("node", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    out = ready.select("vec_id", "node").join(facts, "node", "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"),
                      F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(False)).alias("kept"))


#: The query in DuckDB.
SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.98),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id, vec_id <= coalesce(low, vec_id) AS kept
FROM embeddings LEFT JOIN (SELECT a, COUNT(*) AS n FROM l GROUP BY a) x ON vec_id = x.a
  LEFT JOIN (SELECT a, MIN(b) AS low FROM r GROUP BY a) y ON vec_id = y.a
"""
