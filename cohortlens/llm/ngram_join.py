"""N-gram Jaccard join by chosen paths (operator 6).

A document is the set of its five-word shingles.  Documents with equal sets
form a class, which goes on as one.  In each of several runs the sets descend
a tree: at a node every set goes on to the buckets of its ``BRANCH`` tokens
that come first in a seeded order of that run and level, so two sets meet
where they share a sampled token.  Buckets of up to ``LEAF`` classes are
compared by brute force.  Larger ones are first held against a few leaders:
rows that fold onto the same leader are connected by it and need no comparing
with each other, so a group of near copies costs what it has rows.  Buckets
that do not fold split again, unless splitting does not shrink them, which are
then compared block by block.
The number of runs follows from the target recall at the threshold.

Comparing in a bucket means sizes and 128-bit minhash sketches, which leaves
candidate links; their connected groups are then settled exactly: all sets of
a group meet once, in blocks, and intersections are counted.  No pair is ever
a row: a block gives each class its number of links and a spanning forest.

Tokens are 64-bit hashes of shingles.  Texts of one to four words have one
shingle, all of them.

Cases: documents without words (null or empty text) link with nothing; equal
texts link with each other, repeated rows included; null ids take part and
come last when a group's document is chosen; an empty table gives an empty
result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from hashlib import blake2b
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from cohortlens.llm.common import UnionFind, by_group, components, if_small, in_blocks, with_computed, written

WORDS = 5
#: Jaccard threshold as a fraction.
SHARE = (4, 5)
RECALL = 0.999999
#: Tokens that a set samples for its paths, and how many of them it follows.
SAMPLE, BRANCH = 64, 3
#: Classes that a bucket may hold to be compared, levels of splitting, and the
#: share of its parent above which a bucket counts as not shrinking.
LEAF, DEPTH, DENSE = 400, 8, 0.6
#: Leaders of a large bucket that its rows are first held against.
LEADERS = 4
#: Classes in a block of a bucket, and of a group that is settled.
BUCKET_BLOCK, GROUP_BLOCK = 2000, 800
#: Equal bits of 128 from which a pair is a candidate.  At a similarity of 0.8
#: 115.2 are expected, 3.4 the deviation.
BITS = 94

_RNG = np.random.default_rng(20)
_ODD = _RNG.integers(1, 1 << 63, WORDS, np.uint64) | np.uint64(1)
_MIN_MULT = _RNG.integers(1, 1 << 32, 128, np.uint32) | np.uint32(1)
_MIN_ADD = _RNG.integers(0, 1 << 32, 128, np.uint32)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def runs_for(recall: float = RECALL, branch: int = BRANCH, share: tuple[int, int] = SHARE) -> int:
    """Runs until a pair at the threshold has met in a bucket with ``recall``:
    in one run two sets share none of their first tokens with a probability
    of about ``(1 - J)**branch`` a level; two levels are reckoned with.

    All runs draw from one sample of a set, and sampled tokens are less alike
    where one set contains the other, so what a pair at exactly 0.8 loses was
    measured: with the default runs, after 1, 2, 4 and 6 levels, 4e-7, 1e-6, 6e-6
    and 2e-5 for sets of equal size, 5e-6, 3e-5, 2e-4 and 7e-4 for a set and one
    with a quarter more.  More similar pairs lose less; a higher ``recall``
    gives more runs."""
    miss = 1 - (1 - (1 - share[0] / share[1]) ** branch) ** 2
    return max(1, math.ceil(math.log(1 - recall) / math.log(miss)))


def shingles(text: str | None) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    words = (text or "").encode().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(WORDS, len(h))
    n = len(h) - width + 1
    total = np.full(n, width, np.uint64)
    for k in range(width):
        total = total + h[k : k + n] * _ODD[k]
    return np.unique(_mix(total))


def digest(tokens: np.ndarray) -> bytes | None:
    return blake2b(tokens.tobytes(), digest_size=16).digest() if len(tokens) else None


def minhash_bits(tokens: np.ndarray) -> bytes:
    """128 bits: the lowest bit of each of 128 minhashes."""
    low = (tokens & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    best = np.full(128, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(low), 4096):
        v = low[i : i + 4096, None] * _MIN_MULT + _MIN_ADD
        np.minimum(best, (v ^ (v >> np.uint32(15))).min(axis=0), out=best)
    bit = (best * np.uint32(0x9E3779B1)) >> np.uint32(31)
    return np.packbits(bit.astype(np.uint8)).tobytes()


def picks(sample: np.ndarray, run: int, level: int, branch: int = BRANCH) -> np.ndarray:
    """The tokens of a sample that come first in the order of a run and level."""
    order = _mix(sample ^ _mix(np.array([run * 1000 + level + 1], np.uint64)))
    return sample[np.argsort(order, kind="stable")[:branch]]


def _sketch(texts: list[str | None]) -> list:
    nodes, sizes, samples, bits = [], [], [], []
    for t in texts:
        tokens = shingles(t)
        nodes.append(digest(tokens))
        sizes.append(len(tokens))
        samples.append(tokens[:SAMPLE].astype(np.int64).tobytes() if len(tokens) else None)
        bits.append(minhash_bits(tokens) if len(tokens) else None)
    return [nodes, sizes, samples, bits]


def _paths(classes: DataFrame, runs: int, level: int) -> DataFrame:
    """Rows of the next level: ``classes (node, n, bits, sample)`` give the
    first level, with ``path``, ``run`` and ``parent`` (the size of the bucket
    that splits) the level below.  Tokens of the path so far are not used again,
    as all sets of the bucket share them."""
    first = "path" not in classes.columns

    def descend(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (f.slice(at, 1024) for f in frames for at in range(0, f.num_rows, 1024)):
            out: dict[str, list] = {k: [] for k in ("row", "run", "path", "used")}
            cols = {k: b.column(k).to_pylist() for k in (["sample"] if first else ["sample", "path", "run", "used"])}
            for i, raw in enumerate(cols["sample"]):
                sample = np.frombuffer(raw, np.uint64)
                for run in range(runs) if first else [cols["run"][i]]:
                    used = b"" if first else cols["used"][i]
                    free = sample if first else sample[~np.isin(sample, np.frombuffer(used, np.uint64))]
                    for t in picks(free, run, level):
                        step = np.array([(0 if first else cols["path"][i]) & 0xFFFFFFFFFFFFFFFF, int(t), run], np.uint64)
                        out["row"].append(i)
                        out["run"].append(run)
                        out["path"].append(xxh3_64_intdigest(step.tobytes()) - (1 << 63))
                        out["used"].append(used + t.tobytes())
            at = pa.array(out["row"], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("node").take(at), b.column("n").take(at), b.column("bits").take(at), pa.array(out["run"], pa.int32()), pa.array(out["path"], pa.int64()), pa.array(out["used"], pa.binary()),
                 (pa.nulls(len(at), pa.int64()) if first else b.column("parent").take(at))], ["node", "n", "bits", "run", "path", "used", "parent"])

    return classes.mapInArrow(descend, "node binary, n int, bits binary, run int, path long, used binary, parent long")


def _bit_matrix(bits: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(bits), np.uint64).reshape(len(bits), 2)


def _alike(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Whether sizes and sketches allow the threshold, broadcasting."""
    equal = 128 - np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)
    return (equal >= BITS) & (np.minimum(na, nb) * SHARE[1] >= np.maximum(na, nb) * SHARE[0])


def _bucket(df: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Candidate links of one pair of blocks of a bucket, as a forest."""
    left, right = df[df["blk"] == df["bi"].iloc[0]], df[df["blk"] == df["bj"].iloc[0]]
    if left.empty or right.empty:
        return
    a, b = _bit_matrix(left["bits"]), _bit_matrix(right["bits"])
    na, nb = left["n"].to_numpy(), right["n"].to_numpy()
    ids: dict[bytes, int] = {}
    own = [np.array([ids.setdefault(x, len(ids)) for x in side["node"]], np.int64) for side in (left, right)]
    forest, rows, cols = UnionFind(len(ids)), [], []
    for i in range(0, len(a), 128):
        x, y = np.nonzero(_alike(a[i : i + 128, None], b[None], na[i : i + 128, None], nb[None]))
        rows.append(own[0][x + i])
        cols.append(own[1][y])
    rows, cols = np.concatenate(rows), np.concatenate(cols)
    keep = rows != cols
    forest.join_all(rows[keep], cols[keep])
    roots, names = forest.roots(), np.array(list(ids), object)
    some = np.unique(np.concatenate([rows[keep], cols[keep]]))
    if len(some):
        yield pd.DataFrame({"node": names[some], "root": names[roots[some]]})


def _small(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Candidate links of whole buckets, given sorted by path.  Buckets of two
    classes, most of them, are compared all at once."""

    def whole(df: pd.DataFrame) -> Iterator[pd.DataFrame]:
        keys = df["path"].to_numpy()
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        sizes = np.diff(np.r_[starts, len(keys)])
        bits, n, nodes = _bit_matrix(df["bits"]), df["n"].to_numpy(), df["node"].to_numpy()
        two = starts[sizes == 2]
        two = two[_alike(bits[two], bits[two + 1], n[two], n[two + 1])]
        two = two[nodes[two] != nodes[two + 1]]
        yield pd.DataFrame({"node": nodes[two], "root": nodes[two + 1]})
        for s, m in zip(starts[sizes > 2], sizes[sizes > 2], strict=True):
            yield from _bucket(df.iloc[s : s + m].assign(blk=0, bi=0, bj=0))

    held: pd.DataFrame | None = None
    for df in frames:
        df = df if held is None else pd.concat([held, df], ignore_index=True)
        keys = df["path"].to_numpy()
        cut = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
        held = df.iloc[cut:]
        if cut:
            yield from whole(df.iloc[:cut].reset_index(drop=True))
    if held is not None and len(held):
        yield from whole(held.reset_index(drop=True))


def _heads(hot: DataFrame) -> DataFrame:
    """``LEADERS`` classes of each bucket, drawn by seeded hashes of the node."""
    return hot.groupBy("path").agg(*[F.min_by(F.struct("node", "n", "bits"), F.xxhash64("node", F.lit(k))).alias(f"h{k}") for k in range(LEADERS)])


def _folded(hot: DataFrame, heads: DataFrame) -> DataFrame:
    """``hot`` rows with the first leader of their bucket that they are a
    candidate link of (``lead``, its node ``head``), or -1."""
    own = hot.columns
    led = hot.join(heads, "path", "left")
    flat = [F.col(f"h{k}.{c}").alias(f"{c}{k}") for k in range(LEADERS) for c in ("node", "n", "bits")]

    def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            bits, n = _bit_matrix(df["bits"]), df["n"].to_numpy()
            lead, head = np.full(len(df), -1), np.full(len(df), None, object)
            for k in range(LEADERS):
                take = (lead < 0) & _alike(bits, _bit_matrix(df[f"bits{k}"]), n, df[f"n{k}"].to_numpy())
                lead[take], head[take] = k, df[f"node{k}"].to_numpy()[take]
            yield df[own].assign(lead=lead, head=head)

    kinds = ", ".join(f.simpleString().replace(":", " ", 1) for f in hot.schema.fields)
    return led.select(*own, *flat).mapInPandas(fold, f"{kinds}, lead int, head binary")


def _units(stay: DataFrame, block: int) -> DataFrame:
    """The pairs of blocks of each bucket that still need comparing: rows of
    the bucket's largest fold are linked through its leader already, so only
    the other rows (``rest``) meet each other and all of that fold."""
    own = F.pmod(F.hash("node"), F.greatest(F.when(F.col("same"), F.col("nm")).otherwise(F.col("nr")), F.lit(1)))
    dealt = stay.withColumns({"nm": F.ceil(F.col("most") / block).cast("int"), "nr": F.ceil(F.col("rest") / block).cast("int"), "same": F.col("lead") == F.col("major")})
    dealt = dealt.where("nr > 0").withColumn("blk", F.when(F.col("same"), F.col("nr")).otherwise(0) + own)
    last = F.when(F.col("same"), F.col("nr")).otherwise(F.col("nr") + F.col("nm")) - 1
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    return dealt.select("path", "node", "n", "bits", "blk", F.least("blk", "other").alias("bi"), F.greatest("blk", "other").alias("bj"))


def candidate_links(classes: DataFrame, runs: int, leaf: int = LEAF, depth: int = DEPTH, block: int = BUCKET_BLOCK) -> DataFrame:
    """``(node, root)`` forest edges of the candidate links of ``classes (node,
    n, bits, sample)``, level by level.

    Rows of a large bucket are first held against a few leaders of it.  Where
    all but ``leaf`` rows fold onto one leader (a group of near copies) the
    bucket ends there: the rest is compared with all its rows, the fold not
    with itself, which its leader connects.  Work and shuffle are thus in
    proportion to the group."""
    found: list[DataFrame] = []
    rows = written(_paths(classes, runs, 0), "paths")
    for level in range(1, depth + 1):
        # only the large buckets are named; the rest meet in one shuffle
        large = written(rows.groupBy("path").agg(F.count("*").alias("m"), F.max("parent").alias("parent")).where(F.col("m") > leaf), "large")
        names = if_small(large.select("path"))
        small = rows.join(names, "path", "left_anti").select("path", "node", "n", "bits")
        small = small.repartition("path").sortWithinPartitions("path")
        found.append(written(small.mapInPandas(_small, "node binary, root binary"), "candidates"))
        if large.isEmpty():
            break
        hot = rows.join(names, "path", "left_semi").select("path", "node", "n", "bits", "run", "used")
        folded = written(_folded(hot, if_small(written(_heads(hot), "heads"))), "folded")
        found.append(folded.where("lead >= 0 and node <> head").select("node", F.col("head").alias("root")))
        kinds = folded.groupBy("path", "lead").agg(F.count("*").alias("c")).groupBy("path")
        # a bucket without any fold has nothing in common: all its rows are the rest
        top = kinds.agg(F.max(F.when(F.col("lead") >= 0, F.struct("c", F.col("lead").alias("major")))).alias("top"))
        facts = large.join(top, "path").select("path", "m", "parent", F.coalesce("top.major", F.lit(-2)).alias("major"), F.coalesce("top.c", F.lit(0)).alias("most"))
        facts = facts.withColumn("rest", F.col("m") - F.col("most"))
        over = F.lit(level == depth) | (F.col("rest") <= leaf) | (F.col("m") > F.coalesce("parent", F.lit(1 << 62)) * DENSE)
        facts = written(facts.withColumn("over", over), "buckets")
        known = if_small(facts)
        unit = ["path", "bi", "bj"]
        dealt = _units(folded.join(known.where("over and rest > 0"), "path"), block).repartition(*unit).sortWithinPartitions(*unit)
        found.append(written(dealt.mapInPandas(lambda f: by_group(f, ["path", "bi", "bj"], _bucket), "node binary, root binary"), "candidates"))
        if facts.where("not over").isEmpty():
            break
        go = folded.join(known.where("not over").select("path", "m"), "path")
        below = go.select("node", "n", "bits", "path", "run", "used", F.col("m").alias("parent")).join(classes.select("node", "sample"), "node")
        rows = written(_paths(below, runs, level), "paths")
    out = found[0]
    for f in found[1:]:
        out = out.union(f)
    return out


def _settle(df: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Exact links of one pair of blocks of a group, summed per class, and a
    forest of them.  Of classes that came as visitors from the size band above
    only links with the others count here."""
    df = df.drop_duplicates(["node", "blk"])
    left, right = df[df["blk"] == df["bi"].iloc[0]], df[df["blk"] == df["bj"].iloc[0]]
    same = df["bi"].iloc[0] == df["bj"].iloc[0]
    homes = left["home"].to_numpy()[:, None] | right["home"].to_numpy()[None, :] if len(left) and len(right) else np.zeros((0, 0), bool)
    if not homes.any():
        return
    sets = [np.frombuffer(x, np.uint64) for x in (left["tokens"] if same else pd.concat([left["tokens"], right["tokens"]]))]
    inter = overlaps(sets, len(left), same)
    na, nb = left["n"].to_numpy()[:, None], right["n"].to_numpy()[None, :]
    found = inter * sum(SHARE) >= SHARE[0] * (na + nb)
    found &= homes
    if same:
        found = np.triu(found, 1)
    i, j = np.nonzero(found)
    if not len(i):
        return
    nodes = np.concatenate([left["node"], right["node"]])
    copies = (left["copies"].to_numpy(), right["copies"].to_numpy())
    links = np.concatenate([found @ copies[1], copies[0] @ found])
    forest, at = UnionFind(len(nodes)), len(left)
    both = np.arange(at if same else 0)  # then both halves hold the same classes
    forest.join_all(np.concatenate([i, both]), np.concatenate([j, both]) + at)
    some = np.flatnonzero(links > 0)
    yield pd.DataFrame({"node": nodes[some], "links": links[some], "root": nodes[forest.roots()[some]]})


def overlaps(sets: list[np.ndarray], at: int, same: bool) -> np.ndarray:
    """Intersection sizes of the sets before ``at`` with those from it on (or
    with themselves), by products of incidence matrices over slices of the
    tokens that occur in more than one set."""
    m = len(sets)
    if m == 2:  # the common case
        n = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([[len(sets[0]), n], [n, len(sets[1])]]) if same else np.array([[n]])
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    _, inv, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.cumsum(counts > 1) - 1
    keep = counts[inv] > 1
    row, col = owner[keep], shared[inv[keep]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    total, width = np.zeros((at, at if same else m - at), np.float32), 4096
    for s in range(0, int(col[-1]) + 1 if len(col) else 0, width):
        a, b = np.searchsorted(col, [s, s + width])
        x = np.zeros((m, width), np.float32)
        x[row[a:b], col[a:b] - s] = 1
        total += x[:at] @ (x if same else x[at:]).T
    return np.rint(total).astype(np.int64)


def _tokens(texts: list[str | None], nodes: list[bytes]) -> list:
    out = []
    for t, node in zip(texts, nodes, strict=True):
        tokens = shingles(t)
        out.append(tokens.tobytes() if digest(tokens) == node else None)
    return [out]


def settled_links(docs: DataFrame, groups: DataFrame, block: int = GROUP_BLOCK) -> DataFrame:
    """Exact links within candidate groups: ``(node, links, root)``.  ``groups
    (node, group, rep, n, copies)`` names a document of each class, whose text
    is shingled again.  A group of more than ``block`` classes is compared by
    bands of set size, each with itself and the band above, as a similarity of
    0.8 allows no more, and each band by blocks."""
    sizes = groups.groupBy("group").agg(F.count("*").alias("m"))
    # a band is a little wider than the threshold's ratio of sizes
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(math.log(1.01 * SHARE[1] / SHARE[0])))
    spread = groups.join(sizes, "group").withColumn("at", F.when(F.col("m") > block, band).otherwise(F.lit(0)))
    spread = spread.withColumn("band", F.explode(F.when(F.col("m") > block, F.array(F.col("at"), F.col("at") - 1)).otherwise(F.array(F.col("at")))))
    spread = written(spread.select("node", "rep", "n", "copies", "group", "band", (F.col("band") == F.col("at")).alias("home")), "bands")
    # bands of visitors only, or of one class, have nothing to compare
    counts = spread.groupBy("group", "band").agg(F.count("*").alias("m"), F.max("home").alias("any")).where("m > 1 and any").drop("any")
    unit = ["group", "band", "bi", "bj"]
    units = if_small(written(in_blocks(spread, ["group", "band"], "node", counts, block), "units"))
    reps = if_small(written(spread.select("node", "rep").distinct(), "reps")).alias("r")
    d = docs.select(F.col("doc_id").alias("rep"), "text").alias("d")
    texts = reps.join(d, F.col("r.rep").eqNullSafe(F.col("d.rep"))).select("r.node", "d.text")
    sets = with_computed(texts, ["node"], ["text", "node"], {"tokens": "binary"}, _tokens).where("tokens is not null")
    dealt = units.join(sets, "node").select(*unit, "blk", "node", "n", "copies", "home", "tokens").repartition(*unit).sortWithinPartitions(*unit)
    return dealt.mapInPandas(lambda f: by_group(f, ["group", "band", "bi", "bj"], _settle), "node binary, links long, root binary")


def join(documents: DataFrame, recall: float = RECALL, leaf: int = LEAF, bucket_block: int = BUCKET_BLOCK, group_block: int = GROUP_BLOCK, extra: dict | None = None) -> DataFrame:
    """One row per row of ``documents (doc_id, text)``: ``doc_id``, ``n_shingles``,
    ``class_id`` (smallest id of the documents with the same set), ``n_links``
    (other documents at or above the threshold), ``component_id`` (smallest
    id reachable by links), ``kept`` (the document that stays), and the
    columns ``extra`` (name to expression) of each row."""
    extra = extra or {}
    docs = documents.select("doc_id", "text")
    own = documents.select(F.col("doc_id").alias("id"), F.col("text").alias("t"), *[e.alias(f"x{i}") for i, e in enumerate(extra.values())])
    kept = ["id", *[f"x{i}" for i in range(len(extra))]]
    sketch = with_computed(own, kept, ["t"], {"node": "binary", "n": "long", "sample": "binary", "bits": "binary"}, _sketch)
    sketch = written(sketch, "sketches")
    classes = sketch.where("node is not null").groupBy("node").agg(F.min("id").alias("rep"), F.count("*").alias("copies"), F.first("n").cast("int").alias("n"), F.first("bits").alias("bits"), F.first("sample").alias("sample"))
    classes = written(classes, "classes")

    edges = candidate_links(classes.select("node", "n", "bits", "sample"), runs_for(recall), leaf, block=bucket_block)
    groups = components(edges, "node", "root").withColumnRenamed("component", "group")
    groups = groups.join(classes.select("node", "rep", "n", "copies"), "node")
    found = written(settled_links(docs, written(groups, "groups"), group_block), "links")

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    part = components(found, "node", "root").withColumnRenamed("component", "part")
    known = classes.select("node", "rep", "copies").join(links, "node", "left").join(part, "node", "left").withColumn("part", F.coalesce("part", "node"))
    chosen = known.groupBy("part").agg(F.min(F.struct(F.col("rep").isNull().alias("none"), "rep", "node")).alias("first"))
    facts = known.join(chosen, "part").select("node", F.col("rep").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.col("first.rep").alias("component_id"), F.col("first.node").alias("stays"))
    out = sketch.select(*kept, "node", "n").join(facts, "node", "left")
    stays = F.col("node").isNull() | ((F.col("node") == F.col("stays")) & F.col("id").eqNullSafe(F.col("component_id")))
    none = F.col("node").isNull()
    return out.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.when(none, F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(none, F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        stays.alias("kept"), *[F.col(f"x{i}").alias(c) for i, c in enumerate(extra)])


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, with their own columns, one of each group of
    linked documents; documents without words all stay."""
    own = docs.columns
    names = [f"d{i}" for i in range(len(own))]
    named = docs.toDF(*names)
    id_, text = names[own.index("doc_id")], names[own.index("text")]
    keyed = named.withColumns({"doc_id": F.col(id_), "text": F.col(text), "mark": F.md5(F.col(text).cast("binary"))})
    found = join(keyed, extra={"mark": F.col("mark")}, **options)
    # what is not simply kept: documents that go, and repeated rows of which one stays
    seen = found.where("n_shingles > 0").groupBy("doc_id", "mark").agg(F.max("kept").alias("stays"), F.count("*").alias("times"))
    seen = if_small(written(seen.where("not stays or times > 1"), "seen")).alias("s")
    k = keyed.alias("k")
    same = F.col("k.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("k.mark") == F.col("s.mark"))
    once = k.join(seen, same, "left_anti").select(*names)
    again = k.join(seen.where("stays"), same).select(*[F.col(f"k.{n}").alias(n) for n in names], "k.mark")
    first = again.groupBy(id_, "mark").agg(F.min(F.struct(*names)).alias("row")).select("row.*")
    return once.unionByName(first).toDF(*own)


#: The query in DuckDB.
SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, COUNT(*) AS n, string_agg(s, chr(10) ORDER BY s) AS whole FROM s GROUP BY doc_id),
c AS (SELECT whole, MIN(doc_id) AS rep FROM n GROUP BY whole),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, COUNT(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 9 * c >= 4 * (x.n + y.n)),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.rep, d.doc_id) AS class_id, coalesce(k.n_links, 0) AS n_links,
       least(d.doc_id, coalesce(m.low, d.doc_id)) AS component_id, d.doc_id <= coalesce(m.low, d.doc_id) AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.whole = n.whole
  LEFT JOIN (SELECT a, COUNT(*) AS n_links FROM l GROUP BY a) k ON k.a = d.doc_id
  LEFT JOIN (SELECT a, MIN(b) AS low FROM r GROUP BY a) m ON m.a = d.doc_id
"""
