"""Exact duplicates by deterministic block naming (operator 11).

A normalised text is cut into blocks of ``BLOCK`` code points.  Distinct blocks
are sorted by (hash, block) and named: the first block of a hash bears the
hash (a non-negative integer), each further one a fresh negative integer.  So
blocks have the same name only if they are equal, whatever the hash does.
Adjacent names form pairs (an odd one pairs with null), distinct pairs are
named in the same way, and so on until a document has one name.  That name
and the number of blocks are its identity: no two texts share it.

As the first name of a hash is known without a look at the sorted list, names
are given in place and whole texts never travel by document: the names of a
document stay in its row, distinct blocks are shuffled once to be held against
each other, and the pairs of all levels in one further pass of two integers a
pair.  Only where different blocks or pairs do share a hash does a join bring
in the fresh names, from that level on.

Cases: a null text counts as empty, and all empty texts are equal; a null
``doc_id`` comes after all others among equal texts; of repeated rows one
stays; an empty table gives an empty result; columns other than ``doc_id`` and
``text`` are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import written

#: Code points a block, and bits of the hash that names begin with.
BLOCK, BITS = 512, 62
SPACE = r"[\x20\x09-\x0D]+"


def _hash(bits: int, *cols: Column | str) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*cols), 64 - bits)


def _cut(docs: DataFrame, block: int) -> DataFrame:
    """``(rid, doc_id, length, norm, blocks)`` of each row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", F.char_length(text).cast("long").alias("length"), F.regexp_replace(text, SPACE, "").alias("norm"))
    return rows.withColumn("blocks", F.regexp_extract_all("norm", F.lit(f"(?s).{{1,{block}}}"), F.lit(0)))


def _sharing(things: DataFrame, hash_key: list[str]) -> DataFrame:
    """The hashes that several of the distinct ``things`` have."""
    return things.groupBy(*hash_key).count().where("count > 1").drop("count")


def _fresh(things: DataFrame, sharing: DataFrame, hash_key: list[str], sort: list[str]) -> DataFrame:
    """``things`` that are not the first of their hash, in sorted order, each
    with a negative ``fresh`` name; written, so that names stay as they are."""
    place = F.row_number().over(Window.partitionBy(*hash_key).orderBy(*[F.col(c).asc_nulls_first() for c in sort]))
    later = things.join(sharing, hash_key).withColumn("place", place).where("place > 1").drop("place")
    return written(later.withColumn("fresh", -1 - F.monotonically_increasing_id()), "fresh_names")


def _block_names(docs: DataFrame, block: int, bits: int) -> DataFrame:
    """``(rid, doc_id, length, text_sha256, n, names)``, a written table."""
    rows = _cut(docs, block)
    own = ["rid", "doc_id", "length", F.sha2("norm", 256).alias("text_sha256"), F.size("blocks").alias("n")]
    things = rows.select(F.explode("blocks").alias("block")).select(_hash(bits, "block").alias("h"), "block").distinct()
    sharing = written(_sharing(things, ["h"]), "shared_hashes")
    if sharing.isEmpty():
        return written(rows.select(*own, F.transform("blocks", lambda b: _hash(bits, b)).alias("names")), "block_names")
    fresh = _fresh(things, sharing, ["h"], ["block"])
    each = rows.select(*own, F.posexplode_outer("blocks").alias("pos", "block")).withColumn("h", _hash(bits, "block"))
    named = each.join(fresh, ["h", "block"], "left").withColumn("name", F.coalesce("fresh", "h"))
    return written(_regrouped(named.withColumn("pos", F.when(F.col("block").isNotNull(), F.col("pos")))), "block_names")


def _regrouped(named: DataFrame) -> DataFrame:
    """One row per document again, its names in order (null ``pos``: none)."""
    own = [F.first(c).alias(c) for c in ("doc_id", "length", "text_sha256", "n")]
    item = F.when(F.col("pos").isNotNull(), F.struct("pos", "name"))
    listed = named.groupBy("rid").agg(*own, F.sort_array(F.collect_list(item)).alias("names"))
    return listed.withColumn("names", F.transform("names", lambda x: x["name"]))


def _climb(bits: int, limit: int | None = None) -> Column:
    """Names and pairs of a row after all levels, or the first ``limit``:
    ``struct<names, pairs: array<struct<level, pos, a, b>>>``."""
    n = F.size("names")
    steps = F.length(F.bin(n - 1))
    steps = F.least(steps, F.lit(limit)) if limit else steps
    levels = F.when(n < 2, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(1), steps))
    pair = "struct<level:int,pos:int,a:bigint,b:bigint>"

    def level_up(at: Column, level: Column) -> Column:
        names = at["names"]
        places = F.sequence(F.lit(0), F.floor((F.size(names) - 1) / 2).cast("int"))
        join = lambda i: F.struct(level.alias("level"), i.alias("pos"), F.get(names, 2 * i).alias("a"), F.get(names, 2 * i + 1).alias("b"))
        up = F.transform(places, lambda i: _hash(bits, F.get(names, 2 * i), F.get(names, 2 * i + 1)))
        return F.struct(up.alias("names"), F.concat(at["pairs"], F.transform(places, join)).alias("pairs"))

    return F.aggregate(levels, F.struct(F.col("names"), F.array().cast(f"array<{pair}>").alias("pairs")), level_up)


def identities(docs: DataFrame, block: int = BLOCK, bits: int = BITS) -> DataFrame:
    """``(rid, doc_id, length, text_sha256, n, name)`` of each row: ``(n, name)``
    are equal exactly for equal normalised texts."""
    own = ["rid", "doc_id", "length", "text_sha256", "n"]
    rows = _block_names(docs, block, bits)
    while True:
        pairs = rows.select(F.explode(_climb(bits)["pairs"]).alias("p")).select("p.level", "p.a", "p.b")
        pairs = pairs.withColumn("h", _hash(bits, "a", "b")).distinct()
        sharing = written(_sharing(pairs, ["level", "h"]), "shared_hashes")
        at = sharing.agg(F.min("level")).first()[0]
        if at is None:
            return rows.select(*own, F.coalesce(F.get(_climb(bits)["names"], F.lit(0)), F.lit(0)).alias("name"))
        # names hold below this level; from its fresh names the climb goes on
        fresh = _fresh(pairs.where(F.col("level") == at), sharing, ["level", "h"], ["a", "b"]).select("h", F.col("a").alias("fa"), F.col("b").alias("fb"), "fresh")
        up = rows.select(*own, _climb(bits, at).alias("t"))
        level = F.filter("t.pairs", lambda p: p["level"] == at)
        done = F.transform("t.names", lambda x: F.struct(F.lit(at).alias("level"), F.lit(0).alias("pos"), x.alias("a"), F.lit(None).cast("long").alias("b")))
        risen = F.size(level) > 0  # a row that has one name already keeps it
        each = up.select(*own, risen.alias("risen"), F.explode_outer(F.when(risen, level).otherwise(done)).alias("p")).select(*own, "risen", "p.pos", "p.a", "p.b")
        each = each.withColumn("h", F.when(F.col("risen"), _hash(bits, "a", "b")).otherwise(F.col("a")))
        alike = F.col("risen") & (each["h"] == fresh["h"]) & F.col("a").eqNullSafe(F.col("fa")) & F.col("b").eqNullSafe(F.col("fb"))
        named = each.join(fresh, alike, "left").select(*own, "pos", F.coalesce("fresh", each["h"]).alias("name"))
        rows = written(_regrouped(named), "pair_names")


def deduplicate(docs: DataFrame, block: int = BLOCK, bits: int = BITS) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)`` of every row of
    ``docs (doc_id, text)``: of equal texts the row of the longest original,
    then of the smallest ``doc_id``, stays."""
    ids = identities(docs.select("doc_id", "text"), block, bits)
    first = F.min(F.struct((-F.col("length")).alias("shorter"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "rid")).alias("best")
    groups = ids.groupBy("n", "name").agg(F.count("*").alias("group_size"), first).where("group_size > 1")
    groups = written(groups.select("n", "name", "group_size", F.col("best.doc_id").alias("keep_id"), F.col("best.rid").alias("keep_rid")), "copies")
    # a hot group is a skewed key of the left side, which AQE splits
    both = ids.join(groups, ["n", "name"], "left")
    alone = F.col("keep_rid").isNull()
    return both.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("rid") == F.col("keep_rid"))).alias("kept"),
        "text_sha256",
    )


SQL = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm, length(coalesce(text, '')) AS len
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER w = 1 AS kept,
       sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm ORDER BY len DESC, doc_id)
"""
