r"""Chat formatting by prefix-target expansion (operator 2), in DataFrame
functions only.

A turn is written ``### role: text</turn>`` and a line feed.  Inside texts the
control strings are escaped reversibly: a backslash becomes ``\\``, ``###``
becomes ``\h``, ``</turn>`` becomes ``\t``; in roles also a colon, ``\c``.

Each assistant turn becomes an example of its own: all turns before it as
context, then the turn, with the loss on its text alone.  A conversation that
does not end with the assistant gets one more row, its whole text with an
empty loss mask, so that no turn is lost.  The output is quadratic in the
length of a conversation, as the method asks; the work per conversation other
than writing that output is linear.

Cases: null roles and texts count as empty; turns go by ``turn`` (null first),
then role and text, and repeated rows are repeated turns; a null ``conv_id`` is
a conversation; one without an assistant turn has no loss; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import written

ASSISTANT = "assistant"
OPEN, CLOSE = "###", "</turn>"
_CODES = {OPEN: r"\h", CLOSE: r"\t", ":": r"\c"}


def escape(text: Column, role: bool = False) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control, code in _CODES.items():
        if role or control != ":":
            out = F.replace(out, F.lit(control), F.lit(code))
    return out


def unescape(text: Column) -> Column:
    """Between the escaped backslashes, which a scan from the left finds
    first, every code stands for its control string."""

    def plain(piece: Column) -> Column:
        for control, code in _CODES.items():
            piece = F.replace(piece, F.lit(code), F.lit(control))
        return piece

    return F.array_join(F.transform(F.split(text, r"\\\\", -1), plain), "\\")


def expand(conversations: DataFrame) -> DataFrame:
    """The examples of ``conversations (conv_id, turn, role, text)``:
    ``conv_id``, ``example`` (place of the last turn), ``text``,
    ``loss_start`` (from 0) and ``loss_chars`` (both in code points of ``text``),
    and ``whole``, true for the row that holds the whole conversation."""
    empty = F.lit("")
    turns = conversations.select("conv_id", "turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("body"))
    head = F.concat(F.lit(OPEN + " "), escape(F.col("role"), role=True), F.lit(": "))
    shown = turns.withColumns({"head": head, "safe": escape(F.col("body"))})
    shown = shown.withColumn("part", F.concat("head", "safe", F.lit(CLOSE + "\n")))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "body")
    placed = shown.withColumns({
        "place": F.row_number().over(order),
        "end": F.sum(F.length("part")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
    })
    start = F.col("end") - F.length("part") + F.length("head")
    placed = placed.select("conv_id", F.struct(
        "place", "part", "end", (F.col("role") == ASSISTANT).alias("reply"), start.alias("loss_start"), F.length("safe").cast("long").alias("loss_chars")).alias("t"))
    whole = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    whole = whole.select("conv_id", F.array_join(F.transform("turns", lambda t: t["part"]), "").alias("formatted"), F.size("turns").alias("n"), F.transform(
        "turns", lambda t: t.dropFields("part")).alias("turns"))
    targets = F.filter("turns", lambda t: t["reply"] | (t["place"] == F.col("n")))
    rows = whole.select("conv_id", "formatted", "n", F.explode(targets).alias("t"))
    return rows.select(
        "conv_id", F.col("t.place").alias("example"), F.substring("formatted", F.lit(1), F.col("t.end").cast("int")).alias("text"),
        F.when(F.col("t.reply"), F.col("t.loss_start")).alias("loss_start"), F.when(F.col("t.reply"), F.col("t.loss_chars")).otherwise(0).alias("loss_chars"),
        (F.col("t.place") == F.col("n")).alias("whole"))


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation, from the examples alone: ``n_turns``,
    ``turns_sha256``, ``loss_chars``, ``loss_sha256``, ``formatted_chars`` and
    ``n_examples``."""
    loss = unescape(F.substring("text", (F.coalesce("loss_start", F.lit(0)) + 1).cast("int"), F.col("loss_chars").cast("int")))
    parts = F.filter(F.split("text", CLOSE + "\n", -1), lambda p: p != "")
    cut = lambda p: F.locate(": ", p)  # noqa: E731  the head ends at the first colon, those of roles are escaped
    turn = lambda p: F.concat(
        unescape(F.substring(p, F.lit(len(OPEN) + 2), cut(p) - len(OPEN) - 2)), F.lit("\n"), unescape(F.substring(p, cut(p) + 2, F.length(p))), F.lit("\n"))
    rows = examples.select(
        "conv_id", "example", loss.alias("loss"), F.length("text").alias("chars"), F.when(F.col("whole"), F.size(parts)).alias("n"),
        F.when(F.col("whole"), F.sha2(F.array_join(F.transform(parts, turn), ""), 256)).alias("sha"))
    losses = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("example", "loss"))), lambda r: r["loss"]), "")
    got = rows.groupBy("conv_id").agg(F.max("n").cast("long").alias("n_turns"), F.max("sha").alias("turns_sha256"), losses.alias("all"), F.sum("chars").cast("long").alias("formatted_chars"), F.count("*").alias("n_examples"))
    return got.select("conv_id", "n_turns", "turns_sha256", F.length("all").cast("long").alias("loss_chars"), F.sha2("all", 256).alias("loss_sha256"), "formatted_chars", "n_examples")


def control_case(spark) -> DataFrame:
    """Conversation -7: a user and an assistant row full of control strings."""
    text = F.lit(r"\### Assistant: </turn> ok")
    return spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise(ASSISTANT).alias("role"), text.alias("text"))


def digest(conversations: DataFrame) -> DataFrame:
    """The examples written as a table, and what is read back from it."""
    return read_back(written(expand(conversations), "examples"))


#: The query in DuckDB.
SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS body FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, replace(replace(replace(body, '\', '\\'), '###', '\h'), '</turn>', '\t') AS safe,
             replace(replace(replace(replace(role, '\', '\\'), '###', '\h'), '</turn>', '\t'), ':', '\c') AS name FROM c),
l AS (SELECT *, SUM(length(name) + length(safe) + 14) OVER w AS upto, ROW_NUMBER() OVER w = COUNT(*) OVER (PARTITION BY conv_id) AS last
      FROM e WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, body ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT conv_id, COUNT(*) AS n_turns,
       sha256(string_agg(role || chr(10) || body || chr(10), '' ORDER BY turn NULLS FIRST, role, body)) AS turns_sha256,
       CAST(SUM(CASE WHEN role = 'assistant' THEN length(body) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN body END, '' ORDER BY turn NULLS FIRST, role, body), '')) AS loss_sha256,
       CAST(SUM(CASE WHEN role = 'assistant' OR last THEN upto ELSE 0 END) AS BIGINT) AS formatted_chars,
       SUM(CASE WHEN role = 'assistant' OR last THEN 1 ELSE 0 END)::BIGINT AS n_examples
FROM l GROUP BY conv_id
"""
