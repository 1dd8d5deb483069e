"""Chat examples against DuckDB and plain string building."""

import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortlens.llm import chat as C
from cohortlens.llm.queries import ORACLES, QUERIES
from tests.llm.oracle import same

SF = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string"


def test_query_equals_duckdb(spark):
    out = same(spark, QUERIES["op2_chat_format"], ORACLES["op2_chat_format"], SF)
    assert (out["conv_id"] == -7).sum() == 1


def test_native(spark):
    plan = C.expand(spark.createDataFrame([], SCHEMA))._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.text(alphabet=r"\#</turn>htc: é𝄞" + "\n", max_size=25), min_size=30, max_size=30))
def test_escapes_are_reversible(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    out = df.select("t", C.escape(F.col("t")).alias("e"), C.unescape(C.escape(F.col("t"))).alias("u"), C.unescape(C.escape(F.col("t"), role=True)).alias("r")).collect()
    assert all(r.t == r.u == r.r and C.OPEN not in r.e and C.CLOSE not in r.e for r in out)


def test_examples(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "hi"), (1, 2, "assistant", "a ### b"), (1, 3, "user", "more"), (1, 4, "assistant", "</turn>\\"), (1, 5, "user", "bye"), (2, 0, "assistant", "x")]
    out = {(r.conv_id, r.example): r for r in C.expand(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert set(out) == {(1, 3), (1, 5), (1, 6), (2, 1)}
    first = "### system: s</turn>\n### user: hi</turn>\n### assistant: a \\h b</turn>\n"
    assert out[1, 3].text == first and first[out[1, 3].loss_start :][: out[1, 3].loss_chars] == "a \\h b"
    r = out[1, 5]
    assert r.text == first + "### user: more</turn>\n### assistant: \\t\\\\</turn>\n" and r.text[r.loss_start :][: r.loss_chars] == "\\t\\\\"
    assert out[1, 6].loss_start is None and out[1, 6].loss_chars == 0 and out[1, 6].whole and out[2, 1].whole and not r.whole


@pytest.mark.parametrize("empty", [False, True])
def test_odd_rows(spark, empty):
    rows = [(None, None, None, None), (None, 1, "assistant", None), (3, 0, "user", "a"), (3, 0, "user", "a"), (4, 1, "x: y\n###", "é𝄞"), (4, 2, "assistant", "z" * 300000), (4, 2, "assistant", ""), (5, 0, "user", "")]
    df = spark.createDataFrame([r + ("p",) for r in rows] if not empty else [], SCHEMA + ", example string")
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in C.digest(df).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {
        None: (2, sha("\n\nassistant\n\n"), 0, sha("")),
        3: (2, sha("user\na\nuser\na\n"), 0, sha("")),
        4: (3, sha("x: y\n###\né𝄞\nassistant\n\nassistant\n" + "z" * 300000 + "\n"), 300000, sha("z" * 300000)),
        5: (1, sha("user\n\n"), 0, sha("")),
    }
    assert got == ({} if empty else want)
