"""Block naming against DuckDB and a plain dictionary, with hashes so weak that
different blocks and pairs share them."""

import hashlib
import re

import pytest

from cohortlens.llm import exact_dedup as X
from cohortlens.llm.queries import ORACLES, QUERIES
from tests.llm.oracle import same

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string"


def plain(rows):
    groups = {}
    for i, (d, t) in enumerate(rows):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append(i)
    out = []
    for norm, members in groups.items():
        best = min(members, key=lambda i: (-len(rows[i][1] or ""), rows[i][0] is None, rows[i][0] or 0))
        for i in members:
            out.append((rows[i][0], rows[best][0], len(members), hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows, schema=SCHEMA, **how):
    got = X.deduplicate(spark.createDataFrame(rows, schema), **how).collect()
    ids = sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str)
    assert sum(r.kept for r in got) == len({r.text_sha256 for r in got})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)
    return ids


def test_query_equals_duckdb(spark):
    same(spark, QUERIES["op11_exact_dedup"], ORACLES["op11_exact_dedup"], SF)


@pytest.mark.parametrize("block,bits", [(512, 62), (3, 62), (2, 1), (2, 3), (1, 2)])
def test_weak_hashes_do_not_merge_texts(spark, block, bits):
    rows = [(i, "".join("abc"[(i >> (2 * k)) % 3] for k in range(1 + i % 9))) for i in range(120)]
    rows += [(1000 + i, " \t".join(rows[7 * i][1])) for i in range(12)] + [(2000, ""), (2001, "   "), (2002, None), (2003, "é\u0085漢😀" * 9), (2004, "é\u0085漢 😀" * 9)]
    assert found(spark, rows, block=block, bits=bits) == plain(rows)


def test_odd_rows(spark):
    long = "word and more of it. " * 60_000
    rows = [(1, long, "x"), (2, long.replace(" ", "\n"), "x"), (3, long[:-3], "x"), (4, None, None), (None, "", "x"), (None, "a b", "x"), (6, "ab", "x"), (6, "ab", "x"), (5, "a  b", None)]
    schema = SCHEMA + ", name string"  # a name that the operator uses itself
    assert found(spark, rows, schema) == plain([r[:2] for r in rows])
    assert found(spark, [], schema) == []


def test_copies_in_a_hot_group(spark):
    rows = [(i, "the same text " * 50) for i in range(3000)] + [(10_000 + i, f"text {i}") for i in range(500)]
    assert found(spark, rows) == plain(rows)


def test_no_python_in_the_plan(spark):
    df = X.deduplicate(spark.createDataFrame([(1, "a b")], SCHEMA))
    assert not any(w in df._jdf.queryExecution().toString() for w in ("Python", "Pandas", "InArrow"))
