"""Personal data: base spans against plain matching, reliabilities, and a planted case."""

import hashlib
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortlens.llm import pii as P

SF = "/root/testdata/sf0.01"
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def plain(text):
    out = []
    for rank, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else True,
                  "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append((m.start(), rank, m.end(), kind))
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


def check(rows, texts):
    got = {r.doc_id: r for r in rows}
    for i, t in texts.items():
        want = plain(t)
        assert got[i].base_sha256 == hashlib.sha256(want.encode()).hexdigest(), (t, want, got[i])
        assert all(got[i][f"n_{k}"] == sum(x.startswith(k + ":") for x in want.split(",")) for k in PLAIN)
        assert set(filter(None, want.split(","))) <= set(got[i].spans.split(",")) and got[i].n_added == len(list(filter(None, got[i].spans.split(",")))) - len(list(filter(None, want.split(","))))


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = P.detect(docs).collect()
    check(rows, {r.doc_id: r.text for r in docs.collect()})
    assert sum(r.n_email for r in rows) > 5 and sum(r.n_added for r in rows) < 0.01 * len(rows)


piece = st.sampled_from(["4111 1111 1111 1111", "4111-1111-1111-1112", "1.2.3.4", "300.1.2.3", "001.002.3.0255", "a@b.c", "x.y+z@mail.example.com", "@", "+1 (555) 123-4567", "+49 30 1234", "+", "5", "12", "-", " ", ".", "(", ")", "é𝄞", "a", "%", "\n", "555-123-4567", "a [at] b.com"])


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(piece, max_size=12).map("".join), min_size=60, max_size=60))
def test_base_spans(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    check(P.detect(docs).collect(), dict(enumerate(texts)))


def test_native(spark):
    plan = P.find(spark.createDataFrame([], "doc_id long, text string"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_reliable_labelers_are_told_from_noise():
    patterns = {}
    for n, (a, b, noise) in [(400, (1, 1, 1)), (400, (1, 1, -1)), (300, (-1, -1, 1)), (300, (-1, -1, -1)), (20, (1, -1, 1)), (20, (-1, 1, -1))]:
        patterns[f"email,{a},{b},{noise},0,0"] = n
    prob, tables = P.reliabilities(patterns)
    assert tables[0][1, 1] > 0.9 and tables[0][0, -1] > 0.9 and abs(tables[2][1, 1] - tables[2][0, 1]) < 0.1
    assert prob["email,1,1,-1,0,0"] > 0.95 and prob["email,-1,-1,1,0,0"] < 0.05


def test_loose_candidates_need_support(spark):
    rows = [(i, f"call phone +1 (555) 123-{4000 + i} now, mail me{i}@mail.example.com") for i in range(200)]
    rows += [(1000, "tel (555) 123-4567 thanks"), (1001, "ratio x@y and order 4111 1111 1111 1112")]
    out = {r.doc_id: r for r in P.detect(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert "card" not in out[1001].spans and all(r.n_email == r.n_phone == 1 for i, r in out.items() if i < 200)


@pytest.mark.parametrize("empty", [False, True])
def test_odd_rows(spark, empty):
    texts = {1: None, 2: "", 3: "1" * 100000, 4: "a" * 100000 + "@", 5: "a.b@c.d " * 800, 6: "+1 " + " " * 50000, 7: "a@" + "b." * 20000 + "c"}
    rows = [(i, t, "x") for i, t in texts.items()] + [(None, "q@r.s", "x"), (2, "", "x")]
    docs = spark.createDataFrame([] if empty else rows, "doc_id long, text string, spans string")
    out = P.detect(docs).collect()
    assert len(out) == (0 if empty else 9)
    if not empty:
        check(out, texts)
        assert [r.spans for r in out if r.doc_id is None] == ["email:0:5"]
