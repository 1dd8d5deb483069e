"""The pipeline stage by stage: columns, planted cases, and plain versions."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from cohortlens.llm import packing, secrets_scan
from cohortlens.llm.common import written

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    key = "0123456789abcdef" * 3
    more = [(900001, "12345 67890 !!", "en", "src1", 14), (900002, None, "en", "src1", 0)]
    planted = docs.where("doc_id = 1").select(F.lit(900003).cast("long").alias("doc_id"), "text", "lang", F.lit("src2").alias("source"), "n_chars")
    secret = docs.where("doc_id = 3").select(F.lit(900004).cast("long").alias("doc_id"), F.concat(F.reverse(F.regexp_replace("text", r"\s+", " ")), F.lit(f" token: {key} end")).alias("text"), "lang", "source", "n_chars")
    out = [docs.unionByName(spark.createDataFrame(more, docs.schema)).unionByName(planted).unionByName(secret)]
    for name, stage in C.STAGES:
        out.append(written(stage(spark, out[-1], SF), name))
    return out


def test_columns(stages):
    assert all(s.columns == stages[0].columns for s in stages[1:5])
    assert len(C.STAGES) == 5


def test_language_stage_rejects_only_texts_without_one(stages):
    gone = {r.doc_id for r in stages[0].join(stages[1], "doc_id", "left_anti").collect()}
    assert {900001, 900002} <= gone and len(gone) <= 3


def test_one_of_each_group_stays(stages):
    before, after = ({r.doc_id: r.text for r in s.collect()} for s in stages[1:3])
    sets = {}
    for i, t in before.items():
        w = t.split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}
    linked = {i: {j for j in sets if j != i and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])} for i in sets}
    want = set()
    for i in sets:
        seen, todo = {i}, [i]
        while todo:
            for j in linked[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        want.add(min(seen))
    assert set(after) == want and 900003 not in want


def test_secrets_are_masked_and_other_text_kept(stages):
    before, after = ({r.doc_id: r for r in s.collect()} for s in stages[2:4])
    assert set(before) == set(after)
    for i, r in after.items():
        assert not secrets_scan.base_spans(r.text)
        if "<secret>" not in r.text:
            assert r == before[i]
    assert "token: 0123" not in after.get(900004, after[3]).text


def test_mix_takes_whole_documents(stages):
    before = {r.doc_id: r for r in stages[3].collect()}
    taken = stages[4].collect()
    assert all(before[r.doc_id] == r for r in taken)
    assert max(sum(x.doc_id == i for x in taken) for i in before) <= 3


def test_sequences_hold_the_mix(stages):
    parts = {}
    for r in stages[5].collect():
        assert sum(r.lengths) == r.bin_used <= r.capacity <= max(packing.CAPACITIES)
        for d, s, t, n in zip(r.doc_ids, r.starts, r.texts, r.lengths):
            assert len(re.findall(r"[^\x20\x09-\x0D]+", t)) == n
            parts.setdefault((d, s), []).append(t)
    times = {}
    for r in stages[4].collect():
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    texts = {r.doc_id: r.text for r in stages[4].collect()}
    for i, n in times.items():
        pieces = [parts[k] for k in sorted(parts) if k[0] == i]
        assert all(len(p) == n and len(set(p)) == 1 for p in pieces) and "".join(p[0] for p in pieces) == texts[i]


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in C.STAGES:
        docs = written(stage(spark, docs, SF), name)
    assert docs.count() == 0
