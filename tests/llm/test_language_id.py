"""Language ID against a plain PPM coder, on held-out accuracy and odd rows."""

import math
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortlens.llm import language_id as L
from cohortlens.llm.common import BATCH_BYTES, small_batches

SF = "/root/testdata/sf0.01"


def plain_bits(train: list[str], text: str) -> float:
    """PPM with method C and exclusion, by dictionaries."""
    seen = defaultdict(Counter)
    pad = b"\n" * L.ORDER
    for t in train:
        b = pad + t.encode()
        for i in range(L.ORDER, len(b)):
            for j in range(L.ORDER + 1):
                seen[b[i - j : i]][b[i]] += 1
    b, total = pad + text.encode(), 0.0
    for i in range(L.ORDER, len(b)):
        gone = set()
        for j in range(L.ORDER, -1, -1):
            left = {s: c for s, c in seen.get(b[i - j : i], {}).items() if s not in gone}
            if not left:
                continue
            n, q = sum(left.values()), len(left)
            if b[i] in left:
                total += math.log2((n + q) / left[b[i]])
                break
            total += math.log2((n + q) / q)
            gone |= set(left)
        else:
            total += math.log2(256 - len(gone))
    return total


def counts(train: dict[str, list[str]]) -> pd.DataFrame:
    rows = []
    for lang, texts in train.items():
        for t in texts:
            g, n = np.unique(L._grams(b"\n" * L.ORDER + t.encode()), return_counts=True)
            rows.append(pd.DataFrame({"lang": lang, "gram": g.astype(np.int64), "n": n}))
    return pd.concat(rows).groupby(["lang", "gram"], as_index=False).sum()


def test_code_lengths_equal_a_plain_coder():
    train = {"a": ["the cat sat on the mat", "the hat"], "b": ["le chat était là", "où est le chat"]}
    model = L.Model.fit(counts(train))
    texts = ["the chat", "", "x", "était où? ÿ", "the cat sat on the mat the cat"]
    got = model.texts([t.encode() for t in texts])
    want = [[plain_bits(train[x], t) for x in model.langs] for t in texts]
    assert np.allclose(got, want, atol=1e-3)


def test_long_texts_are_scored_whole(monkeypatch):
    model = L.Model.fit(counts({"a": ["abcabcab"], "b": ["xyzxyzxy"]}))
    text = ("abcxy" * 997).encode()
    whole = model.texts([text])
    monkeypatch.setattr(L, "WINDOW", 64)
    assert np.allclose(model.texts([text, b"abc"])[0], whole[0], atol=1e-2)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = L.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    total, right = out.agg(F.count("*"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert total > 100 and right >= 0.98 * total


def test_language_of_held_out_rows_is_never_an_input(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(300)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    other = docs.withColumn("lang", F.when(held, F.lit("zz")).otherwise(F.col("lang")))
    a = L.identify(docs).orderBy("doc_id").toPandas()
    b = L.identify(other).orderBy("doc_id").toPandas()
    pd.testing.assert_frame_equal(a, b)
    assert "zz" not in set(b["lang_pred"])


@pytest.mark.parametrize("empty", [False, True])
def test_odd_rows(spark, empty):
    rows = [(i, "the cat sat on the mat " * 3, "en", "s", 1, "x") for i in range(20)]
    rows += [(100, None, "en", None, None, "x"), (101, "", None, None, None, "x"), (102, "123 !?", "en", None, None, "x"),
             (None, "the cat", None, None, None, "x"), (3, "the cat", "en", "s", 1, None), (3, "the cat", "en", "s", 1, None), (104, "cat " * 50000, None, None, 1, "y")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string"
    docs = spark.createDataFrame([] if empty else rows, schema)
    out = {(r.doc_id, r.lang_pred) for r in L.identify(docs).collect()}
    assert out == (set() if empty else {(i, "en") for i in range(20)} | {(100, "und"), (101, "und"), (102, "und"), (None, "en"), (104, "en")})
    kept = L.keep_identified(docs)
    assert kept.columns == docs.columns and kept.count() == (0 if empty else 24)


def test_no_learned_language(spark):
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert [r.lang_pred for r in L.identify(docs).collect()] == ["und"]


def test_digits_and_signs_are_no_letters(spark):
    rows = [(i, "the cat and the dog", "en") for i in range(1, 30)] + [(100 + i, t, None) for i, t in enumerate(["½", "²", "①", "Ⅷ", "1 2_3", "Ⅷ a"])]
    got = {r.doc_id: r.lang_pred for r in L.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert [got[100 + i] for i in range(6)] == ["und"] * 5 + ["en"]


def test_no_task_holds_many_long_texts_at_once(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "size"])

    other = spark.newSession()
    docs = other.range(0, 2000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("the cat and "), 2000).alias("text"))
    L.keep_identified(docs.withColumn("lang", F.lit("en")), sample_docs=1)
    n, most = docs.mapInArrow(sizes, "n long, size long").agg(F.sum("n"), F.max("size")).first()
    assert n == 2000 and most < 2 * BATCH_BYTES


def test_a_limit_that_the_session_sets_is_kept(spark):
    other, limit = spark.newSession(), "spark.sql.execution.arrow.maxBytesPerBatch"
    other.conf.set(limit, "1m")
    small_batches(other)
    assert other.conf.get(limit) == "1m"


def test_trees_keep_only_what_the_table_lacks():
    model = L.Model.fit(counts({"a": ["the cat sat on the mat"], "b": ["le chat est là"]}))
    assert len(model.keys) and not any(len(t.grams[L.ORDER]) or len(t.counts[L.ORDER]) for t in model.trees)
    assert all(len(t.contexts[L.ORDER]) for t in model.trees)
