"""Quality rules against plain counting and a plain likelihood ratio."""

import math
import re
from collections import Counter
from zlib import crc32

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortlens.llm import quality as Q

SF = "/root/testdata/sf0.001"


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = list(zip(words, words[1:], words[2:]))
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab #|\n\t\x0b\x1c\x85\xa0é<", max_size=60))
def test_base_counts(text):
    assert Q.base_counts(text)[0] == plain(text)


def test_repeat_words_with_many_distinct_words(monkeypatch):
    text = " ".join(f"w{i}" for i in range(1 << 20)) + " a b c d a b c"
    assert Q.base_counts(text)[0][4] == 6


def test_scores_equal_a_plain_ratio(spark):
    docs = [(i, f"good fine words number {i} here") for i in range(40)] + [(i, f"junk ### {i} @@ junk junk") for i in range(40, 80)]
    labels = [(i, 1, 0) for i in range(30)] + [(50, 0, 0), (51, 1, 1)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in Q.judge(d, lab, buckets=1 << 12).collect()}
    import hashlib
    u = lambda i: int(hashlib.md5(f"1:{i}".encode()).hexdigest()[:13], 16) / 2**52
    share = 1.0
    half = [i for i in range(30) if u(i) < share / 2]

    def cells(text):
        h = [crc32(w.encode()) for w in text.split()]
        return [x % 4096 for x in h] + [((a * 0x9E3779B1 + b * 0x85EBCA77) % 2**64 >> 13) % 4096 for a, b in zip(h, h[1:])]

    raw, target = Counter(), Counter()
    for i, t in docs:
        raw.update(cells(t))
        if i in half:
            target.update(cells(t))
    n, m = sum(raw.values()), sum(target.values())
    p = lambda c: (raw[c] + 1) / (n + 4096)
    for i, t in docs:
        c = cells(t)
        want = sum(math.log((target[x] + Q.SMOOTHING * p(x)) / (m + Q.SMOOTHING) / p(x)) for x in c) / len(c)
        assert out[i].llr == pytest.approx(want, abs=1e-9)
        assert out[i].base_failed and not out[i].kept


def test_whole_table_and_reruns(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    a, b = (sorted(map(tuple, Q.judge(docs.repartition(n), labels).collect())) for n in (3, 7))
    assert a == b
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(a) == len(texts) and all(list(r[1:6]) == plain(texts[r[0]]) for r in a)
    assert all(r[6] == (r[1] < 50 or 100 * r[5] > 50 * r[1]) and not (r[6] and r[7]) for r in a)


@pytest.mark.parametrize("empty", [False, True])
def test_odd_rows(spark, empty):
    long = "word other third " * 30000
    rows = [(1, None, 1, 2), (2, "", 1, 2), (None, "a b", None, None), (3, long, 1, 2), (3, long, 1, 2), (4, " \n\n ", 0, 0)]
    docs = spark.createDataFrame([] if empty else rows, "doc_id long, text string, n_words long, trusted long")
    none = spark.createDataFrame([(None, 1, 0), (9, 1, None), (3, None, None)][: 0 if empty else 3], "doc_id long, quality int, toxic int")
    out = sorted((r.doc_id or 0, r.n_words, r.base_failed, r.kept, r.llr) for r in Q.judge(docs, none).collect())
    assert out == ([] if empty else [(0, 2, True, False, 0.0), (1, 0, True, False, 0.0), (2, 0, True, False, 0.0), (3, 90000, True, False, 0.0), (3, 90000, True, False, 0.0), (4, 0, True, False, 0.0)])
