"""Packing: every word once, no bin overfull, least lengths, cost against a plain packer."""

import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortlens.llm import packing as P
from cohortlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
CAPS = (8, 16, 32)


def plain(sizes, caps, overhead):
    """The same rule by searching all bins."""
    price, later, bins = min((c + overhead) / c for c in caps), sum(sizes), []
    for s in sorted(sizes, reverse=True):
        later -= s
        open_ = [b for b in bins if b[0] - b[1] >= s]
        if open_:
            least = min(b[0] - b[1] for b in open_)
            b = [b for b in open_ if b[0] - b[1] == least][0]
        else:
            b = [min((c for c in sorted(caps) if c >= s), key=lambda c: (c + overhead - price * min(c - s, later), c)), 0]
            bins.append(b)
        b[1] += s
    return sorted((min(c for c in caps if c >= u), u) for _, u in bins)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=60), st.integers(0, 8))
def test_best_fit(sizes, overhead):
    bins, offsets, capacity, used = P.best_fit(np.array(sizes, np.int64), CAPS, overhead)
    held = Counter()
    for b, o, s in sorted(zip(bins, offsets, sizes)):
        assert o == held[b]
        held[b] += s
    assert [held[b] for b in range(len(used))] == list(used)
    assert all(u <= c and not any(u <= x < c for x in CAPS) for c, u in zip(capacity, used))
    want = plain(sizes, CAPS, overhead)
    assert sum(c + overhead for c in capacity) <= 1.35 * sum(c + overhead for c, _ in want) + 40
    assert len(used) == 0 or sum(used) == sum(sizes)


def check(out, words, caps):
    """Each document's words once, in pieces; bins as they say they are."""
    pieces, bins = {}, {}
    for r in out:
        pieces.setdefault((r.doc_id, r["size"], r.copy), []).append((r.start, r.length))
        if r.bin_id is not None:
            bins.setdefault(r.bin_id, []).append(r)
    assert Counter((d, s) for d, s, _ in pieces) == Counter(words)
    for (_, size, _), p in pieces.items():
        at = 0
        for start, length in sorted(p):
            assert start == at and length <= max(caps)
            at += length
        assert at == size
    for rows in bins.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.position):
            assert r.position == at
            at += r.length
        assert {r.bin_used for r in rows} == {at} and {r.capacity for r in rows} == {min(c for c in caps if c >= at)}
    return bins


def test_query_packs_every_word(spark):
    out = QUERIES["op8_best_fit_packing"](spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    bins = check(out, [(r.doc_id, len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))) for r in docs], P.CAPACITIES)
    room = sum(rows[0].capacity for rows in bins.values())
    assert sum(rows[0].bin_used for rows in bins.values()) >= 0.97 * room


def test_shards_do_not_depend_on_partitioning(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    a, b = (sorted(map(str, P.pack(docs.repartition(n), shard_pieces=100).collect())) for n in (2, 5))
    assert a == b and len({x.split("bin_id='")[1].split(":")[0] for x in a}) > 5


@pytest.mark.parametrize("empty", [False, True])
def test_odd_rows(spark, empty):
    rows = [(1, None, 5), (2, "", 5), (None, "a b", 5), (None, "c d", 5), (None, "c d", 5), (4, "w\n " * 30001, 5), (4, "w\n " * 30001, None), (5, " lead  trail ", 1), (2**62 + 1, "x", 2)]
    docs = spark.createDataFrame([] if empty else rows, "doc_id long, text string, size long")
    words = [(r[0], len((r[1] or "").split())) for r in rows]
    check(P.pack(docs).collect(), [] if empty else words, P.CAPACITIES)
    out = P.sequences(docs, shard_pieces=3).collect()
    parts = {}
    for r in out:
        assert sum(r.lengths) == r.bin_used <= r.capacity
        for d, s, t in zip(r.doc_ids, r.starts, r.texts):
            parts.setdefault(d, []).append((s, t))
    assert sorted(t for _, t in parts.get(None, [])) == ([] if empty else ["a b", "c d", "c d"])
    if not empty:
        assert parts[5] == [(0, " lead  trail ")] and parts[2**62 + 1] == [(0, "x")]
        assert "".join(t for _, t in sorted(parts[4])[::2]) == "w\n " * 30001
        assert 1 not in parts and 2 not in parts
