"""Spelling variants against DuckDB and all pairs of words, in many small shards."""

import random
import re
import zlib
from collections import Counter

import pytest

from cohortlens.llm import spelling as S
from cohortlens.llm.queries import ORACLES, QUERIES
from tests.llm.oracle import same

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_error(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def words_of(rows):
    n = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    return {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}


def plain(rows):
    n = words_of(rows)
    near = {w: sorted((x for x in n if one_error(w, x)), key=lambda x: (-n[x], x)) for w in n}
    form = {w: near[w][0] if near[w] and n[near[w][0]] >= 5 * n[w] else None for w in n}

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n)


def found(spark, rows, schema=SCHEMA, **how):
    return sorted(tuple(r) for r in S.variants(spark.createDataFrame(rows, schema), **how).collect())


def test_query_equals_duckdb(spark):
    got = same(spark, QUERIES["op12_spelling_variants"], ORACLES["op12_spelling_variants"], SF)
    assert got["form"].notna().any() and (got["n_near"] > 1).any()


def drawn(seed, letters, n_stems):
    rng = random.Random(seed)
    stems = ["".join(rng.choice(letters) for _ in range(rng.randint(6, 11))) for _ in range(n_stems)]
    pool = []
    for s in stems:
        pool += [s] * rng.choice((30, 6, 5))
        for _ in range(6):
            i, kind = rng.randrange(len(s)), rng.randrange(3)
            pool += [s[:i] + ("" if kind == 0 else rng.choice(letters)) + s[i + (kind != 2) :]] * rng.choice((5, 7))
    rng.shuffle(pool)
    return [(i, " ".join(pool[i * 40 : i * 40 + 40])) for i in range(len(pool) // 40 + 1)]


@pytest.mark.parametrize("letters,shard_words,batch", [("ab", 20_000, 8192), ("abé", 30, 7), ("abc", 7, 50), ("abcdefghÿXY", 60, 64), ("ab", 1, 8192)])
def test_equals_all_pairs(spark, letters, shard_words, batch):
    rows = drawn(3, letters, 40)
    got = found(spark, rows, shard_words=shard_words, batch=batch)
    assert got == plain(rows)
    assert max(r[4] for r in got) > 3 or len(letters) > 4


@pytest.mark.parametrize("backward", [False, True])
def test_intervals_number_their_words(backward):
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(6, 9))) for _ in range(300)})
    shard = S.Shard(words, [1] * len(words), backward)
    q, w = shard.near(words, [len(x) // 2 for x in words])
    got = {(words[i], shard.words[j]) for i, j in zip(q, w)}
    half = lambda a, b: a[: len(a) // 2] == b[: len(a) // 2] if not backward else a[len(a) // 2 :][::-1] == b[::-1][: len(a) - len(a) // 2]
    assert got >= {(a, b) for a in words for b in words if one_error(a, b) and half(a, b)}
    assert all(one_error(a, b) for a, b in got)


def test_wide_intervals_are_read_symbol_by_symbol(monkeypatch):
    words = sorted({f"aaaaaa{x}{y}aaa" for x in "abcdefgh" for y in "abcdefgh"})
    shard = S.Shard(words, [1] * len(words), False)
    narrow = shard.near(words, [5] * len(words))
    monkeypatch.setattr(S, "NARROW", 0)
    wide = shard.near(words, [5] * len(words))
    assert [x.tolist() for x in narrow] == [x.tolist() for x in wide] and len(wide[0])


def test_odd_rows(spark):
    rows = [(1, None, 1), (2, "", 1), (None, "spelling Spelling SPELLING spellinG spelling", 1), (3, "speling " * 5, 1), (3, "speling " * 5, 1), (4, "x" * 40_000 + " " + "spelling " * 60_000, 1), (5, "naïveté NAïVETé " * 3, 1)]
    assert found(spark, rows, SCHEMA + ", n int") == plain([r[:2] for r in rows])
    assert found(spark, [], SCHEMA + ", n int") == []
