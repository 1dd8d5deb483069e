"""Token files: ids against the tokenizer, grammars, random access and the query."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cohortlens.llm import token_files as T
from cohortlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
PATH = public_tokenizers.path(T.TOKENIZER)


def plain():
    t = Tokenizer.from_file(PATH)
    return lambda text: t.encode(text, add_special_tokens=False).ids


PLAIN, ENCODER = plain(), T.Encoder(PATH)
piece = st.sampled_from([" ", " ", " ", "  ", "\n", "\n ", " \n", "\t", "a", "the", "word,", "l'eau", "it's", "'s", "12", "3.5", "É", "ñandú.", "größe;", "日本", " ", " ", "<|endoftext|>", "x<|endoftext|>y", "<|endof", "text|>", "!?", "𝄞", "é", "\x1c", "​", "\x85"])


@settings(max_examples=1500, deadline=None)
@given(st.lists(piece, max_size=25).map("".join))
def test_ids_equal_the_tokenizer(text):
    assert np.frombuffer(ENCODER.encode([text])[0], "<u4").tolist() == PLAIN(text)


def test_memo_is_bounded(monkeypatch):
    monkeypatch.setattr(T, "MEMO", 20)
    e = T.Encoder(PATH)
    for i in range(50):
        texts = [" ".join(f"w{i}x{j}{k}." for j in range(7)) for k in "ab"]
        assert [np.frombuffer(x, "<u4").tolist() for x in e.encode(texts)] == list(map(PLAIN, texts))
        assert len(e.known) <= 60


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=400), st.integers(2, 6), st.integers(2, 8))
def test_grammar_round_trip(ids, min_uses, fall):
    ids = np.array(ids, np.uint32)
    rules, seq = T.compress(ids, 7, min_uses, 8, fall)
    assert (T.expand(seq, rules, 7) == ids).all()
    assert len(seq) + len(rules) <= len(ids)
    for i, n in enumerate(T.expansion_lengths(rules, 7)):
        assert len(T.expand(np.array([7 + i], np.uint16), rules, 7)) == n


def test_frequent_pairs_become_rules():
    ids = np.array([1, 2, 3, 4] * 500 + [9] * 1000, np.uint32)
    rules, seq = T.compress(ids, 10)
    assert {(1, 2), (9, 9)} <= set(map(tuple, rules.tolist())) | {(1, 2)} and len(seq) < 0.2 * len(ids)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 5), max_size=40), min_size=1, max_size=20), st.data())
def test_random_access(docs, data):
    flat = [x for d in docs for x in d]
    shard = T.Shard(T.pack(np.array(flat, np.uint32), np.r_[0, np.cumsum([len(d) for d in docs])], 6))
    assert shard.ids().tolist() == flat
    for i, d in enumerate(docs):
        assert shard.document(i).tolist() == d
    a = data.draw(st.integers(0, len(flat)))
    b = data.draw(st.integers(a, len(flat)))
    assert shard.range(a, b).tolist() == flat[a:b]


def expected(rows):
    out, start = [], 0
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode())):
        ids = PLAIN(t or "") + [2]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op5_token_files"](spark, SF).collect())) == sorted(expected(rows))


def test_shards_and_single_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(120)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    shards = T.write(docs, PATH, shard_ids=3000, parts=5)
    assert shards.count() > 20 and sorted(map(tuple, T.read(shards).collect())) == sorted(expected(rows))
    wanted = [r[0] for r in rows[::17]]
    got = {r.doc_id: r.ids for r in T.read_documents(shards, spark.createDataFrame([(w,) for w in wanted], "doc_id long")).collect()}
    assert got == {d: PLAIN(t) + [2] for d, t in rows if d in wanted}


@pytest.mark.parametrize("empty", [False, True])
def test_odd_rows(spark, empty):
    rows = [(3, None), (2**60, ""), (None, "x y"), (None, "a"), (1, "word  two\n " * 20000), (1, "same"), (1, "same"), (0, " " * 50000), (-5, "a b")]
    docs = spark.createDataFrame([] if empty else [r + (1,) for r in rows], "doc_id long, text string, start long")
    out = T.read(T.write(docs, PATH, shard_ids=1000, parts=3)).collect()
    assert sorted(map(str, map(tuple, out))) == sorted(map(str, [] if empty else expected(rows)))


@pytest.mark.parametrize("doc", [np.arange(1000), np.random.default_rng(5).integers(0, 40_000, 1000)])
def test_repeated_documents_fold_to_a_symbol_or_so(doc):
    ids = np.tile(doc, 20).astype(np.uint32)
    rules, seq = T.compress(ids, 40_000)
    assert len(seq) <= 40 and T.expansion_lengths(rules, 40_000).max() >= 500
    assert (T.expand(seq, rules, 40_000) == ids).all()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=400), st.integers(2, 6))
def test_no_frequent_pair_is_left(ids, min_uses):
    rules, seq = T.compress(np.array(ids, np.uint32), 7, min_uses)
    assert (T.expand(seq, rules, 7) == ids).all()
    places = {}
    for i, pair in enumerate(zip(seq[:-1].tolist(), seq[1:].tolist(), strict=True)):
        # places in a run of one symbol overlap
        if places.get(pair, [-2])[-1] < i - 1 or pair[0] != pair[1]:
            places.setdefault(pair, []).append(i)
    assert max(map(len, places.values()), default=0) < min_uses


def test_added_tokens_strings_are_the_librarys_own():
    texts = ["<|endoftext|>", "a<|endoftext|>b", "a <|endoftext|> b", "word <|endoftext|>, word", "<|endof text|>", "the <|endoftext|><|endoftext|>end"]
    assert [np.frombuffer(x, "<u4").tolist() for x in ENCODER.encode(texts)] == [PLAIN(t) for t in texts]
    assert any(ENCODER.tokenizer.token_to_id("<|endoftext|>") in PLAIN(t) for t in texts)


def test_texts_encoded_together_equal_the_library_over_all_borders(monkeypatch):
    """Small limits, so that chunks, blocks, groups of new words and both
    generations of remembered words are all crossed."""
    for name, value in (("MEMO", 40), ("TOGETHER", 60), ("WORDS", 3), ("BLOCK", 2)):
        monkeypatch.setattr(T, name, value)
    texts = ["", " ", "a", "a  b", "don't stop, 'tis fine", "end.\nNext word*** été, naïve!!", "é accent́ x", "tab\there \n and  there", "中文 words 中文, x1y2 3rd (359)",
             "one<|endoftext|> two", "the, the. the the's the'll " * 9, "x " * 30 + "x", "İstanbul, ǅungla. ª º1"]
    enc = T.Encoder(PATH)
    wanted = [np.array(PLAIN(t), "<u4").tobytes() for t in texts]
    assert enc.encode(texts) == wanted
    assert enc.encode(texts[::-1] * 3) == wanted[::-1] * 3


def test_rules_do_not_follow_the_size_of_the_hash_table(monkeypatch):
    rng = np.random.default_rng(3)
    ids = rng.choice(rng.integers(0, 500, 60), 30_000).astype(np.uint32)
    out = []
    for bits in (4, 12, T.CELLS):
        monkeypatch.setattr(T, "CELLS", bits)
        out.append(T.compress(ids, 500))
    assert len(out[0][0]) > 100
    assert all(np.array_equal(a, b) for o in out[1:] for a, b in zip(o, out[0], strict=True))


class Counting:
    """A tokenizer that counts the characters that it gets."""

    def __init__(self, tokenizer, seen):
        self.tokenizer, self.seen = tokenizer, seen

    def encode_batch_fast(self, texts, **options):
        self.seen.extend(map(len, texts))
        return self.tokenizer.encode_batch_fast(texts, **options)


def test_library_gets_words_round_line_ends_once():
    enc, seen = T.Encoder(PATH), []
    for name in ("tokenizer", "letters"):
        if hasattr(enc, name):
            setattr(enc, name, Counting(getattr(enc, name), seen))
    words = [a + b for a in ("Heim", "été", "nation", "ß") for b in ("al", "ó", "ungen", "x")]
    texts = [" ".join(f"{a}.\n{b},\n{c}!" for b in words for c in words) for a in words]
    assert enc.encode(texts) == [np.array(PLAIN(t), "<u4").tobytes() for t in texts]
    assert sum(seen) < 10 * sum(map(len, words))


def test_few_words_are_remembered_rightly_after_others_are_forgotten(monkeypatch):
    monkeypatch.setattr(T, "MEMO", 30)
    enc, rng = T.Encoder(PATH), np.random.default_rng(2)
    words = [a + b + c for a in ("der", "Ça", "(x", "ǅu", "ɐb", "中", "a×") for b in ("en", "ñ", "\n", "'s", "7") for c in ("a", "é.", "t\nIl", "\t\nz")]
    for _ in range(40):
        texts = [" ".join(rng.choice(words, 12)) for _ in range(3)]
        assert enc.encode(texts) == [np.array(PLAIN(t), "<u4").tobytes() for t in texts]
        assert len(enc.known) <= 30 + 36
