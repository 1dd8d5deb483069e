"""Token-id files compressed by Re-Pair grammars (operator 5).

Texts are encoded with a public tokenizer of the tokenizers library, an end id
closes each document, and documents go in ascending id order into shards of a
bounded number of ids.  In a shard the most frequent pairs of neighbouring
symbols are replaced by nonterminals, until no pair is frequent or the 16-bit
symbols are used up; a round replaces all pairs down to a falling bound at
once, each place by its most frequent pair.
A shard's blob holds the rules, the length that each expands to, the remaining
sequence, and the documents' ids and starts, so that any document, or any
range of ids, is decoded alone.  Blobs are rows of a Parquet table, which
Spark writes and reads in any store.

Encoding is memoised per word: the tokenizer never joins characters across a
single space between two others, so a text's ids are those of its words, each
with the space in front.  Nor does it join the letters that a word starts with
to other ASCII characters behind them, or anything across a single line end, so
a word's ids are those of its letters and of the parts of what follows.

Cases: a null text is empty and has the end id alone; null ids come first;
documents with equal ids go by their text; a document longer than a shard is a
shard of its own; an empty table gives an empty result.
"""

from __future__ import annotations

import codecs
import os
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import written

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
#: Ids in a shard, about.
SHARD_IDS = 1 << 20
#: Symbols fit 16 bits, so this is the most that rules and ids may name.
SYMBOLS = 1 << 16
#: Least uses of a rule, and how the bound falls from one round to the next.
MIN_USES, FALL = 6, 8
#: Words that a task remembers, and characters of texts that are encoded together.
MEMO, TOGETHER = 1_000_000, 1 << 22
#: Rows of a batch that are taken out of it at a time, new words that the library gets at a time, places filled in at a time.
ROWS, WORDS, BLOCK = 4096, 2048, 1 << 16

# letters that every Unicode version takes for letters
_LETTERS = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]*")

# a line end with white space or an end at its side
_BROKEN = re.compile(r"(?:\A|\s)\n|\n(?:\s|\Z)")

# bytes of UTF-8: 0 in such letters, 1 other ASCII, 2 the first of another character
_KIND = np.full(256, 2, np.uint8)
_KIND[:0x80] = [not chr(c).isalpha() for c in range(0x80)]
_KIND[0x80:0xC0] = _KIND[0xC3:0xCA] = 0

#: Rows of ids: all ids, and where a row's begin and how many they are.
Ragged = tuple[np.ndarray, np.ndarray, np.ndarray]
_NOTHING: Ragged = (np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int32))

_MAGIC = b"RPG1"


def _strings(words: pa.StringArray) -> list[str]:
    return words.to_numpy(zero_copy_only=False).tolist()


def _ragged(raw: list[bytes]) -> Ragged:
    lengths = np.fromiter(map(len, raw), np.int32, len(raw)) // 4
    return np.frombuffer(b"".join(raw), "<u4"), np.cumsum(lengths, dtype=np.int64) - lengths, lengths


def _joined(*tables: Ragged) -> Ragged:
    """The rows of some tables in one, those of the first table first."""
    ahead = np.cumsum([0] + [len(t[0]) for t in tables])
    return np.concatenate([t[0] for t in tables]), np.concatenate([t[1] + n for t, n in zip(tables, ahead, strict=False)]), np.concatenate([t[2] for t in tables])


def _filled(rows: np.ndarray, table: Ragged) -> np.ndarray:
    """The ids of ``rows``, one after the other."""
    flat, begins, lengths = table
    out = []
    for at in range(0, len(rows), BLOCK):
        some = rows[at : at + BLOCK]
        n = lengths[some]
        ends = np.cumsum(n, dtype=np.int64)
        places = np.repeat(begins[some] - ends + n, n)
        places += np.arange(ends[-1])
        out.append(flat.take(places))
    return np.concatenate(out) if out else _NOTHING[0]


def _cut(words: pa.StringArray) -> tuple[pa.StringArray, pa.StringArray, np.ndarray]:
    """The letters that each word starts with, and what follows them; a word
    that starts with none, or with some before a character beyond ASCII, whole.
    Last, whether the first part is letters alone."""
    n, (_, offsets, data) = len(words), words.buffers()
    if not n:
        return words, words, np.zeros(0, bool)
    offsets = np.frombuffer(offsets, np.int32)[words.offset : words.offset + n + 1]
    raw = np.frombuffer(data, np.uint8)[: offsets[-1]]
    kind = _KIND[raw]
    signs = np.flatnonzero((raw[:-1] == 0xC3) & ((raw[1:] == 0x97) | (raw[1:] == 0xB7)) | (raw[:-1] == 0xC9) & (raw[1:] >= 0x90))
    kind[signs] = 2
    start, end = offsets[:-1], offsets[1:]
    stops = np.r_[np.flatnonzero(kind), len(raw)].astype(np.int32)
    stop = np.minimum(stops[np.searchsorted(stops, start)], end)
    cut = (start < stop) & (np.r_[kind, np.uint8(0)][stop] == 1)
    both = np.empty(2 * n + 1, np.int32)
    both[::2], both[1::2] = offsets, np.where(cut, stop, end)
    parts = pa.StringArray.from_buffers(2 * n, pa.py_buffer(both), data)
    return parts.take(pa.array(np.arange(0, 2 * n, 2))), parts.take(pa.array(np.arange(1, 2 * n, 2))), cut | ((start < stop) & (stop == end))


def _parts(piece: str) -> list[str]:
    """A piece cut where the tokenizer does so whatever stands about: round a
    line end between two other characters, and behind a line's first letters."""
    if "\n" in piece and _BROKEN.search(piece):
        return [piece]
    out: list[str] = []
    for i, line in enumerate(piece.split("\n")):
        if i:
            out.append("\n")
        letters = _LETTERS.match(line)[0]
        if letters and letters != line and line[len(letters)] < "\x80":
            out += [letters, line[len(letters) :]]
        else:
            out.append(line)
    return out


class Encoder:
    """Ids of whole texts, as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task is the unit of parallel work
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # strings that the library takes out of a text before all else
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # letters and whole words after a space: the rows of their ids; pieces after none: their ids
        self.known: dict[str, int] = {}
        self.table = _NOTHING
        self.heads: dict[str, bytes] = {"": b""}
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        # letters alone need no search for borders: the library gets them as its own byte table writes them
        byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        written = dict(zip(range(256), map(chr, range(256)), strict=True))
        for c in filter(_LETTERS.fullmatch, map(chr, range(0x250))):
            written.update(zip(c.encode(), byte_level.pre_tokenize_str(c)[0][0], strict=True))
        self.written = "".join(written.values())
        self.letters = Tokenizer(self.tokenizer.model)
        self.letters.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        self.opens = np.zeros(max(vocab.values()) + 1, bool)
        self.opens[[i for t, i in vocab.items() if t.startswith("\u0120")]] = True  # a space, as byte-level vocabularies write it
        self.line_end = np.zeros(len(self.opens), bool)
        self.line_end[vocab["\u010a"]] = True  # likewise

    def _fresh(self, pieces: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def _words(self, words: pa.StringArray) -> Ragged:
        """Ids of distinct words that a space in front sets apart: those of the
        letters that a word starts with, then those of what follows them."""
        starts, tails, alone = _cut(words)
        starts, tails = starts.dictionary_encode(), tails.dictionary_encode()
        letters = np.zeros(len(starts.dictionary), bool)
        letters[starts.indices.to_numpy()] = alone
        first = _strings(starts.dictionary)
        rows = self._rows(first, letters)[starts.indices.to_numpy()]
        ends = _ragged(self._pieces(_strings(tails.dictionary)))
        parts = _joined(self.table, ends)
        both = np.empty(2 * len(words), np.int64)
        both[::2], both[1::2] = rows, len(self.table[1]) + tails.indices.to_numpy()
        flat = _filled(both, parts)
        lengths = parts[2][both].reshape(-1, 2).sum(axis=1, dtype=np.int32)
        if len(self.known) > MEMO:
            self._forget(first)
        return flat, np.cumsum(lengths) - lengths, lengths

    def _rows(self, words: list[str], letters: np.ndarray) -> np.ndarray:
        """Rows of distinct words in the table, which gets those not known;
        ``letters`` marks those of such letters alone."""
        known, added = self.known, []
        rows = np.array(list(map(known.get, words, repeat(-1))), np.int64)
        unknown = rows < 0
        for alone in (False, True):
            at = np.flatnonzero(unknown & (letters == alone))
            new, n = [words[i] for i in at.tolist()], len(known)
            known.update(zip(new, range(n, n + len(new)), strict=True))
            rows[at] = np.arange(n, n + len(new))
            added += [self._after_space(new[i : i + WORDS], alone) for i in range(0, len(new), WORDS)]
        if added:
            self.table = _joined(self.table, *added)
        return rows

    def _forget(self, words: list[str]) -> None:
        """Remember only ``words``, the last ones met."""
        rows = np.array([self.known[w] for w in words], np.int64)
        lengths = self.table[2][rows]
        self.table = _filled(rows, self.table), np.cumsum(lengths) - lengths, lengths
        self.known = dict(zip(words, range(len(words)), strict=True))

    def _after_space(self, words: list[str], letters: bool) -> Ragged:
        """Ids of words, of letters alone or any, each with a space in front."""
        if letters:
            return self._apart(self.letters, codecs.charmap_decode((" " + " ".join(words)).encode(), "strict", self.written)[0].replace(" ", " \u0120"), words, " ")
        return self._apart(self.tokenizer, " " + " ".join(words), words, " ")

    def _apart(self, tokenizer, text: str, pieces: list[str], border: str) -> Ragged:
        """Ids of pieces that the library gets in one text, each behind a
        border: a space, which is part of a piece's first id, or a line end,
        which has an id of its own."""
        opens, skip = (self.opens, 0) if border == " " else (self.line_end, 1)
        ids = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        at = np.flatnonzero(opens[ids])
        if len(at) != len(pieces):
            return _ragged([x[4 * skip :] for x in self._fresh([border + p for p in pieces])])
        return ids, at + skip, np.diff(np.r_[at, len(ids)]).astype(np.int32) - np.int32(skip)

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces that no space stands in front of, by their parts."""
        heads = self.heads
        if len(heads) > MEMO // 10:
            heads = self.heads = {"": b""}
        parts = list(map(_parts, pieces))
        new = list(dict.fromkeys(x for some in parts for x in some if x not in heads))
        lone = [p for p in new if not (p[0].isspace() or p[-1].isspace() or "\n" in p)]
        for i in range(0, len(lone), WORDS):
            some = lone[i : i + WORDS]
            flat, begins, lengths = self._apart(self.tokenizer, "\n" + "\n".join(some), some, "\n")
            raw = flat.astype("<u4").tobytes()
            heads.update((p, raw[4 * a : 4 * (a + n)]) for p, a, n in zip(some, begins.tolist(), lengths.tolist(), strict=True))
        rest = [p for p in new if p not in heads]
        heads.update(zip(rest, self._fresh(rest), strict=True))
        return [heads[x[0]] if len(x) == 1 else b"".join([heads[p] for p in x]) for x in parts]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text.  A text that holds an added token's string is
        encoded as a whole, since that string is a border of its own wherever it
        stands."""
        whole = {i for i, t in enumerate(texts) if any(a in t for a in self.added)}
        out = dict(zip(whole, self._fresh([texts[i] for i in whole]), strict=True))
        rest = [i for i in range(len(texts)) if i not in whole]
        at = 0
        while at < len(rest):
            end, size = at, 0
            while end < len(rest) and (end == at or size + len(texts[rest[end]]) <= TOGETHER):
                size += len(texts[rest[end]])
                end += 1
            out.update(zip(rest[at:end], self._together([texts[i] for i in rest[at:end]]), strict=True))
            at = end
        return [out[i] for i in range(len(texts))]

    def _together(self, texts: list[str]) -> list[bytes]:
        """Ids of texts by their distinct words: each is looked up once, and the
        places are filled in from the words' numbers."""
        split = pc.split_pattern(pa.array(texts, pa.string()), " ")
        first = split.offsets.to_numpy().astype(np.int64)
        coded = split.values.dictionary_encode()
        number, words = coded.indices.to_numpy(), coded.dictionary
        # some space has white space (or an end) at its side: not a border
        trimmed = pc.utf8_trim_whitespace(words)
        odd = pc.or_(pc.equal(trimmed, ""), pc.not_equal(trimmed, words)).to_numpy(zero_copy_only=False)
        plain = np.ones(len(texts), bool)
        used = np.ones(len(words), bool)
        if odd.any():
            plain = ~np.logical_or.reduceat(odd[number], first[:-1])
            used[:] = False
            used[number[np.repeat(plain, np.diff(first))]] = True
        ids = self._words(words.filter(pa.array(used)))
        row = np.cumsum(used, dtype=np.int32) - 1
        rows = row[number]
        rows[first[:-1][plain]] = len(ids[1]) + np.arange(plain.sum())
        ids = _joined(ids, _ragged(self._pieces(_strings(words.take(pa.array(number[first[:-1][plain]]))))))
        out, held = [], []
        for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
            if not plain[i]:
                out.append(self._odd(texts[i].split(" ")))
                continue
            out.append(b"")
            held.append(i)
            if i + 1 == len(texts) or not plain[i + 1] or b - int(first[held[0]]) >= BLOCK:
                some = rows[first[held[0]] : b]
                spans = _filled(some, ids).tobytes()
                ends = np.r_[0, np.cumsum(ids[2][some], dtype=np.int64)][first[np.array(held) + 1] - first[held[0]]] * 4
                for j, c, d in zip(held, [0, *ends[:-1].tolist()], ends.tolist(), strict=True):
                    out[j] = spans[c:d]
                held = []
        return out

    def _odd(self, parts: list[str]) -> bytes:
        """Ids of a text some of whose spaces are no borders: cut at the others."""
        pieces, held = [], parts[0]
        for w in islice(parts, 1, None):
            if held and w and not held[-1].isspace() and not w[0].isspace():
                pieces.append(held)
                held = " " + w
            else:
                held += " " + w
        return b"".join(self._fresh([*pieces, held]))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder a worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


#: Bits of a cell in the hash table of pairs, at most: a core's cache holds it.
CELLS = 19


def _cell(pairs: np.ndarray, bits: int) -> np.ndarray:
    return ((pairs * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits)).astype(np.intp)


def compress(ids: np.ndarray, terminals: int, min_uses: int = MIN_USES, rounds: int | None = None, fall: int = FALL) -> tuple[np.ndarray, np.ndarray]:
    """Re-Pair: ``rules`` (two symbols each; the i-th is symbol ``terminals +
    i``) and the sequence that is left, in which no pair has ``min_uses`` places
    unless symbols (or ``rounds``, where given) are used up."""
    seq = ids.astype(np.uint32)
    rules: list[np.ndarray] = []
    n_rules, bound, n_rounds = 0, None, 0
    # places whose pair may be frequent; a pair that is not never becomes so, as
    # a round only makes new neighbours of its new symbols
    at = np.arange(max(0, len(seq) - 1))
    while len(at) and n_rules < SYMBOLS - terminals and n_rounds != rounds:
        n_rounds += 1
        pairs = (seq[:-1] << np.uint32(16)) | seq[1:]
        if len(at) < len(pairs):
            pairs = pairs.take(at)
        beside = np.r_[False, at[1:] == at[:-1] + 1]
        # in a run of one symbol every second place may start a pair
        free, second = np.ones(len(at), bool), at[:0]
        run = np.flatnonzero(beside & np.r_[False, pairs[1:] == pairs[:-1]])
        if len(run):
            first = np.r_[True, np.diff(run) > 1]
            offset = run - np.maximum.accumulate(np.where(first, run, 0))
            second = run[offset % 2 == 0]
            free[second] = False
        # only cells of a hash table that are full enough can hold a frequent pair
        bits = min(CELLS, len(at).bit_length())
        cell = _cell(pairs, bits)
        held = np.bincount(cell, minlength=1 << bits)
        if len(second):
            held -= np.bincount(cell[second], minlength=1 << bits)
        warm = np.flatnonzero((held >= min_uses).take(cell))
        at, pairs, cell, free = at.take(warm), pairs.take(warm), cell.take(warm), free.take(warm)
        bound = bound and max(min_uses, bound // fall)
        hot = free & (held >= bound).take(cell) if bound else free
        ordered = np.sort(pairs.take(np.flatnonzero(hot)))
        starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]][: len(ordered)])
        counts = np.diff(np.r_[starts, len(ordered)])
        top = int(counts.max(initial=0))
        bound = bound or max(min_uses, top // fall)
        if top < bound:
            if bound <= min_uses:
                break
            continue
        often = np.flatnonzero(counts >= bound)
        codes = ordered[starts[often]]
        # the most frequent first; of equals in no order that a text could follow
        by_count = np.lexsort((codes * np.uint32(0x9E3779B1), -counts[often]))[: SYMBOLS - terminals - n_rules]
        none = np.int32(len(by_count))
        order = np.full(len(codes), none, np.int32)
        order[by_count] = np.arange(none, dtype=np.int32)
        beside = np.r_[False, at[1:] == at[:-1] + 1][: len(at)]
        # rank of each place's pair, 0 for the most frequent
        rank = np.full(len(at), none, np.int32)
        cells = _cell(codes, bits)
        one = np.full(1 << bits, -1, np.int32)  # a code of each cell
        one[cells] = np.arange(len(codes), dtype=np.int32)
        slot = one.take(cell)
        near = np.flatnonzero(free & (slot >= 0))
        slot, pair = slot.take(near), pairs.take(near)
        same = codes.take(slot) == pair
        more = np.flatnonzero(~same)
        more = more.take(np.flatnonzero((np.bincount(cells, minlength=1 << bits) > 1).take(cell.take(near.take(more)))))
        slot[more] = np.minimum(np.searchsorted(codes, pair[more]), len(codes) - 1)
        same[more] = codes[slot[more]] == pair[more]
        rank[near] = np.where(same, order.take(slot), none)
        # the most frequent pairs take their places first, others where nothing
        # overlaps: that is every second place up a slope of ranks, and a peak
        # that is the second of both its slopes
        index = np.arange(len(at), dtype=np.int32)
        rising = beside & np.r_[False, rank[:-1] < rank[1:]]
        falling = np.r_[beside[1:] & (rank[1:] < rank[:-1]), False]
        up = index - np.maximum.accumulate(index * ~rising)
        down = (index - np.maximum.accumulate(index * ~falling[::-1]))[::-1]
        take = np.flatnonzero((rank < none) & ((up | down) & 1 == 0))
        by = rank.take(take)
        worth = np.bincount(by, minlength=none) >= min_uses
        some = np.flatnonzero(worth.take(by))
        where, by = at.take(take.take(some)), by.take(some)
        kept = np.flatnonzero(worth)
        codes = codes[by_count]
        name = np.zeros(len(codes), np.uint32)
        name[kept] = terminals + n_rules + np.arange(len(kept), dtype=np.uint32)
        rules.append(np.stack([codes[kept] >> np.uint32(16), codes[kept] & np.uint32(0xFFFF)], axis=1))
        n_rules += len(kept)
        seq[where] = name.take(by)
        stay, look = np.ones(len(seq), bool), np.zeros(len(seq), bool)
        stay[where + 1] = False
        look[at] = True
        look[where] = look[np.maximum(where - 1, 0)] = True
        stay = np.flatnonzero(stay)
        seq = seq.take(stay)
        at = np.flatnonzero(look.take(stay)[:-1])
    return (np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)).astype(np.uint16), seq.astype(np.uint16)


def expansion_lengths(rules: np.ndarray, terminals: int) -> np.ndarray:
    """Ids that each rule stands for; rules only name earlier ones."""
    out = np.zeros(len(rules), np.int64)
    known = np.zeros(len(rules), bool)
    while not known.all():
        parts = rules.astype(np.int64) - terminals
        done = ((parts < 0) | known[np.maximum(parts, 0)]).all(axis=1) & ~known
        lengths = np.where(parts < 0, 1, out[np.maximum(parts, 0)]).sum(axis=1)
        out[done] = lengths[done]
        known |= done
    return out


def expand(seq: np.ndarray, rules: np.ndarray, terminals: int) -> np.ndarray:
    """The ids of a sequence of symbols."""
    while True:
        at = np.flatnonzero(seq >= terminals)
        if not len(at):
            return seq.astype(np.uint32)
        times = np.ones(len(seq), np.uint8)
        times[at] = 2
        out = np.repeat(seq, times)
        pair = rules[seq[at] - np.uint16(terminals)]
        at += np.arange(len(at))  # the first of both places
        out[at], out[at + 1] = pair[:, 0], pair[:, 1]
        seq = out


class Shard:
    """A blob, opened: documents and ranges of ids can be decoded alone."""

    def __init__(self, blob: bytes):
        magic, self.terminals, n_rules, n_seq, n_docs = struct.unpack_from("<4sIIQI", blob)
        if magic != _MAGIC:
            raise ValueError("not a shard of token ids")
        at = struct.calcsize("<4sIIQI")

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(blob, kind, n, at)
            at += out.nbytes
            return out

        self.rules = take("<u2", 2 * n_rules).reshape(-1, 2)
        self.lengths = take("<u4", n_rules)
        self.seq = take("<u2", n_seq)
        self.starts = take("<u4", n_docs + 1)
        self._ends: np.ndarray | None = None

    def ids(self) -> np.ndarray:
        """All ids of the shard."""
        lengths, n = self.lengths.astype(np.int32), int(self.starts[-1])
        if lengths.sum(dtype=np.int64) > n:
            return expand(self.seq, self.rules, self.terminals)
        own = np.arange(self.terminals, dtype=np.uint32)
        rules = expand(self.rules.ravel(), self.rules, self.terminals), np.cumsum(lengths, dtype=np.int64) - lengths, lengths
        return _filled(self.seq, _joined((own, own.astype(np.int64), np.ones(self.terminals, np.int32)), rules))

    def range(self, start: int, end: int) -> np.ndarray:
        """The ids from ``start`` to ``end``, expanding only the symbols that hold
        them."""
        if self._ends is None:
            symbols = self.seq.astype(np.int64) - self.terminals
            size = np.ones(len(symbols), np.int64)
            size[symbols >= 0] = self.lengths[symbols[symbols >= 0]]
            self._ends = np.cumsum(size)
        a = int(np.searchsorted(self._ends, start, side="right"))
        b = int(np.searchsorted(self._ends, end, side="left")) + 1
        skip = start - (int(self._ends[a - 1]) if a else 0)
        return expand(self.seq[a:b], self.rules, self.terminals)[skip : skip + end - start]

    def document(self, i: int) -> np.ndarray:
        return self.range(int(self.starts[i]), int(self.starts[i + 1]))


def pack(ids: np.ndarray, starts: np.ndarray, terminals: int) -> bytes:
    """The blob of a shard: ``starts`` are those of its documents, and the end."""
    rules, seq = compress(ids, terminals)
    head = struct.pack("<4sIIQI", _MAGIC, terminals, len(rules), len(seq), len(starts) - 1)
    lengths = expansion_lengths(rules, terminals)
    return b"".join([head, rules.astype("<u2").tobytes(), lengths.astype("<u4").tobytes(), seq.astype("<u2").tobytes(), starts.astype("<u4").tobytes()])


def write(documents: DataFrame, tokenizer_path: str, end_id: int = END_ID, shard_ids: int = SHARD_IDS, parts: int | None = None) -> DataFrame:
    """Encode ``documents (doc_id, text)`` and write the shards as a table, read
    back: ``part, shard`` (their order), ``doc_ids``, ``n_ids`` and ``blob``."""
    spark = documents.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ranged = docs.repartitionByRange(parts, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(tokenizer_path), TaskContext.get().partitionId()
        terminals = max(enc.tokenizer.get_vocab_size(with_added_tokens=True), end_id + 1)
        end = np.array([end_id], "<u4").tobytes()
        shard, held, size, ids = 0, [], 0, []

        def flush() -> pa.RecordBatch:
            starts = np.r_[0, np.cumsum([len(x) // 4 for x in held])]
            blob = pack(np.frombuffer(b"".join(held), "<u4"), starts, terminals)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([ids], pa.list_(pa.int64())), pa.array([int(starts[-1])], pa.int64()), pa.array([blob], pa.binary())], ["part", "shard", "doc_ids", "n_ids", "blob"])

        for b in batches:
            for at in range(0, b.num_rows, ROWS):
                some = b.slice(at, ROWS)
                for doc_id, raw in zip(some.column("doc_id").to_pylist(), enc.encode(some.column("text").to_pylist()), strict=True):
                    held.append(raw + end)
                    ids.append(doc_id)
                    size += len(held[-1]) // 4
                    if size >= shard_ids:
                        yield flush()
                        shard, held, size, ids = shard + 1, [], 0, []
        if held:
            yield flush()

    return written(ranged.mapInArrow(run, "part int, shard int, doc_ids array<long>, n_ids long, blob binary"), "shards")


def read(shards: DataFrame) -> DataFrame:
    """Per document, from the shards: ``doc_id``, ``start`` (ids of all documents
    before it), ``n_tokens`` and ``ids_crc32``."""
    # first ids of the parts, a row each, then of the shards within a part
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("ids")).select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    firsts = shards.select("part", "shard", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("ahead")).join(parts, "part")
    firsts = firsts.select("part", "shard", (F.col("first") + F.col("ahead")).alias("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                shard = Shard(b.column("blob")[i].as_py())
                ids, starts = shard.ids().astype("<u4"), shard.starts.astype(np.int64)
                crc = [zlib.crc32(ids[a:e]) for a, e in zip(starts[:-1], starts[1:], strict=True)]
                n = len(crc)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b.column("part")[i].as_py()] * n, pa.int32()), pa.array([b.column("shard")[i].as_py()] * n, pa.int32()), b.column("doc_ids")[i].values.cast(pa.int64()),
                     pa.array(starts[:-1], pa.int64()), pa.array(np.diff(starts), pa.int64()), pa.array(crc, pa.int64())], ["part", "shard", "doc_id", "inside", "n_tokens", "ids_crc32"])

    docs = shards.select("part", "shard", "doc_ids", "blob").mapInArrow(run, "part int, shard int, doc_id long, inside long, n_tokens long, ids_crc32 long")
    return docs.join(firsts, ["part", "shard"]).select("doc_id", (F.col("first") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def read_documents(shards: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(doc_id, ids)`` of the documents named in ``wanted (doc_id)``, each
    decoded alone."""
    found = shards.select("doc_ids", "blob", F.explode("doc_ids").alias("doc_id")).join(wanted.select("doc_id").distinct(), "doc_id")
    near = found.groupBy("blob").agg(F.first("doc_ids").alias("doc_ids"), F.collect_set("doc_id").alias("want"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for blob, ids, want in zip(*(b.column(c).to_pylist() for c in ("blob", "doc_ids", "want")), strict=True):
                shard, want = Shard(blob), set(want)
                rows = [(d, shard.document(i).tolist()) for i, d in enumerate(ids) if d in want]
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.list_(pa.int64()))], ["doc_id", "ids"])

    return near.mapInArrow(run, "doc_id long, ids array<long>")
