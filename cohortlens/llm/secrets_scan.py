"""Secret scans with a character convolutional network (operator 9).

Strict patterns give the base spans.  Every long unbroken token of a text is a
candidate besides.  The network, in numpy, reads the candidate with the text
around it, a long one in overlapping windows of which the likeliest counts:
characters become classes, an embedding, one convolution, a
maximum over the candidate's places and one over those around it, and a
logistic layer.  It is trained on all labelled findings of the corpus, every
window of them: base spans as secrets; as none tokens of one letter
case without digits, numbers and rules of signs.  Each finding is also shown
in another form, secrets drawn anew from other alphabets, alone or amid lower
case, and words in other cases, and half of all are shown without context, so that the token itself
has to convince.  As none the network is also shown tokens composed of all the
corpus's words, with dates, versions and numbers.  Findings and words are dealt
into groups by a hash; in a round each group goes on from the same weights, in
a task of its own, and the mean of what the groups come to starts the next
round.  A quarter of the findings and words, told apart by a hash, is held out;
all of it calibrates the logit (Platt) and sets the threshold, by counts of
logits in narrow bins: the highest that keeps
``recall`` of the held-out secrets drawn anew, with room for the chance of that
draw.  Candidates at or above it that overlap no base span are added with kind ``token``.

Cases: null and empty texts have no spans; repeated rows and null ids are
judged like others; where there are no secrets, or nothing else, to learn
from, no span is added; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import with_computed, written

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
#: Candidates: long unbroken tokens.
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Composed tokens that a group is shown in a round at least, and those that the
#: words of a group make together, about.
LEAST, GROUP = 6000, 32768
#: Rounds of training, and how often a group's examples are gone through in each.
ROUNDS, EPOCHS = 4, 3
RECALL = 0.98
#: Characters read before a candidate, inside it at once, and after it, and how
#: far apart the windows of a longer one start.
BEFORE, INSIDE, AFTER, STEP = 24, 40, 8, 5
#: Windows judged at once, and pieces that a long finding is cut into at most.
TOGETHER, DRAWABLE = 4096, 64
WIDTH, CHANNELS, EMBED, BATCH, RATE = 5, 24, 12, 64, 0.01
#: Bins of logits: so many to one, and the largest logit told apart.
BINS, REACH = 256, 32

# Character classes: the alphabet that secrets are written in one by one, the
# rest by kind; 0 pads.
_ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ+/_=-.:\"' "
_CODE = {c: i + 1 for i, c in enumerate(_ALPHABET)}
_ALPHABETS = ("0123456789abcdef", "0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", _ALPHABET[:36], _ALPHABET[:62], _ALPHABET[:62], _ALPHABET[:64], _ALPHABET[:62] + "_-")
_PATH = _ALPHABET[:26] + "/_-"
_LETTER, _OTHER = len(_ALPHABET) + 1, len(_ALPHABET) + 2
CLASSES = _OTHER + 1
LENGTH = BEFORE + INSIDE + AFTER
_WORD = re.compile(r"\b[A-Za-z]{3,10}\b")
#: Words that a task remembers as sent.
SENT = 200_000


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, rank of the kind, end)`` of the base spans, in order."""
    out = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Tokens that overlap no base span."""
    out, i, reach = [], 0, 0
    for m in TOKEN.finditer(text):
        while i < len(base) and base[i][0] < m.end():
            reach = max(reach, base[i][2])
            i += 1
        if reach <= m.start():
            out.append(m.span())
    return out


def label(token: str) -> int | None:
    """0 for a token that is no secret: no letter, or no digit and one letter
    case (but for a capital in front); None for one that the network has to
    judge."""
    digits, letters = any(c.isdigit() for c in token), any(c.isalpha() for c in token)
    if not letters:
        return 0
    rest = token[1:]
    return 0 if not digits and (rest.islower() or rest.isupper()) else None


def composed(words: list[str], rng: np.random.Generator, unread: list[str] | None = None) -> str:
    """A token that is no secret though it has a secret's signs and digits: a path
    or name made of words of the corpus, dates, versions and numbers.  Words are
    taken out of ``unread`` while it has any."""
    mark = ("_", "-", "/", "=", "")[rng.integers(5)]
    form = (str.lower, str.upper, str.title)[rng.integers(3)] if mark else str.title
    out, least = "", int(rng.integers(20, INSIDE + 8))
    while len(out) < least:
        kind = rng.random()
        if kind < 0.62 and words:
            part = form(unread.pop() if unread else words[rng.integers(len(words))])
        elif kind < 0.8:
            part = str(rng.integers(10 ** int(rng.integers(1, 6))))
        elif kind < 0.93:
            inner = ("-", "_", "/", "")[rng.integers(4)]
            part = inner.join((str(rng.integers(1990, 2040)), f"{rng.integers(1, 13):02d}", f"{rng.integers(1, 32):02d}"))
            if rng.random() < 0.4:
                part += "T" + inner.join(f"{rng.integers(60):02d}" for _ in range(3))
        else:
            part = f"v{rng.integers(20)}" + (f"_{rng.integers(20)}" if rng.random() < 0.5 else "")
        out += (("_", "-", "/")[rng.integers(3)] if mark and rng.random() < 0.2 else mark) * bool(out) + part
    return out


def other_form(window: str, y: int, rng: np.random.Generator, words: list[str] = (), unread: list[str] | None = None) -> str:
    """A finding in another form: a secret drawn anew from some alphabet, half
    of the long ones with lower-case ends, as in a window over part of a path; a
    token that is none in another case, or, given ``words``, composed of them."""
    token = window[BEFORE : BEFORE + INSIDE].rstrip("\0")
    if y:
        alphabet = _ALPHABETS[rng.integers(len(_ALPHABETS))]
        token = "".join(alphabet[i] for i in rng.integers(len(alphabet), size=max(20, len(token))))[:INSIDE]
        if len(token) == INSIDE and rng.random() < 0.5:
            n = int(rng.integers(INSIDE // 2 + 1))
            left, ends = int(rng.integers(n + 1)), "".join(_PATH[i] for i in rng.integers(len(_PATH), size=n))
            token = ends[:left] + token[left : INSIDE - (n - left)] + ends[left:]
    elif words:
        token = composed(words, rng, unread)
        at = int(rng.integers(max(1, len(token) - INSIDE + 1)))  # a window over part of a long one
        token = token[at:]
    else:
        token = (token.upper(), token.lower(), token.title())[rng.integers(3)]
    return window[:BEFORE] + token[:INSIDE].ljust(INSIDE, "\0") + window[BEFORE + INSIDE :]


def windows(text: str, start: int, end: int) -> Iterator[str]:
    """The parts of a candidate, which overlap and leave no place out, each with
    the context of the whole, at fixed places, padded with NUL."""
    before, after = text[max(0, start - BEFORE) : start].rjust(BEFORE, "\0"), text[end : end + AFTER].ljust(AFTER, "\0")
    last = max(start, end - INSIDE)
    for a in (*range(start, last, STEP), last):
        yield before + text[a : min(end, a + INSIDE)].ljust(INSIDE, "\0") + after


def pieces(text: str, start: int, end: int) -> list[str]:
    """A finding in at most ``DRAWABLE`` pieces, each between the context of the
    whole: the windows of the pieces are those of the finding, none twice, and
    together the pieces are little longer than it."""
    before, after = text[max(0, start - BEFORE) : start].rjust(BEFORE, "\0"), text[end : end + AFTER].ljust(AFTER, "\0")
    last = max(start, end - INSIDE)
    reach = STEP * max(DRAWABLE, -(-(last - start) // (STEP * DRAWABLE)))
    out = []
    for a in range(start, max(last, start + 1), reach):
        b = last if a + reach >= last else a + reach - STEP
        out.append(before + text[a : min(end, b + INSIDE)].ljust(INSIDE, "\0") + after)
    return out


def piece_windows(piece: str) -> list[str]:
    return list(windows(piece, BEFORE, len(piece) - AFTER))


_CODES = np.array([_CODE.get(chr(i)) or (0 if i == 0 else _LETTER if chr(i).isalpha() else _OTHER) for i in range(1 << 16)], np.uint8)


def codes(windows: list[str]) -> np.ndarray:
    points = np.frombuffer("".join(windows).encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(windows), LENGTH)
    out = _CODES[points & 0xFFFF]
    for i, j in np.argwhere(points > 0xFFFF):
        out[i, j] = _LETTER if chr(points[i, j]).isalpha() else _OTHER
    return out


@dataclass
class Network:
    """Weights, calibration, threshold, and the share of secrets among the
    held-out findings that pass it."""

    embed: np.ndarray
    conv: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    scale: float = 1.0
    shift: float = 0.0
    threshold: float = 1.1
    precision: float = 1.0

    @staticmethod
    def new(rng: np.random.Generator) -> Network:
        embed = rng.normal(0, 0.3, (CLASSES, EMBED))
        embed[0] = 0
        return Network(embed, rng.normal(0, 1 / np.sqrt(WIDTH * EMBED), (WIDTH * EMBED, CHANNELS)), np.zeros(CHANNELS), np.zeros(2 * CHANNELS), 0.0)

    def forward(self, x: np.ndarray) -> tuple:
        # a class has one contribution for each place in a patch
        by_class = self.embed @ self.conv.reshape(WIDTH, EMBED, CHANNELS)
        n = LENGTH - WIDTH + 1
        h = by_class[0][x[:, :n]]
        for k in range(1, WIDTH):
            h += by_class[k][x[:, k : k + n]]
        inside = h[:, BEFORE : BEFORE + INSIDE - WIDTH + 1]
        around = np.concatenate([h[:, :BEFORE], h[:, BEFORE + INSIDE - WIDTH + 1 :]], axis=1)
        at = inside.argmax(axis=1), around.argmax(axis=1)
        pooled = np.concatenate([inside.max(axis=1) + self.bias, around.max(axis=1) + self.bias], axis=1)
        pooled = np.maximum(pooled, 0)
        return pooled @ self.out + self.out_bias, pooled, at

    def logits(self, windows: list[str]) -> np.ndarray:
        return np.concatenate([self.forward(codes(windows[i : i + 512]))[0] for i in range(0, len(windows), 512)] or [np.zeros(0)])

    def probability(self, windows: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * self.logits(windows) + self.shift, -30, 30)))

    def gradients(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | float = 1.0) -> list[np.ndarray]:
        logit, pooled, at = self.forward(x)
        d = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y) * weight / len(x)
        d_pooled = d[:, None] * self.out * (pooled > 0)
        place = [at[0] + BEFORE, np.where(at[1] < BEFORE, at[1], at[1] + INSIDE - WIDTH + 1)]
        rows, channel = np.arange(len(x))[:, None], np.arange(CHANNELS)
        conv = self.conv.reshape(WIDTH, EMBED, CHANNELS)
        d_conv, d_bias, d_embed = np.zeros_like(conv), np.zeros_like(self.bias), np.zeros_like(self.embed)
        halves = [d_pooled[:, :CHANNELS], d_pooled[:, CHANNELS:]]
        values = np.concatenate([g.ravel() for g in halves])
        for k in range(WIDTH):
            cells = np.concatenate([(x[rows, p + k].astype(np.int64) * CHANNELS + channel).ravel() for p in place])
            by_class = np.bincount(cells, values, CLASSES * CHANNELS).reshape(CLASSES, CHANNELS)
            d_conv[k] = self.embed.T @ by_class
            d_embed += by_class @ conv[k].T
        d_bias = halves[0].sum(axis=0) + halves[1].sum(axis=0)
        d_embed[0] = 0
        return [d_embed, d_conv.reshape(self.conv.shape), d_bias, pooled.T @ d, np.array(d.sum())]


_SHAPES = ((CLASSES, EMBED), (WIDTH * EMBED, CHANNELS), (CHANNELS,), (2 * CHANNELS,), ())
_CUTS = np.cumsum([int(np.prod(shape)) for shape in _SHAPES])
N_WEIGHTS = int(_CUTS[-1])


def start(seed: int) -> np.ndarray:
    """State of training: the steps done, then weights and both of Adam's means."""
    net = Network.new(np.random.default_rng(seed))
    weights = np.concatenate([np.ravel(w) for w in (net.embed, net.conv, net.bias, net.out, net.out_bias)])
    return np.concatenate([[0.0], weights, np.zeros(2 * N_WEIGHTS)])


def network(weights: np.ndarray) -> Network:
    parts = [w.reshape(shape) for w, shape in zip(np.split(weights, _CUTS[:-1]), _SHAPES, strict=True)]
    return Network(*parts[:-1], float(parts[-1]))


def is_held(found: str) -> bool:
    """Whether a finding or word is held out from training."""
    return hashlib.md5(found.encode("utf-8", "surrogatepass")).digest()[0] < 64


def examples(found: list[tuple[int, str, int]], words: list[str], rng: np.random.Generator, least: int, turn: int = 0, turns: int = 1) -> tuple:
    """Codes, labels, weights, and whether drawn anew, of a group's examples in
    one of ``turns``: of each piece ``(label, piece, pieces of the finding)`` the
    windows whose turn it is, one at least, which share its weight, and another
    form of each; more secrets drawn anew if those are few; and tokens composed
    of the words, all words whose turn it is among them."""
    own, y, weight = [], [], []
    for label_, piece, k in found:
        ws = piece_windows(piece)
        ws = ws[turn::turns] if turn < len(ws) else [ws[turn % len(ws)]]
        own += ws
        y += [label_] * len(ws)
        weight += [1 / (k * len(ws))] * len(ws)
    blank = [" " * BEFORE + "\0" * INSIDE + " " * AFTER]
    more = [other_form(w, k, rng) for w, k in zip(own, y, strict=True)]
    unread = [words[i] for i in rng.permutation(np.arange(turn, len(words), turns))] if len(words) else []
    n, made, around = max(least, round(sum(weight))) if words else 0, [], own or blank
    while len(made) < n or unread:
        made.append(other_form(around[rng.integers(len(around))], 0, rng, words, unread))
    # few secrets are shown in many forms, and composed tokens outnumber them: no sign or digit alone makes one
    secret = [w for w, k in zip(own, y, strict=True) if k] or around
    lighter = sum(w for w, k in zip(weight, y, strict=True) if not k)
    again = round(max(0.0, lighter + len(made) / 2 - 2 * (sum(weight) - lighter)))
    again = [other_form(secret[i], 1, rng) for i in rng.integers(len(secret), size=again)]
    x = codes(own + more + again + made) if own or again or made else np.zeros((0, LENGTH), np.uint8)
    labels = np.array(y + y + [1] * len(again) + [0] * len(made), float)
    weights = np.array(weight + weight + [1.0] * (len(again) + len(made)))
    return x, labels, weights, np.arange(len(x)) >= len(own)


def _bare(x: np.ndarray) -> np.ndarray:
    """Findings without their context."""
    out = x.copy()
    out[:, :BEFORE] = out[:, BEFORE + INSIDE :] = _CODE[" "]
    return out


def improved(state: np.ndarray, found: list, words: list[str], turn: int, seed: list[int]) -> np.ndarray:
    """The state after a round of Adam on a group's examples."""
    rng = np.random.default_rng([*seed, turn])
    x, y, weight, _ = examples(found, words, rng, LEAST, turn, ROUNDS)
    bare, step = _bare(x), state[0]
    w, mean, square = state[1:].reshape(3, -1).copy()
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for i in range(0, len(order), BATCH):
            rows = order[i : i + BATCH]
            blank = (rng.random(len(rows)) < 0.5)[:, None]
            g = np.concatenate([np.ravel(v) for v in network(w).gradients(np.where(blank, bare[rows], x[rows]), y[rows], weight[rows])])
            step += 1
            mean += 0.1 * (g - mean)
            square += 0.001 * (g * g - square)
            w -= RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return np.concatenate([[step], w, mean, square])


def counted(net: Network, found: list, words: list[str], seed: list[int]) -> pd.DataFrame:
    """Weight of a group's held-out examples in each bin of logits, in millionths:
    ``y, drawn, z, n``."""
    x, y, weight, drawn = examples(found, words, np.random.default_rng([*seed, ROUNDS]), LEAST // 4)
    # secrets are held to their bare form, as added tokens have no keyword in front
    x = np.where((y == 1)[:, None], _bare(x), x)
    z = np.concatenate([net.forward(x[i : i + 512])[0] for i in range(0, len(x), 512)] or [np.zeros(0)])
    bins = np.floor(np.clip(z, -REACH, REACH) * BINS).astype(np.int64)
    rows = pd.DataFrame({"y": y.astype(np.int64), "drawn": drawn.astype(np.int64), "z": bins, "n": np.maximum(1, np.rint(weight * 1e6)).astype(np.int64)})
    return rows.groupby(["y", "drawn", "z"], as_index=False)["n"].sum()


def calibrated(net: Network, counts: pd.DataFrame, recall: float = RECALL) -> Network:
    """The network with calibration and threshold from the bins of logits."""
    counts = counts.sort_values(["z", "y", "drawn"])
    y, low, n = counts["y"].to_numpy(float), counts["z"].to_numpy(float) / BINS, counts["n"].to_numpy(float) / 1e6
    if not (y == 1).any() or not (y == 0).any():
        return net
    net.scale, net.shift = _platt(low + 0.5 / BINS, y, n)
    p = 1 / (1 + np.exp(-np.clip(net.scale * low + net.shift, -30, 30)))
    # base spans are found without the network: the threshold is for other forms
    drawn = (y == 1) & (counts["drawn"].to_numpy() == 1)
    against = drawn if drawn.any() else y == 1
    total = n[against].sum()
    # with room for the chance of the held-out draw (one side, 99%)
    miss = max(0.0, 1 - recall - 2.326 * np.sqrt(recall * (1 - recall) / total))
    # the lower end of the bin that the quantile is in
    at = min(np.searchsorted(np.cumsum(n[against]), miss * max(0.0, total - 1), side="right"), against.sum() - 1)
    net.threshold = float(p[against][at])
    flagged = p >= net.threshold
    net.precision = float(n[flagged & (y == 1)].sum() / n[flagged].sum()) if flagged.any() else 1.0
    return net


def _parted(found: list, words: list[str], held: bool) -> tuple[list, list[str]]:
    return [f for f in found if is_held(f[1]) == held], [w for w in words if is_held(w) == held]


def train(windows: list[str], labels: list[int], recall: float = RECALL, seed: int = 9, words: list[str] = ()) -> Network:
    """The network from the windows of one group of findings."""
    words = sorted({*words, *(m for w in windows for m in re.findall("[A-Za-z]{3,10}", w[:BEFORE] + " " + w[BEFORE + INSIDE :]))})
    found = sorted({(y, w, 1) for w, y in zip(windows, labels, strict=True)})
    if len({y for y, _, _ in found}) < 2:
        return Network.new(np.random.default_rng(seed))
    state = start(seed)
    for turn in range(ROUNDS):
        state = improved(state, *_parted(found, words, False), turn, [seed, 0])
    net = network(state[1 : N_WEIGHTS + 1])
    return calibrated(net, counted(net, *_parted(found, words, True), [seed, 0]), recall)


def _platt(z: np.ndarray, y: np.ndarray, n: np.ndarray, rounds: int = 200) -> tuple[float, float]:
    """Logistic fit of ``y``, ``n`` times each, on the logit, with Platt's
    smoothed targets, by damped Newton steps."""
    n1, n0 = n[y == 1].sum(), n[y == 0].sum()
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        w = n * p * (1 - p)
        grad = np.array([(n * (p - t) * z).sum(), (n * (p - t)).sum()])
        hess = np.array([[(w * z * z).sum() + 1e-3, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-3]])
        move = np.linalg.solve(hess, grad)
        move *= min(1.0, 1.0 / np.abs(move).max()) if np.abs(move).max() > 0 else 1.0
        a, b = a - move[0], b - move[1]
        if np.abs(move).max() < 1e-9:
            break
    return max(a, 1e-3), b


def _findings(texts: list[str | None]) -> list:
    """Labelled pieces of each text's findings, as ``label``, number of pieces of
    the finding, and piece."""
    out = []
    for t in texts:
        t = t or ""
        base = base_spans(t)
        rows = [("1", pieces(t, a, b)) for a, _, b in base]
        rows += [("0", pieces(t, a, b)) for a, b in candidates(t, base) if label(t[a:b]) == 0]
        out.append([f"{y}\n{len(ps)}\n{p}" for y, ps in rows for p in ps])
    return [out]


def _words(texts: list[str | None], sent: set[str]) -> list:
    """Words of each text that were not yet sent."""
    out = []
    for t in texts:
        new = set(_WORD.findall(t or "")) - sent
        if len(sent) > SENT:
            sent.clear()
        sent |= new
        out.append([f"w\n1\n{w}" for w in new])
    return [out]


def _rows(group: pd.DataFrame, held: bool) -> tuple[list, list[str]]:
    """A group's findings and words, those held out or the others."""
    rows = sorted(zip(group["y"], group["w"], group["k"], strict=True))
    return _parted([(int(y), w, int(k)) for y, w, k in rows if y != "w"], [w for y, w, _ in rows if y == "w"], held)


def _round(state: np.ndarray, turn: int, seed: int):
    def one(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"state": [improved(state, *_rows(group, False), turn, [seed, int(key[0])])]})

    return one


def fit(docs: DataFrame, text_col: str = "text", seed: int = 9) -> Network:
    """Train on all distinct labelled findings and all distinct words of the
    corpus, dealt into groups."""
    sent: set[str] = set()  # a task has its own

    def make(texts: list[str | None]) -> list:
        return _findings(texts) + _words(texts, sent)

    found = with_computed(docs, [], [text_col], {"found": "array<string>", "words": "array<string>"}, make)
    rows = found.select(F.explode(F.concat("found", "words")).alias("f")).select(F.substring_index("f", "\n", 1).alias("y"), F.substring_index(F.substring_index("f", "\n", 2), "\n", -1).cast("int").alias("k"), F.expr("substr(f, length(substring_index(f, '\n', 2)) + 2)").alias("w"))
    rows = written(rows.groupBy("y", "w").agg(F.min("k").alias("k")), "findings")
    sizes = F.when(F.col("y") == "w", 0.25).otherwise((F.length("w") - LENGTH) / STEP + 1)
    counts = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.sum(F.ceil(sizes * 4)).alias("n")).collect()}
    if not counts.get("1") or not counts.get("0"):
        return Network.new(np.random.default_rng(seed))
    n_groups = -(-sum(counts.values()) // (4 * GROUP))
    # more partitions than groups, so that few share one
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("w", F.lit(seed)), F.lit(n_groups))).repartition(4 * n_groups, "part").groupBy("part")
    state = start(seed)
    for turn in range(ROUNDS):
        # as whole numbers, whose sum no order changes
        sums = dealt.applyInPandas(_round(state, turn, seed), "state array<double>").select(F.posexplode("state")).groupBy("pos").agg(F.sum(F.rint(F.col("col") * 2.0**40).cast("long")).alias("s"), F.count("*").alias("n"))
        state = np.array([r["s"] / r["n"] for r in sums.orderBy("pos").collect()]) / 2.0**40
    net = network(state[1 : N_WEIGHTS + 1])

    def held(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        return counted(net, *_rows(group, True), [seed, int(key[0])])

    bins = dealt.applyInPandas(held, "y long, drawn long, z long, n long").groupBy("y", "drawn", "z").agg(F.sum("n").alias("n"))
    return calibrated(net, pd.DataFrame([tuple(r) for r in bins.collect()], columns=["y", "drawn", "z", "n"]))


def spans(texts: list[str | None], net: Network) -> list[tuple[list, list]]:
    """Base and added spans of each text."""
    out, held, where = [], [], []

    def judge() -> None:
        for (i, a, b), p in zip(where, net.probability(held), strict=True):
            # windows of one candidate follow each other
            if p >= net.threshold and (not out[i][1] or out[i][1][-1][0] != a):
                out[i][1].append((a, len(KINDS), b))
        held.clear()
        where.clear()

    for i, t in enumerate(texts):
        t = t or ""
        base = base_spans(t)
        out.append((base, []))
        if net.threshold > 1:
            continue
        for a, b in candidates(t, base):
            for w in windows(t, a, b):
                held.append(w)
                where.append((i, a, b))
                if len(held) == TOGETHER:
                    judge()
    judge()
    return out


def _named(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{(*KINDS, 'token')[k]}:{a}:{b}" for a, k, b in sorted(found))


def scan(documents: DataFrame) -> DataFrame:
    """One row per row of ``documents (doc_id, text)``: the base counts and
    digest, ``spans`` (base and added) and ``n_added``."""
    net = documents.sparkSession.sparkContext.broadcast(fit(documents))

    def judge(texts: list[str | None]) -> list:
        rows = spans(texts, net.value)
        kinds = [[sum(s[1] == k for s in base) for base, _ in rows] for k in range(len(KINDS))]
        return [*kinds, [hashlib.sha256(_named(base).encode()).hexdigest() for base, _ in rows], [_named(base + more) for base, more in rows], [len(more) for _, more in rows]]

    added = {f"n_{k}": "long" for k in KINDS} | {"base_sha256": "string", "spans": "string", "n_added": "long"}
    return with_computed(documents, ["doc_id"], ["text"], added, judge)


def _redactor(net: Broadcast, mask: str):
    def redact(texts: list[str | None]) -> list:
        out = []
        for t, (base, more) in zip(texts, spans(texts, net.value), strict=True):
            at, parts = 0, []
            for a, _, b in sorted(base + more):
                if b > at:
                    parts += [t[at : max(a, at)], mask if a >= at else ""]
                    at = b
            out.append("".join(parts) + t[at:] if parts else t)
        return [out, [None if x is None else len(x) for x in out]]

    return redact


def redacted(docs: DataFrame, text_col: str = "text", size_col: str = "n_chars", mask: str = "<secret>") -> DataFrame:
    """The rows of ``docs`` with their own columns, every secret replaced by
    ``mask``; ``size_col``, if there is one, becomes the new text's length."""
    own = docs.columns
    names = [f"d{i}" for i in range(len(own))]
    named = docs.toDF(*names)
    text = names[own.index(text_col)]
    net = docs.sparkSession.sparkContext.broadcast(fit(named, text))
    out = with_computed(named, names, [text], {"clean": "string", "size": "long"}, _redactor(net, mask))
    fresh = {text: F.col("clean")}
    if size_col in own:
        size = names[own.index(size_col)]
        fresh[size] = F.when(F.col("clean").eqNullSafe(F.col(text)), F.col(size)).otherwise(F.col("size").cast(named.schema[size].dataType))
    return out.select(*[fresh.get(n, F.col(n)).alias(n) for n in names]).toDF(*own)
