"""Personal data by weak-supervision aggregation (operator 7), in DataFrame
functions only.

Strict patterns give the base spans, looser ones further candidates.  Five
labelers vote on every candidate (-1, 0 or 1): the strict pattern, the shape
(checksum, digits, labels), a gazetteer (top-level domains, reserved networks,
issuer digits, calling codes), the words before the span, and its edges.
Expectation-maximisation over the counts of vote patterns, a bounded table,
estimates how reliable each labeler is and how likely each pattern is.  With
those probabilities as soft labels a naive Bayes span classifier is trained
over votes, length, digits and neighbouring characters; candidates that it
gives at least ``accept`` and that overlap no base span are added to the base
spans, the first of overlapping ones only.

Cases: null and empty texts have no spans; rows are judged one by one, so
repeated rows and null ids do no harm; without candidates nothing is trained;
an empty table gives an empty result.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import written

KINDS = ("email", "ip", "card", "phone")
#: Least probability of an added span.
ACCEPT = 0.95
#: Characters before a span that the context labeler reads.
CONTEXT = 24
ROUNDS = 60

# Strict patterns.  The guards in front only keep a search from starting again
# inside a run that has failed already; they change no match.
_LOCAL = r"A-Za-z0-9._%+-"
EMAIL = rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
# whole chains of 12 to 19 digits; shorter and longer ones would fail anyway
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9](?:[\x20().-]*[0-9]){8,14}+(?![\x20().-]*[0-9])"
# Looser patterns of further candidates.
LOOSE = {
    "email": r"[^\s@<>()\",;:]{1,64}@[^\s@<>()\",;:]{1,255}|[A-Za-z0-9._%+-]{1,64}\x20?[\[(]at[\])]\x20?[A-Za-z0-9.-]{1,255}",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": CARD,
    "phone": r"(?<![0-9+])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
}
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
TLDS = ["com", "org", "net", "edu", "gov", "info", "io", "eu", "de", "fr", "es", "it", "uk", "us", "ca", "ch", "at", "be", "nl"]
CALLING = ["1", "33", "34", "39", "41", "43", "44", "49"]
WORDS = {
    "email": ["mail", "contact", "write", "correo", "courriel", "schreib"],
    "ip": ["ip", "host", "server", "addr", "login", "client"],
    "card": ["card", "visa", "credit", "payment", "carte", "karte", "tarjeta"],
    "phone": ["phone", "tel", "call", "fax", "mobile", "fono", "ruf"],
}
OTHER_WORDS = ["version", "order", "isbn", "invoice", "total", "price", "serial", "page"]


_SPANS = "array<struct<start:int,end:int,hit:string>>"


def _matches(text: Column, pattern: str) -> Column:
    """``struct(start, end, hit)`` of every match, leftmost and in order: the
    pieces between the matches and the matches are laid end to end."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    steps = F.zip_with(F.split(text, pattern, -1), hits, lambda gap, hit: F.struct(F.length(gap).alias("gap"), hit.alias("hit")))

    def lay(done: Column, step: Column) -> Column:
        start = done["at"] + step["gap"]
        end = start + F.coalesce(F.length(step["hit"]), F.lit(0))
        more = F.concat(done["out"], F.array(F.struct(start.alias("start"), end.alias("end"), step["hit"].alias("hit"))))
        return F.struct(end.alias("at"), F.when(step["hit"].isNull(), done["out"]).otherwise(more).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("out"))
    return F.aggregate(steps, start, lay, lambda done: done["out"])


def _hint(text: Column, kind: str) -> Column:
    """Whether a text can hold a span of a kind at all, told cheaply."""
    if kind == "email":
        return text.contains("@") | text.contains("[at]") | text.contains("(at)")
    if kind == "ip":
        return text.rlike(r"[0-9]\.[0-9]") | (text.contains(":") & text.rlike(r"[0-9A-Fa-f]:[0-9A-Fa-f]{1,4}:"))
    return text.rlike(r"[0-9](?:[\x20-]?[0-9]){11}" if kind == "card" else r"\+[0-9]|[0-9]{3}\)?[\x20.-][0-9]{3}")


def luhn(text: Column) -> Column:
    """Whether the digits of a text pass the Luhn check."""
    digits = F.reverse(F.regexp_replace(text, "[^0-9]", ""))
    value = F.transform(F.split(digits, ""), lambda d, i: F.when(i % 2 == 1, F.floor(d.cast("int") / 5) + d.cast("int") * 2 % 10).otherwise(d.cast("int")).cast("int"))
    return F.aggregate(value, F.lit(0), lambda a, b: a + F.coalesce(b, F.lit(0))) % 10 == 0


def _strict(kind: str, hit: Column) -> Column:
    if kind == "ip":
        return hit.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    return luhn(hit) if kind == "card" else F.lit(True)


def _kind_spans(text: Column, kind: str, pattern: str, base: bool) -> Column:
    """Spans of a kind, looked for where its hint column is true."""
    spans = _matches(text, pattern)
    if base:
        spans = F.filter(spans, lambda s: _strict(kind, s["hit"]))
    named = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind"), s["hit"].alias("hit")))
    none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string,hit:string>>")
    return F.when(F.col(f"may_{kind}"), named).otherwise(none)


def _in(value: Column, words: list[str]) -> Column:
    return value.isin(words)


def _votes(kind: Column, base: Column, hit: Column, left: Column, right: Column) -> Column:
    """The five labelers' votes as an array."""
    digits = F.length(F.regexp_replace(hit, "[^0-9]", ""))
    top = F.lower(F.regexp_extract(hit, r"\.([A-Za-z]{2,24})$", 1))
    sign = lambda yes, no=-1: F.when(yes, 1).otherwise(no)
    shape = (F.when(kind == "email", sign(top != "")).when(kind == "ip", sign(hit.rlike(r"^(?:[1-9][0-9]?|1[0-9]{2}|2[01][0-9]|22[0-3])\.") & ~hit.rlike(r"(?:^|\.)0[0-9]")))
             .when(kind == "card", sign(luhn(hit))).otherwise(sign(digits.between(10, 13), 0)))
    code = F.greatest(*[F.when(hit.startswith("+" + c), 1).otherwise(0) for c in CALLING])
    gazetteer = (F.when(kind == "email", sign(_in(top, TLDS), 0)).when(kind == "ip", sign(~hit.rlike(r"^(?:0|10|127|192\.168|172\.(?:1[6-9]|2[0-9]|3[01]))\."), 0))
                 .when(kind == "card", sign(hit.rlike("^[3-6]"))).otherwise(code))
    word = F.lit(False)
    for k, words in WORDS.items():
        word = word | ((kind == k) & left.rlike("|".join(words)))
    context = F.when(word, 1).when(left.rlike("|".join(OTHER_WORDS)), -1).otherwise(0)
    edges = sign(~left.rlike(r"[\p{L}\p{N}_]$") & ~right.rlike(r"^[\p{L}\p{N}_]"))
    return F.array(*[v.cast("int") for v in (sign(base), shape, gazetteer, context, edges)])


def _features(s: Column) -> Column:
    """What the span classifier sees, as ``name=value`` texts."""
    char = lambda c: F.when(c == "", "end").when(c.rlike(r"\s"), "space").when(c.rlike(r"\p{L}"), "letter").when(c.rlike("[0-9]"), "digit").otherwise("mark")
    digits = F.length(F.regexp_replace(s["hit"], "[^0-9]", ""))
    return F.array(
        *[F.concat(s["kind"], F.lit(f":vote{i}="), s["votes"][i].cast("string")) for i in range(5)],
        F.concat(s["kind"], F.lit(":length="), F.least(F.floor(F.length(s["hit"]) / 4), F.lit(12)).cast("string")),
        F.concat(s["kind"], F.lit(":digits="), F.least(digits, F.lit(20)).cast("string")),
        F.concat(F.lit("before="), char(F.substring(s["left"], -1, 1))), F.concat(F.lit("after="), char(s["right"])))


def _pattern(s: Column) -> Column:
    return F.concat_ws(",", s["kind"], s["votes"].cast("array<string>"))


def candidates(text: Column) -> tuple[Column, Column]:
    """The base spans of a text, and the matches of the looser patterns."""
    base = F.concat(*[_kind_spans(text, k, p, True) for k, p in (("email", EMAIL), ("ip", IP), ("card", CARD), ("phone", PHONE))])
    return base, F.concat(*[_kind_spans(text, k, p, False) for k, p in LOOSE.items()])


def find(documents: DataFrame) -> DataFrame:
    """``doc_id`` and ``spans``: base spans and other candidates of whole texts,
    each with ``start, rank, end, kind, base, hit, left, right, votes``."""
    docs = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    digits = F.col("t").rlike("[0-9]")
    docs = docs.withColumns({f"may_{k}": _hint(F.col("t"), k) if k == "email" else digits & _hint(F.col("t"), k) for k in KINDS})
    base, loose = candidates(F.col("t"))
    both = docs.select("doc_id", "t", base.alias("b"), loose.alias("l"))
    apart = F.filter("l", lambda s: ~F.exists("b", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))

    def dressed(spans: Column | str, is_base: bool) -> Column:
        def dress(s: Column) -> Column:
            left = F.lower(F.substring("t", F.greatest(s["start"] - CONTEXT, F.lit(0)) + 1, F.least(F.lit(CONTEXT), s["start"])))
            right = F.substring("t", s["end"] + 1, F.lit(1))
            return F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"),
                            F.lit(is_base).alias("base"), s["hit"].alias("hit"), left.alias("left"), right.alias("right"))

        return F.transform(spans, dress)

    dressed_all = F.concat(dressed("b", True), dressed(apart, False))
    voted = F.transform(dressed_all, lambda s: s.withField("votes", _votes(s["kind"], s["base"], s["hit"], s["left"], s["right"])))
    return both.select("doc_id", F.array_sort(voted).alias("spans"))


def reliabilities(patterns: dict[str, int], rounds: int = ROUNDS) -> tuple[dict[str, float], list[dict]]:
    """Expectation-maximisation over vote patterns (``kind,v1,..,v5`` to count):
    the probability of each pattern, and per labeler how often it votes what
    on true and on false candidates."""
    votes = {p: [int(v) for v in p.split(",")[1:]] for p in patterns}
    prob = {p: 1 / (1 + math.exp(-sum(v))) for p, v in votes.items()}
    tables: list[dict] = []
    for _ in range(rounds):
        tables = []
        for j in range(5):
            seen = {(y, v): 1.0 for y in (0, 1) for v in (-1, 0, 1)}
            for p, n in patterns.items():
                seen[1, votes[p][j]] += n * prob[p]
                seen[0, votes[p][j]] += n * (1 - prob[p])
            total = [sum(seen[y, v] for v in (-1, 0, 1)) for y in (0, 1)]
            tables.append({k: x / total[k[0]] for k, x in seen.items()})
        kinds: dict[str, list[float]] = {}
        for p, n in patterns.items():
            t = kinds.setdefault(p.split(",")[0], [1.0, 2.0])
            t[0] += n * prob[p]
            t[1] += n
        for p in patterns:
            share = kinds[p.split(",")[0]]
            logit = math.log(share[0] / (share[1] - share[0])) if share[1] > share[0] else 30.0
            logit += sum(math.log(tables[j][1, v] / tables[j][0, v]) for j, v in enumerate(votes[p]))
            prob[p] = 1 / (1 + math.exp(-max(-30.0, min(30.0, logit))))
    return prob, tables


def _lookup(values: dict[str, float], key: Column, default: float) -> Column:
    table = F.from_json(F.lit(json.dumps(values)), "map<string,double>")
    return F.coalesce(F.element_at(table, key), F.lit(default))


def train(found: DataFrame) -> tuple[dict[str, float], float]:
    """The span classifier: a weight per feature, and the intercept.  Vote
    patterns and features are counted by Spark; both tables are bounded by
    the number of kinds, votes and value ranges."""
    spans = found.select(F.explode("spans").alias("s"))
    patterns = {r["p"]: r["n"] for r in spans.groupBy(_pattern(F.col("s")).alias("p")).agg(F.count("*").alias("n")).collect()}
    prob, _ = reliabilities(patterns)
    if not prob:
        return {}, 0.0
    soft = spans.select(F.explode(_features(F.col("s"))).alias("f"), _lookup(prob, _pattern(F.col("s")), 0.5).alias("p"))
    sums = soft.groupBy("f").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no")).collect()
    yes = sum(n * prob[p] for p, n in patterns.items()) + 1
    no = sum(n * (1 - prob[p]) for p, n in patterns.items()) + 1
    return {r["f"]: math.log((r["yes"] + 0.5) / yes) - math.log((r["no"] + 0.5) / no) for r in sums}, math.log(yes / no)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def detect(documents: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """One row per row of ``documents (doc_id, text)``: the base counts and
    digest, ``spans`` (base and added) and ``n_added``."""
    found = written(find(documents), "spans")
    weights, intercept = train(found)

    def likely(s: Column) -> Column:
        logit = F.aggregate(_features(s), F.lit(intercept), lambda a, f: a + _lookup(weights, f, 0.0))
        return logit >= math.log(accept / (1 - accept))

    base = F.filter("spans", lambda s: s["base"])
    more = F.filter("spans", lambda s: ~s["base"] & likely(s))
    own = found.select("doc_id", base.alias("b"), more.alias("m"))
    # of added spans that overlap, the first
    first = F.filter("m", lambda s: ~F.exists("m", lambda x: (x["start"] < s["end"]) & (s["start"] < x["end"]) & (F.struct(x["start"], x["rank"]) < F.struct(s["start"], s["rank"]))))
    own = own.select("doc_id", "b", first.alias("m"))
    count = lambda k: F.size(F.filter("b", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return own.select("doc_id", *[count(k) for k in KINDS], F.sha2(_joined(F.col("b")), 256).alias("base_sha256"),
                      _joined(F.array_sort(F.concat("b", "m"))).alias("spans"), F.size("m").cast("long").alias("n_added"))
