"""Secret scans with character Markov models, in DataFrame operations only.

Base patterns (assignments to names of secrets, access keys, long hex strings) give spans of their own and, with their
different values, the labelled sample of random strings. The labelled ordinary identifiers are the different runs of letters
and digits that are shorter than any scored token and occur more than once in the corpus, so no long key, of whatever
characters, is among them, and a general list that stands for a corpus too to show its identifiers. Two first-order character models are counted from these samples. Every other long token is
scored by the log-likelihood ratio of a random string against an ordinary identifier, and becomes a span of kind ``markov``
if the ratio exceeds ``RATIO``. A random string follows, half and half, the model of the random sample or draws evenly
from the letters and digits of the token's kinds, as secrets use more alphabets than the samples show; an ordinary one may
also repeat its last character (rules and fillers) or go on with a capital. Pairs with a separator (``+/_=-``) say nothing.

Positions count code points: a text is cut at the matches of a pattern, and the lengths of the parts are summed up.

Defined cases: a null text is empty and has no spans; texts of any length are read whole; repeated rows get equal
results; an empty table gives no rows (and untrained, equal models); only ``doc_id`` and ``text`` are read, other
columns may have any name (``redact`` returns them all).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cascara.llm.common import stage

#: The base patterns. Assignments also need a value of VALUE characters.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
VALUE = 6
KINDS = ("assign", "access", "hex", "markov")

#: Tokens that are scored: LONG characters or more. The models read their letters and digits.
LONG = 16
TOKEN = rf"[A-Za-z0-9+/_=-]{{{LONG},}}"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
#: Weight of the characters' own shares in a model; of an ordinary identifier's repeating its last character; of its
#: going on with a new word's capital; of its being written in capitals.
BACK, REPEAT, CAMEL, CAPITALS = 5.0, 0.1, 0.05, 0.1
#: General words of identifiers. Each, with the next one in capitals, is worth GENERAL_WEIGHT identifiers of
#: the corpus, and so is every pair of digits.
GENERAL = (
    "about access account action address after average before begin between block buffer button cache "
    "call category change channel class client close code column command comment common config connect content context control "
    "copy count create current customer data date default delete description detail device different directory display document "
    "domain email enable error event every export extension field file filter find first folder follow format "
    "found function general group handle history image import index input insert internal item label language "
    "last length limit line link list load local location long message method model month "
    "name network next node normal number object offset open option order ordinary other output page part path "
    "place point position previous process product profile property public query question "
    "read record reference resource response result return review right sample save search "
    "section select series server service size small some source space special standard start state status store "
    "string structure style support system table target task template test text that their there these thing this time "
    "title total track type unique update user value version very what where which window with word work world "
    "would year"
).split()
GENERAL_WEIGHT = 20
#: A random string's alphabet has this many characters at least.
LEAST = 16
#: Natural log of the odds that a token must show: secrets are rare among tokens.
RATIO = 10.0
MASK = "[SECRET]"

_SPAN = "struct<start: long, token: string, value: string>"


def _found(text: Column, pattern: str, value: int) -> Column:
    """(start, token, value) of each match in order; value: the group that is kept."""
    whole = F.zip_with(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.regexp_extract_all(text, F.lit(pattern), F.lit(value)), lambda m, v: F.struct(m.alias("m"), v.alias("v")))
    parts = F.zip_with(whole, F.split(text, pattern, -1), lambda m, gap: F.struct(m["m"].alias("m"), m["v"].alias("v"), F.char_length(gap).cast("long").alias("gap")))
    none = F.array().cast(f"array<{_SPAN}>")

    def step(s: Column, x: Column) -> Column:
        at = s["at"] + x["gap"]
        one = F.array(F.struct(at.alias("start"), x["m"].alias("token"), x["v"].alias("value")))
        return F.struct((at + F.coalesce(F.char_length(x["m"]), F.lit(0))).alias("at"), F.when(x["m"].isNull(), s["spans"]).otherwise(F.concat(s["spans"], one)).alias("spans"))

    spans = F.aggregate(parts, F.struct(F.lit(0).cast("long").alias("at"), none.alias("spans")), step, lambda s: s["spans"])
    return F.when(F.regexp_like(text, F.lit(pattern)), spans).otherwise(none)


def scan(docs: DataFrame, *keep: str) -> DataFrame:
    """Per row the base matches of each kind and all long tokens."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        *keep,
        F.filter(_found(text, ASSIGN, 2), lambda s: F.char_length(s["value"]) >= VALUE).alias("assign"),
        _found(text, ACCESS, 0).alias("access"),
        _found(text, HEX, 0).alias("hex"),
        _found(text, TOKEN, 0).alias("tokens"),
    )


def _end(span: Column) -> Column:
    return span["start"] + F.char_length(span["token"])


def _ranked(spans: str, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), _end(s).alias("end")))


def _base() -> Column:
    return F.concat(*(_ranked(k, k) for k in KINDS[:3]))


def _free(spans: Column, base: Column) -> Column:
    """Spans that touch no base span."""
    return F.filter(spans, lambda s: ~F.exists(base, lambda b: (b["start"] < _end(s)) & (s["start"] < b["end"])))


def ordinary(docs: DataFrame) -> DataFrame:
    """The labelled ordinary identifiers: short runs of letters and digits that occur more than once."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    runs = docs.select(F.explode(F.split(text, "[^A-Za-z0-9]+", -1)).alias("token")).where(F.char_length("token").between(2, LONG - 1))
    return runs.groupBy("token").agg(F.count("*").alias("n")).where("n > 1").select("token")


def _letters(token: Column) -> Column:
    return F.split(token, "", -1)


def train(found: DataFrame, plain: DataFrame) -> tuple[list[float], list[float]]:
    """Natural logs, for each two characters in a row (0: another character than ALPHABET's): the random model's
    likelihood of the second over the ordinary model's, and one over the ordinary model's."""
    random = found.select(F.explode(F.transform(F.concat("assign", "access", "hex"), lambda s: s["value"])).alias("token")).distinct()
    samples = random.select("token", F.lit(1).alias("random")).unionByName(plain.select("token", F.lit(0).alias("random")))
    after = F.slice(_letters(F.col("token")), 2, F.greatest(F.char_length("token") - 1, F.lit(0)))
    pairs = samples.select("random", F.explode(F.zip_with(_letters(F.col("token")), after, lambda a, b: F.concat(a, b))).alias("pair")).where(F.col("pair").rlike("^[A-Za-z0-9]{2}$"))
    counts = {(r["random"], r["pair"]): r["n"] for r in pairs.groupBy("random", "pair").agg(F.count("*").alias("n")).collect()}  # at most 2 x 62 x 62 rows
    return tables(counts)


def tables(counts: dict[tuple[int, str], int]) -> tuple[list[float], list[float]]:
    """See ``train``; ``counts`` of (random, pair)."""
    size = len(ALPHABET)
    learnt = {0: {}, 1: {}}
    known = [a + b.capitalize() for a, b in zip(GENERAL, GENERAL[1:] + GENERAL[:1], strict=True)] + [a + b for a in "0123456789" for b in "0123456789"]
    general = [((0, w[i : i + 2]), GENERAL_WEIGHT) for w in known for i in range(len(w) - 1)]
    for (label, pair), n in [*counts.items(), *general]:
        learnt[label][pair] = learnt[label].get(pair, 0) + n
        if not label and pair.isalpha() and pair != pair.upper():
            learnt[0][pair.upper()] = learnt[0].get(pair.upper(), 0) + CAPITALS * n

    def model(label: int) -> list[list[float]]:
        """Probability of each second character: the pair's share, backed by the character's share overall."""
        rows = [[learnt[label].get(a + b, 0) for b in ALPHABET] for a in ALPHABET]
        every = [sum(r[b] for r in rows) for b in range(size)]
        single = [(0.95 * n / sum(every) if sum(every) else 0.95 / size) + 0.05 / size for n in every]
        return [[(n + BACK * single[b]) / (sum(r) + BACK) for b, n in enumerate(r)] for r in rows]

    plain, secret = model(0), model(1)
    against, cost = [0.0] * (size + 1) ** 2, [0.0] * (size + 1) ** 2
    for a in range(size):
        for b in range(size):
            camel = ALPHABET[a].islower() and ALPHABET[b].isupper()
            p = (1 - REPEAT - CAMEL) * plain[a][b] + REPEAT * (a == b) + CAMEL / 26 * camel
            at = (a + 1) * (size + 1) + b + 1
            against[at], cost[at] = round(math.log(secret[a][b] / p), 6), round(-math.log(p), 6)
    return against, cost


def ratio(token: Column, table: tuple[list[float], list[float]]) -> Column:
    """Log-likelihood ratio of a token."""
    against, cost = (F.from_json(F.lit("[" + ",".join(f"{v:.6f}" for v in t) + "]"), "array<double>") for t in table)
    place = F.transform(_letters(token), lambda c: F.position(c, F.lit(ALPHABET)))
    after = F.slice(place, 2, F.greatest(F.char_length(token) - 1, F.lit(0)))
    at = F.zip_with(place, after, lambda a, b: F.when((a > 0) & (b > 0), a * (len(ALPHABET) + 1) + b + 1).otherwise(F.lit(1)))
    kinds = sum((F.when(token.rlike(k), n).otherwise(0) for k, n in (("[a-z]", 26), ("[A-Z]", 26), ("[0-9]", 10))), F.lit(0))
    even = F.log(F.greatest(kinds, F.lit(LEAST)).cast("double"))
    start = F.struct(F.lit(0.0).alias("learnt"), F.lit(0.0).alias("even"))

    def step(s: Column, i: Column) -> Column:
        one = F.element_at(cost, i)
        return F.struct((s["learnt"] + F.element_at(against, i)).alias("learnt"), (s["even"] + F.when(one > 0, one - even).otherwise(0.0)).alias("even"))

    return F.aggregate(at, start, step, lambda s: F.greatest(s["learnt"], s["even"])) - F.lit(math.log(2))


def _markov(table: tuple[list[float], list[float]]) -> Column:
    scored = F.filter(_free(F.col("tokens"), _base()), lambda s: ratio(s["token"], table) >= RATIO)
    return F.transform(scored, lambda s: F.struct(s["start"].alias("start"), F.lit(3).alias("kind"), _end(s).alias("end")))


def spans(docs: DataFrame) -> DataFrame:
    """doc_id, base and all spans of every document: arrays of (start, kind, end), kind as its place in KINDS."""
    found = stage(scan(docs.withColumn("doc_id", F.col("doc_id").cast("long")), "doc_id"), "secrets-found")
    return found.select("doc_id", F.array_sort(_base()).alias("base"), F.array_sort(F.concat(_base(), _markov(train(found, ordinary(docs))))).alias("spans"))


def written(spans_: str) -> Column:
    """Spans as kind:start:end, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(spans_, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"], s["end"])))


def count_of(kind: str) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def redact(docs: DataFrame, mask: str = MASK) -> DataFrame:
    """The documents with every span replaced by ``mask``, with all columns; ``n_chars``, if there, follows the text."""
    table = train(stage(scan(docs), "secrets-found"), ordinary(docs))
    rest = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text")
    found = scan(rest, "row").select("row", F.array_sort(F.concat(_base(), _markov(table))).alias("spans"))
    text = F.coalesce(F.col("row.text"), F.lit(""))

    def step(s: Column, x: Column) -> Column:
        new = x["start"] >= s["at"]
        part = F.concat(s["out"], F.substring(text, (s["at"] + 1).cast("int"), (x["start"] - s["at"]).cast("int")), F.lit(mask))
        return F.struct(F.greatest(s["at"], x["end"]).alias("at"), F.when(new, part).otherwise(s["out"]).alias("out"))

    clean = F.aggregate("spans", F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out")), step, lambda s: F.concat(s["out"], F.substring(text, (s["at"] + 1).cast("int"), F.char_length(text))))
    masked = F.when(F.size("spans") > 0, clean).otherwise(F.col("row.text"))
    out = found.select("row", F.size("spans").alias("n"), masked.alias("masked"))
    columns = []
    for c, kind in docs.dtypes:
        old = F.col(f"row.`{c}`")
        columns.append(F.col("masked").alias(c) if c == "text" else F.when(F.col("n") > 0, F.char_length("masked")).otherwise(old).cast(kind).alias(c) if c == "n_chars" else old.alias(c))
    return out.select(*columns)
