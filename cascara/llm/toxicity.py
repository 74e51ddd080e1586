"""Toxicity scores by weak supervision.

1. Lexicon induction. From a bounded sample of labelled documents the word starts are picked that mark the labelled
   class with high precision; a greedy cover that wants every toxic document covered several times turns them into
   lexicon voters. Pattern voters (shouting, masked letters, repeated marks, insults of a general list) join them.
2. Votes. One pass over all documents records, per document, which voters fire and which induced terms occur in the
   whole text. Counts of vote patterns are aggregated by Spark (at most 2**16 patterns).
3. Generative label model. Expectation-maximisation over the pattern counts of the whole corpus estimates each voter's
   firing rates in both classes (its accuracy) and the class balance. The given label is one more voter of the sample's
   documents, with rates that are estimated like the others. Correlations left within a class are measured from the same counts; a voter's weight is divided by the
   variance it shares with others, so copies of a rule do not count twice.
4. A logistic regression on the induced terms and voters is trained on the model's posterior of the sample's documents,
   and scores every document.

Labels are learnt only from rows whose crc32(doc_id as text) mod 4 is not 2; labels, lang, source and doc_id are no
inputs of a score. The sample's bound is ``SAMPLE`` documents (those whose ids hash lowest), everything else covers all.

Defined cases: a null text is empty and gets the score of a document in which nothing fires; without usable labels the
general list alone votes; repeated rows get equal scores; an empty table gives no rows; extra columns may have any name
(``clean`` returns them all). Rows with a null id count as not held out.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cascara.llm.common import prepare, release, stage

#: Labelled documents that the lexicon and the classifier are fitted on, at most.
SAMPLE = 20_000
#: Induced terms, at most.
TERMS = 400
LEXICON_VOTERS = 12
#: A term counts as present, as repeated, as frequent.
LEVELS = (1, 2, 4)
THRESHOLD = 0.3
#: How often a label says toxic in toxic and in clean documents, before the label model estimates it, and how many
#: documents of each class that guess is worth.
LABEL, LABEL_WEIGHT = (0.95, 0.02), 20
#: Without labels: how often the general list fires in toxic documents, and every voter in any class otherwise.
GENERAL_RATES = (0.6, 0.015)

#: A general list of insults, for the voter that needs no labels.
INSULTS = (
    "asshole bastard bitch clown crap cretin disgusting dumbass fool garbage hate idiot imbecile jerk kill loser lunatic "
    "moron pathetic pig scum shit slut stupid trash ugly vermin whore worthless"
).split()

_WORD = re.compile(r"\w+")
_SHOUT = re.compile(r"\b[A-Z]{3,}\b.{0,80}\b[A-Z]{3,}\b[^\n]{0,40}!!", re.S)
_MASKED = re.compile(r"\b\w{1,2}[*@#$]{2,}\w*\b")
_MARKS = re.compile(r"[!?]{4,}")
PATTERNS = 4  # the general list and the three above


@dataclass
class Lexicon:
    """Induced terms (a word start, ``=`` in front: the whole word; and how often at least) and the terms of each
    lexicon voter."""

    terms: list[tuple[str, int]]
    voters: list[list[int]]

    @property
    def size(self) -> int:
        return len(self.voters) + PATTERNS


def starts_of(text: str) -> set[tuple[str, int]]:
    """The features of a text: its words and their starts of 3 to 6 letters, each with how often it occurs at least."""
    n: Counter[str] = Counter()
    for w, k in Counter(_WORD.findall(text.lower())).items():
        n["=" + w] += k
        for size in range(3, min(6, len(w)) + 1):
            n[w[:size]] += k
    return {(t, level) for t, k in n.items() for level in LEVELS if k >= level}


def packed(text: str) -> bytes:
    """A sampled text as the driver keeps it."""
    return zlib.compress(text.encode(), 1)


def unpacked(text: bytes) -> str:
    return zlib.decompress(text).decode()


def induce(sample: list[tuple[bytes, int]], terms: int = TERMS, voters: int = LEXICON_VOTERS) -> Lexicon:
    """Terms that mark the labelled class, and voters that cover the toxic documents, if possible several times.
    ``sample``: packed texts and their labels."""
    positive = sum(y for _, y in sample)
    negative = len(sample) - positive
    if not positive or not negative:
        return Lexicon([], [])
    least = max(3, positive // 500)
    # Counted by hash first: the features themselves are only kept if they are frequent.
    marks, n = np.unique(np.concatenate([np.fromiter((hash(f) for f in starts_of(unpacked(t))), np.int64) for t, y in sample if y]), return_counts=True)
    often = set(marks[n >= least].tolist())
    own: dict[tuple[str, int], tuple[str, int]] = {}
    kept = [{own.setdefault(f, f) for f in starts_of(unpacked(t)) if hash(f) in often} for t, y in sample if y]
    held = (Counter(), Counter())
    for found in kept:
        held[1].update(found)
    frequent = {t for t, n in held[1].items() if n >= least}
    for text, y in sample:
        if not y:
            held[0].update(frequent & starts_of(unpacked(text)))
    scored = []
    for term in frequent:
        n, m = held[1][term], held[0][term]
        lift = np.log((n + 0.5) / (positive + 1)) - np.log((m + 0.5) / (negative + 1))
        if lift > 1.0:
            scored.append((float(lift * np.sqrt(n)), term, n, m))
    # Of a word and its starts that occur in the same documents one is enough.
    seen, chosen = set(), []
    for _, term, n, m in sorted(scored, key=lambda x: (-x[0], len(x[1][0]), x[1])):
        mark = (n, m, term[0].lstrip("=")[:3])
        if mark not in seen:
            seen.add(mark)
            chosen.append((term, n, m))
    chosen = chosen[:terms]
    picked = [t for t, _, _ in chosen]
    at = {t: i for i, t in enumerate(picked)}
    where = defaultdict(list)
    for d, found in enumerate(kept):
        for t in found & at.keys():
            where[at[t]].append(d)
    pure = [i for i, (_, n, m) in enumerate(chosen) if m / (negative + 1) < 0.05 * n / positive]
    covered = np.zeros(len(kept), np.int64)
    groups: list[list[int]] = []
    times = 1
    while len(groups) < voters and times <= 4:
        best = max(((int((covered[where[i]] < times).sum()), -i) for i in pure), default=(0, 0))
        if best[0] < least:
            times += 1
            continue
        i = -best[1]
        groups.append([i])
        pure.remove(i)
        covered[where[i]] += 1
    return Lexicon(picked, groups)


class Reader:
    """Reads texts: which terms occur at a word's start, and which voters fire."""

    def __init__(self, lexicon: Lexicon):
        import ahocorasick

        self.lexicon = lexicon
        self.insults = re.compile(r"\b(?:" + "|".join(INSULTS) + r")s?\b")
        self.machine = ahocorasick.Automaton()
        marks: dict[str, list[tuple[bool, int, int]]] = defaultdict(list)
        for i, (t, level) in enumerate(lexicon.terms):
            marks[t.lstrip("=")].append((t[0] == "=", level, i))
        for start, terms in marks.items():
            self.machine.add_word(start, (len(start), terms))
        if marks:
            self.machine.make_automaton()

    def read(self, text: str) -> tuple[list[int], int]:
        low = text.lower()
        n: Counter[int] = Counter()
        if self.lexicon.terms and low:
            size = len(low)
            for end, (length, terms) in self.machine.iter(low):
                begin = end - length + 1
                if begin and (low[begin - 1].isalnum() or low[begin - 1] == "_"):
                    continue
                ends = end + 1 == size or not (low[end + 1].isalnum() or low[end + 1] == "_")
                for whole, _, i in terms:
                    if ends or not whole:
                        n[i] += 1
        found = {i for i, k in n.items() if k >= self.lexicon.terms[i][1]}
        votes = 0
        for v, members in enumerate(self.lexicon.voters):
            votes |= int(not found.isdisjoint(members)) << v
        v = len(self.lexicon.voters)
        for k, fires in enumerate((self.insults.search(low), _SHOUT.search(text), _MASKED.search(text), _MARKS.search(text))):
            votes |= int(fires is not None) << (v + k)
        return sorted(found), votes


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """(doc_id, text, toxic) of at most ``size`` labelled documents outside the held-out fold, those whose ids hash lowest."""
    marks = labels.where("toxic is not null and doc_id is not null").where(~held_out(F.col("doc_id"))).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.avg("toxic") >= 0.5).cast("int").alias("toxic"))
    marks = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(size)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.join(F.broadcast(marks), "doc_id")  # bounded by ``size`` rows


def fit_label_model(patterns: dict[int, int], voters: int, votes: np.ndarray | None = None, labels: np.ndarray | None = None, rounds: int = 100) -> tuple[dict[int, float], np.ndarray]:
    """Posterior of the toxic class for each vote pattern, and for each document of the labelled sample (``votes``,
    ``labels``) with its label as one more voter.

    The model: a document is toxic with a probability, and each voter fires with one rate in toxic documents and another
    in clean ones. Both rates of each voter, of the label too, and the class balance are estimated by
    expectation-maximisation over all documents, beginning with the sample's labels. Documents without a label weigh no
    more in all than the labelled ones, so that they cannot turn the classes into something else. Without labels of both
    kinds nothing is estimated, and the general list alone votes."""
    votes = np.zeros(0, np.int64) if votes is None else votes
    labels = np.zeros(0) if labels is None else labels
    given = Counter(zip(votes.tolist(), (labels > 0.5).tolist(), strict=True))
    rest = {k: max(0, n - given[(k, False)] - given[(k, True)]) for k, n in patterns.items()}
    rows = [(k, None, n) for k, n in sorted(rest.items())] + [(k, y, n) for (k, y), n in sorted(given.items())]
    keys = np.array([k for k, _, _ in rows], np.int64)
    weight = np.array([n for _, _, n in rows], np.float64)
    marked = np.array([y is not None for _, y, _ in rows])
    says = np.array([y is True for _, y, _ in rows], np.float64)
    fires = ((keys[:, None] >> np.arange(voters)) & 1).astype(np.float64)
    positive, sample = float(weight[marked] @ says[marked]), float(weight[marked].sum())
    learnt = 0 < positive < sample
    if learnt:
        weight[~marked] *= min(1.0, sample / max(1.0, weight[~marked].sum()))
        p, held = np.where(says > 0, *LABEL), np.where(marked, weight, 0.0)
        prior, strength = (weight @ fires + 0.5) / (weight.sum() + 1), 1.0
        prior = np.vstack([prior, prior])
        balance = positive / sample
    else:  # the general list alone has a known meaning
        p, held = np.zeros(len(keys)), np.zeros(len(keys))
        prior, strength = np.tile(GENERAL_RATES[1], (2, voters)), 50.0
        prior[0, voters - PATTERNS] = GENERAL_RATES[0]
        balance = 0.1
    share = np.ones(voters)

    def rates(p: np.ndarray, w: np.ndarray, of: np.ndarray, before: np.ndarray, worth: float) -> np.ndarray:
        """How often each column fires in toxic (row 0) and in clean documents (row 1)."""
        mass = np.vstack([w * p, w * (1 - p)])
        return np.clip((mass @ of + worth * before) / (mass.sum(axis=1, keepdims=True) + worth), 1e-5, 1 - 1e-5)

    def evidence(of: np.ndarray, rate: np.ndarray) -> np.ndarray:
        """Log-odds of the toxic class that each column's firing, or not firing, adds."""
        return of * np.log(rate[0] / rate[1]) + (1 - of) * np.log((1 - rate[0]) / (1 - rate[1]))

    def sigmoid(x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x, -50, 50)))

    before, own = np.zeros(len(keys)), np.array([[LABEL[0]], [LABEL[1]]])
    rate = rates(p, held, fires, prior, strength)
    alone = p
    for step in range(rounds):
        alone = np.log(balance / (1 - balance)) + evidence(fires, rate) @ share
        p = sigmoid(alone + marked * evidence(says[:, None], own)[:, 0])
        if not learnt or (np.abs(p - before).max(initial=0) < 1e-6 and step > 12):
            break
        before = p
        balance = float(np.clip((weight @ p + 0.5) / (weight.sum() + 5), 1e-4, 0.5))
        rate = rates(p, weight, fires, prior, strength)
        own = rates(p, weight * marked, says[:, None], np.array([[LABEL[0]], [LABEL[1]]]), LABEL_WEIGHT)
        if step in (3, 12):
            share = _shares(fires, weight, p)
    with_label = dict(zip([(k, y) for k, y, _ in rows], p.tolist(), strict=True))
    return dict(zip(keys.tolist(), sigmoid(alone).tolist(), strict=True)), np.array([with_label[(int(k), bool(y > 0.5))] for k, y in zip(votes, labels, strict=True)])


def _shares(fires: np.ndarray, weight: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Votes per voter: one, divided by the variance that it shares with the voters it stays correlated with inside a
    class (itself included). Copies of a rule have one vote together; voters that fire independently keep theirs."""
    shared = np.zeros((fires.shape[1],) * 2)
    for q in (1 - p, p):
        w = weight * q
        n = max(w.sum(), 1e-9)
        mean = w @ fires / n
        cov = (fires * w[:, None]).T @ fires / n - np.outer(mean, mean)
        sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
        rho = np.where(np.minimum.outer(sd, sd) > 1e-3, cov / np.outer(sd, sd), 0)
        shared = np.maximum(shared, np.maximum(rho, 0) ** 2)
    np.fill_diagonal(shared, 1)
    return 1 / shared.sum(axis=1)


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights (intercept last) of a ridge-penalised logistic regression on soft labels, by Newton steps."""
    n, m = x.shape
    w = np.zeros(m + 1)
    ridge = np.full(m + 1, penalty)
    ridge[-1] = 1e-3
    for _ in range(rounds):
        grad, hess = ridge * w, np.diag(ridge)
        for a in range(0, n, 2000):
            part = np.hstack([x[a : a + 2000], np.ones((len(x[a : a + 2000]), 1))])
            p = 1 / (1 + np.exp(-np.clip(part @ w, -30, 30)))
            grad += part.T @ (p - y[a : a + 2000])
            hess += (part * (p * (1 - p))[:, None]).T @ part
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-5:
            break
    return w


def score(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    _, weights, intercept, read = _fit(docs, labels, sample)
    return _scored(read, weights, intercept).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def _scored(read: DataFrame, weights: list[float], intercept: float) -> DataFrame:
    table = F.from_json(F.lit("[" + ",".join(f"{w:.9g}" for w in weights) + "]"), "array<double>")
    total = F.aggregate("features", F.lit(intercept), lambda s, i: s + F.element_at(table, i + 1))
    return read.withColumn("score", F.lit(1.0) / (F.lit(1.0) + F.exp(-total)))


def _fit(docs: DataFrame, labels: DataFrame, sample: int) -> tuple[Lexicon, list[float], float, DataFrame]:
    """(lexicon, weight of each feature, intercept, doc_id, features and votes of every document)."""
    prepare(docs.sparkSession)
    rows = [(packed(r["text"] or ""), r["toxic"]) for r in labelled_sample(docs, labels, sample).toLocalIterator()]
    lexicon = induce(rows)
    reader = Reader(lexicon)
    read_sample = [reader.read(unpacked(t)) for t, _ in rows]
    marks = [y for _, y in rows]
    del rows

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(lexicon)
        for batch in batches:
            got = [reader.read(t.as_py() or "") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([_features(f, v, lexicon) for f, v in got], pa.list_(pa.int32())), pa.array([v for _, v in got], pa.int32())], ["doc_id", "features", "votes"])
        release()

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    read = stage(texts.mapInArrow(work, "doc_id long, features array<int>, votes int"), "toxicity-votes")
    patterns = {r["votes"]: r["n"] for r in read.groupBy("votes").agg(F.count("*").alias("n")).collect()}  # at most 2**16 rows
    width = len(lexicon.terms) + lexicon.size
    weights, intercept = np.zeros(width), -3.0
    if patterns:
        y = np.array(marks, np.float64)
        votes = np.array([v for _, v in read_sample], np.int64)
        alone, soft = fit_label_model(patterns, lexicon.size, votes, y)
        if len(read_sample):
            x = np.zeros((len(read_sample), width), np.int8)
            for i, (f, v) in enumerate(read_sample):
                x[i, _features(f, v, lexicon)] = 1
        else:  # no labelled documents: the patterns themselves stand for the sample
            keys = list(alone)
            x = ((np.array(keys)[:, None] >> np.arange(lexicon.size)) & 1).astype(np.int8)
            soft = np.array([alone[k] for k in keys])
        # Without a sample the posterior is itself linear in the general list's vote: nothing to shrink.
        w = fit_logistic(x, soft, penalty=1.0 if len(read_sample) else 1e-3)
        weights, intercept = w[:-1], float(w[-1])
    return lexicon, [float(v) for v in weights], intercept, read


def _features(found: list[int], votes: int, lexicon: Lexicon) -> list[int]:
    """Indices of a document's features: its terms, then its voters."""
    return found + [len(lexicon.terms) + v for v in range(lexicon.size) if votes >> v & 1]


def clean(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """The documents with a score under the threshold, with all columns; each row is scored where it is."""
    lexicon, weights, intercept, _ = _fit(docs, labels, sample)
    least = float(np.log(threshold / (1 - threshold)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, w = Reader(lexicon), np.array(weights)
        for batch in batches:
            keep = []
            for t in batch.column("text"):
                found, votes = reader.read(t.as_py() or "")
                keep.append(bool(w[_features(found, votes, lexicon)].sum() + intercept < least))
            yield batch.filter(pa.array(keep, pa.bool_()))
        release()

    return docs.mapInArrow(work, docs.schema)
