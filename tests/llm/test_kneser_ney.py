"""Kneser-Ney scores against a model counted with plain dictionaries."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from .fixtures_path import documents, rows_of
from pyspark.sql import functions as F

from cascara.llm import kneser_ney
from cascara.llm.queries import QUERIES
from cascara.session import scratch_path

SF = "/root/testdata/sf0.001"
BOS, EOS = ("begin",), ("end",)


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [EOS]


class Plain:
    """The model as its definition reads."""

    def __init__(self, texts, order):
        self.order = order
        self.plain = Counter(t for x in texts for t in tokens(x))
        types = Counter()
        for x in texts:
            seq = [BOS] * (order - 1) + tokens(x)
            types.update(tuple(seq[i : i + order]) for i in range(len(seq) - order + 1))
        self.levels = {order: dict(types)}
        for k in range(order - 1, 0, -1):
            self.levels[k] = Counter(g[1:] for g in self.levels[k + 1])
        self.contexts, self.d = {}, {}
        for k, level in self.levels.items():
            found = defaultdict(list)
            for g, c in level.items():
                found[g[:-1]].append(c)
            n = Counter(level.values())
            self.d[k] = kneser_ney.discounts(n[1], n[2], n[3], n[4])
            self.contexts[k] = {h: (sum(c), sum(self.d[k][min(x, 3) - 1] for x in c)) for h, c in found.items()}

    def p(self, h, w):
        out = 1 / (len(self.plain) + 1)
        for k in range(1, self.order + 1):
            context = tuple(h[len(h) - k + 1 :])
            if context in self.contexts[k]:
                total, rest = self.contexts[k][context]
                c = self.levels[k].get((*context, w), 0)
                out = ((c - self.d[k][min(c, 3) - 1] if c else 0) + rest * out) / total
        return out

    def score(self, text):
        seq = [BOS] * (self.order - 1) + tokens(text)
        return sum(math.log10(self.p(seq[i - self.order + 1 : i], seq[i])) for i in range(self.order - 1, len(seq)))


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def check(got, rows, order):
    model = Plain([t for i, t in rows if not held_out(i)], order)
    total, kinds = sum(model.plain.values()), len(model.plain)
    want = sorted((i is None, i or 0, held_out(i), len(tokens(t)), sum(w in model.plain for w in tokens(t)), total,
                   round(sum(math.log10((model.plain[w] + 1) / (total + 1 * (kinds + 1))) for w in tokens(t)), 6), round(model.score(t), 6)) for i, t in rows)
    have = sorted((r[0] is None, r[0] or 0, *r[1:5], round(r[5], 6), round(r[6], 6)) for r in got)
    assert have == want


@pytest.mark.parametrize("order", [2, 3])
def test_scores_equal_the_definition(spark, order, monkeypatch):
    monkeypatch.setattr(kneser_ney, "CHUNK_BYTES", 9000)  # several chunks and ranges
    monkeypatch.setattr(kneser_ney, "RANGE_BYTES", 9000)
    docs = documents(spark, [(None, "one of no id"), (None, "ab ab ab")])
    got = kneser_ney.score(docs.repartition(5), order=order)
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    check(got.collect(), rows_of(docs), order)


def test_query_on_the_documents(spark):
    name = next(q for q in QUERIES if q.startswith("op12_"))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = QUERIES[name](spark, SF)
    check(got.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect(), rows_of(docs), kneser_ney.ORDER)
    sides = {r["held_out"]: r for r in kneser_ney.perplexity(got).collect()}
    assert sides[True]["perplexity"] < sides[True]["base_perplexity"] and sides[False]["perplexity"] < sides[False]["base_perplexity"]


def test_probabilities_sum_to_one():
    texts = ["a b c a b", "a c", "b b b a", "", "c a b c d"]
    model = Plain(texts, 3)
    words = [*model.plain, "never"]
    for h in ([BOS, BOS], [BOS, "a"], ["a", "b"], ["x", "y"], ["x", "a"]):
        assert math.isclose(sum(model.p(h, w) for w in words), 1)


def test_nothing_to_learn_from(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert kneser_ney.score(none).count() == 0
    only = kneser_ney.score(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), held_out=F.lit(True)).first()
    assert (only["score"], only["base_score"], only["n_known"], only["train_tokens"], only["n_tokens"]) == (0, 0, 0, 0, 3)


def test_model_is_stored_sorted_and_mapped(spark):
    folder = scratch_path(spark, "model")
    docs = documents(spark)
    kneser_ney.score(docs, order=2, folder=folder).count()
    keys, sums = kneser_ney.mapped(f"{folder}/level-2/part-000000")
    counts = sums[0][np.arange(len(keys))]
    assert isinstance(keys.base, np.ndarray) and (keys[1:] > keys[:-1]).all() and (counts > 0).all() and counts.max() > 255
    types = Plain([t for i, t in rows_of(docs) if not held_out(i)], 2).levels[2]
    assert len(keys) == len(types) and int(counts.sum()) == sum(types.values())
