"""Small tables with the awkward cases: nulls, empty and long texts, repeated rows, clashing column names, no rows."""

import random

DOCS = "doc_id long, text string, n_words int, chunk string, row string, spans int, features string"


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n)]


def documents(spark, extra=()):
    rng = random.Random(5)
    passage = " ".join(words(rng, 60))
    base = words(rng, 120)
    texts = [" ".join(words(rng, rng.randint(30, 200))) for _ in range(25)]
    texts += [f"{' '.join(words(rng, 20))} {passage}\n{' '.join(words(rng, 30))}" for _ in range(8)]
    for k in range(6):
        near = list(base)
        near[k * 7] = f"edit{k}"
        texts.append(" ".join(near))
    texts += [" ".join(base)] * 3 + ["", None, " \t\n", "one", "ONE", "two words", "é ü 😀 é", "x" * 1500, "ab " * 400]
    texts.append(" ".join(words(rng, 4000)) + " " + passage)
    rows = [(i * 3 - 5, t) for i, t in enumerate(texts)] + [(1000, texts[2]), (1000, texts[2]), *extra]
    return spark.createDataFrame([(i, t, 1, "c", "r", 2, None) for i, t in rows], DOCS)


def rows_of(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]
