"""Substring, byte and near-duplicate operators against brute force, over several chunk sizes."""

import collections
import hashlib

import numpy as np
import pytest
from .fixtures_path import documents, rows_of

from cascara.llm import common, ngram_join, run_length_dedup, substring_dedup

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def chunks_of(monkeypatch, module, size):
    monkeypatch.setattr(module, "chunked", lambda docs, total: common.chunked(docs, total, size))


def removed_words(rows, window=20):
    seen, out = set(), []
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0], r[1] is None, r[1])):
        w = (t or "").encode().split()
        gone = np.zeros(len(w), bool)
        for p in range(len(w) - window + 1):
            k = tuple(w[p : p + window])
            if k in seen:
                gone[p : p + window] = True
            seen.add(k)
        out.append((i, b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode(), len(w), int(gone.sum())))
    return collections.Counter(out)


@pytest.mark.parametrize("size", [2_000_000, 3_000])
def test_windows_match_brute_force(spark, monkeypatch, size):
    chunks_of(monkeypatch, substring_dedup, size)
    docs = documents(spark, [(None, "nul id " * 30)])
    got = substring_dedup.deduplicate(docs).collect()
    assert collections.Counter((r["doc_id"], r["text"], r["n_words"], r["n_removed"]) for r in got) == removed_words(rows_of(docs))
    assert all(sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"] for r in got)


def test_odd_window_has_one_level(spark):
    docs = documents(spark)
    assert substring_dedup.lengths(20) == [5, 10, 20] and substring_dedup.lengths(7) == [7]
    got = substring_dedup.deduplicate(docs, window=7).collect()
    assert collections.Counter((r["doc_id"], r["text"], r["n_words"], r["n_removed"]) for r in got) == removed_words(rows_of(docs), 7)


def removed_bytes(rows, size=200):
    seen = collections.Counter(b[p : p + size] for b in ((t or "").encode() for _, t in rows) for p in range(len(b) - size + 1))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - size + 1):
            if seen[b[p : p + size]] > 1:
                gone[p : p + size] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((i, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest(), len(b), int(gone.sum()), runs))
    return collections.Counter(out)


@pytest.mark.parametrize(("size", "hot"), [(2_000_000, 64), (3_000, 64), (3_000, 2)])
def test_bytes_match_brute_force(spark, monkeypatch, size, hot):
    chunks_of(monkeypatch, run_length_dedup, size)
    docs = documents(spark)
    got = run_length_dedup.deduplicate(docs, hot=hot).collect()
    assert collections.Counter((r["doc_id"], hashlib.sha256(r["kept"]).hexdigest(), r["n_bytes"], r["n_removed"], len(r["spans"])) for r in got) == removed_bytes(rows_of(docs))


def test_index_matching_statistics():
    text = b"abracadabra\xffbracadabrab\xffzzz\xffabrac\xff"
    got = run_length_dedup.RunLengthIndex(np.frombuffer(text, np.uint8), 16).matching_statistics()
    for i in range(len(text)):
        end = text.index(255, i) - i
        best = max(next((n for n in range(end) if text[i : i + n + 1] != text[j : j + n + 1]), end) for j in range(len(text)) if j != i)
        assert min(got[i], end) == best


def linked(rows):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().translate(LOWER).split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    of = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if a != b and both and 100 * both >= 80 * len(sets[a] | sets[b]) and of[b] < of[a]:
                    of[a], changed = of[b], True
    return {i: (len(sets[i]), of[i]) for i in sets}


@pytest.mark.parametrize(("size", "block"), [(2_000_000, 256), (3_000, 3)])
def test_classes_match_brute_force(spark, monkeypatch, size, block):
    chunks_of(monkeypatch, ngram_join, size)
    monkeypatch.setattr(ngram_join.tiles, "__defaults__", (block,))
    docs = documents(spark)
    rows = rows_of(docs)
    got = ngram_join.classes(docs).collect()
    assert len(got) == len(rows)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == linked(rows)
    kept = ngram_join.unique(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, (_, c) in linked(rows).items() if c == i)


def test_no_rows(spark):
    none = documents(spark).limit(0)
    assert substring_dedup.deduplicate(none).count() == 0
    assert run_length_dedup.deduplicate(none).count() == 0
    assert ngram_join.classes(none).count() == 0
    assert ngram_join.unique(none).count() == 0
