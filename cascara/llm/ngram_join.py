"""Jaccard join of word n-gram sets by vertical partitioning.

1. Pruning. Of two linked sets neither has more than a fifth (1 - t) of its n-grams outside the other. A fixed share of
   all n-grams, chosen by hash alone, is counted over the corpus in packed form; a set whose counted n-grams occur
   nowhere else more often than that fifth allows has no link and leaves.
2. Equal sets become one representative (the least id); copies are never paired.
3. Global order. The n-grams of the representatives left are ordered by how many of them hold it (rarest first, in
   powers of two), then by hash. Two linked sets share an n-gram of their prefixes, so a star from the least member of
   each prefix n-gram's list to the others connects everything that can link. The connected groups are bounded by
   blocks of ``BLOCK`` representatives; a larger group is split into pairs of blocks, small groups share a tile.
4. Vertical partitioning. The order is cut into ``FRAGMENTS`` of equal weight. A task counts the overlaps of a tile's
   sets inside one fragment (a product of incidence matrices), a second task sums the fragments per pair and compares
   with the threshold. Pairs never become rows: a tile's counts are one matrix, and it returns a spanning forest of its
   links, which has all connections between different sets.
5. Components of the links give every document its class.

Defined cases: null and empty texts have no n-grams and no links; a text shorter than n words is one n-gram; rows with
equal ids are one document each but share the id, so they share a class where their sets are equal or linked; a null id
is never linked; an empty table gives no rows; only ``doc_id`` and ``text`` are read (``unique`` keeps all columns).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cascara.llm.common import BLOBS, BUCKET_BYTES, by_chunk, chunked, components, doc_words, key_width, member, mix, ordered, pack, prepare, repeated, reply_keys, stage, text_bytes, to_blobs, unpack, windows

N = 5
THRESHOLD = (80, 100)
FRAGMENTS = 4
#: Representatives on each side of a tile.
BLOCK = 256
#: Of all n-grams, the share in 256ths that the pruning counts.
COUNTED = 90

SETS = "doc_id long, n_shingles long, signature binary, grams binary"
COUNTS = "chunk long, bucket int, grams binary, held binary"
ORDERED = "doc_id long, n_shingles long, prefix array<long>, fragments array<binary>"


def gram_sets(table: pa.Table, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(n-grams, first of each row, with the end): the distinct n-grams of each row, sorted by hash."""
    _, _, _, first, h = doc_words(table, lower=True)
    rows = len(first) - 1
    count = np.diff(first)
    size = np.where(count >= n, count - n + 1, 0)
    row = np.repeat(np.arange(rows), size)
    start = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + first[:-1][row]
    gram = windows(h, n)[start] if len(start) else np.zeros(0, np.uint64)
    short = np.flatnonzero((count > 0) & (count < n))
    if len(short):
        whole = np.array([mix(windows(h[first[i] : first[i + 1]], int(count[i])) + np.uint64(count[i]))[0] for i in short], np.uint64)
        row, gram = np.concatenate([row, short]), np.concatenate([gram, whole])
    order = np.lexsort((gram, row))
    row, gram = row[order], gram[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (gram[1:] != gram[:-1])
    row, gram = row[new], gram[new]
    return gram, np.searchsorted(row, np.arange(rows + 1)), row


def _is_counted(gram: np.ndarray) -> np.ndarray:
    return gram >> np.uint64(56) < COUNTED


def document_sets(docs: DataFrame, n: int = N, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """Per document its number of n-grams and, where it may have a link, a signature of the set and the set."""
    prepare(docs.sparkSession)
    total = text_bytes(docs)
    frame = chunked(docs, total)
    width = key_width(total)
    low = np.uint64(256**width - 1)
    buckets = max(1, math.ceil(total / 5.5 * COUNTED / 256 * width / BUCKET_BYTES))
    num, den = threshold

    def count(table: pa.Table) -> pa.Table:
        gram, _, _ = gram_sets(ordered(table), n)
        return to_blobs(table["chunk"][0].as_py(), gram[_is_counted(gram)] & low, width, buckets)

    def prune(table: pa.Table, back: pa.Table) -> pa.Table:
        gram, first, row = gram_sets(table, n)
        alone = np.zeros(len(gram), bool)
        asked = np.flatnonzero(_is_counted(gram))
        alone[asked] = ~member(gram[asked] & low, reply_keys(back, width))
        size = np.diff(first)
        outside = np.bincount(row[alone], minlength=len(size))
        keep = (size > 0) & (outside * den <= (den - num) * size)
        signature = [_signature(gram[a:b]) if k else None for a, b, k in zip(first[:-1], first[1:], keep, strict=True)]
        grams = [gram[a:b].tobytes() if k else None for a, b, k in zip(first[:-1], first[1:], keep, strict=True)]
        return pa.table({"doc_id": table["doc_id"], "n_shingles": pa.array(size, pa.int64()), "signature": pa.array(signature, pa.binary()), "grams": pa.array(grams, pa.binary())})

    again = repeated(frame.groupBy("chunk").applyInArrow(count, BLOBS), width)
    return by_chunk(frame, again, prune, SETS)


def _signature(grams: np.ndarray) -> bytes:
    """128 bits of a sorted set."""
    a = mix(grams + np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64)
    b = mix(grams ^ np.uint64(0xD1B54A32D192ED03)).sum(dtype=np.uint64)
    return np.array([a, b], "<u8").tobytes()


def representatives(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sets of the representatives, (doc_id, representative) of all documents that may have a link)."""
    kept = sets.where("signature is not null and doc_id is not null")
    least = kept.groupBy("signature", "n_shingles").agg(F.min("doc_id").alias("representative"), F.count("*").alias("copies"))
    members = kept.select("doc_id", "signature", "n_shingles").join(least, ["signature", "n_shingles"]).select("doc_id", "representative")
    chosen = kept.join(least.select(F.col("representative").alias("doc_id"), "signature", "n_shingles"), ["doc_id", "signature", "n_shingles"], "left_semi")
    return chosen.dropDuplicates(["doc_id", "signature"]).select("doc_id", "n_shingles", "grams"), members


def in_order(sets: DataFrame, threshold: tuple[int, int], fragments: int) -> DataFrame:
    """The sets in the global order: each one's prefix (n-grams that others hold too) and its cut into fragments."""
    total = sets.agg(F.sum("n_shingles").alias("n")).first()["n"] or 0
    chunks = max(1, math.ceil(total * 8 / 4_000_000))
    frame = stage(sets.withColumn("chunk", F.pmod(F.xxhash64("doc_id"), F.lit(chunks))), "join-sets")
    buckets = max(1, math.ceil(total * 8 / BUCKET_BYTES))
    num, den = threshold

    def flat(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        return np.frombuffer(b"".join(table["grams"].to_pylist()), np.uint64), table["n_shingles"].to_numpy()

    def count(table: pa.Table) -> pa.Table:
        gram, n = np.unique(flat(table)[0], return_counts=True)
        cuts = np.searchsorted(gram, np.array([2**64 * b // buckets for b in range(buckets)], np.uint64)).tolist() + [len(gram)]
        at = [(b, slice(cuts[b], cuts[b + 1])) for b in range(buckets) if cuts[b] < cuts[b + 1]]
        rows = [(table["chunk"][0].as_py(), b, gram[s].tobytes(), n[s].astype("<u4").tobytes()) for b, s in at]
        return _rows(rows, COUNTS, [pa.int64(), pa.int32(), pa.binary(), pa.binary()])

    def holders(table: pa.Table) -> pa.Table:
        """For each chunk's n-grams, how many sets hold them."""
        grams = [np.frombuffer(g.as_py(), np.uint64) for g in table["grams"]]
        held = np.concatenate([np.frombuffer(h.as_py(), "<u4") for h in table["held"]])
        _, inverse = np.unique(np.concatenate(grams), return_inverse=True)
        every = np.bincount(inverse, weights=held)[inverse].astype("<u4")
        ends = np.cumsum([len(g) for g in grams])
        rows = [(c.as_py(), b.as_py(), g.as_py(), every[e - len(x) : e].tobytes()) for c, b, g, x, e in zip(table["chunk"], table["bucket"], table["grams"], grams, ends, strict=True)]
        return _rows(rows, COUNTS, [pa.int64(), pa.int32(), pa.binary(), pa.binary()])

    held = stage(frame.select("chunk", "n_shingles", "grams").groupBy("chunk").applyInArrow(count, COUNTS).groupBy("bucket").applyInArrow(holders, COUNTS), "join-counts")

    def weigh(table: pa.Table) -> pa.Table:
        known, level = _levels(table)
        n = np.bincount(level, minlength=33)
        return pa.table({"level": pa.array(range(33), pa.int32()), "n": pa.array(n, pa.int64())})

    weights = {r["level"]: r["n"] for r in held.groupBy("chunk").applyInArrow(weigh, "level int, n long").groupBy("level").agg(F.sum("n").alias("n")).collect()}  # 33 rows
    before = np.cumsum([0, *(weights.get(k, 0) for k in range(33))])
    whole = max(1, int(before[-1]))

    def arrange(table: pa.Table, back: pa.Table) -> pa.Table:
        table = table.sort_by("doc_id")
        known, level = _levels(back)
        gram, size = flat(table)
        order = np.argsort(known)
        known, level = known[order], level[order]
        lev = level[np.searchsorted(known, gram)]
        row = np.repeat(np.arange(len(size)), size)
        order = np.lexsort((gram, lev, row))
        gram, lev = gram[order], lev[order]
        # The place of each n-gram in the global order, as a share of all, and so its fragment.
        share = (before[lev] + (before[lev + 1] - before[lev]) * (gram.astype(np.float64) / 2.0**64)) / whole
        cut = np.minimum((share * fragments).astype(np.int64), fragments - 1)
        first = np.concatenate([[0], np.cumsum(size)])
        prefixes, parts = [], []
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            length = (b - a) - -(-num * (b - a) // den) + 1
            p = gram[a : a + length][lev[a : a + length] > 0]
            prefixes.append(p.view(np.int64))
            at = np.searchsorted(cut[a:b], np.arange(fragments + 1))
            parts.append([gram[a + x : a + y].tobytes() for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)])
        return pa.table({"doc_id": table["doc_id"], "n_shingles": table["n_shingles"], "prefix": pa.array(prefixes, pa.list_(pa.int64())), "fragments": pa.array(parts, pa.list_(pa.binary()))})

    return frame.groupBy("chunk").cogroup(held.groupBy("chunk")).applyInArrow(arrange, ORDERED)


def _levels(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """N-grams and how many sets hold them, in powers of two (0: one set alone)."""
    gram = np.frombuffer(b"".join(table["grams"].to_pylist()), np.uint64)
    held = np.frombuffer(b"".join(table["held"].to_pylist()), "<u4")
    level = np.floor(np.log2(np.maximum(held, 1))).astype(np.int64)
    level[held > 1] = np.maximum(level[held > 1], 1)
    return gram, level


def _rows(rows: list[tuple], schema: str, kinds: list[pa.DataType]) -> pa.Table:
    names = [c.split()[0] for c in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
    return pa.table({n: pa.array(c, k) for n, c, k in zip(names, columns, kinds, strict=True)})


def tiles(sets: DataFrame, block: int = BLOCK) -> DataFrame:
    """(tile, side_a, side_b, doc_id, ...): the representatives of each connected group of prefix n-grams, in tiles."""
    entries = stage(sets.select("doc_id", F.explode("prefix").alias("gram")), "join-prefixes")
    hubs = entries.groupBy("gram").agg(F.min("doc_id").alias("hub"), F.count("*").alias("n")).where("n > 1").select("gram", "hub")
    edges = entries.join(hubs, "gram").where("doc_id != hub").select(F.col("doc_id").alias("a"), F.col("hub").alias("b")).distinct()
    groups = components(edges, "join-groups")
    sizes = groups.groupBy("component").agg(F.count("*").alias("size"))
    small = sizes.where(F.col("size") <= block).agg(F.sum("size").alias("n")).first()["n"] or 0
    shared = max(1, math.ceil(small / (block / 2)))
    blocks = F.ceil(F.col("size") / block).cast("int")
    own = F.pmod(F.xxhash64("doc_id"), blocks).cast("int")
    alone = F.col("size") <= block
    placed = groups.withColumnRenamed("node", "doc_id").join(sizes, "component").select(
        "doc_id",
        F.when(alone, -1 - F.pmod(F.xxhash64("component"), F.lit(shared))).otherwise(F.col("component")).alias("tile"),
        F.when(alone, F.lit(0)).otherwise(own).alias("own"),
        F.explode(F.when(alone, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), blocks - 1))).alias("other"),
    )
    return placed.select("tile", F.least("own", "other").alias("side_a"), F.greatest("own", "other").alias("side_b"), "doc_id").distinct()


def links(sets: DataFrame, threshold: tuple[int, int] = THRESHOLD, fragments: int = FRAGMENTS) -> DataFrame:
    """(a, b): links between representatives, enough to connect all that are connected (a spanning forest per tile)."""
    num, den = threshold
    ranked = stage(in_order(sets, threshold, fragments), "join-ordered")
    key = ["tile", "side_a", "side_b"]
    parts = tiles(ranked).join(ranked.select("doc_id", "n_shingles", F.posexplode("fragments").alias("fragment", "grams")), "doc_id")

    def overlap(table: pa.Table) -> pa.Table:
        table = table.sort_by("doc_id")
        docs = len(table)
        size = np.array([len(g) // 8 for g in table["grams"].to_pylist()])
        gram = np.frombuffer(b"".join(table["grams"].to_pylist()), np.uint64)
        row = np.repeat(np.arange(docs), size)
        counts = np.zeros((docs, docs), np.float32)
        if len(gram):
            _, column, held = np.unique(gram, return_inverse=True, return_counts=True)
            shared = held[column] > 1  # an n-gram of one set alone adds nothing
            dense = np.cumsum(held > 1) - 1
            row, column = row[shared], dense[column[shared]]
            order = np.argsort(column, kind="stable")
            row, column = row[order], column[order]
            step = max(1, 8_000_000 // max(1, docs) // 4)
            for c in range(0, int((held > 1).sum()), step):
                a, b = np.searchsorted(column, [c, c + step])
                m = np.zeros((docs, step), np.float32)
                m[row[a:b], column[a:b] - c] = 1
                counts += m @ m.T
        first = {k: table[k][0].as_py() for k in key}
        upper = counts[np.triu_indices(docs, 1)].astype("<u4")
        ids, sizes = table["doc_id"].to_numpy().astype("<i8"), table["n_shingles"].to_numpy().astype("<i8")
        return pa.table({**{k: pa.array([v], t) for (k, v), t in zip(first.items(), [pa.int64(), pa.int32(), pa.int32()], strict=True)}, "ids": pa.array([ids.tobytes()]), "sizes": pa.array([sizes.tobytes()]), "counts": pa.array([upper.tobytes()])})

    def total(table: pa.Table) -> pa.Table:
        ids, sizes = np.frombuffer(table["ids"][0].as_py(), "<i8"), np.frombuffer(table["sizes"][0].as_py(), "<i8")
        shared = sum(np.frombuffer(c.as_py(), "<u4").astype(np.int64) for c in table["counts"])
        i, j = np.triu_indices(len(ids), 1)
        linked = shared * den >= num * (sizes[i] + sizes[j] - shared)
        root = np.arange(len(ids))
        for a, b in zip(i[linked].tolist(), j[linked].tolist(), strict=True):
            while root[a] != a:
                a = root[a]
            while root[b] != b:
                b = root[b]
            root[max(a, b)] = min(a, b)
        child = np.flatnonzero(root != np.arange(len(ids)))
        return pa.table({"a": pa.array(ids[child], pa.int64()), "b": pa.array(ids[root[child]], pa.int64())})

    counted = parts.groupBy(*key, "fragment").applyInArrow(overlap, "tile long, side_a int, side_b int, ids binary, sizes binary, counts binary")
    return counted.groupBy(*key).applyInArrow(total, "a long, b long")


def classes(docs: DataFrame, n: int = N, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """doc_id, n_shingles and component_id (the least id reachable by links) of every document."""
    sets = stage(document_sets(docs, n, threshold), "join-documents")
    chosen, members = representatives(sets)
    found = components(links(chosen, threshold), "join-links").withColumnRenamed("node", "representative")
    of = members.join(found, "representative", "left").select("doc_id", F.coalesce("component", "representative").alias("component_id")).distinct()
    of = of.groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    return sets.select("doc_id", "n_shingles").join(of, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def unique(docs: DataFrame, n: int = N, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """The documents of which each group of linked ones keeps the one with the least id, with all columns. Of rows with
    the same id and text one stays; rows that share an id but not the text are kept or dropped together."""
    found = classes(docs.select("doc_id", "text"), n, threshold)
    state = stage(found.groupBy(F.col("doc_id").alias("gone")).agg(F.count("*").alias("n"), F.max(F.col("doc_id") != F.col("component_id")).alias("drop")).where("gone is not null and (drop or n > 1)"), "join-gone")
    same = F.col("doc_id").cast("long") == F.col("gone")
    kept = docs.join(state.where("drop").select("gone"), same, "left_anti")
    again = state.where("not drop").select("gone")
    if again.isEmpty():
        return kept
    return kept.join(again, same, "left_anti").unionByName(kept.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"]))
