"""SimHash fingerprints, links by Hamming distance and their components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.llm.common import shards, text_of
from shopgrain.llm.components import components
from shopgrain.session import materialize

BITS = 64
CHUNK = 65_536
MAX_BUCKET = 1024
FLUSH = 1_000_000
#: Bytes of text that a worker looks at together.
SLICE_BYTES = 4 << 20


def fingerprint(text: bytes, words_per_shingle: int = 3, seed: int = 42) -> int:
    """A bit is set if it is set in over half of the shingle hashes; no words give zero."""
    words = text.lower().split()  # on bytes: ASCII letters and the six ASCII white spaces only
    if not words:
        return 0
    joined = b" ".join(words)
    k = min(words_per_shingle, len(words))
    ends = [e + i for i, e in enumerate(accumulate(map(len, words)))]
    starts = [0, *(e + 1 for e in ends[: len(words) - k])]
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), CHUNK):
        pairs = zip(starts[at : at + CHUNK], ends[k - 1 + at :])
        hashes = np.array([digest(joined[a:b], seed) for a, b in pairs], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(votes * 2 > len(starts), bitorder="little")
    return int(packed.view(np.int64)[0])


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, seed: int = 42
) -> DataFrame:
    """``id``, ``fp`` (64 bits as a long) and ``th`` (a hash of the text) for every row."""

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in shards(batches, SLICE_BYTES):
            texts = b.column(1).cast(pa.large_binary())
            fps = [fingerprint(t.as_py(), words, seed) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(fps, pa.int64()), b.column(2)], names=["id", "fp", "th"]
            )

    rows = docs.select(
        F.col(id_col).alias("id"),
        text_of(text_col).alias("text"),
        F.xxhash64(text_of(text_col)).alias("th"),
    )
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(prints, f"id {kind}, fp long, th long")


def agreed_masks(levels: int, distance: int) -> list[list[int]]:
    """For each level, the bit masks on which linked fingerprints may agree.

    Of ``distance + 1`` blocks, a pair within ``distance`` bits agrees in one at least; the bits
    outside that block are cut into blocks again, so each level adds agreed bits.
    """
    ways = distance + 1
    masks = [[0]]
    for _ in range(levels):
        nxt = []
        for mask in masks[-1]:
            free = [b for b in range(BITS) if not mask >> b & 1]
            for j in range(ways):
                own = free[len(free) * j // ways : len(free) * (j + 1) // ways]
                nxt.append(mask | sum(1 << b for b in own))
        masks.append(nxt)
    return masks


def signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def pivots(count: int, seed: int = 7) -> np.ndarray:
    """Reference fingerprints; any values are right, random ones spread the distances."""
    return np.random.default_rng(seed).integers(0, 2**63, count, np.uint64) * np.uint64(2) + (
        np.arange(count, dtype=np.uint64) & np.uint64(1)
    )


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest linked position of each of n positions, links taken transitively."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (before == label).all():
            return label


def bucket_links(
    bucket: np.ndarray, fp: np.ndarray, distance: int, refs: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Links within runs of equal ``bucket``, thinned to a forest with the same components.

    The table of distances to all references comes first. Each run is sorted by its first column; a
    pair is dropped as soon as any two distances to a reference differ by more than ``distance``,
    since Hamming distance obeys the triangle inequality. Survivors are compared bit by bit.
    """
    table = np.bitwise_count(fp[:, None] ^ refs[None, :]).astype(np.int8)
    order = np.lexsort((table[:, 0], bucket))
    bucket, fp, table = bucket[order], fp[order], table[order]
    n = len(fp)
    left, right, held = [], [], 0
    active, step = np.arange(n), 1
    while len(active):
        active = active[active + step < n]
        other = active + step
        near = (bucket[active] == bucket[other]) & (
            table[other, 0] - table[active, 0] <= distance
        )  # beyond, all later partners are as far in the first column, too
        active = active[near]
        other = active + step
        fits = (np.abs(table[active] - table[other]) <= distance).all(axis=1)
        i, j = active[fits], other[fits]
        linked = np.bitwise_count(fp[i] ^ fp[j]) <= distance
        left.append(i[linked])
        right.append(j[linked])
        held += int(linked.sum())
        if held > FLUSH:
            root = forest(n, np.concatenate(left), np.concatenate(right))
            i = np.flatnonzero(root != np.arange(n))
            left, right, held = [i], [root[i]], len(i) - n
        step += 1
    root = forest(n, np.concatenate(left or [active]), np.concatenate(right or [active]))
    i = np.flatnonzero(root != np.arange(n))
    return fp[i], fp[root[i]]


def links(nodes: DataFrame, distance: int = 3, n_pivots: int = 16) -> DataFrame:
    """Links ``a``, ``b`` between distinct fingerprints ``fp`` with the same components as all links.

    Pivot distances alone leave a constant share of all pairs, so fingerprints are first dealt into
    buckets that linked ones must share; buckets over MAX_BUCKET rows are dealt again by more
    agreed bits. After five levels few bits are free (15 at 3 bits' distance), which
    bounds the distinct fingerprints of a bucket.
    """
    levels = 5
    masks = [[signed(m) for m in level] for level in agreed_masks(levels, distance)]
    ways = distance + 1
    refs = pivots(n_pivots)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = []
        for b in _with_end(batches):
            if b is not None:
                got = [b.column(i).to_numpy() for i in range(3)]
                kept = [np.concatenate(x) for x in zip(kept, got)] if kept else got
            if not kept or not len(kept[0]):
                continue
            path, val, fp = kept
            new = (path[1:] != path[:-1]) | (val[1:] != val[:-1])
            run = np.concatenate([[0], np.cumsum(new)])
            done = len(run) if b is None else int(np.searchsorted(run, run[-1]))
            if done:
                a, c = bucket_links(run[:done], fp[:done].view(np.uint64), distance, refs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a.view(np.int64)), pa.array(c.view(np.int64))], names=["a", "b"]
                )
            kept = [x[done:].copy() for x in kept]

    def dealt(rows: DataFrame, level: int) -> DataFrame:
        """Rows of ``path`` and ``fp``, once for each mask that continues the path."""
        lit = F.array(*(F.lit(m).cast("long") for m in masks[level]))
        return rows.select(
            F.explode(F.array(*(F.col("path") * ways + j for j in range(ways)))).alias("path"), "fp"
        ).select("path", F.col("fp").bitwiseAND(F.get(lit, F.col("path"))).alias("val"), "fp")

    rows = dealt(nodes.select(F.lit(0).alias("path"), "fp"), 1)
    found = None
    for level in range(2, levels + 1):
        rows = dealt(rows.select("path", "fp"), level)
        sizes = rows.groupBy("path", "val").agg(F.count("*").alias("n")).where("n > 1")
        # Written first: a join of two plain shuffles can split a hot bucket.
        sizes = materialize(sizes, f"sizes-{level}")
        rows = materialize(rows.join(sizes, ["path", "val"]), f"buckets-{level}")
        ready = rows if level == levels else rows.where(F.col("n") <= MAX_BUCKET)
        part = (
            ready.select("path", "val", "fp")
            .repartition("path", "val")
            .sortWithinPartitions("path", "val")
            .mapInArrow(compare, "a long, b long")
        )
        found = part if found is None else found.union(part)
        rows = rows.where(F.col("n") > MAX_BUCKET)
        if rows.isEmpty():
            break
    return found.distinct()


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def simhash_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 3,
    distance: int = 3,
    seed: int = 42,
    n_pivots: int = 16,
) -> DataFrame:
    """``id``, ``fp``, ``th``, ``component_id``, the smallest id reachable over links, and
    ``component_th``, the hash of that row's text (the least, should several texts have the id).

    Null text counts as empty. Texts without words share the fingerprint zero. Repeated rows and
    ids each get a result row. Null ids are never a component's id unless it has no other.
    """
    marked = materialize(fingerprints(docs, id_col, text_col, words, seed), "fingerprints")
    named = F.when(F.col("id").isNotNull(), F.struct("id", "th"))
    nodes = materialize(marked.groupBy("fp").agg(F.min(named).alias("first")), "distinct-prints")
    roots = components(links(nodes, distance, n_pivots))
    grouped = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    smallest = grouped.groupBy("root").agg(F.min("first").alias("least"))
    member = grouped.join(smallest, "root").select(
        "fp", F.col("least.id").alias("component_id"), F.col("least.th").alias("component_th")
    )
    return marked.join(member, "fp").select("id", "fp", "th", "component_id", "component_th")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """Of each component, the document with the smallest id; rows without an id stay as they are.

    Should several texts of a component have that id, the one with the least hash stays. Rows equal in id
    and text are one document and stay or go together.
    """
    groups = simhash_groups(docs, id_col, **options)
    gone = groups.where("id IS NOT NULL AND (id <> component_id OR th <> component_th)").select(
        F.col("id").alias("__id"), F.col("th").alias("__th")
    )
    same = (F.col(id_col) == F.col("__id")) & (F.xxhash64(text_of()) == F.col("__th"))
    return docs.join(gone.distinct(), same, "left_anti")
