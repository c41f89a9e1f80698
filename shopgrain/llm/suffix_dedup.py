"""Removal of byte strings that occur more than once, by hash-compared suffix sorting."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.llm.common import flat, shards, text_of
from shopgrain.session import delete_path, materialize, scratch_path

LENGTH = 200
#: Bytes of the anchor string; the longer, the fewer anchors are shared by chance, but the more there are.
GRAM = 48
SHARD_BYTES = 1 << 20
#: Different surroundings of one anchor that a task sorts together; larger groups go by window digests.
MAX_GROUP = 4096
#: Surroundings sorted at a time.
BATCH_SEGMENTS = 4096

BASE = np.uint64(0xD6E8FEB86659FD93)  # odd, so it has an inverse modulo 2 ** 64
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
MIX = np.uint64(0x9E3779B97F4A7C15)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    p = np.full(n + 1, base, np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


class Hashes:
    """Prefix polynomial hashes of a byte string; equal substrings have equal hashes anywhere."""

    def __init__(self, data: np.ndarray):
        self.data = data
        weighted = (data.astype(np.uint64) + np.uint64(1)) * _powers(BASE, len(data))[:-1]
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(weighted, dtype=np.uint64)])
        self.back = _powers(INVERSE, len(data))

    def of(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return (self.sums[start + length] - self.sums[start]) * self.back[start]

    def common(self, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
        """Length of the common extension of suffixes, ``depth`` at most, by binary search."""
        low = np.zeros(len(a), np.int64)
        high = np.full(len(a), depth, np.int64)
        for _ in range(depth.bit_length()):
            mid = (low + high + 1) // 2
            same = self.of(a, mid) == self.of(b, mid)
            low = np.where(same, mid, low)
            high = np.where(same, high, np.maximum(mid - 1, low))
        return low

    def less(self, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
        n = self.common(a, b, depth)
        at = np.minimum(n, depth - 1)
        return (n < depth) & (self.data[a + at] < self.data[b + at])


def suffix_sort(hashes: Hashes, starts: np.ndarray, groups: np.ndarray, depth: int) -> np.ndarray:
    """Order of suffixes by group and their first ``depth`` bytes (as many must follow each start).

    Runs begin as the suffixes with equal group and first 8 bytes; within these, a bottom-up
    mergesort doubles its sorted stretches. Each element finds its place in the neighbouring
    stretch by binary search, and each comparison is a binary search on the hashes, so it takes
    logarithmically many steps in ``depth``. All elements move at once.
    """
    data = hashes.data.astype(np.uint64)
    lead = np.zeros(len(starts), np.uint64)
    for i in range(min(8, depth)):
        lead = (lead << np.uint64(8)) | data[starts + i]
    order = np.lexsort((lead, groups))
    g, k = groups[order], lead[order]
    new = np.concatenate([[True], (g[1:] != g[:-1]) | (k[1:] != k[:-1])])[: len(order)]
    first = np.flatnonzero(new)
    block = np.cumsum(new) - 1
    begin = first[block]
    end = np.concatenate([first[1:], [len(order)]])[block] if len(order) else begin
    width, longest = 1, int((end - begin).max(initial=0))
    while width < longest:
        spot = np.flatnonzero(end - begin > width)
        offset = spot - begin[spot]
        run = offset // width
        low = np.minimum(begin[spot] + (run ^ 1) * width, end[spot])
        high = np.minimum(low + width, end[spot])
        base = low.copy()
        own = starts[order[spot]]
        odd = run % 2 == 1
        while (live := low < high).any():
            at = np.flatnonzero(live)
            mid = (low[at] + high[at]) // 2
            other = starts[order[mid]]
            # Equal suffixes of the left stretch stay before those of the right one.
            x, y = np.where(odd[at], own[at], other), np.where(odd[at], other, own[at])
            below = hashes.less(x, y, depth) ^ odd[at]
            low[at] = np.where(below, mid + 1, low[at])
            high[at] = np.where(below, high[at], mid)
        place = begin[spot] + (run // 2) * 2 * width + offset % width + (low - base)
        moved = order.copy()
        moved[place] = order[spot]
        order = moved
        width *= 2
    return order


def anchors(raw: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Segments (first start, last start, anchor) that cover the starts of all ``length``-byte strings.

    A string's anchor is the leftmost of its ``gram``-byte strings with the least hash, so equal
    strings have their anchor at the same place. Starts in a row with the same anchor are one segment.
    """
    none = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    wide = length - gram + 1
    if len(raw) < length:
        return none
    h = Hashes(raw)
    x = h.of(np.arange(len(raw) - gram + 1), gram)
    x = (x ^ (x >> np.uint64(32))) * MIX
    x ^= x >> np.uint64(29)
    bits = np.uint64(max(20, len(raw).bit_length()))
    mask = (np.uint64(1) << bits) - np.uint64(1)
    least = (x & ~mask) | np.arange(len(x), dtype=np.uint64)
    span = 1
    while span * 2 <= wide:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if wide > span:
        least = np.minimum(least[: -(wide - span)], least[wide - span :])
    ends = np.repeat(offsets[1:], np.diff(offsets))
    start = np.flatnonzero(ends[: len(least)] - np.arange(len(least)) >= length)
    if not len(start):
        return none
    at = (least[start] & mask).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    last = np.concatenate([new[1:], [len(start)]]) - 1
    return start[new], start[last], at[new], x[at[new]]


def segments(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """A row per segment: ``a`` (the anchor's hash), ``s``, ``s2`` (a 96-bit digest of the segment's bytes
    and the anchor's place in it), ``nd`` (starts in it and the anchor's place), ``o`` (where it is in
    its document) and the document's ``id`` and ``th``."""
    kind = docs.schema["id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in shards(batches, SHARD_BYTES):
            raw, offsets = flat(b.column(1))
            first, last, at, a = anchors(raw, offsets, length, gram)
            text = raw.tobytes()
            n, d = last - first + 1, at - first
            digest = b"".join(
                hashlib.blake2b(text[i:j], digest_size=12, salt=bytes((m & 255, m >> 8))).digest()
                for i, j, m in zip(first.tolist(), (last + length).tolist(), d.tolist())
            )
            parts = np.frombuffer(digest, np.dtype([("s", "<i8"), ("s2", "<i4")]))
            doc = np.searchsorted(offsets, first, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(a.view(np.int64)),
                    pa.array(np.ascontiguousarray(parts["s"])),
                    pa.array(np.ascontiguousarray(parts["s2"])),
                    pa.array((n << 16 | d).astype(np.int32)),
                    pa.array(first - offsets[doc]),
                    b.column(0).take(pa.array(doc)),
                    b.column(2).take(pa.array(doc)),
                ],
                names=["a", "s", "s2", "nd", "o", "id", "th"],
            )

    return docs.mapInArrow(cut, f"a long, s long, s2 int, nd int, o long, id {kind}, th long")


def _ranges(starts: np.ndarray) -> list[dict]:
    """Sorted numbers as ranges, end exclusive."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > 1)
    low = starts[np.concatenate([[0], cut + 1])]
    high = starts[np.concatenate([cut, [len(starts) - 1]])] + 1
    return [{"low": int(x), "high": int(y)} for x, y in zip(low, high)]


def repeated_starts(
    group: np.ndarray, texts: list[bytes], length: int
) -> list[np.ndarray]:
    """For each segment, the starts whose ``length`` bytes also start in another segment of its group."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    n = sizes - length + 1
    segment = np.repeat(np.arange(len(texts)), n)
    within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    starts = begin[segment] + within
    hashes = Hashes(data)
    order = suffix_sort(hashes, starts, group[segment], length)
    a, b = starts[order[:-1]], starts[order[1:]]
    same = (group[segment[order[:-1]]] == group[segment[order[1:]]]) & (hashes.common(a, b, length) >= length)
    pairs = np.flatnonzero(same)
    for i in range(0, len(pairs), 4096):  # a hash may collide: the bytes decide
        p = pairs[i : i + 4096]
        spread = np.arange(length)
        equal = (data[a[p][:, None] + spread] == data[b[p][:, None] + spread]).all(axis=1)
        if not equal.all():
            return _by_bytes(group, texts, length)
    hit = np.zeros(len(starts), bool)
    hit[order[pairs]] = True
    hit[order[pairs + 1]] = True
    cut = np.searchsorted(segment[hit], np.arange(len(texts) + 1))
    found = within[hit]
    return [found[cut[i] : cut[i + 1]] for i in range(len(texts))]


def _by_bytes(group: np.ndarray, texts: list[bytes], length: int) -> list[np.ndarray]:
    """The same without hashes, for the case that two of them collided."""
    count: dict[tuple, int] = {}
    keys = [[(g, t[i : i + length]) for i in range(len(t) - length + 1)] for g, t in zip(group.tolist(), texts)]
    for own in keys:
        for k in own:
            count[k] = count.get(k, 0) + 1
    return [np.array([i for i, k in enumerate(own) if count[k] > 1], np.int64) for own in keys]


RANGES = "ranges array<struct<low: int, high: int>>"


def _within_groups(pieces: DataFrame, length: int) -> DataFrame:
    """``a``, ``s``, ``s2``, ``ranges`` of segments that share some but not all of their strings."""
    ranges = pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def solved(done: pa.Table) -> pa.RecordBatch:
            found = repeated_starts(done["a"].to_numpy(), done["bytes"].to_pylist(), length)
            keep = [i for i, f in enumerate(found) if len(f)]
            out = done.take(pa.array(keep, pa.int64())).combine_chunks()
            columns = [out[c].combine_chunks() for c in ("a", "s", "s2")]
            return pa.RecordBatch.from_arrays(
                [*columns, pa.array([_ranges(found[i]) for i in keep], ranges)], names=["a", "s", "s2", "ranges"]
            )

        for b in batches:
            held.append(b)
            if sum(x.num_rows for x in held) < BATCH_SEGMENTS:
                continue
            table = pa.Table.from_batches(held)
            a = table["a"].to_numpy()
            open_from = int(np.flatnonzero(a == a[-1])[0])  # the last group may go on
            if open_from:
                yield solved(table.slice(0, open_from))
            held = table.slice(open_from).combine_chunks().to_batches()
        if held and sum(x.num_rows for x in held):
            yield solved(pa.Table.from_batches(held))

    return (
        pieces.select("a", "s", "s2", "bytes")
        .repartition("a")
        .sortWithinPartitions("a")
        .mapInArrow(sort, f"a long, s long, s2 int, {RANGES}")
    )


def _by_digest(pieces: DataFrame, length: int) -> DataFrame:
    """The same for large groups: counts of 128-bit digests, so no task gathers a group."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in shards(batches, SHARD_BYTES >> 4, "bytes"):
            texts = b.column(3).to_pylist()
            owner = [i for i, t in enumerate(texts) for _ in range(len(t) - length + 1)]
            start = [j for t in texts for j in range(len(t) - length + 1)]
            joined = b"".join(
                hashlib.blake2b(texts[i][j : j + length], digest_size=16).digest() for i, j in zip(owner, start)
            )
            pair = np.frombuffer(joined, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.ascontiguousarray(pair[:, 0])),
                    pa.array(np.ascontiguousarray(pair[:, 1])),
                    *(b.column(c).take(pa.array(owner, pa.int64())) for c in range(3)),
                    pa.array(start, pa.int32()),
                ],
                names=["h1", "h2", "a", "s", "s2", "i"],
            )

    rows = materialize(
        pieces.select("a", "s", "s2", "bytes").mapInArrow(
            digests, "h1 long, h2 long, a long, s long, s2 int, i int"
        ),
        "window-digests",
    )
    often = rows.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    often = materialize(often, "common-windows")
    found = rows.join(often, ["h1", "h2"], "left_semi").groupBy("a", "s", "s2").agg(
        F.array_sort(F.collect_list("i")).alias("i")  # as many as a segment has starts at most
    )
    one = F.transform("i", lambda i: F.struct(i.alias("low"), (i + 1).alias("high")))
    return found.select("a", "s", "s2", one.alias("ranges"))


def repeated_spans(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, max_group: int = MAX_GROUP
) -> DataFrame:
    """``id``, ``th``, ``spans`` (low, high in bytes; they may overlap) of documents with repeated strings.

    ``docs``: ``id``, ``text`` and ``th``, a hash of the text. A string
    occurs twice only if its anchor does, so only segments whose anchor is shared go on. Equal
    segments are found by their digests. Where an anchor stands in different segments, one copy
    of each is fetched and their suffixes are sorted.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "segments")
    segments(docs, length, gram).write.parquet(path)
    every = spark.read.parquet(path)
    # Counts are written before they are joined: a join of two plain shuffles can split a hot anchor.
    often = every.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").select("a")
    shared = every.join(materialize(often, "shared-anchors"), "a", "left_semi")
    shared = materialize(shared, "shared-segments")
    delete_path(spark, path)  # most segments are the only ones with their anchor
    copies = materialize(
        shared.groupBy("a", "s", "s2").agg(
            F.count("*").alias("n"), F.min(F.struct("id", "th", "o", "nd")).alias("one")
        ),
        "segment-copies",
    )
    kinds = materialize(copies.groupBy("a").agg(F.count("*").alias("kinds")), "anchor-kinds")
    copies = materialize(copies.join(kinds, "a"), "different-segments")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        for b in shards(batches, SHARD_BYTES, "z"):
            for z, wanted in zip(b.column(0), b.column(1)):
                text = unzip.decompress(z.as_py())
                rows = wanted.as_py()
                for r in rows:
                    starts = r.pop("nd") >> 16
                    o = r.pop("o")
                    r["bytes"] = text[o : o + starts - 1 + length]
                yield pa.RecordBatch.from_pylist(rows, fetched)

    fetched = pa.schema(
        [("a", pa.int64()), ("s", pa.int64()), ("s2", pa.int32()), ("kinds", pa.int64()), ("bytes", pa.binary())]
    )
    wanted = (
        copies.where("kinds > 1")
        .groupBy(F.col("one.id").alias("id"), F.col("one.th").alias("th"))
        .agg(F.collect_list(F.struct("a", "s", "s2", "kinds", "one.o", "one.nd")).alias("wanted"))
    )
    # Repeated rows would fetch a segment twice: one of them is enough.
    pieces = (
        zipped(docs).alias("d")
        .join(wanted.alias("w"), (F.col("d.id").eqNullSafe(F.col("w.id"))) & (F.col("d.th") == F.col("w.th")))
        .select("d.z", "w.wanted")
        .mapInArrow(fetch, "a long, s long, s2 int, kinds long, bytes binary")
    )
    pieces = materialize(pieces, "segment-bytes").dropDuplicates(["a", "s", "s2"])
    small = _within_groups(pieces.where(F.col("kinds") <= max_group), length)
    found = small
    if not copies.where(F.col("kinds") > max_group).isEmpty():
        found = small.unionByName(_by_digest(pieces.where(F.col("kinds") > max_group), length))
    found = materialize(found, "repeated-ranges")
    # One table of what repeats, so that one plain join, which can split hot segments, tells all copies.
    whole = F.array(F.struct(F.lit(0).alias("low"), F.shiftright(F.col("one.nd"), 16).alias("high")))
    repeats = materialize(
        copies.join(found, ["a", "s", "s2"], "left")
        .select("a", "s", "s2", F.when(F.col("n") > 1, whole).otherwise(F.col("ranges")).alias("ranges"))
        .where("ranges IS NOT NULL"),
        "repeats",
    )
    return (
        shared.select("a", "s", "s2", "o", "id", "th")
        .join(repeats, ["a", "s", "s2"])
        .select("id", "th", "o", F.explode("ranges").alias("r"))
        .groupBy("id", "th")
        .agg(
            F.collect_set(  # repeated rows have the same ones
                F.struct(
                    (F.col("o") + F.col("r.low")).alias("low"),
                    (F.col("o") + F.col("r.high") - 1 + length).alias("high"),
                )
            ).alias("spans")
        )
    )


def zipped(docs: DataFrame) -> DataFrame:
    """``id``, ``th`` and the compressed text: it moves twice, so it should be small."""
    kind = docs.schema["id"].dataType.simpleString()

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeezer = zstandard.ZstdCompressor(level=3)
        for b in shards(batches, 4 * SHARD_BYTES):
            z = [squeezer.compress(t.as_py()) for t in b.column(1).cast(pa.large_binary())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(z, pa.binary())], names=["id", "th", "z"]
            )

    return docs.select("id", "text", "th").mapInArrow(squeeze, f"id {kind}, th long, z binary")


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    max_group: int = MAX_GROUP,
) -> DataFrame:
    """``id``, ``n_bytes``, ``spans`` (removed runs: low, high) and ``kept`` (the bytes left) of every row.

    A byte goes if a string of ``length`` bytes over it also starts anywhere else, in the same
    document or another; texts are compared as they came. Null text counts as empty; shorter
    texts stay whole; of repeated rows all copies go. An empty table gives no rows. What is
    left may end inside a character, so it is binary.
    """
    rows = docs.select(
        F.col(id_col).alias("id"),
        text_of(text_col).alias("text"),
        F.xxhash64(text_of(text_col)).alias("th"),
    )
    kind = rows.schema["id"].dataType.simpleString()
    spans = repeated_spans(rows, length, gram, max_group)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        for b in shards(batches, SHARD_BYTES, "z"):
            size, runs, kept = [], [], []
            for z, found in zip(b.column(1), b.column(2)):
                text = unzip.decompress(z.as_py())
                own: list[list[int]] = []
                for low, high in sorted((s["low"], s["high"]) for s in found.as_py() or []):
                    if own and low <= own[-1][1]:
                        own[-1][1] = max(own[-1][1], high)
                    else:
                        own.append([low, high])
                size.append(len(text))
                runs.append([{"low": x, "high": y} for x, y in own])
                edges = [0, *(e for r in own for e in r), len(text)]
                kept.append(b"".join(text[x:y] for x, y in zip(edges[::2], edges[1::2])))
            span = pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(size, pa.int64()), pa.array(runs, span), pa.array(kept, pa.binary())],
                names=["id", "n_bytes", "spans", "kept"],
            )

    on = (F.col("d.id").eqNullSafe(F.col("f.id"))) & (F.col("d.th") == F.col("f.th"))
    return (
        zipped(rows).alias("d")
        .join(spans.alias("f"), on, "left")
        .select("d.id", "d.z", "f.spans")
        .mapInArrow(cut, f"id {kind}, n_bytes long, spans array<struct<low: bigint, high: bigint>>, kept binary")
    )
