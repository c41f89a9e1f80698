"""Packing of tokenised documents into sequences of bounded length."""

from __future__ import annotations

import re
import sys
import zlib
from array import array
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopgrain.llm.common import shards, text_of
from shopgrain.session import materialize

CAPACITY = 4096
END_ID = 1
BATCH_BYTES = 8 << 20
#: Encodings that a worker remembers, in each of two generations.
MEMORY = 300_000

#: A word of letters that are composed already, then ASCII marks: the tokenizer always cuts between
#: the two, and neither half depends on the other.
WORD_AND_MARKS = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\\[-`{-~]*)")


class Encoder(dict):
    """Ids of a chunk without white space, as bytes of unsigned 32-bit little-endian numbers.

    The tokenizer treats white space as nothing but a cut, so a text's ids are its chunks' ids in
    a row. Chunks and words repeat, so each is encoded once and remembered; when a memory is full,
    it becomes the old generation, from which what is used again moves on.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        super().__init__()
        self.whole = Tokenizer.from_file(path)
        # A lower-case word or a run of marks is one unit: no need to normalise and cut it.
        self.unit = Tokenizer.from_file(path)
        self.unit.normalizer = None
        self.unit.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.merges = self.unit.model
        self.old_chunks: dict[str, bytes] = {}
        self.units: dict[str, bytes] = {}
        self.old_units: dict[str, bytes] = {}

    def encode_unit(self, text: str) -> bytes:
        found = self.units.get(text)
        if found is None:
            found = self.old_units.get(text)
            if found is None:
                if text.isascii():  # bytes stand for themselves: the merges can start at once
                    found = as_bytes([t.id for t in self.merges.tokenize(text)])
                else:
                    found = as_bytes(self.unit.encode(text, add_special_tokens=False).ids)
            if len(self.units) >= MEMORY:
                self.old_units, self.units = self.units, {}
            if len(text) <= 64:
                self.units[text] = found
        return found

    def __missing__(self, chunk: str) -> bytes:
        ids = self.old_chunks.get(chunk)
        if ids is None:
            m = WORD_AND_MARKS.fullmatch(chunk)
            if m:
                ids = self.encode_unit(m[1].lower()) + (self.encode_unit(m[2]) if m[2] else b"")
            else:
                ids = as_bytes(self.whole.encode(chunk, add_special_tokens=False).ids)
        if len(self) >= MEMORY:
            self.old_chunks = dict(self)
            self.clear()
        if len(chunk) <= 64:
            self[chunk] = ids
        return ids

    def ids(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


def as_bytes(ids: list[int]) -> bytes:
    found = array("I", ids)
    if sys.byteorder == "big":
        found.byteswap()
    return found.tobytes()


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def pieces(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY
) -> DataFrame:
    """Each document's ids and the end id, cut into pieces of at most ``capacity`` ids.

    ``part`` and ``nth`` number the pieces of each length within a task, so that a rank over all
    pieces needs only the counts per task.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    end = np.array([END_ID], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(tokenizer)
        part = TaskContext.get().partitionId()
        count = [0] * (capacity + 1)
        for b in shards(batches, BATCH_BYTES):
            owner, rows = [], []
            for at, text in enumerate(b.column(1)):
                ids = known.ids(text.as_py()) + end
                for i in range(0, len(ids), 4 * capacity):
                    piece = ids[i : i + 4 * capacity]
                    n = len(piece) // 4
                    owner.append(at)
                    rows.append((i // (4 * capacity), i // 4, n, zlib.crc32(piece), part, count[n]))
                    count[n] += 1
            cols = list(zip(*rows))
            kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(owner)), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                names=["id", "piece", "start", "length", "crc", "part", "nth"],
            )

    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(
        cut, f"id {kind}, piece int, start long, length int, crc long, part int, nth long"
    )


@dataclass
class Run:
    """``bins`` sequences from ``first`` on each take ``each`` pieces of ``length`` at ``offset``;
    they are the pieces of that length from rank ``rank`` on."""

    length: int
    rank: int
    first: int
    bins: int
    each: int
    offset: int


class Plan:
    """Packs a histogram of lengths; pieces of one length are alike, so it need not see them singly."""

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY):
        self.capacity = capacity
        self.left = {n: c for n, c in counts.items() if c > 0}
        self.sizes = sorted(self.left)
        self.used = dict.fromkeys(counts, 0)
        self.runs: list[Run] = []
        self.bins = 0
        self._reduce()
        self._best_fit()

    def _take(self, length: int, first: int, bins: int, each: int, offset: int) -> None:
        self.runs.append(Run(length, self.used[length], first, bins, each, offset))
        self.used[length] += bins * each
        self.left[length] -= bins * each
        if not self.left[length]:
            del self.left[length]
            self.sizes.pop(bisect_left(self.sizes, length))

    def _reduce(self) -> None:
        """Dominance: fix sets that hold the longest piece and no other set with it can beat.

        A set beats another if the other's pieces can be dealt into groups, each no longer than a
        piece of the first. With the longest piece and the room it leaves: if nothing fits, the
        piece goes alone; with one more piece at most, the longest that fits; a piece as long as
        the room beats any set; so does the longest fitting piece if no two fitting pieces
        together are longer than it; and, when at most two more fit, the longest two that fill
        the room, the first being the longest that fits. Each step fixes all copies at once.
        """
        for top in sorted(self.left, reverse=True):
            while top in self.left:
                room = self.capacity - top
                at = bisect_right(self.sizes, room) - 1
                if at < 0:
                    n = self.left[top]
                    self._open(n, (top,))
                    continue
                fit = self.sizes[at]
                mates = self._mates(top, fit, room)
                if mates is None:
                    break  # not decided by dominance: best fit packs it
                need: dict[int, int] = {}
                for x in (top, *mates):
                    need[x] = need.get(x, 0) + 1
                n = min(self.left[x] // k for x, k in need.items())
                if not n:  # the last piece of this length would pair with itself
                    break
                self._open(n, (top, *mates))

    def _mates(self, top: int, fit: int, room: int) -> tuple[int, ...] | None:
        if fit == room:
            return (fit,)
        smallest = self._smallest(3)
        if len(smallest) < 2 or smallest[0] + smallest[1] > room:
            return (fit,)
        pair = self._longest_pair(room)
        if pair is None or sum(pair) <= fit:
            return (fit,) if sum(smallest) > room or len(smallest) < 3 else None
        if (len(smallest) < 3 or sum(smallest) > room) and pair[0] == fit and sum(pair) == room:
            # Any other fitting pair must have its shorter piece no longer than ours.
            if all(y <= pair[1] for y in self.sizes[: bisect_right(self.sizes, room // 2)]):
                return pair
        return None

    def _smallest(self, k: int) -> list[int]:
        out: list[int] = []
        for s in self.sizes[:k]:
            out += [s] * min(self.left[s], k - len(out))
            if len(out) == k:
                break
        return out

    def _longest_pair(self, room: int) -> tuple[int, int] | None:
        """The pair with the largest sum that fits, longest first piece among equals."""
        best: tuple[int, int] | None = None
        low, high = 0, bisect_right(self.sizes, room) - 1
        while low <= high:
            a, b = self.sizes[high], self.sizes[low]
            if a + b > room:
                high -= 1
                continue
            if (a != b or self.left[a] > 1) and (best is None or a + b > sum(best)):
                best = (a, b)
            low += 1
        return best

    def _open(self, bins: int, lengths: tuple[int, ...]) -> None:
        offset = 0
        for length in lengths:
            self._take(length, self.bins, bins, 1, offset)
            offset += length
        self.bins += bins

    def _best_fit(self) -> None:
        """Longest first, each piece into the fullest sequence that has room for it.

        Sequences with equal room are alike and are filled together: a group of them takes as many
        pieces each as fit, which is what best fit does one by one.
        """
        rooms: dict[int, list[tuple[int, int]]] = {}  # room -> sequences from, how many
        order: list[int] = []

        def put(room: int, first: int, bins: int) -> None:
            if not bins:
                return
            if room not in rooms:
                rooms[room] = []
                insort(order, room)
            rooms[room].append((first, bins))

        for length in sorted(self.left, reverse=True):
            while length in self.left:
                at = bisect_left(order, length)
                if at == len(order):
                    each = self.capacity // length
                    first, bins = self.bins, -(-self.left[length] // each)
                    room = self.capacity
                    self.bins += bins
                else:
                    room = order[at]
                    first, bins = rooms[room].pop()
                    if not rooms[room]:
                        del rooms[room]
                        order.pop(at)
                each = room // length
                n = self.left[length]
                full = min(bins, n // each)
                if full:
                    self._take(length, first, full, each, self.capacity - room)
                    put(room - each * length, first, full)
                rest = 0
                if full < bins and n % each and full == n // each:
                    rest = n % each
                    self._take(length, first + full, 1, rest, self.capacity - room)
                    put(room - rest * length, first + full, 1)
                put(room, first + full + (rest > 0), bins - full - (rest > 0))


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
) -> DataFrame:
    """Pieces with their sequence: ``id``, ``piece``, ``start``, ``length``, ``ids_crc32``,
    ``sequence_id``, ``offset``.

    Null and empty texts are one piece of the end id alone. Repeated rows and ids are packed each.
    An empty table gives no rows. The driver sees one count per length (``capacity`` at most).
    """
    spark = docs.sparkSession
    cut = materialize(pieces(docs, tokenizer, id_col, text_col, capacity), "pieces")
    per_task = materialize(
        cut.groupBy("part", "length").agg((F.max("nth") + 1).alias("n")), "lengths"
    )
    histogram = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = sorted(Plan(histogram, capacity).runs, key=lambda r: (r.length, r.rank))
    fields = ("length", "rank", "first", "bins", "each", "offset")
    plan = spark.sparkContext.broadcast(np.array([[getattr(r, f) for f in fields] for r in runs], np.int64).reshape(-1, 6))
    before = F.sum("n").over(
        Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    )
    ranked = cut.join(
        per_task.select("part", "length", F.coalesce(before, F.lit(0)).alias("before")), ["part", "length"]
    ).select("id", "piece", "start", "length", "crc", (F.col("before") + F.col("nth")).alias("rank"))
    kind = ranked.schema["id"].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = plan.value
        wide = 1 << 44  # ranks stay below it
        keys = table[:, 0] * wide + table[:, 1]
        for b in batches:
            length = b.column(3).to_numpy().astype(np.int64)
            rank = b.column(5).to_numpy()
            run = table[np.searchsorted(keys, length * wide + rank, "right") - 1]
            nth = rank - run[:, 1]
            yield pa.RecordBatch.from_arrays(
                [
                    *b.columns[:3],
                    pa.array(length),
                    b.column(4),
                    pa.array(run[:, 2] + nth // run[:, 4]),
                    pa.array(run[:, 5] + nth % run[:, 4] * length),
                ],
                names=["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return ranked.mapInArrow(
        place,
        f"id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )
