"""Benchmark decontamination by suffix arrays over shards of the training texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopgrain.llm.common import flat, shards, text_of

WINDOW = 10
#: Words by which suffixes are ordered; longer matches are extended word by word.
DEPTH = 16
SHARD_BYTES = 2 << 20
#: Benchmark texts broadcast and searched at a time.
BLOCK_BYTES = 8 << 20

#: Lower-cased byte, or 0 outside words.
WORD_BYTE = np.zeros(256, np.uint8)
for _c in [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]:
    WORD_BYTE[_c] = _c
WORD_BYTE[0x41:0x5B] = np.arange(0x61, 0x7B)

BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2 ** 64
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    p = np.full(n + 1, base, np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


class Words:
    """The words of a run of texts: a 64-bit hash each, where they are, and each text's first word."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        self.low = WORD_BYTE[raw]
        inside = self.low > 0
        edge = np.zeros(len(raw) + 1, bool)  # a text's end also ends its last word
        edge[offsets] = True
        before = np.concatenate([[False], inside])[:-1] & ~edge[:-1]
        after = np.concatenate([inside, [False]])[1:] & ~edge[1:]
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        # Polynomial hash of each word from running sums of byte * BASE ** place, scaled back to
        # place 0, so that equal words agree wherever they stand.
        weighted = self.low * _powers(BASE, len(raw))[:-1]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(weighted, dtype=np.uint64)])
        self.hash = (sums[self.end] - sums[self.start]) * _powers(INVERSE, len(raw))[self.start]
        self.first = np.searchsorted(self.start, offsets)

    def bytes_of(self, i: int, n: int) -> bytes:
        return b" ".join(bytes(self.low[s:e]) for s, e in zip(self.start[i : i + n], self.end[i : i + n]))


def suffix_array(ranks: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Places in the order of the words that follow, by prefix doubling up to ``depth`` words."""
    n, k = len(ranks), 1
    rank = ranks.astype(np.int64)
    order = np.argsort(rank, kind="stable")
    while k < depth:
        later = np.zeros(n, np.int64)
        later[: n - k] = rank[k:] + 1 if k < n else 0
        tied = np.zeros(n, bool)
        sorted_rank = rank[order]
        equal = sorted_rank[1:] == sorted_rank[:-1]
        tied[1:] |= equal
        tied[:-1] |= equal
        spots = np.flatnonzero(tied)  # suffixes that differ already keep their places
        if not len(spots):
            break
        some = order[spots]
        some = some[np.argsort(rank[some] * (n + 2) + later[some], kind="stable")]
        order[spots] = some
        fresh = np.empty(n, np.int64)
        pair_rank, pair_later = rank[order], later[order]
        new = np.concatenate([[0], (pair_rank[1:] != pair_rank[:-1]) | (pair_later[1:] != pair_later[:-1])])
        # A group's rank is its first place: ranks of settled suffixes don't move.
        fresh[order] = np.maximum.accumulate(np.where(new > 0, np.arange(n), 0))
        rank, k = fresh, 2 * k
    return order


class Shard:
    """Suffix array over the words of some documents; -1 stands after each document."""

    def __init__(self, words: Words, depth: int = DEPTH):
        self.words = words
        n_docs = len(words.first) - 1
        vocabulary, codes = np.unique(words.hash, return_inverse=True)
        self.vocabulary = vocabulary
        # Place of each word in a sequence with an end mark (0) after each document.
        doc = np.searchsorted(words.first[1:], np.arange(len(codes)), "right")
        self.place = np.arange(len(codes)) + doc
        self.text = np.zeros(len(codes) + n_docs, np.int64)
        self.text[self.place] = codes + 1
        self.word_at = np.full(len(self.text), -1, np.int64)
        self.word_at[self.place] = np.arange(len(codes))
        order = suffix_array(self.text, depth)
        self.order = order[self.text[order] > 0]

    def find(self, query: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row of ``query`` (codes, its first ``n`` words count), the interval of suffixes
        that start with it, by binary search."""
        bounds = []
        for upper in (False, True):
            low = np.zeros(len(query), np.int64)
            high = np.full(len(query), len(self.order), np.int64)
            while (live := low < high).any():
                mid = (low + high) // 2
                suffix = self.order[np.minimum(mid, len(self.order) - 1)]
                sign = self._compare(suffix, query, n)
                right = (sign <= 0 if upper else sign < 0) & live
                low = np.where(right, mid + 1, low)
                high = np.where(live & ~right, mid, high)
            bounds.append(low)
        return bounds[0], bounds[1]

    def _compare(self, suffix: np.ndarray, query: np.ndarray, n: np.ndarray) -> np.ndarray:
        at = np.minimum(suffix[:, None] + np.arange(query.shape[1]), len(self.text) - 1)
        differ = np.sign(self.text[at] - query)
        differ[np.arange(query.shape[1]) >= n[:, None]] = 0
        first = (differ != 0).argmax(axis=1)
        return differ[np.arange(len(query)), first]

    def common(self, place: np.ndarray, rest: list[np.ndarray]) -> list[int]:
        """Words that the suffix at each place shares with a sequence of codes."""
        found = []
        for p, codes in zip(place, rest):
            own = self.text[p : p + len(codes)]
            same = own == codes[: len(own)]
            found.append(len(same) if same.all() else int(same.argmin()))
        return found


class Benchmark:
    """A block of benchmark items as hash sequences; every window of words is a test suffix's head."""

    def __init__(self, ids: list, texts: list[bytes], window: int = WINDOW):
        self.ids, self.window = ids, window
        self.raw = np.frombuffer(b"".join(texts), np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        self.words = Words(self.raw, self.offsets)
        first = self.words.first
        item, start, size = [], [], []
        for i in range(len(ids)):
            n = int(first[i + 1] - first[i])
            w = min(n, window)
            for j in range(n - w + 1 if n else 0):
                item.append(i)
                start.append(int(first[i]) + j)
                size.append(w)
        self.item, self.start, self.size = (np.array(x, np.int64) for x in (item, start, size))

    def search(self, shard: Shard) -> Iterator[tuple[int, int, int, int]]:
        """Item, first word in the shard, words in the window, longest verbatim match from there."""
        codes = np.searchsorted(shard.vocabulary, self.words.hash)
        codes = np.minimum(codes, max(len(shard.vocabulary) - 1, 0))
        known = shard.vocabulary[codes] == self.words.hash if len(shard.vocabulary) else np.zeros(len(codes), bool)
        codes = np.where(known, codes + 1, -1)
        if not len(self.start) or not len(shard.order):
            return
        query = codes[np.minimum(self.start[:, None] + np.arange(self.window), len(codes) - 1)]
        inside = np.arange(self.window) < self.size[:, None]
        able = ((query > 0) | ~inside).all(axis=1)  # a window with a word the shard lacks can't occur
        row = np.flatnonzero(able)
        low, high = shard.find(query[row], self.size[row])
        for r, lo, hi in zip(row[high > low], low[high > low], high[high > low]):
            i, s, n = int(self.item[r]), int(self.start[r]), int(self.size[r])
            wanted = self.words.bytes_of(s, n)
            places = shard.order[lo:hi]
            rest = codes[s : int(self.words.first[i + 1])]
            lengths = shard.common(places, [rest] * len(places))
            for p, longest in zip(places, lengths):
                w = int(shard.word_at[p])
                if shard.words.bytes_of(w, n) == wanted:  # equal hashes are confirmed on the text
                    yield i, w, n, longest


RESULT = (
    "n_words: bigint, n_hit: bigint, longest: bigint, items: array<string>, "
    "hits: array<struct<item: string, word: bigint, words: bigint>>"
)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """The documents with the struct ``__found`` appended, one for each block of the benchmark.

    ``n_words``, ``n_hit`` (words inside an occurrence of a window of ``window`` words of an item,
    or of the whole item if it is shorter), ``longest`` (words of the longest verbatim match from
    a hit window on), ``items`` and ``hits`` (item, first word, words matched). Null and empty
    texts have no words and are never hit; items without words are never found; repeated items
    count once per id; a null item id is reported as an empty string.

    The benchmark is dealt out in blocks of bounded size, one search of each shard per block.
    """
    items = benchmark.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("id"), text_of(item_text).alias("text")
    )
    sent, ids, texts, held = [], [], [], 0
    context = docs.sparkSession.sparkContext
    for r in items.toLocalIterator():
        text = r["text"].encode()
        if held + len(text) > BLOCK_BYTES and ids:
            sent.append(context.broadcast((ids, texts)))
            ids, texts, held = [], [], 0
        ids.append(r["id"])
        texts.append(text)
        held += len(text)
    sent.append(context.broadcast((ids, texts)))
    place = docs.columns.index(text_col)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only = Benchmark(*sent[0].value, window) if len(sent) == 1 else None
        for b in shards(batches, SHARD_BYTES, text_col):
            texts = b.column(place).cast(pa.large_binary()).fill_null(b"")
            words = Words(*flat(texts))
            shard = Shard(words, max(DEPTH, window))
            per = [{"items": set(), "hits": {}} for _ in range(b.num_rows)]
            hit = np.zeros(len(words.start) + 1, np.int64)
            for block in sent:
                test = only or Benchmark(*block.value, window)
                for i, w, n, longest in test.search(shard):
                    d = int(np.searchsorted(words.first, w, "right")) - 1
                    per[d]["items"].add(test.ids[i])
                    key = (test.ids[i], w - int(words.first[d]))
                    per[d]["hits"][key] = max(per[d]["hits"].get(key, 0), longest)
                    hit[w] += 1
                    hit[w + n] -= 1
            covered = np.concatenate([[0], np.cumsum(np.cumsum(hit[:-1]) > 0)])
            found = [
                {
                    "n_words": int(words.first[d + 1] - words.first[d]),
                    "n_hit": int(covered[words.first[d + 1]] - covered[words.first[d]]),
                    "longest": max(x["hits"].values(), default=0),
                    "items": sorted(x["items"]),
                    "hits": [
                        {"item": i, "word": w, "words": n} for (i, w), n in sorted(x["hits"].items())
                    ],
                }
                for d, x in enumerate(per)
            ]
            kind = pa.struct(
                [
                    ("n_words", pa.int64()),
                    ("n_hit", pa.int64()),
                    ("longest", pa.int64()),
                    ("items", pa.list_(pa.string())),
                    ("hits", pa.list_(pa.struct([("item", pa.string()), ("word", pa.int64()), ("words", pa.int64())]))),
                ]
            )
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(found, kind)], names=[*b.schema.names, "__found"]
            )

    kind = T.StructType([*docs.schema.fields, *T.StructType.fromDDL(f"__found struct<{RESULT}>").fields])
    return docs.mapInArrow(look, kind)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no benchmark window occurs, with their own columns, whatever their names."""
    names = {c: f"__d{i}" for i, c in enumerate(docs.columns)}
    found = contamination(docs.withColumnsRenamed(names), benchmark, names["text"])
    return found.where("__found.n_hit = 0").select(*(F.col(n).alias(c) for c, n in names.items()))
