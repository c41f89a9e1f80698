"""Toxicity by class-conditional Kneser-Ney character models with a shared backoff.

Whole words, kept as they are, have counts of their own in a Spark table that grows with the corpus
and is joined with the texts; words it does not tell apart are left to the models of folded characters.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopgrain.llm.common import shards, text_of
from shopgrain.session import materialize

SYMBOLS = 32
ORDER = 4
DISCOUNT = 0.75
#: Long texts dilute a few rude words, short ones vary by chance: log-likelihoods are divided by
#: (length + LENGTH_PRIOR) ** LENGTH_POWER.
LENGTH_PRIOR, LENGTH_POWER = 200, 0.8
#: Rows on which the two calibration numbers are fitted, at most, unless told otherwise.
CALIBRATION_ROWS = 20_000
THRESHOLD = 0.7
#: Bytes of text that a worker looks at together.
SLICE_BYTES = 2 << 20
#: Longer runs of letters are several words.
WORD = re.compile(r"[^\W\d_]{1,64}")
#: Scripts without blanks between words: every two neighbouring letters count as a word.
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\U00020000-\U0003ffff]")
#: Log ratios of words are summed as whole numbers of this size, whatever the order of tasks.
WORD_UNIT = 1e-6#: Bits of the filter that keeps words without a ratio out of the join; others that pass do no harm.
FILTER_BITS = 1 << 24


def _symbols() -> np.ndarray:
    """Symbol of each UTF-8 byte: 0 other, 1-26 letters, 27 digits, 28-31 letters beyond ASCII."""
    table = np.zeros(256, np.uint8)
    for i in range(26):
        table[ord("a") + i] = table[ord("A") + i] = i + 1
    table[ord("0") : ord("9") + 1] = 27
    table[0x80:0xC0] = 28 + np.arange(0x40) % 4
    return table


SYMBOL = _symbols()


def expressions(text: bytes, order: int = ORDER) -> np.ndarray:
    """One number for each run of ``order`` symbols; runs of other characters count as one."""
    raw = np.frombuffer(text, np.uint8)
    s = SYMBOL[raw[raw < 0xC0]]  # lead bytes say little and would use up context
    s = s[np.concatenate([[True], (s[1:] > 0) | (s[:-1] > 0)])] if len(s) else s
    s = np.concatenate([np.zeros(order - 1, np.uint8), s, [0]]).astype(np.int64)
    n = len(s) - order + 1
    keys = np.zeros(n, np.int64)
    for i in range(order):
        keys = keys * SYMBOLS + s[i : i + n]
    return keys


def words(text: str) -> list[str]:
    """The words of a text in lower case, nothing folded."""
    found = WORD.findall(text.lower())
    if text.isascii() or not UNSPACED.search(text):
        return found
    return [
        part
        for w in found
        for part in ([w[i : i + 2] for i in range(max(1, len(w) - 1))] if UNSPACED.search(w) else [w])
    ]


def word_discount(different: int) -> float:
    """Standard deviations that chance alone lets one of so many words exceed."""
    return NormalDist().inv_cdf(1 - 0.5 / max(different, 1))


def word_ratios(counted: DataFrame) -> DataFrame:
    """``word``, ``ratio`` of every word: log P(word | toxic) / P(word | ordinary), in WORD_UNIT.

    ``counted``: ``toxic``, ``word``, ``n`` rows that hold the word; the empty word stands for all rows.
    Each class's count backs off to what the counts shared by both classes let expect for it: a discount is
    taken off the difference and given back to the shared count. A word with nothing left is as likely in both, ratio 0.
    The discount follows from the number of different words: what chance alone would reach among so many.
    """
    total = {r.toxic: r.n for r in counted.where("word = ''").select("toxic", "n").collect()}
    p = total[1] / (total[0] + total[1])
    known = counted.where("word <> ''")
    discount = word_discount(known.agg(F.count_distinct("word")).first()[0])
    m, t = F.col("m"), F.col("t")
    gap = t - p * m
    left = F.greatest(F.abs(gap) - discount * F.sqrt(p * (1 - p) * m), F.lit(0.0))
    moved = p * m + F.signum(gap) * left
    ratio = F.log(moved / (m - moved) * ((1 - p) / p))
    return (
        known.groupBy("word")
        .agg(F.sum("n").alias("m"), F.sum(F.col("n") * F.col("toxic")).alias("t"))
        .select("word", F.when(left > 0, F.round(ratio / WORD_UNIT)).otherwise(0).cast("long").alias("ratio"))
    )


def _bit(word: str) -> int:
    return zlib.crc32(word.encode()) % FILTER_BITS


def _index(batches: Iterator[pa.RecordBatch], passing: bytes) -> Iterator[pa.RecordBatch]:
    """Per slice of 2 MB, its different words that pass by place, and which places each row holds how often."""
    for b in shards(batches, SLICE_BYTES):
        rows = b.column(0).to_numpy()
        seen: dict[str, int] = {}  # place of a word, -1 for one that doesn't pass
        place: list[str] = []
        at, times, sizes = [], [], []
        for text in b.column(1).to_pylist():
            size = len(at)
            for word, n in Counter(words(text)).items():
                if word not in seen:
                    bit = _bit(word)
                    passes = passing[bit >> 3] >> (bit & 7) & 1
                    seen[word] = len(place) if passes else -1
                    if passes:
                        place.append(word)
                if seen[word] >= 0:
                    at.append(seen[word])
                    times.append(n)
            sizes.append(len(at) - size)
        blobs = [rows.astype("<i8"), np.array(sizes, "<i4"), np.array(at, "<i4"), np.array(times, "<i4")]
        n = len(place)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n + 1, rows[0], np.int64)),
                pa.array([*range(n), None], pa.int32()),
                pa.array([*place, None], pa.string()),
                *(pa.array([None] * n + [x.tobytes()], pa.binary()) for x in blobs),
            ],
            names=["slice", "place", "word", "rows", "sizes", "at", "times"],
        )


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of ratio times occurrences of each row of a slice."""
    for b in batches:
        for said, *blobs in zip(*(b.column(c) for c in ("said", "rows", "sizes", "at", "times"))):
            rows, sizes, at, times = (np.frombuffer(x.as_py(), t) for x, t in zip(blobs, ("<i8", "<i4", "<i4", "<i4")))
            ratio = np.zeros(int(at.max(initial=-1)) + 1, np.int64)
            if said.is_valid:
                found = said.values
                ratio[found.field("place").to_numpy()] = found.field("ratio").to_numpy()
            upto = np.concatenate([[0], np.cumsum(ratio[at] * times)])
            ends = np.cumsum(sizes)
            total = upto[ends] - upto[ends - sizes]
            yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(total)], names=["row", "said"])


def word_evidence(rows: DataFrame, ratios: DataFrame, row: str) -> DataFrame:
    """``row``, ``said``: sum of the ratios of all words of a text, occurrences counted.

    ``rows``: the number ``row`` and ``text``. A slice of 2 MB tells each of its words once, to be joined with the
    ratios, and adds up its rows by itself: no row per word and text, and a word has at most one row
    a slice. Words of ratio 0 add nothing and are kept out by a filter of fixed size.
    """
    ratios = ratios.where("ratio <> 0")
    bits = np.zeros(FILTER_BITS, np.uint8)
    places = ratios.select((F.crc32(F.col("word").cast("binary")) % FILTER_BITS).alias("bit")).distinct().toArrow()
    bits[places["bit"].to_numpy()] = 1
    held = rows.sparkSession.sparkContext.broadcast(np.packbits(bits, bitorder="little").tobytes())
    indexed = materialize(
        rows.select(F.col(row).alias("row"), "text").mapInArrow(
            lambda batches: _index(batches, held.value),
            "slice long, place int, word string, rows binary, sizes binary, at binary, times binary",
        ),
        "slices",
    )
    said = (
        indexed.where("word IS NOT NULL")
        .select("slice", "place", "word")
        .join(ratios, "word")
        .groupBy("slice")
        .agg(F.collect_list(F.struct("place", "ratio")).alias("said"))
    )
    slices = indexed.where("word IS NULL").drop("place", "word")
    return (
        slices.join(said, "slice", "left")
        .select("said", "rows", "sizes", "at", "times")
        .mapInArrow(_add_up, "row long, said long")
        .withColumnRenamed("row", row)
    )


def log_ratios(counts: np.ndarray, order: int = ORDER, discount: float = DISCOUNT) -> np.ndarray:
    """log P(symbol | context, toxic) - log P(symbol | context, ordinary) for each expression.

    ``counts``: a row for ordinary, a row for toxic texts. Both classes back off to the same
    model, estimated from the number of different left contexts over both.
    """
    shape = (SYMBOLS,) * order
    seen = (counts.sum(axis=0) > 0).reshape(shape)
    back = np.full(SYMBOLS, 1 / SYMBOLS)
    # In how many left contexts each shorter expression occurs, shortest first.
    left = [seen.sum(axis=tuple(range(order - m))) for m in range(1, order)]
    for c in left:
        back = _kneser_ney(c.astype(np.float64), back, discount)
    ordinary, toxic = (_kneser_ney(c.reshape(shape).astype(np.float32), back, discount) for c in counts)
    return (np.log(toxic) - np.log(ordinary)).astype(np.float32).ravel()


def _kneser_ney(c: np.ndarray, back: np.ndarray, discount: float) -> np.ndarray:
    total = c.sum(axis=-1, keepdims=True)
    kinds = (c > 0).sum(axis=-1, keepdims=True)
    p = (np.maximum(c - discount, 0) + discount * kinds * back) / np.maximum(total, 1)
    return np.where(total > 0, p, back)


def fold(id_col: str) -> Column:
    """crc32 of the id as text; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary"))


def fit_logistic(x: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[np.ndarray, float]:
    """Slopes (one for each column) and offset by Newton's method with a slight penalty on the slopes."""
    if len(x) == 0 or y.min() == y.max():
        return np.zeros(x.shape[1]), -20.0
    mid, wide = x.mean(axis=0), x.std(axis=0)
    wide[wide == 0] = 1.0
    design = np.column_stack([(x - mid) / wide, np.ones(len(x))])
    penalty = np.array([0.1] * x.shape[1] + [0])
    w = np.zeros(len(penalty))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        curve = design.T @ (design * (p * (1 - p))[:, None]) + np.diag(np.maximum(penalty, 1e-6))
        w -= np.linalg.solve(curve, design.T @ (p - y) + penalty * w)
    return w[:-1] / wide, float(w[-1] - (w[:-1] * mid / wide).sum())


class Model:
    """The two class models as one table of log ratios, the table of words, and the calibration."""

    def __init__(
        self,
        ratios: np.ndarray,
        slope: float = 1.0,
        offset: float = 0.0,
        words: DataFrame | None = None,
        weight: float = 0.0,
    ):
        self.ratios, self.slope, self.offset, self.words, self.weight = ratios, slope, offset, words, weight

    def evidence(self, text: bytes) -> float:
        keys = expressions(text)
        return float(self.ratios[keys].sum(dtype=np.float64) / (len(keys) + LENGTH_PRIOR) ** LENGTH_POWER)

    def score(self, text: bytes, said: float = 0.0) -> float:
        """``said``: sum of the ratios of the text's words, in WORD_UNIT."""
        x = self.slope * self.evidence(text) + self.weight * word_part(text, said) + self.offset
        return float(1 / (1 + np.exp(-np.clip(x, -500, 500))))


def word_part(text: bytes, said: float) -> float:
    return said * WORD_UNIT / (len(text) + LENGTH_PRIOR) ** LENGTH_POWER


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    label_col: str = "toxic",
    calibration_rows: int = CALIBRATION_ROWS,
) -> Model:
    """Count expressions of all rows that may be learned from but those picked for calibration.

    Rows with crc32(id) mod 3 = 1 are never learned from. The counts come from every other labelled
    row that is not picked. Runs of folded characters fit in SYMBOLS ** ORDER cells a class whatever the corpus, which
    bounds what the driver gets and what is broadcast. Words stay in a Spark table that grows with the
    corpus. The logistic curve from both kinds of evidence to the score, three numbers, is fitted on at
    most ``calibration_rows`` rows, of a fifth of the ids those with the least hashes. Labels that repeat an id count as toxic
    if any does. With no toxic or no ordinary rows to learn from, all scores are 0.
    """
    spark = docs.sparkSession
    may = (F.col("__fold") % 3 != 1) & F.col("__id").isNotNull()
    marks = (
        labels.where(F.col(label_col).isNotNull())
        .groupBy(F.col(id_col).alias("__id"))
        .agg(F.max(F.col(label_col).cast("int")).alias("toxic"))
        .withColumn("__fold", fold("__id"))
        .where(may)
    )
    rows = (
        docs.select(F.col(id_col).alias("__id"), text_of().alias("text"))
        .where((fold("__id") % 3 != 1) & F.col("__id").isNotNull())
        .join(marks.hint("merge"), "__id")  # the labels grow with the documents
    )
    calibrates = F.floor(F.col("__fold") / 3) % 5 == 0
    # At most calibration_rows ids, small enough to broadcast: their texts need not move.
    picked = marks.where(calibrates).orderBy("__fold", "__id").limit(calibration_rows)
    cells = SYMBOLS**ORDER

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, cells), np.int64)
        names = ["toxic", "key", "word", "n"]
        for b in shards(batches, SLICE_BYTES):
            said: dict[int, Counter] = defaultdict(Counter)
            for label, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                toxic = 1 if label else 0
                keys, n = np.unique(expressions(text.encode()), return_counts=True)
                counts[toxic, keys] += n
                said[toxic].update({"", *words(text)})
            for toxic, found in said.items():
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(found), toxic, np.int32)),
                        pa.nulls(len(found), pa.int32()),
                        pa.array(list(found), pa.string()),
                        pa.array(list(found.values()), pa.int64()),
                    ],
                    names=names,
                )
        for toxic in (0, 1):
            keys = np.flatnonzero(counts[toxic])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(keys), toxic, np.int32)),
                    pa.array(keys.astype(np.int32)),
                    pa.nulls(len(keys), pa.string()),
                    pa.array(counts[toxic, keys]),
                ],
                names=names,
            )

    counted = materialize(
        rows.join(F.broadcast(picked.select("__id")), "__id", "left_anti")
        .select("toxic", "text")
        .mapInArrow(count, "toxic int, key int, word string, n long")
        .groupBy("toxic", "key", "word")
        .agg(F.sum("n").alias("n")),
        "expressions",
    )
    found = counted.where("word IS NULL").select("toxic", "key", "n").toArrow()
    counts = np.zeros((2, cells), np.int64)
    counts[found["toxic"].to_numpy(), found["key"].to_numpy()] = found["n"].to_numpy()
    if not counts.any(axis=1).all():
        return Model(np.zeros(cells, np.float32), 0.0, -1000.0)
    model = Model(log_ratios(counts), words=materialize(word_ratios(counted.where("key IS NULL")), "word_ratios"))
    held = spark.sparkContext.broadcast(model.ratios)

    def evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Model(held.value)
        for b in shards(batches, SLICE_BYTES):
            texts = [t.as_py() for t in b.column(2).cast(pa.large_binary())]
            found = ([known.evidence(t) for t in texts], [word_part(t, 1) for t in texts])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), *(pa.array(x, pa.float64()) for x in found)],
                names=["row", "toxic", "x", "unit"],
            )

    texts = numbered(docs.select(F.col(id_col).alias("__id"), text_of().alias("text")), "row").join(
        F.broadcast(picked), "__id"
    )
    sample = (
        texts.select("row", "toxic", "text")
        .mapInArrow(evidence, "row long, toxic int, x double, unit double")
        .join(word_evidence(texts.select("row", "text"), model.words, "row"), "row", "left")
        .select("toxic", "x", (F.col("unit") * F.coalesce("said", F.lit(0))).alias("said"))
        .toArrow()
    )
    y, x, said = (sample[c].to_numpy().astype(np.float64) for c in ("toxic", "x", "said"))
    order = np.lexsort((y, x, said))  # sums don't depend on the order of tasks
    slopes, offset = fit_logistic(np.column_stack([x, said])[order], (y[order] > 0).astype(np.float64))
    return Model(model.ratios, float(slopes[0]), offset, model.words, float(slopes[1]))


def numbered(docs: DataFrame, row: str) -> DataFrame:
    """A number for each row by input split and place there; the same whenever the same files are read."""
    return docs.withColumn(row, F.monotonically_increasing_id())


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """The documents with a score from 0 to 1 appended. Null text counts as empty and gets a score, too.

    Runs of more than 64 letters count as several words. A column of the name ``out`` is an error.

    The documents are read twice, for their words and for the rest, and must come in the same splits
    and order both times, as tables do.
    """
    if out in docs.columns:
        raise ValueError(f"there is a column {out!r} already")
    table = docs.sparkSession.sparkContext.broadcast(model.ratios)
    slope, offset = model.slope, model.offset
    place = docs.columns.index(text_col)
    row, x, unit = "__row", "__x", "__unit"

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Model(table.value, slope, offset)
        for b in shards(batches, SLICE_BYTES, text_col):
            texts = [t.as_py() or b"" for t in b.column(place).cast(pa.large_binary())]
            found = ([known.slope * known.evidence(t) + known.offset for t in texts], [word_part(t, 1) for t in texts])
            yield pa.RecordBatch.from_arrays(
                [*b.columns, *(pa.array(v, pa.float64()) for v in found)], names=[*b.schema.names, x, unit]
            )

    rows = numbered(docs, row)
    kinds = [T.StructField(n, T.DoubleType()) for n in (x, unit)]
    scored = rows.mapInArrow(scores, T.StructType([*rows.schema.fields, *kinds]))
    if model.words is None:
        total = F.col(x)
    else:
        texts = rows.select(row, text_of(text_col).alias("text"))
        scored = scored.join(word_evidence(texts, model.words, row).withColumnRenamed("said", "__said"), row, "left")
        total = F.col(x) + model.weight * F.col(unit) * F.coalesce("__said", F.lit(0))
    capped = F.greatest(F.least(total, F.lit(500.0)), F.lit(-500.0))
    return scored.select(*(F.col(f"`{c}`") for c in docs.columns), (1 / (1 + F.exp(-capped))).alias(out))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below the threshold, whole, with their own columns."""
    out = "score"
    while out in docs.columns:
        out = f"_{out}"
    return score(docs, train(docs, labels), out=out).where(F.col(out) < threshold).select(*docs.columns)
