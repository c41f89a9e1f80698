import numpy as np
from pyspark.sql import functions as F

from shopgrain.llm.toxicity import drop_toxic, expressions, fold, log_ratios, score, train, words


def frames(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")


def test_held_out_accuracy(spark):
    docs, labels = frames(spark, "/root/testdata/sf0.1")
    # In these tables only English texts hold words that mark them as toxic.
    held = (fold("doc_id") % 3 == 1) & (F.col("lang") == "en")
    found = score(docs, train(docs, labels)).join(labels, "doc_id").where(held)
    rows = [(r.score, r.toxic) for r in found.select("score", "toxic").collect()]
    toxic = [s for s, t in rows if t]
    clean = [s for s, t in rows if not t]
    assert np.mean([s >= 0.7 for s in toxic]) > 0.2
    assert np.mean([s >= 0.7 for s in clean]) < 0.01
    assert np.mean([t > c for t in toxic for c in clean]) > 0.9


def test_labels_of_the_held_out_rows_are_not_read(spark, sf_dir):
    docs, labels = frames(spark, sf_dir)
    turned = labels.withColumn("toxic", (1 - labels.toxic).cast("int")).where(fold("doc_id") % 3 == 1)
    other = labels.where(fold("doc_id") % 3 != 1).union(turned)
    a, b = train(docs, labels), train(docs, other)
    assert (a.ratios == b.ratios).all() and (a.slope, a.offset) == (b.slope, b.offset)


def test_odd_rows(spark, odd, docs_of, sf_dir):
    docs, labels = frames(spark, sf_dir)
    model = train(docs, labels)
    got = score(odd, model, out="own").collect()
    assert len(got) == odd.count() and all(0 <= r.own <= 1 for r in got)
    assert [r.own for r in got if not r.text] == [model.score(b"")] * 2
    assert drop_toxic(odd, labels).schema == odd.schema
    none = drop_toxic(odd, labels.limit(0))
    assert none.count() == odd.count()
    assert drop_toxic(odd.limit(0), labels).count() == 0


def test_models_are_distributions():
    counts = np.zeros((2, 32**4), np.int64)
    for row, text in enumerate((b"the thing and the other", b"the idiot and the idiots")):
        np.add.at(counts[row], expressions(text), 1)
    ratios = log_ratios(counts)
    assert np.isfinite(ratios).all()
    assert ratios[expressions(b"idiot")].sum() > 0 > ratios[expressions(b"thing")].sum()


def test_words_are_counted_as_they_are(spark):
    docs, labels = frames(spark, "/root/testdata/sf0.1")
    model = train(docs, labels)
    held = (fold("doc_id") % 3 == 1) & (F.col("lang") == "en")
    rows = score(docs, model).join(labels, "doc_id").where(held).select("score", "toxic").collect()
    # Four folded symbols found 25 of the 82.
    assert sum(r.score >= 0.7 for r in rows if r.toxic) >= 70
    assert sum(r.score >= 0.7 for r in rows if not r.toxic) <= 3
    found = {r.word for r in model.words.where("ratio > 2000000").collect()}
    assert {"idiot", "worthless", "moron", "scum"} <= found


def test_words():
    assert words("An idiot, 2 Idiots!") == ["an", "idiot", "idiots"]
    assert words("日本語 x 人") == ["日本", "本語", "x", "人"]
    # In folded symbols these were the same.
    assert expressions("ñandú".encode()).tolist() != [] and words("ñandú") == ["ñandú"] != words("òandú")


def test_only_picked_rows_are_left_out_of_the_counts(spark, sf_dir):
    docs, labels = frames(spark, sf_dir)
    marked = labels.where(F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = docs.join(marked, "doc_id").withColumn("h", fold("doc_id")).where("h % 3 <> 1").orderBy("h", "doc_id")
    rows = rows.select("h", "toxic", "text").collect()
    picked = [r for r in rows if r.h // 3 % 5 == 0][:3]
    counts = np.zeros((2, 32**4), np.int64)
    for r in rows:
        if r not in picked:
            np.add.at(counts[1 if r.toxic else 0], expressions((r.text or "").encode()), 1)
    assert (train(docs, labels, calibration_rows=3).ratios == log_ratios(counts)).all()


def test_word_evidence_row_by_row(spark, odd, monkeypatch):
    """Every row's sum against the plain one, over slices of a few rows."""
    from shopgrain.llm import toxicity

    texts = [(i, t or "") for i, (_, t) in enumerate((r.doc_id, r.text) for r in odd.collect())]
    texts += [(100 + i, "a b b c " * (i % 4) + "naïve scum " * (i % 3)) for i in range(50)]
    rows = spark.createDataFrame(texts, "row long, text string").repartition(3)
    ratio = {"a": 5, "b": -7, "naïve": 11, "lorem": 1, "never": 99, "c": 0}
    table = spark.createDataFrame(list(ratio.items()), "word string, ratio long")
    want = {i: sum(ratio.get(w, 0) for w in words(t)) for i, t in texts}
    for size in (40, toxicity.SLICE_BYTES):
        monkeypatch.setattr(toxicity, "SLICE_BYTES", size)
        assert {r.row: r.said for r in toxicity.word_evidence(rows, table, "row").collect()} == want
    assert toxicity.word_evidence(rows, table.limit(0), "row").where("said <> 0").count() == 0


def test_word_ratios_back_off_to_shared_counts(spark):
    import math

    from shopgrain.llm.toxicity import WORD_UNIT, word_discount, word_ratios

    counts = [(0, "", 900), (1, "", 100), (1, "rude", 60), (0, "the", 810), (1, "the", 91), (0, "once", 1), (0, "kind", 90)]
    got = {r.word: r.ratio for r in word_ratios(spark.createDataFrame(counts, "toxic int, word string, n long")).collect()}
    assert got["the"] == got["once"] == 0 and set(got) == {"rude", "the", "once", "kind"}
    gap = 60 - 6 - word_discount(4) * math.sqrt(0.09 * 60)
    assert got["rude"] == round(math.log((6 + gap) / (54 - gap) * 9) / WORD_UNIT)
    assert got["kind"] < 0
