import corpus_pipeline
import public_tokenizers
from test_decontam import brute as windows
from test_packing import check
from test_simhash import classes, near, plain

from shopgrain.llm.toxicity import score, train


def test_against_brute_force(spark, sf_dir):
    """All five stages, each told again row by row on what the one before it kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scores = score(docs, train(docs, labels)).collect()
    rows = {r.doc_id: r.text for r in scores if r.score < 0.7}
    last = {t or "": max(i for i, u in rows.items() if (u or "") == (t or "")) for t in rows.values()}
    rows = {i: t for i, t in rows.items() if last[t or ""] == i}
    ids = sorted(rows)
    root = classes([plain(rows[i]) for i in ids], near)
    rows = {i: rows[i] for k, i in enumerate(ids) if root[k] == k}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    rows = {i: t for i, t in rows.items() if not windows(t, items)[1]}
    got = corpus_pipeline.run(spark, sf_dir)
    used, least = check(list(rows.items()), got.withColumnRenamed("doc_id", "id").collect(), 4096)
    assert used <= least + 1
    assert 0 < len(rows) < len(scores)
    assert public_tokenizers.path("word_bpe_49k.json")


def test_stages_keep_the_columns(spark, odd, sf_dir):
    docs = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.schema == odd.schema, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() > 0
    empty = odd.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf_dir).count() == 0


def test_registration():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {"pipeline", *(n for n in names if n.startswith("op"))} <= names
    assert sum(n.startswith("op") and n[2].isdigit() for n in names) == 10
    assert set(entry.oracle_sql()) <= names
