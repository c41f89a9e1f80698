import random
import re

import numpy as np
import pytest

from shopgrain.llm import decontam
from shopgrain.llm.decontam import contamination, drop_contaminated, suffix_array

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items):
    w = words(text)
    hit, found = set(), set()
    for item, t in items:
        q = words(t)
        n = min(len(q), 10)
        for j in range(len(q) - n + 1 if q else 0):
            for i in range(len(w) - n + 1):
                if w[i] == q[j] and w[i : i + n] == q[j : j + n]:
                    hit.update(range(i, i + n))
                    found.add(str(item))
    return len(w), len(hit), sorted(found)


def items_frame(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def compare(docs, spark, items):
    got = contamination(docs, items_frame(spark, items)).collect()
    for r in got:
        f = r["__found"]
        assert (f.n_words, f.n_hit, f["items"]) == brute(r.text, items), r.doc_id


def test_on_documents(spark, sf_dir, docs_of, documents):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    items += [(900, "of THE"), (901, None), (902, "..."), (903, "of THE"), (904, documents[5][1][:400])]
    compare(docs_of(documents), spark, items)


def test_small_shards_and_blocks(spark, docs_of, documents, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 300)
    items = [(i, (documents[i][1] or "")[40:240]) for i in range(0, 40, 4)]
    compare(docs_of(documents[:60]), spark, items)


def test_odd_rows(spark, odd, docs_of):
    items = [(1, "A b"), (2, "lorem ipsum dolor sit amet lorem ipsum dolor sit amet lorem ipsum"), (3, "naïve")]
    small = docs_of([(r.doc_id, r.text[:3000] if r.text else r.text) for r in odd.collect()])
    compare(small, spark, items)
    kept = drop_contaminated(odd, items_frame(spark, items))
    assert kept.schema == odd.schema
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 1, 2, 3, 9]
    assert drop_contaminated(odd, items_frame(spark, []).limit(0)).count() == odd.count()
    assert drop_contaminated(odd.limit(0), items_frame(spark, items)).count() == 0


def test_longest_match(spark, docs_of):
    long = " ".join(f"w{i}" for i in range(60))
    docs = docs_of([(1, f"head {' '.join(f'w{i}' for i in range(5, 45))} tail")])
    found = contamination(docs, items_frame(spark, [(1, long)])).first()["__found"]
    assert (found.longest, found.n_hit) == (40, 40)
    assert min(h.word for h in found.hits) == 1


@pytest.mark.parametrize("seed", range(3))
def test_suffix_array(seed):
    text = np.array(random.Random(seed).choices([0, 1, 2, 3], [1, 3, 3, 1], k=400))
    order = suffix_array(text, 16)
    keys = [tuple(text[i : i + 16]) for i in order]
    assert keys == sorted(keys) and sorted(order) == list(range(400))


@pytest.mark.parametrize("window", [17, 20, 40])
def test_windows_deeper_than_the_default_order(spark, docs_of, window):
    """Items that share their first 16 words and more, each of them in a document of its own."""
    texts = [" ".join(["a"] * 16 + [f"w{i // 5}"] * 3 + [f"x{i}"] + ["b"] * 40) for i in range(60)]
    items = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "item_id string, text string")
    docs = docs_of([(i, f"start{i} {t} end") for i, t in enumerate(texts)])
    found = contamination(docs, items, window=window).select("doc_id", "__found.n_hit", "__found.items").collect()
    assert all(r.n_hit == 60 and str(r.doc_id) in r["items"] for r in found)
