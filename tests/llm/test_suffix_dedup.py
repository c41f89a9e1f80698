import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopgrain.llm import suffix_dedup
from shopgrain.llm.queries import op5_suffix_dedup
from shopgrain.llm.suffix_dedup import Hashes, anchors, remove_repeats, repeated_starts, suffix_sort


def brute(texts, length):
    """Removed runs and what is left, by counting all strings."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1).sum())
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def check(docs, rows, **options):
    got = remove_repeats(docs, **options).collect()
    mine = sorted(
        ((r.id, r.n_bytes, r.n_bytes - len(r.kept), len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in got),
        key=repr,
    )
    want = brute([t for _, t in rows], options.get("length", 200))
    assert mine == sorted(((i, *w) for (i, _), w in zip(rows, want)), key=repr)


def test_documents(spark, sf_dir, documents):
    want = {i: w for (i, _), w in zip(documents, brute([t for _, t in documents], 200))}
    got = op5_suffix_dedup(spark, sf_dir).collect()
    assert len(got) == len(want)
    for r in got:
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id], r.doc_id
    assert any(r.n_removed for r in got) and any(not r.n_removed for r in got)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("max_group", [4096, 2])
def test_overlaps_at_all_places(docs_of, seed, max_group):
    """Short strings over few letters: shared parts of all lengths begin and end anywhere."""
    rng = random.Random(seed)
    word = lambda k: "".join(rng.choices("abé ", k=k))
    shared = [word(rng.randint(10, 90)) for _ in range(8)]
    rows = [
        (i, word(rng.randint(0, 30)) + "".join(rng.choice(shared) + word(rng.randint(0, 12)) for _ in range(4)))
        for i in range(40)
    ]
    rows += [(100, "ab" * 60), (101, "x" * 19), (102, "x" * 20), (103, "x" * 21), (104, "b" + "ab" * 30)]
    check(docs_of(rows), rows, length=20, gram=6, max_group=max_group)


def test_odd_rows(docs_of, odd):
    rows = [(r.doc_id, r.text[:4000] if r.text else r.text) for r in odd.collect()]
    check(docs_of(rows), rows)
    assert remove_repeats(odd.limit(0)).count() == 0


def test_repeated_rows_hold_their_spans_once(docs_of):
    """Rows of one id and text don't multiply what is gathered for them."""
    text = random.Random(9).randbytes(600).hex()
    rows = [(1, text)] * 20 + [(2, text[300:900])]
    check(docs_of(rows), rows)
    docs = docs_of(rows).select(F.col("doc_id").alias("id"), "text", F.xxhash64("text").alias("th"))
    once = docs_of([*rows[:2], rows[-1]]).select(F.col("doc_id").alias("id"), "text", F.xxhash64("text").alias("th"))
    spans = lambda d: {r.id: len(r.spans) for r in suffix_dedup.repeated_spans(d).collect()}
    assert spans(docs) == spans(once)


def test_anchors_cover_every_start():
    data = np.frombuffer(random.Random(5).randbytes(3000), np.uint8)
    offsets = np.array([0, 100, 100, 1500, 3000])
    first, last, at, _ = anchors(data, offsets, 200, 48)
    starts = [i for f, x in zip(first, last) for i in range(f, x + 1)]
    assert starts == [*range(100, 1301), *range(1500, 2801)]
    assert all(f <= p and p + 48 <= f + 200 and x <= p for f, x, p in zip(first, last, at))


@pytest.mark.parametrize("seed", range(5))
def test_suffix_sort(seed):
    rng = random.Random(seed)
    data = np.array(rng.choices([97, 98], k=600), np.uint8)
    starts = np.array(rng.sample(range(560), 300))
    groups = np.array(rng.choices([1, 2], k=300))
    order = suffix_sort(Hashes(data), starts, groups, 32)
    raw = data.tobytes()
    keys = [(groups[i], raw[starts[i] : starts[i] + 32]) for i in order]
    assert keys == sorted(keys) and sorted(order) == list(range(300))


def test_common_extension():
    data = np.frombuffer(b"abcabcabd", np.uint8)
    h = Hashes(data)
    assert h.common(np.array([0, 0, 3]), np.array([3, 1, 6]), 3).tolist() == [3, 0, 2]


def test_collisions_are_noticed(monkeypatch):
    """With a useless hash, the bytes still decide."""
    texts = [b"a" * 30 + b"b" * 10, b"c" * 5 + b"a" * 25, b"d" * 40]
    group = np.zeros(3, np.int64)
    want = [x.tolist() for x in repeated_starts(group, texts, 20)]
    monkeypatch.setattr(Hashes, "of", lambda self, start, n: np.zeros(len(start), np.uint64))
    assert [x.tolist() for x in repeated_starts(group, texts, 20)] == want
    assert suffix_dedup._by_bytes(group, texts, 20)[2].tolist() == list(range(21))
