import hashlib
from collections import defaultdict

import pytest

from shopgrain.llm.exact_dedup import drop_copies, exact_dedup


@pytest.mark.parametrize("keep", ["min", "max"])
def test_groups_and_odd_rows(odd, keep):
    got = exact_dedup(odd, keep=keep).collect()
    rows = [(r.doc_id, r.text or "") for r in odd.collect()]
    groups = defaultdict(list)
    for i, t in rows:
        groups[hashlib.sha256(t.encode()).hexdigest()].append(i)
    assert len(got) == len(rows)
    pick = max if keep == "max" else min
    for r in got:
        ids = [i for i in groups[r.text_sha256] if i is not None]
        assert r.group_size == len(groups[r.text_sha256])
        assert r.keep_id == (pick(ids) if ids else None)
    kept = [r for r in got if r.kept]
    assert sorted(r.text_sha256 for r in kept) == sorted(groups)
    assert all(r.doc_id == r.keep_id for r in kept)


def test_hot_text_is_cut_and_merged(docs_of):
    rows = [(i, "same" if i % 3 else f"own {i}") for i in range(30_000)]
    got = exact_dedup(docs_of(rows), keep="min")
    assert got.where("group_size = 20000 AND keep_id = 1").count() == 20_000
    assert got.where("kept").count() == 10_001


def test_drop_keeps_columns(odd):
    kept = drop_copies(odd)
    assert kept.schema == odd.schema
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 2, 3, 5, 7, 8, 9]
    assert drop_copies(odd.limit(0)).count() == 0
