import random

import xxhash
import pytest

from shopgrain.llm.components import components
from shopgrain.llm.simhash import drop_near_copies, fingerprint, links, signed, simhash_groups


def plain(text, k=3):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate(
        {c: " " for c in (9, 10, 11, 12, 13)}).split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(items, linked):
    """Brute-force components of a list."""
    parent = list(range(len(items)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(items)):
        for j in range(i):
            if linked(items[i], items[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [root(i) for i in range(len(items))]


def near(a, b):
    return (a ^ b).bit_count() <= 3


@pytest.mark.parametrize("text", ["", "a", "A b", "a b c", "One two three\vfour é ÉA", "x " * 200])
def test_fingerprint(text):
    assert fingerprint(text.encode()) % 2**64 == plain(text)


def expected(rows):
    items = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    fps = [plain(t) for _, t in items]
    root = classes(fps, near)
    return sorted(((items[i][0], f"{fps[i]:016x}", items[root[i]][0]) for i in range(len(items))), key=repr)


def test_against_brute_force(spark, docs_of, documents):
    rows = documents + [(10_000 + i, t.replace("the", "thy", 1)) for i, t in documents[:80] if t]
    got = simhash_groups(docs_of(rows)).collect()
    assert sorted(((r.id, f"{r.fp % 2**64:016x}", r.component_id) for r in got), key=repr) == expected(rows)


def test_odd_rows(odd):
    got = simhash_groups(odd).collect()
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert sorted(((r.id, f"{r.fp % 2**64:016x}", r.component_id) for r in got), key=repr) == expected(rows)
    kept = drop_near_copies(odd)
    assert kept.schema == odd.schema
    assert simhash_groups(odd.limit(0)).count() == 0 and drop_near_copies(odd.limit(0)).count() == 0


def test_large_bucket_is_dealt_again(spark):
    rng = random.Random(3)
    centre = rng.getrandbits(64)
    fps = {centre}
    while len(fps) < 3000:
        f = centre
        for b in rng.sample(range(64), rng.choice([1, 2, 3, 9])):
            f ^= 1 << b
        fps.add(f)
    fps = sorted(fps)
    frame = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    got = {r.node: r.root for r in components(links(frame)).collect()}
    root = classes(fps, near)
    pairs = {}
    for f, r in zip(fps, root):
        pairs.setdefault(r, set()).add(got.get(signed(f), signed(f)))
    assert all(len(x) == 1 for x in pairs.values())
    assert len(set().union(*pairs.values())) == len(pairs)


def test_components_of_a_long_path(spark):
    order = list(range(60))
    random.Random(1).shuffle(order)
    path = spark.createDataFrame(list(zip(order, order[1:])) + [(100, 101), (7, 7)], "a long, b long")
    assert {r.node: r.root for r in components(path).collect()} == {**dict.fromkeys(order, 0), 100: 100, 101: 100}


def test_one_text_of_an_id_that_a_group_holds_twice(spark, docs_of):
    docs = docs_of([(1, "a b c"), (1, "A b c"), (2, "a  b c"), (3, "quite another text here"), (1, "a b c")])
    kept = [(r.doc_id, r.text) for r in drop_near_copies(docs).collect()]
    own = {t for i, t in kept if i == 1}
    assert len(own) == 1 and {i for i, _ in kept} == {1, 3}
