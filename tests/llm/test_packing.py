import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shopgrain.llm.packing import Encoder, Plan, pack

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(rows, got, capacity):
    tok = Tokenizer.from_file(PATH)
    want = Counter()
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        for k, s in enumerate(range(0, len(ids), capacity)):
            piece = np.array(ids[s : s + capacity], "<u4")
            want[(i, k, s, len(piece), zlib.crc32(piece.tobytes()))] += 1
    assert want == Counter((r.id, r.piece, r.start, r.length, r.ids_crc32) for r in got)
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins), -(-sum(r.length for r in got) // capacity)


def test_documents(docs_of, documents):
    used, least = check(documents, pack(docs_of(documents), PATH).collect(), 4096)
    assert used <= least + 1


def test_small_capacity_and_odd_rows(odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    used, least = check(rows, pack(odd, PATH, capacity=64).collect(), 64)
    assert used <= least + 1
    assert pack(odd.limit(0), PATH).count() == 0


@pytest.mark.parametrize(
    "text", ["don't Stop'LL 're", "áb é", "x<|endoftext|>y", "1234 a1b2", "É!!? Ⅷ ß…", " \n\n ", "İstanbul ſ"]
)
def test_chunks_encode_as_the_whole(text):
    tok = Tokenizer.from_file(PATH)
    got = np.frombuffer(Encoder(PATH).ids(text), "<u4").tolist()
    assert got == tok.encode(text, add_special_tokens=False).ids


def optimum(sizes, capacity):
    """Fewest bins, by trying all ways."""
    best = [len(sizes)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(bins)
            return
        for j in {b: j for j, b in enumerate(bins)}.values():
            if bins[j] >= sizes[i]:
                go(i + 1, [*bins[:j], bins[j] - sizes[i], *bins[j + 1 :]])
        go(i + 1, [*bins, capacity - sizes[i]])

    go(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(40))
def test_dominance_never_costs_a_sequence(seed):
    """After the reduction alone, an optimal packing of what is left is still optimal overall."""
    rng = random.Random(seed)
    capacity = 24
    sizes = sorted((rng.randint(1 if seed % 2 else 5, capacity) for _ in range(8)), reverse=True)

    class Reduced(Plan):
        def _best_fit(self):
            pass

    plan = Reduced(dict(Counter(sizes)), capacity)
    rest = [n for n, c in plan.left.items() for _ in range(c)]
    assert plan.bins + optimum(sorted(rest, reverse=True), capacity) == optimum(sizes, capacity)
    full = Plan(dict(Counter(sizes)), capacity)
    assert full.bins <= optimum(sizes, capacity) + 1
    assert Counter({n: sum(r.bins * r.each for r in full.runs if r.length == n) for n in set(sizes)}) == Counter(sizes)
