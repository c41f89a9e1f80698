import hashlib
import re
from collections import defaultdict

import parity
import pytest
from pyspark.sql import functions as F

from shopgrain.llm.mix_queries import OP11_SQL, op11_mixing
from shopgrain.llm.mixing import draw, mix, pareto_sample


def test_against_sql(spark, sf_dir):
    assert parity.compare(op11_mixing(spark, sf_dir), parity.connect(sf_dir), OP11_SQL) is None


def of_sources(spark, rows):
    schema = "doc_id long, text string, source string, key string, size string, target string, __d0 int"
    return spark.createDataFrame([(*r, "k", "s", "t", 3) for r in rows], schema)


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute(rows, weights=(5, 2, 1), share=1.5, most=2, seed=11):
    """Copies by (id, text, source), one document after the other."""
    names = sorted({r[2] for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    size = {s: sum(words(r[1]) for r in rows if r[2] == s) for s in names}
    capped = set()
    while True:
        rest = [s for s in names if s not in capped]
        left = share * sum(size.values()) - sum(most * size[s] for s in capped)
        unit = left / sum(weight[s] for s in rest) if rest else 0
        over = {s for s in rest if unit * weight[s] >= most * size[s]}
        if not over:
            break
        capped |= over
    out = {}
    for s in names:
        target = most * size[s] if s in capped else unit * weight[s]
        units = defaultdict(int)
        for i, text, source in rows:
            if source == s:
                units[i, text or ""] += words(text)
        whole = int(target // size[s]) if size[s] else 0
        left = round(target - whole * size[s], 6)
        key = {u: hashlib.md5(f"{seed}:{'-' if u[0] is None else u[0]}:{u[1]}".encode()).hexdigest() for u in units}
        order = sorted((u for u in units if units[u] and left > 0), key=key.get)
        taken, skipped = set(), []
        for u in order:
            if units[u] <= left:
                left -= units[u]
                taken.add(u)
            else:
                skipped.append(u)
        least = min(skipped, key=lambda u: units[u], default=None)
        if least and units[least] < 2 * left:
            taken.add(least)
        for i, t in units:
            out[i, t, s] = (target, whole + ((i, t) in taken))
    return out


ODD = (
    [(i, "w " * (i % 7 + 1) + f"t{i}", "big") for i in range(300)]
    + [(5, "same words here", "copy")] * 9
    + [(i, "a b c d", None) for i in range(20)]
    + [(None, "no id", "copy"), (400, None, "copy"), (401, "", "blank"), (402, " \t\n", "blank")]
    + [(500, "long " * 30_000, "one"), (501, "é x   ü", "one")]
)


def test_odd_rows(spark):
    want = brute(ODD)
    for parts in (1, 5):
        got = mix(of_sources(spark, ODD).repartition(parts)).collect()
        assert len(got) == len(ODD)
        texts = defaultdict(set)
        for r in got:
            texts[r.doc_id, r.source, r.size].add((round(r.target, 6), r.copies, r.taken))
        for (i, t, s), (target, copies) in want.items():
            assert texts[i, s, words(t)] == {(round(target, 6), copies, copies * words(t))}


def test_draw_repeats_rows(spark):
    docs = of_sources(spark, ODD)
    drawn = draw(docs)
    assert drawn.schema == docs.schema
    want = brute(ODD)
    total = sum(words(t) * want[i, t or "", s][1] for i, t, s in ODD)
    assert drawn.agg(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0] == total
    assert draw(docs.limit(0)).count() == 0 and mix(docs.limit(0)).count() == 0


def test_unequal_chances_keep_the_size(spark):
    """Over many strata, a document is drawn about as often as its chance says, and each sum is met."""
    rows = spark.range(400 * 40).select(
        (F.col("id") % 400).cast("string").alias("source"),
        F.md5(F.col("id").cast("string")).alias("key"),
        F.lit(10).cast("long").alias("size"),
        F.when(F.col("id") < 400 * 20, 0.2).otherwise(0.7).alias("chance"),
    )
    bounds, extras = pareto_sample(rows)
    odds = lambda p: p / (1 - p)
    cut = {r.source: (r["rank"], r["key"]) for r in bounds.collect()}
    more = {(r.source, r.key) for r in extras.collect()}
    drawn = defaultdict(int)
    words_of = defaultdict(int)
    for r in rows.collect():
        u = (int(r.key[:13], 16) + 0.5) / 2**52
        if (odds(u) / odds(r.chance), r.key) < cut[r.source] or (r.source, r.key) in more:
            drawn[r.chance] += 1
            words_of[r.source] += r["size"]
    assert set(words_of.values()) == {180}
    assert drawn[0.2] / 8000 == pytest.approx(0.2, abs=0.02) and drawn[0.7] / 8000 == pytest.approx(0.7, abs=0.02)
