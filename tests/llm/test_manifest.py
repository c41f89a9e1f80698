import hashlib
import zlib
from collections import defaultdict

import parity
import pytest
from pyspark.sql import functions as F

from shopgrain.llm.manifest import fold, leaf_digest, prove_all
from shopgrain.llm.manifest_queries import OP12_SQL, op12_manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree int, rank int, digest string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def value(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def up(nodes):
    return [sha("".join(nodes[i : i + 8])) for i in range(0, len(nodes), 8)]


def siblings(nodes, at):
    """Pairs of what stands before and after, from the leaf's run up, and the root."""
    out = []
    while len(nodes) > 1:
        run = nodes[at // 8 * 8 : at // 8 * 8 + 8]
        out.append(("".join(run[: at % 8]), "".join(run[at % 8 + 1 :])))
        nodes, at = up(nodes), at // 8
    return out, nodes[0]


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text, lang, source, n_chars in rows:
        leaf = sha("".join(map(value, (doc_id, source, lang, n_chars, text))))
        given = leaf
        if doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0:
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            given = sha("".join(map(value, (doc_id, source, lang, n_chars, low))))
        groups[lang].append((doc_id, leaf, given))
    langs = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for g in groups.values():
        g.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    subroots = [siblings([r[1] for r in groups[s]], 0)[1] for s in langs]
    out = []
    for i, s in enumerate(langs):
        above, root = siblings(subroots, i)
        for k, (doc_id, leaf, given) in enumerate(groups[s]):
            path = siblings([r[1] for r in groups[s]], k)[0] + above
            folded = given
            for a, b in path:
                folded = sha(a + folded + b)
            out.append((doc_id, leaf, subroots[i], root, sha("".join(a + b for a, b in path)), folded, folded == root))
    return out


ODD = (
    [(i, f"Text {i} É", "en", "s", i) for i in range(70)]
    + [(i, None if i % 5 == 0 else "WORD " * i, "de", None, None) for i in range(200, 209)]
    + [(300, "alone", "fr", "s", 1), (301, "Alone", None, "s", 1), (302, "", "", "", 0)]
    + [(400, "same", "xx", "s", 4)] * 17
    + [(401, "one", "xx", "s", 4), (401, "two", "xx", "s", 4), (None, "no id", "xx", "s", 4)]
    + [(500, "LONG " * 100_000, "é", "s", 4)]
    + [(600 + i, "t", f"l{i}", "s", 1) for i in range(10)]
)


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "d") for r in rows], SCHEMA)


def run(spark, tmp_path, rows):
    table(spark, rows).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    return op12_manifest(spark, str(tmp_path))


@pytest.mark.parametrize("rows", [ODD, ODD[:1], ODD[:8], ODD[:9], []], ids=["odd", "one", "eight", "nine", "none"])
def test_odd_rows(spark, tmp_path, rows):
    got = run(spark, tmp_path, rows)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute(rows), key=repr)


def test_against_sql(spark, sf_dir):
    assert parity.compare(op12_manifest(spark, sf_dir), parity.connect(sf_dir), OP12_SQL) is None


def test_requests_descend_alone(spark):
    cols = ("doc_id", "source", "lang", "n_chars", "text")
    leaves = table(spark, ODD).select("doc_id", "lang", "text", leaf_digest(*map(F.col, cols)).alias("digest"))
    asked = spark.createDataFrame([("en", 0), ("en", 69), ("xx", 5), (None, 0), ("zz", 0), ("en", 70)], "lang string, rank long")
    proofs, root = prove_all(leaves, "lang", "doc_id", asked)
    assert sorted((r.lang or "", r["rank"]) for r in proofs.collect()) == [("", 0), ("en", 0), ("en", 69), ("xx", 5)]
    assert {r[0] for r in proofs.select(fold(F.col("digest"), F.col("path"))).collect()} == {root}
