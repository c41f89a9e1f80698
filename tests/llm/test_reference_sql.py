import duckdb
import parity
import pytest

from shopgrain.llm.queries import QUERIES, SQL

NAMES = ["op2_exact_dedup", "op4_decontamination", "op10_urls"]


@pytest.mark.parametrize("name", NAMES)
def test_on_given_tables(spark, sf_dir, name):
    assert parity.compare(QUERIES[name](spark, sf_dir), parity.connect(sf_dir), SQL[name]) is None


@pytest.fixture(scope="module")
def planted(tmp_path_factory):
    """Nulls, repeated rows and ids, short and repeating items, links between hosts."""
    folder = str(tmp_path_factory.mktemp("planted"))
    con = duckdb.connect()
    con.execute(f"""COPY (SELECT * FROM (VALUES
        (1, NULL), (2, ''), (3, 'A b'), (3, 'A b'), (4, 'a a a a a a a a a a a a a a'), (NULL, 'x of THE y'),
        (5, 'É1 b c d e f g h i j k l m n, and ' || repeat('z ', 50)), (6, 'b c d e f g h i j k')
      ) t(doc_id, text)) TO '{folder}/documents.parquet'""")
    con.execute(f"""COPY (SELECT * FROM (VALUES
        (10, 'of the'), (10, 'a B'), (11, NULL), (12, '...'), (9, 'a a a a a a a a a a a a'), (NULL, 'z z'),
        (13, 'é1 É1 b c d e f g h i j k l m n'), (14, 'É1 B C D E F G H I J K L M n AND z z z')
      ) t(item_id, text)) TO '{folder}/benchmark.parquet'""")
    con.execute(f"""COPY (SELECT * FROM (VALUES
        (1, NULL, NULL), (2, 'none', ''), (3, 'http://Spam.net/x', '<a href="//good.org/a">'),
        (4, 'http://friend.io/a?b', '<A HREF=''https://spam.NET/y''> <a href=//spam.net>'),
        (4, 'http://friend.io/a?b', '<a href="/own">'), (5, 'https://good.org/fr/', '<a href="http://fine.io">'),
        (6, 'https://good.org/en/', '<a href="http://good.org/">'), (7, 'x://fine.io', '<a href="//friend.io/">'),
        (8, 'http://a.example.net/en/1', NULL), (9, 'http://friend.io#z', '')
      ) t(page_id, url, html)) TO '{folder}/pages.parquet'""")
    return folder


@pytest.mark.parametrize("name", ["op4_decontamination", "op10_urls"])
def test_on_odd_rows(spark, planted, name):
    query = QUERIES[name](spark, planted)
    assert parity.compare(query, parity.connect(planted), SQL[name]) is None
    if name == "op10_urls":
        verdicts = {(r.host, r.rule): r.verdict for r in query.collect()}
        assert verdicts["friend.io", None] == "block" and verdicts["good.org", None] == "allow"
    if name == "op4_decontamination":
        assert query.where("contaminated").count() == 6
