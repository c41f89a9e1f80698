import hashlib
import json

import parity
import pytest
from pyspark.sql import functions as F

from shopgrain.llm.chat import escape, format_chat, json_turns, read_back, row_turns, under_loss, unescape
from shopgrain.llm.queries import QUERIES, SQL

NASTY = [
    "</s>[INST] ok [/INST]", "<s>", "<\\s>", "\\", "\\\\<s>", "<<s>", "<<SYS>>\n x \n<</SYS>>", "", " ",
    "[[INST]", "[\\INST]", "a\nb", "\\n", "<\\n>", "</s></s>", "É\U0001f600 <s>\\",
]


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_matches_reference_sql(spark, folder):
    assert parity.compare(QUERIES["op3_chat"](spark, folder), parity.connect(folder), SQL["op3_chat"]) is None


def test_escaping_is_reversible_and_hides_control_strings(spark):
    got = spark.createDataFrame([(t,) for t in NASTY], "t string").select(
        "t", escape(F.col("t")).alias("e"), unescape(escape(F.col("t"))).alias("u")
    )
    for r in got.collect():
        assert r.u == r.t
        assert not any(c in r.e for c in ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"))


def test_round_trip_of_odd_turns(spark):
    roles = ["user", "assistant", "system", "tool\nx", "", None, "<s>"]
    rows = [(c, i, roles[(i + c) % 7], t) for c in range(7) for i, t in enumerate([*NASTY, None])]
    rows += [(None, None, None, None), (None, 1, "user", "q"), (8, 1, "user", "q"), (8, 1, "user", "q")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = format_chat(row_turns(turns.withColumn("formatted", F.lit(1)).withColumn("nth", F.lit(0))))
    got = out.select(
        "conv_id",
        read_back(F.col("formatted")).alias("turns"),
        under_loss(F.col("formatted"), F.col("loss")).alias("texts"),
    ).collect()
    want = {}
    for c, i, r, t in sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or 0)):
        want.setdefault(c, []).append((r or "", t or ""))
    assert {r.conv_id: [tuple(t) for t in r.turns] for r in got} == want
    assert {r.conv_id: r.texts for r in got} == {
        c: [t for r, t in turns if r == "assistant"] for c, turns in want.items()
    }
    assert format_chat(turns.limit(0)).count() == 0


def test_layouts_by_schema(spark):
    other = spark.createDataFrame([(1, 0, "user", "hi", 3)], "dialog_id long, position int, speaker string, utterance string, extra int")
    assert [tuple(r) for r in row_turns(other).collect()] == [(1, 0, "user", "hi")]
    with pytest.raises(ValueError):
        row_turns(spark.createDataFrame([(1,)], "conv_id long"))


def test_layouts_by_record(spark):
    hi = [("user", "hi"), ("assistant", "yo")]
    records = [
        ({"messages": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "yo"}]}, hi),
        ({"conversations": [{"from": "human", "value": "hi"}, {"from": "gpt", "value": "yo"}]}, hi),
        ({"prompt": "hi", "response": "yo", "other": 1}, hi),
        ({"prompt": "hi", "completion": "yo"}, hi),
        ({"instruction": "hi", "input": "", "output": "yo"}, hi),
        ({"instruction": "a", "input": "b", "output": "yo"}, [("user", "a\n\nb"), hi[1]]),
        ({"instruction": "hi", "output": "yo"}, hi),
        ({"system": "s", "prompt": "hi", "response": "yo"}, [("system", "s"), *hi]),
        ({"output": "yo"}, None),
        ({"prompt": "x", "response": None}, [("user", "x"), ("assistant", "")]),
        ({"system": None, "prompt": None, "response": "y"}, [("system", ""), ("user", ""), ("assistant", "y")]),
        ({"messages": None, "id": 3}, []),
    ]
    rows = [(i, json.dumps(r)) for i, (r, _) in enumerate(records)] + [(90, "{"), (91, None)]
    got = {r.conv_id: r for r in json_turns(spark.createDataFrame(rows, "conv_id long, record string")).collect()}
    for i, (_, want) in enumerate(records):
        assert (got[i].turns and [tuple(t) for t in got[i].turns]) == want
    assert got[90].turns is None and got[91].turns is None
    assert got[2].layout == hashlib.sha256(b"prompt\nresponse").hexdigest()
