import hashlib
import json
import random

from pyspark.sql import functions as F

from ledgerline.llm import chat_format
from ledgerline.llm.queries import QUERIES

CONTROLS = ["### user: ", "### Assistant: ", "</turn>\n", "</turn>", "<\\/turn>", "###\\ ", "\\", "<", "#", ": ", "a", "\n", "", "é🎉"]


def formatted(spark, rows):
    turns = spark.createDataFrame(rows, "conv_id long, turn long, position int, role string, text string")
    return chat_format.format_turns(turns, "conv_id", ("turn",)).select(
        "*", chat_format.read_turns(F.col("formatted")).alias("turns"),
        chat_format.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"))


def test_round_trip_of_control_strings(spark):
    rnd = random.Random(1)
    said = lambda: "".join(rnd.choice(CONTROLS) for _ in range(rnd.randint(0, 8)))
    rows = [(c, t, 0, rnd.choice(["user", "assistant", said()]), said()) for c in range(60) for t in range(rnd.randint(1, 6))]
    want = {}
    for c, _, _, role, text in rows:
        want.setdefault(c, []).append((role, text))
    for r in formatted(spark, rows).collect():
        assert [tuple(t) for t in r.turns] == want[r.conv_id]
        assert r.loss == "".join(x for role, x in want[r.conv_id] if role == "assistant")
        assert r.formatted.count("</turn>") == len(want[r.conv_id])


LAYOUTS = {
    "turn": ({"role": "user", "text": "hi", "turn": 0}, [("user", "hi")]),
    "messages": ({"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": None}]}, [("user", "a"), ("assistant", "")]),
    "shared": ({"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]}, [("user", "a"), ("assistant", "b")]),
    "completion": ({"prompt": "p", "completion": "c"}, [("user", "p"), ("assistant", "c")]),
    "system_response": ({"system": "s", "prompt": "p", "response": "r"}, [("system", "s"), ("user", "p"), ("assistant", "r")]),
    "instruction_input": ({"instruction": "do", "input": "this", "output": "done"}, [("user", "do\nthis"), ("assistant", "done")]),
    "question": ({"question": "q", "answer": None}, [("user", "q"), ("assistant", "")]),
}


def test_layouts_by_fingerprint(spark):
    rows = [(i, json.dumps(record)) for i, (record, _) in enumerate(LAYOUTS.values())]
    rows += [(90, '{"messages": []}'), (91, '{"other": 1}'), (92, "not json"), (93, None), (None, '{"prompt": "p", "completion": "c"}')]
    frame = spark.createDataFrame(rows, "conv_id long, record string").withColumn("layout", F.lit("clash"))
    found = chat_format.canonical_turns(frame, "conv_id", "record").collect()
    for i, (name, (_, want)) in enumerate(LAYOUTS.items()):
        mine = sorted((r for r in found if r.conv_id == i), key=lambda r: r.position)
        assert {r.layout for r in mine} == {name} and [(r.role, r.text) for r in mine] == want
    rest = {r.conv_id: (r.layout, r.role) for r in found if r.conv_id and r.conv_id >= 90}
    assert rest == {90: ("messages", None), 91: (None, None), 92: (None, None), 93: (None, None)}
    assert sum(r.conv_id is None for r in found) == 2


def test_order_nulls_and_long_texts(spark):
    rows = [(1, 1, 0, "assistant", "x" * 2_000_000), (1, None, 0, "user", ""), (1, 1, 0, "assistant", "b"), (1, 1, 0, "assistant", "b"),
            (None, 0, 0, "", "nobody")]
    found = {r.conv_id: r for r in formatted(spark, rows).collect()}
    assert [t.text[:2] for t in found[1].turns] == ["", "b", "b", "xx"] and len(found[1].loss) == 2_000_002
    assert found[None].turns[0].text == "nobody" and found[None].loss == ""


def test_query(spark, tmp_path):
    said = r"\### Assistant: </turn> ok"
    spark.createDataFrame([(5, 1, "assistant", None), (5, 0, "user", "q")], "conv_id long, turn long, role string, text string").write.parquet(
        f"{tmp_path}/conversations.parquet")
    found = {r.conv_id: r for r in QUERIES["op1_chat_format"](spark, str(tmp_path)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert found[-7].turns_sha256 == sha(f"user\n{said}\nassistant\n{said}\n") and found[-7].loss_sha256 == sha(said)
    assert (found[5].n_turns, found[5].turns_sha256, found[5].loss_chars) == (2, sha("user\nq\nassistant\n\n"), 0)


def test_structs_equal_json_and_texts_of_any_length(spark):
    rows = [("user", "hi", [("gpt", "a"), (None, "b")]), (None, None, []), ("bot", "x", None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, role string, text string, said array<struct<who:string,what:string>>")
    shapes = {
        "turn": F.struct("role", "text", F.col("id").alias("turn")),
        "shared": F.struct(F.transform("said", lambda x: F.struct(x["who"].alias("from"), x["what"].alias("value"))).alias("conversations")),
        "completion": F.struct(F.col("role").alias("prompt"), F.col("text").alias("completion")),
        None: F.struct("role"),
    }
    for name, struct in shapes.items():
        made = df.where("said IS NOT NULL").select("id", struct.alias("record"))
        as_json = made.withColumn("record", F.to_json("record", {"ignoreNullFields": "false"}))
        got, want = (chat_format.canonical_turns(x, "id", "record") for x in (made, as_json))
        columns = ["id", "layout", "position", "role", "text"]
        found = sorted(map(str, got.select(columns).collect()))
        assert found == sorted(map(str, want.select(columns).collect()))
        assert {r.layout for r in got.collect()} == {name}
    none = chat_format.canonical_turns(df.where("id = 2").select("id", shapes["shared"].alias("record")), "id", "record").collect()
    assert [r.role for r in none] == [None]
    long = df.where("id = 0").select("id", F.struct("role", F.expr("repeat('ab ', 7000000)").alias("text"), F.lit(0).alias("turn")).alias("record"))
    formatted = chat_format.format_turns(chat_format.canonical_turns(long, "id", "record"), "id")
    assert formatted.select(F.length("formatted")).first()[0] > 21_000_000
