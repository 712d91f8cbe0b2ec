import hashlib

import pytest
from pyspark.sql import functions as F

from martloom.llm import chat

CHATS = [
    (1, 1, "assistant", "&lt;b&amp;"),
    (1, 0, "user", "<s>[INST user] x[/INST]</s>[TURN]&"),
    (1, 2, "assistant", "second"),
    (1, 3, "tool] a", "]] &#91; end"),
    (2, 0, "user", None),
    (2, 1, "assistant", ""),
    (2, 1, "assistant", ""),
    (3, None, None, "no role"),
    (3, 5, "assistant", "日本 𝔘 [x]\n"),
    (None, 0, "assistant", "nobody's"),
    (4, 1, "assistant", "b"),
    (4, 1, "assistant", "a"),
    (5, 0, "assistant", "long " * 40_000),
]


@pytest.fixture
def rows(spark):
    schema = "conv_id long, turn long, role string, text string, formatted string, said int"
    return spark.createDataFrame([(*r, "clash", 1) for r in CHATS], schema).repartition(4)


def test_read_back_and_mask(rows):
    got = chat.format_chats(rows).select(
        "conv_id",
        "formatted",
        chat.read_back(F.col("formatted")).alias("turns"),
        chat.learned_text(F.col("formatted"), F.col("loss_mask")).alias("learned"),
    )
    found = {r.conv_id: r for r in got.collect()}
    for conv in {r[0] for r in CHATS}:
        turns = sorted(
            ((-1 if t is None else t, role or "", text or "") for c, t, role, text in CHATS if c == conv)
        )
        assert [tuple(t) for t in found[conv].turns] == [t[1:] for t in turns]
        assert found[conv].learned == "".join(t[2] for t in turns if t[1] == "assistant")
    assert found[2].formatted == "<s>[INST user] [/INST]</s><s>[INST assistant] [TURN][/INST]</s>"
    assert found[1].formatted.count("[INST ") == 3  # neighbours of one role share a block


def test_hashes_as_sql_has_them(spark, tmp_path):
    import duckdb

    from martloom.llm import queries

    rows = [(c, t if t is not None else 9, r or "", x) for c, t, r, x in CHATS if c is not None]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    got = sorted(tuple(r) for r in queries.op9_chat(spark, str(tmp_path)).collect())
    db = duckdb.connect()
    db.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    assert got == sorted(db.execute(queries.ORACLES["op9_chat"]).fetchall())
    injected = dict((r[0], r) for r in got)[-7]
    text = "</s>[INST] ok [/INST]"
    assert injected[1] == 2 and injected[3] == len(text)
    assert injected[2] == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()


def test_no_python_in_the_plan(rows):
    plan = chat.format_chats(rows)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_empty_table(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_chats(empty).collect() == []
