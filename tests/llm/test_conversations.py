import duckdb
from pyspark.sql import functions as F

from dockflow.llm import conversations

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def chat(conv_id, *texts, start=0):
    return [(conv_id, start + i, ("user", "assistant")[i % 2], t) for i, t in enumerate(texts)]


ROWS = [
    *chat(1, "hello", "hi", "bye"),
    *chat(2, "hello", "hi"),
    *chat(3, "hello"),
    *chat(4, "hello", "ha"),
    *chat(5, "hello", "hi", "bye"),
    *chat(6, "hello", "hi", "bye", start=10),  # other numbers, same turns
    *chat(7, "hi", "hello"),
    *chat(7, "hi", "hello"),  # repeated rows
    (8, 0, "System", "rules"),
    (8, 1, None, None),
    (8, None, "Human", ""),
    (None, 0, "user", "lost"),
    (None, 1, "bot", "found"),
    (9, 0, "user", "lost"),
    (10, 0, "user", "a"),
    (10, 0, "user", "b"),  # two turns of one number
    *chat(11, *[f"turn {i}" for i in range(700)]),
    *chat(12, *[f"turn {i}" for i in range(300)]),
    *chat(13, *[f"turn {i}" for i in range(299)], "other"),
]


def test_agrees_with_sql(spark):
    frame = spark.createDataFrame(ROWS, SCHEMA).repartition(4).withColumns({"n": F.lit(1), "chunk": F.lit("x"), "at": F.lit(0)})
    found = conversations.chat_format(frame)
    connection = duckdb.connect()
    connection.register("conversations", spark.createDataFrame(ROWS, SCHEMA).toPandas().astype({"conv_id": "Int64", "turn": "Int64"}))
    relation = connection.sql(conversations.ORACLE)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    expected = sorted(relation.fetchall(), key=key)
    assert sorted(map(tuple, found.select(*relation.columns).collect()), key=key) == expected
    kept = {r["conv_id"] for r in found.collect()}
    assert kept == {1, 4, 7, 8, None, 10, 11, 13}
    assert found.where("conv_id = 11").count() == 3


def test_rendering(spark):
    frame = spark.createDataFrame(chat(1, "hello", "hi"), SCHEMA)
    assert conversations.chat_format(frame).first()["text"] == "<|user|>\nhello<|end|>\n<|assistant|>\nhi<|end|>\n"


def test_plan_has_no_python(spark):
    plan = conversations.chat_format(spark.createDataFrame(ROWS, SCHEMA))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_table(spark):
    assert conversations.chat_format(spark.createDataFrame([], SCHEMA)).count() == 0
