import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.streaming import messages as M

SCHEMA = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("t", T.StringType())])
TEXTS = ['{"k": 1, "t": "a"}', '{"k": 2}', '{"k": "x"}', "{broken", "[]", ""]
NO_OBJECTS = ['[{"k": 1}]', '[{"k": 1}, {"k": 2}]', '{"k": 1}{"k": 2}', '{"k": 1} x', '{"k": 1}, {"k": 2}', "7", '"k"', "null"]


def test_encode_and_decode(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], SCHEMA)
    encoded = M.encode(df, lambda d: d.where("k = 1"))
    assert [r["value"] for r in encoded.collect()] == ['{"k":1,"t":"a"}']
    back = M.decode(M.encode(df), SCHEMA)
    assert [tuple(r) for r in back.collect()] == [(1, "a", None), (2, None, None)]


def test_bad_messages_are_marked(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS[:4]] + [(None,)], "value string")
    bad = [r[M.CORRUPT] for r in M.decode(df, SCHEMA).collect()]
    assert bad == [None, None, '{"k": "x"}', "{broken", ""]


def test_only_a_single_object_is_a_message(spark):
    texts = TEXTS[4:] + NO_OBJECTS
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    assert [r[M.CORRUPT] for r in M.decode(df, SCHEMA).collect()] == texts
    spaced = spark.createDataFrame([('\n\t {"k": 5, "t": "]{"} \r\n',)], "value string")
    assert [tuple(r) for r in M.decode(spaced, SCHEMA).collect()] == [(5, "]{", None)]


def test_publish_and_whole_files(spark, tmp_path):
    M.publish(spark.createDataFrame([(1, "a")], SCHEMA), "text", path=f"{tmp_path}/topic")
    assert [r["value"] for r in spark.read.text(f"{tmp_path}/topic").collect()] == ['{"k":1,"t":"a"}']
    os.makedirs(f"{tmp_path}/in")
    for n in ("a", "b"):
        with open(f"{tmp_path}/in/{n}.json", "w") as f:
            f.write(f'{{\n"t": "{n}"}}')
    whole = M.whole_files(spark, f"{tmp_path}/in")
    assert sorted(r["t"] for r in M.decode(whole, SCHEMA).collect()) == ["a", "b"]


def test_stream(spark, tmp_path):
    inbox, archive, table, checkpoint = (f"{tmp_path}/{n}" for n in ("inbox", "archive", "table", "checkpoint"))
    os.makedirs(inbox)

    def drop(name, lines):
        with open(f"{inbox}/{name}", "w") as f:
            f.write("\n".join(lines))

    def run():
        stream = M.message_folder(spark, inbox, archive)
        M.receive(stream, SCHEMA, table, checkpoint).awaitTermination()
        good = M.received(spark, table, SCHEMA)
        bad = M.received(spark, table, SCHEMA, "bad")
        return sorted(r["k"] for r in good.collect()), sorted(r[M.CORRUPT] for r in bad.collect())

    drop("a.txt", TEXTS[:4])
    assert run() == ([1, 2], ['{"k": "x"}', "{broken"])
    assert run() == ([1, 2], ['{"k": "x"}', "{broken"])  # nothing new: nothing twice
    drop("b.txt", ['{"k": 3}'])
    assert run() == ([1, 2, 3], ['{"k": "x"}', "{broken"])
    drop("c.txt", ['{"k": 4}'])
    assert run()[0] == [1, 2, 3, 4]
    archived = [f for _, _, files in os.walk(archive) for f in files if f.endswith(".txt")]
    assert "a.txt" in archived and "a.txt" not in os.listdir(inbox)


def test_a_new_stream_replaces_nothing(spark, tmp_path):
    """What a second stream receives, with a checkpoint of its own, is added to the table."""
    table = f"{tmp_path}/table"
    for name, texts in (("one", TEXTS[:4]), ("two", ['{"k": 9}'])):
        spark.createDataFrame([(t,) for t in texts], "value string").write.text(f"{tmp_path}/{name}")
        for _ in range(2):  # the same stream again finds nothing new
            stream = M.message_folder(spark, f"{tmp_path}/{name}")
            M.receive(stream, SCHEMA, table, f"{tmp_path}/checkpoint-{name}").awaitTermination()
    assert sorted(r["k"] for r in M.received(spark, table, SCHEMA).collect()) == [1, 2, 9]
    assert M.received(spark, table, SCHEMA, "bad").select(F.count("*")).first()[0] == 2


def test_a_batch_that_runs_again_replaces_itself(spark, tmp_path):
    """The commit of a batch is lost after its rows were written: it runs again under its number."""
    folder, table, checkpoint = (f"{tmp_path}/{n}" for n in ("in", "table", "checkpoint"))
    spark.createDataFrame([(t,) for t in TEXTS[:4]], "value string").write.text(folder)
    for _ in range(2):
        M.receive(M.message_folder(spark, folder), SCHEMA, table, checkpoint).awaitTermination()
        for name in os.listdir(f"{checkpoint}/commits"):
            os.remove(f"{checkpoint}/commits/{name}")
    assert sorted(r["k"] for r in M.received(spark, table, SCHEMA).collect()) == [1, 2]
