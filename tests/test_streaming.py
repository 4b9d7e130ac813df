from conftest import rows

from tidemark.operators.dedup import latest_by_key
from tidemark.sources.tables import LakeTable
from tidemark.streaming.incremental import upsert_new_files

KEY = ["user_id"]


def run(spark, folder, schema, target):
    query = upsert_new_files(spark, f"{folder}/in", schema, target, KEY, f"{folder}/checkpoint", newest=("ts", "event_id"))
    query.awaitTermination()
    assert query.exception() is None


def test_stream_equals_batch_and_sees_each_file_once(spark, folder):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    middle = events.selectExpr("percentile(event_id, 0.5)").first()[0]
    target = LakeTable(spark, f"{folder}/out")
    for wave in (events.filter(events.event_id <= middle), events.filter(events.event_id > middle)):
        wave.write.mode("append").parquet(f"{folder}/in")
        run(spark, folder, events.schema, target)
    versions = target.log().count()
    run(spark, folder, events.schema, target)  # nothing new arrived
    assert target.log().count() == versions == 2
    expected = latest_by_key(events, KEY, newest=("ts", "event_id"))
    assert rows(target.read(), "user_id", "event_id") == rows(expected, "user_id", "event_id")


def test_a_replayed_batch_is_skipped(spark, folder):
    target = LakeTable(spark, f"{folder}/out")
    df = spark.createDataFrame([(1, "a")], "k long, v string")
    assert target.upsert(df, ["k"], origin="checkpoint#0") == 1
    assert target.upsert(df, ["k"], origin="checkpoint#0") == 0
    assert target.current().version == 1


def test_a_renewed_checkpoint_loses_nothing(spark, folder):
    import shutil
    target, schema = LakeTable(spark, f"{folder}/renewed"), "k int, v string"
    for k in (1, 2):
        spark.createDataFrame([(k, "x")], schema).write.mode("overwrite").parquet(f"{folder}/landing{k}")
        df = spark.read.parquet(f"{folder}/landing{k}")
        upsert_new_files(spark, f"{folder}/landing{k}", df.schema, target, ["k"], f"{folder}/checkpoint", newest=("v",)).awaitTermination()
        shutil.rmtree(f"{folder}/checkpoint")
    assert sorted(r.k for r in target.read().collect()) == [1, 2]
