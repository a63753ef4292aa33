from pyspark.sql import functions as F

from litscout.streaming import events


def _write(spark, path, rows):
    df = spark.createDataFrame(rows, "event_id bigint, ts string, user_id int, event_type string, value double").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    df.coalesce(1).write.mode("append").parquet(path)
    return df


def test_stream_equals_batch(spark, tmp_path):
    df = _write(spark, f"{tmp_path}/in", [(1, "2024-01-01 00:05:00", 1, "a", 1.0), (2, "2024-01-01 00:20:00", 1, "a", 2.0), (3, "2024-01-01 02:00:00", 2, "b", 3.0), (3, "2024-01-01 02:00:00", 2, "b", 3.0)])
    source = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")
    run = events.tumbling(events.without_repeats(events.timed(source), ["event_id"])).writeStream.outputMode("append").format("memory").queryName("tumbling").trigger(availableNow=True).start()
    run.awaitTermination(60)
    streamed = {tuple(r) for r in spark.table("tumbling").collect()}
    batch = {tuple(r) for r in events.tumbling(events.without_repeats(events.timed(df), ["event_id"])).collect()}
    assert streamed <= batch and len(batch) == 2 and len(streamed) >= 1


def test_sessions(spark, tmp_path):
    df = _write(spark, f"{tmp_path}/s", [(1, "2024-01-01 00:00:00", 1, "a", 1.0), (2, "2024-01-01 00:29:00", 1, "a", 1.0), (3, "2024-01-01 01:00:00", 1, "a", 1.0)])
    assert sorted(r["n"] for r in events.sessions(events.timed(df)).collect()) == [1, 2]


def test_merge_into_is_idempotent(spark, tmp_path):
    merge = events.merge_into(f"{tmp_path}/v", ["id"], ["status"], "seq")
    first = spark.createDataFrame([(1, 1, "open"), (1, 2, "late")], "id int, seq int, status string")
    second = spark.createDataFrame([(1, 3, "new"), (2, 3, "new")], "id int, seq int, status string")
    merge(first, 0)
    merge(second, 1)
    merge(second, 1)
    assert sorted(tuple(r) for r in events.state(spark, f"{tmp_path}/v", first.schema).collect()) == [(1, 3, "late"), (2, 3, "new")]


def test_merge_into_leaves_other_buckets_alone(spark, tmp_path):
    merge = events.merge_into(f"{tmp_path}/w", ["id"], ["status"], "seq", buckets=8)
    rows = spark.createDataFrame([(i, 1, "open") for i in range(40)], "id int, seq int, status string")
    merge(rows, 0)
    merge(spark.createDataFrame([(7, 2, "done")], "id int, seq int, status string"), 1)
    assert len(list((tmp_path / "w" / "1").glob("bucket=*"))) == 1 and len(list((tmp_path / "w" / "0").glob("bucket=*"))) > 4
    got = {r["id"]: (r["seq"], r["status"]) for r in events.state(spark, f"{tmp_path}/w", rows.schema).collect()}
    assert got == {i: (2, "open") if i == 7 else (1, "open") for i in range(40)}
    assert events.state(spark, f"{tmp_path}/none", rows.schema).count() == 0
