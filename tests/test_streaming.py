from datetime import datetime

from folioflow.streaming import jobs

EVENTS = "ts timestamp, kind string, user string, value double"


def test_counts_and_sessions(spark):
    at = lambda h, m: datetime(2024, 1, 1, h, m)
    df = spark.createDataFrame([(at(1, 5), "a", "u", 1.0), (at(1, 55), "a", "u", 2.0), (at(2, 10), "a", "u", 3.0), (at(5, 0), "b", "u", 4.0)], EVENTS)
    assert {(r.window_start.hour, r.kind, r.n_events, r.total) for r in jobs.counts_by_time(df, "ts", "kind").collect()} == {(1, "a", 2, 3.0), (2, "a", 1, 3.0), (5, "b", 1, 4.0)}
    assert sorted(r.n_events for r in jobs.sessions(df, "ts", "user").collect()) == [1, 1, 2]


def test_late_events_are_left_out_and_runs_resume(spark, tmp_path):
    at = lambda d, h: datetime(2024, 1, d, h)
    folder, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    batches = [[(at(1, 1), "a", "u", 1.0), (at(1, 9), "a", "u", 1.0)], [(at(1, 1), "a", "u", 1.0), (at(2, 9), "a", "u", 1.0)], [(at(3, 9), "b", "u", 1.0)]]
    for rows in batches:
        spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").json(folder)
        stream = spark.readStream.schema(EVENTS).json(folder)
        jobs.keep_counts(stream, "ts", "kind", out, check).awaitTermination()
    got = {(r.window_start, r.n_events) for r in spark.read.parquet(out).collect()}
    assert (at(1, 1), 1) in got and (at(1, 9), 1) in got and (at(2, 9), 1) in got


def test_same_text_arrives_once(spark, tmp_path):
    folder = tmp_path / "texts"
    folder.mkdir()
    for name, text in (("a.txt", "one"), ("b.txt", "two"), ("c.txt", "one")):
        (folder / name).write_text(text)
    q = jobs.arriving_texts(spark, str(folder)).writeStream.format("memory").queryName("texts").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r.text for r in spark.table("texts").collect()) == ["one", "two"]


def test_retries_are_bounded(spark, tmp_path):
    folder = tmp_path / "attempts"
    spark.createDataFrame([("x", False), ("x", False), ("x", True), ("y", True), ("z", False)], "k string, ok boolean").coalesce(1).write.json(str(folder))
    stream = spark.readStream.schema("k string, ok boolean").json(str(folder))
    q = jobs.bounded_retries(stream, "k").writeStream.format("memory").queryName("retries").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(tuple(r) for r in spark.table("retries").collect()) == [("x", 1, "retry"), ("x", 2, "gave_up"), ("y", 1, "recovered"), ("z", 1, "retry")]
