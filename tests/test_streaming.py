import json

from lavra.sources import sinks
from lavra.streaming import events


def test_windows_on_a_stream(spark, tmp_path):
    rows = [("2024-01-01 00:01:00", 1, "a", 1.0), ("2024-01-01 00:50:00", 1, "a", 2.0), ("2024-01-01 01:10:00", 2, "b", 3.0), ("2024-01-01 05:00:00", 1, "a", 4.0)]
    df = spark.createDataFrame(rows, "t string, user_id int, event_type string, value double").selectExpr("timestamp(t) as ts", "user_id", "event_type", "value")
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = events.tumbling(stream).writeStream.outputMode("append").format("memory").queryName("w").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {(str(r.window_start), r.event_type, r.n, r.total) for r in spark.table("w").collect()}
    assert got == {("2024-01-01 00:00:00", "a", 2, 3.0), ("2024-01-01 01:00:00", "b", 1, 3.0)}  # the last window is still open
    assert {(r.user_id, r.n) for r in events.sessions(df).collect()} == {(1, 1), (2, 1)}


def test_ingest_twice(spark, tmp_path):
    folder, table = tmp_path / "drop", str(tmp_path / "table")
    folder.mkdir()
    (folder / "1.json").write_text("\n".join(json.dumps({"k": k, "v": v}) for k, v in (("a", 1), ("b", 2))))
    run = lambda: events.ingest(spark, str(folder), "k string, v int", table, "k", str(tmp_path / "check")).awaitTermination(120)
    run()
    (folder / "2.json").write_text(json.dumps({"k": "b", "v": 5}))
    run()
    run()
    assert {tuple(r) for r in sinks.read_table(spark, table).select("k", "v").collect()} == {("a", 1), ("b", 5)}
