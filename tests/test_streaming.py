from pyspark.sql import functions as F

from tallyweir.operators import lifecycle
from tallyweir.streaming import lifecycle as streams


def source(spark, tmp_path, batches, schema):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))


def drain(df, name, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).start()
    q.processAllAvailable()
    q.stop()
    return df.sparkSession.table(name)


def test_append_once(spark, tmp_path):
    schema = "id string, ts timestamp, v int"
    s = source(spark, tmp_path, [[("a", None, 0)][:0] or [("a", __import__("datetime").datetime(2026, 1, 1), 1)], [("a", __import__("datetime").datetime(2026, 1, 2), 2), ("b", __import__("datetime").datetime(2026, 1, 2), 3)]], schema)
    assert sorted(map(tuple, drain(streams.append_once(s, "id", "ts"), "once").select("id").collect())) == [("a",), ("b",)]


def test_page_changes(spark, tmp_path):
    s = source(spark, tmp_path, [[("u", "<p>a", "1")], [("u", "<p>a<!-- x -->", "2")], [("u", "<p>b", "3"), ("w", "<p>", "3")]], "url string, html string, fetched_at string")
    got = sorted((r.url, r.fetched_at, r.outcome) for r in drain(streams.page_changes(s), "pages").collect())
    assert got == [("u", "1", "new"), ("u", "2", "unchanged"), ("u", "3", "changed"), ("w", "3", "new")]


def test_tracked_changes_equal_the_batch(spark, tmp_path):
    schema = "k string, d string, i int, v int"
    log = [[("a", "1", 0, 5), ("b", "1", 0, 1)], [("a", "2", 0, 5), ("b", "2", 0, 2)], [("a", "3", 0, None), ("b", "3", 0, 2), ("a", "0", 0, 9)]]
    s = source(spark, tmp_path, log, schema)
    got = sorted((r.key, r.from_date) for r in drain(streams.tracked_changes(s, "k", "d", ["v"]), "tracked").collect())
    batch = lifecycle.tracked_periods(spark.createDataFrame([x for b in log for x in b if x[1] != "0"], schema), "k", "d", ["i"], ["v"])
    assert got == sorted((r.k, r.from_date) for r in batch.collect())


def test_seen_counts(spark, tmp_path):
    import datetime as dt

    s = source(spark, tmp_path, [[("a", dt.datetime(2026, 1, 1, 5)), ("a", dt.datetime(2026, 1, 1, 7))], [("a", dt.datetime(2026, 3, 1))]], "k string, ts timestamp")
    got = drain(streams.seen_counts(s, ["k"], "ts"), "seen", "complete").select("k", "readings").collect()
    assert sorted(map(tuple, got)) == [("a", 1), ("a", 2)]


def test_fold_stream_equals_the_batch(spark, tmp_path):
    schema = "k string, t int, v int"
    log = [[("a", 1, 5), ("b", 1, None)], [("a", 2, None), ("b", 2, 7)], [("a", 3, 8)]]
    s = source(spark, tmp_path, log, schema)
    fold = lambda old, new: lifecycle.upsert_fold(new if old is None else old.unionByName(new), "k", ["t"])
    q = streams.fold_stream(s, str(tmp_path / "state"), fold, str(tmp_path / "cp"))
    q.awaitTermination(120)
    got = streams.latest_version(spark, str(tmp_path / "state"), 2)
    batch = lifecycle.upsert_fold(spark.createDataFrame([x for b in log for x in b], schema), "k", ["t"])
    assert sorted(map(tuple, got.select("k", "v").collect())) == sorted(map(tuple, batch.select("k", "v").collect()))
    assert got.where(F.col("k") == "b").first().v == 7
