from pyspark.sql import functions as F

from tallyweir.streaming.lifecycle import fold_stream, latest_version


def total(old, batch):
    rows = batch if old is None else old.unionByName(batch)
    return rows.groupBy("k").agg(F.sum("n").alias("n"))


def test_a_batch_rewrites_only_what_it_touches(spark, tmp_path):
    log, state = tmp_path / "log", tmp_path / "state"

    def add(*rows):
        spark.createDataFrame(list(rows), "k string, n bigint").coalesce(1).write.mode("append").parquet(str(log))
        fold_stream(spark.readStream.schema("k string, n bigint").parquet(str(log)), str(state), total, str(tmp_path / "ck"), key="k", buckets=8).awaitTermination()
        return {p.name for p in state.iterdir() for v in p.iterdir() if v.name == f"v{n[0]}"}

    n = [0]
    first = add(*((c, 1) for c in "abcdefgh"), ("a", 5))
    n[0] = 1
    second = add(("a", 10))
    assert len(first) > 1 and len(second) == 1 and second < first
    n[0] = 2
    assert add(("a", 100)) == second
    rows = {r.k: r.n for r in latest_version(spark, str(state), 2).collect()}
    assert rows == {**{c: 1 for c in "bcdefgh"}, "a": 116}
    assert sorted(v.name for v in (state / second.pop()).iterdir()) == ["v1", "v2"]
