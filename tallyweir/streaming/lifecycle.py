"""Streaming forms of the stateful operators. On the same log they give what the batch folds give."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tallyweir.functions import text
from tallyweir.session import remove


def append_once(stream: DataFrame, key: str, when: str | None = None) -> DataFrame:
    """Insert-if-absent: one row of each key, the first that comes, however late; the keys are kept for good. ``when`` makes no difference."""
    return stream.dropDuplicates([key])


def seen_counts(stream: DataFrame, keys: list[str], when: str, delay: str = "14 days", every: str = "1 day") -> DataFrame:
    """keys and window with first_seen, last_seen, readings per tumbling window; late rows within the delay count."""
    return stream.withWatermark(when, delay).groupBy(*keys, F.window(when, every)).agg(F.min(when).alias("first_seen"), F.max(when).alias("last_seen"), F.count("*").alias("readings"))


def page_changes(stream: DataFrame) -> DataFrame:
    """url, outcome, sha, fetched_at of each fetched page against the last one of its url. stream: url, html, fetched_at string."""
    hashed = stream.select("url", text.html_fingerprint(F.col("html")).alias("sha"), "fetched_at")

    def compare(key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        out = []
        for r in pd.concat(list(rows)).sort_values("fetched_at").itertuples():
            out.append((key[0], "new" if last is None else "unchanged" if last == r.sha else "changed", r.sha, r.fetched_at))
            last = r.sha
        state.update((last,))
        yield pd.DataFrame(out, columns=["url", "outcome", "sha", "fetched_at"])

    return hashed.groupBy("url").applyInPandasWithState(compare, "url string, outcome string, sha string, fetched_at string", "sha string", "append", GroupStateTimeout.NoTimeout)


def tracked_changes(stream: DataFrame, key: str, when: str, fields: list[str]) -> DataFrame:
    """key, from_date, fields whenever a tracked field differs from the key's last reading; readings come in order of ``when`` (older ones are dropped). All as strings."""
    rows = stream.select(F.col(key).alias("key"), F.col(when).alias("at"), F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("v"))

    def changes(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        at, value = state.get if state.exists else ("", None)
        out = []
        for r in pd.concat(list(batches)).sort_values("at", kind="stable").drop_duplicates("at", keep="last").itertuples():
            if r.at <= at:
                continue
            if r.v != value:
                out.append((k[0], r.at, r.v))
            at, value = r.at, r.v
        state.update((at, value))
        yield pd.DataFrame(out, columns=["key", "from_date", "v"])

    return rows.groupBy("key").applyInPandasWithState(changes, "key string, from_date string, v string", "at string, value string", "append", GroupStateTimeout.NoTimeout)


def fold_stream(stream: DataFrame, state: str, fold: Callable[[DataFrame | None, DataFrame], DataFrame], checkpoint: str, once: bool = True, key: str | None = None, buckets: int = 64) -> StreamingQuery:
    """Keeps a table under ``state`` up to date: its rows after batch n are fold(the rows before, batch n). A batch that runs again rewrites its own files, so each counts once.

    With ``key`` the table lies in buckets of the key, and a batch reads and rewrites only the buckets it touches; without,
    it is one bucket. What no later batch needs is deleted: of each bucket the last two versions stay.
    """

    def step(batch: DataFrame, n: int) -> None:
        spark: SparkSession = batch.sparkSession
        placed = batch.withColumn("__b", F.lit(0) if key is None else F.pmod(F.hash(key), F.lit(buckets)))
        touched = sorted(r[0] for r in placed.select("__b").distinct().collect())  # at most as many as there are buckets
        held = _versions(spark, state, n - 1)
        if key is None and not touched:
            touched = [0]
        old = [f"{state}/b{b}/v{held[b]}" for b in touched if b in held]
        rows = fold(spark.read.parquet(*old) if old else None, placed.drop("__b"))
        out = rows.withColumn("__b", F.lit(0) if key is None else F.pmod(F.hash(key), F.lit(buckets))).persist()
        for b in touched:
            out.where(F.col("__b") == b).drop("__b").write.mode("overwrite").parquet(f"{state}/b{b}/v{n}")
        out.unpersist()
        for b in touched:
            _forget(spark, f"{state}/b{b}", below=held.get(b, n))

    writer = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def _listed(spark: SparkSession, path: str) -> list[str]:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in fs.listStatus(at)] if fs.exists(at) else []


def _versions(spark: SparkSession, state: str, last: int) -> dict[int, int]:
    """bucket: its latest finished version up to ``last``."""
    found = {}
    for b in _listed(spark, state):
        done = [int(v[1:]) for v in _listed(spark, f"{state}/{b}") if int(v[1:]) <= last and "_SUCCESS" in _listed(spark, f"{state}/{b}/{v}")]
        if done:
            found[int(b[1:])] = max(done)
    return found


def _forget(spark: SparkSession, path: str, below: int) -> None:
    for v in _listed(spark, path):
        if int(v[1:]) < below:
            remove(spark, f"{path}/{v}")


def latest_version(spark: SparkSession, state: str, n: int) -> DataFrame:
    """The table after batch n, while the versions are there."""
    return spark.read.parquet(*(f"{state}/b{b}/v{v}" for b, v in sorted(_versions(spark, state, n).items())))
