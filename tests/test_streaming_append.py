from datetime import datetime

from tallyweir.operators import lifecycle
from tallyweir.streaming import lifecycle as streams
from tests.test_streaming import drain, source


def test_append_once_over_a_long_log_equals_the_batch(spark, tmp_path):
    """A key read again after months is no new one, and a row that comes months late is not lost."""
    schema = "id string, ts timestamp"
    log = [[("a", datetime(2026, 1, 1))], [("b", datetime(2026, 3, 1))], [("c", datetime(2026, 3, 2))], [("a", datetime(2026, 3, 3)), ("late", datetime(2026, 1, 2))], [("b", datetime(2026, 6, 1))]]
    s = source(spark, tmp_path, log, schema)
    got = sorted(r.id for r in drain(streams.append_once(s, "id", "ts"), "long").collect())
    batch = lifecycle.append_absent(spark.createDataFrame(log[0], schema), spark.createDataFrame([x for b in log for x in b], schema), "id", ["ts"])
    assert got == sorted(r.id for r in batch.collect()) == ["a", "b", "c", "late"]
