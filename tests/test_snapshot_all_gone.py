import pytest

from tallyweir.operators.snapshot_diff import snapshot_changes
from tests.test_data_operators import COMPANY, SWEEP, T0


@pytest.mark.parametrize("depth", [0, 3])
def test_snapshots_without_a_live_row_are_compared(spark, depth):
    days = ["2026-01-01", "2026-01-08", "2026-01-15", "2026-01-22"]
    sweeps = spark.createDataFrame([(i, d, True) for i, d in enumerate(days)], SWEEP)
    row = lambda d, i, gone=None: (d, T0, i, "N", None, "x", 0, gone)
    data = [row(days[0], "a"), row(days[0], "b"), row(days[1], "a", "g"), row(days[1], "b", "g"), row(days[2], "a"), row(days[3], "a", "g")]
    got = sorted(map(tuple, snapshot_changes(spark.createDataFrame(data, COMPANY), sweeps, depth).collect()))
    assert got == [(days[1], "a", "removed"), (days[1], "b", "removed"), (days[2], "a", "added"), (days[3], "a", "removed")]
