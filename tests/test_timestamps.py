import datetime as dt
import re
import zoneinfo

from pyspark.sql import functions as F

from tallyweir.functions.timestamps import Candidate, days_from_civil, normalise
from tallyweir.operators.timestamps import DATE_ATTRIBUTES, attribute_instants
from tests.oracle import SF, connect

UTC = dt.timezone.utc
MONTH = {m: i + 1 for i, m in enumerate("Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split())}
SCHEMA = "attr_id bigint, attr_name string, attr_value string, display_value string, formatted_value string, tz string, culture string"


def millis(x):
    d = x - dt.datetime(1970, 1, 1, tzinfo=UTC)
    return d.days * 86_400_000 + d.seconds * 1000 + d.microseconds // 1000


def zone(tz):
    tz = tz or "Asia/Qatar"
    if tz[0] in "+-":
        return dt.timezone((-1 if tz[0] == "-" else 1) * dt.timedelta(hours=int(tz[1:3]), minutes=int(tz[4:6])))
    return zoneinfo.ZoneInfo(tz)


def one_by_one(v, local, us, tz):
    """The statement, format by format, with Python's own calendar."""
    if not v:
        return None
    v = v.translate(str.maketrans("٠١٢٣٤٥٦٧٨٩", "0123456789")).strip()
    try:
        if m := re.fullmatch(r"/Date\((-?\d+)([+-]\d{4})?\)/", v):
            r = int(m[1])
        elif re.fullmatch(r"\d{13}", v):
            r = int(v)
        elif re.fullmatch(r"\d{10}", v):
            r = int(v) * 1000
        elif m := re.fullmatch(r"(\d{4}-\d\d-\d\d)[T ](\d\d:\d\d(?::\d\d)?)(\.\d+)?(Z|[+-]\d\d:?\d\d)?(\[.*\])?", v):
            z = UTC if m[4] in (None, "Z") else dt.datetime.strptime(m[4], "%z").tzinfo
            r = millis(dt.datetime.fromisoformat(f"{m[1]}T{m[2]}").replace(tzinfo=z)) + int((m[3] or ".000").ljust(4, "0")[1:4])
        elif re.fullmatch(r"\d{4}-\d\d-\d\d", v):
            r = millis(dt.datetime.fromisoformat(v).replace(tzinfo=UTC))
        elif m := re.fullmatch(r"\w{3}, (\d\d) (\w{3}) (\d{4}) (\d\d):(\d\d):(\d\d) GMT", v):
            r = millis(dt.datetime(int(m[3]), MONTH[m[2]], int(m[1]), *(int(m[i]) for i in (4, 5, 6)), tzinfo=UTC))
        elif m := re.fullmatch(r"(\d+)[/.](\d+)[/.](\d{4})(?: (\d+):(\d+)(?: (AM|PM|ص|م))?)?", v):
            d, mo = (int(m[2]), int(m[1])) if us else (int(m[1]), int(m[2]))
            if m[4] is None:
                r = millis(dt.datetime(int(m[3]), mo, d, tzinfo=UTC))
            else:
                h = int(m[4]) % 12 + (12 if m[6] in ("PM", "م") else 0) if m[6] else int(m[4])
                r = millis(dt.datetime(int(m[3]), mo, d, h, int(m[5])).replace(tzinfo=zone(tz) if local else UTC, fold=0).astimezone(UTC))
        else:
            return None
    except (ValueError, OverflowError):
        return None
    return r if r >= -2_208_988_800_000 else None


def test_against_the_calendar_library(spark):
    names = ", ".join(f"'{n}'" for n in DATE_ATTRIBUTES)
    expected = {}
    for i, a, b, c, tz, culture in connect(SF).execute(f"SELECT attr_id, attr_value, display_value, formatted_value, tz, culture FROM record_attribute WHERE lower(trim(attr_name)) IN ({names})").fetchall():
        found = [one_by_one(a, False, False, tz), one_by_one(b, False, False, tz), one_by_one(c, True, culture == "en-US", tz)]
        at = next((x for x in found if x is not None), None)
        if at is not None:
            expected[i] = at
    got = attribute_instants(spark.read.parquet(f"{SF}/record_attribute.parquet")).collect()
    assert {r.attr_id: r.utc_ms for r in got} == expected and len(got) == len(expected)


def instants(spark, cases, **kw):
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, v string, tz string")
    us = kw.pop("us", False)
    out = normalise(df, [Candidate("v", month_first=F.lit(us), **kw)], tz=F.col("tz"), default_tz="Asia/Qatar")
    return [r.utc_ms for r in out.orderBy("i").collect()]


def at(*a):
    return millis(dt.datetime(*a, tzinfo=UTC))


def test_forms_and_bounds(spark):
    cases = ["2024-02-29", "2023-02-29", "31/02/2027", "1899-12-31T23:59:59Z", "1900-01-01", "2024-01-01T24:00:00Z", "2024-13-01", "2024-01-01T10:00:60Z", "2025-04-16T23:59:46.0009999Z", "2024-05-05 10:00+05:30", "Sun, 26 Mar 2023 00:00:57 GMT", "5 March 2024 7:05 pm", "", None, "x", "/Date(0)/", "1/2/2024", "1/2.2024", "\u200f١٧/١١/٢٠٢٧\u200f", "9" * 3000, "12:30", "0000-01-01"]
    expected = [at(2024, 2, 29), None, None, None, at(1900, 1, 1), None, None, None, at(2025, 4, 16, 23, 59, 46, 0), at(2024, 5, 5, 4, 30), at(2023, 3, 26, 0, 0, 57), at(2024, 3, 5, 19, 5), None, None, None, 0, at(2024, 2, 1), None, at(2027, 11, 17), None, None, None]
    assert instants(spark, [(c, None) for c in cases]) == expected


def test_local_times(spark):
    cases = [("26/10/2025 02:30", "Europe/Paris"), ("30/03/2025 02:30", "Europe/Paris"), ("01/01/2025 00:00", None), ("01/01/2025 00:00", "-05:00"), ("01/01/2025", "-05:00"), ("01/01/2025 00:00", "Nowhere/Land"), ("2025-01-01T00:00Z", "-05:00"), ("01/01/2025 00:00", " ")]
    expected = [at(2025, 10, 26, 0, 30), at(2025, 3, 30, 1, 30), at(2024, 12, 31, 21), at(2025, 1, 1, 5), at(2025, 1, 1), None, at(2025, 1, 1), at(2024, 12, 31, 21)]
    assert instants(spark, cases, local=True) == expected
    assert instants(spark, [("5/14/2028 1:05 AM", "UTC"), ("12/1/2024 12:00 AM", "UTC"), ("12/1/2024 12:00 PM", "UTC"), ("1/1/2024 13:00 PM", "UTC")], local=True, us=True) == [at(2028, 5, 14, 1, 5), at(2024, 12, 1), at(2024, 12, 1, 12), None]


def test_day_arithmetic(spark):
    df = spark.range(0, 60000, 37).select(F.date_add(F.to_date(F.lit("1900-01-01")), F.col("id").cast("int")).alias("d"))
    days = days_from_civil(F.year("d").cast("bigint"), F.month("d").cast("bigint"), F.dayofmonth("d").cast("bigint"))
    assert df.where(days != F.unix_date("d")).count() == 0


def test_empty_tables_nulls_and_extra_columns(spark):
    assert attribute_instants(spark.createDataFrame([], SCHEMA)).count() == 0
    df = spark.createDataFrame([(1, None, None, None, None, None, None), (2, " CreatedOn ", None, "", "01/01/2025", None, None), (2, "createdon", "x", None, "01/01/2025", None, "en-us")], SCHEMA).withColumn("utc_ms", F.lit("clash")).withColumn("__ms", F.lit(1))
    assert sorted((r.attr_id, r.utc_ms) for r in attribute_instants(df).collect()) == [(2, at(2025, 1, 1))] * 2
