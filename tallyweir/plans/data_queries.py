"""Queries p1 to p6 and the SQL they are held against."""

from __future__ import annotations

from datetime import date

from tallyweir.operators.event_time import scores_with_state
from tallyweir.operators.history import status_periods
from tallyweir.operators.rolling import trailing_awards
from tallyweir.operators.snapshot_diff import snapshot_changes
from tallyweir.operators.timestamps import attribute_instants
from tallyweir.operators.wide import account_rows
from tallyweir.session import table

FIRST, LAST = date(2026, 1, 1), date(2026, 3, 31)

QUERIES = {
    "p1_found": lambda spark, d: attribute_instants(table(spark, d, "record_attribute")),
    "p2_found": lambda spark, d: status_periods(table(spark, d, "listing_snapshot"), table(spark, d, "sweep")),
    "p3_found": lambda spark, d: account_rows(table(spark, d, "record_attribute"), block_size=4),
    "p4_found": lambda spark, d: snapshot_changes(table(spark, d, "company"), table(spark, d, "sweep")),
    "p5_found": lambda spark, d: trailing_awards(table(spark, d, "tender"), table(spark, d, "tender_company"), table(spark, d, "classified_company"), FIRST, LAST),
    "p6_found": lambda spark, d: scores_with_state(table(spark, d, "score_observation"), table(spark, d, "listing_state")),
}

ID = "lower(regexp_replace(regexp_replace({c}, '^[\\s\\x{{a0}}]+|[\\s\\x{{a0}}]+$', '', 'g'), '^\\{{|\\}}$', '', 'g'))"
VAL = "nullif(lower(regexp_replace({c}, '^[\\s\\x{{a0}}]+|[\\s\\x{{a0}}]+$', '', 'g')), '')"

#: spellings of a point in time; of the third field the time is local
ISO = r"^(\d{4})-(\d{1,2})-(\d{1,2})(?:[T ](\d{1,2}):(\d{2})(?::(\d{2})(?:\.(\d+))?)?\s*(Z|[+-]\d{2}:?\d{2})?(?:\[.*\])?)?$"
SHORT = r"^(\d{1,2})[/.](\d{1,2})[/.](\d{4})(?:,? +(\d{1,2}):(\d{2})(?::(\d{2}))?\s*(AM|PM|ص|م)?)?$"
MAIL = r"^\w{3}, (\d{1,2}) (\w{3}) (\d{4}) (\d{2}):(\d{2}):(\d{2}) GMT$"

ORACLES = {
    "p1_found": f"""
WITH r AS (SELECT attr_id, coalesce(nullif(trim(tz), ''), 'Asia/Qatar') AS z, coalesce(lower(trim(culture)), '') = 'en-us' AS us, [attr_value, display_value, formatted_value] AS v FROM record_attribute WHERE lower(trim(attr_name)) IN ('icv_posteddate', 'createdon', 'modifiedon', 'icv_icvscoreexpirydate')),
t AS (SELECT attr_id, z, i, us AND i = 3 AS us, trim(translate(v[i], '٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹', '01234567890123456789')) AS t FROM r, (SELECT unnest([1, 2, 3]) AS i)),
p AS (SELECT *, TRY_CAST(nullif(regexp_extract(t, '^/Date\\((-?\\d+)(?:[+-]\\d{{4}})?\\)/$', 1), '') AS BIGINT) AS js, TRY_CAST(nullif(regexp_extract(t, '^\\d{{12,14}}$'), '') AS BIGINT) AS ms, TRY_CAST(nullif(regexp_extract(t, '^\\d{{9,11}}$'), '') AS BIGINT) AS sec,
  regexp_extract(t, '{ISO}', ['y', 'm', 'd', 'h', 'mi', 's', 'f', 'o']) AS a, regexp_extract(t, '{SHORT}', ['x', 'w', 'y', 'h', 'mi', 's', 'ap']) AS b, regexp_extract(t, '{MAIL}', ['d', 'm', 'y', 'h', 'mi', 's']) AS c FROM t),
q AS (SELECT attr_id, z, i, coalesce(js, ms, sec * 1000) AS ms, a.o AS o, coalesce(nullif(a.y, ''), nullif(b.y, ''), nullif(c.y, '')) AS y, coalesce(nullif(a.m, ''), nullif(CASE WHEN us THEN b.x ELSE b.w END, ''), nullif(CAST(list_position(['Jan', 'Feb', 'Mar', 'Apr', 'May', 'Jun', 'Jul', 'Aug', 'Sep', 'Oct', 'Nov', 'Dec'], c.m) AS VARCHAR), '0')) AS m,
  coalesce(nullif(a.d, ''), nullif(CASE WHEN us THEN b.w ELSE b.x END, ''), nullif(c.d, '')) AS d, TRY_CAST(coalesce(nullif(a.h, ''), nullif(b.h, ''), nullif(c.h, '')) AS INT) AS h, TRY_CAST(coalesce(nullif(a.mi, ''), nullif(b.mi, ''), nullif(c.mi, '')) AS INT) AS mi, coalesce(TRY_CAST(coalesce(nullif(a.s, ''), nullif(b.s, ''), nullif(c.s, '')) AS INT), 0) AS s,
  CAST(left(a.f || '000', 3) AS INT) AS f, b.ap AS ap, c.y <> '' AS mail FROM p),
w AS (SELECT *, TRY_CAST(y || '-' || lpad(m, 2, '0') || '-' || lpad(d, 2, '0') AS DATE) AS day, CASE WHEN ap = '' THEN h WHEN h BETWEEN 1 AND 12 THEN h % 12 + CASE WHEN ap IN ('PM', 'م') THEN 12 ELSE 0 END END AS hour FROM q),
x AS (SELECT *, epoch_ms(CAST(day AS TIMESTAMP)) + CASE WHEN hour <= 23 AND mi <= 59 AND s <= 59 THEN ((hour * 60 + mi) * 60 + s) * 1000 + f END AS wall, CASE WHEN o = '' OR o = 'Z' THEN o ELSE left(o, 3) || ':' || right(o, 2) END AS zone FROM w),
l AS (SELECT *, CASE WHEN i = 3 AND zone = '' AND z NOT SIMILAR TO '[+-].*' THEN timezone(z, make_timestamp(wall * 1000)) END AS local FROM x),
g AS (SELECT attr_id, i, CASE WHEN ms IS NOT NULL THEN ms WHEN h IS NULL THEN epoch_ms(CAST(day AS TIMESTAMP)) WHEN zone = 'Z' OR mail OR (i < 3 AND zone = '') THEN wall
  WHEN zone <> '' OR z SIMILAR TO '[+-].*' THEN wall - (CASE WHEN left(coalesce(nullif(zone, ''), z), 1) = '-' THEN -1 ELSE 1 END) * (CAST(substr(coalesce(nullif(zone, ''), z), 2, 2) AS INT) * 60 + CAST(right(coalesce(nullif(zone, ''), z), 2) AS INT)) * 60000
  ELSE epoch_ms(CASE WHEN timezone(z, local - INTERVAL 1 HOUR) = make_timestamp(wall * 1000) THEN local - INTERVAL 1 HOUR ELSE local END) END AS utc FROM l)
SELECT attr_id, CAST(arg_min(utc, i) AS BIGINT) AS utc_ms FROM g WHERE utc >= -2208988800000 GROUP BY attr_id""",
    "p2_found": f"""
WITH s AS (SELECT sweep_date, finished, row_number() OVER (ORDER BY sweep_date) pos, count(*) FILTER (WHERE finished) OVER (ORDER BY sweep_date) fin FROM sweep),
f AS (SELECT fin, sweep_date AS d FROM s WHERE finished),
r AS (SELECT {ID.format(c='id')} id, sweep_date, max(struct_pack(a := read_at, b := coalesce({VAL.format(c='status')}, ''), c := coalesce({VAL.format(c='certificate_no')}, ''))) x FROM listing_snapshot GROUP BY ALL),
u AS (SELECT id, s.pos, s.fin, r.sweep_date d, x.b st, x.c ce, s.finished FROM r JOIN s USING (sweep_date)),
g AS (SELECT *, lag(st) OVER w pst, lag(ce) OVER w pce, lag(fin) OVER w pfin FROM u WINDOW w AS (PARTITION BY id ORDER BY pos)),
h AS (SELECT *, CASE WHEN pst = st AND pce = ce AND fin - (CASE WHEN finished THEN 1 ELSE 0 END) - pfin < 2 THEN 0 ELSE 1 END op FROM g),
p AS (SELECT *, sum(op) OVER (PARTITION BY id ORDER BY pos) grp FROM h),
q AS (SELECT id, grp, min(d) from_date, max(d) last_d, max(fin) fin FROM p GROUP BY id, grp),
z AS (SELECT q.*, lead(from_date) OVER (PARTITION BY id ORDER BY grp) nxt FROM q)
SELECT id, from_date, coalesce(CASE WHEN f.d IS NOT NULL AND (nxt IS NULL OR f.d < nxt) THEN f.d ELSE nxt END, '') AS to_date
FROM z LEFT JOIN f ON f.fin = z.fin + 2""",
    "p3_found": """
WITH a AS (SELECT record_id, read_at, lower(trim(attr_name)) n,
  coalesce(nullif(trim(CASE WHEN trim(attr_value) LIKE '{%' THEN coalesce(json_extract_string(attr_value, '$.Name'), json_extract_string(attr_value, '$.Value')) ELSE attr_value END), ''), nullif(trim(display_value), ''), nullif(trim(formatted_value), '')) v
  FROM record_attribute WHERE entity_name = 'account'),
l AS (SELECT * FROM (SELECT *, max(read_at) OVER (PARTITION BY record_id) m FROM a) WHERE read_at = m),
w AS (SELECT record_id, max(v) FILTER (WHERE n = 'name') name, max(v) FILTER (WHERE n = 'icv_commercialregistrationnumber') cr_number, max(v) FILTER (WHERE n = 'icv_mainactivity') industry,
  max(v) FILTER (WHERE n = 'icv_totalscore') score, max(v) FILTER (WHERE n = 'cert.statuscode') st, max(v) FILTER (WHERE n = 'icv_latestcertificate') ce, max(lower(v)) FILTER (WHERE n = 'icv_ismanufacturer') ma FROM l GROUP BY record_id)
SELECT record_id, coalesce(name, '') AS name, coalesce(cr_number, '') AS cr_number, coalesce(industry, '') AS industry,
  coalesce(CAST(round(TRY_CAST(regexp_replace(translate(score, '٠١٢٣٤٥٦٧٨٩٫', '0123456789.'), '[\\s,%]', '', 'g') AS DOUBLE) * 100) AS BIGINT), -1) AS score_x100,
  coalesce(TRY_CAST(st AS BIGINT), CASE lower(st) WHEN 'valid' THEN 100000002 WHEN 'expired' THEN 100000003 WHEN 'under review' THEN 100000005 WHEN 'suspended' THEN 100000007 WHEN 'withdrawn' THEN 100000009 END, -1)::BIGINT AS status_code,
  coalesce(ce, '') AS certificate_no, (CASE WHEN ma IN ('true', '1', 'yes', 'نعم') THEN 1 WHEN ma IN ('false', '0', 'no', 'لا') THEN 0 ELSE -1 END)::BIGINT AS manufacturer
FROM w""",
    "p4_found": f"""
WITH s AS (SELECT sweep_date, row_number() OVER (ORDER BY sweep_date) pos FROM sweep WHERE finished AND sweep_date IN (SELECT snapshot_date FROM company)),
r AS (SELECT pos, sweep_date d, {ID.format(c='id')} id, loaded_at, gone_at IS NULL live, lower(trim(regexp_replace(name, '\\s+', ' ', 'g'))) n, coalesce(cr_number, '') c, coalesce(industry, '~') i, misses m FROM company JOIN s ON snapshot_date = sweep_date),
l AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY pos, id ORDER BY loaded_at DESC, live DESC, n DESC, c DESC) = 1),
v AS (SELECT * FROM l WHERE live)
SELECT (SELECT sweep_date FROM s WHERE s.pos = coalesce(n.pos, o.pos + 1)) AS snapshot_date, coalesce(n.id, o.id) AS id,
  CASE WHEN o.id IS NULL THEN 'added' WHEN n.id IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM v n FULL JOIN v o ON n.id = o.id AND n.pos = o.pos + 1
WHERE coalesce(n.pos, o.pos + 1) BETWEEN 2 AND (SELECT max(pos) FROM s)
  AND (o.id IS NULL OR n.id IS NULL OR n.n <> o.n OR n.c <> o.c OR n.i <> o.i OR n.m IS DISTINCT FROM o.m)""",
    "p5_found": """
WITH t AS (SELECT tender_id, coalesce(try_strptime(left(awarded_date, 10), '%Y-%m-%d'), try_strptime(awarded_date, '%d/%m/%Y'))::DATE AS d, awarded_amount AS amount
  FROM (SELECT * FROM tender QUALIFY row_number() OVER (PARTITION BY tender_id ORDER BY parsed_at DESC, awarded_date DESC, awarded_amount DESC) = 1)),
a AS (SELECT DISTINCT tender_id, cr_root FROM tender_company WHERE role = 'awarded' AND cr_root IN (SELECT cr_root FROM classified_company)),
x AS (SELECT cr_root, d, CAST(round(amount * 100) AS BIGINT) c FROM a JOIN t USING (tender_id) WHERE d IS NOT NULL AND amount IS NOT NULL),
days AS (SELECT CAST(unnest(generate_series(DATE '2026-01-01', DATE '2026-03-31', INTERVAL 1 DAY)) AS DATE) AS day),
g AS (SELECT e.cr_root, day, coalesce(sum(c) FILTER (WHERE d > day - 7), 0)::BIGINT t7, coalesce(sum(c), 0)::BIGINT t30
  FROM (SELECT DISTINCT cr_root FROM x) e CROSS JOIN days LEFT JOIN x ON x.cr_root = e.cr_root AND x.d <= day AND x.d > day - 30 GROUP BY ALL)
SELECT cr_root, strftime(day, '%Y-%m-%d') AS day, t7 AS total_7, CAST(floor(t7 / 7.0) AS BIGINT) AS avg_7, t30 AS total_30, CAST(floor(t30 / 30.0) AS BIGINT) AS avg_30 FROM g""",
    "p6_found": """
SELECT id AS observation_id, from_date, CASE lower(trim(status)) WHEN 'under review' THEN 'Under Review' ELSE upper(left(trim(status), 1)) || lower(substr(trim(status), 2)) END AS status
FROM (SELECT o.id, l.from_date, l.status, row_number() OVER (PARTITION BY o.id ORDER BY l.from_date DESC, l.recorded_at DESC, l.status DESC) k
  FROM (SELECT DISTINCT id, company_id, posted_at, posted_date FROM score_observation) o JOIN listing_state l ON l.company_id = o.company_id AND l.from_date <= o.posted_date
  AND l.recorded_at <= CAST(posted_at AS TIMESTAMPTZ)) WHERE k = 1""",
}
