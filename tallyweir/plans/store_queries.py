"""Queries for the store's jobs: register passes, sweeps, cohorts, exports' counters, pages parsed again; each with its SQL."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweir.functions import dates, text
from tallyweir.operators import features, lifecycle, reports, resolve
from tallyweir.operators.history import canonical_id
from tallyweir.plans import register_queries as q
from tallyweir.session import cut, table
from tallyweir.sinks import exports
from tallyweir.sources import pages, reparse

NOW = datetime(2026, 7, 1)


def _escaped(c):
    """Text as markup; null as ''."""
    return F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def _slashed(c):
    return F.coalesce(F.date_format(dates.iso_date(c), "dd/MM/yyyy"), F.lit(""))


def _raw_pages(spark, d) -> DataFrame:
    """The tenders and their companies as the pages they would come from: a listing card and a tender page of each."""
    t = q._tender(spark, d)
    c = q._companies(spark, d).select("tender_id", "role", "seq", "name", "cr_number", F.col("value").cast("decimal(20,4)").alias("value"))
    line = F.concat(F.lit("<tr><td>"), _escaped(F.col("name")), F.lit("</td><td>"), _escaped(F.col("cr_number")), F.lit("</td><td>"), F.coalesce(F.col("value").cast("string"), F.lit("")), F.lit("</td></tr>"))
    body = lambda role: F.array_join(F.transform(F.array_sort(F.filter("rows", lambda r: r["role"] == role)), lambda r: r["line"]), "")
    grid = lambda heading, head, role: F.concat(F.lit(f"<h3>{heading} :</h3><table><thead><tr><th>Company name</th><th>Commercial Registration Number</th><th>{head}</th></tr></thead><tbody>"), body(role), F.lit("</tbody></table>"))
    rows = c.groupBy("tender_id").agg(F.collect_list(F.struct("seq", "role", line.alias("line"))).alias("rows"))  # one tender's companies
    span = lambda mark, value: F.concat(F.lit(f"<span id='{mark}'>"), value, F.lit("</span>"))
    detail = t.join(rows, "tender_id", "left").withColumn("rows", F.coalesce("rows", F.array().cast("array<struct<seq:int,role:string,line:string>>")))
    spans = [span("lbl_num", _escaped(F.col("tender_number"))), span("lblRequesterEntity", _escaped(F.col("ministry"))), span("lblAwardedDate", _slashed(F.col("awarded_date"))), span("lbl_award", F.coalesce(F.concat(F.format_number("awarded_amount", 2), F.lit(" QAR")), F.lit("")))]
    detail = detail.select(F.lit("detail").alias("kind"), F.col("tender_id").alias("key"), F.concat(*spans, grid("Awarded Companies", "Approved Value", "awarded"), grid("Financially opened", "Proposal amount", "bidder")).alias("html"))
    card = F.concat(F.lit("<div class='row custom-cards'><div class='col-header'><span class='card-label'>"), _escaped(F.col("tender_number")), F.lit("</span></div><a href='/x/TenderDetails/"), F.col("tender_id"), F.lit("'>"), _escaped(F.col("subject")), F.lit("</a><div class='cards-row'><span class='card-label'>Closing Date :</span><span class='card-title'>"), _slashed(F.col("closing_date")), F.lit("</span></div></div>"))
    kind = F.when(F.col("family") == "bid", F.concat(F.lit("bids-"), F.when(F.col("state") == "published", "available").otherwise(F.col("state")))).otherwise(F.when(F.col("state") == "published", "available").otherwise(F.col("state")))
    # A listing page holds the cards of one section whose tender_id has the same last two digits.
    listing = t.groupBy(kind.alias("key"), F.substring("tender_id", -2, 2).alias("page")).agg(F.array_join(F.collect_list(card), "").alias("html"))
    both = detail.unionByName(listing.select(F.lit("listing").alias("kind"), "key", "html", "page"), allowMissingColumns=True)
    return both.withColumn("fetched_at", F.lit("2026-07-01")).select("kind", "key", "html", "fetched_at", "page")


def _reparsed(spark, d, name: str) -> DataFrame:
    raw = _raw_pages(spark, d)
    if name == "company":
        return reparse.reparse(raw.where("kind = 'detail'").drop("page"))["company"].select("tender_id", "role", "name", "value")
    return reparse.reparse(raw.where("kind = 'detail'").drop("page"))["tender"].select("tender_id", "tender_number", "ministry", "awarded_date", F.round("awarded_amount", 2).alias("awarded_amount"))


def _cards(spark, d) -> DataFrame:
    return pages.read_listings(_raw_pages(spark, d).where("kind = 'listing'").select("key", "html")).select("tender_id", "tender_number", "subject", "closing_date", "family", "state")


def _passes(spark, d) -> tuple[DataFrame, DataFrame]:
    """The readings of the listing as those of a register: a finished sweep is a complete pass, an unfinished one none."""
    sweep = table(spark, d, "sweep").select("sweep_no", "sweep_date", "finished")
    log = table(spark, d, "listing_snapshot").join(sweep, "sweep_date").select(canonical_id(F.col("id")).alias("profile_number"), F.when(F.col("finished"), F.col("sweep_no")).alias("pass_id"), "read_at", "name")
    return log, sweep.where("finished").select(F.col("sweep_no").alias("pass_id"), F.col("sweep_date").alias("finished_at"))


def _upsert_rules(spark, d) -> DataFrame:
    log = table(spark, d, "tender").select("tender_id", "family", "state", "subject", "parsed_at")
    return lifecycle.upsert_fold(log, "tender_id", ["parsed_at"], ("family",), ("parsed_at",), {"state": text.state_rank(F.col("state"))}).select("tender_id", "family", "state", F.unix_seconds("parsed_at").alias("parsed_at"))


def _sweep(spark, d) -> DataFrame:
    a = table(spark, d, "record_attribute").where("entity_name = 'account'")
    last = a.agg(F.max("page_no")).first()[0]
    return lifecycle.sweep_rows(a.select("page_no", "record_id", (F.col("page_no") < F.lit(last)).alias("more")), "page_no", "record_id", "more")


def _statistics(spark, d) -> DataFrame:
    docs = table(spark, d, "documents")
    pages = docs.select(F.when(F.col("source") == "notice", "listing").otherwise("detail").alias("kind"))
    register = table(spark, d, "classified_company").distinct().withColumn("delisted_at", F.when(F.col("certificate_end") < "2026-01-01", F.col("certificate_end")))
    ta = register.select(F.explode("activities").alias("a"))
    return reports.store_statistics(q._tender(spark, d), q._companies(spark, d), register, pages, q._seen(spark, d), ta, q._matches(spark, d), q._listed(spark, d), docs.where("text is null"), table(spark, d, "sweep").where("finished").select(F.col("sweep_date").alias("finished_at")))


def _matched_numbers(spark, d) -> DataFrame:
    return q._customers(spark, d).select("customer_id", text.cr_root(F.col("cr_number")).alias("matched_cr"))


ARABIC = "select name_ar as name from customers where name_ar is not null union select name from classified_company"


def _arabic_names(spark, d) -> DataFrame:
    names = table(spark, d, "customers").select(F.col("name_ar").alias("name")).unionByName(table(spark, d, "classified_company").select("name")).distinct().where(text.is_arabic(F.col("name")))
    return names.select("name", text.normalize_arabic(F.col("name")).alias("norm"), text.key_of(text.normalize_arabic(F.col("name"))).alias("key"), text.fold_arabic(F.col("name")).alias("folded"))


QUERIES = {
    "st2_upsert_rules": _upsert_rules,
    "st4_register_passes": lambda s, d: lifecycle.register_upsert(*_passes(s, d), "profile_number", ["read_at"]).select("profile_number", "last_pass", "missed", "delisted_at"),
    "st17_days_since_run": lambda s, d: lifecycle.days_since_last_run(table(s, d, "sweep").select(F.col("sweep_no").alias("run_id"), F.lit("sweep").alias("command"), F.col("sweep_date").alias("started_at")), NOW, "sweep"),
    "st20_reparsed_tenders": lambda s, d: _reparsed(s, d, "tender"),
    "st20_reparsed_companies": lambda s, d: _reparsed(s, d, "company"),
    "st21_sweep_rows": _sweep,
    "htm1_listing_cards": _cards,
    "ag9_cohort_scores": lambda s, d: reports.cohort_scores(features.distinct_scores(table(s, d, "score_observation")), q._industries(s, d), F.lit(q.AT)),
    "ag12_store_statistics": _statistics,
    "jn15_register_of_matches": lambda s, d: reports.register_of_matches(_matched_numbers(s, d), table(s, d, "classified_company"), "customer_id").select("customer_id", "profile_number", "name"),
    "str4_arabic_names": _arabic_names,
    "snk2_awards": lambda s, d: exports.awards(q._companies(s, d), q._tender(s, d)).select("tender_id", "role", "seq", "name", "family", "state", "awarded_date", "ministry", "awarded_amount"),
}

RANK = "CASE state WHEN 'future' THEN 0 WHEN 'published' THEN 1 WHEN 'closed' THEN 2 WHEN 'technical' THEN 3 WHEN 'financial' THEN 4 WHEN 'awarded' THEN 5 WHEN 'cancelled' THEN 6 ELSE -1 END"
KEY = "regexp_replace(lower(trim(id)), '[{}]', '', 'g')"
#: folding, words to drop and articles of Arabic names, as in the specification
FOLD = "regexp_replace(regexp_replace(regexp_replace(translate(regexp_replace({c}, '[\\x{{610}}-\\x{{61a}}\\x{{64b}}-\\x{{65f}}\\x{{670}}\\x{{6d6}}-\\x{{6ed}}]', '', 'g'), 'أإآٱىئةؤیک٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹ـ', 'ااااييهويك01234567890123456789'), '([\\x{{600}}-\\x{{6ff}}])\\.([\\x{{600}}-\\x{{6ff}}])', '\\1\\2', 'g'), '([\\x{{600}}-\\x{{6ff}}])\\.([\\x{{600}}-\\x{{6ff}}])', '\\1\\2', 'g'), '[^ء-ي0-9 ]+', ' ', 'g')"
DROP = "['ذمم', 'شمق', 'شمعق', 'ششو', 'شمخ', 'شمع', 'شركه', 'موسسه', 'مجموعه', 'ذات', 'مسووليه', 'محدوده', 'قابضه', 'القابضه', 'و']"

ORACLES = {
    "st2_upsert_rules": f"SELECT tender_id, arg_min(family, struct_pack(a := parsed_at, b := family)) FILTER (WHERE family IS NOT NULL) AS family, arg_max(state, struct_pack(r := {RANK}, a := parsed_at, b := state)) FILTER (WHERE state IS NOT NULL) AS state, CAST(floor(epoch(max(parsed_at))) AS BIGINT) AS parsed_at FROM tender GROUP BY tender_id",
    "st4_register_passes": f"""WITH p AS (SELECT sweep_no, sweep_date FROM sweep WHERE finished), r AS (SELECT {KEY} AS k, max(p.sweep_no) AS last_pass FROM listing_snapshot s LEFT JOIN p USING (sweep_date) GROUP BY 1),
x AS (SELECT k, last_pass, list_sort(list(struct_pack(n := p.sweep_no, d := p.sweep_date)) FILTER (WHERE p.sweep_no > coalesce(last_pass, -1))) AS a FROM r CROSS JOIN p GROUP BY ALL)
SELECT k AS profile_number, last_pass, CAST(least(coalesce(len(a), 0), 2) AS INT) AS missed, a[2].d AS delisted_at FROM x""",
    "st17_days_since_run": "SELECT greatest(coalesce(date_diff('second', CAST(max(sweep_date) AS TIMESTAMP), TIMESTAMP '2026-07-01') / 86400.0, 1.0), 0.0)::DOUBLE AS days FROM sweep",
    "st20_reparsed_tenders": f"""WITH {q.T} SELECT tender_id, nullif(trim(regexp_replace(tender_number, '\\s+', ' ', 'g')), '') AS tender_number, nullif(trim(regexp_replace(ministry, '\\s+', ' ', 'g')), '') AS ministry, CAST({q.ISO.format(c='awarded_date')} AS VARCHAR) AS awarded_date, round(awarded_amount, 2) AS awarded_amount FROM t
WHERE tender_number <> '' OR ministry <> '' OR awarded_amount IS NOT NULL OR tender_id IN (SELECT tender_id FROM tender_company WHERE trim(name) <> '')""",
    "st20_reparsed_companies": f"WITH {q.T}, {q.C} SELECT tender_id, role, trim(regexp_replace(name, '\\s+', ' ', 'g')) AS name, CAST(CAST(value AS DECIMAL(20, 4)) AS DOUBLE) AS value FROM c WHERE trim(name) <> '' AND tender_id IN (SELECT tender_id FROM t)",
    "st21_sweep_rows": """WITH a AS (SELECT page_no, record_id FROM record_attribute WHERE entity_name = 'account'), f AS (SELECT record_id, min(page_no) AS page_no FROM a WHERE record_id IS NOT NULL GROUP BY 1),
p AS (SELECT DISTINCT page_no, page_no < (SELECT max(page_no) FROM a) AS more FROM a), s AS (SELECT min(page_no) AS stop FROM p WHERE NOT more OR page_no NOT IN (SELECT page_no FROM f)) SELECT record_id, page_no FROM f, s WHERE page_no <= stop""",
    "htm1_listing_cards": f"WITH {q.T} SELECT tender_id, nullif(trim(regexp_replace(tender_number, '\\s+', ' ', 'g')), '') AS tender_number, nullif(trim(regexp_replace(subject, '\\s+', ' ', 'g')), '') AS subject, CAST({q.ISO.format(c='closing_date')} AS VARCHAR) AS closing_date, family, state FROM t",
    "ag9_cohort_scores": f"WITH {q.O}, {q.IND} SELECT industry, company_id, score FROM (SELECT company_id, score FROM o WHERE day <= DATE '2026-03-31' QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY day DESC, posted_at DESC, id DESC) = 1) JOIN ind USING (company_id) WHERE industry IS NOT NULL",
    "jn15_register_of_matches": f"SELECT customer_id, min(struct_pack(p := profile_number, n := c.name)).p AS profile_number, min(struct_pack(p := profile_number, n := c.name)).n AS name FROM (SELECT customer_id, {q.ROOT.format(c='cr_number')} AS r FROM customers) k JOIN classified_company c ON c.cr_root = k.r GROUP BY customer_id",
    "str4_arabic_names": f"""WITH n AS (SELECT DISTINCT name FROM ({ARABIC}) WHERE len(regexp_extract_all(name, '[ء-يٱ-ۓ]')) >= 2), f AS (SELECT name, {FOLD.format(c='name')} AS folded FROM n),
w AS (SELECT name, folded, list_filter(list_transform(list_filter(string_split_regex(folded, ' +'), lambda x: x <> '' AND NOT list_contains({DROP}, x)), lambda x: regexp_replace(x, '^(?:وال|بال|كال|فال|لل|ال)(..)', '\\1')), lambda x: NOT list_contains({DROP}, x)) AS k FROM f)
SELECT name, array_to_string(k, ' ') AS norm, array_to_string(list_sort(list_distinct(k)), ' ') AS key, folded FROM w""",
    "snk2_awards": f"WITH {q.T}, {q.C} SELECT tender_id, role, seq, name, family, state, awarded_date, ministry, awarded_amount FROM c JOIN t USING (tender_id)",
}
ORACLES["ag12_store_statistics"] = f"""WITH {q.MATCHES}, {q.L}, {q.SEEN}, reg AS (SELECT DISTINCT * FROM classified_company)
SELECT * FROM ({q.ORACLES["ag12_store_counts"].removeprefix(f"WITH {q.T}, {q.C} ")}),
(SELECT count(*) FILTER (WHERE source = 'notice') AS listing_pages, count(*) FILTER (WHERE source IS DISTINCT FROM 'notice') AS detail_pages, count(*) FILTER (WHERE text IS NULL) AS pages_awaiting_retry FROM documents),
(SELECT count(*) FILTER (WHERE live = 0) AS listed_nowhere FROM (SELECT tender_id, count(*) FILTER (WHERE gone_at IS NULL) AS live FROM seen GROUP BY 1)),
(SELECT count(*) FILTER (WHERE certificate_end < '2026-01-01') AS delisted, coalesce(sum(len(activities)), 0)::BIGINT AS company_activities, coalesce(sum(len(activities)), 0)::BIGINT AS tender_activities FROM reg),
(SELECT count(*) AS matches, count(*) FILTER (WHERE method IN ('name_fuzzy', 'name_translit')) AS matches_for_review FROM m), (SELECT count(*) AS feature_rows FROM l), (SELECT max(sweep_date) AS last_run FROM sweep WHERE finished)"""


def _names_sql(c: str) -> str:
    """A name's comparison form in DuckDB: by its script; '|' stands for the marks and blanks between initials while they are looked at."""
    noise = f"lower(strip_accents({c}))"
    for pattern in text.NOISE:
        noise = f"regexp_replace({noise}, '{pattern}', ' ', 'g')"
    dotted = f"replace(regexp_replace(regexp_replace({noise}, '\\b([a-z])\\.', '\\1|', 'g'), '\\|([a-z])\\b', '\\1', 'g'), '|', '.')"
    bare = f"regexp_replace({dotted}, '[^a-z0-9 ]+', ' ', 'g')"
    run = f"replace(regexp_replace(regexp_replace({bare}, '\\b([a-z]) ', '\\1|', 'g'), '\\|([a-z])\\b', '\\1', 'g'), '|', ' ')"
    short = ", ".join(f"'{k}': '{v}'" for k, v in text.ABBREVIATIONS.items())
    full = f"array_to_string(list_transform(list_filter(string_split({run}, ' '), lambda w: w <> ''), lambda w: coalesce(MAP {{{short}}}[w], w)), ' ')"
    legal = f"regexp_replace({full}, '(?:(?:^| )(?:{'|'.join(text.LEGAL)}))+$', '')"
    latin = f"array_to_string(list_filter(string_split({legal}, ' '), lambda w: w <> '' AND NOT list_contains({text.STOPWORDS}, w)), ' ')"
    own = f"list_filter(list_transform(list_filter(string_split_regex({FOLD.format(c=c)}, ' +'), lambda x: x <> '' AND NOT list_contains({DROP}, x)), lambda x: regexp_replace(x, '^(?:وال|بال|كال|فال|لل|ال)(..)', '\\1')), lambda x: NOT list_contains({DROP}, x))"
    return f"CASE WHEN arabic THEN array_to_string({own}, ' ') ELSE {latin} END"


SORTED = "array_to_string(list_sort({d}(string_split({c}, ' '))), ' ')"
#: the longest common subsequence of a and b, row by row
COMMON = """list_last(list_reduce(string_split(b, ''), lambda r, c: list_reduce(range(1, len(a) + 1), lambda n, j: list_append(n, CASE WHEN a[j] = c THEN r[j] + 1 ELSE greatest(r[j + 1], n[j]) END), [0::BIGINT]), list_resize([0::BIGINT], len(a) + 1, 0::BIGINT)))"""
LADDER = f"""WITH l AS (SELECT DISTINCT customer_id, {q.ROOT.format(c='cr_number')} AS root, unnest([name, name_ar]) AS name FROM customers), r AS (SELECT DISTINCT profile_number, {q.ROOT.format(c='cr_number')} AS root, name FROM classified_company),
s AS (SELECT name, len(regexp_extract_all(name, '[ء-يٱ-ۓ]')) >= 2 AS arabic FROM (SELECT name FROM l UNION SELECT name FROM r) WHERE name IS NOT NULL), n AS (SELECT name, arabic, {_names_sql('name')} AS norm FROM s),
ln AS (SELECT DISTINCT customer_id, arabic, norm, {SORTED.format(d='list_distinct', c='norm')} AS canon FROM l JOIN n USING (name) WHERE norm <> ''), rn AS (SELECT DISTINCT profile_number, arabic, norm, {SORTED.format(d='list_distinct', c='norm')} AS canon FROM r JOIN n USING (name) WHERE norm <> ''),
held AS (SELECT DISTINCT arabic, norm, unnest(string_split(norm, ' ')) AS word FROM rn), df AS (SELECT arabic, word, count(*) AS df FROM held GROUP BY ALL),
rare AS (SELECT arabic, query, word FROM (SELECT DISTINCT arabic, norm AS query, unnest(string_split(norm, ' ')) AS word FROM ln) JOIN df USING (arabic, word) QUALIFY row_number() OVER (PARTITION BY arabic, query ORDER BY df, word) <= 2),
near AS (SELECT DISTINCT arabic, query, norm, {SORTED.format(d='', c='query')} AS a, {SORTED.format(d='', c='norm')} AS b FROM rare JOIN held USING (arabic, word) WHERE query <> norm AND 2 * least(len(query), len(norm)) >= 0.92 * (len(query) + len(norm)) - 1e-9),
score AS (SELECT arabic, query, norm, 2.0 * {COMMON} / (len(a) + len(b)) AS score FROM near),
found AS (SELECT customer_id, profile_number, 0 AS rank, 1.0::DOUBLE AS score FROM (SELECT DISTINCT customer_id, root FROM l) JOIN (SELECT DISTINCT profile_number, root FROM r) USING (root)
  UNION ALL SELECT customer_id, profile_number, 1, 1.0 FROM ln JOIN rn USING (norm) UNION ALL SELECT customer_id, profile_number, 1, 0.99 FROM ln JOIN rn USING (canon)
  UNION ALL SELECT customer_id, profile_number, 2, round(score, 3) FROM ln JOIN score ON ln.norm = score.query JOIN rn ON rn.norm = score.norm WHERE score >= 0.92),
best AS (SELECT customer_id, profile_number, min(struct_pack(r := rank, s := -score)) AS b FROM found GROUP BY ALL)"""


def _names_ladder(spark, d) -> DataFrame:
    """The ladder without its transliterating rung."""
    return resolve.match(q._customers(spark, d), table(spark, d, "classified_company"), ["customer_id"], ["profile_number"], ["name", "name_ar"], ["name"], translit=1.0)


QUERIES |= {
    "jn11_ladder_names": _names_ladder,
    "ag10_names_summary": lambda s, d: resolve.match_summary(_names_ladder(s, d), "customer_id"),
    "sim1_similar_names": lambda s, d: _similar(s, d),
}


def _similar(spark, d) -> DataFrame:
    """The score, whatever it is down to 0.3, of each customer's name with the register's names that hold one of its two rarest words."""
    names = lambda t: cut(table(spark, d, t).where("name is not null").select(text.is_arabic(F.col("name")).alias("arabic"), text.normalize_name(F.col("name")).alias("norm")).where("norm <> ''").distinct())
    return resolve.fuzzy_pairs(names("customers"), names("classified_company"), 0.3)


ORACLES |= {
    "jn11_ladder_names": f"{LADDER} SELECT customer_id, profile_number, CASE b.r WHEN 0 THEN 'cr' WHEN 1 THEN 'name_exact' ELSE 'name_fuzzy' END AS method, -b.s AS score, CASE WHEN b.r >= 2 THEN 1 ELSE 0 END::INT AS needs_review FROM best",
    "ag10_names_summary": f"{LADDER} SELECT count(*) AS matches, count(DISTINCT customer_id) AS entities, count(*) FILTER (WHERE b.r = 0) AS cr, count(*) FILTER (WHERE b.r = 1) AS name_exact, count(*) FILTER (WHERE b.r = 2) AS name_fuzzy, 0::BIGINT AS name_translit, count(*) FILTER (WHERE b.r >= 2) AS needs_review FROM best",
    "sim1_similar_names": f"""WITH s AS (SELECT DISTINCT side, name, len(regexp_extract_all(name, '[ء-يٱ-ۓ]')) >= 2 AS arabic FROM (SELECT 'c' AS side, name FROM customers UNION ALL SELECT 'r', name FROM classified_company) WHERE name IS NOT NULL),
n AS (SELECT DISTINCT side, arabic, {_names_sql('name')} AS norm FROM s), h AS (SELECT side, arabic, norm, unnest(list_distinct(string_split(norm, ' '))) AS word FROM n WHERE norm <> ''), df AS (SELECT arabic, word, count(*) AS df FROM h WHERE side = 'r' GROUP BY ALL),
rare AS (SELECT arabic, norm AS query, word FROM h JOIN df USING (arabic, word) WHERE side = 'c' QUALIFY row_number() OVER (PARTITION BY arabic, norm ORDER BY df, word) <= 2),
p AS (SELECT DISTINCT query, norm, {SORTED.format(d='', c='query')} AS a, {SORTED.format(d='', c='norm')} AS b FROM rare JOIN h USING (arabic, word) WHERE side = 'r' AND query <> norm),
x AS (SELECT query, norm, 2.0 * {COMMON} / (len(a) + len(b)) AS score FROM p) SELECT query, norm, round(score, 3) AS score FROM x WHERE score >= 0.3""",
}
