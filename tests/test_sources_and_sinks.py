import base64
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from tallyweir.sinks import exports
from tallyweir.sources import customers, pages, records


def write(tmp_path, name, data):
    p = tmp_path / name
    p.write_bytes(data)
    return str(p)


@pytest.mark.parametrize(
    "data, encoding",
    [
        ("customer_id,name,cr_number,name_ar\n1,Gulf,5,\n,,,\n2,شركة الريان,,\n".encode("utf-8-sig"), "utf-8"),
        ("CIF No;Company Name;C.R. No.\n1;Gulf;5\n2;شركة الريان;\n".encode("cp1256"), "windows-1256"),
        (" , \n\nid\tname\tcr\n1\tGulf\t5.0\n2\tشركة الريان\t\n".encode(), "utf-8"),
        (b"id|name|cr\n1|Gulf|5\n2|\xd8\xb4\xd8\xb1\xd9\x83\xd8\xa9 \xd8\xa7\xd9\x84\xd8\xb1\xd9\x8a\xd8\xa7\xd9\x86|\n", "utf-8"),
    ],
)
def test_customer_files(spark, tmp_path, data, encoding):
    rows, how = customers.load_customers(spark, write(tmp_path, "c.csv", data))
    assert how["encoding"] == encoding
    got = sorted(map(tuple, rows.collect()))
    assert got == [("1", "Gulf", "5", None), ("2", "شركة الريان", None, "شركة الريان")]
    r = customers.load_report(rows).first()
    assert (r.rows, r.with_cr, r.english_only, r.arabic_only) == (2, 1, 0, 1)


def test_encodings_and_headers():
    assert customers.detect_encoding("Café".encode("cp1252")) == "windows-1252"
    assert customers.detect_encoding("é".encode() * 40 + b"\xff " + b"a" * 9) == "utf-8"
    assert customers.map_headers(["Client ID", "CIF No", "customer_id", None]) == {"customer_id": 2}


def test_no_usable_column(spark, tmp_path):
    with pytest.raises(ValueError, match="colour"):
        customers.load_customers(spark, write(tmp_path, "c.csv", b"colour,size\n1,2\n"))


def test_workbook(spark, tmp_path):
    path = tmp_path / "c.xlsx"
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="S" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="r1" Target="worksheets/s.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {main}><si><t>name</t></si><si><t>cr</t></si><si><t>Gulf</t></si></sst>")
        z.writestr("xl/worksheets/s.xml", f'<worksheet {main}><sheetData><row/><row><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c></row><row><c r="A2" t="s"><v>2</v></c><c r="C2"><v>5.0</v></c></row></sheetData></worksheet>')
    rows, _ = customers.load_customers(spark, str(path))
    assert [tuple(r) for r in rows.collect()] == [("Gulf", "Gulf", "5", None)]


def test_counterparties(spark, tmp_path):
    rows, _ = customers.load_counterparties(spark, write(tmp_path, "p.csv", b"CIF,counterparty,side,position,turnover\n1,Gulf,vendor,2.0,\"1,000\"\n1,,buyer,1,5\n"))
    assert [tuple(r) for r in rows.collect()] == [("1", "Gulf", "supplier", 2, 1000.0, None)]


DETAIL = """<span id='lbl_num'>7/2026</span><span id=lblRequesterEntity> Water  Yard</span><span id="lblAwardedDate">21/06/2026</span><span id='lbl_award'>1,000.5 QAR</span>
<h3>Awarded Companies:</h3><table><thead><tr><th>Company name</th><th>Commercial Registration Number</th><th>Approved Value</th></tr></thead><tbody><tr><td>Gulf <b>Co</b></td><td>29309/1 | 77</td><td>1,000.5</td></tr><tr><td></td><td>1</td><td>2</td></tr></tbody></table>
<h4>Technically opened</h4><table><tr><th>Company name</th><th>Commercial Registration Number</th></tr><tr><td>Gulf Co</td><td>29309</td></tr><tr><td>Doha</td><td></td></tr></table>"""


def test_tender_pages(spark):
    df = spark.createDataFrame([("1", DETAIL), ("2", "<html>home</html>"), ("3", None)], "key string, html string")
    got = [tuple(r)[:8] for r in pages.read_companies(df).orderBy("role", "seq").collect()]
    assert got == [("1", "awarded", 0, "awarded", "Gulf Co", "29309/1", "77", 1000.5), ("1", "bidder", 0, "technical", "Gulf Co", "29309", None, None), ("1", "bidder", 1, "technical", "Doha", None, None, None)]
    t = pages.read_tenders(df).collect()
    assert [(r.tender_id, r.tender_number, r.ministry, r.awarded_date, r.awarded_amount) for r in t] == [("1", "7/2026", "Water Yard", "2026-06-21", 1000.5)]


def test_listing_terms_and_register(spark):
    card = "<div class='row custom-cards'><div class='col-header'><span class='card-label'>9/2026</span></div><a href='/x/TenderDetails/55'>Pipes</a><a href='/x/TenderCompaniesDetails/55'></a><div class='cards-row'><span class='card-label'>Award Date :</span><span class='card-title'>01/02/2026</span></div></div><div class='row custom-cards'>none</div>"
    got = pages.read_listings(spark.createDataFrame([("awarded", card)], "key string, html string")).collect()
    assert [(r.tender_id, r.tender_number, r.subject, r.awarded_date, r.family, r.state) for r in got] == [("55", "9/2026", "Pipes", "2026-02-01", "tender", "awarded")]
    terms = "<table><tr><th>Tender number</th><th>Tender Bond</th></tr><tr><td>9</td><td>5,000</td></tr></table><table><tr><th>Name</th><th>Value</th></tr><tr><th>Contract Duration</th><td>12</td></tr></table><table><tr><th>Activity code</th><th>Activity name</th></tr><tr><td>4.1</td><td>Pumps</td></tr></table>"
    df = spark.createDataFrame([("9", terms)], "key string, html string")
    t = pages.read_terms(df).first()
    assert (t.tender_number, t.tender_bond, t.contract_duration) == ("9", 5000.0, "12") and tuple(pages.read_activities(df).first()) == ("9", "4.1", "Pumps")
    register = "<table><tr><th>Profile number</th><th>Company name</th><th>Commercial Registration Number</th><th>Company size</th></tr><tr><td>P1</td><td>Gulf</td><td>5 | 6</td><td>Small</td><td><a href='javascript:openCompanyDataModel(3)'>x</a></td></tr></table><div id='CompanyData-3'><div class='alert alert-info'>Class A - Certificate end date : 01/02/2027</div><table><tr><th>Activity code</th><th>Activity name</th><th>Classification grade</th></tr><tr><td>1</td><td>n</td><td>B</td></tr></table></div>"
    r = pages.read_register(spark.createDataFrame([("k", register)], "key string, html string")).first()
    assert (r.profile_number, r.cr_number, r.cr_secondary, r["size"], r.classification, r.certificate_end, r.activities[0].grade) == ("P1", "5", "6", "Small", "Class A", "2027-02-01", "B")


def test_json_records(spark):
    a = lambda n, v, d=None, f=None: {"Name": n, "Type": "t", "Value": v, "DisplayValue": d, "FormattedValue": f}
    page = {"MoreRecords": True, "Records": [{"Id": "AB", "EntityName": "account", "Attributes": [a("name", "Gulf Co", "Gulf Co "), a("icv_totalscore", 12.5), a(records.STATUS, {"Value": 100000002}, "Valid  "), a("icv_mainactivity", {"Id": "1", "Name": "Marine"}), a("icv_icvscoreexpirydate", "/Date(1842480000000)/"), a("icv_ismanufacturer", False)]}, {"Id": None, "Attributes": []}]}
    df = spark.createDataFrame([(json.dumps(page),), ("{}",), (None,)], "payload string")
    r = records.supplier_rows(df).collect()
    assert len(r) == 1 and (r[0].id, r[0].name, r[0].total_score, r[0].status, r[0].status_code, r[0].industry, r[0].expiry_date, r[0].manufacturer, r[0].cr_number) == ("ab", "Gulf Co", 12.5, "Valid", 100000002, "Marine", "2028-05-21", False, None)
    h = {"Records": [{"Id": "H1", "Attributes": [a("icv_posteddate", None, "2025-12-10T22:00:00+03:00"), a("icv_icvscorepercent", None, "1,5.5"), a("statuscode", {"Value": 3}, "Reissued  ")]}]}
    r = records.history_rows(spark.createDataFrame([(json.dumps(h),)], "payload string")).first()
    assert (r.id, r.posted_at, r.posted_date, r.score, r.reason, r.reason_code) == ("h1", "2025-12-10T19:00:00Z", "2025-12-10", 15.5, "Reissued", 3)
    assert "Extra" not in records.slim(spark.createDataFrame([(json.dumps(page | {"Extra": 1}),)], "payload string")).first().payload


def test_grid_configs_and_token(spark):
    layouts = base64.b64encode(json.dumps([{"Id": "v1", "Base64SecureConfiguration": "s1"}, {"Id": "v2", "Base64SecureConfiguration": "s2", "SortExpression": "n"}]).encode()).decode()
    html = f"<div class='x entity-grid' data-view-layouts='{layouts}' data-selected-view='v2' data-get-url='/g' data-ref-rel='{records.HISTORY_RELATION}'></div><div class='entity-grid' data-view-layouts='@@'></div><input name='__RequestVerificationToken' value='tok'>"
    df = spark.createDataFrame([("p", html)], "page string, html string")
    assert [(r.page, r.get_url, r.secure_config, r.sort, r.view_id) for r in records.grid_configs(df).collect()] == [("p", "/g", "s2", "n", "v2")]
    assert df.select(records.verification_token(F.col("html")).alias("t")).first().t == "tok"
    with pytest.raises(Exception, match="no verification token"):
        df.select(records.verification_token(F.lit("<p>")).alias("t")).collect()


def test_exports(spark, tmp_path):
    a, b = spark.createDataFrame([(1, "x")], "i int, s string"), spark.createDataFrame([(2, 0.5)], "i int, d double")
    exports.write_csv([a, b], str(tmp_path / "out"), one_file=True)
    data = next((tmp_path / "out").glob("*.csv")).read_bytes()
    assert data.decode().splitlines() == ["﻿i,s,d", "1,x,", "2,,0.5"]
    assert exports.pack({"tender": a, "customers": a, "match": a, "raw_page": a}, str(tmp_path / "pack")) == ["tender"]
    assert [p.name for p in (tmp_path / "pack").iterdir()] == ["tender"]
    with pytest.raises(ValueError):
        exports.export("none", {"none": lambda: a.limit(0)}, str(tmp_path / "n"))
    exports.rebuild(a, str(tmp_path / "r"))
    exports.rebuild(a, str(tmp_path / "r"))
    assert spark.read.parquet(str(tmp_path / "r")).count() == 1
    stored = spark.createDataFrame([("k", "abc"), ("k", "d"), ("l", None)], "kind string, html string")
    exports.store_pages(stored, str(tmp_path / "p"))
    assert sorted(map(tuple, exports.stored_sizes(spark.read.parquet(str(tmp_path / "p"))).collect())) == [("k", 2, 4), ("l", 1, None)]
    exports.compact(str(tmp_path / "p"), str(tmp_path / "q"), spark)
    assert spark.read.parquet(str(tmp_path / "q")).count() == 3
