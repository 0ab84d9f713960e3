"""Records of JSON grid pages with polymorphic attribute values, and the grids' configuration inside pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweir.functions import text
from tallyweir.functions.timestamps import Candidate, normalise

ATTRIBUTE = "struct<Name:string,Type:string,Value:string,DisplayValue:string,FormattedValue:string>"
PAGE = f"struct<MoreRecords:boolean,Records:array<struct<Id:string,EntityName:string,Attributes:array<{ATTRIBUTE}>>>>"
#: fixed values: attribute names of the portal
STATUS = "a_3455de4d6335ec118c64000d3a3a4aee.statuscode"
HISTORY_RELATION, GOODS_RELATION = "icv_account_icv_scorecardhistory_Supplier", "icv_icv_suppliergoodsandservices_Supplier_acc"


def grid_pages(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """more, record of each record of each page (JSON text); a Value that is an object or number arrives as its JSON text."""
    return payloads.select(F.from_json(column, PAGE).alias("p")).select(F.coalesce("p.MoreRecords", F.lit(False)).alias("more"), F.explode("p.Records").alias("record"))


def slim(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """The payload with only the five attribute fields, for storing."""
    return payloads.withColumn(column, F.to_json(F.from_json(column, PAGE)))


def attribute(record: Column, name: str) -> Column:
    """The attribute's struct; null if absent (absent is not empty). Of a repeated name the last counts."""
    return F.try_element_at(F.filter(record["Attributes"], lambda a: a["Name"] == name), F.lit(-1))


def _full(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def label(record: Column, name: str) -> Column:
    """The first of display, formatted and value that is not blank, trimmed; of a lookup its Name."""
    a = attribute(record, name)
    value = F.when(a["Value"].startswith("{"), F.get_json_object(a["Value"], "$.Name")).otherwise(a["Value"])
    return F.coalesce(_full(a["DisplayValue"]), _full(a["FormattedValue"]), _full(value))


def number(record: Column, name: str) -> Column:
    a = attribute(record, name)
    plain = lambda c: F.replace(F.trim(c), F.lit(","), F.lit("")).try_cast("double")
    return F.coalesce(a["Value"].try_cast("double"), plain(a["DisplayValue"]), plain(a["FormattedValue"]))


def boolean(record: Column, name: str) -> Column:
    a = attribute(record, name)
    said = F.lower(F.coalesce(F.when(a["Value"].isin("true", "false"), a["Value"]), _full(a["DisplayValue"]), _full(a["FormattedValue"])))
    return F.when(said.isin("yes", "true", "1"), True).when(said.isin("no", "false", "0"), False)


def option(record: Column, name: str) -> Column:
    return F.get_json_object(attribute(record, name)["Value"], "$.Value").try_cast("bigint")


def _moments(rows: DataFrame, name: str, out: str) -> DataFrame:
    """Adds ``out``: the attribute as UTC milliseconds."""
    a = attribute(F.col("record"), name)
    wide = rows.select("*", a["Value"].alias("__value"), a["DisplayValue"].alias("__display"), a["FormattedValue"].alias("__formatted"))
    return normalise(wide, [Candidate("__value"), Candidate("__display"), Candidate("__formatted")], out=out).drop("__value", "__display", "__formatted")


def supplier_rows(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """A row per listed supplier; records without id or name are left out."""
    r = F.col("record")
    rows = _moments(grid_pages(payloads, column), "icv_icvscoreexpirydate", "ms")
    cr = label(r, "icv_commercialregistrationnumber")
    return rows.select(
        F.lower(F.coalesce(r["Id"], label(r, "accountid"))).alias("id"), cr.alias("cr_number"), text.cr_root(cr, qfc=True).alias("cr_root"), label(r, "name").alias("name"), text.normalize_name(label(r, "name")).alias("name_norm"), label(r, "icv_mainactivity").alias("industry"),
        number(r, "icv_totalscore").alias("total_score"), label(r, STATUS).alias("status"), option(r, STATUS).alias("status_code"), label(r, "icv_latestcertificate").alias("certificate_no"),
        F.date_format(F.timestamp_millis("ms"), "yyyy-MM-dd").alias("expiry_date"), boolean(r, "icv_ismanufacturer").alias("manufacturer"),
    ).where("id is not null and name is not null")


def history_rows(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """A row per published score change; records without id, time or score are left out."""
    r = F.col("record")
    at = F.timestamp_millis("ms")
    rows = _moments(grid_pages(payloads, column), "icv_posteddate", "ms").where("ms is not null")
    return rows.select(
        F.lower(F.coalesce(r["Id"], label(r, "icv_scorecardhistoryid"))).alias("id"), F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("posted_at"), F.date_format(at, "yyyy-MM-dd").alias("posted_date"), number(r, "icv_icvscorepercent").alias("score"),
        number(r, "icv_scoredifference").alias("change"), label(r, "statuscode").alias("reason"), option(r, "statuscode").alias("reason_code"), boolean(r, "statecode").alias("active"),
    ).where("id is not null and score is not null")


def goods_rows(payloads: DataFrame, column: str = "payload") -> DataFrame:
    r = F.col("record")
    names = {"service_type": "icv_servicetype", "service_type_ar": "icv_servicetypearabicname", "category": "icv_goodscategory", "sub_category": "icv_goodssubcategory", "category_ar": "icv_goodscategoryarabicname", "sub_category_ar": "icv_goodssubcategoryarabicname"}
    return grid_pages(payloads, column).select(F.lower(r["Id"]).alias("id"), *(label(r, n).alias(c) for c, n in names.items())).where("id is not null")


LAYOUT = "array<struct<Id:string,Base64SecureConfiguration:string,SortExpression:string>>"


def grid_configs(pages: DataFrame, column: str = "html") -> DataFrame:
    """get_url, secure_config, sort, relationship, view_id of every entity grid of each page, in order (pos), with the page's other columns."""
    tags = F.filter(F.regexp_extract_all(column, F.lit(r"(?s)<div\b([^>]*)>"), 1), lambda t: t.rlike(r"class=[\"'][^\"']*\bentity-grid\b") & t.rlike("data-view-layouts="))
    grids = pages.select(*(c for c in pages.columns if c != column), F.posexplode(tags).alias("pos", "tag"))
    value = lambda name: F.regexp_extract("tag", rf"\b{name}=[\"']([^\"']*)[\"']", 1)
    layouts = F.from_json(F.try_to_binary(value("data-view-layouts"), F.lit("base64")).cast("string"), LAYOUT)
    g = grids.withColumn("layouts", layouts).withColumn("selected", value("data-selected-view"))
    chosen = F.coalesce(F.get(F.filter("layouts", lambda v: v["Id"] == F.col("selected")), F.lit(0)), F.get("layouts", F.lit(0)))
    g = g.withColumn("layout", chosen).where("layout.Base64SecureConfiguration is not null")
    return g.select(*(c for c in pages.columns if c != column), "pos", value("data-get-url").alias("get_url"), F.col("layout.Base64SecureConfiguration").alias("secure_config"), F.coalesce("layout.SortExpression", F.lit("")).alias("sort"), value("data-ref-rel").alias("relationship"), F.coalesce(F.nullif("selected", F.lit("")), F.col("layout.Id")).alias("view_id"))


def verification_token(c: Column) -> Column:
    """The token of a page; an error where there is none, as the page is then not the portal's."""
    tag = F.regexp_extract(c, r"(?s)<input\b[^>]*\bname=[\"']__RequestVerificationToken[\"'][^>]*>", 0)
    token = F.nullif(F.regexp_extract(tag, r"\bvalue=[\"']([^\"']+)[\"']", 1), F.lit(""))
    return F.coalesce(token, F.raise_error(F.lit("no verification token on the page")))
