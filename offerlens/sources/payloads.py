"""Provider payloads to offers. Payload columns follow the provider's JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlens.constants import MARKETPLACE_DOMAIN_MARK
from offerlens.functions.urls import normalize_company_name, pick_website, website_domain

_ITEM = "struct<id:int,value:string,key:string>"
_SHARED = f"""id string, title string, city string, link string, province {_ITEM}, category {_ITEM},
    subcategory {_ITEM}, contractType {_ITEM}, salaryMin {_ITEM}, salaryMax {_ITEM},
    salaryPeriod {_ITEM}, salaryDescription string, minPay {_ITEM}, maxPay {_ITEM},
    experienceMin {_ITEM}, published string, requirementMin string"""
MARKETPLACE_ITEM = f"{_SHARED}, workDay {_ITEM}, updated string, author struct<id:string,name:string,uri:string>"
MARKETPLACE_DETAIL = f"""{_SHARED}, journey {_ITEM}, updateDate string, creationDate string, description string,
    minRequirements string, desiredRequirements string, applications string, profile struct<id:string,
    name:string,hidden:boolean,corporateWebsiteUrl:string,websiteUrl:string,web:string>"""
POSTING = """id string, text string, hostedUrl string, createdAt bigint, categories struct<commitment:string,
    department:string,location:string,team:string>, description string, descriptionPlain string,
    lists array<struct<text:string,content:string>>, additional string, additionalPlain string"""
JOB = """id bigint, title string, absolute_url string, updated_at string, location struct<name:string>,
    content string, metadata array<struct<id:bigint,name:string,value:string>>"""


def _present(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def _struct_or_null(**parts: Column) -> Column:
    return F.when(
        F.coalesce(*[F.when(p.isNotNull(), F.lit(1)) for p in parts.values()]).isNotNull(),
        F.struct(*[p.alias(n) for n, p in parts.items()]))


def salary() -> Column:
    """Pay of the detail shape overrides the list shape; null when all is missing."""
    return _struct_or_null(
        min=F.coalesce("minPay", "salaryMin"), max=F.coalesce("maxPay", "salaryMax"),
        period=F.col("salaryPeriod"), description=_present(F.col("salaryDescription")))


def _marketplace(rows: DataFrame, work_day: str) -> DataFrame:
    return rows.filter(_present(F.col("id")).isNotNull()).withColumns({
        "title": F.coalesce("title", F.lit("")),
        "location": _struct_or_null(city=_present(F.col("city")), province=F.col("province")),
        "metadata": _struct_or_null(
            category=F.col("category"), subcategory=F.col("subcategory"),
            contractType=F.col("contractType"), workDay=F.col(work_day),
            experienceMin=F.col("experienceMin"), salary=salary())})


def map_marketplace_items(rows: DataFrame, *keys: str) -> DataFrame:
    return _marketplace(rows, "workDay").select(
        *keys,
        F.lit("infojobs").alias("provider"), "id", F.col("link").alias("url"), "title",
        F.struct(F.col("author.id").alias("id"), F.col("author.name").alias("name"),
                 normalize_company_name(_present(F.col("author.name"))).alias("normalizedName")).alias("company"),
        F.col("published").alias("publishedAt"), F.col("updated").alias("updatedAt"), "location",
        "metadata", F.col("requirementMin").alias("requirementsSnippet"))


def map_marketplace_details(rows: DataFrame) -> DataFrame:
    site = pick_website(F.col("profile.corporateWebsiteUrl"), F.col("profile.websiteUrl"), F.col("profile.web"))
    domain = website_domain(site)
    return _marketplace(rows, "journey").select(
        F.lit("infojobs").alias("provider"), "id", F.col("link").alias("url"), "title",
        F.struct(F.col("profile.id").alias("id"), F.col("profile.name").alias("name"),
                 normalize_company_name(_present(F.col("profile.name"))).alias("normalizedName"),
                 site.alias("websiteUrl"),
                 F.when(~F.contains(domain, F.lit(MARKETPLACE_DOMAIN_MARK)), domain).alias("websiteDomain"),
                 F.col("profile.hidden").alias("hidden")).alias("company"),
        F.col("published").alias("publishedAt"), F.col("updateDate").alias("updatedAt"),
        F.col("creationDate").alias("createdAt"), "location", "metadata",
        F.col("requirementMin").alias("requirementsSnippet"), "description", "minRequirements",
        "desiredRequirements", F.col("applications").alias("applicationsCount"))


def posting_description() -> Column:
    lists = F.transform(
        F.filter("lists", lambda x: (F.coalesce(x.text, F.lit("")) != "") & (F.coalesce(x.content, F.lit("")) != "")),
        lambda x: F.concat(x.text, F.lit(":\n"), x.content))
    parts = F.array_compact(F.concat(
        F.array(F.coalesce(_present(F.col("descriptionPlain")), _present(F.col("description")))),
        F.coalesce(lists, F.array().cast("array<string>")),
        F.array(F.coalesce(_present(F.col("additionalPlain")), _present(F.col("additional"))))))
    return F.when(F.size(parts) > 0, F.array_join(parts, "\n\n"))


def map_postings(rows: DataFrame, *keys: str) -> DataFrame:
    """Postings with their ``tenant``, which is also the company name."""
    stamp = F.concat(
        F.date_format(F.to_utc_timestamp(F.timestamp_millis("createdAt"), F.current_timezone()),
                      "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("Z"))
    return rows.select(
        *keys, F.lit("lever").alias("provider"), "id", F.col("hostedUrl").alias("url"), F.col("text").alias("title"),
        F.col("tenant").alias("company_name"), stamp.alias("publishedAt"),
        _present(F.col("categories.location")).alias("city"),
        F.coalesce(_present(F.col("categories.department")), _present(F.col("categories.team"))).alias("category"),
        _present(F.col("categories.commitment")).alias("contractType"),
        posting_description().alias("description"))


def map_jobs(rows: DataFrame, *keys: str, max_chars: int | None = None) -> DataFrame:
    """Jobs with their ``tenant``. ``max_chars`` cuts descriptions; off by default."""
    value = F.get(F.filter("metadata", lambda m: F.lower(m.getField("name")) == "department"), F.lit(0)).getField("value")
    first = F.when(F.startswith(value, F.lit("[")), F.get_json_object(value, "$[0]")).otherwise(value)
    content = F.col("content") if max_chars is None else F.substring("content", 1, max_chars)
    return rows.select(
        *keys, F.lit("greenhouse").alias("provider"), F.col("id").cast("string").alias("id"),
        F.col("absolute_url").alias("url"), "title", F.col("tenant").alias("company_name"),
        F.col("updated_at").alias("updatedAt"), _present(F.col("location.name")).alias("city"),
        _present(first).alias("category"), content.alias("description"))
