"""Readers of registry, filing and document files, and the projections that go with them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions.dates import parse_date

# Kinds of interventions and phases that are in scope.
DRUG_TYPES = ("DRUG", "BIOLOGICAL")
PHASES = ("PHASE2", "PHASE3", "PHASE2_PHASE3")
#: The part of a registry record that is read; other fields are skipped while parsing.
REGISTRY = """protocolSection struct<
  identificationModule:struct<nctId:string,briefTitle:string,officialTitle:string>,
  sponsorCollaboratorsModule:struct<leadSponsor:struct<name:string,class:string>,collaborators:array<struct<name:string>>>,
  designModule:struct<studyType:string,phases:array<string>,enrollmentInfo:struct<count:int,type:string>,designInfo:struct<allocation:string,maskingInfo:struct<masking:string>>>,
  armsInterventionsModule:struct<interventions:array<struct<type:string,name:string>>,armGroups:array<struct<label:string,type:string>>>,
  outcomesModule:struct<primaryOutcomes:array<struct<measure:string,timeFrame:string>>,secondaryOutcomes:array<struct<measure:string,timeFrame:string>>>,
  statusModule:struct<overallStatus:string,startDateStruct:struct<date:string>,primaryCompletionDateStruct:struct<date:string>,completionDateStruct:struct<date:string>,lastUpdatePostDateStruct:struct<date:string>>,
  conditionsModule:struct<conditions:array<string>,keywords:array<string>>,
  eligibilityModule:struct<eligibilityCriteria:string>>"""


def registry(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    """Registry records (JSON lines) as one struct column; broken lines are skipped.

    With `since`, only records updated on that day or later: the cursor of an incremental load.
    """
    raw = spark.read.schema(REGISTRY).option("mode", "DROPMALFORMED").json(path)
    updated = parse_date(F.col("protocolSection.statusModule.lastUpdatePostDateStruct.date"))
    return raw if since is None else raw.where(updated >= F.lit(since).cast("date"))


def in_scope(df: DataFrame) -> DataFrame:
    """Interventional studies of drugs or biologicals in phase 2 or 3."""
    p = F.col("protocolSection")
    kinds = F.transform(p["armsInterventionsModule"]["interventions"], lambda i: F.upper(i["type"]))
    lit = lambda xs: F.array(*(F.lit(x) for x in xs))
    return df.where(F.upper(p["designModule"]["studyType"]).startswith("INTERVENTIONAL") & F.arrays_overlap(kinds, lit(DRUG_TYPES)) & F.arrays_overlap(p["designModule"]["phases"], lit(PHASES)))


def phase_of(phases: Column) -> Column:
    """PHASE2 and PHASE3 together are one phase; else the first named."""
    both = F.array_contains(phases, "PHASE2") & F.array_contains(phases, "PHASE3")
    return F.when(both, "PHASE2_PHASE3").otherwise(F.get(phases, F.lit(0)))


def trial_fields(df: DataFrame) -> DataFrame:
    """Flat trial fields of registry records; missing modules give nulls."""
    p = F.col("protocolSection")
    outcomes = p["outcomesModule"]["primaryOutcomes"]
    shown = F.transform(outcomes, lambda o: F.concat(o["measure"], F.when(F.coalesce(o["timeFrame"], F.lit("")) != "", F.concat(F.lit(" ("), o["timeFrame"], F.lit(")"))).otherwise("")))
    s = p["statusModule"]
    return df.select(
        p["identificationModule"]["nctId"].alias("nct_id"),
        p["identificationModule"]["briefTitle"].alias("brief_title"),
        p["sponsorCollaboratorsModule"]["leadSponsor"]["name"].alias("sponsor_text"),
        phase_of(p["designModule"]["phases"]).alias("phase"),
        F.array_join(F.filter(shown, lambda x: x.isNotNull() & (x != "")), "; ").alias("primary_endpoint_text"),
        F.array_sort(F.array_distinct(F.transform(p["armsInterventionsModule"]["interventions"], lambda i: F.upper(i["type"])))).alias("intervention_types"),
        F.transform(p["sponsorCollaboratorsModule"]["collaborators"], lambda c: c["name"]).alias("collaborators"),
        p["designModule"]["enrollmentInfo"]["count"].alias("sample_size"),
        p["conditionsModule"]["conditions"].alias("conditions"),
        p["conditionsModule"]["keywords"].alias("keywords"),
        p["eligibilityModule"]["eligibilityCriteria"].alias("eligibility"),
        s["overallStatus"].alias("status"),
        parse_date(s["startDateStruct"]["date"]).alias("study_start"),
        parse_date(s["primaryCompletionDateStruct"]["date"]).alias("primary_completion"),
        parse_date(s["completionDateStruct"]["date"]).alias("study_completion"),
        F.sha2(F.to_json(p), 256).alias("sha256"),
    )


def sample(df: DataFrame, phases: list[str] | None = None, statuses: list[str] | None = None, rows: int | None = None) -> DataFrame:
    """Trials of some phases and statuses (unknown ones pass), at most so many."""
    for name, allowed in (("phase", phases), ("status", statuses)):
        df = df if allowed is None else df.where(F.col(name).isNull() | F.col(name).isin(allowed))
    return df if rows is None else df.limit(rows)


def company_tickers(spark: SparkSession, path: str) -> DataFrame:
    """cik, name, ticker, exchange from one JSON document in any of its three layouts: fields and data, a
    map of objects, or a list of objects."""
    text = spark.read.text(path, wholetext=True)
    item = "struct<cik_str:string,cik:string,title:string,name:string,ticker:string,exchange:string>"
    table = F.from_json("value", "struct<fields:array<string>,data:array<array<string>>>")
    place = lambda f: F.array_position(F.col("t.fields"), f).cast("int")
    cell = lambda f: F.when(place(f) > 0, F.get(F.col("r"), place(f) - 1))
    rows = text.select(table.alias("t")).where("t.data is not null").select("t", F.explode("t.data").alias("r")).select(cell("cik").alias("cik"), cell("name").alias("name"), cell("ticker").alias("ticker"), cell("exchange").alias("exchange"))
    listed = F.from_json("value", f"array<{item}>")
    mapped = F.map_values(F.from_json("value", f"map<string,{item}>"))
    head = F.substring(F.trim("value"), 1, 1)
    objects = text.where(~F.col("value").rlike(r'^\s*\{\s*"fields"')).select(F.explode(F.when(head == "[", listed).otherwise(mapped)).alias("o"))
    flat = objects.select(F.coalesce("o.cik_str", "o.cik").alias("cik"), F.coalesce("o.title", "o.name").alias("name"), "o.ticker", "o.exchange")
    return rows.unionByName(flat).where("cik is not null").withColumn("cik", F.lpad("cik", 10, "0"))


def former_names(spark: SparkSession, path: str) -> DataFrame:
    """cik, name, from_date, to_date of earlier company names; files that don't parse are skipped."""
    schema = "cik string, formerNames array<struct<name:string,`from`:string,`to`:string>>"
    raw = spark.read.schema(schema).option("multiLine", True).option("mode", "DROPMALFORMED").json(path)
    rows = raw.where("cik is not null").select(F.lpad("cik", 10, "0").alias("cik"), F.explode("formerNames").alias("f"))
    return rows.select("cik", "f.name", parse_date(F.substring("f.from", 1, 10)).alias("from_date"), parse_date(F.substring("f.to", 1, 10)).alias("to_date"))


def blobs(spark: SparkSession, path: str) -> DataFrame:
    """Files with their content digest and address."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", "length", "modificationTime", F.sha2("content", 256).alias("sha256"), "content").withColumn("uri", F.concat(F.lit("local://"), "sha256", F.lit("/"), F.element_at(F.split("path", "/"), -1)))


def parse_uri(uri: Column) -> Column:
    """Struct (backend, sha256 or bucket, name) of a storage address."""
    pattern = r"^(\w+)://([^/]+)/(.*)$"
    return F.struct(*(F.nullif(F.regexp_extract(uri, pattern, i), F.lit("")).alias(n) for i, n in ((1, "backend"), (2, "place"), (3, "name"))))


def news_links(pages: DataFrame, url: str, hrefs: str) -> DataFrame:
    """Absolute links that look like news, from exploded hrefs."""
    wanted = r"(?i)(press|news|release|investor|media|announce)"
    host = F.regexp_extract(url, r"^(https?://[^/]+)", 1)
    rows = pages.select(F.col(url).alias("page"), host.alias("host"), F.explode(hrefs).alias("href")).where(F.col("href").rlike(wanted))
    full = F.when(F.col("href").rlike("^https?://"), F.col("href")).when(F.col("href").startswith("/"), F.concat("host", "href")).otherwise(F.concat("host", F.lit("/"), "href"))
    return rows.select("page", full.alias("link")).distinct()


def write_training_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)
