"""Listings of securities as intervals, made from a log of events.

The state of a ticker follows from its events in the order of their date, whatever the order in which they came in:
a listing ends where the next one begins, or at a closing that finds it open.  So late events fall into place,
and events that come twice change nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.functions.text import norm_name
from lodestar.operators.catalyst import number_rows

#: How filings write the names of exchanges.
EXCHANGE_NAMES = {
    "NASDAQ": ("nasdaq", "nasdaqgs", "nasdaqgm", "nasdaqcm", "nasdaqg", "nasdaq global select market", "nasdaq global market", "nasdaq capital market"),
    "NYSE": ("nyse", "new york stock exchange"),
    "NYSE American": ("nyse american", "nyse mkt", "nyse mkt llc", "amex"),
    "OTCQX": ("otcqx", "otcqx u.s.", "otcqx u.s.a."),
    "OTCQB": ("otcqb", "otcqb u.s."),
}
LIST, CLOSE, TRANSFER = "list", "close", "transfer"


def exchange_code(name: Column) -> Column:
    """The exchange's code, or null."""
    plain = F.lower(F.trim(name))
    return F.coalesce(*(F.when(plain.isin(*names), code) for code, names in EXCHANGE_NAMES.items()))


def admitted(events: DataFrame, exchanges: DataFrame) -> DataFrame:
    """events with `admitted`: closings always, listings and transfers on exchanges(code, is_allowed) that are allowed.

    A code that stands there twice is allowed if one row says so; rejected events have no effect at all.
    """
    allowed = exchanges.groupBy("code").agg(F.max("is_allowed").alias("_allowed"))
    joined = events.join(allowed, events["exchange"] == allowed["code"], "left").drop("code")
    return joined.withColumn("admitted", (F.col("kind") == CLOSE) | F.coalesce("_allowed", F.lit(False))).drop("_allowed")


def timeline(events: DataFrame) -> DataFrame:
    """ticker, company_id, exchange, valid_from, valid_to, status, closed_by, marker: the listings of every ticker.

    events(ticker, seq, kind, company_id, exchange, date, status) in any order; seq orders events of one date.  A
    transfer is a closing and a listing.  A listing [date, valid_to) is active while valid_to is null.  It ends at
    the next listing of the ticker (closed_by `listing`; on the same date it becomes empty), or before that at a
    closing of a later date (closed_by `closing`), which also leaves a marker of zero length and may name another
    status than `delisted`.  Closings that find nothing open do nothing.  Tickers count in upper case; rows without
    ticker or date, or of another kind, are left out; of events that say the same the first counts, so a log may be
    applied again in part or whole.

    One shuffle by ticker; windows only look at rows before, so a ticker's events pass through memory one by one.
    """
    parts = F.when(F.col("kind") == LIST, F.array(F.struct(F.lit(1).alias("part"), F.lit(True).alias("lists"))))
    parts = parts.when(F.col("kind") == CLOSE, F.array(F.struct(F.lit(0).alias("part"), F.lit(False).alias("lists"))))
    parts = parts.when(F.col("kind") == TRANSFER, F.array(F.struct(F.lit(0).alias("part"), F.lit(False).alias("lists")), F.struct(F.lit(1).alias("part"), F.lit(True).alias("lists"))))
    steps = events.where(F.col("ticker").isNotNull() & F.col("date").isNotNull()).select(F.upper("ticker").alias("ticker"), "seq", "company_id", "exchange", "date", "status", F.explode(parts).alias("_p"))
    # what a closing says is its date and status, what a listing says is its owner and exchange
    said = lambda c, when: F.when(F.col("_p.lists") == when, F.col(c)).alias(c)
    same = ["ticker", "date", "lists", "company_id", "exchange", "status"]
    steps = steps.select("ticker", "date", "seq", "_p.part", "_p.lists", said("company_id", True), said("exchange", True), said("status", False))
    steps = steps.groupBy(*same).agg(F.min(F.struct("seq", "part")).alias("_at")).withColumn("_at", F.struct("date", "_at.seq", "_at.part"))
    later = Window.partitionBy("ticker").orderBy(F.desc("_at")).rowsBetween(Window.unboundedPreceding, -1)
    later_days = Window.partitionBy("ticker").orderBy(F.desc(F.unix_date("date"))).rangeBetween(Window.unboundedPreceding, -1)
    next_listing = F.last(F.when(F.col("lists"), F.col("_at")), ignorenulls=True).over(later)
    next_closing = F.min(F.when(~F.col("lists"), F.struct(F.col("_at"), F.col("status")))).over(later_days)
    seen = steps.withColumn("_list", next_listing).withColumn("_close", next_closing).where("lists")
    closes = F.col("_close").isNotNull() & (F.col("_list").isNull() | (F.col("_close._at") < F.col("_list")))
    status = F.when(F.col("_closes"), F.coalesce("_close.status", F.lit("delisted"))).when(F.col("_list").isNotNull(), "delisted").otherwise("active")
    ends = F.when(F.col("_closes"), F.col("_close._at.date")).otherwise(F.col("_list.date"))
    ranges = seen.withColumn("_closes", closes).select(
        "ticker", "company_id", "exchange", F.col("date").alias("valid_from"), ends.alias("valid_to"), status.alias("status"),
        F.when(F.col("_closes"), "closing").when(F.col("_list").isNotNull(), "listing").alias("closed_by"),
    )
    own = [F.struct(F.col("valid_from"), F.lit(False).alias("marker")), F.when(F.col("closed_by") == "closing", F.struct(F.col("valid_to").alias("valid_from"), F.lit(True).alias("marker")))]
    out = ranges.withColumn("_r", F.explode(F.array_compact(F.array(*own))))
    return out.select("ticker", "company_id", "exchange", "_r.valid_from", "valid_to", "status", "closed_by", "_r.marker")


def listed_on(ranges: DataFrame, day: Column) -> DataFrame:
    """Of each ticker, the listing that holds on the day; there is one at most."""
    return ranges.where((F.col("valid_from") <= day) & (F.col("valid_to").isNull() | (F.col("valid_to") > day)))


def ingest_registrants(rows: DataFrame, companies: DataFrame, aliases: DataFrame, exchanges: DataFrame, start: Column, latest: str = "row_no") -> dict[str, DataFrame]:
    """What rows(row_no, cik, title, ticker, exchange) of a filing registry add to the tables.

    companies: the state after them (company_id, cik, name); a known number takes its last title as its name, new
    ones get ids after the highest there is, in the order of their number.  aliases: the legal names that are new
    (company_id, alias, alias_norm, alias_type), the first spelling of each.  events: a listing per row on an
    allowed exchange.  counts: inserted_companies, updated_companies, activated, skipped.  Rows whose exchange has
    no code change nothing; those on a known but disallowed exchange still name their company.
    """
    coded = rows.where(F.col("cik").isNotNull()).withColumn("code", exchange_code(F.col("exchange")))
    named = coded.where(F.col("code").isNotNull())
    titles = named.groupBy("cik").agg(F.max_by("title", latest).alias("title"))
    known = companies.select("company_id", "cik", "name")
    fresh = number_rows(titles.join(known, "cik", "left_anti"), [F.col("cik")], "_place")
    top = companies.agg(F.coalesce(F.max("company_id"), F.lit(0)).cast("long").alias("_top"))
    new = fresh.join(F.broadcast(top)).select((F.col("_top") + F.col("_place")).alias("company_id"), "cik", F.col("title").alias("name"))  # one row
    old = known.join(titles, "cik", "left").select("company_id", "cik", F.coalesce("title", "name").alias("name"))
    state = old.unionByName(new)
    owned = named.join(state.select("company_id", "cik"), "cik")
    spelled = owned.withColumn("alias_norm", norm_name(F.col("title"))).groupBy("company_id", "alias_norm").agg(F.min_by("title", latest).alias("alias"))
    legal = aliases.where("alias_type = 'legal'").select("company_id", "alias_norm")
    added = spelled.join(legal, ["company_id", "alias_norm"], "left_anti").select("company_id", "alias", "alias_norm", F.lit("legal").alias("alias_type"))
    asked = owned.select("ticker", F.col(latest).alias("seq"), F.lit(LIST).alias("kind"), "company_id", F.col("code").alias("exchange"), start.alias("date"), F.lit(None).cast("string").alias("status"))
    judged = admitted(asked, exchanges)
    n_new, n_all, n_named = (d.agg(F.count("*").alias(k)) for d, k in ((new, "inserted_companies"), (rows, "_all"), (named, "_named")))
    n_on = judged.agg(F.count_if("admitted").alias("activated"))
    one = n_new.join(F.broadcast(n_named)).join(F.broadcast(n_on)).join(F.broadcast(n_all))  # one row each
    counts = one.select("inserted_companies", (F.col("_named") - F.col("inserted_companies")).alias("updated_companies"), "activated", (F.col("_all") - F.col("activated")).alias("skipped"))
    return {"companies": state, "aliases": added, "events": judged.where("admitted").drop("admitted"), "counts": counts}
