"""Marketing payloads to raw rows: keywords, email campaigns and profiles, posts, search rows, ad reports."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions.scalars import (
    blank_to_null,
    number,
    once,
    ratio,
    round_at,
    to_int_half_away,
    to_int_half_up,
    url_host,
)
from martloom.ingest.shop import run_stamp
from martloom.operators.joins import newest_before
from martloom.operators.keyed import latest_wins
from martloom.operators.skew import SALT, spread_hot_keys

# ---- fixed values: report headers in upper-case letters and digits ----
AD_HEADERS = {
    "date": ("DAY", "DAILY"),
    "campaign_id": ("CAMPAIGNID",),
    "campaign_name": ("CAMPAIGNNAME",),
    "impressions": ("IMPRESSIONS", "IMPS"),
    "clicks": ("CLICKS",),
    "cost": ("COST",),
    "conversions": ("CONVERSIONS",),
    "revenue": ("CONVVALUE", "CONVERSIONVALUE"),
}
NO_VALUE = ("Total", "--")
PREAMBLE_HEADER = ("TimePeriod", "CampaignId")
PREAMBLE_COLUMNS = {
    "date": "timeperiod",
    "campaign_id": "campaignid",
    "campaign_name": "campaignname",
    "campaign_type": "campaigntype",
    "impressions": "impressions",
    "clicks": "clicks",
    "cost": "spend",
    "conversions": "conversions",
    "revenue": "revenue",
}
SCD_DAYS = 60
MICROS = 1_000_000
# ---- end of fixed values ----


def keyword_rows(payloads: DataFrame, fetched_date: dt.date, run_at: dt.datetime) -> DataFrame:
    """Keywords per target site. payloads carries target_url and match_type beside the parsed body."""
    whole = lambda f: F.col(f"k.metrics.{f}").cast("long")
    return payloads.withColumn("k", F.explode("data.items")).select(
        F.lit(fetched_date).alias("fetched_date"),
        "target_url",
        "match_type",
        url_host(F.col("target_url")).alias("domain"),
        F.coalesce(F.col("k.keyword"), F.lit("")).alias("keyword"),
        whole("searchVolume").alias("search_volume"),
        whole("seoDifficulty").alias("seo_difficulty"),
        F.col("k.metrics.cpc").alias("cpc"),
        F.col("k.metrics.competition").alias("competition"),
        whole("rank").alias("rank"),
        F.col("k.metrics.etv").alias("etv"),
        run_stamp(run_at),
    )


def email_campaigns(campaigns: DataFrame, stats: DataFrame, run_at: dt.datetime) -> DataFrame:
    """Campaigns with their figures. stats carries seq, the order of arrival: the last result of a campaign
    counts. Unique counts are preferred to totals."""
    latest = (
        stats.select("seq", F.posexplode("data.attributes.results").alias("pos", "r"))
        .filter(F.col("r.groupings.campaign_id").isNotNull())
        .groupBy(F.col("r.groupings.campaign_id").alias("campaign_id"))
        .agg(F.max(F.struct("seq", "pos", "r.statistics")).getField("statistics").alias("s"))
    )
    sent = F.coalesce(blank_to_null(F.col("c.attributes.send_time")), blank_to_null(F.col("c.attributes.scheduled_at")))
    whole = lambda *fs: F.coalesce(*[F.col(f"s.{f}") for f in fs]).cast("long")
    return (
        campaigns.select(F.explode("data").alias("c"))
        .select(
            F.col("c.id").alias("campaign_id"),
            blank_to_null(F.col("c.attributes.name")).alias("campaign_name"),
            sent.try_cast("timestamp").alias("sent_at"),
        )
        .join(latest, "campaign_id", "left")
        .select(
            "campaign_id",
            "campaign_name",
            "sent_at",
            F.date_format("sent_at", "EEEE").alias("sent_day_of_week"),
            F.hour("sent_at").cast("long").alias("sent_hour"),
            whole("recipients").alias("recipients"),
            whole("opens_unique", "opens").alias("opens"),
            F.col("s.open_rate").alias("open_rate"),
            whole("clicks_unique", "clicks").alias("clicks"),
            F.col("s.click_rate").alias("click_rate"),
            whole("conversion_uniques", "conversions").alias("conversions"),
            to_int_half_up(F.coalesce(F.col("s.conversion_value"), F.col("s.revenue"))).alias("revenue"),
            whole("unsubscribes").alias("unsubscribes"),
            run_stamp(run_at),
        )
    )


def email_profiles(payloads: DataFrame, run_at: dt.datetime) -> DataFrame:
    """Profiles with an email; the update stamp falls back to the last event and the creation."""
    a = lambda f: blank_to_null(F.col(f"p.attributes.{f}"))
    stamp = lambda *fs: F.coalesce(*map(a, fs)).try_cast("timestamp")
    return (
        payloads.select(F.explode("data").alias("p"))
        .filter(a("email").isNotNull())
        .select(
            F.col("p.id").alias("profile_id"),
            a("email").alias("email"),
            a("first_name").alias("first_name"),
            a("last_name").alias("last_name"),
            to_int_half_up(F.col("p.attributes.predictive_analytics.historic_clv")).alias("total_revenue"),
            stamp("created").alias("created_at"),
            stamp("updated", "updated_at", "last_event_date", "created").alias("updated_at"),
            run_stamp(run_at),
        )
    )


def social_posts(media: DataFrame, insights: DataFrame, day: dt.date, run_at: dt.datetime) -> DataFrame:
    """Posts with their metrics. insights carries post_id beside the parsed metric list; posts whose
    metrics have not arrived are left out."""

    def metric(name: str) -> Column:
        found = F.get(F.filter("data", lambda m: m["name"] == name), F.lit(0))
        return F.get(found["values"], F.lit(0))["value"].try_cast("double").cast("long")

    wanted = {"impressions": "impressions", "reach": "reach", "saves": "saved", "interactions": "total_interactions"}
    metrics = insights.select("post_id", *[metric(src).alias(out) for out, src in wanted.items()])
    return (
        media.select(F.explode("data").alias("m"))
        .select(F.col("m.id").alias("post_id"), "m")
        .join(metrics, "post_id")
        .select(
            "post_id",
            F.lit(day).alias("date"),
            blank_to_null(F.col("m.permalink")).alias("post_url"),
            blank_to_null(F.col("m.media_type")).alias("media_type"),
            F.col("m.timestamp").try_cast("timestamp").alias("posted_at"),
            "impressions",
            "reach",
            F.col("m.like_count").alias("likes"),
            F.col("m.comments_count").alias("comments"),
            "saves",
            round_at(ratio(F.col("interactions"), F.col("reach")), 6).alias("engagement_rate"),
            run_stamp(run_at),
        )
    )


def search_rows(payloads: DataFrame) -> DataFrame:
    """(day, page, query) rows of one site; payloads carries site_url. Rows with fewer keys are left out."""
    key = lambda i: F.get("r.keys", F.lit(i))
    zero = lambda f, t: F.coalesce(F.col(f"r.{f}"), F.lit(0.0)).cast(t).alias(f)
    return (
        payloads.withColumn("r", F.explode("rows"))
        .filter(F.size("r.keys") >= 3)
        .select(
            key(0).try_cast("date").alias("data_date"),
            "site_url",
            key(1).alias("url"),
            key(2).alias("query"),
            zero("clicks", "long"),
            zero("impressions", "long"),
            zero("ctr", "double"),
            zero("position", "double"),
        )
    )


# ------------------------------------------------------------------ advertising reports


def _iso_day(text: Column) -> Column:
    return F.regexp_replace(text, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3").try_cast("date")


def _ad_row(field, campaign_type: Column, run_at: dt.datetime) -> list[Column]:
    """Typed columns of an ad row out of its text fields. A blank figure counts as 0, text as null."""
    figure = lambda name: F.when(F.coalesce(field(name), F.lit("")) == "", F.lit(0.0)).otherwise(number(field(name)))
    return [
        _iso_day(field("date")).alias("date"),
        field("campaign_id").alias("campaign_id"),
        blank_to_null(field("campaign_name")).alias("campaign_name"),
        campaign_type.alias("campaign_type"),
        F.lit(None).cast("string").alias("ad_group_id"),
        figure("impressions").cast("long").alias("impressions"),
        figure("clicks").cast("long").alias("clicks"),
        to_int_half_up(figure("cost")).alias("cost"),
        figure("conversions").alias("conversions"),
        to_int_half_up(figure("revenue")).alias("revenue"),
        run_stamp(run_at),
    ]


def read_ad_report(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("escape", '"').csv(path)


def ad_report(report: DataFrame, campaign_type: str, run_at: dt.datetime) -> DataFrame:
    """A report read with its header (all text), whatever spelling the header uses. Total rows and rows
    without a campaign are left out; columns the report does not have become null."""
    plain = {re.sub(r"[^A-Z0-9]", "", c.upper()): c for c in reversed(report.columns)}
    found = {name: next((plain[a] for a in names if a in plain), None) for name, names in AD_HEADERS.items()}
    cells = {
        name: F.trim(F.col(f"`{c}`")) if c is not None else F.lit(None).cast("string") for name, c in found.items()
    }
    named = report.select(*[c.alias(name) for name, c in cells.items()])
    present = lambda name: F.col(name).isNotNull() & (F.col(name) != "") & ~F.col(name).isin(*NO_VALUE)
    rows = named.filter(present("date") & F.col("campaign_id").isNotNull() & ~F.col("campaign_id").isin("", "--"))
    typed = rows.select(*_ad_row(F.col, F.lit(campaign_type), run_at))
    absent = [name for name, c in found.items() if c is None and name in typed.columns]
    for name in absent:
        typed = typed.withColumn(name, F.lit(None).cast(typed.schema[name].dataType))
    return typed


def ad_report_with_preamble(lines: DataFrame, run_at: dt.datetime) -> DataFrame:
    """(file, pos, line) of reports with some lines before the header and a footer after the rows.

    The header is the first line of a file that names both key columns. It is looked up per file and
    joined to the later lines, so a file can be read in splits. Quoted fields may hold commas.
    """
    names_keys = F.lit(True)
    for word in PREAMBLE_HEADER:
        names_keys = names_keys & F.col("line").contains(word)
    headers = (
        lines.filter(names_keys)
        .groupBy("file")
        .agg(F.min(F.struct("pos", "line")).alias("h"))
        .select("file", F.col("h.pos").alias("header_pos"), F.transform(_fields(F.col("h.line")), F.lower).alias("header"))
    )
    # one file may hold most of the lines
    spread, headers = spread_hot_keys(lines, headers, ["file"], ["pos"])
    cells = (
        spread.join(headers, ["file", SALT])
        .filter((F.col("pos") > F.col("header_pos")) & (F.trim("line") != ""))
        .select("header", once(_fields(F.col("line"))).alias("cells"))
    )
    named = cells.select(
        *[
            F.when(F.array_contains("header", src), F.get("cells", F.array_position("header", src).cast("int") - 1)).alias(out)
            for out, src in PREAMBLE_COLUMNS.items()
        ],
        *[F.array_contains("header", src).alias(f"has_{out}") for out, src in PREAMBLE_COLUMNS.items()],
    ).filter(F.col("campaign_id").isNotNull() & (F.col("campaign_id") != ""))
    typed = named.select(
        *_ad_row(F.col, blank_to_null(F.col("campaign_type")), run_at),
        *[f"has_{f}" for f in ("impressions", "clicks", "cost", "conversions", "revenue")],
    )
    shown = lambda c: F.when(F.col(f"has_{c}"), F.col(c)).alias(c) if f"has_{c}" in typed.columns else F.col(c)
    return typed.select(*[shown(c) for c in typed.columns if not c.startswith("has_")])


def _fields(line: Column) -> Column:
    """Fields of a CSV line: split at commas outside quotes, outer quotes and blanks removed."""
    parts = F.split(line, r',(?=(?:[^"]*"[^"]*")*[^"]*$)')
    return F.transform(parts, lambda p: F.regexp_replace(F.trim(p), r'^"|"$', ""))


# ------------------------------------------------------------------ views over transferred tables


def google_ads_view(stats: DataFrame, campaigns: DataFrame, run_at: dt.datetime) -> DataFrame:
    """Daily campaign figures with the newest campaign record of the 60 days before; one row per day and
    campaign, campaigns without such a record drop out."""
    figures = [f"metrics_{m}" for m in ("impressions", "clicks", "cost_micros", "conversions", "conversions_value")]
    daily = latest_wins(
        stats.select("_DATA_DATE", "campaign_id", *figures), ["_DATA_DATE", "campaign_id"], figures[0], figures[1:]
    )
    named = newest_before(
        daily.withColumnRenamed("_DATA_DATE", "date"),
        campaigns.withColumnRenamed("_DATA_DATE", "loaded_on"),
        "campaign_id",
        "date",
        "loaded_on",
        SCD_DAYS,
        ["campaign_name", "campaign_advertising_channel_type"],
    )
    return named.select(
        "date",
        F.col("campaign_id").cast("string").alias("campaign_id"),
        "campaign_name",
        F.col("campaign_advertising_channel_type").alias("campaign_type"),
        F.lit(None).cast("string").alias("ad_group_id"),
        F.col("metrics_impressions").alias("impressions"),
        F.col("metrics_clicks").alias("clicks"),
        to_int_half_away(F.col("metrics_cost_micros") / F.lit(MICROS)).alias("cost"),
        F.col("metrics_conversions").alias("conversions"),
        to_int_half_away(F.col("metrics_conversions_value")).alias("revenue"),
        run_stamp(run_at),
    )


def meta_ads_view(insights: DataFrame, actions: DataFrame, run_at: dt.datetime) -> DataFrame:
    """Ad rows typed from text, with the one-day click actions of the day and ad as conversions."""
    decimal = lambda c: F.col(c).try_cast("decimal(38,9)")
    clicked = (
        actions.groupBy("DateStart", "AdId")
        .agg(F.sum(decimal("Action1dClick")).cast("double").alias("click_actions"))
    )
    return insights.join(clicked, ["DateStart", "AdId"], "left").select(
        F.col("DateStart").alias("date"),
        F.col("CampaignId").alias("campaign_id"),
        F.col("CampaignName").alias("campaign_name"),
        F.col("AdSetId").alias("ad_set_id"),
        F.col("Impressions").try_cast("bigint").alias("impressions"),
        F.col("Clicks").try_cast("bigint").alias("clicks"),
        F.round(decimal("Spend")).cast("long").alias("cost"),
        F.coalesce(F.col("click_actions"), F.lit(0.0)).alias("conversions"),
        F.lit(None).cast("long").alias("revenue"),
        run_stamp(run_at),
    )


def search_console_view(url_impressions: DataFrame, run_at: dt.datetime) -> DataFrame:
    """Rows of the search export under the names the reports use, with rate and mean position."""
    return url_impressions.filter(F.col("query").isNotNull()).select(
        F.col("data_date").alias("date"),
        F.col("url").alias("page"),
        "query",
        "clicks",
        "impressions",
        ratio(F.col("clicks"), F.col("impressions")).alias("ctr"),
        ratio(F.col("sum_position"), F.col("impressions")).alias("position"),
        run_stamp(run_at),
    )
