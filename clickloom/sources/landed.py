"""Flatten landed service responses (trending searches, explore widgets, search console, ads ideas)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.arrays import cells_to_columns
from clickloom.functions.text import blank_free, traffic_number
from clickloom.operators.ranking import keep_first

TRENDS = (
    "struct<default:struct<trendingSearchesDays:array<struct<trendingSearches:array<struct<"
    "title:struct<query:string>,formattedTraffic:string,relatedQueries:array<struct<query:string>>>>>>>>"
)
TIMELINE = (
    "struct<default:struct<timelineData:array<struct<time:string,formattedTime:string,"
    "value:array<bigint>,hasData:array<boolean>,formattedValue:array<string>>>>>"
)
GEO = (
    "struct<default:struct<geoMapData:array<struct<geoCode:string,geoName:string,"
    "value:array<bigint>,hasData:array<boolean>,formattedValue:array<string>>>>>"
)
RANKED = (
    "struct<default:struct<rankedList:array<struct<rankedKeyword:array<struct<query:string,"
    "topic:struct<mid:string,title:string,type:string>,value:bigint,formattedValue:string>>>>>>"
)
IDEAS = (
    "struct<text:string,keyword_idea_metrics:struct<competition:string,low_top_of_page_bid_micros:bigint,"
    "high_top_of_page_bid_micros:bigint,avg_monthly_searches:bigint,"
    "monthly_search_volumes:array<struct<year:int,month:int,monthly_searches:bigint>>>>"
)
CONSOLE = "struct<rows:array<struct<keys:array<string>,clicks:double,impressions:double,position:double>>>"
CELLS = ("value", "hasData", "formattedValue")


def _json(text: Column, schema: str) -> Column:
    """Responses start with a guard prefix that is no JSON."""
    return F.from_json(F.regexp_replace(text, r"\A\)\]\}',\n", ""), schema)


def flatten_trends(df: DataFrame, text: str = "value", date: str = "date") -> DataFrame:
    """(keyword, related_queries, traffic, date), the first of equal (keyword, traffic, date) rows."""
    day = F.col("_j.default.trendingSearchesDays")[0]["trendingSearches"]
    rows = df.select(date, _json(F.col(text), TRENDS).alias("_j")).select(date, F.explode(day).alias("_s"))
    flat = rows.select(
        F.col("_s.title.query").alias("keyword"),
        F.array_join(F.transform("_s.relatedQueries", lambda q: q["query"]), ",").alias("related_queries"),
        traffic_number(F.col("_s.formattedTraffic")).alias("traffic"),
        date,
    )
    return keep_first(flat, ["keyword", "traffic", date], [F.asc("related_queries")])


def _cells(df: DataFrame, text: str, schema: str, field: str, names: Sequence[str] | None) -> DataFrame:
    keys = [c for c in df.columns if c != text]
    rows = df.select(*keys, F.explode(_json(F.col(text), schema)["default"][field]).alias("_c"))
    return cells_to_columns(rows.select(*keys, "_c.*"), CELLS, names)


def flatten_timeline(df: DataFrame, text: str = "value", names: Sequence[str] | None = None) -> DataFrame:
    """Interest over time; with ``names`` one set of columns per compared keyword."""
    return _cells(df, text, TIMELINE, "timelineData", names)


def flatten_geo(df: DataFrame, text: str = "value", names: Sequence[str] | None = None) -> DataFrame:
    return _cells(df, text, GEO, "geoMapData", names)


def flatten_ranked(df: DataFrame, text: str = "value", topics: bool = False) -> DataFrame:
    """Hot and rising queries, or topics as (title, type, formattedValue), with column ``kind``."""
    keys = [c for c in df.columns if c != text]
    lists = df.select(*keys, F.posexplode(_json(F.col(text), RANKED)["default"]["rankedList"]).alias("_i", "_l"))
    kind = F.when(F.col("_i") == 0, "hot").when(F.col("_i") == 1, "up").alias("kind")
    rows = lists.where(F.col("_i") < 2).select(*keys, kind, F.explode("_l.rankedKeyword").alias("_r"))
    if topics:
        named = rows.select(*keys, "kind", F.col("_r.topic").alias("topic"), F.col("_r.formattedValue").alias("formattedValue"))
        return named.select(*keys, "kind", "topic.title", "topic.type", "formattedValue")
    return rows.select(*keys, "kind", "_r.query", "_r.value", "_r.formattedValue")


def flatten_console(df: DataFrame, dimensions: Sequence[str], text: str = "value") -> DataFrame:
    """Search-console response rows with one column per requested dimension."""
    keys = [c for c in df.columns if c != text]
    rows = df.select(*keys, F.explode(F.from_json(text, CONSOLE)["rows"]).alias("_r"))
    dims = [F.col("_r.keys")[i].alias(name) for i, name in enumerate(dimensions)]
    return rows.select(*keys, "_r.clicks", "_r.impressions", "_r.position", *dims)


def parse_ideas(df: DataFrame, text: str = "value") -> DataFrame:
    """Keyword ideas with prices in units; bids come in millionths."""
    idea = F.from_json(text, IDEAS)
    metrics = "_i.keyword_idea_metrics"
    return df.select(idea.alias("_i")).select(
        blank_free(F.col("_i.text")).alias("keyword_join"),
        F.col("_i.text").alias("keyword_google"),
        F.col(f"{metrics}.competition").alias("competition_level"),
        (F.col(f"{metrics}.low_top_of_page_bid_micros") / 1_000_000).alias("low_price"),
        (F.col(f"{metrics}.high_top_of_page_bid_micros") / 1_000_000).alias("high_price"),
        F.col(f"{metrics}.avg_monthly_searches").alias("avg_monthly_traffic"),
        F.col(f"{metrics}.monthly_search_volumes").alias("volumes"),
    )


def flatten_ideas(ideas: DataFrame, asked: DataFrame) -> DataFrame:
    """Monthly traffic rows of ideas that match an asked keyword up to blanks.

    The landed month code is one higher than the month.
    """
    keyed = asked.select("keyword_ask", blank_free(F.col("keyword_ask")).alias("keyword_join"))
    first = keep_first(keyed, ["keyword_join"], [F.asc("keyword_ask")])
    rows = ideas.join(first, "keyword_join").withColumn("_v", F.explode("volumes"))
    month = F.col("_v.month") - 1
    return rows.withColumns(
        {
            "monthly_traffic": F.col("_v.monthly_searches"),
            "year": F.col("_v.year"),
            "month": month,
            "date": F.make_date(F.col("_v.year"), month, F.lit(1)),
        }
    ).drop("_v", "volumes")
