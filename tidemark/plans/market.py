"""The table refresh: observations in, silver and gold tables out."""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from tidemark import schema as s
from tidemark.operators import gold, silver
from tidemark.sources.tables import publish, publish_stream

# comments the tables carry in the catalog
COMMENTS = {
    s.BRONZE_TABLE: "Landed observations as text, each file once.",
    s.SILVER_DAILY: "Daily means per asset, symbol and name.",
    s.SILVER_FACT: "One row per asset and day, newest version.",
    s.GOLD_RANKING: "Daily ranking by market cap and by volume, ties kept.",
    s.GOLD_CHANGE: "Mean price against the previous calendar day.",
    s.GOLD_MARKET: "Daily market totals, means, median and leaders.",
    s.GOLD_ASSET: "History per asset with the values of its last day.",
}


def gold_tables(
    fact: DataFrame, ranking_depth: int = s.RANKING_DEPTH, accuracy: int = gold.MEDIAN_ACCURACY
) -> dict[str, DataFrame]:
    """The four gold products of a stored fact, not yet written."""
    return {
        s.GOLD_RANKING: gold.daily_ranking(fact, ranking_depth),
        s.GOLD_CHANGE: gold.change_d1(fact),
        s.GOLD_MARKET: gold.market_summary(fact, accuracy),
        s.GOLD_ASSET: gold.asset_summary(fact),
    }


def publish_bronze(spark: SparkSession, path: str, database: str) -> DataFrame:
    """Name the bronze layer that a stream keeps at `path`."""
    return publish_stream(
        spark,
        path,
        s.BRONZE_TABLE,
        s.BRONZE,
        database=database,
        comment=COMMENTS[s.BRONZE_TABLE],
        quality="bronze",
    )


def refresh_tables(
    observations: DataFrame,
    root: str,
    *,
    database: str | None = None,
    ranking_depth: int = s.RANKING_DEPTH,
    processed_at: dt.datetime | str | None = None,
    accuracy: int = gold.MEDIAN_ACCURACY,
    silver_by_day: bool = False,
) -> dict[str, DataFrame]:
    """Recompute every table from observations (raw or bronze) and return them.

    Each layer is stored before the next reads it, so the fact is computed once for
    its four readers. Those are independent jobs and run side by side. With
    `silver_by_day` the silver tables are partitioned by day, so that reports on the
    newest day and later refreshes of single days leave the other days unread.
    """

    def put(name: str, df: DataFrame, quality: str) -> DataFrame:
        by_day = silver_by_day and quality == "silver"
        return publish(
            df,
            root,
            name,
            database=database,
            comment=COMMENTS[name],
            quality=quality,
            partition_by=s.DAY if by_day else None,
        )

    daily = put(s.SILVER_DAILY, silver.daily_metrics(observations, processed_at), "silver")
    fact = put(s.SILVER_FACT, silver.latest_version(daily), "silver")
    golds = gold_tables(fact, ranking_depth, accuracy)
    with ThreadPoolExecutor(len(golds)) as pool:
        written = pool.map(lambda item: put(*item, "gold"), golds.items())
        return {
            s.SILVER_DAILY: daily,
            s.SILVER_FACT: fact,
            **dict(zip(golds, written, strict=True)),
        }
