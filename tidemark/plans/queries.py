"""Every operator as a query over the test tables: name -> fn(spark, folder)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schema as s
from tidemark.functions import calendar, numbers
from tidemark.operators import bronze, coverage, gold, ingest, quarantine, reports, silver, sketches
from tidemark.plans.bindings import event_observations, table, trade_observations
from tidemark.plans.ingestion import (
    add_coverage,
    backfill_load,
    daily_load,
    gap_load,
    landed_observations,
    resumable_backfill,
)
from tidemark.plans.market import publish_bronze, refresh_tables
from tidemark.sources import listing, raw
from tidemark.sources.files import store, work_path
from tidemark.sources.tables import publish_bucketed
from tidemark.streaming import bronze as bronze_flow
from tidemark.streaming import cursor as cursor_flow
from tidemark.streaming import dedup as dedup_flow
from tidemark.streaming import evolution as evolution_flow
from tidemark.streaming import gold as gold_flow
from tidemark.streaming import silver as silver_flow

Query = Callable[[SparkSession, str], DataFrame]

# a test day has about twenty assets, so the ranking report is cut at five places
DEPTH = 5
AS_OF = "2024-02-05"
LATE_FROM, LATE_TO = "2024-01-10", "2024-01-12"
OVERLAP_FROM = "2024-01-20 12:00:00"
DAILY_RUNS = ("2024-01-07", "2024-01-19", "2024-01-20", "2024-01-20")
GAPS_SINCE, HALF_DAY = "2024-01-05", "2024-01-15"
BACKFILL = ("2024-01-08 06:00:00", "2024-01-19 18:30:00")


# --- inputs -------------------------------------------------------------------


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return event_observations(table(spark, folder, "events"))


def _fact(spark: SparkSession, folder: str) -> DataFrame:
    return silver.daily_fact(trade_observations(spark, folder))


def _last_caps(spark: SparkSession, folder: str) -> DataFrame:
    """What the share report reads of the asset summary; the rest is never computed."""
    summary = gold.asset_summary(_fact(spark, folder))
    return store(summary.select(s.ASSET, s.LABEL, s.TITLE, reports.LAST_CAP), "summary")


def _raw_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Events as raw rows; money kept as decimals, which every engine spells alike."""
    rows = raw.with_load_partitions(_events(spark, folder))
    return rows.withColumns(
        {
            s.PRICE: F.col(s.PRICE).cast("decimal(18,2)"),
            s.MARKET_CAP: F.col(s.MARKET_CAP).cast("decimal(18,2)"),
            s.TOTAL_VOLUME: F.col(s.TOTAL_VOLUME).cast("bigint"),
        }
    )


def _text_rows(spark: SparkSession, folder: str) -> DataFrame:
    return bronze.to_bronze(_raw_rows(spark, folder)).drop(s.INGESTED_AT)


def _spoiled_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Bronze text where some cells of some rows are unreadable."""
    value = F.col("value").cast("decimal(18,2)").cast("string")

    def every(step: int) -> Column:
        return F.col("event_id") % step == 0

    return table(spark, folder, "events").select(
        F.col("user_id").cast("string").alias(s.ID),
        F.concat(F.lit("U"), F.col("user_id")).alias(s.SYMBOL),
        F.col("event_type").alias(s.NAME),
        F.when(every(101), "zzz").otherwise(F.col("ts").cast("string")).alias(s.TIMESTAMP),
        F.when(every(97), "abc").otherwise(value).alias(s.PRICE),
        F.when(every(89), "").otherwise(value).alias(s.MARKET_CAP),
        (F.col("event_id") % 50).cast("string").alias(s.TOTAL_VOLUME),
    )


def _without_clock(df: DataFrame) -> DataFrame:
    return df.drop(s.PROCESSED_AT, s.LAST_SEEN, s.INGESTED_AT)


# --- raw ----------------------------------------------------------------------


def _land_payloads(
    spark: SparkSession, folder: str, by_day: bool = False, by_asset: bool = False
) -> DataFrame:
    """Events folded into range responses, landed as JSON and read back.

    A response holds one user's events of one block of 256 event ids, so no user's
    whole history is ever gathered into a row; with `by_day` also of one day, and the
    landing is laid out by it. With `by_asset` it is laid out by the buckets of the users,
    as a folder for each would make as many files as there are users.
    """
    days = [F.to_date("ts").alias(s.REQUEST_DAY)] if by_day else []
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    millis = F.timestamp_diff("MILLISECOND", epoch, F.col("ts")).cast("double")
    point = F.struct(
        "event_id",
        F.array(millis, "value").alias("price"),
        F.array(millis, F.col("value") * 2).alias("cap"),
        F.array(millis, (F.col("event_id") % 50).cast("double")).alias("volume"),
    )
    folded = (
        table(spark, folder, "events")
        .groupBy("user_id", F.floor(F.col("event_id") / 256).alias("block"), *days)
        .agg(F.array_sort(F.collect_list(point)).alias("points"))
        .select(
            F.col("user_id").cast("string").alias("coin"),
            F.col("points.price").alias("prices"),
            F.col("points.cap").alias("market_caps"),
            F.col("points.volume").alias("total_volumes"),
            *([s.REQUEST_DAY] if by_day else []),
        )
    )
    landing = work_path(spark, "payloads")
    if by_day:
        folded.hint("rebalance", s.REQUEST_DAY).write.partitionBy(s.REQUEST_DAY).json(landing)
    elif by_asset:
        folded = folded.withColumn(s.COIN_BUCKET, ingest.coin_bucket("coin"))
        folded.hint("rebalance", s.COIN_BUCKET).write.partitionBy(s.COIN_BUCKET).json(landing)
    else:
        folded.write.json(landing)
    return raw.read_payloads(spark, landing)


def _land_listing(spark: SparkSession, folder: str) -> DataFrame:
    """Users as listed assets, the sum of their event values as market cap."""
    key = F.col("user_id").cast("string")
    landing = work_path(spark, "listing")
    (
        table(spark, folder, "events")
        .groupBy(
            key.alias(s.ID),
            F.concat(F.lit("U"), key).alias(s.SYMBOL),
            F.concat(F.lit("user "), key).alias(s.NAME),
        )
        .agg(numbers.exact_sum("value").alias(s.MARKET_CAP))
        .write.json(landing)
    )
    return raw.read_listing(spark, landing)


def _by_instant(rows: DataFrame) -> DataFrame:
    """Time as a number: no clock zone takes part in the comparison."""
    others = [c for c in rows.columns if c != s.TIMESTAMP]
    return rows.select(*others, F.unix_millis(s.TIMESTAMP).alias("ts_ms"))


def payload_flatten(spark: SparkSession, folder: str) -> DataFrame:
    return _by_instant(ingest.flatten_payload(_land_payloads(spark, folder)))


def ingest_backfill(spark: SparkSession, folder: str) -> DataFrame:
    """The samples of the largest assets between two instants, landed JSON to raw."""
    path = work_path(spark, "raw")
    landed = _land_payloads(spark, folder), _land_listing(spark, folder)
    backfill_load(*landed, path, *BACKFILL)
    return _by_instant(raw.read_raw(spark, path).select(s.OBSERVATION_COLUMNS))


def backfill_resume(spark: SparkSession, folder: str) -> DataFrame:
    """A backfill in batches that is cut after the first one and run again."""
    path, ledger = work_path(spark, "raw"), work_path(spark, "ledger")
    landed = _land_payloads(spark, folder, by_asset=True), _land_listing(spark, folder)
    for most in (1, None, None):  # the last run finds nothing left
        resumable_backfill(spark, *landed, path, ledger, *BACKFILL, most_batches=most)
    return _by_instant(raw.read_raw(spark, path).select(s.OBSERVATION_COLUMNS))


def ingest_daily(spark: SparkSession, folder: str) -> DataFrame:
    """A first load, the days that follow it, and a run that finds nothing due."""
    path = work_path(spark, "raw")
    landed = _land_payloads(spark, folder, by_day=True), _land_listing(spark, folder)
    for as_of in DAILY_RUNS:
        daily_load(spark, *landed, path, as_of)
    return _by_instant(raw.read_raw(spark, path).select(s.OBSERVATION_COLUMNS))


def dim_lookup(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select(
        F.col("l_suppkey").cast("string").alias(s.ID),
        F.col("l_shipdate").alias(s.TIMESTAMP),
        F.col("l_extendedprice").alias(s.PRICE),
        "l_orderkey",
        "l_linenumber",
    )
    listing = table(spark, folder, "supplier").select(
        F.col("s_suppkey").cast("string").alias(s.ID),
        F.concat(F.lit("S"), F.col("s_suppkey")).alias(s.SYMBOL),
        F.col("s_name").alias(s.NAME),
    )
    return ingest.attach_dimension(lines, store(ingest.dimension(listing), "dimension"))


def universe_topn(spark: SparkSession, folder: str) -> DataFrame:
    listing = (
        trade_observations(spark, folder)
        .groupBy(s.ID, s.SYMBOL, s.NAME)
        .agg(numbers.exact_sum(s.MARKET_CAP).alias(s.MARKET_CAP))
    )
    return ingest.top_universe(listing)


def _written_raw(spark: SparkSession, folder: str) -> str:
    path = work_path(spark, "raw")
    raw.write_raw(_events(spark, folder), path)
    return path


def ingest_high_water_mark(spark: SparkSession, folder: str) -> DataFrame:
    path = _written_raw(spark, folder)
    return ingest.high_water_mark(raw.read_raw(spark, path))


def ingest_mark_listing(spark: SparkSession, folder: str) -> DataFrame:
    """The last loaded day by the names of raw's folders."""
    day = F.lit(listing.newest_day(spark, _written_raw(spark, folder)))
    return spark.range(1).select(day.cast("date").alias("ultima_data"))


def ingest_window_today(spark: SparkSession, folder: str) -> DataFrame:
    """The days due by today's date, after the last one of raw."""
    rows = raw.with_load_partitions(_events(spark, folder))
    first, last = ingest.load_window(ingest.high_water_mark(rows))
    return spark.range(1).select(first.alias("inicio"), last.alias("fim"))


def _partly_loaded(rows: DataFrame) -> DataFrame:
    """Rows without those of some assets, and without half the assets on one day."""
    number = F.col(s.ID).cast("int")
    new = number % 17 == 3
    half = (F.to_date(s.TIMESTAMP) == F.lit(HALF_DAY).cast("date")) & (number % 2 == 1)
    return rows.where(~new & ~half)


def ingest_gap_plan(spark: SparkSession, folder: str) -> DataFrame:
    """Requests for the days that each user still lacks."""
    rows = _events(spark, folder)
    universe = rows.select(s.ID).distinct()
    covered = coverage.coverage(_partly_loaded(rows))
    return coverage.gap_plan(universe, covered, GAPS_SINCE, AS_OF)


def ingest_gap_load(spark: SparkSession, folder: str) -> DataFrame:
    """Raw with holes, filled from the landing: each sample of the universe once."""
    path, covered = work_path(spark, "raw"), work_path(spark, "coverage")
    landed = _land_payloads(spark, folder, by_day=True), _land_listing(spark, folder)
    rows = ingest.backfill_range(landed_observations(*landed), GAPS_SINCE, "2024-01-25")
    held = store(_partly_loaded(rows), "held")
    raw.write_raw(held, path)
    # the last day held came in up to midnight only, and is loaded again
    add_coverage(held.where(F.col(s.TIMESTAMP) < F.lit("2024-01-25").cast("timestamp")), covered)
    for _ in range(2):  # the second run finds nothing to do but days without samples
        gap_load(spark, *landed, path, covered, GAPS_SINCE, AS_OF)
    return _by_instant(raw.read_raw(spark, path).select(s.OBSERVATION_COLUMNS))


def ingest_plan(spark: SparkSession, folder: str) -> DataFrame:
    rows = raw.with_load_partitions(_events(spark, folder))
    universe = rows.select(s.ID).distinct()
    return ingest.ingest_plan(universe, ingest.high_water_mark(rows), AS_OF)


def backfill_range(spark: SparkSession, folder: str) -> DataFrame:
    return ingest.backfill_range(_events(spark, folder), *BACKFILL)


def asset_batches(spark: SparkSession, folder: str) -> DataFrame:
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_name")
    return ingest.asset_batches(suppliers, order=[F.col("s_suppkey")])


def raw_partitioned_write(spark: SparkSession, folder: str) -> DataFrame:
    path = _written_raw(spark, folder)
    back = raw.read_raw(spark, path)
    return back.groupBy(s.MONTH, s.LOAD_DAY).agg(
        F.count("*").alias("linhas"), numbers.exact_sum(s.PRICE).alias("soma_preco")
    )


def raw_replace_days(spark: SparkSession, folder: str) -> DataFrame:
    """An overlapping second load that replaces its days leaves each row once."""
    path = _written_raw(spark, folder)
    again = ingest.backfill_range(_events(spark, folder), OVERLAP_FROM[:10], "2024-12-31")
    raw.write_raw(again, path, mode="replace_days")
    back = raw.read_raw(spark, path)
    return back.groupBy(s.MONTH, s.LOAD_DAY).agg(
        F.count("*").alias("linhas"), numbers.exact_sum(s.PRICE).alias("soma_preco")
    )


def ingest_overlap(spark: SparkSession, folder: str) -> DataFrame:
    """A second load of half the assets, part of its first day included, merged into
    raw: each sample is there once and the other assets keep their rows."""
    path = _written_raw(spark, folder)
    again = ingest.backfill_range(_events(spark, folder), OVERLAP_FROM, "2024-12-31")
    raw.merge_raw(ingest.dedup_observations(again.where(F.col(s.ID).cast("int") % 2 == 0)), path)
    back = raw.read_raw(spark, path)
    return back.groupBy(s.MONTH, s.LOAD_DAY).agg(
        F.count("*").alias("linhas"), numbers.exact_sum(s.PRICE).alias("soma_preco")
    )


def raw_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = _events(spark, folder)
    overlap = rows.where(F.col(s.TIMESTAMP) >= F.lit(OVERLAP_FROM).cast("timestamp_ntz"))
    return ingest.dedup_observations(rows.unionByName(overlap))


# --- bronze -------------------------------------------------------------------


def bronze_normalize(spark: SparkSession, folder: str) -> DataFrame:
    return _text_rows(spark, folder)


def bronze_quality(spark: SparkSession, folder: str) -> DataFrame:
    return bronze.quality_report(_spoiled_rows(spark, folder))


def bronze_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Two landed loads, each streamed in after it lands, then a run that finds nothing."""
    source, target, checkpoint = (work_path(spark, n) for n in ("raw", "bronze", "offsets"))
    rows = _raw_rows(spark, folder)
    late = F.col(s.LOAD_DAY) >= F.lit(OVERLAP_FROM).cast("date")
    for load in (rows.where(~late), rows.where(late)):
        load.hint("rebalance", s.LOAD_DAY).write.mode("append").partitionBy(
            s.MONTH, s.LOAD_DAY
        ).parquet(source)
        bronze_flow.bronze_stream(spark, source, target, checkpoint, rows.schema)
    bronze_flow.bronze_stream(spark, source, target, checkpoint, rows.schema)
    return bronze_flow.read_bronze(spark, target).drop(s.INGESTED_AT)


def bronze_stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Overlapping loads streamed in by two runs over one checkpoint: each sample is there once.
    The first load repeats a day within itself, the second one repeats days of the first."""
    source, target, checkpoint = (work_path(spark, n) for n in ("raw", "bronze", "offsets"))
    rows = _raw_rows(spark, folder)
    day = F.col(s.LOAD_DAY)
    late, again = F.lit(OVERLAP_FROM).cast("date"), F.lit(LATE_FROM).cast("date")
    early = rows.where(day < late)
    for load in (early.unionByName(rows.where(day == again)), rows.where(day >= again)):
        load.hint("rebalance", s.LOAD_DAY).write.mode("append").partitionBy(
            s.MONTH, s.LOAD_DAY
        ).parquet(source)
        dedup_flow.bronze_stream_dedup(spark, source, target, checkpoint, rows.schema)
    return bronze_flow.read_bronze(spark, target).drop(s.INGESTED_AT)


def bronze_stream_cursor(spark: SparkSession, folder: str) -> DataFrame:
    """Two landed loads, the second with late files of an old day, month by month; then a run
    in which no month has changed."""
    source, target, checkpoints = (work_path(spark, n) for n in ("raw", "bronze", "offsets"))
    rows = _raw_rows(spark, folder)
    early = F.col(s.LOAD_DAY) < F.lit(OVERLAP_FROM).cast("date")
    old = (F.col(s.LOAD_DAY) == F.lit(LATE_FROM).cast("date")) & (F.col(s.NAME) == "purchase")
    for load in (rows.where(early & ~old), rows.where(~early | old)):
        load.hint("rebalance", s.LOAD_DAY).write.mode("append").partitionBy(
            s.MONTH, s.LOAD_DAY
        ).parquet(source)
        cursor_flow.bronze_by_month(spark, source, target, checkpoints, rows.schema)
    cursor_flow.bronze_by_month(spark, source, target, checkpoints, rows.schema)
    return cursor_flow.read_bronze_by_month(spark, target).drop(s.INGESTED_AT)


def schema_evolution(spark: SparkSession, folder: str) -> DataFrame:
    """The second load brings a new column; the stream restarts with a wider schema."""
    source, target, checkpoint = (work_path(spark, n) for n in ("raw", "wide", "offsets"))
    wide = table(spark, folder, "events").select("event_id", "ts", "user_id", "event_type")
    narrow = wide.drop("event_type")
    late = F.col("ts") >= F.lit(OVERLAP_FROM).cast("timestamp_ntz")
    for load in (narrow.where(~late), wide.where(late)):
        load.write.mode("append").parquet(source)
        stream = bronze_flow.raw_stream(spark, source, load.schema)
        bronze_flow.append_stream(stream, target, checkpoint)
    return spark.read.schema(wide.schema).parquet(target)


def schema_evolution_auto(spark: SparkSession, folder: str) -> DataFrame:
    """The same loads, where nobody tells the stream of the new column."""
    source, target, checkpoint = (work_path(spark, n) for n in ("raw", "wide", "offsets"))
    wide = table(spark, folder, "events").select("event_id", "ts", "user_id", "event_type")
    late = F.col("ts") >= F.lit(OVERLAP_FROM).cast("timestamp_ntz")
    for load in (wide.drop("event_type").where(~late), wide.where(late)):
        load.write.mode("append").parquet(source)
        schema = evolution_flow.evolving_stream(spark, source, target, checkpoint)
    return evolution_flow.read_evolved(spark, target, schema)


def bronze_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Spoiled rows, some of assets that are not listed, loaded with a quarantine: what was
    kept and what was rejected, by reason, read back from the two tables."""
    kept, rejected = work_path(spark, "bronze"), work_path(spark, "rejected")
    ids = table(spark, folder, "events").select(F.col("user_id").cast("string").alias(s.ID)).distinct()
    listed = ids.where(F.col(s.ID).cast("int") % 13 != 5)
    counts = quarantine.load(_spoiled_rows(spark, folder), kept, rejected, listed)
    tables = spark.read.parquet(kept).select(F.lit(quarantine.KEPT).alias(quarantine.REASON)).unionAll(
        spark.read.parquet(rejected).select(quarantine.REASON)
    )
    reported = F.create_map(*[F.lit(x) for reason in counts for x in (reason, counts[reason])])
    return (
        tables.groupBy(quarantine.REASON)
        .agg(F.count("*").alias("linhas"))
        .select("*", reported[F.col(quarantine.REASON)].cast("bigint").alias("observadas"))
    )


# --- silver -------------------------------------------------------------------


def silver_daily(spark: SparkSession, folder: str) -> DataFrame:
    return _without_clock(silver.daily_metrics(trade_observations(spark, folder)))


def silver_from_text(spark: SparkSession, folder: str) -> DataFrame:
    return _without_clock(silver.daily_metrics(_spoiled_rows(spark, folder)))


def silver_latest(spark: SparkSession, folder: str) -> DataFrame:
    return _without_clock(silver.daily_fact(_events(spark, folder)))


def _landed_in_two(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Events on time, and the purchases of a few days that arrive later."""
    rows = _raw_rows(spark, folder)
    late = F.col(s.LOAD_DAY).between(
        F.lit(LATE_FROM).cast("date"), F.lit(LATE_TO).cast("date")
    ) & (F.col(s.NAME) == "purchase")
    return rows.where(~late), rows.where(late)


def silver_refresh_touched(spark: SparkSession, folder: str) -> DataFrame:
    target, silver_path = work_path(spark, "bronze"), work_path(spark, "silver")
    for load in _landed_in_two(spark, folder):
        text = bronze.to_bronze(load)
        text.hint("rebalance", s.LOAD_DAY).write.mode("append").partitionBy(
            s.LOAD_DAY
        ).parquet(target)
        current = bronze_flow.read_bronze(spark, target)
        silver_flow.refresh_touched(current, silver_path, silver_flow.touched_days(text))
    return _without_clock(silver_flow.read_silver(spark, silver_path))


def silver_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Raw to bronze to silver, both steps streaming, with a late second load."""
    names = ("raw", "bronze", "silver", "offsets", "offsets")
    source, target, silver_path, first, second = (work_path(spark, n) for n in names)
    for load in _landed_in_two(spark, folder):
        load.hint("rebalance", s.LOAD_DAY).write.mode("append").partitionBy(
            s.MONTH, s.LOAD_DAY
        ).parquet(source)
        bronze_flow.bronze_stream(spark, source, target, first, load.schema)
        silver_flow.silver_stream(spark, target, silver_path, second)
    return _without_clock(silver_flow.read_silver(spark, silver_path))


# --- gold ---------------------------------------------------------------------


def gold_ranking(spark: SparkSession, folder: str) -> DataFrame:
    return gold.daily_ranking(store(_fact(spark, folder), "fact"), DEPTH)


def gold_ranking_spread(spark: SparkSession, folder: str) -> DataFrame:
    """The ranking as computed for oversized days, here for every day."""
    fact = store(_fact(spark, folder), "fact")
    return gold.daily_ranking(fact, DEPTH, day_rows_per_task=0)


def gold_ranking_null_days(spark: SparkSession, folder: str) -> DataFrame:
    """The ranking of oversized days beside rows that have no day."""
    fact = _fact(spark, folder)
    day = F.when(F.dayofmonth(s.DAY) % 3 != 0, F.col(s.DAY))
    fact = store(fact.withColumn(s.DAY, day), "fact")
    return gold.daily_ranking(fact, DEPTH, day_rows_per_task=0)


def _large(spark: SparkSession, folder: str) -> DataFrame:
    """The fact of trades whose amounts are scaled by 10^15 to 10^25."""
    scale = F.lit(1e15) * F.pow(F.lit(10.0), F.col(s.ID).cast("int") % 11)
    trades = trade_observations(spark, folder)
    return silver.daily_fact(
        trades.withColumns({c: F.col(c) * scale for c in (s.PRICE, s.MARKET_CAP)})
    )


def silver_large_values(spark: SparkSession, folder: str) -> DataFrame:
    """Magnitudes of the daily means, compared to six digits of their logarithm."""
    return _large(spark, folder).select(
        s.DAY,
        s.ASSET,
        F.round(F.log10(s.MEAN_PRICE), 6).alias("ordem_preco"),
        F.round(F.log10(s.MEAN_CAP), 6).alias("ordem_valor"),
    )


def gold_market_large_values(spark: SparkSession, folder: str) -> DataFrame:
    """Magnitudes of the market's totals and means over such a fact."""
    summary = gold.market_summary(_large(spark, folder))
    return summary.select(
        s.DAY,
        F.round(F.log10("valor_mercado_total_usd"), 6).alias("ordem_total"),
        F.round(F.log10("valor_mercado_medio_por_moeda_usd"), 6).alias("ordem_media"),
        F.round(F.log10("preco_medio_geral_usd"), 6).alias("ordem_preco"),
    )


def gold_ranking_top100(spark: SparkSession, folder: str) -> DataFrame:
    fact = silver.daily_fact(_events(spark, folder))
    return gold.daily_ranking(store(fact, "fact"))


def gold_change_d1(spark: SparkSession, folder: str) -> DataFrame:
    return gold.change_d1(_fact(spark, folder))


def gold_change_d1_events(spark: SparkSession, folder: str) -> DataFrame:
    return gold.change_d1(silver.daily_fact(_events(spark, folder)))


def gold_top_by_day(spark: SparkSession, folder: str) -> DataFrame:
    return gold.top_by_day(_fact(spark, folder), s.MEAN_CAP, "top_valor_mercado")


def gold_top_volume_by_day(spark: SparkSession, folder: str) -> DataFrame:
    return gold.top_by_day(_fact(spark, folder), s.MEAN_VOLUME, "top_volume")


def gold_market_summary(spark: SparkSession, folder: str) -> DataFrame:
    return gold.market_summary(_fact(spark, folder))


def first_last_day(spark: SparkSession, folder: str) -> DataFrame:
    return gold.first_last_day(_fact(spark, folder))


def gold_asset_summary(spark: SparkSession, folder: str) -> DataFrame:
    return gold.asset_summary(_fact(spark, folder))


# --- reports ------------------------------------------------------------------


def report_top20(spark: SparkSession, folder: str) -> DataFrame:
    return reports.top_by_last_cap(gold.asset_summary(_fact(spark, folder)))


def report_latest_price(spark: SparkSession, folder: str) -> DataFrame:
    fact = silver.daily_fact(_events(spark, folder))
    return reports.latest_prices(store(fact.drop(s.MEAN_CAP, s.MEAN_VOLUME), "fact"))


def report_share(spark: SparkSession, folder: str) -> DataFrame:
    return reports.market_share(_last_caps(spark, folder))


def report_share_all(spark: SparkSession, folder: str) -> DataFrame:
    return reports.market_share(_last_caps(spark, folder), None)


def widget_price(spark: SparkSession, folder: str) -> DataFrame:
    return reports.sum_by(report_latest_price(spark, folder), "preco_usd")


def widget_volume(spark: SparkSession, folder: str) -> DataFrame:
    return reports.sum_by(report_top20(spark, folder), "volume_ultimo_dia_bi_usd")


def widget_share(spark: SparkSession, folder: str) -> DataFrame:
    return reports.sum_by(report_share(spark, folder), "participacao_percentual")


# --- all layers ---------------------------------------------------------------

_MEANS = (s.MEAN_PRICE, s.MEAN_CAP, s.MEAN_VOLUME)

# per table: first day, last day, and every column with numbers
CONTROLS = {
    s.SILVER_DAILY: (s.DAY, s.DAY, _MEANS),
    s.SILVER_FACT: (s.DAY, s.DAY, _MEANS),
    s.GOLD_RANKING: (s.DAY, s.DAY, (*_MEANS, *gold.RANKS)),
    s.GOLD_CHANGE: (
        s.DAY,
        s.DAY,
        (s.MEAN_PRICE, "preco_medio_ontem_usd", "variacao_abs_d1_usd", "variacao_pct_d1"),
    ),
    s.GOLD_MARKET: (
        s.DAY,
        s.DAY,
        (
            "qtd_moedas",
            "valor_mercado_total_usd",
            "volume_total_usd",
            "preco_medio_geral_usd",
            "preco_mediano_geral_usd",
            "valor_mercado_medio_por_moeda_usd",
            "volume_medio_por_moeda_usd",
            "top_valor_mercado_usd",
            "top_volume_usd",
        ),
    ),
    s.GOLD_ASSET: (
        "data_primeiro_dia",
        "data_ultimo_dia",
        (
            "qtd_dias_com_dados",
            "preco_medio_historico_usd",
            "preco_min_historico_usd",
            "preco_max_historico_usd",
            "preco_primeiro_dia_usd",
            "preco_ultimo_dia_usd",
            "variacao_percentual_total",
            "valor_mercado_medio_historico_usd",
            "volume_medio_historico_usd",
            "valor_mercado_ultimo_dia_usd",
            "volume_ultimo_dia_usd",
            "valor_mercado_medio_historico_bi_usd",
            "volume_medio_historico_bi_usd",
            "valor_mercado_ultimo_dia_bi_usd",
            "volume_ultimo_dia_bi_usd",
        ),
    ),
}


def _controls(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count, days covered and the total of each column with numbers, per table."""
    controls = None
    for name, (first, last, figures) in CONTROLS.items():
        if name not in tables:
            continue
        totals = [
            F.struct(F.lit(c).alias("coluna"), numbers.exact_sum(c).alias("total_controle"))
            for c in figures
        ]
        lines = (
            tables[name]
            .agg(
                F.count("*").alias("linhas"),
                F.min(first).alias("primeiro_dia"),
                F.max(last).alias("ultimo_dia"),
                F.array(*totals).alias("totais"),
            )
            .select(F.lit(name).alias("tabela"), "linhas", "primeiro_dia", "ultimo_dia", F.inline("totais"))
        )
        controls = lines if controls is None else controls.unionByName(lines)
    return controls


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """Refresh every table from bronze text, then report row count, days covered and the
    total of each column with numbers."""
    rows = raw.with_load_partitions(trade_observations(spark, folder))
    tables = refresh_tables(
        bronze.to_bronze(rows), work_path(spark, "tables"), ranking_depth=DEPTH
    )
    return _controls(tables)


def gold_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """Fact and gold kept current batch by batch, with a late second load and one delivery
    that comes again; the same controls as of a full refresh."""
    source, target, root, first, second = (
        work_path(spark, n) for n in ("raw", "bronze", "marts", "offsets", "offsets")
    )
    for load in _landed_in_two(spark, folder):
        load.hint("rebalance", s.LOAD_DAY).write.mode("append").partitionBy(
            s.MONTH, s.LOAD_DAY
        ).parquet(source)
        bronze_flow.bronze_stream(spark, source, target, first, load.schema)
        gold_flow.gold_stream(spark, target, root, second, ranking_depth=DEPTH)
    gold_flow.refresh_gold(bronze.to_bronze(load), root, 1, ranking_depth=DEPTH)
    kept = [name for name in CONTROLS if name != s.SILVER_DAILY]
    return _controls({name: gold_flow.read_table(spark, root, name) for name in kept})


def gold_median_range(spark: SparkSession, folder: str) -> DataFrame:
    """The median price of each month and of all days, merged from stored daily sketches, and
    whether its rank is as near to the middle as stated."""
    fact = store(_fact(spark, folder).select(s.DAY, s.MEAN_PRICE), "fact")
    daily = store(sketches.daily_sketches(fact), "sketches")
    month = calendar.month_of(s.DAY)
    medians = sketches.quantile_of(daily.withColumn(s.MONTH, month), 0.5, s.MONTH)
    whole = sketches.quantile_of(daily.withColumn(s.MONTH, F.lit("todos")), 0.5, s.MONTH)
    rows = fact.withColumn(s.MONTH, F.explode(F.array(month, F.lit("todos"))))
    value = F.col(sketches.VALUE)
    # one row per month: unless it is broadcast, all days' values may meet in one task
    medians = F.broadcast(medians.unionByName(whole))
    checked = rows.join(medians, s.MONTH).groupBy(s.MONTH, sketches.COUNT)
    ranks = checked.agg(
        F.avg((F.col(s.MEAN_PRICE) < value).cast("int")).alias("abaixo"),
        F.avg((F.col(s.MEAN_PRICE) <= value).cast("int")).alias("ate"),
    )
    near = (F.col("abaixo") <= 0.5 + sketches.RANK_ERROR) & (F.col("ate") >= 0.5 - sketches.RANK_ERROR)
    return ranks.select(s.MONTH, sketches.COUNT, near.alias("dentro_do_limite"))


def gold_bucketed(spark: SparkSession, folder: str) -> DataFrame:
    """Change, first and last day, and history off a fact in buckets by asset: their controls."""
    database, place = f"marts_{uuid.uuid4().hex}", work_path(spark, "catalog")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{place}'")
    fact = publish_bucketed(
        _fact(spark, folder), work_path(spark, "tables"), s.SILVER_FACT,
        database=database, bucket_by=s.ASSET, sort_by=s.DAY, buckets=8,
    )
    tables = {s.GOLD_CHANGE: gold.change_d1(fact), s.GOLD_ASSET: gold.asset_summary(fact)}
    ends = gold.first_last_day(fact)
    first_last = ends.agg(
        F.lit("primeiro_e_ultimo_dia").alias("tabela"),
        F.count("*").alias("linhas"),
        F.min("data_primeiro_dia").alias("primeiro_dia"),
        F.max("data_ultimo_dia").alias("ultimo_dia"),
        F.lit("preco_ultimo_dia_usd").alias("coluna"),
        numbers.exact_sum("preco_ultimo_dia_usd").alias("total_controle"),
    )
    return _controls(tables).unionByName(first_last)


def catalog_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Every layer published under a name, then looked up by it: rows, comment and tag."""
    names = ("raw", "bronze", "offsets", "tables", "catalog")
    source, target, checkpoint, root, place = (work_path(spark, n) for n in names)
    database = f"marts_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{place}'")
    raw.write_raw(_events(spark, folder), source)
    bronze_flow.bronze_stream(spark, source, target, checkpoint)
    text = publish_bronze(spark, target, database)
    tables = [s.BRONZE_TABLE, *refresh_tables(text, root, database=database)]
    found = None
    for name in tables:
        about = {
            r.col_name: r.data_type
            for r in spark.sql(f"DESCRIBE TABLE EXTENDED {database}.{name}").collect()
        }
        tag = spark.sql(f"SHOW TBLPROPERTIES {database}.{name} ('quality')").first()
        line = spark.table(f"{database}.{name}").agg(
            F.lit(name).alias("tabela"),
            F.count("*").alias("linhas"),
            F.lit(about.get("Comment")).alias("comentario"),
            F.lit(tag["value"]).alias("qualidade"),
        )
        found = line if found is None else found.unionByName(line)
    return found


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        flagship,
        catalog_tables,
        payload_flatten,
        ingest_backfill,
        backfill_resume,
        ingest_daily,
        dim_lookup,
        universe_topn,
        ingest_high_water_mark,
        ingest_mark_listing,
        ingest_plan,
        ingest_window_today,
        ingest_gap_plan,
        ingest_gap_load,
        backfill_range,
        asset_batches,
        raw_partitioned_write,
        raw_replace_days,
        ingest_overlap,
        raw_dedup,
        bronze_normalize,
        bronze_quality,
        bronze_stream,
        bronze_stream_dedup,
        bronze_stream_cursor,
        schema_evolution,
        schema_evolution_auto,
        bronze_quarantine,
        silver_daily,
        silver_from_text,
        silver_latest,
        silver_refresh_touched,
        silver_stream,
        gold_ranking,
        gold_ranking_spread,
        gold_ranking_null_days,
        silver_large_values,
        gold_market_large_values,
        gold_ranking_top100,
        gold_change_d1,
        gold_change_d1_events,
        gold_top_by_day,
        gold_top_volume_by_day,
        gold_market_summary,
        first_last_day,
        gold_asset_summary,
        gold_incremental,
        gold_median_range,
        gold_bucketed,
        report_top20,
        report_latest_price,
        report_share,
        report_share_all,
        widget_price,
        widget_volume,
        widget_share,
    )
}
