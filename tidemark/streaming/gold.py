"""Silver and gold kept current from new bronze rows alone.

New rows are folded into mergeable states per day and asset and stored beside the
states of earlier batches, so no earlier observation is read again. From there on work is
bounded by what the batch touches:

| table | what a batch reads | what it replaces |
| --- | --- | --- |
| daily states | the batch | its own rows of each touched day |
| fact | states of touched days | touched days |
| ranking, market | fact of touched days | touched days |
| change | fact of touched days and of the days before and after | touched days and the days after |
| history states | fact of touched months | touched months |
| asset summary | history states: a row per asset, label and month | the table |

Every step replaces whole partitions by values that follow from stored rows, so a batch
that failed anywhere may run again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import schema as s
from tidemark.functions import calendar
from tidemark.operators import gold, silver
from tidemark.sources.files import store
from tidemark.streaming.bronze import MAX_FILE_AGE

# our own tables beside silver and gold, and their partition columns
DAILY_STATE = "estado_diario"
HISTORY_STATE = "estado_historico"
BATCH = "lote"

PARTITIONS = {
    DAILY_STATE: (s.DAY, BATCH),
    s.SILVER_FACT: (s.DAY,),
    s.GOLD_RANKING: (s.DAY,),
    s.GOLD_CHANGE: (s.DAY,),
    s.GOLD_MARKET: (s.DAY,),
    HISTORY_STATE: (s.MONTH,),
}


def replace_partitions(df: DataFrame, root: str, name: str) -> None:
    """Write the partitions that `df` has, in place of what they held."""
    keys = PARTITIONS[name]
    (
        df.hint("rebalance", *keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(f"{root}/{name}")
    )


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}")


@dataclass(frozen=True)
class Touched:
    """Days as text, the days before and after them, and their months; each list is no longer
    than the calendar. Text holds days of any year."""

    days: list[str]
    before: list[str]
    after: list[str]
    months: list[str]

    @classmethod
    def of(cls, rows: DataFrame) -> Touched:
        day = F.col(s.DAY)
        near = [day, F.date_add(day, -1), F.date_add(day, 1)]
        texts = [F.collect_set(d.cast("string")) for d in near] + [F.collect_set(calendar.month_of(day))]
        found = rows.select(s.DAY).where(day.isNotNull()).distinct().agg(*texts).first()
        return cls(*(sorted(values) for values in found))

    @classmethod
    def named(cls, spark: SparkSession, days: Iterable[dt.date | str]) -> Touched:
        rows = spark.createDataFrame([(str(day),) for day in days], f"{s.DAY} string")
        return cls.of(rows.select(F.col(s.DAY).cast("date").alias(s.DAY)))


def on_days(*days: list[str]) -> Column:
    """Rows of the given days; on a table partitioned by day, no others are read."""
    return F.col(s.DAY).isin([F.lit(day).cast("date") for day in sorted(set().union(*days))])


def in_months(months: list[str]) -> Column:
    """Rows of the given months; a table partitioned by day is read in these only."""
    return calendar.month_of(s.DAY).isin(months)


def refresh_gold(
    rows: DataFrame,
    root: str,
    batch: int | str,
    *,
    ranking_depth: int = s.RANKING_DEPTH,
    accuracy: int = gold.MEDIAN_ACCURACY,
    processed_at: dt.datetime | str | None = None,
) -> list[str]:
    """Bring silver and gold under `root` up to date with new observations (raw or bronze)
    and return the days they touch. `batch` names the delivery: the same rows under the same
    name may come again and count once."""
    spark = rows.sparkSession
    delta = store(silver.daily_state(rows).withColumn(BATCH, F.lit(str(batch))), "delta")
    touched = Touched.of(delta)
    if touched.days:
        replace_partitions(delta, root, DAILY_STATE)
        rebuild(
            spark, root, touched, ranking_depth=ranking_depth, accuracy=accuracy, processed_at=processed_at
        )
    return touched.days


def rebuild(
    spark: SparkSession,
    root: str,
    touched: Touched,
    *,
    ranking_depth: int = s.RANKING_DEPTH,
    accuracy: int = gold.MEDIAN_ACCURACY,
    processed_at: dt.datetime | str | None = None,
) -> None:
    """Fact and gold of the touched days from the stored states."""
    metrics = silver.metrics_of_states(touched_states(spark, root, touched), processed_at)
    replace_partitions(silver.latest_version(metrics), root, s.SILVER_FACT)

    fact = read_table(spark, root, s.SILVER_FACT)
    days = fact.where(on_days(touched.days))
    replace_partitions(gold.daily_ranking(days, ranking_depth), root, s.GOLD_RANKING)
    replace_partitions(gold.market_summary(days, accuracy), root, s.GOLD_MARKET)
    replace_partitions(change_of_days(fact, touched), root, s.GOLD_CHANGE)
    replace_partitions(history_of_months(fact, touched), root, HISTORY_STATE)
    summary = gold.summary_of_states(read_table(spark, root, HISTORY_STATE))
    summary.write.mode("overwrite").parquet(f"{root}/{s.GOLD_ASSET}")


def touched_states(spark: SparkSession, root: str, touched: Touched) -> DataFrame:
    return read_table(spark, root, DAILY_STATE).where(on_days(touched.days)).drop(BATCH)


def change_of_days(fact: DataFrame, touched: Touched) -> DataFrame:
    """Change on the touched days and on those that follow them, for which they are yesterday."""
    near = fact.where(on_days(touched.before, touched.days, touched.after))
    return gold.change_d1(near).where(on_days(touched.days, touched.after))


def history_of_months(fact: DataFrame, touched: Touched) -> DataFrame:
    """History states of the months the touched days lie in."""
    inside = fact.where(in_months(touched.months)).withColumn(s.MONTH, calendar.month_of(s.DAY))
    return gold.history_state(inside, s.MONTH)


def gold_stream(
    spark: SparkSession,
    bronze_path: str,
    root: str,
    checkpoint: str,
    *,
    files_per_batch: int | None = None,
    **options,
) -> StreamingQuery:
    """Follow bronze and stop when caught up. Late rows need no watermark: they touch an old
    day. `options` as for `refresh_gold`."""

    def update(batch: DataFrame, number: int) -> None:
        refresh_gold(batch, root, number, **options)

    reader = spark.readStream.schema(s.BRONZE).option("maxFileAge", MAX_FILE_AGE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    query = (
        reader.parquet(bronze_path)
        .writeStream.foreachBatch(update)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
