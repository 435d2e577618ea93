"""Gold: ranking, day-over-day change, market summary and asset history.

All operators take the silver fact, which holds one row per (day, asset). That grain
bounds an asset's group by the calendar; a day's group is bounded only by the number
of assets, so nothing here sorts a whole day unless its size was checked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark import schema as s
from tidemark.functions import numbers, ordering
from tidemark.operators import placement

RANKS = {"rank_valor_mercado": s.MEAN_CAP, "rank_volume": s.MEAN_VOLUME}

_MEASURES = (s.MEAN_PRICE, s.MEAN_CAP, s.MEAN_VOLUME)

# a day with more assets than this is ranked across the cluster, not in one task
DAY_ROWS_PER_TASK = 1_000_000

# of the approximate median: its rank is off by at most 1 / accuracy of the rows
MEDIAN_ACCURACY = 10_000


def daily_ranking(
    fact: DataFrame,
    n: int = s.RANKING_DEPTH,
    *,
    ranks: dict[str, str] | None = None,
    day_rows_per_task: int = DAY_ROWS_PER_TASK,
) -> DataFrame:
    """Assets within the first `n` places of their day by any measure, ties kept.

    A kept row shows its true place by every measure, so all of a day's values count.
    Day sizes are checked first (one pass over the day column; give a stored fact):
    small days share one window shuffle, larger ones are ranked from their distinct
    values spread over the cluster.
    """
    ranks = ranks or RANKS
    columns = [c for c in fact.columns if c != s.PROCESSED_AT]
    fact = fact.select(*columns)
    large = placement.groups_over(fact, s.DAY, day_rows_per_task)
    if large:
        # rows without a day are one small or large group like others
        named = F.col(s.DAY).isin([day for day in large if day is not None])
        in_large = F.when(F.col(s.DAY).isNull(), F.lit(None in large)).otherwise(named)
        ranked = placement.window_dense_ranks(fact.where(~in_large), s.DAY, ranks)
        spread = placement.spread_dense_ranks(fact.where(in_large), s.DAY, ranks, n)
        ranked = ranked.unionByName(spread)
    else:
        ranked = placement.window_dense_ranks(fact, s.DAY, ranks)
    placed = F.lit(False)
    for rank in ranks:
        placed = placed | (F.col(rank) <= n)
    return ranked.where(placed)


def change_d1(fact: DataFrame) -> DataFrame:
    """Price against the previous calendar day; null after a gap.

    The row before, per asset by date, is yesterday exactly when its date says so.
    One shuffle of the fact replaces a join of the fact with itself.
    """
    by_day = W.partitionBy(s.ASSET).orderBy(s.DAY)
    follows = F.lag(s.DAY).over(by_day) == F.date_add(s.DAY, -1)
    before = F.when(follows & F.col(s.ASSET).isNotNull(), F.lag(s.MEAN_PRICE).over(by_day))
    now, then = F.col(s.MEAN_PRICE), F.col("preco_medio_ontem_usd")
    return fact.select(
        s.DAY, s.ASSET, s.LABEL, s.TITLE, s.MEAN_PRICE, before.alias("preco_medio_ontem_usd")
    ).select(
        "*",
        numbers.half_up_of_many(now - then, s.PRICE_DIGITS).alias("variacao_abs_d1_usd"),
        numbers.percent_change(now, then, s.PRICE_DIGITS).alias("variacao_pct_d1"),
    )


def top_by_day(fact: DataFrame, measure: str, prefix: str) -> DataFrame:
    """Each day's first asset by `measure` (ties: smallest id): id, symbol, name, value."""
    return fact.groupBy(s.DAY).agg(_top(measure).alias("top")).select(
        s.DAY, *_top_columns("top", prefix)
    )


def market_summary(fact: DataFrame, accuracy: int = MEDIAN_ACCURACY) -> DataFrame:
    """Per day: asset count, totals, means, approximate median and the two leaders.

    One aggregate over one scan. Every part combines before the shuffle, the leaders
    included, so no join and no window over a whole day is needed.
    """
    median = F.percentile_approx(s.MEAN_PRICE, 0.5, accuracy)
    return (
        numbers.with_summable(fact, *_MEASURES)
        .groupBy(s.DAY)
        .agg(
            F.count("*").alias("qtd_moedas"),
            numbers.total_of_parts(s.MEAN_CAP, s.MONEY_DIGITS).alias("valor_mercado_total_usd"),
            numbers.total_of_parts(s.MEAN_VOLUME, s.MONEY_DIGITS).alias("volume_total_usd"),
            numbers.mean_of_parts(s.MEAN_PRICE, s.PRICE_DIGITS).alias("preco_medio_geral_usd"),
            numbers.half_up(median, s.PRICE_DIGITS).alias("preco_mediano_geral_usd"),
            numbers.mean_of_parts(s.MEAN_CAP, s.MONEY_DIGITS).alias(
                "valor_mercado_medio_por_moeda_usd"
            ),
            numbers.mean_of_parts(s.MEAN_VOLUME, s.MONEY_DIGITS).alias(
                "volume_medio_por_moeda_usd"
            ),
            _top(s.MEAN_CAP).alias("by_cap"),
            _top(s.MEAN_VOLUME).alias("by_volume"),
        )
        .select(
            "*",
            *_top_columns("by_cap", "top_valor_mercado"),
            *_top_columns("by_volume", "top_volume"),
        )
        .drop("by_cap", "by_volume")
    )


def first_last_day(fact: DataFrame) -> DataFrame:
    """Per asset: price on its first day; price, cap and volume on its last day."""
    return fact.groupBy(s.ASSET).agg(
        F.min(s.DAY).alias("data_primeiro_dia"),
        F.max(s.DAY).alias("data_ultimo_dia"),
        *_ends(),
    )


_FIRST, _LAST = "data_primeiro_dia", "data_ultimo_dia"


def asset_summary(fact: DataFrame) -> DataFrame:
    """History of each asset with its values on its own first and last day.

    After a rename the alphabetically greatest symbol and name are shown. The days are
    folded per asset and label first: with the texts as keys, all aggregated values are
    numbers and dates, which Spark hashes in place, while a greatest text per asset
    would have it sort the fact. The second step sees one row per asset and label.
    """
    return summary_of_states(history_state(fact))


def history_state(fact: DataFrame, *within: str) -> DataFrame:
    """Days of the fact folded per asset, symbol and name, and the columns in `within`: sums,
    counts, extremes, first and last values. States of different days merge."""
    split = numbers.with_summable(fact, *_MEASURES)
    return split.groupBy(*within, s.ASSET, s.LABEL, s.TITLE).agg(
        F.min(s.DAY).alias(_FIRST),
        F.max(s.DAY).alias(_LAST),
        F.count("*").alias("dias"),
        *numbers.state_columns(*_MEASURES),
        F.min(s.MEAN_PRICE).alias("menor"),
        F.max(s.MEAN_PRICE).alias("maior"),
        *_ends(),
    )


def summary_of_states(states: DataFrame) -> DataFrame:
    """The asset summary of all days behind the states."""
    mean_cap = "valor_mercado_medio_historico_usd"
    mean_volume = "volume_medio_historico_usd"
    last_cap = "valor_mercado_ultimo_dia_usd"
    last_volume = "volume_ultimo_dia_usd"
    first, last = _FIRST, _LAST

    history = states.groupBy(s.ASSET).agg(
        F.max(s.LABEL).alias(s.LABEL),
        F.max(s.TITLE).alias(s.TITLE),
        F.min(first).alias(first),
        F.max(last).alias(last),
        F.sum("dias").alias("qtd_dias_com_dados"),
        numbers.mean_of_states(s.MEAN_PRICE, s.PRICE_DIGITS).alias("preco_medio_historico_usd"),
        numbers.half_up(F.min("menor"), s.PRICE_DIGITS).alias("preco_min_historico_usd"),
        numbers.half_up(F.max("maior"), s.PRICE_DIGITS).alias("preco_max_historico_usd"),
        numbers.mean_of_states(s.MEAN_CAP, s.MONEY_DIGITS).alias(mean_cap),
        numbers.mean_of_states(s.MEAN_VOLUME, s.MONEY_DIGITS).alias(mean_volume),
        ordering.earliest("preco_primeiro_dia_usd", first).alias("preco_primeiro_dia_usd"),
        ordering.newest("preco_ultimo_dia_usd", last).alias("preco_ultimo_dia_usd"),
        ordering.newest(last_cap, last).alias(last_cap),
        ordering.newest(last_volume, last).alias(last_volume),
    )
    total_change = numbers.percent_change(
        F.col("preco_ultimo_dia_usd"), F.col("preco_primeiro_dia_usd"), s.PRICE_DIGITS
    )
    return history.select(
        s.ASSET,
        s.LABEL,
        s.TITLE,
        "data_primeiro_dia",
        "data_ultimo_dia",
        "qtd_dias_com_dados",
        "preco_medio_historico_usd",
        "preco_min_historico_usd",
        "preco_max_historico_usd",
        "preco_primeiro_dia_usd",
        "preco_ultimo_dia_usd",
        total_change.alias("variacao_percentual_total"),
        mean_cap,
        mean_volume,
        last_cap,
        last_volume,
        *[
            numbers.billions(column, 2).alias(column.replace("_usd", "_bi_usd"))
            for column in (mean_cap, mean_volume, last_cap, last_volume)
        ],
    )


def _top(measure: str):
    row = F.struct(
        F.col(s.ASSET).alias("id_moeda"),
        F.col(s.LABEL).alias("simbolo"),
        F.col(s.TITLE).alias("nome"),
        F.col(measure).alias("usd"),
    )
    return ordering.leader(row, measure, s.ASSET)


def _top_columns(row: str, prefix: str) -> list:
    fields = ("id_moeda", "simbolo", "nome", "usd")
    return [F.col(f"{row}.{field}").alias(f"{prefix}_{field}") for field in fields]


def _ends() -> list:
    return [
        ordering.earliest(s.MEAN_PRICE, s.DAY).alias("preco_primeiro_dia_usd"),
        ordering.newest(s.MEAN_PRICE, s.DAY).alias("preco_ultimo_dia_usd"),
        ordering.newest(s.MEAN_CAP, s.DAY).alias("valor_mercado_ultimo_dia_usd"),
        ordering.newest(s.MEAN_VOLUME, s.DAY).alias("volume_ultimo_dia_usd"),
    ]
