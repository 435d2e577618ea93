"""Gold and reports on a small market with ties, nulls, a gap and a zero base."""

import pytest
from conftest import keyed, observations
from pyspark.sql import functions as F

from tidemark import schema as s
from tidemark.operators import gold, reports, silver
from tidemark.sources.files import store


@pytest.fixture
def fact(market):
    return silver.daily_fact(market, "2024-03-05 00:00:00")


def test_silver(fact):
    rows = keyed(fact, s.DAY, s.ASSET)
    measures = (s.MEAN_PRICE, s.MEAN_CAP, s.MEAN_VOLUME)
    day = {k[1]: tuple(v[m] for m in measures) for k, v in rows.items() if k[0] == "2024-02-28"}
    assert day == {"btc": (105, 1100, 15), "eth": (0, 1100, 15), "xrp": (1.02, None, 7)}
    assert fact.columns == [*s.FACT_COLUMNS, s.PROCESSED_AT]


@pytest.mark.parametrize("limit", [10**6, 0])
def test_ranking(fact, limit):
    ranked = gold.daily_ranking(store(fact), day_rows_per_task=limit)
    rows = keyed(ranked, s.DAY, s.ASSET)
    places = {
        k[1]: (v["rank_valor_mercado"], v["rank_volume"])
        for k, v in rows.items()
        if k[0] == "2024-02-28"
    }
    assert places == {"btc": (1, 1), "eth": (1, 1), "xrp": (2, 2)}
    # a null measure is placed last but placed
    assert rows["2024-02-29", "eth"]["rank_volume"] == 2
    assert len(rows) == 7


@pytest.mark.parametrize("limit", [10**6, 1, 0])
def test_ranking_keeps_either_measure(spark, limit):
    rows = [(f"a{i}", "2024-01-01 00:00:00", 1.0, float(i), float(9 - i)) for i in range(10)]
    rows += [("b", "2024-01-02 00:00:00", 1.0, 1.0, 1.0)]
    fact = store(silver.daily_fact(observations(spark, rows)))
    kept = keyed(gold.daily_ranking(fact, 2, day_rows_per_task=limit), s.ASSET)
    assert sorted(kept) == ["a0", "a1", "a8", "a9", "b"]
    assert (kept["a9"]["rank_valor_mercado"], kept["a9"]["rank_volume"]) == (1, 10)


def test_change(fact):
    rows = keyed(gold.change_d1(fact), s.DAY, s.ASSET)
    change = {k: (v["variacao_abs_d1_usd"], v["variacao_pct_d1"]) for k, v in rows.items()}
    assert change == {
        ("2024-02-28", "btc"): (None, None),
        ("2024-02-29", "btc"): (21, 20),
        ("2024-03-01", "btc"): (-63, -50),
        ("2024-02-28", "eth"): (None, None),
        ("2024-02-29", "eth"): (5, None),
        ("2024-03-02", "eth"): (None, None),
        ("2024-02-28", "xrp"): (None, None),
    }


def test_market_summary(fact):
    rows = keyed(gold.market_summary(fact), s.DAY)
    first = rows["2024-02-28"]
    assert first == {
        s.DAY: "2024-02-28",
        "qtd_moedas": 3,
        "valor_mercado_total_usd": 2200,
        "volume_total_usd": 37,
        "preco_medio_geral_usd": 35.34,
        "preco_mediano_geral_usd": 1.02,
        "valor_mercado_medio_por_moeda_usd": 1100,
        "volume_medio_por_moeda_usd": 12,
        "top_valor_mercado_id_moeda": "btc",
        "top_valor_mercado_simbolo": "b",
        "top_valor_mercado_nome": "btc",
        "top_valor_mercado_usd": 1100,
        "top_volume_id_moeda": "btc",
        "top_volume_simbolo": "b",
        "top_volume_nome": "btc",
        "top_volume_usd": 15,
    }
    second = rows["2024-02-29"]
    assert (second["qtd_moedas"], second["volume_total_usd"]) == (2, 15)
    assert (second["preco_medio_geral_usd"], second["preco_mediano_geral_usd"]) == (65.5, 5)
    assert second["valor_mercado_medio_por_moeda_usd"] == 800
    assert second["volume_medio_por_moeda_usd"] == 15


def test_top_with_only_nulls_still_names_an_asset(spark):
    rows = [(i, "2024-01-01 00:00:00", 1.0, None, None) for i in ("z", "m", "q")]
    top = gold.top_by_day(silver.daily_fact(observations(spark, rows)), s.MEAN_CAP, "t")
    (row,) = top.collect()
    assert (row.t_id_moeda, row.t_usd) == ("m", None)


def test_first_last_day(fact):
    rows = keyed(gold.first_last_day(fact), s.ASSET)
    assert rows["eth"] == {
        s.ASSET: "eth",
        "data_primeiro_dia": "2024-02-28",
        "data_ultimo_dia": "2024-03-02",
        "preco_primeiro_dia_usd": 0,
        "preco_ultimo_dia_usd": 8,
        "valor_mercado_ultimo_dia_usd": 600,
        "volume_ultimo_dia_usd": 5,
    }


def test_asset_summary(fact):
    rows = keyed(gold.asset_summary(fact), s.ASSET)
    names = (
        "data_primeiro_dia data_ultimo_dia qtd_dias_com_dados preco_medio_historico_usd "
        "preco_min_historico_usd preco_max_historico_usd preco_primeiro_dia_usd "
        "preco_ultimo_dia_usd variacao_percentual_total valor_mercado_medio_historico_usd "
        "volume_medio_historico_usd valor_mercado_ultimo_dia_usd volume_ultimo_dia_usd"
    ).split()
    got = {k: tuple(v[n] for n in names) for k, v in rows.items()}
    assert got == {
        "btc": ("2024-02-28", "2024-03-01", 3, 98, 63, 126, 105, 63, -40, 1033, 15, 900, 15),
        "eth": ("2024-02-28", "2024-03-02", 3, 4.33, 0, 8, 0, 8, None, 733, 10, 600, 5),
        "xrp": ("2024-02-28", "2024-02-28", 1, 1.02, 1.02, 1.02, 1.02, 1.02, 0, None, 7, None, 7),
    }
    assert len(gold.asset_summary(fact).columns) == 20


def test_billions(spark):
    rows = [("a", "2024-01-01 00:00:00", 1.0, 1_234_567_890.0, 5_000_000.0)]
    (row,) = gold.asset_summary(silver.daily_fact(observations(spark, rows))).collect()
    assert row.valor_mercado_ultimo_dia_bi_usd == 1.23
    assert row.volume_ultimo_dia_bi_usd == 0.01


def test_renamed_asset_shows_greatest_label(spark):
    rows = [
        ("a", "2024-01-01 00:00:00", 1.0, 1.0, 1.0, "zeta"),
        ("a", "2024-01-02 00:00:00", 1.0, 1.0, 1.0, "alpha"),
    ]
    (row,) = gold.asset_summary(silver.daily_fact(observations(spark, rows))).collect()
    assert row.nome_moeda == "zeta"


def test_shares(fact):
    summary = gold.asset_summary(fact)
    rows = reports.market_share(summary, None).collect()
    assert [(r.nome_moeda, r.participacao_percentual) for r in rows] == [
        ("btc", 60),
        ("eth", 40),
        ("xrp", None),
    ]
    assert len(reports.market_share(summary, 1).collect()) == 1


def test_share_of_nothing_is_null(spark):
    rows = [("a", "2024-01-01 00:00:00", 1.0, 0.0, 1.0)]
    summary = gold.asset_summary(silver.daily_fact(observations(spark, rows)))
    (row,) = reports.market_share(summary).collect()
    assert row.participacao_percentual is None


def test_latest_prices_use_the_common_last_day(fact):
    rows = reports.latest_prices(fact).collect()
    assert [(r.id_moeda, r.preco_usd) for r in rows] == [("eth", 8)]


def test_top_report_order(fact):
    rows = reports.top_by_last_cap(gold.asset_summary(fact), 2).collect()
    assert [r.id_moeda for r in rows] == ["btc", "eth"]


def test_widget(fact):
    widget = reports.sum_by(fact, s.MEAN_PRICE)
    assert [tuple(r) for r in widget.collect()] == [("btc", 294.0), ("eth", 13.0), ("xrp", 1.02)]


def test_empty_input(spark, market):
    fact = silver.daily_fact(market.where(F.lit(False)))
    for df in (
        gold.daily_ranking(fact),
        gold.change_d1(fact),
        gold.market_summary(fact),
        gold.asset_summary(fact),
        reports.latest_prices(fact),
        reports.market_share(gold.asset_summary(fact)),
    ):
        assert df.collect() == []
