"""The same results in SQL, for an independent engine to check ours against.

Written the long way round (self-joins, row numbers, correlated parts) so that a
shared mistake is unlikely.
"""

from __future__ import annotations

from tidemark import schema as s
from tidemark.plans.market import COMMENTS
from tidemark.plans.queries import (
    AS_OF,
    BACKFILL,
    CONTROLS,
    DEPTH,
    GAPS_SINCE,
    HALF_DAY,
    OVERLAP_FROM,
)


def _half(value: str, digits: int) -> str:
    return f"CAST(ROUND(CAST({value} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def _mean(column: str, digits: int) -> str:
    total = f"CAST(SUM(CAST({column} AS DECIMAL(28,8))) AS DOUBLE)"
    return _half(f"{total} / NULLIF(COUNT({column}), 0)", digits)


def _sum(column: str, digits: int | None = None) -> str:
    total = f"SUM(CAST({column} AS DECIMAL(28,8)))"
    if digits is not None:
        total = f"ROUND({total}, {digits})"
    return f"CAST({total} AS DOUBLE)"


def _pct(now: str, base: str) -> str:
    return _half(f"({now} - {base}) / NULLIF({base}, 0) * 100", 2)


def _with(*parts: str, then: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + then


# --- views --------------------------------------------------------------------

_TRADES = """obs AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS id, 'S' || CAST(l_suppkey AS VARCHAR) AS symbol,
    s_name AS name, l_shipdate AS "timestamp", l_extendedprice AS current_price,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_quantity AS DECIMAL(18,2))
      AS DOUBLE) AS market_cap,
    l_quantity AS total_volume
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)"""

_EVENTS = """obs AS (
  SELECT CAST(user_id AS VARCHAR) AS id, 'U' || CAST(user_id AS VARCHAR) AS symbol,
    event_type AS name, ts AS "timestamp", value AS current_price,
    CAST(CAST(value AS DECIMAL(18,2)) * CAST(event_id % 7 + 1 AS DECIMAL(18,2))
      AS DOUBLE) AS market_cap,
    CAST(event_id % 50 AS DOUBLE) AS total_volume
  FROM events)"""

_SPOILED = """obs AS (
  SELECT CAST(user_id AS VARCHAR) AS id, 'U' || CAST(user_id AS VARCHAR) AS symbol,
    event_type AS name,
    CASE WHEN event_id % 101 = 0 THEN 'zzz' ELSE CAST(ts AS VARCHAR) END AS "timestamp",
    CASE WHEN event_id % 97 = 0 THEN 'abc'
      ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS current_price,
    CASE WHEN event_id % 89 = 0 THEN ''
      ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS market_cap,
    CAST(event_id % 50 AS VARCHAR) AS total_volume
  FROM events)"""

_READ = """readable AS (
  SELECT id, symbol, name, TRY_CAST("timestamp" AS TIMESTAMP) AS "timestamp",
    TRY_CAST(current_price AS DOUBLE) AS current_price,
    TRY_CAST(market_cap AS DOUBLE) AS market_cap,
    TRY_CAST(total_volume AS DOUBLE) AS total_volume
  FROM obs WHERE TRY_CAST("timestamp" AS TIMESTAMP) IS NOT NULL)"""


def _daily(source: str = "obs") -> str:
    return f"""daily AS (
  SELECT CAST("timestamp" AS DATE) AS data_referencia, id AS id_moeda,
    symbol AS simbolo, name AS nome_moeda,
    {_mean("current_price", 2)} AS preco_medio_usd,
    {_mean("market_cap", 0)} AS valor_mercado_medio_usd,
    {_mean("total_volume", 0)} AS volume_medio_usd,
    MAX("timestamp") AS seen
  FROM {source} GROUP BY 1, 2, 3, 4)"""


_FACT = """fact AS (
  SELECT data_referencia, id_moeda, simbolo, nome_moeda, preco_medio_usd,
    valor_mercado_medio_usd, volume_medio_usd
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY data_referencia, id_moeda
          ORDER BY seen DESC, simbolo, nome_moeda) AS rn FROM daily) v
  WHERE rn = 1)"""

_TRADE_FACT = (_TRADES, _daily(), _FACT)
_EVENT_FACT = (_EVENTS, _daily(), _FACT)


_LARGE = (
    _TRADES,
    """scaled AS (
  SELECT * REPLACE (
    current_price * (1e15 * pow(10.0, CAST(id AS INTEGER) % 11)) AS current_price,
    market_cap * (1e15 * pow(10.0, CAST(id AS INTEGER) % 11)) AS market_cap) FROM obs)""",
    """daily AS (
  SELECT CAST("timestamp" AS DATE) AS data_referencia, id AS id_moeda,
    AVG(current_price) AS preco, AVG(market_cap) AS valor
  FROM scaled GROUP BY 1, 2)""",
)


def _ranking(depth: int) -> str:
    return f"""ranking AS (
  SELECT * FROM (
    SELECT *,
      DENSE_RANK() OVER (PARTITION BY data_referencia
        ORDER BY valor_mercado_medio_usd DESC NULLS LAST) AS rank_valor_mercado,
      DENSE_RANK() OVER (PARTITION BY data_referencia
        ORDER BY volume_medio_usd DESC NULLS LAST) AS rank_volume
    FROM fact) r
  WHERE rank_valor_mercado <= {depth} OR rank_volume <= {depth})"""


_CHANGE = f"""paired AS (
  SELECT *, MAX(preco_medio_usd) OVER (PARTITION BY id_moeda ORDER BY data_referencia
      RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING)
    AS preco_medio_ontem_usd
  FROM fact),
change AS (
  SELECT data_referencia, id_moeda, simbolo, nome_moeda, preco_medio_usd,
    preco_medio_ontem_usd,
    {_half("preco_medio_usd - preco_medio_ontem_usd", 2)} AS variacao_abs_d1_usd,
    {_pct("preco_medio_usd", "preco_medio_ontem_usd")} AS variacao_pct_d1
  FROM paired)"""


def _top(name: str, measure: str, prefix: str) -> str:
    return f"""{name} AS (
  SELECT data_referencia, id_moeda AS {prefix}_id_moeda, simbolo AS {prefix}_simbolo,
    nome_moeda AS {prefix}_nome, {measure} AS {prefix}_usd
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY data_referencia
          ORDER BY {measure} DESC NULLS LAST, id_moeda) AS rn FROM fact) t
  WHERE rn = 1)"""


_TOP_CAP = _top("top_cap", "valor_mercado_medio_usd", "top_valor_mercado")
_TOP_VOLUME = _top("top_volume", "volume_medio_usd", "top_volume")

_MARKET = f"""market AS (
  SELECT a.*, c.* EXCLUDE (data_referencia), v.* EXCLUDE (data_referencia)
  FROM (
    SELECT data_referencia, COUNT(*) AS qtd_moedas,
      {_sum("valor_mercado_medio_usd", 0)} AS valor_mercado_total_usd,
      {_sum("volume_medio_usd", 0)} AS volume_total_usd,
      {_mean("preco_medio_usd", 2)} AS preco_medio_geral_usd,
      {_half("QUANTILE_DISC(preco_medio_usd, 0.5)", 2)} AS preco_mediano_geral_usd,
      {_mean("valor_mercado_medio_usd", 0)} AS valor_mercado_medio_por_moeda_usd,
      {_mean("volume_medio_usd", 0)} AS volume_medio_por_moeda_usd
    FROM fact GROUP BY 1) a
  LEFT JOIN top_cap c ON a.data_referencia = c.data_referencia
  LEFT JOIN top_volume v ON a.data_referencia = v.data_referencia)"""

_ENDS = """ends AS (
  SELECT f.id_moeda, f.data_referencia AS data_primeiro_dia,
    l.data_referencia AS data_ultimo_dia,
    f.preco_medio_usd AS preco_primeiro_dia_usd, l.preco_medio_usd AS preco_ultimo_dia_usd,
    l.valor_mercado_medio_usd AS valor_mercado_ultimo_dia_usd,
    l.volume_medio_usd AS volume_ultimo_dia_usd
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY id_moeda ORDER BY data_referencia) AS rn
        FROM fact) f
  JOIN (SELECT *, ROW_NUMBER() OVER (PARTITION BY id_moeda
          ORDER BY data_referencia DESC) AS rn FROM fact) l
    ON f.id_moeda = l.id_moeda
  WHERE f.rn = 1 AND l.rn = 1)"""


def _billions(column: str) -> str:
    return f"{_half(column + ' / 1e9', 2)} AS {column.replace('_usd', '_bi_usd')}"


_MONEY = (
    "valor_mercado_medio_historico_usd",
    "volume_medio_historico_usd",
    "valor_mercado_ultimo_dia_usd",
    "volume_ultimo_dia_usd",
)

_ASSET = f"""asset AS (
  SELECT *, {_pct("preco_ultimo_dia_usd", "preco_primeiro_dia_usd")}
      AS variacao_percentual_total,
    {", ".join(_billions(column) for column in _MONEY)}
  FROM (
    SELECT id_moeda, MAX(simbolo) AS simbolo, MAX(nome_moeda) AS nome_moeda,
      COUNT(*) AS qtd_dias_com_dados,
      {_mean("preco_medio_usd", 2)} AS preco_medio_historico_usd,
      {_half("MIN(preco_medio_usd)", 2)} AS preco_min_historico_usd,
      {_half("MAX(preco_medio_usd)", 2)} AS preco_max_historico_usd,
      {_mean("valor_mercado_medio_usd", 0)} AS valor_mercado_medio_historico_usd,
      {_mean("volume_medio_usd", 0)} AS volume_medio_historico_usd
    FROM fact GROUP BY 1) e
  JOIN ends USING (id_moeda))"""

_TRADE_ASSET = (*_TRADE_FACT, _ENDS, _ASSET)

_LATEST = """latest AS (
  SELECT data_referencia AS data_mais_recente, id_moeda, simbolo, nome_moeda,
    preco_medio_usd AS preco_usd
  FROM fact WHERE data_referencia = (SELECT MAX(data_referencia) FROM fact))"""

_TOP20 = """top20 AS (
  SELECT id_moeda, simbolo, nome_moeda, valor_mercado_ultimo_dia_bi_usd,
    volume_ultimo_dia_bi_usd, qtd_dias_com_dados, data_ultimo_dia
  FROM asset ORDER BY valor_mercado_ultimo_dia_usd DESC NULLS LAST, id_moeda LIMIT 20)"""

_SHARE_OF_ALL = _half(
    "valor_mercado_ultimo_dia_usd / NULLIF((SELECT "
    + _sum("valor_mercado_ultimo_dia_usd")
    + " FROM asset), 0) * 100",
    2,
)

_SHARES = f"""shares AS (
  SELECT id_moeda, nome_moeda, simbolo, {_SHARE_OF_ALL} AS participacao_percentual
  FROM asset)"""

_TOP_SHARES = """top_shares AS (
  SELECT nome_moeda, simbolo, participacao_percentual FROM shares
  ORDER BY participacao_percentual DESC NULLS LAST, id_moeda LIMIT 10)"""


def _widget(source: str, column: str) -> str:
    return (
        f'SELECT nome_moeda, {_sum(column)} AS "sum({column})" FROM {source} '
        f'GROUP BY 1 ORDER BY 2 DESC'
    )


_WITHOUT_SEEN = "SELECT * EXCLUDE (seen) FROM daily"


_SOURCES = ("daily", "fact", "ranking", "change", "market", "asset")

_DAY = "data_referencia"
_CONTROLS = [
    f"SELECT '{name}' AS tabela, COUNT(*) AS linhas, MIN({first}) AS primeiro_dia, "
    f"MAX({last}) AS ultimo_dia, '{figure}' AS coluna, {_sum(figure)} AS total_controle "
    f"FROM {source}"
    for source, (name, (first, last, figures)) in zip(_SOURCES, CONTROLS.items(), strict=True)
    for figure in figures
]
_FLAGSHIP = "\nUNION ALL ".join(_CONTROLS)
_BUCKETED = "\nUNION ALL ".join(
    [c for c in _CONTROLS if f"'{s.GOLD_CHANGE}'" in c or f"'{s.GOLD_ASSET}'" in c]
    + [
        f"""SELECT 'primeiro_e_ultimo_dia' AS tabela, COUNT(*) AS linhas,
  MIN(data_primeiro_dia) AS primeiro_dia, MAX(data_ultimo_dia) AS ultimo_dia,
  'preco_ultimo_dia_usd' AS coluna, {_sum('preco_ultimo_dia_usd')} AS total_controle FROM ends"""
    ]
)
_KEPT_CURRENT = "\nUNION ALL ".join(c for c in _CONTROLS if s.SILVER_DAILY not in c)

_BRONZE = """SELECT id, symbol, name, CAST("timestamp" AS VARCHAR) AS "timestamp",
  CAST(CAST(current_price AS DECIMAL(18,2)) AS VARCHAR) AS current_price,
  CAST(CAST(market_cap AS DECIMAL(18,2)) AS VARCHAR) AS market_cap,
  CAST(CAST(total_volume AS BIGINT) AS VARCHAR) AS total_volume,
  CAST(CAST("timestamp" AS DATE) AS VARCHAR) AS dt
FROM obs"""

_WRITTEN_DAYS = f"""SELECT STRFTIME("timestamp", '%Y-%m') AS mes,
  CAST("timestamp" AS DATE) AS dt, COUNT(*) AS linhas,
  {_sum("current_price")} AS soma_preco
FROM obs GROUP BY 1, 2"""

_PLAN = f"""SELECT id, CAST(d AS DATE) AS dt, CAST(EPOCH(d) AS BIGINT) AS from_epoch,
  CAST(EPOCH(d) AS BIGINT) + 86399 AS to_epoch
FROM (SELECT DISTINCT id FROM obs) u,
  GENERATE_SERIES(
    (SELECT CAST(MAX(CAST("timestamp" AS DATE)) + 1 AS TIMESTAMP) FROM obs),
    CAST(CAST('{AS_OF}' AS DATE) - 2 AS TIMESTAMP), INTERVAL 1 DAY) g(d)"""

_GAPS = f"""due AS (
  SELECT id, CAST(d AS DATE) AS d FROM (SELECT DISTINCT id FROM obs) u, GENERATE_SERIES(
    TIMESTAMP '{GAPS_SINCE}', CAST(CAST('{AS_OF}' AS DATE) - 2 AS TIMESTAMP), INTERVAL 1 DAY) g(d)),
held AS (
  SELECT DISTINCT id, CAST("timestamp" AS DATE) AS d FROM obs
  WHERE CAST(id AS INTEGER) % 17 <> 3
    AND NOT (CAST("timestamp" AS DATE) = DATE '{HALF_DAY}' AND CAST(id AS INTEGER) % 2 = 1)),
missing AS (SELECT * FROM due EXCEPT SELECT * FROM held),
edges AS (
  SELECT id, d, CASE WHEN LAG(d) OVER (PARTITION BY id ORDER BY d) = d - 1 THEN 0 ELSE 1 END AS starts
  FROM missing),
runs AS (SELECT id, d, SUM(starts) OVER (PARTITION BY id ORDER BY d) AS run FROM edges)"""

_GAP_PLAN = """SELECT id, MIN(d) AS primeiro_dia, MAX(d) AS ultimo_dia, COUNT(*) AS dias,
  CAST(EPOCH(CAST(MIN(d) AS TIMESTAMP)) AS BIGINT) AS from_epoch,
  CAST(EPOCH(CAST(MAX(d) AS TIMESTAMP)) AS BIGINT) + 86399 AS to_epoch
FROM runs GROUP BY id, run"""

_SAMPLES = """samples AS (
  SELECT CAST(user_id AS VARCHAR) AS id, 'U' || CAST(user_id AS VARCHAR) AS symbol,
    'user ' || CAST(user_id AS VARCHAR) AS name, EPOCH_US(ts) // 1000 AS ts_ms,
    value AS current_price, value * 2 AS market_cap,
    CAST(event_id % 50 AS DOUBLE) AS total_volume
  FROM events)"""

_LARGEST = f"""largest AS (
  SELECT CAST(user_id AS VARCHAR) AS id FROM events GROUP BY 1
  ORDER BY {_sum("value")} DESC, 1 LIMIT 50)"""


def _samples_between(first: str, last: str) -> str:
    return _with(
        _SAMPLES,
        _LARGEST,
        then=f"""SELECT * FROM samples WHERE id IN (SELECT id FROM largest)
  AND ts_ms >= EPOCH_MS(TIMESTAMP '{first}') AND ts_ms <= EPOCH_MS(TIMESTAMP '{last}')""",
    )


_QUALITY = """SELECT COUNT(*) AS linhas,
  COUNT(*) FILTER (TRY_CAST("timestamp" AS TIMESTAMP) IS NULL) AS timestamp_rejeitado,
  COUNT(*) FILTER (current_price IS NOT NULL
    AND TRY_CAST(current_price AS DOUBLE) IS NULL) AS preco_rejeitado,
  COUNT(*) FILTER (market_cap IS NOT NULL
    AND TRY_CAST(market_cap AS DOUBLE) IS NULL) AS valor_mercado_rejeitado,
  COUNT(*) FILTER (total_volume IS NOT NULL
    AND TRY_CAST(total_volume AS DOUBLE) IS NULL) AS volume_rejeitado
FROM obs"""

_CATALOG = "\nUNION ALL ".join(
    f"SELECT '{name}' AS tabela, {rows} AS linhas, '{COMMENTS[name]}' AS comentario, "
    f"'{name.split('_')[0]}' AS qualidade FROM {source}"
    for name, source, rows in (
        (s.BRONZE_TABLE, "obs", "COUNT(*)"),
        (s.SILVER_DAILY, "daily", "COUNT(*)"),
        (s.SILVER_FACT, "fact", "COUNT(*)"),
        (s.GOLD_RANKING, "ranking", "COUNT(*)"),
        (s.GOLD_CHANGE, "fact", "COUNT(*)"),
        (s.GOLD_MARKET, "fact", f"COUNT(DISTINCT {_DAY})"),
        (s.GOLD_ASSET, "fact", "COUNT(DISTINCT id_moeda)"),
    )
)

ORACLE: dict[str, str] = {
    "flagship": _with(
        *_TRADE_ASSET, _ranking(DEPTH), _CHANGE, _TOP_CAP, _TOP_VOLUME, _MARKET, then=_FLAGSHIP
    ),
    "catalog_tables": _with(*_EVENT_FACT, _ranking(100), then=_CATALOG),
    "payload_flatten": """SELECT CAST(user_id AS VARCHAR) AS id, EPOCH_US(ts) // 1000 AS ts_ms,
  value AS current_price, value * 2 AS market_cap,
  CAST(event_id % 50 AS DOUBLE) AS total_volume FROM events""",
    "ingest_backfill": _samples_between(*BACKFILL),
    "backfill_resume": _samples_between(*BACKFILL),
    # the first run loads its last complete day, the others what follows it
    "ingest_daily": _samples_between("2024-01-05 00:00:00", "2024-01-18 23:59:59.999"),
    "dim_lookup": """SELECT CAST(l_suppkey AS VARCHAR) AS id,
  'S' || CAST(l_suppkey AS VARCHAR) AS symbol, s_name AS name, l_shipdate AS "timestamp",
  l_extendedprice AS current_price, l_orderkey, l_linenumber
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""",
    "universe_topn": _with(
        _TRADES,
        then=f"""SELECT id, symbol, name, {_sum("market_cap")} AS market_cap
FROM obs GROUP BY 1, 2, 3 ORDER BY 4 DESC, id LIMIT 50""",
    ),
    "ingest_high_water_mark": "SELECT MAX(CAST(ts AS DATE)) AS ultima_data FROM events",
    "ingest_mark_listing": "SELECT MAX(CAST(ts AS DATE)) AS ultima_data FROM events",
    "ingest_plan": _with(_EVENTS, then=_PLAN),
    "ingest_window_today": """SELECT CAST(MAX(CAST(ts AS DATE)) + 1 AS DATE) AS inicio,
  CAST(CAST(now() AT TIME ZONE 'UTC' AS DATE) - 2 AS DATE) AS fim FROM events""",
    "ingest_gap_plan": _with(_EVENTS, _GAPS, then=_GAP_PLAN),
    "ingest_gap_load": _samples_between(f"{GAPS_SINCE} 00:00:00", "2024-02-03 23:59:59.999"),
    "backfill_range": _with(
        _EVENTS,
        then=f"""SELECT * FROM obs WHERE "timestamp" >= TIMESTAMP '{BACKFILL[0]}'
  AND "timestamp" <= TIMESTAMP '{BACKFILL[1]}'""",
    ),
    "asset_batches": """SELECT s_suppkey, s_name,
  (ROW_NUMBER() OVER (ORDER BY s_suppkey) - 1) // 10 AS lote FROM supplier""",
    "raw_partitioned_write": _with(_EVENTS, then=_WRITTEN_DAYS),
    "raw_replace_days": _with(_EVENTS, then=_WRITTEN_DAYS),
    "ingest_overlap": _with(_EVENTS, then=_WRITTEN_DAYS),
    "raw_dedup": _with(
        _EVENTS,
        f"""doubled AS (SELECT * FROM obs UNION ALL
  SELECT * FROM obs WHERE "timestamp" >= TIMESTAMP '{OVERLAP_FROM}')""",
        then="""SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (
  PARTITION BY id, "timestamp" ORDER BY symbol DESC, name DESC, current_price DESC,
  market_cap DESC, total_volume DESC) AS rn FROM doubled) d WHERE rn = 1""",
    ),
    "bronze_normalize": _with(_EVENTS, then=_BRONZE),
    "bronze_quality": _with(_SPOILED, then=_QUALITY),
    "bronze_stream": _with(_EVENTS, then=_BRONZE),
    "bronze_stream_dedup": _with(_EVENTS, then=_BRONZE),
    "bronze_stream_cursor": _with(_EVENTS, then=_BRONZE),
    "schema_evolution": f"""SELECT event_id, ts, user_id,
  CASE WHEN ts >= TIMESTAMP '{OVERLAP_FROM}' THEN event_type END AS event_type FROM events""",
    "schema_evolution_auto": f"""SELECT event_id, ts, user_id,
  CASE WHEN ts >= TIMESTAMP '{OVERLAP_FROM}' THEN event_type END AS event_type FROM events""",
    "bronze_quarantine": _with(
        _SPOILED,
        then="""SELECT motivo, COUNT(*) AS linhas, COUNT(*) AS observadas FROM (
  SELECT CASE WHEN CAST(id AS INTEGER) % 13 = 5 THEN 'ativo_nao_listado'
    WHEN "timestamp" = 'zzz' THEN 'timestamp_ilegivel' WHEN current_price = 'abc' THEN 'preco_ilegivel'
    WHEN market_cap = '' THEN 'valor_mercado_ilegivel' ELSE 'aceita' END AS motivo FROM obs) r
GROUP BY 1""",
    ),
    "silver_daily": _with(_TRADES, _daily(), then=_WITHOUT_SEEN),
    "silver_from_text": _with(_SPOILED, _READ, _daily("readable"), then=_WITHOUT_SEEN),
    "silver_latest": _with(*_EVENT_FACT, then="SELECT * FROM fact"),
    "silver_refresh_touched": _with(*_EVENT_FACT, then="SELECT * FROM fact"),
    "silver_stream": _with(*_EVENT_FACT, then="SELECT * FROM fact"),
    "gold_ranking": _with(*_TRADE_FACT, _ranking(DEPTH), then="SELECT * FROM ranking"),
    "gold_ranking_spread": _with(*_TRADE_FACT, _ranking(DEPTH), then="SELECT * FROM ranking"),
    "gold_ranking_null_days": _with(
        *_TRADE_FACT[:-1],
        _FACT.replace("fact AS", "dated AS", 1),
        """fact AS (
  SELECT * REPLACE (CASE WHEN day(data_referencia) % 3 <> 0 THEN data_referencia END
    AS data_referencia) FROM dated)""",
        _ranking(DEPTH),
        then="SELECT * FROM ranking",
    ),
    "silver_large_values": _with(
        *_LARGE,
        then="""SELECT data_referencia, id_moeda, ROUND(LOG10(preco), 6) AS ordem_preco,
  ROUND(LOG10(valor), 6) AS ordem_valor FROM daily""",
    ),
    "gold_market_large_values": _with(
        *_LARGE,
        then="""SELECT data_referencia, ROUND(LOG10(SUM(valor)), 6) AS ordem_total,
  ROUND(LOG10(AVG(valor)), 6) AS ordem_media, ROUND(LOG10(AVG(preco)), 6) AS ordem_preco
FROM daily GROUP BY 1""",
    ),
    "gold_ranking_top100": _with(*_EVENT_FACT, _ranking(100), then="SELECT * FROM ranking"),
    "gold_change_d1": _with(*_TRADE_FACT, _CHANGE, then="SELECT * FROM change"),
    "gold_change_d1_events": _with(*_EVENT_FACT, _CHANGE, then="SELECT * FROM change"),
    "gold_top_by_day": _with(*_TRADE_FACT, _TOP_CAP, then="SELECT * FROM top_cap"),
    "gold_top_volume_by_day": _with(*_TRADE_FACT, _TOP_VOLUME, then="SELECT * FROM top_volume"),
    "gold_market_summary": _with(
        *_TRADE_FACT, _TOP_CAP, _TOP_VOLUME, _MARKET, then="SELECT * FROM market"
    ),
    "first_last_day": _with(*_TRADE_FACT, _ENDS, then="SELECT * FROM ends"),
    "gold_asset_summary": _with(*_TRADE_ASSET, then="SELECT * FROM asset"),
    "gold_median_range": _with(
        *_TRADE_FACT,
        then="""SELECT STRFTIME(data_referencia, '%Y-%m') AS mes, COUNT(preco_medio_usd) AS qtd_valores,
  TRUE AS dentro_do_limite FROM fact GROUP BY 1
UNION ALL SELECT 'todos', COUNT(preco_medio_usd), TRUE FROM fact""",
    ),
    "gold_bucketed": _with(*_TRADE_ASSET, _CHANGE, then=_BUCKETED),
    "gold_incremental": _with(
        *_EVENT_FACT,
        _ENDS,
        _ASSET,
        _ranking(DEPTH),
        _CHANGE,
        _TOP_CAP,
        _TOP_VOLUME,
        _MARKET,
        then=_KEPT_CURRENT,
    ),
    "report_top20": _with(*_TRADE_ASSET, _TOP20, then="SELECT * FROM top20"),
    "report_latest_price": _with(*_EVENT_FACT, _LATEST, then="SELECT * FROM latest"),
    "report_share": _with(
        *_TRADE_ASSET, _SHARES, _TOP_SHARES, then="SELECT * FROM top_shares"
    ),
    "report_share_all": _with(
        *_TRADE_ASSET, _SHARES, then="SELECT * EXCLUDE (id_moeda) FROM shares"
    ),
    "widget_price": _with(*_EVENT_FACT, _LATEST, then=_widget("latest", "preco_usd")),
    "widget_volume": _with(
        *_TRADE_ASSET, _TOP20, then=_widget("top20", "volume_ultimo_dia_bi_usd")
    ),
    "widget_share": _with(
        *_TRADE_ASSET,
        _SHARES,
        _TOP_SHARES,
        then=_widget("top_shares", "participacao_percentual"),
    ),
}
