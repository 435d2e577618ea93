"""Column names, record layouts and defaults shared by every layer."""

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Names and numbers that downstream tables and reports rely on.
# ---------------------------------------------------------------------------

# observation columns (raw and bronze)
ID = "id"
SYMBOL = "symbol"
NAME = "name"
TIMESTAMP = "timestamp"
PRICE = "current_price"
MARKET_CAP = "market_cap"
TOTAL_VOLUME = "total_volume"
OBSERVATION_COLUMNS = [ID, SYMBOL, NAME, TIMESTAMP, PRICE, MARKET_CAP, TOTAL_VOLUME]

# raw partition columns
MONTH = "mes"
LOAD_DAY = "dt"
INGESTED_AT = "ingested_at"

# silver columns
DAY = "data_referencia"
ASSET = "id_moeda"
LABEL = "simbolo"
TITLE = "nome_moeda"
MEAN_PRICE = "preco_medio_usd"
MEAN_CAP = "valor_mercado_medio_usd"
MEAN_VOLUME = "volume_medio_usd"
PROCESSED_AT = "ts_processamento"
FACT_COLUMNS = [DAY, ASSET, LABEL, TITLE, MEAN_PRICE, MEAN_CAP, MEAN_VOLUME]

# table names and comments
BRONZE_TABLE = "bronze_moeda"
SILVER_DAILY = "silver_moeda_diaria"
SILVER_FACT = "silver_fato_moeda_diaria"
GOLD_RANKING = "gold_ranking_moedas_diario"
GOLD_CHANGE = "gold_variacao_preco_d1"
GOLD_MARKET = "gold_resumo_mercado_diario"
GOLD_ASSET = "gold_resumo_moeda"

# sizes: universe, backfill batch, ranking depth, report lengths, ingestion lag in days
UNIVERSE_SIZE = 50
BATCH_SIZE = 10
RANKING_DEPTH = 100
TOP_REPORT_ROWS = 20
SHARE_REPORT_ROWS = 10
LAG_DAYS = 2

# digits kept: prices and percentages, money totals
PRICE_DIGITS = 2
MONEY_DIGITS = 0

# ---------------------------------------------------------------------------

# Our own addition to the daily table: newest source instant behind a row, so that
# the version choice has a deterministic order. The fact drops it.
LAST_SEEN = "ts_ultima_observacao"

# Our own folder column of a landing that is laid out by the day that was requested.
REQUEST_DAY = "request_day"

# Our own folder column of a landing that is laid out by asset: a fixed number of folders, each
# with the responses of all assets that hash to it, however many assets are listed.
COIN_BUCKET = "coin_bucket"
COIN_BUCKETS = 256

OBSERVATION = T.StructType(
    [
        T.StructField(ID, T.StringType()),
        T.StructField(SYMBOL, T.StringType()),
        T.StructField(NAME, T.StringType()),
        T.StructField(TIMESTAMP, T.TimestampType()),
        T.StructField(PRICE, T.DoubleType()),
        T.StructField(MARKET_CAP, T.DoubleType()),
        T.StructField(TOTAL_VOLUME, T.DoubleType()),
    ]
)

RAW = T.StructType(
    OBSERVATION.fields
    + [T.StructField(MONTH, T.StringType()), T.StructField(LOAD_DAY, T.DateType())]
)

BRONZE = T.StructType(
    [T.StructField(name, T.StringType()) for name in OBSERVATION_COLUMNS]
    + [
        T.StructField(INGESTED_AT, T.TimestampType()),
        T.StructField(LOAD_DAY, T.StringType()),
    ]
)

SILVER = T.StructType(
    [
        T.StructField(ASSET, T.StringType()),
        T.StructField(LABEL, T.StringType()),
        T.StructField(TITLE, T.StringType()),
        T.StructField(MEAN_PRICE, T.DoubleType()),
        T.StructField(MEAN_CAP, T.DoubleType()),
        T.StructField(MEAN_VOLUME, T.DoubleType()),
        T.StructField(PROCESSED_AT, T.TimestampType()),
        T.StructField(DAY, T.DateType()),
    ]
)

_SERIES = T.ArrayType(T.ArrayType(T.DoubleType()))

# one landed range response: three parallel series of [epoch millis, value]
PAYLOAD = T.StructType(
    [
        T.StructField("coin", T.StringType()),
        T.StructField("prices", _SERIES),
        T.StructField("market_caps", _SERIES),
        T.StructField("total_volumes", _SERIES),
    ]
)

LISTING = T.StructType(
    [
        T.StructField(ID, T.StringType()),
        T.StructField(SYMBOL, T.StringType()),
        T.StructField(NAME, T.StringType()),
        T.StructField(MARKET_CAP, T.DoubleType()),
    ]
)
