"""Declared schemas of the stored tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

TEXT, DOUBLE, LONG, INT, TIME = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType(), T.TimestampType()
DATE = T.DateType()
MONEY = T.DecimalType(18, 2)


def _columns(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in types.items()])


BRONZE_PRICES = _columns(
    Date=TIME, Open=DOUBLE, High=DOUBLE, Low=DOUBLE, Close=DOUBLE, Volume=LONG, ticker=TEXT, extraction_timestamp=TEXT
)
INFO = _columns(
    ticker=TEXT, longName=TEXT, sector=TEXT, industry=TEXT, sectorKey=TEXT, industryKey=TEXT, extraction_timestamp=TEXT
)

STOCKS_MASTER = _columns(ticker=TEXT, company_name=TEXT, sector=TEXT, industry=TEXT)
PRICE_HISTORY = _columns(
    ticker=TEXT, date=TIME, year=INT, open=DOUBLE, high=DOUBLE, low=DOUBLE, close=DOUBLE, volume=LONG, adj_close=DOUBLE
)
TECHNICAL = _columns(
    ticker=TEXT,
    date=TIME,
    year=INT,
    sma_20=DOUBLE,
    sma_50=DOUBLE,
    atr=DOUBLE,
    rsi=DOUBLE,
    macd=DOUBLE,
    bb_upper=DOUBLE,
    bb_lower=DOUBLE,
)

# A manifest is a tree: files by bucket of their path, buckets by prefix. Its head names the commits of both tables.
LEAVES = _columns(prefix=TEXT, path=TEXT, sha256=TEXT, length=LONG, modified=LONG)
NODES = _columns(prefix=TEXT, bucket=TEXT, sha256=TEXT, n=LONG)
MANIFEST = _columns(
    stage=TEXT, generated_at=TEXT, output_dir=TEXT, manifest_hash=TEXT, file_count=LONG, hashed=LONG, leaves=LONG, nodes=LONG
)
TAKEN = _columns(path=TEXT, length=LONG, modified=LONG)
# The files of a custody record are those of its manifest; its issues are rows of their own.
CUSTODY = _columns(
    stage=TEXT,
    manifest_hash=TEXT,
    file_count=LONG,
    manifest=TEXT,
    timestamp=TEXT,
    log_analysis=TEXT,
    issue_count=LONG,
    verdict=TEXT,
)
CUSTODY_ISSUES = _columns(stage=TEXT, timestamp=TEXT, line=TEXT)
WATERMARK = _columns(name=TEXT, value=TEXT, saved_at=TIME)
TICKER_WATERMARK = _columns(ticker=TEXT, last_date=T.DateType())


@dataclass(frozen=True)
class TableSpec:
    """A gold table: its columns, primary key, required columns, text lengths and folders."""

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    required: tuple[str, ...]
    lengths: dict[str, int] = field(default_factory=dict)
    partition: tuple[str, ...] = ()


_IDS = {"DateId": INT, "TickerId": INT, "SectorId": INT, "IndustryId": INT}
_FACT = {"key": ("DateId", "TickerId"), "required": tuple(_IDS), "partition": ("DateId",)}

# Names, types and text lengths of the gold tables.
DIM_DATE = TableSpec(
    "DimDate", _columns(DateId=INT, Year=INT, Quarter=INT, Month=INT, Week=INT, Day=INT), ("DateId",), ("DateId",)
)
DIM_TICKER = TableSpec(
    "DimTicker",
    _columns(TickerId=INT, Symbol=TEXT, Name=TEXT, Sector=TEXT, Industry=TEXT),
    ("TickerId",),
    ("TickerId", "Symbol"),
    {"Symbol": 10, "Name": 255, "Sector": 100, "Industry": 100},
)
DIM_SECTOR = TableSpec(
    "DimSector", _columns(SectorId=INT, Sector=TEXT), ("SectorId",), ("SectorId", "Sector"), {"Sector": 100}
)
DIM_INDUSTRY = TableSpec(
    "DimIndustry",
    _columns(IndustryId=INT, Industry=TEXT),
    ("IndustryId",),
    ("IndustryId", "Industry"),
    {"Industry": 100},
)
FACT_PRICES = TableSpec(
    "FactStockPrices",
    _columns(
        **_IDS,
        OpenPrice=MONEY,
        HighPrice=MONEY,
        LowPrice=MONEY,
        ClosePrice=MONEY,
        AdjustedClosePrice=MONEY,
        Volume=LONG,
    ),
    **_FACT,
)
FACT_TECHNICAL = TableSpec(
    "FactTechnicalIndicators",
    _columns(
        **_IDS,
        sma20=MONEY,
        sma50=MONEY,
        atr=MONEY,
        rsi=MONEY,
        macd=MONEY,
        bollinger_bands_down=MONEY,
        bollinger_bands_up=MONEY,
    ),
    **_FACT,
)
# Predictions are only ever appended, so they need no folders to replace.
FACT_PREDICTED = TableSpec(
    "FactPredictedStockPrices",
    _columns(**_IDS, PredictionDateId=INT, PredictedPrice=DOUBLE),
    ("DateId", "TickerId"),
    tuple(_IDS),
)
GOLD_TABLES = (DIM_DATE, DIM_TICKER, DIM_SECTOR, DIM_INDUSTRY, FACT_PRICES, FACT_TECHNICAL, FACT_PREDICTED)
