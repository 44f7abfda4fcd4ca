"""Dimensions, facts, prediction import and the joins over the star."""

from __future__ import annotations

from pyspark.sql import functions as F

from quotelake.operators import star
from quotelake.operators.indicators import compute_indicators
from quotelake.operators.merge import insert_counts, key_violations, split_valid
from quotelake.operators.sizing import broadcast_if_small, materialised
from quotelake.operators.tables import price_history, technical_indicators
from quotelake.plans import testbed as tb
from quotelake.plans.catalog.indicators import INDICATORS_SQL
from quotelake.plans.catalog.registry import query, rounded, rounded_as
from quotelake.plans.gold import export_star, import_predictions, load_facts, read_gold, refresh_gold
from quotelake.schemas import DIM_INDUSTRY, DIM_SECTOR, DIM_TICKER, FACT_PREDICTED, FACT_PRICES
from quotelake.session import work_folder
from quotelake.sources.files import read_predictions
from quotelake.sources.sinks import four_decimals, rewrite_table


def _key_sql(name: str) -> str:
    return f"CAST(row_number() OVER (ORDER BY substr(md5({name}), 1, 3), {name}) AS INTEGER)"


def _date_key(day: str) -> str:
    return f"CAST(year({day}) * 10000 + month({day}) * 100 + day({day}) AS INTEGER)"


def _parts(day: str) -> str:
    parts = {"Year": "year", "Quarter": "quarter", "Month": "month", "Week": "week", "Day": "day"}
    return f"{_date_key(day)} AS DateId, " + ", ".join(
        f"CAST({fn}({day}) AS INTEGER) AS {name}" for name, fn in parts.items()
    )


SECTORS = f"SELECT {_key_sql('Sector')} AS SectorId, Sector FROM (SELECT DISTINCT sector AS Sector FROM ({tb.MASTER}))"
INDUSTRIES = (
    f"SELECT {_key_sql('Industry')} AS IndustryId, Industry FROM (SELECT DISTINCT industry AS Industry FROM ({tb.MASTER}))"
)
TICKERS = f"""SELECT {_key_sql('ticker')} AS TickerId, ticker AS Symbol, company_name AS Name, sector AS Sector,
    industry AS Industry FROM ({tb.MASTER})"""
DATES = f"SELECT {_parts('date')} FROM (SELECT DISTINCT date FROM ({tb.BARS_SUPPLIER}))"
KEYS = f"""SELECT Symbol AS ticker, TickerId, SectorId, IndustryId FROM ({TICKERS}) t
    JOIN ({SECTORS}) s ON t.Sector = s.Sector JOIN ({INDUSTRIES}) i ON t.Industry = i.Industry"""
_IDS = f"{_date_key('date')} AS DateId, TickerId, SectorId, IndustryId"
_PRICES = rounded_as(
    2, OpenPrice="open", HighPrice="high", LowPrice="low", ClosePrice="close", AdjustedClosePrice="close"
)
PRICE_FACTS = f"SELECT {_IDS}, {_PRICES}, volume AS Volume FROM ({tb.BARS_SUPPLIER}) b JOIN ({KEYS}) k ON b.ticker = k.ticker"
_TECHNICAL = rounded_as(
    2,
    sma20="sma_20",
    sma50="sma_50",
    atr="atr",
    rsi="rsi",
    macd="macd",
    bollinger_bands_down="bb_lower",
    bollinger_bands_up="bb_upper",
)
TECHNICAL_FACTS = (
    f"SELECT {_IDS}, {_TECHNICAL} FROM ({INDICATORS_SQL(tb.BARS_SUPPLIER)}) b JOIN ({KEYS}) k ON b.ticker = k.ticker"
)


def _joined(facts: str, measures: str) -> str:
    return f"""SELECT make_date(d.Year, d.Month, d.Day) AS DateKey, d.Year, d.Quarter, d.Month, d.Week, d.Day,
        t.Symbol, t.Name, s.Sector, i.Industry, {measures}
        FROM ({facts}) f JOIN ({DATES}) d ON f.DateId = d.DateId JOIN ({TICKERS}) t ON f.TickerId = t.TickerId
        JOIN ({SECTORS}) s ON f.SectorId = s.SectorId JOIN ({INDUSTRIES}) i ON f.IndustryId = i.IndustryId"""


STAR_PRICES = _joined(
    PRICE_FACTS, "OpenPrice, HighPrice, LowPrice, ClosePrice, AdjustedClosePrice, Volume"
)
STAR_TECHNICAL = _joined(
    TECHNICAL_FACTS, "sma20, sma50, atr, rsi, macd, bollinger_bands_down, bollinger_bands_up"
)


def prices(spark, folder):
    return price_history(tb.bars_by_supplier(spark, folder))


def stored_bars(spark, folder):
    """Bars written once, for queries that pass over them more than once."""
    return materialised(tb.bars_by_supplier(spark, folder), "bars")


def technical(bars):
    return technical_indicators(compute_indicators(bars))


def dimensions(spark, folder):
    """The three keyed dimensions, stored as a load would find them."""
    m = tb.master(spark, folder)
    return [materialised(dim, "dimension") for dim in (star.dim_ticker(m), star.dim_sector(m), star.dim_industry(m))]


def stored_dates(bars):
    """The date dimension, stored like the others: it is counted before it is joined."""
    return materialised(star.dim_date(bars), "dimension")


def lookup(dims):
    return star.ticker_keys(*dims)


@query(DATES)
def dim_date(spark, folder):
    return star.dim_date(tb.bars_by_supplier(spark, folder))


@query(SECTORS)
def dim_sector(spark, folder):
    return star.dim_sector(tb.master(spark, folder))


@query(INDUSTRIES)
def dim_industry(spark, folder):
    return star.dim_industry(tb.master(spark, folder))


@query(TICKERS)
def dim_ticker(spark, folder):
    return star.dim_ticker(tb.master(spark, folder))


_EARLY = f"SELECT * FROM ({tb.MASTER}) WHERE sector < 'ASIA' OR sector > 'EUROPE'"


@query(f"""WITH early AS ({_EARLY}),
    k AS (SELECT {_key_sql('ticker')} AS TickerId, ticker FROM early),
    n AS (SELECT (SELECT count(*) FROM k) + {_key_sql('ticker')} AS TickerId, ticker
          FROM ({tb.MASTER}) WHERE ticker NOT IN (SELECT ticker FROM k))
    SELECT CAST(TickerId AS INTEGER) AS TickerId, m.ticker AS Symbol, company_name AS Name,
           upper(sector) || '!' AS Sector, industry AS Industry
    FROM (SELECT * FROM k UNION ALL SELECT * FROM n) x JOIN ({tb.MASTER}) m ON x.ticker = m.ticker""")
def surrogate_keys_stable(spark, folder):
    """A second load keeps known keys, updates attributes and numbers the rest after the largest key."""
    m = tb.master(spark, folder)
    known = star.dim_ticker(m.where((F.col("sector") < "ASIA") | (F.col("sector") > "EUROPE")))
    return star.dim_ticker(m.withColumn("sector", F.concat(F.upper("sector"), F.lit("!"))), known)


@query(KEYS)
def ticker_key_lookup(spark, folder):
    """Symbol to ticker, sector and industry keys, the last two in two steps."""
    return lookup(dimensions(spark, folder))


@query(PRICE_FACTS)
def fact_prices(spark, folder):
    return star.fact_prices(prices(spark, folder), lookup(dimensions(spark, folder)))


@query(TECHNICAL_FACTS)
def fact_technical(spark, folder):
    return star.fact_technical(technical(stored_bars(spark, folder)), lookup(dimensions(spark, folder)))


@query(f"""SELECT b.ticker, date, {rounded('close', 2)} AS close, sector, industry
    FROM ({tb.BARS_SUPPLIER}) b LEFT JOIN ({tb.MASTER}) m ON b.ticker = m.ticker""")
def enrich_master(spark, folder):
    """Sector and industry onto price rows."""
    attributes = tb.master(spark, folder).select("ticker", "sector", "industry")
    rows = prices(spark, folder).select("ticker", "date", "close")
    return rows.join(broadcast_if_small(attributes), "ticker", "left")


# Predictions: a week ahead, with unknown members on some days and a second, different copy on others.
PREDICTIONS = f"""WITH p AS (
      SELECT CAST(date + INTERVAL 7 DAY AS DATE) AS date, date AS exportDate,
             CASE WHEN day(date) = 13 THEN 'UNKNOWN' ELSE b.ticker END AS ticker,
             CASE WHEN day(date) = 17 THEN 'NOWHERE' ELSE sector END AS sector,
             CASE WHEN day(date) = 19 THEN 'NOTHING' ELSE industry END AS industry, close
      FROM ({tb.BARS_SUPPLIER}) b JOIN ({tb.MASTER}) m ON b.ticker = m.ticker)
    SELECT * FROM p UNION ALL SELECT * REPLACE (close + 1 AS close) FROM p WHERE day(exportDate) = 21"""
RESOLVED = f"""SELECT {_date_key('date')} AS DateId, TickerId, SectorId, IndustryId,
      {_date_key('exportDate')} AS PredictionDateId, close AS PredictedPrice, p.ticker, p.sector, p.industry,
      CASE WHEN TickerId IS NULL THEN 'unknown ticker' WHEN SectorId IS NULL THEN 'unknown sector'
           WHEN IndustryId IS NULL THEN 'unknown industry' END AS reason
    FROM ({PREDICTIONS}) p LEFT JOIN ({TICKERS}) t ON p.ticker = t.Symbol
    LEFT JOIN ({SECTORS}) s ON p.sector = s.Sector LEFT JOIN ({INDUSTRIES}) i ON p.industry = i.Industry"""
RANKED = f"""SELECT *, row_number() OVER (PARTITION BY DateId, TickerId ORDER BY PredictedPrice) AS rn
    FROM ({RESOLVED}) WHERE reason IS NULL"""
_PREDICTED = "DateId, TickerId, SectorId, IndustryId, PredictionDateId, PredictedPrice"
PREDICTED = f"SELECT {_PREDICTED} FROM ({RANKED}) WHERE rn = 1"
REJECTED = f"""SELECT {_PREDICTED}, ticker, sector, industry, reason FROM ({RESOLVED}) WHERE reason IS NOT NULL
    UNION ALL SELECT {_PREDICTED}, NULL, NULL, NULL, 'duplicate key' FROM ({RANKED}) WHERE rn > 1"""


def predictions(spark, folder):
    day = F.dayofmonth("exportDate")
    m = tb.master(spark, folder)
    p = (
        stored_bars(spark, folder)
        .select("ticker", F.date_add("date", 7).alias("date"), F.col("date").alias("exportDate"), "close")
        .join(broadcast_if_small(m), "ticker")
        .select(
            "date",
            "exportDate",
            F.when(day == 13, "UNKNOWN").otherwise(F.col("ticker")).alias("ticker"),
            F.when(day == 17, "NOWHERE").otherwise(F.col("sector")).alias("sector"),
            F.when(day == 19, "NOTHING").otherwise(F.col("industry")).alias("industry"),
            "close",
        )
    )
    return p.unionAll(p.where(day == 21).withColumn("close", F.col("close") + 1))


@query(PREDICTED)
def fact_predicted(spark, folder):
    return star.fact_predicted(predictions(spark, folder), *dimensions(spark, folder))[0]


@query(f"SELECT * EXCLUDE (n), CAST(n AS BIGINT) AS copies FROM (SELECT *, count(*) AS n FROM ({REJECTED}) GROUP BY ALL)")
def predicted_rejects(spark, folder):
    """Every refused prediction with the reason."""
    return star.fact_predicted(predictions(spark, folder), *dimensions(spark, folder))[1]


@query(PREDICTED)
def predictions_from_csv(spark, folder):
    """The import end to end: CSV files to the stored fact table."""
    path, root = work_folder(spark, "predictions"), work_folder(spark, "gold")
    predictions(spark, folder).write.option("header", "true").csv(path)
    for frame, spec in zip(dimensions(spark, folder), (DIM_TICKER, DIM_SECTOR, DIM_INDUSTRY)):
        rewrite_table(frame, f"{root}/{spec.name}")
    import_predictions(spark, root, read_predictions(spark, path))
    return read_gold(spark, root, FACT_PREDICTED)


@query(f"""SELECT DISTINCT {_parts('d')} FROM (SELECT date AS d FROM ({tb.BARS_SUPPLIER})
    UNION ALL SELECT CAST(o_orderdate AS DATE) FROM orders)""")
def date_get_or_insert(spark, folder):
    """Days the dimension lacks are added with all their parts."""
    dates = star.dim_date(tb.bars_by_supplier(spark, folder))
    return star.add_dates(dates, tb.table(spark, folder, "orders"), "o_orderdate")


@query(STAR_PRICES)
def star_prices(spark, folder):
    bars, dims = stored_bars(spark, folder), dimensions(spark, folder)
    facts = star.fact_prices(price_history(bars), lookup(dims))
    dates = stored_dates(bars)
    return star.export_order(star.denormalised(facts, dates, *dims))


@query(STAR_TECHNICAL)
def star_indicators(spark, folder):
    bars, dims = stored_bars(spark, folder), dimensions(spark, folder)
    facts = star.fact_technical(technical(bars), lookup(dims))
    dates = stored_dates(bars)
    return star.export_order(star.denormalised(facts, dates, *dims))


_MONEY = ("OpenPrice", "HighPrice", "LowPrice", "ClosePrice", "AdjustedClosePrice")


@query(f"""SELECT * REPLACE ({', '.join(f"printf('%.4f', {c}) AS {c}" for c in _MONEY)}) FROM ({STAR_PRICES})""")
def csv_export_format(spark, folder):
    """Export rows with four decimals."""
    bars, dims = stored_bars(spark, folder), dimensions(spark, folder)
    facts = star.fact_prices(price_history(bars), lookup(dims))
    dates = stored_dates(bars)
    return four_decimals(star.denormalised(facts, dates, *dims))


@query(f"""SELECT 'stock_prices_daily' AS file, count(*) AS rows FROM ({tb.BARS_EVENT})
    UNION ALL SELECT 'technical_indicators_daily', count(*) FROM ({tb.BARS_EVENT})""")
def gold_refresh_export(spark, folder):
    """Star load and CSV export on stored tables; the rows written per file."""
    root, target = work_folder(spark, "gold"), work_folder(spark, "export")
    bars = materialised(tb.bars_by_event(spark, folder), "bars")
    names = bars.select("ticker").distinct()
    m = names.select(
        "ticker", F.upper("ticker").alias("company_name"), F.lit("web").alias("sector"), F.lit("clicks").alias("industry")
    )
    refresh_gold(spark, root, price_history(bars), technical_indicators(compute_indicators(bars)), m)
    export_star(spark, root, target)
    log = spark.read.schema("file string, rows bigint, exported_at string").json(f"{target}/export_log")
    return log.select("file", "rows")


_KNOWN = "ticker NOT IN ('error', 'signup')"
_GIVEN = f"SELECT * FROM ({tb.BARS_EVENT}) UNION ALL SELECT * FROM ({tb.BARS_EVENT}) WHERE volume % 5 = 0"


@query(f"""SELECT 'inserted' AS outcome, count(DISTINCT (ticker, date)) AS rows FROM ({_GIVEN}) WHERE {_KNOWN}
    UNION ALL SELECT 'missing: TickerId', count(*) FROM ({_GIVEN}) WHERE NOT {_KNOWN}
    UNION ALL SELECT 'duplicate key', count(*) - count(DISTINCT (ticker, date)) FROM ({_GIVEN}) WHERE {_KNOWN}
    UNION ALL SELECT 'stored', count(DISTINCT (ticker, date)) FROM ({_GIVEN}) WHERE {_KNOWN}
    UNION ALL SELECT 'refused with reason', count(*) FROM ({_GIVEN}) WHERE NOT {_KNOWN}""")
def gold_load_counts(spark, folder):
    """Bars of which some come twice and some belong to no known ticker, through the checked fact load: its counts, and what was stored."""
    root, bars = work_folder(spark, "gold"), price_history(materialised(tb.bars_by_event(spark, folder), "bars"))
    known = bars.select("ticker").distinct().where(_KNOWN)
    m = materialised(known.select("ticker", F.upper("ticker").alias("company_name"), F.lit("web").alias("sector"), F.lit("clicks").alias("industry")), "master")
    lookup = star.ticker_keys(star.dim_ticker(m), star.dim_sector(m), star.dim_industry(m))
    given = bars.unionAll(bars.where("volume % 5 = 0"))
    counts = load_facts(star.shaped_prices(given, lookup), root, FACT_PRICES)
    counts["stored"] = read_gold(spark, root, FACT_PRICES).count()
    counts["refused with reason"] = spark.read.parquet(f"{root}/refused/{FACT_PRICES.name}").where("reason = 'missing: TickerId'").count()
    return spark.createDataFrame(list(counts.items()), "outcome string, rows bigint")


# Keyed inserts: order lines keyed by (order, line number), which is not unique.
_LINES = "SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity > 49 THEN NULL ELSE l_quantity END AS qty, l_returnflag FROM lineitem"
_JUDGED = f"""SELECT *, CASE WHEN qty IS NULL THEN 'missing: qty' END AS reason,
    row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY qty, l_returnflag) AS rn
    FROM ({_LINES}) WHERE qty IS NOT NULL"""
_INSERTED = f"SELECT l_orderkey, l_linenumber, qty, l_returnflag FROM ({_JUDGED}) WHERE rn = 1"
_REFUSED = f"""SELECT *, 'missing: qty' AS reason FROM ({_LINES}) WHERE qty IS NULL
    UNION ALL SELECT l_orderkey, l_linenumber, qty, l_returnflag, 'duplicate key' FROM ({_JUDGED}) WHERE rn > 1"""


def _split(spark, folder):
    lines = tb.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_quantity") <= 49, F.col("l_quantity")).alias("qty"), "l_returnflag"
    )
    return split_valid(lines, ["l_orderkey", "l_linenumber"], ["qty"], ["qty"])


@query(_INSERTED)
def insert_accepted(spark, folder):
    return _split(spark, folder)[0]


@query(f"SELECT *, count(*) AS copies FROM ({_REFUSED}) GROUP BY ALL")
def insert_rejected(spark, folder):
    return _split(spark, folder)[1]


@query(f"""SELECT CAST(i AS BIGINT) AS inserted, CAST(s AS BIGINT) AS skipped, CAST(i + s AS BIGINT) AS total
    FROM (SELECT (SELECT count(*) FROM ({_INSERTED})) AS i, (SELECT count(*) FROM ({_REFUSED})) AS s)""")
def insert_summary(spark, folder):
    return insert_counts(*_split(spark, folder))


@query("""SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def primary_key_violations(spark, folder):
    return key_violations(tb.table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])

