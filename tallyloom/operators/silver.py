"""Raw documents to clean rows: unnest, coerce, filter, de-duplicate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.contracts import FOREX_KEYS, FOREX_RATES, TRADE_KEYS, TRADES
from tallyloom.functions.casting import to_day, to_dec, to_int, to_long
from tallyloom.operators.keyed import dedupe

# Target column -> (path in the document, coercion to the declared type).
FOREX_SOURCES = {
    "rate_date": ("of_day", to_day),
    "currency_iso3": ("entry.currency.iso3", F.upper),
    "currency_name": ("entry.currency.name", None),
    "currency_unit": ("entry.currency.unit", None),
    "buying_rate": ("entry.buy", to_dec),
    "selling_rate": ("entry.sell", to_dec),
}
TRADE_SOURCES = {
    "contract_id": ("entry.contract_id", None),
    "trade_date": ("of_day", to_day),
    "symbol": ("entry.symbol", lambda c: F.upper(F.trim(c))),
    "buyer_broker": ("entry.buyer_broker", to_int),
    "seller_broker": ("entry.seller_broker", to_int),
    "quantity": ("entry.quantity", to_long),
    "rate": ("entry.rate", to_dec),
    "total_amount": ("entry.amount", to_dec),
    "trade_time_str": ("entry.trade_time", None),
}
RATE_ORDER = ("buying_rate", "selling_rate", "currency_name", "currency_unit")
TRADE_ORDER = ("trade_date", "symbol", "buyer_broker", "seller_broker", "quantity", "total_amount", "rate",
               "trade_time_str")


def with_audit(df: DataFrame, name: str) -> DataFrame:
    """Add the processing time."""
    return df.withColumn(name, F.current_timestamp())


def _entries(documents: DataFrame, day: str, entries: str) -> DataFrame:
    """(of_day, entry): one row per entry of a document's list; an empty list gives one row without an entry."""
    return documents.select(F.col(day).alias("of_day"), F.explode_outer(entries).alias("entry"))


def flatten_forex(raw: DataFrame) -> DataFrame:
    """One row per rate; days without rates keep one row of nulls."""
    return _entries(raw.select(F.inline_outer("data.payload")), "date", "rates")


def flatten_trades(raw: DataFrame) -> DataFrame:
    """One row per trade with the document's date; documents without trades keep one row of nulls."""
    return _entries(raw, "date", "trades")


def _typed(entries: DataFrame, contract: T.StructType, sources: dict) -> DataFrame:
    """Columns of a contract that have a source, each coerced to its declared type."""
    def column(field: T.StructField) -> Column:
        path, coerce = sources[field.name]
        value = F.col(path)
        if coerce is to_dec:
            value = to_dec(value, field.dataType.precision, field.dataType.scale)
        elif coerce is not None:
            value = coerce(value)
        return value.cast(field.dataType).alias(field.name)

    return entries.select(*[column(f) for f in contract.fields if f.name in sources])


def _first(rows: DataFrame, keys, order) -> DataFrame:
    return dedupe(rows, keys, [F.asc_nulls_last(c) for c in order])


def typed_forex(flat: DataFrame) -> DataFrame:
    """All rates with declared types, unfiltered; days without rates give no row."""
    return _typed(flat.filter(F.col("entry").isNotNull()), FOREX_RATES, FOREX_SOURCES)


def typed_trades(flat: DataFrame) -> DataFrame:
    """All trades with declared types, unfiltered; documents without trades give no row."""
    return _typed(flat.filter(F.col("entry").isNotNull()), TRADES, TRADE_SOURCES)


def first_rates(rates: DataFrame) -> DataFrame:
    """One rate per day and currency, the first by buying, then selling rate."""
    return _first(rates, FOREX_KEYS, RATE_ORDER)


def clean_forex(flat: DataFrame, audit: bool = True) -> DataFrame:
    """Typed rates, rows without a currency dropped, one row per day and currency.

    Of several rates for one key the lowest buying, then selling rate is kept.
    """
    named = _typed(flat, FOREX_RATES, FOREX_SOURCES).filter(F.col("currency_iso3").isNotNull())
    rates = first_rates(named)
    return with_audit(rates, "ingested_at") if audit else rates


def first_trades(trades: DataFrame, keys=TRADE_KEYS) -> DataFrame:
    """One trade per key, the first under a total order."""
    return _first(trades, keys, TRADE_ORDER)


def clean_trades(flat: DataFrame, keys=TRADE_KEYS, audit: bool = True) -> DataFrame:
    """Typed trades with an id and a positive quantity, one row per key.

    The survivor of a repeated key is the first by day, symbol, brokers, quantity, amount, rate and time.
    """
    real = _typed(flat, TRADES, TRADE_SOURCES).filter(F.col("contract_id").isNotNull() & (F.col("quantity") > 0))
    trades = first_trades(real, keys)
    return with_audit(trades, "processed_at") if audit else trades
