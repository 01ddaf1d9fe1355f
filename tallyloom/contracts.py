"""Table contracts: declared schemas, natural keys and quality rules."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _L = T.StringType(), T.IntegerType(), T.LongType()


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(f[0], f[1], f[2] if len(f) > 2 else True) for f in fields])


# Raw documents, as landed. Every field may be missing; prices and trade fields arrive as text.
FOREX_DOCUMENT = _struct(
    ("status", _struct(("code", _I), ("message", _S))),
    ("data", _struct(
        ("payload", T.ArrayType(_struct(
            ("date", _S),
            ("rates", T.ArrayType(_struct(
                ("currency", _struct(("iso3", _S), ("name", _S), ("unit", _I))),
                ("buy", _S),
                ("sell", _S),
            ))),
        ))),
    )),
)

FLOORSHEET_DOCUMENT = _struct(
    ("status", _S),
    ("date", _S),
    ("trades", T.ArrayType(_struct(
        ("contract_id", _S), ("symbol", _S), ("buyer_broker", _S), ("seller_broker", _S),
        ("quantity", _S), ("rate", _S), ("amount", _S), ("trade_time", _S),
    ))),
)

# Cleaned and summarised tables.
FOREX_RATES = _struct(
    ("rate_date", T.DateType(), False),
    ("currency_iso3", _S, False),
    ("currency_name", _S, False),
    ("currency_unit", _I, False),
    ("buying_rate", T.DecimalType(12, 4), False),
    ("selling_rate", T.DecimalType(12, 4), False),
    ("ingested_at", T.TimestampType()),
)

TRADES = _struct(
    ("contract_id", _S, False),
    ("trade_date", T.DateType(), False),
    ("symbol", _S, False),
    ("buyer_broker", _I, False),
    ("seller_broker", _I, False),
    ("quantity", _L, False),
    ("rate", T.DecimalType(12, 2), False),
    ("total_amount", T.DecimalType(16, 2), False),
    ("trade_time_str", _S),
    ("processed_at", T.TimestampType()),
)

BROKER_SUMMARY = _struct(
    ("trade_date", T.DateType(), False),
    ("buyer_broker", _I, False),
    ("seller_broker", _I, False),
    ("symbol", _S, False),
    ("total_volume", _L, False),
    ("total_amount", T.DecimalType(18, 2), False),
    ("trade_count", _I, False),
    ("created_at", T.TimestampType()),
)

RISK_ALERTS = _struct(
    ("alert_id", _L, False),
    ("alert_date", T.DateType(), False),
    ("alert_type", _S, False),
    ("broker_id", _I, False),
    ("symbol", _S),
    ("risk_score", T.DecimalType(5, 4), False),
    ("details", _S),
    ("is_reviewed", T.BooleanType()),
    ("created_at", T.TimestampType()),
)

NEWS = _struct(("URL", _S), ("Source", _S), ("Title", _S), ("Text", _S),
               ("Publish_Date", _S), ("Label", _S))

RETAIL = _struct(
    ("item_identifier", _S), ("item_weight", T.DoubleType()), ("item_fat_content", _S),
    ("item_visibility", T.DoubleType()), ("item_mrp", T.DoubleType()),
    ("outlet_identifier", _S), ("outlet_establishment_year", _I), ("outlet_size", _S),
    ("outlet_location_type", _S), ("outlet_type", _S), ("item_outlet_sales", T.DoubleType()),
)

FOREX_KEYS = ("rate_date", "currency_iso3")
TRADE_KEYS = ("contract_id", "trade_date")
SUMMARY_KEYS = ("trade_date", "buyer_broker", "seller_broker", "symbol")
ALERT_KEYS = ("alert_date", "alert_type", "broker_id", "symbol")

# Rule name -> SQL condition a good row meets. A null result passes, as in a CHECK constraint.
FOREX_RULES = {
    "unit_positive": "currency_unit > 0",
    "buying_rate_not_negative": "buying_rate >= 0",
    "selling_rate_not_negative": "selling_rate >= 0",
    "iso3_length": "length(currency_iso3) <= 3",
    "name_length": "length(currency_name) <= 100",
}
TRADE_RULES = {
    "quantity_positive": "quantity > 0",
    "rate_not_negative": "rate >= 0",
    "amount_not_negative": "total_amount >= 0",
    "contract_id_length": "length(contract_id) <= 64",
    "symbol_length": "length(symbol) <= 20",
}
ALERT_RULES = {
    "score_in_range": "risk_score BETWEEN 0 AND 1",
    "type_length": "length(alert_type) <= 50",
    "symbol_length": "length(symbol) <= 20",
}


def required_columns(schema: T.StructType) -> list[str]:
    """Columns the contract declares not null."""
    return [f.name for f in schema.fields if not f.nullable]
