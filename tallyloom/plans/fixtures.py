"""Trades, rates, news, retail and page tables derived from the given tables, in the shape the operators read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.contracts import FLOORSHEET_DOCUMENT, FOREX_DOCUMENT, TRADE_KEYS
from tallyloom.functions.html import page_title
from tallyloom.operators.gold import daily_broker_summary, stage_trades
from tallyloom.operators.keyed import dedupe

TRADE_ORDER = ("trade_date", "l_partkey", "l_suppkey", "quantity", "total_amount", "l_discount", "l_tax")
TRADES_TYPE = FLOORSHEET_DOCUMENT["trades"].dataType
RATES_TYPE = FOREX_DOCUMENT["data"].dataType["payload"].dataType.elementType["rates"].dataType


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    line, orders, part = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "part"))
    return (line.join(orders, line.l_orderkey == orders.o_orderkey)
            .join(part, line.l_partkey == part.p_partkey))


def raw_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades before de-duplication; the l_* columns break ties."""
    price = F.col("l_extendedprice") * 40
    return _lines(spark, sf_dir).select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("contract_id"),
        F.col("l_shipdate").cast("date").alias("trade_date"),
        F.col("p_type").alias("symbol"),
        (F.col("o_custkey") % 3).cast("int").alias("buyer_broker"),
        (F.col("l_suppkey") % 3).cast("int").alias("seller_broker"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.floor(price / F.col("l_quantity")).cast("decimal(12,2)").alias("rate"),
        price.cast("decimal(16,2)").alias("total_amount"),
        "l_partkey", "l_suppkey", "l_discount", "l_tax")


def silver_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per contract and day under a total order."""
    first = dedupe(raw_trades(spark, sf_dir), TRADE_KEYS, list(TRADE_ORDER))
    return first.filter((F.col("quantity") > 0) & (F.col("total_amount") > 0))


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily broker matrix of the silver trades."""
    return daily_broker_summary(stage_trades(silver_trades(spark, sf_dir)))


def forex(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rate per day and nation."""
    orders, customer, nation = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    joined = (orders.join(customer, orders.o_custkey == customer.c_custkey)
              .join(nation, customer.c_nationkey == nation.n_nationkey))
    return joined.groupBy(
        F.col("o_orderdate").cast("date").alias("rate_date"),
        F.concat(F.lit("n"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("currency_iso3"),
    ).agg(F.min("n_name").alias("currency_name"), F.lit(1).alias("currency_unit"),
          F.min("o_totalprice").cast("decimal(12,4)").alias("buying_rate"),
          F.max("o_totalprice").cast("decimal(12,4)").alias("selling_rate"))


def floorsheet_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trade documents: each holds one trade, in text form, and a broken copy of it.

    One document per trade keeps every array short; the broken copies (no id, or unreadable quantity)
    and the documents without trades must vanish in cleaning.
    """
    t = raw_trades(spark, sf_dir)
    text = {"contract_id": F.col("contract_id"), "symbol": F.concat(F.lit(" "), F.lower("symbol"), F.lit(" ")),
            "buyer_broker": F.col("buyer_broker").cast("string"), "seller_broker": F.col("seller_broker").cast("string"),
            "quantity": F.concat(F.col("quantity").cast("string"), F.lit(".7")), "rate": F.col("rate").cast("string"),
            "amount": F.col("total_amount").cast("string"),
            "trade_time": F.concat(F.lit("line "), F.col("l_partkey").cast("string"))}
    good = F.struct(*[v.alias(k) for k, v in text.items()])
    broken = F.struct(*[(F.lit("1,200") if k == "quantity" else v).alias(k) for k, v in text.items()])
    nameless = F.struct(*[(F.lit(None).cast("string") if k == "contract_id" else v).alias(k) for k, v in text.items()])
    trades = (F.when(F.col("l_partkey") % 3 == 0, F.array(good, broken))
              .when(F.col("l_partkey") % 3 == 1, F.array(nameless, good)).otherwise(F.array(good)))
    none = F.array().cast(TRADES_TYPE)
    document = F.to_json(F.struct(
        F.lit("SUCCESS").alias("status"), F.col("trade_date").cast("string").alias("date"),
        F.when(F.col("quantity") == 50, none).otherwise(trades).alias("trades")))
    return t.select(F.from_json(document, FLOORSHEET_DOCUMENT).alias("d")).select("d.*")


def forex_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rate documents: one per day and currency, with an unreadable and a nameless rate beside it."""
    def rate(iso, buy):
        return F.struct(F.struct(iso.alias("iso3"), F.col("currency_name").alias("name"),
                                 F.col("currency_unit").alias("unit")).alias("currency"),
                        buy.alias("buy"), F.col("selling_rate").cast("string").alias("sell"))

    good = rate(F.col("currency_iso3"), F.col("buying_rate").cast("string"))
    unreadable = rate(F.concat(F.lit("x"), F.substring("currency_iso3", 2, 2)), F.lit("n/a"))
    nameless = rate(F.lit(None).cast("string"), F.lit("1"))
    day = F.struct(F.col("rate_date").cast("string").alias("date"), F.array(good, unreadable, nameless).alias("rates"))
    empty = F.struct(F.col("rate_date").cast("string").alias("date"), F.array().cast(RATES_TYPE).alias("rates"))
    document = F.to_json(F.struct(
        F.struct(F.lit(200).alias("code"), F.lit("OK").alias("message")).alias("status"),
        F.struct(F.array(day, empty).alias("payload")).alias("data")))
    return forex(spark, sf_dir).select(F.from_json(document, FOREX_DOCUMENT).alias("d")).select("d.*")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: (doc_id, text, source)."""
    return table(spark, sf_dir, "documents").select("doc_id", "text", "source")


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents: (doc_id, text, source, label)."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return docs.join(labels, "doc_id").select(
        "doc_id", "text", "source", F.when(F.col("quality") == 1, "Real").otherwise("Fake").alias("label"))


def retail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item and outlet rows with missing values and several spellings."""
    fat = F.col("p_partkey") % 5
    size = F.col("l_suppkey") % 4
    return _lines(spark, sf_dir).select(
        F.col("p_partkey").cast("string").alias("item_identifier"),
        F.when(F.col("p_partkey") % 7 != 0, F.col("p_size").cast("double")).alias("item_weight"),
        F.when(fat == 0, "LF").when(fat == 1, "low fat").when(fat == 2, "reg").when(fat == 3, "Low Fat")
        .otherwise("Regular").alias("item_fat_content"),
        F.col("l_discount").alias("item_visibility"), F.col("p_retailprice").alias("item_mrp"),
        F.col("l_suppkey").cast("string").alias("outlet_identifier"),
        F.year("o_orderdate").cast("int").alias("outlet_establishment_year"),
        F.when(size == 1, "Small").when(size == 2, "Medium").when(size == 3, "High").alias("outlet_size"),
        F.col("o_orderpriority").alias("outlet_location_type"), F.col("l_returnflag").alias("outlet_type"),
        F.col("l_extendedprice").alias("item_outlet_sales"),
        "l_orderkey", "l_linenumber")


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact-check listings over the stored pages: each names its own page, with headings of several kinds."""
    pages = table(spark, sf_dir, "pages")
    title = F.coalesce(page_title(F.col("html"), None), F.lit(""))
    safe = F.replace(F.replace(title, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    link = F.concat(F.lit('<a class="more" href="'), F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit('#claim">more</a>'))

    def block(*parts):
        return F.concat(F.lit('<article class="entry">'), *parts, F.lit("</article>"))

    h2 = F.concat(F.lit("<h2> <b>"), safe, F.lit("</b> </h2>"))
    h3 = F.concat(F.lit("<h3>"), F.col("page_id").cast("string"), F.lit("</h3>"))
    kind = F.col("page_id") % 4
    body = (F.when(kind == 0, F.concat(block(h2, link), block(h3)))
            .when(kind == 1, F.concat(block(h3, link), block(h3, h2, link)))
            .when(kind == 2, F.concat(block(link), block(h2, link)))
            .otherwise(block(h3, F.lit('<a href="https://unknown.example/none">none</a>'))))
    return pages.select("page_id", "url", F.concat(
        F.lit("<html><body><!-- <article><h2>hidden</h2></article> -->"), body, F.lit("</body></html>")).alias("html"))
