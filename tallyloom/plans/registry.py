"""Every checked query by name: a callable from (session, table folder) to a DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.contracts import ALERT_RULES, FOREX_RULES, SUMMARY_KEYS, TRADE_KEYS, TRADE_RULES
from tallyloom.functions import text as txt
from tallyloom.functions.hashing import keyed_hash
from tallyloom.functions.market import classify_risk, day_folder
from tallyloom.functions.urls import contains_any, portal_name, url_host
from tallyloom.operators import alerts, bayes, encode, frames, gold, impute, isolation, keyed, kneser_ney, linear, metrics, models
from tallyloom.operators import pages as pg
from tallyloom.operators import profile, quality, sampling, sequences, silver, text_forest, tfidf
from tallyloom.plans import fixtures as fx
from tallyloom.session import write_staged
from tallyloom.sources.files import read_labelled
from tallyloom.sources.tables import register_views

CUT_DAY, SECOND_DAY, ONE_DAY = "1999-06-30", "1999-01-01", "1998-06-15"
CLASSES = ("Fake", "Real")
LATIN = "a-zA-ZÀ-ÖØ-öø-ÿ"
LATIN_STOPWORDS = ("the", "of", "and", "la", "de", "die", "der", "und", "que", "el")
LETTERS = "abcdefghijklmnopqrstuvwxyz"
DEVANAGARI_LETTERS = "रमकलछनयतपसहगदबजघचटडणथधफभवश"
ENCODED = ("item_fat_content", "outlet_location_type", "outlet_size", "outlet_type",
           "item_identifier", "outlet_identifier")
FAT_SPELLINGS = {"LF": "Low Fat", "low fat": "Low Fat", "reg": "Regular"}
LINK_PATTERNS = ("/th", "/en", "/de", "/la")
LINE_KEYS = ("conv_id", "turn", "line_no")
SUMMARY = ("trade_date", "buyer_broker", "seller_broker", "symbol", "total_volume", "total_amount", "trade_count")
TRADE_COLUMNS = ("contract_id", "trade_date", "symbol", "buyer_broker", "seller_broker",
                 "quantity", "rate", "total_amount")


def _r(c, digits: int = 6) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


def _day(value: str) -> Column:
    return F.lit(value).cast("date")


# --- raw documents and cleaning ------------------------------------------------------------------

def a1_forex_roundtrip(spark, d):
    return silver.clean_forex(silver.flatten_forex(fx.forex_documents(spark, d)), audit=False)


def a2_floorsheet_roundtrip(spark, d):
    return silver.clean_trades(silver.flatten_trades(fx.floorsheet_documents(spark, d)), audit=False)


def b1_forex_unnest(spark, d):
    flat = silver.flatten_forex(fx.forex_documents(spark, d))
    return flat.select(F.col("of_day").alias("raw_date"), F.col("entry.currency.iso3").alias("iso3"), F.col("entry.currency.name").alias("name"),
                       F.col("entry.buy").alias("buy"), F.col("entry.sell").alias("sell"))


def b2_trades_unnest(spark, d):
    flat = silver.flatten_trades(fx.floorsheet_documents(spark, d))
    return flat.select(F.col("of_day").alias("payload_date"), F.col("entry.contract_id").alias("contract_id"),
                       F.col("entry.symbol").alias("symbol"), F.col("entry.quantity").alias("quantity"))


def d15_dedupe(spark, d):
    return keyed.dedupe(fx.raw_trades(spark, d), TRADE_KEYS, list(fx.TRADE_ORDER)).select(*TRADE_COLUMNS)


# --- matrix and wash trades ----------------------------------------------------------------------

def a7_fact_for_day(spark, d):
    return gold.for_day(fx.fact(spark, d), ONE_DAY)


def a14_views(spark, d):
    register_views(fx.silver_trades(spark, d), fx.fact(spark, d))
    return spark.sql("SELECT symbol, risk_classification, count(*) AS pairs, sum(aggregate_matched_volume) AS volume "
                     "FROM view_wash_trade_detection GROUP BY symbol, risk_classification")


def b8_staging(spark, d):
    raw = fx.silver_trades(spark, d).withColumn("symbol", F.concat(F.lit(" "), F.lower("symbol"), F.lit("  ")))
    return gold.stage_trades(raw)


def b12_risk_tiers(spark, d):
    pairs = gold.reciprocal_pairs_agg(fx.fact(spark, d))
    return pairs.select("trade_date", "symbol", "broker_a", "broker_b", classify_risk(
        F.col("aggregate_matched_amount"), F.col("volume_symmetry_ratio")).alias("risk_classification"))


def _rounded_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.withColumn("volume_symmetry_ratio", _r("volume_symmetry_ratio"))


def c1_reciprocal_pairs(spark, d):
    return _rounded_pairs(gold.reciprocal_pairs(fx.fact(spark, d)))


def c1b_reciprocal_pairs_agg(spark, d):
    return _rounded_pairs(gold.reciprocal_pairs_agg(fx.fact(spark, d)))


def d1_broker_matrix(spark, d):
    return fx.fact(spark, d)


def f1_wash_trades(spark, d):
    return gold.wash_trades(fx.fact(spark, d))


# --- keys and increments -------------------------------------------------------------------------

def _flagged(spark, d) -> DataFrame:
    """Matrix rows a fixed rule calls outliers."""
    return fx.fact(spark, d).filter(F.col("total_volume") >= 60)


def _alert_rows(df: DataFrame) -> DataFrame:
    return df.select("alert_date", "alert_type", "broker_id", "symbol", "risk_score", "details", "is_reviewed")


def c2_append_if_absent(spark, d):
    made = alerts.build_alerts(_flagged(spark, d))
    existing = made.filter(F.col("broker_id") == 1).withColumn("is_reviewed", F.lit(True))
    return _alert_rows(existing.unionByName(alerts.build_alerts(_flagged(spark, d), existing)))


def c3_merge_upsert(spark, d):
    f = fx.fact(spark, d)
    target = f.filter(F.col("trade_date") <= _day(CUT_DAY))
    updates = f.filter(F.col("trade_date") >= _day(SECOND_DAY)).withColumn("total_volume", F.col("total_volume") + 1)
    return keyed.merge_upsert(target, updates, SUMMARY_KEYS)


def _cut_fact(spark, d) -> DataFrame:
    return fx.fact(spark, d).filter(F.col("trade_date") <= _day(CUT_DAY))


def c4_incremental_slice(spark, d):
    staged = gold.stage_trades(fx.silver_trades(spark, d))
    return keyed.incremental_slice(staged, _cut_fact(spark, d)).select(*TRADE_COLUMNS)


def c4_slice_with_lookback(spark, d):
    staged = gold.stage_trades(fx.silver_trades(spark, d))
    return keyed.incremental_slice(staged, _cut_fact(spark, d), lookback_days=30).select(*TRADE_COLUMNS)


def l2_refresh_fact(spark, d):
    target = _cut_fact(spark, d).withColumn("total_volume", F.col("total_volume") * 10)
    return gold.refresh_fact(gold.stage_trades(fx.silver_trades(spark, d)), target)


def l4_first_run(spark, d):
    # The matrix, its last day and the new rows all come from the trades: they are made once.
    staged = write_staged(gold.stage_trades(fx.silver_trades(spark, d)))
    return gold.refresh_fact(staged, gold.daily_broker_summary(staged).filter(F.col("total_volume") < 0))


def i18_alerts(spark, d):
    return _alert_rows(alerts.build_alerts(_flagged(spark, d)))


def i19_open_alerts(spark, d):
    made = alerts.build_alerts(_flagged(spark, d))
    return _alert_rows(alerts.open_alerts(made.withColumn("is_reviewed", F.col("broker_id") == 1)))


def i17_isolation_scores(spark, d):
    return isolation.isolation_scores(fx.fact(spark, d))


def b14_outlier_alerts(spark, d):
    return _alert_rows(alerts.build_alerts(isolation.outliers(isolation.isolation_scores(fx.fact(spark, d)))))


# --- quality -------------------------------------------------------------------------------------

def _flawed_trades(spark, d) -> DataFrame:
    """Raw trades with missing symbols, zero quantities and negative amounts."""
    t = fx.raw_trades(spark, d)
    return (t.withColumn("symbol", F.when(F.col("l_partkey") % 11 != 0, F.col("symbol")))
            .withColumn("quantity", F.when(F.col("l_suppkey") % 13 == 0, 0).when(F.col("l_suppkey") % 17 != 0, F.col("quantity")))
            .withColumn("total_amount", F.when(F.col("l_partkey") % 19 == 0, -F.col("total_amount")).otherwise(F.col("total_amount")).cast("decimal(16,2)")))


def k1_not_null(spark, d):
    return quality.check_not_null(_flawed_trades(spark, d), ["contract_id", "symbol", "quantity", "trade_date"])


def k2_rules(spark, d):
    return quality.check_rules(_flawed_trades(spark, d), TRADE_RULES)


def k2_forex_rules(spark, d):
    """Rules of the rates on rates with a zero unit, a negative rate, a long code or a long name."""
    rates = fx.forex(spark, d)
    day, code = F.dayofmonth("rate_date"), F.col("currency_iso3")
    flawed = rates.select(
        "rate_date", F.when(day == 3, F.concat(code, F.lit("x"))).otherwise(code).alias("currency_iso3"),
        F.when(day == 5, F.repeat("currency_name", F.lit(20))).otherwise(F.col("currency_name")).alias("currency_name"),
        F.when(day == 7, F.lit(0)).when(day != 9, F.col("currency_unit")).alias("currency_unit"),
        F.when(day == 11, -F.col("buying_rate")).otherwise(F.col("buying_rate")).alias("buying_rate"),
        F.when(day == 13, -F.col("selling_rate")).when(day != 15, F.col("selling_rate")).alias("selling_rate"))
    return quality.check_rules(flawed, FOREX_RULES)


def k2_alert_rules(spark, d):
    """Rules of the alerts on alerts with a score above one, a long type or a long symbol."""
    made = alerts.build_alerts(_flagged(spark, d))
    day = F.dayofmonth("alert_date")
    flawed = made.withColumns({
        "risk_score": F.when(day < 10, F.col("risk_score") + F.lit(1)).when(day < 12, F.lit(None)).otherwise(F.col("risk_score")),
        "alert_type": F.when(day % 3 == 0, F.repeat("alert_type", F.lit(3))).otherwise(F.col("alert_type")),
        "symbol": F.concat("symbol", "symbol")})
    return quality.check_rules(flawed, ALERT_RULES)


def k3_unique(spark, d):
    return quality.check_unique(fx.raw_trades(spark, d), TRADE_KEYS)


def k3_unique_contract(spark, d):
    return quality.check_unique(fx.raw_trades(spark, d), ["contract_id"])


def k4_quarantine(spark, d):
    _, rejected = quality.quarantine(_flawed_trades(spark, d), TRADE_RULES, ["symbol", "quantity"])
    return rejected.select("contract_id", "trade_date", "total_amount", "reasons")


# --- frames --------------------------------------------------------------------------------------

def b13_label_filter(spark, d):
    docs = read_labelled(spark, f"{d}/documents.parquet", "text", "lang")
    return frames.with_label(frames.filter_label(docs, "fr"), "Fake", "assigned")


def b17_recode(spark, d):
    df = frames.recode(fx.retail(spark, d), "item_fat_content", FAT_SPELLINGS)
    df = frames.years_since(df, "outlet_establishment_year")
    df = (df.withColumn("fat_code", frames.ordinal(F.col("item_fat_content"), models.FAT_CODES))
          .withColumn("size_code", frames.ordinal(F.col("outlet_size"), models.SIZE_CODES)))
    return frames.drop_if_present(df, ["item_outlet_sales", "outlet_establishment_year", "no_such_column"]).select(
        "l_orderkey", "l_linenumber", "item_identifier", "item_fat_content", "outlet_years", "fat_code", "size_code")


def d2_row_counts(spark, d):
    return fx.retail(spark, d).agg(F.count(F.lit(1)).alias("rows"))


def d3_value_counts(spark, d):
    df = frames.recode(fx.retail(spark, d), "item_fat_content", FAT_SPELLINGS)
    return profile.value_counts(df, "item_fat_content")


def d4_null_counts(spark, d):
    return profile.null_counts(fx.retail(spark, d).drop("l_orderkey", "l_linenumber"))


def d5_profile(spark, d):
    return profile.profile(fx.retail(spark, d).drop("l_orderkey", "l_linenumber"))


def d6_impute(spark, d):
    df = fx.retail(spark, d).withColumn("outlet_size_const", F.col("outlet_size"))
    df = impute.impute(df, means=["item_weight"], modes=["outlet_size"], constants={"outlet_size_const": "Medium"})
    return df.select("l_orderkey", "l_linenumber", _r("item_weight").alias("item_weight"), "outlet_size", "outlet_size_const")


def d9_class_sizes(spark, d):
    return profile.class_sizes(fx.news(spark, d), "label", CLASSES)


def _ruled(spark, d) -> DataFrame:
    """Predictions of a fixed rule joined to the true labels by document id."""
    docs = fx.news(spark, d)
    guess = docs.select("doc_id", F.when(F.length("text") % 3 == 0, "Fake").otherwise("Real").alias("prediction"))
    return metrics.align(guess, docs.select("doc_id", "label"), "doc_id")


def d10_confusion(spark, d):
    return metrics.confusion(_ruled(spark, d), CLASSES)


def d11_accuracy(spark, d):
    return metrics.accuracy(_ruled(spark, d)).select(_r("accuracy").alias("accuracy"))


def d12_class_report(spark, d):
    return metrics.classification_report(_ruled(spark, d), CLASSES)


def d13_regression_report(spark, d):
    pred = fx.retail(spark, d).select(F.col("item_outlet_sales").alias("label"), (F.col("item_mrp") * 10).alias("prediction"))
    report = metrics.regression_report(pred)
    return report.select(_r("mse", 1).alias("mse"), _r("rmse", 4).alias("rmse"), _r("mae", 4).alias("mae"), _r("r2").alias("r2"))


def f2_head(spark, d):
    return frames.head(fx.texts(spark, d).select("doc_id", "source", "text"), ["doc_id"], 5)


def g1_concat_frames(spark, d):
    docs = fx.news(spark, d)
    real = frames.filter_label(docs, "Real").select("doc_id", "source", "label")
    fake = frames.filter_label(docs, "Fake").select("label", "doc_id", F.length("text").alias("n_chars"))
    return frames.concat_frames(real, fake)


def i6_split(spark, d):
    return sampling.with_part(fx.news(spark, d), "doc_id").select("doc_id", "label", "part")


def i6_split_exact(spark, d):
    return sampling.split_exact(fx.news(spark, d), "doc_id").select("doc_id", "label", "part")


def i7_balance(spark, d):
    return sampling.balance(fx.news(spark, d).select("doc_id", "source", "label"), "label", "doc_id", CLASSES)


def f5_shuffle(spark, d):
    docs = frames.shuffle(fx.texts(spark, d).select("doc_id", "source"), "doc_id")
    return docs.select("doc_id", "source", keyed_hash(F.col("doc_id"), 42).alias("place"))


def i13_label_encode(spark, d):
    encoded, _ = encode.label_encode(fx.retail(spark, d), ENCODED)
    return encoded.select("l_orderkey", "l_linenumber", *ENCODED)


# --- text ----------------------------------------------------------------------------------------

def _latin_clean(c: Column) -> Column:
    return txt.clean_text(c, keep=LATIN, drop="0-9", stopwords=LATIN_STOPWORDS)


def _devanagari(c: Column) -> Column:
    return F.translate(c, LETTERS, DEVANAGARI_LETTERS)


def h11_clean_text(spark, d):
    docs = fx.texts(spark, d)
    return docs.select("doc_id", txt.clean_basic(F.col("text"), LATIN).alias("basic"), _latin_clean(F.col("text")).alias("cleaned"))


def h11_clean_devanagari(spark, d):
    return fx.table(spark, d, "documents").select("doc_id", txt.clean_text(_devanagari(F.col("text"))).alias("cleaned"))


def m1_clean_text_sql(spark, d):
    txt.register_text_functions(spark)
    docs = fx.table(spark, d, "documents").select("doc_id", _devanagari(F.col("text")).alias("raw"))
    return docs.select("doc_id", F.expr("clean_text(raw)").alias("cleaned"))


def h16_url_host(spark, d):
    pages = fx.table(spark, d, "pages")
    return pages.select("page_id", url_host(F.col("url")).alias("host"), portal_name(F.col("url")).alias("portal"),
                        contains_any(F.col("url"), ["/en/", "/de/"]).alias("listed"))


def h21_details(spark, d):
    return fx.fact(spark, d).select(
        "trade_date", "buyer_broker", "seller_broker", "symbol", day_folder(F.col("trade_date")).alias("folder"),
        alerts.alert_details(F.col("total_volume"), F.col("total_amount")).alias("details"))


def h24_prefix(spark, d):
    return fx.texts(spark, d).select("doc_id", txt.prefix(F.col("text")).alias("prefix"))


def _words(spark, d) -> DataFrame:
    docs = fx.news(spark, d)
    return docs.select("doc_id", "label", txt.tokens(_latin_clean(F.col("text"))).alias("words"))


def _all_words(spark, d) -> DataFrame:
    """Words of every document, labelled or not."""
    return fx.texts(spark, d).select("doc_id", F.lit(None).cast("string").alias("label"),
                                     txt.tokens(_latin_clean(F.col("text"))).alias("words"))


def _counts(docs: DataFrame, lo: int = 1, hi: int = 1, most: int | None = None) -> DataFrame:
    return tfidf.term_counts(docs, "doc_id", "words", carry=("label",), lo=lo, hi=hi, most=most)


def i3_tokens(spark, d):
    docs = fx.texts(spark, d)
    return frames.unnest(docs, ["doc_id"], txt.tokens(F.col("text")), "token", "pos")


def i4_ngrams(spark, d):
    return _counts(_all_words(spark, d), 1, 3).select("doc_id", "term", "tf")


def d17_term_stats(spark, d):
    return tfidf.term_stats(_counts(_all_words(spark, d), 1, 2))


def f6_top_terms(spark, d):
    return tfidf.top_terms(tfidf.term_stats(_counts(_all_words(spark, d))), 500)


def _weights(docs: DataFrame, counts: DataFrame, **fit) -> tuple:
    model = tfidf.fit_tfidf(counts, docs, **fit)
    return model, tfidf.apply_tfidf(counts, model, "doc_id", carry=("label",))


def i5_tfidf(spark, d):
    docs = _all_words(spark, d)
    _, weights = _weights(docs, _counts(docs), max_df=0.7)
    return weights.select("doc_id", "term", _r("weight").alias("weight"))


def i5_tfidf_capped(spark, d):
    docs = _all_words(spark, d)
    _, weights = _weights(docs, _counts(docs, 1, 3, tfidf.VOCABULARY), max_features=tfidf.VOCABULARY)
    return weights.select("doc_id", "term", _r("weight").alias("weight"))


def i8_nb_model(spark, d):
    docs = _words(spark, d)
    _, weights = _weights(docs, _counts(docs))
    model = bayes.fit_nb(weights, docs, CLASSES)
    return bayes.class_terms(model).select("term", "label", _r("log_prob").alias("log_prob"))


def i8_nb_priors(spark, d):
    docs = _words(spark, d)
    _, weights = _weights(docs, _counts(docs))
    return bayes.class_priors(bayes.fit_nb(weights, docs, CLASSES)).select("label", _r("log_prior").alias("log_prior"))


def f7_top_class_terms(spark, d):
    docs = _words(spark, d)
    _, weights = _weights(docs, _counts(docs, 1, 2))
    return bayes.top_class_terms(bayes.fit_nb(weights, docs, CLASSES), 20, digits=6)


def _nb_predictions(spark, d, docs: DataFrame | None = None, **fit) -> DataFrame:
    train, test = sampling.split(_words(spark, d) if docs is None else docs, "doc_id")
    vocab, weights = _weights(train, _counts(train), **fit)
    model = bayes.fit_nb(weights, train, CLASSES)
    unseen = tfidf.apply_tfidf(_counts(test), vocab, "doc_id", carry=("label",))
    return bayes.predict_nb(unseen, test, model, vocab, "doc_id")


def i9_nb_predict(spark, d):
    return _nb_predictions(spark, d).select("doc_id", "prediction", _r("confidence", 4).alias("confidence"))


def i9_nb_predict_capped(spark, d):
    predicted = _nb_predictions(spark, d, max_features=tfidf.VOCABULARY)
    return predicted.select("doc_id", "prediction", _r("confidence", 4).alias("confidence"))


def _even_news(spark, d) -> DataFrame:
    """Labelled texts, as many of each class; drawn with another seed than the split that follows."""
    return sampling.balance(fx.news(spark, d), "label", "doc_id", CLASSES, seed=7)


def d12_balanced_report(spark, d):
    """Balance the classes, clean, split, fit, predict, and report on the predictions."""
    even = _even_news(spark, d)
    words = even.select("doc_id", "label", txt.tokens(_latin_clean(F.col("text"))).alias("words"))
    predicted = _nb_predictions(spark, d, words).select("doc_id", "prediction")
    return metrics.classification_report(metrics.align(predicted, even.select("doc_id", "label"), "doc_id"), CLASSES)


# --- models --------------------------------------------------------------------------------------

def i11_rf_text(spark, d):
    train, test = sampling.split(fx.news(spark, d), "doc_id")
    predicted = text_forest.score_text_forest(text_forest.fit_text_forest(train, ngram=(1, 2)), test)
    return metrics.align(predicted.select("doc_id", "prediction"), test.select("doc_id", "label"), "doc_id")


def i11_rf_text_balanced(spark, d):
    """Twice the trees over one to three words, fitted on classes of one size; probabilities per test document."""
    train, test = sampling.split(_even_news(spark, d), "doc_id")
    model = text_forest.fit_text_forest(train, trees=models.TEXT_TREES_BALANCED, ngram=(1, 3), vocab=tfidf.VOCABULARY)
    return text_forest.score_text_forest(model, test)


def i12_linear_text(spark, d):
    train, test = sampling.split(fx.news(spark, d), "doc_id")
    predicted = linear.predict_linear(linear.fit_linear(train, CLASSES), test)
    return metrics.align(predicted.select("doc_id", "prediction"), test.select("doc_id", "label"), "doc_id")


def _sales_model(spark, d, features):
    train, _ = sampling.split(_sales_rows(spark, d), "row_id")
    return models.fit_sales(train, "item_outlet_sales", features, key="row_id")


def _sales_rows(spark, d) -> DataFrame:
    df = frames.recode(fx.retail(spark, d), "item_fat_content", FAT_SPELLINGS)
    df = impute.impute(df, means=["item_weight"], modes=["outlet_size"])
    df, _ = encode.label_encode(df, ["outlet_location_type", "outlet_type"])
    row_id = F.concat_ws("-", "l_orderkey", "l_linenumber", "item_identifier", "outlet_identifier")
    return models.sales_attributes(df).withColumn("row_id", row_id)


WIDE = (*models.SALES_ATTRIBUTES, "outlet_location_type", "outlet_type")


def i14_sales_forest(spark, d):
    _, test = sampling.split(_sales_rows(spark, d), "row_id")
    scored = models.score_sales(test.select("item_outlet_sales", *WIDE), _sales_model(spark, d, WIDE))
    return metrics.regression_report(scored, "item_outlet_sales")


def f4_importances(spark, d):
    return models.top_importances(_sales_model(spark, d, WIDE))


def i16_batch_score(spark, d):
    rows = _sales_rows(spark, d).select("row_id", *models.SALES_ATTRIBUTES)
    return models.score_sales(rows, _sales_model(spark, d, models.SALES_ATTRIBUTES)).select(
        "row_id", *models.SALES_ATTRIBUTES, "prediction")


# --- sequences -----------------------------------------------------------------------------------

def _text_lines(spark, d) -> DataFrame:
    return sequences.text_lines(fx.table(spark, d, "conversations"), ["conv_id", "turn"])


def i20_vocabulary(spark, d):
    return sequences.vocabulary(_text_lines(spark, d), LINE_KEYS)


def _ragged(spark, d) -> DataFrame:
    lines = _text_lines(spark, d)
    encoded = sequences.encode_lines(lines, sequences.vocabulary(lines, LINE_KEYS), LINE_KEYS)
    return sequences.ragged_sequences(encoded, LINE_KEYS)


def _digest(ids: str) -> Column:
    """Whole id list as one short value, to keep the compared result small."""
    return F.md5(F.array_join(F.col(ids).cast("array<string>"), " "))


def i21_prefixes(spark, d):
    return sequences.prefix_views(_ragged(spark, d), LINE_KEYS).select(*LINE_KEYS, "size", F.element_at("seq", 1).alias("first_id"), _digest("seq").alias("seq"))


def i22_padded(spark, d):
    padded = sequences.padded_views(_ragged(spark, d), LINE_KEYS)
    return padded.select(*LINE_KEYS, "size", F.size("x").alias("width"), _digest("x").alias("x"), "y")


def i23_next_words(spark, d):
    lines = _text_lines(spark, d)
    words = txt.sequence_words(F.col("line"))
    seeds = lines.select(*LINE_KEYS, F.array_join(F.slice(words, 1, 2), " ").alias("seed")).filter(F.col("seed") != "")
    return sequences.next_words(seeds, sequences.next_word_table(lines, LINE_KEYS), 4)


def i23_kneser_ney(spark, d):
    """The most likely word after the first three of each line, by runs of up to four words."""
    lines = _text_lines(spark, d)
    words = txt.sequence_words(F.col("line"))
    seeds = lines.select(*LINE_KEYS, F.array_join(F.slice(words, 1, 3), " ").alias("seed")).filter(F.col("seed") != "")
    found = kneser_ney.suggest(seeds, kneser_ney.fit_kneser_ney(lines))
    return found.withColumn("prob", _r("prob", 9))


# --- pages ---------------------------------------------------------------------------------------

def _pages(spark, d) -> DataFrame:
    return fx.table(spark, d, "pages")


def j1_title(spark, d):
    return pg.page_titles(_pages(spark, d))


def j1_title_nodes(spark, d):
    return pg.page_titles(_pages(spark, d), default=None, strip="nodes")


def j2_body(spark, d):
    return pg.page_bodies(_pages(spark, d), "plain")


def j2_body_portal(spark, d):
    return pg.page_bodies(_pages(spark, d), "portal")


def j2_body_site(spark, d):
    return pg.page_bodies(_pages(spark, d), "site")


def j3_keep(spark, d):
    articles = pg.article_rows(_pages(spark, d), "Real", "site")
    return pg.keep_article(articles, min_body=3000).select("page_id", F.length("Text").alias("n_chars"))


def j4_links(spark, d):
    return pg.page_links(_pages(spark, d), LINK_PATTERNS)


def f3_first_links(spark, d):
    return pg.page_links(_pages(spark, d), limit=3)


def j6_articles(spark, d):
    return pg.article_rows(_pages(spark, d), "Real", "portal")


def j5_claim_listing(spark, d):
    return pg.claim_listing(fx.listing_pages(spark, d))


def c5_claim_pages(spark, d):
    return pg.join_claim_pages(pg.claim_listing(fx.listing_pages(spark, d)), _pages(spark, d))


QUERIES = {f.__name__: f for f in (
    f1_wash_trades, a1_forex_roundtrip, a2_floorsheet_roundtrip, a7_fact_for_day, a14_views, b1_forex_unnest,
    b2_trades_unnest, b8_staging, b12_risk_tiers, b13_label_filter, b14_outlier_alerts, b17_recode,
    c1_reciprocal_pairs, c1b_reciprocal_pairs_agg, c2_append_if_absent, c3_merge_upsert, c4_incremental_slice,
    c4_slice_with_lookback, c5_claim_pages, d1_broker_matrix, d2_row_counts, d3_value_counts, d4_null_counts,
    d5_profile, d6_impute, d9_class_sizes, d10_confusion, d11_accuracy, d12_class_report, d12_balanced_report, d13_regression_report,
    d15_dedupe, d17_term_stats, f2_head, f3_first_links, f4_importances, f5_shuffle, f6_top_terms,
    f7_top_class_terms, g1_concat_frames, h11_clean_text, h11_clean_devanagari, h16_url_host, h21_details,
    h24_prefix, i3_tokens, i4_ngrams, i5_tfidf, i5_tfidf_capped, i6_split, i6_split_exact, i7_balance, i8_nb_model, i8_nb_priors,
    i9_nb_predict, i9_nb_predict_capped, i11_rf_text, i11_rf_text_balanced, i12_linear_text, i13_label_encode, i14_sales_forest,
    i16_batch_score, i17_isolation_scores, i18_alerts, i19_open_alerts, i20_vocabulary, i21_prefixes, i22_padded,
    i23_next_words, i23_kneser_ney, j1_title, j1_title_nodes, j2_body, j2_body_portal, j2_body_site, j3_keep, j4_links,
    j5_claim_listing, j6_articles, k1_not_null, k2_rules, k2_forex_rules, k2_alert_rules, k3_unique, k3_unique_contract, k4_quarantine,
    l2_refresh_fact, l4_first_run, m1_clean_text_sql)}
