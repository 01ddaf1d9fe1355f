"""Secret scans: fixed patterns, and a character Markov model that adds what the patterns miss.

Two first-order Markov models over characters are trained from samples that the patterns label: strings found as secrets
are the random class, identifiers without digits the ordinary class. A long run of key-like characters is a secret if
its log-likelihood ratio, random against ordinary, is high in total and on average. Everything is built-in expressions;
the trained table is at most 66 x 66 numbers.

Null and empty texts have no spans. Rows are handled one by one, so repeated rows give repeated results; other columns
are left alone. An empty table, or one without any secret, trains a uniform random class. Offsets count code points.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import empty_array, own, running_sum, text_of

# The patterns of the base kinds, in the order in which ties are listed.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "markov")
SHORTEST_VALUE = 12
ANY_BASE = r"(?i:password|passwd|secret|token|api_?key)|AKIA[A-Z0-9]{14}|[0-9a-f]{16}"

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
STATES = len(ALPHABET) + 1
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
IDENTIFIER = r"\b[A-Za-z_]{6,}\b"
SAMPLE_DOCS = 2_000
LEAST_TOTAL, LEAST_MEAN = 20.0, 0.8
SPAN = "start:bigint,kind:int,end:bigint"


def _spans(text: Column, pattern: str, kind: int, least: Column | None = None, group: int = 0) -> Column:
    """(start, kind, end) of the matches; ``least`` is the length that the given group must have."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    lengths = F.flatten(F.zip_with(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches)), matches, lambda between, match: F.array(
        F.length(between).cast("long"), F.length(match).cast("long"))))
    edges = F.col("__edges")
    found = F.transform(values, lambda value, i: F.struct(
        F.get(edges, 2 * i).alias("start"), F.lit(kind).alias("kind"), F.get(edges, 2 * i + 1).alias("end"), F.length(value).alias("size")))
    if least is not None:
        found = F.filter(found, lambda s: s["size"] >= least)
    kept = F.transform(found, lambda s: F.struct(s["start"], s["kind"], s["end"]))
    return lengths, kept


def _with_spans(df: DataFrame, text: str, pattern: str, kind: int, name: str, gate: Column,
                least: Column | None = None, group: int = 0) -> DataFrame:
    lengths, kept = _spans(F.col(text), pattern, kind, least, group)
    nothing = empty_array(f"struct<{SPAN}>")
    return (df.withColumn("__lengths", F.when(gate, lengths).otherwise(empty_array("bigint")))
            .withColumn("__edges", F.when(F.size("__lengths") > 0, running_sum(F.col("__lengths"))).otherwise(empty_array("bigint")))
            .withColumn(name, F.when(F.size("__edges") > 0, kept).otherwise(nothing)).drop("__lengths", "__edges"))


def base_spans(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add ``name``: spans of the three fixed kinds, ordered by start and then kind."""
    hit, a, b, c = own("hit", "assign", "access", "hex")
    found = df.withColumn(hit, F.col(text).rlike(ANY_BASE))
    gate = F.col(hit)
    found = _with_spans(found, text, ASSIGN, 0, a, gate, F.lit(SHORTEST_VALUE), 2)
    found = _with_spans(found, text, ACCESS, 1, b, gate)
    found = _with_spans(found, text, HEX, 2, c, gate)
    return found.withColumn(name, F.array_sort(F.concat(a, b, c))).drop(hit, a, b, c)


def _code(char: Column) -> Column:
    """1 to 66 for the characters of the alphabet, 0 for any other and before the first."""
    return F.instr(F.lit(ALPHABET), char)


def train(docs: DataFrame, text: str = "text", key: str = "doc_id", sample: int = SAMPLE_DOCS) -> list[float]:
    """Log-likelihood ratios, ``STATES`` x ``STATES`` by (character before, character), random against ordinary.

    Each class is learned from the ``sample`` documents with the lowest hash of the key (of those with a base match,
    for the random class), so the size of the sample is fixed by a parameter and the choice by the rows.
    """
    frame = docs.select(F.col(key).alias("__key"), text_of(text).alias("__text"))

    def drawn(rows: DataFrame) -> DataFrame:
        keys = (rows.select("__key").filter(F.col("__key").isNotNull()).distinct()
                .orderBy(F.xxhash64("__key"), "__key").limit(sample))
        # Of a key's rows the text with the smallest hash stands for it, in whatever order they come.
        return rows.join(F.broadcast(keys), "__key", "left_semi").groupBy("__key").agg(F.min_by("__text", F.xxhash64("__text")).alias("__text"))

    secrets = drawn(frame.filter(F.col("__text").rlike(ANY_BASE)))
    values = F.concat(F.regexp_extract_all("__text", F.lit(ASSIGN), F.lit(2)),
                      F.regexp_extract_all("__text", F.lit(ACCESS), F.lit(0)),
                      F.regexp_extract_all("__text", F.lit(HEX), F.lit(0)))
    values = F.filter(values, lambda v: F.length(v) >= SHORTEST_VALUE)
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace("__text", ASSIGN, " "), ACCESS, " "), HEX, " ")
    ordinary = drawn(frame)
    strings = (secrets.select(F.lit(1).alias("cls"), F.explode(values).alias("s"))
               .unionAll(ordinary.select(F.lit(0).alias("cls"), F.explode(F.regexp_extract_all(plain, F.lit(IDENTIFIER), F.lit(0))).alias("s"))))
    pairs = strings.select("cls", F.explode(F.transform(F.split("s", ""), lambda ch, i: F.struct(
        F.when(i > 0, _code(F.substring("s", i, F.lit(1)))).otherwise(F.lit(0)).alias("a"), _code(ch).alias("b")))).alias("p"))
    counts = {0: [[0] * STATES for _ in range(STATES)], 1: [[0] * STATES for _ in range(STATES)]}
    for row in pairs.groupBy("cls", "p.a", "p.b").count().collect():  # at most 2 x STATES x STATES rows
        counts[row["cls"]][row["a"]][row["b"]] = row["count"]
    return [math.log(r / o) for r_row, o_row in zip(_model(counts[1], 0.5), _model(counts[0], 0.0)) for r, o in zip(r_row, o_row)]


def _model(counts: list[list[int]], uniform: float) -> list[list[float]]:
    """Transition probabilities, smoothed by those of single characters and mixed with a uniform share."""
    single = [sum(row[b] for row in counts) for b in range(STATES)]
    total = sum(single)
    single = [(n + 0.5) / (total + 0.5 * STATES) for n in single]
    return [[uniform / STATES + (1 - uniform) * (row[b] + 5 * single[b]) / (sum(row) + 5) for b in range(STATES)] for row in counts]


def _ratio(token: Column, model: Column) -> Column:
    """Log-likelihood ratio of a whole string."""
    steps = F.transform(F.split(token, ""), lambda ch, i: F.get(model, STATES * F.when(
        i > 0, _code(F.substring(token, i, F.lit(1)))).otherwise(F.lit(0)) + _code(ch)))
    return F.aggregate(steps, F.lit(0.0), lambda acc, x: acc + x)


def _constant(ratios: list[float]) -> Column:
    """The table as one constant array, folded when the query is planned."""
    return F.split(F.lit(",".join(f"{x:.6f}" for x in ratios)), ",").cast("array<double>")


def _random(token: Column, ratios: list[float]) -> Column:
    score = _ratio(token, _constant(ratios))
    return (score >= LEAST_TOTAL) & (score >= LEAST_MEAN * F.length(token))


def scan(docs: DataFrame, ratios: list[float], text: str = "text", base: str = "base_spans", more: str = "model_spans") -> DataFrame:
    """Add two arrays of (start, kind, end): the fixed kinds, and what the Markov model finds beside them."""
    t, cand = own("text", "cand")
    found = base_spans(docs.withColumn(t, text_of(text)), t, base)
    found = _with_spans(found, t, CANDIDATE, 3, cand, F.col(t).rlike(CANDIDATE))
    known = F.col(base)
    apart = F.filter(F.col(cand), lambda c: ~F.exists(known, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    random = F.filter(F.col(more), lambda c: _random(F.substring(F.col(t), c["start"].cast("int") + 1, (c["end"] - c["start"]).cast("int")), ratios))
    return (found.withColumn(more, apart)
            .withColumn(more, F.when(F.size(more) > 0, random).otherwise(F.col(more))).drop(t, cand))


def spans_text(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, ratios: list[float], text: str = "text", mark: str = "[secret]") -> DataFrame:
    """Replace every secret by ``mark``; of an assignment only the value goes. Null texts stay null."""
    def over(pattern: str, test, group: int, new) -> Column:
        t = F.col(text)
        matches = F.regexp_extract_all(t, F.lit(pattern), F.lit(0))
        values = F.regexp_extract_all(t, F.lit(pattern), F.lit(group))
        parts = F.split(t, pattern, -1)
        pairs = F.arrays_zip(matches.alias("match"), values.alias("value"))
        mended = F.transform(pairs, lambda p: F.when(test(p["value"]), new(p["match"], p["value"])).otherwise(p["match"]))
        last = F.element_at(parts, -1)
        return F.when(t.rlike(pattern), F.concat(F.array_join(F.zip_with(
            F.slice(parts, F.lit(1), F.size(matches)), mended, lambda a, b: F.concat(a, b)), ""), last)).otherwise(t)

    def always(v: Column) -> Column:
        return F.lit(True)

    def whole(m: Column, v: Column) -> Column:
        return F.lit(mark)

    def value_only(m: Column, v: Column) -> Column:
        return F.concat(F.substring(m, F.lit(1), F.length(m) - F.length(v)), F.lit(mark))

    out = docs.withColumn(text, over(ASSIGN, lambda v: F.length(v) >= SHORTEST_VALUE, 2, value_only))
    out = out.withColumn(text, over(ACCESS, always, 0, whole))
    out = out.withColumn(text, over(HEX, always, 0, whole))
    return out.withColumn(text, over(CANDIDATE, lambda v: _random(v, ratios), 0, whole))


def op10_secret_scans(docs: DataFrame) -> DataFrame:
    """One row per document: counts per fixed kind, a digest of their spans, and all spans."""
    found = scan(docs.select("doc_id", "text"), train(docs))

    def count(kind: int) -> Column:
        return F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(spans_text(F.col("base_spans")), 256).alias("base_sha256"),
        spans_text(F.array_sort(F.concat("base_spans", "model_spans"))).alias("spans"),
        F.size("model_spans").cast("long").alias("n_markov"))
