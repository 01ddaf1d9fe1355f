"""Quality rules: base counts per document, and a decision list learned from labels by sequential covering.

Each rule is a conjunction of thresholds on a document's statistics. A rule is grown on two thirds of the labelled rows
(one condition at a time, by FOIL gain) and pruned on the rest; documents that it covers are taken away and the next rule
is grown, until no rule is precise enough. The list becomes one ordered Spark ``CASE WHEN``: the first rule that holds
rejects, otherwise the document is kept.

The labelled rows are the ``SAMPLE`` labels with the lowest hash of their key: a documented bound, since only that many
small rows of statistics reach the driver. The statistics themselves cover whole texts of all documents.

A null or empty text has no words and fails the base rule. Without labels of both kinds the list is empty and the base
rule alone decides. Repeated rows get equal results; other columns are passed on.
"""

from __future__ import annotations

import re
import sys
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Send this module's functions with the tasks: executors need numpy and pyarrow, but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SAMPLE = 20_000
LEAST_WORDS, MOST_REPEATED_PERCENT = 10, 20
WINDOW = 5
LEAST_PRECISION, LEAST_COVERED, MOST_CONDITIONS, CUTS = 0.95, 10, 4, 32

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_upper", "n_digits", "n_marks", "n_bars", "n_lines", "n_distinct_words")
_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
_BLANKS = {ord(c): None for c in "\x20\x09\x0a\x0b\x0c\x0d"}
# The characters that count as symbols.
_SYMBOLS = "#*$%&|<>"


def text_counts(text: str | None) -> tuple[int, ...]:
    """The statistics of one text, in the order of ``COUNTS`` and ``MORE``."""
    text = text or ""
    words = _WORDS.findall(text)
    n = len(words)
    lines = [line for line in text.split("\n") if _WORDS.search(line)]
    repeated = 0
    if n >= WINDOW:
        windows = list(zip(words, words[1:], words[2:], words[3:], words[4:]))
        seen = Counter(windows)
        if len(seen) < len(windows):
            covered = np.zeros(n + 1, dtype=np.int64)
            at = np.flatnonzero(np.fromiter((seen[w] > 1 for w in windows), dtype=bool, count=len(windows)))
            np.add.at(covered, at, 1)
            np.add.at(covered, at + WINDOW, -1)
            repeated = int((np.cumsum(covered)[:n] > 0).sum())
    chars = "".join(words)
    count = chars.count
    return (n, len(chars), sum(map(count, _SYMBOLS)), len(lines) - len(set(lines)), repeated,
            sum(map(str.isupper, words)), sum(map(count, "0123456789")), count("!") + count("?"), words.count("|"),
            len(lines), len(set(words)))


def with_counts(docs: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """Add the statistics as long columns, each name preceded by ``prefix``."""
    names = [prefix + c for c in (*COUNTS, *MORE)]
    at = docs.columns.index(text)
    schema = T.StructType([*docs.schema.fields, *[T.StructField(n, T.LongType(), False) for n in names]])

    def batches(source):
        for batch in source:
            columns = list(zip(*map(text_counts, batch.column(at).to_pylist()))) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(c, pa.int64()) for c in columns]],
                                             names=[*batch.schema.names, *names])

    return docs.mapInArrow(batches, schema)


def _share(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(0.0)


def features(prefix: str = "") -> dict[str, Column]:
    """What rules may test, by name."""
    c = {n: F.col(f"`{prefix}{n}`").cast("double") for n in (*COUNTS, *MORE)}
    return {
        "words": c["n_words"], "word_length": _share(c["word_chars"], c["n_words"]),
        "symbol_share": _share(c["n_symbols"], c["word_chars"]), "symbols_per_word": _share(c["n_symbols"], c["n_words"]),
        "duplicate_line_share": _share(c["n_dup_lines"], c["n_lines"]), "repeat_share": _share(c["n_repeat_words"], c["n_words"]),
        "upper_share": _share(c["n_upper"], c["n_words"]), "digit_share": _share(c["n_digits"], c["word_chars"]),
        "mark_share": _share(c["n_marks"], c["word_chars"]), "bar_share": _share(c["n_bars"], c["n_words"]),
        "words_per_line": _share(c["n_words"], c["n_lines"]), "distinct_share": _share(c["n_distinct_words"], c["n_words"]),
    }


Rule = list[tuple[str, str, float]]


def _covers(rule: Rule, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    held = np.ones(n, dtype=bool)
    for name, sign, cut in rule:
        held &= (x[name] >= cut) if sign == ">=" else (x[name] <= cut)
    return held


def _precision(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray) -> tuple[float, int]:
    held = _covers(rule, x, len(bad))
    covered = int(held.sum())
    return ((bad & held).sum() + 1) / (covered + 2), covered


def _grow(x: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    rule: Rule = []
    held = np.ones(len(bad), dtype=bool)
    while len(rule) < MOST_CONDITIONS and (bad & held).any() and (~bad & held).any():
        p0, n0 = (bad & held).sum(), held.sum()
        best = (1e-9, None)
        for name, values in x.items():
            inside = values[held & bad]
            cuts = np.unique(np.quantile(inside, np.linspace(0, 1, CUTS)))
            for sign in (">=", "<="):
                for cut in cuts:
                    now = held & ((values >= cut) if sign == ">=" else (values <= cut))
                    p, n = (bad & now).sum(), now.sum()
                    if p:
                        gain = p * (np.log2(p / n) - np.log2(p0 / n0))
                        if gain > best[0]:
                            best = (gain, (name, sign, float(cut)))
        if best[1] is None:
            break
        rule.append(best[1])
        held = _covers(rule, x, len(bad))
    return rule


def _prune(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """Drop last conditions while that makes (good out of covered) on the pruning rows no worse."""
    def worth(r: Rule) -> float:
        held = _covers(r, x, len(bad))
        p, n = (bad & held).sum(), (~bad & held).sum()
        return (p - n) / max(p + n, 1)

    while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
        rule = rule[:-1]
    return rule


def learn(x: dict[str, np.ndarray], bad: np.ndarray, prune: np.ndarray) -> list[Rule]:
    """Ordered rules for ``bad`` rows; ``prune`` marks the rows kept apart for pruning."""
    rules: list[Rule] = []
    left = np.ones(len(bad), dtype=bool)
    while True:
        grow_at, prune_at = left & ~prune, left & prune
        if not (bad & grow_at).any():
            return rules
        rule = _grow({k: v[grow_at] for k, v in x.items()}, bad[grow_at])
        rule = _prune(rule, {k: v[prune_at] for k, v in x.items()}, bad[prune_at])
        precision, covered = _precision(rule, {k: v[left] for k, v in x.items()}, bad[left])
        if not rule or covered < LEAST_COVERED or precision < LEAST_PRECISION:
            return rules
        rules.append(rule)
        left &= ~_covers(rule, x, len(bad))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
        sample: int = SAMPLE) -> list[Rule]:
    """Learn from at most ``sample`` labelled documents; a label of 0 is a document to reject."""
    drawn = (labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull())
             .groupBy(F.col(key).alias("__key")).agg(F.min(label).alias("__label"))
             .orderBy(F.xxhash64("__key"), "__key").limit(sample))
    one = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text"))
    found = with_counts(one.join(F.broadcast(drawn), "__key"), "__text")
    row = found.select("__key", F.struct(F.xxhash64("__text").alias("__order"), "__label", *[c.alias(n) for n, c in features().items()]).alias("row"))
    # Of a key's rows the text with the smallest hash stands for it, in whatever order they come.
    rows = row.groupBy("__key").agg(F.min("row").alias("row")).select("__key", "row.*").orderBy("__key").limit(sample).toPandas()
    if rows["__label"].nunique() < 2:
        return []
    bad = rows["__label"].to_numpy() == 0
    turn = np.zeros(len(rows), dtype=bool)  # every third row of either class prunes
    for kind in (True, False):
        turn[np.flatnonzero(bad == kind)[2::3]] = True
    return learn({n: rows[n].to_numpy(dtype=float) for n in features()}, bad, turn)


def verdict(rules: list[Rule], prefix: str = "") -> Column:
    """Number of the first rule that rejects, from 1; 0 for documents to keep. One ordered CASE WHEN."""
    x = features(prefix)
    found = None
    for i, rule in enumerate(rules, 1):
        held = F.lit(True)
        for name, sign, cut in rule:
            held = held & ((x[name] >= cut) if sign == ">=" else (x[name] <= cut))
        found = F.when(held, F.lit(i)) if found is None else found.when(held, F.lit(i))
    return F.lit(0) if found is None else found.otherwise(F.lit(0))


def base_failed(prefix: str = "") -> Column:
    n = F.col(f"`{prefix}n_words`")
    return (n < LEAST_WORDS) | (100 * F.col(f"`{prefix}n_repeat_words`") > MOST_REPEATED_PERCENT * n)


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that neither the base rule nor the learned list rejects; same columns."""
    rules = fit(docs, labels, key, text)
    counted = with_counts(docs, text, "__")
    return counted.filter(~base_failed("__") & (verdict(rules, "__") == 0)).select(*[F.col(f"`{c}`") for c in docs.columns])


def op3_quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: base counts, the base verdict, the final one, and the rule that rejected."""
    rules = fit(docs, labels)
    counted = with_counts(docs.select("doc_id", "text")).drop("text")
    rule = F.when(F.col("base_failed"), F.lit(0)).otherwise(verdict(rules))
    return (counted.withColumn("base_failed", base_failed()).withColumn("rule", rule)
            .select("doc_id", *COUNTS, "base_failed", (~F.col("base_failed") & (F.col("rule") == 0)).alias("kept"), "rule"))
