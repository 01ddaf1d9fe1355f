"""Cleaning, tokenising and n-grams as native column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# The characters the cleaner keeps, given as the inside of a regex class.
DEVANAGARI = r"ऀ-ॿ"
LATIN_AND_DIGITS = "a-zA-Z0-9"
# Every character Python calls white space: the Unicode property and four separators (\s is ASCII-only in Java).
# A property is one look at the character's type; a list of ranges is one look for each.
WHITESPACE = r"\p{IsWhite_Space}\x1C-\x1F"

# Words without meaning of their own.
NEPALI_STOPWORDS = (
    "र", "पनि", "छ", "छन्", "हो", "हुन्", "भएको", "गरेको", "भने", "गर्नु",
    "तथा", "गरेका", "भनेका", "यस", "यो", "त्यो", "मा", "को", "का", "ले",
    "लाई", "देखि", "बाट", "सम्म", "भनेर", "पर्ने", "पर्छ", "हुने", "हुन्छ",
)

# Punctuation that separates words in token sequences.
SEQUENCE_PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~\t\n"

# Length that reaches past the end of any array.
REST = 1 << 30

REFERENCE_TOKEN = r"[\p{L}\p{N}_]{2,}"
WHOLE_WORD_TOKEN = r"[\p{L}\p{M}\p{N}_]{2,}"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, also where ``body`` uses it inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip_space(c: Column) -> Column:
    """Cut white space of any kind off both ends."""
    return F.regexp_replace(c, f"^[{WHITESPACE}]+|[{WHITESPACE}]+$", "")


def squeeze_space(c: Column) -> Column:
    """Runs of white space become one blank; none at the ends."""
    # Single blanks, by far the most, are no match and are not copied one by one.
    return F.trim(F.regexp_replace(c, f"[{WHITESPACE}]{{2,}}|[{WHITESPACE}&&[^ ]]", " "))


def _unusual(keep: str) -> str:
    """A look ahead that the most frequent characters fail at once: those of the first range in ``keep`` and the blank."""
    first = re.match(r"[^\\\[\]^&-]-[^\\\[\]^&-]", keep)
    return f"(?=[^{first[0]} ])" if first else ""


def clean_basic(c: Column, keep: str = DEVANAGARI) -> Column:
    """Drop every character that is neither in ``keep`` nor white space."""
    return F.regexp_replace(c, f"{_unusual(keep)}[^{keep}{WHITESPACE}]+", "")


def drop_stopwords(c: Column, stopwords=NEPALI_STOPWORDS) -> Column:
    """Drop whole words, keep order and repeats of the others."""
    # IN over literals becomes one hash lookup per word.
    return F.array_join(F.filter(F.split(c, " "), lambda w: ~w.isin(list(stopwords))), " ")


def clean_text(c: Column, keep: str = DEVANAGARI, drop: str = LATIN_AND_DIGITS,
               stopwords=NEPALI_STOPWORDS, strip_danda: bool = False) -> Column:
    """Full cleaning; null gives empty text. The danda lies inside the kept range and stays unless asked."""
    gone = drop + (r"\u0964\u0965" if strip_danda else "")
    text = clean_basic(F.coalesce(c.cast("string"), F.lit("")), keep)
    text = squeeze_space(F.regexp_replace(text, f"[{gone}]+", "") if gone else text)
    return drop_stopwords(text, stopwords) if stopwords else text


def tokens(c: Column, mode: str = "reference") -> Column:
    """Lower-cased words of two or more characters.

    ``reference`` ends a word at a vowel sign, as the usual ``\\w\\w+`` rule does; ``word`` keeps signs.
    """
    pattern = {"reference": REFERENCE_TOKEN, "word": WHOLE_WORD_TOKEN}[mode]
    return F.regexp_extract_all(F.lower(c), F.lit(f"({pattern})"), F.lit(1))


def ngrams(words: Column, lo: int = 1, hi: int = 1, gaps: bool = False) -> Column:
    """All runs of ``lo`` to ``hi`` neighbouring words, each joined by a blank. With ``gaps`` no run goes over a null word."""
    if (lo, hi) == (1, 1):
        return words

    def runs(w: Column, n: int) -> Column:
        starts = F.when(F.size(w) >= n, F.sequence(F.lit(0), F.size(w) - n)).otherwise(
            F.array().cast("array<int>"))
        # Single elements are read in constant time; slice() would copy the whole array for every run.
        if gaps:  # concat gives null where a word is null, concat_ws passes over it
            return F.array_compact(F.transform(starts, lambda i: F.concat(
                F.get(w, i), *[part for k in range(1, n) for part in (F.lit(" "), F.get(w, i + k))])))
        return F.transform(starts, lambda i: F.concat_ws(" ", *[F.get(w, i + k) for k in range(n)]))

    single = F.array_compact if gaps else lambda w: w
    return let(words, lambda w: F.flatten(F.array(*[single(w) if n == 1 else runs(w, n) for n in range(lo, hi + 1)])))


def counted(words: Column) -> Column:
    """(term, tf) of each different word, alphabetical; null words do not count. Sorted within the row, so nothing is kept across rows."""
    def ends(s: Column) -> Column:  # the places of the last ones of equal words, from 1 on
        places = F.when(F.size(s) > 0, F.sequence(F.lit(1), F.size(s))).otherwise(F.array().cast("array<int>"))
        return F.filter(places, lambda i: ~F.get(s, i).eqNullSafe(F.get(s, i - 1)))

    def pairs(s: Column, e: Column) -> Column:
        before = lambda k: F.coalesce(F.get(e, k - 1), F.lit(0))
        return F.transform(e, lambda i, k: F.struct(F.get(s, i - 1).alias("term"), (i - before(k)).cast("long").alias("tf")))

    return let(F.sort_array(F.array_compact(words)), lambda s: let(ends(s), lambda e: pairs(s, e)))


def sequence_words(c: Column) -> Column:
    """Words for token sequences: lower-cased, punctuation becomes a blank, split at blanks."""
    blanks = F.translate(F.lower(c), SEQUENCE_PUNCTUATION, " " * len(SEQUENCE_PUNCTUATION))
    return F.filter(F.split(blanks, " "), lambda w: w != F.lit(""))


def prefix(c: Column, n: int = 50) -> Column:
    """First ``n`` characters, for display."""
    return F.substring(c, 1, n)


def register_text_functions(spark: SparkSession) -> None:
    """Make ``clean_text`` callable from SQL as an inlined SQL function (no Python worker)."""
    stop = ", ".join(f"'{w}'" for w in NEPALI_STOPWORDS)
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION clean_text(raw STRING) RETURNS STRING
        RETURN array_join(filter(
          split(trim(regexp_replace(regexp_replace(regexp_replace(coalesce(raw, ''),
                r'[^{DEVANAGARI}{WHITESPACE}]', ''), '[{LATIN_AND_DIGITS}]', ''),
                r'[{WHITESPACE}]+', ' ')), ' '),
          w -> w NOT IN ({stop})), ' ')
    """)
