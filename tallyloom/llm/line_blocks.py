"""Main text of pages by the line-block distribution.

Markup becomes lines, one per block element; a line counts with the characters that stand in no link. Parts that by element
or class are never article text (menus, footers, sidebars, forms, notices, adverts, comments of readers, scripts and styles)
give no lines. The counts of ``WIDTH`` following lines are summed, and the sums decide:

* In an ``article`` or ``main`` element every window whose sum is zero lies outside the text: a list of links is cut off where
  the sum dives to zero, and the text goes on where it surges again. Short lines with words of their own stay.
* Elsewhere the text runs from the first surge over ``SHARE`` of the page's largest sum to the last dive below it, without the
  short lines that the windows at its ends reach over and with the headings and whole sentences that stand next to it; windows
  whose sum is zero are left out here too.

Text elsewhere is taken in place of the marked element only if it holds more than ``OUTWEIGHS`` times as much: an
element with a teaser does not hide a long text beside it. On a page without such elements the sums alone decide.

Null and empty pages, and pages without text, give an empty text. Pages are read whole, whatever their length, one row at a
time; repeated rows give equal results, and other columns are kept.
"""

from __future__ import annotations

import html as entities
import re
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WIDTH = 3
SHARE = 0.1
OUTWEIGHS = 4

# Elements by their role.
SKIPPED = frozenset("nav header footer aside form script style noscript template svg math iframe object head select button textarea "
                    "dialog menu canvas audio video".split())
RAW = frozenset("script style textarea title noscript iframe".split())
BLOCKS = frozenset("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure "
                   "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary "
                   "table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that a class says nothing about: they hold words, not parts of a page, or the whole page.
NOT_PARTS = HEADINGS | frozenset("html body article main a abbr b br cite code em font i img mark q s small span strong sub sup time u".split())
#: Words of a class, id or role that mark a part as no article text.
UNWANTED = frozenset("ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar side nav navbar "
                     "navigation menu breadcrumb breadcrumbs header footer masthead cookie cookies consent gdpr notice notices alert popup "
                     "modal newsletter subscribe subscription signup login share sharing social comment comments respond reply replies "
                     "disqus related recommended recommendations widget toolbar pagination pager contentinfo complementary".split())
#: Words that may stand beside an unwanted one in a class name without changing what it means.
NEUTRAL = frozenset("area articles bar block bottom box button buttons col column container form global group inner item items js left link links "
                    "list main mobile outer panel primary reader right row secondary section sticky thread top user wrap wrapper x".split())
#: Beside these words, which name the article itself, a header holds the headline; other unwanted words keep their meaning.
OF_ARTICLE = frozenset("article blog content entry news page post story text".split())
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*'|[\"'])*)(?:>|(?=<)|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NOT_SHOWN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_PARTS = HEADINGS | frozenset("html body article main a abbr b br cite code em font i img mark q s small span strong sub sup time u".split())
#: Words of a class, id or role that mark a part as no article text.
UNWANTED = frozenset("ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar side nav navbar "
                     "navigation menu breadcrumb breadcrumbs header footer masthead cookie cookies consent gdpr notice notices alert popup "
                     "modal newsletter subscribe subscription signup login share sharing social comment comments respond reply replies "
                     "disqus related recommended recommendations widget toolbar pagination pager contentinfo complementary".split())
#: Words that may stand beside an unwanted one in a class name without changing what it means.
NEUTRAL = frozenset("area articles bar block bottom box button buttons col column container form global group inner item items js left link links "
                    "list main mobile outer panel primary reader right row secondary section sticky thread top user wrap wrapper x".split())
#: Beside these words, which name the article itself, a header holds the headline; other unwanted words keep their meaning.
OF_ARTICLE = frozenset("article blog content entry news page post story text".split())
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*'|[\"'])*)(?:>|(?=<)|\Z)", re.S)
_MARKED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_PARTS = re.compile(r"[A-Za-z]+")
_SPACE = re.compile(r"\s+")


def _names_no_text(word: str) -> bool:
    """Whether a class name as a whole names a part that is no article text: ``cookie-notice``, but not ``content-header``."""
    pieces = {p.lower() for p in _PARTS.findall(word)}
    found = pieces & UNWANTED
    if not found or pieces - UNWANTED - NEUTRAL - OF_ARTICLE:
        return False
    return found != {"header"} or not pieces & OF_ARTICLE


def _unwanted(name: str, attributes: str, in_article: bool) -> bool:
    if name in SKIPPED:
        return name != "header" or not in_article  # an article's own header holds its headline
    if not attributes.strip() or name in ("html", "body"):
        return False
    for m in _ATTRIBUTE.finditer(attributes):
        which, value = m[1].lower(), (m[2] or "").strip("\"'")
        if which == "hidden" or which == "aria-hidden" and value.lower() == "true" or which == "style" and _NOT_SHOWN.search(value):
            return True
        if which in ("class", "id", "role") and name not in NOT_PARTS and any(map(_names_no_text, value.split())):
            return True
    return False


def page_lines(page: str) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """(lines with text, their characters outside links, whether in an article or main element, whether a heading)."""
    lines: list[str] = []
    own: list[int] = []
    inside: list[bool] = []
    headings: list[bool] = []
    buffer: list[str] = []
    linked: list[str] = []
    open_: list[tuple[str, bool, bool]] = []  # (name, unwanted, article) of open elements, outermost first
    skipping = article = link = heading = 0
    at, lower = 0, None

    def end_line() -> None:
        line = _SPACE.sub(" ", "".join(buffer)).strip()
        if line:
            lines.append(line)
            own.append(max(0, len(line) - len(_SPACE.sub(" ", "".join(linked)).strip())) if linked else len(line))
            inside.append(article > 0)
            headings.append(heading > 0)
        buffer.clear()
        linked.clear()

    def add(text: str) -> None:
        buffer.append(entities.unescape(text))
        if link:
            linked.append(buffer[-1])

    n = len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        stop = m.start() if m else n
        if stop > at and not skipping:
            add(page[at:stop])
        if not m:
            break
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if name in BLOCKS:
            end_line()
        if m[1]:
            place = next((i for i in range(len(open_) - 1, -1, -1) if open_[i][0] == name), None)
            if place is not None:
                for closed, bad, art in open_[place:]:
                    skipping -= bad
                    article -= art
                    link -= closed == "a"
                    heading -= closed in HEADINGS
                del open_[place:]
            continue
        if name in VOID or m[3].endswith("/"):
            continue
        if name in ("p", "a") and open_ and open_[-1][0] == name:
            open_.pop()
            link -= name == "a"
        bad, art = _unwanted(name, m[3], article > 0), name in ("article", "main")
        open_.append((name, bad, art))
        skipping += bad
        article += art
        link += name == "a"
        heading += name in HEADINGS
        if name in RAW:  # its content is no markup
            lower = lower if lower is not None else page.lower()
            close = lower.find(f"</{name}", at) if len(lower) == n else page.find(f"</{name}", at)
            if close < 0:
                close = n
            if not skipping and name != "title":
                add(page[at:close])
            at = close
    end_line()
    return lines, np.array(own, np.int64), np.array(inside, bool), np.array(headings, bool)


def window_sums(sizes: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """The sum of each window of ``width`` following lines that lies within them; one sum of all if they are fewer."""
    total = np.concatenate([[0], np.cumsum(sizes)])
    width = min(width, len(sizes))
    return total[width:] - total[:-width] if width else np.empty(0, np.int64)


def _covered(chosen: np.ndarray, n: int) -> np.ndarray:
    """Lines that a chosen window holds."""
    width = n - len(chosen) + 1
    return np.convolve(chosen, np.ones(width, np.int64))[:n] > 0


def marked_lines(sizes: np.ndarray) -> np.ndarray:
    """Lines of a marked element that are text: those in no window of links alone."""
    if not sizes.any():
        return np.zeros(len(sizes), bool)
    if len(sizes) < WIDTH:
        return np.ones(len(sizes), bool)
    return ~_covered(window_sums(sizes) == 0, len(sizes))


def unmarked_lines(lines: list[str], sizes: np.ndarray, headings: np.ndarray) -> np.ndarray:
    """Lines between the first surge and the last dive of a page without marks, or of what stands outside them."""
    if not sizes.any():
        return np.zeros(len(sizes), bool)
    sums = window_sums(sizes)
    least = SHARE * sums.max()
    short = np.array([size < least / WIDTH and not head and not line.endswith((".", "!", "?", "\u2026")) for line, size, head in zip(lines, sizes, headings)])
    short |= sizes == 0
    above = np.flatnonzero(_covered(sums >= least, len(sizes)) & ~short)
    first, last = (above[0], above[-1]) if len(above) else (len(sizes), -1)
    while 0 < first < len(sizes) and not short[first - 1]:
        first -= 1
    while 0 <= last < len(sizes) - 1 and not short[last + 1]:
        last += 1
    kept = np.zeros(len(sizes), bool)
    kept[first:last + 1] = marked_lines(sizes[first:last + 1])
    return kept


def main_text(page: str | None) -> str:
    """Blocks of the main text, joined by one space."""
    if not page:
        return ""
    lines, sizes, inside, headings = page_lines(page)
    kept, outside = np.zeros(len(lines), bool), np.flatnonzero(~inside)
    kept[inside] = marked_lines(sizes[inside])
    free = np.zeros(len(lines), bool)
    free[outside] = unmarked_lines([lines[i] for i in outside], sizes[outside], headings[outside])
    if sizes[free].sum() > OUTWEIGHS * sizes[kept].sum():
        kept = free
    return " ".join(line for line, keep in zip(lines, kept) if keep)


def extract(pages: DataFrame, html: str = "html", name: str = "text") -> DataFrame:
    """Replace the html column by the page's main text."""
    at = pages.columns.index(html)
    rest = [f for f in pages.schema.fields if f.name != html]
    schema = T.StructType([*rest, T.StructField(name, T.StringType(), False)])

    def batches(source):
        for batch in source:
            made = pa.array([main_text(x.as_py()) for x in batch.column(at)], pa.string())
            keep = [i for i in range(batch.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in keep], made], names=[*[batch.schema.names[i] for i in keep], name])

    return pages.mapInArrow(batches, schema)


def op4_main_text(pages: DataFrame) -> DataFrame:
    """One row per page: its main text and that text's length in code points."""
    found = extract(pages.select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
