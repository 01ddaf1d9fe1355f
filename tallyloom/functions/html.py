"""Article pieces from raw HTML, as regex expressions over the html column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions.text import REST, WHITESPACE, let, strip_space
from tallyloom.functions.urls import contains_any

_HIDDEN = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->"
_TAG = r"(?s)<[^>]*>"
_TAG_WITH_SPACE = rf"(?s)[{WHITESPACE}]*<[^>]*>[{WHITESPACE}]*"
_PARAGRAPH_START = r"(?i)<p(?:\s[^>]*)?>"
_PARAGRAPH_END = r"(?i)</p\s*>|</article\s*>"
_ARTICLE_START = r"(?i)<article(?:\s[^>]*)?>"
_ARTICLE_END = r"(?i)</article\s*>"
_HREF = r"""(?is)<a(?=\s)[^>]*?\shref\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
_VALUE = r"""("[^"]*"|'[^']*'|[^\s"'>]+)"""
_DATE_META = rf"""(?is)<meta(?=\s)(?=[^>]*?\sproperty\s*=\s*["']?article:published_time["'\s/>])[^>]*?\scontent\s*=\s*{_VALUE}"""
_DATE_TIME = rf"(?is)<time(?=\s)[^>]*?\sdatetime\s*=\s*{_VALUE}"
_QUOTES = r"""^["']|["']$"""
_ENTITY = r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"

# Named characters decoded in page text.
ENTITIES = {
    "amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": "\u00a0",
    "copy": "©", "reg": "®", "trade": "™", "middot": "·", "bull": "•",
    "hellip": "…", "ndash": "–", "mdash": "—", "lsquo": "‘", "rsquo": "’",
    "ldquo": "“", "rdquo": "”", "laquo": "«", "raquo": "»", "deg": "°",
    "euro": "€", "pound": "£", "yen": "¥", "cent": "¢", "sect": "§",
    "times": "×", "zwj": "\u200d", "zwnj": "\u200c", "shy": "\u00ad",
}


def visible_html(html: Column) -> Column:
    """Page without scripts, styles and comments."""
    return F.regexp_replace(html, _HIDDEN, "")


def decode_entities(c: Column) -> Column:
    """Named and numeric character references to characters, each once; unknown ones stay as they are."""
    table = F.create_map(*[F.lit(x) for pair in ENTITIES.items() for x in pair])

    def numeric(name: Column) -> Column:
        digits = F.when(F.lower(F.substring(name, 2, 1)) == "x",
                        F.conv(F.substring(name, F.lit(3), F.length(name)), 16, 10)
                        ).otherwise(F.substring(name, F.lit(2), F.length(name)))
        code = digits.try_cast("int")
        legal = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
        return F.decode(F.unhex(F.lpad(F.hex(F.when(legal, code).otherwise(F.lit(0xFFFD))), 8, "0")), "UTF-32")

    def decode(piece: Column) -> Column:
        def replaced(name: Column) -> Column:
            rest = F.substring(piece, F.length(name) + 2, F.length(piece))
            return (F.when(name == "", F.concat(F.lit("&"), piece))
                    .when(name.startswith("#"), F.concat(numeric(name), rest))
                    .otherwise(F.coalesce(F.concat(F.try_element_at(table, name), rest), F.concat(F.lit("&"), piece))))

        return let(F.regexp_extract(piece, _ENTITY, 1), replaced)

    def whole(text: Column) -> Column:
        decoded = let(F.split(text, "&"), lambda pieces: F.concat(
            F.get(pieces, F.lit(0)), F.array_join(F.transform(F.slice(pieces, 2, REST), decode), "")))
        return F.when(F.contains(text, F.lit("&")), decoded).otherwise(text)

    return let(c, whole)


def node_text(fragment: Column, strip: str = "none") -> Column:
    """Text of an HTML fragment.

    ``none`` keeps blanks, ``trim`` cuts the ends, ``nodes`` cuts both ends of every text piece
    between tags before gluing the pieces together.
    """
    if strip == "nodes":
        return strip_space(decode_entities(F.regexp_replace(fragment, _TAG_WITH_SPACE, "")))
    text = decode_entities(F.regexp_replace(fragment, _TAG, ""))
    return strip_space(text) if strip == "trim" else text


def first_tag(fragment: Column, tag: str, strip: str = "trim") -> Column:
    """Text of the first ``tag`` element, or null where there is none."""
    pattern = rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}\s*>"
    found = F.regexp_like(fragment, F.lit(pattern))
    return F.when(found, node_text(F.regexp_extract(fragment, pattern, 1), strip))


def page_title(html: Column, default: str | None = "No Title", strip: str = "trim") -> Column:
    """First ``h1``; ``default`` (or null) for pages without one."""
    title = let(visible_html(html), lambda page: first_tag(page, "h1", strip))
    return title if default is None else F.coalesce(title, F.lit(default))


def page_body(html: Column, min_len: int | None = None, measure: str = "raw", strip: str = "none") -> Column:
    """Paragraph texts joined by a blank.

    A paragraph runs from ``<p>`` to the next ``<p>``, ``</p>``, ``</article>`` or the end, so unclosed
    paragraphs never swallow each other. Paragraphs with ``min_len`` characters or fewer are left out,
    measured on the ``raw`` or the ``trimmed`` text.
    """
    pieces = F.split(visible_html(html), _PARAGRAPH_START)
    cut = F.transform(F.slice(pieces, 2, REST), lambda p: F.get(F.split(p, _PARAGRAPH_END, 2), F.lit(0)))
    if min_len is None:
        kept = F.transform(cut, lambda p: node_text(p, strip))
    else:
        size_of = "trim" if measure == "trimmed" else "none"
        both = F.transform(cut, lambda p: F.struct(
            node_text(p, strip).alias("text"), F.length(node_text(p, size_of)).alias("size")))
        kept = F.transform(F.filter(both, lambda s: s["size"] > min_len), lambda s: s["text"])
    return F.array_join(kept, " ")


def _target(value: Column) -> Column:
    """Link target of an attribute value, quoted or bare."""
    return decode_entities(F.regexp_replace(value, _QUOTES, ""))


def page_hrefs(html: Column, patterns=None) -> Column:
    """Distinct link targets in page order, those holding one of ``patterns`` if given."""
    hrefs = F.transform(F.regexp_extract_all(visible_html(html), F.lit(_HREF), F.lit(1)), _target)
    if patterns is not None:
        hrefs = F.filter(hrefs, lambda h: contains_any(h, patterns))
    return F.array_distinct(hrefs)


def claim_blocks(html: Column) -> Column:
    """One (title, link) struct per ``article`` block: first ``h2``, else ``h3``, and first link."""
    pieces = F.split(visible_html(html), _ARTICLE_START)
    blocks = F.transform(F.slice(pieces, 2, REST), lambda b: F.get(F.split(b, _ARTICLE_END, 2), F.lit(0)))

    def entry(block: Column) -> Column:
        heading = F.coalesce(first_tag(block, "h2", "nodes"), first_tag(block, "h3", "nodes"))
        link = F.when(F.regexp_like(block, F.lit(_HREF)), _target(F.regexp_extract(block, _HREF, 1)))
        return F.struct(heading.alias("title"), link.alias("link"))

    return F.transform(blocks, entry)


def publish_date(html: Column) -> Column:
    """Date text from an article meta tag, its attributes in any order, or from a ``time`` element, else null."""
    def attribute(pattern: str) -> Column:
        found = F.regexp_extract(html, pattern, 1)
        return F.nullif(F.regexp_replace(found, _QUOTES, ""), F.lit(""))

    return F.coalesce(attribute(_DATE_META), attribute(_DATE_TIME))
