"""Quality rules, main text, scores, SimHash groups, repeated strings, archives and packing."""

import base64
import hashlib
import json
import math
import random
import zlib
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pytest
from helpers import PASSAGE, ROWS, counts, groups, make, removed, simhash
from pyspark.sql import functions as F

from tallyloom.llm import backoff, bwt_dedup, decision_list, graph, line_blocks, packing, simhash as sh, warc
from tallyloom.llm.common import table

NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("source", ["rows", "table"])
def test_quality_counts(spark, small, source):
    df = make(spark, extra=True) if source == "rows" else table(spark, small, "documents")
    labels = labels_of(spark, []) if source == "rows" else table(spark, small, "labels")
    got = decision_list.op3_quality_rules(df, labels)
    for r in got.join(df.select("doc_id", "text"), "doc_id").collect():
        if len(r["text"] or "") < 20_000:
            want = counts(r["text"])
            assert tuple(r[n] for n in NAMES) == want
        failed = r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]
        assert r["base_failed"] == failed and r["kept"] == (not failed and r["rule"] == 0)
    assert got.count() == df.count()


def test_decision_list_learns_and_keeps_clean(spark):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron".split()
    rng = random.Random(1)
    text = lambda: " ".join(rng.choice(words) + str(rng.randrange(99)) for _ in range(60))
    rows = [(i, text(), None, None) for i in range(300)] + [(300 + i, text().upper() + " !!" * 9, None, None) for i in range(60)]
    rows += [(400 + i, " | ".join(text().split()[:40]), None, None) for i in range(60)]
    marks = labels_of(spark, [(i, int(i < 300), 0) for i in range(0, 460, 2)])
    df = make(spark, rows)
    got = {r["doc_id"]: r for r in decision_list.op3_quality_rules(df, marks).collect()}
    held_out = [i for i, *_ in rows if i % 2]
    right = sum(got[i]["kept"] == (i < 300) for i in held_out if not got[i]["base_failed"])
    assert right / len(held_out) > 0.95 and all(got[i]["kept"] for i in range(300))
    kept = decision_list.keep_good(df, marks)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == {i for i in got if got[i]["kept"]}
    assert decision_list.op3_quality_rules(make(spark, []), marks).count() == 0


def test_rules_do_not_depend_on_the_order_of_repeated_ids(spark):
    rng = random.Random(8)
    rows = [(i % 40, " ".join(rng.choice(("alpha", "BETA", "|", "delta#", "eps")) + str(rng.randrange(30)) for _ in range(rng.randrange(20, 90))), None, None) for i in range(400)]
    marks = labels_of(spark, [(i, int(i % 3 > 0), 0) for i in range(40)])
    learned = [decision_list.fit(make(spark, rows).orderBy(F.xxhash64("text", F.lit(i))).repartition(i + 1), marks) for i in range(3)]
    assert learned[0] == learned[1] == learned[2]


def test_quality_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    labels = table(spark, folder, "labels")
    got = (decision_list.op3_quality_rules(table(spark, folder, "documents"), labels.filter("doc_id % 3 > 0"))
           .join(labels.filter("doc_id % 3 = 0"), "doc_id").filter("not base_failed").collect())
    assert sum(r["kept"] == (r["quality"] == 1) for r in got) / len(got) > 0.9
    good = [r for r in got if r["quality"] == 1]
    assert sum(r["kept"] for r in good) / len(good) > 0.97


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="page has-sidebar"><header>Site</header>
<nav><ul><li><a href="/a">menu</a></li></ul></nav><div class="cookie-notice">We use cookies &amp; more</div><div class="ad">Buy now</div>
<article><h1>Big &amp; bold</h1><p>First <b>para</b>graph
 with&nbsp;space.<br>Next line<p>Second &lt;tag&gt; <a href="x">link</a>.</p><script>var t="</p>";</script><form><input>Send</form>
<!-- <p>hidden</p> --><ul><li>one</li><li>two</li></ul><p>x</p></article><aside>side</aside>
<section id="comments"><p>Reader says hi</p></section><footer>&copy; foot</footer></body></html>"""


def test_main_text():
    assert line_blocks.main_text(PAGE) == "Big & bold First paragraph with space. Next line Second <tag> link. one two x"
    assert line_blocks.main_text(None) == line_blocks.main_text("") == line_blocks.main_text("<nav>menu</nav>") == ""
    assert line_blocks.main_text("<article><p>unclosed <b>bold<p>next &am") == "unclosed bold next &am"
    plain = "<body><div>menu</div>" + "<p>" + "long words of a text without an article element " * 5 + "</p><p>short</p><p>" + "and more of the same " * 9 + "</p></body>"
    assert "short" in line_blocks.main_text(plain) and line_blocks.main_text(plain).endswith("of the same")
    assert line_blocks.main_text("<ARTICLE><P>Upper < case & co</P></ARTICLE>") == "Upper < case & co"


LONG = "A text without any marks that is long enough. " * 5
LINKS = "".join(f'<li><a href="{i}">link {i}</a></li>' for i in range(40))


@pytest.mark.parametrize("page, want", [
    (f"<body><div><p>{LONG * 3}</p><p>Yes.</p><p>{LONG * 3}</p></div><article><p>Teaser one</p></article></body>", f"{LONG * 3}Yes. {LONG * 3}".strip()),
    (f'<article><div class="content-header"><h1>Head line</h1></div><p>{LONG}</p></article>', f"Head line {LONG}".strip()),
    (f"<article><h1>Head</h1><p>{LONG}</p><ul>{LINKS}</ul></article>", f"Head {LONG}".strip()),
    (f"<body><div>Home</div><div>News</div><div>Sport</div><p>{LONG}</p><p>Yes.</p><p>{LONG}</p><div>Imprint</div><div>Contact</div></body>", f"{LONG}Yes. {LONG}".strip()),
    (f"<body><ul>{LINKS}</ul><h1>Head</h1><p>{LONG}</p><ul>{LINKS}</ul><p>{LONG}</p></body>", f"Head {LONG}{LONG}".strip()),
    ('<article><header><h1>Head</h1></header><p>One <a href="x">link</a></p><p><a href="y">Two</a></p><p>End</p></article>', "Head One link Two End"),
    ('<body><header>Site</header><article><div class="user-comments">no</div><div class="has-sidebar ads-free">yes</div><p hidden>no</p><p data-hidden="1">on</p></article>', "yes on"),
    ('<article><p class="notice">no</p><span class="share">in</span><div id="ad-300x250">no</div><section role="complementary">no</section><p>words</p></article>', "in words"),
    (f"<article><ul>{LINKS}</ul></article>", ""), ("<article></article><div>x", "x"), ("<p>" * 5000 + "deep", "deep"),
])
def test_main_text_by_surge_and_dive(page, want):
    assert line_blocks.main_text(page) == want


def test_window_sums():
    sizes = np.array([0, 5, 0, 0, 0, 7])
    assert line_blocks.window_sums(sizes).tolist() == [5, 5, 0, 7] and line_blocks.window_sums(sizes[:2]).tolist() == [5]
    assert line_blocks.marked_lines(sizes).tolist() == [True, True, False, False, False, True]
    assert line_blocks.window_sums(sizes[:0]).tolist() == []


class _Blocks(HTMLParser):
    """Text of a page of the table by a parser, without the parts that its markup names as no article; no look at ``article``."""

    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.out, self.off = [], 0
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        if self.off or tag in ("head", "nav", "footer", "script") or ("class", "ad") in attrs:
            self.off += tag not in ("meta", "br", "img", "link")
        self.out += [" "] * (tag in ("p", "h1", "br"))

    def handle_endtag(self, tag):
        self.off -= bool(self.off)
        self.out += [" "] * (tag in ("p", "h1"))

    def handle_data(self, data):
        self.out += [data] * (not self.off)


@pytest.mark.parametrize("element, least", [("article", 1.0), ("main", 1.0), ("div", 0.95)])
def test_main_text_equals_a_parsers(spark, element, least):
    pages = [r["html"] for r in table(spark, "/root/testdata/sf0.01", "pages").collect()]
    changed = [p.replace("<article>", f"<{element}>").replace("</article>", f"</{element}>") for p in pages]
    same = sum(line_blocks.main_text(c) == " ".join("".join(_Blocks(p).out).split()) for c, p in zip(changed, pages))
    assert same >= least * len(pages)


def test_main_text_of_odd_rows(spark):
    rows = [(1, "u", PAGE, 5), (1, "u", PAGE, 5), (None, None, None, 1), (2, "u", "", 2), (3, "u", "<article><p>" + "long " * 200_000 + "</p></article>", 3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int").withColumn("lines", F.lit(1)).withColumn("text", F.lit("old"))
    got = line_blocks.op4_main_text(pages).collect()
    assert sorted((r["page_id"] or 0, r["n_chars"]) for r in got) == [(0, 0), (1, 77), (1, 77), (2, 0), (3, 999_999)]
    kept = line_blocks.extract(pages.drop("text"))
    assert kept.columns == ["page_id", "url", "n_chars", "lines", "text"] and line_blocks.op4_main_text(pages.limit(0)).count() == 0


def test_main_text_of_pages(spark, small):
    pages = table(spark, small, "pages")
    got = line_blocks.op4_main_text(pages).join(pages.select("page_id", "html"), "page_id").collect()
    assert len(got) == pages.count()
    for r in got:
        assert r["n_chars"] == len(r["text"]) and r["text"] == " ".join(r["text"].split()) and "var t=" not in r["text"]
        body = r["html"].split("<article>")[1].split("</article>")[0]
        import html
        import re
        want = " ".join(html.unescape(re.sub(r"</?(?:b|a)\b[^>]*>", "", re.sub(r"</?(?:p|h1|br)\b[^>]*>", "\n", body))).split())
        assert r["text"] == want
    odd = spark.createDataFrame([(1, None, None), (2, "u", "")], "page_id long, url string, html string")
    assert [r["text"] for r in line_blocks.op4_main_text(odd).collect()] == ["", ""]


def test_backoff_scores(spark):
    df = make(spark, [(r[0], (r[1] or None) and r[1][:900], *r[2:]) for r in ROWS] + [(9, "before it " + PASSAGE, "en", None)])
    encode = packing.Encoder(packing.VOCABULARY)
    docs = [(r["doc_id"], np.frombuffer(encode(r["text"] or ""), "<u4").tolist()) for r in df.collect()]
    one, two = Counter(), Counter()
    for _, ids in docs:
        one.update(ids)
        two.update(zip(ids, ids[1:]))
    want = []
    for key, ids in docs:
        a, b = one - Counter(ids), two - Counter(zip(ids, ids[1:]))
        n = max(sum(a.values()), 1)
        alone = lambda w: math.log(a[w] / n) if a[w] else math.log(0.4 / n)
        total = (alone(ids[0]) if ids else 0.0) + sum(math.log(b[v, w] / max(a[v], 1)) if b[v, w] else math.log(0.4) + alone(w) for v, w in zip(ids, ids[1:]))
        want.append((key, len(ids), round(total, 6)))
    for block in (3, 2048):
        got = [(r["key"], r["n_tokens"], round(r["score_sum"], 6)) for r in backoff.score(df, block_docs=block).collect()]
        assert sorted(got) == sorted(want)
    assert backoff.op5_backoff_scores(make(spark, [])).count() == 0


@pytest.mark.parametrize("source", ["rows", "table"])
def test_simhash(spark, small, source):
    df = make(spark, extra=True) if source == "rows" else table(spark, small, "documents")
    fps = {r["doc_id"]: simhash(r["text"]) for r in df.collect()}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in sh.op6_simhash(df).collect()}
    want = groups(fps)
    assert got == {k: (f"{fps[k]:016x}", want[k]) for k in fps}


@pytest.mark.parametrize("crowd", [2, 8, 256])
def test_simhash_links_connect_what_is_near(spark, crowd):
    """With crowds of any size, the components are those of all pairs within four bits."""
    rng = random.Random(crowd)
    centres = [rng.getrandbits(64) for _ in range(12)]
    fps = {c for c in centres}
    for c in centres[:6]:
        for _ in range(30):
            x = c
            for b in rng.sample(range(64), rng.randint(1, 7)):
                x ^= 1 << b
            fps.add(x)
    fps = {sh._signed(x) for x in fps}
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    got = {r["node"]: r["root"] for r in graph.components(sh.links(df, crowd=crowd)).collect()}
    mask = (1 << 64) - 1
    want = groups({x: x & mask for x in fps})
    assert {x: got.get(x, x) for x in fps} == want


def test_thresholds_cover_every_pair(spark):
    rng = random.Random(3)
    fps = [rng.getrandbits(64) for _ in range(500)]
    bits = np.array([[x >> b & 1 for b in range(64)] for x in fps], dtype=float)
    for n in (500, 10 ** 7, 10 ** 10):
        parts = sh.allocation(bits.T @ bits * (n / 500), n)
        assert sum(t + 1 for _, t in parts) == 5
        for _ in range(300):
            x = sum(1 << b for b in rng.sample(range(64), 4))
            assert any((x & sum(1 << b for b in g)).bit_count() <= t for g, t in parts)


def test_components(spark):
    chain = [(i, i + 1) for i in range(300)] + [(1000, i) for i in range(1001, 1100)] + [(5000, 5000)]
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(301)}, **{i: 1000 for i in range(1000, 1100)}}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_keep_first(spark):
    rows = [(3, PASSAGE, None, None), (1, PASSAGE, None, None), (1, PASSAGE, None, None), (None, PASSAGE, None, None), (None, PASSAGE, None, None), (8, "other text entirely, with a few words", None, None)]
    kept = sh.keep_first(make(spark, rows, extra=True))
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "8"] and kept.columns == make(spark, rows, extra=True).columns
    assert sh.op6_simhash(make(spark, rows)).filter("component_id = 1").count() == 5
    assert sh.op6_simhash(make(spark, [])).count() == 0


def test_one_row_of_each_component_stays(spark):
    rng = random.Random(2)
    own = [" ".join(f"w{rng.randrange(5000)}" for _ in range(400)) for _ in range(4)]
    near = own[0].rsplit(" ", 1)[0] + " end"
    rows = [(5, own[1]), (5, own[2]), (5, near), (3, own[0]), (None, own[0] + " tail"), (None, own[3] + " a"), (None, own[3] + " b"), (3, own[0])]
    assert len({simhash(t) for _, t in rows}) > 5 and all((simhash(own[0]) ^ simhash(t)).bit_count() <= 4 for t in (near, own[0] + " tail"))
    kept = [(r["doc_id"], r["text"]) for r in sh.keep_first(make(spark, [(*r, "en", "web") for r in rows])).collect()]
    assert len(kept) == 4 and {(5, own[1]), (5, own[2]), (3, own[0])} < set(kept)
    assert [k for k, t in kept if t.startswith(own[3])] == [None]


def test_the_row_that_stays_is_the_same_in_any_order(spark):
    rows = [(1, PASSAGE, "en", f"s{i % 7}") for i in range(60)] + [(None, None, "en", "s"), (None, "", "en", "s"), (2, None, "en", "s")]
    docs = make(spark, rows, extra=True).withColumn("kept", F.lit(1)).withColumn("a.b", F.lit(2))
    got = {tuple(sorted((r["doc_id"], r["text"], r["source"]) for r in sh.keep_first(docs.orderBy(F.xxhash64("source", F.lit(i))).repartition(i + 1)).collect())) for i in range(3)}
    assert len(got) == 1 and [r[0] for r in got.pop()] == [1, 2]
    assert sh.keep_first(docs).columns == docs.columns and sh.keep_first(make(spark, [])).count() == 0


@pytest.mark.parametrize("source", ["rows", "table"])
def test_repeated_strings(spark, small, source):
    df = make(spark, extra=True) if source == "rows" else table(spark, small, "documents")
    docs = {r["doc_id"]: r["text"] for r in df.collect()}
    got = {r["doc_id"]: tuple(r)[1:] for r in bwt_dedup.op7_suffix_dedup(df).collect()}
    assert got == removed(docs)


def test_repeated_strings_edge_cases(spark, monkeypatch):
    rng = random.Random(5)
    letters = "".join(rng.choice("ab") for _ in range(400))
    rows = [(i, letters[a:a + n]) for i, (a, n) in enumerate([(0, 200), (100, 150), (50, 49), (50, 50), (51, 51), (300, 100), (0, 400)])]
    rows += [(20, "z" * 300), (21, "y" + "z" * 120 + "y"), (22, "\0" * 90), (23, "\0" * 60), (24, None), (25, "")]
    rows += [(30 + i, chr(97 + i) * 7 + PASSAGE + chr(98 + i) * 5) for i in range(12)]
    df = make(spark, [(i, t, None, None) for i, t in rows])
    got = {r["doc_id"]: tuple(r)[1:] for r in bwt_dedup.op7_suffix_dedup(df).collect()}
    assert got == removed(dict(rows))
    twice = make(spark, [(1, PASSAGE, None, None)] * 2 + [(None, PASSAGE, None, None), (2, PASSAGE, None, None)])
    gone = sorted((str(r["doc_id"]), r["n_removed"]) for r in bwt_dedup.op7_suffix_dedup(twice).collect())
    assert gone == [("1", 0), ("1", 0), ("2", len(PASSAGE)), ("None", 0)]
    assert bwt_dedup.op7_suffix_dedup(make(spark, [])).count() == 0


def test_suffix_order():
    text = np.frombuffer(b"banana\0ananas\0", dtype=np.uint8)
    order = bwt_dedup.suffix_order(text, np.array([0, 7]), np.array([6, 13]))
    whole = b"banana", b"ananas"
    got = [(whole[0] if p < 7 else whole[1])[p if p < 7 else p - 7:] for p in order]
    assert got == sorted(got) and len(got) == 14


def test_long_text_in_chunks(monkeypatch):
    rng = random.Random(9)
    data = bytes(rng.choice(b"abcdefgh ") for _ in range(bwt_dedup.CHUNK + 5000))
    h, first, last = bwt_dedup.anchor_runs(data)
    assert first[0] == 0 and last[-1] == len(data) - 50 and (first[1:] == last[:-1] + 1).all()
    part = bwt_dedup.anchor_runs(data[bwt_dedup.CHUNK - 300:bwt_dedup.CHUNK + 300])
    assert set(part[0].tolist()) <= set(h.tolist())


@pytest.mark.parametrize("records,roll", [(4096, 32 << 20), (7, 2000)])
def test_archives(spark, small, tmp_path, records, roll):
    rows = [(1, "http://a/1", "<p>same</p>"), (2, None, "<p>same</p>"), (3, "u", None), (4, "u\r\n", ""), (5, "u", "é\r\n\r\n你"), (5, "u", "é\r\n\r\n你"), (None, "u", "<p>same</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").unionByName(table(spark, small, "pages").withColumn("page_id", F.col("page_id") + 100))
    folder = warc.write_archives(df, str(tmp_path / "a"), records=records, roll=roll)
    got = warc.read_archives(spark, folder).collect()
    first = {}
    for r in df.collect():
        body = (r["html"] or "").encode()
        if r["page_id"] is not None:
            first[body] = min(first.get(body, 1 << 60), r["page_id"])
    digests = {base64.b32encode(hashlib.sha1(b).digest()).decode(): (len(b), k) for b, k in first.items()}
    assert len(got) == df.count()
    for r in got:
        assert (r["payload_bytes"], r["refers_to"] if r["record_type"] == "revisit" else r["page_id"]) == digests[r["payload_digest"]]
    assert Counter(r["record_type"] for r in got)["response"] == len(first)
    texts = {r["page_id"]: r["html"] for r in got if r["record_type"] == "response"}
    assert texts[5] == "é\r\n\r\n你" and texts[3] == ""
    again = warc.write_archives(df.repartition(5), str(tmp_path / "b"), records=records, roll=roll)
    read = lambda f: sorted(json.dumps(r.asDict()) for r in spark.read.json(f"{f}/manifest").collect())
    assert read(folder) == read(again) and (records > 100 or len(read(folder)) > 8)


def test_archives_of_no_pages(spark, tmp_path):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archives(spark, warc.write_archives(none, str(tmp_path / "c"))).count() == 0


@pytest.mark.parametrize("source", ["rows", "table"])
def test_packing(spark, small, source):
    df = make(spark, extra=True) if source == "rows" else table(spark, small, "documents")
    from public_tokenizers import path
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path("byte_bpe_50k.json"))  # as the contract loads it
    want = {}
    for r in df.collect():
        ids = [*whole.encode(r["text"] or "", add_special_tokens=False).ids, 2]
        at, size, k = 0, len(ids) % 1024 or 1024, 0
        while at < len(ids):
            part = np.array(ids[at:at + size], dtype="<u4").tobytes()
            want[r["doc_id"], k] = (at, len(part) // 4, zlib.crc32(part))
            at, size, k = at + size, 1024, k + 1
    got = packing.op9_packing(df).collect()
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in got} == want
    check_places(got)


def check_places(got):
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    least = -(-sum(r["length"] for r in got) // 1024)
    assert len(by) <= 1.05 * least + 1


def test_packing_repeated_rows_and_white_space(spark):
    odd = ["a  b", "a \n b", " \n\n  x y", "a  b  ", "  ", "don't  we'll\t x", "你 好 \U0001F600", "a   b c", "12 345  6\n\n7 ", "<|endoftext|> x"]
    encode = packing.Encoder(packing.VOCABULARY)
    from public_tokenizers import path
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path("byte_bpe_50k.json"))
    whole.encode_special_tokens = True
    for t in odd:
        assert np.frombuffer(encode(t), "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids, t
    got = packing.op9_packing(make(spark, [(1, "one two three", None, None)] * 500 + [(None, None, None, None)])).collect()
    assert len(got) == 501
    check_places(got)
    assert packing.op9_packing(make(spark, [])).count() == 0


def test_packing_has_the_ids_of_added_tokens(spark):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path("byte_bpe_50k.json"))  # as loaded
    end = "<|endoftext|>"
    texts = [f"a {end} b", end, end * 3, f"x  {end}  y  {end}\n", f"{end}word  z", f"a <|endoftext|b {end}>", "plain  text", f" {end} "]
    got = packing.op9_packing(make(spark, [(i, t, "en", "s1") for i, t in enumerate(texts)])).collect()
    want = {}
    for i, t in enumerate(texts):
        ids = [*whole.encode(t, add_special_tokens=False).ids, 2]
        want[i] = (len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
    assert whole.encode(texts[0], add_special_tokens=False).ids == [64, 220, 50256, 275]
    assert {r["doc_id"]: (r["length"], r["ids_crc32"]) for r in got} == want


def test_plan_places_every_piece():
    for seed in range(8):
        rng = random.Random(seed)
        have = Counter(min(1024, max(1, int(rng.lognormvariate(5, 1.3)))) for _ in range(rng.choice([1, 5, 400, 5000])))
        made = packing.plan(dict(have))
        used = Counter()
        for lengths, times in made:
            assert sum(lengths) <= 1024 and times > 0
            for n in lengths:
                used[n] += times
        assert used == have


def test_archives_lie_in_the_file_system_that_spark_names(spark, tmp_path):
    assert warc.qualified(spark, str(tmp_path)) == f"file:{tmp_path}" and warc.qualified(spark, f"file://{tmp_path}") in (f"file:{tmp_path}", f"file://{tmp_path}")
    assert warc.store_address("s3a://bucket/a/b") == ("s3", "s3://bucket/a/b") and warc.store_address("hdfs://name:8020/a") == ("hdfs", "hdfs://name:8020/a")
    assert warc.store_address("file:/a/b") == warc.store_address("file:///a/b") == ("file", "/a/b")
    with pytest.raises(ValueError):
        warc.store_address("/a/b")


def test_token_ids_beyond_two_bytes_are_refused():
    assert backoff._two_bytes(np.array([0, 65_535], "<u4")) == b"\0\0\xff\xff"
    with pytest.raises(ValueError):
        backoff._two_bytes(np.array([65_536], "<u4"))
