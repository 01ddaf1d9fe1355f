"""Filter audit, ranked search and license scans against brute force on odd rows; the tables are compared to SQL in test_oracles."""

import math
import random
import re
from collections import Counter
from itertools import permutations

import pytest
from helpers import ROWS, WORD, make

from tallyloom.llm import filter_audit, license_join, term_pipeline

FILTERS = "ABCDE"
NAMES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def fails(text, copy):
    words = WORD.findall(text)
    found = "A" * (len(words) < 100) + "B" * (100 * len(set(words)) < 80 * len(words))
    found += "C" * (100 * len(re.findall("[A-Z]", text)) > 10 * len(text)) + "D" * bool(re.search("[#$%&*|]", text))
    return set(found + "E" * copy)


def audited(rows, labels):
    """{(part, order, step): counts} by applying the filters to the documents one after the other."""
    good, toxic = {i for i, q, _ in labels if q == 1} - {None}, {i for i, _, t in labels if t == 1} - {None}
    docs = []
    for i, text, lang, _ in rows:
        copy = i is not None and any(j is not None and j < i and (t or "") == (text or "") for j, t, *_ in rows)
        docs.append((i, lang or "", fails(text or "", copy)))
    out = {}
    for part in {d[1] for d in docs}:
        shapley = Counter()
        for order in permutations(FILTERS):
            left = [d for d in docs if d[1] == part]
            gone = []
            for step, f in enumerate(order, 1):
                removed, kept = [d for d in left if f in d[2]], [d for d in left if f not in d[2]]
                alone = sum(d[1] == part and d[2] == {f} for d in docs)
                out[part, "".join(order), step] = [len(kept), len(removed), sum(f in d[2] for d in gone), alone,
                                                   sum(d[0] in good for d in removed), sum(d[0] in toxic for d in removed)]
                shapley[f] += len(removed)
                left, gone = kept, gone + removed
        for order in permutations(FILTERS):
            for step, f in enumerate(order, 1):
                out[part, "".join(order), step].append(shapley[f])
    return out


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


ODD = [*ROWS, (None, "ABC def " * 60, "en", None), (None, "ABC def " * 60, "en", None), (17, "same id, other text | with words", "fr", "s"), (5, "a b c d e f g h i j k l", "en", "s1"),
       (40, " ".join(f"W{i}" for i in range(130)), "en", "s"), (41, " ".join(f"W{i}" for i in range(130)), None, "s")]


def test_audit_of_odd_rows(spark):
    labels = [(5, 1, 0), (5, 0, 1), (8, 1, 1), (10, None, 1), (41, 1, None), (None, 1, 1), (99, 1, 1)]
    got = filter_audit.op11_filter_audit(make(spark, ODD, extra=True), labels_of(spark, labels))
    found = {(r["part"], r["filter_order"], r["step"]): [r[n] for n in NAMES] for r in got.collect()}
    assert found == audited(ODD, labels) and len(found) == 600 * 3
    assert filter_audit.op11_filter_audit(make(spark, []), labels_of(spark, labels)).count() == 0
    without = filter_audit.op11_filter_audit(make(spark, ODD), labels_of(spark, [])).collect()
    assert all(r["good_lost"] == r["toxic_lost"] == 0 for r in without)


def test_audit_of_a_crowd_of_copies(spark):
    rows = [(i, "one text | that many rows share", "en", "s") for i in range(3000)] + [(3000 + i, f"own {i}", "de", "s") for i in range(50)]
    got = {(r["part"], r["filter_order"], r["step"]): r for r in filter_audit.op11_filter_audit(make(spark, rows), labels_of(spark, [])).collect()}
    assert got["en", "EABCD", 1]["removed"] == 2999 and got["en", "EABCD", 2]["removed"] == 1 and got["de", "EABCD", 1]["removed"] == 0
    assert got["en", "ADEBC", 2]["redundant"] == 3000


def terms(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def searched(rows, items, top=20):
    """Lists of (score, doc_id) of each item, best first, over plain counters."""
    bags = [(i, Counter(terms(t))) for i, t, *_ in rows]
    bags = [(i, b) for i, b in bags if b]
    n_docs, total = len(bags), sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for i, bag in bags:
            m = 75 + 25 * bag.total() * n_docs // total
            s = sum(int(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))) * (10 ** 9 * bag[t] // (1000 * bag[t] + 12 * m)) for t in terms(text) if bag[t])
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, rank, None if unnamed else i, -s) for rank, (s, unnamed, i) in enumerate(sorted(scores)[:top], 1)]
    return Counter(out)


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_search_of_odd_rows(spark):
    rows = [*ODD, (50, "\u00c9cole \u00c9COLE wide", "fr", "s"), *[(None, PASSAGE_OF[i % 3], "en", "s") for i in range(40)]]
    items = [(1, "several documents and this passage, this PASSAGE"), (1, "wide \u00c9cole"), (None, "more words w17 w18"), (3, None), (4, ""), (5, "unknownterm"),
             (6, "the zzz zzz one line of words"), (7, "same words")]
    frame = items_of(spark, items)
    got = Counter((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in term_pipeline.op12_ranked_search(make(spark, rows, extra=True), frame.selectExpr("*", "1 AS slot", "2 AS block", "3 AS term")).collect())
    assert got == searched(rows, items)
    assert term_pipeline.op12_ranked_search(make(spark, []), frame).count() == 0
    assert term_pipeline.op12_ranked_search(make(spark, rows), items_of(spark, [])).count() == 0


PASSAGE_OF = ["the same words in many rows", "the same words in several rows of text", "this passage again"]


@pytest.mark.parametrize("partitions", [1, 7])
def test_search_over_many_blocks_and_bundles(spark, partitions, monkeypatch):
    rng = random.Random(5)
    vocabulary = [f"t{i}" for i in range(400)]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 40))), "en", "s") for i in range(700)]
    items = [(i, " ".join(rng.choices(vocabulary, k=12))) for i in range(60)]
    monkeypatch.setattr(term_pipeline, "BUNDLE", 16)
    monkeypatch.setattr(term_pipeline, "BLOCK_BITS", 6)
    monkeypatch.setattr(term_pipeline, "BLOCK", 64)
    got = term_pipeline.op12_ranked_search(make(spark, rows).repartition(partitions), items_of(spark, items))
    assert Counter((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in got.collect()) == searched(rows, items)


def license_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def scanned(text):
    """The expected row for a text: all phrases by place, all templates against all blocks."""
    words, places, labels = license_words(text), [], set()
    for phrase, label in license_join.PHRASES:
        p = phrase.split()
        here = [i for i in range(len(words)) if words[i:i + len(p)] == p]
        places += here
        labels |= {label} if here else set()
    base, score = ",".join(sorted(labels)), 1.0 if places else 0.0
    for label, body in license_join.TEMPLATES:
        wanted = license_words(body)
        span = max(8, 1 << (len(wanted) - 1).bit_length())
        for start in range(0, max(len(words), 1), span):
            shared = len(set(wanted) & set(words[start:start + 2 * span]))
            if 10 * shared >= 9 * len(set(wanted)):
                labels.add(label)
                score = max(score, shared / len(set(wanted)))
    return len(words), len(places), min(places, default=None), max(places, default=None), base, ",".join(sorted(labels)), score


def test_licenses_of_odd_rows(spark):
    rng = random.Random(3)
    fill = [f"w{i}" for i in range(300)]
    texts = [None, "", " \n", "CC BY", "cc by cc by-nc 4.0", "cc  BY cc", "All rights reserved. all Rights\nReserved", "ccby accby cc", "x GNU General Public License", "license " * 5000]
    for _, body in license_join.TEMPLATES:
        words = body.split()
        for cut in (0, 1, len(words) // 9, len(words) // 3):
            kept = sorted(rng.sample(range(len(words)), len(words) - cut))
            before, after = rng.randrange(90), rng.randrange(90)
            texts.append(" ".join([*rng.choices(fill, k=before), *[words[i] for i in kept], *rng.choices(fill, k=after)]))
    rows = [(i if i % 5 else 5, t, "en", "s") for i, t in enumerate(texts)] + [(None, texts[4], "en", "s")] * 3 + [(2, texts[20], "en", "s")] * 2
    got = license_join.op13_license_scans(make(spark, rows, extra=True))
    want = Counter((i, *scanned(t)) for i, t, *_ in rows)
    assert Counter(tuple(r) for r in got.collect()) == want
    assert sum(bool(w[-2]) for w in want) > 30
    assert license_join.op13_license_scans(make(spark, [])).count() == 0


def test_license_blocks_with_own_templates(spark):
    text = "one two " + "alpha beta gamma delta epsilon zeta eta theta iota kappa " * 2
    docs = make(spark, [(1, text, "en", "s"), (2, "alpha beta", "en", "s"), (3, "none", "en", "s")])
    found = license_join.license_blocks(docs, templates=[("greek", "Alpha beta gamma delta epsilon zeta eta theta iota kappa"), ("none", "...")]).collect()
    assert {r["label"] for r in found} == {"greek"} and {r["first_word"] for r in found} == {0} and max(r["containment"] for r in found) == 1.0
    assert {r["name"].split("/")[0] for r in found} == {"1"}


def test_plans_are_native(spark):
    docs = make(spark)
    for df in (license_join.op13_license_scans(docs), filter_audit.op11_filter_audit(docs, labels_of(spark, []))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Arrow|Pandas|CartesianProduct|BroadcastNestedLoop", plan)
