"""The pipeline's stages, each on what the one before kept."""

import zlib
from collections import Counter

import numpy as np
from helpers import WORD, base_spans, counts, groups, make
from helpers import simhash as brute_simhash

import corpus_pipeline
from tallyloom.llm import decision_list, secrets, simhash
from tallyloom.llm.common import table


def stored(df, folder):
    df.write.parquet(str(folder))
    return df.sparkSession.read.parquet(str(folder))


def test_stages(spark, small, tmp_path):
    docs = table(spark, small, "documents")
    columns = docs.columns
    kept = stored(corpus_pipeline.quality_rules(spark, docs, small), tmp_path / "1")
    want = {r["doc_id"] for r in decision_list.op3_quality_rules(docs, table(spark, small, "labels")).filter("kept").collect()}
    assert kept.columns == columns and {r["doc_id"] for r in kept.collect()} == want
    unique = stored(corpus_pipeline.near_duplicates(spark, kept, small), tmp_path / "2")
    ids = {r["component_id"] for r in simhash.op6_simhash(kept).collect()}
    assert unique.columns == columns and {r["doc_id"] for r in unique.collect()} == ids
    clean = stored(corpus_pipeline.secret_scans(spark, unique, small), tmp_path / "3")
    assert clean.columns == columns and clean.count() == unique.count()
    assert secrets.op10_secret_scans(clean).filter("n_assign + n_access + n_hex > 0").count() == 0
    assert clean.filter("n_chars <> length(text)").count() == 0
    mixed = stored(corpus_pipeline.source_mix(spark, clean, small), tmp_path / "4")
    assert mixed.columns == columns
    packed = corpus_pipeline.best_fit_packing(spark, mixed, small)
    assert packed.filter("piece = 0").count() == mixed.count()


def test_run(spark, small):
    got = corpus_pipeline.run(spark, small)
    assert got.count() > 0 and "sequence_id" in got.columns
    assert [s[0] for s in corpus_pipeline.STAGES] == ["quality rules", "near duplicates", "secret scans", "source mix", "best-fit packing"]


def test_run_against_brute_force(spark, small):
    """Survivors by counting and comparing all pairs, pieces by the public tokenizer, copies by the mix's contract."""
    from public_tokenizers import path
    from tokenizers import Tokenizer

    docs = table(spark, small, "documents")
    texts = {r["doc_id"]: (r["text"] or "", r["source"]) for r in docs.collect()}
    listed = {r["doc_id"] for r in decision_list.op3_quality_rules(docs, table(spark, small, "labels")).filter("rule > 0").collect()}
    good = {}
    for k, (text, _) in texts.items():
        n, *_, repeated = counts(text)
        if n >= 10 and 100 * repeated <= 20 * n and k not in listed:
            good[k] = brute_simhash(text)
    first = groups(good)
    unique = docs.filter(docs["doc_id"].isin([k for k in good if first[k] == k]))
    clean = {r["doc_id"]: r["text"] for r in secrets.redact(unique, secrets.train(unique)).collect()}
    assert len(clean) == len(set(first.values())) < len(good) < len(texts) and not any(base_spans(t) for t in clean.values())
    encoder, pieces = Tokenizer.from_file(path("byte_bpe_50k.json")), {}
    for k, text in clean.items():
        ids = [*encoder.encode(text, add_special_tokens=False).ids, 2]
        starts = [0, *range(len(ids) % 1024 or 1024, len(ids), 1024)]
        pieces[k] = {(i, a, b - a, zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes())) for i, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)]))}
    got = corpus_pipeline.run(spark, small).collect()
    found = Counter((r["doc_id"], (r["piece"], r["start"], r["length"], r["ids_crc32"])) for r in got)
    copies = {k: found[k, piece] for k, of in pieces.items() for piece in of}
    assert set(copies.values()) <= {0, 1, 2} and found == Counter({(k, piece): copies[k] for k in pieces for piece in pieces[k] if copies[k]})
    sizes, taken, largest = Counter(), Counter(), Counter()
    for k, text in clean.items():
        n, source = len(WORD.findall(text)), texts[k][1]
        sizes[source] += n
        taken[source] += n * copies[k]
        largest[source] = max(largest[source], n)
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    free, left, aims = set(order), 1.5 * sizes.total(), {}
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 2 * sizes[s]} or set()
        aims |= {s: 2.0 * sizes[s] if s in over else level * weight[s] for s in (over or free)}
        left -= sum(2 * sizes[s] for s in over)
        free = free - over if over else set()
    assert all(abs(taken[s] - aims[s]) <= largest[s] + 1e-6 for s in order)
    used = Counter()
    for r in got:
        used[r["sequence_id"]] += r["length"]
    assert max(used.values()) <= 1024 and len(used) <= 1.05 * -(-sum(used.values()) // 1024) + 1


def test_stages_on_odd_rows(spark, small, tmp_path):
    for rows in (None, []):
        docs = make(spark, rows)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stored(stage(spark, docs, small), tmp_path / f"{rows is None} {name}")
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        assert corpus_pipeline.best_fit_packing(spark, docs, small).count() >= docs.count()
