"""Texts of few words, clashing columns, repeated ids, and rows that differ in other columns only."""

import random

import numpy as np
import pytest

from pyspark.sql import functions as F

import corpus_pipeline
from pairtrace.llm import decontam, labelled, line_dedup, quality, simhash, topk


def hits(doc, items, window=10):
    """(words hit, items with occurring windows) by looking each window up."""
    hit, named = set(), set()
    for i, words in items.items():
        for s in range(max(1, len(words) - window + 1)) if words else ():
            w = words[s : s + window]
            for p in range(len(doc) - len(w) + 1):
                if doc[p : p + len(w)] == w:
                    hit.update(range(p, p + len(w)))
                    named.add(str(i))
    return len(hit), sorted(named)


@pytest.mark.parametrize("most", [decontam.CROWDED, 0])
def test_texts_of_few_words(spark, monkeypatch, most):
    """Postings times segments would be many; with ``most`` 0 every text goes by its windows."""
    kept = decontam.crowded_texts
    monkeypatch.setattr(decontam, "crowded_texts", lambda index, anchors, _: kept(index, anchors, most))
    rnd = random.Random(4)
    prose = lambda n, words="a b c": [rnd.choice(words.split()) for _ in range(n)]
    items = {1: prose(120), 2: prose(90), 3: ["a"] * 40, 4: prose(4), 5: prose(25, "d e f g h i j"), 6: ["zz"], 7: []}
    docs = {1: prose(700), 2: ["a"] * 300, 3: prose(30, "d e f g") + items[5] + prose(9), 4: ["c", "b"], 5: [], 6: prose(50, "x y") + items[5][3:15]}
    frame = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()] + [(1, " ".join(docs[1]))], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string")
    got = {r.doc_id: (r.n_hit, r["items"]) for r in decontam.find_benchmark_text(frame, bench).collect()}
    assert got == {i: hits(w, items) for i, w in docs.items()}


def test_line_dedup_keeps_columns_of_any_name(spark):
    names = ["__host", "__bad", "__any", "__kept", "host", "row", "bad", "of", "salt", "kept", "n_lines"]
    schema = "doc_id long, source string, text string, " + ", ".join(f"`{c}` string" for c in names)
    docs = spark.createDataFrame([(i, "s", f"own {i}\nmenu", *names) for i in range(10)], schema)
    got = line_dedup.drop_boilerplate(docs)
    assert got.columns == ["doc_id", "source", "text", *names[:-1], "n_lines", "n_dropped"]
    assert all(r.text == f"own {r.doc_id}" and [r[c] for c in names[:-1]] == names[:-1] and (r.n_lines, r.n_dropped) == (2, 1) for r in got.collect())


def test_fits_do_not_depend_on_partitions_where_ids_repeat(spark):
    rnd = random.Random(1)
    rows = [(i % 60, " ".join(rnd.choice(("good", "bad!", "so", "text", "x")) for _ in range(rnd.randrange(1, 30)))) for i in range(180)] + [(5, None)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    picked = spark.createDataFrame([(5, 1), (7, 0)], "id long, label int")
    assert {r.id: r.text for r in labelled.join_texts(docs, picked, "text").collect()} == {i: min(t for n, t in rows if n == i and t is not None) for i in (5, 7)}
    one, two = (quality.train(docs.repartition(n), labels) for n in (1, 5))
    assert all(np.array_equal(a, b) for a, b in zip(one.value, two.value, strict=True))


def test_near_stage_keeps_the_least_of_rows_that_share_id_and_text(spark):
    text = "one two three four five six seven"
    rows = [(1, text, "fr", "s2", 3), (1, text, "en", "s9", 3), (1, text, "en", "s1", 3), (2, "other", "en", "s1", 5), (None, "alone here", "en", "s1", 5)]
    for parts in (1, 4):
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").repartition(parts)
        got = sorted(map(tuple, corpus_pipeline.near_stage(spark, docs, "").collect()), key=str)
        assert got == sorted([(1, text, "en", "s1", 3), *rows[3:]], key=str)


def test_fingerprint_shards_pass_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(simhash, "MEMBERS", 3)
    rnd = random.Random(2)
    values = {rnd.getrandbits(64) for _ in range(40)}
    values |= {v ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) for v in list(values)[:25]}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    links = {tuple(sorted((r.a & (1 << 64) - 1, r.b & (1 << 64) - 1))) for r in simhash.fingerprint_links(spark.createDataFrame([(v,) for v in signed], "fp long"), most=5).collect()}
    assert links and links <= {(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= 8}
    near = {(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= 4}
    group = {v: v for v in values}
    for a, b in links:
        low, high = sorted((group[a], group[b]))
        group = {v: low if g == high else g for v, g in group.items()}
    assert all(group[a] == group[b] for a, b in near)


def test_query_blocks_held_while_shards_stream_by(spark, monkeypatch):
    """Small tiles, several lanes and several blocks a lane give the products of all with all."""
    for name, value in (("TILE_ROWS", 7), ("QUERY_ROWS", 5), ("HELD_BYTES", 300)):
        monkeypatch.setattr(topk, name, value)
    rng = np.random.default_rng(5)
    body = {i: rng.integers(-3, 4, 4 if i % 10 else 3) / 2 for i in range(120)}
    df = spark.createDataFrame([(i, v.tolist()) for i, v in body.items()], "vec_id long, embedding array<double>").repartition(3)
    got = sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 3 == 0).collect()))
    whole = {i: np.floor(256 * v) for i, v in body.items()}
    want = []
    for q in range(0, 120, 3):
        best = sorted((-int(whole[q] @ v), i) for i, v in whole.items() if i != q and v.size == whole[q].size)[:5]
        want += [(q, rank, i, -s) for rank, (s, i) in enumerate(best, 1)]
    assert got == want
