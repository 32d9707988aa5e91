"""Operators against brute force, round trips and edge cases on small tables."""

import base64
import datetime
import hashlib
import random
import re
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
import xxhash
from pyspark.sql import functions as F

from pairtrace.llm import rows as llm_rows
from pairtrace.llm import bpe, decontam, line_dedup, pii, quality, sharding, simhash, suffix_dedup, topk, toxicity

KEY = "a key for tests only"
WORDS = [a + b for a in ("the", "an", "ing", "ré", "ß", "on", "ti") for b in ("re", "lo", "wh", "ñ", "st", "ou")]


def texts(seed, n):
    rnd = random.Random(seed)
    prose = lambda k: " ".join(rnd.choice(WORDS) for _ in range(k))
    out = [prose(rnd.randrange(1, 120)) for _ in range(n)]
    passage = prose(60)
    return out + [None, "", "   ", "\n", passage, prose(5) + passage + prose(9), passage * 3, out[0], prose(4000), "don't   stop 12345 é\t\n\n x"]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", "s%d" % (i % 3)) for i, t in enumerate(rows)], "doc_id long, text string, id string, source string").repartition(3)


def test_bpe_round_trip(spark):
    rows = texts(1, 40) + ["aaaaaaaaaaaaaaaaaa", "naïve façade 中文字符 🙂🙂"]
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in bpe.encode_decode(frame(spark, rows), path, public_tokenizers.PATTERN).collect():
        text = rows[r.doc_id] or ""
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode_ordinary(text)
        assert bytes(r.decoded) == text.encode() and r.n_tokens == len(r.ids) // 4


def test_bpe_in_small_pieces_that_forget(spark, monkeypatch):
    """Pieces, repeated and null ids, clashing columns, no rows."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    monkeypatch.setattr(bpe, "CORPUS_CHARS", 300)
    monkeypatch.setattr(bpe, "KNOWN_WORDS", 50)
    table, split = bpe.Merges(open(path, "rb").read()), regex.compile(public_tokenizers.PATTERN)
    rows = texts(8, 30)
    for lo, hi in bpe.pieces(pa.array(rows, pa.string())):
        for text, ids in zip(rows[lo:hi], table.encode(rows[lo:hi], split), strict=True):
            assert ids.tolist() == library.encode_ordinary(text or "")
    docs = spark.createDataFrame([(None, "a b", 1), (3, "a b", 2), (3, "a b", 2), (3, None, 1)], "doc_id long, text string, ids int")
    got = sorted((r.doc_id or 0, r.n_tokens) for r in bpe.token_digests(docs, path, public_tokenizers.PATTERN).collect())
    assert got == [(0, 2), (3, 0), (3, 2), (3, 2)]
    assert bpe.token_digests(docs.limit(0), path, public_tokenizers.PATTERN).count() == 0


def test_tables_are_whole_groups():
    rnd = random.Random(4)
    keys = sorted(rnd.randrange(12) for _ in range(80))
    for least in (1, 5, 200):
        cuts = sorted(rnd.sample(range(81), 6))
        stream = [pa.RecordBatch.from_pydict({"k": keys[a:b], "v": list(range(a, b))}) for a, b in zip([0, *cuts], [*cuts, 80], strict=True) if a < b]
        got = list(llm_rows.tables(stream, "k", least=least))
        assert [v for t in got for v in t.column("v").to_pylist()] == list(range(80))
        groups = [set(t.column("k").to_pylist()) for t in got]
        assert sum(map(len, groups)) == len(set(keys)) and all(t.num_rows >= least for t in got[:-1])


def test_levels_settle_the_later_of_equal_reaches():
    """Batches in any order against a dictionary; levels stay in byte order without a reach twice."""
    rnd = np.random.default_rng(3)
    rows = np.zeros(3_000, suffix_dedup.SUFFIX)
    rows["key"] = [b"k%02d" % k for k in rnd.integers(0, 99, rows.size)]
    rows["id"], rows["pos"] = rnd.integers(0, 500, rows.size), np.arange(rows.size)
    family = suffix_dedup.LevelFamily()
    for part in np.array_split(rows, 40):
        family.add(part)
        assert all((np.sort(x["key"]) == x["key"]).all() for x in family.levels.values())
    kept, later = family.close(), family.settled()
    first = {}
    for r in rows:
        first[r["key"]] = min(first.get(r["key"], (1 << 60, 0)), (int(r["id"]), int(r["pos"])))
    assert sorted((int(r["id"]), int(r["pos"])) for r in kept) == sorted(first.values())
    assert len(kept) + len(later) == len(rows) and len(np.unique(np.concatenate((kept["pos"], later["pos"])))) == len(rows)


def test_edge_strings_are_compared_byte_by_byte(monkeypatch):
    """With hashes that all clash the extents are the same."""
    rnd = np.random.default_rng(7)
    window = rnd.integers(97, 99, (40, 168)).astype(np.uint8)
    window[:, 60:120] = window[0, 60:120]
    window[20:30, 30:140] = window[5, 30:140]
    left, right = rnd.integers(0, 69, 40), rnd.integers(0, 69, 40)
    want, seen = set(), set()
    for x in range(69):
        for i in range(40):
            if left[i] >= x and right[i] >= 68 - x:
                s = (x, window[i, 68 - x : 168 - x].tobytes())
                if s in seen:
                    want.add((i, x))
                seen.add(s)
    assert want and set(suffix_dedup.edge_intervals(window, left, right, range(69))) == want
    monkeypatch.setattr(suffix_dedup, "_mix", lambda x, n: x * np.uint64(0))
    assert set(suffix_dedup.edge_intervals(window, left, right, range(69))) == want


@pytest.mark.parametrize("least", [20_000, 1])
def test_suffix_dedup_equals_brute_force(spark, monkeypatch, least):
    monkeypatch.setattr(suffix_dedup, "MATCH_ROWS", least)
    monkeypatch.setattr(suffix_dedup, "BATCH_ROWS", least)
    rows = texts(2, 40)
    seen, raw = {}, [(t or "").encode() for t in rows]
    for i, b in enumerate(raw):
        for s in range(len(b) - 99):
            seen.setdefault(b[s : s + 100], (i, s))
    for r in suffix_dedup.remove_repeats(frame(spark, rows)).collect():
        b = raw[r.doc_id]
        gone = np.zeros(len(b) + 1, bool)
        for s in range(len(b) - 99):
            if seen[b[s : s + 100]] < (r.doc_id, s):
                gone[s : s + 100] = True
        kept = bytes(x for x, g in zip(b, gone, strict=False) if not g)
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len(b), int(gone.sum()), int((gone[1:] < gone[:-1]).sum()))
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_suffix_dedup_keeps_a_copy_of_repeated_rows(spark):
    rnd = random.Random(12)
    hexes = lambda n: "".join(rnd.choice("0123456789abcdef") for _ in range(n))
    one, other, shared = hexes(150), hexes(400), hexes(130)
    edge = "p" + shared + "q" + hexes(60)
    rows = [(1, one), (1, one), (None, other), (None, other), (2, one), (3, edge), (3, edge), (4, "r" + shared + "s" + hexes(80))]
    # Texts under one id: every second one repeats its own first half.
    many = [hexes(120) for _ in range(2000)]
    rows += [(9, t * (1 + i % 2)) for i, t in enumerate(many)]
    want = sorted([(1, 150, 0)] * 2 + [(0, 400, 0)] * 2 + [(2, 150, 150)] + [(3, len(edge), 0)] * 2 + [(4, 212, 130)] + [(9, 120 * (1 + i % 2), 120 * (i % 2)) for i in range(2000)])
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "doc_id long, text string, id int, twin string, spot int").repartition(3)
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in suffix_dedup.remove_repeats(docs).collect()) == want
    assert suffix_dedup.remove_repeats(docs.limit(0)).count() == 0


def test_suffix_dedup_of_ids_that_repeat_and_are_null(spark):
    """Texts under one id, half of them also under a null id, which is the least."""
    rnd = random.Random(44)
    many = ["".join(rnd.choice("0123456789abcdef") for _ in range(110)) for _ in range(3_000)]
    docs = spark.createDataFrame([(7, t) for t in many] + [(None, t) for t in many[:1_500]], "doc_id long, text string").repartition(4)
    got = suffix_dedup.remove_repeats(docs).filter("n_removed > 0").collect()
    assert len(got) == 1_500 and all(r.doc_id == 7 and r.n_removed == 110 for r in got)


def test_simhash_equals_brute_force(spark):
    rows = texts(3, 30)
    rnd = random.Random(5)
    long = [rnd.choice(WORDS) for _ in range(900)]
    for i in range(12):
        rows.append(" ".join(long[:i] + ["edit%d" % i] + long[i + 1 :]))
    found = simhash.near_duplicates(frame(spark, rows)).collect()
    fp = {i: simhash.fingerprint(t) for i, t in enumerate(rows)}
    up = list(range(len(rows)))
    for _ in rows:
        for a in up[:]:
            for b in range(len(rows)):
                if (fp[a] ^ fp[b]).bit_count() <= 4:
                    up[b] = up[a] = min(up[a], up[b])
    up = [up[up[i]] for i in range(len(up))]
    assert len(found) == len(rows)
    assert all(r.fp & (2**64 - 1) == fp[r.doc_id] and r.component_id == up[r.doc_id] for r in found)


def similar_components(rows, shingle=5, similarity=0.8):
    """Least reachable index of every text, by comparing all pairs."""
    words = [(t or "").encode().lower().split() for t in rows]
    sets = [{tuple(w[i : i + shingle]) for i in range(max(1, len(w) - shingle + 1))} for w in words]
    up = list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both >= similarity * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((top(a), top(b)))
                up[y] = x
    return [top(i) for i in range(len(rows))]


def test_similar_documents_equal_brute_force(spark):
    rnd = random.Random(8)
    rows = texts(4, 30) + ["same  words", "Same words", "same words\n"]
    base = [rnd.choice(WORDS) + str(rnd.randrange(50)) for _ in range(400)]
    for edits in [0, 1, 1, 2, 3, 5, 7, 8, 9, 10, 12, 16, 20, 40] * 4:
        copy = list(base)
        for at in rnd.sample(range(400), edits):
            copy[at] = "edit%d" % rnd.randrange(10**6)
        rows.append(" ".join(copy))
    want = similar_components(rows)
    # Shards over ``most`` are dealt to several trees, and what these leave apart is settled in blocks; the groups stay the same.
    for most, links, block in ((500, 2, 1_000), (10, 1, 10)):
        found = simhash.similar_documents(frame(spark, rows), most=most, links=links, block=block).collect()
        assert len(found) == len(rows) and {r.doc_id: r.component_id for r in found} == dict(enumerate(want))


def test_similar_documents_with_different_repeated_lines(spark):
    rnd = random.Random(13)
    word = lambda: rnd.choice(WORDS) + str(rnd.randrange(10**6))
    rows = []
    for times in [(10, 10)] * 20 + [(40, 1)] * 20:
        body = [word() for _ in range(200)]
        for n in times:
            rows.append(" ".join(body + [word() for _ in range(8 if times[1] > 1 or n > 1 else 0)] * n))
    want = similar_components(rows)
    assert len(set(want)) == 40
    assert {r.doc_id: r.component_id for r in simhash.similar_documents(frame(spark, rows)).collect()} == dict(enumerate(want))


def test_similar_documents_without_rows_or_ids(spark):
    empty = frame(spark, ["x"]).filter("doc_id < 0")
    assert simhash.similar_documents(empty).count() == 0
    rows = spark.createDataFrame([(None, "a b"), (3, "a b"), (3, "c d"), (4, "c d"), (5, None)], "doc_id long, text string")
    found = {(r.doc_id, r.component_id) for r in simhash.similar_documents(rows).collect()}
    assert found == {(None, None), (3, None), (3, 3), (4, 3), (5, 5)}


def test_tree_pairs_are_few_and_span():
    rng = np.random.default_rng(2)
    same = rng.integers(0, 1 << 16, simhash.BANDS * simhash.ROWS).astype(np.uint16)
    pairs = simhash.similar_links([7] * 60, np.stack([same] * 60), links=2)
    assert len(pairs) == 1 + 2 * 58
    sets = simhash.Groups(list(range(60)))
    assert sum(sets.join(i, j) for i, j in pairs) == 59


def test_settled_links_span_what_trees_leave(spark):
    """A group that straddles the similarity, in shards cut to small trees and blocks, against all pairs."""
    rnd = random.Random(21)
    base = [rnd.choice(WORDS) + str(rnd.randrange(50)) for _ in range(150)]
    rows = []
    for n in range(90):
        copy = list(base)
        for at in rnd.sample(range(150), n % 9):
            copy[at] = "edit%d" % rnd.randrange(10**6)
        rows.append(" ".join(copy))
    want = dict(enumerate(similar_components(rows)))
    assert 3 < len(set(want.values())) < 80
    for most, links, block in ((500, 2, 1_000), (4, 1, 7), (2, 1, 1)):
        found = simhash.similar_documents(frame(spark, rows), most=most, links=links, block=block).collect()
        assert {r.doc_id: r.component_id for r in found} == want
    # All asking rows against all answering ones, without any link known.
    hashes = [np.unique(simhash.shingle_hashes(simhash.split_words(r), 5)) for r in rows]
    bands = np.zeros((len(rows), simhash.BANDS), np.int64)
    all_rows = np.ones(len(rows), bool)
    links = simhash.settled_links(hashes, list(range(len(rows))), bands, 0, all_rows, all_rows, np.arange(len(rows)), 0.8)
    sets = simhash.Groups(list(range(len(rows))))
    assert all(sets.join(i, j) for i, j in links) and [sets.top(i) for i in range(len(rows))] == list(want.values())
    assert simhash.settled_links(hashes, list(range(len(rows))), bands, 1, all_rows, all_rows, np.arange(len(rows)), 0.8) == []


def test_similar_documents_of_the_smallest_table_equal_an_exact_join(spark):
    """Recall on whole prose, measured against a count of shared shingles over all pairs that share one."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    sets = {r.doc_id: set(simhash.shingle_hashes(simhash.split_words(r.text), 5).tolist()) for r in rows}
    holders, up = {}, {i: i for i in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in sorted(sets):
        shared = {}
        for g in sets[i]:
            for j in holders.setdefault(g, []):
                shared[j] = shared.get(j, 0) + 1
            holders[g].append(i)
        for j, n in shared.items():
            if n >= 0.8 * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((top(i), top(j)))
                up[b] = a
    none = min((i for i in sets if not sets[i]), default=None)
    want = {i: top(i) if sets[i] else none for i in sets}
    assert len(set(want.values())) < len(rows)
    assert {r.doc_id: r.component_id for r in simhash.similar_documents(docs).collect()} == want


def test_topk_ties_and_bad_vectors(spark):
    rnd = np.random.default_rng(1)
    vectors = [(i, rnd.normal(size=8).tolist()) for i in range(300)] + [(i, [1.0] * 8) for i in range(300, 360)]
    bad = [(1000, None), (1050, [float("nan")] * 8), (1100, [None] * 8), (1150, [float("inf")] * 8), (1200, []), (1250, [1.0])]
    df = spark.createDataFrame(vectors + bad, "vec_id long, embedding array<float>").repartition(4)
    got = {}
    for r in topk.top_k(df, F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    ints = {i: np.floor(256.0 * np.array(v, np.float32).astype(np.float64)).astype(int) for i, v in vectors}
    assert set(got) == {i for i in ints if i % 50 == 0}
    for q, rows in got.items():
        best = sorted((-int(ints[q] @ v), i) for i, v in ints.items() if i != q)[:5]
        assert sorted(rows) == [(n, i, -s) for n, (s, i) in enumerate(best, 1)]


def test_topk_repeated_rows_and_clashing_columns(spark):
    rows = [(50, [1.0, 0.0])] * 2 + [(50, [2.0, 0.0])] + [(i, [float(i), 1.0]) for i in range(1, 8)] + [(7, [7.0, 1.0])] * 3
    df = spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], "vec_id long, embedding array<float>, rank int, tile int, id int").repartition(4)
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(df, F.col("vec_id") % 50 == 0).collect())
    assert got == [(50, n, 8 - n, 65536 * (8 - n)) for n in range(1, 6)]
    assert topk.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_topk_products_beyond_doubles(spark):
    one, two = np.array([[2.0**27, 1.0]]), np.array([[2.0**27, 1.0], [2.0**27, 0.0], [-(2.0**100), 3.0]])
    want = [[2**54 + 1, 2**54, -(2**127) + 3]]
    assert topk.exact_products(one, two).tolist() == want
    rows, cols, scores = topk.best_of(one, np.array([9]), two, np.array([1, 2, 3]), 2)
    assert sorted(zip(scores.tolist(), cols.tolist())) == [(2**54, 1), (2**54 + 1, 0)]
    # 2**19 becomes 2**27; the better row has the larger id, and doubles would call it a tie.
    df = spark.createDataFrame([(50, [2.0**19, 1 / 256]), (1, [2.0**19, 0.0]), (2, [2.0**19, 1 / 256]), (3, [2.0**60, 0.0])], "vec_id long, embedding array<double>")
    got = sorted((r["rank"], r.vec_id, r.score) for r in topk.top_k(df, F.col("vec_id") == 50).collect())
    assert got == [(1, 3, 2**63 - 1), (2, 2, 2**54 + 1), (3, 1, 2**54)]


def test_decontamination_short_items_and_repeats(spark):
    docs = frame(spark, ["one two three", "ONE, two; three four", None, "", "x " * 30 + "a b c d e f g h i j k", "a b c d e f g h i zz", "a b c d e f g h i j a b c d e f g h i j"])
    items = spark.createDataFrame([(1, "two three"), (2, "A b c d e f g h i j"), (3, None), (4, "..."), (10, "two three"), (None, "one")], "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in decontam.find_benchmark_text(docs, items).collect()}
    assert got == {0: (3, 2, ["1", "10"]), 1: (4, 2, ["1", "10"]), 2: (0, 0, []), 3: (0, 0, []), 4: (41, 10, ["2"]), 5: (10, 0, []), 6: (20, 20, ["2"])}
    assert sorted(r.doc_id for r in decontam.contaminated_rows(docs, items).collect()) == [0, 1, 4, 6]
    assert decontam.find_benchmark_text(docs, items.limit(0)).filter("n_hit > 0").count() == 0
    near = decontam.proximity_matches(frame(spark, ["two odd three"]), items, slack=2).collect()
    assert {r.item for r in near} == {"1", "10"}


def test_proximity_looks_past_equal_terms_and_within_a_window(spark):
    docs = frame(spark, ["alpha x x x x zeta zeta", "beta gamma delta epsilon " * 5])
    items = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta")], "item_id long, text string")
    assert sorted((r.doc_id, r.position, r.gap) for r in decontam.proximity_matches(docs, items).collect()) == [(0, 5, 0), (0, 6, 1)]
    docs = frame(spark, ["one x three", "two", "one two"])
    items = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    assert [(r.doc_id, r.position, r.gap) for r in decontam.proximity_matches(docs, items, window=2).collect()] == [(2, 1, 0)]


def test_decontamination_of_repeated_words(spark):
    """A long text of one word against a long item of it, and items that share a frame."""
    docs = frame(spark, ["same " * 20_000, "what is the colour of snow in the far north of the land", "what is the colour of snow", "x same same y"])
    frames = [(10 + n, f"what is the colour of snow in the far north of number{n} town") for n in range(50)]
    items = spark.createDataFrame([(1, "same " * 1_500), *frames, (99, "same same")], "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, len(r["items"])) for r in decontam.find_benchmark_text(docs, items).collect()}
    assert got == {0: (20_000, 20_000, 2), 1: (13, 11, 50), 2: (6, 0, 0), 3: (4, 2, 1)}


def windows_of(words, wide):
    return {tuple(words[i : i + wide]): None for i in range(len(words) - wide + 1)}


@pytest.mark.parametrize("bound", [1 << 25, -1])
def test_decontamination_equals_brute_force(spark, monkeypatch, bound):
    """Broadcast and shuffle joins; null, repeated and equal ids; clashing columns; no rows."""
    monkeypatch.setattr(decontam, "BROADCAST_BYTES", bound)
    rnd = random.Random(31)
    prose = lambda k: [rnd.choice(WORDS[:9]) for _ in range(k)]
    items = [prose(n) for n in (3, 5, 9, 10, 11, 14, 30, 30)] + [["ti" + "re"] * 25]
    docs = [prose(40) + items[n % len(items)][k : k + 12 + n] + prose(5) for n in range(30) for k in (0, 3)] + [[], ["tire"] * 60]
    ids = [None, None, 7, 7, 7, *range(100, 100 + len(docs) - 5)]
    rows = [(i, " ".join(d), "x", 1, "y", None) for i, d in zip(ids, docs, strict=True)] + [(None, None, "x", 1, "y", None)]
    rows.append(rows[2])
    table = spark.createDataFrame(rows, "doc_id long, text string, term string, position int, words string, items string").repartition(3)
    bench = spark.createDataFrame([(n, " ".join(w).replace("the", "The"), "x") for n, w in enumerate(items)], "item_id long, text string, words string")
    want = []
    for i, text, *_ in rows:
        w = (text or "").split()
        hit, named = set(), set()
        for n, item in enumerate(items):
            wide = min(10, len(item))
            wanted = windows_of(item, wide)
            for s in range(len(w) - wide + 1):
                if tuple(w[s : s + wide]) in wanted:
                    hit.update(range(s, s + wide))
                    named.add(str(n))
        want.append((i or 0, len(w), len(hit), sorted(named)))
    found = decontam.find_benchmark_text(table, bench)
    assert sorted((r.doc_id or 0, r.n_words, r.n_hit, r["items"]) for r in found.collect()) == sorted(want)
    assert decontam.contaminated_rows(table, bench).count() == len({(i, tuple(d)) for i, d in zip(ids, docs, strict=True) if next(x for x in want if x[0] == (i or 0) and x[1] == len(d))[2]})
    assert decontam.find_benchmark_text(table.limit(0), bench).count() == 0 == decontam.proximity_matches(table, bench.limit(0)).count()


def test_proximity_equals_brute_force(spark):
    """Windows of two words are their own rarest terms, so every place within the slack can be counted."""
    rnd = random.Random(17)
    docs = [[rnd.choice("abcdef") for _ in range(30)] for _ in range(8)]
    items = [["a", "b", "c"], ["c", "c"], ["e"]]
    bench = spark.createDataFrame([(n, " ".join(w)) for n, w in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item, r.position, r.gap) for r in decontam.proximity_matches(frame(spark, [" ".join(d) for d in docs]), bench, window=2, slack=2).collect()}
    want = set()
    for i, d in enumerate(docs):
        count = {w: sum(x.count(w) for x in docs) for w in "abcdef"}
        for n, item in enumerate(items):
            for s in range(len(item) - 1):
                terms = sorted((count[item[s + o]], o, item[s + o]) for o in (0, 1))
                places = sorted((p - o, bit, p) for bit, (_, o, w) in enumerate(terms) for p, x in enumerate(d) if x == w)
                for k, (at, bit, p) in enumerate(places):
                    before = [x for x in places[:k] if x[1] != bit]
                    if before and at - before[-1][0] <= 2 and before[-1][2] != p:
                        want.add((i, str(n), p, at - before[-1][0]))
    assert got == want and len(want) > 20


def test_pii_keeps_formats_and_links(spark):
    rows = ["card 4539 1488 0343 6467, 4539148803436467 or 4539148803436468.", "call +1 (212) 555-0188 on 2020-02-29 or 29.02.2020", "DE89370400440532013000 078-05-1120 10.0.0.7 999.1.1.1 a.b@c.org", None, "", "plain words 2024 12:30"]
    got = {r.doc_id: r for r in pii.pseudonymize(frame(spark, rows), KEY).collect()}
    a, b = got[0].text.split(" or ")[0].split(", ")
    assert a.removeprefix("card ").replace(" ", "") == b and b != "4539148803436467" and "4539148803436468" in got[0].text
    assert sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(b)))) % 10 == 0
    assert got[1].kinds == ["date", "phone"] and "29.02.2020" not in got[1].text
    assert got[2].kinds == ["email", "iban", "ip", "ssn"] and "999.1.1.1" in got[2].text and "a.b@c.org" not in got[2].text
    assert got[3].text is None and got[4].text == "" and got[5].text == rows[5] and got[5].n_values == 0


def plain_feistel(kind, left, right, a, b):
    """The keyed permutation by its definition: eight rounds, halves with moduli a and b."""
    for i in range(8):
        half, modulus = (right, a) if i % 2 == 0 else (left, b)
        add = int(hashlib.sha256(f"{KEY}:{kind}:{i}:{half}:{modulus}".encode()).hexdigest()[:15], 16) % modulus
        left, right = ((left + add) % a, right) if i % 2 == 0 else (left, (right + add) % b)
    return left, right


def plain_digits(kind, digits):
    u = len(digits) // 2
    v = len(digits) - u
    left, right = plain_feistel(kind, int(digits[:u]), int(digits[u:]), 10**u, 10**v)
    return f"{left:0{u}d}{right:0{v}d}"


def luhn(digits):
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10


def refill(shape, digits):
    digits = iter(digits)
    return "".join(next(digits) if c.isdigit() else c for c in shape)


def plain_pseudonym(v):
    """One value, in plain Python; None where it fails its check."""
    whole = lambda p: re.fullmatch(p, v)
    d = re.sub(r"\D", "", v)
    if whole(pii.EMAIL):
        return "user-" + hashlib.sha256(f"{KEY}:email:{v.lower()}".encode()).hexdigest()[:32] + "@example.invalid"
    if whole(pii.IBAN):
        spelled = lambda s: int("".join(str(int(c, 36)) for c in s[4:] + s[:4]))
        d = re.sub(r"\D", "", v[4:])
        if spelled(v) % 97 != 1 or len(d) < 2:
            return None
        body = refill(v[4:], plain_digits("iban", d))
        return v[:2] + f"{98 - spelled(v[:2] + '00' + body) % 97:02d}" + body
    if whole(pii.SECRET):
        if not (re.search("[0-9]", v) and re.search("[A-Fa-f]", v)):
            return None
        made = hashlib.sha512(f"{KEY}:secret:{v}".encode()).hexdigest()[: len(v)]
        return made.upper() if v == v.upper() else made
    if whole(pii.DATE):
        for form in ("%Y-%m-%d", "%d.%m.%Y", "%m/%d/%Y", "%d/%m/%Y"):
            try:
                n = (datetime.datetime.strptime(v, form).date() - datetime.date(1900, 1, 1)).days
            except ValueError:
                continue
            if not 0 <= n < 360 * 203:
                return None
            left, right = plain_feistel("date", n // 203, n % 203, 360, 203)
            return (datetime.date(1900, 1, 1) + datetime.timedelta(left * 203 + right)).strftime(form)
        return None
    if whole(pii.IPV4):
        p = [int(x) for x in v.split(".")]
        if max(p) > 255:
            return None
        left, right = plain_feistel("ip", p[0] * 256 + p[1], p[2] * 256 + p[3], 65536, 65536)
        return f"{left // 256}.{left % 256}.{right // 256}.{right % 256}"
    if whole(pii.SSN):
        area, group, serial = map(int, v.split("-"))
        if not (0 < area < 900 and area != 666 and group and serial):
            return None
        left, right = plain_feistel("ssn", (area - 1 - (area > 666)) * 99 + group - 1, serial - 1, 898 * 99, 9999)
        k = left // 99
        return f"{k + 1 + (k >= 665):03d}-{left % 99 + 1:02d}-{right + 1:04d}"
    if whole(pii.PHONE):
        code, area, exchange, line = d[:-10], int(d[-10:-7]), int(d[-7:-4]), int(d[-4:])
        if code not in ("", "1"):
            return refill(v, code + plain_digits("phone", d[-10:]))
        if area < 200 or exchange < 200:
            return None
        left, right = plain_feistel("phone", (area - 200) * 800 + exchange - 200, line, 640_000, 10_000)
        return refill(v, f"{code}{left // 800 + 200:03d}{left % 800 + 200:03d}{right:04d}")
    if luhn(d):
        return None
    body = d[0] + plain_digits("card", d[1:-1])
    return refill(v, body + str(-luhn(body + "0") % 10))


def test_pii_equals_plain_python(spark):
    rnd = random.Random(77)
    digits = lambda n: "".join(rnd.choice("0123456789") for _ in range(n))
    cards = []
    for n in (13, 15, 16, 16, 19):
        d = digits(n - 1)
        cards.append(d + str(-luhn(d + "0") % 10))
    cards.append(" ".join(cards[2][i : i + 4] for i in range(0, 16, 4)))
    values = [*cards, digits(16), "DE89370400440532013000", "DE88370400440532013000", "GB82WEST12345698765432", "a.b+c@mail.example.org", "A.B+C@mail.example.org"]
    values += ["+1 (212) 555-0188", "(212) 555-0188", "212.555.0188", "112-555-0188", "+44 123 456 7890", "078-05-1120", "666-05-1120", "899-99-9999", "10.0.0.7", "256.1.1.1"]
    values += ["1999-12-31", "31.12.1999", "12/31/1999", "31/12/1999", "1899-12-31", "2100-02-29", "2000-02-29", "d41d8cd98f00b204e9800998ecf8427e", "D41D8CD98F00B204E9800998ECF8427E", "9" * 40]
    rows = [f"see {v}, or ({v}) and {rnd.choice(values)}." for v in values] + [" ".join(values), "x" * 200_000 + " 10.0.0.7", None, "", "none here"]
    docs = spark.createDataFrame([(i if i % 7 else None, t, "x", 1, "y") for i, t in enumerate(rows)], "doc_id long, text string, found string, made int, kinds string")
    replace = lambda t: re.sub(pii.ANY, lambda m: plain_pseudonym(m[0]) or m[0], t)
    want = sorted((i if i % 7 else -1, "-" if t is None else replace(t)) for i, t in enumerate(rows))
    found = pii.pseudonymize(docs.unionAll(docs), KEY)
    assert sorted((-1 if r.doc_id is None else r.doc_id, "-" if r.text is None else r.text) for r in found.collect()) == sorted(want * 2)
    assert sum(replace(t) != t for t in rows if t) > 20
    assert pii.pseudonymize(docs.limit(0), KEY).count() == 0 and pii.configured_key(spark) == pii.configured_key(spark)
    with pytest.raises(ValueError):
        pii.pseudonymize(docs, "short")


def test_feistel_is_a_permutation(spark):
    pairs = spark.range(35).select((F.col("id") % 5).alias("l"), F.floor(F.col("id") / 5).alias("r"))
    go = lambda inv, l, r: pii.feistel("k", "t", l, r, F.lit(5).cast("long"), F.lit(7).cast("long"), inv)  # noqa: E731, E741
    rows = pairs.withColumn("x", go(False, F.col("l"), F.col("r"))).withColumn("y", go(True, F.col("x.l"), F.col("x.r"))).collect()
    assert len({(r.x.l, r.x.r) for r in rows}) == 35 and all((r.y.l, r.y.r) == (r.l, r.r) for r in rows)


def test_sharding_is_even_gapless_and_keeps_groups(spark):
    rows = texts(4, 600) + ["same text again"] * 5
    got = sharding.shard_by_bytes(frame(spark, rows)).toPandas()
    assert len(got) == len(rows) and (got.law == "bytes").all() and got.grown_shard.isna().all()
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in got.groupby("shard"))
    assert got[got.doc_id >= len(rows) - 5].shard.nunique() == 1
    assert sharding.shard_by_bytes(frame(spark, rows).limit(0)).count() == 0


def test_sharding_splits_a_hot_group(spark):
    got = sharding.shard_by_bytes(frame(spark, ["hot " * 50] * 400 + texts(6, 200))).toPandas()
    sizes = got.groupby("shard")["size"].sum()
    assert sizes.max() < 2.5 * sizes.mean()


@pytest.mark.parametrize("rows_per_range", [sharding.ROWS_PER_RANGE, 5])
def test_sharding_equals_sort_and_cut(spark, rows_per_range):
    """Against one sorted list; a third of the rows are empty texts, and few ranges hold many rows each."""
    rnd = random.Random(5)
    rows = [(i, t) for i, t in enumerate(texts(9, 500) + ["hot group " * 30] * 300 + [""] * 400)] + [(None, "null id"), (None, None), (7, "again"), (7, "again")]
    rnd.shuffle(rows)
    docs = spark.createDataFrame([(i, t, 1, "x", 2.0) for i, t in rows], "doc_id long, text string, part int, key string, size double").repartition(4)
    got = sharding.shard_by_bytes(docs, rows_per_range=rows_per_range).collect()
    size = lambda t: len((t or "").encode()) + 1
    hashed = lambda t: 42 if t is None else int(np.uint64(xxhash.xxh64_intdigest(t.encode(), 42)).astype(np.int64))
    ordered = sorted((hashed(t), -(1 << 63) if i is None else i, size(t), zlib.crc32((t or "").encode()), i) for i, t in rows)
    total = sum(r[2] for r in ordered)
    starts, at = [], 0
    for r in ordered:
        starts.append(at)
        at += r[2]
    group = {}
    for r, s in zip(ordered, starts, strict=True):
        first, held = group.get(r[0], (s, 0))
        group[r[0]] = (first, held + r[2])
    want, slots = [], {}
    for (key, _, n, crc, i), s in zip(ordered, starts, strict=True):
        first, held = group[key]
        middle = s + n / 2 if held > total / 256 else first + held / 2
        shard = min(15, int(middle * 16 // total))
        want.append((-1 if i is None else i, n, crc, shard, slots.get(shard, 0)))
        slots[shard] = slots.get(shard, 0) + 1
    assert sorted((-1 if r.doc_id is None else r.doc_id, r["size"], r.text_crc32, r.shard, r.slot) for r in got) == sorted(want)


def test_toxicity_gradient_by_differences():
    rng = np.random.default_rng(6)
    is_p = np.arange(30) < 10
    for prior, shift in ((0.2, 0.0), (0.7, 4.0)):
        z = rng.normal(size=30) + np.where(is_p, shift, -shift)
        negative = toxicity.risk_parts(z, is_p, prior)[1] < 0
        assert negative == (shift > 0)
        value = lambda x: -toxicity.risk_parts(x, is_p, prior)[1] if negative else sum(toxicity.risk_parts(x, is_p, prior))  # noqa: E731, B023
        by_hand = [(value(z + d) - value(z - d)) / 2e-6 for d in np.eye(30) * 1e-6]
        assert np.allclose(toxicity.risk_gradient(z, is_p, prior), by_hand, atol=1e-8)


def plain_boosting(x, y, trees, depth, bins, rate, ridge):
    """Split search over all bin edges, a node and a row at a time; the margins of the fitted rows."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    margin = np.full(len(x), np.log(y.mean() / (1 - y.mean())))
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        step = np.zeros(len(x))

        def grow(rows, level):
            G, H = g[rows].sum(), h[rows].sum()  # noqa: B023
            if level == depth:
                step[rows] = -rate * G / (H + ridge)  # noqa: B023
                return
            best = (1e-6, None)
            for j in range(x.shape[1]):
                for e in edges[j]:
                    left = [i for i in rows if x[i, j] <= e]
                    a, b = g[left].sum(), h[left].sum()  # noqa: B023
                    if b >= 1 and H - b >= 1:
                        gain = a**2 / (b + ridge) + (G - a) ** 2 / (H - b + ridge) - G**2 / (H + ridge)
                        if gain > best[0] + 1e-12:
                            best = (gain, (j, e))
            if best[1] is None:
                grow(rows, level + 1)
                return
            j, e = best[1]
            for part in ([i for i in rows if x[i, j] <= e], [i for i in rows if x[i, j] > e]):
                if part:
                    grow(part, level + 1)

        grow(list(range(len(x))), 0)
        margin = margin + step
    return margin


def test_boosting_equals_plain_split_search():
    rng = np.random.default_rng(12)
    x = np.zeros((150, len(quality.STATISTICS)))
    x[:, :4] = rng.normal(size=(150, 4))
    x[:, 4] = rng.integers(0, 3, 150)
    y = ((x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(size=150) * 0.3) > 0).astype(float)
    trees = quality.fit(x, y, trees=6, depth=3, bins=8)
    want = plain_boosting(x, y, 6, 3, 8, 0.15, 1.0)
    assert np.allclose(trees.score(x), 1 / (1 + np.exp(-want)))
    # Walking the arrays a node at a time.
    for row in rng.normal(size=(20, x.shape[1])):
        margin = trees.base
        for feature, threshold, value in zip(trees.feature, trees.threshold, trees.value, strict=True):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if row[feature[node]] > threshold[node] else 1)
            margin += value[node - len(feature)]
        assert np.isclose(trees.score(row[None])[0], 1 / (1 + np.exp(-margin)))


def test_line_dedup_edges(spark, monkeypatch):
    """Hosts read from URLs, null hosts, clashing columns, repeated rows, no rows; both joins."""
    rows = [(n, f"https://www.Example.org/{n}", f"page {n} text\n  menu \nfoot") for n in range(8)] + [(n, f"http://other.net:80/{n}", f"menu\nother {n}") for n in range(3)] + [(9, None, "menu")] * 6
    docs = spark.createDataFrame([(*r, "kept", 5) for r in rows], "doc_id long, url string, text string, __bad string, n_dropped int").drop("__bad")
    docs = docs.withColumn("host", F.lower(F.regexp_extract("url", r"^[a-z]+://([^/:]+)", 1)))
    docs = docs.withColumn("host", F.when(F.col("url").isNotNull(), F.col("host")))
    found = []
    for bound in (200_000, -1):
        monkeypatch.setattr(line_dedup, "BROADCAST_LINES", bound)
        got = line_dedup.drop_boilerplate(docs, host_col="host", ratio=0.5).collect()
        found.append(sorted((r.doc_id, r.url or "", r.text, r.n_lines, r.n_dropped) for r in got))
    want = [(n, f"https://www.Example.org/{n}", f"page {n} text", 3, 2) for n in range(8)] + [(n, f"http://other.net:80/{n}", f"menu\nother {n}", 2, 0) for n in range(3)] + [(9, "", "", 1, 1)] * 6
    assert found[0] == found[1] == sorted(want)
    assert line_dedup.drop_boilerplate(docs.limit(0), host_col="host").count() == 0


def test_simhash_without_rows_or_ids(spark):
    docs = spark.createDataFrame([(None, "a b c d", 1), (None, None, 1), (4, "a b c d", 2), (4, "a b c d", 2), (6, "", 3)], "doc_id long, text string, fp int")
    got = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == {(None, 4), (4, 4), (None, 6), (6, 6)}
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    alone = simhash.near_duplicates(docs.filter("doc_id IS NULL")).collect()
    assert len(alone) == 2 and all(r.component_id is None for r in alone)


def test_line_dedup(spark):
    rows = [f"line {i}\nmenu\n\nend {i}" for i in range(60)] + [None, "", "menu"]
    got = {r.doc_id: r for r in line_dedup.drop_boilerplate(frame(spark, rows)).collect()}
    assert got[0].text == "line 0\n\nend 0" and got[0].n_dropped == 1 and got[60].text is None and got[61].text == "" and got[62].text == ""


@pytest.mark.parametrize("scores", [quality.quality_scores, toxicity.toxicity_scores])
def test_classifiers_learn_and_survive_empty_labels(spark, scores):
    rnd = random.Random(9)
    rows = [" ".join(rnd.choice(WORDS) + ("!!" if i % 2 else "") for _ in range(40)) + (" slur" if i % 2 else "") for i in range(400)] + [None, ""]
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(400)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    got = scores(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out and r.doc_id < 400]
    assert sum(r.predicted == r.doc_id % 2 for r in held) >= 0.95 * len(held)
    assert len({r.score for r in scores(docs, labels.limit(0)).collect()}) == 1
    odd = docs.limit(5).unionAll(docs.limit(5)).unionAll(spark.createDataFrame([(None, "word " * 60_000, "x", "y"), (None, None, "x", "y")], docs.schema))
    odd = odd.withColumn("label", F.lit("x")).withColumn("quality_score", F.lit("x")).withColumn("toxicity", F.lit("x"))
    again = scores(odd, labels).collect()
    assert len(again) == 12 and all(r.held_out is False for r in again if r.doc_id is None) and all(r.held_out in (True, False) for r in again)
    assert scores(docs.limit(0), labels).count() == 0


def test_bpe_replay_holds_32_bit_arrays():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    table, rnd = bpe.Merges(open(path, "rb").read()), random.Random(1)
    words = ["".join(rnd.choice("etaoinshrdlu") for _ in range(9)).encode() for _ in range(20_000)]
    tracemalloc.start()
    table.replay(words)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 45 * sum(len(w) + 1 for w in words)
