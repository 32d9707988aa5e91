"""Bottom-k near duplicates against all pairs of full sets."""

import random

import numpy as np
import pytest

from pairtrace.llm import minhash


def shingles(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2)))


def brute(rows):
    """(id, n_shingles, component_id) by comparing all pairs; ids are distinct."""
    sets = [(i, shingles(t)) for i, t in rows]
    up = {i: i for i, _ in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, s in sets:
        for b, t in sets:
            if a < b and s and t and 100 * len(s & t) >= 85 * len(s | t):
                x, y = top(a), top(b)
                up[max(x, y)] = min(x, y)
    return {(i, len(s), top(i), top(i) == i) for i, s in sets}


def corpus(seed):
    rnd = random.Random(seed)
    words = [a + b for a in "bcdfg" for b in ("a", "é", "on", "ist", "ÀB")]
    prose = lambda n: [rnd.choice(words) for _ in range(n)]
    out = []
    for n in (12, 40, 80, 150):  # groups whose members differ from the first by more and more words
        first = prose(n)
        for edits in range(14):
            made = list(first)
            for _ in range(edits * n // 120):
                made[rnd.randrange(n)] = rnd.choice(words)
            out.append(made)
    chain = prose(100)  # each member links with its neighbours only
    for _ in range(12):
        chain = chain[3:] + prose(3)
        out.append(list(chain))
    passage = prose(60)  # one passage in unlike texts, in several shares
    out += [prose(n) + passage + prose(n) for n in (1, 2, 4, 8, 16, 30) for _ in range(6)]
    out += [prose(n) for n in (1, 2, 3, 3, 200, 4_000)]
    out += [out[0], out[20], [w.upper() if w.isascii() else w for w in out[30]]]
    return [" ".join(w) for w in out] + ["", None, " \n", "one", "ONE", "one two", "\tone  two "]


@pytest.mark.parametrize(("seed", "most", "block", "few"), [(1, 500, 500, 16), (2, 4, 3, 16), (3, 4, 40, 0)])
def test_components_equal_all_pairs(spark, monkeypatch, seed, most, block, few):
    monkeypatch.setattr(minhash, "FEW", few)
    rows = list(enumerate(corpus(seed), 10))
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, n int, id int").repartition(5)
    assert {tuple(r) for r in minhash.linked_sets(docs, most=most, block=block).collect()} == brute(rows)


def test_null_and_repeated_ids_and_no_rows(spark):
    text = "a b c d e f g h"
    docs = spark.createDataFrame([(None, text), (7, text), (7, "other words here"), (3, None), (3, text), (3, text), (9, "other words here")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.linked_sets(docs).collect()), key=str)
    assert got == sorted([(None, 6, None, True), (7, 6, None, False), (7, 1, 7, True), (3, 0, 3, True), (3, 6, None, False), (3, 6, None, False), (9, 1, 7, False)], key=str)
    assert minhash.linked_sets(docs.limit(0)).count() == 0


def test_least_links_pass_every_filter():
    """Sets of exactly 85 percent share a listed value, have the overlap, and pass the union's sketch."""
    rnd = np.random.default_rng(6)
    for size in (17, 34, 51, 68, 170, 1_700):
        for _ in range(40):
            shared = rnd.integers(0, 1 << 63, size, dtype=np.uint64)
            more = rnd.integers(0, 1 << 63, size * 3 // 17, dtype=np.uint64)
            cut = int(rnd.integers(0, more.size + 1))
            a, b = np.unique(np.r_[shared, more[:cut]]), np.unique(np.r_[shared, more[cut:]])
            assert minhash.linked(a, b, 85)
            x, y = minhash.bottom(a), minhash.bottom(b)
            overlap = np.intersect1d(x, y).size
            assert overlap >= max(minhash.needed(a.size, 85), minhash.needed(b.size, 85)) and minhash.union_passes(x, y, 85)
            assert np.intersect1d(x[: x.size - minhash.needed(a.size, 85) + 1], y[: y.size - minhash.needed(b.size, 85) + 1]).size


def test_a_group_of_near_copies_meets_sketches_once(spark, monkeypatch):
    """120 texts that differ in a word each have some 25 lists in common; one row of each meets its sketch, not one a list."""
    words, met, leaders = [f"w{i}" for i in range(150)], [], minhash._leaders
    monkeypatch.setattr(minhash, "_leaders", lambda lists, *rest: met.append(lists.count()) or leaders(lists, *rest))
    texts = [" ".join([*words[:i], "other", *words[i + 1 :]]) for i in range(120)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.component_id for r in minhash.linked_sets(docs).collect()} == {0}
    assert sum(met) < 3 * len(texts)
