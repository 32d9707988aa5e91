"""Spelling variants against all pairs of words, and against SQL on odd texts."""

import random

import duckdb
import pytest

from pairtrace.llm import spelling


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts):
    out = set()
    best = {}
    for w, n in counts.items():
        near = [x for x in counts if one_edit(w, x)]
        top = min(near, key=lambda x: (-counts[x], x), default=None)
        form = top if top and counts[top] >= 2 * n else None
        best[w] = (form, n, len(near), counts[form] if form else None)
    for w, (form, n, near, form_n) in best.items():
        root = w
        while best[root][0]:
            root = best[root][0]
        out.add((w, form, root, n, near, form_n))
    return out


@pytest.mark.parametrize("tile", [1_000, 7])
def test_variants_equal_all_pairs(spark, monkeypatch, tile):
    """Also with groups dealt to many tiles, small matrices and few pairs at once."""
    monkeypatch.setattr(spelling, "PAIRS", 50)
    rnd = random.Random(2)
    counts = {}
    while len(counts) < 260:
        counts["".join(rnd.choice("abé" if len(counts) % 3 else "ÿaÀ") for _ in range(rnd.choice((5, 5, 6, 6, 7))))] = rnd.choice((3, 4, 6, 9, 18, 40, 90))
    for i in range(60):
        counts[f"prefixedlong{chr(97 + i % 26)}{chr(97 + i // 26)}"] = 3 + i
    got = spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3), tile=tile)
    assert {tuple(r) for r in got.collect()} == brute(counts)


def test_first_part_is_satisfied_by_every_pair():
    for wide in range(4, 12):
        cuts = spelling.bounds(wide)
        for prefix in range(wide + 1):
            for suffix in range(max(0, wide - 1 - prefix), wide + 1):
                assert any(prefix >= cuts[j] and suffix >= wide - cuts[j + 1] for j in range(spelling.PARTS))


def test_texts_equal_sql(spark):
    """Null, empty and long texts, null and repeated ids, case outside A-Z, characters outside the class, slips that shorten words below the least."""
    rnd = random.Random(8)
    stems = ["Straße", "Élan", "élans", "naïve", "NAÏVE", "tables", "table", "cable", "cables", "fables", "×÷×÷×", "wordsœword", "abcdė"]
    stems += ["".join(rnd.choice("aeiourst") for _ in range(5)) for _ in range(60)]
    rows = [(i, " ".join(rnd.choice(stems) for _ in range(rnd.randrange(60)))) for i in range(60)]
    rows += [(None, "tables tables"), (3, None), (3, ""), (4, "..."), (5, " ".join(stems) * 400), (5, " ".join(stems) * 400)]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, word int, n int").repartition(4)
    con = duckdb.connect()
    con.sql("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    for row in rows:
        con.execute("INSERT INTO documents VALUES (?, ?)", row)
    want = con.sql(spelling.ORACLE)
    got = spelling.spelling_variants(docs, slips=97)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall()) and want.fetchall
    assert spelling.spelling_variants(docs.limit(0), slips=97).count() == 0
