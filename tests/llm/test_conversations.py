"""Conversation repair against a search over all edits, and edge cases."""

import hashlib
import heapq
import random

import duckdb
import pytest

from pairtrace.llm import conversations as conv

STEP = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def cheapest(rows):
    """Least (cost, audit) by uniform-cost search; rows are (initial, has to go, truncated)."""
    heap = [(0, "", 0, "")]
    while True:
        cost, audit, i, last = heapq.heappop(heap)
        if i == len(rows) and last in ("", "a"):
            return cost, audit
        for put in "ua":
            if (last, put) in STEP and audit.count("I") < len(rows) + 3:
                heapq.heappush(heap, (cost + 3, audit + "I", i, put))
        if i < len(rows):
            initial, gone, cut = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, last))
            if not gone:
                if (last, initial) in STEP:
                    heapq.heappush(heap, (cost + 3 * cut, audit + "K", i + 1, initial))
                for put in "ua":
                    if (last, put) in STEP:
                        heapq.heappush(heap, (cost + 3 + 3 * cut, audit + "R", i + 1, put))


def test_audits_equal_search():
    rnd = random.Random(5)
    tails = {""}
    while len(tails) < 250:
        tails.add("".join(rnd.choice("suaSUAxX--ua") for _ in range(rnd.randrange(7))))
    tails = sorted(tails)
    for tail, got in zip(tails, conv.cheapest_audits(tails), strict=True):
        rows = [(c.lower(), c == conv.GONE, c.isupper()) for c in reversed(tail)]
        assert got == cheapest(rows), tail


ROWS = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "Hello there."), (1, 2, "assistant", "Good day!"), (1, 2, "assistant", "Good day!"), (1, 9, "user", "and then"),
    (2, None, "user", "No turn."), (2, None, None, "no role"), (2, 3, "assistant", None), (2, 3, "assistant", " \t\n"), (2, 3, "", "x."),
    (None, 0, "user", "Whose?"), (None, 1, "assistant", "Nobody's."), (3, 0, "tool", "?"), (4, 5, "user", ""), (5, 1, "assistant", "a" + " " * 50_000 + "b"),
    *[(6, t, ("user", "assistant")[t % 2], f"line {t % 7}.") for t in range(300)], *[(7, 1, "user", "same.")] * 5,
    *[(20 + n, t, ("user", "assistant", "system")[(n * t + n) % 3], "text" if n % 5 == t else "text %d." % (n % 4)) for n in range(40) for t in range(n % 6)],
]
COLUMNS = "conv_id long, turn long, role string, text string"


def sql(rows):
    con = duckdb.connect()
    con.sql("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    for row in rows:
        con.execute("INSERT INTO conversations VALUES (?, ?, ?, ?)", row)
    return con.sql(conv.ORACLE)


def test_edge_rows_equal_sql(spark):
    """Nulls, ties, repeated rows, blank and long texts, unknown roles, conversations that lose all rows."""
    got = conv.repair_damaged(spark.createDataFrame(ROWS, COLUMNS).repartition(3))
    want = sql(ROWS)
    assert got.columns == want.columns
    order = lambda rows: sorted(map(tuple, rows), key=str)
    assert order(got.collect()) == order(want.fetchall())


def test_repaired_rows_are_whole_conversations(spark):
    docs = spark.createDataFrame(ROWS, COLUMNS)
    hashes = {r.conv_id: r for r in conv.repair(docs).collect()}
    rows = {}
    for r in conv.repaired_rows(docs).collect():
        rows.setdefault(r.conv_id, []).append(r)
    for key, told in hashes.items():
        mine = sorted(rows.get(key, []), key=lambda r: r.place)
        assert [r.edit for r in mine] == [e for e in told.audit if e != "D"]
        initials = "".join(r.role[0] for r in mine).removeprefix("s")
        assert initials == "ua" * (len(initials) // 2)
        assert told.repaired_sha256 == hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in mine).encode()).hexdigest()


def test_text_ids_clashing_columns_and_no_rows(spark):
    docs = spark.createDataFrame([("a:b", 1, "user", "Yes.", 1, 2), (None, 2, "assistant", "No.", 3, 4)], "conv_id string, turn int, role string, text string, kind int, __conv int")
    got = {r.conv_id: (r.cost, r.audit) for r in conv.repair(docs).collect()}
    assert got == {"a:b": (3, "KI"), None: (3, "IK")}
    assert conv.repair_damaged(docs.limit(0)).count() == 0 and conv.repaired_rows(docs.limit(0)).count() == 0


@pytest.mark.parametrize("rows", [[], [(9, None, None, None)]])
def test_little(spark, rows):
    got = conv.repair_damaged(spark.createDataFrame(rows, COLUMNS))
    assert [tuple(r) for r in got.collect()] == sql(rows).fetchall()
