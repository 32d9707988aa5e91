"""Repair of conversation structure by cheapest edits, with costs shared over all conversations.

A conversation becomes a signature: one letter a row for its role's initial and its fault. The
distinct signatures are read from their ends, in sorted order, so that equal endings are one
node of a suffix-shared automaton. Nodes with the same costs up to a constant go on alike and are
minimised to one. Costs to go and the best edit are worked out once for each node and grammar
state; only the path of the current signature is held. The edits are then applied to the rows
of each conversation as a stream.
"""

from __future__ import annotations

import hashlib
import os
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairtrace.functions.shared import materialize
from pairtrace.llm.crc import CRC_TABLE, crc32

# Costs of the edits. Their initials are the letters of an audit.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Roles by initial; a repaired conversation's initials are (s?(ua)+)?, or nothing.
ROLES = {"u": "user", "a": "assistant"}
#: Grammar states: nothing yet, after s, after u, after a; what each takes, and the initial that it needs next.
TAKES = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
NEEDS = ("u", "u", "a", "u")
#: Letter of a row that has to go; others are their initial, upper case where truncated, x for no known one.
GONE = "-"

SPACE = " \t\n\x0b\x0c\r"
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal")


def damage(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with the faults that crc32 of ``conv_id:turn`` modulo 20 names.

    0 drops the row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 sets role user.
    Nulls are written as one space, but a null conv_id or turn stays null in its column.
    """
    told = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.pmod(F.crc32(F.concat(told("conv_id"), F.lit(":"), told("turn")).cast("binary")), F.lit(20))
    text = F.when(fate == 1, "").when(fate == 2, F.regexp_replace(told("text"), "[.!?]", "")).otherwise(told("text"))
    role = F.when(fate == 4, "user").otherwise(told("role"))
    times = F.when(fate == 3, 2).otherwise(1)
    rows = conversations.filter(fate != 0).select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), times)).alias("__again"))
    return rows.drop("__again")


def _ordered(conversations: DataFrame) -> DataFrame:
    """(conv, turn, role, digest, text); rows of a conversation are in the order of turn, role, digest."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    role = F.coalesce(F.col("role").cast("string"), F.lit(" "))
    return conversations.select(
        F.col("conv_id").cast("string").alias("conv"), F.col("turn").cast("long").alias("turn"), role.alias("role"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"), text.alias("text")
    )


def _faults(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, digest, letter, fault) without texts; fault is b, d, t or empty."""
    bare = F.rtrim("text", F.lit(SPACE))  # texts go no further than here
    slim = rows.select("conv", "turn", "role", "digest", (bare == "").alias("blank"), F.right(bare, F.lit(1)).isin(".", "!", "?").alias("ended"))
    slim = slim.repartition("conv")  # the window below needs no other shuffle
    again = F.row_number().over(Window.partitionBy("conv", "role", "digest").orderBy("turn")) > 1
    fault = F.when(F.col("blank"), "b").when(again, "d").when(~F.col("ended"), "t").otherwise("")
    initial = F.left("role", F.lit(1))
    letter = F.when(F.col("blank") | again, GONE).when(initial.isin("s", "u", "a"), F.when(fault == "t", F.upper(initial)).otherwise(initial)).otherwise(F.when(fault == "t", "X").otherwise("x"))
    return slim.select("conv", "turn", "role", "digest", letter.alias("letter"), fault.alias("fault"))


def signatures(rows: DataFrame) -> DataFrame:
    """(conv, tail, gaps, blank, duplicate, truncated, illegal) for each conversation; ``tail`` is its signature from the end."""
    legal = {"su", "ua", "au"}

    def close(conv, letters, n, low, high, turns, illegal):
        gaps = high - low + 1 - turns if turns else 0
        return conv, letters[::-1].decode(), gaps, n["b"], n["d"], n["t"], illegal

    def run(batches):
        now, letters, n, low, high, turns, illegal, last = None, None, {}, 0, 0, 0, 0, ""
        names = ["conv", "tail", *COUNTS]
        kinds = [pa.string(), pa.string(), *[pa.int64()] * 5]
        for batch in batches:
            out = []
            for conv, turn, role, letter, fault in zip(*[batch.column(c).to_pylist() for c in ("conv", "turn", "role", "letter", "fault")], strict=True):
                if letters is None or conv != now:
                    if letters is not None:
                        out.append(close(now, letters, n, low, high, turns, illegal))
                    now, letters, n, turns, illegal, last = conv, bytearray(), {"b": 0, "d": 0, "t": 0, "": 0}, 0, 0, None
                letters += letter.encode()
                n[fault] += 1
                if turn is not None:
                    if not turns or turn != high:
                        turns += 1
                    low = turn if turns == 1 else low
                    high = turn
                illegal += last is not None and last + role[:1] not in legal
                last = role[:1]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kinds[i]) for i in range(7)], names)
        if letters is not None:
            last_row = close(now, letters, n, low, high, turns, illegal)
            yield pa.RecordBatch.from_arrays([pa.array([last_row[i]], kinds[i]) for i in range(7)], names)

    slim = _faults(rows).sortWithinPartitions("conv", "turn", "role", "digest", F.col("fault") == "d")
    return slim.mapInArrow(run, f"conv string, tail string, {', '.join(f'{c} long' for c in COUNTS)}")


@lru_cache(maxsize=100_000)
def _node(letter: str, below: tuple[int, ...]) -> tuple[int, tuple[int, ...], tuple[tuple[str, int], ...]]:
    """(least cost, costs above it by state, best edits by state) where ``below`` are the costs of what follows.

    An edit is (initial, state after it). All edits of a state have different initials, so the
    least initial gives the least audit among edits of equal cost.
    """
    best: list[tuple[int, str, int]] = []
    for state in range(4):
        edits = [] if not letter else [(below[state] + DELETE, "D", state)]
        if not letter and state in (0, 3):
            edits.append((0, "", state))
        if letter and letter != GONE:
            more = TRUNCATED if letter.isupper() else 0
            if letter.lower() in TAKES[state]:
                to = TAKES[state][letter.lower()]
                edits.append((below[to] + more, "K", to))
            to = TAKES[state][NEEDS[state]]
            edits.append((below[to] + REROLE + more, "R", to))
        best.append(min(edits, default=(1 << 60, "", state)))
    for _ in range(4):  # an inserted row leads to another state of the same node
        for state in range(4):
            to = TAKES[state][NEEDS[state]]
            best[state] = min(best[state], (best[to][0] + INSERT, "I", to))
    least = min(b[0] for b in best)
    return least, tuple(b[0] - least for b in best), tuple((b[1], b[2]) for b in best)


END = _node("", (0, 0, 0, 0))


def cheapest_audits(tails):
    """(cost, audit) of each of the ascending ``tails``; what a tail shares with the one before it is kept."""
    nodes, totals, path = [END], [END[0]], ""
    for tail in tails:
        same = len(os.path.commonprefix([path, tail]))
        del nodes[same + 1 :], totals[same + 1 :]
        for letter in tail[same:]:
            made = _node(letter, nodes[-1][1])
            nodes.append(made)
            totals.append(totals[-1] + made[0])
        path, state, at, audit = tail, 0, len(tail), []
        while True:
            edit, to = nodes[at][2][state]
            if not edit:
                break
            audit.append(edit)
            at, state = at - (edit != "I"), to
        yield totals[-1] + nodes[-1][1][0], "".join(audit)


def repair_plans(tails: DataFrame) -> DataFrame:
    """(tail, cost, audit) of the distinct ``tail``, dealt by ranges so that equal endings meet."""

    def run(batches):
        def ascending():
            for batch in batches:
                for tail in batch.column("tail").to_pylist():
                    tail_of.append(tail)
                    yield tail

        tail_of: list[str] = []
        rows, size = [], 0
        for cost, audit in cheapest_audits(ascending()):
            rows.append((tail_of.pop(), cost, audit))
            size += len(audit) + 64
            if size > 1 << 22:
                yield _batch(rows)
                rows, size = [], 0
        yield _batch(rows)

    def _batch(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.string(), pa.int64(), pa.string()))], ["tail", "cost", "audit"])

    dealt = tails.select("tail").distinct().repartitionByRange("tail").sortWithinPartitions("tail")
    return dealt.mapInArrow(run, "tail string, cost long, audit string")


def repaired(audit: str, rows):
    """(edit, turn, role, text) of the rows that stand after the edits; inserted ones have no turn."""
    state = 0
    for edit in audit:
        if edit == "I":
            yield edit, None, ROLES[NEEDS[state]], ""
            state = TAKES[state][NEEDS[state]]
            continue
        turn, role, text = next(rows)
        if edit == "D":
            continue
        role = role if edit == "K" else ROLES[NEEDS[state]]
        state = TAKES[state][role[0]]
        yield edit, turn, role, text


def _streams(batches):
    """(conv, audit, rows) for each conversation of a stream in which its plan precedes its rows."""
    flat = (row for b in batches for row in zip(*[b.column(c).to_pylist() for c in ("conv", "audit", "turn", "role", "text")], strict=True))
    held = next(flat, None)

    def rows(conv):
        nonlocal held
        while (held := next(flat, None)) is not None and held[1] is None:
            yield held[2:]

    while held is not None:
        conv, audit = held[:2]
        mine = rows(conv)
        yield conv, audit, mine
        for _ in mine:  # what the reader left
            pass


def _with_plans(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """Rows of each conversation behind its plan, in order."""
    plan = plans.select("conv", F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("binary").alias("digest"), F.lit(None).cast("string").alias("text"), "audit", F.lit(0).alias("kind"))
    both = plan.unionByName(rows.withColumns({"audit": F.lit(None).cast("string"), "kind": F.lit(1)}))
    return both.repartition("conv").sortWithinPartitions("conv", "kind", "turn", "role", "digest")


def _planned(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, plans): plans (conv, counts, cost, audit)."""
    rows = _ordered(conversations)
    signed = materialize(signatures(rows), "conversation-signatures")
    plans = materialize(repair_plans(signed), "repair-plans")
    return rows, materialize(signed.join(plans, "tail").drop("tail"), "conversation-plans")


def repaired_rows(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, edit, turn, role, text) of every row that stands after the cheapest edits."""
    rows, plans = _planned(conversations)

    def run(batches):
        names, kinds = ["conv", "place", "edit", "turn", "role", "text"], (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string())
        out, size = [], 0
        make = lambda: pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names)
        for conv, audit, mine in _streams(batches):
            for place, row in enumerate(repaired(audit, mine)):
                out.append((conv, place, *row))
                size += len(row[3]) + 64
                if size > 1 << 22:
                    yield make()
                    out, size = [], 0
        yield make()

    made = _with_plans(rows, plans).mapInArrow(run, "conv string, place long, edit string, turn long, role string, text string")
    return made.select(F.col("conv").cast(conversations.schema["conv_id"].dataType).alias("conv_id"), "place", "edit", "turn", "role", "text")


def repair(conversations: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of each conversation.

    A row's first fault counts: blank (no character beyond white space), duplicate (role and text
    seen earlier), truncated (last such character not ``.!?``). Keep costs 0, Rerole 3, Delete 4
    (blank and duplicate rows have to go), Insert of an empty text 3; truncated rows that stay add
    3. The audit lists the initials of the cheapest edits, the ASCII-least ones of equal cost.

    Null roles and texts count as one space; an empty role is like an unknown one. Rows of a null
    conv_id are one conversation. Null turns come first and have no gaps; rows of one turn are
    taken by role and then by SHA-256 of their text, so repeated rows are neighbours. Further
    columns are ignored; an empty table gives no rows. A conversation passes through one task
    as a stream, since its hash is a sequence; what is held of it is a letter a row.
    """
    rows, plans = _planned(conversations)

    def run(batches):
        convs, digests = [], []
        for conv, audit, mine in _streams(batches):
            digest, first = hashlib.sha256(), True
            for _, _, role, text in repaired(audit, mine):
                digest.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                first = False
            convs.append(conv)
            digests.append(digest.hexdigest())
            if len(convs) == 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(convs, pa.string()), pa.array(digests)], ["conv", "repaired_sha256"])
                convs, digests = [], []
        yield pa.RecordBatch.from_arrays([pa.array(convs, pa.string()), pa.array(digests, pa.string())], ["conv", "repaired_sha256"])

    hashes = _with_plans(rows, plans.select("conv", "audit")).mapInArrow(run, "conv string, repaired_sha256 string").withColumnRenamed("conv", "__conv")
    joined = plans.join(hashes, F.col("conv").eqNullSafe(F.col("__conv")))
    return joined.select(F.col("conv").cast(conversations.schema["conv_id"].dataType).alias("conv_id"), *COUNTS, "cost", "audit", "repaired_sha256")


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """``repair`` of the damaged rows for every original conv_id; one without rows has zeros, no edits and the hash of nothing."""
    told = conversations.select("conv_id").distinct()
    made = repair(damage(conversations)).withColumnRenamed("conv_id", "__conv")
    rows = told.join(made, F.col("conv_id").eqNullSafe(F.col("__conv")), "left")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    empty: Column = F.lit(hashlib.sha256().hexdigest())
    return rows.select("conv_id", *[zero(c) for c in (*COUNTS, "cost")], F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", empty).alias("repaired_sha256"))


def _edits(state: int) -> str:
    """SQL: the best of deleting, keeping and reroling the row in ``state``, as (cost, audit, lines)."""
    none = "{'c': 1000000000, 'a': '', 't': CAST([] AS VARCHAR[])}"
    edit = lambda to, cost, letter, line: f"{{'c': d{to}.c + {cost}, 'a': '{letter}' || d{to}.a, 't': list_prepend({line}, d{to}.t)}}"
    keeps = " ".join(f"WHEN NOT gone AND initial = '{i}' THEN {edit(to, '3 * cut', 'K', line='line')}" for i, to in TAKES[state].items())
    need = NEEDS[state]
    turned = f"CASE WHEN NOT gone THEN {edit(TAKES[state][need], '3 + 3 * cut', 'R', f"'{ROLES[need]}:' || text")} ELSE {none} END"
    return f"least({{'c': d{state}.c + 4, 'a': 'D' || d{state}.a, 't': d{state}.t}}, CASE {keeps} ELSE {none} END, {turned})"


def _insert(state: int, of: str) -> str:
    return f"{{'c': {of}.c + 3, 'a': 'I' || {of}.a, 't': list_prepend('{ROLES[NEEDS[state]]}:', {of}.t)}}"


_DONE = "{'c': 0, 'a': '', 't': CAST([] AS VARCHAR[])}"
_WHITE = r"regexp_replace(text, '[\x20\x09-\x0D]+$', '')"
ORACLE = f"""
WITH RECURSIVE {CRC_TABLE},
fates AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS fate
  FROM conversations, crc_table),
hurt AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role, unnest(CASE WHEN fate = 3 THEN [0, 1] ELSE [0] END) AS copy,
    CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM fates WHERE fate <> 0),
seen AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again, {_WHITE} AS bare FROM hurt),
told AS (
  SELECT *, bare = '' AS blank, bare <> '' AND again AS twice, bare <> '' AND NOT again AND right(bare, 1) NOT IN ('.', '!', '?') AS short, left(role, 1) AS initial FROM seen),
placed AS (
  SELECT *, blank OR twice AS gone, CAST(short AS BIGINT) AS cut, role || ':' || text AS line,
    row_number() OVER w AS i, lag(initial) OVER w || initial AS step
  FROM told WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), again)),
counts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank,
    count(*) FILTER (WHERE twice) AS duplicate, count(*) FILTER (WHERE short) AS truncated,
    count(*) FILTER (WHERE step NOT IN ('su', 'ua', 'au')) AS illegal
  FROM placed GROUP BY conv_id),
dp(conv_id, i, d0, d1, d2, d3) AS (
  SELECT conv_id, n + 1, {_DONE}, {{'c': 6, 'a': 'II', 't': ['user:', 'assistant:']}}, {{'c': 3, 'a': 'I', 't': ['assistant:']}}, {_DONE} FROM counts
  UNION ALL
  SELECT conv_id, i, least(e0, {_insert(0, "e2")}, {_insert(0, _insert(2, "e3"))}), least(e1, {_insert(1, "e2")}, {_insert(1, _insert(2, "e3"))}),
    least(e2, {_insert(2, "e3")}), least(e3, {_insert(3, "e2")})
  FROM (
    SELECT dp.conv_id, p.i, {", ".join(f"{_edits(s)} AS e{s}" for s in range(4))}
    FROM dp JOIN placed p ON dp.conv_id IS NOT DISTINCT FROM p.conv_id AND p.i = dp.i - 1))
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(d0.c, 0) AS cost, coalesce(d0.a, '') AS audit, sha256(coalesce(array_to_string(d0.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON o.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN (SELECT * FROM dp WHERE i = 1) r ON o.conv_id IS NOT DISTINCT FROM r.conv_id
"""
