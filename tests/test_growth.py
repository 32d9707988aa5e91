"""What the detection shuffles, sorts and writes at size: places voted for as numbers, flags that are not written."""

import random

from pyspark.sql import functions as F

from pairtrace.config import PairConfig, RuleConfig, ShortlistConfig
from pairtrace.functions.expr import PAIR_KEY
from pairtrace.operators import pairs, rules
from pairtrace.plans.detection import Detection
from tests.test_detection import order, table


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pair_base_sorts_no_pairs(spark):
    """Same modal places as by comparing texts, ties, nulls and empty texts included, from hashed groups alone."""
    rnd = random.Random(18)
    texts = (None, "", "a", "b", "B", "é", "a|b")
    rows = [("w" if rnd.random() < 0.9 else "v", f"d{rnd.randrange(9)}", f"c{rnd.randrange(9)}", rnd.choice(texts), rnd.choice(texts), rnd.random() < 0.3) for _ in range(1_500)]
    active = spark.createDataFrame(rows, "window_id string, driver_id string, customer_id string, service_name string, pickup_province_name string, is_ghost boolean")
    base = pairs.pair_base(active)
    got = {tuple(r[c] for c in PAIR_KEY): (r.n_trips, r.n_orders, r.n_ghost, r.top_service_name, r.top_pickup_province_name) for r in base.collect()}
    want = {}
    for *pair, service, province, ghost in rows:
        want.setdefault(tuple(pair), []).append((service, province, ghost))
    rank = lambda votes: lambda p: (-votes[p], p[0] is None, (p[0] or "").encode(), p[1] is None, (p[1] or "").encode())
    for pair, votes in want.items():
        counts = {}
        for v in votes:
            counts[v[:2]] = counts.get(v[:2], 0) + 1
        want[pair] = (len(votes), len(votes), sum(v[2] for v in votes), *min(counts, key=rank(counts)))
    assert got == want
    assert "HashAggregate" in _plan(base) and "SortAggregate" not in _plan(base)


def test_reports_read_few_columns_of_flags(spark, monkeypatch):
    """Flags are joined for the columns of a report: no table of their hundred columns is written first."""
    written = []
    real = pairs.materialize
    for module in ("pairtrace.plans.detection", "pairtrace.operators.pairs"):
        monkeypatch.setattr(f"{module}.materialize", lambda df, name: written.append(name) or real(df, name))
    rows = [order(f"o{i}", "d1", "c1", f"2026-07-14T10:{i:02d}:00") for i in range(6)] + [order("p", "d2", "c2", "2026-07-14T11:00:00", kmh=30.0)]
    found = Detection(
        table(spark, rows), PairConfig(extreme_trip_quantile=0.5), ShortlistConfig(3, 0.5, 35, 0.3, 0.3, 0.3),
        RuleConfig(high_ghost_rate=0.3, superfast_gap_min=5, min_pair_trips_for_share_rule=3, dominant_route_share=0.5, min_high_confidence_trips=3, min_superfast_trips=3),
    )
    summary = rules.daily_flag_summary(found.flags)
    assert [(r.flagged_orders, r.flagged_customers, r.total_gmv) for r in summary.collect()] == [(6, 1, 72000.0)]
    assert "pair-reasons" in written and "flagged-orders" not in written
    assert "volume_score" not in _plan(summary) and "flag_reason" not in _plan(summary)
    assert found.flags.select(F.countDistinct("order_id")).first()[0] == 6 and found.flags.filter("evidence.n_trips <> 6").isEmpty()
