"""The written edge index reads its nodes' buckets only; flags are refreshed from what changed."""

import random

from pairtrace.operators import property_graph as pg
from pairtrace.operators.adjacency import AdjacencyIndex, seed_orders


def graph(spark, orders=400):
    rnd = random.Random(4)
    rows = [(f"o{i}", f"d{rnd.randrange(9)}", f"c{rnd.randrange(30)}", f"pay{rnd.randrange(20)}", f"place{rnd.randrange(50)}") for i in range(orders)]
    edges = [e for o, d, c, p, a in rows for e in (("SERVED", d, o), ("PLACED", c, o), ("PAID_BY", o, p), ("PICKUP_AT", o, a), ("USES_SERVICE", o, "bike"))]
    return spark.createDataFrame([r[:3] for r in rows], "order_id string, driver_id string, customer_id string"), spark.createDataFrame(edges, "type string, src string, dst string")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_lookups_read_their_buckets_only(spark, tmp_path):
    orders, edges = graph(spark)
    index = AdjacencyIndex.write(edges, str(tmp_path / "index"), 16)
    nodes = lambda *names: spark.createDataFrame([(n,) for n in names], "node string")
    for end, find in (("src", index.leaving), ("dst", index.reaching)):
        for names in (("o7", "d3"), ("bike", None), ("nobody",), ()):
            found = find(nodes(*names))
            assert rows(found) == rows(edges.filter(edges[end].isin([n for n in names if n])).select("type", "src", "dst"))
    found = index.leaving(nodes("o7"))
    assert found.count() == 3
    found.collect()
    assert 0 < _files_read(found) < len(spark.read.parquet(f"{index.path}/src").inputFiles())
    degrees = {(r.type, r.dst): r.degree for r in index.degrees(nodes("bike", "pay3", "o1")).collect()}
    assert degrees["USES_SERVICE", "bike"] == 400 and degrees["SERVED", "o1"] == 1 and degrees["PAID_BY", "pay3"] == edges.filter("type = 'PAID_BY' AND dst = 'pay3'").count()


def _files_read(df):
    """Files that the scans of an executed plan read, by its metrics."""
    plan, total, todo = df._jdf.queryExecution().executedPlan(), 0, []
    todo.append(plan)
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            todo.append(node.plan())
            continue
        if node.getClass().getSimpleName() == "FileSourceScanExec":
            total += node.metrics().apply("numFiles").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


def test_patterns_from_the_index_equal_those_of_all_edges(spark, tmp_path):
    orders, edges = graph(spark)
    index = AdjacencyIndex.write(edges, str(tmp_path / "index"), 8)
    seeds = orders.filter("driver_id = 'd1'").select("driver_id", "customer_id").limit(3)
    seeds = spark.createDataFrame(seeds.collect(), seeds.schema)
    mine = seed_orders(orders, seeds, "driver_id", "customer_id")
    assert rows(index.shared_infrastructure(mine)) == rows(pg.shared_infrastructure(edges, mine))
    assert rows(index.pair_infrastructure(orders, seeds)) == rows(pg.pair_infrastructure(orders, edges, seeds))
    assert rows(index.infrastructure_orders(orders, seeds)) == rows(pg.infrastructure_orders(orders, edges, seeds))
    assert rows(pg.pair_history(orders, index.at_orders(mine), seeds)) == rows(pg.pair_history(orders, edges, seeds))
    assert rows(pg.order_neighborhood(index.at_orders(mine), mine)) == rows(pg.order_neighborhood(edges, mine))


def test_members_come_from_the_smaller_list(spark):
    orders, _ = graph(spark)
    seeds = spark.createDataFrame([("d1", "c1"), ("d1", "c2"), ("d2", "c1"), ("d9", "c1")], "driver_id string, customer_id string")
    met = {tuple(r) for r in orders.select("driver_id", "customer_id").collect()}
    of = lambda d: {c for x, c in met if x == d}
    drivers = {d for d, _ in met}
    want = {(d, c, o, s) for d, c in map(tuple, seeds.collect()) for o in drivers if o != d and (o, c) in met for s in of(d) & of(o) if s != c}
    got = pg.shared_customers(orders, seeds)
    assert {tuple(r) for r in got.collect()} == want
    bound = {r.driver_id: r.most_members for r in pg.shared_customer_estimate(orders, seeds).collect()}
    others = {d: {o for e, c in map(tuple, seeds.collect()) if e == d for o in drivers if o != d and (o, c) in met} for d in ("d1", "d2", "d9")}
    assert bound == {d: sum(min(len(of(d)), len(of(o))) for o in os) for d, os in others.items() if of(d)}


def test_refreshed_flags_equal_a_rebuild(spark):
    orders, _ = graph(spark, 120)
    orders = orders.unionAll(orders.limit(30))  # repeated rows of an order count once
    marks = lambda *r: spark.createDataFrame(list(r), "order_id string, priority_score double, risk_tier string")
    runs = [marks(), marks(("o1", 50.0, "MONITOR"), ("o2", 60.0, "MONITOR"), ("o3", None, None)), marks(("o2", 60.0, "HIGH_RISK"), ("o3", None, None), ("o9", 1.0, "LOW_PRIORITY"), ("x", 2.0, "MONITOR")), marks()]
    known = {a: pg.actor_flags(orders, runs[0], a) for a in ("driver", "customer")}
    nodes = pg.flag_orders(orders, runs[0])
    for before, after in zip(runs, runs[1:], strict=False):
        changes = pg.flag_changes(before, after)
        nodes = pg.apply_flag_changes(nodes, changes)
        assert rows(nodes.select("order_id", "is_flagged", "priority_score", "risk_tier")) == rows(pg.flag_orders(orders, after).select("order_id", "is_flagged", "priority_score", "risk_tier"))
        for actor in known:
            known[actor] = pg.refresh_actor_flags(known[actor], orders, changes, actor)
            assert rows(known[actor]) == rows(pg.actor_flags(orders, after, actor))
    assert rows(pg.flag_changes(runs[1], runs[2]).select("order_id", "change")) == [("o1", "removed"), ("o2", "changed"), ("o9", "added"), ("x", "added")]
