"""Address keys, upsert and the incremental ingest on small fixtures."""

import hashlib

import pytest
from pyspark.sql import DataFrameWriter

import __spark_entry__
from pairtrace import graph_catalog
from pairtrace.functions import shared
from pairtrace.operators import property_graph as pg
from pairtrace.sources import manifest
from pairtrace.sources.trips import trips
from pairtrace.streaming import ingest
from pairtrace.streaming.ingest import incremental_ingest

SCHEMA = "order_id string, driver_id string, customer_id string, order_status string, order_time_local_tz string"


def test_address_keys_fold_wide_and_accented_text(spark):
    rows = [("HCM", "Quận 1", "12  ＡＢ Straße"), ("hcm", "quận 1", "12 ab strasse"), ("HCM", "D1", "A  b"), ("HCM", "D1", " "), (None, None, None)]
    found = {r.address: r.address_key for r in pg.address_keys(spark.createDataFrame(rows, "province_name string, district_name string, address string")).collect()}
    assert found["12  ＡＢ Straße"] == found["12 ab strasse"] and len(found) == 3
    assert found["A  b"] == hashlib.sha1(b"hcm|d1|a b").hexdigest()


def test_upsert_counts_and_keeps_the_first_of_a_batch(spark):
    old = spark.createDataFrame([("a", 1), ("b", 1)], "order_id string, v int")
    batch = spark.createDataFrame([("b", 3), ("b", 2), ("c", 5), (" ", 9), (None, 9)], "order_id string, v int")
    merged, counters = pg.upsert_orders(old, batch, ["v"])
    assert sorted(map(tuple, merged.collect())) == [("a", 1), ("b", 2), ("c", 5)]
    assert dict(map(tuple, counters.collect())) == {"new": 1, "updated": 1, "valid": 2, "processed": 5}


def test_incremental_ingest_merges_new_files_once(spark, tmp_path):
    source, table, check = (str(tmp_path / n) for n in ("in", "table", "check"))
    load = lambda rows: spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(source)
    run = lambda: incremental_ingest(spark, source, table, check, SCHEMA).awaitTermination()
    load([("a", "d1", "c1", "COMPLETED", "1"), ("b", "d1", "c1", "completed", "1"), (" ", "d1", "c1", "COMPLETED", "1")])
    run()
    load([("b", "d2", "c1", "COMPLETED", "2"), ("c", "d3", "c1", "CANCELLED", "2")])
    run()
    run()
    rows = {r.order_id: (r.driver_id, r.is_completed) for r in ingest.read_table(spark, table).collect()}
    assert rows == {"a": ("d1", True), "b": ("d2", True), "c": ("d3", False)}


def test_batches_are_appended_and_merged_by_size(spark, tmp_path, monkeypatch):
    """A batch writes its own segment; four of a tier become one; batches that come again change nothing."""
    table, counts = str(tmp_path / "table"), str(tmp_path / "counts")
    batch = lambda n, rows: spark.createDataFrame([(f"o{i:05d}", f"d{n}", f"c{i}", "COMPLETED", str(n)) for i in rows], SCHEMA)
    put = lambda n, rows: ingest.merge_batch(batch(n, rows), table, n, list(ingest.FIRST), counts)
    put(0, range(4_000))
    monkeypatch.setattr(ingest, "TIER_BYTES", manifest.latest(spark, table)["segments"][0]["bytes"] // 8)
    first = manifest.latest(spark, table)["segments"][0]
    seen, written = {first["path"]}, []
    for n in range(1, 12):
        put(n, range(n * 50, n * 50 + 60))
        put(n, range(10))  # the same batch again, whatever it holds
        state = manifest.latest(spark, table)
        written.append(sum(s["bytes"] for s in state["segments"] if s["path"] not in seen))
        seen |= {s["path"] for s in state["segments"]}
        assert state["segments"][0] == first and len(state["segments"]) <= 1 + 2 * (ingest.FANOUT - 1)
    assert all(w < first["bytes"] / 3 for w in written)
    spans = [(s["low"], s["high"]) for s in manifest.latest(spark, table)["segments"]]
    assert [n for low, high in spans for n in range(low, high + 1)] == list(range(12)) and 3 <= len(spans) < 12
    want = {f"o{i:05d}": 0 for i in range(4_000)} | {f"o{i:05d}": n for n in range(1, 12) for i in range(n * 50, n * 50 + 60)}
    rows = ingest.read_table(spark, table)
    assert {r.order_id: int(r.driver_id[1:]) for r in rows.collect()} == want and rows.count() == len(want)
    counted = {(r.batch, r.metric): r.value for r in spark.read.parquet(counts).collect()}
    assert counted[0, "new"] == 4_000 and counted[3, "updated"] == 60 and counted[3, "valid"] == counted[3, "processed"] == 60 and len(counted) == 12 * 4
    left = set(manifest.children(spark, f"{table}/segments"))
    put(12, [])
    assert left >= {s["path"].rpartition("/")[2] for s in manifest.latest(spark, table)["segments"]} and len(left) <= 6 + ingest.FANOUT


def test_segments_take_new_columns_and_refuse_new_types(spark, tmp_path):
    table = str(tmp_path / "table")
    ingest.merge_batch(spark.createDataFrame([("a", "d", "c", "COMPLETED", "1")], SCHEMA), table, 0, list(ingest.FIRST))
    ingest.merge_batch(spark.createDataFrame([("b", "d", "c", "COMPLETED", "2", 5)], SCHEMA + ", gmv int"), table, 1, list(ingest.FIRST))
    assert {r.order_id: r.gmv for r in ingest.read_table(spark, table).collect()} == {"a": None, "b": 5}
    with pytest.raises(ValueError, match="gmv"):
        ingest.merge_batch(spark.createDataFrame([("b", "d", "c", "COMPLETED", "2", "5")], SCHEMA + ", gmv string"), table, 2, list(ingest.FIRST))
    with pytest.raises(ValueError, match="nothing"):
        ingest.read_table(spark, str(tmp_path / "none"))


def test_ingest_writes_and_shuffles_a_batch_once(spark, tmp_path, monkeypatch):
    """No copy of the batch beside its segment, one shuffle of wide rows, by ranges; reading few columns leaves the others unread."""
    table, plans, copies = str(tmp_path / "table"), [], []
    write, fresh = DataFrameWriter.parquet, shared.fresh_path
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda w, path, *a, **k: plans.append(w._df._jdf.queryExecution().executedPlan().toString()) or write(w, path, *a, **k))
    monkeypatch.setattr(shared, "fresh_path", lambda spark, name: copies.append(name) or fresh(spark, name))
    monkeypatch.setattr(ingest, "RANGE_ROWS", 300, raising=False)
    for n in range(5):
        rows = [(f" o{i % 400:03d}", f"d{n}", f"c{i:04d}", " COMPLETED", str(n)) for i in range(n * 10, n * 10 + 900)] + [(" ", "d", "c", "x", "0"), (None, "d", "c", "x", "0")]
        ingest.merge_batch(spark.createDataFrame(rows, SCHEMA), table, n, list(ingest.FIRST))
    assert not copies and len(plans) == 6  # five segments, and four that were merged
    assert all(p.count("Exchange ") == 1 and "Exchange rangepartitioning(order_id" in p for p in plans)
    segments = manifest.latest(spark, table)["segments"]
    assert [(s["low"], s["high"]) for s in segments] == [(0, 3), (4, 4)]
    files = [[r.order_id for r in spark.read.parquet(f).select("order_id").collect()] for f in sorted(spark.read.parquet(segments[0]["path"]).inputFiles())]
    assert len(files) > 1 and [i for f in files for i in f] == [f"o{i:03d}" for i in range(400)]
    read = ingest.read_table(spark, table).select("order_id", "driver_id")
    assert sorted(map(tuple, read.collect())) == [(f"o{i:03d}", "d4") for i in range(400)]
    assert "customer_id" not in read._jdf.queryExecution().executedPlan().toString()
    whole = {r.order_id: r for r in ingest.read_table(spark, table).collect()}
    assert whole["o039"].customer_id == "c0439" and whole["o040"].customer_id == "c0040" and whole["o040"].is_completed and whole["o040"].domain == "ride"


def test_ingest_counters_write_arrivals_segments_and_counts_alone(spark, monkeypatch):
    """Both arrivals from one join, two segments, two parts of counts; a batch of many rows makes no more ranges than named."""
    plans, write = {}, DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda w, path, *a, **k: plans.update({(len(plans), path): w._df._jdf.queryExecution().executedPlan().toString()}) or write(w, path, *a, **k))
    monkeypatch.setattr(ingest, "RANGE_ROWS", 10, raising=False)
    monkeypatch.setattr(ingest, "MOST_RANGES", 5, raising=False)
    got = {(r.batch, r.metric): r.value for r in __spark_entry__.queries()["ingest_counters"](spark, __spark_entry__.SMOKE_DIR).collect()}
    assert [path.rpartition("pairtrace-")[2].split("/")[1].split("-")[1] for _, path in plans] == ["aside", "table", "counts", "table", "counts"]
    assert "Sort [arrival" not in next(iter(plans.values())) and spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
    assert all("ASC NULLS FIRST, 5)" in plan for (_, path), plan in plans.items() if "/segments/" in path)
    old, new = (t.select("order_id") for t in graph_catalog._HALVES(trips(spark, __spark_entry__.SMOKE_DIR)))
    ids, known = new.distinct(), old.distinct()
    updated = ids.intersect(known).count()
    assert got == {(0, "new"): known.count(), (0, "updated"): 0, (0, "valid"): known.count(), (0, "processed"): old.count()} | {
        (1, "new"): ids.count() - updated, (1, "updated"): updated, (1, "valid"): ids.count(), (1, "processed"): new.count()
    }


def test_arrivals_are_the_halves_and_may_be_empty(spark):
    days = spark.sql("SELECT string(id) AS order_id, date_add(DATE '1994-12-01', int(id)) AS order_date FROM range(0, 800, 20) UNION ALL SELECT 'none', NULL")
    for df in (days, days.filter("order_date > '1996-01-10'"), days.limit(0)):
        for folder, half in zip(graph_catalog._arrivals(spark, df), graph_catalog._HALVES(df), strict=True):
            assert sorted(map(tuple, spark.read.parquet(folder).collect())) == sorted(map(tuple, half.collect()))


def test_component_subgraph_and_paths_take_all_orders(spark):
    flags = spark.createDataFrame([("c1", f"o{i:04d}") for i in range(450)] * 2 + [("c2", "x1")], "component_id string, order_id string")
    edges = [("PAID_BY", f"o{i:04d}", "card") for i in range(450)] + [("PICKUP_AT", f"o{i:04d}", "late") for i in range(400, 450)] + [("PAID_BY", "x1", "card"), ("USED_PROMO", "o0449", "once")]
    edges += [(t, who, f"o{i:04d}") for i in range(450) for t, who in (("PLACED", "cust"), ("SERVED", f"d{i % 3}"))] + [("PLACED", "cust", "x1")]
    edges = spark.createDataFrame(edges, "type string, src string, dst string")
    assert sorted(map(tuple, pg.component_subgraph(flags, edges).collect())) == [("c1", "PAID_BY", "card", 450), ("c1", "PICKUP_AT", "late", 50)]
    assert sorted(map(tuple, pg.component_paths(flags, edges).collect())) == sorted(("c1", "cust", f"o{i:04d}", f"d{i % 3}") for i in range(450))


def test_component_subgraph_lists_core_paths_and_every_pair(spark, monkeypatch):
    """Core paths and pairs of orders, the lesser id first, of ends with one block and with many; other components' orders and single ends make none."""
    monkeypatch.setattr(pg, "PAIR_BLOCK", 40, raising=False)
    monkeypatch.setattr(pg, "PAIRS_A_TASK", 9_000, raising=False)
    of = {f"o{i}": ("c1",) if i < 250 else ("c2", "c3") if i < 256 else () for i in range(260)}
    ends = [("PAID_BY", o, "card") for o in of] + [("PICKUP_AT", o, f"a{i // 3}") for i, o in enumerate(of)] + [("DROPOFF_AT", o, "a1") for o in ("o0", "o7", "o255")] + [("USES_SERVICE", o, "svc") for o in of]
    core = [e for i, o in enumerate(of) for e in (("PLACED", f"cust{i % 4}", o), ("SERVED", f"d{i % 9}", o))] + [("PLACED", "cust9", "o5")]
    flags = spark.createDataFrame([(c, o) for o, found in of.items() for c in found] * 2, "component_id string, order_id string")
    want = [(c, "CORE", who, o, by) for t, who, o in core if t == "PLACED" for s, by, at in core if s == "SERVED" and at == o for c in of[o]]
    used = [e for e in ends if e[0] in pg.INFRASTRUCTURE]
    want += [(c, t, o, end, p) for t, o, end in used for u, p, same in used if (t, end) == (u, same) and o < p for c in of[o] if c in of[p]]
    got = pg.component_subgraph_paths(flags, spark.createDataFrame(ends + core, "type string, src string, dst string"))
    assert got.columns == ["component_id", "type", "src", "via", "dst"] and sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 31_000
    counted = pg.component_subgraph(flags, spark.createDataFrame(ends, "type string, src string, dst string"))
    assert sum(r.orders * (r.orders - 1) // 2 for r in counted.collect()) == sum(w[1] != "CORE" for w in want)
    pairs = pg._sharing_pairs(flags, spark.createDataFrame(ends, "type string, src string, dst string"))
    assert "SortMergeJoin" in pairs._jdf.queryExecution().executedPlan().toString() and pairs.rdd.getNumPartitions() == 4
    assert __spark_entry__.queries()["component_subgraph"](spark, __spark_entry__.SMOKE_DIR).columns == got.columns
