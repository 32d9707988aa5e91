"""Order sources and result sinks on small files."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pairtrace.sources import manifest, orders


def test_orders_of_a_folder_get_missing_columns_and_windows(spark, tmp_path):
    folder = str(tmp_path / "days")
    spark.createDataFrame([("o1", "d1", float("nan"))], "order_id string, driver_id string, gmv double").coalesce(1).write.mode("append").parquet(folder)
    spark.createDataFrame([("o2", "c2", 5.0)], "order_id string, customer_id string, gmv double").coalesce(1).write.mode("append").parquet(folder)
    found = orders.read_orders(spark, folder)
    assert set(orders.ORDER_TYPES) <= set(found.columns)
    rows = {r.order_id: (r.driver_id, r.customer_id, r.gmv) for r in found.collect()}
    assert rows == {"o1": ("d1", None, None), "o2": (None, "c2", 5.0)}
    assert found.select("window_id").distinct().count() == 2


def test_listed_files_may_disagree_on_types(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    spark.createDataFrame([("o1", "2026-07-14T10:00:00", "2026-07-14")], "order_id string, order_time_local_tz string, order_date string").write.parquet(a)
    spark.createDataFrame([("o2", 0, "no number")], "order_id string, order_time_local_tz long, gmv string").write.parquet(b)
    found = {r.order_id: r for r in orders.read_orders(spark, [a, b], window_from="date").collect()}
    assert found["o1"].order_time_local_tz == dt.datetime(2026, 7, 14, 10) and found["o1"].window_id == "2026-07-14"
    assert found["o2"].order_date == dt.date(1970, 1, 1) and found["o2"].gmv is None


def test_csv_orders_and_known_pairs(spark, tmp_path):
    (tmp_path / "orders.csv").write_text("order_id,gmv,order_time_local_tz,is_now_order\no1,12.5,2026-07-14 10:00:00,true\no2,bad,bad,bad\n")
    rows = {r.order_id: (r.gmv, r.order_date, r.is_now_order) for r in orders.read_orders_csv(spark, str(tmp_path / "orders.csv")).collect()}
    assert rows == {"o1": (12.5, dt.date(2026, 7, 14), True), "o2": (None, None, None)}
    (tmp_path / "known.csv").write_text("customer_id,driver_id,note\nc1,d1,x\n")
    assert [tuple(r) for r in orders.read_known_pairs(spark, str(tmp_path / "known.csv")).collect()] == [("d1", "c1")]
    none = orders.read_known_pairs(spark, None)
    assert none.columns == ["driver_id", "customer_id"] and none.count() == 0


def test_results_are_written_and_read_again(spark, tmp_path):
    flags = spark.createDataFrame([("o1", "w1"), ("o2", "w2")], "order_id string, window_id string")
    pairs = spark.range(2).select(F.col("id").alias("pair"), F.struct(F.col("id").alias("n")).alias("evidence"))
    folder = str(tmp_path / "out")
    for _ in range(2):
        orders.write_outputs({"flagged_orders": flags, "pair_summary": pairs, "pair_reasons": pairs.limit(0)}, folder)
    found = orders.read_reports(spark, folder)
    assert found["flagged_orders"].count() == 2 and {r.evidence for r in found["pair_summary"].collect()} == {'{"n":0}', '{"n":1}'}
    assert all(df.count() == 0 for df in orders.read_reports(spark, str(tmp_path / "nowhere")).values())


def report_tables(spark, driver="007"):
    flags = spark.createDataFrame([("o1", "2026-07-14", driver, dt.datetime(2026, 7, 14, 10), 1.5), ("o2", "2026-07-15", driver, None, None)], "order_id string, window_id string, driver_id string, complete_time_local_tz timestamp_ntz, gmv double")
    rows = [("2026-07-14", driver, "1e5", 'said "yes", then\nleft', dt.date(2026, 7, 14), 3, True), ("2026-07-14", driver, "", None, None, None, None)]
    pairs = spark.createDataFrame(rows, "window_id string, driver_id string, customer_id string, note string, latest_order_date date, n_trips long, high boolean").withColumn("evidence", F.struct("note", "n_trips"))
    return {"flagged_orders": flags, "pair_summary": pairs, "pair_reasons": pairs.drop("evidence")}


def test_reports_come_back_as_they_were_written(spark, tmp_path):
    folder = str(tmp_path / "out")
    given = report_tables(spark)
    orders.write_outputs(given, folder)
    found = orders.read_reports(spark, folder)
    for name, df in given.items():
        assert dict(found[name].dtypes) == {c: "string" if c == "evidence" else t for c, t in df.dtypes}, name
    order = lambda df, cs: sorted(map(str, df.select(*cs).collect()))
    assert order(found["flagged_orders"], given["flagged_orders"].columns) == order(given["flagged_orders"], given["flagged_orders"].columns)
    blank_null = given["pair_reasons"].withColumn("customer_id", F.nullif("customer_id", F.lit("")))
    assert order(found["pair_reasons"], blank_null.columns) == order(blank_null, blank_null.columns)
    joined = found["flagged_orders"].join(found["pair_summary"], ["window_id", "driver_id"]).filter("driver_id = '007'")
    assert joined.count() == 2
    one = orders.read_reports(spark, folder, window_id="2026-07-15")["flagged_orders"]
    assert [r.order_id for r in one.collect()] == ["o2"] and len({r[0] for r in one.select("_metadata.file_path").collect()}) == 1
    assert "PartitionFilters: [isnotnull(window_id" in one._jdf.queryExecution().toString()


def test_an_interrupted_run_leaves_the_set_before(spark, tmp_path):
    folder = str(tmp_path / "out")
    orders.write_outputs(report_tables(spark), folder)
    broken = report_tables(spark, "008")
    broken["pair_reasons"] = broken["pair_reasons"].withColumn("n_trips", F.raise_error(F.lit("stopped")).cast("long"))
    with pytest.raises(Exception, match="stopped"):
        orders.write_outputs(broken, folder)
    assert all({r.driver_id for r in df.collect()} == {"007"} for df in orders.read_reports(spark, folder).values())
    for driver in ("009", "010", "011"):
        orders.write_outputs(report_tables(spark, driver), folder)
    assert all({r.driver_id for r in df.collect()} == {"011"} for df in orders.read_reports(spark, folder).values())
    assert len(manifest.children(spark, f"{folder}/manifests")) == 2 and len(manifest.latest(spark, folder)["runs"]) == 2


def test_window_from_the_date_needs_no_file_name(spark, tmp_path):
    spark.createDataFrame([("o1", dt.date(2026, 7, 14))], "order_id string, order_date date").write.parquet(str(tmp_path / "one"))
    assert orders.read_orders(spark, str(tmp_path / "one"), window_from="date").first().window_id == "2026-07-14"
    with pytest.raises(Exception, match="(?i)path"):
        orders.read_orders(spark, str(tmp_path / "absent"))
