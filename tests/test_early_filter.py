from pyspark.sql import functions as F

from pairtrace.functions.membership import maybe_in, written_filter
from pairtrace.operators import pairs
from pairtrace.operators import property_graph as pg


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def joined(spark):
    """Orders that are a join; only the right side has the customers, only the left one the ids."""
    left = spark.range(2_000).select((F.col("id") % 1_900).alias("k"), F.col("id").alias("n"))
    right = spark.range(1_900).select(F.col("id").alias("k2"), (F.col("id") % 40).alias("c"), (F.col("id") % 9).alias("d"))
    return left.join(right.hint("merge"), F.expr("k = k2")).select(
        F.lit("w").alias("window_id"), F.concat(F.lit("d"), "d").alias("driver_id"), F.when(F.col("c") > 0, F.concat(F.lit("c"), "c")).alias("customer_id"), F.concat(F.lit("o"), "n").alias("order_id")
    )


def test_filter_is_tested_before_the_join_and_loses_no_key(spark):
    table = joined(spark)
    keys = spark.createDataFrame([(f"o{i * 7}",) for i in range(200)] + [(None,)], "order_id string")
    kept = table.filter(maybe_in(written_filter(keys, ["order_id"]), ["order_id"]))
    found = {r.order_id for r in kept.collect()}
    assert {f"o{i * 7}" for i in range(200)} <= found and len(found) < 250
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("scalar-subquery")
    assert maybe_rows(table, [(None,)], "customer_id") == table.filter("customer_id IS NULL").count()


def maybe_rows(table, keys, column):
    written = written_filter(table.sparkSession.createDataFrame(keys, f"{column} string"), [column], words=1)
    strict = written_filter(table.sparkSession.createDataFrame(keys, f"{column} string"), [column])
    few = table.filter(maybe_in(strict, [column])).count()
    assert table.filter(maybe_in(written, [column], words=1)).count() >= few
    return few


def test_candidates_by_ids_are_those_of_the_plain_form(spark):
    active = joined(spark).filter("customer_id IS NOT NULL")
    some = active.select("window_id", "driver_id", "customer_id").distinct().filter("driver_id IN ('d1', 'd4') AND customer_id <> 'c7'")
    plain = rows(pairs.candidate_orders(active, some))
    assert plain and rows(pairs.candidate_orders(active, some, active)) == plain


def test_edges_shuffle_place_texts_and_match_those_of_keys(spark):
    table = spark.createDataFrame([
        (i % 5, f"d{i}", f"c{i % 2}", "prov", "x  Y", f" Phố\t{i % 3} ", "P|1", None, f"b {i}" if i % 4 else " ", "pm", None) for i in range(12)
    ], "order_id long, driver_id string, customer_id string, pickup_province_name string, pickup_district_name string, pickup_address string, last_dropoff_province_name string, "
       "last_dropoff_district_name string, last_dropoff_address string, payment_method string, promotion_code string")  # fmt: skip
    types = ("PLACED", "SERVED", "PICKUP_AT", "DROPOFF_AT", "PAID_BY", "USED_PROMO")
    made = pg.graph_edges(table, types)
    assert rows(made) == rows(pg.graph_edges(pg.with_address_keys(table), types)) and len(rows(made)) == made.distinct().count()
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.index("sha1") < plan.index("Exchange hashpartitioning(order_id")  # the keys are made behind the shuffle


def test_place_texts_of_plain_and_spaced_ascii_have_the_keys_of_python(spark):
    import hashlib

    texts = ["A1", " A1", "a1 ", "A  1", "A\t1", "A\x001", "A|1", "Á 1", "", None]
    table = spark.createDataFrame([("Prov", "D  1", t) for t in texts], "province_name string, district_name string, address string")
    found = {r.address: r.address_key for r in pg.address_keys(table).collect()}
    key = lambda t: hashlib.sha1("|".join(" ".join(p.replace("\0", " ").casefold().split()) for p in ("Prov", "D  1", t)).encode()).hexdigest()
    assert found == {t: key(t) for t in texts if t and t.strip()}
