"""Sinks, stored tables, filters and the shared folder."""

import os
import threading
from concurrent.futures import ThreadPoolExecutor
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from wardstone import session as W
from wardstone.operators.scoring import score_encounters
from wardstone.plans.catalog import QUERIES
from wardstone.plans.tables import encounters
from wardstone.sources import encounters as E
from wardstone.sources import folders, orders_fixture
from wardstone.sources.orders_fixture import encounters as derived

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(str(tuple(r)) for r in df.collect())


def test_model_ready_csv_round_trip(spark):
    table = QUERIES["model_ready"](spark, SF)
    path = W.scratch_path(spark, "model_ready_csv")
    E.write_csv(table, path)
    assert rows(spark.read.schema(table.schema).option("header", True).csv(path)) == rows(table)


def test_stored_table_equals_derivation(spark):
    assert rows(encounters(spark, SF)) == rows(derived(spark, SF))


def test_partitioned_parquet_round_trip(spark):
    path = W.scratch_path(spark, "by_year")
    dated = encounters(spark, SF).withColumn("year", F.year("encounter_ts"))
    E.write_parquet(dated, path, partition_by=["year"])
    back = E.read_encounters_parquet(spark, path)
    assert rows(back.drop("year")) == rows(encounters(spark, SF))


def test_create_if_absent_keeps_the_first_table(spark):
    path = W.scratch_path(spark, "once")
    E.create_if_absent(spark.range(3), path)
    assert E.create_if_absent(spark.range(9), path).count() == 3


def test_an_unmarked_table_survives(spark):
    """No success mark, as other writers leave it."""
    path = W.scratch_path(spark, "unmarked")
    spark.range(10).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    assert not os.path.exists(f"{path}/_SUCCESS")
    assert E.create_if_absent(spark.range(3), path).count() == 10


def test_a_partitioned_table_survives(spark):
    path = W.scratch_path(spark, "partitioned")
    spark.range(10).withColumn("_k", F.col("id") % 2).write.partitionBy("_k").parquet(path)
    assert E.create_if_absent(spark.range(3), path).count() == 10


@pytest.mark.parametrize("left", ["_temporary/0/part-0", "_SUCCESS", None])
def test_what_a_dead_writer_left_is_moved_aside(spark, left):
    path = W.scratch_path(spark, "dead")
    os.makedirs(f"{path}/{os.path.dirname(left or '')}")
    if left:
        open(f"{path}/{left}", "w").close()
    assert E.create_if_absent(spark.range(3), path).count() == 3
    parent, name = os.path.split(path)
    aside = [f for f in os.listdir(parent) if f.startswith(f"_{name}.left-")]
    assert len(aside) == 1 and (not left or os.path.exists(f"{parent}/{aside[0]}/{left}"))


def test_racing_writers_leave_one_whole_table(spark):
    path = W.scratch_path(spark, "race")
    sizes = [1000 + i for i in range(6)]
    barrier = threading.Barrier(len(sizes))
    found = {}

    def write(n):
        staged = folders.beside(path, "stage")
        spark.range(n).write.parquet(staged)
        barrier.wait()  # all rows are written before any is published
        won = folders.publish(spark, staged, path)
        found[n] = won, spark.read.parquet(path).count()

    threads = [threading.Thread(target=write, args=(n,)) for n in sizes]
    [t.start() for t in threads]
    [t.join() for t in threads]
    winners = [n for n, (won, _) in found.items() if won]
    assert len(winners) == 1 and {count for _, count in found.values()} == set(winners)
    assert spark.read.parquet(path).count() == winners[0]
    assert not [f for f in os.listdir(os.path.dirname(path)) if "race" in f and "stage" in f]


def test_racing_creations_of_a_catalog_table(spark):
    name = "raced_table"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    found = []
    with ThreadPoolExecutor(4) as pool:
        found = list(pool.map(lambda n: E.create_table_if_absent(spark.range(n), name).count(), [11, 12, 13, 14]))
    assert len(set(found)) == 1 and found[0] in (11, 12, 13, 14)
    assert E.create_table_if_absent(spark.range(99), name).count() == found[0]
    spark.sql(f"DROP TABLE {name}")


def test_filters_compose(spark):
    scored = score_encounters(encounters(spark, SF))
    got = E.filter_encounters(scored, ages=["[60-70)"], admission_types=[1], tiers=["High"], start="1994-01-01")
    for r in got.collect():
        assert (r["age"], r["admission_type_id"], r["tier"]) == ("[60-70)", 1, "High") and r["encounter_ts"].year >= 1994
    assert E.filter_encounters(scored).count() == scored.count()


def test_filters_reach_the_scan(spark):
    plan = E.filter_encounters(encounters(spark, SF), ages=["[60-70)"], dispositions=[1, 3])._jdf.queryExecution().toString()
    pushed = plan[plan.index("PushedFilters") :]
    assert "In(age" in pushed or "EqualTo(age" in pushed
    assert "discharge_disposition_id" in pushed[: pushed.index("]")]


def test_ad_hoc_sql(spark):
    E.register_view(encounters(spark, SF), "stays")
    assert spark.sql("SELECT count(*) AS n FROM stays").first()["n"] == encounters(spark, SF).count()


def _session(configured, master, app):
    context = SimpleNamespace(master=master, applicationId=app, getCheckpointDir=lambda: None)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: configured), sparkContext=context)


def test_shared_folder_comes_from_the_session(spark):
    assert W.shared_dir(_session("/some/shared/place/", "yarn", "a")) == "/some/shared/place"
    with pytest.raises(RuntimeError):
        W.shared_dir(_session(None, "yarn", "b"))
    local = _session(None, "local[2]", "c")
    assert W.shared_dir(local) == W.shared_dir(local)


@pytest.mark.parametrize("names", [["a", "b", "c"]])
def test_alignment_fills_and_orders(spark, names):
    from wardstone.operators.scoring import align_features

    row = align_features(spark.createDataFrame([(5, 7)], ["c", "a"]), names).first()
    assert row.asDict() == {"a": 7, "b": 0, "c": 5} and row.__fields__ == names


def test_lines_are_counted_in_parts_that_follow_their_number(spark, monkeypatch):
    monkeypatch.setattr(orders_fixture, "LINES_PER_PART", 100)
    lines = [(None if i % 50 == 0 else i % 300, i % 7 if i % 11 else None, float(i % 5)) for i in range(1000)]
    counted = orders_fixture.order_items(spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_quantity double"))
    assert counted.rdd.getNumPartitions() == 10
    expected = {}
    for order, part, quantity in lines:
        n, total, parts = expected.get(order, (0, 0, set()))
        expected[order] = (n + 1, total + int(quantity), parts | ({part} - {None}))
    assert {r["l_orderkey"]: (r["n_items"], r["qty"], r["n_parts"]) for r in counted.collect()} == {k: (n, q, len(p)) for k, (n, q, p) in expected.items()}
