from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from conftest import rows
from pyspark.sql import functions as F

from tillroll.operators.checks import Check, run_checks
from tillroll.operators.running_checks import add_landing, report
from tillroll.sources.commits import read_version

SUITE = [
    Check("unique", "orders", "order_id"), Check("not_null", "orders", "order_id"),
    Check("relationships", "orders", "customer", "customers", "name"), Check("not_null", "orders", "customer"),
    Check("unique", "customers", "name"), Check("not_null", "customers", "name"), Check("unique", "customers", "day"),
]


def landing(spark, low, high):
    orders = spark.range(low, high).selectExpr(
        "case when id % 50 = 3 then null when id % 50 = 4 then id - 40 else id end as order_id",
        "case when id % 3 = 0 then 'hot' when id % 17 = 1 then null else concat('c', id % 40) end as customer",
    )
    customers = spark.range(low, high).where("id % 5 = 0").selectExpr(
        "if(id % 30 = 0, null, concat('c', id % 35)) as name", "date'2024-01-01' + cast(id % 90 as int) as day"
    )
    return {"orders": orders, "customers": customers}


def test_landings_add_up_to_checks_from_scratch(spark, tmp_path):
    root, parts = str(tmp_path), []
    assert report(spark, root, SUITE).agg(F.sum("failures")).first()[0] == 0
    for low, high in ((0, 100), (100, 130), (130, 400)):
        parts.append(landing(spark, low, high))
        add_landing(spark, root, parts[-1], SUITE, buckets=7)
        whole = {t: parts[0][t] for t in parts[0]}
        for more in parts[1:]:
            whole = {t: whole[t].unionByName(more[t]) for t in whole}
        assert rows(report(spark, root, SUITE)) == rows(run_checks(whole, SUITE))
    assert report(spark, root, SUITE).where("failures > 0").count() == len(SUITE)


def test_a_late_parent_clears_its_children(spark, tmp_path):
    root = str(tmp_path)
    orders = spark.createDataFrame([(1, "a"), (2, "b")], "order_id long, customer string")
    add_landing(spark, root, {"orders": orders}, SUITE)
    orphans = report(spark, root, SUITE).where("test = 'relationships'")
    assert orphans.first()["failures"] == 2
    add_landing(spark, root, {"customers": spark.createDataFrame([("a", None)], "name string, day date")}, SUITE)
    assert report(spark, root, SUITE).where("test = 'relationships'").first()["failures"] == 1


def test_a_landing_reads_and_writes_its_own_buckets_alone(spark, tmp_path):
    root = str(tmp_path)
    first = add_landing(spark, root, landing(spark, 0, 400), SUITE, buckets=64)
    one = {"orders": spark.createDataFrame([(5000, "hot")], "order_id long, customer string")}
    second = add_landing(spark, root, one, SUITE)
    before, after = first.note["buckets"], second.note["buckets"]
    moved = [b for b in after if after[b] != before.get(b)]
    assert len(before) > 50 and 1 <= len(moved) <= 2
    assert {after[b] for b in after if b not in moved} <= set(before.values())


def test_landings_at_once(spark, tmp_path):
    root = str(tmp_path)
    parts = [landing(spark, 40 * i, 40 * i + 40) for i in range(3)]
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda p: add_landing(spark, root, p, SUITE, buckets=4), parts))
    whole = landing(spark, 0, 120)
    assert read_version(spark, root).number == 3
    assert rows(report(spark, root, SUITE)) == rows(run_checks(whole, SUITE))


def test_a_new_store_takes_a_landing_as_counted(spark, tmp_path):
    root = str(tmp_path)
    first = add_landing(spark, root, landing(spark, 0, 400), SUITE, buckets=4)
    assert {p.name for p in tmp_path.glob("data-*")} == set(first.folders) and len(first.folders) == 2
    second = add_landing(spark, root, landing(spark, 300, 700), SUITE, buckets=4)
    # One folder of the landing, one of it merged with the stored buckets, one of totals.
    assert len(list(tmp_path.glob("data-*"))) == 2 + 3 and len(second.folders) == 2
