from __future__ import annotations

import datetime as dt
import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tillroll import schemas, session
from tillroll.session import object_store_conf, scratch_path
from tillroll.sources import commits, landing, tables
from tillroll.streaming.incremental import append_new, finish, stage_new

DAY, NEXT = dt.date(2024, 6, 1), dt.date(2024, 6, 2)


@pytest.fixture()
def orders(spark):
    data = [(1, 10, DAY, "completed", 0.1), (2, None, None, "cancelled", 1e7 + 0.25)]
    return spark.createDataFrame(data, schemas.ORDERS)


def test_csv_round_trip_keeps_text(spark, tmp_path):
    texts = [' two\nlines, "quoted" ', "comma, here", "tab\t", '"', "\\", "", None, "é"]
    reviews = spark.createDataFrame(
        [(i, 1, 1, 1, DAY, 3, t, "none") for i, t in enumerate(texts)], schemas.REVIEWS
    )
    landing.land_raw(reviews, str(tmp_path), "reviews", DAY)
    back = landing.read_raw(spark, str(tmp_path), "reviews")
    got = [r["review_text"] for r in back.orderBy("review_id").collect()]
    # A CSV file has no other mark for an empty text than for a missing one.
    assert [t or None for t in got] == [t or None for t in texts]


def test_line_breaks_in_any_text_of_any_entity(spark, tmp_path):
    for entity, schema in schemas.RAW_ENTITIES.items():
        texts = [f.name for f in schema if f.dataType.simpleString() == "string"]
        row = {f.name: 'a\nb, "c"\r\nd' if f.name in texts else None for f in schema}
        df = spark.createDataFrame([tuple(row.values())] * 2, schema)
        landing.land_raw(df, str(tmp_path), entity, DAY)
        assert rows(landing.read_raw(spark, str(tmp_path), entity).drop("dt")) == rows(df)


@pytest.mark.parametrize("bad", ["X2,1,2024-06-01,completed,1.0", "2,1,June,completed,1.0", "2,1", "2,1,2024-06-01,completed,much"])
def test_rows_that_do_not_fit_are_counted_and_kept(spark, tmp_path, bad):
    folder = tmp_path / "in" / "orders" / "dt=2024-06-01"
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text(f"order_id,customer_id,order_date,status,order_total\n1,1,2024-06-01,completed,1.0\n{bad}\n")
    with pytest.raises(Exception):  # noqa: B017 - Spark's own error
        landing.read_raw(spark, str(tmp_path / "in"), "orders").collect()
    with pytest.raises(landing.RejectedRows, match="'orders': 1"):
        landing.load_bronze(spark, str(tmp_path / "in"), str(tmp_path / "out"), ["orders"])
    assert spark.read.parquet(str(tmp_path / "out" / "rejects" / "orders")).first()["_rejected"] == bad
    assert spark.read.parquet(str(tmp_path / "out" / "raw" / "orders")).count() == 1


def test_landing_replaces_its_own_day_only(spark, tmp_path, orders):
    root = str(tmp_path)
    landing.land_raw(orders, root, "orders", DAY)
    landing.land_raw(orders.limit(1), root, "orders", NEXT)
    landing.land_raw(orders.limit(1), root, "orders", NEXT)
    counts = landing.read_raw(spark, root, "orders").groupBy("dt").count()
    assert rows(counts) == [(DAY, 2), (NEXT, 1)]
    assert sorted(os.listdir(tmp_path / "orders"))[-2:] == ["dt=2024-06-01", "dt=2024-06-02"]


def test_newest_landing_by_date_and_by_file_time(spark, tmp_path, orders):
    root = str(tmp_path)
    assert landing.latest_dt(spark, root, "orders") is None
    assert landing.latest_partition(spark, root, "orders") is None
    (tmp_path / "orders").mkdir()
    assert landing.latest_dt(spark, root, "orders") is None
    landing.land_raw(orders, root, "orders", NEXT)
    landing.land_raw(orders.limit(1), root, "orders", DAY)
    (tmp_path / "orders" / "dt=__HIVE_DEFAULT_PARTITION__").mkdir()
    assert landing.landed_days(spark, root, "orders") == ["2024-06-01", "2024-06-02"]
    for path in (tmp_path / "orders" / "dt=2024-06-02").iterdir():
        os.utime(path, (1_000_000, 1_000_000))
    assert landing.latest_dt(spark, root, "orders") == "2024-06-02"
    assert landing.latest_dt(spark, root, "orders", by="mtime") == "2024-06-01"
    newest = landing.latest_partition(spark, root, "orders")
    assert newest.count() == 2
    assert {f.split("/")[-2] for f in newest.inputFiles()} == {"dt=2024-06-02"}
    assert rows(newest.select("dt").distinct()) == [(NEXT,)]
    one_day = landing.read_raw(spark, root, "orders").where(F.col("dt") == DAY)
    assert "PartitionFilters: [isnotnull(dt" in one_day._jdf.queryExecution().toString()


def test_schema_inference_is_an_option(spark, tmp_path, orders):
    landing.land_raw(orders, str(tmp_path), "things", DAY)
    got = landing.read_raw(spark, str(tmp_path), "things")
    assert dict(got.dtypes)["order_total"] == "double" and got.count() == 2


def test_load_skips_what_is_not_there(spark, tmp_path, orders):
    land, store = str(tmp_path / "landing"), str(tmp_path / "store")
    landing.land_raw(orders, land, "orders", DAY)
    load = landing.load_bronze(spark, land, store)
    assert load.skipped == ["customers", "products", "order_items", "reviews"]
    assert load.rows == {"orders": 2}
    assert rows(load.tables["orders"]) == rows(orders)
    landing.land_raw(orders.limit(1), land, "orders", NEXT)
    assert landing.load_bronze(spark, land, store).rows == {"orders": 1}
    assert tables.read_table(spark, store, "raw", "orders").count() == 1


def test_large_files_without_broken_lines_are_split(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "LOOK_FROM", 20_000)
    folder = tmp_path / "products" / "dt=2024-06-01"
    folder.mkdir(parents=True)
    head = "product_id,product_name,category,cost,price\n"
    plain = [f'{i},"cup, ""no. {i}""",Home,1.5,{i}.25\n' for i in range(4000)]
    broken = [f'{10_000 + i},"cup\nno. {i}",Home,1.5,2.5\n' for i in range(1000)]
    stray = [f'{20_000 + i},5" plate,Home,1.5,2.5\n' for i in range(1000)]
    small = [f'{30_000 + i},"a\nb",Home,1.5,2.5\n' for i in range(9)]
    for name, part in {"plain": plain, "bro ken": broken, "stray": stray, "small": small}.items():
        (folder / f"{name}.csv").write_text(head + "".join(part))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        found = landing.read_raw(spark, str(tmp_path), "products")
        names = {r["product_id"]: r["product_name"] for r in found.collect()}
        assert len(names) == found.count() == 6009 and found.where("price is null or dt is null").count() == 0
        assert names[7] == 'cup, "no. 7"' and names[10_005] == "cup\nno. 5" and names[20_001] == '5" plate' and names[30_000] == "a\nb"
        of_file = {}
        for r in found.select(F.spark_partition_id().alias("p"), (F.col("product_id") / 10_000).cast("int").alias("file")).distinct().collect():
            of_file.setdefault(r["file"], set()).add(r["p"])
        assert len(of_file[0]) > 4 and len(of_file[1]) == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize(
    ("line", "whole"),
    [("", True), ("a,b,", True), ('"a","b ""c"", d",e', True), ('"a', False), ('a","b', False), ('a"b, "c', False), ('"a"b', False), ('""', True), ('"""', False)],
)
def test_whole_records(spark, line, whole):
    one = spark.createDataFrame([(line,)], "value string")
    assert one.select(F.col("value").rlike(landing.WHOLE_RECORD)).first()[0] is whole


def test_rows_of_single_keys_are_not_grouped(spark, monkeypatch):
    df = spark.range(1000).selectExpr("if(id < 990, id, 5) as k", "concat('t', id) as text", "id as n")
    expected = [(i, "t5" if i == 5 else f"t{i}", i) for i in range(990)]
    for most in (1, 0):
        monkeypatch.setattr(tables, "REPEATED_KEYS", most)
        assert rows(tables.one_per_key(df, "k")) == expected
    monkeypatch.setattr(tables, "REPEATED_KEYS", 10)
    single = tables.one_per_key(df.where("k != 5"), "k")
    plan = single._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Exchange" not in plan


def test_other_formats_can_be_landed(spark, tmp_path, orders):
    landing.land_raw(orders, str(tmp_path), "orders", DAY, fmt="parquet")
    got = landing.latest_partition(spark, str(tmp_path), "orders", fmt="parquet")
    assert rows(got.drop("dt")) == rows(orders)


def test_layer_names(spark, tmp_path, orders):
    assert tables.table_path("/r/", "gold", "t") == "/r/gold/t"
    assert tables.table_path("/r", None, "t") == "/r/main/t"
    stored = tables.write_table(orders, str(tmp_path), "gold", "orders", partition_by=["status"])
    assert rows(stored.select(*orders.columns)) == rows(orders)


def test_registered_tables_are_known_to_sql(spark, tmp_path, orders):
    tables.write_table(orders, str(tmp_path), "gold_test", "orders")
    tables.register_layer(spark, str(tmp_path), "gold_test", ["orders"])
    assert spark.sql("select count(*) from gold_test.orders").first()[0] == 2
    spark.sql("drop database gold_test cascade")


def test_append_is_idempotent_and_keeps_one_row_per_key(spark, tmp_path):
    path = str(tmp_path / "enrichment")
    schema = schemas.REVIEW_ENRICHMENT
    assert tables.read_or_empty(spark, path, schema).count() == 0
    first = spark.createDataFrame(
        [
            (1, "negative", "none", "low"),
            (2, "b", "none", "low"),
            (2, "a", "x", "low"),
            (None, "a", "b", "c"),
        ],
        schema,
    )
    want = [(1, "negative", "none", "low"), (2, "a", "x", "low")]
    assert rows(append_new(first, path, schema, "review_id")) == want
    assert rows(append_new(first, path, schema, "review_id")) == want
    more = spark.createDataFrame([(2, "a", "a", "a"), (3, "p", "none", "low")], schema)
    assert rows(append_new(more, path, schema, "review_id")) == [*want, (3, "p", "none", "low")]


def answers(spark, low, high, mark):
    return spark.range(low, high).selectExpr("id as review_id", f"'{mark}' as sentiment", "'none' as issue_type", "'low' as urgency")


def test_the_writer_that_loses_checks_its_keys(spark, tmp_path):
    path, schema = str(tmp_path / "enrichment"), schemas.REVIEW_ENRICHMENT
    append_new(answers(spark, 0, 5, "old"), path, schema, "review_id")
    a = stage_new(answers(spark, 0, 20, "a"), path, schema, "review_id")
    b = stage_new(answers(spark, 10, 30, "b"), path, schema, "review_id")
    c = stage_new(answers(spark, 40, 45, "c"), path, schema, "review_id")
    before = commits.read_table_version(spark, path, schema)
    finish(a, spark)
    assert before.count() == 5  # readers keep the version they opened
    finish(c, spark)
    stored = {r["review_id"]: r["sentiment"] for r in finish(b, spark).collect()}
    assert stored == {i: "old" if i < 5 else "a" if i < 20 else "b" if i < 30 else "c" for i in [*range(30), *range(40, 45)]}
    assert commits.read_version(spark, path).number == 4
    assert commits.read_table_version(spark, path, schema).count() == 35
    assert commits.read_table_version(spark, path, schema, commits.read_version(spark, path, 2)).count() == 20


def test_writers_at_once_store_each_key_once(spark, tmp_path):
    path, schema = str(tmp_path / "enrichment"), schemas.REVIEW_ENRICHMENT
    with ThreadPoolExecutor(5) as pool:
        jobs = [pool.submit(append_new, answers(spark, 7 * i, 7 * i + 20, str(i)), path, schema, "review_id") for i in range(5)]
        [job.result() for job in jobs]
    stored = commits.read_table_version(spark, path, schema)
    assert sorted(r["review_id"] for r in stored.collect()) == list(range(48))
    assert commits.version_numbers(spark, path) == [1, 2, 3, 4, 5]
    late = stage_new(answers(spark, 0, 60, "late"), path, schema, "review_id")
    commits.compact(spark, path, schema)
    assert len(commits.read_version(spark, path).folders) == 1
    assert finish(late, spark).count() == 60
    gone = commits.remove_unlisted(spark, path)
    assert gone and commits.read_table_version(spark, path, schema).count() == 60


def test_a_version_is_made_once(spark, tmp_path):
    for path in (str(tmp_path / "a" / "v1"), f"file:{tmp_path}/b/v1"):
        with ThreadPoolExecutor(8) as pool:
            made = list(pool.map(lambda i: commits.create_if_absent(spark, path, f"writer {i}"), range(8)))
        assert sum(made) == 1
        assert spark.read.text(path, wholetext=True).first()[0] == f"writer {made.index(True)}"
    assert sorted(os.listdir(tmp_path / "a")) == ["v1"]
    with pytest.raises(LookupError):
        commits.read_version(spark, str(tmp_path / "a"), 9)
    assert commits.read_version(spark, str(tmp_path / "none")) == commits.Version()


def test_other_file_systems_rename_and_stores_create(spark, tmp_path, monkeypatch):
    class Named:
        """A file system that goes by another scheme."""

        def __init__(self, files, scheme):
            self.files, self.scheme = files, scheme

        def getScheme(self):
            return self.scheme

        def __getattr__(self, name):
            return getattr(self.files, name)

    plain = tables.file_system
    for scheme in ("hdfs", "s3a"):
        monkeypatch.setattr(commits, "file_system", lambda s, p: (Named(plain(s, p)[0], scheme), plain(s, p)[1]))
        path = str(tmp_path / scheme / "v1")
        assert commits.create_if_absent(spark, path, "first") and not commits.create_if_absent(spark, path, "second")
        assert spark.read.text(path, wholetext=True).first()[0] == "first"


def test_load_audit(spark):
    audit = tables.load_audit({"a": spark.range(3), "b": spark.range(0)})
    assert rows(audit) == [("a", 3), ("b", 0)]


def test_scratch_is_under_the_named_folder(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_path(spark, "x")
    assert before is None or path.startswith(before)
    assert path != scratch_path(spark, "x")


def test_a_session_is_left_as_found(spark):
    before = {key: spark.conf.get(key, None) for key in (session.INITIAL_PARTITIONS, session.READ_BYTES)}
    with pytest.raises(KeyError), session.fitted_partitions(spark, 1 << 50):
        assert int(spark.conf.get(session.INITIAL_PARTITIONS)) == session.MAX_SHUFFLE_PARTITIONS
        assert spark.conf.get(session.READ_BYTES) == f"{session.LARGEST_READ}b"
        raise KeyError
    assert {key: spark.conf.get(key, None) for key in before} == before


def test_object_store_options():
    conf = object_store_conf("http://store:9000", "key", "secret")
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"


def test_listing_reads_no_content(spark, tmp_path, orders):
    landing.land_raw(orders.withColumn("pad", F.lit("x" * 1000)), str(tmp_path), "orders", DAY)
    files = spark.read.format("binaryFile").load(str(tmp_path / "orders"))
    for newest in (F.max("dt"), F.max_by("dt", F.struct("modificationTime", "dt"))):
        plan = files.agg(newest)._jdf.queryExecution().executedPlan().toString()
        assert "content" not in plan[plan.index("ReadSchema") :], plan


def test_landing_without_a_day_is_of_today(spark, tmp_path, orders):
    landing.land_raw(orders, str(tmp_path), "orders")
    today = spark.sql("select cast(current_date() as string)").first()[0]
    assert landing.landed_days(spark, str(tmp_path), "orders") == [today]


def test_keys_of_large_inputs_are_not_broadcast_for_their_small_files(spark, tmp_path):
    """Over a large input a table counts as what it takes in memory, not as its compressed file."""
    path = str(tmp_path / "keys")
    spark.range(300_000).select((F.col("id") % 100).alias("k"), "id").write.parquet(path)
    files = tables.path_bytes(spark, path)

    def joined():
        keys = spark.read.parquet(path).select("id")
        return spark.read.parquet(path).join(keys, "id", "left_semi")

    def broadcasts(df) -> bool:
        return "BroadcastHashJoin" in df._jdf.queryExecution().executedPlan().toString()

    before = spark.conf.get(session.FILE_FACTOR)
    with session.setting(spark, session.FILE_FACTOR, "1.0"), session.setting(spark, "spark.sql.autoBroadcastJoinThreshold", str(2 * files)):
        with session.fitted_partitions(spark, 1 << 20):
            assert broadcasts(joined())
        with session.fitted_partitions(spark, 1 << 30):
            large = joined()
            assert not broadcasts(large)
            assert large.count() == 300_000
        assert spark.conf.get(session.FILE_FACTOR) == "1.0"
    assert spark.conf.get(session.FILE_FACTOR) == before
