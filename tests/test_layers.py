"""Layer storage, the warehouse sink's settings, the staged run and its gate."""

import pytest
from pyspark.sql import functions as F

from stratamart.plans.gold import gold_from_tables
from stratamart.plans.ledger import Ledger
from stratamart.plans.quality import DataQualityError
from stratamart.plans.reports import REPORTS
from stratamart.plans.run import (
    Lake,
    publish_to_layer,
    publish_to_warehouse,
    run,
    stored_gold,
    warehouse_gold,
)
from stratamart.registry import faults
from stratamart.registry.queries import clean_gold
from stratamart.sources import tpch
from stratamart.sources.csv import ingest, write_csv
from stratamart.sources.jdbc import IncompleteLoadError, JdbcTarget
from stratamart.sources.layers import (
    Layer,
    children,
    new_version,
    remove,
    remove_scratch,
    row_counts,
    scratch_directory,
)
from stratamart.sources.session import session_conf
from stratamart.specs import GOLD_TABLES, LOADED_AT, METADATA_COLUMNS, PROCESSED_AT, SOURCES
from tests.conftest import TESTDATA

SF_DIR = f"{TESTDATA}/sf0.001"


def same_rows(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.fixture(scope="module")
def finished(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    lake = Lake.under(root)
    published = Layer(f"{root}/published")
    counts = run(spark, tpch.sources(spark, SF_DIR), lake, publish_to_layer(published))
    return lake, published, counts


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_write_replaces_rows_and_schema_and_counts(spark, tmp_path, fmt):
    layer = Layer(str(tmp_path), fmt)
    assert layer.write(spark.range(10), "t") == 10
    second = spark.range(3).select(F.col("id").alias("other"))
    assert layer.write(second, "t", stamp=LOADED_AT) == 3
    back = layer.read(spark, "t")
    assert set(back.columns) == {"other", LOADED_AT} and back.count() == 3
    assert row_counts(spark, {"t": 3}).collect() == [("t", 3)]


def test_catalog_layer(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS lake_gold")
    layer = Layer("lake_gold", catalog=True)
    for n in (4, 2):
        assert layer.write(spark.range(n), "t") == n
    assert layer.read(spark, "t").count() == 2
    spark.sql("DROP SCHEMA lake_gold CASCADE")


def test_partitioned_layout_prunes(spark, tmp_path):
    layer = Layer(str(tmp_path))
    payments = tpch.order_payments(spark, SF_DIR)
    layer.write(payments, "p", partition_by=["payment_type"])
    back = layer.read(spark, "p")
    assert same_rows(back.select(payments.columns), payments)
    one = back.filter("payment_type = '1-URGENT'")
    assert "PartitionFilters: [isnotnull" in one._jdf.queryExecution().executedPlan().toString()


def test_scratch_is_under_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    a, b = scratch_directory(spark), scratch_directory(spark)
    assert a.startswith(shared) and b.startswith(shared) and a != b


def test_run_writes_every_stage(spark, finished):
    lake, published, counts = finished
    assert list(counts) == ["bronze", "silver", "gold", "published"]
    assert set(counts["bronze"]) == set(counts["silver"]) == set(SOURCES)
    assert set(counts["gold"]) == set(GOLD_TABLES) and counts["published"] == counts["gold"]
    assert PROCESSED_AT in lake.silver.read(spark, "orders").columns
    for name in GOLD_TABLES:
        assert LOADED_AT in published.read(spark, name).columns
        assert published.read(spark, name).count() == counts["gold"][name]


def test_run_twice_gives_equal_tables(spark, finished):
    lake, _, counts = finished
    before = {n: df.collect() for n, df in stored_gold(spark, lake).tables().items()}
    layout = {"fact_order_items": ["order_date_id"]}
    again = run(spark, tpch.sources(spark, SF_DIR), lake, gate_silver=True, layout=layout)
    assert again["gold"] == counts["gold"]
    for name, df in stored_gold(spark, lake).tables().items():
        columns = before[name][0].asDict()
        assert sorted(map(str, df.select(*columns).collect())) == sorted(map(str, before[name]))


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_reports_agree_on_stored_and_lazy_gold(spark, finished, name):
    lake, _, _ = finished
    lazy = REPORTS[name](clean_gold(spark, SF_DIR)).collect()
    assert REPORTS[name](stored_gold(spark, lake)).collect() == lazy


def test_failed_check_blocks_publishing(spark, tmp_path):
    called = []
    with pytest.raises(DataQualityError):
        run(
            spark,
            faults.sources(spark, SF_DIR),
            Lake.under(str(tmp_path)),
            publish=lambda *_: called.append(1),
        )
    assert not called


def test_bronze_gate_stops_before_cleaning(spark, tmp_path):
    lake = Lake.under(str(tmp_path))
    sources = dict(tpch.sources(spark, SF_DIR)) | {"order_reviews": faults.score_text(spark, SF_DIR)}
    with pytest.raises(DataQualityError, match="review_score"):
        run(spark, sources, lake, gate_bronze=True)
    assert not (tmp_path / "silver").exists()


def test_jdbc_settings():
    target = JdbcTarget("jdbc:x", "u", "p", "d", connections=4, batch_size=5, truncate=True)
    assert target.write_options("t") == {
        "url": "jdbc:x",
        "user": "u",
        "password": "p",
        "driver": "d",
        "dbtable": "t",
        "numPartitions": "4",
        "batchsize": "5",
        "truncate": "true",
    }
    assert JdbcTarget("jdbc:x").connection() == {"url": "jdbc:x"}


def test_warehouse_publisher_verifies_counts(spark, monkeypatch):
    """No database here: writing and counting are replaced, the order and check are real."""
    written = []
    monkeypatch.setattr(JdbcTarget, "write", lambda self, df, table: written.append(table))
    monkeypatch.setattr(JdbcTarget, "count", lambda self, spark, table: 2)
    publish = publish_to_warehouse(JdbcTarget("jdbc:x"))
    assert publish(spark, {"a": None, "b": None}, {"a": 2, "b": 2}) == {"a": 2, "b": 2}
    assert written == ["a", "b"]
    with pytest.raises(IncompleteLoadError):
        publish(spark, {"a": None}, {"a": 1})


def test_reports_read_the_warehouse(spark, finished, monkeypatch):
    lake, published, _ = finished
    monkeypatch.setattr(JdbcTarget, "read", lambda self, spark, table, *bounds: published.read(spark, table))
    gold = warehouse_gold(spark, JdbcTarget("jdbc:x"))
    for name in ("q03_top_sellers", "kpi_totals"):
        assert REPORTS[name](gold).collect() == REPORTS[name](stored_gold(spark, lake)).collect()


def test_session_settings():
    plain = session_conf()
    assert plain["spark.sql.ansi.enabled"] == "true" and "spark.jars" not in plain
    full = session_conf(delta=True, jars=["a.jar", "b.jar"], conf={"spark.sql.ansi.enabled": "false"})
    assert full["spark.jars"] == "a.jar,b.jar" and full["spark.sql.ansi.enabled"] == "false"
    assert "io.delta" in full["spark.sql.extensions"]


def test_metadata_names_are_distinct():
    assert len(set(METADATA_COLUMNS)) == 5


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    layer = Layer(str(tmp_path))
    layer.write(spark.range(5).toDF("id"), "t")
    broken = spark.range(100).select(F.expr("IF(id = 99, raise_error('lost'), id)").cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        layer.write(broken, "t")
    assert layer.read(spark, "t").count() == 5
    layer.write(spark.range(7).toDF("id"), "t", version="next")
    assert layer.read(spark, "t").count() == 5 and layer.read(spark, "t", "next").count() == 7
    layer.commit(spark, ["t"], "next")
    assert layer.read(spark, "t").count() == 7


def test_facts_are_read_over_several_connections(spark, monkeypatch):
    asked = {}
    days = spark.createDataFrame([(20170101,), (20181231,)], "date_id int")

    def read(self, spark, table, *bounds):
        asked[table] = bounds
        return days

    monkeypatch.setattr(JdbcTarget, "read", read)
    gold = warehouse_gold(spark, JdbcTarget("jdbc:x"), {"fact_payments": ("payment_sequential", 1, 9)})
    for name in ("fact_order_items", "fact_reviews", "fact_payments", "dim_seller"):
        gold[name]
    assert asked["fact_order_items"] == ("order_date_id", 20170101, 20181231)
    assert asked["fact_reviews"] == ("review_date_id", 20170101, 20181231)
    assert asked["fact_payments"] == ("payment_sequential", 1, 9) and asked["dim_seller"] == ()


def numbers(spark, n):
    return spark.range(n).toDF("id")


def test_tables_are_published_together(spark, tmp_path):
    """A reader who opened a layer keeps its tables, whatever is written and published since."""
    layer = Layer(str(tmp_path))
    layer.write_all({"a": numbers(spark, 1), "b": numbers(spark, 1)})
    layer.write(numbers(spark, 9), "c")
    held = layer.read_all(spark, ["a", "b", "c"])
    assert held["a"].count() == 1
    layer.write(numbers(spark, 2), "a", version="v")
    layer.write(numbers(spark, 2), "b", version="v")
    assert [layer.read(spark, t).count() for t in "abc"] == [1, 1, 9]
    layer.commit(spark, ["a", "b"], "v")
    assert [layer.read(spark, t).count() for t in "abc"] == [2, 2, 9]
    assert [held[t].count() for t in "abc"] == [1, 1, 9]
    assert [s.number for s in layer.snapshots(spark)] == [3, 2, 1]
    with pytest.raises(ValueError, match="no published version of d"):
        layer.read(spark, "d")


def test_a_commit_that_died_is_passed_over(spark, tmp_path):
    layer = Layer(str(tmp_path))
    layer.write(numbers(spark, 3), "t")
    (tmp_path / "snapshots" / "number=2").mkdir()  # as a writer leaves it who is lost before its file
    assert layer.snapshot(spark).number == 1 and layer.read(spark, "t").count() == 3
    layer.write(numbers(spark, 4), "t")
    assert layer.snapshot(spark).number == 3 and layer.read(spark, "t").count() == 4


def test_retention_keeps_what_kept_snapshots_name(spark, tmp_path):
    layer = Layer(str(tmp_path))
    layer.write(numbers(spark, 7), "once")
    for n in (1, 2, 3):
        layer.write(numbers(spark, n), "t")
    before = layer.read_all(spark, ["once", "t"])
    layer.write(numbers(spark, 4), "t")
    layer.write(numbers(spark, 5), "t", version=new_version())  # of a run that failed
    removed = layer.retain(spark, 2)
    assert {t: len(v) for t, v in removed.items()} == {"once": 0, "t": 3}
    assert (before["once"].count(), before["t"].count(), layer.read(spark, "t").count()) == (7, 3, 4)
    assert len(layer.versions(spark, "t")) == 2 and len(layer.snapshots(spark)) == 2
    assert layer.retain(spark, 2) == {"once": [], "t": []}
    with pytest.raises(ValueError):
        layer.retain(spark, 0)


def test_scratch_of_this_application_is_removed(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    numbers(spark, 1).write.parquet(scratch_directory(spark))
    (other := f"{shared}/stratamart-other-application-x")
    numbers(spark, 1).write.parquet(other)
    assert remove_scratch(spark) >= 1
    assert children(spark, shared).count("stratamart-other-application-x") == 1
    assert remove_scratch(spark) == 0 and children(spark, other + "/none") == []


def test_a_run_goes_on_where_inputs_changed(spark, tmp_path):
    lake = Lake.under(str(tmp_path / "lake"))
    sources = dict(tpch.sources(spark, SF_DIR))

    def go(sources, **settings):
        ledger = Ledger(str(tmp_path / "ledger"))
        counts = run(spark, sources, lake, ledger=ledger, **settings)
        assert set(counts["gold"]) == set(GOLD_TABLES)
        made = {(stage, table) for stage, table, _ in ledger.made}
        assert len(made) + len(ledger.skipped) == 2 * len(SOURCES) + len(GOLD_TABLES)
        return made, counts

    first, counts = go(sources)
    assert len(first) == 2 * len(SOURCES) + len(GOLD_TABLES)
    assert go(sources) == (set(), counts)
    other = sources | {"sellers": sources["sellers"].filter("seller_id > 3")}
    layout = {"fact_payments": ["payment_type"]}
    made, fewer = go(sources, layout=layout)
    assert made == {("gold", "fact_payments")} and fewer == counts
    with pytest.raises(DataQualityError, match="seller_id"):  # items refer to what is gone
        go(other, layout=layout)
    assert stored_gold(spark, lake)["dim_seller"].count() == counts["gold"]["dim_seller"]
    made, _ = go(sources, keep=1, layout=layout)
    assert made == {("bronze", "sellers"), ("silver", "sellers"), ("gold", "dim_seller")}
    assert all(len(lake.gold.versions(spark, t)) == 1 for t in GOLD_TABLES)
    # a version that is gone is made again
    remove(spark, f"{lake.gold.location}/dim_date")
    made, _ = go(sources, layout=layout)
    assert made == {("gold", "dim_date")}


def test_a_damaged_drop_stops_a_run_by_default(spark, tmp_path):
    drop = tmp_path / "drop"
    for name, df in tpch.sources(spark, SF_DIR).items():
        write_csv(df, f"{drop}/{SOURCES[name].file_pattern.replace('*', 'x_')}")
    place = next(drop.glob("*reviews*"))
    part = next(place.glob("part-*.csv"))
    lines = part.read_text().splitlines()
    damaged = tmp_path / "reviews.csv"
    damaged.write_text("\n".join([lines[0], lines[1] + ",shifted", *lines[2:]]) + "\n")
    sources = ingest(spark, str(drop), {"order_reviews": str(damaged)})
    with pytest.raises(DataQualityError, match="order_reviews.*well_formed"):
        run(spark, sources, Lake.under(str(tmp_path / "lake")))
    counts = run(spark, sources, Lake.under(str(tmp_path / "lake")), gate_bronze=False)
    assert counts["silver"]["order_reviews"] == counts["bronze"]["order_reviews"] - 1


def test_bucketed_facts_meet_without_a_shuffle(spark, finished):
    lake, _, _ = finished
    spark.sql("CREATE SCHEMA IF NOT EXISTS bucketed_gold")
    layer = Layer("bucketed_gold", catalog=True)
    gold = stored_gold(spark, lake)
    facts = {n: gold[n] for n in ("fact_order_items", "fact_reviews")}
    layer.write_all(facts, buckets=dict.fromkeys(facts, (4, ["order_id"])))
    layer.write(gold["dim_product"], "dim_product")
    stored = gold_from_tables(layer.read_all(spark, [*facts, "dim_product"]), co_partitioned=True)
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        for name in ("q06_category_reviews", "q09_worst_products"):
            report = REPORTS[name](stored)
            assert report.collect() == REPORTS[name](gold).collect()
            plan = report._jdf.queryExecution().executedPlan().toString()
            plan = plan[plan.index("== Final Plan ==") : plan.index("== Initial Plan ==")]
            # one exchange by product above the facts, one of the products, one of the result
            by_order = [line for line in plan.splitlines() if "Exchange hashpartitioning(order_id" in line]
            assert not by_order and plan.count("Bucketed: true") == 2, plan
    finally:
        spark.conf.set(key, before)
        spark.sql("DROP SCHEMA bucketed_gold CASCADE")
    with pytest.raises(ValueError, match="catalog"):
        lake.gold.write(gold["dim_seller"], "x", buckets=(2, ["seller_id"]))


def test_parquet_layers_are_compressed_by_zstd(spark, tmp_path):
    def endings(layer):
        layer.write(spark.range(3), "t")
        return {f.name.split(".", 1)[1] for f in (tmp_path / layer.location.rsplit("/", 1)[-1]).rglob("part-*.parquet")}

    plain, own = Layer(f"{tmp_path}/plain"), Layer(f"{tmp_path}/own", options={"compression": "snappy"})
    assert endings(plain) == {"zstd.parquet"} and endings(own) == {"snappy.parquet"}
    assert plain.read(spark, "t").count() == 3
