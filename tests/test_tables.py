from __future__ import annotations

import uuid
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from beaconlake import contracts
from beaconlake.operators import costs, quality
from beaconlake.plans import jobs, materialize, retention, warehouse
from beaconlake.session import run_path
from conftest import as_tuples


@pytest.fixture
def project(spark, tmp_path):
    number = uuid.uuid4().int % 10**12
    yield number, str(tmp_path / "warehouse")
    spark.sql(f"DROP DATABASE IF EXISTS `{warehouse.database_name(number)}` CASCADE")


@pytest.fixture
def database(spark, project):
    return warehouse.create_database(spark, *project)


def test_bootstrap_changes_nothing_the_second_time(spark, project, make_events):
    number, location = project
    first = warehouse.bootstrap(spark, number, location, prefix="acme_")
    assert first["database"] == f"sx_{number}"
    assert warehouse.database_exists(spark, first["database"])
    for name in (*contracts.WAREHOUSE_TABLES, "excluded_referrers"):
        assert warehouse.table_exists(spark, first["database"], name)
    for name in contracts.WAREHOUSE_TABLES:
        assert quality.contract_diff(spark.table(first[name]), contracts.schema(name, "acme_")) == []
        parts = {c.name for c in spark.catalog.listColumns(first[name]) if c.isPartition}
        assert parts == ({"date", "data_source"} if name == "ad_costs" else {"date"})
    assert spark.table(first["excluded_referrers"]).first()["hosts"] == ["https://some-site.com/"]
    events = make_events([{"event_id": "1", "date": "2024-01-01"}]).withColumnRenamed("avid", "acme_avid")
    warehouse.save_rows(spark, events, first["raw_events"])
    assert warehouse.bootstrap(spark, number, location, prefix="acme_") == first
    assert spark.table(first["raw_events"]).count() == 1


def test_a_table_that_exists_is_left_as_it_is(spark, database):
    first = contracts.schema("raw_events")
    warehouse.create_table(spark, database, "t", first)
    warehouse.create_table(spark, database, "t", contracts.schema("identified_events"))
    assert set(spark.table(f"{database}.t").columns) == set(first.names)


def test_database_and_table_descriptions(spark, project):
    name = warehouse.create_database(
        spark, *project, description="it's", default_table_expiration_ms=5, labels={"a": "b"}
    )
    described = {r[0]: r[1] for r in spark.sql(f"DESCRIBE DATABASE EXTENDED `{name}`").collect()}
    assert described["Comment"] == "it's"
    assert "default_table_expiration_ms" in described["Properties"]


def test_overwriting_replaces_only_its_own_partitions(spark, database):
    contract = contracts.schema("ad_costs")
    warehouse.create_table(spark, database, "ad_costs", contract, ("date", "data_source"))
    name = f"{database}.ad_costs"

    def rows(source: str, day: str, cost: float):
        values = {"date": F.lit(day), "data_source": F.lit(source), "cost": F.lit(cost)}
        return spark.range(2).select(
            *[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in contract.fields]
        )

    for source, day, cost in (("a", "2024-01-01", 1.0), ("b", "2024-01-01", 2.0), ("a", "2024-01-02", 3.0)):
        warehouse.save_rows(spark, rows(source, day, cost), name, overwrite=True)
    for _ in range(2):
        warehouse.save_rows(spark, rows("a", "2024-01-01", 9.0).limit(1), name, overwrite=True)
    assert as_tuples(spark.table(name), "data_source", "cost") == [
        ("a", 3.0), ("a", 3.0), ("a", 9.0), ("b", 2.0), ("b", 2.0)
    ]


def _by_day(spark, database, days: int = 10, **options) -> str:
    df = spark.range(days * 10).select(
        F.col("id").alias("n"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % days).cast("int")).alias("date"),
    )
    warehouse.create_table(spark, database, "by_day", df.schema, clustering=("n",), **options)
    warehouse.save_rows(spark, df, f"{database}.by_day")
    return f"{database}.by_day"


def test_partition_guard_and_pruning(spark, database):
    name = _by_day(spark, database, require_partition_filter=True)
    with pytest.raises(ValueError):
        warehouse.read_table(spark, name)
    rows = warehouse.read_table(spark, name, date(2024, 1, 3), date(2024, 1, 4))
    assert rows.count() == 20
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_partitions_expire(spark, database):
    name = _by_day(spark, database, expiration_ms=3 * quality.DAY_MS)
    dropped = retention.expire_partitions(spark, name, date(2024, 1, 10))
    assert len(dropped) == 6
    assert spark.table(name).agg(F.min("date")).first()[0] == date(2024, 1, 7)
    assert retention.expire_partitions(spark, name, date(2024, 1, 10)) == []


@pytest.mark.parametrize("unit, partitions, left", [("HOUR", 50, 30), ("MONTH", 1, 1), ("YEAR", 1, 1), ("DAY", 3, 3)])
def test_partitions_of_every_unit(spark, database, unit, partitions, left):
    start = 1704067200000
    df = spark.range(100).select(
        F.col("id").alias("n"), (F.lit(start) + F.col("id") * 1_800_000).alias("timestamp"),
    ).withColumn("date", F.timestamp_millis("timestamp").cast("date"))
    warehouse.create_table(spark, database, "t", df.schema, unit=unit, expiration_ms=30 * 3_600_000)
    warehouse.save_rows(spark, df, f"{database}.t")
    assert spark.sql(f"SHOW PARTITIONS {database}.t").count() == partitions
    assert spark.table(f"{database}.t").count() == 100
    assert len(retention.expire_partitions(spark, f"{database}.t", datetime(2024, 1, 3, 2))) == partitions - left
    with pytest.raises(ValueError):
        warehouse.create_table(spark, database, "u", df.schema, unit="WEEK")


def test_tables_expire(spark, project):
    name = warehouse.create_database(spark, *project, default_table_expiration_ms=1000)
    warehouse.create_table(spark, name, "old", contracts.schema("ad_costs"))
    assert retention.expire_tables(spark, name, datetime.now(timezone.utc) - timedelta(hours=1)) == []
    assert retention.expire_tables(spark, name, datetime.now(timezone.utc) + timedelta(hours=1)) == ["old"]
    assert not warehouse.table_exists(spark, name, "old")


def test_clustered_rows_let_a_scan_skip_files(spark, tmp_path):
    df = spark.range(10_000).select((F.col("id") * 7919 % 10_000).alias("n"), F.lit("x").alias("part"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        warehouse.clustered(df, ("part",), ("n",)).write.parquet(str(tmp_path / "c"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    ranges = spark.read.parquet(str(tmp_path / "c")).groupBy(F.input_file_name()).agg(F.min("n"), F.max("n")).collect()
    bounds = sorted((r[1], r[2]) for r in ranges)
    assert len(bounds) > 1
    assert all(a[1] < b[0] for a, b in zip(bounds, bounds[1:]))


def test_materialize(spark, database):
    day = date(2024, 2, 3)
    spark.range(3).createOrReplaceTempView("numbers")
    arguments = (spark, "select id, cast(id % 2 as int) as part from numbers", database, day)
    name = materialize.materialize(*arguments, partitioning_field="part")
    assert name == f"`{database}`.`scheduled_20240203`"
    for disposition, rows in (("WRITE_APPEND", 6), ("WRITE_TRUNCATE", 3)):
        materialize.materialize(*arguments, write_disposition=disposition, partitioning_field="part")
        assert spark.table(name).count() == rows
    with pytest.raises(ValueError):
        materialize.materialize(*arguments, write_disposition="WRITE_EMPTY")
    spark.sql(f"create table `{database}`.empty_one (id bigint, part int) using parquet")
    materialize.materialize(*arguments, template="empty_one", write_disposition="WRITE_EMPTY")
    assert spark.table(f"`{database}`.empty_one").count() == 3
    with pytest.raises(ValueError):
        materialize.materialize(*arguments, write_disposition="OTHER")


def test_jobs_are_found_by_exact_name(spark):
    path = run_path(spark, "jobs")
    for name in ("update_1", "update_10", "update_1"):
        materialize.register_job(spark, path, name, "select 1", "db")
    found = materialize.find_job(spark.read.parquet(path), "update_1")
    assert as_tuples(found, "display_name", "schedule", "write_disposition", "disabled") == [
        ("update_1", "every 24 hours", "WRITE_TRUNCATE", False)
    ]
    assert materialize.find_job(spark.read.parquet(path), "update").isEmpty()


def test_run_log(spark):
    path = run_path(spark, "runs")

    def state():
        return as_tuples(jobs.last_run(spark.read.parquet(path)), "job", "last_run", "is_running", "runs")

    running = jobs.log_run(spark, path, "job", 1, state)
    assert running == [("job", 0, True, 0)]
    started = spark.read.parquet(path).first()["started_ms"]
    assert state() == [("job", started, False, 1)]

    def fail():
        raise jobs.JobError("MISSING_PROJECT_CONFIG", "none")

    with pytest.raises(jobs.JobError):
        jobs.log_run(spark, path, "job", 1, fail)
    with pytest.raises(ZeroDivisionError):
        jobs.log_run(spark, path, "other", 1, lambda: 1 / 0)
    found = jobs.last_run(spark.read.parquet(path))
    assert as_tuples(found, "job", "last_run", "last_status", "last_error_type", "runs") == [
        ("job", started, "error", "MISSING_PROJECT_CONFIG", 2), ("other", 0, "error", "UNRECOGNIZED_ERROR", 1),
    ]
    incremental = spark.createDataFrame([(1,), (5,)], "inserted_at bigint")
    assert jobs.newer_than(incremental, 1).count() == 1


def test_manual_costs_from_a_file(spark, tmp_path):
    path = tmp_path / "upload.csv"
    path.write_text(
        "date,source,cost,clicks,currency\n2024-01-01,s,1.5,3,USD\n2024-01-01,s,many,3,USD\n"
        "bad,s,1,3,USD\n2024-01-02,s,,3,USD\n2024-01-02,s,-1,1.5,USD\n"
    )
    good, bad = costs.load_manual_costs(spark, str(path))
    assert quality.contract_diff(good, contracts.schema("ad_costs")) == []
    assert as_tuples(good, "date", "cost", "clicks", "data_source") == [(date(2024, 1, 1), 1.5, 3, "manual")]
    assert sorted(r["reason"] for r in bad.collect()) == [
        "clicks does not parse; cost is negative", "cost does not parse", "cost is missing", "date does not parse",
    ]
    parquet = str(tmp_path / "upload.parquet")
    spark.read.csv(str(path), header=True).write.parquet(parquet)
    assert costs.load_manual_costs(spark, parquet, file_format="parquet")[0].count() == 1


def test_each_file_has_its_own_header_and_loses_nothing(spark, tmp_path):
    (tmp_path / "a.csv").write_text('date,cost,source,url_params\n2024-01-01,5,x,"[{""key"":""k"",""value"":""v""}]"\n')
    (tmp_path / "b.csv").write_text("date,source,cost\n2024-01-01,y,7\n2024-01-01,z,1,surplus\n")
    (tmp_path / "c.csv").write_text("date,cost,colour\n2024-01-01,1,red\n")
    good, bad = costs.load_manual_costs(spark, str(tmp_path))
    assert as_tuples(good, "source", "cost") == [("x", 5.0), ("y", 7.0)]
    assert good.where("source = 'x'").first()["url_params"][0]["key"] == "k"
    assert sorted(r["reason"] for r in bad.collect()) == ["not as many fields as its header", "unknown column colour"]


def test_a_failing_truncate_keeps_the_old_table(spark):
    spark.sql("create database if not exists kept_db")
    day = date(2024, 1, 1)
    table = materialize.materialize(spark, "select 1 as a", "kept_db", day)
    with pytest.raises(Exception):
        materialize.materialize(spark, "select 1 / (id - id) as a from range(3)", "kept_db", day)
    assert as_tuples(spark.table(table), "a") == [(1,)]
    materialize.materialize(spark, f"select a + 1 as a from {table}", "kept_db", day)
    assert as_tuples(spark.table(table), "a") == [(2,)]
    assert spark.catalog.listTables("kept_db")[0].name == "scheduled_20240101"
    spark.sql("drop database kept_db cascade")
