"""A project's settings and jobs on hand-written rows."""

from __future__ import annotations

import uuid
from datetime import date

import pytest

from beaconlake.plans import jobs, project, warehouse
from beaconlake.session import run_path
from conftest import as_tuples

DAY_MS = 1_704_067_200_000  # 2024-01-01


@pytest.fixture
def number(spark):
    made = uuid.uuid4().int % 10**12
    project.register_project(spark, made, run_path(spark, "project"), buckets=4)
    yield made
    spark.sql(f"drop database `{warehouse.database_name(made)}` cascade")


def _event(event_id: str, name: str, seconds: int, **fields) -> dict:
    page = {"key": "landing_page_url", "value": {"string_value": f"http://x.org/{fields.pop('query', '')}"}}
    return {
        "date": "2024-01-01", "timestamp": DAY_MS + 1000 * seconds, "event_id": event_id, "event_name": name, "avid": "v",
        "user_external_ids": [], "event_params": [page], **fields,
    }


def test_settings_are_made_once(spark, number):
    table = f"{warehouse.database_name(number)}.{project.CONFIGS}"
    assert as_tuples(spark.table(table), "project_id", "unattributed_events_threshold") == [(number, 1.0)]
    states = project.job_states(spark, number)
    assert states.count() == 7 and states.where("last_run = 0 and runs = 0 and last_status is null").count() == 7
    project.register_project(spark, number)
    assert spark.table(table).count() == 1


def test_checks_follow_the_settings(spark, number, make_events):
    database = warehouse.database_name(number)
    rows = [
        _event("1", "click", 1, query="?utm_source=s"), _event("2", "purchase", 2, order={"value": 5.0}),
        _event("2", "purchase", 3, order={"value": 5.0}), _event("3", "purchase", 4, avid="other"),
    ]
    warehouse.save_rows(spark, make_events(rows), f"{database}.raw_events")
    for _ in range(2):
        project.run_job(spark, number, "calculate_events_attribution")
    found = spark.table(f"{database}.attributed_events")
    assert as_tuples(found, "event_id", "source", "timestamp") == [
        ("2", "s", DAY_MS + 2000), ("3", None, DAY_MS + 4000),
    ]
    project.run_job(spark, number, "check_unattributed_events_share")
    shares = spark.table(f"{database}.unattributed_shares")
    assert as_tuples(shares, "date", "total", "unattributed", "breach") == [(date(2024, 1, 1), 2, 1, True)]

    ignored = [(number, 60.0, [("signup", None, None)], "UTC", "USD")]
    changed = spark.createDataFrame(ignored, project.CONFIG_COLUMNS)
    spark.sql(f"truncate table {database}.{project.CONFIGS}")
    with pytest.raises(jobs.JobError):
        project.run_job(spark, number, "check_unattributed_events_share")
    warehouse.save_rows(spark, changed, f"{database}.{project.CONFIGS}")
    project.run_job(spark, number, "check_unattributed_events_share")
    assert as_tuples(shares.select("breach"), "breach") == [(False,), (True,)]
    state = project.job_states(spark, number).where("job = 'check_unattributed_events_share'").first()
    assert (state.last_status, state.runs) == ("success", 3)


def test_costs_come_by_their_dates(spark, number, tmp_path):
    database = warehouse.database_name(number)
    network = f"{database}.facebook_ads_ad_costs"
    empty = spark.table(network)

    def bring(day: str, inserted_at: int, cost: float) -> None:
        given = {"inserted_at": inserted_at, "date": day, "ad_account_id": "a", "cost": cost}
        columns = ", ".join(
            f"cast({given[f.name]!r} as {f.dataType.simpleString()}) as `{f.name}`" if f.name in given
            else f"cast(null as {f.dataType.simpleString()}) as `{f.name}`" for f in empty.schema.fields
        )
        warehouse.save_rows(spark, spark.sql(f"select {columns}"), network)
        project.run_job(spark, number, "update_facebook_ad_costs")

    later = 10**14
    bring("2024-01-01", later, 1.0)
    bring("2024-01-02", later + 1, 2.0)
    bring("2024-01-01", later + 2, 3.0)
    upload = tmp_path / "upload.csv"
    upload.write_text("date,source,cost\n2024-01-01,s,4\n2024-01-01,s,many\n")
    for _ in range(2):
        project.run_job(spark, number, "update_manual_ad_costs", upload=str(upload))
    found = spark.table(f"{database}.ad_costs")
    assert as_tuples(found, "data_source", "cost") == [("facebook_ads", 2.0), ("facebook_ads", 3.0), ("manual", 4.0)]
    assert spark.table(f"{database}.manual_costs_rejected").select("reason").distinct().count() == 1
    project.run_job(spark, number, "check_ad_costs_without_visits")
    assert spark.table(f"{database}.costs_without_visits").count() == 3


def test_network_rows_are_read_once_whatever_the_clock(spark, number):
    database = warehouse.database_name(number)
    network, costs = f"{database}.google_ads_ad_costs", f"{database}.ad_costs"
    fields = spark.table(network).schema.fields

    def bring(day: str, inserted_at: int, cost: float) -> None:
        given = {"inserted_at": inserted_at, "date": day, "ad_account_id": "a", "cost": cost}
        columns = ", ".join(f"cast({given[f.name]!r} as {f.dataType.simpleString()}) as `{f.name}`" if f.name in given
                            else f"cast(null as {f.dataType.simpleString()}) as `{f.name}`" for f in fields)
        warehouse.save_rows(spark, spark.sql(f"select {columns}"), network)
        project.run_job(spark, number, "update_google_ad_costs")

    # Stamped long before the runs' start.
    bring("2024-01-01", 5, 1.0)
    bring("2024-01-02", 7, 2.0)
    assert as_tuples(spark.table(costs), "date", "cost") == [(date(2024, 1, 1), 1.0), (date(2024, 1, 2), 2.0)]
    assert spark.table(f"{database}.{project.MARKS}").count() == 2
    # A date that the network withdraws goes, also when nothing is new.
    spark.sql(f"ALTER TABLE {network} DROP PARTITION (`date` = '2024-01-01')")
    project.run_job(spark, number, "update_google_ad_costs")
    assert as_tuples(spark.table(costs), "date", "cost") == [(date(2024, 1, 2), 2.0)]
    assert spark.table(f"{database}.{project.MARKS}").count() == 2


def test_unknown_job(spark, number):
    with pytest.raises(ValueError):
        project.run_job(spark, number, "none")
