"""Warehouse rows derived from the generic test tables ``events`` and ``pages``.

Everything is computed row by row or by ordinary joins and aggregations, so it grows with the tables.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from beaconlake.contracts import schema
from beaconlake.sources.topic import topic_name

EXCLUDED_QUERY = (
    "select array('https://spam-farm.example.org/', 'http://www.cheap-pills.example.com') as hosts"
)
NETWORKS = ("facebook_ads", "google_ads", "tiktok_ads")
PROJECT_ID = 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Pages whose addresses may be broadcast to the events.
MAX_BROADCAST_PAGES = 500_000
#: Events of a task that makes nested rows or messages of them.
EVENTS_PER_TASK = 100_000
#: The least number of the topic's files.
TOPIC_FILES = 8

Deal = Callable[[DataFrame], DataFrame]


def staged_events(spark: SparkSession, sf_dir: str, deal: Deal | None = None) -> DataFrame:
    """One flat row per event with its landing page and referrer.

    ``deal`` spreads the events over tasks while their rows are narrow: before they get the pages' addresses where those
    are few enough to broadcast, and after that where they are joined by shuffle.
    """
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    count = pages.count()
    events = spark.sql(
        """
        select e.event_id as eid,
               cast(e.ts as date) as `date`,
               unix_millis(cast(e.ts as timestamp)) as `timestamp`,
               cast(e.event_id as string) as event_id,
               e.event_type as event_name,
               e.user_id,
               e.value,
               cast(get_json_object(e.props, '$.k') as bigint) as k,
               concat('v', cast(case when e.user_id % 30 = 29 then e.user_id div 3
                                     else (e.user_id + e.event_id % 2) div 3 end as string)) as avid
        from {events} e
        """,
        events=table(spark, sf_dir, "events"),
    )
    few = count <= MAX_BROADCAST_PAGES
    if deal and few:
        events = deal(events)
    staged = spark.sql(
        f"""
        select {"/*+ BROADCAST(l, r) */" if few else ""} e.*, l.page_id, l.url as landing_url, r.url as referrer_url
        from {{events}} e
        left join {{pages}} l on l.page_id = e.eid % {count}
        left join {{pages}} r on e.eid % 4 <> 0 and r.page_id = (e.eid * 7 + 3) % {count}
        """,
        events=events,
        pages=pages,
    )
    return deal(staged) if deal and not few else staged


def _tasks(spark: SparkSession, sf_dir: str) -> int:
    """Tasks for the work on all events: as many as the events need, and for few events not more than there are cores."""
    events = table(spark, sf_dir, "events").count()
    least = min(spark.sparkContext.defaultParallelism, events // 10_000)
    return max(1, least, math.ceil(events / EVENTS_PER_TASK))


def topic_files(spark: SparkSession, sf_dir: str) -> int:
    """How many files the topic's rows go to."""
    return max(TOPIC_FILES, math.ceil(table(spark, sf_dir, "events").count() / EVENTS_PER_TASK))


def _record(data_type: DataType, values: dict[str, object]) -> Column:
    """A struct of the contract's type; fields that are not given are null or, for lists, empty."""
    if isinstance(data_type, ArrayType):
        data_type = data_type.elementType
    fields = []
    for field in data_type.fields:
        value = values.get(field.name)
        if isinstance(value, Column):
            column = value
        elif value is not None:
            column = F.expr(str(value))
        elif isinstance(field.dataType, ArrayType):
            column = F.array()
        else:
            column = F.lit(None)
        fields.append(column.cast(field.dataType).alias(field.name))
    return F.struct(*fields)


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staged events in the ``raw_events`` contract, dealt by date: the flat rows are, before they are nested."""
    tasks = _tasks(spark, sf_dir)
    return as_raw_events(staged_events(spark, sf_dir, lambda rows: rows.repartitionByRange(tasks, "date", "eid")))


def as_raw_events(staged: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Staged events in the contract; ``keep`` names further columns of theirs."""
    contract = schema("raw_events")
    types = {f.name: f.dataType for f in contract.fields}
    typed_value: StructType = types["event_params"].elementType["value"].dataType

    def entry(key: str, **slots: str) -> Column:
        return F.struct(F.lit(key).alias("key"), _record(typed_value, slots).alias("value"))

    def pair(key: str, value: str) -> Column:
        return F.struct(F.lit(key).alias("key"), F.expr(value).cast("string").alias("value"))

    def network(name: str, *values: Column) -> Column:
        return F.struct(F.expr(name).alias("ad_network"), F.array(*values).alias("values"))

    empty = F.array()
    name = F.col("event_name")
    event_params = F.filter(
        F.array(
            entry("k", int_value="k"),
            entry("value", double_value="value"),
            entry("landing_page_url", string_value="landing_url"),
            entry("referrer_url", string_value="referrer_url"),
        ),
        lambda p: (p["key"] != "referrer_url") | p["value"]["string_value"].isNotNull(),
    )
    plan = F.array(
        entry(
            "plan",
            string_value="case when user_id % 2 = 0 then 'free' else 'pro' end",
            int_value="case when eid % 100 = 7 then 1 end",
        )
    )
    own_network = network(
        "element_at(array('facebook_ads', 'google_ads', 'tiktok_ads'), cast(user_id % 3 as int) + 1)",
        pair("campaign_id", "concat('c', page_id % 10)"),
        pair("ad_id", "page_id"),
    )
    affiliate = network("'affiliate'", pair("partner", "concat('p', k % 5)"))
    ad_data = (
        F.when(~name.isin("click", "view"), empty.cast(types["ad_data"]))
        .when(F.expr("eid % 3 = 0"), F.array(own_network, affiliate).cast(types["ad_data"]))
        .otherwise(F.array(own_network).cast(types["ad_data"]))
    )
    deal = _record(types["deal"], {
        "id": "concat('d', user_id)",
        "status": "element_at(array('created', 'paid', 'refunded'), cast(k % 3 as int) + 1)",
        "value": "value",
        "paid_value": "case when k % 3 >= 1 then value else 0D end",
        "refund_value": "case when k % 3 = 2 then value / 2 else 0D end",
        "currency": "case when user_id % 2 = 0 then 'USD' else 'EUR' end",
    })
    order = _record(types["order"], {
        "id": "event_id", "status": "'paid'", "value": "value", "paid_value": "value", "refund_value": "0D",
        "currency": "'USD'",
    })
    transaction = _record(types["transaction"], {
        "id": "concat('t', event_id)", "status": "'settled'", "value": "value", "currency": "'USD'",
        "order_id": "case when eid % 7 = 0 then 'missing' else event_id end",
        "deal_id": "case when eid % 2 = 0 then concat('d', user_id) end",
    })
    offers = F.transform(
        F.filter(F.array(F.lit(1), F.lit(2)), lambda i: i <= F.expr("eid % 3")),
        lambda i: _record(types["offers"], {
            "id": F.concat(F.lit("o"), "k", F.lit("_"), i), "name": F.concat(F.lit("offer "), i),
            "value": "value", "currency": "'USD'",
            "discount_percentage": F.when(i == 2, F.lit(10.0)),
        }),
    )
    products = F.transform(
        F.filter(F.array(F.lit(1), F.lit(2), F.lit(3)), lambda i: i <= F.expr("eid % 4")),
        lambda i: _record(types["products"], {
            "id": F.concat(F.lit("p"), (F.col("k") + i) % 20), "category": F.concat(F.lit("cat"), i),
            "quantity": i, "value": "value", "currency": "'USD'",
            "discount_amount": F.when(i == 2, F.lit(1.0)),
            "discount_percentage": F.when(i == 3, F.lit(20.0)),
        }),
    )
    geo = _record(types["geo"], {
        "continent": "element_at(array('Americas', 'Europe', 'Europe'), cast(user_id % 4 as int) + 1)",
        "country": "element_at(array('US', 'DE', 'FR'), cast(user_id % 4 as int) + 1)",
        "city": "concat('city', user_id % 8)",
    })
    device = _record(types["device_info"], {
        "category": "element_at(array('desktop', 'mobile', 'tablet'), cast(eid % 3 as int) + 1)",
        "operating_system": "element_at(array('ios', 'android', 'windows'), cast(user_id % 3 as int) + 1)",
        "timezone_offset_seconds": "(user_id % 5 - 2) * 14400",
        "web_info": _record(types["device_info"]["web_info"].dataType, {
            "browser": "case when eid % 2 = 0 then 'firefox' else 'chrome' end"
        }),
    })
    user = _record(types["user_data"], {
        "email": "case when eid % 10 = 0 then concat(' U', user_id, '@Example.com') end",
        "phone_number": "case when eid % 10 = 5 then concat('+1 (555) ', user_id) end",
        "age": "18 + user_id % 60",
    })
    columns = {
        "event_params": event_params,
        "user_data": user,
        "user_properties": plan,
        "user_external_ids": F.array(pair("user_id", "concat('u', user_id)")),
        "ad_data": ad_data,
        "deal": F.when(name == "signup", deal),
        "offers": F.when(name == "view", offers).otherwise(empty.cast(types["offers"])),
        "order": F.when(name == "purchase", order),
        "products": F.when(name == "purchase", products).otherwise(empty.cast(types["products"])),
        "transaction": F.when(name == "purchase", transaction),
        "geo": F.when(F.expr("user_id % 4 <> 3"), geo),
        "device_info": device,
        "is_test_event": F.expr("case when eid % 50 = 0 then true when eid % 50 = 1 then null else false end"),
    }
    return staged.select(
        *[columns.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in contract.fields], *keep
    )


def excluded_referrers(spark: SparkSession) -> DataFrame:
    return spark.sql(EXCLUDED_QUERY)


def _page_figures(staged: DataFrame, names: tuple[str, ...], *extra: str) -> DataFrame:
    """Event counts and cents per day and landing page."""
    return (
        staged.where(F.col("event_name").isin(*names))
        .groupBy("date", "page_id", "landing_url", *extra)
        .agg(
            F.count_if(F.col("event_name") == "view").alias("impressions"),
            F.count_if(F.col("event_name") == "click").alias("clicks"),
            F.countDistinct("user_id").alias("reach"),
            F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("cents"),
        )
    )


def _utm_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "*",
        F.expr("try_parse_url(landing_url, 'HOST')").alias("landing_hostname"),
        F.expr("coalesce(try_parse_url(landing_url, 'QUERY', 'utm_source'), try_parse_url(landing_url, 'HOST'))").alias(
            "source"
        ),
        F.lit("cpc").alias("medium"),
    )


def network_costs(spark: SparkSession, sf_dir: str, data_source: str) -> DataFrame:
    """Cost rows of one network: two snapshots, the first with half the cost."""
    number = NETWORKS.index(data_source)
    staged = staged_events(spark, sf_dir).where(F.expr(f"user_id % 3 = {number}"))
    rows = _utm_columns(_page_figures(staged, ("click", "view"))).select(
        "*",
        F.expr("case when page_id % 10 = 9 then 'ghost' else concat('c', page_id % 10) end").alias("campaign"),
        F.explode(F.array(F.lit(1), F.lit(2))).alias("snapshot"),
    )
    values = {
        "inserted_at": "snapshot",
        "ad_account_id": "concat('acc', page_id % 2)",
        "timezone": "'UTC'",
        "landing_page_url": "landing_url",
        "landing_page_path": "try_parse_url(landing_url, 'PATH')",
        "cost": "case when snapshot = 1 then (cents div 2) / 100D else cents / 100D end",
        "currency": "'USD'",
        "click_delay": "false",
        "ad_id": "page_id",
        "keyword": "'kw'",
        "adset_id": "'as1'",
        "adset_name": "'first set'",
        "campaign_id": "concat('c', page_id % 10)",
        "url_params": "array()",
    }
    return rows.select(
        *[
            (F.expr(values[f.name]) if f.name in values else F.col(f.name) if f.name in rows.columns else F.lit(None))
            .cast(f.dataType).alias(f.name)
            for f in schema(f"{data_source}_ad_costs").fields
        ]
    )


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits with the cost rows' own campaign names, except that no visit has the campaign ``ghost``."""
    staged = staged_events(spark, sf_dir).where(F.col("event_name").isin("click", "view"))
    return _utm_columns(staged).select(
        "date",
        "source",
        "medium",
        F.expr("concat('c', page_id % 10)").alias("campaign"),
        F.lit(None).cast("string").alias("content"),
        F.expr("case when user_id % 3 = 1 then 'kw' end").alias("term"),
    )


def manual_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An upload of text columns with a cost per day and page; some costs are not numbers."""
    rows = _utm_columns(_page_figures(staged_events(spark, sf_dir), ("signup",)))
    return rows.select(
        F.col("date").cast("string").alias("date"),
        "source",
        "medium",
        F.expr("concat('c', page_id % 10)").alias("campaign"),
        F.col("landing_url").alias("landing_page_url"),
        "landing_hostname",
        F.expr("case when page_id % 10 = 3 then 'n/a' else cast(cents / 100D as string) end").alias("cost"),
        F.lit("USD").alias("currency"),
        F.col("reach").cast("string").alias("reach"),
        F.col("page_id").cast("string").alias("ad_id"),
    )


def topic_rows(spark: SparkSession, sf_dir: str, extra: str = '"extra"') -> DataFrame:
    """The events as topic rows. Some messages are sent twice, carry unknown fields or are broken.

    ``extra`` is an unknown field's name with its quotes. The rows are dealt to ``topic_files`` tasks by offset: the flat
    events are, before they become messages.
    """
    copies = F.when(F.col("eid") % 40 == 5, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))

    def deal(rows: DataFrame) -> DataFrame:
        numbered = rows.withColumn("copy", F.explode(copies)).withColumn("offset", F.col("eid") * 2 + F.col("copy"))
        return numbered.repartition(topic_files(spark, sf_dir), "offset")

    events = as_raw_events(staged_events(spark, sf_dir, deal), keep=("offset",))
    message = F.to_json(F.struct(*[F.col(f"`{c}`") for c in events.columns if c != "offset"]))
    # The nested rows end here. What is dear and named several times below is not computed anew for each.
    sent = events.select(
        "avid", "offset", "timestamp", "event_name", F.col("event_id").cast("bigint").alias("eid"), message.alias("json")
    )
    kind = F.col("eid") % 100
    body = (
        F.when(F.col("eid") % 20 == 3, F.concat(F.lit(f"{{{extra}:1,"), F.expr("substr(json, 2)")))
        .when(F.col("eid") % 20 == 4, F.replace("json", F.lit('"device_info":{'), F.lit('"device_info":{"zip":"x",')))
        .when(kind == 7, F.lit("not json"))
        .when(kind == 9, F.lit(""))
        .when(kind == 13, F.regexp_replace("json", '"timestamp":[0-9]+', '"timestamp":"12"'))
        .when(kind == 17, F.regexp_replace("json", '"event_id":"[0-9]+",', ""))
        .otherwise(F.col("json"))
    )
    return sent.select(
        F.col("avid").cast("binary").alias("key"),
        body.cast("binary").alias("value"),
        F.lit(topic_name(PROJECT_ID)).alias("topic"),
        (F.expr("cast(substr(avid, 2) as bigint)") % 4).cast("int").alias("partition"),
        "offset",
        F.timestamp_millis(F.col("timestamp") + 2000).alias("timestamp"),
        F.array(F.struct(F.lit("event_name").alias("key"), F.col("event_name").cast("binary").alias("value"))).alias(
            "headers"
        ),
    )


def job_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run log read out of the events: each one is a run of one of the jobs, and an ``error`` a failed one."""
    return staged_events(spark, sf_dir).select(
        F.expr(
            "element_at(array('check_unattributed_events_share', 'check_ad_costs_without_visits', "
            "'calculate_events_attribution', 'update_facebook_ad_costs', 'update_google_ad_costs', "
            "'update_tiktok_ad_costs', 'update_manual_ad_costs'), cast(k % 7 as int) + 1)"
        ).alias("job"),
        (F.col("user_id") % 5).alias("project_id"),
        F.col("timestamp").alias("started_ms"),
        (F.col("timestamp") + F.col("k")).alias("ended_ms"),
        F.expr("case when event_name = 'error' then 'error' else 'success' end").alias("status"),
        F.expr("case when event_name = 'error' then 'UNRECOGNIZED_ERROR' end").alias("error_type"),
        F.lit(None).cast("string").alias("error_message"),
    )


def project_configs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One configuration per project found in the events."""
    projects = table(spark, sf_dir, "events").select((F.col("user_id") % 5).alias("project_id")).distinct()
    return projects.select(
        "project_id",
        F.expr("case when project_id > 0 then cast(project_id as double) end").alias("unattributed_events_threshold"),
        F.expr(
            "case when project_id = 2 then array(named_struct('event_name', 'error', 'param_key', "
            "cast(null as string), 'param_value', cast(null as string))) end"
        ).alias("ignored_event_filters"),
        F.expr("case when project_id = 3 then 'Europe/Berlin' end").alias("timezone"),
        F.lit(None).cast("string").alias("currency"),
    )
