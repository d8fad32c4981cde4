"""Table contracts: column names and types are a wire format, so they are fixed.

Two columns (the anonymous visitor id and the click reference id) carry the event producer's own prefix on the wire.
The prefix is a deployment setting: ``schema("raw_events", prefix="acme_")`` names the visitor column ``acme_avid``.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql.types import StructType

# Record types shared by the tables.
TYPED_VALUE = "STRUCT<string_value: STRING, int_value: BIGINT, double_value: DOUBLE, boolean_value: BOOLEAN>"
TYPED_PARAMS = f"ARRAY<STRUCT<key: STRING, value: {TYPED_VALUE}>>"
STRING_PARAMS = "ARRAY<STRUCT<key: STRING, value: STRING>>"
URL_PARAMS = "ARRAY<STRUCT<key: STRING, value: STRUCT<string_value: STRING>>>"
AD_DATA = f"ARRAY<STRUCT<ad_network: STRING, `values`: {STRING_PARAMS}>>"
USER_DATA = (
    "STRUCT<first_name: STRING, last_name: STRING, full_name: STRING, gender: STRING, age: BIGINT, "
    "phone_number: STRING, email: STRING, country: STRING, region: STRING, city: STRING>"
)
DEAL = (
    "STRUCT<id: STRING, status: STRING, manager: STRING, value: DOUBLE, paid_value: DOUBLE, refund_value: DOUBLE, "
    "currency: STRING, promo_action: STRING, discount_amount: DOUBLE, discount_percentage: DOUBLE, "
    f"payment_method: STRING, custom_params: {TYPED_PARAMS}>"
)
ORDER = (
    "STRUCT<id: STRING, status: STRING, manager: STRING, value: DOUBLE, paid_value: DOUBLE, refund_value: DOUBLE, "
    "currency: STRING, shipping: DOUBLE, tax: DOUBLE, promo_action: STRING, discount_amount: DOUBLE, "
    f"discount_percentage: DOUBLE, payment_method: STRING, custom_params: {TYPED_PARAMS}>"
)
OFFERS = (
    "ARRAY<STRUCT<id: STRING, name: STRING, value: DOUBLE, currency: STRING, promo_action: STRING, "
    "discount_amount: DOUBLE, discount_percentage: DOUBLE>>"
)
PRODUCTS = (
    "ARRAY<STRUCT<id: STRING, name: STRING, brand: STRING, category: STRING, sku: STRING, quantity: BIGINT, "
    "value: DOUBLE, currency: STRING, promo_action: STRING, discount_amount: DOUBLE, discount_percentage: DOUBLE>>"
)
TRANSACTION = (
    "STRUCT<id: STRING, status: STRING, value: DOUBLE, currency: STRING, tax: DOUBLE, payment_method: STRING, "
    f"deal_id: STRING, order_id: STRING, custom_params: {TYPED_PARAMS}>"
)
GEO = "STRUCT<continent: STRING, sub_continent: STRING, country: STRING, region: STRING, city: STRING>"
DEVICE_INFO = (
    "STRUCT<category: STRING, mobile_brand_name: STRING, mobile_model_name: STRING, operating_system: STRING, "
    "operating_system_version: STRING, language: STRING, timezone: STRING, timezone_offset_seconds: BIGINT, "
    "ip: STRING, screen_resolution: STRING, "
    "web_info: STRUCT<browser: STRING, browser_version: STRING, user_agent: STRING>>"
)

# The tables, column by column. ``{p}`` stands for the producer's prefix.
COLUMNS = {
    "raw_events": (
        f"`date` DATE, `timestamp` BIGINT, event_id STRING, event_name STRING, event_params {TYPED_PARAMS}, "
        f"user_data {USER_DATA}, user_properties {TYPED_PARAMS}, user_external_ids {STRING_PARAMS}, "
        f"{{p}}avid STRING, ad_data {AD_DATA}, deal {DEAL}, offers {OFFERS}, `order` {ORDER}, products {PRODUCTS}, "
        f"`transaction` {TRANSACTION}, geo {GEO}, device_info {DEVICE_INFO}, is_test_event BOOLEAN"
    ),
    "identified_events": (
        f"`date` DATE, `timestamp` BIGINT, event_id STRING, event_name STRING, event_params {TYPED_PARAMS}, "
        f"user_data {USER_DATA}, user_properties {TYPED_PARAMS}, user_external_ids {STRING_PARAMS}, "
        f"profile_id STRING, {{p}}avid STRING, ad_data {AD_DATA}, deal {DEAL}, offers {OFFERS}, `order` {ORDER}, "
        f"products {PRODUCTS}, `transaction` {TRANSACTION}, geo {GEO}, device_info {DEVICE_INFO}, "
        "is_test_event BOOLEAN, inserted_at BIGINT"
    ),
    "ad_costs": (
        "`date` DATE, source STRING, medium STRING, campaign STRING, content STRING, term STRING, {p}refid STRING, "
        f"landing_page_url STRING, landing_hostname STRING, landing_page_path STRING, url_params {URL_PARAMS}, "
        "cost DOUBLE, currency STRING, impressions BIGINT, reach BIGINT, clicks BIGINT, click_delay BOOLEAN, "
        "data_source STRING, campaign_id STRING, campaign_name STRING, adgroup_id STRING, adgroup_name STRING, "
        "ad_id STRING, ad_name STRING, creative_image_url STRING"
    ),
    "facebook_ads_ad_costs": (
        "inserted_at BIGINT, `date` DATE, ad_account_id STRING, timezone STRING, source STRING, medium STRING, "
        "campaign STRING, content STRING, term STRING, {p}refid STRING, landing_page_url STRING, "
        "landing_hostname STRING, landing_page_path STRING, campaign_id STRING, campaign_name STRING, "
        "adset_id STRING, adset_name STRING, ad_id STRING, ad_name STRING, creative_image_url STRING, "
        f"url_params {URL_PARAMS}, cost DOUBLE, currency STRING, impressions BIGINT, reach BIGINT, clicks BIGINT, "
        "click_delay BOOLEAN"
    ),
    "google_ads_ad_costs": (
        "inserted_at BIGINT, `date` DATE, ad_account_id STRING, timezone STRING, source STRING, medium STRING, "
        "campaign STRING, content STRING, term STRING, {p}refid STRING, landing_page_url STRING, "
        f"landing_hostname STRING, landing_page_path STRING, url_params {URL_PARAMS}, cost DOUBLE, currency STRING, "
        "impressions BIGINT, reach BIGINT, clicks BIGINT, click_delay BOOLEAN, ad_id STRING, keyword STRING"
    ),
    "tiktok_ads_ad_costs": (
        "inserted_at BIGINT, `date` DATE, ad_account_id STRING, timezone STRING, source STRING, medium STRING, "
        "campaign STRING, content STRING, term STRING, {p}refid STRING, landing_page_url STRING, "
        f"landing_hostname STRING, landing_page_path STRING, url_params {URL_PARAMS}, cost DOUBLE, currency STRING, "
        "impressions BIGINT, reach BIGINT, clicks BIGINT, click_delay BOOLEAN, ad_id STRING"
    ),
    "event_messages": (
        "subscription_name STRING, message_id STRING, publish_time TIMESTAMP, data STRING, attributes STRING"
    ),
}

# Names, limits and defaults of a deployed project.
DATABASE_PREFIX = "sx_"
TOPIC_PREFIX = "event_collector"
SINK_SUBSCRIPTION_PREFIX = "bigquery_raw_events"
PROCESSOR_SUBSCRIPTION_PREFIX = "event_processor"
MESSAGE_RETENTION_SECONDS = 2_678_400
UNATTRIBUTED_THRESHOLD_PERCENT = 1
EXCLUDED_REFERRERS_QUERY = "select array('https://some-site.com/') as hosts"
WAREHOUSE_TABLES = (
    "raw_events",
    "identified_events",
    "ad_costs",
    "facebook_ads_ad_costs",
    "google_ads_ad_costs",
    "tiktok_ads_ad_costs",
)
JOBS = (
    "check_unattributed_events_share",
    "check_ad_costs_without_visits",
    "calculate_events_attribution",
    "update_facebook_ad_costs",
    "update_google_ad_costs",
    "update_tiktok_ad_costs",
    "update_manual_ad_costs",
)
JOB_ERROR_TYPES = (
    "MISSING_PROJECT_CONFIG",
    "UNRECOGNIZED_ERROR",
    "NOTIFICATION_SERVICE_ERROR",
    "BIGQUERY_REQUEST_ERROR",
)


@lru_cache(maxsize=None)
def schema(table: str, prefix: str = "") -> StructType:
    """The Spark schema of a table."""
    return StructType.fromDDL(COLUMNS[table].replace("{p}", prefix))
