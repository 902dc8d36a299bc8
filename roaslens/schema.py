"""Column lists and schemas shared by every operator."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values of the input and output contract: dimensions, metrics, engine columns, level-sum columns.
DIMENSIONS: list[str] = ["SUBSIDIARY", "CHANNEL", "DIVISION", "PRODUCT"]
METRICS: list[str] = ["Spend", "Revenue", "Clicks", "Orders"]
ENGINE_METRICS: list[str] = [
    "Spend_curr", "Spend_prev", "Revenue_curr", "Revenue_prev",
    "Clicks_curr", "Clicks_prev", "Orders_curr", "Orders_prev",
]
ENGINE_COLUMNS: list[str] = DIMENSIONS + ENGINE_METRICS
SUM_COLUMNS: list[str] = [
    "Revenue_curr_sum", "Revenue_prev_sum", "Spend_curr_sum", "Spend_prev_sum",
    "Clicks_curr_sum", "Clicks_prev_sum", "Orders_curr_sum", "Orders_prev_sum",
]
# engine metric -> level-sum column
SUM_OF: dict[str, str] = {m: f"{m}_sum" for m in ENGINE_METRICS}

ENGINE_SCHEMA = T.StructType(
    [T.StructField(d, T.StringType()) for d in DIMENSIONS]
    + [T.StructField(m, T.DoubleType()) for m in ENGINE_METRICS]
)

# Fixed values of the input contract: raw metric headers and their engine names,
# objective filter value, kept divisions.
RAW_METRIC_MAP: dict[str, str] = {
    "PLATFORM_SPEND_USD": "Spend",
    "GROSS_REVENUE": "Revenue",
    "PLATFORM_CLICKS": "Clicks",
    "GROSS_ORDERS": "Orders",
}
OBJECTIVE_CANDIDATES: tuple[str, ...] = ("OBJECTIVE", "Objective", "objective")
TARGET_OBJECTIVE = "CONVERSION"
TARGET_DIVISIONS: tuple[str, ...] = ("MX", "VD", "DA")

# The known source headers (canonical spelling), used for
# case-insensitive header standardisation.
SOURCE_RAW_HEADERS: tuple[str, ...] = (
    "Year", "Month", "Day", "PLATFORM", "SUBSIDIARY", "REGION", "COUNTRY", "DIVISION",
    "CAMPAIGN_NAME", "CAMPAIGN_ID", "PLATFORM_CAMPAIGN_TYPE", "CHANNEL", "PRODUCT",
    "SOCIAL_CONTENT_TYPE", "BID_STRATEGY_TYPE", "CAMPAIGN_OBJECTIVE", "OBJECTIVE",
    "TAXO_PHASE_PH", "PUBLISHER", "PLATFORM_LANDING_PAGE_URL", "TARGET_TYPE",
    "AI_AD_PRODUCT", "MX_FLAGSHIP", "MX_FLAGSHIP_S", "MX_FLAGSHIP_S_DETAIL",
    "MX_FLAGSHIP_Z", "MX_FLAGSHIP_Z_DETAIL", "GOOGLE_ADS_NETWORK",
    "GOOGLE_ADS_EXTERNAL_CONVERSION_SOURCE", "ACCOUNT", "ACCOUNT_ID",
    "PLATFORM_SPEND_USD", "PLATFORM_IMPRESSIONS", "PLATFORM_CLICKS", "VISITS",
    "QUALIFY_VISITS", "GROSS_ORDERS", "GROSS_REVENUE", "PLATFORM_TOTAL_CONVERSIONS",
    "PLATFORM_REVENUE_USD", "META_MOBILE_APP_PURCHASE", "META_WEB_PURCHASE",
    "PLATFORM_VIDEO_VIEWS",
)
REQUIRED_LONG_UPPER: frozenset[str] = frozenset(
    {"YEAR", *DIMENSIONS, "PLATFORM_SPEND_USD", "PLATFORM_CLICKS", "GROSS_ORDERS", "GROSS_REVENUE"}
)
REQUIRED_WIDE_UPPER: frozenset[str] = frozenset(c.upper() for c in ENGINE_COLUMNS)

LEVEL_NAMES = {1: "LEVEL1", 2: "LEVEL2", 3: "LEVEL3", 4: "LEVEL4"}



def dims_of(level: int) -> list[str]:
    """Dimensions that identify a row of ``level`` (0 = grand total)."""
    return DIMENSIONS[:level]
