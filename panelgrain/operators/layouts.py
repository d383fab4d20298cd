"""Vendor file layouts as data."""

from panelgrain.spec import DelimitedLayout, Field, FixedLayout

# ---- Fixed values: positions (1-based start, length) and header words of the vendor formats. ----

FACT_A = FixedLayout(
    "fact_a",
    (
        Field("market_code", 2, 9),
        Field("product_code", 11, 9),
        Field("period_code", 20, 9),
        Field("market_prefix", 29, 1),
        Field("filler", 30, 23),
    ),
    record="letter:U",
    slot_start=53,
    slot_width=10,
    tail=Field("rest", 253, 10),
)
FACT_B = FixedLayout(
    "fact_b",
    (
        Field("period_code", 7, 9),
        Field("market_code", 16, 6),
        Field("product_code", 25, 37),
        Field("market_prefix", 62, 2),
        Field("filler", 64, 2),
    ),
    record="fact_line",
    slot_start=66,
    slot_width=11,
    tail=Field("rest", 286, 11),
)
MARKET_A = FixedLayout(
    "market_a",
    (Field("code", 2, 9), Field("name", 26, 40), Field("attributes", 67, 40)),
    record="letter:G",
)
MARKET_A2 = FixedLayout(
    "market_a2",
    (Field("code", 2, 9), Field("name", 26, 41), Field("attributes", 67, 112)),
    record="letter:G",
)
MARKET_B = FixedLayout(
    "market_b",
    (Field("code", 11, 6), Field("name", 49, 80), Field("prefix", 129, 2), Field("attributes", 131, 120)),
    record="code:02",
    prefix_field="prefix",
)
MEASURE_A = FixedLayout("measure_a", (Field("code", 2, 9), Field("name", 67, 80)), record="letter:O")
MEASURE_B = FixedLayout("measure_b", (Field("code", 12, 37), Field("name", 49, 80)), record="code:04")
PERIOD_A = FixedLayout("period_a", (Field("code", 2, 8), Field("name", 67, 80)), record="letter:R")
PERIOD_B = FixedLayout("period_b", (Field("code", 9, 9), Field("name", 49, 80)), record="code:01")
PRODUCT_A = FixedLayout(
    "product_a",
    (Field("code", 2, 9), Field("name", 27, 40), Field("attributes", 67, 40)),
    record="letter:L",
)
PRODUCT_A2 = FixedLayout(
    "product_a2",
    (Field("code", 2, 10), Field("attributes", 27, 40), Field("name", 67, 80)),
    record="letter:L",
)
PRODUCT_B = FixedLayout(
    "product_b",
    (Field("code", 12, 37), Field("name", 49, 80), Field("attributes", 129, 120)),
    record="code:06",
)

MARKET_D = DelimitedLayout("market_d", code="TAG", attributes="SHORT", long_name="LONG", order="DISPLAY_ORDER")
PRODUCT_D = DelimitedLayout("product_d", code="TAG", attributes="LONG", long_name="SHORT", order="DISPLAY_ORDER")
PRODUCT_D2 = DelimitedLayout("product_d2", code="TAG", attributes="SHORT", long_name="LONG", order="DISPLAY_ORDER")
MEASURE_D = DelimitedLayout("measure_d", code="TAG", long_name="LONG", order="DISPLAY_ORDER")
PERIOD_D = DelimitedLayout("period_d", code="TAG", long_name="LONG", order="DISPLAY_ORDER")
PERIOD_D3 = DelimitedLayout("period_d3", code="period_id", long_name="period_long_description")

FACT_TAGS = {"market_code": "MKT_TAG", "product_code": "PROD_TAG", "period_code": "PER_TAG"}
FACT_KEYS = ("market_code", "product_code", "period_code")
FACT_WIDTH = 103

# Product text: a half-width dot becomes three underscores, any other character outside the list two
# (layout A); a replacement character becomes one (layout A2).
PRODUCT_TEXT_DOT = "\uff65"
PRODUCT_TEXT_UNKNOWN = "\ufffd"
PRODUCT_TEXT_ALLOWED = "a-zA-Z0-9 \\-!@#$%^&*()\\[\\]{};:,./<>?|`~\"'=_+\\n"

# ---- end of fixed values ----

FIXED = {
    layout.name: layout
    for layout in (
        FACT_A, FACT_B, MARKET_A, MARKET_A2, MARKET_B, MEASURE_A, MEASURE_B,
        PERIOD_A, PERIOD_B, PRODUCT_A, PRODUCT_A2, PRODUCT_B,
    )
}
