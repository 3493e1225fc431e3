"""The table contract: one StructType per table, domains and thresholds."""

from __future__ import annotations

from pyspark.sql import types as T


def _fields(*cols: tuple[str, T.DataType, str]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True, {"comment": c}) for n, t, c in cols])


CUSTOMERS = _fields(
    ("customer_id", T.StringType(), "Customer key"),
    ("first_name", T.StringType(), "First name"),
    ("last_name", T.StringType(), "Last name"),
    ("email", T.StringType(), "E-mail address, lower case"),
    ("region", T.StringType(), "Sales region of the customer"),
    ("country", T.StringType(), "Country of residence"),
    ("city", T.StringType(), "City of residence"),
    ("signup_date", T.DateType(), "Day the account was opened"),
    ("segment", T.StringType(), "Customer segment"),
)

PRODUCTS = _fields(
    ("product_id", T.StringType(), "Product key"),
    ("product_name", T.StringType(), "Full product name"),
    ("category", T.StringType(), "Product category"),
    ("sub_category", T.StringType(), "Product sub-category"),
    ("unit_cost", T.DoubleType(), "Cost of one unit"),
    ("unit_price", T.DoubleType(), "Catalogue price of one unit"),
    ("brand", T.StringType(), "Brand"),
    ("margin_pct", T.DoubleType(), "(price - cost) / price * 100"),
)

SALES_TRANSACTIONS = _fields(
    ("transaction_id", T.StringType(), "Transaction key"),
    ("customer_id", T.StringType(), "Buyer, refers to customers"),
    ("product_id", T.StringType(), "Article, refers to products"),
    ("order_date", T.DateType(), "Day of the order"),
    ("ship_date", T.DateType(), "Day of shipment, may be missing"),
    ("quantity", T.IntegerType(), "Units ordered"),
    ("unit_price", T.DoubleType(), "Price of one unit in this sale"),
    ("discount", T.DoubleType(), "Discount as a fraction of 1"),
    ("net_revenue", T.DoubleType(), "unit_price * quantity * (1 - discount)"),
    ("region", T.StringType(), "Region of the sale"),
    ("year", T.IntegerType(), "Order year, partition key"),
    ("month", T.IntegerType(), "Order month, partition key"),
)

TABLES = {"customers": CUSTOMERS, "products": PRODUCTS, "sales_transactions": SALES_TRANSACTIONS}
PARTITIONS = {"customers": (), "products": (), "sales_transactions": ("year", "month")}

# Columns a raw file carries; everything else in the contract is derived.
_DERIVED = {"products": {"margin_pct"}, "sales_transactions": {"net_revenue"}}
RAW = {
    name: T.StructType(
        [T.StructField(f.name, T.StringType()) for f in s if f.name not in _DERIVED.get(name, set())]
    )
    for name, s in TABLES.items()
}

# Fixed values of the retail domain.
REGIONS = ("Northeast", "Southeast", "Midwest", "West", "Southwest")
SEGMENTS = ("Consumer", "Corporate", "Home Office")
UNKNOWN_REGION = "Unknown"
DEFAULT_SEGMENT = "Consumer"
EMAIL_PATTERN = r"^[a-z0-9._%+\-]+@[a-z0-9.\-]+\.[a-z]{2,}$"
RFM_ACTIONS = {
    "Champions": "Loyalty program, upsell",
    "At Risk": "Win-back campaign",
    "Lost": "Re-engagement or sunset",
    "Recent Customers": "Onboarding nurture",
    "Loyal Customers": "Reward and retain",
}
