"""Business labels: tiers, bands, flags and segments as CASE columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label texts and thresholds of the retail model.
DISCOUNT_TIERS = ((0.10, "Low (0-10%)"), (0.20, "Medium (10-20%)"))
NO_DISCOUNT, TOP_DISCOUNT = "No Discount", "High (20%+)"
AGE_BANDS = ((18, 25), (26, 35), (36, 50))
OLDEST_BAND = "51+"
STATUS_FLAGS = {"is_returned": "Returned", "is_cancelled": "Cancelled", "is_completed": "Completed"}
WEEKEND_DAYS = (1, 7)
HOLIDAY_SEASON_MONTHS = (11, 12)


def discount_tier(pct: str) -> Column:
    label = F.when(F.col(pct) == 0, NO_DISCOUNT)
    for upper, name in DISCOUNT_TIERS:
        label = label.when(F.col(pct) <= upper, name)
    return label.otherwise(TOP_DISCOUNT)


def age_band(age: str) -> Column:
    (low, high), *rest = AGE_BANDS
    label = F.when(F.col(age).between(low, high), f"{low}-{high}")
    for low, high in rest:
        label = label.when(F.col(age).between(low, high), f"{low}-{high}")
    return label.otherwise(OLDEST_BAND)


def status_flags(status: str = "status") -> dict[str, Column]:
    return {
        flag: F.when(F.col(status) == value, 1).otherwise(0)
        for flag, value in STATUS_FLAGS.items()
    }


def stock_status(out_of_stock: str, below_reorder: str) -> Column:
    return (
        F.when(F.col(out_of_stock), "Out of Stock")
        .when(F.col(below_reorder), "Low Stock")
        .otherwise("Healthy")
    )


def rfm_segment(r: str, f: str, m: str) -> Column:
    """Eight customer segments; the first matching rule wins."""
    # Segment names, score limits and their order.
    recency, frequency, monetary = F.col(r), F.col(f), F.col(m)
    rules = [
        ("Champions", (recency >= 4) & (frequency >= 4) & (monetary >= 4)),
        ("Loyal Customers", (recency >= 3) & (frequency >= 3)),
        ("Recent Customers", recency >= 4),
        ("Frequent Buyers", frequency >= 4),
        ("High Spenders", monetary >= 4),
        ("At Risk", (recency <= 2) & (frequency >= 3)),
        ("Lost Customers", (recency <= 2) & (frequency <= 2)),
    ]
    name, condition = rules[0]
    label = F.when(condition, name)
    for name, condition in rules[1:]:
        label = label.when(condition, name)
    return label.otherwise("Potential Loyalists")
