"""Choice lists and code tables of the loan dashboard."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Regions and the first zip digits that belong to each.
REGION_DIGITS = {
    "West": ("8", "9"),
    "Midwest": ("6", "5", "4"),
    "South": ("7", "3", "2"),
    "East": ("1", "0"),
}
REGIONS = ("East", "South", "Midwest", "West")

# Rule: grade letters A..G, five steps each.
SUB_GRADES = tuple(f"{letter}{step}" for letter in "ABCDEFG" for step in range(1, 6))

# Loan purpose codes and their titles.
PURPOSE_TITLES = {
    "credit_card": "Credit card refinancing",
    "medical": "Medical expenses",
    "major_purchase": "Major purchase",
    "renewable_energy": "Green loan",
    "small_business": "Business",
    "debt_consolidation": "Debt consolidation",
    "vacation": "Vacation",
    "house": "Home buying",
    "other": "Other",
    "home_improvement": "Home improvement",
    "moving": "Moving and relocation",
    "car": "Car financing",
}
PURPOSES = tuple(PURPOSE_TITLES)

# Statuses that are not at risk.
SETTLED_STATUSES = ("Current", "Fully Paid", "Charged Off")


def purpose_lookup(spark: SparkSession) -> DataFrame:
    """Purpose code to title, 12 rows."""
    return spark.createDataFrame(list(PURPOSE_TITLES.items()), "purpose string, title string")
