"""The sales regressor: attributes, fit, batch scores and importances."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.forest import Forest, fit_forest, forest_importances, score_forest
from tallyloom.operators.frames import ordinal, years_since

# Number codes of the two text attributes of a scoring row.
FAT_CODES = {"Low Fat": 0, "Regular": 1}
SIZE_CODES = {"Small": 0, "Medium": 1, "High": 2}
# The attributes of a scoring row, in order.
SALES_ATTRIBUTES = ("item_weight", "fat_code", "item_visibility", "item_mrp", "size_code", "outlet_years")

TEXT_TREES_BALANCED, SALES_TREES, SEED = 200, 100, 42


def sales_attributes(df: DataFrame) -> DataFrame:
    """The numeric attributes of a sales row, for training and scoring alike."""
    coded = (df.withColumn("fat_code", ordinal(F.col("item_fat_content"), FAT_CODES))
             .withColumn("size_code", ordinal(F.col("outlet_size"), SIZE_CODES)))
    return coded if "outlet_years" in coded.columns else years_since(coded, "outlet_establishment_year")


def fit_sales(df: DataFrame, target: str, features, trees: int = SALES_TREES, seed: int = SEED, max_depth: int | None = None,
              key: str | None = None) -> Forest:
    """Random-forest regressor; every feature is taken as a number, also codes. Trees are grown to the end unless ``max_depth`` is given."""
    return fit_forest(df, target, features, trees, max_depth, seed, key)


def score_sales(df: DataFrame, model: Forest) -> DataFrame:
    """Add the predicted sales to a table of attribute rows; rows with a missing attribute get null."""
    return score_forest(df, model)


def importances(model: Forest) -> DataFrame:
    """Importance of each feature of a fitted model as rows (feature, importance)."""
    return forest_importances(model)


def top_importances(model: Forest, n: int = 7) -> DataFrame:
    """The ``n`` most important features."""
    return importances(model).orderBy(F.desc("importance"), "feature").limit(n)
