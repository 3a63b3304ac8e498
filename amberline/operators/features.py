"""Per-row features. Narrow: no shuffle, one projection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amberline.functions.columns import flag, text, with_sql

# The cities treated as risky and the thresholds of the amount flags.
RISKY_LOCATIONS: tuple[str, ...] = ("Lagos", "Mumbai", "Manila", "Dhaka")
HIGH_AMOUNT = 1000
LOW_AMOUNT = 10
ONLINE_MARK = "Online"

# Text that is no time gives null; an offset in the text is converted to the session zone.
_MOMENT = "try_to_timestamp(timestamp)"

TIME_FEATURES = {
    "hour": f"hour({_MOMENT})",
    "day_of_week": f"dayofweek({_MOMENT})",
    "is_weekend": flag(f"dayofweek({_MOMENT}) IN (1, 7)"),  # Sunday, Saturday
}
AMOUNT_FEATURES = {
    "amount_log": "log1p(amount)",
    "is_high_amount": flag(f"amount > {HIGH_AMOUNT}"),
    "is_low_amount": flag(f"amount < {LOW_AMOUNT}"),
}
MERCHANT_FEATURES = {
    "merchant_length": "length(merchant)",
    "is_online_merchant": flag(f"contains(merchant, {text(ONLINE_MARK)})"),
}


def location_features(locations: Sequence[str] = RISKY_LOCATIONS) -> dict[str, str]:
    listed = ", ".join(text(name) for name in locations) or "NULL"
    return {"location_risk": flag(f"location IN ({listed})")}


def engineer_features(
    df: DataFrame, risky_locations: Sequence[str] | DataFrame = RISKY_LOCATIONS
) -> DataFrame:
    """Add the nine feature columns.

    ``risky_locations`` is a short list, tested in place, or a DataFrame with a ``location``
    column, joined (see ``flag_risky_locations``).
    """
    if isinstance(risky_locations, DataFrame):
        staged = with_sql(df, {**TIME_FEATURES, **AMOUNT_FEATURES})
        return with_sql(flag_risky_locations(staged, risky_locations), MERCHANT_FEATURES)
    added = {
        **TIME_FEATURES,
        **AMOUNT_FEATURES,
        **location_features(risky_locations),
        **MERCHANT_FEATURES,
    }
    return with_sql(df, added)


def flag_risky_locations(df: DataFrame, risk_table: DataFrame) -> DataFrame:
    """Add ``location_risk`` by an equi-join with a risk table of any size.

    The table's distinct locations are computed once. Adaptive execution sees their size and
    broadcasts a small table; with a larger one it splits a location that holds much of the data.
    """
    listed = risk_table.where("location IS NOT NULL").select("location").distinct().withColumn("_listed", F.lit(True))
    kept = [f"`{name}`" for name in df.columns if name != "location_risk"]
    return df.join(listed, "location", "left").selectExpr(*kept, f"{flag('_listed')} AS location_risk")
