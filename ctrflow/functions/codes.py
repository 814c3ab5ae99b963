"""Fixed codes and labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# ---- fixed values ---------------------------------------------------------------------------
GENDER_CODES = {"female": 0, "male": 1}
CLICKED, NOT_CLICKED = "Clicked", "Not Clicked"
# ---- end of fixed values --------------------------------------------------------------------


def gender_code(gender: Column) -> Column:
    """Code of a gender in any letter case; null when it is neither."""
    lowered = F.lower(gender)
    return (
        F.when(lowered == "female", GENDER_CODES["female"])
        .when(lowered == "male", GENDER_CODES["male"])
    )


def threshold_label(probability: Column, threshold: float = 0.5, inclusive: bool = False) -> Column:
    """1 above the threshold, else 0. Serving compares strictly, evaluation includes equality."""
    above = probability >= threshold if inclusive else probability > threshold
    return F.when(above, 1).otherwise(0)


def click_text(label: Column) -> Column:
    return F.when(label == 1, CLICKED).otherwise(NOT_CLICKED)


def as_csv_row(columns: list[str]) -> Column:
    """All columns of a row as one comma-separated string; a null keeps its position, empty."""
    return F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
