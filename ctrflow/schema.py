"""Columns and types of the impression log and of the tables derived from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

# ---- fixed values: names and types of the impression log ------------------------------------
IMPRESSIONS = T.StructType([
    T.StructField("session_id", T.LongType()),
    T.StructField("DateTime", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("product", T.StringType()),
    T.StructField("campaign_id", T.LongType()),
    T.StructField("webpage_id", T.LongType()),
    T.StructField("product_category_1", T.LongType()),
    T.StructField("product_category_2", T.DoubleType()),
    T.StructField("user_group_id", T.DoubleType()),
    T.StructField("gender", T.StringType()),
    T.StructField("age_level", T.DoubleType()),
    T.StructField("user_depth", T.DoubleType()),
    T.StructField("city_development_index", T.DoubleType()),
    T.StructField("is_click", T.IntegerType()),
])
REQUIRED = ["session_id", "DateTime", "user_id", "is_click"]
ID, TIME, USER, TARGET = "session_id", "DateTime", "user_id", "is_click"
DEDUP_KEY = [name for name in IMPRESSIONS.names if name != ID]
ENCODED = ["product", "age_level", "time_of_day", "product_category_1", "webpage_id", "campaign_id"]
ENGINEERED = {"product": "most_recent_clicked_product", "webpage_id": "most_recent_clicked_webpage"}
FEATURES = [
    "is_click", "gender_encoding", "product_category_1_encoding", "product_encoding",
    "campaign_id_encoding", "age_level_encoding", "webpage_id_encoding", "time_of_day_encoding",
]
FEATURES_ENGINEERED = [*FEATURES, "most_recent_clicked_product_encoding"]
# ---- end of fixed values --------------------------------------------------------------------

_KINDS = {
    "Integral": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    "Fractional": (T.FloatType, T.DoubleType, T.DecimalType),
    "String": (T.StringType,),
}


def columns_of(df: DataFrame, *kinds: str) -> list[str]:
    """Columns of the kinds Integral, Fractional and String, in frame order."""
    wanted = tuple(t for kind in kinds for t in _KINDS[kind])
    return [f.name for f in df.schema if isinstance(f.dataType, wanted)]


def select_by_kind(df: DataFrame, *kinds: str) -> DataFrame:
    return df.select(*columns_of(df, *kinds))


def feature_kind(dtype: T.DataType) -> str:
    """The declared kind a column type maps to; whatever is not a number is stored as a string."""
    return next((kind for kind, types in _KINDS.items() if isinstance(dtype, types)), "String")


def infer_definitions(df: DataFrame) -> dict[str, str]:
    """Feature definitions (name to kind) of a frame."""
    return {f.name: feature_kind(f.dataType) for f in df.schema}


def project(df: DataFrame, columns: list[str]) -> DataFrame:
    """Model features in order, target first; Spark names a missing one in its error."""
    return df.select(*columns)


def drop_columns(df: DataFrame, *columns: str) -> DataFrame:
    return df.drop(*columns)


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def to_string(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def spare_names(df: DataFrame, *names: str) -> list[str]:
    """Each name with as many underscores in front as it takes to be no column of ``df``, whatever the case of letters."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        found.append(name)
        taken.add(name.lower())
    return found
