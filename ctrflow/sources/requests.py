"""Scoring requests: JSON batches of positional rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# ---- fixed values: positions and types of a request row --------------------------------------
POSITIONS = {
    "user_id": "bigint", "gender": "string", "product_category_1": "bigint", "product": "string",
    "campaign_id": "bigint", "age_level": "double", "webpage_id": "bigint", "hour": "int",
}
# ---- end of fixed values --------------------------------------------------------------------


def parse_requests(df: DataFrame, body: str = "body") -> DataFrame:
    """One typed row per request row, with its ``position`` in the batch.

    The body is ``{"data": [[user_id, gender, ...], ...]}``. Other columns of ``df`` are kept.
    """
    rows = F.from_json(F.col(body), "data array<array<string>>")["data"]
    exploded = df.select(
        *[c for c in df.columns if c != body], F.posexplode(rows).alias("position", "_row")
    )
    typed = [
        F.get("_row", F.lit(at)).try_cast(dtype).alias(name)
        for at, (name, dtype) in enumerate(POSITIONS.items())
    ]
    return exploded.select(*[c for c in exploded.columns if c != "_row"], *typed)


def request_row() -> Column:
    """A request row as an array of texts, from columns with the names of the positions."""
    return F.array(*[F.col(c).cast("string") for c in POSITIONS])


def as_request(rows: Column) -> Column:
    """The JSON body of a batch, from an array of request rows."""
    return F.to_json(F.struct(rows.alias("data")))
