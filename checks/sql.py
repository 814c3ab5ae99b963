"""Building blocks of the oracle SQL (DuckDB)."""

from __future__ import annotations

KEY = (
    "DateTime, user_id, product, campaign_id, webpage_id, product_category_1, product_category_2, "
    "user_group_id, gender, age_level, user_depth, city_development_index, is_click"
)
COLUMNS = f"session_id, {KEY}"
ENCODED = ["product", "age_level", "time_of_day", "product_category_1", "webpage_id", "campaign_id"]
FEATURES = [
    "gender_encoding", "product_category_1_encoding", "product_encoding", "campaign_id_encoding",
    "age_level_encoding", "webpage_id_encoding", "time_of_day_encoding",
]

TIME_OF_DAY = """CASE WHEN {h} BETWEEN 1 AND 4 OR {h} = 23 THEN 'night' WHEN {h} BETWEEN 5 AND 9 THEN 'early-morning'
  WHEN {h} BETWEEN 10 AND 13 THEN 'morning' WHEN {h} BETWEEN 14 AND 17 THEN 'afternoon' ELSE 'evening' END"""
ISO = "strftime({t}, '%Y-%m-%dT%H:%M:%S.%g') || 'Z'"


def _mode(column: str, table: str = "base") -> str:
    return (
        f"(SELECT {column} FROM {table} WHERE {column} IS NOT NULL GROUP BY 1 "
        f"ORDER BY count(*) DESC, 1 LIMIT 1)"
    )


def _median(column: str, table: str = "base") -> str:
    return f"(SELECT median({column}) FROM {table})"


_FILLS = {
    "product": _mode("product"), "gender": _mode("gender"),
    **{c: _median(c) for c in (
        "product_category_2", "user_group_id", "age_level", "user_depth", "city_development_index"
    )},
}


def _rolling(value: str, name: str) -> str:
    return f"""counts_{value} AS (
  SELECT a.session_id, b.{value} AS v, sum(b.is_click) AS k, count(*) AS n FROM ranked a JOIN ranked b
    ON a.user_id = b.user_id AND b.rn BETWEEN a.rn - 23 AND a.rn GROUP BY 1, 2),
{name} AS (
  SELECT session_id, v AS {name}, modal FROM (
    SELECT session_id, v, first_value(v) OVER (PARTITION BY session_id ORDER BY n DESC, v) AS modal,
      row_number() OVER (PARTITION BY session_id ORDER BY CASE WHEN mk > 0 THEN k ELSE n END DESC, v) AS z
    FROM (SELECT *, max(k) OVER (PARTITION BY session_id) AS mk FROM counts_{value})) WHERE z = 1)"""


def codes(name: str, column: str, source: str) -> str:
    """Label codes of a column fitted on a table."""
    return (
        f"{name} AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INT) AS code "
        f"FROM (SELECT DISTINCT {column} AS v FROM {source} WHERE {column} IS NOT NULL))"
    )


def _code_tables(prefix: str, source: str) -> str:
    return ",\n".join(codes(f"{prefix}_{c}", c, source) for c in ENCODED)


def _encoded(prefix: str, source: str) -> str:
    lookups = ",\n  ".join(
        f"(SELECT code FROM {prefix}_{c} m WHERE m.v = s.{c}) AS {c}_encoding" for c in ENCODED
    )
    return f"""SELECT s.*, most_recent_clicked_product, most_recent_clicked_webpage,
  CASE lower(gender) WHEN 'female' THEN 0 WHEN 'male' THEN 1 END AS gender_encoding,
  {lookups},
  (SELECT code FROM {prefix}_product m WHERE m.v = most_recent_clicked_product) AS most_recent_clicked_product_encoding,
  (SELECT code FROM {prefix}_webpage_id m WHERE m.v = most_recent_clicked_webpage) AS most_recent_clicked_webpage_encoding
FROM {source} s JOIN most_recent_clicked_product USING (session_id) JOIN most_recent_clicked_webpage USING (session_id)"""


def profile(source: str) -> str:
    """Customer profile of an encoded table."""
    first = ", ".join(
        f"min_by({c}, (DateTime, session_id)) FILTER ({c} IS NOT NULL) AS {c}"
        for c in ("gender_encoding", "age_level_encoding")
    )
    return f"""SELECT user_id, {first},
  max(most_recent_clicked_product_encoding) AS most_recent_clicked_product_encoding,
  max(most_recent_clicked_webpage_encoding) AS most_recent_clicked_webpage_encoding FROM {source} GROUP BY user_id"""


_F1 = "coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0)"
_CELLS = (
    "sum(CASE WHEN is_click = 1 AND prediction = 1 THEN 1 ELSE 0 END) AS tp, "
    "sum(CASE WHEN is_click = 0 AND prediction = 1 THEN 1 ELSE 0 END) AS fp, "
    "sum(CASE WHEN is_click = 1 AND prediction = 0 THEN 1 ELSE 0 END) AS fn, "
    "sum(CASE WHEN is_click = 0 AND prediction = 0 THEN 1 ELSE 0 END) AS tn"
)

#: Common table expressions; each may use the ones before it.
CHAIN: dict[str, str] = {
    "impressions": """impressions AS (
  SELECT CASE WHEN event_id % 211 = 0 THEN NULL ELSE event_id + dup * 1000000000 END AS session_id,
    CASE WHEN event_id % 229 = 0 THEN NULL ELSE ts END AS DateTime,
    CASE WHEN event_id % 223 = 0 THEN NULL ELSE user_id END AS user_id,
    CASE WHEN k % 23 = 0 THEN NULL ELSE substr('ABCDEFGHIJ', 1 + k % 10, 1) END AS product,
    CAST(80000 + ((event_id * 7) % 10) * 30000 AS BIGINT) AS campaign_id,
    CAST(1000 + (event_id % 9) * 7000 AS BIGINT) AS webpage_id,
    CAST(1 + k % 5 AS BIGINT) AS product_category_1,
    CASE WHEN event_id % 4 <> 0 THEN NULL ELSE CAST(10000 + k * 100 AS DOUBLE) END AS product_category_2,
    CASE WHEN event_id % 29 = 0 THEN NULL ELSE CAST(user_id % 13 AS DOUBLE) END AS user_group_id,
    CASE WHEN event_id % 31 = 0 THEN NULL WHEN user_id % 3 = 0 THEN 'Female' ELSE 'Male' END AS gender,
    CASE WHEN event_id % 37 = 0 THEN NULL ELSE CAST(user_id % 7 AS DOUBLE) END AS age_level,
    CASE WHEN event_id % 41 = 0 THEN NULL ELSE CAST(1 + user_id % 3 AS DOUBLE) END AS user_depth,
    CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(1 + user_id % 4 AS DOUBLE) END AS city_development_index,
    CASE WHEN event_id % 227 = 0 THEN NULL WHEN event_type = 'click' THEN 1 ELSE 0 END AS is_click
  FROM (SELECT e.*, d.dup, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k
    FROM events e CROSS JOIN (SELECT 0 AS dup UNION ALL SELECT 1 AS dup) d
    WHERE d.dup = 0 OR e.event_id % 20 = 0) x)""",
    "required": """required AS (SELECT * FROM impressions WHERE session_id IS NOT NULL AND DateTime IS NOT NULL
  AND user_id IS NOT NULL AND is_click IS NOT NULL)""",
    "dedup": f"""dedup AS (SELECT {COLUMNS} FROM (SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY session_id) AS rn
  FROM required) WHERE rn = 1)""",
    "base": f"""base AS (SELECT *, CAST(hour(DateTime) AS INT) AS hour,
  {TIME_OF_DAY.format(h='hour(DateTime)')} AS time_of_day FROM dedup)""",
    "clean": "clean AS (SELECT * REPLACE ({}) FROM base)".format(
        ", ".join(f"coalesce({c}, {fill}) AS {c}" for c, fill in _FILLS.items())
    ),
    "rolling": """ranked AS (SELECT session_id, user_id, product, webpage_id, is_click,
    row_number() OVER (PARTITION BY user_id ORDER BY DateTime, session_id) AS rn FROM clean),
""" + _rolling("product", "most_recent_clicked_product") + ",\n"
        + _rolling("webpage_id", "most_recent_clicked_webpage"),
    "parts": """parts AS (SELECT *, CASE WHEN DateTime < TIMESTAMP '2024-01-21' THEN 'train'
    WHEN DateTime < TIMESTAMP '2024-01-26' THEN 'validation' ELSE 'test' END AS split FROM clean),
train AS (SELECT * FROM parts WHERE split = 'train')""",
    "encoded": _code_tables("t", "train") + ",\nencoded AS (" + _encoded("t", "parts") + ")",
    "encoded_all": _code_tables("a", "clean") + ",\nencoded_all AS (" + _encoded("a", "clean")
        + "),\ncustomers AS (" + profile("encoded_all") + "),\ntrain_customers AS ("
        + profile("(SELECT * FROM encoded WHERE split = 'train')") + ")",
    "loads": """loads AS (
  SELECT *, '2024-02-01T00:00:00.000Z' AS event_time, DATE '2024-02-01' AS event_date FROM train_customers
  UNION ALL BY NAME SELECT *, '2024-02-02T00:00:00.000Z' AS event_time, DATE '2024-02-02' AS event_date FROM ("""
        + profile("(SELECT * FROM encoded WHERE split <> 'train')") + """)),
latest AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_time DESC) AS rn
  FROM loads) WHERE rn = 1)""",
    "predictions": f"""rates AS (SELECT product, sum(is_click) / count(session_id) AS ctr FROM clean GROUP BY 1),
predictions AS (SELECT session_id, DateTime, user_id, c.product, is_click, ctr AS probability,
  CASE WHEN ctr > (SELECT sum(is_click) / count(is_click) FROM clean) THEN 1 ELSE 0 END AS prediction
  FROM clean c JOIN rates r ON c.product = r.product),
cells AS (SELECT {_CELLS} FROM predictions),
reports AS (SELECT product, {_F1} AS f1_score FROM (SELECT product, {_CELLS} FROM predictions GROUP BY 1)),
registry AS (SELECT 'ctr-' || product AS model_group, CAST(day(d) AS INT) AS version,
  'models/' || product || '/' || CAST(day(d) AS INT) AS model_path,
  CASE WHEN day(d) % 3 = 0 AND product <> 'A' THEN 'Approved' WHEN day(d) % 3 = 1 THEN 'PendingManualApproval'
    ELSE 'Rejected' END AS status,
  CAST(d AS TIMESTAMP) AS created, {_F1} AS f1
  FROM (SELECT product, CAST(DateTime AS DATE) AS d, {_CELLS} FROM predictions GROUP BY 1, 2))""",
    "requests": """requests AS (SELECT CAST(floor(session_id / 16) AS BIGINT) AS batch_id,
  CAST(row_number() OVER (PARTITION BY floor(session_id / 16) ORDER BY session_id) - 1 AS INT) AS position,
  CASE WHEN session_id % 19 = 0 THEN user_id + 1000000 ELSE user_id END AS user_id,
  CASE WHEN session_id % 3 = 0 THEN upper(gender) ELSE gender END AS gender, product_category_1,
  CASE WHEN session_id % 17 = 0 THEN 'Z' ELSE product END AS product, campaign_id, age_level, webpage_id, hour FROM base)""",
    "request_features": "request_features AS (SELECT batch_id, position, r.user_id, "
        "CASE lower(gender) WHEN 'female' THEN 0 WHEN 'male' THEN 1 END AS gender_encoding, "
        + ", ".join(
            f"(SELECT code FROM a_{c} m WHERE m.v = "
            + (TIME_OF_DAY.format(h="hour") if c == "time_of_day" else f"r.{c}")
            + f") AS {c}_encoding" for c in ENCODED
        )
        + ", coalesce(CAST(most_recent_clicked_product_encoding AS DOUBLE), -1) AS most_recent_clicked_product_encoding"
        " FROM requests r LEFT JOIN customers c ON r.user_id = c.user_id)",
}


def sql(body: str, upto: str = "impressions") -> str:
    """The query with the common tables up to the named one."""
    names = list(CHAIN)
    used = names[: names.index(upto) + 1]
    return "WITH " + ",\n".join(CHAIN[n] for n in used) + "\n" + body
