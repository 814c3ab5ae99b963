from collections import Counter

import pytest
from pyspark.sql import functions as F

from ctrflow.operators.rolling import _cut_users, _place, rolling_top
from checks import fixtures as fx
from tests.conftest import SMALL, executed, plan, same, skewed, table

NAME = {"product": "top"}


def expected(rows, frame=24, include_current=True, use_clicks=True):
    """Rows of one user in order: (session, product, click)."""
    out = {}
    for i, (session, _, _) in enumerate(rows):
        end = i + 1 if include_current else i
        window = rows[max(0, end - frame):end]
        counts = Counter(p for _, p, c in window if c) if use_clicks else Counter()
        counts = counts or Counter(p for _, p, _ in window)
        out[session] = min(counts, key=lambda p: (-counts[p], p)) if counts else None
    return out


def brute_force(df, **options):
    by_user = {}
    for r in df.orderBy("user_id", "DateTime", "session_id").collect():
        by_user.setdefault(r.user_id, []).append((r.session_id, r["product"], r.is_click))
    out = {}
    for rows in by_user.values():
        out |= expected(rows, **options)
    return out


def result(df):
    return {r.session_id: r.top for r in df.select("session_id", "top").collect()}


@pytest.mark.parametrize("n", [1, 23, 24, 25])
def test_frame_is_24_rows_and_shorter_at_the_start(rows_of, n):
    df = rows_of(*[{"DateTime": i, "product": "Z" if i == 0 else "A", "is_click": int(i == 0)} for i in range(n)])
    out = result(rolling_top(df, NAME))
    assert out == brute_force(df)
    # The click of the first row counts until 24 rows later.
    assert out[n] == ("Z" if n <= 24 else "A")


def test_frequency_without_clicks_and_ties_to_the_lowest(rows_of):
    df = rows_of(*[{"DateTime": i, "product": p} for i, p in enumerate("CBBCA")])
    assert result(rolling_top(df, NAME)) == {1: "C", 2: "B", 3: "B", 4: "B", 5: "B"}


def test_clicks_win_over_frequency_and_tie_to_the_lowest(rows_of):
    df = rows_of(*[
        {"DateTime": i, "product": p, "is_click": c} for i, (p, c) in enumerate([("A", 0), ("A", 0), ("C", 1), ("B", 1), ("C", 1)])
    ])
    assert result(rolling_top(df, NAME)) == {1: "A", 2: "A", 3: "C", 4: "B", 5: "C"}
    assert result(rolling_top(df, NAME, clicked=None)) == {1: "A", 2: "A", 3: "A", 4: "A", 5: "A"}


def test_equal_times_are_ordered_by_session(rows_of):
    df = rows_of({"session_id": 9, "product": "B"}, {"session_id": 4, "product": "A"})
    assert result(rolling_top(df, NAME)) == {4: "A", 9: "A"}
    assert result(rolling_top(df, NAME, frame_rows=1)) == {4: "A", 9: "B"}


def test_current_row_can_be_left_out(rows_of):
    df = rows_of(*[{"DateTime": i, "product": p} for i, p in enumerate("ABB")])
    assert result(rolling_top(df, NAME, include_current=False)) == {1: None, 2: "A", 3: "A"}


@pytest.mark.parametrize("use_clicks", [True, False])
@pytest.mark.parametrize("include_current", [True, False])
def test_equals_brute_force_on_all_rows(clean, include_current, use_clicks):
    options = {"include_current": include_current}
    out = rolling_top(clean, NAME, clicked="is_click" if use_clicks else None, **options)
    assert result(out) == brute_force(clean, use_clicks=use_clicks, **options)


@pytest.fixture(scope="module")
def uneven(clean):
    """One user has most rows, some of them without a time or a row id; other rows have no user."""
    hot = F.col("session_id") % 5 != 0
    return clean.withColumns({
        "user_id": F.when(hot, 1).when(F.col("session_id") % 10 == 0, F.lit(None)).otherwise(F.col("user_id")),
        "DateTime": F.when(F.col("session_id") % 7 == 0, F.lit(None)).otherwise(F.col("DateTime")),
    })


@pytest.mark.parametrize("parts", [1, 3, 8, 200])
@pytest.mark.parametrize("include_current", [True, False])
def test_cut_users_give_the_same_result(clean, parts, include_current):
    df = skewed(clean)
    out = rolling_top(df, NAME, parts=parts, include_current=include_current)
    assert result(out) == brute_force(df, include_current=include_current)
    assert out.count() == df.count()
    assert out.columns == [*df.columns, "top"]


@pytest.mark.parametrize("parts", [1, 8, 150])
def test_null_times_null_users_and_a_user_with_most_rows(uneven, parts):
    assert uneven.where("user_id IS NULL").count() > 30 and uneven.where("DateTime IS NULL").count() > 100
    assert uneven.where("user_id = 1").count() > 0.7 * uneven.count()
    # collect() sorts nulls first, as the operator does.
    assert result(rolling_top(uneven, NAME, parts=parts)) == brute_force(uneven)


def test_a_user_with_most_rows_is_cut_evenly(clean):
    df = skewed(clean)
    order = ["DateTime", "session_id"]
    cuts = _cut_users(df, "user_id", order, 30, "at", "cuts")
    assert cuts.agg(F.sum(F.size(F.flatten("cuts")))).first()[0] < 30
    parts = df.join(cuts, "user_id", "left").withColumn("part", _place(F.struct(*order), F.col("cuts")))
    biggest = parts.groupBy("user_id", "part").count().agg(F.max("count")).first()[0]
    assert biggest <= 3 * df.count() / 30 < df.where("user_id = 1").count() / 3


def test_only_busy_users_are_cut(rows_of):
    """40 users of 5 rows need no cut for 4 ranges of 50 rows; of one more user with 100 rows only that one is cut."""
    quiet = [{"DateTime": i % 5, "user_id": 2 + i % 40, "product": "ABC"[i % 3], "is_click": int(i % 7 == 0)} for i in range(200)]
    busy = [{"DateTime": i, "product": "ABC"[i % 3], "is_click": int(i % 5 == 0)} for i in range(100)]
    order = ["DateTime", "session_id"]
    few, more = rows_of(*quiet), rows_of(*quiet, *busy)
    assert _cut_users(few, "user_id", order, 4, "at", "cuts") is None
    assert [r[0] for r in _cut_users(more, "user_id", order, 4, "at", "cuts").select("user_id").collect()] == [1]
    for df in (few, more, few.limit(0), rows_of({"user_id": None}, {"user_id": None})):
        assert result(rolling_top(df, NAME, parts=4)) == brute_force(df)
    # Without cuts the rows are sorted once, for the windows of the users.
    final = executed(rolling_top(few, NAME, parts=4)).split("Initial Plan")[0]
    assert final.count("+- Exchange hashpartitioning") == 1 and "ReusedExchange" not in final and final.count("Window [") == 1


def test_rows_of_one_time_and_id_cannot_be_cut_but_stay(rows_of):
    df = rows_of(*[{"session_id": 1}] * 30)
    assert rolling_top(df, NAME, parts=5).count() == 30


def test_helper_columns_do_not_hide_others(clean):
    df = clean.withColumns({c: F.lit(c) for c in ("_at", "_cuts", "_part", "_head", "_tail", "_owner", "_range")})
    out = rolling_top(df, NAME, parts=9)
    assert out.columns == [*df.columns, "top"] and result(out) == brute_force(clean)
    assert out.select("_cuts", "_part").distinct().collect() == [("_cuts", "_part")]


def test_nothing_is_counted_or_sorted_into_ranges_in_the_plan(clean):
    text = plan(rolling_top(clean, NAME))
    assert "rangepartitioning" not in text and "count(" not in text


def test_both_features_share_one_shuffle_of_the_rows(spark):
    out = rolling_top(fx.clean(spark, SMALL))
    text = executed(out.select("most_recent_clicked_product", "most_recent_clicked_webpage"))
    final = text.split("Initial Plan")[0]
    # The rows once, and once more the few at the edges of ranges.
    assert final.count("+- Exchange hashpartitioning") == 2 and final.count("ReusedExchange") == 1


def test_value_comes_from_the_frame(clean):
    out = rolling_top(clean, NAME)
    pairs = clean.select("user_id", F.col("product").alias("top")).distinct()
    assert out.select("user_id", "top").join(pairs, ["user_id", "top"], "left_anti").isEmpty()


def test_same_for_any_partitioning(clean):
    a, b = (rolling_top(clean.repartition(n)) for n in (1, 11))
    assert same(a, b)
    assert table(a.select("session_id"), "session_id") == table(clean.select("session_id"), "session_id")
