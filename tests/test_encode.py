import pytest
from pyspark.sql import functions as F

from ctrflow.functions.codes import gender_code
from ctrflow.operators import encode
from ctrflow.operators.split import time_split
from ctrflow.schema import ENCODED
from tests.conftest import executed, same, table

# ---- fixed values: codes of the serving maps --------------------------------------------------
PRODUCTS = {"A": 0, "B": 1, "C": 2, "D": 3, "E": 4, "F": 5, "G": 6, "H": 7, "I": 8, "J": 9}
CAMPAIGNS = {82320: 0, 98970: 1, 105960: 2, 118601: 3, 359520: 4, 360936: 5, 396664: 6, 404347: 7, 405490: 8, 414149: 9}
AGES = {0.0: 0, 1.0: 1, 2.0: 2, 3.0: 3, 4.0: 4, 5.0: 5, 6.0: 6}
WEBPAGES = {1734: 0, 6970: 1, 11085: 2, 13787: 3, 28529: 4, 45962: 5, 51181: 6, 53587: 7, 60305: 8}
CATEGORIES = {1: 0, 2: 1, 3: 2, 4: 3, 5: 4}
# ---- end of fixed values ----------------------------------------------------------------------


@pytest.mark.parametrize("column, codes", [
    ("product", PRODUCTS), ("campaign_id", CAMPAIGNS), ("age_level", AGES), ("webpage_id", WEBPAGES),
    ("product_category_1", CATEGORIES),
])
def test_label_codes_equal_the_serving_maps(rows_of, column, codes):
    df = rows_of(*[{column: v} for v in reversed(codes)])
    out = encode.fit_label(df, [column]).transform(df)
    assert dict(table(out.select(column, f"{column}_encoding"))) == codes


def test_unseen_label(rows_of):
    train, other = rows_of({"product": "A"}, {"product": "B"}), rows_of({"product": "B"}, {"product": "Z"})
    encoder = encode.fit_label(train, ["product"])
    with pytest.raises(Exception, match="unseen label in product: Z"):
        encoder.transform(other).collect()

    def coded(**options):
        return table(encoder.transform(other, **options).select("product_encoding"), "product_encoding")

    assert coded(on_unseen="null") == [(None,), (1,)]
    assert coded(on_unseen="value", unseen_value=-1) == [(-1,), (1,)]
    with pytest.raises(ValueError):
        encoder.transform(other, on_unseen="ignore")


def test_nulls_get_no_code(rows_of):
    df = rows_of({"product": "B"}, {"product": None})
    encoder = encode.fit_label(df, ["product"])
    assert encoder.mapping.count() == 1
    assert table(encoder.transform(df, on_unseen="null").select("product_encoding"), "product_encoding") == [(None,), (0,)]


def test_codes_are_a_bijection(clean):
    mapping = encode.fit_label(clean, ENCODED).mapping
    for column in ENCODED:
        codes = [r.code for r in mapping.where(F.col("column") == column).collect()]
        assert sorted(codes) == list(range(clean.select(column).distinct().count()))


def test_ordinal_ranks_by_rate_then_value(rows_of):
    df = rows_of(
        {"product": "A", "is_click": 1}, {"product": "B"}, {"product": "C", "is_click": 1}, {"product": "C"}, {"product": "D"},
    )
    out = encode.fit_ordinal_ctr(df, ["product"]).transform(df)
    assert dict(table(out.select("product", "product_encoding"))) == {"B": 0, "D": 1, "C": 2, "A": 3}


def test_engineered_column_takes_the_codes_of_its_base(rows_of):
    df = rows_of({"product": "A"}, {"product": "B"}).withColumn("recent", F.lit("B"))
    out = encode.fit_label(df, ["product"]).transform(df, {"product": "product", "recent": "product"})
    assert table(out.select("product", "product_encoding", "recent_encoding"), "product") == [("A", 0, 1), ("B", 1, 1)]


def test_mapping_survives_a_round_trip(spark, clean, tmp_path):
    encoder = encode.fit_label(clean, ENCODED)
    encoder.save(str(tmp_path / "m"))
    loaded = encode.Encoder.load(spark, str(tmp_path / "m"))
    assert same(loaded.mapping, encoder.mapping)
    assert same(loaded.transform(clean, ENCODED), encoder.transform(clean, ENCODED))


def test_more_labels_than_fit_the_driver(clean):
    columns = ["session_id", "product", "webpage_id"]
    few = encode.fit_label(clean, columns)
    many = encode.fit_label(clean, columns, max_labels=7)
    assert few.mapping.isLocal() and not many.mapping.isLocal()
    assert same(few.mapping, many.mapping)
    assert same(few.transform(clean), many.transform(clean))
    assert same(encode.fit_ordinal_ctr(clean, columns, max_labels=7).mapping, encode.fit_ordinal_ctr(clean, columns).mapping)


def test_small_mapping_is_broadcast_without_a_shuffle_of_the_rows(clean):
    out = encode.fit_label(clean, ENCODED).transform(clean)
    text = executed(out).split("Initial Plan")[0]
    assert text.count("BroadcastHashJoin") == len(ENCODED) and "hashpartitioning" not in text


def smoothed(ys, mean, variance):
    n, m = len(ys), sum(ys) / len(ys)
    spread = sum((y - m) ** 2 for y in ys)
    weight = variance * n / (variance * n + spread / n)
    return weight * m + (1 - weight) * mean


def test_target_encoding_by_hand(rows_of):
    data = [("A", 1), ("A", 0), ("A", 0), ("B", 1), ("B", 1), ("B", 0), ("C", 0)]
    df = rows_of(*[{"product": p, "is_click": y} for p, y in data])
    ys = [y for _, y in data]
    mean = sum(ys) / len(ys)
    variance = sum((y - mean) ** 2 for y in ys) / len(ys)
    encoder = encode.fit_target(df, ["product"])
    out = encoder.transform(rows_of(*[{"product": p} for p in "ABCZ"]))
    got = dict(table(out.select("product", "product_encoding")))
    for p in "ABC":
        assert got[p] == pytest.approx(smoothed([y for q, y in data if q == p], mean, variance))
    assert got["Z"] == pytest.approx(mean)


def test_cross_fit_leaves_the_own_fold_out(rows_of):
    data = [("A", i % 2) for i in range(20)] + [("B", 1)]
    df = rows_of(*[{"product": p, "is_click": y} for p, y in data])
    encoder = encode.fit_target(df, ["product"])
    for row in encoder.transform_train(df).collect():
        other = [(p, y) for i, (p, y) in enumerate(data, 1) if i % 5 != row.session_id % 5]
        ys = [y for _, y in other]
        mean = sum(ys) / len(ys)
        variance = sum((y - mean) ** 2 for y in ys) / len(ys)
        own = [y for p, y in other if p == row["product"]]
        want = smoothed(own, mean, variance) if own else mean
        assert row.product_encoding == pytest.approx(want)


def test_target_encoding_with_many_labels(clean):
    few = encode.fit_target(clean, ["product", "webpage_id"])
    many = encode.fit_target(clean, ["product", "webpage_id"], max_labels=3)
    for name in ("transform", "transform_train"):
        a, b = (
            getattr(e, name)(clean).select("session_id", F.round("product_encoding", 9), F.round("webpage_id_encoding", 9))
            for e in (few, many)
        )
        assert same(a, b)


def test_gender_codes(rows_of):
    df = rows_of({"gender": "Female"}, {"gender": "MALE"}, {"gender": "x"}, {"gender": None})
    assert table(df.select(gender_code(F.col("gender"))).coalesce(1)) == [(0,), (1,), (None,), (None,)]


def test_codes_come_from_the_training_rows(clean):
    train, validation, _ = time_split(clean, "2024-01-21", "2024-01-26")
    encoder = encode.fit_label(train, ENCODED)
    assert encoder.transform(validation, on_unseen="null").count() == validation.count()
