import hashlib

import pytest
from pyspark.sql import functions as F

from ctrflow.operators import sample
from ctrflow.operators.split import class_split, time_split, union_rows, with_split
from tests.conftest import executed, same, table


def order(session):
    return hashlib.md5(f"{session}:42".encode()).hexdigest()


def sessions(df, **where):
    for c, v in where.items():
        df = df.where(F.col(c) == v)
    return [r.session_id for r in df.select("session_id").collect()]


def test_downsample_is_exact_and_the_first_of_the_hash_order(clean):
    out = sample.downsample(clean)
    ones, zeros = sessions(clean, is_click=1), sessions(clean, is_click=0)
    assert sorted(sessions(out, is_click=1)) == sorted(ones)
    assert sorted(sessions(out, is_click=0)) == sorted(sorted(zeros, key=order)[: len(ones)])


def test_downsample_result_is_a_plain_filter(clean):
    text = executed(sample.downsample(clean))
    assert "Exchange" not in text and "Sort" not in text


def test_downsample_edge_cases(rows_of):
    with pytest.raises(ValueError, match="fewer rows"):
        sample.downsample(rows_of({"is_click": 1}, {"is_click": 1}, {"is_click": 0}))
    with pytest.raises(ValueError, match="fewer rows"):
        sample.downsample(rows_of({"is_click": 1}))
    assert sample.downsample(rows_of({"is_click": 0}, {"is_click": 0})).count() == 0
    assert sample.downsample(rows_of({"is_click": None})).count() == 0
    assert table(sample.downsample(rows_of({"is_click": 1}, {}, {"is_click": 5})).select("is_click"), "is_click") == [(0,), (1,)]
    assert sample.downsample(rows_of({"is_click": 1}, {"is_click": 1}, {}, {})).count() == 4


def test_downsample_needs_a_key_that_identifies_rows(rows_of):
    df = rows_of({"session_id": 1, "is_click": 1}, {"session_id": 2}, {"session_id": 2}, {"session_id": 2})
    with pytest.raises(ValueError, match="does not identify"):
        sample.downsample(df)


@pytest.mark.parametrize("most", [0, 3])
def test_boundary_bucket_is_split_by_further_digits(clean, rows_of, monkeypatch, most):
    want = sample.downsample(clean)
    monkeypatch.setattr(sample, "RANKED_ROWS", most)
    assert same(sample.downsample(clean), want)
    monkeypatch.setattr(sample, "bucket", lambda hashed: F.substring(hashed, 1, 0))
    assert same(sample.downsample(clean), want)
    repeated = rows_of({"session_id": 1, "is_click": 1}, *[{"session_id": 2}] * 5)
    with pytest.raises(ValueError, match="identify"):
        sample.downsample(repeated)


def test_upsample_is_exact(clean):
    out = sample.upsample(clean)
    ones, zeros = sorted(sessions(clean, is_click=1), key=order), sessions(clean, is_click=0)
    want = [ones[int(order(i)[:15], 16) % len(ones)] for i in range(len(zeros))]
    assert sorted(sessions(out, is_click=1)) == sorted(want)
    assert sorted(sessions(out, is_click=0)) == sorted(zeros)
    assert out.columns == clean.columns


def test_upsample_edge_cases(rows_of):
    with pytest.raises(ValueError, match="no rows to draw"):
        sample.upsample(rows_of({}, {}))
    assert sample.upsample(rows_of({"is_click": 1})).count() == 0
    with pytest.raises(ValueError):
        sample.balance(rows_of({}), "both")


def test_row_numbers_are_dense_in_hash_order(clean):
    out = sample.number_in_hash_order(clean, "number")
    got = {r.number: r.session_id for r in out.select("number", "session_id").collect()}
    assert got == dict(enumerate(sorted(sessions(clean), key=order)))


@pytest.mark.parametrize("how", ["downsample", "upsample"])
def test_balancing_does_not_depend_on_partitioning(clean, how):
    assert same(sample.balance(clean.repartition(7), how), sample.balance(clean.coalesce(1), how))


def test_other_seed_gives_other_rows(clean):
    a, b = (set(sessions(sample.downsample(clean, seed=s), is_click=0)) for s in (1, 2))
    assert len(a) == len(b) and a != b


def test_shuffle_keeps_all_rows_in_hash_order(clean):
    assert sessions(sample.shuffle_rows(clean)) == sorted(sessions(clean), key=order)
    assert sessions(sample.sample_rows(clean, 5)) == sorted(sessions(clean), key=order)[:5]


def test_time_split_covers_and_is_disjoint(clean):
    parts = time_split(clean, "2024-01-10", "2024-01-20")
    assert same(union_rows(union_rows(parts[0], parts[1]), parts[2]), clean)
    labels = dict(table(with_split(clean, "2024-01-10", "2024-01-20").groupBy("split").count()))
    assert labels == {n: p.count() for n, p in zip(("train", "validation", "test"), parts)}


def test_cut_points_belong_to_the_later_part(rows_of, spark):
    import datetime

    day = datetime.datetime(2024, 1, 10)
    df = rows_of({"DateTime": day}, {"DateTime": day - datetime.timedelta(microseconds=1)})
    train, validation, test = time_split(df, "2024-01-10", "2024-01-11")
    assert sessions(train) == [2] and sessions(validation) == [1] and sessions(test) == []


def test_split_filter_reaches_the_scan(clean, spark, tmp_path):
    clean.write.parquet(str(tmp_path / "t"))
    _, validation, _ = time_split(spark.read.parquet(str(tmp_path / "t")), "2024-01-10", "2024-01-20")
    text = executed(validation)
    assert "GreaterThanOrEqual(DateTime,2024-01-10T00:00)" in text and "LessThan(DateTime,2024-01-20T00:00)" in text


def test_class_split_drops_other_values(rows_of):
    zero, one = class_split(rows_of({"is_click": 0}, {"is_click": 1}, {"is_click": 2}, {"is_click": None}))
    assert sessions(zero) == [1] and sessions(one) == [2]
