"""Profiler: dataset checks and per-column profile."""

from blocklot.operators import profile


def test_duplicates_count_all_copies(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,), (None,)], "v bigint")
    row = profile.dataset_checks(df).first()
    assert (row.total_rows, row.duplicated_rows, row.rows_with_missing, row.columns) == (6, 5, 2, 1)


def test_profile_columns(spark):
    rows = [(i, float(i % 3) if i % 5 else None, "t" + str(i % 2), float(i)) for i in range(1, 41)]
    rows.append((41, 1.0, "t1", 10000.0))
    df = spark.createDataFrame(rows, "id bigint, small double, label string, big double")
    got = {r.column_name: r for r in profile.profile_columns(df).collect()}
    assert got["small"].sample == "0.0,1.0,2.0,nan"
    assert got["small"].missing == 8
    assert got["label"].sample == "t0,t1"
    assert got["label"].outliers is None
    assert got["id"].sample == "bounds: 1-41"
    assert got["big"].outliers == 1
    assert got["big"].dtype == "double"
    nulls = profile.profile_columns(df, propagate_nulls=True).collect()
    assert {r.column_name: r.outliers for r in nulls}["small"] == 0


def test_many_strings_and_null_counts(spark):
    df = spark.createDataFrame([(str(i), None if i % 4 == 0 else i) for i in range(30)], "s string, n bigint")
    got = {r.column_name: r for r in profile.profile_columns(df).collect()}
    assert got["s"].sample == "many str values"
    counts = {r.column_name: r.missing for r in profile.null_counts(df).collect()}
    assert counts == {"s": 0, "n": 8}
