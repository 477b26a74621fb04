import pytest
from pyspark.sql import functions as F

from cloakwork.functions import scalar
from cloakwork.operators import clean, encode, hierarchy
from cloakwork.operators.encode import Mapping, Steps
from cloakwork.plans import presets
from cloakwork.roles import bound_columns, dtype_histogram, numeric_columns, text_columns


def test_scaler_ignores_nulls_and_constants(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (None, 5.0)], "a double, b double")
    out = encode.fit_standard(df, ["a", "b"]).apply(df).collect()
    assert [tuple(r) for r in out] == [(-1.0, 0.0), (1.0, 0.0), (None, 0.0)]


def test_fitted_steps_apply_to_a_stream(spark, tmp_path):
    df = spark.createDataFrame([(float(i), "ab"[i % 2]) for i in range(10)], "a double, c string")
    path = str(tmp_path / "in")
    df.write.parquet(path)
    scaler, hot = encode.fit_standard(df, ["a"]), encode.fit_one_hot(df, ["c"])
    stream = hot.apply(scaler.apply(spark.readStream.schema(df.schema).parquet(path)))
    query = stream.writeStream.format("memory").queryName("scaled").start()
    query.processAllAvailable()
    query.stop()
    want = sorted(map(tuple, hot.apply(scaler.apply(df)).collect()))
    assert sorted(map(tuple, spark.table("scaled").collect())) == want


def test_ordinal_unknown(spark):
    df = spark.createDataFrame([("Poor",), ("Great",), (None,)], "c string")
    order = {"c": presets.CONDITION_ORDER}
    with pytest.raises(Exception, match="unknown category"):
        encode.Ordinal(order).apply(df).collect()
    assert [r["c"] for r in encode.Ordinal(order, strict=False).apply(df).collect()] == [0.0, None, None]


def test_codes_round_trip(spark):
    df = spark.createDataFrame([(2, "b"), (0, "c"), (1, "a"), (3, "c")], "i int, c string")
    first = encode.fit_first_codes(df, ["c"], "i")
    out = first.apply(df)
    assert {r["i"]: r["c"] for r in out.collect()} == {0: 0, 1: 1, 2: 2, 3: 0}
    assert {r["i"]: r["label"] for r in first.decode(out, "c", "label").collect()} == {0: "c", 1: "a", 2: "b", 3: "c"}
    labels = encode.fit_label_codes(df, ["c"]).apply(df)
    assert {r["i"]: r["c"] for r in labels.collect()} == {0: 2, 1: 0, 2: 1, 3: 2}


def test_sparse_one_hot(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",)], "c string")
    out = encode.fit_sparse_one_hot(df, "c").transform(df)
    assert out.filter(F.col("c") == "a").select("c_vector").distinct().count() == 1


def test_resampling_only_touches_training_rows(spark):
    df = spark.range(6).withColumn("x", F.col("id") * 2.0)
    twice = Mapping(lambda d: d.unionByName(d))
    steps = Steps([lambda d: encode.fit_standard(d, ["x"]), lambda d: twice], {1})
    fitted, train = steps.fit(df)
    assert train.count() == 12 and fitted.apply(df).count() == 6


def test_month_without_data_takes_the_calendar_month(spark):
    rows = [("2000-01-05", 1.0), ("2000-01-09", None), ("2001-01-03", 5.0), ("2002-01-02", None), ("2002-02-02", None)]
    df = spark.createDataFrame(rows, "d string, x double").withColumn("d", F.to_date("d"))
    out = {str(r["d"]): r["x"] for r in clean.month_mean_impute(df, "d", ["x"]).collect()}
    assert out["2000-01-09"] == 1.0 and out["2002-01-02"] == pytest.approx((1 + 1 + 5) / 3) and out["2002-02-02"] is None


def test_month_unseen_in_training_takes_the_calendar_month(spark):
    rows = [("2000-01-05", 1.0), ("2001-01-03", 5.0), ("2001-02-01", 9.0)]
    train = spark.createDataFrame(rows, "d string, x double").withColumn("d", F.to_date("d"))
    new = spark.createDataFrame([("2002-01-07", None), ("2002-02-07", 2.0), ("2002-03-01", None)], "d string, x double")
    new = new.withColumn("d", F.to_date("d"))
    out = clean.month_mean_impute(new, "d", ["x"], clean.month_means(train, "d", ["x"]))
    assert out.columns == new.columns
    assert {str(r["d"]): r["x"] for r in out.collect()} == {"2002-01-07": 3.0, "2002-02-07": 2.0, "2002-03-01": None}


def test_group_with_unknown_value_keeps_a_row(spark):
    tree = spark.createDataFrame([("all", None, 0), ("x", "all", 1), ("y", "all", 1)], "value string, parent string, level int")
    df = spark.createDataFrame([(1, "x"), (1, "x"), (2, "x"), (2, "y"), (3, "x"), (3, "lost"), (4, "lost")], "g int, v string")
    got = {r["g"]: (r["lca"], r["n"]) for r in hierarchy.group_lca(df, ["g"], "v", hierarchy.closure(tree)).collect()}
    assert got == {1: ("x", 2), 2: ("all", 2), 3: (None, 2), 4: (None, 1)}


def test_missing_limit(spark):
    cols = [f"c{i}" for i in range(20)]
    rows = [(i, *[None if j < i else 1.0 for j in range(20)]) for i in (14, 15, 16)]
    df = spark.createDataFrame(rows, "id int, " + ", ".join(f"{c} double" for c in cols))
    assert sorted(r["id"] for r in clean.keep_dense_rows(df, cols).collect()) == [14, 15]


def test_interval_texts(spark):
    df = spark.createDataFrame([("3~9",), ("3",), ("a~b",), ("1~2~3",), (None,), (" ",)], "v string")
    lo, hi = scalar.interval_bounds("v")
    got = [tuple(r) for r in df.select(lo, hi).collect()]
    assert got == [(3.0, 9.0), (3.0, 3.0), (None, None), (1.0, 3.0), (None, None), (None, None)]
    lists = [r[0] for r in df.select(scalar.category_list("v")).collect()]
    assert lists[2] == ["a", "b"] and lists[4] == ["missing"]


def test_truncation_and_digits(spark):
    df = spark.createDataFrame([(0.2, 0.9, "9th"), (-1.7, 2.5, "1a2"), (7.0, 7.0, "none")], "a double, b double, g string")
    out = df.select(
        scalar.format_interval("a", "b"), scalar.format_interval("a", "b", "exact"), scalar.first_digits("g"), scalar.all_digits("g")
    ).collect()
    assert [tuple(r) for r in out] == [("0~0", "0.2~0.9", 9, 9), ("-1~2", "-1.7~2.5", 1, 12), ("7", "7.0", None, 0)]


def test_schema_helpers(spark):
    df = spark.createDataFrame([(1, 2.0, "x")], "a int, b double, c string")
    assert numeric_columns(df) == ["a", "b"] and text_columns(df) == ["c"]
    assert dtype_histogram(df) == {"int": 1, "double": 1, "string": 1}
    assert bound_columns(["a_min", "a_max", "b"], ["a", "b", "z"]) == ["a_min", "a_max", "b"]


def test_regex_drop_trims_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["ID", " radius ", " area_mean"])
    assert clean.drop_columns(df, ["ID"], "perimeter|area").columns == ["radius"]
    wide = spark.createDataFrame([tuple(range(4))], ["WSR0", "T23", "T_AV", "x"])
    assert clean.drop_family(wide, ["WSR", "T"]).columns == ["T_AV", "x"]
