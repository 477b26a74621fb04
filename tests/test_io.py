import json

import pytest
from pyspark.sql import functions as F

from cloakwork.operators import hierarchy
from cloakwork.roles import AnonSpec
from cloakwork.session import discard, materialize
from cloakwork.sources import sinks, tables


def write(path, text):
    path.write_text(text)
    return str(path)


def test_csv_scans(spark, tmp_path):
    df = tables.read_csv(spark, write(tmp_path / "a.csv", "d,x\n2000-01-01,?\n2000-01-02,1.5\n"), "d string, x double", null_token="?")
    assert [r["x"] for r in df.collect()] == [None, 1.5]
    semi = tables.read_csv(spark, write(tmp_path / "b.csv", "a;b\n1~2;x\n"), sep=";")
    assert semi.first().asDict() == {"a": "1~2", "b": "x"}
    assert tables.read_csv(spark, write(tmp_path / "c.csv", "a\nNaN\n2\n"), "a double").filter(F.col("a").isNull()).count() == 1


def test_microdata(spark, tmp_path):
    path = write(tmp_path / "m.csv", "age,job,day,sa\n30, cook ,2020-01-02,x\n?,cook,2020-01-02,y\n31,,2020-01-02,z\n44,smith,2021-05-06,w\n")
    qi = {"age": (0, "number"), "job": (1, "category"), "day": (2, "datetime")}
    got = tables.read_microdata(spark, path, qi, ("sa", 3), time_format="yyyy-MM-dd").collect()
    assert sorted((r["age"], r["job"], r["day"].year, r["sa"]) for r in got) == [(30.0, "cook", 2020, "x"), (44.0, "smith", 2021, "w")]


def test_persons_and_adjacency(spark, tmp_path):
    p = write(tmp_path / "p.csv", "id,age,workclass,native-country,sex,race,marital-status\n7,33, Private ,US,F,W,Single\n")
    assert tables.read_persons(spark, p).first()["workclass"] == "Private"
    edges = tables.read_adjacency(spark, write(tmp_path / "g.csv", "1,2,3,\n4,\n5,6,\n")).collect()
    assert sorted((r["src"], r["dst"], r["position"]) for r in edges) == [(1, 2, 0), (1, 3, 1), (5, 6, 0)]


TREE = {
    "name": "Branch",
    "entries": {
        "all": {"name": "*", "gen": "all", "level": 0},
        "A": {"name": "A", "gen": "all", "level": 1},
        "B": {"name": "B", "gen": "all", "level": 1},
        "a1": {"name": "a1", "gen": "A", "level": 2},
        "a2": {"name": "a2", "gen": "A", "level": 2},
        "b1": {"name": "b1", "gen": "B", "level": 2},
    },
}


def test_hierarchy_and_common_ancestors(spark, tmp_path):
    tree = hierarchy.read_hierarchy(spark, write(tmp_path / "t.json", json.dumps(TREE, indent=1)))
    closed = hierarchy.closure(tree)
    assert closed.filter("value = 'a1'").orderBy(F.desc("level")).toPandas()["ancestor"].tolist() == ["a1", "A", "all"]
    df = spark.createDataFrame([(1, "a1"), (1, "a2"), (2, "a1"), (2, "b1"), (3, "b1"), (3, "b1"), (4, "A"), (4, "a2")], "g int, v string")
    got = {r["g"]: r["lca"] for r in hierarchy.group_lca(df, ["g"], "v", closed).collect()}
    assert got == {1: "A", 2: "all", 3: "b1", 4: "A"}
    two = {**TREE, "entries": {**TREE["entries"], "top": {"name": "*", "gen": "top", "level": 0}}}
    with pytest.raises(ValueError):
        hierarchy.read_hierarchy(spark, write(tmp_path / "bad.json", json.dumps(two)))


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("1~2", "a", 3), ("5", "b", 4)], "q string, s string, id int")
    spec = AnonSpec(qi=("q",), sa="s", identifiers=("id",), k=2)
    path = sinks.write_anonymized(df, spec, str(tmp_path), "demo")
    assert path.endswith("demo_global_k2.csv")
    back = tables.read_csv(spark, path, sep=";")
    assert back.columns == ["q", "s"] and back.count() == 2
    grid = spark.createDataFrame([("a", 0.1), ("b", 0.9)], "params string, f1 double")
    assert tables.read_csv(spark, sinks.write_grid_overview(grid, str(tmp_path / "g"), "f1")).first()["params"] == "b"
    scored = df.withColumn("prediction", F.lit("p"))
    assert tables.read_csv(spark, sinks.write_scores(scored, str(tmp_path / "s"), "id")).columns == ["id", "class"]
    members = spark.createDataFrame([(1, 3, "all"), (2, 2, "x")], "age_min int, age_max int, job string")
    lines = spark.read.text(sinks.write_clusters(members, ["age"], ["job"], str(tmp_path / "c")))
    assert sorted(r["value"] for r in lines.collect()) == ["2, x", "[1 - 3], *"]


def test_feature_store_with_and_without_metadata(spark, tmp_path):
    df = spark.createDataFrame([(1.0, ["a", "b"], "y")], "x_min double, c array<string>, t string")
    path = sinks.write_features(df, {"cat_cols": ["c"], "num_cols": ["x_min"], "target_col": "t"}, str(tmp_path / "f"))
    back, info = tables.load_features(spark, path, "t")
    assert back.first()["c"] == ["a", "b"] and info["cat_cols"] == ["c"]
    df.write.parquet(str(tmp_path / "plain" / "data"))
    assert tables.load_features(spark, str(tmp_path / "plain"), "t")[1]["num_cols"] == ["x_min"]


def test_scratch_tables(spark):
    t = materialize(spark.range(10))
    assert t.count() == 10
    discard(t)
    with pytest.raises(Exception):
        spark.read.parquet(t.inputFiles()[0]).count()


def test_sample_is_repeatable(spark):
    df = spark.range(2000)
    a = tables.sample(df, "id", 0.2).count()
    assert a == tables.sample(df, "id", 0.2).count() and 300 < a < 500
