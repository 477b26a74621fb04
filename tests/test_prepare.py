import pytest
from pyspark.sql import functions as F

from cloakwork.operators import encode
from cloakwork.plans import prepare as p
from cloakwork.plans.anonymize import global_anonymize


def phones(spark):
    rows = [(i, f"n{i}", f"town{i % 30}", 13 + i % 7, ["m", "f"][i % 2], f"{i % 12}", ["chat", " game "][i % 2], i / 2, i % 4) for i in range(60)]
    names = "ID long, Name string, Location string, Age int, Gender string, Calls string, Phone_Usage_Purpose string, Hours double, Addiction_Level int"
    return spark.createDataFrame(rows, names)


def test_roles_codes_and_persisted_specification(spark, tmp_path):
    got = p.prepare(phones(spark), p.TEEN_PHONE, "ID")
    assert got.spec.qi == ("Age", "Gender", "Calls", "Phone_Usage_Purpose", "Hours")
    assert got.spec.categorical == ("Gender", "Phone_Usage_Purpose")  # Age has few values but is exempt, Calls are numbers
    first = got.rows.orderBy("ID").first()
    assert (first["Age"], first["Gender"], first["Calls"], first["Phone_Usage_Purpose"]) == (13.0, 0, 0.0, 0)
    codes = {(r["column"], r["code"]): r["value"] for r in got.code_table().collect()}
    assert codes[("Gender", 1)] == "f" and codes[("Phone_Usage_Purpose", 1)] == "game"
    p.save(got, str(tmp_path / "spec"))
    back = p.load(spark, str(tmp_path / "spec"))
    assert back.spec == got.spec
    assert sorted(map(tuple, back.rows.collect())) == sorted(map(tuple, got.rows.collect()))
    assert sorted(map(tuple, back.code_table().collect())) == sorted(map(tuple, got.code_table().collect()))
    boxes = back.rows.groupBy("Age").agg(F.min("Gender").alias("lo"), F.max("Gender").alias("hi"))
    spelled = {r["Age"]: r["sex"] for r in back.codes.decode_spans(boxes, "Gender", "lo", "hi", "sex").collect()}
    assert set(spelled.values()) <= {"m", "f", "m~f"} and spelled[13.0] == "m~f"


def test_other_recipes(spark):
    rows = [(i, ["male", "female"][i % 2], "sport", i % 50, "x" if i % 9 == 0 else str(i), "type" + str(i % 3)) for i in range(400)]
    df = spark.createDataFrame(rows, "key long, Gender string, Interest string, Age int, Score string, Personality string")
    got = p.prepare(df, p.PERSONALITY, "key")
    assert set(got.spec.categorical) == {"Gender", "Interest", "Score"} and 5 < got.rows.count() < 60
    zero = p.prepare(df.select("key", "Age", "Score", F.col("Personality").alias("class")), p.BREAST_CANCER, "key")
    assert zero.spec.categorical == () and zero.code_table() is None
    assert {r["key"]: r["Score"] for r in zero.rows.collect()}[9] == 0.0


def test_more_labels_than_any_literal_holds(spark):
    """A span of 5000 labels is spelled by a join."""
    df = spark.range(5000).select(F.col("id"), F.format_string("v%05d", "id").alias("c"), F.lit(1).alias("sa"))
    codes = encode.fit_first_codes(df, ["c"], "id")
    one = codes.decode_spans(spark.createDataFrame([(0, 4999), (3, 4)], "lo long, hi long"), "c", "lo", "hi", "t")
    got = {r["lo"]: r["t"] for r in one.collect()}
    assert got[3] == "v00003~v00004" and got[0].count("~") == 4999
    spec = p.AnonSpec(qi=("c",), sa="sa", categorical=("c",), k=1000)
    rows = global_anonymize(df, spec, "id").rows
    assert rows.count() == 5000 and rows.select(F.size(F.split("c", "~")).alias("n")).agg(F.min("n")).first()[0] >= 1000


def test_a_code_table_is_needed_to_decode(spark):
    with pytest.raises(KeyError):
        encode.Codes({}).decode_spans(spark.range(1).selectExpr("id as lo", "id as hi"), "c", "lo", "hi", "t")
