import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tablesnap.operators.frames import exclude_columns, map_columns, qualify, replace_columns
from tablesnap.operators.freshness import schema_diff


@pytest.fixture
def df(spark):
    return spark.createDataFrame([(1, "a", 5), (1, "b", 7), (2, "c", 6)], "k int, `odd.name` string, v int")


def test_qualify(df):
    w = Window.partitionBy("k").orderBy(F.desc("v"))
    kept = qualify(df, F.row_number().over(w), lambda rn: rn == 1)
    assert kept.columns == df.columns and sorted(r.v for r in kept.collect()) == [6, 7]


def test_exclude(df):
    assert exclude_columns(df, "v").columns == ["k", "odd.name"]
    with pytest.raises(ValueError):
        exclude_columns(df, "nope")


def test_replace(df):
    changed = replace_columns(df, {"v": F.col("v") * 10, "odd.name": F.upper("`odd.name`")})
    assert changed.columns == df.columns and sorted(map(tuple, changed.collect()))[0] == (1, "A", 50)
    with pytest.raises(ValueError):
        replace_columns(df, {"nope": F.lit(1)})


def test_map_columns(df):
    row = df.agg(*map_columns(df, F.max, "^[kv]$", "max_{}".format)).first()
    assert row.asDict() == {"max_k": 2, "max_v": 7}
    assert len(map_columns(df, F.upper)) == 3


def test_schema_diff(spark):
    schema = "position int, name string, json_type string"
    old = spark.createDataFrame([(0, "a", "int"), (1, "b", None), (2, "c", "date")], schema)
    new = spark.createDataFrame([(0, "a", "float"), (1, "b", "")], schema)
    assert [tuple(r) for r in schema_diff(old, new).orderBy("position").collect()] == [
        (0, "a", "int", "a", "float"),
        (2, "c", "date", None, None),
    ]
    assert schema_diff(old, old).count() == 0
