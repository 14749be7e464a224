"""Readers and writers on files in a scratch folder."""

import json
import os
import tempfile

import pytest
from pyspark.sql import types as T

from tidemark.sources import files as S


@pytest.fixture()
def tmp():
    return tempfile.mkdtemp(prefix="tidemark-src-")


def test_dict_lines(spark, tmp):
    p = os.path.join(tmp, "ev.txt")
    with open(p, "w") as f:
        f.write("{'Time': 1, 'EventID': 4608, 'LogHost': 'Comp1', 'Source': None}\n")
        f.write("{'Time': 2, 'EventID': 4688, 'LogHost': 'Comp1', 'UserName': 'User2'}\n")
        f.write("not a dict\n")
    schema = T.StructType([T.StructField("Time", T.LongType()), T.StructField("EventID", T.IntegerType()),
                           T.StructField("LogHost", T.StringType()), T.StructField("Source", T.StringType()),
                           T.StructField("UserName", T.StringType())])
    rows = S.read_dict_lines(spark, p, schema).collect()
    assert rows[0].EventID == 4608 and rows[0].Source is None and rows[0].UserName is None
    assert rows[1].UserName == "User2"
    assert rows[2]._corrupt_record == "not a dict"
    assert S.line_count(spark, p) == 3


def test_csv_semicolon_and_write(spark, tmp):
    p = os.path.join(tmp, "a.csv")
    with open(p, "w") as f:
        f.write("a;b\n1;x\n2;y\n")
    df = S.read_csv(spark, p, T.StructType([T.StructField("a", T.IntegerType()),
                                             T.StructField("b", T.StringType())]), sep=";")
    assert [tuple(r) for r in df.collect()] == [(1, "x"), (2, "y")]
    out = os.path.join(tmp, "out")
    S.write_csv(df, out)
    with pytest.raises(Exception):
        S.write_csv(df, out)  # errorifexists, as the reference's to_sql
    assert S.read_csv(spark, out, df.schema).count() == 2


def test_code_map_and_labelled_files(spark, tmp):
    p = os.path.join(tmp, "names.json")
    with open(p, "w") as f:
        json.dump({"1": "class one", "2": "class two"}, f)
    m = {r.code: r.name for r in S.read_code_map(spark, p).collect()}
    assert m == {"1": "class one", "2": "class two"}
    for split, label in [("train", "1"), ("train", "2"), ("valid", "1")]:
        d = os.path.join(tmp, "img", split, label)
        os.makedirs(d)
        with open(os.path.join(d, "a.jpg"), "wb") as f:
            f.write(b"\xff\xd8")
    files = S.scan_labelled_files(spark, os.path.join(tmp, "img"))
    rows = files.collect()
    assert sorted((r.split, r.label) for r in rows) == [("train", "1"), ("train", "2"), ("valid", "1")]
    from tidemark.operators.encode import string_index
    idx, model = string_index(files.filter("split = 'train'"), "label", "class_index")
    assert model.labels == ["1", "2"]
    assert {(r.label, r.class_index) for r in model.transform(files).collect()} == {("1", 0.0), ("2", 1.0)}


def test_save_table_fails_if_exists(spark):
    df = spark.range(3)
    name = "tidemark_tmp_tbl"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    S.save_table(df, name)
    with pytest.raises(Exception):
        S.save_table(df, name)
    assert S.read_table(spark, name).count() == 3
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_bz2_json_lines(spark, tmp):
    import bz2
    p = os.path.join(tmp, "events.json.bz2")
    with bz2.open(p, "wt") as f:
        f.write('{"userId": "1", "ts": 5, "page": "NextSong"}\n{"userId": "", "ts": 6, "page": "Home"}\n')
    df = S.read_events(spark, p)
    assert df.count() == 2 and df.filter("userId = '1'").first().page == "NextSong"


def test_partitioned_events_prune(spark, tmp):
    from pyspark.sql import functions as F
    from tests.conftest import SF0001
    ev = spark.read.parquet(f"{SF0001}/events.parquet").withColumn("day", F.to_date("ts"))
    out = os.path.join(tmp, "events_by_day")
    S.write_partitioned(ev, out, ["day"])
    r = spark.read.parquet(out).filter(F.col("day") == F.lit("2024-01-05").cast("date"))
    plan = r._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "2024-01-05" in plan
    assert r.count() == ev.filter(F.col("day") == F.lit("2024-01-05").cast("date")).count()
