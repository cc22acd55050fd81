"""File sources and sinks (S1-S19) on small files written by the tests."""

import io
import json
import zipfile

from pyspark.sql import functions as F

from sparkpanel.operators import clean
from sparkpanel.sources import files


def test_bom_header_and_append(spark, tmp_path):
    p = tmp_path / "bom.csv"
    p.write_bytes("﻿a,b\n1,x\n2,y\n".encode("utf-8"))
    df = files.read_csv(spark, str(p), "a int, b string")
    assert [tuple(r) for r in df.collect()] == [(1, "x"), (2, "y")]
    out = str(tmp_path / "app")
    files.write_csv(df, out, mode="append")
    files.write_csv(df, out, mode="append")
    assert files.read_csv(spark, out, "a int, b string").count() == 4


def test_zipped_csv_utf8_and_cp949(spark, tmp_path):
    for name, enc in (("u.zip", "utf-8"), ("k.zip", "cp949")):
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w") as zf:
            zf.writestr("data.csv", "code,name\n1,강남구\n2,종로구\n".encode(enc))
        (tmp_path / name).write_bytes(buf.getvalue())
    df = files.read_zipped_csv(spark, str(tmp_path), "code int, name string")
    assert sorted(tuple(r) for r in df.collect()) == [(1, "강남구"), (1, "강남구"), (2, "종로구"), (2, "종로구")]


def test_feature_collection_names(spark, tmp_path):
    doc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"name": "A"}, "geometry": None},
        {"type": "Feature", "properties": {"name": "B"}, "geometry": None}]}
    (tmp_path / "g.json").write_text(json.dumps(doc, indent=2))
    df = files.read_json_lines(spark, str(tmp_path / "g.json"),
                               "features array<struct<properties: struct<name: string>>>", multi_line=True)
    names = [r.name for r in df.select(F.explode("features").alias("f")).select("f.properties.name").collect()]
    assert names == ["A", "B"]


def test_json_export_per_key_and_landing(spark, tmp_path):
    df = spark.createDataFrame([("x", 1), ("y", 2), ("x", 3)], "item string, v int")
    files.write_json_by(df, str(tmp_path / "by"), "item")
    back = spark.read.json(str(tmp_path / "by"))
    assert sorted((r.item, r.v) for r in back.collect()) == [("x", 1), ("x", 3), ("y", 2)]
    land = str(tmp_path / "land")
    files.append_json_landing(df.select(F.to_json(F.struct("item", "v")).alias("raw_data")), land)
    files.append_json_landing(df.select(F.to_json(F.struct("item", "v")).alias("raw_data")), land)
    assert spark.read.parquet(land).where(F.col("scraped_at").isNotNull()).count() == 6


def test_partitioned_lookup_and_footers(spark, tmp_path):
    df = spark.range(100).select((F.col("id") % 24).cast("int").alias("hour"), F.col("id").alias("v"))
    out = str(tmp_path / "pre")
    files.write_parquet(df, out, partition_by=["hour"])
    got = files.lookup_partition(spark, out, "hour", 7)
    assert sorted(r.v for r in got.collect()) == [7, 31, 55, 79]
    assert "PartitionFilters: [isnotnull(hour" in got._jdf.queryExecution().executedPlan().toString()
    f = files.parquet_footers(spark, out).agg(F.sum("num_rows")).collect()[0][0]
    assert f == 100


def test_roles_by_name_and_registry(spark):
    df = spark.createDataFrame([(1, 2, 3.0)], "admin_code long, hour_band int, pop_total double")
    assert clean.roles_by_name(df, {"code": ["code"], "hour": ["hour"], "pop": ["pop"]}) == {
        "code": "admin_code", "hour": "hour_band", "pop": "pop_total"}
    assert {"csv", "parquet", "json"} <= set(files.SOURCE_READERS)


def test_multi_file_read_takes_columns_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n1,x\n2,y\n")
    (tmp_path / "b.csv").write_text('"name","note, long","id"\n"z\nz",q,3\n')
    (tmp_path / "c.csv").write_text("other\n9\n")
    (tmp_path / "d.csv").write_text(",".join(f"c{i:06d}" for i in range(12_000)) + ",id\n" + "0," * 12_000 + "4\n")
    (tmp_path / "own_result.csv").write_text("id,name\n100,x\n")
    df = files.read_csv_files_with_column(spark, str(tmp_path), "id", "id long, name string", skip_names=("own_result",))
    got = sorted((r.id, r.name, r.source_file) for r in df.collect())
    assert got == [(1, "x", "a.csv"), (2, "y", "a.csv"), (3, "z\nz", "b.csv"), (4, None, "d.csv")]
    none = files.read_csv_files_with_column(spark, str(tmp_path), "absent", "id long")
    assert none.columns == ["id", "source_file", "source_path"] and none.count() == 0


def test_zipped_csv_keeps_quoted_line_breaks(spark, tmp_path):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        zf.writestr("q.csv", 'code,name\n1,"two\nlines, one field"\n\nx,plain\n')
    (tmp_path / "q.zip").write_bytes(buf.getvalue())
    got = files.read_zipped_csv(spark, str(tmp_path), "code int, name string").collect()
    assert sorted((str(r.code), r.name) for r in got) == [("1", "two\nlines, one field"), ("None", "plain")]


def test_footers_of_a_folder_named_parquet_and_narrowed_types(spark, tmp_path):
    df = spark.createDataFrame([(1, 300, 70_000, 1 << 40, 1.5), (-2, 5, 1, 0, 2.5)], "a long, b long, c long, d long, e double")
    out = str(tmp_path / "t.parquet")
    files.write_parquet(df, out, narrow=True)
    back = spark.read.parquet(out)
    assert [t for _, t in back.dtypes] == ["tinyint", "smallint", "int", "bigint", "double"]
    assert files.parquet_footers(spark, out).agg(F.sum("num_rows")).first()[0] == 2
    files.typed_append(spark.createDataFrame([("7", "x"), ("n/a", None)], "n string, s string"), str(tmp_path / "ins"), "n int, s string, extra double")
    assert sorted((str(r.n), r.extra) for r in spark.read.parquet(str(tmp_path / "ins")).collect()) == [("7", None), ("None", None)]
