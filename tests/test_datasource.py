import glob
import os

import pytest
from pyspark.sql import functions as F

from docloom.operators import documents, store
from docloom.sources import datasource


@pytest.fixture(scope="module")
def fmt(spark):
    datasource.register(spark)
    return spark


def docs(spark, n, first=0, note="v1"):
    rows = spark.range(first, first + n).select(F.concat(F.lit("/d/"), "id", F.lit(".json")).alias("URI"), F.encode(F.concat(F.lit(note), F.col("id").cast("string")), "UTF-8").alias("content"), F.when(F.col("id") % 2 == 0, "JSON").otherwise("TEXT").alias("format"))
    return documents.blank(rows).withColumn("collections", F.array(F.lit(note)))


def shown(df):
    return {r["URI"]: (bytes(r["content"]).decode(), r["format"], r["collections"]) for r in df.collect()}


def test_hash_is_that_of_spark(spark):
    names = ["", "a", "/d/é😀.json", "x" * 100]
    got = spark.createDataFrame([(n,) for n in names], "u string").select(F.pmod(F.xxhash64("u"), F.lit(13)).alias("b")).collect()
    assert [r["b"] for r in got] == [datasource.bucket_of(n, 13) for n in names]


def test_round_trip_with_the_store(fmt, tmp_path):
    path = str(tmp_path / "s")
    docs(fmt, 50).repartition(3).write.format("docloom").mode("append").option("buckets", 4).save(path)
    s = store.Store(fmt, path, buckets=4)
    assert s.latest() == 1 and shown(s.read()) == shown(fmt.read.format("docloom").load(path)) and s.read().count() == 50
    s.write(docs(fmt, 5, 45, "v2"))
    s.delete(fmt.createDataFrame([("/d/1.json",)], "URI string"))
    docs(fmt, 2, 48, "v3").write.format("docloom").mode("append").option("buckets", 4).save(path)
    now = fmt.read.format("docloom").load(path)
    assert shown(now) == shown(s.read()) and now.count() == 49 and shown(now)["/d/49.json"] == ("v349", "TEXT", ["v3"])
    old = fmt.read.format("docloom").option("version", 1).load(path)
    assert shown(old)["/d/49.json"][0] == "v149" and old.count() == 50


def test_filters_choose_folders_and_files(fmt, tmp_path, monkeypatch):
    path = str(tmp_path / "s")
    docs(fmt, 200).repartition(2).write.format("docloom").mode("append").option("buckets", 8).save(path)
    reader = datasource.Reader({"path": path})
    whole = len(reader.partitions())
    left = list(reader.pushFilters([datasource.In(("URI",), ("/d/3.json", "/d/4.json")), datasource.IsNotNull(("content",))]))
    assert [type(f).__name__ for f in left] == ["IsNotNull"] and whole >= 8
    wanted = {f"bucket={datasource.bucket_of(u, 8)}" for u in ("/d/3.json", "/d/4.json")}
    assert {p.files[0][1].split("/")[-2] for p in reader.partitions()} == wanted
    df = fmt.read.format("docloom").load(path)
    assert df.filter("URI = '/d/7.json'").count() == 1
    assert df.filter("URI IN ('/d/7.json', '/d/8.json', 'none') AND format = 'JSON'").count() == 1
    assert df.filter("URI LIKE '/d/1%' AND format = 'TEXT'").count() == 56
    assert df.filter("array_contains(collections, 'v1') AND quality IS NULL").count() == 200
    plan = df.filter("URI = '/d/7.json'")._jdf.queryExecution().executedPlan().toString()
    assert "docloom" in plan


def test_filters_hold_for_the_newest_form_alone(fmt, tmp_path):
    path = str(tmp_path / "s")
    docs(fmt, 10).write.format("docloom").mode("append").save(path)
    docs(fmt, 10).withColumn("format", F.lit("XML")).limit(4).write.format("docloom").mode("append").save(path)
    df = fmt.read.format("docloom").load(path)
    assert df.filter("format = 'XML'").count() == 4 and df.filter("format IN ('JSON', 'TEXT')").count() == 6


def test_a_failed_write_leaves_nothing(fmt, tmp_path):
    path = str(tmp_path / "s")
    docs(fmt, 10).write.format("docloom").mode("append").save(path)
    bad = docs(fmt, 20, 5, "v9").withColumn("content", F.when(F.col("URI") == "/d/20.json", F.raise_error(F.lit("broken")).cast("binary")).otherwise(F.col("content")))
    with pytest.raises(Exception, match="broken"):
        bad.repartition(4).write.format("docloom").mode("append").save(path)
    assert store.Store(fmt, path).latest() == 1 and fmt.read.format("docloom").load(path).count() == 10
    assert not glob.glob(f"{path}/staging/*") and len(os.listdir(f"{path}/data")) == 1


def test_overwrite_empty_and_strange_rows(fmt, tmp_path):
    path = str(tmp_path / "s")
    docs(fmt, 10).write.format("docloom").mode("append").save(path)
    docs(fmt, 3, 100, "new").write.format("docloom").mode("overwrite").save(path)
    df = fmt.read.format("docloom").load(path)
    assert sorted(shown(df)) == ["/d/100.json", "/d/101.json", "/d/102.json"]
    docs(fmt, 3).limit(0).write.format("docloom").mode("append").save(path)
    assert store.Store(fmt, path).latest() == 2
    with pytest.raises(Exception, match="rows of documents"):
        fmt.range(3).write.format("docloom").mode("append").save(path)


def test_two_writers_follow_each_other(fmt, tmp_path):
    fs, root = datasource.opened(str(tmp_path))
    assert datasource.published(fs, root, 1, [{"id": "a"}]) and not datasource.published(fs, root, 1, [{"id": "b"}])
    assert datasource.commits(fs, root, 1) == [{"id": "a"}] and datasource.newest(fs, root) == 1
