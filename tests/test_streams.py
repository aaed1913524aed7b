import pytest

from docloom.api import Engine
from docloom.sources import custom
from docloom.streaming import streams


def drain(query):
    try:
        query.processAllAvailable()
    finally:
        query.stop()


@pytest.fixture(scope="module")
def script(tmp_path_factory):
    path = tmp_path_factory.mktemp("code") / "code.py"
    path.write_text("def items(v):\n    return [f\"{v['PARTITION']}-{n}\" for n in range(3)]\n\ndef parts(v):\n    return ['a', 'b', 'c']\n")
    return path


def test_a_view_comes_a_bucket_a_batch(spark, tmp_path):
    view = spark.range(50).withColumnRenamed("id", "n")
    sizes = []
    q = streams.stream_view(spark, view, ["n"], partitions=4).writeStream.foreachBatch(lambda df, i: sizes.append([r[0] for r in df.collect()])).option("checkpointLocation", str(tmp_path / "c")).start()
    drain(q)
    assert sorted(n for s in sizes for n in s) == list(range(50)) and len([s for s in sizes if s]) == 4


def test_custom_code_resumes_from_its_checkpoint(spark, tmp_path, script):
    o = {"read.file": f"{script}:items", "read.partitions.file": f"{script}:parts"}
    seen = []

    def start():
        return streams.stream_custom(spark, o).writeStream.foreachBatch(lambda df, i: seen.append(sorted(r["URI"] for r in df.collect()))).option("checkpointLocation", str(tmp_path / "c")).start()

    drain(start())
    assert [s for s in seen if s] == [[f"{p}-{n}" for n in range(3)] for p in "abc"]
    seen.clear()
    drain(start())
    assert not [s for s in seen if s]


def test_a_stream_of_custom_code_into_the_store(spark, tmp_path, script):
    engine = Engine(spark, str(tmp_path / "store"))
    stream = streams.stream_custom(spark, {"read.file": f"{script}:items", "read.partitions.file": f"{script}:parts"})
    q = streams.to_store(stream, engine.store, str(tmp_path / "c"), {"write.uriTemplate": "/{URI}.json"}, processingTime="0 seconds")
    drain(q)
    assert sorted(r["URI"] for r in engine.store.read().select("URI").collect()) == sorted(f"/{p}-{n}.json" for p in "abc" for n in range(3))


def test_a_stream_into_custom_code(spark, tmp_path):
    src, out = tmp_path / "src", tmp_path / "out"
    out.mkdir()
    spark.range(20).selectExpr("cast(id as string) URI").write.parquet(str(src))

    def keep(value, given):
        import uuid

        (out / uuid.uuid4().hex).write_text(value)

    q = streams.to_code(spark.readStream.schema("URI string").parquet(str(src)), keep, str(tmp_path / "c"), {"write.batchSize": "4"})
    q.awaitTermination(120)
    assert sorted(int(x) for f in out.iterdir() for x in f.read_text().split(",")) == list(range(20))


def test_readers_are_registered():
    custom.register_reader("x", lambda v: [])
    assert "x" in custom.READERS


def test_all_orders_reach_the_store(spark, tmp_path):
    from docloom import queries_io

    spark.range(1, 41).selectExpr("id as o_orderkey", "cast(id * 10 as int) as o_custkey").write.parquet(str(tmp_path / "orders.parquet"))
    store = queries_io.orders_streamed(spark, str(tmp_path))
    assert sorted(r["URI"] for r in store.read().select("URI").collect()) == sorted(f"/o/{k}.json" for k in range(1, 41))
    compared = queries_io.stream_into_store(spark, str(tmp_path)).collect()
    assert sorted((r["URI"], r["custkey"]) for r in compared) == sorted((f"/o/{k}.json", 10 * k) for k in range(1, 41))
