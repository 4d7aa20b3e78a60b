import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from changeloom import SourceSpec
from changeloom.sinks.catalog_merge import merge_into_catalog
from changeloom.sinks.layout import compact_files, write_partitioned
from changeloom.sinks.rejects import read_rejects, write_rejects
from changeloom.sources import catalog
from changeloom.sources.files import SourceError, archive_folder, read_source, scan_batch, scan_stream
from changeloom.storage import PathTaken, Storage, scratch_folder, scratch_root


def spec(**fields):
    return SourceSpec(source="meters", **fields)


def parquet_files(folder):
    return sorted(p for p in folder.rglob("*.parquet"))


@pytest.fixture
def landing(spark, tmp_path):
    spark.range(5).coalesce(1).write.parquet(str(tmp_path / "in/2026/06/30"))
    spark.range(5, 8).coalesce(1).write.parquet(str(tmp_path / "in/2026/07/01"))
    return str(tmp_path / "in")


def test_batch_scan_stays_at_the_root_unless_told(spark, landing):
    with pytest.raises(SourceError):
        scan_batch(spark, spec(source_location=landing))
    assert scan_batch(spark, spec(source_location=landing), recursive=True).count() == 8
    assert scan_batch(spark, spec(source_location=landing + "/*/*/*")).count() == 8
    assert read_source(spark, spec(source_location=landing + "/2026/06/30"), "batch").count() == 5


def test_batch_scan_other_format_and_schema(spark, tmp_path):
    (tmp_path / "rows.csv").write_text("1,a\n2,b\n")
    source = spec(source_location=str(tmp_path / "rows.csv"), format="csv")
    assert scan_batch(spark, source).count() == 2
    schema = spark.createDataFrame([], "id int, v string").schema
    assert scan_batch(spark, source, schema=schema).agg(F.sum("id")).first()[0] == 3


def test_batch_scan_of_newer_files(spark, landing):
    source = spec(source_location=landing)
    assert scan_batch(spark, source, recursive=True, modified_after="2020-01-01T00:00:00").count() == 8
    with pytest.raises(SourceError):
        scan_batch(spark, source, recursive=True, modified_after="2999-01-01T00:00:00")


def test_missing_path_and_unknown_format(spark, tmp_path):
    with pytest.raises(SourceError):
        scan_batch(spark, spec(source_location=str(tmp_path / "none")))
    with pytest.raises(SourceError):
        scan_batch(spark, spec(source_location=str(tmp_path), format="nonsense"))
    with pytest.raises(SourceError):
        scan_stream(spark, spec(cdc_source_location=str(tmp_path / "none")))


def test_stream_scan_falls_back_to_the_full_load_path(spark, landing):
    assert read_source(spark, spec(source_location=landing)).isStreaming
    assert read_source(spark, spec(source_location=landing), "anything").isStreaming
    assert scan_stream(spark, spec(source_location="/nowhere", cdc_source_location=landing)).columns == ["id"]
    assert archive_folder("/landing/parcels_cdc/") == "/landing/parcels_cdc_archive/"


@pytest.mark.parametrize("options, batches", [({}, 2), ({"max_files": 5}, 1), ({"max_bytes": 10**9}, 1)])
def test_stream_rate_limit_and_archive(spark, landing, tmp_path, options, batches):
    stream = scan_stream(spark, spec(cdc_source_location=landing), **options)
    seen = []
    query = (
        stream.writeStream.foreachBatch(lambda df, i: seen.append(df.count()))
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert len(seen) == batches and sum(seen) == 8
    if batches == 2:
        archived = parquet_files(tmp_path / "in_archive")
        left = parquet_files(tmp_path / "in")
        assert len(archived) >= 1 and len(archived) + len(left) == 2


def test_catalog_and_sql(spark, tmp_path):
    spark.range(4).write.parquet(str(tmp_path / "t"))
    assert not catalog.table_exists(spark, "cl_test.numbers")
    catalog.register_files(spark, "cl_test.numbers", str(tmp_path / "t"))
    assert catalog.table_exists(spark, "cl_test.numbers")
    assert catalog.read_table(spark, "cl_test.numbers").count() == 4
    assert catalog.run_sql(spark, "SELECT sum(id) AS s FROM numbers", database="cl_test").first().s == 6
    assert spark.catalog.currentDatabase() == "default"
    stored = catalog.run_sql(
        spark, "SELECT id FROM {n} WHERE id > 1", tables={"n": spark.range(4)}, result_location=str(tmp_path / "out")
    )
    assert stored.count() == 2 and len(parquet_files(tmp_path / "out")) >= 1
    spark.sql("DROP DATABASE cl_test CASCADE")


def test_merge_needs_a_format_with_row_level_operations(spark, tmp_path):
    spark.range(4).selectExpr("id", "'a' v", "false is_deleted").write.parquet(str(tmp_path / "t"))
    catalog.register_files(spark, "cl_plain", str(tmp_path / "t"))
    changes = spark.sql("SELECT 1L id, 'b' v, 'U' op, 1 seq")
    for deletes in ("hard", "soft"):
        with pytest.raises(PySparkException, match="UNSUPPORTED|not support"):
            merge_into_catalog(changes, "cl_plain", ["id"], "op", ["seq"], deletes)
    spark.sql("DROP TABLE cl_plain")


def test_a_hot_partition_is_split_and_small_ones_are_not_scattered(spark, tmp_path):
    df = spark.range(0, 120_000, 1, 8).selectExpr(
        "id", "if(id % 3 = 0, 'hot', concat('p', id % 4)) p", "concat(uuid(), uuid(), uuid(), uuid(), uuid(), uuid()) pad"
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        write_partitioned(df, str(tmp_path / "out"), ["p"], sort_by=["id"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = {d.name: len(parquet_files(d)) for d in (tmp_path / "out").iterdir() if d.is_dir()}
    assert files["p=hot"] > 1
    assert spark.read.parquet(str(tmp_path / "out")).count() == 120_000


def test_compaction(spark, tmp_path):
    small, even = str(tmp_path / "small"), str(tmp_path / "even")
    spark.range(100).repartition(20).write.parquet(small)
    compact_files(spark, small, even)
    assert len(parquet_files(tmp_path / "even")) < 20 == len(parquet_files(tmp_path / "small"))
    assert spark.read.parquet(even).agg(F.sum("id")).first()[0] == 4950
    with pytest.raises(ValueError):
        compact_files(spark, small, small + "/")


def test_rejects_of_a_batch_replace_themselves(spark, tmp_path):
    location = str(tmp_path / "rejected")
    assert read_rejects(spark, location).columns == ["_reject_table", "_reject_rule", "_reject_timestamp"]
    for _ in range(2):
        write_rejects(spark.range(3), location, "b1")
    write_rejects(spark.range(2).withColumn("more", F.lit(1)), location, "b2")
    stored = read_rejects(spark, location)
    assert stored.count() == 5 and stored.columns == ["id", "more", "batch_id"]
    assert read_rejects(spark, location, spark.range(1).schema).columns == ["id", "batch_id"]


def test_storage(spark, tmp_path):
    storage = Storage(spark)
    path = str(tmp_path / "a" / "b.txt")
    storage.put_text(path, "grün")
    assert storage.read_text(path) == "grün" and storage.exists(path)
    with pytest.raises(PathTaken):
        storage.put_text(path, "again")
    assert storage.plain("file:/a b") == storage.plain("file:///a b") == storage.plain("/a b") == "/a b"
    assert storage.plain("s3a://x/a") == "s3a://x/a" and storage.plain(storage.decoded("file:///a%20b")) == "/a b"
    storage.move(path, f"{path}.moved")
    assert not storage.exists(path) and storage.read_text(f"{path}.moved") == "grün"
    storage.move(f"{path}.moved", path)
    assert storage.bytes_under(str(tmp_path / "a")) >= 5 and storage.bytes_under(str(tmp_path / "none")) == 0
    assert "b.txt" in storage.names(str(tmp_path / "a")) and storage.names(str(tmp_path / "none")) == []
    storage.remove(path)
    assert not storage.exists(path)


def test_scratch_folders_are_new_each_time(spark):
    first, second = scratch_folder(spark, "x"), scratch_folder(spark, "x")
    assert first != second and first.startswith(scratch_root(spark))
