"""Work that is dealt by files must not end up in a few tasks, nor be cut into one task per small file."""

import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pixsieve import fixtures as fx
from pixsieve import sources
from pixsieve.sources.manifest import number_parts
from pixsieve.sources.zipped import packed, read_zipped_arrays


@pytest.fixture
def task_of():
    def number(_) -> bytes:
        from pyspark import TaskContext

        return str(TaskContext.get().partitionId()).encode()

    return number


def test_files_are_written_by_many_tasks(spark, tmp_path, task_of):
    rows = spark.range(400).select(F.concat(F.lit("f"), "id").alias("path")).coalesce(1)
    assert fx.write_files(rows, f"file://{tmp_path}/files", task_of) == 400
    tasks = [p.read_bytes() for p in (tmp_path / "files").iterdir()]
    assert len(tasks) == 400 and max(tasks.count(t) for t in set(tasks)) < 200


def test_listed_files_are_opened_by_many_tasks(spark, tmp_path, task_of):
    fx.write_files(spark.range(100).select(F.concat(F.lit("f"), "id").alias("path")), f"file://{tmp_path}/files", task_of)
    listing = sources.list_images(spark, f"file://{tmp_path}/files", base_dir=str(tmp_path))
    features = sources.measure_listed(listing.coalesce(1), listing.coalesce(1).select("path"))
    sizes = features.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in sizes) == 100 and max(r["count"] for r in sizes) < 50


def test_small_zip_files_share_tasks(spark, tmp_path):
    for k in range(300):
        with zipfile.ZipFile(tmp_path / f"{k:03d}.zip", "w") as archive:
            archive.writestr("a.json", f'[{{"id": {2 * k}}}, {{"id": {2 * k + 1}}}]')
    layout = T.StructType([T.StructField("id", T.LongType())])
    items = read_zipped_arrays(spark, str(tmp_path), layout)
    assert items.rdd.getNumPartitions() <= 8 * spark.sparkContext.defaultParallelism + 1
    assert sorted(r["id"] for r in items.collect()) == list(range(600))
    assert items.select("zip_file").distinct().count() == 300


@pytest.mark.parametrize("most, want", [(1, [["a"], ["b"], ["c"]]), (5, [["a", "b"], ["c"]]), (100, [["a", "b", "c"]])])
def test_packing(most, want):
    assert packed([("a", 4), ("b", 3), ("c", 9)], most) == want
    assert packed([], most) == []


def test_numbering_shuffles_sizes_only(spark):
    rows = spark.range(1000).select((F.col("id") % 7).alias("part"), F.floor(F.col("id") / 7).alias("_id"), F.col("id").alias("payload"))
    automatic = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for most, join in ((100, "BroadcastHashJoin"), (0, "SortMergeJoin")):
            numbered = number_parts(rows, ["part"], "n", most)
            assert sorted(r["n"] for r in numbered.collect()) == list(range(1, 1001))
            assert join in numbered._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", automatic)
