"""JSON Lines manifests as samples, and dense row numbers without a global sort in one task."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pixsieve import schema as S
from pixsieve.functions import format_id, strip
from pixsieve.session import write_table


def number_parts(rows: DataFrame, part: list[str], name: str, most_broadcast: int = 100_000) -> DataFrame:
    """Dense 1-based ``name`` over parts in order; ``_id`` rises by one inside a part.

    Only the sizes of the parts pass through one window: one row per file split or partition. Up to ``most_broadcast`` of them
    go to the rows, which then need no shuffle.
    """
    sizes = write_table(rows.groupBy(*part).agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_size")), "part-sizes")
    before = Window.orderBy(*part).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        *part, (F.coalesce(F.sum("_size").over(before), F.lit(0)) - F.col("_first")).alias("_shift")
    )
    if sizes.count() <= most_broadcast:
        starts = F.broadcast(starts)
    numbered = rows.join(starts, part)
    return numbered.withColumn(name, F.col("_shift") + F.col("_id") + 1).drop("_shift", "_id")


_SPLIT = {
    "_file": "file_path", "_offset": "file_block_start", "_length": "file_block_length",
    "_bytes": "file_size", "_changed": "file_modification_time",
}


def index_lines(spark: SparkSession, path: str, most_broadcast: int = 100_000) -> DataFrame:
    """``row_idx, value``: the lines of a text file, blank ones too, numbered from 1.

    A file is read in splits. A first scan counts the lines of every split and keeps one row per split, in
    order of file name and byte offset; several files count on from one another by name. The result reads the
    files a second time and adds the lines before each split; no text is written. Both scans
    must cut and pack the files alike: every row checks that it is where the first scan had a line of its
    split, and the job fails if not. Files must not be rewritten in between; one that loses lines is not noticed.
    """
    lines = spark.read.text(path).select(
        "value", *[F.col(f"_metadata.{c}").alias(n) for n, c in _SPLIT.items()],
        F.monotonically_increasing_id().alias("_id"),
    )
    splits = write_table(lines.groupBy(*_SPLIT).agg(
        F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_size")
    ), "line-splits")
    before = Window.orderBy("_file", "_offset").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0)))
    # One row per split: beyond some size it is joined like any table.
    if splits.count() <= most_broadcast:
        starts = F.broadcast(starts)
    place = F.col("_id") - F.col("_first")
    same = F.coalesce((place >= 0) & (place < F.col("_size")), F.lit(False))
    failure = F.raise_error(F.concat(F.lit("files were split or changed between two scans: "), F.col("_file")))
    number = F.when(same, F.col("_before") + place + 1).otherwise(failure.cast("bigint"))
    return lines.join(starts, list(_SPLIT), "left").select(number.alias(S.ROW_INDEX), "value")


def number_splits(rows: DataFrame, name: str = S.ROW_INDEX) -> DataFrame:
    """Dense 1-based ``name`` for rows of one scan with ``_file``, ``_offset`` and a rising ``_id``."""
    return number_parts(write_table(rows, "splits"), ["_file", "_offset"], name).drop("_file", "_offset")


def dense_index(df: DataFrame, keys: list[str], name: str = S.ROW_INDEX) -> DataFrame:
    """Dense 1-based row number in the order of ``keys``.

    A range partitioned sort, then numbers inside each partition plus the sizes of the
    partitions before it. The sorted rows are written once, so that partition numbers stay
    what they were if a task is run again.
    """
    ordered = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumns({
        "_part": F.spark_partition_id(),
        "_id": F.monotonically_increasing_id(),
    })
    placed = write_table(ordered, "ordered")
    return number_parts(placed, ["_part"], name).drop("_part")


def _key_or(record: Column, key: str, default: str) -> Column:
    """The value of a key; the default only where the key is absent, not where it is null."""
    present = F.array_contains(F.json_object_keys("value"), key)
    return F.when(present, record.getField(key)).otherwise(F.lit(default))


def canonical(text: Column, image_path: Column, width: Column, height: Column, number: Column) -> list[Column]:
    """The sample columns of a source record, with the constants of the manifest source."""
    blank, none = F.lit(""), F.lit(None)
    values = {
        "sample_id": format_id(number, S.ID_PREFIX), "character": F.lit(S.MANIFEST_SOURCE),
        "scene": text, "dialogue": blank, "image_prompt": text, "emotion": blank,
        "action": blank, "visual_style": F.lit(S.REAL_IMAGE), "image_path": image_path,
        "width": width.cast("int"), "height": height.cast("int"),
        "blur_score": none.cast("double"), "clip_score": none.cast("double"),
        "status": F.lit(S.PENDING), "reject_reason": none.cast("string"),
    }
    return [values[c].alias(c) for c in S.SAMPLE_COLUMNS]


def manifest_from_lines(lines: DataFrame) -> DataFrame:
    """Samples from ``row_idx, value``; ids come from line numbers, blank lines are skipped."""
    trimmed = lines.withColumn("value", strip("value")).filter("value <> ''")
    parsed = trimmed.withColumn(
        "record", F.from_json("value", S.MANIFEST_SCHEMA, {"mode": "FAILFAST"})
    )
    record = F.col("record")
    text = _key_or(record, "text", "")
    columns = canonical(
        text, record.image_path, record.width, record.height, F.col(S.ROW_INDEX)
    )
    return parsed.select(S.ROW_INDEX, *columns)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return manifest_from_lines(index_lines(spark, path))
