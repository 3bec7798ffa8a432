"""JSON arrays inside zip files, as a data source: ``spark.read.format("zipped_json").schema(...).load(path)``.

The array is the first member of each zip file. A zip file is read by one task, many small ones by the same; its member is
unpacked and cut into items while it is read, so no task holds an array. Only the fields of the given
schema are kept, at any depth. Two names are filled in by the source: ``zip_file``, where an item comes from, and
``zip_item``, its place in the array from 0.
"""

import codecs
import json
import zipfile
from collections.abc import Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from pixsieve.files import open_listed

FILE_FIELD, ITEM_FIELD = "zip_file", "zip_item"
CHUNK_BYTES = 1 << 18
BATCH_ITEMS = 4096
BATCH_CHARS = 4 << 20
MOST_BYTES, TASKS_PER_CORE = 16 << 20, 8
_BLANK = " \t\r\n"
# An item cut off at the end of what was read so far shows as an error this near to it, or as an open string.
_NEAR_END = 16


def array_items(chunks: Iterable[bytes]) -> Iterator[tuple[Any, int]]:
    """(item, its length in characters) of one JSON array, decoded one by one while the bytes come in.

    Holds one item and two chunks at most. Anything but an array raises ``ValueError``.
    """
    source, decode = iter(chunks), codecs.getincrementaldecoder("utf-8-sig")().decode
    scan = json.JSONDecoder().raw_decode
    text, at, ended = "", 0, False

    def more(least: int = 1) -> bool:
        """Reads on until ``least`` characters more are there; whether anything came."""
        nonlocal text, at, ended
        parts, size = [text[at:]], 0
        while size < least and not ended:
            chunk = next(source, None)
            ended = chunk is None
            parts.append(decode(chunk or b"", ended))
            size += len(parts[-1])
        text, at = "".join(parts), 0
        return size > 0

    def next_sign() -> str:
        """The next character that is not blank; empty at the end."""
        nonlocal at
        while True:
            while at < len(text) and text[at] in _BLANK:
                at += 1
            if at < len(text):
                return text[at]
            if not more():
                return ""

    def item() -> tuple[Any, int]:
        nonlocal at
        while True:
            try:
                value, end = scan(text, at)
            except json.JSONDecodeError as error:
                cut = error.pos >= len(text) - _NEAR_END or error.msg.startswith("Unterminated string")
                if not cut or not more(len(text) - at + 1):
                    raise
                continue
            size, rest = end - at, text[end:end + _NEAR_END]
            # At the end of what was read, a number may go on in the next chunk.
            complete = len(rest) == _NEAR_END or rest.strip("0123456789.eE+-")
            if complete or not more():
                at += size
                return value, size

    if next_sign() != "[":
        raise ValueError("not a JSON array")
    at += 1
    if next_sign() == "]":
        at += 1
    else:
        while True:
            next_sign()
            yield item()
            sign = next_sign()
            if sign not in (",", "]"):
                raise ValueError("the array is not closed" if not sign else f"no comma after an item but {sign!r}")
            at += 1
            if sign == "]":
                break
    if next_sign():
        raise ValueError("data after the array")


class ZipFiles(InputPartition):
    def __init__(self, places: list[str]):
        super().__init__(places)


def packed(files: list[tuple[str, int]], most_bytes: int) -> list[list[str]]:
    """Names of (name, bytes) in runs, each closed as soon as it has ``most_bytes``."""
    runs, size = [], 0
    for name, length in files:
        if not runs or size >= most_bytes:
            runs.append([])
            size = 0
        runs[-1].append(name)
        size += length
    return runs


class _Reader(DataSourceReader):
    def __init__(self, options: dict, schema: T.StructType):
        self.schema = schema
        self.runs = json.loads(options["places"])

    def partitions(self) -> list[InputPartition]:
        return [ZipFiles(r) for r in self.runs] or [ZipFiles([])]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        for place in partition.value:
            yield from self.items(place)

    def items(self, place: str) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        layout = to_arrow_schema(self.schema)
        own = {FILE_FIELD: place} if FILE_FIELD in layout.names else {}
        with open_listed(place) as stream, zipfile.ZipFile(stream) as archive:
            names = archive.namelist()
            if not names:
                raise ValueError(f"no member in {place}")
            rows, size = [], 0
            with archive.open(names[0]) as member:
                items = array_items(iter(lambda: member.read(CHUNK_BYTES), b""))
                for number, (item, length) in enumerate(items):
                    if not isinstance(item, dict):
                        raise ValueError(f"item {number} of {place} is no object")
                    rows.append({**item, **own, ITEM_FIELD: number})
                    size += length
                    if len(rows) >= BATCH_ITEMS or size >= BATCH_CHARS:
                        yield pa.RecordBatch.from_pylist(rows, schema=layout)
                        rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=layout)


class ZippedArrays(DataSource):
    @classmethod
    def name(cls) -> str:
        return "zipped_json"

    def schema(self) -> T.StructType:
        raise ValueError("zipped_json needs a schema: it names the fields to keep")

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(self.options, schema)


def read_zipped_arrays(spark: SparkSession, path: str, layout: T.StructType) -> DataFrame:
    """The items of the arrays in the zip files under ``path``: ``zip_file, zip_item`` and the fields of ``layout``.

    The driver lists the files, name and size each, packs them into partitions by size, and opens none.
    """
    spark.dataSource.register(ZippedArrays)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path)
    listed = [(r["path"], r["length"]) for r in files.select("path", "length").orderBy("path").collect()]
    # A few tasks per core as long as they stay small; a task for every file would mostly start and stop.
    share = sum(length for _, length in listed) // (TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    runs = packed(listed, min(MOST_BYTES, max(1, share)))
    whole = T.StructType([
        T.StructField(FILE_FIELD, T.StringType()), T.StructField(ITEM_FIELD, T.LongType()), *layout.fields,
    ])
    return spark.read.format("zipped_json").schema(whole).option("places", json.dumps(runs)).load()
