"""Writers; each output is a folder of part files."""

import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pixsieve import schema as S

_CORRUPT = "_corrupt_record"
_VERSION = re.compile(r"version=(\d{8})$")


def _write_json(df: DataFrame, path: str) -> None:
    """One object per line; NULL fields are written, text is not escaped."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def save_samples(df: DataFrame, path: str, format: str = "json") -> None:
    """All rows, rejected ones too, in input order; internal columns are left out."""
    ordered = df.orderBy(S.ROW_INDEX) if S.ROW_INDEX in df.columns else df
    rows = ordered.select(*S.SAMPLE_COLUMNS)
    if format == "json":
        _write_json(rows, path)
    else:
        rows.write.mode("overwrite").format(format).save(path)


def save_annotations(df: DataFrame, path: str) -> None:
    ordered = df.orderBy(S.ROW_INDEX) if S.ROW_INDEX in df.columns else df
    _write_json(ordered.select(*S.ANNOTATION_SCHEMA.fieldNames()), path)


def save_metrics(df: DataFrame, path: str) -> None:
    _write_json(df, path)


def save_manifest(df: DataFrame, path: str, order: str | None = None) -> None:
    ordered = df.orderBy(order) if order else df
    _write_json(ordered.select(*S.MANIFEST_SCHEMA.fieldNames()), path)


def with_dedup_metrics(metrics: DataFrame | None, dedup: DataFrame) -> DataFrame:
    """The operator metrics and a row for the dedup step; a row of that name is replaced."""
    row = dedup.select(F.lit(S.DEDUP_LABEL).alias("operator"), "*")
    if metrics is None:
        return row
    others = metrics.filter(F.col("operator") != S.DEDUP_LABEL)
    return others.unionByName(row, allowMissingColumns=True)


class _Store:
    """A folder of numbered versions, each a folder of JSON Lines that appears by one rename."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.hadoop = spark, spark._jvm.org.apache.hadoop.fs
        self.root = self.hadoop.Path(path)
        conf = spark._jsc.hadoopConfiguration()
        self.fs = self.root.getFileSystem(conf)
        self.context = self.hadoop.FileContext.getFileContext(self.fs.getUri(), conf)

    def versions(self) -> list[int]:
        if not self.fs.exists(self.root):
            return []
        names = [entry.getPath().getName() for entry in self.fs.listStatus(self.root) if entry.isDirectory()]
        return sorted(int(m[1]) for m in map(_VERSION.match, names) if m)

    def place(self, version: int) -> str:
        return self.hadoop.Path(self.root, f"version={version:08d}").toString()

    def commit(self, df: DataFrame, version: int) -> bool:
        """Writes beside and renames; False if another writer was first with this version."""
        beside = self.hadoop.Path(self.root, f".writing-{uuid.uuid4().hex}")
        df.coalesce(1).write.option("ignoreNullFields", "false").json(beside.toString())
        options = self.spark.sparkContext._gateway.new_array(self.hadoop.Options.Rename, 0)
        try:
            self.context.rename(beside, self.hadoop.Path(self.place(version)), options)
        except Py4JJavaError as error:
            self.fs.delete(beside, True)
            if error.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
                raise
            return False
        return True


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The stored metrics of the newest version; without rows if there is none or if it is corrupt.

    Versions appear whole, so a reader never sees half a file whatever is being written.
    """
    versions = _Store(spark, path).versions()
    fields = S.METRICS_SCHEMA.fieldNames()
    if not versions:
        return spark.createDataFrame([], S.METRICS_SCHEMA)
    layout = T.StructType([*S.METRICS_SCHEMA, T.StructField(_CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    # One row per operator of a chain, so they fit the driver.
    rows = spark.read.schema(layout).options(**options).json(_Store(spark, path).place(versions[-1])).collect()
    if any(r[_CORRUPT] is not None for r in rows):
        rows = []
    return spark.createDataFrame([tuple(r[f] for f in fields) for r in rows], S.METRICS_SCHEMA)


def append_metrics(spark: SparkSession, path: str, rows: DataFrame) -> int:
    """Merge metrics into those stored under ``path`` and return the new version.

    Rows of an operator replace the stored ones of that name, others stay. A missing or corrupt store counts as
    empty. Two writers at a time both succeed: the second merges into what the first stored.
    """
    store, missing = _Store(spark, path), [f for f in S.METRICS_SCHEMA if f.name not in rows.columns]
    given = rows.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing]).select(*S.METRICS_SCHEMA.fieldNames())
    own = spark.createDataFrame([tuple(r) for r in given.collect()], S.METRICS_SCHEMA)
    while True:
        version = max(store.versions(), default=0) + 1
        others = read_metrics(spark, path).join(own.select("operator"), "operator", "left_anti")
        if store.commit(others.select(*own.columns).unionByName(own), version):
            return version


def metrics_dict(metrics: DataFrame) -> dict[str, dict]:
    """Driver view of a metrics table: one entry per operator, without NULL fields."""
    out = {}
    for row in metrics.collect():
        values = row.asDict()
        name = values.pop("operator")
        out[name] = {k: v for k, v in values.items() if v is not None}
    return out
