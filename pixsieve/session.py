"""Where intermediate tables live, and the session settings used by tests and the bench."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: str = "8", name: str = "pixsieve") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName(name)
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared checkpoint folder of the session.

    The folder is the one the cluster names in ``spark.checkpoint.dir``. Only a local
    master may fall back to a temporary folder of the machine.
    """
    context = spark.sparkContext
    base = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="pixsieve-")
        context.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def write_table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt evenly over the session's shuffle partitions.

    For rows that are short but cost much each, such as files to open: partitions that are cut or merged by bytes
    would leave them to a few tasks.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
