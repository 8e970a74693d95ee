"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app: str = "gazetick", cores: str = "*", **conf: str) -> SparkSession:
    """Local session for tests and the bench; a cluster passes its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_utc(spark: SparkSession) -> SparkSession:
    """Bars and dates are naive UTC throughout; pin the session to that."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session, where driver and
    executors are one machine, may fall back to a temporary folder.
    """
    path = spark.conf.get(CHECKPOINT_DIR, None)
    if path:
        return path
    if spark.sparkContext.master.partition("[")[0] != "local":
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors share")
    path = tempfile.mkdtemp(prefix="gazetick-")
    spark.conf.set(CHECKPOINT_DIR, path)
    return path


def run_dir(spark: SparkSession) -> str:
    """The application's own folder inside the shared one; :func:`clean_up` removes it."""
    return f"{shared_dir(spark).rstrip('/')}/gazetick-{spark.sparkContext.applicationId}"


def clean_up(spark: SparkSession) -> None:
    """Remove all that this application has staged. Tables that are still read from there are gone then."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(run_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def stage(df: DataFrame, types: dict[str, T.DataType] | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage for iterative jobs and for results that several branches read. Parquet rather
    than an RDD checkpoint, so later branches still prune columns and push filters. ``types`` names
    columns to be read as another type of the same storage.
    """
    spark = df.sparkSession
    path = f"{run_dir(spark)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    fields = [T.StructField(f.name, (types or {}).get(f.name, f.dataType), f.nullable, f.metadata) for f in df.schema.fields]
    return spark.read.schema(T.StructType(fields)).parquet(path)
