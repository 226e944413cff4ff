"""Session services shared by all operators: code shipping, table access and stage tables.

A *stage table* is an intermediate result written to the folder that all executors share
(``spark.checkpoint.dir``).  It cuts lineage, survives the loss of executors and is columnar and
compressed, so it costs less disk than an RDD checkpoint.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PACKAGE = Path(__file__).resolve().parent
_shipped: set[str] = set()
_folders: dict[str, str] = {}
_tables: dict[str, list[str]] = {}


def prepare(spark: SparkSession) -> SparkSession:
    """Make the package importable in Python workers and set what every query relies on.

    Idempotent for an application: the package is zipped and added once.
    """
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        # Only the driver reads this file; Spark serves it to the executors.
        archive = Path(tempfile.mkdtemp(prefix="pagelens-")) / "pagelens_src.zip"
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
            for p in sorted(PACKAGE.rglob("*.py")):
                z.write(p, str(Path("pagelens") / p.relative_to(PACKAGE)))
        spark.sparkContext.addPyFile(str(archive))
        _shipped.add(app)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder that driver and all executors see: the session's ``spark.checkpoint.dir``.

    Where it is unset a temporary folder is used in local mode only; on a cluster that is an error,
    since a machine-local folder would be lost or unreachable.
    """
    app = spark.sparkContext.applicationId
    if app not in _folders:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            base = "file://" + tempfile.mkdtemp(prefix="pagelens-shared-")
            spark.sparkContext.setCheckpointDir(base)
        _folders[app] = f"{base.rstrip('/')}/pagelens-{uuid.uuid4().hex[:12]}"
    return _folders[app]


def stage(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as a stage table and return a scan of it with the same schema."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    w = df.write.mode("errorifexists")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_bucketed(df: DataFrame, name: str, column: str, buckets: int) -> DataFrame:
    """Write ``df`` as a stage table in buckets of ``column``, so joins and groups by it needn't move its rows."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    table_name = f"stage_{uuid.uuid4().hex[:16]}"
    df.write.bucketBy(buckets, column).option("path", path).saveAsTable(table_name)
    _tables.setdefault(spark.sparkContext.applicationId, []).append(table_name)
    return spark.table(table_name)


def discard(spark: SparkSession) -> None:
    """Delete all stage tables of this application; results that read them must be consumed before."""
    for name in _tables.pop(spark.sparkContext.applicationId, []):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    folder = _folders.pop(spark.sparkContext.applicationId, None)
    if folder:
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of one input table; a parquet file or a folder of them."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def require(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` cut down to the named columns.

    Operators call it first, so extra columns, whatever their names, can't clash with inner ones.
    """
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*[F.col(f"`{c}`") for c in columns])


def local_session(cores: int | str = "*", **conf: str) -> SparkSession:
    """A session for tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("pagelens")
    base = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("PAGELENS_DRIVER_MEMORY", "8g"),
        "spark.driver.host": "127.0.0.1",
    }
    spark = builder.config(map=base | conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)
