"""Session set-up and the one place that decides where lineage is cut."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession, functions as F


def make_session(app: str = "rollspan", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators assume; anything passed in ``conf`` wins."""
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_SHIPPED: set[str] = set()
_LOCAL: dict[str, str] = {}
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def ship_package(spark: SparkSession) -> SparkSession:
    """Send this package to the Python workers, once per application.

    Functions travel to the workers by module name, so the workers must be able to import
    the package wherever the driver was started.
    """
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        root = os.path.dirname(os.path.abspath(__file__))
        path = os.path.join(tempfile.mkdtemp(prefix="rollspan-package-"), "rollspan_package.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in os.walk(root):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.relpath(full, os.path.dirname(root)))
        sc.addPyFile(path)
        _SHIPPED.add(sc.applicationId)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder that the driver and all executors reach: ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder (one per application): on a
    cluster a machine-local path would be lost with its executor.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        if sc.applicationId not in _LOCAL:
            _LOCAL[sc.applicationId] = tempfile.mkdtemp(prefix="rollspan-shared-")
        configured = _LOCAL[sc.applicationId]
    return configured


def cut_lineage(df: DataFrame, drops_shuffles: bool = False) -> DataFrame:
    """Materialise ``df`` in the reliable checkpoint directory (see :func:`shared_folder`).

    ``drops_shuffles``: the shuffle files of this job go as soon as it has ended, not when the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(spark))
    if not drops_shuffles:
        return df.checkpoint()
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        return df.select("*").checkpoint()  # a plan of its own: only its shuffles are dropped
    finally:
        spark.conf.unset(_DROP_SHUFFLES) if before is None else spark.conf.set(_DROP_SHUFFLES, before)


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row aggregate to every row through a scalar subquery.

    Spark runs the subquery once and hands its row to the tasks as a constant, so neither
    a driver round trip nor a join is planned.
    """
    row = one_row.select(F.struct(*one_row.columns).alias("_row")).scalar()
    return df.withColumn("_row", row).select(
        *df.columns, *[F.col(f"_row.{c}").alias(c) for c in one_row.columns])
