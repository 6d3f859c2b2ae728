"""The shared folder for intermediate and landed output."""

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

_REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@cache
def _folder_of_this_machine() -> str:
    return tempfile.mkdtemp(prefix="grantline-")


def shared_folder(spark: SparkSession) -> str:
    """A new path below the folder that the cluster names in ``spark.checkpoint.dir``.

    Only a session whose executor threads live in the driver's own process (master ``local`` or
    ``local[n]``, as in tests) may leave it unset; it then gets a temporary folder.  Everything else
    has to set it: a folder of one machine would be lost with it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir has to name a shared folder")
        root = _folder_of_this_machine()
    return f"{root.rstrip('/')}/{run_folder(spark)}/{uuid.uuid4().hex}"


def run_folder(spark: SparkSession) -> str:
    """The sub-folder of the shared folder with all that this application writes; delete it afterwards."""
    return f"grantline-{spark.sparkContext.applicationId}"


def stage(rows: DataFrame) -> DataFrame:
    """Compute a result once into the shared folder and go on from there.

    The written table cuts the lineage and survives the loss of executors.  The shuffle files behind it
    are not needed any more, so Spark is told to remove them when the table is written.
    """
    spark = rows.sparkSession
    path = shared_folder(spark)
    before = spark.conf.get(_REMOVE_SHUFFLES, "false")
    spark.conf.set(_REMOVE_SHUFFLES, "true")
    try:
        rows.write.parquet(path)
    finally:
        spark.conf.set(_REMOVE_SHUFFLES, before)
    return spark.read.schema(rows.schema).parquet(path)
