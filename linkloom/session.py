"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import linkloom

# The packed code of each application; Spark reads it for as long as the application runs.
_SHIPPED: dict[str, tempfile.TemporaryDirectory] = {}

# Settings the plans rely on. AQE merges small partitions; written files come out near 256 MB.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def build_session(
    app: str = "linkloom", local_cores: int | None = None, partitions: int | None = None
) -> SparkSession:
    """A session on the submitting cluster, or on this machine with ``local_cores``.

    ``partitions`` is how many each shuffle starts with. AQE merges small ones but splits only
    skewed ones, so give about one for each 256 MB of the largest shuffle; the cluster's own
    setting holds if none is given.
    """
    builder = SparkSession.builder.appName(app)
    settings = dict(SETTINGS)
    if local_cores:
        builder = builder.master(f"local[{local_cores}]")
        settings |= {
            "spark.sql.shuffle.partitions": str(local_cores),
            "spark.ui.enabled": "false",
        }
    else:
        settings |= CLUSTER_SETTINGS
    if partitions:
        settings["spark.sql.shuffle.partitions"] = str(partitions)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession) -> str:
    """A new folder name under the shared folder named by ``spark.checkpoint.dir``."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="linkloom-")
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def ship(spark: SparkSession) -> None:
    """Give the package to the executors through Spark's file server, once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    top, folder = Path(linkloom.__file__).parent, tempfile.TemporaryDirectory()
    with zipfile.ZipFile(f"{folder.name}/linkloom.zip", "w") as archive:
        for source in sorted(top.rglob("*.py")):
            archive.write(source, source.relative_to(top.parent))
    context.addPyFile(archive.filename)
    _SHIPPED[context.applicationId] = folder
