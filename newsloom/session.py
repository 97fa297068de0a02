"""Session settings and the one place where lineage is cut."""

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation, SparkSession

#: Settings the jobs are written for; pass them to the session builder.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # pages are tens of kilobytes each, so Arrow batches hold fewer rows
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

_LOCAL_DIRS: dict[str, str] = {}
_SHIPPED: set[str] = set()


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, as named by ``spark.checkpoint.dir``."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not (spark.conf.get("spark.master", None) or "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.conf.get("spark.app.id", None) or "local"
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="newsloom-")
    return _LOCAL_DIRS[app]


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    A written table survives lost executors, and its file sizes give the
    optimiser real statistics for the joins that follow.
    """
    return cut_and_measure(df)[0]


def cut_and_measure(df: DataFrame, **measures: Column) -> tuple[DataFrame, dict]:
    """``cut_lineage`` plus aggregates collected while writing, at no extra job."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark).rstrip('/')}/newsloom-{uuid.uuid4().hex}"
    seen = Observation()
    out = df.observe(seen, *[c.alias(k) for k, c in measures.items()]) if measures else df
    out.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), (seen.get if measures else {})


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers that do not have it installed."""
    app = spark.conf.get("spark.app.id", None) or "local"
    if app in _SHIPPED:
        return
    target = Path(tempfile.mkdtemp(prefix="newsloom-zip-")) / "newsloom"
    root = Path(__file__).resolve().parent.parent
    archive = shutil.make_archive(str(target), "zip", root, "newsloom")
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)
