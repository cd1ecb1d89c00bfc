"""Session settings and the shared folder for intermediate tables."""

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app_name="labelweave", master=None, **conf):
    """A session with adaptive execution on; cluster sizing stays with the caller."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    settings.update(conf)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def ship_package(spark):
    """Sends this package to the executors, where it is not installed; needed
    by whatever runs Python there. Once per session, a few hundred kilobytes."""
    context = spark.sparkContext
    if getattr(context, "_labelweave_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="labelweave-"), "labelweave.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)
    context._labelweave_shipped = True


def shared_dir(spark):
    """The folder all executors share.

    A cluster names it in ``spark.checkpoint.dir``. Only where that is unset
    on a local master is a folder of this machine used.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="labelweave-")
    spark.conf.set(CHECKPOINT_DIR, folder)
    return folder


def fresh_dir(spark, name):
    """A new path below the shared folder; nothing is created there yet."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df, name):
    """Write a frame once and read it back, so that later passes share the
    written rows and a lost executor costs no recomputation."""
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def spread(scan):
    """A scan of fewer splits than cores, dealt out to all cores.

    A table of a few row groups would otherwise keep most cores idle through
    costly row-wise work. A scan of many splits is returned untouched, so no
    large table is ever moved by this. Meant for plain scans.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= cores:
        return scan
    return scan.repartition(cores)
