"""Session settings, and the folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import SparkSession

#: Wall-clock timestamps need the session's zone to be the JVM's; adaptive execution and filter pushdown are on.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.orc.filterPushdown": "true",
    "spark.sql.orc.enableVectorizedReader": "true",
    "spark.driver.extraJavaOptions": "-Duser.timezone=UTC",
    "spark.executor.extraJavaOptions": "-Duser.timezone=UTC",
}


def session(master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.config(map=SETTINGS | {k.replace("__", "."): v for k, v in conf.items()})
    return (builder.master(master) if master else builder).getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; set here only if it is unset and the executors run in this process (tests). On a cluster a
    folder of this machine would be another one on each executor, so there it has to be set."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not path:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="stripeline-shared-")
        atexit.register(shutil.rmtree, path.removeprefix("file://"), True)
        spark.conf.set("spark.checkpoint.dir", path)
        spark.sparkContext.setCheckpointDir(path)
    return path


def wall_clock_is_safe(spark: SparkSession) -> bool:
    """ORC timestamps keep their wall clock only if the JVM's zone is the session's."""
    zone = spark.sparkContext._jvm.java.util.TimeZone.getTimeZone
    own, jvm = zone(spark.conf.get("spark.sql.session.timeZone")), spark.sparkContext._jvm.java.util.TimeZone.getDefault()
    return own.hasSameRules(jvm)
