"""Lineage cuts that survive a lost executor: Parquet tables in the shared folder."""

from __future__ import annotations

import gc
import time
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir, which all executors share.

    Where it is unset (as in tests) a local master gets a folder of its own; a
    cluster has none that all its machines see, so there it must be set.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch"
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def scratch_path(spark: SparkSession) -> str:
    """A new place in the shared folder."""
    return f"{scratch_dir(spark)}/{uuid.uuid4().hex}.parquet"


def save(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._scratch_path = path
    return table


def drop(table: DataFrame) -> None:
    """Delete a table made by ``save`` that nothing reads any more."""
    jvm = table.sparkSession.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(table._scratch_path)
    path.getFileSystem(table.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def short_plans(spark: SparkSession, characters: int = 16_384) -> None:
    """Bound the text of each plan that the driver keeps and logs, once for each change of the plan; plans themselves stay as they are."""
    if int(spark.conf.get("spark.sql.maxPlanStringLength").rstrip("b")) > characters:
        spark.conf.set("spark.sql.maxPlanStringLength", str(characters))


def give_back(spark: SparkSession) -> str | None:
    """Hand native memory that the driver's JVM has freed, mostly after compiling, back to the system; what the JVM says, or None where it has no such command."""
    gateway = spark.sparkContext._gateway
    jvm = gateway.jvm
    try:
        # by the interface, as the class of the bean server is not open to callers
        call = next(m for m in jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke")
        given = gateway.new_array(jvm.java.lang.Object, 4)
        given[0], given[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        return call.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), given)
    except Py4JError:
        return None


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop shuffle files that no live DataFrame needs, and the driver's JVM the memory that it has freed."""
    for wait in (0.1, 0.1):  # the first collection frees the plans, the second what only they held
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(wait)
    give_back(spark)
