"""Tables that cut lineage, in the folder that all executors share."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

from sluice.llm.batches import let_go

#: Files of a written table a core.
FILES = 4
#: Tables of an operator after which the driver is cleaned up.
TABLES = 4


def shared_folder(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir; where it is unset, as in tests, a folder of the context's own."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or getattr(context, "_sluice_folder", None)
    if not folder:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = context._sluice_folder = tempfile.mkdtemp(prefix="checkpoints-")
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def in_files(rows: DataFrame) -> DataFrame:
    """The rows in at most FILES partitions a core: each takes several of the plan's one after another, so a small table of many partitions isn't as many files."""
    return rows.coalesce(FILES * rows.sparkSession.sparkContext.defaultParallelism)


def kept(rows: DataFrame, name: str = "rows") -> DataFrame:
    """The rows, written in the shared folder and read again."""
    spark = rows.sparkSession
    path = new_path(spark, name)
    in_files(rows).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


class Scratch:
    """The tables that one operator writes on its way, all in one folder of the shared one."""

    def __init__(self, spark: SparkSession, name: str = "scratch"):
        self.spark, self.path = spark, new_path(spark, name)
        self.made = 0

    def kept(self, rows: DataFrame, name: str) -> DataFrame:
        """The rows, written here and read again."""
        self.made += 1
        path = f"{self.path}/{name}-{self.made}"
        in_files(rows).write.option("compression", "zstd").parquet(path)
        if self.made % TABLES == 0:  # plans of many stages leave much behind in the driver
            settled(self.spark)
        return self.spark.read.schema(rows.schema).parquet(path)

    def last(self, rows: DataFrame, name: str) -> DataFrame:
        """The operator's result, written beside the folder, which goes: nothing but the result stays."""
        out = kept(rows, name)
        dropped(self.spark, self.path)
        settled(self.spark)
        return out


def dropped(spark: SparkSession, path: str) -> None:
    """Deletes a table of the shared folder that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def settled(spark: SparkSession) -> None:
    """Has the driver free the shuffle files of plans that are done with, and give freed memory back, now, not at its next periodic collection."""
    let_go()
    spark._jvm.System.gc()
    with contextlib.suppress(Py4JError):  # an older Java, or another system than Linux
        _trimmed(spark)


def _trimmed(spark: SparkSession) -> None:
    """Has the driver's Java give freed memory outside its heap (of compilers, codecs) back to the system: malloc_trim, a command of Java's since 17.0.9."""
    jvm, array = spark._jvm, spark.sparkContext._gateway.new_array
    lang = jvm.java.lang
    kinds, values = array(lang.Class, 4), array(lang.Object, 4)
    for k, (kind, value) in enumerate((
        ("javax.management.ObjectName", jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")),
        ("java.lang.String", "systemTrimNativeHeap"),
        ("[Ljava.lang.Object;", array(lang.Object, 0)),
        ("[Ljava.lang.String;", array(lang.String, 0)),
    )):
        kinds[k], values[k] = lang.Class.forName(kind), value
    invoke = lang.Class.forName("javax.management.MBeanServer").getMethod("invoke", kinds)  # the server's own class is closed to reflection
    invoke.invoke(lang.management.ManagementFactory.getPlatformMBeanServer(), values)
