"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The characters that separate words, as a class of a regular expression's body.
WORD_GAP = r"\x20\x09-\x0D"


_OWN: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, which the session names in ``spark.checkpoint.dir``.

    Where it names none, a local session (tests) gets a temporary folder; on a cluster that would be
    a folder of one machine, so there it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not _OWN:
        _OWN.append("file://" + tempfile.mkdtemp(prefix="lexquarry-"))
        atexit.register(shutil.rmtree, _OWN[0].removeprefix("file://"), ignore_errors=True)
    return _OWN[0]


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session may have ended already
        pass


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    It cuts the lineage: a lost executor costs the tasks that it ran, not the stages before. The
    folder goes with ``discard``, else when the driver's process ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_remove, spark, path)
    back = spark.read.schema(df.schema).parquet(path)
    back._lexquarry_path = path
    return back


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialize`` wrote and that no result still to be computed reads."""
    for table in tables:
        _remove(table.sparkSession, table._lexquarry_path)


def _trim(spark: SparkSession) -> str | None:
    """Have the driver's JVM give freed native memory back to the system; what it says of that, or None where it can't (before Java 17.0.9, other C libraries)."""
    sc = spark.sparkContext
    jvm, array = sc._jvm, sc._gateway.new_array
    try:
        # the server's own class isn't public, its interface is
        forms = array(jvm.java.lang.Class, 4)
        for i, name in enumerate(("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")):
            forms[i] = jvm.java.lang.Class.forName(name)
        call = array(jvm.java.lang.Object, 4)
        call[0], call[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        server = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
        return jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethod("invoke", forms).invoke(server, call)
    except Exception:
        return None


def release(spark: SparkSession) -> None:
    """Give back what finished steps left in the driver.

    Python's references to their plans go, then the JVM's (by which Spark drops their shuffles and broadcasts), and a
    full collection shrinks the heap. Code that was compiled meanwhile and blocks that were sent leave freed
    native memory, which the C library keeps for each thread unless told to return it.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    _trim(spark)


def text_of(column: str) -> Column:
    """The text of a row, a null as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def free_name(name: str, taken: list[str]) -> str:
    """``name``, or with the first number behind it that makes it unlike the names taken (which Spark compares without case)."""
    low = {t.lower() for t in taken}
    return next(n for n in (name, *(f"{name}_{i}" for i in range(1, len(low) + 2))) if n.lower() not in low)


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")
