"""Session helpers shared by all operators."""

from __future__ import annotations

import atexit
import ctypes
import gc
import os
import shutil
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder named by ``spark.checkpoint.dir``; a temporary one only where none is set and all tasks run on this machine (tests)."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = sc.getConf().get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if not named:
            named = tempfile.mkdtemp(prefix="strandlake-ckpt-")
            atexit.register(shutil.rmtree, named, ignore_errors=True)
        sc.setCheckpointDir(named)


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut the lineage by a reliable checkpoint that every executor can read again."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager)


def drop(*tables: DataFrame) -> None:
    """Delete the files of tables made by ``cut`` that nothing will read again."""
    for df in tables:
        sc = df.sparkSession.sparkContext
        file = df._jdf.queryExecution().logical().rdd().getCheckpointFile()
        if file.isDefined():
            path = sc._jvm.org.apache.hadoop.fs.Path(file.get())
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Keys up to which a semi-join may broadcast its side; each is one 64-bit value.
BROADCAST_KEYS = 500_000


def rows_with(df: DataFrame, keys: DataFrame, on: str, most: int = BROADCAST_KEYS) -> DataFrame:
    """Rows of ``df`` whose ``on`` is among ``keys``: the distinct keys are broadcast if counted to be few, else both sides are shuffled."""
    own = cut(keys.select(on).distinct())
    few = own.limit(most + 1).count() <= most
    return df.join(F.broadcast(own) if few else own, on, "left_semi")


#: Rows and bytes up to which a table may be broadcast.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 32 << 20


def _width(df: DataFrame) -> Column:
    """Bytes of a row, about: eight for a value, texts and nested values by their length as text."""
    out = F.lit(0)
    for field in df.schema:
        kind, c = field.dataType, F.col(f"`{field.name}`")
        if isinstance(kind, (T.StringType, T.BinaryType)):
            out = out + F.coalesce(F.octet_length(c), F.lit(0)) + 8
        elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            out = out + F.coalesce(F.octet_length(F.to_json(c if isinstance(kind, T.StructType) else F.struct(c))), F.lit(0)) + 8
        else:
            out = out + 8
    return out


def hinted(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """The table cut off, with a broadcast hint if it is counted to have at most ``most`` rows and ``BROADCAST_BYTES``; else joins with it are shuffled."""
    own = cut(df)
    rows, size = own.agg(F.count("*"), F.sum(_width(own))).first()
    return F.broadcast(own) if rows <= most and (size or 0) <= BROADCAST_BYTES else own


#: Keys that can be taken out of a shuffled join (each has at least that share of the rows), and rows of a key below which none is.
HOT_KEYS, HOT_ROWS = 500, 500


def hot_keys(df: DataFrame, key: str) -> list:
    """The keys that hold more than a ``HOT_KEYS``-th of the rows, by a mergeable sketch of frequent items: one pass, bounded whatever the table.

    Joins use it to choose where rows meet, never which rows there are, so its small errors change no result.
    """
    known = df.where(F.col(key).isNotNull())
    n, top = known.agg(F.count("*"), F.expr(f"approx_top_k(`{key}`, {HOT_KEYS}, {8 * HOT_KEYS})")).first()
    return [x["item"] for x in top or [] if x["count"] > max(HOT_ROWS, n / HOT_KEYS)]


def joined(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner", hot: list | None = None) -> DataFrame:
    """``left`` joined ("inner" or "left") with ``right``, which has one row a key, where a few keys may hold most of ``left``.

    Rows of ``left`` with a hot value of the (first) key meet their few rows of ``right`` by broadcast, rows without a key meet none; only
    the rest is shuffled, so no task gets the rows of a hot key. Both sides should be cut off, as they are read twice.
    """
    keys = [on] if isinstance(on, str) else list(on)
    hot = hot_keys(left, keys[0]) if hot is None else hot
    known = left.where(F.col(keys[0]).isNotNull())
    if hot:
        among = F.col(keys[0]).isin(hot)
        few = right.where(among)  # at most HOT_KEYS values, and one row a key
        out = known.where(~among).join(right.where(~among), keys, how).unionByName(known.where(among).join(F.broadcast(few), keys, how))
    else:
        out = known.join(right, keys, how)
    if how == "left":
        none = [F.lit(None).cast(t).alias(c) for c, t in right.dtypes if c not in keys]
        out = out.unionByName(left.where(F.col(keys[0]).isNull()).select("*", *none))
    return out


def together(df: DataFrame, *keys: str) -> DataFrame:
    """Rows with equal ``keys`` in one partition, also above a join on the same keys.

    Spark leaves out a ``repartition`` by the keys that its child is partitioned by already, and may then split a skewed partition of that
    join, as it sees no need of a Python function above. A hash of the keys is a partitioning that no child has.
    """
    return df.repartition(F.xxhash64(*keys))


def ship(spark: SparkSession) -> None:
    """Give Python workers this package where they would not find it: a session started outside the repository."""
    root = Path(__file__).resolve().parents[1]
    sc = spark.sparkContext
    if Path.cwd() == root or str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or getattr(sc, "_strandlake_shipped", False):
        return
    sc._strandlake_shipped = True
    folder = tempfile.mkdtemp(prefix="strandlake-package-")  # served from here for as long as the session lives
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    packed = Path(folder, "strandlake_package.zip")
    with zipfile.ZipFile(packed, "w") as z:
        for p in sorted(root.glob("strandlake/**/*.py")):
            z.write(p, p.relative_to(root))
    sc.addPyFile(str(packed))


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of tables that are no longer referred to: its cleaner acts when the driver's JVM collects.

    Plans and their tasks are garbage of the driver too; both its JVM and its Python side hand freed memory back.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    trim_memory()
    trim_driver(spark)


def trim_driver(spark: SparkSession) -> str:
    """Hand native memory that the driver's JVM has freed back to the system; what the JVM says of it, or nothing where it has no such command.

    Its allocator keeps what many threads have freed (compiled plans, buffers), beyond the heap and its limit, and more with every run in a session.
    """
    jvm, array = spark.sparkContext._jvm, spark.sparkContext._gateway.new_array
    forName = jvm.java.lang.Class.forName
    kinds, values = array(jvm.java.lang.Class, 4), array(jvm.java.lang.Object, 4)
    try:
        values[0] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")
        values[1], values[2], values[3] = "systemTrimNativeHeap", array(jvm.java.lang.Object, 0), array(jvm.java.lang.String, 0)
        for i, kind in enumerate(("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")):
            kinds[i] = forName(kind)
        invoke = forName("javax.management.MBeanServer").getMethod("invoke", kinds)
        return invoke.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), values)
    except Py4JError:  # another JVM or system; only memory is at stake
        return ""


def trim_memory() -> None:
    """Hand memory that this process has freed back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library only
    if trim:
        trim(0)


#: Bytes and rows of an Arrow batch for a Python worker. Texts can be long; batches of this size bound what a worker, and Spark's buffers beside it, hold.
BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": "2m", "spark.sql.execution.arrow.maxRecordsPerBatch": "2000"}


def bounded_batches(spark: SparkSession) -> None:
    """Hand texts to Python workers in smaller batches than Spark does by default, unless the session sets its own size.

    Plans read these settings when they run, which is after the operator has returned, so they stay set in the session.
    """
    own = spark.conf.getAll
    for name, value in BATCHES.items():
        if name not in own:
            spark.conf.set(name, value)


def giving_back(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The same function of Arrow batches, but a worker hands the memory it freed back to the system at the end of each task.

    Spark reuses Python workers; without this each keeps the peak of the hungriest task it ever ran.
    """

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            trim_memory()

    return whole
