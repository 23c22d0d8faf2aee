"""Session settings every plan relies on, and the shared folder for checkpoints."""

from __future__ import annotations

import atexit
import hashlib
import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """Put the session into the state the operators assume (UTC, adaptive execution). Runtime settings only."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "true")
    ship(spark)
    return spark


def local_session(cores: str = "8", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the bench."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("weirstream")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``. Only on one machine (tests) may it be unset; a temporary folder is taken there."""
    where = _named_dir(spark)
    if not where:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        where = tempfile.mkdtemp(prefix="weirstream-checkpoint-")
        spark.sparkContext.setCheckpointDir(where)
    return where


def _named_dir(spark: SparkSession) -> str | None:
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        set_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
        where = set_dir.get() if set_dir.isDefined() else None
    return where


def ship(spark: SparkSession) -> None:
    """Let workers import this package, once per application: its source as one zip file, in the shared folder where one is named."""
    sc = spark.sparkContext
    if getattr(sc, "_weirstream_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    if os.path.isdir(root):
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w") as z:
            for folder, _, names in sorted(os.walk(root)):
                for name in sorted(names):
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        with open(full, "rb") as f:
                            z.writestr(zipfile.ZipInfo(os.path.join("weirstream", os.path.relpath(full, root))), f.read())
        data = packed.getvalue()
        where = _named_dir(spark) or tempfile.mkdtemp(prefix="weirstream-code-")
        # a name of its own for each application, so that no other one reads a half-written file
        path = f"{where.rstrip('/')}/weirstream-{hashlib.sha256(data).hexdigest()[:16]}-{uuid.uuid4().hex[:8]}.zip"
        jvm = spark._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
        out.write(bytearray(data))
        out.close()
        sc.addPyFile(path)
    sc._weirstream_shipped = True


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back: computed once, column-pruned on reuse.

    The files go when the application ends, or earlier by ``drop_staged``.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    keep_until_end(spark, path)
    return spark.read.schema(df.schema).parquet(path)


_kept: dict[str, SparkSession] = {}


def keep_until_end(spark: SparkSession, path: str) -> None:
    """Note a folder of intermediate files, to be deleted when the application ends."""
    if not _kept:
        atexit.register(drop_staged)
    _kept[path] = spark


def drop_staged() -> None:
    """Delete all intermediate files of this application."""
    for path, spark in list(_kept.items()):
        del _kept[path]
        try:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # noqa: BLE001 - the session may be gone already; files that stay do no harm
            return
