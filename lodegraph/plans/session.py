"""Session helpers: table loading, lineage cuts and parallelism, all driven by the session's own settings."""

from __future__ import annotations

import io
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give executors this package, once an application: a zip of its modules in the shared folder."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    _SHIPPED.add(app)
    root = Path(__file__).resolve().parent.parent
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"{root.name}/{f.relative_to(root)}")
    spark.sparkContext.addPyFile(write_bytes(spark, scratch(spark, root.name) + ".zip", buf.getvalue()))


def ship_here() -> None:
    """``ship`` for the active session, for operators that run Python on a caller's own rows."""
    spark = SparkSession.getActiveSession()
    if spark is not None:
        ship(spark)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder; a table is a Parquet file or a folder of them."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    Only where the setting is absent (local tests) is a folder of our own made and set.
    """
    jsc = spark.sparkContext._jsc.sc()
    if jsc.getCheckpointDir().isDefined():
        return jsc.getCheckpointDir().get()
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="lodegraph-")
    spark.sparkContext.setCheckpointDir(folder)
    return jsc.getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the result is written to the shared folder, so a lost executor loses nothing."""
    ship(df.sparkSession)
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch(spark: SparkSession, stem: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{stem}-{uuid.uuid4().hex}"


def write_bytes(spark: SparkSession, path: str, data: bytes) -> str:
    """Write a small driver-side artefact (a lexicon, weights) to a Hadoop path."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    try:
        for i in range(0, len(data), 1 << 20):
            out.write(bytearray(data[i : i + (1 << 20)]))
    finally:
        out.close()
    return path


#: Input below this size a core may be spread anew; beyond it a scan has partitions enough.
SPREAD_BYTES = 32 << 20


def shuffle_parts(spark: SparkSession) -> int:
    """Partitions of an explicit shuffle: as set for the session, a core each at least."""
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def spread(df: DataFrame) -> DataFrame:
    """Give CPU-heavy Python stages one partition a core where the scan yields fewer.

    Only inputs that the optimizer's statistics put below SPREAD_BYTES a core are looked at (finding out
    the number of partitions may run a plan's shuffles), so what this adds is bounded; larger ones pass
    through untouched.
    """
    ship(df.sparkSession)
    want = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size > want * SPREAD_BYTES or df.rdd.getNumPartitions() * 2 > want:
        return df
    return df.repartition(want)
