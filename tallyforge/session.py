"""Session helpers: tables, reliable checkpoints and size-checked broadcasts."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: what the cluster names in ``spark.checkpoint.dir``.

    A cluster that names none is refused, as a folder of one machine would lose or mix up data
    there; only a session of one machine may set its own (``local_session`` does).
    """
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        where = spark.conf.get("spark.checkpoint.dir", None)
        if not where:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all executors share")
            where = tempfile.mkdtemp(prefix="ckpt")
            atexit.register(shutil.rmtree, where, True)
        sc.setCheckpointDir(where)
    return sc._jsc.sc().getCheckpointDir().get()


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and cut its lineage."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_within(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint a broadcast only if ``df`` is measured to hold at most ``max_rows`` rows.

    ``df`` should be checkpointed, so that counting it is cheap. Beyond the bound it
    is hinted to a shuffled join, as Spark's own estimate may take it for small.
    """
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df.hint("merge")


def local_session(cores: str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A single-machine session with the settings the queries assume."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()


def spread(df: DataFrame) -> DataFrame:
    """Repartition a scan that has fewer splits than the cluster has cores.

    A table in a few unsplittable row groups would keep most cores idle through heavy work;
    large tables have more splits than cores and are left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df._jdf.queryExecution().toRdd().getNumPartitions() < cores:
        return df.repartition(cores)
    return df


def dealt(df: DataFrame) -> DataFrame:
    """Deal out rows that are few and dear each, so that adaptive execution leaves them no single task."""
    spark = df.sparkSession
    return df.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def stored(df: DataFrame, plain: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once as a compressed table beside the checkpoints and read it back.

    Cuts the lineage as ``checkpointed`` does, in a fraction of the disk, for wide rows that are
    read several times. The session's tables are removed when its driver ends. ``plain`` are
    columns of Parquet that hardly repeat a value, for which no dictionary is tried.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    if not _TABLES:
        atexit.register(drop_stored)
    _TABLES.append((spark, path))
    df.write.options(**{f"parquet.enable.dictionary#{c}": "false" for c in plain}).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_TABLES: list[tuple[SparkSession, str]] = []


def drop_stored() -> None:
    """Remove the tables of ``stored``; frames that still read them fail from then on."""
    while _TABLES:
        spark, path = _TABLES.pop()
        try:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        except Exception:  # the session has ended; a folder of one machine can still be removed
            shutil.rmtree(path.removeprefix("file:"), ignore_errors=True)
