"""Session settings, table access, shared intermediate tables and size-checked broadcasts.

Intermediate results of iterative operators are written as Parquet into the folder that the cluster
names in ``spark.checkpoint.dir`` (shared by all executors, so a lost executor costs nothing). Where that
setting is absent a temporary folder of this machine is used, but only if all executors are on it.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and measured bytes up to which ``join_bounded`` broadcasts its right side.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 8 << 20
#: Rows of one key from which ``join_unique`` takes it out of the shuffle, and most keys it takes out.
HOT_ROWS = 1_000_000
HOT_KEYS = 1_000

_LOCAL_DIR: str | None = None
_ROOTS: list[str] = []


def session(app: str = "folium", **conf: str) -> SparkSession:
    """A local session with the settings the engine expects; on a cluster use the given session instead."""
    builder = SparkSession.builder.appName(app)
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    return builder.config(map=base | conf).getOrCreate()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the Parquet tables of a data folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables: ``spark.checkpoint.dir``, or, in local mode only, a temporary one where it is unset."""
    global _LOCAL_DIR
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _LOCAL_DIR is None:
        _LOCAL_DIR = tempfile.mkdtemp(prefix="folium-")
        atexit.register(shutil.rmtree, _LOCAL_DIR, True)
    return _LOCAL_DIR


class Stage:
    """Written intermediate tables of one operator run; ``drop`` frees those that are no longer read."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"
        self._n = 0
        _ROOTS.append(self.root)

    def put(self, df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
        """Write ``df`` and return it as read back, which cuts its lineage."""
        self._n += 1
        path = f"{self.root}/{self._n:03d}"
        writer = df.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._folium_path = path  # type: ignore[attr-defined]
        return out

    def drop(self, df: DataFrame | None) -> None:
        """Delete the table behind ``df``, which must not be read again."""
        path = getattr(df, "_folium_path", None)
        if path:
            _delete(self.spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def release(spark: SparkSession) -> None:
    """Delete all intermediate tables this process wrote, once no result that reads them is needed any more."""
    while _ROOTS:
        _delete(spark, _ROOTS.pop())


def is_empty(df: DataFrame) -> bool:
    return not df.take(1)


def measured(df: DataFrame) -> tuple[int, int]:
    """Rows of a written table, and bytes of its values spelled out."""
    text = F.coalesce(F.octet_length(F.to_json(F.struct(*df.columns))), F.lit(0))
    r = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(text), F.lit(0)).alias("b")).first()
    return int(r["n"]), int(r["b"])


def join_bounded(left: DataFrame, right: DataFrame, on: list[str], how: str = "left", max_rows: int = BROADCAST_ROWS, salt: int = 0) -> DataFrame:
    """Join with ``right`` broadcast only if its counted rows and measured bytes are small, else shuffled.

    The right side is written first unless it is a written table, so that it is computed once for the measure and the join. Beyond the bounds both sides are hashed on
    ``on``; with ``salt`` > 1 the right side is replicated that often and the left side spread over
    the copies, so one hot key is shared by that many tasks. ``right`` must be unique on ``on``.
    """
    if getattr(right, "_folium_path", None) is None:
        right = Stage(left.sparkSession, "side").put(right)
    rows, size = measured(right)
    if rows <= max_rows and size <= BROADCAST_BYTES:
        return left.join(F.broadcast(right), on, how)
    if salt > 1:
        spread = left.withColumn("_salt", F.floor(F.rand(7) * salt).cast("int"))
        copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
        return spread.join(copies, [*on, "_salt"], how).drop("_salt")
    return left.join(right.hint("shuffle_merge"), on, how)


def join_unique(left: DataFrame, right: DataFrame, on: str, how: str = "inner", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Join (inner or left) with ``right``, which is unique on ``on``, so that no hot key of ``left`` falls to one task.

    ``left`` should be a written table. Keys with more than ``hot_rows`` rows, and more than a ``HOT_KEYS``-th of all,
    are taken out: there are at most ``HOT_KEYS`` of them, so their rows of ``right`` are broadcast, and all others are
    shuffled. Null keys match nothing.
    """
    total = left.count()
    if total <= hot_rows:
        return left.join(right, on, how)
    most = max(hot_rows, total // HOT_KEYS)
    hot = left.where(F.col(on).isNotNull()).groupBy(on).agg(F.count("*").alias("_n")).where(F.col("_n") > most).select(on)
    hot = Stage(left.sparkSession, "hot").put(hot)
    if is_empty(hot):
        return left.join(right, on, how)
    few = F.broadcast(hot)
    spread = left.join(few, on, "left_semi").join(F.broadcast(right.join(few, on, "left_semi")), on, how)
    return left.join(few, on, "left_anti").join(right, on, how).unionByName(spread)
