"""Sessions, table access and the one way this library cuts lineage."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Session settings every entry point of this library expects.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

_staged: dict[str, SparkSession] = {}


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g", **conf: str) -> SparkSession:
    """A local session for tests and benches."""
    b = SparkSession.builder.master(f"local[{cores}]").appName("rodado")
    settings = DEFAULTS | {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.driver.memory": memory,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    } | conf
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One Parquet table (a file or a folder of files) below ``root``."""
    return spark.read.parquet(f"{root}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Where it is unset, a local master gets a temporary folder; a cluster gets an error,
    because a folder of one machine would lose data with that machine.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where:
        return where
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    where = "file://" + tempfile.mkdtemp(prefix="rodado-")
    spark.conf.set("spark.checkpoint.dir", where)
    return where


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Writes ``df`` once to the shared folder and reads it back.

    Unlike ``checkpoint()`` the plan runs once, the copy is columnar, and later readers prune
    columns. The copy outlives lost executors and is removed when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if not _staged:
        atexit.register(drop_staged)
    out = spark.read.schema(df.schema).parquet(path)
    _staged[path] = spark
    out._staged_path = path
    return out


def _remove(path: str) -> None:
    spark = _staged.pop(path)
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:
        pass


def drop(*frames: DataFrame) -> None:
    """Removes the copies that :func:`stage` returned as these frames; others are left alone.

    For loops that write a copy each round: no plan that is still to run may read what is dropped.
    """
    for df in frames:
        if getattr(df, "_staged_path", None) in _staged:
            _remove(df._staged_path)


def drop_staged() -> None:
    """Removes every table that :func:`stage` wrote. Errors are ignored: the session may be gone."""
    for path in list(_staged):
        _remove(path)
