"""Session defaults and the shared folder used to cut long lineages."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, types as T


_TABLES: list[str] = []   # paths stored by this process; "" once deleted


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "vitrine", **extra: str) -> SparkSession:
    """A session for tests and the local bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Where neither that setting
    nor a checkpoint folder exists, a local session gets a temporary folder; on a
    cluster that is an error, as executors would not see each other's files.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if current is None:
        if named is None and not re.match(r"local(\[|$)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="vitrine-"))
        current = context.getCheckpointDir()
    return named or current


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later stages restart from files, not from the plan."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def store_table(df: DataFrame, label: str = "table", schema: T.StructType | None = None) -> DataFrame:
    """``df`` as columnar files in the shared folder.

    The planner knows the bytes of a stored table and broadcasts it only below
    the session's threshold; above, joins shuffle and adaptive execution splits
    hot keys. ``schema`` names the types to read back, where they are not those written.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    _TABLES.append(path)
    return df.sparkSession.read.schema(schema or df.schema).parquet(path)


def stored_so_far() -> int:
    """How many tables this process has stored; a mark for ``stored_since``."""
    return len(_TABLES)


def stored_since(mark: int) -> list[str]:
    return [path for path in _TABLES[mark:] if path]


def drop_tables(df: DataFrame, paths: list[str]) -> None:
    """Delete stored tables that nothing needs any more; those that ``df`` still reads stay."""
    spark = df.sparkSession
    read = "\n".join(df.inputFiles()) if paths else ""
    for path in paths:
        if path.rsplit("/", 1)[-1] in read:
            continue
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
        _TABLES[_TABLES.index(path)] = ""


def drop_replaced(old: DataFrame, new: DataFrame) -> None:
    """Delete the stored table that ``old`` reads, once ``new`` is stored and reads it no more."""
    folders = {file.rsplit("/", 2)[-2] for file in old.inputFiles()}
    drop_tables(new, [path for path in stored_since(0) if path.rsplit("/", 1)[-1] in folders])
