"""Written intermediates in the folder that driver and executors share: for one run, or kept for the next."""

from __future__ import annotations

import hashlib
import re
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Folders that this module makes: tag, 32 or 64 hexadecimal digits. Nothing else is ever cleared.
_NAME = re.compile(r"[\w.]+-([0-9a-f]{32}|[0-9a-f]{64})(-half-[0-9a-f]{32})?$")
DAY = 86400.0


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Only a session of a single process may do without it."""
    folder = spark.conf.get("spark.checkpoint.dir", "")
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file:///tmp/checkpoints"
    return folder.rstrip("/")


def _files(spark: SparkSession, path: str):
    """(Hadoop's file system of the path, the path)."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), target


def written(df: DataFrame, tag: str = "table") -> DataFrame:
    """df written once and read again: cuts the lineage of loops, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_path = path
    return out


def discard(df: DataFrame) -> None:
    """Deletes what written() wrote, once nothing reads it any more."""
    path = getattr(df, "_written_path", None)
    if path:
        fs, target = _files(df.sparkSession, path)
        fs.delete(target, True)


def content_key(df: DataFrame) -> str | None:
    """A hash of what df computes and of the files that it reads (path, length, time); null if it reads anything but files, runs Python
    (whose code a plan doesn't show), or isn't the same each time."""
    spark, plan = df.sparkSession, df._jdf.queryExecution().analyzed()
    leaves = plan.collectLeaves()
    if not plan.deterministic() or any(leaves.apply(i).getClass().getSimpleName() != "LogicalRelation" for i in range(leaves.size())):
        return None
    text = plan.canonicalized().toString()
    if re.search(r"Python|Pandas|Arrow|Cogroup|Scala|UDF", text):
        return None
    files = []
    for path in sorted(df.inputFiles()):
        fs, target = _files(spark, path)
        status = fs.getFileStatus(target)
        files.append((path, status.getLen(), status.getModificationTime()))
    return hashlib.sha256(repr((df.semanticHash(), text, df.schema.json(), files)).encode()).hexdigest()


def kept(df: DataFrame, tag: str, *parameters: object, inputs: list[DataFrame] | None = None, days: float = 7.0) -> DataFrame:
    """As written(), under a name made of the parameters and the inputs (df itself, if none are given): a later call, of any run,
    with the same inputs and parameters reads what the first has written. df must depend on nothing else.

    It is written beside its place and renamed, so a folder with this name is whole. After `days` it is made anew. Inputs that
    aren't files alone have no lasting name: then this is written()."""
    spark, keys = df.sparkSession, [content_key(d) for d in (inputs or [df])]
    if None in keys:
        return written(df, tag)
    path = f"{shared_folder(spark)}/{tag}-{hashlib.sha256(repr((keys, parameters)).encode()).hexdigest()}"
    fs, target = _files(spark, path)
    if fs.exists(target) and time.time() - fs.getFileStatus(target).getModificationTime() / 1000 > days * DAY:
        fs.delete(target, True)
    if not fs.exists(target):
        half = f"{path}-half-{uuid.uuid4().hex}"
        df.write.parquet(half)
        own = _files(spark, half)[1]
        # another run may have been first: its folder is as good
        if fs.exists(target) or not fs.rename(own, target):
            fs.delete(own, True)
    return spark.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession, older_than: float = DAY) -> int:
    """Deletes the intermediates of the shared folder that are older than so many seconds, and says how many. Jobs that may still read
    theirs must be younger."""
    fs, folder = _files(spark, shared_folder(spark))
    if not fs.exists(folder):
        return 0
    old = [s.getPath() for s in fs.listStatus(folder) if _NAME.match(s.getPath().getName()) and time.time() - s.getModificationTime() / 1000 > older_than]
    for path in old:
        fs.delete(path, True)
    return len(old)
