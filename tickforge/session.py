"""Session settings the results depend on, and shared-folder access."""

import os
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Cluster sizing (partitions, memory) is left to spark-submit; see
# conf/spark-cluster.conf. These settings change results or safety.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def object_store_conf(endpoint=None, access_key=None, secret_key=None):
    """``s3a://`` settings; values left out come from the standard AWS variables."""
    endpoint = endpoint or os.getenv("AWS_ENDPOINT_URL")
    access_key = access_key or os.getenv("AWS_ACCESS_KEY_ID")
    secret_key = secret_key or os.getenv("AWS_SECRET_ACCESS_KEY")
    conf = {"spark.hadoop.fs.s3a.path.style.access": "true"}
    if endpoint:
        conf["spark.hadoop.fs.s3a.endpoint"] = endpoint
    if access_key and secret_key:
        conf["spark.hadoop.fs.s3a.access.key"] = access_key
        conf["spark.hadoop.fs.s3a.secret.key"] = secret_key
    return conf


def build_session(app_name, extra=None) -> SparkSession:
    """Session for the jobs. The master and the sizes come from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**BASE_CONF, **object_store_conf(), **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def require_utc(spark: SparkSession) -> None:
    """Hour, date and bar boundaries are UTC; any other session zone shifts them."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"session time zone must be UTC, found {zone!r}")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the session names it.

    Only a local master, where driver and executors share one disk, may fall back
    to a temporary folder.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tickforge-"))
    return context.getCheckpointDir().rstrip("/")


def run_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the shared folder, unique to this run.

    All of them lie in one folder of the session, which goes when its driver ends. What a
    killed driver leaves behind carries the application's id and is for a clean-up by age.
    """
    context = spark.sparkContext
    home = f"{shared_folder(spark)}/tickforge-{context.applicationId}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(home)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    return f"{home}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def session_conf(spark: SparkSession, settings: dict):
    """Session settings for the length of a block."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Write once, read back columnar: cuts lineage and gives later passes pruning."""
    return _stage_at(df, run_folder(df.sparkSession, purpose))


def _stage_at(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staged(df: DataFrame, purpose: str):
    """``stage`` for the length of a block; the files are deleted at its end."""
    spark = df.sparkSession
    path = run_folder(spark, purpose)
    try:
        yield _stage_at(df, path)
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
