"""Tables replaced as a whole (S3, S5): readers see the old table or the new one.

A table is a folder of versions and a pointer file naming the current one.  A write
fills a version folder of its own and switches the pointer last, by one rename that
replaces it; until then, and for ever if the write fails, readers get the version
before.  The version before the current one is kept for jobs still reading it; older
ones, and what failed writes left, are deleted by the next replacement.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

POINTER = "_CURRENT"


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def current_version(spark: SparkSession, path: str) -> list[str]:
    """Names of the current version and the one before (as far as they exist)."""
    fs, pointer = _fs(spark, f"{path}/{POINTER}")
    if not fs.exists(pointer):
        return []
    stream = fs.open(pointer)
    try:
        return stream.readUTF().split()
    finally:
        stream.close()


def replace_table(df: DataFrame, path: str) -> DataFrame:
    """Replace the table at ``path`` by ``df`` (which may read it); returns the new one."""
    spark, path = df.sparkSession, path.rstrip("/")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    before, version = current_version(spark, path), f"v-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(f"{path}/{version}")
    keep = [version, *before[:1]]
    fs, draft = _fs(spark, f"{path}/_draft-{version}")
    out = fs.create(draft)
    out.writeUTF(" ".join(keep))
    out.close()
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), conf).rename(
        draft, jvm.org.apache.hadoop.fs.Path(f"{path}/{POINTER}"), overwrite)
    for entry in fs.listStatus(_fs(spark, path)[1]):
        name = entry.getPath().getName()
        if name not in (POINTER, f".{POINTER}.crc") and name not in keep:
            fs.delete(entry.getPath(), True)
    return read_current(spark, path)


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The current version of the table at ``path``."""
    versions = current_version(spark, path.rstrip("/"))
    if not versions:
        raise FileNotFoundError(f"no table at {path}")
    return spark.read.parquet(f"{path.rstrip('/')}/{versions[0]}")
