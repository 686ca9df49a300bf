"""Small text files that are there whole or not at all: pointers, journals, ledgers' heads."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import SparkSession

from basketry.scratch import folder_and_files


def put(spark: SparkSession, path: str, text: str) -> None:
    """Create a file. It gets its name only once it is complete; one that exists raises FileExistsError."""
    target, files = folder_and_files(spark, path)
    draft, _ = folder_and_files(spark, f"{target.getParent().toString()}/_{uuid.uuid4().hex}")
    files.mkdirs(target.getParent())
    out = files.create(draft, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        files.getUri(), spark._jsparkSession.sessionState().newHadoopConf()
    )
    plain = gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(files.makeQualified(draft), files.makeQualified(target), plain)
    except Exception as failed:
        files.delete(draft, False)
        if files.exists(target):
            raise FileExistsError(path) from failed
        raise


def get(spark: SparkSession, path: str) -> str | None:
    """The text of a file; None if there is none."""
    target, files = folder_and_files(spark, path)
    if not files.exists(target):
        return None
    stream = files.open(target)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, without hidden ones; none if it does not exist."""
    path, files = folder_and_files(spark, folder)
    if not files.exists(path):
        return []
    listed = sorted(status.getPath().getName() for status in files.listStatus(path))
    return [n for n in listed if not n.startswith(".") and ("=" in n or not n.startswith("_"))]


def fingerprint(spark: SparkSession, folder: str) -> str:
    """A digest of the names, lengths and times of all files below a folder: another one once any was replaced."""
    path, files = folder_and_files(spark, folder)
    if not files.exists(path):
        return ""
    found, listed = [], files.listFiles(path, True)
    while listed.hasNext():
        status = listed.next()
        found.append(f"{status.getPath().toString()} {status.getLen()} {status.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()
