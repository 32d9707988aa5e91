"""Numbered manifests: a folder's state is what its latest manifest says, so it changes in one step."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

FOLDER = "manifests"


def _files(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def written_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files under ``path``; 0 where there are none."""
    files, at = _files(spark, path)
    return files.getContentSummary(at).getLength() if files.exists(at) else 0


def remove(spark: SparkSession, path: str) -> None:
    files, at = _files(spark, path)
    files.delete(at, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in the folder ``path``, in order; none where it is absent."""
    files, at = _files(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(at)) if files.exists(at) else []


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    names = (n.partition(".") for n in children(spark, f"{folder}/{FOLDER}"))
    return sorted(int(stem) for stem, _, end in names if end == "json" and stem.isdigit())


def latest(spark: SparkSession, folder: str) -> dict | None:
    """Content of the latest manifest; None where nothing was published."""
    numbers = _numbers(spark, folder)
    if not numbers:
        return None
    files, at = _files(spark, f"{folder}/{FOLDER}/{numbers[-1]:012d}.json")
    stream = files.open(at)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def publish(spark: SparkSession, folder: str, content: dict, keep: int = 2) -> int:
    """Make ``content`` the state of ``folder``; one writer at a time. The last ``keep`` manifests stay.

    The manifest is written under another name and renamed, so a reader sees the old state or
    the new one, whenever the writer is stopped.
    """
    numbers = _numbers(spark, folder)
    number = numbers[-1] + 1 if numbers else 0
    files, draft = _files(spark, f"{folder}/{FOLDER}/.draft-{uuid.uuid4().hex}")
    stream = files.create(draft, False)
    stream.write(bytearray(json.dumps(content).encode()))
    stream.close()
    _, final = _files(spark, f"{folder}/{FOLDER}/{number:012d}.json")
    if files.exists(final) or not files.rename(draft, final):
        raise RuntimeError(f"another writer published number {number} of {folder}")
    for old in numbers[: len(numbers) + 1 - keep]:
        remove(spark, f"{folder}/{FOLDER}/{old:012d}.json")
    return number
