"""Versions of a stored set of tables: one small JSON manifest per version.

A manifest says which folders make up the tables now.  Data go to fresh folders first and
the manifest is created last, exclusively, so of two loads that saw the same version one
fails; readers take the newest manifest that is complete, so a load that dies leaves the
version before as it was.  A manifest holds pointers only, never data.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid

from pyspark.sql import SparkSession

FOLDER = "_manifests"


class Conflict(RuntimeError):
    """Another load has committed the version that this one was to become."""


def join(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), *parts])


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and the path as its own type."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    fs.delete(p, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none where it is missing."""
    fs, p = file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def numbers(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the manifests, complete or not."""
    return [int(n[:-5]) for n in list_names(spark, join(root, FOLDER)) if re.fullmatch(r"\d{10}\.json", n)]


def _read(spark: SparkSession, root: str, number: int) -> dict | None:
    fs, p = file_system(spark, join(root, FOLDER, f"{number:010d}.json"))
    stream = fs.open(p)
    try:
        content = json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    except ValueError:  # its writer died
        return None
    finally:
        stream.close()
    return content


def newest(spark: SparkSession, root: str) -> tuple[int, dict]:
    """Number and content of the newest complete manifest; ``(0, {})`` where there is none."""
    for number in reversed(numbers(spark, root)):
        content = _read(spark, root, number)
        if content is not None:
            return number, content
    return 0, {}


def commit(spark: SparkSession, root: str, content: dict, after: int) -> int:
    """Make ``content`` the version that follows ``after`` (as ``newest`` gave it)."""
    there = numbers(spark, root)
    if any(n > after and _read(spark, root, n) is not None for n in there):
        raise Conflict(f"{root}: version {after} is no longer the newest")
    number = max([after, *there]) + 1
    fs, p = file_system(spark, join(root, FOLDER, f"{number:010d}.json"))
    try:
        stream = fs.create(p, False)  # fails where it exists
    except Exception as exc:
        raise Conflict(f"{root}: version {number} is being written by another load") from exc
    try:
        stream.write(bytearray(json.dumps(content, sort_keys=True).encode()))
    finally:
        stream.close()
    return number


def fingerprint(spark: SparkSession, *paths: str) -> str:
    """A digest of the names, lengths and modification times of all files at ``paths``: another
    one whenever a file comes, goes or is written again."""
    seen = hashlib.sha256()
    for path in paths:
        fs, p = file_system(spark, path)
        files = fs.listFiles(p, True)
        found = []
        while files.hasNext():
            f = files.next()
            found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
        seen.update(json.dumps(sorted(found)).encode())
    return seen.hexdigest()


def fresh_folder(kind: str) -> str:
    """A name under the root that no other load uses."""
    return f"{kind}/v-{uuid.uuid4().hex[:16]}"


def expire(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Forget all manifests but the ``keep`` newest complete ones and delete the folders of data that
    none of these names, those of loads that died among them.  Not while a load is running."""
    complete = [n for n in numbers(spark, root) if _read(spark, root, n) is not None]
    kept = complete[-keep:]
    if not kept:
        return []
    named = json.dumps([_read(spark, root, n) for n in kept])
    gone = [join(root, FOLDER, f"{n:010d}.json") for n in numbers(spark, root) if n not in kept]
    for kind in list_names(spark, root):
        if kind != FOLDER:
            gone += [join(root, kind, v) for v in list_names(spark, join(root, kind))
                     if v.startswith("v-") and f"{kind}/{v}" not in named]
    for path in gone:
        delete(spark, path)
    return gone
