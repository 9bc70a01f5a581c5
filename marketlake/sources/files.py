"""The few file-system calls a job makes itself, through the file systems Spark is set up with."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession

from marketlake.functions.paths import DAY_FOLDER

#: Beside the day folders of a source; has a mark for each batch that is being written.
WRITING = "_writing"


def _open(spark: SparkSession, path: str):
    handle = spark._jvm.org.apache.hadoop.fs.Path(path)
    return handle.getFileSystem(spark._jsc.hadoopConfiguration()), handle


def exists(spark: SparkSession, path: str) -> bool:
    fs, handle = _open(spark, path)
    return fs.exists(handle)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below a path; one level, no recursion."""
    fs, handle = _open(spark, path)
    if not fs.exists(handle):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(handle) if s.isDirectory())


def _mark_of(target: str) -> str:
    """The mark of a batch stands beside its day folder, that of another folder beside itself."""
    parent, _, name = target.rstrip("/").rpartition("/")
    holder, _, day = parent.rpartition("/")
    if re.fullmatch(DAY_FOLDER, day):
        return f"{holder}/{WRITING}/{day}/{name}"
    return f"{parent}/{WRITING}/{name}"


def unfinished_folders(spark: SparkSession, roots: list[str]) -> list[str]:
    """Batches below the roots that carry the mark of a running or broken write.

    A root is the folder of a source, a day folder or a batch, so its marks are beside it or up to
    two folders above: a call or two per source, however many days and batches it has. A writer of
    this library leaves the mark from before its first file until its last one is published. Files
    put there by others carry none and are finished.
    """
    holders: set[str] = set()
    for root in roots:
        folder = root.rstrip("/")
        for _ in range(3):
            holders.add(folder)
            folder = folder.rpartition("/")[0]
    found = []
    for holder in sorted(filter(None, holders)):
        fs, handle = _open(spark, f"{holder}/{WRITING}")
        if not fs.exists(handle):
            continue
        base = fs.makeQualified(handle).toString()
        marks = fs.listFiles(handle, True)
        while marks.hasNext():
            inner = marks.next().getPath().toString()[len(base) :]
            found.append(base.removesuffix(f"/{WRITING}") + inner)
    return found


def is_unfinished(spark: SparkSession, target: str) -> bool:
    return exists(spark, _mark_of(target))


def first_files(spark: SparkSession, roots: list[str], suffix: str, limit: int) -> list[str]:
    """Up to ``limit`` files below the roots, without hidden ones."""
    found: list[str] = []
    for root in roots:
        fs, handle = _open(spark, root)
        if not fs.exists(handle):
            continue
        base = fs.makeQualified(handle).toString()
        listing = fs.listFiles(handle, True)
        while len(found) < limit and listing.hasNext():
            path = listing.next().getPath().toString()
            inner = path[len(base) :].split("/")
            if path.endswith(suffix) and not any(n.startswith(("_", ".")) for n in inner):
                found.append(path)
    return found


def mark_writing(spark: SparkSession, path: str) -> None:
    fs, handle = _open(spark, _mark_of(path))
    fs.create(handle, True).close()


def mark_finished(spark: SparkSession, path: str) -> None:
    fs, handle = _open(spark, _mark_of(path))
    fs.delete(handle, False)


def write_line(spark: SparkSession, path: str, line: str) -> None:
    """A small file of one line, whole or not there."""
    fs, handle = _open(spark, path)
    staged = spark._jvm.org.apache.hadoop.fs.Path(staging_path(path))
    out = fs.create(staged, True)
    try:
        out.write(bytearray(f"{line}\n".encode()))
    finally:
        out.close()
    if not fs.rename(staged, handle):
        raise OSError(f"cannot publish {path}")


def make_folder(spark: SparkSession, path: str) -> None:
    fs, handle = _open(spark, path)
    fs.mkdirs(handle)


def staging_path(path: str) -> str:
    """A sibling that scans skip, because its name starts with an underscore."""
    parent, _, name = path.rpartition("/")
    return f"{parent}/_staging-{uuid.uuid4().hex}-{name}"


def replace(spark: SparkSession, staged: str, target: str) -> None:
    """Put a finished folder in the place of an older one."""
    fs, target_handle = _open(spark, target)
    path = spark._jvm.org.apache.hadoop.fs.Path
    old = path(staging_path(target))
    had_old = fs.exists(target_handle)
    if not had_old:
        fs.mkdirs(target_handle.getParent())
    if had_old and not fs.rename(target_handle, old):
        raise OSError(f"cannot move {target} aside")
    if not fs.rename(path(staged), target_handle):
        if had_old:
            fs.rename(old, target_handle)
        raise OSError(f"cannot publish {target}")
    if had_old:
        fs.delete(old, True)


def discard(spark: SparkSession, staged: str) -> None:
    fs, handle = _open(spark, staged)
    fs.delete(handle, True)
