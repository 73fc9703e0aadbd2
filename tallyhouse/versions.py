"""Groups of tables that are replaced together, by one job at a time.

A group's tables are written into a folder of their own. Small files, numbered from 1, each name
one folder; the highest number is in use. A job takes the number after the highest one when it
begins, and puts its folder to use by creating the file of that number, which succeeds only where
there is none yet: of two jobs that ran at the same time the first to end wins, and the other
fails without a trace. A failure before that step leaves the tables in use whole and
consistent. The folder used before is kept for readers that have it open; older ones are
removed, as is what crashed jobs have left of numbers that are taken.

Creating a file only where there is none is one step on each kind of storage by its own means: a
hard link on a local disk, a rename on HDFS, a conditional write on object stores. Whoever made
the file is then read from it, so that a lost answer is no lost version.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager, suppress
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from tallyhouse.operators.scratch import release


class VersionConflict(RuntimeError):
    """Another job has replaced the tables since this one began."""


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _read(spark: SparkSession, path: str) -> str:
    stream = _files(spark, path).open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _names(spark: SparkSession, root: str) -> list[str]:
    files = _files(spark, root)
    if not files.exists(_path(spark, root)):
        return []
    return [entry.getPath().getName() for entry in files.listStatus(_path(spark, root))]


def _pointer(root: str, group: str, number: int) -> str:
    return f"{root}/{group}.{number:010d}.version"


def _numbers(spark: SparkSession, root: str, group: str) -> list[int]:
    """Numbers of the versions there are, highest first."""
    named = re.compile(rf"{re.escape(group)}\.(\d+)\.version")
    return sorted((int(m[1]) for m in map(named.fullmatch, _names(spark, root)) if m), reverse=True)


def folders(spark: SparkSession, root: str, group: str) -> list[str]:
    """Names of the folder in use and of the one before it; empty before the first version."""
    return [_read(spark, _pointer(root, group, n)).strip() for n in _numbers(spark, root, group)[:2]]


def _write(spark: SparkSession, path: str, text: str, conditional: bool = False) -> None:
    if conditional:
        made = _files(spark, path).createFile(_path(spark, path)).overwrite(False)
        stream = made.opt("fs.option.create.conditional.overwrite", True).build()
    else:
        stream = _files(spark, path).create(_path(spark, path), False)
    stream.write(bytearray(text, "utf-8"))
    stream.close()


def _create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Whether the file at ``path`` is now the one with this text. A file that is there already
    stays as it is; the text must be nobody else's."""
    jvm, files = spark._jvm, _files(spark, path)
    scheme = files.getScheme()
    try:
        if scheme not in ("file", "hdfs", "viewfs"):
            _write(spark, path, text, conditional=True)
        else:
            folder, name = path.rsplit("/", 1)
            written = f"{folder}/.{name}-{uuid4().hex}"
            _write(spark, written, text)
            try:
                if scheme == "file":
                    link, target = (files.pathToFile(_path(spark, p)).toPath() for p in (path, written))
                    jvm.java.nio.file.Files.createLink(link, target)
                else:
                    qualified = files.makeQualified(_path(spark, path))
                    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                        qualified.toUri(), spark._jsc.hadoopConfiguration()
                    )
                    no_options = spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
                    context.rename(_path(spark, written), qualified, no_options)
            finally:
                files.delete(_path(spark, written), False)
    except Py4JJavaError:
        if not files.exists(_path(spark, path)):
            raise
    return _read(spark, path) == text


@contextmanager
def new_version(spark: SparkSession, root: str, group: str) -> Iterator[str]:
    """A folder to write the group's tables into, in use once the block ends without an
    error; after an error, or if another job was first, it is removed."""
    number = max(_numbers(spark, root, group), default=0) + 1
    name = f"{group}-{number:010d}-{uuid4().hex}"
    try:
        yield f"{root}/{name}"
        # Numbers that were passed by long ago are removed and could be taken again.
        won = _create_if_absent(spark, _pointer(root, group, number), name)
        if not won or _numbers(spark, root, group)[0] != number:
            if won:
                release(spark, _pointer(root, group, number))
            raise VersionConflict(f"{root}: another job has replaced the {group} tables since this one began")
    except BaseException:
        release(spark, f"{root}/{name}")
        raise
    _sweep(spark, root, group, number)


def _sweep(spark: SparkSession, root: str, group: str, number: int) -> None:
    """Remove versions before the last one, and folders of jobs that did not come to an end.
    No job can put a number to use that is taken, so what it wrote under it is of no use."""
    named = re.compile(rf"{re.escape(group)}-(\d+)-[0-9a-f]+")
    kept = set(folders(spark, root, group))
    for old in _numbers(spark, root, group):
        if old < number - 1:
            release(spark, _pointer(root, group, old))
    for name in _names(spark, root):
        found = named.fullmatch(name)
        if found and int(found[1]) < number and name not in kept:
            with suppress(Py4JJavaError):  # another job may be removing it
                release(spark, f"{root}/{name}")
