"""Single files on the file system that Spark uses for a path: small texts replaced whole, digests of files of any size."""

from __future__ import annotations

import hashlib
import uuid
from urllib.parse import quote

from pyarrow import fs
from pyspark.sql import SparkSession

PIECE = 8 << 20


def qualified(spark: SparkSession, path: str) -> tuple[object, object]:
    """The cluster's file system for a path, and the path in full: without a scheme it lies where Spark would look for it."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    system = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system, system.makeQualified(at)


def uri_of(text: str) -> str:
    """A full path, as Spark shows it, in the form of the library that reads files in tasks; a path may hold any character."""
    if text.startswith("file:/"):
        return "file:///" + quote(text.removeprefix("file:").lstrip("/"))
    scheme, rest = text.split("://", 1)
    return f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{quote(rest, safe='/:@')}"


def empty_files(spark: SparkSession, *paths: str) -> list[str]:
    """Full paths of the files without bytes in folders (not the folders in them) or under patterns; names that begin with a dot or an underscore are passed over, as Spark does."""
    found = []
    for path in paths:
        system, at = qualified(spark, path)
        for entry in system.globStatus(at) or []:
            inside = system.listStatus(entry.getPath()) if entry.isDirectory() else [entry]
            found += [e.getPath().toString() for e in inside if e.isFile() and e.getLen() == 0 and e.getPath().getName()[0] not in "._"]
    return found


def sha256_of(path: str) -> tuple[str, int]:
    """The digest and length of one file, read in pieces of a few megabytes."""
    system, at = fs.FileSystem.from_uri(uri_of(path))
    digest, size = hashlib.sha256(), 0
    with system.open_input_stream(at) as stream:
        while piece := stream.read(PIECE):
            digest.update(piece)
            size += len(piece)
    return digest.hexdigest(), size


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None where there is no such file."""
    system, at = qualified(spark, path)
    if not system.exists(at):
        return None
    stream = system.open(at)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, written beside its place and renamed over what is there, so that readers see the old text or the new one."""
    system, at = qualified(spark, path)
    draft = at.suffix(f".draft-{uuid.uuid4().hex}")
    stream = system.create(draft, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    kind = getattr(hadoop, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.valueOf("OVERWRITE")
    try:
        hadoop.FileContext.getFileContext(at.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(draft, at, how)
    except BaseException:
        system.delete(draft, False)
        raise
