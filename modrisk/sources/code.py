"""Source files from directory trees, file lists, archives and in-memory rows."""

from __future__ import annotations

import io
import math
import os
import re
import zipfile
import zlib
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from modrisk.session import checkpoint_dir
from modrisk.operators.code_metrics import LIST_FAMILIES, TREE_FAMILIES, supported_only
from modrisk.operators.languages import (
    LANGUAGES, SKIPPED_FRAGMENTS, SKIPPED_SEGMENTS, in_hidden_directory, is_skipped, only_sources, source_rows,
)

# Stores whose files are read in parts.
RANGED_SCHEMES = {"file", "hdfs", "s3", "s3a", "gs"}
MEMBER_BYTES = 8_000_000
TASK_BYTES, TASK_FILES, DIRECTORIES = 64_000_000, 5_000, 64  # dealt to one task
REPLACEMENT = "�"


def decoded(content: Column, on_invalid: str = "drop") -> Column:
    """Bytes as text; invalid bytes are dropped or replaced, never an error."""
    text = F.make_valid_utf8(content.cast("string"))
    return F.replace(text, F.lit(REPLACEMENT), F.lit("")) if on_invalid == "drop" else text


def _binary(spark: SparkSession, paths: list[str], pattern: str | None, recursive: bool) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(paths)


def _plain(path: Column) -> Column:
    """Path without its scheme, in one spelling."""
    return F.regexp_replace(path, r"\A[A-Za-z][A-Za-z0-9+.-]*:/*", "/")


def _with_empty(files: DataFrame) -> DataFrame:
    """(path, content) rows plus the zero-byte files, which Spark's reader leaves out: the listed names without a row.

    Only for stores that tasks cannot list themselves; the names are those of the listing Spark holds on the driver.
    """
    found = files.select(_plain(F.col("path")).alias("path"), "content")
    names = [(unquote(name),) for name in files.inputFiles()]
    listed = files.sparkSession.createDataFrame(names, "path string").select(_plain(F.col("path")).alias("path"))
    empty = listed.join(found.select("path"), "path", "left_anti")
    return found.unionByName(empty.withColumn("content", F.lit(b"")))


def _children(batches):
    """(path, size, folder) of what stands in the given directories; links to directories are not followed."""
    from pyarrow import fs

    for batch in batches:
        for directory in batch["path"]:
            system, inner = _system(directory)
            head = directory.rstrip("/")
            rows = []
            for info in system.get_file_info(fs.FileSelector(inner)):
                folder = info.type == fs.FileType.Directory
                if folder and isinstance(system, fs.LocalFileSystem) and os.path.islink(info.path):
                    continue
                if folder or info.type == fs.FileType.File:
                    rows.append((f"{head}/{info.base_name}", None if folder else info.size, folder))
            for start in range(0, len(rows), 10_000):
                yield pd.DataFrame(rows[start : start + 10_000], columns=["path", "size", "folder"])


def listed_tree(spark: SparkSession, root: str, directories: int = DIRECTORIES) -> DataFrame:
    """(path, size) of the files below a directory, as a DataFrame.

    Directories are listed in tasks, level by level, some ``directories`` a task; each level is checkpointed, so a lost
    executor costs its own directories. Library and hidden directories are not entered. Names never pass the driver.
    """
    checkpoint_dir(spark)
    level, wide, files = spark.createDataFrame([(root,)], "path string"), 1, None
    while wide:
        dealt = level.repartition(math.ceil(wide / directories), "path")
        found = dealt.mapInPandas(_children, "path string, size long, folder boolean").checkpoint()
        here = found.filter("NOT folder").select("path", "size")
        files = here if files is None else files.unionByName(here)
        below = F.concat(_relative(F.col("path"), root), F.lit("/"))
        level = found.filter(F.col("folder") & ~is_skipped(F.concat(F.lit("./"), below)) & ~in_hidden_directory(below)).select("path")
        wide = level.count()
    return files


def _contents(batches):
    """(path, content) of the given files; what is sent at once holds some megabytes or one file."""
    rows, held = [], 0
    for batch in batches:
        for path in batch["path"]:
            system, inner = _system(path)
            with system.open_input_stream(inner, compression=None) as file:
                content = file.read()
            if rows and held + len(content) > MEMBER_BYTES:
                yield pd.DataFrame(rows, columns=["path", "content"])
                rows, held = [], 0
            rows.append((path, content))
            held += len(content)
    if rows:
        yield pd.DataFrame(rows, columns=["path", "content"])


def _read(files: DataFrame, task_bytes: int = TASK_BYTES, task_files: int = TASK_FILES) -> DataFrame:
    """(path, content) of listed (path, size) files, zero-byte ones included; dealt by bytes and by number."""
    n, size = files.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    tasks = max(1, math.ceil(size / task_bytes), math.ceil(n / task_files))
    rows = files.select("path").repartition(tasks, "path").mapInPandas(_contents, "path string, content binary")
    return rows.select(_plain(F.col("path")).alias("path"), "content")


def _listed_in_tasks(path: str) -> bool:
    """Whether tasks can list and read this path themselves; name patterns are left to Spark's reader."""
    return in_parts(path) and not any(c in path for c in "*?[{")


def _relative(path: Column, root: str) -> Column:
    """Path below the root; whole path when it lies elsewhere."""
    plain = _plain(path)
    base = "/" + root.split(":", 1)[-1].strip("/") + "/"
    return F.when(plain.startswith(base), F.substring(plain, len(base) + 1, 1 << 30)).otherwise(plain)


def read_tree(
    spark: SparkSession, root: str, on_invalid: str = "drop", keep_empty: bool = True, in_tasks: bool = True
) -> DataFrame:
    """Supported source files below a directory, without library and hidden directories.

    Listing and reading run in tasks, and files are chosen by name before any content is read; the path rules apply to
    the part below ``root``. ``keep_empty=False`` leaves out zero-byte files. Tasks reach the store through Arrow; with
    ``in_tasks=False``, and in stores that only Spark reaches, Spark's reader lists on the driver, and leaves out names
    that begin with an underscore or a dot.
    """
    extensions = tuple(e for group in TREE_FAMILIES.values() for e in group)
    if in_tasks and _listed_in_tasks(root):
        found = listed_tree(spark, root)
        chosen = F.lit(False)
        for e in extensions:
            chosen = chosen | F.col("path").endswith(e)
        files = _read(found.filter(chosen) if keep_empty else found.filter(chosen & (F.col("size") > 0)))
    else:
        files = _binary(spark, [root], "*{" + ",".join(extensions) + "}", True).select("path", "content")
        files = _with_empty(files) if keep_empty else files
    shown = files.withColumn("path", _relative(F.col("path"), root))
    kept = shown.filter(~is_skipped(F.concat(F.lit("./"), F.col("path"))) & ~in_hidden_directory(F.col("path")))
    text = decoded(F.col("content"), on_invalid)
    return supported_only(source_rows(kept.select("path", text.alias("content"))))


def read_files(spark: SparkSession, paths: list[str], on_invalid: str = "drop", in_tasks: bool = True) -> DataFrame:
    """The given files, as far as their extension has metric rules (also .jsx); a file given twice counts once.

    ``in_tasks`` is that of :func:`read_tree`.
    """
    if in_tasks and all(map(_listed_in_tasks, paths)):
        given = spark.createDataFrame([(p,) for p in dict.fromkeys(paths)], "path string")
        files = _read(supported_only(source_rows(given.withColumn("content", F.lit(""))), LIST_FAMILIES).select("path", F.lit(0).alias("size")))
    else:
        files = _with_empty(_binary(spark, paths, None, False).select("path", "content"))
    text = files.select("path", decoded(F.col("content"), on_invalid).alias("content"))
    return supported_only(source_rows(text), LIST_FAMILIES)


def _wanted(name: str) -> bool:
    parts = name.replace("\\", "/").split("/")
    base = name.split("/")[-1]
    return (
        bool(base)
        and not base.startswith(".")
        and base.lower().endswith(tuple(LANGUAGES))
        and not any(p in SKIPPED_SEGMENTS or any(f in p for f in SKIPPED_FRAGMENTS) for p in parts)
    )


class _Parts(io.RawIOBase):
    """An Arrow file as Python's own; places before its start are an OSError, as Python's readers expect."""

    def __init__(self, file):
        self.file, self.end = file, file.size()

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.file.tell()

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        at = offset + (0, self.file.tell(), self.end)[whence]
        if at < 0:
            raise OSError(f"place {at} of a file")
        return self.file.seek(at)

    def readinto(self, room) -> int:
        data = self.file.read(len(room))
        room[: len(data)] = data
        return len(data)

    def close(self) -> None:
        self.file.close()
        super().close()


def _system(path: str):
    """Arrow's file system of a path, and the path in it."""
    from pyarrow import fs

    if path.startswith("file:") or ":" not in path.split("/", 1)[0]:
        return fs.LocalFileSystem(), os.path.abspath(re.sub(r"\Afile:/*", "/", path))
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def _opened(path: str) -> io.BufferedReader:
    """A file that can be read in parts, wherever an Arrow file system reaches."""
    system, inner = _system(path)
    return io.BufferedReader(_Parts(system.open_input_file(inner)), 1 << 16)


def in_parts(path: str) -> bool:
    """Whether files of this scheme are read in parts; others are read whole by Spark."""
    scheme = path.split(":", 1)[0].lower() if ":" in path else "file"
    return scheme in RANGED_SCHEMES


def _listed(batches):
    """(archive, path, at, packed, method) of the wanted members, from the directory at an archive's end."""
    for batch in batches:
        for archive in batch["path"]:
            with _opened(archive) as file, zipfile.ZipFile(file) as opened:
                rows = [(archive, m.filename, m.header_offset, m.compress_size, m.compress_type) for m in opened.infolist() if _wanted(m.filename)]
            for start in range(0, len(rows), 10_000):
                yield pd.DataFrame(rows[start : start + 10_000], columns=["archive", "path", "at", "packed", "method"])


def _unpacked(batches):
    """(archive, path, content) of listed members; each is read on its own."""
    for batch in batches:
        for archive, members in batch.groupby("archive", sort=False):
            with _opened(archive) as file:
                for m in members.sort_values("at").itertuples():
                    file.seek(m.at)
                    header = file.read(30)
                    name, extra = int.from_bytes(header[26:28], "little"), int.from_bytes(header[28:30], "little")
                    file.seek(m.at + 30 + name + extra)
                    data = file.read(m.packed)
                    if m.method == zipfile.ZIP_DEFLATED:
                        data = zlib.decompress(data, -zlib.MAX_WBITS)
                    elif m.method != zipfile.ZIP_STORED:
                        with zipfile.ZipFile(file) as opened:
                            data = opened.read(m.path)
                    yield pd.DataFrame({"archive": [archive], "path": [m.path], "content": [data.decode("utf-8", errors="replace")]})


def _whole(batches):
    for batch in batches:
        for archive, content in zip(batch["path"], batch["content"]):
            with zipfile.ZipFile(io.BytesIO(content)) as opened:
                for name in filter(_wanted, opened.namelist()):
                    text = opened.read(name).decode("utf-8", errors="replace")
                    yield pd.DataFrame({"archive": [archive], "path": [name], "content": [text]})


def read_archives(spark: SparkSession, paths: list[str] | str, member_bytes: int = MEMBER_BYTES) -> DataFrame:
    """Source files inside ZIP archives, one row each, with invalid bytes replaced.

    An archive's directory is read by itself, and its members are dealt to tasks by some ``member_bytes`` packed bytes each,
    so neither a row nor a task holds an archive, and archives may be larger than a row can be. That takes a store that
    both Spark and Arrow reach (RANGED_SCHEMES); elsewhere an archive is one row, of 2 GB at most, and one task.
    """
    whole = _binary(spark, [paths] if isinstance(paths, str) else paths, None, True)
    found = [paths] if isinstance(paths, str) else paths
    if not all(in_parts(p) for p in found):
        rows = whole.select("path", "content").mapInPandas(_whole, "archive string, path string, content string")
        return only_sources(source_rows(rows))
    checkpoint_dir(spark)
    members = whole.select("path").mapInPandas(_listed, "archive string, path string, at long, packed long, method int").checkpoint()
    # A given number of tasks: rows are names here, and their size says nothing of the work. Members that stand together
    # stay together.
    tasks = math.ceil((members.agg(F.sum("packed")).first()[0] or 1) / member_bytes)
    part = F.floor(F.col("at") / F.lit(member_bytes))
    dealt = members.withColumn("part", part).repartition(max(1, tasks), "archive", "part").drop("part")
    return only_sources(source_rows(dealt.mapInPandas(_unpacked, "archive string, path string, content string")))


def from_rows(rows: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """In-memory (name, content) rows as source-file rows."""
    return source_rows(rows, path, content)
