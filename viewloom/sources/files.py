"""Files as rows: listed, read and written by name on the executors.

Spark's own sources pass over files without bytes and its writers choose the names. Here a listing is a
table (path, size, modified_at) that the executors fill folder by folder, whole files are read where they
are worked on, and a row can be written as the file it names. Paths are URIs of a store that pyarrow
knows (``file:``, ``s3:``, ``gs:``, ``hdfs:``); a path without a scheme is local to a shared folder.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewloom.session import scratch_path

LISTED = "path string, is_folder boolean, size long, modified_at timestamp"
#: Files of one Arrow batch of a listing, bytes read before a batch is handed on, and bytes a task should read.
LISTED_TOGETHER = 10_000
READ_TOGETHER = 16 << 20
TASK_BYTES = 128 << 20


def _store(path: str) -> tuple[fs.FileSystem, str, str]:
    """The store of a path, the path in it, and what goes before a path to make it a URI again."""
    scheme = re.match(r"^([a-zA-Z][a-zA-Z0-9+.-]+):", path)
    if not scheme or scheme[1] == "file":
        return fs.LocalFileSystem(), "/" + re.sub(r"^file:/*|^/+", "", path), "file:"
    store, inside = fs.FileSystem.from_uri(path)
    return store, inside, path[: len(path) - len(inside)] if path.endswith(inside) else f"{scheme[1]}://"


def is_listable(path: str) -> bool:
    """Whether this module can reach the store; Spark reads some more."""
    try:
        _store(path)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, NotImplementedError, OSError):
        return False
    return True


def _list(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for folder in batch.column("path").to_pylist():
            store, inside, before = _store(folder)
            found = store.get_file_info(fs.FileSelector(inside, recursive=False, allow_not_found=True))
            # Names that Spark takes for its own are passed over, as its readers do.
            found = [i for i in found if not i.base_name.startswith(("_", "."))]
            for at in range(0, len(found), LISTED_TOGETHER):
                part = found[at : at + LISTED_TOGETHER]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([before + i.path for i in part], pa.string()),
                        pa.array([i.type == fs.FileType.Directory for i in part]),
                        pa.array([i.size for i in part], pa.int64()),
                        pa.array([None if i.mtime_ns is None else i.mtime_ns // 1000 for i in part], pa.timestamp("us", "UTC")),
                    ],
                    names=["path", "is_folder", "size", "modified_at"],
                )


def list_files(spark: SparkSession, *prefixes: str) -> DataFrame:
    """Rows (path, size, modified_at) of all files below the prefixes, also those without bytes.

    Each level of folders is listed by one stage, a folder by one task; what it found is written to the
    shared folder, and the next level starts from the folders in it. Prefixes that do not exist have no
    files; prefixes should not contain each other.
    """
    levels: list[DataFrame] = []
    frontier = spark.createDataFrame([(p.rstrip("/"),) for p in prefixes], "path string")
    tasks = spark.sparkContext.defaultParallelism
    while not levels or not frontier.isEmpty():
        folder = scratch_path(spark, "listing")
        frontier.repartition(tasks, "path").mapInArrow(_list, LISTED).write.parquet(folder)
        levels.append(spark.read.schema(LISTED).parquet(folder))
        frontier = levels[-1].filter("is_folder").select("path")
    found = levels[0]
    for level in levels[1:]:
        found = found.unionByName(level)
    return found.filter("NOT is_folder").drop("is_folder")


def _read(names: list[str]):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size, start = [], 0, 0
            for i, path in enumerate(batch.column("path").to_pylist()):
                store, inside, _ = _store(path)
                try:
                    with store.open_input_stream(inside, compression=None) as stream:
                        content = stream.read()
                except FileNotFoundError:  # went since it was listed
                    content = None
                held.append(content)
                size += len(content or b"")
                if size >= READ_TOGETHER or i + 1 == batch.num_rows:
                    part = batch.slice(start, len(held))
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(held, pa.binary())], names=names)
                    held, size, start = [], 0, i + 1

    return read


def with_content(files: DataFrame) -> DataFrame:
    """The files of a listing with their bytes in ``content``; null if the file is gone. They are dealt so
    that a task reads about ``TASK_BYTES``, as told by their sizes; a file is one row."""
    spark = files.sparkSession
    # One number: the sum of the sizes.
    total = files.agg(F.sum("size")).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // TASK_BYTES))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema)
    return files.repartition(tasks, "path").mapInArrow(_read([*files.columns, "content"]), f"{types}, content binary")


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = []
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
            store, inside, _ = _store(path)
            folder, _, name = inside.rpartition("/")
            if isinstance(store, fs.LocalFileSystem | fs.HadoopFileSystem):
                # Under a name no reader looks at, then renamed: a file is there whole or not at all.
                store.create_dir(folder, recursive=True)
                beside = f"{folder}/_{name}-{uuid.uuid4().hex}"
                with store.open_output_stream(beside, compression=None) as stream:
                    stream.write(content or b"")
                store.move(beside, inside)
            else:  # object stores show a file when it is complete
                with store.open_output_stream(inside, compression=None) as stream:
                    stream.write(content or b"")
            sizes.append(len(content or b""))
        yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(sizes, pa.int64())], names=["path", "size"])


def write_files(rows: DataFrame, path: str = "path", content: str = "content") -> dict:
    """Write each row as the file its ``path`` names, replacing what is there; returns the number of files
    and bytes. Null content makes an empty file, a null path none. Paths must be distinct. A task that is
    run again writes the same files again."""
    named = rows.filter(F.col(path).isNotNull()).select(F.col(path).cast("string").alias("path"), F.col(content).cast("binary").alias("content"))
    done = named.mapInArrow(_write, "path string, size long").agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"))
    return done.first().asDict()
