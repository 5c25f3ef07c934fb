"""Files as rows: listed, written and read by tasks, not by the driver.

Paths are local ones or URIs of a store that `pyarrow.fs` knows (s3, gs, hdfs, ...).
"""

import fnmatch
import os
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.session import written

_FOUND = "path string, size bigint, is_folder boolean"
#: Folders that one task lists, and the most tasks of a level.
_FOLDERS_A_TASK, _MOST_TASKS = 64, 10_000


def located(path: str) -> tuple[fs.FileSystem, str, str]:
    """The file system of a path or URI, the path in it, and what stands before that in a URI.

    Local paths have no scheme, as in all tables of this library.
    """
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), path, ""
    system, inner = fs.FileSystem.from_uri(path)
    return system, inner, path.rstrip("/").removesuffix(inner.rstrip("/"))


def is_known(path: str) -> bool:
    """Whether tasks can read the store of this path by themselves."""
    try:
        located(path)
    except (pa.ArrowInvalid, NotImplementedError, OSError):
        return False
    return True


def read_bytes(path: str) -> bytes:
    system, inner, _ = located(path)
    with system.open_input_stream(inner, compression=None) as f:
        return f.read()


def of_content(parser: Callable[[bytes], object]) -> Callable[[str], object]:
    """A parser of paths from one of bytes: a task holds the content of one file at a time."""
    return lambda path: parser(read_bytes(path))


def _is_hidden(name: str) -> bool:
    """As Spark's own scans see it."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name)


def list_tree(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """(path, size) of the files in any folder under `root` whose name fits `pattern`.

    Folders are dealt to tasks, level by level; the driver sees how many there are. Each
    level is written, so that nothing is listed twice, and a lost executor costs little. A
    folder's entries are listed by one task. A missing root is an error.
    """

    def entries(batches):
        system, base, prefix = located(root)
        for batch in batches:
            for folder in batch["path"].to_pylist():
                found = system.get_file_info(fs.FileSelector(folder))
                shown = [i for i in found if not _is_hidden(i.base_name)]
                wanted = [
                    i for i in shown if i.type == fs.FileType.Directory or fnmatch.fnmatchcase(i.base_name, pattern)
                ]
                for at in range(0, len(wanted), 10_000):
                    part = wanted[at : at + 10_000]
                    folders = [i.type == fs.FileType.Directory for i in part]
                    paths = [i.path if d else prefix + i.path for i, d in zip(part, folders, strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(paths), pa.array([i.size for i in part], pa.int64()), pa.array(folders)],
                        ["path", "size", "is_folder"],
                    )

    _, start, _ = located(root)
    level = spark.createDataFrame([(start.rstrip("/") or "/",)], "path string")
    files, count = None, 1
    while count:
        tasks = min(-(-count // _FOLDERS_A_TASK), _MOST_TASKS)
        listed = written(level.repartition(tasks).mapInArrow(entries, _FOUND), "listing")
        found = listed.filter(~F.col("is_folder")).select("path", "size")
        files = found if files is None else files.unionByName(found)
        level = listed.filter("is_folder").select("path")
        count = level.count()
    return files


def write_files(df: DataFrame, root: str, name: str, content: str) -> DataFrame:
    """Write each row's content (text or bytes; null is empty) as the file `name` under `root`.

    Gives (path, size) of each file. A file is written under another name and renamed, so
    a task that is lost or repeated leaves no half file; of rows with the same name, any stays.
    """
    rows = df.select(F.col(name).alias("name"), F.col(content).cast("binary").alias("content"))

    def write(batches):
        system, base, prefix = located(root)
        made = set()
        for batch in batches:
            paths, sizes = [], []
            for file_name, data in zip(batch["name"].to_pylist(), batch["content"], strict=True):
                path, data = f"{base}/{file_name}", data.as_py() or b""
                folder = os.path.dirname(path)
                if folder not in made:
                    system.create_dir(folder, recursive=True)
                    made.add(folder)
                part = f"{folder}/.{uuid.uuid4().hex}"
                with system.open_output_stream(part, compression=None) as f:
                    f.write(data)
                system.move(part, path)
                paths.append(prefix + path)
                sizes.append(len(data))
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(sizes, pa.int64())], ["path", "size"])

    return written(rows.mapInArrow(write, "path string, size bigint"), "files")


def dealt_by_size(files: DataFrame, size: str = "size", bytes_a_task: int = 64 << 20) -> DataFrame:
    """The rows dealt to tasks by the bytes they stand for.

    A file of `bytes_a_task` or more has a task of its own; the others, in no order, fill as
    many tasks as their bytes need. A null size counts as none.
    """
    large = F.coalesce(F.col(size) >= bytes_a_task, F.lit(False))
    sums = files.agg(
        F.count_if(large).alias("large"), F.coalesce(F.sum(F.when(~large, F.col(size))), F.lit(0)).alias("rest")
    ).first()
    small = files.filter(~large).repartition(min(int(sums.rest // bytes_a_task) + 1, _MOST_TASKS))
    if not sums.large:
        return small
    return small.unionByName(files.filter(large).repartition(min(sums.large, _MOST_TASKS)))


def read_contents(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """(path, size, content) by Spark's own scan, for stores that tasks can't open by themselves.

    Contents go to Python in batches of `spark.sql.execution.arrow.maxRecordsPerBatch` rows:
    set that by the size of the files.
    """
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(root)
    )
    return files.select("path", F.col("length").alias("size"), "content")
