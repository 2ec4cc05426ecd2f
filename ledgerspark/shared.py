"""Small files in the shared folders, through Hadoop's file system (any store that Spark can reach).

Only markers and listings of a few names go this way; tables are written and read by Spark. Many files of given
names are written by the tasks (``write_named``).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if there is no folder."""
    fs, p = _at(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def write_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file; False, and nothing is changed, if it is there already.

    The store decides (exclusive create): of two writers one gets False.
    """
    fs, p = _at(spark, path)
    try:
        out = fs.create(p, False)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in str(e.java_exception):
            return False
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.mkdirs(p)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


def arrow_reaches(folder: str) -> bool:
    """Whether Arrow's file systems reach a folder, so that tasks can write files of given names there themselves."""
    from pyarrow import fs
    try:
        fs.FileSystem.from_uri(folder)
    except (ValueError, OSError, ImportError, NotImplementedError):
        return False
    return True


def write_named(rows: DataFrame, root: str, suffix: str) -> int:
    """Rows (folder, name, line) as files ``<root>/<folder>/<name>.<suffix>``, each line with a line break after it; how many files.

    A file's rows must be neighbours in one partition. The tasks write their files under hidden names and rename
    them when they are whole, so a task that runs again replaces them; nothing passes through the driver, one row
    and one open file at a time are held.
    """
    def write(batches):
        import uuid

        import pyarrow as pa
        from pyarrow import fs
        store, top = fs.FileSystem.from_uri(root)
        made, at, out, hidden, n = set(), None, None, "", 0

        def close():
            out.close()
            store.move(hidden, f"{top}/{at[0]}/{at[1]}.{suffix}")
        for batch in batches:
            for folder, name, line in zip(*(batch.column(i) for i in range(3))):
                key = (folder.as_py(), name.as_py())
                if key != at:
                    if out is not None:
                        close()
                    at, n = key, n + 1
                    if at[0] not in made:
                        store.create_dir(f"{top}/{at[0]}", recursive=True)
                        made.add(at[0])
                    hidden = f"{top}/{at[0]}/.{uuid.uuid4().hex}"
                    out = store.open_output_stream(hidden)
                out.write(line.as_buffer())
                out.write(b"\n")
        if out is not None:
            close()
        yield pa.RecordBatch.from_pydict({"files": pa.array([n], pa.int64())})
    cells = rows.select("folder", "name", F.col("line").cast("binary").alias("line"))
    return cells.mapInArrow(write, "files long").agg(F.coalesce(F.sum("files"), F.lit(0))).first()[0]


def rename_parts(spark: SparkSession, source: str, target: str, suffix: str) -> None:
    """Files that Spark wrote below ``source`` as ``layer=<a>/part=<b>/part-*``, one each, become ``target/<a>/part_<b>.<suffix>``."""
    fs, root = _at(spark, source)
    path = spark._jvm.org.apache.hadoop.fs.Path
    value = lambda name: spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(name.split("=", 1)[1])

    def move(layer) -> None:
        folder = f"{target}/{value(layer.getPath().getName())}"
        fs.mkdirs(path(folder))
        for part in fs.listStatus(layer.getPath()):
            for f in fs.listStatus(part.getPath()):
                if f.getPath().getName().startswith("part-"):
                    fs.rename(f.getPath(), path(f"{folder}/part_{value(part.getPath().getName())}.{suffix}"))
    with ThreadPoolExecutor(16) as pool:
        list(pool.map(move, [x for x in fs.listStatus(root) if x.isDirectory()]))
    fs.delete(root, True)
