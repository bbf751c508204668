"""Path checks on the filesystem of a path (any Hadoop scheme).

Driver-side metadata only — existence and directory listings, never file
contents. On a classic session the Hadoop ``FileSystem`` of the path is
used; on a session without a JVM gateway (Spark Connect) the same answers
come from a Spark listing of file paths (the ``binaryFile`` source with only
its ``path`` column selected reads no content).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession


def _hadoop(spark: SparkSession, path: str):
    jvm = getattr(spark, "_jvm", None)
    if jvm is None:
        return None, None
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _listed(spark: SparkSession, path: str) -> list[str]:
    """Every file below ``path``; only a path that is not there gives none."""
    try:
        rows = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                .load(path).select("path").collect())
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return [r.path for r in rows]


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop(spark, path)
    if fs is not None:
        return bool(fs.exists(p))
    return bool(_listed(spark, path))


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Entry names directly inside ``folder`` (sorted; empty if missing)."""
    fs, p = _hadoop(spark, folder)
    if fs is not None:
        if not fs.exists(p):
            return []
        return sorted(st.getPath().getName() for st in fs.listStatus(p))
    base = folder.rstrip("/").split(":", 1)[-1].lstrip("/")
    names = set()
    for f in _listed(spark, folder):
        rest = f.split(":", 1)[-1].lstrip("/")
        if rest.startswith(base + "/"):
            names.add(rest[len(base) + 1:].split("/", 1)[0])
    return sorted(names)


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Move a file or folder within one filesystem."""
    fs, p = _hadoop(spark, source)
    if fs is None:
        raise RuntimeError(f"cannot move {source}: no filesystem gateway in this session")
    if not fs.rename(p, _hadoop(spark, target)[1]):
        raise OSError(f"cannot move {source} to {target}")


def delete(spark: SparkSession, path: str) -> bool:
    """Remove a folder (recursively) on the path's filesystem."""
    fs, p = _hadoop(spark, path)
    if fs is None:
        raise RuntimeError(f"cannot delete {path}: no filesystem gateway in this session")
    return bool(fs.delete(p, True))


__all__ = ["delete", "exists", "list_names", "rename"]
