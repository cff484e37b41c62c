"""File-system questions, answered by the cluster's own Hadoop client."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _locate(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _locate(spark, path)
    return bool(fs.exists(p))


def is_complete(spark: SparkSession, path: str) -> bool:
    """A finished write leaves its success marker."""
    return exists(spark, f"{path}/_SUCCESS")


def has_files(spark: SparkSession, path: str) -> bool:
    """True when the folder holds anything but hidden or marker entries."""
    fs, p = _locate(spark, path)
    if not fs.exists(p):
        return False
    return any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(p))


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _locate(spark, path)
    fs.delete(p, True)


def touch(spark: SparkSession, path: str) -> None:
    fs, p = _locate(spark, path)
    fs.create(p, True).close()


def folders(spark: SparkSession, path: str) -> list[str]:
    """Folders directly under ``path``; none if it does not exist."""
    fs, p = _locate(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().toString() for s in fs.listStatus(p) if s.isDirectory())


def files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """Name, size and time of change of the data files directly under ``path``."""
    fs, p = _locate(spark, path)
    if not fs.exists(p):
        return []
    found = [s for s in fs.listStatus(p) if s.isFile() and not s.getPath().getName().startswith(("_", "."))]
    return sorted((s.getPath().toString(), int(s.getLen()), int(s.getModificationTime())) for s in found)


def cut_files(spark: SparkSession, path: str, out: str, share: float, n_files: int | None = None) -> None:
    """Copies of the data files under ``path`` that end early, as an upload that broke off leaves them.

    With ``n_files``, that many, of all files under ``path`` one behind the other. Bytes go from stream to stream, never
    into memory whole. A copy never ends where one of its files does: it would end in that file's footer.
    """
    found = files(spark, path)
    n = len(found) if n_files is None else min(n_files, len(found))
    copy = spark._jvm.org.apache.commons.io.IOUtils.copyLarge
    for k in range(n):
        own = found[k * len(found) // n : (k + 1) * len(found) // n]
        left = int(sum(size for _, size, _ in own) * share)
        fs, p = _locate(spark, f"{out}/{own[0][0].rsplit('/', 1)[1]}")
        to = fs.create(p, True)
        for name, size, _ in own:
            if left <= 0:
                break
            fs, p = _locate(spark, name)
            source = fs.open(p)
            copy(source, to, 0, size - 1 if left == size else min(left, size))
            source.close()
            left -= size
        to.close()
