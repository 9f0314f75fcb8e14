"""What the corpus operators share: staging, batches, word hashing and files in the shared folder."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What separates words, as a pattern for the JVM and for Python alike.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

#: Letters and digits of any script, for shingles: case, punctuation and layout don't count.
SHINGLE_WORD = re.compile(r"[^\W_]+")
SHINGLE_SIZE = 5
SIMILAR = 0.8

_GOLDEN, _M1, _M2 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


# Sessions


#: Texts are long: Arrow batches of so many rows keep a task's memory small.
BATCH_ROWS = 500


def ship(spark: SparkSession) -> None:
    """Set the size of batches, and give executors this package; harmless where it is installed there."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    context = spark.sparkContext
    if getattr(context, "has_haulmetry", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    context.has_haulmetry = True


# Staging


def shared_folder(spark: SparkSession) -> str:
    """Folder that the driver and all executors see: ``spark.checkpoint.dir``.

    Only a single-machine session without that setting gets a temporary folder of its own; a
    cluster without it is an error, because executors would not see each other's files.
    """
    folder = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        folder = "file://" + tempfile.mkdtemp(prefix="corpus-")
        spark.sparkContext.setCheckpointDir(folder)
    return (folder if "://" in folder or folder.startswith("file:") else f"file://{folder}").rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/corpus-{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    It cuts the lineage, survives lost executors, and gives readers pruned columns and a known size.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back.staged_at = path
    return back


def dropped(df: DataFrame) -> None:
    """Delete a staged table that nothing reads any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.staged_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings for the jobs that run inside; dots are written as two underscores."""
    before = {k.replace("__", "."): spark.conf.get(k.replace("__", "."), None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k.replace("__", "."), v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def parts_for(spark: SparkSession, megabytes: float, each: float = 32.0) -> int:
    """Partitions for so many MB, at least as many as the session's shuffles have."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(megabytes / each) + 1)


# Columns


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text, white space between them, as an array."""
    return F.array_remove(F.split(text, SPACES), "")


def remainder(doc_id: Column, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % by


# Batches


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in small batches, so that only a few texts are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


# Hashing


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers with well spread bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _M1
        x = (x ^ (x >> np.uint64(27))) * _M2
        return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words; forgets all it has once there are ``most``."""

    def __init__(self, most: int = 200_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: str) -> int:
        import xxhash

        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def shingle_hashes(words: np.ndarray, size: int = SHINGLE_SIZE) -> np.ndarray:
    """One hash for each run of ``size`` words, from the words' hashes; a shorter text is one run."""
    n = len(words)
    if not n:
        return words
    size = min(size, n)
    with np.errstate(over="ignore"):
        total = np.zeros(n - size + 1, dtype=np.uint64)
        for k in range(size):
            total = total * _M1 + mix(words[k : n - size + 1 + k] + _GOLDEN * np.uint64(k + 1))
        return mix(total)


def shingle_batch(word_lists: list[list[str]], hashes: WordHashes, size: int = SHINGLE_SIZE) -> list[np.ndarray]:
    """``shingle_hashes`` of several texts, with one pass over all their words."""
    counts = np.array([len(w) for w in word_lists], dtype=np.int64)
    ends = np.cumsum(counts)
    every = hashes.of([w for words in word_lists for w in words])
    whole = shingle_hashes(every, size) if len(every) >= size else every
    return [
        whole[end - n : end - size + 1] if n >= size else shingle_hashes(every[end - n : end], size)
        for n, end in zip(counts.tolist(), ends.tolist(), strict=True)
    ]


# Files


def file_system(uri: str):
    """File system and path of a URI, for tasks that write or read binary files themselves."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))
