"""Helpers shared by the operators: inputs, shared scratch tables, let
bindings for column expressions, and text chunks for Arrow tasks."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.session import unique_name, work_root
from orrery.sources.commitlog import delete

#: White space that separates words, and its regular-expression class.
BLANKS = " \t\n\x0b\x0c\r"
WORD_GAP = r"[\x20\x09-\x0D]+"
#: Code points that one vectorised step handles at most (a longer text is a
#: step of its own), so that a task's memory follows its longest text.
CHUNK_CHARS = 1 << 20
BATCH_ROWS = 1000
#: Rows that hold lists of ids, a thousand and more each, read at once.
LIST_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the cluster's shared checkpoint folder."""
    return work_root(spark, "llm", unique_name(name))


_PASSING: ContextVar[list | None] = ContextVar("passing", default=None)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Tables that ``written`` makes inside are deleted at the end, but for
    those with a path of their own: for steps whose result is itself written
    and reads none of the others."""
    paths: list = []
    token = _PASSING.set(paths)
    try:
        yield
    finally:
        _PASSING.reset(token)
        for path in paths:
            delete(spark, path)


def written(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """The frame as a Parquet table in the shared folder: cuts the lineage
    and survives lost executors."""
    spark = df.sparkSession
    if path is None:
        path = scratch(spark, name)
        if _PASSING.get() is not None:
            _PASSING.get().append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value`` computed once. A plain reference inside a
    lambda would be evaluated again for each element."""
    return F.transform(F.array(value), body)[0]


def chunks(texts: Sequence[str], limit: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges [a, b) of texts with at most ``limit`` characters together."""
    a = size = 0
    for b, text in enumerate(texts):
        if b > a and size + len(text) > limit:
            yield a, b
            a, size = b, 0
        size += len(text) + 1
    if a < len(texts):
        yield a, len(texts)


def code_points(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one array of code points, each followed by a 0, and the
    start of each text in it (one more entry: the total length)."""
    joined = "\0".join(texts) + "\0"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    lengths = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    return points, np.concatenate([[0], np.cumsum(lengths)])


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64), wrapping."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def at_most(spark: SparkSession, key: str, most: int) -> None:
    """Lower a session's number of rows; a smaller one stays."""
    if not 0 < int(spark.conf.get(key)) <= most:
        spark.conf.set(key, str(most))


def short_batches(spark: SparkSession) -> None:
    """Read files in batches of few rows. Spark's own sizes fit short rows:
    4096 texts or id lists at once are arrays of tens of MB, of which a task
    holds several."""
    at_most(spark, "spark.sql.parquet.columnarReaderBatchSize", BATCH_ROWS)
    at_most(spark, "spark.sql.orc.columnarReaderBatchSize", LIST_ROWS)


def ship(spark: SparkSession) -> None:
    """Prepare a session for Python tasks over texts: Arrow batches of at most
    BATCH_ROWS rows (texts are long), and this package on the executors, once a
    session: a zip sent by Spark itself, for clusters where it is not
    installed."""
    at_most(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    sc = spark.sparkContext
    if getattr(sc, "_orrery_shipped", False):
        return
    root = Path(__file__).resolve().parent.parent
    name = Path(tempfile.mkdtemp(prefix="orrery-zip-")) / "orrery_tasks.zip"
    with zipfile.ZipFile(name, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    sc.addPyFile(str(name))
    sc._orrery_shipped = True
