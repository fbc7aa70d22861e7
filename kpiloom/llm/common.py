"""Shared pieces: word rule, 64-bit hashes over whole texts, cut points, value keys.

A word is a run of bytes other than space and \\x09-\\x0D. The hashes are prefix-sum
polynomials modulo 2^64 over the UTF-8 bytes, so all words or windows of a text cost a few
array operations, whatever their number.
"""

from __future__ import annotations

import ctypes
import sys
import types
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.store import drop_shuffles, shared_folder

SPACES = " \t\n\x0b\f\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]"

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_STEP = np.uint64(0xD6E8FEB86659FD93)


def process_state() -> dict:
    """A dictionary that lives as long as the process: caches outlive a task in a reused worker."""
    name = "_kpiloom_process_state"
    return sys.modules.setdefault(name, types.ModuleType(name)).__dict__


def give_back() -> None:
    """Return memory that earlier tasks of a reused worker have freed, where the C library can."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task function whose worker lets go of what earlier stages keep, and of its own freed memory."""

    def freed(frames: Iterator) -> Iterator:
        process_state().pop("tokenizers", None)
        give_back()
        yield from run(frames)
        give_back()

    return freed


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Folders written while a ``scratch`` is open, the innermost one last.
_OPEN: list[list[str]] = []


@contextmanager
def scratch() -> Iterator[list[str]]:
    """Collects the folders that ``cut`` and ``stored`` write, for ``remove`` once all is consumed."""
    made: list[str] = []
    _OPEN.append(made)
    try:
        yield made
    finally:
        _OPEN.remove(made)
        if _OPEN:
            _OPEN[-1].extend(made)


def remove(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete intermediate files and let Spark drop the shuffles that nothing refers to."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    drop_shuffles(spark)


def forget(*tables: DataFrame) -> None:
    """Delete the files of results of ``cut`` or ``stored`` that no later step reads."""
    remove(tables[0].sparkSession, [t._written for t in tables])


def forget_all_but(made: Iterable[str], *tables: DataFrame) -> None:
    """Delete what a ``scratch`` collected so far, apart from the files of ``tables``."""
    needed = {t._written for t in tables}
    remove(tables[0].sparkSession, [path for path in made if path not in needed])


def _noted(df: DataFrame, path: str) -> DataFrame:
    df._written = path
    if _OPEN:
        _OPEN[-1].append(path)
    return df


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint into the shared folder; the files stay until ``forget`` or ``remove``."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    done = df.checkpoint(eager=True)
    return _noted(done, done._jdf.queryExecution().analyzed().rdd().getCheckpointFile().get())


def stored(df: DataFrame) -> DataFrame:
    """Cut the lineage like ``cut``, in packed columns: for tables with a row per window or word.

    The files stay until ``forget`` or ``remove``, or the application ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    return _noted(spark.read.schema(df.schema).parquet(path), path)


def value_key(text: str = "text") -> Column:
    """A row key made of the row's own values: reruns and other layouts agree on it.

    Rows that agree in the key are copies of one another, so they may share a result.
    """
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns that an operator is about to add; its own names win over extra columns."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def set_aside(df: DataFrame, *known: str) -> DataFrame:
    """All columns but ``known`` under numbered names, so that no working column can meet one of them.

    ``toDF`` with the old names brings them back.
    """
    return df.toDF(*[c if c in known else f"_extra{i}" for i, c in enumerate(df.columns)])


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    kept = process_state().get("powers")
    if kept is None or len(kept[0]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        kept = []
        for base in (_BASE, _BASE_INVERSE):
            powers = np.full(size, base, dtype=np.uint64)
            powers[0] = 1
            kept.append(np.multiply.accumulate(powers))
        process_state()["powers"] = kept
    return kept[0][:n], kept[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Prefix sums of (byte + 1) * base^position; one longer than ``data``."""
    power, _ = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=sums[1:])
    return sums


def range_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each byte range, wherever in a text it stands."""
    _, inverse = _powers(len(sums))
    return mix((sums[ends] - sums[starts]) * inverse[starts])


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    space = np.ones(len(data) + 2, dtype=np.int8)
    space[1:-1] = (data == 32) | ((data >= 9) & (data <= 13))
    edges = np.flatnonzero(space[1:] != space[:-1])
    return edges[0::2], edges[1::2]


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end) of each word."""
    array = np.frombuffer(data, dtype=np.uint8)
    starts, ends = word_bounds(array)
    return range_hashes(prefix_sums(array), starts, ends), starts, ends


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words; of the whole sequence if it is shorter."""
    if len(words) == 0:
        return words
    size = min(size, len(words))
    last = len(words) - size + 1
    out = np.zeros(last, dtype=np.uint64)
    for k in range(size):
        out = out * _STEP + words[k : k + last]
    return mix(out)


def utf8(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""
