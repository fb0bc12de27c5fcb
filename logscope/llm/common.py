"""Helpers shared by the corpus operators."""

from __future__ import annotations

import functools
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logscope.session import materialize

LONG = 1 << 64


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, as ``--py-files`` does, once per application, so that
    Python workers can import it wherever the driver found it."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import logscope

    parent, name = os.path.split(os.path.dirname(os.path.abspath(logscope.__file__)))
    # in the driver's own folder of this application, from which Spark serves it to the executors
    archive = os.path.join(tempfile.mkdtemp(dir=sc._temp_dir), f"{name}-code.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for at, _, files in os.walk(os.path.join(parent, name)):
            for f in sorted(files):
                if f.endswith(".py"):
                    z.write(os.path.join(at, f), os.path.relpath(os.path.join(at, f), parent))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


def shipped(query):
    """``query(spark, ...)`` with the package shipped first."""
    @functools.wraps(query)
    def run(spark: SparkSession, *args):
        ship(spark)
        return query(spark, *args)

    return run


def cut(df: DataFrame) -> DataFrame:
    """``df`` written once as a table in the shared checkpoint folder and read back; an error without such a folder."""
    return materialize(df, df.sparkSession, strict=True)


class Memo(dict):
    """``make(word)`` of words met, in about ``limit`` bytes: words of the older half that are met again move to the younger one,
    the rest go when that is full.  Belongs to one task, which makes it and drops it."""

    ENTRY, LONGEST = 200, 64        # bytes of an entry beside its word; letters of the longest word kept

    def __init__(self, make: Callable, limit: int):
        super().__init__()
        self.make, self.half, self.old, self.held = make, limit // 2, {}, 0

    def __missing__(self, word: str):
        value = self.old.pop(word, None)
        if value is None:
            value = self.make(word)
        if len(word) <= self.LONGEST:
            if self.held >= self.half:
                self.old, self.held = dict(self), 0
                self.clear()
            self[word] = value
            self.held += self.ENTRY + len(word)
        return value


def slices(batches: Iterator[pa.Array], text_rows: int = 256) -> Iterator[list[pa.Array]]:
    """Each array in parts of a few rows, so that a task doesn't hold a batch's texts twice."""
    for arr in batches:
        yield [arr.slice(a, text_rows) for a in range(0, len(arr), text_rows)]


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names`` altered until none clashes (case-insensitively) with a column of ``df``."""
    have = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in have:
            n = f"{n}_"
        have.add(n.lower())
        out.append(n)
    return out


def texts(arr: pa.Array, null: str = "") -> list[str]:
    """Strings of an Arrow array; null counts as ``null``."""
    return [null if x is None else x for x in arr.to_pylist()]


def raw(arr: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string array without decoding; null counts as empty."""
    return [x or b"" for x in arr.cast(pa.binary()).to_pylist()]


def each_raw(arr: pa.Array, text_rows: int = 256) -> Iterator[bytes]:
    """``raw``, a few rows at a time."""
    for a in range(0, len(arr), text_rows):
        yield from raw(arr.slice(a, text_rows))


def signed(x: int) -> int:
    """An unsigned 64-bit value as the signed long that Spark stores."""
    return x - LONG if x >= LONG >> 1 else x


def total_bytes(docs: DataFrame, text: str = "text") -> tuple[int, int]:
    """(rows, UTF-8 bytes of the texts) of the whole input, by one aggregate."""
    r = docs.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("b")).first()
    return int(r["n"]), int(r["b"])
