"""What the operators of this subpackage share: stored intermediates, row identity, word patterns."""

from __future__ import annotations

import functools
import os
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktrail.session import work_dir

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared work folder: computed once, lineage cut, safe to lose executors."""
    path = work_dir(df.sparkSession, "llm", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_below(df: DataFrame, rows: int, limit: int) -> DataFrame:
    """A broadcast hint for a side whose counted rows are at most ``limit``; beyond it the join shuffles."""
    return F.broadcast(df) if rows <= limit else df


def words(text: Column) -> Column:
    """The words of a text as an array; null and blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def text_key(text: Column) -> Column:
    """With the id, what identifies a row: rows equal in both get equal results, so they may share them."""
    return F.xxhash64(F.coalesce(text, F.lit("")), text.isNull())


#: Bytes of one of the pieces that stand for a long text.
PIECE = 4_096


def pieces(text: bytes, most: int) -> bytes:
    """A text of up to ``most`` bytes as it is; of a longer one, pieces at even distances from its beginning to its end."""
    n = -(-most // PIECE)
    if len(text) <= most or n < 2:
        return text[:most]
    starts = [(len(text) - PIECE) * i // (n - 1) for i in range(n)]
    return b"".join(text[a : a + PIECE] for a in starts)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@functools.cache
def _shipped(application: str, add: Callable) -> bool:
    """The package as a zip file; Spark serves it to every executor, which need not have it installed."""
    top = Path(__file__).resolve().parents[1]
    path = os.path.join(tempfile.mkdtemp(prefix="clicktrail-"), f"{top.name}.zip")
    with zipfile.ZipFile(path, "w") as out:
        for file in sorted(top.rglob("*.py")):
            out.write(file, file.relative_to(top.parent))
    add(path)
    return True


def in_arrow(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with this package at hand on the executors."""
    _shipped(df.sparkSession.sparkContext.applicationId, df.sparkSession.sparkContext.addPyFile)
    return df.mapInArrow(function, schema)


def in_pandas(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``mapInPandas`` with this package at hand on the executors."""
    _shipped(df.sparkSession.sparkContext.applicationId, df.sparkSession.sparkContext.addPyFile)
    return df.mapInPandas(function, schema)
