"""Batch tables: Parquet, CSV and JDBC."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicktrail.functions.temporal import AsOf, instant, interval
from clicktrail.operators.contracts import conform
from clicktrail.schemas import TableContract

#: Partition columns the engine adds to the tables it writes.
STORAGE_COLUMNS = ("date", "query", "batch_id")


#: The query name of compacted folders.
COMPACTED = "compacted"
#: Lists, inside a compacted folder, the batch folders that it replaces; readers skip names that begin so.
SOURCES = "_sources"


def read_table(spark: SparkSession, path: str, contract: TableContract) -> DataFrame:
    """A table the engine wrote, in contract layout; filters on ``date`` prune partitions."""
    return _live(spark, path, lambda: spark.read.schema(_stored_schema(contract)).parquet(path))


def compacted_folders(spark: SparkSession, path: str, days: Iterable[dt.date] | None = None) -> list[str]:
    """Compacted folders, of all or of some days, whose lists of what they replace are still kept."""
    dates = ["*"] if days is None else sorted({day.isoformat() for day in days})
    found = []
    for date in dates:
        pattern, fs = file_system(spark, f"{path}/date={date}/query={COMPACTED}/batch_id=*/{SOURCES}")
        found += [status.getPath().getParent().toString() for status in fs.globStatus(pattern) or []]
    return sorted(found)


def replaced_batches(spark: SparkSession, compacted: Iterable[str]) -> dict[str, set[str]]:
    """By day, the batch folders (``query=.../batch_id=...``) that compacted folders hold the rows of."""
    replaced: dict[str, set[str]] = {}
    for folder in compacted:
        date = folder.split("/")[-3].removeprefix("date=")
        replaced.setdefault(date, set()).update(row.value for row in spark.read.text(f"{folder}/{SOURCES}").collect())
    return replaced


def _live(spark: SparkSession, path: str, read: Callable[[], DataFrame], days: Iterable[dt.date] | None = None) -> DataFrame:
    """The rows of stored folders that no compacted folder replaces, each once while a compaction goes on.

    Spark lists the files when ``read`` is called. The compacted folders are
    looked up before and after: if they are the same, none came in between, so
    the files listed are those of one state; if not, all is read again.
    """
    while True:
        before = compacted_folders(spark, path, days)
        rows = read()
        if compacted_folders(spark, path, days) == before:
            break
    folder = F.concat(F.lit("query="), F.col("query"), F.lit("/batch_id="), F.col("batch_id").cast("string"))
    for date, names in replaced_batches(spark, before).items():
        hidden = (F.col("date") == F.lit(date).cast("date")) & folder.isin(sorted(names))
        rows = rows.where(~F.coalesce(hidden, F.lit(False)))
    return rows


def _stored_schema(contract: TableContract) -> T.StructType:
    return T.StructType(
        [
            *contract.schema,
            T.StructField("date", T.DateType()),
            T.StructField("query", T.StringType()),
            T.StructField("batch_id", T.LongType()),
        ]
    )


def read_rows(spark: SparkSession, path: str, contract: TableContract) -> DataFrame:
    """The contract's own columns of a stored table."""
    return read_table(spark, path, contract).select(*contract.columns)


def file_system(spark: SparkSession, path: str):
    """Hadoop's path and file system of a path, whatever store it is in."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location, location.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    location, fs = file_system(spark, path)
    return fs.exists(location)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if it does not exist."""
    location, fs = file_system(spark, path)
    if not fs.exists(location):
        return []
    return [status.getPath().getName() for status in fs.listStatus(location) if status.isDirectory()]


def file_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files in a folder."""
    location, fs = file_system(spark, path)
    return fs.getContentSummary(location).getLength()


def fingerprint(spark: SparkSession, path: str) -> tuple:
    """Names, lengths and times of the files of a table, which change when its data does."""
    location, fs = file_system(spark, path)
    found, files = [], fs.listFiles(location, True)
    while files.hasNext():
        status = files.next()
        found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return tuple(sorted(found))


def stored_days(spark: SparkSession, path: str) -> list[dt.date]:
    """Days for which a stored table has a partition, oldest first."""
    values = [name.removeprefix("date=") for name in folders(spark, path) if name.startswith("date=")]
    return sorted(dt.date.fromisoformat(v) for v in values if not v.startswith("__"))


def read_days(spark: SparkSession, path: str, contract: TableContract, days: Iterable[dt.date]) -> DataFrame | None:
    """Those days of a stored table, no other folder being listed; None if none of them is stored."""
    days = sorted(set(days))
    names = [f"{path}/date={day.isoformat()}" for day in days]
    there = [name for name in names if exists(spark, name)]
    if not there:
        return None
    return _live(
        spark, path, lambda: spark.read.schema(_stored_schema(contract)).option("basePath", path).parquet(*there), days
    )


def read_since(
    spark: SparkSession, path: str, contract: TableContract, as_of: AsOf, horizon: str
) -> DataFrame:
    """The contract's columns of the days that a horizon before ``as_of`` can touch; older days are not read."""
    oldest = F.to_date(instant(as_of) - interval(horizon))
    return read_table(spark, path, contract).where(F.col("date") >= oldest).select(*contract.columns)


def newest_day(spark: SparkSession, path: str, contract: TableContract) -> DataFrame:
    """The rows of a stored table's newest day."""
    days = stored_days(spark, path)
    rows = read_days(spark, path, contract, days[-1:])
    return (read_table(spark, path, contract) if rows is None else rows).select(*contract.columns)


#: Header line, and quotes inside a quoted value doubled.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"'}
#: Takes the whole line of a row that does not parse.
MISFIT = "_misfit"


def read_csv(
    spark: SparkSession, path: str, columns: Sequence[str], multi_line: bool = True, misfits: bool = False
) -> DataFrame:
    """CSV with a header line, every column a string, by position; an empty value is NULL.

    Quoted values may hold line breaks. That keeps Spark from splitting a file;
    seeds known to have none can be read with ``multi_line=False``. With
    ``misfits`` the text of a row with too few or too many values comes along
    in a further column, NULL for all others.
    """
    names = [*columns, MISFIT] if misfits else columns
    text = T.StructType([T.StructField(name, T.StringType()) for name in names])
    reader = spark.read.schema(text).options(**CSV_OPTIONS, enforceSchema="true", multiLine=str(multi_line).lower())
    if misfits:
        reader = reader.option("columnNameOfCorruptRecord", MISFIT)
    return reader.csv(path)


def csv_misfits(spark: SparkSession, path: str, columns: Sequence[str], multi_line: bool = True) -> DataFrame:
    """Rows of a CSV seed that do not parse: the columns as far as found, and the text in the last."""
    rows = read_csv(spark, path, columns, multi_line, misfits=True)
    return rows.where(rows[MISFIT].isNotNull())


def read_csv_table(spark: SparkSession, path: str, contract: TableContract, multi_line: bool = True) -> DataFrame:
    """CSV rows cast to a contract."""
    return conform(read_csv(spark, path, contract.columns, multi_line), contract)


@dataclass(frozen=True)
class JdbcRange:
    """A numeric, date or timestamp column that splits a JDBC scan into ranges."""

    column: str
    lower: str
    upper: str
    partitions: int


def jdbc_options(url: str, table: str, split: JdbcRange | None = None, **options: str) -> dict[str, str]:
    """Options of a JDBC scan, parallel over the ranges of ``split`` if there is one."""
    merged = {"url": url, "dbtable": table, **options}
    if split is not None:
        merged |= {
            "partitionColumn": split.column,
            "lowerBound": split.lower,
            "upperBound": split.upper,
            "numPartitions": str(split.partitions),
        }
    return merged


def hash_predicates(column: str, partitions: int, hashed: str = "abs(hashtext({column}))") -> list[str]:
    """Conditions that split a table on a text key, one for each task; every row meets exactly one.

    ``hashed`` is the database's own way to hash a text to a non-negative number.
    """
    value = hashed.format(column=column)
    first = f"MOD({value}, {partitions}) = 0 OR {column} IS NULL"
    return [first, *(f"MOD({value}, {partitions}) = {n}" for n in range(1, partitions))]


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    split: JdbcRange | None = None,
    predicates: Sequence[str] | None = None,
    **options: str,
) -> DataFrame:
    """A database table, column names in lower case, one task for each range or predicate."""
    if predicates is not None:
        rows = spark.read.jdbc(url, table, predicates=list(predicates), properties=options)
    else:
        rows = spark.read.format("jdbc").options(**jdbc_options(url, table, split, **options)).load()
    return rows.toDF(*[name.lower() for name in rows.columns])
