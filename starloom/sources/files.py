"""File scans and landings: CSV exports, Parquet folders, staged extracts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.sources import hadoop
from starloom.sources.contracts import RAW_TABLES

# Fixed value: how this library's own files spell a missing value. Text that begins with
# a backslash gets another one, so no text is ever equal to it.
CSV_NULL = "\\N"

# Quotes are doubled inside quotes, and blanks are part of a value.
_CSV = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def _texts(schema: T.StructType) -> list[str]:
    return [c.name for c in schema.fields if isinstance(c.dataType, T.StringType)]


def _escaped(name: str) -> Column:
    value = F.col(f"`{name}`")
    return F.when(value.startswith("\\"), F.concat(F.lit("\\"), value)).otherwise(value)


def _unescaped(name: str) -> Column:
    value = F.col(f"`{name}`")
    return F.when(value.startswith("\\"), F.expr(f"substring(`{name}`, 2)")).otherwise(value)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV that :func:`read_csv` gives back as it was, whatever the text holds."""
    texts = {name: _escaped(name) for name in _texts(df.schema)}
    rows = df.withColumns(texts) if texts else df
    rows.write.mode("overwrite").options(**_CSV, nullValue=CSV_NULL).csv(path)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: str,
    null_value: str = CSV_NULL,
    multi_line: bool = True,
) -> DataFrame:
    """CSV typed by ``schema``; a value that does not parse raises, as does another header.

    The header has to name the schema's columns in their order. ``null_value`` is how the
    file's writer spells a missing value. Text may hold line breaks; then one file is read
    by one task, so say ``multi_line=False`` for large files that are known to have none.
    """
    kind = T.StructType.fromDDL(schema)
    rows = (
        spark.read.schema(kind)
        .options(**_CSV, nullValue=null_value, mode="FAILFAST", enforceSchema=False)
        .option("multiLine", multi_line)
        .csv(path)
    )
    if null_value != CSV_NULL:
        return rows
    texts = {name: _unescaped(name) for name in _texts(kind)}
    return rows.withColumns(texts) if texts else rows


def land_csv(
    spark: SparkSession,
    path: str,
    table: str,
    null_value: str = CSV_NULL,
    multi_line: bool = True,
) -> DataFrame:
    """An exported raw table, with the types of its contract."""
    return read_csv(spark, path, RAW_TABLES[table], null_value, multi_line)


# Columns of a landing's rejects, besides the record.
RECORD, FILE, REJECTED = "__record", "__file", "__rejected"


def _reason(kind: T.StructType) -> Column:
    """What is wrong with a rejected record: its fields are read as text beside the typed ones."""
    plain = ", ".join(f"`{c.name}` string" for c in kind.fields)
    fields = F.from_csv(F.col(RECORD), plain, {"quote": '"', "escape": '"', "nullValue": CSV_NULL})
    bad = [
        F.when(
            fields[c.name].isNotNull() & F.col(f"`{c.name}`").isNull(),
            F.concat(F.lit(f"{c.name} is not {c.dataType.simpleString()}: "), fields[c.name]),
        )
        for c in kind.fields
        if not isinstance(c.dataType, T.StringType)
    ]
    told = F.array_join(F.array_compact(F.array(*bad)), "; ") if bad else F.lit("")
    return F.when(told == "", F.lit("number of fields")).otherwise(told)


def land_csv_with_rejects(
    spark: SparkSession,
    path: str,
    schema: str,
    landing: str,
    null_value: str = CSV_NULL,
    multi_line: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """CSV typed by ``schema`` and its rejects, both written under ``landing`` in one pass.

    Records whose fields all have their type, and as many fields as the header, land. The
    others are set aside as (record, file, reason), whole and as they were, so that one bad
    value doesn't end a load. Values that parse are kept as they are; a field of the rejects is
    named in the reason if it has a text but no value. A header with other names still raises.
    """
    kind = T.StructType.fromDDL(schema)
    read = (
        spark.read.schema(T.StructType([*kind.fields, T.StructField(RECORD, T.StringType())]))
        .options(**_CSV, nullValue=null_value, mode="PERMISSIVE", enforceSchema=False)
        .option("columnNameOfCorruptRecord", RECORD)
        .option("columnPruning", False)
        .option("multiLine", multi_line)
        .csv(path)
    )
    staged = f"{landing}/staged"
    rows = read.select("*", F.col("_metadata.file_path").alias(FILE), F.col(RECORD).isNotNull().alias(REJECTED))
    rows.write.mode("overwrite").partitionBy(REJECTED).parquet(staged)
    columns = [*kind.fields, T.StructField(RECORD, T.StringType()), T.StructField(FILE, T.StringType())]
    written = spark.read.schema(
        T.StructType([*columns, T.StructField(REJECTED, T.BooleanType())])
    ).parquet(staged)
    good = written.filter(~F.col(REJECTED)).select(*[f"`{c.name}`" for c in kind.fields])
    if null_value == CSV_NULL and _texts(kind):
        good = good.withColumns({name: _unescaped(name) for name in _texts(kind)})
    bad = written.filter(REJECTED).select(
        F.col(RECORD).alias("record"), F.col(FILE).alias("file"), _reason(kind).alias("reason")
    )
    return good, bad


def write_as(df: DataFrame, path: str, fmt: str) -> None:
    """Write in the chosen loader format, ``parquet`` or ``csv``."""
    if fmt == "csv":
        write_csv(df, path)
    elif fmt == "parquet":
        df.write.mode("overwrite").parquet(path)
    else:
        raise ValueError(f"unknown sink format {fmt!r}")


def footer_aggregate(spark: SparkSession, path: str, *aggregates: Column) -> DataFrame:
    """Counts, minima and maxima over a Parquet folder, from the statistics of its footers.

    No column is read where the type has exact statistics (numbers, dates, not text nor times);
    otherwise, or with a filter that isn't on partitions, the columns are scanned as usual. It
    runs in a session of its own settings over the same cluster.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session.read.parquet(path).agg(*aggregates)


class FolderSource:
    """A folder with one Parquet file or folder per table, read like a database."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _children(self) -> dict[str, str]:
        names = hadoop.child_names(self.spark, self.root)
        shown = [name for name in names if not name.startswith(("_", "."))]
        return {name.removesuffix(".parquet"): name for name in shown}

    def tables(self) -> list[str]:
        return sorted(self._children())

    def read(self, table: str, columns: Sequence[str] | None = None) -> DataFrame:
        """One table; unread columns are pruned from the scan."""
        children = self._children()
        if table not in children:
            raise FileNotFoundError(f"no table {table} in {self.root}")
        df = self.spark.read.parquet(f"{self.root}/{children[table]}")
        return df.select(*columns) if columns else df
