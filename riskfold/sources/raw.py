"""Raw files: what is there, and CSV with a defined result for every bad row.

* :func:`inventory` holds an expected list of tables against the file system's listing; an absent one is a row with
  ``exists = false``.  Any store that Spark reads will do.
* :func:`read_csv_checked` keeps every line: a row that does not fit the schema has NULLs and its raw text in
  ``rejected_line``.  :func:`reject_counts` counts them by file, :func:`accepted` leaves the good ones.
* :func:`read_descriptions` is the documentation table: Latin-1, renamed and projected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskfold.operators.profile import key_columns, table_profile

REJECTED = "rejected_line"

# The documentation file's columns and what they are called here.
DESCRIPTION_COLUMNS = {"Table": "source_table_doc", "Row": "column", "Description": "description", "Special": "special"}


def listed_size(spark: SparkSession, path: str) -> int | None:
    """Bytes of a file, or of all files of a folder; None if there is nothing at ``path``."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(at).getLength()) if fs.exists(at) else None


def inventory(spark: SparkSession, expected: Mapping[str, str], label: str = "TARGET") -> DataFrame:
    """A row for each expected Parquet table: table, exists, rows, columns, file_mb, key_columns, has_target, bad_count, bad_rate.

    ``expected`` maps names to paths (a file or a folder of part files).  Counts and label statistics are one
    aggregate a table; an absent table has NULLs and an empty list of keys.
    """
    sizes = {name: listed_size(spark, path) for name, path in expected.items()}
    here = {name: spark.read.parquet(expected[name]) for name, size in sizes.items() if size is not None}
    found = table_profile(here, {n: sizes[n] / 1024 / 1024 for n in here}) if here else None
    schema = T.StructType(
        [T.StructField("table", T.StringType()), T.StructField("exists", T.BooleanType()), T.StructField("rows", T.LongType()), T.StructField("columns", T.LongType()),
         T.StructField("file_mb", T.DoubleType()), T.StructField("key_columns", T.StringType()), T.StructField("has_target", T.BooleanType()),
         T.StructField("bad_count", T.LongType()), T.StructField("bad_rate", T.DoubleType())]
    )
    absent = spark.createDataFrame([(n, False, None, None, None, key_columns([]), False, None, None) for n, s in sizes.items() if s is None], schema)
    return absent if found is None else found.unionByName(absent)


def read_csv_checked(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str, encoding: str = "UTF-8", multi_line: bool = False) -> DataFrame:
    """CSV with a header by an explicit schema, plus ``rejected_line`` and ``source_file``.

    A line with too few or too many values, or with a value that is not of its column's type, is a rejected one:
    its text is in ``rejected_line`` (NULL for good rows), what could be read is in its columns.  All columns are
    parsed whatever is selected later, so the same lines are rejected for every projection.  ``multi_line`` reads
    quoted line ends as part of a value; without it files are split between tasks.
    """
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    whole = T.StructType([*fields.fields, T.StructField(REJECTED, T.StringType())])
    rows = (
        spark.read.schema(whole).option("header", "true").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", REJECTED)
        .option("encoding", encoding).option("multiLine", str(multi_line).lower()).option("columnPruning", "false").option("escape", '"')
        .csv(path if isinstance(path, str) else list(path))
    )
    # Spark converts, and so rejects, only the columns that a query reads: this reads them all
    nothing = F.substring(F.concat_ws("", *[F.col(f"`{c}`").cast("string") for c in fields.names]), 1, 0)
    return rows.withColumns({REJECTED: F.concat(REJECTED, nothing), "source_file": F.regexp_extract(F.input_file_name(), "([^/]+)$", 1)})


def accepted(rows: DataFrame) -> DataFrame:
    """The good rows of :func:`read_csv_checked`, with the schema's columns only."""
    return rows.filter(F.col(REJECTED).isNull()).drop(REJECTED, "source_file")


def reject_counts(rows: DataFrame) -> DataFrame:
    """(source_file, rows, rejected): how many lines of each file do not fit."""
    return rows.groupBy("source_file").agg(F.count(F.lit(1)).alias("rows"), F.count(REJECTED).alias("rejected"))


def write_csv(df: DataFrame, path: str, encoding: str = "UTF-8") -> None:
    """A CSV folder with a header; quotes, separators and line ends inside values are quoted."""
    df.write.mode("overwrite").option("header", "true").option("encoding", encoding).option("escape", '"').option("quoteAll", "true").csv(path)


def read_descriptions(spark: SparkSession, path: str, tables: Mapping[str, str]) -> DataFrame:
    """(table, column, description, special) from a documentation file; of several entries of a column the least counts.

    ``tables`` maps our table names to those that the file uses (several may share one).
    """
    raw = spark.read.option("header", "true").option("encoding", "ISO-8859-1").option("multiLine", "true").option("escape", '"').csv(path)
    doc = raw.select(*[F.col(f"`{c}`").alias(n) for c, n in DESCRIPTION_COLUMNS.items()])
    names = spark.createDataFrame(list(tables.items()), "table string, source_table_doc string")
    once = doc.groupBy("source_table_doc", "column").agg(F.min_by(F.struct("description", "special"), F.coalesce("description", F.lit(""))).alias("d"))
    return once.join(names, "source_table_doc").select("table", "column", F.coalesce("d.description", F.lit("")).alias("description"), F.coalesce("d.special", F.lit("")).alias("special"))
