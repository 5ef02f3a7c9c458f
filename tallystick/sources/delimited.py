"""Delimited files in and out, with the day-first dates and NULL rule of the data model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystick.functions.calendar import DAY_FIRST
from tallystick.sources.tables import SPECS, Tables, TableSpec, spec_of

# On reading, an unquoted empty field is NULL while a quoted one is an empty text.
# Spark tells them apart only if its NULL marker cannot occur as a value.
_NULL_MARKER = "\u0001\u0002NULL\u0002\u0001"


def read_moment(text: Column) -> Column:
    """Day-first (``23.08.2018 0:47:37``) or ISO text to a timestamp without zone, else NULL."""
    return F.regexp_replace(F.trim(text), DAY_FIRST, "$3-$2-$1").try_cast("timestamp_ntz")


def parse_moment(text: Column) -> Column:
    """The same; any other text fails the job."""
    trimmed, parsed = F.trim(text), read_moment(text)
    refused = F.raise_error(F.concat(F.lit("not a date: "), trimmed)).cast("timestamp_ntz")
    return F.when(trimmed.isNotNull() & parsed.isNull(), refused).otherwise(parsed)


def csv_options(delimiter: str) -> dict[str, str]:
    return {"sep": delimiter, "quote": '"', "escape": '"', "nullValue": _NULL_MARKER, "emptyValue": ""}


def read_delimited(
    spark: SparkSession,
    spec: TableSpec,
    path: str,
    delimiter: str = "\t",
    money: T.DataType | None = None,
    multiline: bool = False,
) -> DataFrame:
    """Headerless positional file to a typed frame; a malformed row fails the job.

    ``multiline`` admits line breaks inside quoted fields, at the price of one task per
    file; leave it off for large files.
    """
    raw = (
        spark.read.schema(spec.schema(money, as_text=True))
        .options(**csv_options(delimiter))
        .option("header", False)
        .option("mode", "FAILFAST")
        .option("multiLine", multiline)
        .csv(path)
    )
    return raw.select(
        *[
            parse_moment(F.col(c.name)).alias(c.name) if c.kind == "moment" else F.col(c.name)
            for c in spec.columns
        ]
    )


def write_delimited(df: DataFrame, path: str, delimiter: str = "\t", mode: str = "error") -> None:
    """One part file per partition; NULL as nothing, moments as ISO text."""
    (
        df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
        .write.mode(mode)
        .option("sep", delimiter)
        .option("header", False)
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", "")
        .option("emptyValue", '""')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


class TableStore:
    """The input tables as Parquet folders below one root."""

    def __init__(self, spark: SparkSession, root: str, money: T.DataType | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.money = money

    def _folder(self, table_name: str) -> str:
        return f"{self.root}/{spec_of(table_name).name}"

    def import_data(
        self, table_name: str, file_path: str, delimiter: str = "\t", multiline: bool = False
    ) -> None:
        """Append a delimited file to a table."""
        read_delimited(
            self.spark, spec_of(table_name), file_path, delimiter, self.money, multiline
        ).write.mode("append").parquet(self._folder(table_name))

    def export_data(
        self, table_name: str, file_path: str, delimiter: str = "\t", mode: str = "overwrite"
    ) -> None:
        """Write a table as a folder of delimited part files; by default replaces an older one."""
        write_delimited(self.table(table_name), file_path, delimiter, mode)

    def load_all(self, folder: str, mini: bool = True, delimiter: str = "\t") -> None:
        """Append the eight shipped files, parents before children."""
        for name, spec in SPECS.items():
            small = mini and name != "analysis_formation"
            stem = f"{spec.file_stem}_Mini" if small else spec.file_stem
            self.import_data(name, f"{folder.rstrip('/')}/{stem}.tsv", delimiter)

    def table(self, table_name: str) -> DataFrame:
        schema = spec_of(table_name).schema(self.money)
        return self.spark.read.schema(schema).parquet(self._folder(table_name))

    def tables(self) -> Tables:
        return Tables(**{name: self.table(name) for name in SPECS})


def read_analysis_date(analysis_formation: DataFrame):
    """The single analysis moment; more than one row is an error."""
    rows = analysis_formation.limit(2).collect()
    if len(rows) != 1:
        raise ValueError("analysis_formation must hold exactly one row")
    return rows[0][0]
