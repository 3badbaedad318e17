"""Column names and types of a headless file, from the text of its table definition."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

COLUMN = r"^\s*(\S+)\s+([A-Za-z]\w*(?:\s*\([^)]*\))?)"


def read_ddl(spark: SparkSession, path: str) -> DataFrame:
    """Columns of one definition file: ``ordinal, name, ddl_type, not_null``.

    The first line, lines equal to it, blank lines and the closing line are left out.
    A name given twice keeps its first position.
    """
    text = spark.read.text(path, wholetext=True)
    lines = text.select(F.split("value", r"\r?\n").alias("lines")).select(
        F.filter("lines", lambda line: (line != F.get("lines", F.lit(0))) & (F.trim(line) != "")).alias("body")
    )
    columns = lines.select(
        F.posexplode(F.slice("body", 1, F.greatest(F.size("body") - 1, F.lit(0)))).alias("ordinal", "line")
    ).select(
        "ordinal",
        F.regexp_extract("line", COLUMN, 1).alias("name"),
        F.regexp_extract("line", COLUMN, 2).alias("ddl_type"),
        F.upper("line").contains("NOT NULL").alias("not_null"),
    )
    first = Window.partitionBy("name").orderBy("ordinal")
    return columns.withColumn("_nth", F.row_number().over(first)).filter("_nth = 1").drop("_nth")


# Types by the name a definition gives them; those with digits are decided below.
PLAIN_TYPES = {
    "float": T.DoubleType(),
    "double": T.DoubleType(),
    "real": T.DoubleType(),
    "char": T.StringType(),
    "varchar": T.StringType(),
    "varchar2": T.StringType(),
    "text": T.StringType(),
    "string": T.StringType(),
    "tinyint": T.ShortType(),
    "smallint": T.ShortType(),
    "int": T.IntegerType(),
    "integer": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
    "datetime": T.TimestampNTZType(),
}
# Name of a field that stands for a column that is left out.
SKIPPED = "_skipped_"


def spark_type(ddl_type: str, strict: bool = False) -> T.DataType:
    """Spark type of a column; ``strict`` keeps 19-digit numbers exact beyond a long.

    A type that is not known is read as text, so a definition never stops a job.
    """
    found = re.fullmatch(r"\s*(\w+)\s*(?:\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\))?\s*", ddl_type)
    if not found:
        return T.StringType()
    name, digits, scale = found[1].lower(), int(found[2] or 0), int(found[3] or 0)
    if name in ("decimal", "numeric"):
        digits = digits or 10
        return T.DecimalType(digits, scale) if digits <= 38 and scale <= digits else T.StringType()
    if name == "number":
        if scale or (strict and digits > 18) or digits > 19:
            return T.DecimalType(digits, scale) if digits <= 38 and scale <= digits else T.StringType()
        if digits > 9:
            return T.LongType()
        return T.IntegerType() if digits > 4 else T.ShortType()
    return PLAIN_TYPES.get(name, T.StringType())


def column_positions(columns: DataFrame) -> dict[str, int]:
    """Position of every column in a line. One row per column of the file is fetched."""
    return {c.name: c.ordinal for c in columns.select("name", "ordinal").collect()}


def ddl_schema(columns: DataFrame, strict: bool = False) -> T.StructType:
    """The schema for a typed read. One row per column of the file is fetched.

    A position whose line repeats an earlier name gets a text field that the reader
    drops, so that later columns keep their places.
    """
    fields: list[T.StructField] = []
    for c in columns.orderBy("ordinal").collect():
        while len(fields) < c.ordinal:
            fields.append(T.StructField(f"{SKIPPED}{len(fields)}", T.StringType()))
        fields.append(T.StructField(c.name, spark_type(c.ddl_type, strict), not c.not_null))
    return T.StructType(fields)
