"""The annotated CSV file and the annotation sheet it starts from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinara import schemas
from opinara.runtime import shuffles_go

# Comments hold line breaks, quotes and blanks at either end; all of them must survive.
CSV = {
    "header": True,
    "multiLine": True,
    "quote": '"',
    "escape": '"',
    "lineSep": "\n",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}

# Cell texts that the usual CSV tools take as missing.
MISSING = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.options(**CSV).schema(schema).csv(path)


def write_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    """Multi-line cells make a file unsplittable; each task writes a part of its own."""
    with shuffles_go(df.sparkSession):
        df.write.mode("overwrite").options(**CSV, compression=compression).csv(path)


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """Annotated rows. The file's own header decides which of the known columns it has."""
    header = spark.read.options(**CSV).csv(path).columns
    known = {f.name: f for f in schemas.struct(schemas.GOLD)}
    fields = [known.get(c, T.StructField(c, T.StringType())) for c in header]
    texts = [f.name for f in fields if isinstance(f.dataType, T.StringType)]
    gold = read_csv(spark, path, T.StructType(fields))
    return gold.withColumns(
        {c: F.when(~F.col(f"`{c}`").isin(MISSING), F.col(f"`{c}`")) for c in texts}
    )


def write_sheet(sheet: DataFrame, path: str) -> None:
    """The annotation sheet as CSV."""
    write_csv(sheet, path)
