"""Column types of CSV files, inferred as a data frame library would.

One pass over all rows of a file: every value has a place in the lattice
missing < integer < double < text (booleans stand beside the numbers), a column's
type is the join of its values', and joins are map-side combined counts.  Values that
read as missing by convention are missing; integers with missing values become
double, as do columns without any value; booleans with missing values are text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Texts that a data frame library's CSV reader takes as missing.
MISSING = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
           "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
_INTEGER = r"^[+-]?[0-9]+$"
_DOUBLE = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
_ENDLESS = r"^[+-]?(inf|infinity)$"


def read_text_csv(spark: SparkSession, path: str) -> DataFrame:
    """Every column as text; only the header is looked at."""
    return spark.read.option("header", True).option("nullValue", "").csv(path)


def _value(name: str) -> Column:
    c = F.trim(F.col(f"`{name}`"))
    return F.when(~c.isin(MISSING), c)


def _counts(name: str) -> Column:
    """n values, and how many of them are integers, numbers, booleans."""
    v = _value(name)
    number = F.regexp_like(v, F.lit(_DOUBLE)) | F.regexp_like(F.lower(v), F.lit(_ENDLESS))
    whole = F.regexp_like(v, F.lit(_INTEGER)) & v.try_cast("bigint").isNotNull()
    n = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    return F.struct(F.lit(name).alias("column_name"), n(v.isNotNull()).alias("n_values"), n(v.isNull()).alias("n_missing"),
                    n(whole).alias("n_integer"), n(number).alias("n_number"),
                    n(v.isin("True", "False", "TRUE", "FALSE", "true", "false")).alias("n_boolean"))


def inferred_types(df: DataFrame) -> DataFrame:
    """Of a frame of texts: position, column_name, type, n_values, n_missing."""
    one = df.agg(F.array(*[_counts(c) for c in df.columns]).alias("c"))
    v = F.col("n_values")
    kind = (F.when(v == 0, "double")
            .when((F.col("n_boolean") == v) & (F.col("n_missing") == 0), "boolean")
            .when((F.col("n_integer") == v) & (F.col("n_missing") == 0), "bigint")
            .when(F.col("n_number") == v, "double").otherwise("string"))
    rows = one.select(F.posexplode("c").alias("position", "x")).select("position", "x.*")
    return rows.select("position", "column_name", kind.alias("type"), "n_values", "n_missing")


def read_inferred(spark: SparkSession, path: str, types: DataFrame | None = None) -> DataFrame:
    """The file read by its inferred types; missing texts are NULL."""
    df = read_text_csv(spark, path)
    rows = (types if types is not None else inferred_types(df)).select("column_name", "type").collect()   # one row a column
    kinds = {r["column_name"]: r["type"] for r in rows}
    number = lambda c: F.when(F.lower(_value(c)).isin("inf", "+inf", "infinity", "+infinity"), F.lit(float("inf"))) \
        .when(F.lower(_value(c)).isin("-inf", "-infinity"), F.lit(float("-inf"))).otherwise(_value(c).try_cast("double"))
    read = {"string": lambda c: F.when(_value(c).isNotNull(), F.col(f"`{c}`")), "double": number,
            "bigint": lambda c: _value(c).try_cast("bigint"), "boolean": lambda c: F.lower(_value(c)).try_cast("boolean")}
    return df.select(*[read[kinds[c]](c).alias(c) for c in df.columns])
