"""Column types found from the data of delimited text, as an aggregate over all rows.

Every cell has a kind: missing (empty or ``NA``), logical, 32-bit integer, 64-bit
integer, number, text. The kinds seen in a column are the bits of one number, so
they merge by ``bit_or`` in any order and a single late cell promotes its
column, whichever file and task holds it. The type is the narrowest one that holds
all kinds seen:

- only missing cells, or logical ones: ``boolean``
- integers: ``int``, ``bigint`` if one is beyond 32 bits, ``double`` if one is beyond 64
- other numbers (also ``Inf``, ``NaN``): ``double``, together with integers of any size
- text, or logical cells beside numbers: ``string``

Quotes do not count: a quoted number is a number. One scan, one partial aggregate
row a task, no shuffle of the data. A file without rows gives ``boolean`` columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOGICAL, INT, BIGINT, NUMBER, TEXT = 1, 2, 4, 8, 16

# fixed values: how cells are written
MISSING = ("", "NA")
LOGICALS = ("TRUE", "FALSE", "True", "False", "true", "false")
INTEGER = r"^[+-]?[0-9]+$"
DECIMAL = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
SPECIAL = ("Inf", "-Inf", "+Inf", "NaN")


def _cells(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text; only the header line is read for the names."""
    return spark.read.option("header", True).option("escape", '"').option("multiLine", False).csv(path)


def is_missing(cell):
    return cell.isNull() | F.trim(cell).isin(*MISSING)


def cell_kind(cell):
    """The bit of a cell's kind; 0 if it is missing."""
    bare = F.trim(cell)
    integer = (F.when(bare.try_cast("int").isNotNull(), INT).when(bare.try_cast("bigint").isNotNull(), BIGINT)
               .otherwise(NUMBER))
    return (F.when(is_missing(cell), 0).when(bare.rlike(INTEGER), integer)
            .when(bare.rlike(DECIMAL) | bare.isin(*SPECIAL), NUMBER).when(bare.isin(*LOGICALS), LOGICAL).otherwise(TEXT))


def type_of(kinds):
    """The narrowest type that holds all kinds of a mask."""
    def has(bits: int):
        return kinds.bitwiseAND(F.lit(bits)) != 0
    numeric = INT | BIGINT | NUMBER
    return (F.when(has(TEXT) | (has(LOGICAL) & has(numeric)), "string").when(has(NUMBER), "double")
            .when(has(BIGINT), "bigint").when(has(INT), "int").otherwise("boolean"))


def found_types(spark: SparkSession, path: str) -> DataFrame:
    """``position, column, type, n_missing`` of the CSV files (with header) under ``path``."""
    cells = _cells(spark, path)
    kinds, missing = [], []
    for i, name in enumerate(cells.columns):
        cell = F.col(f"`{name}`")
        kinds.append(F.coalesce(F.bit_or(cell_kind(cell)), F.lit(0)).alias(f"k{i}"))
        missing.append(F.count_if(is_missing(cell)).alias(f"m{i}"))
    wide = cells.agg(*kinds, *missing)
    columns = [F.struct(F.lit(i + 1).cast("long").alias("position"), F.lit(name).alias("column"),
                        type_of(F.col(f"k{i}")).alias("type"), F.col(f"m{i}").alias("n_missing"))
               for i, name in enumerate(cells.columns)]
    return wide.select(F.inline(F.array(*columns)))


def read_found(spark: SparkSession, path: str) -> DataFrame:
    """The CSV files under ``path`` with the types found; missing cells are NULL."""
    types = [(r["column"], r["type"]) for r in found_types(spark, path).orderBy("position").collect()]
    out = []
    for name, dtype in types:
        cell = F.col(f"`{name}`")
        # fixed spelling of the special numbers in Spark's casts
        bare = F.regexp_replace(F.trim(cell), "^([+-]?)Inf$", "$1Infinity") if dtype == "double" else F.trim(cell)
        value = cell if dtype == "string" else bare.cast(dtype)
        out.append(F.when(~is_missing(cell), value).alias(name))
    return _cells(spark, path).select(*out)
