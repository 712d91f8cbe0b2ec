"""Raw CSV inputs: declared schemas, repairs on load, presence check."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions.numbers import finite
from martloom.schemas import MULTI_LINE, RAW_DDL, RAW_RENAMES, raw_schema


BROKEN = "_broken_line"


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, line_breaks: bool = False) -> DataFrame:
    """Headed CSV; nothing is inferred, so ``01310`` stays text.

    A file is split among tasks unless its texts may hold quoted ``line_breaks``: then one task reads it whole. The
    text of a line that does not fit the schema is kept in ``_broken_line`` where the schema has that column.
    """
    return spark.read.schema(schema).csv(
        path, header=True, multiLine=line_breaks, quote='"', escape='"', columnNameOfCorruptRecord=BROKEN
    )


def rename_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def finite_columns(df: DataFrame) -> DataFrame:
    """NaN and infinite numbers become NULL; for inputs that come typed, as from parquet."""
    kinds = (T.DoubleType, T.FloatType)
    broken = {f.name: finite(f.name) for f in df.schema.fields if isinstance(f.dataType, kinds)}
    return df.withColumns(broken) if broken else df


def normalize_strings(df: DataFrame) -> DataFrame:
    """Text columns lose their NULLs, booleans become ``True``/``False``, NaN becomes NULL."""

    def repaired(field: T.StructField):
        c = F.col(field.name)
        if isinstance(field.dataType, T.StringType):
            return F.coalesce(c, F.lit(""))
        if isinstance(field.dataType, T.BooleanType):
            return F.coalesce(F.initcap(c.cast("string")), F.lit(""))
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            return finite(c)
        return c

    return df.select(*[repaired(f).alias(f.name) for f in df.schema.fields])


def read_typed(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One raw input with declared types and corrected names, blanks still missing, and ``_broken_line``."""
    schema = raw_schema(name).add(BROKEN, "string")
    df = read_csv(spark, f"{folder.rstrip('/')}/{name}.csv", schema, name in MULTI_LINE)
    return rename_columns(df, RAW_RENAMES.get(name, {}))


def read_raw(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One raw input, typed, renamed and repaired. Lines that do not fit are for the quality gate to find."""
    return normalize_strings(read_typed(spark, folder, name).drop(BROKEN))


def require_inputs(spark: SparkSession, folder: str, names=tuple(RAW_DDL), suffix: str = ".csv") -> None:
    """Fail before any work starts, naming every missing input."""
    missing = []
    for name in names:
        try:
            # resolves the path on any file system Spark can reach, without reading the data
            spark.read.schema("value string").text(f"{folder.rstrip('/')}/{name}{suffix}")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            missing.append(name + suffix)
    if missing:
        raise FileNotFoundError(f"missing in {folder}: {', '.join(missing)}")


def read_all_raw(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    require_inputs(spark, folder)
    return {name: read_raw(spark, folder, name) for name in RAW_DDL}


def read_all_typed(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All raw inputs before their repair, for the quality gate."""
    require_inputs(spark, folder)
    return {name: read_typed(spark, folder, name) for name in RAW_DDL}
