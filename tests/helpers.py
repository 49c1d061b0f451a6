"""Small tables for the operators' tests."""

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def rows(df: DataFrame, *columns: str) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


def fill(value, kind):
    """A nested value with all fields, and numbers as the decimals the type asks for."""
    from decimal import Decimal

    from pyspark.sql import types as T

    if value is None:
        return None
    if isinstance(kind, T.StructType):
        return {f.name: fill(value.get(f.name), f.dataType) for f in kind.fields}
    if isinstance(kind, T.ArrayType):
        return [fill(v, kind.elementType) for v in value]
    return Decimal(value) if isinstance(kind, T.DecimalType) else value


def filled(spark, ddl: str, rows: list[tuple]):
    from pyspark.sql import types as T

    schema = T.StructType.fromDDL(ddl)
    return spark.createDataFrame([tuple(fill(v, f.dataType) for v, f in zip(r, schema.fields)) for r in rows], schema)
