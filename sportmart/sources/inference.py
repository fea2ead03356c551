"""Documents whose shape nobody declared: fields and types from the documents themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_variants(spark: SparkSession, path: str, column: str = "document", multi_line: bool = False) -> DataFrame:
    """Landed JSON documents, each as one VARIANT whatever it holds; one that does not parse is null. The elements of a list that
    is a whole line, or with ``multi_line`` a whole file, are documents of their own."""
    reader = spark.read.option("singleVariantColumn", column).option("mode", "PERMISSIVE")
    read = reader.option("multiLine", multi_line).json(path)
    listed = F.try_variant_get(column, "$", "array<variant>")
    return read.select(F.explode_outer(F.coalesce(listed, F.array(column))).alias(column))


def inferred_schema(documents: DataFrame, column: str = "document") -> T.StructType:
    """The fields of all documents, in order of name, with the type that holds every value.

    Tasks merge the shapes of their documents and then each other's, so one row comes to the driver. Numbers with a fraction
    anywhere are DOUBLE, fields that are null everywhere STRING, and so are fields whose values
    have no common type: their text is kept. No documents, or none that are objects, give no fields.
    """
    shape = documents.agg(F.schema_of_variant_agg(column)).first()[0]
    if not shape or not shape.startswith("OBJECT<"):
        return T.StructType([])
    # Names with brackets are quoted; what lies outside quotes are types.
    parts = [part if i % 2 else part.replace("OBJECT<", "STRUCT<") for i, part in enumerate(shape.split("`"))]
    return _plain(T.StructType.fromDDL(f"root {'`'.join(parts)}")["root"].dataType)


def _plain(dtype: T.DataType) -> T.DataType:
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(field.name, _plain(field.dataType)) for field in dtype])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_plain(dtype.elementType))
    if isinstance(dtype, T.DecimalType):
        return T.DoubleType() if dtype.scale else T.LongType()
    if isinstance(dtype, (T.VariantType, T.NullType)):
        return T.StringType()
    return dtype


def _type_text(dtype: T.DataType) -> str:
    """A type as SQL, with field names quoted."""
    if isinstance(dtype, T.StructType):
        fields = ", ".join(f"`{f.name.replace('`', '``')}`: {_type_text(f.dataType)}" for f in dtype)
        return f"STRUCT<{fields}>"
    if isinstance(dtype, T.ArrayType):
        return f"ARRAY<{_type_text(dtype.elementType)}>"
    return dtype.simpleString()


def typed(documents: DataFrame, schema: T.StructType, column: str = "document") -> DataFrame:
    """Documents as columns of a schema; a value that is not of its column's type is null there."""
    def field(name: str) -> str:
        return "$[" + '"' + name.replace("\\", "\\\\").replace('"', '\\"') + '"' + "]"

    return documents.select(
        *(F.try_variant_get(column, field(f.name), _type_text(f.dataType)).alias(f.name) for f in schema)
    )


def field_rows(schema: T.StructType, path: str = "") -> list[tuple[str, str]]:
    """Leaf fields of a schema as (path, type)."""
    rows = []
    for field in schema:
        name = f"{path}.{field.name}" if path else field.name
        if isinstance(field.dataType, T.StructType):
            rows += field_rows(field.dataType, name)
        else:
            rows.append((name, field.dataType.simpleString()))
    return rows
