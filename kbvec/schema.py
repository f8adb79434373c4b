"""Column layout of the vector table and conformance of older or foreign frames to it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

STORAGE_TYPES = {"float32": T.FloatType(), "int8": T.ByteType()}

# Column defaults of the vector table.
DEFAULT_TENANT = "default"
DEFAULT_ROLE = "public"
DEFAULT_TYPE = "content"

KEY = "vector_id"
TENANT = "bot_id"

KB_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("source_url", T.StringType()),
    T.StructField("article_content", T.StringType()),
    T.StructField("embedding_vector", T.StringType()),
    T.StructField("role_restriction", T.StringType()),
    T.StructField("content_type", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("bot_id", T.StringType()),
])

EXPORT_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("values", T.ArrayType(T.DoubleType())),
    T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
])


def vector_schema(storage: str = "float32") -> T.StructType:
    """The vector table; timestamps carry no zone, as in the source system."""
    if storage not in STORAGE_TYPES:
        raise ValueError(f"storage must be one of {sorted(STORAGE_TYPES)}, got {storage!r}")
    return T.StructType([
        T.StructField("vector_id", T.StringType(), False),
        T.StructField("bot_id", T.StringType()),
        T.StructField("embedding", T.ArrayType(STORAGE_TYPES[storage])),
        T.StructField("content", T.StringType()),
        T.StructField("source_url", T.StringType()),
        T.StructField("role_restriction", T.StringType()),
        T.StructField("content_type", T.StringType()),
        T.StructField("chunk_index", T.IntegerType()),
        T.StructField("total_chunks", T.IntegerType()),
        T.StructField("is_chunked", T.BooleanType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("updated_at", T.TimestampNTZType()),
    ])


def default_columns(now: Column | None = None) -> dict[str, Column]:
    """Replacement for a missing or null value, per column; columns not named stay null."""
    stamp = F.localtimestamp() if now is None else now
    return {
        "bot_id": F.lit(DEFAULT_TENANT),
        "content": F.lit(""),
        "source_url": F.lit(""),
        "role_restriction": F.lit(DEFAULT_ROLE),
        "content_type": F.lit(DEFAULT_TYPE),
        "is_chunked": F.lit(False),
        "created_at": stamp,
        "updated_at": stamp,
    }


def _castable(have: T.DataType, want: T.DataType) -> bool:
    numeric = (T.NumericType, T.StringType)
    if type(have) is type(want) and not isinstance(want, T.ArrayType):
        return True
    if isinstance(want, T.ArrayType):
        return isinstance(have, T.ArrayType) and isinstance(have.elementType, T.NumericType)
    if isinstance(want, T.StringType):
        return isinstance(have, T.AtomicType)
    if isinstance(want, T.NumericType):
        return isinstance(have, numeric)
    if isinstance(want, T.TimestampNTZType):
        return isinstance(have, (T.TimestampType, T.DateType, T.StringType))
    if isinstance(want, T.BooleanType):
        return isinstance(have, (T.StringType, T.IntegralType))
    return False


def conform(df: DataFrame, storage: str = "float32", now: Column | None = None) -> DataFrame:
    """Bring ``df`` to the current layout: missing columns added, defaults filled, types cast.

    Matching is by name, so column order does not matter, extra columns are dropped, and a second
    pass changes nothing. A column whose type cannot hold the target's values is an error. Float
    components going into int8 storage are quantised; int8 components going into float storage are
    scaled back.
    """
    from kbvec.functions.vectors import dequantize_int8, quantize_int8

    have = {f.name: f.dataType for f in df.schema.fields}
    if KEY not in have:
        raise ValueError(f"column {KEY!r} is required")
    defaults = default_columns(now)
    out = []
    for field in vector_schema(storage).fields:
        name, want = field.name, field.dataType
        if name not in have:
            col = F.lit(None).cast(want)
        elif not _castable(have[name], want):
            raise TypeError(f"column {name!r}: cannot turn {have[name].simpleString()} "
                            f"into {want.simpleString()}")
        elif name == "embedding":
            is_float = isinstance(have[name].elementType, (T.FractionalType,))
            if storage == "int8" and is_float:
                col = quantize_int8(F.col(name))
            elif storage == "float32" and isinstance(have[name].elementType, T.ByteType):
                col = dequantize_int8(F.col(name)).cast(want)
            else:
                col = F.col(name).cast(want)
        else:
            col = F.col(name).cast(want)
        if name == TENANT:
            col = F.nullif(col, F.lit(""))
        if name in defaults:
            col = F.coalesce(col, defaults[name].cast(want))
        out.append(col.alias(name))
    return df.select(*out)
