"""Looking at a frame from the driver."""

from pyspark.sql.types import ArrayType, MapType, StructType


def preview(df, n=20):
    """The first ``n`` rows as a frame."""
    return df.limit(n)


def schema_rows(df, column=None):
    """The schema, or that of one struct column, as a frame: position, name, type, nullable."""
    fields = df.schema.fields if column is None else df.schema[column].dataType.fields
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(fields)]
    return df.sparkSession.createDataFrame(
        rows, "position bigint, name string, type string, nullable boolean"
    )


def _walk(name, kind, nullable, depth):
    """A column and all that is nested in it: path, type, whether it may be NULL, depth."""
    yield name, kind.simpleString() if not isinstance(kind, _NESTED) else kind.typeName(), nullable, depth
    if isinstance(kind, StructType):
        for field in kind.fields:
            yield from _walk(f"{name}.{field.name}", field.dataType, field.nullable, depth + 1)
    elif isinstance(kind, ArrayType):
        yield from _walk(f"{name}[]", kind.elementType, kind.containsNull, depth + 1)
    elif isinstance(kind, MapType):
        yield from _walk(f"{name}{{key}}", kind.keyType, False, depth + 1)
        yield from _walk(f"{name}{{value}}", kind.valueType, kind.valueContainsNull, depth + 1)


_NESTED = (StructType, ArrayType, MapType)


def nested_schema_rows(df):
    """The schema with all that is nested, as a frame: position, path, type, nullable, depth.

    A field of a struct is ``a.b``, the elements of an array ``a[]``, keys and values of a map
    ``a{key}`` and ``a{value}``; a nested type goes by its kind alone.
    """
    found = [row for f in df.schema.fields for row in _walk(f.name, f.dataType, f.nullable, 0)]
    rows = [(i, *row) for i, row in enumerate(found)]
    return df.sparkSession.createDataFrame(
        rows, "position bigint, path string, type string, nullable boolean, depth int")
