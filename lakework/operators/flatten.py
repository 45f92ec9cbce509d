"""Nested documents to flat tables.

The column list is worked out on the driver from the schema alone; rows are
touched once, in a single projection (plus one generator per array).
"""

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType

from lakework.functions.columns import quoted


class FlattenError(ValueError):
    """The document cannot be flattened into distinct, bounded columns."""


@dataclass
class Node:
    """A column still to be placed: output name, expression, type, arrays it came out of."""

    name: str
    value: Column
    type: DataType
    depth: int = 0


def _roots(df):
    return [Node(f.name, F.col(quoted(f.name)), f.dataType) for f in df.schema.fields]


def _struct_children(node, sep):
    return [
        Node(f"{node.name}{sep}{f.name}", node.value.getField(f.name), f.dataType, node.depth)
        for f in node.type.fields
    ]


def _map_children(node, keys, sep):
    return [
        Node(
            f"{node.name}{sep}{key}",
            F.try_element_at(node.value, F.lit(key).cast(node.type.keyType)),
            node.type.valueType,
            node.depth,
        )
        for key in keys
    ]


def _other_entries(node, keys, sep, name):
    """The entries of a map under none of ``keys`` as JSON text, NULL where there are none."""
    named = F.array(*[F.lit(key).cast(node.type.keyType) for key in keys])
    others = F.map_filter(node.value, lambda key, _: ~F.array_contains(named, key)) if keys else node.value
    text = F.when(F.size(others) > 0, F.to_json(others))
    return Node(f"{node.name}{sep}{name}", text, StringType(), node.depth)


def map_rows(df, columns, entries, key="key", value="value"):
    """A map column in long form: ``columns`` and one row per entry.

    For open key sets, which would make too many columns: no job looks for keys and
    none is bounded. Null and empty maps have no rows; an entry with a NULL value has one.
    """
    return df.select(*[F.col(quoted(c)) for c in columns], F.explode(quoted(entries)).alias(key, value))


def map_key_sets(df, columns, max_keys=None):
    """The sorted distinct keys of each map column, all found in one job.

    Keys come back as text. With ``max_keys``, a map with more keys is an error; data with
    very many of them is better read by ``map_rows``.
    """
    def tagged(number, column):
        keys = F.coalesce(F.map_keys(column), F.array())
        return F.transform(
            keys, lambda key: F.struct(F.lit(number).alias("map"), key.cast("string").alias("key"))
        )

    entries = F.concat(*[tagged(i, column) for i, column in enumerate(columns)])
    distinct = df.select(F.explode(entries).alias("entry")).select("entry.map", "entry.key").distinct()
    if max_keys is not None:
        distinct = distinct.limit(max_keys * len(columns) + 1)
    found = distinct.collect()
    keys = [sorted(row["key"] for row in found if row["map"] == i) for i in range(len(columns))]
    if max_keys is not None and (
            max(map(len, keys)) > max_keys or len(found) > max_keys * len(columns)):
        raise FlattenError(f"a map column has more than {max_keys} distinct keys")
    return keys


def _maps_in(nodes, sep):
    """The map columns among ``nodes`` and inside their structs."""
    maps = []
    for node in nodes:
        if isinstance(node.type, MapType):
            maps.append(node)
        elif isinstance(node.type, StructType):
            maps += _maps_in(_struct_children(node, sep), sep)
    return maps


def _select(df, nodes):
    fold = str if df.sparkSession.conf.get("spark.sql.caseSensitive") == "true" else str.lower
    seen = set()
    for node in nodes:
        if fold(node.name) in seen:
            raise FlattenError(f"two columns would be named {node.name!r}")
        seen.add(fold(node.name))
    return df.select(*[node.value.alias(node.name) for node in nodes])


def _explode(df, nodes, positions):
    """Turn the arrays at ``positions`` into rows; several are walked in step."""
    carried = [
        node.value.alias(f"_{i}") for i, node in enumerate(nodes) if i not in positions
    ]
    if len(positions) == 1:
        rows = df.select(*carried, F.explode_outer(nodes[positions[0]].value).alias(f"_{positions[0]}"))
        element = {positions[0]: F.col(f"_{positions[0]}")}
    else:
        arrays = [F.coalesce(nodes[p].value, F.array()).alias(f"_{p}") for p in positions]
        staged = df.select(*carried, *arrays)
        zipped = F.arrays_zip(*[F.col(f"_{p}") for p in positions])
        rows = staged.select(
            *[f"_{i}" for i in range(len(nodes)) if i not in positions],
            F.explode_outer(zipped).alias("_zip"),
        )
        element = {p: F.col("_zip").getField(f"_{p}") for p in positions}
    placed = [
        Node(
            node.name,
            element.get(i, F.col(f"_{i}")),
            node.type.elementType if i in positions else node.type,
            node.depth + (i in positions),
        )
        for i, node in enumerate(nodes)
    ]
    return rows, placed


def flatten(df, sep="_", explode_arrays=True, zip_arrays=False, combine_arrays=False,
            map_keys=None, other_keys="others", max_map_keys=None):
    """Structs and maps to columns and arrays to rows until only scalars are left.

    Scalars keep their place; the children of a struct or map go to the end of
    the list under ``parent<sep>child``. Arrays are exploded where they stand,
    empty and null ones keeping a row with NULL. Of two arrays in one row, ``zip_arrays``
    pairs the elements by position and ``combine_arrays`` gives every combination; without
    either they are an error, as the rows would multiply. An array inside the elements of
    another is walked in any case. With ``explode_arrays=False`` arrays stay as JSON text.

    ``map_keys`` names the keys of a map column (by output name) and so saves the
    job that looks for them; entries under other keys are kept as JSON text in
    ``<map><sep><other_keys>``, unless ``other_keys`` is None.
    """
    known, declared = dict(map_keys or {}), set(map_keys or {})
    nodes = _roots(df)
    at = exploded = 0
    while at < len(nodes):
        node = nodes[at]
        if isinstance(node.type, StructType):
            nodes[at:at + 1] = []
            nodes += _struct_children(node, sep)
        elif isinstance(node.type, MapType):
            if node.name not in known:
                maps = [n for n in _maps_in(nodes[at:], sep) if n.name not in known]
                found = map_key_sets(df, [n.value for n in maps], max_map_keys)
                known.update(zip((n.name for n in maps), found))
            nodes[at:at + 1] = []
            nodes += _map_children(node, known[node.name], sep)
            if node.name in declared and other_keys is not None:
                nodes.append(_other_entries(node, known[node.name], sep, other_keys))
        elif isinstance(node.type, ArrayType) and explode_arrays:
            positions = [at]
            if zip_arrays:
                positions = [i for i, n in enumerate(nodes) if isinstance(n.type, ArrayType)]
            elif node.depth < exploded and not combine_arrays:
                raise FlattenError(
                    f"{node.name!r} is a second array in a row: pass zip_arrays or combine_arrays")
            exploded += 1
            df, nodes = _explode(df, nodes, positions)
        elif isinstance(node.type, ArrayType):
            nodes[at] = Node(node.name, F.to_json(node.value), None)
            at += 1
        else:
            at += 1
    return _select(df, nodes)


def normalize(df, sep=".", max_map_keys=None):
    """Structs and maps to ``parent.child`` columns, arrays kept as JSON text.

    Top-level scalars and arrays come first, then each nested column depth first.
    """
    known = {}

    def leaves(node, unknown):
        if isinstance(node.type, StructType):
            children = _struct_children(node, sep)
        elif isinstance(node.type, MapType):
            if node.name not in known:
                unknown.append(node)
                return []
            children = _map_children(node, known[node.name], sep)
        elif isinstance(node.type, ArrayType):
            return [Node(node.name, F.to_json(node.value), None)]
        else:
            return [node]
        return [leaf for child in children for leaf in leaves(child, unknown)]

    # Nested maps show their inner keys only once the outer ones are known:
    # one job per level of map nesting.
    while True:
        unknown = []
        roots = sorted(_roots(df), key=lambda n: isinstance(n.type, (StructType, MapType)))
        placed = [leaf for root in roots for leaf in leaves(root, unknown)]
        if not unknown:
            return _select(df, placed)
        found = map_key_sets(df, [n.value for n in unknown], max_map_keys)
        known.update(zip((n.name for n in unknown), found))
