"""Visit every string in a nested column, following its schema at plan time.

Shape, keys, numbers, booleans and nulls are left as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veildesk.functions.patterns import match_pieces, running_totals
from veildesk.functions.text import let


def holds_strings(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(holds_strings(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return holds_strings(kind.elementType)
    if isinstance(kind, T.MapType):
        return holds_strings(kind.valueType)
    return isinstance(kind, (T.StringType, T.VariantType))


def map_strings(col: Column, kind: T.DataType, fn: Callable[[Column], Column]) -> Column:
    """The same value with ``fn`` applied to every string leaf."""
    if not holds_strings(kind):
        return col
    if isinstance(kind, T.StructType):
        fields = [map_strings(col[f.name], f.dataType, fn).alias(f.name) for f in kind.fields]
        return F.when(col.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        return F.transform(col, lambda x: map_strings(x, kind.elementType, fn))
    if isinstance(kind, T.MapType):
        return F.transform_values(col, lambda _, v: map_strings(v, kind.valueType, fn))
    if isinstance(kind, T.VariantType):
        return F.parse_json(map_json_strings(F.to_json(col), fn))
    return fn(col)


def string_leaves(col: Column, kind: T.DataType) -> Column:
    """All string leaves in traversal order, nulls left out."""
    return F.filter(all_leaves(col, kind), lambda s: s.isNotNull())


def _fixed_leaves(kind: T.DataType) -> int | None:
    """How many leaves every value of the type has, or None if that depends on the value."""
    if not holds_strings(kind):
        return 0
    if isinstance(kind, T.StructType):
        parts = [_fixed_leaves(f.dataType) for f in kind.fields]
        return None if None in parts else sum(parts)
    return None if isinstance(kind, (T.ArrayType, T.MapType, T.VariantType)) else 1


def leaf_count(col: Column, kind: T.DataType) -> Column | int:
    """The size of ``all_leaves``; a number where the type alone tells it."""
    fixed = _fixed_leaves(kind)
    if fixed is not None:
        return fixed
    if isinstance(kind, T.StructType):
        return sum((leaf_count(col[f.name], f.dataType) for f in kind.fields), 0)
    if isinstance(kind, T.VariantType):
        return F.when(col.isNull(), 0).otherwise(F.size(json_strings(F.to_json(col))))
    inner = kind.elementType if isinstance(kind, T.ArrayType) else kind.valueType
    values = col if isinstance(kind, T.ArrayType) else F.map_values(col)
    fixed = _fixed_leaves(inner)
    if fixed is not None:
        count = F.size(values) * fixed
    else:
        each = F.transform(values, lambda x: leaf_count(x, inner))
        count = F.aggregate(each, F.lit(0), lambda total, n: total + n)
    return F.when(col.isNull(), 0).otherwise(count)


def map_leaves(
    col: Column, kind: T.DataType, at: Column | int, fn: Callable[[Column, Column | int], Column]
) -> Column:
    """The same value with ``fn(leaf, place)`` for every string leaf.

    ``place`` is the leaf's place in ``all_leaves`` plus ``at``, found from the sizes of what
    stands before it, so that nothing has to be searched for. ``fn`` keeps nulls.
    """
    if not holds_strings(kind):
        return col
    if isinstance(kind, T.StructType):
        fields = []
        for f in kind.fields:
            fields.append(map_leaves(col[f.name], f.dataType, at, fn).alias(f.name))
            at = at + leaf_count(col[f.name], f.dataType)
        return F.when(col.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        return _map_elements(col, kind.elementType, at, fn)
    if isinstance(kind, T.MapType):
        values = _map_elements(F.map_values(col), kind.valueType, at, fn)
        return F.when(col.isNotNull(), F.map_from_arrays(F.map_keys(col), values))
    if isinstance(kind, T.VariantType):
        return F.parse_json(_map_json_leaves(F.to_json(col), lambda s, i: fn(s, i + at)))
    return fn(col, at)


def _map_elements(values: Column, kind: T.DataType, at: Column | int, fn: Callable) -> Column:
    fixed = _fixed_leaves(kind)
    if fixed is not None:
        return F.transform(values, lambda x, i: map_leaves(x, kind, i * fixed + at, fn))
    sizes = F.transform(values, lambda x: F.lit(leaf_count(x, kind)).cast("int"))
    return let(
        running_totals(sizes),
        lambda ends: F.transform(
            values,
            lambda x, i: map_leaves(x, kind, F.coalesce(F.get(ends, i - 1), F.lit(0)) + at, fn),
        ),
    )


def all_leaves(col: Column, kind: T.DataType) -> Column:
    """All string leaves in traversal order; a null string is a null leaf, a null array or map
    has none."""
    if not holds_strings(kind):
        return F.array().cast("array<string>")
    if isinstance(kind, T.StructType):
        found = F.concat(*[all_leaves(col[f.name], f.dataType) for f in kind.fields])
    elif isinstance(kind, T.ArrayType):
        found = F.flatten(F.transform(col, lambda x: all_leaves(x, kind.elementType)))
    elif isinstance(kind, T.MapType):
        found = F.flatten(F.transform(F.map_values(col), lambda x: all_leaves(x, kind.valueType)))
    elif isinstance(kind, T.VariantType):
        found = json_strings(F.to_json(col))
    else:
        return F.array(col)
    return F.coalesce(found, F.array().cast("array<string>"))


# Values of unknown schema (variant columns) are walked as JSON text: its string literals
# are the odd pieces, and those followed by a colon are keys.


def _literals(body: Column) -> Column:
    return match_pieces(body, '"(?:[^"\\\\]|\\\\.)*+"')


def _is_value(pieces: Column, at: Column) -> Column:
    return (at % 2 == 1) & ~F.startswith(F.get(pieces, at + 1), F.lit(":"))


def _decoded(literal: Column) -> Column:
    return F.from_json(F.concat(F.lit("["), literal, F.lit("]")), "array<string>")[0]


def _encoded(text: Column) -> Column:
    array = F.to_json(F.array(text))
    return F.substring(array, F.lit(2), F.length(array) - 2)


def json_strings(body: Column) -> Column:
    """All string values of a compact JSON text, in order, keys left out."""
    return let(
        _literals(body),
        lambda pieces: F.transform(
            F.filter(pieces, lambda _, i: _is_value(pieces, i)), _decoded
        ),
    )


def map_json_strings(body: Column, fn: Callable[[Column], Column]) -> Column:
    """The same JSON text with ``fn`` applied to every string value."""
    return let(
        _literals(body),
        lambda pieces: F.array_join(
            F.transform(
                pieces, lambda p, i: F.when(_is_value(pieces, i), _redone(p, fn)).otherwise(p)
            ),
            "",
        ),
    )


def _redone(literal: Column, fn: Callable[[Column], Column]) -> Column:
    return let(
        _decoded(literal),
        lambda s: let(fn(s), lambda out: F.when(out == s, literal).otherwise(_encoded(out))),
    )


def _map_json_leaves(body: Column, fn: Callable[[Column, Column], Column]) -> Column:
    """``map_json_strings`` with each value's place among the values."""

    def rebuilt(pieces: Column, ends: Column) -> Column:
        return F.array_join(
            F.transform(
                pieces,
                lambda p, i: F.when(
                    _is_value(pieces, i), _redone(p, lambda s: fn(s, F.get(ends, i) - 1))
                ).otherwise(p),
            ),
            "",
        )

    def placed(pieces: Column) -> Column:
        values = F.transform(pieces, lambda _, i: F.when(_is_value(pieces, i), 1).otherwise(0))
        return let(running_totals(values), lambda ends: rebuilt(pieces, ends))

    return let(_literals(body), placed)
