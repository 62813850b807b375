"""Types that hold what two batches hold, and columns cast to them without loss."""

from __future__ import annotations

from collections.abc import Callable, Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
_FRACTION = (T.DoubleType, T.FloatType)
EXACT = 1 << 53  # whole numbers up to here are exact as doubles
_SCALAR = (T.StringType, T.BooleanType, T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


def wider_type(old: T.DataType, new: T.DataType, where: str = "", inexact: Collection[str] = ()) -> T.DataType:
    """The narrowest type for both, the same whichever came first.

    Whole numbers widen to longer ones, with decimals to decimals, with fractions to
    doubles; dates to timestamps; structs, arrays and maps field by field; any other two
    scalars to text. Where ``inexact`` names the place, longs and fractions become text too,
    since a double would change their digits. A scalar and a structure have nothing in common:
    that raises, before anything is written.
    """
    if old == new or isinstance(new, T.NullType):
        return old
    if isinstance(old, T.NullType):
        return new
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        return merged_schema(old, new, where, inexact)
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(wider_type(old.elementType, new.elementType, f"{where}[]", inexact), True)
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        return T.MapType(wider_type(old.keyType, new.keyType, where), wider_type(old.valueType, new.valueType, f"{where}{{}}", inexact), True)
    if isinstance(old, _WHOLE) and isinstance(new, _WHOLE):
        return max(old, new, key=lambda t: _DIGITS[type(t)])
    decimals = [t if isinstance(t, T.DecimalType) else T.DecimalType(_DIGITS[type(t)], 0) for t in (old, new) if isinstance(t, (T.DecimalType, *_WHOLE))]
    if len(decimals) == 2:
        scale = max(t.scale for t in decimals)
        digits = max(t.precision - t.scale for t in decimals) + scale
        return T.DecimalType(digits, scale) if digits <= 38 else T.StringType()
    if isinstance(old, T.NumericType) and isinstance(new, T.NumericType):
        return T.StringType() if where in inexact else T.DoubleType()
    if {type(old), type(new)} == {T.DateType, T.TimestampType}:
        return T.TimestampType()
    if isinstance(old, _SCALAR) and isinstance(new, _SCALAR):
        return T.StringType()
    raise ValueError(f"{where or 'column'}: {old.simpleString()} and {new.simpleString()} cannot be held in one column")


def merged_schema(old: T.StructType, new: T.StructType, where: str = "", inexact: Collection[str] = ()) -> T.StructType:
    """The old fields in their order, widened where needed, then what is new; names in any case."""
    incoming = {f.name.lower(): f for f in new.fields}
    fields = []
    for f in old.fields:
        other = incoming.pop(f.name.lower(), None)
        path = f"{where}.{f.name}" if where else f.name
        kind = f.dataType if other is None else wider_type(f.dataType, other.dataType, path, inexact)
        fields.append(T.StructField(f.name, kind, True))
    fields += [T.StructField(f.name, f.dataType, True) for f in new.fields if f.name.lower() in incoming]
    return T.StructType(fields)


Lift = Callable[[Column, Callable[[Column], Column]], Column]


def leaves(held: T.DataType, other: T.DataType, wanted: Callable[[T.DataType, T.DataType], bool], where: str = "") -> list[tuple[str, Lift]]:
    """Places whose types on both sides are ``wanted``, each with how a condition on the leaf becomes one on the column."""
    if isinstance(held, T.StructType) and isinstance(other, T.StructType):
        match = {f.name.lower(): f.dataType for f in other.fields}
        out = []
        for f in held.fields:
            inner = leaves(f.dataType, match.get(f.name.lower(), T.NullType()), wanted, f"{where}.{f.name}" if where else f.name)
            out += [(at, lambda c, test, n=f.name, g=g: g(c.getField(n), test)) for at, g in inner]
        return out
    if isinstance(held, T.ArrayType) and isinstance(other, T.ArrayType):
        inner = leaves(held.elementType, other.elementType, wanted, f"{where}[]")
        return [(at, lambda c, test, g=g: F.exists(c, lambda x: g(x, test))) for at, g in inner]
    if isinstance(held, T.MapType) and isinstance(other, T.MapType):
        inner = leaves(held.valueType, other.valueType, wanted, f"{where}{{}}")
        return [(at, lambda c, test, g=g: F.exists(F.map_values(c), lambda x: g(x, test))) for at, g in inner]
    return [(where, lambda c, test: test(c))] if wanted(held, other) else []


def places_where(rows: DataFrame, places: list[tuple[str, Lift]], test: Callable[[Column], Column]) -> set[str]:
    """Those places at which the test holds in some row; nothing is read where there are no places."""
    if not places:
        return set()
    whole = F.struct(*(F.col(f"`{c.replace('`', '``')}`") for c in rows.columns))
    found = rows.agg(*(F.max(F.coalesce(lift(whole, test), F.lit(False))).alias(f"_{i}") for i, (_, lift) in enumerate(places))).first()
    return {at for (at, _), hit in zip(places, found) if hit}


def inexact_places(old: DataFrame, new: DataFrame) -> set[str]:
    """Places where one side has longs that no double can hold and the other has fractions."""

    def long_beside_fraction(held: T.DataType, other: T.DataType) -> bool:
        return isinstance(held, T.LongType) and isinstance(other, _FRACTION)

    out: set[str] = set()
    for rows, other in ((old, new), (new, old)):
        places = leaves(rows.schema, other.schema, long_beside_fraction)
        out |= places_where(rows, places, lambda c: (c > EXACT) | (c < -EXACT))
    return out


def fitted(column: Column, held: T.DataType, wanted: T.DataType) -> Column:
    """A column as the wanted, wider type; fields of structures are matched by name."""
    if held == wanted:
        return column
    if isinstance(held, T.StructType) and isinstance(wanted, T.StructType):
        own = {f.name.lower(): f for f in held.fields}
        parts = [
            (fitted(column.getField(own[f.name.lower()].name), own[f.name.lower()].dataType, f.dataType) if f.name.lower() in own else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in wanted.fields
        ]
        return F.when(column.isNotNull(), F.struct(*parts))
    if isinstance(held, T.ArrayType) and isinstance(wanted, T.ArrayType):
        return F.transform(column, lambda x: fitted(x, held.elementType, wanted.elementType))
    if isinstance(held, T.MapType) and isinstance(wanted, T.MapType):
        return F.transform_values(column, lambda _, x: fitted(x, held.valueType, wanted.valueType))
    return column.cast(wanted)
