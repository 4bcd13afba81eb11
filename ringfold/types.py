"""CQL type names as Spark types, and what empty collections read back as."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .errors import ConfigError

#: Scalar types. time is nanoseconds of the day; uuid and inet are text.
SCALARS: dict[str, T.DataType] = {
    **dict.fromkeys(("ascii", "text", "varchar", "uuid", "timeuuid", "inet"), T.StringType()),
    "tinyint": T.ByteType(),
    "smallint": T.ShortType(),
    "int": T.IntegerType(),
    **dict.fromkeys(("bigint", "counter", "time"), T.LongType()),
    "varint": T.DecimalType(38, 0),
    "decimal": T.DecimalType(38, 10),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "blob": T.BinaryType(),
}


def arguments(text: str) -> list[str]:
    """Split type arguments at commas outside of brackets."""
    out, depth, at = [], 0, 0
    for i, c in enumerate(text):
        depth += (c == "<") - (c == ">")
        if depth < 0:
            raise ConfigError(f"unbalanced brackets in {text!r}")
        if c == "," and depth == 0:
            out.append(text[at:i].strip())
            at = i + 1
    if depth:
        raise ConfigError(f"unbalanced brackets in {text!r}")
    return [*out, text[at:].strip()]


def spark_type(name: str, structs: dict[str, T.StructType] | None = None) -> T.DataType:
    """The Spark type of a CQL type. structs: user-defined types by name; an unknown one is text."""
    name = name.strip()
    if "<" not in name:
        if ">" in name:
            raise ConfigError(f"unbalanced brackets in {name!r}")
        return SCALARS.get(name.lower()) or (structs or {}).get(name) or T.StringType()
    outer, _, inner = name.partition("<")
    if not inner.endswith(">"):
        raise ConfigError(f"unbalanced brackets in {name!r}")
    outer, parts = outer.strip().lower(), [spark_type(x, structs) for x in arguments(inner[:-1])]
    want = {"list": 1, "set": 1, "frozen": 1, "map": 2}.get(outer)
    if want and len(parts) != want:
        raise ConfigError(f"{outer} takes {want} types, not {len(parts)}: {name!r}")
    if outer in ("list", "set"):
        return T.ArrayType(parts[0])
    if outer == "map":
        return T.MapType(*parts)
    if outer == "frozen":
        return parts[0]
    if outer == "tuple":
        return T.StructType([T.StructField(f"_{i}", t) for i, t in enumerate(parts)])
    return T.StringType()


def spark_schema(columns: dict[str, str], key: tuple[str, ...] = ()) -> T.StructType:
    """A table's schema; key columns are required, counters are marked in their metadata."""
    return T.StructType(
        [T.StructField(c, spark_type(t), c not in key, {"counter": True} if t.strip() == "counter" else {}) for c, t in columns.items()]
    )


def normalised(df: DataFrame, sets: tuple[str, ...] = ()) -> DataFrame:
    """Empty collections read back as null; sets are sorted and distinct."""
    out = {}
    for f in df.schema:
        if isinstance(f.dataType, (T.ArrayType, T.MapType)):
            value = F.array_sort(F.array_distinct(f.name)) if f.name in sets else F.col(f.name)
            out[f.name] = F.when(F.size(f.name) > 0, value)
    return df.withColumns(out) if out else df
