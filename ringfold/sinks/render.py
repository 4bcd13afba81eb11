"""Values as CSV or JSON text, in generated code; and the writers that use it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import ConfigError

#: Codec names of text sinks by the engine's names.
TEXT_CODECS = {None: "none", "gzip": "gzip", "bz2": "bzip2", "lz4": "lz4"}
PARQUET_CODECS = ("snappy", "gzip", "lz4", "zstd", "none")
ISO = "yyyy-MM-dd'T'HH:mm:ss"


def projected(df: DataFrame, columns: list[str] | None) -> DataFrame:
    """The columns in the order given; one that the table lacks is null."""
    if columns is None:
        return df
    return df.select(*[F.col(f"`{c}`") if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns])


def _iso(c: Column) -> Column:
    text = F.date_format(c, ISO)
    micros = F.date_format(c, "SSSSSS")
    return F.when(micros == "000000", text).otherwise(F.concat(text, F.lit("."), micros))


def csv_value(c: Column, t: T.DataType, null_string: str) -> Column:
    """A value's CSV text; within collections, null is the null string too."""
    if isinstance(t, T.BooleanType):
        text = F.when(c, "true").otherwise("false")
    elif isinstance(t, T.BinaryType):
        text = F.lower(F.hex(c))
    elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        text = _iso(c)
    elif isinstance(t, T.ArrayType):
        text = F.concat(F.lit("["), F.array_join(F.transform(c, lambda x: csv_value(x, t.elementType, null_string)), ", "), F.lit("]"))
    elif isinstance(t, T.MapType):
        pair = lambda e: F.concat(csv_value(e["key"], t.keyType, null_string), F.lit(": "), csv_value(e["value"], t.valueType, null_string))
        text = F.concat(F.lit("{"), F.array_join(F.transform(F.map_entries(c), pair), ", "), F.lit("}"))
    elif isinstance(t, T.StructType):
        parts = [csv_value(c[f.name], f.dataType, null_string) for f in t]
        text = F.concat(F.lit("("), F.concat_ws(", ", *parts), F.lit(")"))
    else:
        text = c.cast("string")
    return F.when(c.isNull(), F.lit(null_string)).otherwise(text)


def csv_text(df: DataFrame, null_string: str = "") -> DataFrame:
    """Every column as its CSV text."""
    return df.select(*[csv_value(F.col(f"`{f.name}`"), f.dataType, null_string).alias(f.name) for f in df.schema])


def json_value(c: Column, t: T.DataType, is_set: bool = False) -> Column:
    """A value as to_json writes it rightly: decimals as numbers, bytes as base64, times as ISO, sets sorted, text keys."""
    if isinstance(t, T.DecimalType):
        return c.cast("double")
    if isinstance(t, T.BinaryType):
        return F.base64(c)
    if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        return _iso(c)
    if isinstance(t, T.ArrayType):
        value = F.transform(c, lambda x: json_value(x, t.elementType))
        return F.array_sort(value) if is_set else value
    if isinstance(t, T.MapType):
        return F.transform_values(F.transform_keys(c, lambda k, v: k.cast("string")), lambda k, v: json_value(v, t.valueType))
    if isinstance(t, T.StructType):
        return F.when(c.isNotNull(), F.struct(*[json_value(c[f.name], f.dataType).alias(f.name) for f in t]))
    return c


def json_text(df: DataFrame, sets: tuple[str, ...] = ()) -> DataFrame:
    """Column json: a compact object a row, nulls kept."""
    values = [json_value(F.col(f"`{f.name}`"), f.dataType, f.name in sets).alias(f.name) for f in df.schema]
    return df.select(F.to_json(F.struct(*values), {"ignoreNullFields": "false"}).alias("json"))


def text_codec(codec: str | None) -> str:
    if codec not in TEXT_CODECS:
        raise ConfigError(f"no such codec: {codec!r}; {sorted(map(str, TEXT_CODECS))}")
    return TEXT_CODECS[codec]


def write_csv(
    df: DataFrame, path: str, delimiter: str = ",", null_string: str = "", header: bool = True, codec: str | None = None, columns: list[str] | None = None
) -> None:
    """A folder of CSV files; quotes only where needed, doubled within."""
    csv_text(projected(df, columns), null_string).write.csv(
        path, sep=delimiter, header=header, compression=text_codec(codec), emptyValue="", escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )


def write_jsonl(df: DataFrame, path: str, codec: str | None = None, columns: list[str] | None = None, sets: tuple[str, ...] = ()) -> None:
    """A folder of files with a JSON object a line."""
    json_text(projected(df, columns), sets).write.text(path, compression=text_codec(codec))


def write_json_array(df: DataFrame, path: str, columns: list[str] | None = None, sets: tuple[str, ...] = ()) -> int:
    """One local file that is a JSON array; rows pass the driver a partition at a time. Returns the rows written."""
    n = 0
    with open(f"{path}.part", "w", encoding="utf-8") as f:
        f.write("[\n")
        for row in json_text(projected(df, columns), sets).toLocalIterator(prefetchPartitions=True):
            f.write((",\n" if n else "") + row["json"])
            n += 1
        f.write("\n]")
    import os

    os.replace(f"{path}.part", path)
    return n


def write_parquet(df: DataFrame, path: str, codec: str = "snappy", columns: list[str] | None = None, where: str | None = None) -> None:
    if codec not in PARQUET_CODECS:
        raise ConfigError(f"no such codec: {codec!r}; {PARQUET_CODECS}")
    rows = df.filter(where) if where else df
    projected(rows, columns).write.option("compression", codec).parquet(path)
