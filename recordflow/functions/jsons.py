"""JSON text held in string columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def json_field(col: Column | str, path: str) -> Column:
    return F.get_json_object(F.col(col) if isinstance(col, str) else col, path)


def json_rows(df: DataFrame, col: str, path: str, element: T.StructType, pos: str | None = None) -> DataFrame:
    """One row per element of the JSON array found under the top-level key ``path``.

    The text is parsed once with a declared schema; elements stay in one struct pass instead
    of one path lookup per field and element.
    """
    holder = T.StructType([T.StructField(path, T.ArrayType(element))])
    parsed = F.from_json(F.col(col), holder)[path]
    keep = [c for c in df.columns if c != col]
    rows = df.select(*keep, F.posexplode(parsed).alias("_pos", "_item"))
    fields = [F.col("_item")[f.name].alias(f.name) for f in element.fields]
    extra = [F.col("_pos").cast("bigint").alias(pos)] if pos else []
    return rows.select(*keep, *extra, *fields)


def variant(col: Column | str) -> Column:
    """JSON text parsed without a schema; NULL if it cannot be read."""
    return F.try_parse_json(F.col(col) if isinstance(col, str) else col)


def variant_field(parsed: Column | str, path: Column | str, kind: str = "string") -> Column:
    """The value under a path, which may be computed from columns (``$.a[0].b``).

    NULL where the path leads nowhere or the value is not of the kind. The text is parsed once (``variant``),
    however many paths are looked up.
    """
    value = F.col(parsed) if isinstance(parsed, str) else parsed
    return F.try_variant_get(value, path, kind)


def variant_path(*parts: str | Column) -> Column:
    """A path from names (text) and positions or names held in columns: ``variant_path("a", col, "b")``."""
    out = F.lit("$")
    for part in parts:
        if isinstance(part, str):
            out = F.concat(out, F.lit(f".{part}"))
        else:
            step = part.cast("string")
            position = F.concat(F.lit("["), step, F.lit("]"))
            name = F.concat(F.lit("['"), step, F.lit("']"))
            out = F.concat(out, F.when(step.rlike("^[0-9]+$"), position).otherwise(name))
    return out


def variant_rows(df: DataFrame, parsed: str, path: Column | str, fields: dict[str, str], outer: bool = False) -> DataFrame:
    """One row per element of the array, or entry of the object, under a path that may differ by row.

    ``pos`` and, for objects, ``key`` say which; ``fields`` are read from each element ({name: kind}). The shape
    need not be declared, and rows may differ in it. ``outer`` keeps rows without elements.
    """
    rows = df.withColumn("_at", variant_field(parsed, path, "variant"))
    explode = df.sparkSession.tvf.variant_explode_outer if outer else df.sparkSession.tvf.variant_explode
    joined = rows.lateralJoin(explode(F.col("_at").outer()))
    named = [variant_field("value", f"$.{name}", kind).alias(name) for name, kind in fields.items()]
    keep = [F.col(c) for c in df.columns if c != parsed]
    return joined.select(*keep, F.col("pos").cast("bigint").alias("pos"), "key", *named)
