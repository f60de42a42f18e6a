"""Fields of landing records that the explicit schema does not know.

A reader with a schema leaves unknown fields out without a word. Here records are parsed to VARIANT as well, so that unknown fields can be
counted with the type they have (``unknown_fields``), kept next to the known ones or refused (``read_json``), and taken into
the schema (``evolved``).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNKNOWN = "_unknown"
_PLAIN = r"^\w+$"
_STEP = re.compile(r"(?:`((?:[^`]|``)+)`|([^.\[\]`]+))((?:\[\])?)\.?")
#: Unknown paths that are taken into a schema at most: more are keys that hold data, not fields.
MOST_FIELDS = 1000


def read_records(spark: SparkSession, folder: str, names: str | None = None, partition: str | None = None, multi_line: bool = False) -> DataFrame:
    """(text, partition): the JSON texts below a folder, one per line or, with ``multi_line``, one per file.

    ``names`` is a glob of file names. Blank lines are left out.
    """
    fields = [T.StructField("value", T.StringType())]
    if partition:
        fields.append(T.StructField(partition, T.StringType()))
    reader = spark.read.schema(T.StructType(fields))
    if names:
        reader = reader.option("pathGlobFilter", names)
    return reader.text(folder, wholetext=multi_line).filter(F.trim("value") != "").withColumnRenamed("value", "text")


def _once(value: Column, use) -> Column:
    return F.get(F.transform(F.array(value), use), 0)


def variants(text: Column) -> Column:
    """The records of a JSON text as an array of VARIANT: the elements of an array, or the one object."""
    return _once(F.parse_json(text), lambda parsed: F.coalesce(F.try_variant_get(parsed, "$", "array<variant>"), F.array(parsed)))


def _quoted(name: Column) -> Column:
    return F.when(name.rlike(_PLAIN), name).otherwise(F.concat(F.lit("`"), F.replace(name, F.lit("`"), F.lit("``")), F.lit("`")))


def _value(record: Column, name: str, kind: str = "variant") -> Column:
    """The value of a field of a VARIANT, null if it is of another kind; a plain name is looked up without a map of all fields."""
    if re.fullmatch(_PLAIN, name, re.ASCII):
        return F.try_variant_get(record, f"$.{name}", kind)
    return F.try_variant_get(F.try_element_at(F.try_variant_get(record, "$", "map<string,variant>"), F.lit(name)), "$", kind)


def _is_records(kind: T.DataType) -> bool:
    return isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType)


def _is_flat(schema: T.StructType) -> bool:
    return not any(isinstance(field.dataType, T.StructType) or _is_records(field.dataType) for field in schema)


def _has_others(fields: Column, schema: T.StructType) -> Column:
    return F.exists(F.map_keys(fields), lambda name: ~name.isin(schema.names))


def _one_has_others(elements: Column, schema: T.StructType) -> Column:
    return F.exists(elements, lambda fields: _has_others(fields, schema))


def _others(fields: Column, schema: T.StructType, at: Column) -> Column:
    """Array of (path, value) of the entries of a map that are no fields of ``schema``."""
    others = F.map_entries(F.map_filter(fields, lambda name, _: ~name.isin(schema.names)))
    return F.transform(others, lambda e: F.struct(F.concat(at, _quoted(e["key"])).alias("path"), e["value"].alias("value")))


def unknown_in(record: Column, schema: T.StructType, numbered: bool = False, prefix: Column | str = "") -> Column:
    """Array of (path, value) of the fields of a VARIANT that ``schema`` does not have, at every depth it describes.

    Elements of an array share a path, ``eixos[].novo``, or with ``numbered`` name their place, ``eixos[0].novo``. A value that
    is no object where the schema has one gives none.
    """
    head = prefix if isinstance(prefix, Column) else F.lit(prefix)
    nothing = F.array().cast("array<struct<path:string,value:variant>>")

    def each_of(elements: Column, at: Column, use) -> Column:
        def one(element: Column, i: Column) -> Column:
            place = F.concat(F.lit("["), i.cast("string"), F.lit("].")) if numbered else F.lit("[].")
            return F.coalesce(use(element, F.concat(at, place)), nothing)

        return F.flatten(F.transform(elements, one))

    def of(value: Column, fields: Column) -> Column:
        # values are taken only where a name is unknown: most records are of known fields alone
        parts = [F.when(_has_others(fields, schema), _others(F.try_variant_get(value, "$", "map<string,variant>"), schema, head))]
        for field in schema:
            kind, at = field.dataType, F.concat(head, _quoted(F.lit(field.name)))
            if isinstance(kind, T.StructType):
                parts.append(unknown_in(_value(value, field.name), kind, numbered, F.concat(at, F.lit("."))))
            elif _is_records(kind) and _is_flat(kind.elementType):
                strange = _one_has_others(F.try_element_at(fields, F.lit(field.name)), kind.elementType)
                elements = _value(value, field.name, "array<map<string,variant>>")
                parts.append(F.when(strange, each_of(elements, at, lambda e, at, kind=kind: _others(e, kind.elementType, at))))
            elif _is_records(kind):
                elements = _value(value, field.name, "array<variant>")
                parts.append(each_of(elements, at, lambda e, at, kind=kind: unknown_in(e, kind.elementType, numbered, at)))
        return F.concat(*[F.coalesce(part, nothing) for part in parts])

    # one walk gives the names of the fields and of those of their elements; an empty struct takes no value apart
    names = "map<string,array<map<string,struct<>>>>"
    return _once(record, lambda value: _once(F.try_variant_get(value, "$", names), lambda fields: of(value, fields)))


def unknown_fields(records: DataFrame, schema: T.StructType, text: str = "text") -> DataFrame:
    """(path, kind, occurrences, records) of every field outside ``schema``, from JSON texts.

    kind is the type that fits all values, VARIANT if none does. One pass; a record without an unknown field gives no row
    to the shuffle, and those of a path are merged within each task. Text that is no JSON fails the job.
    """

    def counted(found: Column) -> Column:
        def one(paths: Column) -> Column:
            return F.transform(found, lambda field, i: F.struct(field["path"], field["value"], (F.array_position(paths, field["path"]) == i + 1).alias("first")))

        return _once(found["path"], one)

    # exploded where it is computed: of a column Spark would ask first whether it is empty, and compute it again for that
    found = F.flatten(F.transform(variants(F.col(text)), lambda record: _once(unknown_in(record, schema), counted)))
    return records.select(F.explode(found).alias("field")).groupBy(F.col("field.path").alias("path")).agg(
        F.schema_of_variant_agg(F.col("field.value")).alias("kind"), F.count("*").alias("occurrences"), F.count_if("field.first").alias("records")
    )


def _steps(path: str) -> list[tuple[str, bool]]:
    return [((quoted or plain).replace("``", "`"), bool(many)) for quoted, plain, many in _STEP.findall(path)]


def _kind(text: str) -> T.DataType:
    """The Spark type of a VARIANT schema; a field that was always null is text."""
    ddl = text.replace("OBJECT<", "STRUCT<").replace("VOID", "STRING")
    return T.StructType.fromDDL(f"f {ddl}")["f"].dataType


def _with_field(kind: T.DataType, steps: list[tuple[str, bool]], leaf: T.DataType) -> T.DataType:
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_with_field(kind.elementType, steps, leaf), kind.containsNull)
    (name, _), rest = steps[0], steps[1:]
    fields = {field.name: field.dataType for field in kind}
    fields[name] = _with_field(fields[name], rest, leaf) if rest else leaf
    return T.StructType([T.StructField(n, k) for n, k in fields.items()])


def evolved(schema: T.StructType, report: DataFrame, most: int = MOST_FIELDS) -> T.StructType:
    """``schema`` with the reported fields added at their places, in the order of their paths.

    The report reaches the driver; more than ``most`` paths are an error.
    """
    rows = report.select("path", "kind").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} unknown fields: object keys seem to hold data")
    for row in sorted(rows):
        schema = _with_field(schema, _steps(row.path), _kind(row.kind))
    return schema


def read_json(
    spark: SparkSession, folder: str, schema: T.StructType, unknown: str = "keep", names: str | None = None,
    partition: str | None = None, multi_line: bool = False,
) -> DataFrame:
    """Records with the known fields as typed columns; unknown fields are kept, or fail the job with ``unknown="error"``.

    Kept ones are in the map ``_unknown``, from their path to their value as JSON. Text that cannot be parsed fails the job.
    """
    if unknown not in ("keep", "error"):
        raise ValueError(f"no rule {unknown!r} for unknown fields")
    known = F.from_json("text", T.ArrayType(schema), {"mode": "FAILFAST"})
    both = F.arrays_zip(known.alias("known"), variants(F.col("text")).alias("record"))
    kept = [partition] if partition else []
    rows = read_records(spark, folder, names, partition, multi_line).select(F.explode(both).alias("row"), *kept)
    found = unknown_in(F.col("row.record"), schema, numbered=True)
    if unknown == "error":
        message = F.concat(F.lit("a landing record has unknown fields: "), F.array_join(found["path"], ", "))
        guard = F.when(F.size(found) > 0, F.raise_error(message).cast("boolean")).otherwise(True)
        return rows.filter(guard).select("row.known.*", *kept)
    texts = F.map_from_entries(F.transform(found, lambda f: F.struct(f["path"], F.to_json(f["value"]))))
    return rows.select("row.known.*", texts.alias(UNKNOWN), *kept)
