"""JSON documents that wrap a list of records, flattened to text columns."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stocktake.session import new_work_path
from stocktake.sources.files import file_columns, literal, local_names, plain_name
from stocktake.sources.pieces import write_pieces

#: Larger documents are cut into pieces first, as a task that parses one holds all of its records.
WHOLE_BYTES = 8 << 20


def text_schema(schema: T.DataType) -> T.DataType:
    """The same nesting with text leaves; only booleans keep their type."""
    if isinstance(schema, T.StructType):
        return T.StructType([T.StructField(f.name, text_schema(f.dataType)) for f in schema.fields])
    if isinstance(schema, T.ArrayType) and isinstance(schema.elementType, T.StructType):
        return T.ArrayType(text_schema(schema.elementType))
    return schema if isinstance(schema, T.BooleanType) else T.StringType()


def number_schema(schema: T.StructType, found: T.DataType) -> T.StructType:
    """The text schema with whole numbers where all values found are such.

    From a whole file, Spark takes the text of a number by a read of its own at
    the number's place, which costs a buffer each time; a long is parsed in
    passing and has the same text (but for ``-0``, which becomes 0). Lists keep
    their elements, as they are shown as JSON.
    """

    def numbers(field: T.StructField) -> T.StructField:
        if not isinstance(found, T.StructType) or field.name not in found.names:
            return field
        kind = found[field.name].dataType
        if isinstance(field.dataType, T.StructType):
            return T.StructField(field.name, number_schema(field.dataType, kind))
        whole = isinstance(field.dataType, T.StringType) and isinstance(kind, T.LongType)
        return T.StructField(field.name, kind) if whole else field

    return T.StructType([numbers(f) for f in schema.fields])


def read_envelopes(
    spark: SparkSession,
    paths: Sequence[str],
    items: str,
    one_per_line: bool = False,
    schema: T.StructType | None = None,
    record: T.StructType | None = None,
) -> DataFrame:
    """One row per element of ``items``; the envelope's own fields are dropped.

    A broken document, or one without the list, is an error and never skipped.
    A file is one document (a large one is cut into pieces first, by one task that
    streams through it) or, with ``one_per_line``, one document per line, which
    scans in splits. Passing a schema saves the pass
    that infers it. ``record`` names fields that every element is known to have;
    they are columns even if all lists are empty, other fields found come after.
    """
    reader = spark.read.option("multiLine", not one_per_line).option("mode", "FAILFAST")
    came_from = file_columns()
    if not one_per_line:
        paths, came_from = _without_large(spark, paths, items)
    inferred = schema or _inferred(spark, paths, one_per_line)
    found = inferred
    if record:
        found = merged(T.StructType([T.StructField(items, T.ArrayType(record))]), found)
    # the list stays one even where it is empty everywhere, or holds no records
    fields = [T.StructField(f.name, _listed(f.dataType) if f.name == items else text_schema(f.dataType)) for f in found.fields]
    if not schema and not one_per_line:
        fields = [_numbered(f, inferred) if f.name == items else f for f in fields]
    documents = reader.schema(T.StructType(fields)).json(list(paths))
    missing = F.raise_error(F.concat(F.lit(f"no list of {items} in "), F.col("_metadata.file_path")))
    listed = F.when(F.col(items).isNull(), missing).otherwise(F.col(items))
    records = documents.select(F.explode(listed).alias("_record"), *came_from)
    if not isinstance(records.schema["_record"].dataType, T.StructType):  # every list is empty
        return records.drop("_record")
    return flatten(records.select("_record.*", "_arquivo_origem", "_path"))


def _without_large(spark: SparkSession, paths: Sequence[str], items: str) -> tuple[Sequence[str], list[Column]]:
    """The paths with folders of pieces in place of the large documents among them, and the columns that say where rows came from."""
    found = spark.read.format("binaryFile").load(list(paths)).select(F.col("_metadata.file_path").alias("path"), "length")
    large = [r["path"] for r in found.where(F.col("length") > WHOLE_BYTES).select("path").orderBy("path").collect()]  # of one slice
    if not large:
        return paths, file_columns()
    folder = new_work_path(spark, "pieces")
    numbered = spark.createDataFrame(list(enumerate(large)), "number long, path string")
    # a task each, as each is long
    counts = write_pieces(numbered.repartitionByRange(len(large), "number"), items, folder)
    cut = {r["number"] for r in counts.collect() if r["pieces"]}
    if not cut:
        return paths, file_columns()
    gone = {large[i] for i in cut}
    whole = [literal(p) for p in local_names([r["path"] for r in found.select("path").toLocalIterator() if r["path"] not in gone])]
    # of a piece, the number of the document that its folder has for a name
    number = F.regexp_extract("_metadata.file_path", f"/{folder.rpartition('/')[2]}/([0-9]+)/[^/]*$", 1)
    names = F.array(*(F.lit(p) for p in large))
    path = F.when(number == "", F.col("_metadata.file_path")).otherwise(F.get(names, F.try_to_number(number, F.lit("9999999")).cast("int")))
    name = plain_name(F.element_at(F.split(path, "/"), -1))
    return [*whole, *(literal(f"{folder}/{i}") for i in sorted(cut))], [name.alias("_arquivo_origem"), path.alias("_path")]


def _inferred(spark: SparkSession, paths: Sequence[str], one_per_line: bool) -> T.StructType:
    """The schema of all documents, inferred in the JVM.

    Whole files go in as a Dataset of texts, as inference from paths would take
    names for patterns; Python's reader has no parameter for one.
    """
    reader = spark.read.option("mode", "FAILFAST")
    if one_per_line:
        return reader.json(list(paths)).schema
    texts = spark.read.text(list(paths), wholetext=True)
    strings = getattr(texts._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    return T.StructType.fromJson(json.loads(reader._jreader.json(strings).schema().json()))


def merged(known: T.DataType, found: T.DataType) -> T.DataType:
    """All fields of both, the known ones first; a known nesting is kept where a value of another kind was found."""
    if isinstance(known, T.StructType) and isinstance(found, T.StructType):
        types = {f.name: f.dataType for f in found.fields}
        ours = [T.StructField(f.name, merged(f.dataType, types.pop(f.name)) if f.name in types else f.dataType) for f in known.fields]
        return T.StructType([*ours, *(T.StructField(name, kind) for name, kind in types.items())])
    if isinstance(known, T.ArrayType) and isinstance(found, T.ArrayType):
        return T.ArrayType(merged(known.elementType, found.elementType))
    return known if isinstance(known, (T.StructType, T.ArrayType)) else found


def _numbered(items: T.StructField, inferred: T.StructType) -> T.StructField:
    """The list with the whole numbers that its records were found to have."""
    kind = inferred[items.name].dataType if items.name in inferred.names else None
    if not isinstance(kind, T.ArrayType) or not isinstance(items.dataType.elementType, T.StructType):
        return items
    return T.StructField(items.name, T.ArrayType(number_schema(items.dataType.elementType, kind.elementType)))


def _listed(kind: T.DataType) -> T.DataType:
    shape = text_schema(kind)
    return shape if isinstance(shape, T.ArrayType) else T.ArrayType(T.StringType())


def flatten(df: DataFrame, separator: str = "_") -> DataFrame:
    """Nested structs become ``parent_child`` columns, every leaf as text."""
    return df.select(*(c for f in df.schema.fields for c in _leaves(F.col(f"`{f.name}`"), f, separator)))


def _leaves(value: Column, field: T.StructField, separator: str, prefix: str = "") -> list[Column]:
    name = prefix + field.name
    if isinstance(field.dataType, T.StructType):
        return [
            leaf
            for child in field.dataType.fields
            for leaf in _leaves(value.getField(child.name), child, separator, name + separator)
        ]
    return [as_text(value, field.dataType).alias(name)]


def as_text(value: Column, kind: T.DataType) -> Column:
    """Scalars as written, booleans as ``True`` / ``False``, lists as JSON."""
    if isinstance(kind, T.BooleanType):
        return F.initcap(value.cast("string"))
    if isinstance(kind, (T.ArrayType, T.MapType)):
        return F.to_json(value)
    return value.cast("string")
