"""Documents: file listing, XML parsing, safety and schema checks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructField, StructType

from headway.functions.text import base_name, document_type, document_version, is_unsafe_xml
from headway.schemas import CORRUPT, FARES_DDL, TIMETABLE_DDL

OPTIONS = {"ignoreNamespace": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
TIMETABLE_ROOT, FARES_ROOT = "TransXChange", "PublicationDelivery"


def file_id() -> Column:
    """Id of the file a row was read from, the same for every reader."""
    return F.xxhash64("_metadata.file_path")


def scan_corpus(spark: SparkSession, path: str, pattern: str = "*.xml") -> DataFrame:
    """Files under a path with name, size and content hash."""
    raw = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    return raw.select(
        file_id().alias("file_id"),
        F.col("_metadata.file_path").alias("path"),
        base_name(F.col("path")).alias("name"),
        F.col("length").alias("size"),
        F.sha1("content").alias("sha1"),
        F.make_valid_utf8(F.col("content").cast("string")).alias("text"),
    )


def narrowed(kind: DataType, fields: Iterable[str]) -> DataType:
    """A schema with no more than the fields at some paths (``a.b``) and all below them."""
    if isinstance(kind, ArrayType):
        return ArrayType(narrowed(kind.elementType, fields), kind.containsNull)
    below: dict[str, list[str]] = {}
    for path in fields:
        name, _, rest = path.partition(".")
        below.setdefault(name, []).append(rest)
    unknown = set(below) - set(kind.names)
    if unknown:
        raise ValueError(f"no such fields: {sorted(unknown)}")
    return StructType(
        [f if "" in below[f.name] else StructField(f.name, narrowed(f.dataType, below[f.name]), f.nullable) for f in kind if f.name in below]
    )


def parse(documents: DataFrame, schema: str, text: str = "text", fields: Iterable[str] | None = None) -> DataFrame:
    """Parse whole documents; keys stay, the fields come as columns.

    A document that does not parse keeps its text in the corrupt column. Documents are read to
    their end whatever is asked for, but only ``fields`` (paths like ``Services.Service.Lines``)
    are made into values, which is most of the work. ``inline`` keeps filters on
    the fields behind the parser, which would run once more for each of them.
    """
    keep = [c for c in documents.columns if c != text]
    kind = StructType.fromDDL(schema)
    if fields is not None:
        kind = narrowed(kind, [*fields, CORRUPT])
    return documents.select(*keep, F.inline(F.array(F.from_xml(F.col(text), kind, OPTIONS))))


def parse_timetables(documents: DataFrame, text: str = "text", fields: Iterable[str] | None = None) -> DataFrame:
    return parse(documents, TIMETABLE_DDL, text, fields)


def parse_fares(documents: DataFrame, text: str = "text") -> DataFrame:
    return parse(documents, FARES_DDL, text)


def _read(spark: SparkSession, path: str, root: str, schema: str, xsd: str | None) -> DataFrame:
    reader = spark.read.format("xml").option("rowTag", root).options(**OPTIONS)
    if xsd:
        # Name of a schema file given to the executors with addFile.
        reader = reader.option("rowValidationXSDPath", xsd)
    docs = reader.schema(schema).load(path)
    return docs.withColumns({"path": F.col("_metadata.file_path"), "file_id": file_id()})


def read_timetables(spark: SparkSession, path: str, xsd: str | None = None) -> DataFrame:
    """One row per timetable document under a path."""
    return _read(spark, path, TIMETABLE_ROOT, TIMETABLE_DDL, xsd)


def read_fares(spark: SparkSession, path: str, xsd: str | None = None) -> DataFrame:
    return _read(spark, path, FARES_ROOT, FARES_DDL, xsd)


def stage(documents: DataFrame, path: str) -> DataFrame:
    """Write parsed documents once as Parquet and read them back.

    XML is parsed whole whatever is asked for; Parquet lets every section table
    read its own columns only.
    """
    documents.write.mode("overwrite").parquet(path)
    return documents.sparkSession.read.parquet(path)


def corrupt_documents(documents: DataFrame) -> DataFrame:
    """Documents that did not parse (or did not fit their XSD)."""
    # A reader refuses to fill the corrupt column alone, so a field is asked for too.
    field = next(c for c in documents.columns if c.startswith("_") and c != CORRUPT)
    asked = F.coalesce(F.col(field), F.lit("")) >= F.lit("")
    return documents.where(F.col(CORRUPT).isNotNull() & asked)


def unreadable_files(documents: DataFrame) -> DataFrame:
    """Error table of the files an inventory cannot read."""
    return corrupt_documents(documents).select("file_id", F.lit("XML_SYNTAX_ERROR").alias("error_code"))


def schema_violations(documents: DataFrame) -> DataFrame:
    """Documents that did not conform to the XSD they were read with.

    The reader reports a row, not a line or a message.
    """
    return corrupt_documents(documents).select(
        "file_id", "path", F.lit("document does not conform to its schema").alias("message")
    )


def safety_violations(corpus: DataFrame, expected_root: str, versions: tuple[str, ...]) -> DataFrame:
    """Files that may not be processed, with an error code each.

    Checks in order: suffix, declarations, well-formedness, root element,
    version. A text is well-formed if the XML reader takes it to its end.
    """
    text = F.col("text")
    corpus = corpus.withColumn("_read", F.from_xml(text, f"_read string, {CORRUPT} string", OPTIONS)[CORRUPT])
    code = (
        F.when(~F.lower("name").endswith(".xml"), "SUSPICIOUS_FILE")
        .when(is_unsafe_xml(text), "DANGEROUS_XML_ERROR")
        .when(text.isNull() | F.col("_read").isNotNull(), "XML_SYNTAX_ERROR")
        .when(document_type(text) != expected_root, "XML_SYNTAX_ERROR")
        .when(~F.coalesce(document_version(text).isin(*versions), F.lit(False)), "SCHEMA_VERSION_NOT_SUPPORTED")
    )
    return corpus.withColumn("error_code", code).where("error_code is not null").select(
        "file_id", "name", "error_code"
    )


def surviving_files(corpus: DataFrame, file_status: DataFrame) -> DataFrame:
    """Content of files that passed every stage."""
    passed = file_status.groupBy("file_id").agg(
        F.bool_and(F.col("status") == "succeeded").alias("ok")
    ).where("ok")
    return corpus.join(passed, "file_id", "left_semi")


def child_names(inner: Column) -> Column:
    """Names of an element's children, read from its inner XML.

    Children of the one day element that has children itself are left out.
    """
    flat = F.regexp_replace(
        inner, r"(?s)<OtherPublicHoliday(\s[^>]*)?>.*?</OtherPublicHoliday>", "<OtherPublicHoliday/>"
    )
    names = F.regexp_extract_all(flat, F.lit(r"<(?:\w+:)?([A-Za-z]\w*)"), 1)
    return F.coalesce(names, F.array().cast("array<string>"))
