"""Delimited source files: encoding choice, bad-line handling, column checks, staging."""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions.columns import unmark
from basketry.session import materialise, path_exists
from basketry.sources.records import records, store_records, validity
from basketry.specs import ENTITIES, FIELD_SEPARATOR, SOURCE_FILES, EntitySpec

# The Windows-1252 characters that differ from Latin-1, by byte from 0x80 up.
# A gap in the sequence is a byte that Windows-1252 leaves undefined.
CP1252_BYTES = "\x80\x82\x83\x84\x85\x86\x87\x88\x89\x8a\x8b\x8c\x8e\x91\x92\x93\x94\x95\x96\x97\x98\x99\x9a\x9b\x9c\x9e\x9f"
CP1252_CHARS = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"

ORDINAL = "_ord"


class MissingColumns(ValueError):
    """A required column is not in the file."""


def source_path(folder: str, table: str) -> str:
    file_name = SOURCE_FILES[table][0] if table in SOURCE_FILES else f"{table}.csv"
    return f"{folder.rstrip('/')}/{file_name}"


def file_encodings(checked: DataFrame, candidates: list[str]) -> DataFrame:
    """``file, encoding``: the first candidate under which every byte of the file is valid, null if none is.

    ``checked`` has for each record its file and whether it is valid under each encoding. A wrong encoding does not
    fail in a reader, it silently yields replacement characters."""
    valid = {"utf-8": "utf8", "cp1252": "cp1252"}
    found = checked.groupBy("file").agg(*[F.coalesce(F.bool_and(c), F.lit(True)).alias(c) for c in valid.values()])
    choice = F.coalesce(*[F.when(F.col(valid[n]), F.lit(n)) for n in candidates if n in valid], F.lit(None).cast("string"))
    return found.select("file", choice.alias("encoding"))


def encodings_at(spark: SparkSession, path: str, candidates: list[str]) -> DataFrame:
    """``file, encoding`` of the files at ``path``, from one pass over their lines."""
    lines = spark.read.text(path)
    flags = [e.alias(n) for n, e in validity(F.col("value").cast("binary")).items()]
    return file_encodings(lines.select(F.col("_metadata.file_path").alias("file"), *flags), candidates)


def detect_encoding(spark: SparkSession, path: str, candidates: list[str]) -> str:
    """The encoding of the files at ``path``, which all have the same one."""
    return _one_encoding(encodings_at(spark, path, candidates), path, candidates)


def _one_encoding(encodings: DataFrame, path: str, candidates: list[str]) -> str:
    found = [r.encoding for r in encodings.select("encoding").distinct().collect()]
    if None in found:
        raise ValueError(f"a file at {path} is valid under none of {candidates}")
    if len(found) > 1:
        raise ValueError(f"the files at {path} have several encodings: {sorted(found)}")
    return found[0] if found else candidates[0]


def _decoded(raw: Column, encoding: Column) -> Column:
    """Text of bytes under the encoding that was found. Windows-1252 is read as Latin-1 and the few characters that
    differ are mapped."""
    latin = F.translate(F.decode(raw, "ISO-8859-1"), CP1252_BYTES, CP1252_CHARS)
    return F.when(encoding == "cp1252", latin).otherwise(raw.cast("string"))


def _header(rows: DataFrame, path: str) -> list[str]:
    """Column names from the first record of each file, which must be the same in all. Without byte order mark and
    outer blanks; a quoted name may hold the separator and doubled quotes. At most two rows reach the driver."""
    firsts = rows.filter("_first").select(F.ltrim("text", F.lit("\ufeff")).alias("text")).distinct().limit(2).collect()
    if not firsts:
        raise ValueError(f"{path} is empty")
    headers = [normalise_names(next(csv.reader([r.text], delimiter=FIELD_SEPARATOR), [""])) for r in firsts]
    if headers[0] != headers[-1]:
        raise ValueError(f"the files at {path} have different columns: {headers}")
    return headers[0]


def normalise_names(names: list[str]) -> list[str]:
    return [n.strip() for n in names]


def normalise_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*normalise_names(df.columns))


def check_columns(spec: EntitySpec, found: list[str]) -> None:
    missing = sorted(set(spec.required) - set(found))
    if missing:
        raise MissingColumns(f"{spec.name}: required columns {missing} are not among {sorted(found)}")


def column_report(spec: EntitySpec, df: DataFrame) -> DataFrame:
    """Declared against found columns: one row per name on either side."""
    declared = {c: "required" for c in spec.required} | {c: "optional" for c in spec.optional}
    names = list(dict.fromkeys([*declared, *[c for c in df.columns if c != ORDINAL]]))
    rows = [(spec.name, c, declared.get(c, "undeclared"), int(c in df.columns)) for c in names]
    return df.sparkSession.createDataFrame(rows, "entity string, column string, declared string, found int")


def _too_long(record: Column, columns: int) -> Column:
    """A record with more fields than the header. Whole quoted fields do not count."""
    unquoted = F.regexp_replace(record, f'(^|{FIELD_SEPARATOR})"[^"]*+(?:""[^"]*+)*+"', "$1")
    return F.regexp_count(unquoted, F.lit(FIELD_SEPARATOR)) >= columns


def scan_delimited(
    spark: SparkSession,
    path: str,
    encodings: list[str] | None = None,
    with_ordinal: bool = False,
) -> DataFrame:
    """Read the ``;`` files with header at ``path``, every column as text.

    The bytes are read once: ``store_records`` cuts them into records, whatever line breaks quoted fields hold, and
    stores these with the evidence on their encodings; the encoding is then chosen for each file. Records with too
    many fields are skipped and short ones padded with nulls; null markers become nulls; blank lines are no records.
    ``with_ordinal`` adds ``_ord``, the place in file order, for operators that keep the first row. Quotes inside
    quoted fields are doubled; a backslash is a character like any other. The first record of each file is its
    header, the same in all files.
    """
    if not path_exists(spark, path):
        raise FileNotFoundError(f"data file not found: {path}")
    candidates = encodings or ["utf-8", "cp1252"]
    stored = store_records(spark, path)
    by_file = materialise(file_encodings(stored.filter(F.col("raw").isNotNull()), candidates), "encodings")
    found = [r.encoding for r in by_file.select("encoding").distinct().collect()]
    if None in found:
        raise ValueError(f"a file at {path} is valid under none of {candidates}")
    rows = records(stored)
    if len(found) > 1:
        rows = rows.join(by_file, "file")
    else:
        rows = rows.withColumn("encoding", F.lit(found[0] if found else candidates[0]))
    rows = rows.select(
        "file", "block", "place", _decoded(F.col("raw"), F.col("encoding")).alias("text"), ((F.col("block") == 0) & (F.col("place") == 0)).alias("_first")
    )
    names = _header(rows, path)
    fields = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
    # The parser gives up on a record whose fields it cannot count only with a column for it in the schema.
    options = {"sep": FIELD_SEPARATOR, "quote": '"', "escape": '"', "mode": "PERMISSIVE"}
    body = rows.filter(~F.col("_first") & (F.trim("text") != "") & ~_too_long(F.col("text"), len(names)))
    parsed = body.withColumn("fields", F.from_csv("text", fields.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), options))
    place = F.struct(F.col("file").alias("file_path"), F.col("block").alias("file_block_start"), F.col("place").alias("line"))
    tail = [place.alias(ORDINAL)] if with_ordinal else []
    return parsed.select(*[unmark(F.col(f"fields.c{i}")).alias(n) for i, n in enumerate(names)], *tail)


def stage(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """Scan one entity's file, check its columns, add the file order."""
    spec = ENTITIES[table]
    path = source_path(folder, table)
    df = normalise_columns(scan_delimited(spark, path, SOURCE_FILES[table][1], with_ordinal=True))
    check_columns(spec, df.columns)
    return df


def count_lines(spark: SparkSession, path: str) -> DataFrame:
    """Data lines per folder or file: all lines without the header of each part file."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("part"))
    per_part = lines.groupBy("part").agg((F.count("*") - 1).alias("n"))
    return per_part.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("lines"))


def files_overview(spark: SparkSession, folder: str, tables: list[str]) -> DataFrame:
    """Table, kind, parts, size and encodings of every source file. Contents are read once, for the encodings; those
    of several files of a table are listed."""
    overview = None
    for table in tables:
        path = source_path(folder, table)
        listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path).select("length")
        kind = "Fact" if table in ("SalesHeader", "SalesLine", "Invoice") else "Dimension"
        candidates = SOURCE_FILES[table][1] if table in SOURCE_FILES else ["utf-8", "cp1252"]
        found = encodings_at(spark, path, candidates).agg(F.array_join(F.array_sort(F.collect_set("encoding")), ", ").alias("encodings"))
        row = listing.agg(
            F.count("*").alias("parts"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")
        ).select(F.lit(table).alias("table"), F.lit(kind).alias("kind"), "parts", "bytes", found.select("encodings").scalar().alias("encodings"))
        overview = row if overview is None else overview.unionByName(row)
    return overview


def write_delimited(df: DataFrame, path: str, encoding: str = "utf-8") -> None:
    """Write ``;`` files with header. Windows-1252 goes out as Latin-1 with mapped characters. Amounts have two
    decimals, and further ones only where they are not zero."""
    digits = {f.name: f.dataType.scale for f in df.schema if isinstance(f.dataType, T.DecimalType)}
    df = df.withColumns({c: F.regexp_replace(F.col(c).cast("string"), r"(\.\d\d\d*?)0+$", "$1") for c, n in digits.items() if n > 2})
    if encoding == "cp1252":
        df = df.select(*[F.translate(c, CP1252_CHARS, CP1252_BYTES).alias(c) for c in df.columns])
    (
        df.write.mode("overwrite")
        .option("sep", FIELD_SEPARATOR)
        .option("header", "true")
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .option("encoding", "ISO-8859-1" if encoding == "cp1252" else "UTF-8")
        .csv(path)
    )
