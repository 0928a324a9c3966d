"""Reading the public CSV extracts: header row, every column text, nothing inferred."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from docketrank.sources.schemas import text_schema

CORRUPT_COLUMN = "_corrupt_record"

# RFC 4180: a quote inside a quoted field is doubled.
_RECORD = {"sep": ",", "quote": '"', "escape": '"'}
_DIALECT = {"header": "true", **_RECORD}

# A quote at the start of a field, looked for where well-formed quoted fields are gone.
# The lookbehind comes after the quote, so that it runs at quotes only.
_OPEN_QUOTE = r'"(?<![^,]")'


class MissingExtract(RuntimeError):
    """A raw file is absent or has no rows."""


def line_breaks_by_file(spark: SparkSession, path: str | list[str]) -> dict[str, bool]:
    """Whether some field of a file may hold a line break; only file names reach the driver.

    A record cut by a line break has an odd number of quotes on its first line, so one scan by
    lines, which splits files freely, tells which files can't have any.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"')))
    found = lines.groupBy("file").agg(F.max(quotes % 2 == 1).alias("cut"))
    return {unquote(row["file"]): row["cut"] for row in found.toLocalIterator()}


def _read(spark: SparkSession, paths: list[str] | str, schema: T.StructType, mode: str, **options) -> DataFrame:
    reader = spark.read.schema(schema).options(**_DIALECT, mode=mode)
    # Every file's own header has to agree with the schema, not only the first one's.
    return reader.options(**{"enforceSchema": False, "columnNameOfCorruptRecord": CORRUPT_COLUMN, **options}).csv(paths)


def header_columns(spark: SparkSession, path: str | list[str]) -> tuple[str, ...]:
    """The column names of the header row; reads the first line only."""
    return tuple(spark.read.options(**_DIALECT, inferSchema="false").csv(path).columns)


def _schema(spark: SparkSession, path: str | list[str], columns: tuple[str, ...] | None) -> T.StructType:
    found = header_columns(spark, path)
    if columns is not None and tuple(columns) != found:
        raise ValueError(f"header of {path} is {found}, expected {tuple(columns)}")
    return text_schema(found)


Paths = str | list[str]


def _files(spark: SparkSession, path: Paths, multi_line: bool | None) -> tuple[list[str], list[str]]:
    """Paths to read by lines, and paths in which a record may span lines."""
    if multi_line is not None:
        given = [path] if isinstance(path, str) else path
        return ([], given) if multi_line else (given, [])
    files = line_breaks_by_file(spark, path)
    cut = [name for name, is_cut in files.items() if is_cut]
    return [name for name, is_cut in files.items() if not is_cut], cut


def _raw_records(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """The raw text of every record (column ``record``), as Spark's parser finds them over whole files.

    The parser hands out the raw text of malformed records only; with one column more than the files
    have, all of them are. Where a surplus field makes the width right, it has no date in it.
    """
    # With a wider schema the parser can't compare headers; this pass, by lines, parses no column.
    headers = _read(spark, paths, schema, "PERMISSIVE", columnPruning=False)
    headers.where(F.monotonically_increasing_id() < 0).isEmpty()
    surplus = T.StructField("q_surplus", T.DateType())
    wide = T.StructType([*schema.fields, surplus, T.StructField(CORRUPT_COLUMN, T.StringType())])
    rows = _read(spark, paths, wide, "PERMISSIVE", multiLine=True, enforceSchema=True, dateFormat="'surplus'")
    # The parser leaves a quote at the start of a value, with lines behind it, if it never closed.
    cells = [F.col(f"`{name}`") for name in schema.names]
    open_ = [F.startswith(cell, F.lit('"')) & F.contains(cell, F.lit("\n")) for cell in cells]
    again = [F.when(is_open, cell).otherwise(F.to_csv(F.struct(cell), _RECORD)) for cell, is_open in zip(cells, open_, strict=True)]
    return rows.select(F.coalesce(CORRUPT_COLUMN, F.concat_ws(",", *again, F.lit(""))).alias("record"))


def _unquoted(record: Column) -> Column:
    """A raw record without its well-formed quoted fields."""
    # Doubled quotes go first: what is left of a quoted field has none inside.
    return F.regexp_replace(F.replace(record, F.lit('""'), F.lit("")), rf'(?s){_OPEN_QUOTE}[^"]*+"(?![^,])', "")


def _lines(text: Column) -> Column:
    lines = F.split(F.replace(text, F.lit("\r\n"), F.lit("\n")), "\n")
    return F.filter(lines, lambda line: F.trim(line) != "")


def _is_one_record(record: Column, rest: Column, width: int) -> Column:
    """Whether a text of several lines can be one record: line breaks in well-formed quoted fields only.

    ``rest`` is the text without these. It can't where each of its lines, or the first of one that is
    too wide, makes a record already.
    """
    first = F.substring_index(record, "\n", 1)
    sound = ~F.contains(rest, F.lit("\n")) & ~F.contains(rest, F.lit("\r")) & ~rest.rlike(_OPEN_QUOTE)
    fields = _commas(rest) + 1
    alone = F.forall(_lines(record), lambda line: _commas(line) + 1 >= width)
    return sound & (fields >= width) & ~alone & ((fields == width) | (_commas(first) + 1 < width))


def _commas(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(",")))


def _single_records(records: DataFrame, width: int, strict: bool) -> DataFrame:
    """Column ``records`` with a list of the record as it is, or, where a stray quote took lines for one field,
    of its lines.

    With ``strict`` such a record fails.
    """
    record = F.col("record")
    several = F.contains(record, F.lit("\n"))
    # A column of its own, so that the pattern runs once per record.
    records = records.select("record", F.when(several, _unquoted(record)).alias("q_rest"))
    swallowed = several & ~_is_one_record(record, F.col("q_rest"), width)
    if strict:
        message = F.concat(F.lit("MALFORMED record, a quote opens and does not close: "), F.substring(record, 1, 200))
        record = F.when(swallowed, F.raise_error(message)).otherwise(record)
        return records.select(F.array(record).alias("records"))
    return records.select(F.when(swallowed, _lines(record)).otherwise(F.array(record)).alias("records"))


def _field_count(record: Column) -> Column:
    """Fields of a raw record: unquoted commas plus one."""
    return _commas(_unquoted(record)) + 1


def _from_csv(record: Column, columns: list[str], mode: str = "PERMISSIVE", **options) -> Column:
    names = [*columns, *([CORRUPT_COLUMN] if mode == "PERMISSIVE" else [])]
    ddl = ", ".join(f"`{name}` STRING" for name in names)
    return F.from_csv(record, ddl, {**_RECORD, "mode": mode, "columnNameOfCorruptRecord": CORRUPT_COLUMN, **options})


def _plain(raw: Column, columns: list[str]) -> Column:
    """A malformed record with a quote that doesn't close, parsed with quotes as characters like others."""
    return F.when(_unquoted(raw).rlike(_OPEN_QUOTE), _from_csv(raw, columns, quote=""))


def _parsed(lists: DataFrame, columns: list[str]) -> DataFrame:
    """Columns of text from lists of records, each of which has to be well formed."""
    each = lists.select(F.explode("records").alias("record"))
    return each.select(_from_csv(F.col("record"), columns, "FAILFAST").alias("q_row")).select("q_row.*")


def _parsed_flagged(lists: DataFrame, columns: list[str]) -> DataFrame:
    """Columns of text from lists of records, with those that ``_flagged`` adds.

    All parsing is inside the generator: a filter on what it gives can't be moved below it, where each of
    its mentions of a column would parse the record again.
    """
    rows = F.transform("records", lambda record: _from_csv(record, columns))
    both = F.transform(rows, lambda row: F.struct(row.alias("q_row"), _plain(row[CORRUPT_COLUMN], columns).alias("q_plain")))
    each = lists.select(F.inline(both))
    return _flagged(each, columns, lambda name: F.col("q_row")[name], F.col("q_plain"))


def _read_flagged(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """As ``_parsed_flagged``, of files read by lines."""
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT_COLUMN, T.StringType())])
    rows = _read(spark, paths, wide, "PERMISSIVE")
    held = rows.select("*", _plain(F.col(CORRUPT_COLUMN), schema.names).alias("q_plain"))
    return _flagged(held, schema.names, lambda name: F.col(f"`{name}`"), F.col("q_plain"))


def _flagged(rows: DataFrame, columns: list[str], parsed: Callable[[str], Column], plain: Column) -> DataFrame:
    """Rows with ``rejected`` and ``cut``; a quote that doesn't close is a character like others.

    A record with such a quote that has the right width once quotes mean nothing (``plain``) is taken so, and
    is whole. Of the others those with too few fields are rejected, the rest is kept and says that it was cut.
    """
    raw = parsed(CORRUPT_COLUMN)
    # Spark refuses a CSV query that needs the raw record alone, as a row count would; the first
    # condition always holds and makes every such query read one more column.
    readable = F.length(F.coalesce(parsed(columns[0]), F.lit(""))) >= 0
    fits = plain.isNotNull() & plain[CORRUPT_COLUMN].isNull()
    malformed = readable & raw.isNotNull() & ~fits
    short = _field_count(raw) < len(columns)
    return rows.select(
        *(F.when(fits, plain[name]).otherwise(parsed(name)).alias(name) for name in columns),
        F.when(malformed, raw).alias(CORRUPT_COLUMN),
        F.coalesce(malformed & short, F.lit(False)).alias("rejected"),
        F.coalesce(malformed & ~short, F.lit(False)).alias("cut"),
    )


def read_text_csv(
    spark: SparkSession, path: Paths, columns: tuple[str, ...] | None = None, multi_line: bool | None = None
) -> DataFrame:
    """Read an extract that must be well formed; a malformed row fails the job.

    ``columns`` is the expected header, checked by exact name and order; by default whatever the
    header says. A file with line breaks inside fields cannot be split among tasks, so by
    default (``multi_line=None``) only the files that may have some are read in one piece.
    """
    schema = _schema(spark, path, columns)
    by_lines, whole = _files(spark, path, multi_line)
    parts = [_read(spark, by_lines, schema, "FAILFAST")] if by_lines else []
    if whole:
        records = _single_records(_raw_records(spark, whole, schema), len(schema), strict=True)
        parts.append(_parsed(records, schema.names))
    return reduce(DataFrame.union, parts)


def read_text_csv_flagged(
    spark: SparkSession, path: Paths, columns: tuple[str, ...] | None = None, multi_line: bool | None = None
) -> DataFrame:
    """Read an extract with malformed rows in one pass: its columns, the raw record of every
    malformed row, and ``rejected``.

    A row with too few fields is rejected. One with too many is cut to the width and kept, and
    ``cut`` says so: what was cut off is in the raw record. A quote that opens a field and never closes
    swallows no row: a record of several lines stays one only if all its quoted fields are well
    formed and its lines aren't wide enough to be records; if not, each of its lines is a record, in
    which such a quote is a plain character.
    """
    schema = _schema(spark, path, columns)
    by_lines, whole = _files(spark, path, multi_line)
    parts = []
    if by_lines:
        parts.append(_read_flagged(spark, by_lines, schema))
    if whole:
        records = _single_records(_raw_records(spark, whole, schema), len(schema), strict=False)
        parts.append(_parsed_flagged(records, schema.names))
    return reduce(DataFrame.union, parts)


def read_text_csv_tolerant(
    spark: SparkSession, path: Paths, columns: tuple[str, ...] | None = None, multi_line: bool | None = None
) -> tuple[DataFrame, DataFrame]:
    """Read an extract with malformed rows; returns (rows, rejects with their raw record)."""
    rows = read_text_csv_flagged(spark, path, columns, multi_line)
    kept = rows.where(~F.col("rejected")).drop(CORRUPT_COLUMN, "rejected", "cut")
    rejects = rows.where("rejected").select(F.col(CORRUPT_COLUMN).alias("record"), rows.columns[0])
    return kept, rejects


def csv_records(rows: DataFrame) -> DataFrame:
    """Each row as one CSV record in the dialect of the extracts (column ``record``)."""
    return rows.select(F.to_csv(F.struct("*"), _RECORD).alias("record"))


def parse_csv_records(records: DataFrame, columns: tuple[str, ...], tolerant: bool = False) -> DataFrame:
    """Columns of text from column ``record``, by the rules of the readers above.

    A malformed record fails; with ``tolerant`` a short one is left out and a long one cut, and lines that
    a stray quote made one record are records again.
    """
    single, names = _single_records(records, len(columns), strict=not tolerant), list(columns)
    if not tolerant:
        return _parsed(single, names)
    return _parsed_flagged(single, names).where(~F.col("rejected")).select(*(F.col(f"`{c}`") for c in names))


def require_rows(df: DataFrame, name: str) -> DataFrame:
    """Stop early on an empty extract; stops at the first row it finds."""
    if df.isEmpty():
        raise MissingExtract(f"{name} has no rows")
    return df
