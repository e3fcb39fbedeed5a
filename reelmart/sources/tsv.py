"""COPY text dialect: tab-separated, ``\\N`` for NULL, one header line, no quoting,
backslash escapes.

Line 1 of every file is the header, whatever it says. Two scans, both splitting large
files into line-aligned partitions that all executors read:

* ``scan_landing`` is the loaders' scan. It reads every line once with the text source,
  parses it, and refuses a line of white space only, which is an error in this dialect. Which
  line came first is not known inside a scan, but equal lines are interchangeable: lines
  that equal some file's header are marked, the loader counts them in the same job, and
  as many as there are headers are no rows (``header_rows`` gives back the others).
* ``read_copy_text`` is a lazy table for ad-hoc reading, by the one-column CSV source with
  quoting off and a separator (NUL) that cannot stand in COPY text: it drops the first
  line of each file, but also skips lines of white space only.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmart.constants import FIELD_SEPARATOR, NULL_MARKER, RAW_COLUMNS

END_OF_DATA = "\\."  # a line of its own that marks the end; dropped

# FIXED VALUES: COPY text escapes, (letter after the backslash, character).
_ESCAPES = [
    ("t", "\t"),
    ("n", "\n"),
    ("r", "\r"),
    ("b", "\b"),
    ("f", "\f"),
    ("v", "\v"),
]
_TOKEN = r"(?s)\\x[0-9A-Fa-f]{1,2}|\\[0-7]{1,3}|\\.|[^\\]+|\\"


def _replace(col: Column, search: str, repl: str) -> Column:
    return F.replace(col, F.lit(search), F.lit(repl))


def _token_hex(token: Column) -> Column:
    """UTF-8 bytes, in hex, that one piece of a field stands for."""
    octal = F.conv(F.substr(token, F.lit(2)), 8, 10).cast("int") % 256
    out = F.when(token.rlike(r"^\\x[0-9A-Fa-f]"), F.lpad(F.substr(token, F.lit(3)), 2, "0"))
    out = out.when(token.rlike(r"^\\[0-7]"), F.lpad(F.hex(octal.cast("long")), 2, "0"))
    for letter, char in _ESCAPES:
        out = out.when(token == "\\" + letter, F.hex(F.encode(F.lit(char), "UTF-8")))
    out = out.when(token.startswith("\\") & (F.length(token) > 1), F.hex(F.encode(F.substr(token, F.lit(2)), "UTF-8")))
    return out.otherwise(F.hex(F.encode(token, "UTF-8")))


def unescape(col: Column) -> Column:
    """Undo COPY text escaping, octal and hexadecimal bytes included; fields without a backslash pass through untouched."""
    pieces = F.transform(F.regexp_extract_all(col, F.lit(_TOKEN), F.lit(0)), _token_hex)
    return F.when(F.instr(col, "\\") > 0, F.decode(F.unhex(F.array_join(pieces, "")), "UTF-8")).otherwise(col)


def escape(col: Column) -> Column:
    """COPY text escaping of one field; NULL becomes the ``\\N`` marker."""
    out = _replace(col, "\\", "\\\\")
    for letter, char in _ESCAPES[:3]:
        out = _replace(out, char, "\\" + letter)
    return F.coalesce(out, F.lit(NULL_MARKER))


def read_copy_text(spark: SparkSession, path: str | list[str], table: str) -> DataFrame:
    """Read COPY-text landing file(s) at ``path`` as the raw table ``table``.

    Every column is text; ``\\N`` is NULL; escapes are undone; a row with the
    wrong number of fields fails the job (the whole load aborts, as COPY does).
    """
    lines = (spark.read.schema("value string").option("header", True).option("sep", "\u0000").option("quote", "")
             .option("lineSep", "\n").option("mode", "FAILFAST").csv(path))
    return parse_copy_lines(lines, table)


#: Column that marks lines equal to a file's header: the header's number.
HEADER = "_header"
BLANK_LINE = "line of white space only"


def _text(spark: SparkSession, files: str | list[str]) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(files)


def header_lines(spark: SparkSession, files: list[str], parallel: int = 8) -> dict[str, int]:
    """First line -> number of files that begin with it; only the head of each file is read."""
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        heads = list(pool.map(lambda f: _text(spark, f).head(1), files))
    out: dict[str, int] = {}
    for head in heads:
        if head:
            out[head[0].value] = out.get(head[0].value, 0) + 1
    return out


def scan_landing(spark: SparkSession, path: str | list[str], table: str) -> tuple[DataFrame, dict[str, int]]:
    """The landing file(s) as the raw table ``table`` plus the column ``HEADER``, and the headers with their numbers of files.

    Rows with a non-null ``HEADER`` are header lines and lines that equal one: the i-th of the
    headers. A bad field count or a line of white space only fails the job that reads them.
    """
    headers = header_lines(spark, [unquote(f) for f in _text(spark, path).inputFiles()])  # given as URLs
    line = F.col("value")
    mark = F.lit(None).cast("int")
    for i, text in enumerate(headers):
        mark = F.when(line == text, i).otherwise(mark)
    blank = F.raise_error(F.concat(F.lit(f"{table}: {BLANK_LINE} in "), F.col("_metadata.file_name")))
    checked = F.when(mark.isNull() & ~line.rlike(r"[^\x00-\x20]"), blank).otherwise(line)
    return parse_copy_lines(_text(spark, path).select(checked.alias("value"), mark.alias(HEADER)), table, HEADER), headers


def header_rows(spark: SparkSession, text: str, copies: int, table: str) -> DataFrame:
    """Rows of ``copies`` data lines that equal the header ``text``."""
    return parse_copy_lines(spark.range(copies).select(F.lit(text).alias("value")), table)


def parse_copy_lines(lines: DataFrame, table: str, mark: str | None = None) -> DataFrame:
    """Parse text lines (``value`` column, header already gone) into the raw table.

    ``mark``: a column to keep; lines where it is not null are not parsed.
    """
    columns = RAW_COLUMNS[table]
    line = F.col("value")
    value = F.when(line.endswith("\r"), F.substring(line, F.lit(1), F.length(line) - 1)).otherwise(line)
    fields = F.split(value, FIELD_SEPARATOR, -1)
    checked = F.when(
        F.size(fields) == len(columns), fields
    ).otherwise(F.raise_error(F.concat(
        F.lit(f"{table}: expected {len(columns)} fields, got "), F.size(fields).cast("string"), F.lit(": "), value)))
    if mark:
        checked = F.when(F.col(mark).isNull(), checked)
    parsed = lines.filter(value != END_OF_DATA).select(checked.alias("_f"), *([mark] if mark else []))
    out = [F.col(mark)] if mark else []
    for i, name in enumerate(columns):
        raw = F.col("_f").getItem(i)
        out.append(F.when(raw == F.lit(NULL_MARKER), F.lit(None).cast("string"))
                   .otherwise(unescape(raw)).alias(name))
    return parsed.select(*out[1:], out[0]) if mark else parsed.select(*out)


def write_copy_text(df: DataFrame, path: str, table: str | None = None, mode: str = "overwrite") -> None:
    """Write ``df`` in the COPY text dialect, one header line per output file.

    Each row is formatted into one line by built-in expressions; the CSV sink is
    only used to emit the header, with a separator that cannot occur in a line,
    so no quoting is ever applied.
    """
    columns = RAW_COLUMNS[table] if table else df.columns
    line = F.concat_ws(FIELD_SEPARATOR, *[escape(F.col(c).cast("string")) for c in columns])
    (df.select(line.alias(FIELD_SEPARATOR.join(columns)))
       .write.mode(mode)
       .option("header", True)
       .option("sep", "\u0001")
       .option("quote", "\u0000")
       .option("escapeQuotes", False)
       .option("ignoreLeadingWhiteSpace", False)
       .option("ignoreTrailingWhiteSpace", False)
       .csv(path))


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` is a file, or a folder with at least one data file."""
    try:
        return bool(spark.read.text(path).inputFiles())  # file listing only, on the driver
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            return False
        raise
