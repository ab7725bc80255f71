"""What failed and why: expressions over the text columns of a load log."""

from __future__ import annotations

import builtins
import errno
import json
from collections.abc import Iterator
from functools import cache, reduce

import pyarrow.lib
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, functions as F

from snapdelta.functions.text import lines, once, one_spaced, strip

# Lower-case pieces of messages that mark a schema or logic failure.
SCHEMA_MARKERS = (
    "table schema does not match",
    "schema does not match schema used to create file",
    "extract/schema mismatch",
    "merging arrow schema",
    "column hints were different",
    "undefinedcolumn",
    "syntax error at",
    "programmingerror",
    "duplicate key value violates unique constraint",
)
# Lower-case pieces of messages that mark a passing fault.
TRANSIENT_MARKERS = (
    "content-length",
    "number of bytes specified",
    "connection lost",
    "broken pipe",
    "connection reset",
    "reset by peer",
    "cannot allocate memory",
    "no space left",
    "timed out",
    "timeout",
    "slowdown",
    "throttl",
    "please reduce your request rate",
    "ssl syscall",
    "eof detected",
    "could not receive data from server",
    "server closed the connection unexpectedly",
)
# Storage error codes, exception types and OS error numbers of passing faults.
TRANSIENT_CODES = (
    "Throttling",
    "SlowDown",
    "RequestTimeout",
    "ServiceUnavailable",
    "InternalError",
    "EC2ThrottledException",
)
TRANSIENT_TYPES = ("BrokenPipeError", "TimeoutError")
TRANSIENT_ERRNOS = ("12", "28", "32", "104", "110")
NO_SPACE_ERRNO = "28"

# Texts of a digest line.
MISMATCH_START = "Table schema does not match"
METADATA_START = "-- schema metadata --"
NO_SPACE_TEXT = "No space left on device"
NO_SPACE_SUMMARY = "Disk full (errno 28 No space left on device)"
UNREADABLE_MISMATCH = "Arrow schema mismatch (see logs for full dump)"
METADATA_MISMATCH = "Arrow schema mismatch — column sets equal but metadata differs (see logs)"
MISMATCH_PREFIX = "Extract/schema mismatch: "
WRAPPER_STARTS = ("Pipeline execution failed", "step=")

# Unicode whitespace for patterns, spelled out so that every regex dialect reads it alike.
SPACE = (
    r"[\t-\r\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)


@cache
def kinds_of(base: str) -> tuple[str, ...]:
    """The names of an exception type and of the types derived from it, as far as a log names them: Python's own,
    those of JSON and those of Arrow."""
    modules = (builtins, json, pyarrow.lib)
    known = {each for module in modules for each in vars(module).values() if isinstance(each, type) and issubclass(each, BaseException)}
    return tuple(sorted({base} | {each.__name__ for each in known if any(parent.__name__ == base for parent in each.__mro__)}))


def _kinds_of_any(bases) -> list[str]:
    return sorted({name for base in bases for name in kinds_of(base)})


def _any_of(text: Column, pieces) -> Column:
    return reduce(lambda left, right: left | right, [F.contains(text, F.lit(p)) for p in pieces])


def with_parsed_entry(df: DataFrame, entry: str, name: str = "parsed") -> DataFrame:
    """Add ``db.schema.table: ExcType: message`` as a struct; NULL when it has fewer than three parts."""
    fields = F.struct(
        F.get("_parts", F.lit(0)).alias("table_ref"),
        F.get("_parts", F.lit(1)).alias("exc_type"),
        F.get("_parts", F.lit(2)).alias("detail"),
    )
    # The split is a column of its own, so that it runs once per row.
    parts = df.withColumn("_parts", F.split(F.col(entry), ": ", 3))
    return parts.withColumn(name, F.when(F.size("_parts") == 3, fields)).drop("_parts")


def _extracted(text: Column, start: str, pattern: str, group: int = 1) -> Column:
    """A regex group, blank without a match; the regex only sees texts that hold its fixed start."""
    found = F.regexp_extract(text, pattern, group)
    return F.when(F.contains(text, F.lit(start)), found).otherwise("")


def error_number(message: Column) -> Column:
    """The number in ``[Errno N]``, blank when there is none."""
    return _extracted(message, "[Errno", r"\[Errno\s+([0-9]+)\]")


def error_code(message: Column) -> Column:
    """The code in ``An error occurred (Code) ...``, blank when there is none."""
    return _extracted(message, "An error occurred (", r"An error occurred \(([A-Za-z0-9]+)\)")


def _is_schema_failure(exc_type: Column, message: Column) -> Column:
    text = F.lower(message)
    by_type = exc_type.isin(*kinds_of("ValueError")) & F.contains(text, F.lit("schema")) & F.contains(text, F.lit("match"))
    return by_type | _any_of(text, SCHEMA_MARKERS)


def _is_transient(exc_type: Column, message: Column) -> Column:
    text = F.lower(message)
    bad_length = (error_number(message) == "22") & F.contains(text, F.lit("number of bytes"))
    return (
        exc_type.isin(*_kinds_of_any(TRANSIENT_TYPES))
        | _any_of(text, TRANSIENT_MARKERS)
        | error_code(message).isin(*TRANSIENT_CODES)
        | error_number(message).isin(*TRANSIENT_ERRNOS)
        | bad_length
    )


def _classes(schema: Column, transient: Column) -> Column:
    return F.when(schema, "schema").when(transient, "transient").otherwise("fatal")


def failure_class(exc_type: Column | str, message: Column | str) -> Column:
    """``schema`` (never retry), ``transient`` (worth a retry) or ``fatal``; schema marks win."""
    exc_type = F.col(exc_type) if isinstance(exc_type, str) else exc_type
    message = F.col(message) if isinstance(message, str) else message
    return _classes(_is_schema_failure(exc_type, message), _is_transient(exc_type, message))


def chain_class(chain: Column | str) -> Column:
    """The class of a whole cause chain: an array of ``struct<exc_type, message>``."""
    chain = F.col(chain) if isinstance(chain, str) else chain

    def any_link(test) -> Column:
        return F.exists(chain, lambda link: test(link["exc_type"], link["message"]))

    return _classes(any_link(_is_schema_failure), any_link(_is_transient))


def chain_exhaustion(chain: Column | str) -> Column:
    """Whether any link of a cause chain is out of memory or disk space."""
    chain = F.col(chain) if isinstance(chain, str) else chain
    return F.exists(chain, lambda link: is_exhaustion(link["exc_type"], link["message"]))


def cause_chain(error: BaseException) -> list[BaseException]:
    """An error, what it was raised from or while handling, and so on; each once."""
    found: list[BaseException] = []
    while error is not None and all(error is not each for each in found):
        found.append(error)
        error = error.__cause__ or error.__context__
    return found


def _links(error: BaseException) -> Iterator[tuple[set[str], str]]:
    """The names of the type and its ancestors, and the message, of each link; a JVM error goes on with its causes."""
    for each in cause_chain(error):
        yield {kind.__name__ for kind in type(each).__mro__}, str(each)
        below = each.java_exception if isinstance(each, Py4JJavaError) else getattr(each, "_origin", None)
        depth = 0
        while below is not None and depth < 50:
            yield {below.getClass().getSimpleName()}, str(below.getMessage() or "")
            below, depth = below.getCause(), depth + 1


def _has_any(text: str, pieces) -> bool:
    return any(piece in text for piece in pieces)


def _schema_link(kinds: set[str], text: str) -> bool:
    return ("ValueError" in kinds and "schema" in text and "match" in text) or _has_any(text, SCHEMA_MARKERS)


def _passing_error(error: BaseException) -> bool:
    """The tests on an error object that its text need not show: its number, and a storage service's code."""
    if isinstance(error, OSError) and error.errno is not None:
        if str(error.errno) in TRANSIENT_ERRNOS:
            return True
        if error.errno == errno.EINVAL and _has_any(str(error).lower(), ("content-length", "number of bytes")):
            return True
    response = getattr(error, "response", None)
    return isinstance(response, dict) and (response.get("Error") or {}).get("Code") in TRANSIENT_CODES


def error_class(error: BaseException) -> str:
    """``failure_class`` of an error at hand, by its whole cause chain and the ancestors of its types."""
    links = [(kinds, text.lower()) for kinds, text in _links(error)]
    if any(_schema_link(kinds, text) for kinds, text in links):
        return "schema"
    by_text = any(kinds & set(TRANSIENT_TYPES) or _has_any(text, TRANSIENT_MARKERS) for kinds, text in links)
    return "transient" if by_text or any(map(_passing_error, cause_chain(error))) else "fatal"


def is_exhausted(error: BaseException) -> bool:
    """``is_exhaustion`` of an error at hand, by its whole cause chain."""
    return any(isinstance(each, MemoryError) or (isinstance(each, OSError) and each.errno == errno.ENOSPC) for each in cause_chain(error))


def is_exhaustion(exc_type: Column | str, message: Column | str) -> Column:
    """Out of memory or out of disk space."""
    exc_type = F.col(exc_type) if isinstance(exc_type, str) else exc_type
    message = F.col(message) if isinstance(message, str) else message
    return (
        exc_type.isin(*kinds_of("MemoryError"))
        | (error_number(message) == NO_SPACE_ERRNO)
        | F.contains(message, F.lit(NO_SPACE_TEXT))
    )


def _spaced(text: Column) -> Column:
    return one_spaced(strip(text))


def block_columns(block: Column) -> Column:
    """``name: type`` lines of a schema dump as an array of structs, metadata and noise left out."""
    described = F.substring_index(block, METADATA_START, 1)
    useful = F.filter(lines(described), lambda line: ~line.startswith("--") & F.contains(line, F.lit(": ")))
    pairs = F.transform(
        useful,
        lambda line: F.struct(
            strip(F.substring_index(line, ": ", 1)).alias("name"),
            strip(F.substring(line, F.instr(line, ": ") + 2, F.char_length(line))).alias("type"),
        ),
    )
    return F.filter(pairs, lambda pair: (pair["name"] != "") & (F.lower(pair["name"]) != "pandas"))


def column_differences(in_table: Column, in_file: Column) -> Column:
    """One text per column whose type differs or that one side lacks, by column name."""

    def names(columns: Column) -> Column:
        return F.transform(columns, lambda c: c["name"])

    def type_in(columns: Column, name: Column) -> Column:
        # A repeated line counts as its last one.
        return F.try_element_at(F.filter(columns, lambda c: c["name"] == name), F.lit(-1))["type"]

    def text(c: Column) -> Column:
        of_table, of_file = _spaced(c["of_table"]), _spaced(c["of_file"])
        lacks_table = F.concat(F.lit(" (missing in table chunk, file="), of_file)
        lacks_file = F.concat(F.lit(" (missing in file, table="), of_table)
        differs = F.concat(F.lit(" (table="), of_table, F.lit(" vs file="), of_file)
        return F.concat(c["name"], F.coalesce(differs, lacks_table, lacks_file), F.lit(")"))

    every = F.sort_array(F.array_distinct(F.concat(names(in_table), names(in_file))))
    compared = F.transform(
        every,
        lambda name: F.struct(
            name.alias("name"),
            type_in(in_table, name).alias("of_table"),
            type_in(in_file, name).alias("of_file"),
        ),
    )
    unequal = F.filter(compared, lambda c: ~c["of_table"].eqNullSafe(c["of_file"]))
    return F.transform(unequal, text)


def with_mismatch_summary(df: DataFrame, detail: str, name: str = "mismatch") -> DataFrame:
    """Add a schema-mismatch dump as one line; NULL for other texts.

    The steps are columns of their own, so that each is worked out once per row.
    """
    table_mark, file_mark = rf"(?dm)^table:{SPACE}*\n", rf"(?dm)^file:{SPACE}*\n"
    unix_lines = F.replace(F.col(detail), F.lit("\r\n"), F.lit("\n"))
    is_mismatch = F.contains(F.col(detail), F.lit(MISMATCH_START))
    dump = F.when(is_mismatch, F.regexp_extract(unix_lines, f"(?s){MISMATCH_START}.*", 0))
    steps = df.withColumn("_around_table", F.split(dump, table_mark, 2))
    steps = steps.withColumn("_around_file", F.split(F.get("_around_table", F.lit(1)), file_mark, 2))
    before, in_table, in_file = (
        F.get("_around_table", F.lit(0)),
        F.get("_around_file", F.lit(0)),
        F.get("_around_file", F.lit(1)),
    )
    readable = in_file.isNotNull() & (in_table != "") & ~before.rlike(file_mark)
    steps = steps.withColumn("_in_table", F.when(readable, block_columns(in_table)))
    steps = steps.withColumn("_in_file", F.when(readable, block_columns(in_file)))
    found = F.size("_in_table") + F.size("_in_file")
    steps = steps.withColumn(
        "_differences", F.when(found > 0, column_differences(F.col("_in_table"), F.col("_in_file")))
    )
    summary = (
        F.when(F.col("_around_table").isNull(), None)
        .when(F.col("_differences").isNull(), UNREADABLE_MISMATCH)
        .when(F.size("_differences") == 0, METADATA_MISMATCH)
        .otherwise(F.concat(F.lit(MISMATCH_PREFIX), F.array_join("_differences", "; ")))
    )
    return steps.withColumn(name, summary).drop(
        "_around_table", "_around_file", "_in_table", "_in_file", "_differences"
    )


def system_summary(detail: Column | str) -> Column:
    """Disk-full and OS errors as one line; NULL for other texts."""
    detail = F.col(detail) if isinstance(detail, str) else detail
    pattern = rf"\[Errno{SPACE}+([0-9]+)\]{SPACE}*([^\n]+)"
    number = _extracted(detail, "[Errno", pattern)
    text = _spaced(_extracted(detail, "[Errno", pattern, 2))
    return F.when(F.contains(detail, F.lit(NO_SPACE_TEXT)), NO_SPACE_SUMMARY).when(
        number != "", F.concat(F.lit("OS error errno="), number, F.lit(" "), text)
    )


def with_plain_summary(df: DataFrame, detail: str, name: str = "plain") -> DataFrame:
    """Add the first telling line of a message: wrapper lines skipped, whitespace collapsed."""

    def telling(line: Column) -> Column:
        return ~reduce(lambda a, b: a | b, [line.startswith(start) for start in WRAPPER_STARTS])

    text = strip(detail)
    unwrapped = F.regexp_replace(text, rf"^<class '[^']+'>{SPACE}*\n?", "")
    text = F.when(text.startswith("<class '"), unwrapped).otherwise(text)
    first_telling = F.get(F.filter("_lines", telling), F.lit(0))
    line = F.coalesce(first_telling, F.get("_lines", F.lit(0)), F.lit(""))
    return df.withColumn("_lines", lines(text)).withColumn(name, one_spaced(line)).drop("_lines")


def with_digest(df: DataFrame, entry: str, name: str = "digest") -> DataFrame:
    """Add one line per failure: ``table — exception — summary``, whole."""
    steps = with_parsed_entry(df, entry, "_parsed").withColumn("_detail", F.col("_parsed.detail"))
    steps = with_mismatch_summary(steps, "_detail", "_mismatch")
    steps = steps.withColumn("_special", F.coalesce("_mismatch", system_summary("_detail")))
    # Only messages that are neither are read line by line.
    steps = steps.withColumn("_message", F.when(F.col("_special").isNull(), F.col("_detail")))
    steps = with_plain_summary(steps, "_message", "_plain")
    summary = F.coalesce("_special", "_plain")
    line = F.concat("_parsed.table_ref", F.lit(" — "), "_parsed.exc_type", F.lit(" — "), summary)
    return steps.withColumn(name, F.coalesce(line, F.col(entry))).drop(
        "_parsed", "_detail", "_mismatch", "_special", "_message", "_plain"
    )
