"""Failure texts: parsed, classified and summed up, over whole documents as error messages."""

from __future__ import annotations

from pyspark.sql import functions as F

from snapdelta.operators import failures
from snapdelta.queries.inputs import table
from snapdelta.queries.registry import query

# One failure per document. The whole text is part of its message. The SQL reads the same in both dialects.
_NL = "chr(10)"
_ENTRY = f"""CASE doc_id % 10
  WHEN 0 THEN concat(source, '.public.', lang, ': RuntimeError: Table schema does not match schema used to create file:',
      {_NL}, 'table:', {_NL}, 'doc_id: int64', {_NL}, lang, ': string', {_NL}, 'n_chars: int64', {_NL},
      'pandas: x', {_NL}, '-- schema metadata --', {_NL}, 'noise: y', {_NL},
      'file:', {_NL}, 'doc_id: string', {_NL}, 'n_chars: int64', {_NL}, source, ': double', {_NL},
      '-- schema metadata --', {_NL}, text)
  WHEN 1 THEN concat(source, '.public.', lang, ': ValueError: <class ''ValueError''>', {_NL},
      'Pipeline execution failed at load', {_NL}, 'step=load', {_NL}, '  ', text)
  WHEN 2 THEN concat(source, '.public.', lang, ': OSError: [Errno 28] No space left on device: ', text)
  WHEN 3 THEN concat(source, '.public.', lang, ': OSError: [Errno 104]  ', text)
  WHEN 4 THEN concat(source, '.public.', lang,
      ': ClientError: An error occurred (SlowDown) when calling the PutObject operation: ', text)
  WHEN 5 THEN concat(source, '.public.', lang, ': ProgrammingError: (UndefinedColumn) ', text)
  WHEN 6 THEN concat(source, '.public.', lang, ': TimeoutError: ', text)
  WHEN 7 THEN concat(source, '.public.', lang, ': MemoryError: ', text)
  WHEN 8 THEN concat(source, '.public.', lang, ': RuntimeError: ', text)
  ELSE concat(source, ' ', text) END"""
_FAILURES = f"SELECT doc_id, {_ENTRY} AS entry FROM {{0}}"

# Entries cut at their first two ": " in plain SQL.
_PARSED = f"""SELECT doc_id, entry, first > 0 AND second > 0 AS is_parsed,
      CASE WHEN first > 0 AND second > 0 THEN substr(entry, 1, first - 1) END AS table_ref,
      CASE WHEN first > 0 AND second > 0 THEN substr(rest, 1, second - 1) END AS exc_type,
      CASE WHEN first > 0 AND second > 0 THEN substr(rest, second + 2) END AS detail
  FROM (SELECT *, strpos(rest, ': ') AS second
        FROM (SELECT *, strpos(entry, ': ') AS first, substr(entry, strpos(entry, ': ') + 2) AS rest
              FROM ({_FAILURES.format("documents")})))"""


def _entries(spark, folder):
    return spark.sql(_FAILURES.format("{documents}"), documents=table(spark, folder, "documents"))


def _parsed(spark, folder):
    entries = failures.with_parsed_entry(_entries(spark, folder), "entry")
    return entries.select("doc_id", "entry", F.col("parsed").isNotNull().alias("is_parsed"), "parsed.*")


@query("parse_failure", f"SELECT doc_id, is_parsed, table_ref, exc_type, detail FROM ({_PARSED})")
def parse_failure(spark, folder):
    return _parsed(spark, folder).drop("entry")


def _whole(spark, folder):
    """Every entry with its type and message; one that does not parse is all message."""
    parsed = _parsed(spark, folder)
    exc_type, detail = F.coalesce("exc_type", F.lit("")), F.coalesce("detail", "entry")
    return parsed.select("doc_id", exc_type.alias("exc_type"), detail.alias("detail"))


def _contains_any(pieces) -> str:
    return "(" + " OR ".join(f"contains(lower(detail), '{piece}')" for piece in pieces) + ")"


@query(
    "classify_failure",
    f"""SELECT doc_id, CASE
          WHEN {_contains_any(failures.SCHEMA_MARKERS)} OR (exc_type = 'ValueError'
               AND contains(lower(detail), 'schema') AND contains(lower(detail), 'match')) THEN 'schema'
          WHEN {_contains_any(failures.TRANSIENT_MARKERS)} OR exc_type IN ('BrokenPipeError', 'TimeoutError')
               OR regexp_extract(detail, 'An error occurred \\(([A-Za-z0-9]+)\\)', 1) IN ('Throttling', 'SlowDown',
                  'RequestTimeout', 'ServiceUnavailable', 'InternalError', 'EC2ThrottledException')
               OR regexp_extract(detail, '\\[Errno\\s+([0-9]+)\\]', 1) IN ('12', '28', '32', '104', '110')
               OR (regexp_extract(detail, '\\[Errno\\s+([0-9]+)\\]', 1) = '22'
                   AND contains(lower(detail), 'number of bytes')) THEN 'transient'
          ELSE 'fatal' END AS failure_class
        FROM (SELECT doc_id, COALESCE(exc_type, '') AS exc_type, COALESCE(detail, entry) AS detail FROM ({_PARSED}))""",
)
def classify_failure(spark, folder):
    parsed = _whole(spark, folder)
    return parsed.select("doc_id", failures.failure_class("exc_type", "detail").alias("failure_class"))


@query(
    "exhaustion_flag",
    f"""SELECT doc_id, exc_type = 'MemoryError' OR contains(detail, 'No space left on device')
               OR regexp_extract(detail, '\\[Errno\\s+([0-9]+)\\]', 1) = '28' AS is_exhausted
        FROM (SELECT doc_id, COALESCE(exc_type, '') AS exc_type, COALESCE(detail, entry) AS detail FROM ({_PARSED}))""",
)
def exhaustion_flag(spark, folder):
    parsed = _whole(spark, folder)
    return parsed.select("doc_id", failures.is_exhaustion("exc_type", "detail").alias("is_exhausted"))


# A chain of three: the wrapper a job raises, the entry's own error, and what that was raised from.
_ROOT_TYPE = "CASE doc_id % 4 WHEN 0 THEN 'ArrowInvalid' WHEN 1 THEN 'ConnectionResetError' WHEN 2 THEN 'BrokenPipeError' ELSE 'KeyError' END"
_ROOT_TEXT = "CASE WHEN doc_id % 8 = 0 THEN 'Schema at index 1 did not match: timeout' ELSE lang END"


def _either(test: str) -> str:
    own, root = test, test.replace("exc_type", "root_type").replace("detail", "root_text")
    return f"(({own}) OR ({root}))"


@query(
    "chain_class",
    f"""SELECT doc_id, CASE
          WHEN {_either(_contains_any(failures.SCHEMA_MARKERS) + " OR (exc_type IN ('ValueError', 'ArrowInvalid') AND contains(lower(detail), 'schema') AND contains(lower(detail), 'match'))")}
            THEN 'schema'
          WHEN {_either(_contains_any(failures.TRANSIENT_MARKERS) + " OR exc_type IN ('BrokenPipeError', 'TimeoutError')")}
               OR regexp_extract(detail, 'An error occurred \\(([A-Za-z0-9]+)\\)', 1) IN ('Throttling', 'SlowDown',
                  'RequestTimeout', 'ServiceUnavailable', 'InternalError', 'EC2ThrottledException')
               OR regexp_extract(detail, '\\[Errno\\s+([0-9]+)\\]', 1) IN ('12', '28', '32', '104', '110') THEN 'transient'
          ELSE 'fatal' END AS failure_class,
          exc_type = 'MemoryError' OR contains(detail, 'No space left on device')
            OR regexp_extract(detail, '\\[Errno\\s+([0-9]+)\\]', 1) = '28' AS is_exhausted
        FROM (SELECT doc_id, COALESCE(exc_type, '') AS exc_type, COALESCE(detail, entry) AS detail, {_ROOT_TYPE} AS root_type,
                     {_ROOT_TEXT} AS root_text FROM ({_PARSED}) JOIN (SELECT doc_id, lang FROM documents) USING (doc_id))""",
)
def chain_class(spark, folder):
    """Every entry as the middle of a cause chain: any link decides, and a type counts as its ancestors."""
    def link(exc_type, message):
        return F.struct(exc_type.alias("exc_type"), message.alias("message"))

    langs = table(spark, folder, "documents").select("doc_id", "lang")
    whole = _whole(spark, folder).join(langs, "doc_id")
    wrapper = link(F.lit("LoadError"), F.lit("step=load"))
    chain = F.array(wrapper, link(F.col("exc_type"), F.col("detail")), link(F.expr(_ROOT_TYPE), F.expr(_ROOT_TEXT)))
    chained = whole.select("doc_id", chain.alias("chain"))
    return chained.select("doc_id", failures.chain_class("chain").alias("failure_class"), failures.chain_exhaustion("chain").alias("is_exhausted"))


_SP = failures.SPACE
_BREAK = r"\r\n|[\n-\r\x{1C}-\x{1E}\x{85}\x{2028}\x{2029}]"


def _spaced(text: str) -> str:
    return f"regexp_replace({text}, '{_SP}+', ' ', 'g')"


def _strip(text: str) -> str:
    return f"regexp_replace({text}, '^{_SP}+|{_SP}+$', '', 'g')"


# The name and type lines of both blocks as rows, the last of repeated ones kept.
_BLOCK_LINES = f"""SELECT doc_id, side, name, arg_max(type, pos) AS type FROM (
    SELECT doc_id, side, pos, {_strip("split_part(line, ': ', 1)")} AS name,
           {_strip("substr(line, strpos(line, ': ') + 2)")} AS type
    FROM (SELECT doc_id, side, generate_subscripts(lines, 1) AS pos, {_strip("unnest(lines)")} AS line
          FROM (SELECT doc_id, side, string_split(split_part(block, '-- schema metadata --', 1), chr(10)) AS lines
                FROM blocks))
    WHERE contains(line, ': ') AND NOT starts_with(line, '--'))
  WHERE name <> '' AND lower(name) <> 'pandas' GROUP BY ALL"""

_MISMATCH = f"""dumps AS (
    SELECT doc_id, substr(replace(detail, chr(13) || chr(10), chr(10)),
             strpos(replace(detail, chr(13) || chr(10), chr(10)), 'Table schema does not match')) AS dump
    FROM parsed WHERE contains(detail, 'Table schema does not match')),
  blocks AS (
    SELECT doc_id, unnest(['table', 'file']) AS side, unnest([
      regexp_extract(dump, '(?ms)^table:{_SP}*\\n(.*?)^file:{_SP}*\\n(.*)', 1),
      regexp_extract(dump, '(?ms)^table:{_SP}*\\n(.*?)^file:{_SP}*\\n(.*)', 2)]) AS block FROM dumps),
  block_lines AS ({_BLOCK_LINES}),
  differences AS (
    SELECT doc_id, name, t.type AS in_table, f.type AS in_file,
           name || CASE WHEN t.type IS NULL THEN ' (missing in table chunk, file=' || {_spaced("f.type")} || ')'
                        WHEN f.type IS NULL THEN ' (missing in file, table=' || {_spaced("t.type")} || ')'
                        ELSE ' (table=' || {_spaced("t.type")} || ' vs file=' || {_spaced("f.type")} || ')' END AS difference
    FROM (SELECT * FROM block_lines WHERE side = 'table') t
    FULL JOIN (SELECT * FROM block_lines WHERE side = 'file') f USING (doc_id, name)
    WHERE t.type IS DISTINCT FROM f.type),
  mismatches AS (
    SELECT doc_id, 'Extract/schema mismatch: ' || string_agg(difference, '; ' ORDER BY pos) AS mismatch
    FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY name) AS pos FROM differences)
    GROUP BY doc_id)"""


@query("mismatch_summary", f"WITH parsed AS ({_PARSED}), {_MISMATCH} SELECT doc_id, mismatch FROM mismatches")
def mismatch_summary(spark, folder):
    """Both schema blocks of a dump compared column by column."""
    dumps = _parsed(spark, folder).filter(F.contains(F.col("detail"), F.lit(failures.MISMATCH_START)))
    return failures.with_mismatch_summary(dumps, "detail", "mismatch").select("doc_id", "mismatch")


# The first telling line of a message, found over its lines as rows.
_PLAIN = f"""message_lines AS (
    SELECT doc_id, pos, line FROM (
      SELECT doc_id, generate_subscripts(lines, 1) AS pos, {_strip("unnest(lines)")} AS line
      FROM (SELECT doc_id, regexp_split_to_array(
              regexp_replace({_strip("detail")}, '^<class ''[^'']+''>{_SP}*\\n?', ''),
              '{_BREAK}') AS lines FROM parsed WHERE is_parsed))
    WHERE line <> ''),
  numbered AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS n FROM message_lines),
  plain AS (
    SELECT doc_id, COALESCE(
      arg_min(line, n) FILTER (NOT starts_with(line, 'Pipeline execution failed')
                               AND NOT starts_with(line, 'step=')),
      arg_min(line, n)) AS line
    FROM numbered GROUP BY doc_id)"""


@query(
    "failure_digest",
    f"""WITH parsed AS ({_PARSED}), {_MISMATCH}, {_PLAIN},
       system AS (SELECT doc_id, regexp_extract(detail, '\\[Errno{_SP}+([0-9]+)\\]{_SP}*([^\\n]+)', 1) AS number,
                         {_strip(f"regexp_extract(detail, '[[]Errno{_SP}+([0-9]+)[]]{_SP}*([^{chr(92)}n]+)', 2)")} AS problem
                  FROM parsed)
       SELECT doc_id, CASE WHEN NOT is_parsed THEN entry ELSE table_ref || ' — ' || exc_type || ' — ' || CASE
           WHEN mismatch IS NOT NULL THEN mismatch
           WHEN contains(detail, 'No space left on device') THEN 'Disk full (errno 28 No space left on device)'
           WHEN number <> '' THEN 'OS error errno=' || number || ' ' || {_spaced("problem")}
           ELSE COALESCE(regexp_replace(line, '{_SP}+', ' ', 'g'), '') END END AS digest
       FROM parsed LEFT JOIN mismatches USING (doc_id) LEFT JOIN plain USING (doc_id)
       LEFT JOIN system USING (doc_id)""",
)
def failure_digest(spark, folder):
    return failures.with_digest(_entries(spark, folder), "entry").select("doc_id", "digest")
