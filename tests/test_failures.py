import pytest
from pyspark.sql import functions as F

from snapdelta.operators import failures

DUMP = """Load failed
Table schema does not match schema used to create file:
table:
{table}
-- schema metadata --
pandas: '{{"index": 1}}'
file:
{file}
-- schema metadata --
other: thing"""

MANY = "\n".join(f"c{i:02}: x" for i in range(15))

CASES = [
    (
        "db.s.t: ArrowInvalid: " + DUMP.format(table="a: int64\nb: string\nsame: bool", file="a: string\nsame: bool\nz: double"),
        "db.s.t — ArrowInvalid — Extract/schema mismatch: a (table=int64 vs file=string); "
        "b (missing in file, table=string); z (missing in table chunk, file=double)",
    ),
    (
        "db.s.t: ArrowInvalid: " + DUMP.format(table=MANY, file="zz: int64"),
        "db.s.t — ArrowInvalid — Extract/schema mismatch: "
        + "; ".join(f"c{i:02} (missing in file, table=x)" for i in range(15))
        + "; zz (missing in table chunk, file=int64)",
    ),
    (
        "db.s.t: ArrowInvalid: " + DUMP.format(table="a: int64", file="a: int64"),
        "db.s.t — ArrowInvalid — Arrow schema mismatch — column sets equal but metadata differs (see logs)",
    ),
    (
        "db.s.t: ArrowInvalid: " + DUMP.format(table="a: x\na: int64", file="a: int64").replace("\n", "\r\n"),
        "db.s.t — ArrowInvalid — Arrow schema mismatch — column sets equal but metadata differs (see logs)",
    ),
    (
        "db.s.t: ArrowInvalid: Table schema does not match, no blocks",
        "db.s.t — ArrowInvalid — Arrow schema mismatch (see logs for full dump)",
    ),
    (
        "db.s.t: ArrowInvalid: Table schema does not match\nfile:\na: b\ntable:\nc: d\nfile:\ne: f",
        "db.s.t — ArrowInvalid — Arrow schema mismatch (see logs for full dump)",
    ),
    ("db.s.t: OSError: [Errno 28] No space left on device: '/x'", "db.s.t — OSError — Disk full (errno 28 No space left on device)"),
    ("db.s.t: OSError: at x\n[Errno 5]  Input/output   error\nmore", "db.s.t — OSError — OS error errno=5 Input/output error"),
    (
        "db.s.t: OSError: [Errno 5] " + "x" * 100,
        "db.s.t — OSError — OS error errno=5 " + "x" * 100,
    ),
    (
        "db.s.t: E: <class 'x.Y'>\nPipeline execution failed at step\nstep=load\n\n  the   cause: here \nmore",
        "db.s.t — E — the cause: here",
    ),
    ("db.s.t: E: Pipeline execution failed\nstep=x", "db.s.t — E — Pipeline execution failed"),
    ("db.s.t: E: \n \n", "db.s.t — E — "),
    ("db.s.t: E: " + "w " * 400, "db.s.t — E — " + ("w " * 400).strip()),
    ("no parts here", "no parts here"),
    ("one: part" + "y" * 500, "one: part" + "y" * 500),
]


def test_digests(spark):
    frame = spark.createDataFrame([(i, entry) for i, (entry, _) in enumerate(CASES)], "n int, entry string")
    found = failures.with_digest(frame, "entry").orderBy("n").collect()
    assert found[0].asDict().keys() == {"n", "entry", "digest"}
    for row, (_, want) in zip(found, CASES):
        assert row.digest == want


@pytest.mark.parametrize(
    "entry, parts",
    [
        ("a.b.c: E: m", ("a.b.c", "E", "m")),
        ("a.b.c: E: m: more: x", ("a.b.c", "E", "m: more: x")),
        ("a.b.c: E: ", ("a.b.c", "E", "")),
        ("a.b.c: E", None),
        ("", None),
    ],
)
def test_parsed_entries(spark, entry, parts):
    frame = spark.createDataFrame([(entry,)], "entry string")
    row = failures.with_parsed_entry(frame, "entry").first()
    assert (tuple(row.parsed) if row.parsed else None) == parts


CLASSES = [
    ("RuntimeError", "Table schema does not match schema used to create file; timeout", "schema"),
    ("ValueError", "the Schema did not MATCH", "schema"),
    ("TypeError", "the schema did not match", "fatal"),
    ("DatabaseError", "(psycopg2.errors.UndefinedColumn) column x", "schema"),
    ("OperationalError", "SSL SYSCALL error: EOF detected", "transient"),
    ("TimeoutError", "", "transient"),
    ("BrokenPipeError", "x", "transient"),
    ("ClientError", "An error occurred (ServiceUnavailable) when calling the PutObject operation", "transient"),
    ("ClientError", "An error occurred (AccessDenied) when calling the PutObject operation", "fatal"),
    ("OSError", "[Errno 110] x", "transient"),
    ("OSError", "[Errno 22] wrong number of bytes", "transient"),
    ("OSError", "[Errno 22] Invalid argument", "fatal"),
    ("OSError", "[Errno 2] No such file", "fatal"),
    ("Exception", "Please reduce your request rate.", "transient"),
    ("KeyError", "'x'", "fatal"),
]


def test_classes(spark):
    frame = spark.createDataFrame(CLASSES, "t string, m string, want string")
    one = failures.failure_class("t", "m")
    chain = failures.chain_class(F.array(F.struct(F.col("t").alias("exc_type"), F.col("m").alias("message"))))
    for row in frame.select("*", one.alias("one"), chain.alias("chain")).collect():
        assert (row.one, row.chain) == (row.want, row.want), row


def test_any_link_of_a_chain_counts(spark):
    links = [("RuntimeError", "load failed"), ("OSError", "[Errno 104] gone"), ("E", "column hints were different")]
    frame = spark.createDataFrame([(links[:1],), (links[:2],), (links,)], "c array<struct<exc_type string, message string>>")
    assert [r[0] for r in frame.select(failures.chain_class("c")).collect()] == ["fatal", "transient", "schema"]


def test_exhaustion(spark):
    rows = [("MemoryError", "", True), ("OSError", "[Errno 28] x", True), ("E", "No space left on device", True), ("OSError", "[Errno 5] x", False)]
    frame = spark.createDataFrame(rows, "t string, m string, want boolean")
    assert all(r.want == r.found for r in frame.select("want", failures.is_exhaustion("t", "m").alias("found")).collect())
