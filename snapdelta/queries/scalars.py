"""Scalar cleaning functions over whole columns and whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from snapdelta import functions as pg
from snapdelta.queries.inputs import table
from snapdelta.queries.registry import query


@query(
    "cast_text",
    """SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS key_text, CAST(c_nationkey AS VARCHAR) AS nation_text,
              CAST(c_acctbal > 0 AS VARCHAR) AS flag_text FROM customer""",
)
def cast_text(spark, folder):
    return table(spark, folder, "customer").select(
        "c_custkey",
        pg.as_text("c_custkey").alias("key_text"),
        pg.as_text("c_nationkey").alias("nation_text"),
        pg.as_text(F.col("c_acctbal") > 0).alias("flag_text"),
    )


@query(
    "timestamp_text",
    """SELECT event_id, CAST(ts AS VARCHAR) AS ts_text,
              CAST(DATE_TRUNC('second', ts) AS VARCHAR) AS second_text,
              CAST(DATE_TRUNC('millisecond', ts) AS VARCHAR) AS milli_text FROM events""",
)
def timestamp_text(spark, folder):
    return table(spark, folder, "events").select(
        "event_id",
        pg.timestamp_text("ts").alias("ts_text"),
        pg.timestamp_text(F.date_trunc("second", "ts")).alias("second_text"),
        pg.timestamp_text(F.date_trunc("millisecond", "ts")).alias("milli_text"),
    )


@query(
    "number_text",
    """SELECT l_orderkey, l_linenumber, l_partkey,
              regexp_replace(CAST(l_extendedprice AS VARCHAR), '\\.0$', '') AS price_text,
              regexp_replace(CAST(l_quantity * 1000000 AS VARCHAR), '\\.0$', '') AS quantity_text,
              regexp_replace(CAST(-l_discount AS VARCHAR), '\\.0$', '') AS discount_text
       FROM lineitem""",
)
def number_text(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        pg.number_text("l_extendedprice").alias("price_text"),
        pg.number_text(F.col("l_quantity") * 1000000).alias("quantity_text"),
        pg.number_text(-F.col("l_discount")).alias("discount_text"),
    )


@query(
    "json_text",
    """SELECT event_id, COALESCE(CASE WHEN event_type <> 'error' THEN props END, '[]') AS props_text,
              '{"user":' || user_id || ',"type":"' || event_type || '"}' AS row_text FROM events""",
)
def json_text(spark, folder):
    props = F.when(F.col("event_type") != "error", F.col("props"))
    row = F.struct(F.col("user_id").alias("user"), F.col("event_type").alias("type"))
    return table(spark, folder, "events").select(
        "event_id",
        F.coalesce(pg.as_text(props), F.lit("[]")).alias("props_text"),
        F.to_json(row).alias("row_text"),
    )


# The words of a whole text; one NULL at the end for German ones.
_WORDS = """CASE WHEN lang = 'de' THEN list_append(string_split(text, ' '), NULL)
                 ELSE string_split(text, ' ') END"""


def _words():
    words = F.split("text", " ", -1)
    return F.when(F.col("lang") == "de", F.array_append(words, F.lit(None).cast("string"))).otherwise(words)


@query(
    "array_literal_text",
    f"""SELECT doc_id, '{{' || array_to_string(list_transform({_WORDS}, lambda w:
            CASE WHEN w IS NULL THEN 'NULL'
                 WHEN w = '' OR upper(w) = 'NULL' OR regexp_matches(w, '[{{}},"\\\\ \\t\\n\\x0B\\f\\r]')
                 THEN '"' || replace(replace(w, '\\', '\\\\'), '"', '\\"') || '"'
                 ELSE w END), ',') || '}}' AS words_text FROM documents""",
)
def array_literal_text(spark, folder):
    return table(spark, folder, "documents").select("doc_id", pg.array_literal(_words()).alias("words_text"))


def _sql_number(name: str) -> str:
    return f"regexp_replace(CAST({name} AS VARCHAR), '\\.0$', '')"


@query(
    "array_literal_types",
    f"""SELECT l_orderkey, l_linenumber, '{{' || {_sql_number("l_extendedprice")} || ',NULL,' || {_sql_number("-l_quantity")} || '}}' AS numbers,
               CASE l_returnflag WHEN 'A' THEN '{{t,NULL,' WHEN 'N' THEN '{{NULL,NULL,' ELSE '{{f,NULL,' END
                 || CASE l_linestatus WHEN 'O' THEN 't}}' ELSE 'f}}' END AS flags,
               '{{{{' || l_partkey || ',' || l_suppkey || '}},{{NULL,' || l_linenumber || '}}}}' AS nested,
               '{{"' || strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') || '"}}' AS times,
               '{{' || CAST(l_shipdate AS DATE) || '}}' AS days
        FROM lineitem""",
)
def array_literal_types(spark, folder):
    """Numbers, flags, inner arrays and times inside a literal, each as PostgreSQL prints it there."""
    arrays = table(spark, folder, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "array(l_extendedprice, NULL, -l_quantity) AS numbers",
        "array(CASE l_returnflag WHEN 'A' THEN true WHEN 'N' THEN NULL ELSE false END, NULL, l_linestatus = 'O') AS flags",
        "array(array(l_partkey, l_suppkey), array(NULL, CAST(l_linenumber AS bigint))) AS nested",
        "array(l_shipdate) AS times",
        "array(CAST(l_shipdate AS date)) AS days",
    )
    return pg.array_literals(arrays)


@query(
    "range_text",
    """SELECT o_orderkey,
              CASE WHEN o_orderpriority = '1-URGENT' THEN '(,' ELSE '[' || CAST(o_orderdate AS DATE) || ',' END ||
              CASE WHEN o_orderstatus = 'O' THEN ')' ELSE CAST(CAST(o_orderdate AS DATE) + 30 AS VARCHAR) || ')' END
                AS range_text FROM orders""",
)
def range_text(spark, folder):
    lower = F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderdate").cast("date"))
    upper = F.when(F.col("o_orderstatus") != "O", F.date_add("o_orderdate", 30))
    return table(spark, folder, "orders").select("o_orderkey", pg.range_text(lower, upper).alias("range_text"))


@query(
    "coalesce_string",
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderpriority END AS priority FROM orders",
)
def coalesce_string(spark, folder):
    priority = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    return table(spark, folder, "orders").select("o_orderkey", pg.or_blank(priority).alias("priority"))


@query(
    "coalesce_number",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 0.0 ELSE o_totalprice END AS price,
              CASE WHEN o_orderstatus = 'F' THEN 0 ELSE o_custkey END AS customer FROM orders""",
)
def coalesce_number(spark, folder):
    price = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    customer = F.when(F.col("o_orderstatus") != "F", F.col("o_custkey"))
    return table(spark, folder, "orders").select(
        "o_orderkey",
        pg.or_zero(price, "double").alias("price"),
        pg.or_zero(customer, "bigint").alias("customer"),
    )


@query(
    "coalesce_bool",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN FALSE ELSE o_totalprice > 200000 END AS is_large
       FROM orders""",
)
def coalesce_bool(spark, folder):
    large = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice") > 200000)
    return table(spark, folder, "orders").select("o_orderkey", pg.or_false(large).alias("is_large"))


@query("array_to_json", f"SELECT doc_id, CAST(to_json({_WORDS}) AS VARCHAR) AS words_json FROM documents")
def array_to_json(spark, folder):
    return table(spark, folder, "documents").select("doc_id", pg.json_array(_words()).alias("words_json"))


@query(
    "array_to_json_default",
    """SELECT doc_id, CASE WHEN lang = 'fr' THEN '[]'
                           ELSE CAST(to_json(string_split(text, chr(10))) AS VARCHAR) END AS lines_json
       FROM documents""",
)
def array_to_json_default(spark, folder):
    lines = F.when(F.col("lang") != "fr", F.split("text", "\n", -1))
    return table(spark, folder, "documents").select("doc_id", pg.json_array_or_empty(lines).alias("lines_json"))


@query(
    "array_to_string",
    """SELECT doc_id, array_to_string(string_split(text, ' '), ',') AS words FROM documents""",
)
def array_to_string(spark, folder):
    return table(spark, folder, "documents").select("doc_id", pg.joined(_words()).alias("words"))


@query(
    "unnest_array",
    """SELECT doc_id, lang, unnest(CASE lang WHEN 'fr' THEN NULL WHEN 'de' THEN [] ELSE string_split(text, chr(10)) END)
                AS line FROM documents""",
)
def unnest_array(spark, folder):
    """NULL and empty arrays give no row."""
    empty = F.array().cast("array<string>")
    lines = F.when(F.col("lang") == "de", empty).when(F.col("lang") != "fr", F.split("text", "\n", -1))
    return table(spark, folder, "documents").select("doc_id", "lang", pg.exploded(lines).alias("line"))


@query(
    "map_lookup",
    """SELECT doc_id, CASE WHEN lang = 'de' THEN source ELSE '' END AS source_de,
              CASE WHEN lang = 'en' THEN source ELSE '' END AS source_en,
              CASE WHEN lang = 'fr' THEN source ELSE '' END AS source_fr FROM documents""",
)
def map_lookup(spark, folder):
    by_lang = F.when(F.col("lang") != "es", F.create_map("lang", "source"))
    return table(spark, folder, "documents").select(
        "doc_id", *[pg.map_text(by_lang, key).alias(f"source_{key}") for key in ("de", "en", "fr")]
    )


_DOCUMENT = """'{"sender":"' || event_type || '","gone":null,"keys":{"auth":"a' || user_id || '","p256dh":'
               || user_id || '},"props":' || props || '}'"""


def _documents(spark, folder):
    # The SQL text is the same in both dialects.
    return table(spark, folder, "events").selectExpr("event_id", f"{_DOCUMENT} AS doc")


@query(
    "json_field",
    f"""SELECT event_id, doc ->> 'sender' AS sender, doc ->> 'gone' AS gone, doc ->> 'missing' AS missing,
               props ->> 'k' AS k
        FROM (SELECT event_id, props, {_DOCUMENT} AS doc FROM events)""",
)
def json_field(spark, folder):
    first = pg.json_fields("doc", ["sender", "gone", "missing"])
    return _documents(spark, folder).select("event_id", *first, pg.json_text("doc", "props", "k").alias("k"))


@query(
    "json_path",
    f"""SELECT event_id, doc -> 'keys' ->> 'auth' AS auth, doc -> 'keys' ->> 'p256dh' AS p256dh,
               doc -> 'none' ->> 'auth' AS nothing
        FROM (SELECT event_id, {_DOCUMENT} AS doc FROM events)""",
)
def json_path(spark, folder):
    return _documents(spark, folder).select(
        "event_id",
        pg.json_text("doc", "keys", "auth").alias("auth"),
        pg.json_text("doc", "keys", "p256dh").alias("p256dh"),
        pg.json_text("doc", "none", "auth").alias("nothing"),
    )


# Numbers of unlike form, a name with quotes, a repeated name, an array and an inner document.
_TOKENS = """'{"price":' || event_id || '.10,"power":' || user_id || 'e5,"it''s \\\\"here\\\\"":"' || event_type
             || '","twice":1,"list":[' || event_id || '.50, {"k" : ' || props || '}],"twice":' || user_id || '}'"""


@query(
    "json_tokens",
    """SELECT event_id, event_id || '.10' AS price, user_id || 'e5' AS power, event_type AS quoted, CAST(user_id AS VARCHAR) AS twice,
              event_id || '.50' AS first, '{"k":' || replace(props, ' ', '') || '}' AS last, CAST(NULL AS VARCHAR) AS beyond
       FROM events""",
)
def json_tokens(spark, folder):
    """Fields as the document writes them: digits and exponents kept, the last of repeated names, steps into an array."""
    documents = table(spark, folder, "events").selectExpr("event_id", f"{_TOKENS} AS doc")
    steps = {"price": ["price"], "power": ["power"], "quoted": ["it's \"here\""], "twice": ["twice"], "first": ["list", 0], "last": ["list", -1], "beyond": ["list", 7]}
    return documents.select("event_id", *[pg.json_text("doc", *path).alias(name) for name, path in steps.items()])


# Whole texts with carriage returns, tabs and runs of blanks added at every sentence end.
_DIRTY = "replace(text, '. ', '.' || chr(13) || chr(10) || chr(9) || '  ')"


def _dirty(spark, folder):
    return table(spark, folder, "documents").selectExpr("doc_id", f"{_DIRTY} AS dirty")


@query(
    "strip_newline_runs",
    f"SELECT doc_id, regexp_replace({_DIRTY}, '[\\r\\n]+', ' ', 'g') AS clean FROM documents",
)
def strip_newline_runs(spark, folder):
    return _dirty(spark, folder).select("doc_id", pg.newline_runs_to_space("dirty").alias("clean"))


@query(
    "collapse_whitespace",
    f"""SELECT doc_id, regexp_replace(trim('  ' || {_DIRTY} || ' '), '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g') AS clean,
               regexp_replace(trim(chr(9) || text), '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g') AS leading_tab
        FROM documents""",
)
def collapse_whitespace(spark, folder):
    padded = F.concat(F.lit("  "), F.expr(_DIRTY), F.lit(" "))
    return table(spark, folder, "documents").select(
        "doc_id",
        pg.collapse_spaces(padded).alias("clean"),
        pg.collapse_spaces(F.concat(F.lit("\t"), "text")).alias("leading_tab"),
    )


@query(
    "replace_newlines",
    f"SELECT doc_id, replace(replace({_DIRTY}, chr(10), ' '), chr(13), ' ') AS clean FROM documents",
)
def replace_newlines(spark, folder):
    return _dirty(spark, folder).select("doc_id", pg.newlines_to_spaces("dirty").alias("clean"))


@query(
    "remove_substring",
    """SELECT c_custkey, replace(c_name, 'Customer#', '') AS number, replace(c_name, '0', '') AS without_zeros
       FROM customer""",
)
def remove_substring(spark, folder):
    return table(spark, folder, "customer").select(
        "c_custkey",
        pg.without("c_name", "Customer#").alias("number"),
        pg.without("c_name", "0").alias("without_zeros"),
    )
