"""Personal data, and the terms of the same documents that give it away.

Fixed forms (e-mail, IP, card, phone) are found by pattern. What they protect are entities: each value, and
the groups it belongs to (the domain and the name parts of an e-mail, the network of an IP, the first six
digits of a card or phone). Corpus co-occurrence by whole document then says how strongly a term reveals an
entity: with n documents in all, the information content of an entity is log(n / n(entity)), and a term
discloses the share log(n(term, entity) n / (n(term) n(entity))) of it. A term that discloses at least
``REMOVE`` is removed, one that discloses at least ``GENERALISE`` is generalised, at each of its places in
every document that holds the entity. Evidence must come from at least two different texts, and be worth
``EVIDENCE`` nats: n(term, entity) log(n(term, entity) n / (n(term) n(entity))).

A term can only disclose that much if n(term) is at most n(entity) (n / n(entity))^(1 - ``GENERALISE``), so
only such pairs of a document's terms and entities are counted; no pair over the thresholds is left out.

All of it is built-in column functions and joins; no Python runs on rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from snapdelta.llm.frames import kept, stored, text_of

# The kinds in the order in which they are listed, and their forms. Repeats are
# possessive where what follows cannot match inside them, so that Java neither recurses nor goes back;
# an e-mail starts at the start of its run of characters or where the match before it ended.
KINDS = ("email", "ip", "card", "phone")
FORMS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+",
    "card": r"[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without this holds no match, and is not searched.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}

WORD = r"[\p{L}\p{N}_]+"
REMOVE, GENERALISE = 0.95, 0.85
#: Nats by which a term and an entity must stand together more often than by chance.
EVIDENCE = 6.0
#: Letters that a part of an e-mail's name needs to be an entity.
NAME = 3
#: Up to so many terms are sent to all executors; more are joined by shuffle.
BROADCAST_TERMS = 100_000
#: Tasks that the rows of one very common entity or term are dealt to in a join.
SALTS = 16

SPAN = "array<struct<start:int,rank:int,kind:string,end:int,value:string>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    count = F.length(digits)

    def add(total: Column, at: Column) -> Column:
        digit = F.substring(digits, at, F.lit(1)).cast("int")
        twice = F.when((count - at) % 2 == 1, digit * 2).otherwise(digit)
        return total + F.when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(1), count), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        short = lambda part: F.regexp_replace(part, "^0+(?=[0-9])", "")
        return F.forall(F.split(value, r"\."), lambda part: (F.length(short(part)) <= 3) & (F.substring(short(part), 1, 3).cast("int") <= 255))
    digits = _digits(value)
    if kind == "card":
        return F.length(digits).between(12, 19) & F.when(F.length(digits) <= 19, _luhn(digits)).otherwise(False)
    return F.length(digits).between(9, 15)


def _found(kind: str, text: Column) -> Column:
    """All valid matches of a kind with their places: a match starts after the parts and matches before it."""
    form = FORMS[kind]
    matches = F.regexp_extract_all(text, F.lit(form), F.lit(0))
    parts = F.split(text, form, -1)
    empty = F.array().cast(SPAN)
    start = F.struct(F.lit(0).alias("at"), empty.alias("spans"))

    def step(held: Column, pair: Column) -> Column:
        begin = held["at"] + F.length(pair["part"])
        end = begin + F.length(pair["match"])
        span = F.struct(
            begin.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), F.lit(kind).alias("kind"), end.alias("end"), pair["match"].alias("value")
        )
        spans = F.when(_valid(kind, pair["match"]), F.concat(held["spans"], F.array(span).cast(SPAN))).otherwise(held["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    pairs = F.transform(matches, lambda match, i: F.struct(match.alias("match"), F.get(parts, i).alias("part")))
    searched = text.rlike("[0-9]") if kind != "email" else F.lit(True)
    if NEEDS[kind]:
        searched = F.contains(text, F.lit(NEEDS[kind])) & searched
    return F.when(searched, F.aggregate(pairs, start, step, lambda held: held["spans"])).otherwise(empty)


def base_spans(text: Column) -> Column:
    """Spans of the fixed forms, by start and then by kind."""
    return F.array_sort(F.concat(*[_found(kind, text) for kind in KINDS]))


def _entities(span: Column) -> Column:
    """What a span protects: its value and the groups of it."""
    value = F.lower(span["value"])
    name = F.filter(F.split(F.split_part(value, F.lit("@"), F.lit(1)), "[^a-z]+"), lambda part: F.length(part) >= NAME)
    domain = F.array(F.concat(F.lit("domain:"), F.split_part(value, F.lit("@"), F.lit(2))))
    email = F.concat(domain, F.transform(name, lambda part: F.concat(F.lit("name:"), part)))
    network = F.array(F.concat(F.lit("network:"), F.substring_index(value, ".", 3)))
    prefix = F.array(F.concat(span["kind"], F.lit(" prefix:"), F.substring(_digits(value), 1, 6)))
    groups = F.when(span["kind"] == "email", email).when(span["kind"] == "ip", network).otherwise(prefix)
    return F.transform(F.concat(F.array(F.concat(span["kind"], F.lit(":"), value)), groups), lambda entity: F.md5(entity))


def _terms(text: Column) -> Column:
    """The different words of a text in small letters."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda word: F.lower(word)))


def _salted(many: DataFrame, few: DataFrame, on: list[str]) -> DataFrame:
    """An inner join in which the rows of ``many`` that share a key are dealt to ``SALTS`` tasks."""
    dealt = many.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int"))
    spread = few.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return dealt.join(spread, [*on, "salt"]).drop("salt")


def _holders(rows: DataFrame, total: int) -> DataFrame:
    """Once per id and text: the body, the spans' entities that another text holds too, each with the greatest n(term)
    that can reveal it, the greatest of these (``most``), and the number of ``copies``."""
    held = rows.filter(F.size("spans") > 0)
    each = held.select("key", F.xxhash64("digest").alias("print"), F.explode(F.array_distinct(F.flatten(F.transform("spans", _entities)))).alias("entity"))
    shared = each.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"), F.min("print").alias("low"), F.max("print").alias("high")).filter("low != high")
    limit = F.col("n_entity") * F.pow(F.lit(total) / F.col("n_entity"), F.lit(1 - GENERALISE))
    # a rounding error leaves no pair out
    shared = shared.select("entity", "n_entity", (limit * (1 + 1e-9)).alias("limit"))
    listed = _salted(each, shared, ["entity"]).groupBy("key").agg(
        F.collect_set(F.struct("entity", "n_entity", "limit")).alias("entities"), F.max("limit").alias("most"), F.count(F.lit(1)).alias("entries")
    )
    listed = listed.withColumn("copies", (F.col("entries") / F.size("entities")).cast("long")).drop("entries")
    bodies = held.select("key", "digest", "body").dropDuplicates(["key"])
    joined = bodies.join(listed, "key").select("key", F.xxhash64("digest").alias("print"), "body", "entities", "most", "copies", _terms(F.col("body")).alias("terms"))
    return stored(joined, "personal-holders")


def _term_counts(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """In how many rows of the corpus each of the terms stands."""
    words = texts.select(F.explode(_terms(F.col("body"))).alias("term"))
    if terms.count() <= BROADCAST_TERMS:
        words = words.join(F.broadcast(terms), "term", "left_semi")
        return words.groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
    return words.groupBy("term").agg(F.count(F.lit(1)).alias("n_term")).join(terms, "term", "left_semi")


def disclosure(n_both: Column, n_term: Column, n_entity: Column, n: Column) -> Column:
    """The share of an entity's information that a term gives away; an entity that all documents hold has none."""
    content = F.log2(n / n_entity)
    return F.when(content > 0, F.log2(n_both * n / (n_term * n_entity)) / content).otherwise(0.0)


def _shown(holders: DataFrame, texts: DataFrame, total: int) -> DataFrame:
    """(key, term, disclosure) of the terms of each document that reveal one of its entities, counted over all documents."""
    words = holders.select("key", "print", F.explode("terms").alias("term"))
    common = words.groupBy("term").agg(F.min("print").alias("low"), F.max("print").alias("high")).filter("low != high").select("term")
    counted = kept(_term_counts(texts, kept(common)))
    possible = _salted(holders.select("key", "most", F.explode("terms").alias("term")), counted, ["term"]).filter("n_term <= most")
    pairs = possible.select("key", "term", "n_term").join(holders.select("key", "print", "copies", "entities"), "key")
    pairs = pairs.select("key", "print", "copies", "term", "n_term", F.explode("entities").alias("entity")).filter("n_term <= entity.limit")
    pairs = kept(pairs.select("key", "print", "copies", "term", "n_term", "entity.entity", "entity.n_entity"))
    together = pairs.groupBy("entity", "term").agg(
        F.sum("copies").alias("n_both"), F.max("n_term").alias("n_term"), F.max("n_entity").alias("n_entity"), F.min("print").alias("low"), F.max("print").alias("high")
    )
    n_both, n_term, n_entity = F.col("n_both"), F.col("n_term"), F.col("n_entity")
    evidence = n_both * F.log(n_both * total / (n_term * n_entity))
    share = disclosure(n_both, n_term, n_entity, F.lit(total))
    revealing = together.filter("low != high").filter(evidence >= EVIDENCE).select("entity", "term", share.alias("disclosure"))
    revealing = kept(revealing.filter(F.col("disclosure") >= GENERALISE))
    return kept(_salted(pairs.select("key", "entity", "term"), revealing, ["entity", "term"]).groupBy("key", "term").agg(F.max("disclosure").alias("disclosure")))


def _places(holders: DataFrame, shown: DataFrame) -> DataFrame:
    """(key, places): every place of the revealing terms in each document that has some, by start."""
    marked = holders.select("key", "body").join(shown.select("key").distinct(), "key", "left_semi")
    pieces = F.arrays_zip(F.split("body", WORD, -1).alias("gap"), F.regexp_extract_all("body", F.lit(WORD), F.lit(0)).alias("word"))
    words = marked.select("key", F.posexplode(pieces).alias("nth", "piece")).filter("piece.word IS NOT NULL")
    words = words.select("key", "nth", F.lower("piece.word").alias("term"), F.length("piece.gap").alias("gap"), F.length("piece.word").alias("size"))
    # a running sum over the words of one document
    end = F.sum(F.col("gap") + F.col("size")).over(Window.partitionBy("key").orderBy("nth")).cast("int")
    words = words.select("key", "term", "size", end.alias("end"))
    found = words.join(shown, ["key", "term"])
    action = F.when(F.col("disclosure") >= REMOVE, "remove").otherwise("generalise").alias("action")
    place = F.struct((F.col("end") - F.col("size")).alias("start"), "end", "term", "disclosure", action)
    return found.groupBy("key").agg(F.array_sort(F.collect_list(place)).alias("places"))


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, ``digest`` of the text, ``base`` and ``terms``.

    ``base`` holds (start, rank, kind, end, value) by start and kind; ``terms`` holds (start, end,
    term, disclosure, action) by start, for each place of a term that reveals an entity of the document
    and that no base span covers; never in a document without an entity. Positions count code points,
    ends exclusive. A null or empty text has no spans; rows equal in id and text count once each, but
    are one text as evidence, and each gets its row; an empty table gives an empty one; other columns
    are not read.
    """
    texts = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("body"))
    key = F.concat(F.coalesce(F.concat(F.lit("="), F.col("id").cast("string")), F.lit("")), F.lit(":"), "digest")
    rows = texts.withColumn("digest", F.md5("body")).withColumn("key", key).withColumn("spans", base_spans(F.col("body")))
    # the text goes along only where it holds an entity
    rows = stored(rows.select("id", "digest", "key", "spans", F.when(F.size("spans") > 0, F.col("body")).alias("body")), "personal-rows")
    total = rows.count()
    holders = _holders(rows, total)
    places = _places(holders, _shown(holders, texts, total))
    joined = rows.drop("body").join(places, "key", "left")
    free = F.filter("places", lambda word: ~F.exists("spans", lambda span: (span["start"] < word["end"]) & (word["start"] < span["end"])))
    none = F.array().cast("array<struct<start:int,end:int,term:string,disclosure:double,action:string>>")
    return joined.select(F.col("id").alias(id_col), "digest", F.col("spans").alias("base"), F.coalesce(free, none).alias("terms"))


def sanitised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and sanitised text: entities become their kind in brackets, revealing terms are blanked or become [term]."""
    found = find_personal_data(docs, id_col, text_col).dropDuplicates([id_col, "digest"])
    base = F.transform("base", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.concat(F.lit("["), x["kind"], F.lit("]")).alias("label")))
    terms = F.transform(
        "terms", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.when(x["action"] == "remove", "").otherwise("[term]").alias("label"))
    )
    spans = found.select(F.col(id_col).alias("at_id"), F.col("digest").alias("at_digest"), F.array_sort(F.concat(base, terms)).alias("spans"))
    texts = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("body")).withColumn("digest", F.md5("body"))
    joined = texts.join(spans, (F.col("digest") == F.col("at_digest")) & F.col("id").eqNullSafe(F.col("at_id")))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("text"))

    def step(held: Column, span: Column) -> Column:
        # of overlapping spans the first stands
        piece = F.concat(held["text"], F.substring(F.col("body"), held["at"] + 1, span["start"] - held["at"]), span["label"])
        new = F.struct(span["end"].alias("at"), piece.alias("text"))
        return F.when(span["start"] >= held["at"], new).otherwise(held)

    end = lambda held: F.concat(held["text"], F.substring(F.col("body"), held["at"] + 1, F.length("body")))
    return joined.select(F.col("id").alias(id_col), F.aggregate("spans", start, step, end).alias("sanitised"))
