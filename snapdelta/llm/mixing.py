"""Mixing overlapping sources to target weights by a min-cost flow.

Documents are aggregated by their membership pattern (the set of sources they belong to). Each
pattern offers its words once at no cost, a second time at cost 1, and so on (repetition costs are
convex); each source asks for its quota. The cheapest flow that fills the quotas says how many words
of each pattern go to which source. Within a pattern the documents are then taken in the order of a
seeded digest: all of them as often as the flow goes round, and those before an exact cut once more.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from snapdelta.llm.frames import kept, text_of
from snapdelta.llm.histogram import find_cuts

#: Fixed values of the mix.
SHARES = (3, 1, 2)
TOTAL = 1.5
REPEATS = 2
NOT_WHITE = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """The number of runs of characters that are no white space; 0 for null."""
    # one character per run is left when all else of the run is dropped
    inner = F.regexp_replace(F.translate(text, "\t\n\x0b\x0c\r", "     "), r"[^ ]+", "x")
    return F.length(F.replace(F.coalesce(inner, F.lit("")), F.lit(" "), F.lit(""))).cast("long")


def fill_targets(sizes: list[tuple[str | None, int]], shares=SHARES, total: float = TOTAL, most: float = REPEATS) -> dict[str | None, float]:
    """The target of each source: its share of ``total`` times all sizes, at most ``most`` times its own size.

    Sources go by code point, null last, and take the shares in turn. What is over the limit of a
    source is shared out again by weight among the others until none is above its limit.
    """
    named = sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))
    weight = {name: shares[at % len(shares)] for at, (name, _) in enumerate(named)}
    limit = {name: most * size for name, size in named}
    amount = total * sum(size for _, size in named)
    # the sources that fill up first are those with the least limit for their weight
    target, left, weights = {}, amount, sum(weight.values())
    for name, _ in sorted(named, key=lambda x: limit[x[0]] / weight[x[0]]):
        if left * weight[name] / weights >= limit[name]:
            target[name] = float(limit[name])
            left -= limit[name]
            weights -= weight[name]
        else:
            for rest, _ in named:
                if rest not in target:
                    target[rest] = left * weight[rest] / weights
            break
    return target


def min_cost_flow(patterns: list[tuple[tuple[int, ...], int]], quotas: list[int], repeats: int = REPEATS) -> list[dict[int, int]]:
    """Words of each pattern that go to each source: quotas filled as far as can be, with the fewest repeats.

    ``patterns`` are (numbers of the sources, words). Successive cheapest paths; a path runs from a
    pattern's next free round through sources and patterns that give way, to a source that is not full.
    """
    flow: list[dict[int, int]] = [defaultdict(int) for _ in patterns]
    used = [0] * len(patterns)
    left = list(quotas)
    users = defaultdict(set)  # patterns that send words to a source now
    for cost in range(repeats):
        # in a round all new words cost the same, so any path that adds words is a cheapest one
        pending = True
        while pending:
            pending = False
            came: dict[tuple[str, int], tuple[str, int] | None] = {}
            queue = []
            for p, (_, words) in enumerate(patterns):
                if used[p] < (cost + 1) * words:
                    came["p", p] = None
                    queue.append(("p", p))
            end = None
            for kind, at in queue:
                if kind == "p":
                    for s in patterns[at][0]:
                        if ("s", s) not in came:
                            came["s", s] = (kind, at)
                            queue.append(("s", s))
                elif left[at] > 0:
                    end = (kind, at)
                    break
                else:
                    for p in users[at]:
                        if ("p", p) not in came:
                            came["p", p] = (kind, at)
                            queue.append(("p", p))
            if end is None:
                break
            path = [end]
            while came[path[-1]] is not None:
                path.append(came[path[-1]])
            path.reverse()
            first = path[0][1]
            amount = min(left[end[1]], (cost + 1) * patterns[first][1] - used[first])
            for (kind, a), (_, b) in zip(path, path[1:], strict=False):
                if kind == "s":
                    amount = min(amount, flow[b][a])
            for (kind, a), (_, b) in zip(path, path[1:], strict=False):
                if kind == "p":
                    flow[a][b] += amount
                    users[b].add(a)
                else:
                    flow[b][a] -= amount
                    if not flow[b][a]:
                        users[a].discard(b)
            used[first] += amount
            left[end[1]] -= amount
            pending = True
    return [{s: words for s, words in sent.items() if words} for sent in flow]


@dataclass(frozen=True)
class PatternPlan:
    """How a pattern's documents are taken: ``rounds`` times all of them, once more those with a key below
    ``key``, and ``part`` words of each row at that key."""

    pattern: list[str | None]
    rounds: int
    key: str
    part: int
    sent: dict[str | None, int]


@dataclass(frozen=True)
class Mix:
    plans: list[PatternPlan]
    sizes: dict[str | None, int]
    targets: dict[str | None, float]
    seed: int


def order_key(row_id: Column, text: Column, seed: int) -> Column:
    """A seeded digest of a row's id and text: the order in which documents are taken."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(row_id.cast("string"), F.lit("null")), F.md5(text)))


def _with_parts(docs: DataFrame, members: Column, id_col: str, text_col: str, seed: int) -> DataFrame:
    text = text_of(text_col)
    return docs.select(
        F.col(id_col).alias("id"),
        F.array_sort(F.array_distinct(members)).alias("pattern"),
        word_count(F.col(text_col)).alias("size"),
        order_key(F.col(id_col), text, seed).alias("key"),
    )


def plan_mix(rows: DataFrame, seed: int) -> Mix:
    """The mix of stored rows (pattern, size, key). The driver gets one row per pattern and one per source."""
    counted = [(list(row["pattern"]), row["size"]) for row in rows.groupBy("pattern").agg(F.sum("size").alias("size")).collect()]
    counted.sort(key=lambda x: [(name is None, name or "") for name in x[0]])
    sizes: dict[str | None, int] = defaultdict(int)
    for pattern, size in counted:
        for name in pattern:
            sizes[name] += size
    targets = fill_targets(list(sizes.items()))
    names = list(targets)
    number = {name: at for at, name in enumerate(names)}
    sent = min_cost_flow([(tuple(number[name] for name in pattern), size) for pattern, size in counted], [int(targets[name]) for name in names])

    rest = {}
    for at, (_, size) in enumerate(counted):
        total = sum(sent[at].values())
        rest[at] = (total // size, total % size) if size else (0, 0)
    listed = [(at, pattern) for at, (pattern, _) in enumerate(counted)]
    wanted = [(at, left) for at, (_, left) in rest.items() if left]
    cuts = {}
    if wanted:
        numbered = rows.withColumn("group", pattern_number(F.col("pattern"), listed))
        cuts = find_cuts(numbered.select("group", "key", F.col("size").alias("weight")), wanted)
    plans = []
    for at, pattern in listed:
        rounds, left = rest[at]
        cut = cuts.get((at, left))
        key, part = ("", 0) if cut is None else (cut.key, (left - cut.below) // max(1, cut.rows))
        plans.append(PatternPlan(pattern, int(rounds), key, int(part), {names[s]: words for s, words in sent[at].items()}))
    return Mix(plans, dict(sizes), targets, seed)


def pattern_text(pattern: Column) -> Column:
    return F.to_json(F.struct(F.transform(pattern, lambda name: F.coalesce(F.concat(F.lit("="), name), F.lit("null"))).alias("p")))


def pattern_label(pattern: list[str | None]) -> str:
    import json

    return json.dumps({"p": ["null" if name is None else f"={name}" for name in pattern]}, ensure_ascii=False, separators=(",", ":"))


def pattern_number(pattern: Column, listed: list[tuple[int, list[str | None]]]) -> Column:
    """The number of a pattern in the plan: a lookup in a map of one entry per pattern."""
    entries = [F.lit(x) for at, names in listed for x in (pattern_label(names), at)]
    return F.create_map(*entries)[pattern_text(pattern)].cast("int")


def _taken(rows: DataFrame, mix: Mix) -> DataFrame:
    """Rows with rounds, key_cut, part of their pattern, and the words taken of them."""
    spark = rows.sparkSession
    plan = spark.createDataFrame(
        [(pattern_label(p.pattern), p.rounds, p.key, p.part) for p in mix.plans] or [("", 0, "", 0)],
        "label string, rounds int, cut string, part long",
    )
    joined = rows.withColumn("label", pattern_text(F.col("pattern"))).join(F.broadcast(plan), "label", "left")  # one row per pattern
    extra = F.when(F.col("key") < F.col("cut"), F.col("size")).when(F.col("key") == F.col("cut"), F.col("part")).otherwise(0)
    return joined.withColumn("taken", F.col("rounds") * F.col("size") + extra).drop("label")


def mix(docs: DataFrame, members: Column, seed: int = 1, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, Mix]:
    """id, pattern, size and taken of each row, and the mix itself.

    ``members`` is an array of the sources a row belongs to (null is a source of its own, after all
    others). A null or blank text has size 0, and nothing is taken of it. Equal rows share one key and
    so the words at a cut evenly. An empty table gives an empty one. Reruns give the same rows.
    """
    rows = kept(_with_parts(docs, members, id_col, text_col, seed))
    made = plan_mix(rows, seed)
    return _taken(rows, made).select("id", "pattern", "size", "taken"), made


def mix_by_source(docs: DataFrame, seed: int = 1, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix of documents of one source each, with the size and target of the source."""
    taken, made = mix(docs, F.array(F.col(source_col)), seed, id_col, text_col)
    listed = [(pattern_label([name]), made.sizes[name], made.targets[name]) for name in made.sizes] or [("", 0, 0.0)]
    sources = docs.sparkSession.createDataFrame(listed, "label string, source_size long, target double")
    found = taken.withColumn("label", pattern_text(F.col("pattern"))).join(F.broadcast(sources), "label", "left")  # one row per source
    return found.select(F.col("id").alias(id_col), "size", "source_size", "target", "taken")


def repeat_by_mix(docs: DataFrame, members: Column, seed: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows themselves, each as many times as the mix takes it; a part of at least half a text counts as a whole."""
    _, made = mix(docs, members, seed, id_col, text_col)
    names = docs.columns
    whole = F.struct(*[F.col(f"`{name}`") for name in names]).alias("row")
    text = text_of(text_col)
    rows = docs.select(
        whole,
        F.array_sort(F.array_distinct(members)).alias("pattern"),
        word_count(F.col(text_col)).alias("size"),
        order_key(F.col(id_col), text, seed).alias("key"),
    )
    times = F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size")).cast("int")).otherwise(0)
    repeated = _taken(rows, made).withColumn("times", times).filter("times > 0")
    return repeated.select("row", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("nth")).select("row.*")
