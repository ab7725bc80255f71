"""Line dedup, periodic runs and lexical search beside brute-force versions, SQL texts and odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapdelta.llm import lexical_search, line_dedup, near_dedup, queries, runs
from snapdelta.llm.rows import numbered
from tests.oracle import connect, differences

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, and columns whose names the operators use inside."""
    long = "lorem ipsum dolor sit amet\n" * 9000
    rows = [(1, None), (None, None), (2, ""), (3, " \n\n \n"), (4, "One two\nthree"), (4, "One two\nthree"), (None, " one TWO\t\nthree "), (6, long), (7, "é\U0001f600 x\r\n" * 9)]
    return spark.createDataFrame([(i, t, 1, "b", "k", 2, 3) for i, t in rows], "doc_id long, text string, row int, body string, id string, n_lines int, item int")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, FOLDER), connect(FOLDER), queries.ORACLES[name]) == []


# ---- lines


def lines_left(texts, least, keep_first=False):
    """(lines, dropped, text) of each text, by the definition."""
    split = [(text or "").split("\n") for text in texts]
    key = lambda line: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    docs = defaultdict(set)
    for nth, lines in enumerate(split):
        for line in lines:
            docs[key(line)].add(nth)
    seen, out = set(), []
    for lines in split:
        left = []
        for line in lines:
            own = key(line)
            common = own and len(docs[own]) >= least
            if not common or (keep_first and own not in seen):
                left.append(line)
            seen.add(own)
        out.append((len(lines), len(lines) - len(left), "\n".join(left)))
    return out


@pytest.mark.parametrize("keep_first", [False, True])
def test_common_lines_of_odd_rows(spark, odd, keep_first):
    found = line_dedup.without_common_lines(odd.coalesce(1), 2, keep_first).collect()
    texts = [row["text"] for row in odd.collect()]
    want = lines_left(texts, 2, keep_first)
    assert Counter((r["n_lines"], r["n_dropped"], r["text"]) for r in found) == Counter(want)
    assert line_dedup.without_common_lines(odd.limit(0), 2).count() == 0


@pytest.mark.parametrize("keep_first", [False, True])
def test_a_line_of_a_third_of_all_rows_is_cut_over_tasks(spark, keep_first):
    rng = random.Random(3)
    texts = ["\n".join(rng.choice(["The same", "the same ", f"own {nth}", f"rare {nth % 700}", ""]) for _ in range(rng.randint(1, 6))) for nth in range(4000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    rows = numbered(docs, "doc_id", "text", "test")
    ordered = line_dedup._lines(rows).repartitionByRange(8, "high", "low", "row").sortWithinPartitions("high", "low", "row", "at")
    assert line_dedup._crossing(ordered.checkpoint())
    found = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["text"]) for r in line_dedup.without_common_lines(docs, 6, keep_first).collect()}
    assert found == dict(enumerate(lines_left(texts, 6, keep_first)))


def test_the_stream_does_not_depend_on_its_batches():
    rng = np.random.default_rng(5)
    for _ in range(60):
        n = int(rng.integers(1, 200))
        rows = np.unique(np.stack([rng.integers(0, 4, n), rng.integers(0, 2, n), rng.integers(0, 12, n), rng.integers(0, 3, n)], axis=1), axis=0)
        docs, firsts = defaultdict(set), {}
        for high, low, row, at in rows.tolist():
            docs[high, low].add(row)
            firsts.setdefault((high, low), (row, at))
        for keep_first in (False, True):
            want = [(r, a) for h, l, r, a in rows.tolist() if len(docs[h, l]) >= 5 and not (keep_first and firsts[h, l] == (r, a))]
            stream, got, low = line_dedup._Stream(5, keep_first, {}), [], 0
            while low < len(rows):
                to = low + int(rng.integers(1, 30))
                row, at = stream.take(*rows[low:to].T)
                got += list(zip(row.tolist(), at.tolist()))
                low = to
            assert sorted(got) == sorted(want)


def test_bitmaps_round_trip():
    rng = np.random.default_rng(1)
    for n in (1, 7, 8, 9, 1000):
        keep = rng.random(n) < 0.5
        assert (line_dedup.unpacked(line_dedup.packed(keep), n) == keep).all()
    assert len(line_dedup.packed(np.ones(80_000, bool))) < 100


# ---- runs


def runs_by_definition(words, least=12):
    numbers = np.unique(words, return_inverse=True)[1] if words else np.zeros(0, int)
    found = {}
    for q in range(1, len(words) // 2 + 1):
        edges = [-1, *np.flatnonzero(numbers[q:] != numbers[:-q]).tolist(), len(words) - q]
        for low, high in zip(edges, edges[1:]):
            start, end = low + 1, high + q
            if end - start >= max(least, 2 * q):
                found.setdefault((start, end), q)  # ascending q: the first is the smallest
    return sorted(((start, end - start, q) for (start, end), q in found.items()), key=lambda run: (run[0], run[2]))


@pytest.mark.parametrize("length", [64, 128, 256, 1024, 65536])
def test_transform_correlates(length):
    rng = np.random.default_rng(length)
    windows = rng.integers(0, runs.PRIME, (2, length))
    windows[0] = runs.PRIME - 1  # the greatest sums
    blocks = rng.integers(0, runs.PRIME, (2, length // 16))
    blocks[0] = runs.PRIME - 1
    found = runs.correlated(blocks, windows) % runs.PRIME
    for lag in (0, 1, length // 3, length - length // 16):
        want = (blocks * windows[:, lag : lag + length // 16] % runs.PRIME).sum(axis=1) % runs.PRIME
        assert (found[:, lag] == want).all()


def random_texts(rng):
    texts = []
    for _ in range(rng.randint(1, 5)):
        n, kinds = rng.choice([0, 1, 5, 30, 120, 500, 1500]), rng.choice([1, 2, 3, 60])
        words = [str(rng.randrange(kinds)) for _ in range(n)]
        for _ in range(rng.randint(0, 3)):
            if n > 4:
                start, period = rng.randrange(n), rng.randint(1, n // 3)
                for at in range(start, min(n, start + period * rng.randint(2, 6) + rng.randint(0, period))):
                    words[at] = words[start + (at - start) % period]
        texts.append([word.encode() for word in words])
    return texts + texts[:1]


@pytest.mark.parametrize("seed", range(25))
def test_runs_are_those_of_the_definition(seed):
    texts = random_texts(random.Random(seed))
    assert runs.runs_of(texts) == [runs_by_definition(words) for words in texts]


def test_runs_of_long_texts():
    word = lambda at: str(at).encode()
    same = [b"a"] * 200_000
    wide = [word(at % 150_000) for at in range(310_000)]  # beyond the widest window
    fibonacci = [b"a"]
    before = [b"b"]
    while len(fibonacci) < 2500:
        fibonacci, before = fibonacci + before, fibonacci
    assert runs.runs_of([same, wide, fibonacci]) == [[(0, 200_000, 1)], [(0, 310_000, 150_000)], runs_by_definition(fibonacci)]


def test_runs_of_odd_rows(spark, odd):
    found = runs.find_runs(odd).collect()
    assert len(found) == odd.count() and runs.find_runs(odd.limit(0)).count() == 0
    for row in found:
        if row["doc_id"] == 6:
            assert [tuple(run) for run in row["runs"]] == [(0, 45_000, 5)] and row["collapsed"] == "lorem ipsum dolor sit amet"
        if row["doc_id"] in (1, 2, 3):
            assert row["runs"] == [] and row["collapsed"] == ""


def test_registered_runs(spark):
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    want = {}
    for doc, text in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h, n = zlib.crc32(str(doc).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        found = runs_by_definition(words)
        gone = {at for start, length, period in found for at in range(start + period, start + length)}
        top = max(found, key=lambda run: (run[1], -run[0], -run[2]), default=(None, None, None))
        milli = top[1] * 1000 // top[2] if found else None
        digest = sha("".join(f"{s},{n},{q}\n" for s, n, q in found))
        want[doc] = (len(found), *top, milli, digest, sha(" ".join(w for at, w in enumerate(words) if at not in gone)))
    got = queries.op12_periodic_runs(spark, FOLDER)
    assert dict(got.dtypes) == dict(doc_id="bigint", n_runs="bigint", start="bigint", length="bigint", period="bigint", exponent_milli="bigint", runs_sha256="string", collapsed_sha256="string")
    assert {r["doc_id"]: tuple(r)[1:] for r in got.collect()} == want
    assert sum(row[0] > 0 for row in want.values()) > 10


# ---- search


def ranked_by_definition(docs, items, ranks):
    """(item id, rank, doc id, score) by the formula; docs and items are (id, text) in table order."""
    def terms(text):
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)

    split = [(doc, Counter(terms(text))) for doc, text in docs]
    sizes = [sum(found.values()) for _, found in split]
    n_docs, n_terms = sum(size > 0 for size in sizes), sum(sizes)
    df = Counter(term for _, found in split for term in found)
    out = []
    for item, text in items:
        scores = []
        for nth, (doc, found) in enumerate(split):
            m = 50 + 50 * sizes[nth] * n_docs // n_terms if n_terms else 0
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1))) * (10**9 * found[term] // (1000 * found[term] + 20 * m))
                for term in set(terms(text)) if found[term]
            )
            if score > 0:
                scores.append((-score, doc is None, doc or 0, nth, doc))
        out += [(item, rank, row[4], -row[0]) for rank, row in enumerate(sorted(scores)[:ranks], 1)]
    return Counter(out)


@pytest.mark.parametrize("ranks", [1, 3, 50])
def test_search_of_odd_rows(spark, odd, ranks):
    items = [(1, "one THREE lorem"), (2, None), (3, ""), (None, "one"), (1, "amet x é\U0001f600"), (4, "nowhere")]
    asked = spark.createDataFrame([(i, t, 0, "z") for i, t in items], "item_id long, text string, row int, body string")
    index = lexical_search.build_index(odd.coalesce(1))
    found = lexical_search.search(index, asked, ranks)
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert Counter(tuple(r) for r in found.select("item_id", "rank", "doc_id", "score").collect()) == ranked_by_definition(docs, items, ranks)
    assert lexical_search.search(index, asked.limit(0)).count() == 0
    assert lexical_search.search(lexical_search.build_index(odd.limit(0)), asked).count() == 0


@pytest.mark.parametrize("most", [0, 8_000_000])
def test_search_ties_and_pieces(spark, monkeypatch, most):
    monkeypatch.setattr(lexical_search, "BROADCAST_BYTES", most)
    rng = random.Random(9)
    docs = [(nth, " ".join(rng.choice("abcdefghij") for _ in range(rng.choice([3, 3, 40])))) for nth in range(600)]
    docs += [(nth, text) for nth, text in docs[:30]]
    items = [(nth, " ".join(rng.sample("abcdefghij", 3))) for nth in range(20)]
    monkeypatch.setattr(lexical_search, "PIECE_BYTES", 30)
    index = lexical_search.build_index(spark.createDataFrame(docs, "doc_id long, text string"))
    found = lexical_search.search(index, spark.createDataFrame(items, "item_id long, text string"), 7)
    assert Counter(tuple(r) for r in found.select("item_id", "rank", "doc_id", "score").collect()) == ranked_by_definition(docs, items, 7)


def test_bounds_are_never_below_scores_and_seldom_above():
    rng = random.Random(4)
    texts = [" ".join(f"w{int(rng.paretovariate(0.6)) % 5000}" for _ in range(rng.choice([5, 80, 900]))) for _ in range(300)]
    words = [[f"w{n}".encode() for n in range(low, low + 30)] for low in range(0, 300, 30)]
    known = sorted(set().union(*words))
    place = {word: nth for nth, word in enumerate(known)}
    weights = {word: 1 + nth for nth, word in enumerate(known)}
    hashes = lexical_search.text_hashes(lexical_search.pa.array(known, lexical_search.pa.binary()))
    total = sum(len(text.split()) for text in texts)
    asked = lexical_search.Questions(list(range(10)), words, [np.array([place[w] for w in own]) for own in words], hashes, weights, np.array([weights[w] for w in known]), 300, total)
    cells = exact = 0
    for block in lexical_search._blocks_of(np.arange(300), texts):
        bounds = asked.bounds(block["width"], np.array(block["n"]), block["slices"])
        for column, row in enumerate(block["rows"]):
            terms = lexical_search.terms_of(texts[row])
            scores = [asked.score(nth, Counter(terms), len(terms)) for nth in range(10)]
            assert all(bound >= score for bound, score in zip(bounds[:, column], scores))
            cells += 10
            exact += sum(bound <= 1.2 * score for bound, score in zip(bounds[:, column], scores))
    assert exact > 0.8 * cells


# ---- near duplicates: tiles


def near_sets(rng, n):
    base = np.unique(rng.integers(1, 2**63, 120).astype(np.uint64))
    sets = []
    for _ in range(n):
        own = base.copy()
        at = rng.choice(len(own), int(rng.integers(0, 22)), replace=False)
        own[at] = rng.integers(1, 2**63, len(at)).astype(np.uint64)
        sets.append(np.unique(own))
    return sets


def test_tiles_find_each_link_in_its_first_bucket():
    rng = np.random.default_rng(8)
    sets = near_sets(rng, 60)
    members = [near_dedup._Member(nth % 2, f"n{nth}", f"r{nth // 3}", sorted(rng.choice([3, 5, 7], int(rng.integers(1, 4)), replace=False).tolist()), own) for nth, own in enumerate(sets)]
    jaccard = lambda a, b: len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    want = Counter()
    for a, x in enumerate(members):
        for y in members[a + 1 :]:
            if x.root != y.root and set(x.bands) & set(y.bands) and jaccard(x.shingles, y.shingles) >= 0.8:
                want[frozenset((x.node, y.node))] += 1
    found = Counter()
    for band in (3, 5, 7):
        held = [member for member in members if band in member.bands]
        tiles = [[member for member in held if member.tile == tile] for tile in (0, 1)]
        for low, high in ((0, 0), (0, 1), (1, 1)):
            if tiles[low] and tiles[high]:
                found.update(frozenset(pair) for pair in near_dedup.links_of_tiles(band, tiles[low], tiles[high], 0.8))
    assert found == want and len(want) > 50


@pytest.mark.parametrize("bands", [1, 3])
def test_large_buckets_lose_no_link(spark, monkeypatch, bands):
    """Every text shares its buckets with many; few pairs are near, so that pivots leave most of it open."""
    monkeypatch.setattr(near_dedup, "SMALL", 4)
    monkeypatch.setattr(near_dedup, "TILE", 16)
    monkeypatch.setattr(near_dedup, "band_keys", lambda marks: np.stack([np.arange(len(marks)) % 2 + 10 * band for band in range(bands)], axis=1).astype(np.int64))
    rng = random.Random(1)
    words = [f"w{nth}" for nth in range(90)]
    texts = {nth: f"x{nth} " + " ".join(word if rng.random() > rate else f"x{nth}" for word in words) for nth, rate in enumerate([0.0, 0.01, 0.02, 0.03, 0.05] * 20)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").coalesce(1)
    found = {r["doc_id"]: r["class_id"] for r in near_dedup.near_duplicates(docs).collect()}
    shingler = near_dedup.Shingler()
    sets = [shingler.of(texts[nth]) for nth in range(100)]
    root = list(range(100))

    def find(nth):
        while root[nth] != nth:
            nth = root[nth]
        return nth

    for a in range(100):
        for b in range(a):
            if a % 2 == b % 2 and near_dedup.weighted_jaccard(sets[a], sets[b]) >= 0.8:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert found == {nth: find(nth) for nth in range(100)}
    assert 5 < len(set(found.values())) < 95


def test_one_of_each_keeps_columns_that_its_own_are_named_like(spark):
    text = " ".join(f"w{nth}" for nth in range(40))
    rows = [(1, text, "a", 5, "r"), (2, text + " end", "b", 6, "s"), (2, "other words of their own", "c", 7, "t"), (None, "", "d", 8, "u")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, stay_own string, rows int, row string").withColumn("own", F.lit(1)).withColumn("node", F.lit("n")).withColumn("id", F.lit(0))
    kept = near_dedup.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0, r["stay_own"], r["rows"], r["row"]) for r in kept.collect()) == [(0, "d", 8, "u"), (1, "a", 5, "r"), (2, "c", 7, "t")]
    assert near_dedup.one_of_each(docs.limit(0)).count() == 0
