"""Secrets far behind their word, short ones, and those of the fixed forms; rows exchanged by their splitters."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapdelta.llm import secret_scan, sharding
from snapdelta.llm.frames import kept, text_of

LETTERS = list("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz23456789")
PROSE = "some prose about nothing that explains little, and a list of ordinary words. " * 8


def secret_of(length, seed=7):
    return "".join(np.random.default_rng(seed).choice(LETTERS, length))


def found(text):
    return [text[s:e] for _, s, e, _ in secret_scan.novel_spans(text, secret_scan.base_spans(text), secret_scan.Novelty())]


@pytest.mark.parametrize("gap", [1, 40, 60, 100, 3000])
@pytest.mark.parametrize("length", [15, 24, 40])
def test_a_secret_is_found_however_far_behind_its_word(gap, length):
    secret = secret_of(length)
    assert found(f"{PROSE}\nthe passphrase{' of a thing' * (gap // 11)}: {secret}\n{PROSE}") == [secret]


@pytest.mark.parametrize("word", ["Kennwort: ", "clave = ", "auth: ", "mot de passe : ", "signing-key\n"])
def test_words_of_other_languages(word):
    secret = secret_of(24)
    assert found(f"{PROSE}\n{word}{secret}\n{PROSE}") == [secret]
    assert found(f"{PROSE}\nthe author {secret}\n\n{PROSE}") == []


def test_a_paragraph_ends_the_context_and_plain_words_are_no_secrets():
    secret = secret_of(24)
    assert found(f"{PROSE} passphrase\n \n{secret} {PROSE}") == []
    assert found(f"{PROSE} passphrase Donaudampfschifffahrtsgesellschaft internationalization {PROSE}") == []


def test_candidates_are_those_of_brute_force():
    rng = np.random.default_rng(3)
    pieces = ["token ", "Passwort=", "\n\n", "\n \t\n", "\n", "author ", "abcdefghijklmnopqr ", "Zq7" * 5, " ", "=", "==", "x" * 30, "A1b2C3d4E5f6 ", ": ", "é", "AUTH:"]
    for _ in range(200):
        text = "".join(rng.choice(pieces, 30))
        want = []
        for m in re.finditer(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{12,}(?:={1,2}(?![A-Za-z0-9+/_=-]))?", text):
            behind = re.split(r"\n[^\S\n]*\n", text[: m.start()])[-1]
            if secret_scan.SENSITIVE.search(behind) and secret_scan._long_enough(text, *m.span()):
                want.append(m.span())
        # a run that holds the sensitive word itself may begin inside it
        got = [span for span in secret_scan.candidates(text) if span in want]
        assert got == [span for span in want if span in secret_scan.candidates(text)] and set(secret_scan.candidates(text)) >= {
            span for span in want if not secret_scan.SENSITIVE.search(text[span[0] : span[1]])
        }


def test_fixed_forms_are_measured(spark):
    rows = [(1, f'x password = "{secret_of(30)}" y'), (2, "x password = changemechangeme y"), (3, None)]
    spans = {r["doc_id"]: r["spans"] for r in secret_scan.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert spans[1][0]["novelty"] > spans[2][0]["novelty"] > 0 and not spans[3]


def test_rows_are_exchanged_by_their_splitters(spark):
    odd = spark.createDataFrame([(None, None, "r"), (1, "", "r"), (1, "", "r"), (2, None, "r")], "doc_id long, text string, shard string")
    many = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "copy").otherwise(F.repeat(F.lit("w"), (F.col("id") % 90).cast("int"))).alias("text"))
    for docs, shards in ((many, 24), (many, 3), (many, 1), (odd, 24), (odd.limit(0), 24)):
        named = docs.withColumn("range", F.lit("user"))
        text = text_of("text")
        keys = kept(named.select((F.octet_length(text) + 8).cast("long").alias("size"), sharding.key_of(F.col("doc_id"), text).alias("key")))
        ranges = sharding.ranges_of(keys, shards)
        assert len(ranges) == shards and sum(ranges, []) == sorted(sum(ranges, []))
        moved = sharding.exchanged(named, ranges)
        flat = moved.select("row.*").columns
        assert flat == named.columns
        rows = moved.select("row.doc_id", "row.text", F.col("shard"), F.spark_partition_id().alias("part")).collect()
        assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter((r["doc_id"], r["text"]) for r in docs.collect())
        want = Counter((r["doc_id"], r["shard"]) for r in sharding.assign_shards(named, shards).collect())
        assert Counter((r["doc_id"], r["shard"]) for r in rows) == want
        # one partition holds rows of one shard only, and higher partitions hold no lower shards
        shards_of = {}
        for r in rows:
            shards_of.setdefault(r["part"], set()).add(r["shard"])
        assert all(len(found) == 1 for found in shards_of.values())
        assert [min(shards_of[part]) for part in sorted(shards_of)] == sorted(min(found) for found in shards_of.values())
