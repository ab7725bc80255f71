"""Terms that give personal data away, beside a brute-force count over all documents."""

import math
import re
from collections import defaultdict
from hashlib import md5

import pytest

from snapdelta.llm import pii

SCHEMA = "doc_id long, text string, spans string, key string, term string, body string"


def entities(kind, value):
    value = value.lower()
    yield f"{kind}:{value}"
    if kind == "email":
        name, domain = value.split("@")[:2]
        yield f"domain:{domain}"
        yield from (f"name:{part}" for part in re.split("[^a-z]+", name) if len(part) >= 3)
    elif kind == "ip":
        yield "network:" + ".".join(value.split(".")[:3])
    else:
        yield f"{kind} prefix:" + re.sub("[^0-9]", "", value)[:6]


def revealed(rows):
    """The terms of each row as (start, end, term, action); ``rows`` holds (id, text, base spans)."""
    words = [{m[0].lower() for m in re.finditer(r"\w+", text)} for _, text, _ in rows]
    holds = [{e for kind, start, end in base for e in entities(kind, text[start:end])} for _, text, base in rows]
    n_term, n_entity, n_both, proof = defaultdict(int), defaultdict(int), defaultdict(int), defaultdict(set)
    for (_, text, _), own, held in zip(rows, words, holds, strict=True):
        for word in own:
            n_term[word] += 1
        for entity in held:
            n_entity[entity] += 1
            for word in own:
                n_both[entity, word] += 1
                proof[entity, word].add(text)
    share = {}
    for (entity, word), both in n_both.items():
        lift = both * len(rows) / (n_term[word] * n_entity[entity])
        content = math.log(len(rows) / n_entity[entity])
        if len(proof[entity, word]) > 1 and content > 0 and both * math.log(lift) >= pii.EVIDENCE:
            share[entity, word] = math.log(lift) / content
    found = []
    for (row_id, text, base), held in zip(rows, holds, strict=True):
        places = []
        for m in re.finditer(r"\w+", text):
            best = max((share.get((entity, m[0].lower()), 0) for entity in held), default=0)
            if best >= pii.GENERALISE and not any(start < m.end() and m.start() < end for _, start, end in base):
                places.append((m.start(), m.end(), m[0].lower(), "remove" if best >= pii.REMOVE else "generalise"))
        found.append((row_id, text, tuple(places)))
    return sorted(found, key=str)


@pytest.fixture(scope="module")
def corpus():
    gap = "plain words of no weight stand here " * 30
    rows = [(i, f"Dossier Zanzibarian {i}\n{gap}write to bo.li{i}@rare{i % 2}.org or +1 (578) 555-{6430 + i}\n{gap} Zanzibarian") for i in range(6)]
    rows += [(20 + i, f"Acct K4471X2 of Bo Li é\U0001f600 {gap} bo.li@home.net {gap} K4471X2 end {i}") for i in range(3)]
    rows += [(30 + i, f"server {i} Lagrange {gap} 10.20.30.{i} Lagrange@10.20.30.{i}") for i in range(4)]
    # copies of one text are one piece of evidence, however many rows hold them
    rows += [(40 + i, f"Solitary heading {gap} one@single.org") for i in range(3)] + [(40, f"Solitary heading {gap} one@single.org")]
    rows += [(60 + i, f"{gap} nothing but {i} words, and the plain heading") for i in range(120)]
    rows += [(300, None), (None, None), (301, ""), (302, "___ İı x"), (None, f"Zanzibarian {gap} x@rare0.org"), (20, rows[6][1])]
    return rows


def test_terms_are_those_of_brute_force(spark, corpus):
    frame = spark.createDataFrame([(*row, "s", "k", "t", "b") for row in corpus], SCHEMA)
    found = pii.find_personal_data(frame).collect()
    base = {}
    for row in found:
        base.setdefault((row["doc_id"], row["digest"]), [(s["kind"], s["start"], s["end"]) for s in row["base"]])
    rows = [(i, text or "", base[i, md5((text or "").encode()).hexdigest()]) for i, text in corpus]
    digests = {md5((text or "").encode()).hexdigest(): text or "" for _, text in corpus}
    got = sorted(((r["doc_id"], digests[r["digest"]], tuple((t["start"], t["end"], t["term"], t["action"]) for t in r["terms"])) for r in found), key=str)
    assert got == revealed(rows)


def test_far_terms_go_at_each_of_their_places(spark, corpus):
    frame = spark.createDataFrame(corpus, "doc_id long, text string")
    clean = {r["doc_id"]: r["sanitised"] for r in pii.sanitised(frame).collect()}
    assert all("anzibarian" not in clean[i] for i in range(6)) and all("K4471X2" not in clean[20 + i] for i in range(3))
    assert "Solitary" in clean[40] and clean[60] == dict(corpus)[60] and clean[301] == ""


def test_both_ways_to_count_terms_agree(spark, corpus, monkeypatch):
    frame = spark.createDataFrame(corpus, "doc_id long, text string")
    rows = lambda: sorted(map(str, pii.find_personal_data(frame).collect()))
    want = rows()
    monkeypatch.setattr(pii, "BROADCAST_TERMS", -1)
    assert rows() == want


def test_no_rows(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert pii.find_personal_data(frame).count() == 0 and pii.sanitised(frame).count() == 0
