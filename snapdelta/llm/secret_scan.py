"""Secrets in texts: fixed forms, and strings that a compressor cannot explain.

Fixed forms are found by pattern. Beyond them, each run of key characters that follows a sensitive word
in the same paragraph, however far behind, is a candidate; its novelty is the number of bytes by which it
lengthens the zstandard frame of the code and prose around it, the compressor being primed with a
dictionary of common identifiers. The fixed forms are measured alike, but stay whatever they measure.
Other places of the same string around it are blanked, so that a repeated secret does not explain itself.
Words and names that the surroundings or the dictionary know cost little; random strings cost
nearly a byte a character or more, and are reported.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

# The forms of the base kinds, in the order in which they are listed.
KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # a shorter run fails whole, so only long ones need looking at
LEAST = {"assign": 12, "access": 18}
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")

#: Words that make what follows them sensitive, in the languages of the corpus.
SENSITIVE = re.compile(
    r"password|passwd|passphrase|passcode|passwort|pwd|secret|token|credential|bearer|auth(?!or)|authoriz|"
    r"(?:api|private|access|signing|encryption)[ _-]?key|kennwort|schlüssel|clave|contraseña|mot de passe",
    re.I,
)
#: A text without any of these holds no sensitive word, and is not searched.
STEMS = ("pass", "pwd", "secret", "token", "credential", "bearer", "auth", "key", "kennwort", "schlüssel", "clave", "contraseña")
PARAGRAPH = re.compile(r"\n[^\S\n]*\n")
#: Key characters that a candidate has at least, by how many of small letters, capitals and digits are among them;
#: a capital at the start alone makes no class, and a candidate of one class must stand behind an assignment.
LEAST_LENGTH = {0: 16, 1: 16, 2: 14, 3: 12}
ASSIGNED = re.compile(r"[:=]\s*[\"']?$")
#: Characters on each side that a candidate is measured against.
AROUND = 2_000
#: Key characters, with "=" only as padding behind them: before them it assigns.
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{12,}(?:={1,2}(?![A-Za-z0-9+/_=-]))?")
#: Bytes of frame for each character of a candidate from which on it is reported.
NOVELTY = 0.8

#: Identifiers that any code holds; they prime the compressor. Callers may give their own.
IDENTIFIERS = (
    "abstract accessToken access_token account_id addEventListener apiVersion application argument array assert async "
    "attribute authentication authorization await base64 boolean buffer callback certificate checksum children class client "
    "client_id client_secret collection column component config configuration connection connectionString const constructor "
    "container content contentType context controller cookie counter created_at credentials currentUser database datetime "
    "default definition delete dependencies description destination development dictionary directory document element "
    "encoding endpoint environment exception execute expected export extends factory filename filter float format function "
    "getElementById getenv global handler hashlib header hostname identifier implements import include index initialize "
    "instance integer interface invalid iterator javascript json keyword lambda length library listener localhost logger "
    "manager message metadata method middleware migration module namespace number object observable operator option "
    "os.environ output override package parameter parent password path permission placeholder plugin pointer postgresql "
    "primary_key private process production promise property protected protocol provider public publicKey query random "
    "readonly receive reference refresh_token register registry repository request require resource response return router "
    "schema secret_key select selector self serialize server service session settings signature source static status stream "
    "string struct subscribe super switch synchronized template test timestamp token transaction transform typedef undefined "
    "unsigned update username utf-8 validate value variable version virtual volatile webhook window worker write yield "
    "example changeme your_password your-api-key xxxxxxxxxxxxxxxx 0123456789abcdef ABCDEFGHIJKLMNOPQRSTUVWXYZ abcdefghijklmnopqrstuvwxyz"
)
SPANS = "array<struct<kind:string,start:int,end:int,novelty:double>>"


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed forms, leftmost and apart within a kind; a match that is too short is dropped whole."""
    found = []
    low = text.lower()
    if any(word in low for word in ASSIGN_WORDS) or "ı" in low or not low.isascii():
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return found


class Novelty:
    """Marginal compressed bytes of a string between what stands around it."""

    def __init__(self, identifiers: str = IDENTIFIERS):
        primed = zstandard.ZstdCompressionDict(identifiers.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self._compressor = zstandard.ZstdCompressor(level=9, dict_data=primed, write_content_size=False)

    def of(self, text: str, start: int, end: int, around: int = AROUND) -> float:
        own = text[start:end].rstrip("=") or text[start:end]
        # a place that the edge of the surroundings cuts is blanked too
        blanked = lambda part: part.replace(own, " " * len(own))
        before = blanked(text[max(0, start - around - len(own)) : start])[-around:]
        after = blanked(text[end : end + around + len(own)])[:around]
        size = lambda body: len(self._compressor.compress(body.encode("utf-8", "surrogatepass")))
        return (size(before + text[start:end] + after) - size(before + after)) / (end - start)


def _long_enough(text: str, start: int, end: int) -> bool:
    own = text[start:end]
    rest = own[1:]
    # a capital that starts a word tells no more than its small letter
    capitals = any("A" <= x <= "Z" for x in rest)
    classes = capitals + any("a" <= x <= "z" for x in rest) + any("0" <= x <= "9" for x in own)
    if len(own.rstrip("=")) < LEAST_LENGTH[classes]:
        return False
    return classes > 1 or bool(ASSIGNED.search(text, max(0, start - 8), start))


def candidates(text: str) -> list[tuple[int, int]]:
    """Runs of key characters behind a sensitive word of their paragraph, in order."""
    found, at = [], 0
    folded = text.casefold()
    if not any(stem in folded for stem in STEMS):
        return found
    while word := SENSITIVE.search(text, at):
        stop = PARAGRAPH.search(text, word.end())
        at = stop.end() if stop else len(text)
        found += [m.span() for m in CANDIDATE.finditer(text, word.end(), at) if _long_enough(text, *m.span())]
    return found


def novel_spans(text: str, known: list[tuple[str, int, int]], novelty: Novelty, least: float = NOVELTY) -> list[tuple[str, int, int, float]]:
    """Candidates that measure enough and overlap none of the known spans."""
    starts, ends = [], []
    for _, start, end in sorted(known, key=lambda span: span[1]):
        starts.append(start)
        ends.append(max(end, ends[-1] if ends else end))
    found = []
    for start, end in candidates(text):
        before = bisect_left(starts, end)  # known spans that start before the candidate ends
        if before and ends[before - 1] > start:
            continue
        measured = novelty.of(text, start, end)
        if measured >= least:
            found.append(("novel", start, end, measured))
    return found


@lru_cache(maxsize=2)
def _novelty(identifiers: str) -> Novelty:
    return Novelty(identifiers)


def scan_secrets(
    docs: DataFrame, identifiers: str = IDENTIFIERS, least_novelty: float = NOVELTY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: the id and ``spans``, by start and then by kind as listed in ``KINDS``.

    Positions count code points, ends exclusive; ``novelty`` is the bytes of frame for each character. Base
    kinds stay as they are; a novel span never overlaps one. A null or empty text has no spans; repeated rows are scanned each; an empty table
    gives an empty one; other columns are not read. Rows are scanned where they lie, whole.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = _novelty(identifiers)
        rank = {name: at for at, name in enumerate(KINDS)}
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                base = base_spans(text or "")
                spans = [(*span, novelty.of(text, *span[1:])) for span in base] + novel_spans(text or "", base, novelty, least_novelty)
                spans.sort(key=lambda span: (span[1], rank[span[0]]))
                rows.append([dict(zip(("kind", "start", "end", "novelty"), span, strict=True)) for span in spans])
            made = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("novelty", pa.float64())])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(made))], names=["id", "spans"])

    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("body"))
    return picked.mapInArrow(scan, f"id {kind}, spans {SPANS}").withColumnRenamed("id", id_col)
