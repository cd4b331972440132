"""Substring deduplication by hashing lines.

Units are the lines of a text (or its paragraphs, by another separator). Each is
normalised (A-Z lowered, white space squeezed and trimmed), digests of units of
``min_words`` words or more are grouped over the whole corpus, the earliest
occurrence by rank stays and all others are removed. What stays keeps its
offsets in the original text. Every unit that has a word counts; a caller may ask
for ``min_words`` more.

Short units repeat by chance, and passages begin and end inside lines. So sentences
(``[^.!?\\n]+[.!?]*``, normalised alike) are grouped by digest too, and each document
gets, first occurrences included, the words of its sentences that occur in another
document (``n_shared_words``) and of the longest run of such sentences
(``passage_words``). Of a passage of over 50 words its whole sentences are seen, so
one of over ``PASSAGE`` words counts as a passage.

Texts are read once for their digests, which are staged by document; only digests,
ranks and positions move, and texts meet the removals once, by document. The winner
of a digest is a minimum, combined on the map side, so a line that a third of all
rows share costs one row per task; digests that occur once are filtered out before
the join, and a hot digest's join is split by adaptive execution (an inner join with
no order or grouping right above it).

Defined results: rank is doc_id (nulls last), then the text's hash, then the
unit's position; rows equal in doc_id and text are one document and all get its
result; null texts stay null, with no units; blank units always stay; a text of
which all is removed becomes empty; very long texts are units like others, however
many; an empty table gives an empty result. Columns of the input that are named
like a result are replaced by it.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame

from brindle.llm.common import appended, shaped, staged

#: Words that a run of shared sentences must exceed to count as a passage of over 50 words, whose ends lie within sentences.
PASSAGE = 40

_SPANS = "array<struct<start:bigint,end:bigint>>"
MADE = {"n_units": "bigint", "n_removed": "bigint", "removed": _SPANS, "kept": _SPANS, "n_shared_words": "bigint", "passage_words": "bigint", "clean": "string"}

Spans = list[tuple[int, int]]

_SENTENCE = re.compile(rb"[^.!?\n]+[.!?]*")


def sentences(text: bytes) -> list[list[bytes]]:
    """The words of each sentence that has one, A-Z lowered."""
    return [words for found in _SENTENCE.findall(text) if (words := found.lower().split())]


def passages(text: str, shared: list[int]) -> tuple[int, int]:
    """Words of the sentences at the positions ``shared``, and of their longest run."""
    if not shared:
        return 0, 0
    both = set(shared)
    words = run = longest = 0
    for i, sentence in enumerate(sentences(text.encode("utf-8", "surrogatepass"))):
        if i in both:
            words, run = words + len(sentence), run + len(sentence)
            longest = max(longest, run)
        else:
            run = 0
    return words, longest


def rebuilt(text: str | None, gone: list[int], shared: list[int], separator: str) -> tuple[int, int, Spans, Spans, int, int, str | None]:
    """The results of MADE for a text, the positions of the units to remove and of the sentences that other documents have."""
    if text is None:
        return 0, 0, [], [], 0, 0, None
    units = text.split(separator)
    out, removed, kept = set(gone), [], []
    at, touching = 0, False
    for i, unit in enumerate(units):
        end = at + len(unit)
        if i in out:
            removed.append((at, end))
            touching = False
        else:
            if touching:
                kept[-1] = (kept[-1][0], end)
            else:
                kept.append((at, end))
            touching = True
        at = end + len(separator)
    return len(units), len(removed), removed, kept, *passages(text, shared), separator.join(text[s:e] for s, e in kept)


def _digest(words: list[bytes]) -> bytes:
    return hashlib.md5(b" ".join(words), usedforsecurity=False).digest()


def digests(text: bytes | None, min_words: int, separator: bytes) -> tuple[list[bytes | None], list[int]]:
    """Of each unit the digest of its normal form, if it counts; 64-bit ones of all sentences."""
    lines = [unit.lower().split() for unit in text.split(separator)] if text else []  # bytes: A-Z and ASCII white space only
    found = [int.from_bytes(_digest(words)[:8], "little", signed=True) for words in sentences(text or b"")]
    return [_digest(words) if len(words) >= min_words else None for words in lines], found


def units(docs: DataFrame, min_words: int, separator: str) -> DataFrame:
    """``doc_id``, ``text_hash`` and the digests of ``lines`` and ``sentences`` in order."""

    def batch(column: pa.Array) -> list[list]:
        rows = [digests(t, max(1, min_words), separator.encode()) for t in column.to_pylist()]
        return [[r[0] for r in rows], [r[1] for r in rows]]

    source = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.encode("text", "UTF-8").alias("bytes"))
    return appended(source, {"lines": "array<binary>", "sentences": "array<bigint>"}, batch, "bytes").drop("bytes")


def removals(docs: DataFrame, min_words: int = 1, separator: str = "\n") -> DataFrame:
    """``doc_id``, ``text_hash``, ``gone`` (positions of units that occur earlier in the corpus) and ``shared`` (of sentences that another document has)."""
    every = staged(units(docs, min_words, separator), "units")
    key = ["doc_id", "text_hash"]
    lines = every.select(*key, F.posexplode("lines").alias("pos", "digest")).where("digest IS NOT NULL")
    rank = F.struct(F.col("doc_id").isNull().alias("nameless"), *key, "pos")
    ends = lines.groupBy("digest").agg(F.min(rank).alias("first"), F.max(rank).alias("last")).where("first <> last")
    firsts = staged(ends.select("digest", "first"), "first-units")  # with no aggregate beside it, the join can be split
    later = lines.join(firsts, "digest").where(rank != F.col("first")).select(*key, "pos", F.lit(True).alias("line"))

    pieces = every.select(*key, F.posexplode("sentences").alias("pos", "digest"))
    document = F.xxhash64(*key)
    apart = pieces.groupBy("digest").agg(F.min(document).alias("least"), F.max(document).alias("most")).where("least <> most")
    common = staged(apart.select("digest"), "shared-sentences")
    shared = pieces.join(common, "digest").select(*key, "pos", F.lit(False).alias("line"))
    places = lambda of: F.collect_set(F.when(of, F.col("pos")))
    return later.union(shared).groupBy(*key).agg(places(F.col("line")).alias("gone"), places(~F.col("line")).alias("shared"))


def deduplicated(docs: DataFrame, min_words: int = 1, separator: str = "\n") -> DataFrame:
    """``docs`` with ``text`` deduplicated, plus the other columns of ``MADE``.

    Spans are (start, end) in code points of the original text, end exclusive.
    """
    docs = shaped(docs, ["doc_id", "text"], [*MADE, "_h", "_d", "_in"])
    names = docs.columns
    found = removals(docs, min_words, separator).select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h"), "gone", "shared")
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.xxhash64("text") == F.col("_h"))
    places = [F.coalesce(c, F.expr("cast(array() as array<int>)")).alias(c) for c in ("gone", "shared")]
    met = docs.join(found, same, "left").withColumn("_in", F.struct("text", *places))

    def batch(column: pa.Array) -> list:
        results = [rebuilt(r["text"], r["gone"], r["shared"], separator) for r in column.to_pylist()]
        made = dict(zip(MADE, zip(*results, strict=True), strict=True)) if results else dict.fromkeys(MADE, ())
        named = lambda rows: [[{"start": s, "end": e} for s, e in x] for x in rows]
        return [named(v) if k in ("removed", "kept") else list(v) for k, v in made.items()]

    met = met.select(*[n for n in names if n != "text"], "_in")
    out = appended(met, MADE, batch, "_in").withColumnRenamed("clean", "text")
    return out.select(*names, *[k for k in MADE if k != "clean"])
