"""License scans: MinHash bands over overlapping word windows, in DataFrame expressions only.

A template is a wording of a license (its text, header or a citation), as five-word
shingles of its lower-cased words; one of three or four words as shingles of three, one
of fewer as one shingle. The name up to a ``#`` is the license's. The registered query scans for the templates of
``license_bank``.

A text's shingles, of each width that templates have, are cut into blocks of ``BLOCK``,
and again of ``RATIO`` times as many, up to the longest template. The MinHash values of
a block are the least shingle hash in each of 2 ** ``BITS`` ranges (2 ** ``FINE`` in the
least blocks; one permutation, binned); each is a band of one row, and those of larger
blocks are the least of their parts'. A template belongs to the least block size that
holds it. A block that shares a band with templates of its size retrieves them; exact
containment of their shingles, ``CONTAINMENT`` or more, in the windows of twice the
template's length that overlap by half and touch the block verifies the match. Nothing
is found but through a band.

A window with a match has at least 0.8 n of a template's n shingles. In the least blocks
a shingle is its range's least but for a chance of under 32 / 2 ** 21, which bounds what
one-shingle templates miss by 2e-5. In larger ones, of at most 4 n, each of 0.8 n shingles
is so with a chance of about (1 - exp(-4 n / 128)) 128 / 4 n or more, so all bands miss
with far less.

A match gives way to a better one in an overlapping window that explains most of
it: one with more shingles met, or as many of a shorter template. So a text of
three clauses is not also one of two, and a notice of one version not another's.
A wording of fewer than five words gives way to any longer match that it lies within.

Templates are a parameter: their bands and shingles are constants of the plan, in
parts of about ``MAX_SHINGLES`` shingles, and rows are judged where they lie,
without a shuffle. Work grows with the templates only where bands meet.

Defined results: null and empty texts match nothing; a template without words
is refused; several occurrences of a template count once, at the
first window that has it; very long texts are scanned whole; repeated rows are
all judged; an empty table gives an empty result; a column named ``licenses`` is
replaced.
"""

from __future__ import annotations

import json

import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession

from brindle.llm.common import NON_WORD, let, shaped, words_of

SHINGLE, CONTAINMENT = 5, 0.8
#: Shingles of the least block, how many blocks make the next larger one, and bits of a hash that tell its range.
BLOCK, RATIO, BITS = 32, 4, 7
#: Bits that tell the range in the least blocks.
FINE = 20
#: Shingles of templates that one constant of the plan holds.
MAX_SHINGLES = 20_000
_MATCH = "struct<license:string,at:int,n:int,word:int,end:int,m:array<bigint>>"
_KNOWN = "array<struct<l:string,n:int,b:array<bigint>,s:array<bigint>>>"

#: One notice each of four licenses, the default of a caller who gives no templates. Fixed values.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
}


def width_of(words: int) -> int:
    """Words of the shingles of a template of so many words."""
    return SHINGLE if words >= SHINGLE else min(3, words)


def _words(text: str) -> str:
    """SQL for the words of a text; one empty word if there is none."""
    return f"split(regexp_replace(lower({text}), r'^{NON_WORD}|{NON_WORD}\\z', ''), r'{NON_WORD}')"


def _shingles(words: str, width: int = SHINGLE) -> str:
    """SQL for the shingle hashes of an array of words, in order; an empty array under ``width`` words."""
    at = ", ".join(f"{words}[i + {k}]" for k in range(width))
    return f"if(size({words}) < {width} OR {words}[0] = '', cast(array() as array<bigint>), transform(sequence(0, size({words}) - {width}), i -> xxhash64({at})))"


def _minima(v: str, bits: int = BITS) -> str:
    """SQL for the MinHash values of an array of shingles: the least of each range, in order."""
    range_of = lambda x: f"shiftrightunsigned({x}, {64 - bits})"
    return let("s", f"sort_array({v})", f"filter(s, (x, i) -> i = 0 or {range_of('x')} <> {range_of('s[i - 1]')})")


def _longs(values) -> str:
    return ", ".join(f"{x}L" if x > -(2**63) else "(-9223372036854775807L - 1L)" for x in sorted(values))


def _quoted(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _verified(known: str, first: str, last: str, containment: float, width: int) -> str:
    """SQL for the matches of retrieved templates in their windows number ``first`` to ``last``."""
    match = let(
        "w", "slice(h, q * t.n + 1, 2 * t.n)",
        let("m", "array_intersect(w, t.s)", f"""if(size(m) >= {containment}D * t.n - 1e-9D, array(named_struct('license', t.l, 'at', int(q * t.n), 'n', t.n,
            'word', int(q * t.n + array_position(w, m[0]) - 1), 'end', int(q * t.n + array_position(w, m[size(m) - 1]) + {width - 1}), 'm', m)), cast(array() as array<{_MATCH}>))"""),
    )
    return f"flatten(transform({known}, t -> flatten(transform(sequence(greatest(0, {first}), least({last}, (size(h) - 1) div t.n)), q -> {match}))))"


def _matches(spark: SparkSession, templates: dict[str, str], width: int, containment: float) -> str:
    """SQL for all matches, in the array ``words``, of templates whose shingles have ``width`` words."""
    given = _quoted(json.dumps([{"name": k, "t": t} for k, t in templates.items()]))
    rows = spark.range(1, numPartitions=1).select(F.expr(f"inline(from_json({given}, 'array<struct<name:string,t:string>>'))"))
    told = rows.select("name", F.expr(f"array_distinct({let('words', _words('t'), _shingles('words', width))})").alias("s")).select("name", "s", F.expr(_minima("s")).alias("b"), F.expr(_minima("s", FINE)).alias("fine")).collect()
    parts: list[tuple[int, list]] = []  # (block size, templates)
    for r in sorted(told, key=lambda r: (len(r["s"]), r["name"])):
        n, size = len(r["s"]), BLOCK
        while size < n:
            size *= RATIO
        if not parts or parts[-1][0] != size or sum(x["n"] for x in parts[-1][1]) + n > MAX_SHINGLES:
            parts.append((size, []))
        parts[-1][1].append({"l": r["name"].partition("#")[0], "n": n, "b": r["fine"] if size == BLOCK else r["b"], "s": sorted(r["s"])})

    found = []
    for size, known in parts:
        kin = f"from_json({_quoted(json.dumps(known))}, '{_KNOWN}')"  # JSON makes one constant of the templates, whatever their number
        bands = _longs({x for t in known for x in t["b"]})
        near = f"filter(sequence(0, size(v{size}) - 1), i -> exists(v{size}[i], x -> x in ({bands})))"
        some = _verified(f"filter({kin}, t -> arrays_overlap(v{size}[i], t.b))", f"i * {size} div t.n - 1", f"((i + 1) * {size} - 1) div t.n", containment, width)
        found.append(f"flatten(transform({near}, i -> {some}))")
    matches = f"array_distinct(concat({', '.join(found)}))"
    sizes = [BLOCK * RATIO**k for k in range(20) if BLOCK * RATIO**k <= max(s for s, _ in parts)]
    for size in reversed(sizes):
        below = "h" if size == BLOCK else f"v{size // RATIO}"
        count = BLOCK if size == BLOCK else RATIO
        part = f"slice({below}, int(k) * {count} + 1, {count})"
        least = _minima(part, FINE) if size == BLOCK else _minima(f"flatten({part})")
        matches = let(f"v{size}", f"transform(sequence(0, (size({below}) - 1) div {count}), k -> {least})", matches)
    return let("h", _shingles("words", width), f"if(size(h) = 0, cast(array() as array<{_MATCH}>), {matches})")


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, text: str = "text", containment: float = CONTAINMENT) -> DataFrame:
    """``docs`` plus ``licenses``: an array of (license, word, end), the words from the first to the last shingle met."""
    docs = shaped(docs, [text], ["licenses"])
    widths: dict[int, dict[str, str]] = {}
    for name, t in templates.items():
        widths.setdefault(width_of(len(words_of(t.encode()))), {})[name] = t
    if 0 in widths:
        raise ValueError(f"templates without words: {sorted(widths[0])}")
    if not widths:
        return docs.withColumn("licenses", F.expr("cast(array() as array<struct<license:string,word:int,end:int>>)"))
    found = [_matches(docs.sparkSession, widths[k], k, containment) for k in sorted(widths)]
    every = let("words", _words(f"coalesce(`{text}`, '')"), f"concat({', '.join(found)})")
    better = """b.at < a.at + 2 * a.n and a.at < b.at + 2 * b.n and (size(b.m) > size(a.m) or (size(b.m) = size(a.m) and b.n < a.n))
        and 2 * size(array_intersect(a.m, b.m)) > size(a.m)
        or a.end - a.word < 5 and b.word <= a.word and a.end <= b.end and size(b.m) > size(a.m)"""
    best = let("g", every, f"filter(g, a -> not exists(g, b -> {better}))")
    first = """transform(array_sort(array_distinct(transform(f, x -> x.license))), n ->
        array_min(transform(filter(f, x -> x.license = n), x -> named_struct('license', n, 'word', x.word, 'end', x.end))))"""
    return docs.withColumn("licenses", F.expr(let("f", best, first)))
