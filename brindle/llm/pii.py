"""Personal data by weak supervision, in DataFrame expressions only.

Candidate spans come from one regular expression per kind. Labelers of three
sorts vote on each (+1, -1, 0 abstains): patterns and checksums, gazetteers
(issuer prefixes, country codes, top-level domains), and context (words before,
characters around). Expectation-maximisation over counts of vote patterns
estimates each labeler's reliability by kind; a logistic span classifier over
features of the span is then fitted to the posteriors. Both work on counts of
discrete patterns, whose number is bounded by the features, not by the data.

Base spans follow the fixed definitions of their kinds and always stay. The
classifier may add candidates that the base rules reject, and the further kinds
``secret``, ``ssn`` and ``tel``.

Matches are found whole and leftmost: quantifiers are possessive where nothing
can be given back, so long runs neither recurse nor backtrack. Offsets are code
points, end exclusive, from the lengths of the pieces between matches; work
follows a text's length and, as a root more, its number of spans.

Defined results: null and empty texts have no spans; without candidates nothing
is learned and nothing added; ties of a posterior at one half add nothing;
repeated rows are all judged; very long texts and very many spans are taken whole;
an empty table gives an empty result; input columns named like a result are
replaced.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame

from brindle.llm.common import let, running, shaped


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    #: A character or expression whose absence rules the pattern out.
    needs: str
    #: SQL over ``x``, the matched text: whether it is a base span.
    base: str = "false"


_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

#: Base kinds first, in the order that spans are listed.
KINDS = (
    Kind(
        "email",
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "contains({t}, '@')",
        "true",
    ),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "{t} rlike '[0-9]'", rf"x rlike r'^(?:{_OCTET}\.){{3}}{_OCTET}$'"),
    Kind(
        "card",
        r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])",
        "{t} rlike '[0-9]'",
        "luhn_check(translate(x, ' -', ''))",
    ),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "contains({t}, '+')", "length(translate(x, '+ ().-', '')) between 9 and 15"),
    Kind("secret", r"(?<![A-Za-z0-9])[A-Fa-f0-9]{32,128}+(?![A-Za-z0-9])", "{t} rlike '[0-9]'"),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "contains({t}, '-')"),
    Kind("tel", r"(?<![0-9(+])(?<!\+[0-9]{1,3}[\x20.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[.-][0-9]{4}(?![0-9-])", "{t} rlike '[0-9]'"),
)
BASE = KINDS[:4]

#: Gazetteers and cue words. Fixed values.
DOMAINS = "com org net edu gov info io de fr es uk eu it nl ch at be us ca"
ISSUERS = "34 37 4 51 52 53 54 55 6011 65"
COUNTRIES = "1 31 32 33 34 39 41 43 44 49 61 81 86 91"
CUES = "account api auth bearer call card contact credit e-mail email fax host ip key login mail mastercard mobile password passwd phone secret server ssn social tel telephone token visa"
COUNTER_CUES = "article chapter figure isbn issue no page section table version vol"


def _any(words: str) -> str:
    return "|".join(w.replace("-", r"\-") for w in words.split())


#: Votes of the labelers, SQL over the candidate ``c``.
LABELERS = {
    "pattern": r"""case c.kind when 1 then if(c.ok, 1, -1) when 2 then if(length(translate(c.value, ' -', '')) in (15, 16), 1, -1)
        when 3 then if(c.ok, 1, -1) when 4 then if(length(c.value) in (32, 40, 56, 64, 96, 128), 1, -1)
        when 5 then if(c.value rlike r'^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)', 1, -1)
        when 6 then if(c.value rlike r'^\(?[2-9]', 1, -1) else 1 end""",
    "check": r"""case c.kind when 2 then if(luhn_check(translate(c.value, ' -', '')), 1, -1)
        when 4 then if(c.value rlike '[A-Fa-f]' and c.value rlike '[0-9]', 1, -1) else 0 end""",
    "gazetteer": rf"""case c.kind when 0 then if(lower(c.value) rlike r'\.(?:{_any(DOMAINS)})$', 1, -1)
        when 1 then if(c.value rlike r'^(?:0|127|255)\.', -1, 0)
        when 2 then if(c.value rlike r'^(?:{_any(ISSUERS)})', 1, -1)
        when 3 then if(c.value rlike r'^\+(?:{_any(COUNTRIES)})', 1, -1) else 0 end""",
    "cue": rf"""case when lower(c.before) rlike r'(?:^|[^a-z])(?:{_any(CUES)})[^a-z]*$' then 1
        when lower(c.before) rlike r'(?:^|[^a-z])(?:{_any(COUNTER_CUES)})[^a-z]*$' then -1 else 0 end""",
    "edges": r"""if((c.before = '' or c.before rlike r'[\s"\x27(\[<:=,;|]$') and (c.after = '' or c.after rlike r'^[\s"\x27)\]>.,;:!?|]'), 1, -1)""",
}

#: Features of the span classifier, SQL over ``c``; each has few values.
FEATURES = {
    "kind": "c.kind",
    "check": LABELERS["check"],
    "listed": LABELERS["gazetteer"],
    "size": "least(int(length(c.value) / 4), 16)",
    "digits": "int(4 * length(regexp_replace(c.value, '[^0-9]', '')) / length(c.value))",
    "parts": "least(length(regexp_replace(c.value, '[A-Za-z0-9]', '')), 4)",
    "left": r"case when c.before = '' then 0 when c.before rlike r'\s$' then 1 when c.before rlike r'[A-Za-z0-9]$' then 2 else 3 end",
    "right": r"case when c.after = '' then 0 when c.after rlike r'^\s' then 1 when c.after rlike r'^[A-Za-z0-9]' then 2 else 3 end",
}

RESULTS = [*(f"n_{k.name}" for k in BASE), "base", "found"]


_SPAN = "array<struct<kind:int,start:int,end:int,ok:boolean,value:string,before:string,after:string>>"


def _spans(k: int, kind: Kind, t: str) -> str:
    """SQL for the candidates of one kind: matches, the pieces between them, and ends as a running sum of lengths."""
    ends = running("transform(m, (x, i) -> length(p[i]) + length(x))", "a + x")
    each = f"""transform(m, (x, i) -> named_struct('kind', {k}, 'start', b[i] - length(x), 'end', b[i], 'ok', {kind.base},
        'value', x, 'before', right(p[i], 24), 'after', left(p[i + 1], 1)))"""
    found = let("p", f"split({t}, r'{kind.pattern}', -1)", let("b", ends, each))
    some = let("m", f"regexp_extract_all({t}, r'{kind.pattern}', 0)", f"if(size(m) = 0, cast(array() as {_SPAN}), {found})")
    return f"if({kind.needs.format(t=t)}, {some}, cast(array() as {_SPAN}))"


def candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus ``_c``, an array of (kind, start, end, ok, value, before, after)."""
    t = f"coalesce(`{text}`, '')"
    return docs.withColumn("_c", F.concat(*[F.expr(_spans(k, kind, t)) for k, kind in enumerate(KINDS)]))


@dataclass
class Classifier:
    """Logistic weights by feature value, and what they were learned from."""

    bias: float = -1.0
    weights: dict[str, dict[int, float]] = field(default_factory=dict)
    reliability: dict[tuple[int, str], float] = field(default_factory=dict)

    def accepts(self) -> Column:
        """SQL condition over the candidate ``c``: the probability is over one half."""
        terms = [
            f"case {FEATURES[name]} " + " ".join(f"when {v} then {w!r}D" for v, w in sorted(values.items())) + " else 0D end"
            for name, values in self.weights.items()
        ]
        return " + ".join([f"{self.bias!r}D", *terms]) + " > 0"


def pattern_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """How many candidates have each pattern of votes and features; bounded by the values they can take."""
    c = candidates(docs, text).select(F.explode_outer("_c").alias("c")).where("c IS NOT NULL")
    votes = {f"v_{k}": F.expr(v).cast("int") for k, v in LABELERS.items()}
    features = {f"f_{k}": F.expr(v).cast("int") for k, v in FEATURES.items()}
    names = {**votes, **features, "ok": F.col("c.ok")}
    return c.select(*[v.alias(k) for k, v in names.items()]).groupBy(*names).agg(F.count(F.lit(1)).alias("n"))


def fit(docs: DataFrame, text: str = "text") -> Classifier:
    """Reliabilities by expectation-maximisation, then the classifier, from all candidates of ``docs``."""
    got = pattern_counts(docs, text).toPandas()
    if not len(got):
        return Classifier()
    got = got.sort_values(list(got.columns)).reset_index(drop=True)
    n = got["n"].to_numpy(float)
    votes = got[[f"v_{k}" for k in LABELERS]].to_numpy(int)
    kinds = got["f_kind"].to_numpy(int)
    posterior, reliability = reliabilities(votes, kinds, n)
    x = {k: got[f"f_{k}"].to_numpy(int) for k in FEATURES}
    levels = {k: sorted(set(v.tolist())) for k, v in x.items()}
    columns = [(k, v) for k in FEATURES for v in levels[k]]
    design = np.column_stack([np.ones(len(n)), *[(x[k] == v).astype(float) for k, v in columns]])
    w = logistic(design, posterior, n)
    weights = {k: {v: float(round(w[1 + columns.index((k, v))], 6)) for v in levels[k]} for k in FEATURES}
    return Classifier(float(round(w[0], 6)), weights, reliability)


def reliabilities(votes: np.ndarray, kinds: np.ndarray, n: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, dict]:
    """Posterior that each vote pattern is personal data, and labelers' reliability by kind.

    Two classes; a labeler has, in each kind and class, a distribution over its
    three votes (smoothed by one vote each). The start is the share of votes for.
    """
    p = np.clip(0.5 + votes.sum(1) / (2.0 * votes.shape[1]), 0.05, 0.95)
    reliability = {}
    for _ in range(rounds):
        logit = np.zeros(len(p))
        for kind in np.unique(kinds):
            at = kinds == kind
            w1, w0 = (n * p)[at], (n * (1 - p))[at]
            odds = np.full(at.sum(), np.log((w1.sum() + 1) / (w0.sum() + 1)))
            for j, name in enumerate(LABELERS):
                v = votes[at, j]
                count = lambda w: np.array([w[v == value].sum() + 1 for value in (-1, 0, 1)])  # noqa: B023, E731
                a, b = count(w1), count(w0)
                odds += np.log((a / a.sum()) / (b / b.sum()))[v + 1]
                reliability[int(kind), name] = float((a[2] + b[0]) / (a[0] + a[2] + b[0] + b[2]))
            logit[at] = odds
        p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    return p, reliability


def logistic(x: np.ndarray, target: np.ndarray, n: np.ndarray, ridge: float = 1.0, rounds: int = 40) -> np.ndarray:
    """Ridge logistic regression on soft targets with weights ``n``, by Newton steps."""
    w = np.zeros(x.shape[1])
    n = n / n.sum() * min(n.sum(), 1e6)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (n * (target - p)) - ridge * w
        hess = (x * (n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def find(docs: DataFrame, model: Classifier | None = None, text: str = "text") -> DataFrame:
    """``docs`` plus counts of base spans, ``base`` and ``found`` (arrays of start, kind, end).

    ``found`` holds the base spans and those that the classifier adds.
    """
    docs = shaped(docs, [text], RESULTS)
    model = model or fit(docs, text)
    names = docs.columns
    out = candidates(docs, text)
    order = "transform(array_sort(transform({}, c -> named_struct('start', c.start, 'kind', c.kind, 'end', c.end))), c -> c)"
    out = out.withColumns({"base": F.expr(order.format("filter(_c, c -> c.ok)")), "found": F.expr(order.format(f"filter(_c, c -> c.ok or {model.accepts()})"))})
    counts = {f"n_{kind.name}": F.expr(f"cast(size(filter(base, c -> c.kind = {k})) as bigint)") for k, kind in enumerate(BASE)}
    return out.withColumns(counts).select(*names, *RESULTS)


def listed(spans: str) -> Column:
    """``kind:start:end`` of an array of spans, joined by commas."""
    names = "array(" + ", ".join(f"'{k.name}'" for k in KINDS) + ")"
    return F.expr(f"array_join(transform({spans}, c -> concat(element_at({names}, c.kind + 1), ':', c.start, ':', c.end)), ',')")


def redacted(text: str = "text", spans: str = "found") -> Column:
    """``text`` with each span, or run of overlapping spans, replaced by its kind in brackets; null stays null.

    Pieces are cut from four bytes a code point, whose places are known without counting from the start.
    """
    names = "array(" + ", ".join(f"'[{k.name.upper()}]'" for k in KINDS) + ")"
    mark = "X'0000FEFF'"  # the decoder takes one byte order mark away, so that none of the text's goes
    piece = f"decode(concat({mark}, substring(u, 4 * {{a}} + 1, 4 * ({{z}} - {{a}}))), 'UTF-32')"
    cut = f"if(c.start >= a, concat({piece.format(a='a', z='c.start')}, element_at({names}, c.kind + 1)), '')"
    pieces = f"transform(f, (c, i) -> {let('a', 'if(i = 0, 0, g[i - 1])', cut)})"
    rest = let("a", "g[size(g) - 1]", piece.format(a="a", z="int(length(u) / 4)"))
    joined = let("u", f"encode({text}, 'UTF-32')", f"array_join(concat({pieces}, array({rest})), '')")
    ends = running("transform(f, c -> c.end)", "greatest(a, x)")
    return F.expr(f"case when size({spans}) = 0 then {text} else {let('f', spans, let('g', ends, joined))} end")
