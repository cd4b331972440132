"""The pipeline against a brute-force version, and on awkward rows."""

from __future__ import annotations

import hashlib

import public_tokenizers
import pyspark.sql.functions as F
import tiktoken

import corpus_pipeline
from brindle.llm import pii, pretokens, quality_rules

from llm_brute import brute_hits, brute_links, brute_statistics


def brute(spark, folder):
    """Rows of the pipeline, stage by stage in Python; models come from the operators' own fit on each stage's input."""
    read = lambda name: spark.read.parquet(f"{folder}/{name}.parquet")
    docs = {r.doc_id: r.text for r in read("documents").collect()}
    rules = quality_rules.fit(read("documents"), read("labels"))

    def kept(text):
        words, _, _, _, repeated = brute_statistics(text)
        if words < 20 or 100 * repeated > 30 * words:
            return False
        s = dict(zip(quality_rules.STATISTICS, quality_rules.statistics(text), strict=True))
        per = lambda a, b: a / b if b else 0.0
        v = {
            "words": float(words), "word_length": per(s["word_chars"], words), "symbol_share": per(s["n_symbols"], s["word_chars"]),
            "dup_line_share": per(s["n_dup_lines"], s["n_lines"]), "repeat_share": per(repeated, words), "distinct_share": per(s["n_distinct_words"], words),
            "upper_share": per(s["n_upper"], s["n_upper"] + s["n_lower"]), "marks_per_word": per(s["n_marks"], words),
        }
        return not any(all(v[n] <= t if op == "<=" else v[n] > t for n, op, t in r.conditions) for r in rules)

    docs = {i: t for i, t in docs.items() if kept(t)}
    docs = {i: docs[i] for i, c, _ in brute_links(list(docs.items())) if i == c}
    items = [(r.item_id, r.text) for r in read("benchmark").collect()]
    docs = {i: docs[i] for i, _, hit, _ in brute_hits(list(docs.items()), items) if not hit}
    frame = spark.createDataFrame(list(docs.items()), "doc_id bigint, text string")
    spans = {r.doc_id: [(s.start, s.end, pii.KINDS[s.kind].name) for s in r.found] for r in pii.find(frame).collect()}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=pretokens.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    out = set()
    for i, t in docs.items():
        parts, at = [], 0
        for s, e, kind in spans[i]:
            if s >= at:
                parts += [t[at:s], f"[{kind.upper()}]"]
            at = max(at, e)
        t = "".join(parts) + t[at:]
        ids = library.encode_ordinary(t)
        out.add((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    return out


def test_pipeline_equals_brute_force(spark, data):
    got = corpus_pipeline.run(spark, data)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert {tuple(r) for r in got.collect()} == brute(spark, data)


def test_stages_on_awkward_rows(spark, data, tmp_path):
    docs = spark.read.parquet(f"{data}/documents.parquet").limit(20).withColumn("Kept", F.lit("x"))
    odd = spark.createDataFrame([(None, None, None, None, None, "x"), (1, None, "en", "s", 0, "x"), (2, "", "en", "s", 0, "x")], docs.schema)
    for rows in (docs.union(docs).union(odd), docs.limit(0)):
        out = rows
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, out, data)
            if k + 1 < len(corpus_pipeline.STAGES):
                assert out.columns == docs.columns
            path = str(tmp_path / f"{name}{rows is docs}{id(rows)}")
            out.write.parquet(path)
            out = spark.read.parquet(path)
        if out.columns == docs.columns:
            assert {r.Kept for r in out.collect()} <= {"x"}
        ids = [r.doc_id for r in out.collect()]
        assert len(ids) == len(set(ids))
