"""Operators 11 to 13 against brute force, and on nulls, empty texts, ties, repeats, empty tables and clashing names."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
from collections import Counter

import numpy as np
import pyspark.sql.functions as F
import pytest

from brindle.llm import code_compression, filter_audit, suffix_dedup

DOC = "doc_id bigint, text string"

# ---- 11: vector code compression ----


def brute_codes(rows, rounds=4):
    """(vec_id, code, error, label_error) as strings, and the digest of the codebooks, in Python's integers."""
    kept = [(i, v, l) for i, v, l in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    rank = lambda r: (r[0] is None, r[0] or 0)
    size = next((len(v) for _, v, _ in sorted(kept, key=lambda r: (*rank(r), len(r[1]))) if v and len(v) % 4 == 0), 0)
    whole = {k: [math.floor(1024 * int(x)) if abs(x) > 2**60 else math.floor(1024 * x) for x in v] for k, (_, v, _) in enumerate(kept) if len(v) == size and size}
    least = {}
    for k, v in whole.items():
        i = kept[k][0]
        least[i] = min(least.get(i, v), v)
    first = [least[i] for i in sorted(least, key=lambda i: rank((i,)))[:256]]
    w = size // 4
    books = [[v[p * w : (p + 1) * w] for v in first] for p in range(4)]

    def assign(v, p):
        part = v[p * w : (p + 1) * w]
        return min((sum((a - b) ** 2 for a, b in zip(part, c, strict=True)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds if whole else 0):
        new = [list(b) for b in books]
        for p in range(4):
            members = {}
            for v in whole.values():
                members.setdefault(assign(v, p)[1], []).append(v[p * w : (p + 1) * w])
            for e, m in members.items():
                new[p][e] = [sum(x) // len(m) for x in zip(*m, strict=True)]
        books = new
    out, sums = [], {}
    for k, (i, _, label) in enumerate(kept):
        code = error = None
        if k in whole:
            best = [assign(whole[k], p) for p in range(4)]
            code, error = "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best)
            error = error if error < 1 << 63 else None
            if error is not None:
                sums[label] = sums.get(label, 0) + error
        out.append((i, code, error, label))
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    fits = lambda s: s if s is None or s < 1 << 63 else None
    return sorted([str((i, c, e, fits(sums.get(l)))) for i, c, e, l in out]), digest


def codes(spark, rows, kind="float"):
    df = spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>, label int").withColumn("Code", F.lit("x"))
    got = code_compression.compressed(df).collect()
    digests = {r.codebooks_sha256 for r in got}
    assert len(digests) == 1
    return sorted(str((r.vec_id, r.code, r.error, r.label_error)) for r in got), digests.pop()


def test_codes_equal_lloyd(spark):
    r = random.Random(3)
    centers = [[r.gauss(0, 1) for _ in range(8)] for _ in range(40)]
    rows = [(i, [float(np.float32(x + r.gauss(0, 0.1))) for x in r.choice(centers)], r.choice([1, 2, None])) for i in range(700)]
    assert codes(spark, rows) == brute_codes(rows)


def test_codes_of_awkward_vectors(spark):
    rows = [
        (3, [0.5, -0.25, 0.0, 1.0], 1), (3, [0.25, -0.25, 0.0, 1.0], 1), (3, [0.5, -0.25, 0.0, 1.0], 1), (None, [0.0, 0.0, 0.0, -0.0005], None),
        (1, None, 1), (2, [0.1, None, 0.2, 0.3], 1), (4, [0.1, float("nan"), 0.2, 0.3], 1), (5, [0.1, float("inf"), 0.2, 0.3], 2),
        (0, [], 2), (6, [1.0, 2.0, 3.0], 2), (7, [1.0] * 8, 2), (8, [0.4, -0.3, 0.1, 0.9], None), (9, [2.5e5, -3.0, 0.0, 1.0], 4),
    ]
    assert codes(spark, rows) == brute_codes(rows)
    huge = [(i, [float(10**i), -1.0, 3.5, float(-(10**20))], 7) for i in range(25)]
    assert codes(spark, huge, "double") == brute_codes(huge)
    same = [(i, [0.1, 0.2, 0.3, 0.4], 1) for i in range(600)]
    assert codes(spark, same) == brute_codes(same)
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert code_compression.compressed(empty).count() == 0
    only_odd = spark.createDataFrame([(1, [1.0])], "vec_id bigint, embedding array<float>")
    assert [tuple(r)[:4] for r in code_compression.compressed(only_odd).collect()] == [(1, None, None, None)]


def test_heaps_pop_only_what_drift_has_violated():
    g = np.random.default_rng(5)
    centers = np.floor(g.normal(0, 1000, (64, 6)))
    parts = np.floor(centers[g.integers(0, 64, 5000)] + g.normal(0, 30, (5000, 6)))
    entries = centers + 5
    heaps = code_compression.Heaps(parts, entries)
    seen = []
    for k in range(6):
        new = np.floor(entries + g.normal(0, 8 / (k + 1), entries.shape))
        heaps.moved(parts, entries, new)
        entries = new
        assert (heaps.entry == code_compression.nearest(parts, entries)[0]).all()
        seen.append(heaps.rescanned)
    assert max(seen) < len(parts) / 10 and sum(len(k) for k, _ in heaps.heaps) == len(parts)
    for keys, _ in heaps.heaps:
        assert all(keys[(i - 1) // 2] <= keys[i] for i in range(1, len(keys)))
    far = entries[::-1].copy()
    heaps.moved(parts, entries, far)
    assert heaps.rescanned == len(parts) and (heaps.entry == code_compression.nearest(parts, far)[0]).all()


# ---- 12: suffix-array dedup ----


def brute_repeats(rows):
    """By row: bytes, removed bytes, spans and what stays."""
    seen, out = {}, []
    by_rank = {}
    for i, t in rows:
        by_rank.setdefault((i is None, i or 0), set()).add((t or "").encode())
    assert all(len(v) == 1 for v in by_rank.values()), "one text for each id"
    covered = {}
    for key in sorted(by_rank):
        (data,) = by_rank[key]
        gone = bytearray(len(data))
        for s in range(len(data) - 99):
            w = data[s : s + 100]
            if w in seen:
                gone[s : s + 100] = b"\1" * 100
            else:
                seen[w] = key
        covered[key] = gone
    for i, t in rows:
        data, gone = (t or "").encode(), covered[i is None, i or 0]
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append(str((i, len(data), len(data) - len(kept), spans, kept)))
    return sorted(out)


def suffix_rows(spark, rows, **how):
    df = spark.createDataFrame(rows, DOC).select("*", F.lit("x").alias("N_Bytes"), F.lit("y").alias("did"), F.lit(0).alias("TEXT")).repartition(3)
    got = suffix_dedup.deduplicated(df, **how).collect()
    for r in got:
        at = [x for s in r.removed for x in (s.start, s.end)]
        assert at == sorted(set(at)) and sum(s.end - s.start for s in r.removed) == r.n_removed
    return sorted(str((r.doc_id, r.n_bytes, r.n_removed, len(r.removed), bytes(r.kept))) for r in got)


def texts_with_copies(seed, n=60):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(1, 9)))
    vocabulary = [word() for _ in range(300)]
    prose = lambda k: " ".join(r.choice(vocabulary) for _ in range(k))
    passages = [prose(40) for _ in range(4)]
    rows = []
    for i in range(n):
        parts = [prose(r.randint(0, 40))]
        for _ in range(r.randint(0, 3)):
            p = r.choice(passages)
            a = r.randint(0, 40)
            parts += [p[a : a + r.randint(90, 140)] if r.random() < 0.5 else p, prose(r.randint(0, 8))]
        rows.append((i, " ".join(parts)))
    rows += [(n + k, rows[k][1]) for k in range(5)]
    near = rows[7][1].split(" ")
    for k in range(5):
        near[r.randrange(len(near))] = "changed"
        rows.append((n + 10 + k, " ".join(near)))
    return rows


@pytest.mark.parametrize("how", [{}, {"fold": 1}, {"limit": 3, "fold": 50}])
def test_suffix_dedup_equals_brute_force(spark, how):
    rows = texts_with_copies(1)
    assert suffix_rows(spark, rows, **how) == brute_repeats(rows)


def test_suffix_dedup_on_awkward_texts(spark):
    rows = [
        (None, "z" * 150), (1, None), (2, ""), (3, "a" * 99), (4, "a" * 100), (5, "a" * 101), (6, "ab" * 300), (6, "ab" * 300),
        (7, "é" * 60), (8, "xé" * 70 + "é" * 60), (9, "z" * 150), (10, "a" * 99 + "b"), (11, "\x00" * 120), (-5, "ab" * 80),
    ]
    assert suffix_rows(spark, rows) == brute_repeats(rows)
    assert suffix_rows(spark, rows, limit=1, fold=1) == brute_repeats(rows)
    assert suffix_dedup.deduplicated(spark.createDataFrame([], DOC)).count() == 0
    with pytest.raises(ValueError, match="integer"):
        suffix_dedup.deduplicated(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


def test_suffix_dedup_of_one_id_with_two_texts(spark):
    shared = " ".join(f"w{i}" for i in range(60))
    got = suffix_dedup.deduplicated(spark.createDataFrame([(1, shared + "x"), (1, shared + "y"), (1, shared + "y")], DOC)).collect()
    assert sorted(r.n_removed for r in got) in ([0, 0, len(shared)], [0, len(shared), len(shared)])


def test_suffix_dedup_of_texts_longer_than_a_slab(spark):
    r = random.Random(9)
    long = "".join(r.choice("abcdefgh ") for _ in range(2 * suffix_dedup.SLAB + 5000))
    cut = long[suffix_dedup.SLAB - 700 : suffix_dedup.SLAB + 900]
    got = {r.doc_id: r for r in suffix_dedup.deduplicated(spark.createDataFrame([(1, cut), (2, long), (3, "." + cut + ".")], DOC)).collect()}
    at = suffix_dedup.SLAB - 700
    assert got[1].n_removed == 0 and [tuple(s) for s in got[2].removed] == [(at, at + len(cut))] and [tuple(s) for s in got[3].removed] == [(1, 1 + len(cut))]


def test_suffixes_sort_by_hashes_and_survive_collisions(monkeypatch):
    r = random.Random(2)
    words = [bytes(r.choice(b"ab") for _ in range(r.randint(0, 30))) for _ in range(400)]
    data = np.frombuffer(b"".join(words), np.uint8)
    size = np.array([len(w) for w in words])
    group = np.sort(np.array([r.randint(0, 5) for _ in words]))
    make = lambda: suffix_dedup.Suffixes(data, np.cumsum(size) - size, size, group)
    order, extension = make().sorted()
    want = sorted(range(len(words)), key=lambda i: (group[i], words[i]))
    assert [(group[i], words[i]) for i in order] == [(group[i], words[i]) for i in want]
    calls = []
    plain = suffix_dedup.Suffixes.sorted_by_bytes
    monkeypatch.setattr(suffix_dedup.Suffixes, "sorted_by_bytes", lambda self: calls.append(1) or plain(self))
    assert (make().sorted()[1] == extension).all() and not calls
    monkeypatch.setattr(suffix_dedup.Hashes, "of", lambda self, start, length: self.prefix[start + length] * np.uint64(0))
    again, same = make().sorted()
    assert calls and [(group[i], words[i]) for i in again] == [(group[i], words[i]) for i in want] and (same == extension).all()


# ---- 13: filter interaction audit ----


def brute_audit(rows, labels):
    import re

    labelled = lambda i, k: any(l[k] == 1 for l in labels if l[0] == i and i is not None)
    rank = lambda i: (i is None, i or 0)
    least, failed = {}, []
    for i, t, _ in rows:
        least[t or ""] = min(least.get(t or "", rank(i)), rank(i))
    for i, t, s in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = {"A"} if len(w) < 50 else set()
        f |= {"B"} if 100 * len(set(w)) < 65 * len(w) else set()
        f |= {"C"} if 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t) else set()
        f |= {"D"} if any(c in "#$%&*|" for c in t) else set()
        f |= {"E"} if rank(i) > least[t] else set()
        failed.append((s or "", f, labelled(i, 1), labelled(i, 2)))
    out = []
    for part in {x[0] for x in failed}:
        mine, own, shapley = [x[1:] for x in failed if x[0] == part], [], Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            left = list(mine)
            for k, f in enumerate(order):
                gone = [x for x in left if f in x[0]]
                left = [x for x in left if f not in x[0]]
                shapley[f] += len(gone)
                fails = sum(f in x[0] for x in mine)
                own.append((part, order, k + 1, len(left), len(gone), fails - len(gone), sum(x[0] == {f} for x in mine), sum(x[1] for x in gone), sum(x[2] for x in gone), f))
        out += [(*x[:-1], shapley[x[-1]]) for x in own]
    return sorted(out)


def audited(spark, rows, labels):
    docs = spark.createDataFrame(rows, DOC + ", source string").select("*", F.lit(1).alias("Part"), F.lit(2).alias("SOURCE")).repartition(3)
    return sorted(tuple(r) for r in filter_audit.audit(docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")).collect())


def test_audit_equals_brute_force(spark):
    r = random.Random(4)
    pick = lambda: " ".join(r.choice(["a", "b", "Cc", "DD", "e#", "f", "é"] + [f"w{i}" for i in range(200)]) for _ in range(r.choice([3, 49, 50, 60])))
    texts = [pick() for _ in range(60)] + ["", None, "X" * 3, "a b " * 40]
    rows = [(r.choice([i, i, None]), r.choice(texts), r.choice(["s", "t", None, ""])) for i in range(400)]
    rows += rows[:20]
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1])) for i in range(0, 300, 2)] + [(2, 1, 1), (None, 1, 1)]
    assert audited(spark, rows, labels) == brute_audit(rows, labels)


def test_audit_of_empty_tables(spark):
    assert audited(spark, [], []) == []
    assert audited(spark, [(1, "a", None)], []) == brute_audit([(1, "a", None)], [])


def test_audit_folds_within_bounds_and_tells_collisions_apart(monkeypatch):
    rows = [(i, f"text {i % 7} " + "x" * 50, "p") for i in range(100)]
    whole = lambda out: Counter(x for x in out)
    want = whole(filter_audit.chain(filter_audit.fold(rows)))
    passed = list(filter_audit.fold(rows, 120))
    assert whole(filter_audit.chain(passed)) == want and len(passed) >= 100
    monkeypatch.setattr(filter_audit.xxhash, "xxh64_intdigest", lambda data: 5)
    assert whole(filter_audit.chain(filter_audit.fold(rows))) == want
    assert sum(n for *_, mask, n in want if mask & 16) == 93
