"""Near duplicates and line dedup."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerflow.llm import line_dedup, near_duplicates
from ledgerflow.llm.common import table

from . import brute


def result(docs, **kw):
    out = near_duplicates.near_duplicates(docs, near_duplicates.MinHashParams(**kw)).collect()
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in out), key=repr)


def wanted(rows, size=2):
    return sorted(((r[0], n, c if n else r[0], r[0] is not None and r[0] == (c if n else r[0]))
                   for r, (n, c, _) in zip(rows, brute.components([r[:2] for r in rows], size))), key=repr)


def varied(seed, n):
    """Chains and groups: texts that differ from one another by a few words, so that
    links reach across texts that are no link themselves."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdef") for _ in range(4))
    texts = [[word() for _ in range(r.choice([1, 2, 3, 12, 30, 60]))] for _ in range(n // 6)]
    while len(texts) < n:
        t = list(r.choice(texts))
        for _ in range(r.randint(0, max(1, len(t) // 12))):
            t[r.randrange(len(t))] = word()
        texts.append(t)
    r.shuffle(texts)
    return [(i * 3 + 1, " ".join(t) if r.random() < .7 else "\n".join(t).upper()) for i, t in enumerate(texts)]


@pytest.mark.parametrize("kw", [{}, {"block": 4}])
def test_components_by_brute_force(make_docs, edge_rows, kw):
    rows = varied(1, 240) + [(i if i is None else i + 10_000, t) for i, t in edge_rows]
    assert result(make_docs(rows), **kw) == wanted(rows)


def test_five_word_shingles_of_documents(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert result(docs, shingle=5) == wanted(rows, 5)


@pytest.mark.parametrize("n", range(7))
def test_five_word_shingles_of_one_short_document(n):
    text = " ".join("abcdef"[:n])
    data = np.frombuffer(text.encode(), np.uint8)
    h, runs = near_duplicates.shingle_sets(data, np.array([0, len(data)]), 5)
    assert len(h) == len(brute.shingles(text, 5)) and runs.tolist() == [0, len(h)]


def test_keep_one(make_docs, edge_rows):
    rows = varied(2, 90) + edge_rows
    docs = make_docs(rows)
    kept = near_duplicates.keep_one(docs)
    assert kept.columns == docs.columns
    groups = {}
    for (i, t), (n, _, root) in zip(rows, brute.components(rows)):
        groups.setdefault(root if n else object(), []).append((i, t))
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(got) == len(groups)
    for members in groups.values():
        least = min((i for i, _ in members if i is not None), default=None)
        assert sum(got.count(m) for m in set(m for m in members if m[0] == least)) >= 1
    assert near_duplicates.keep_one(docs.limit(0)).count() == 0


def test_components_of_a_long_chain(spark):
    n = 300
    edges = spark.range(n).select(*(F.encode(F.format_string("%05d", (F.col("id") + k) * 7919 % 100_003), "utf-8").alias(c) for k, c in ((0, "a"), (1, "b"))))
    roots = near_duplicates.components(edges).collect()
    assert len({r.root for r in roots}) == 1 and len(roots) == n
    assert roots[0].root == min(b"%05d" % (i * 7919 % 100_003) for i in range(n + 1))


def test_sequential_test_keeps_pairs_at_the_threshold():
    p = near_duplicates.MinHashParams()
    least = near_duplicates.least_matches(p)
    assert (np.diff(least) > 0).all()
    rng = np.random.default_rng(0)
    n = p.bands * p.rows
    for s, lowest, highest in ((0.8, .9999, 1), (0.3, 0, .0)):
        same = rng.random((20_000, n)) < s
        alive = near_duplicates.survives(same.astype(np.uint16), np.ones((20_000, n), np.uint16), p, least)
        assert lowest <= len(alive) / 20_000 <= highest
    # the bound is the exact posterior: one match fewer is below it
    for k, m in enumerate(least):
        h = (k + 1) * p.batch
        tail = lambda m: sum(math.comb(h + 1, i) * .8**i * .2**(h + 1 - i) for i in range(m + 1))
        assert tail(m) >= p.miss > (tail(m - 1) if m else 0)


def test_signature_estimates_similarity():
    p = near_duplicates.MinHashParams()
    rng = np.random.default_rng(4)
    pool = rng.integers(0, 2**63, 6000, dtype=np.uint64)
    a, b = (np.frombuffer(near_duplicates.signature(x, p), "<u2") for x in (pool[:4000], pool[1000:5000]))
    assert abs((a == b).mean() - 3000 / 5000) < 0.12


@pytest.mark.parametrize("limit", [64 << 20, 0])
@pytest.mark.parametrize("keys", [1 << 18, 3])
def test_line_dedup_by_brute_force(make_docs, edge_rows, limit, keys):
    r = random.Random(7)
    pool = ["A line of more than twenty characters %d" % i for i in range(30)] + ["short", "", "  \t", "é" * 20, "é" * 19, "日本語のとても長い行です、二十文字以上あります"]
    rows = [(i // 2 if i % 10 == 0 else i, "\n".join(r.choice(["", " ", "\t"]) + (x.upper() if r.random() < .3 else x) + r.choice(["", " \r"]) for x in r.choices(pool, k=r.randint(0, 9)))) for i in range(80)]
    rows += edge_rows + [(None, "all of these have no id at all\nx")] * 3
    docs = make_docs(rows)
    params = line_dedup.LineParams(broadcast_bytes=limit, shard_keys=keys, added=("lines_", "dropped_"))
    out = line_dedup.dedup_lines(docs, params)
    assert out.columns == [*docs.columns, "lines_", "dropped_"]
    got = sorted(((x.doc_id, x.lines_, x.dropped_, x.text) for x in out.collect()), key=repr)
    want = [(i, n, k, t if rows[j][1] is not None else None) for j, (i, n, k, t) in enumerate(brute.line_dedup(rows))]
    assert got == sorted(want, key=repr)
    assert sum(x[2] for x in got) > 0
    assert line_dedup.dedup_lines(docs.limit(0), params).count() == 0


def test_perfect_hash():
    for n in (0, 1, 2, 1000, 50_000):
        h = np.random.default_rng(n).integers(0, 2**63, n, dtype=np.uint64)
        levels = line_dedup.build_mph(h)
        mph = line_dedup.Mph([np.packbits(x).tobytes() for x in levels], [len(x) for x in levels])
        assert sorted(mph.index(h).tolist()) == list(range(n))


@pytest.mark.parametrize("shards", [2, 8, 40])
def test_hot_line_is_dealt_at_any_number_of_shards(spark, make_docs, shards):
    """A line in a third of the documents, and more shards than tasks: no task is far above the median."""
    hot = "one line that a third of all documents hold"
    rows = [(i, f"{hot if i % 3 == 0 else f'a line of the document {i} alone'}\nsome other line of {i} and {i % 50}") for i in range(6000)]
    docs = make_docs(rows)
    p = line_dedup.LineParams()
    deals = line_dedup.shard_deals(line_dedup.line_counts(docs, p), shards, line_dedup.shuffle_tasks(docs))
    routed = line_dedup.route_lines(docs.withColumn("__rk", F.monotonically_increasing_id()), deals, p)
    sizes = [r["count"] for r in routed.groupBy(F.spark_partition_id().alias("at")).count().collect()]
    assert sum(sizes) == 12000
    assert max(sizes) < 2.5 * np.median(sizes)
