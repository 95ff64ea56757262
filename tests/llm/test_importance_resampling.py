"""Importance resampling against a plain version, and the CRC composition."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerflow.llm import importance_resampling as ir
from ledgerflow.llm.common import table, text_slices

from .brute import bench_words


def buckets(text):
    w = bench_words(text)
    return [zlib.crc32(" ".join(w[i:i + k]).encode()) % 10_000 for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def brute(docs, target, percent=5, least=20):
    """Rows of the contract; positions break what ids leave tied."""
    s = collections.Counter(b for _, t in docs for b in buckets(t))
    t = collections.Counter(b for _, x in target for b in buckets(x))
    ns, nt = s.total(), t.total()
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * (ns + 10_000.0) / ((s[b] + 1.0) * (nt + 10_000.0))))
    rows = []
    for at, (i, text) in enumerate(docs):
        f = buckets(text)
        weight = sum(map(gain, f))
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(bench_words(text)), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = [r for r in rows if r[1] >= least]
    order = sorted(range(len(rows)), key=lambda k: (rows[k][1] < least, -rows[k][4], rows[k][0] is not None, rows[k][0] or 0, k))
    rank = {k: n for n, k in enumerate(order[:percent * len(able) // 100], 1)}
    return collections.Counter((*r, rank.get(k)) for k, r in enumerate(rows))


def got(df):
    return collections.Counter(tuple(r) for r in df.collect())


def test_appended_crc():
    r = random.Random(1)
    some = [r.randbytes(r.choice([0, 1, 5, 63, 64, 65, 66, 500, 70_000])) for _ in range(60)]
    a, b = zip(*((r.choice(some), r.choice(some)) for _ in range(1000)))
    out = ir.append_crc(np.array([zlib.crc32(x) for x in a], np.uint32), np.array([zlib.crc32(x) for x in b], np.uint32), np.array([len(x) for x in b]))
    assert out.tolist() == [zlib.crc32(x + y) for x, y in zip(a, b)]


@pytest.mark.parametrize("piece", [7, 50, 2 << 20])
def test_scans_in_pieces(monkeypatch, piece):
    """Any cut of a text into pieces gives the same buckets, words and documents."""
    monkeypatch.setattr(ir, "PIECE_BYTES", piece)
    r = random.Random(piece)
    parts = ["a", "b ", "C", "é", "\n", ".", "\0", "\x01", "日本", " ", "x" * 70, "  ", "\x85", "\xa0", "ab ", "cd "]
    for trial in range(150):
        texts = ["".join(r.choice(parts) for _ in range(r.choice([0, 1, 3, 30, 300]))) for _ in range(r.choice([1, 1, 4]))] + [None] * (trial % 3 == 0)
        found, words = [[] for _ in texts], [0] * len(texts)
        batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
        for first, n, data, offsets in text_slices(batch, 0, 1 if trial % 2 else 10_000):
            for docs, of, counts in ir.bucket_runs(data, offsets, ir.ResampleParams()):
                for d, b in zip(docs.tolist(), of.tolist()):
                    found[first + d].append(b)
                for d, c in enumerate(counts.tolist()):
                    words[first + d] += c
        assert list(map(sorted, found)) == [sorted(buckets(t)) for t in texts]
        assert words == [len(bench_words(t)) for t in texts]


def test_draw_by_brute_force(spark):
    docs, target = table(spark, "/root/testdata/sf0.001", "documents"), table(spark, "/root/testdata/sf0.001", "benchmark")
    out = ir.resample(docs, target).select("doc_id", "n_words", "n_features", "weight", "score", "rank")
    assert got(out) == brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in target.collect()])


def test_edges(spark, make_docs, edge_rows):
    r = random.Random(3)
    text = lambda: " ".join(r.choice(["apple", "Pear", "naïve", "x" * 200, "kiwi", "日本"]) for _ in range(r.choice([5, 19, 20, 40])))
    rows = edge_rows + [(100 + i, text()) for i in range(300)] + [(7, "one two " * 15)] * 40 + [(None, "three four " * 15)] * 10
    rows += [(500 + i, "a b c d e " * 4) for i in range(30)]
    target = spark.createDataFrame([(1, "apple kiwi apple kiwi"), (2, None), (3, ""), (4, "three four")], "item_id long, text string")
    docs = make_docs(rows).coalesce(1)
    assert got(ir.resample(docs, target)) == brute(rows, [(1, "apple kiwi apple kiwi"), (4, "three four")])
    none = ir.resample(docs, target.limit(0))
    assert got(none) == brute(rows, [])
    assert ir.resample(docs.limit(0), target).count() == 0
    few = make_docs(rows[:12]).coalesce(1)  # nothing that can be drawn, or too few for one draw
    assert all(x.rank is None for x in ir.resample(few, target).collect())


def test_ranks_are_gapless_and_favour_the_target(spark):
    """Documents like the target are drawn far more often than others; ranks have no gaps."""
    r = random.Random(5)
    say = lambda words: " ".join(r.choice(words) for _ in range(60))
    near, far = [f"n{i}" for i in range(30)], [f"f{i}" for i in range(30)]
    rows = [(i, say(near if i % 10 == 0 else far)) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    target = spark.createDataFrame([(i, say(near)) for i in range(50)], "item_id long, text string")
    drawn = ir.resample(docs, target).filter(F.col("rank").isNotNull()).collect()
    assert sorted(x["rank"] for x in drawn) == list(range(1, 101))
    assert all(x["doc_id"] % 10 == 0 for x in drawn)
