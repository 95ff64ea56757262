"""The operators that use DataFrame functions alone: shards, quality rules, decontamination."""

import collections
import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerflow.llm import decontamination, kd_shards, quality_rules
from ledgerflow.llm.common import table

from . import brute

SF = "/root/testdata/sf0.01"


def plan_of(df):
    return df._jdf.queryExecution().toString()


# ---------------------------------------------------------------- shards

def check_shards(rows, out, shards):
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in out) == collections.Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    slots = collections.defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
        assert r.law == "bytes" and r.grown_shard is None
    assert set(slots) <= set(range(shards))
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    by_text = collections.defaultdict(set)
    for r in out:
        by_text[r.text_crc32, r.size].add(r.shard)
    assert all(len(x) == 1 for x in by_text.values())


@pytest.mark.parametrize("shards", [8, 5, 1])
def test_shards_are_near_equal(spark, shards):
    docs = table(spark, SF, "documents")
    out = kd_shards.shard(docs, shards).collect()
    check_shards([(r.doc_id, r.text) for r in docs.collect()], out, shards)
    weight = collections.Counter()
    group = collections.Counter()
    for r in out:
        weight[r.shard] += r.size
        group[r.text_crc32] += r.size
    mean = sum(weight.values()) / shards
    # each level misses its point by half of the heaviest text at most
    assert all(abs(w - mean) <= max(group.values()) * math.ceil(math.log2(shards) or 1) / 2 + 1 for w in weight.values())


def test_shard_edges(make_docs, edge_rows):
    rows = edge_rows + [(i, "the same text") for i in range(30)]
    check_shards(rows, kd_shards.shard(make_docs(rows), 8).collect(), 8)
    rows = [(i, None) for i in range(5)] + [(i, "") for i in range(5)]
    out = kd_shards.shard(make_docs(rows), 4).collect()
    check_shards(rows, out, 4)
    assert len({r.shard for r in out}) == 1
    assert kd_shards.shard(make_docs(rows).limit(0), 8).count() == 0


def test_target_bytes_gives_the_number_of_shards(make_docs):
    rows = [(i, "x" * (i % 37) + "\n" * (i % 5)) for i in range(200)]
    out = kd_shards.shard(make_docs(rows), target_bytes=500).collect()
    check_shards(rows, out, 200)
    total = sum(r.size for r in out)
    assert max(r.shard for r in out) <= math.ceil(total / 500) - 1


def plain_places(rows, shards):
    """Weighted k-d cuts one node after another, over (size, tie, coordinates...) rows."""
    dims = range(2, 5)
    extent = [max(r[d] for r in rows) - min(r[d] for r in rows) or 1.0 for d in dims]
    out = [None] * len(rows)

    def cut(members, first, count):
        if count == 1 or not members:
            for k in members:
                out[k] = first
            return
        widths = [(max(rows[k][d] for k in members) - min(rows[k][d] for k in members)) / e for d, e in zip(dims, extent)]
        d = 2 + widths.index(max(widths))
        groups = collections.defaultdict(list)
        for k in members:
            groups[rows[k][d], rows[k][1]].append(k)
        half = count // 2
        wanted, below, left, right = sum(rows[k][0] for k in members) * half / count, 0, [], []
        for key in sorted(groups):
            upto = below + sum(rows[k][0] for k in groups[key])
            (left if upto < wanted or below < wanted and abs(upto - wanted) < abs(below - wanted) else right).extend(groups[key])
            below = upto
        cut(left, first, half)
        cut(right, first + half, count - half)

    cut(list(range(len(rows))), 0, shards)
    return out


@pytest.mark.parametrize("shards, least", [(8, 10**6), (8, 1), (64, 10**6), (64, 40), (7, 100), (1024, 300)])
def test_places_by_brute_force(spark, make_docs, shards, least):
    """Histogram cuts and running-sum cuts give the plain weighted medians, ties and copies included."""
    r = random.Random(shards)
    rows = [(x.doc_id, x.text) for x in table(spark, "/root/testdata/sf0.001", "documents").collect()]
    rows += [(1000 + i, "copied text\n" * 3) for i in range(150)] + [(2000 + i, None) for i in range(20)]
    rows += [(3000 + i, r.choice("abc") * r.randrange(1, 40)) for i in range(200)]
    meta = kd_shards.materialize(kd_shards.describe(make_docs(rows)), "test-meta")
    order = [(x.rk, x.size, x.tie, x.log_size, x.log_lines, x.chars_per_byte) for x in meta.collect()]
    want = dict(zip((o[0] for o in order), plain_places([o[1:] for o in order], shards)))
    assert {x.rk: x["first"] for x in kd_shards.place(meta, shards, bins=16, least_window_rows=least).collect()} == want


def test_many_shards_of_many_rows(spark):
    """1,024 shards of 100,000 texts: near equal, and a short plan."""
    docs = spark.range(100_000).select(F.col("id").alias("doc_id"), F.concat(F.sha2(F.col("id").cast("string"), 256), F.repeat(F.lit("x"), (F.col("id") % 61).cast("int"))).alias("text"))
    weight = collections.Counter()
    for r in kd_shards.shard(docs, 1024).groupBy("shard").agg(F.sum("size").alias("w"), F.count("*").alias("n"), F.max("slot").alias("last")).collect():
        weight[r["shard"]] = r.w
        assert r["last"] == r.n - 1
    mean = sum(weight.values()) / 1024
    assert len(weight) == 1024 and max(abs(w - mean) for w in weight.values()) < 10 * 130
    plan = kd_shards.place(kd_shards.describe(docs), 1024)._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 30_000  # it grew with the shards before, by a factor a level


# ---------------------------------------------------------------- quality rules

def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_counts_by_brute_force(spark, make_docs, edge_rows):
    r = random.Random(2)
    rows = edge_rows + [(100 + i, r.choice([" ", "\n", "\t "]).join(r.choice(["a", "b", "c|", "dd#", "É<>", "word"]) for _ in range(r.randint(0, 90)))) for i in range(150)]
    rows += [(x.doc_id + 1000, x.text) for x in table(spark, "/root/testdata/sf0.001", "documents").collect()]
    out = quality_rules.judge(make_docs(rows), labels_of(spark, []))
    assert "Python" not in plan_of(out) and "Arrow" not in plan_of(out)
    got = collections.Counter((x.doc_id, x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words, x.base_failed, x.kept) for x in out.collect())
    assert got == collections.Counter((i, *brute.quality(t), not brute.quality(t)[-1]) for i, t in rows)
    assert quality_rules.judge(make_docs(rows).limit(0), labels_of(spark, [])).count() == 0


def test_binomial_tail():
    for k, n, rate in ((0, 10, .1), (3, 10, .3), (7, 500, .02), (0, 2000, .004)):
        exact = sum(math.comb(n, i) * rate**i * (1 - rate)**(n - i) for i in range(k + 1))
        assert quality_rules.binomial_tail(k, n, rate) == pytest.approx(exact, rel=1e-9)


def clean_text(i):
    return " ".join(f"w{i}x{k}" for k in range(60))


def test_certified_cutoffs_reject_junk_and_keep_good(spark, make_docs):
    good = [(i, clean_text(i), "en") for i in range(3000)]
    junk = [(10_000 + i, " ".join(f"j{i}x{k}$$$" for k in range(60)), "en") for i in range(200)]
    other = [(20_000 + i, f"{clean_text(i)} ###", None) for i in range(40)]  # too few labels in this stratum
    docs = make_docs(good + junk + other)
    marks = labels_of(spark, [(i, 1, 0) for i, _, _ in good] + [(i, 0, 0) for i, _, _ in junk] + [(20_000, 0, 0), (5, 1, 0), (6, 0, 0), (7, None, 0), (None, 1, 0)])
    rows = {r.doc_id: r.kept for r in quality_rules.judge(docs, marks).collect()}
    assert all(rows[i] for i, _, _ in good) and not any(rows[i] for i, _, _ in junk) and all(rows[i] for i, _, _ in other)
    kept = quality_rules.keep_good(docs, marks)
    assert kept.columns == docs.columns and kept.count() == 3040
    assert "Python" not in plan_of(kept)


def test_strata_of_few_labels_get_cutoffs(spark, make_docs):
    """217 clean labels certify one of four strata; smaller strata share a pool; one without good labels gets none."""
    junk = lambda lang, at: [(at + i, " ".join(f"J{lang}{i}x{k}$$" for k in range(60)), lang) for i in range(20)]
    rows, quality = [], []
    for at, (lang, n) in enumerate({"aa": 217, "bb": 217, "cc": 217, "dd": 120, "ee": 120, "ff": 0}.items()):
        good = [(at * 1000 + i, clean_text(at * 1000 + i).upper() if lang == "bb" else clean_text(at * 1000 + i), lang) for i in range(n)]
        bad = junk(lang, at * 1000 + 500)
        rows += good + bad
        quality += [(i, 1, 0) for i, _, _ in good] + [(i, 0, 0) for i, _, _ in bad]
    got = {r.doc_id: r.kept for r in quality_rules.judge(make_docs(rows), labels_of(spark, quality)).collect()}
    kept = collections.Counter((lang, i % 1000 < 500) for i, _, lang in rows if got[i])
    assert kept == {("aa", True): 217, ("bb", True): 217, ("cc", True): 217, ("dd", True): 120, ("ee", True): 120, ("ff", False): 20}


def test_families_depend_on_label_counts_alone():
    p = quality_rules.QualityParams()
    families, level = quality_rules._families({x: (217, 40) for x in "abcd"} | {"e": (0, 0)}, p)
    assert [x["uses"] for x in families] == [["a"], ["b"], ["c"], ["d"]] and level == p.error / 4
    families, level = quality_rules._families({"a": (2000, 400), None: (5, 1), "b": (9, 2)}, p)
    assert [x["uses"] for x in families] == [["a"], ["b", None]] and families[1]["tested"] == {"a", "b", None} and level == p.error / 2
    assert quality_rules._families({"a": (60, 10), "b": (60, 10)}, p)[0] == []


def test_joint_false_rejection_is_bounded():
    """All features of a stratum together reject no more good texts than their share, at the error of one test."""
    p = quality_rules.QualityParams()
    rng = random.Random(5)
    failures = used = 0
    scale = [.25, .4, .3, .5, .2]
    draw = lambda x: [min(p.grid, int(rng.expovariate(r * x))) for r in scale]
    good_rate = lambda cuts: 1 - math.prod(1 - math.exp(-scale[f] * (c + 1)) for f, c in cuts.items())
    for _ in range(150):
        own, other, bad = [draw(1) for _ in range(600)], [draw(1) for _ in range(300)], [draw(.2) for _ in range(300)]
        grid = lambda x: [[sum(t[f] == i for t in x) for i in range(p.grid + 1)] for f in range(5)]
        path = quality_rules._path(grid(other), grid(bad), p)
        def step(t):
            return next((i for i, (f, c) in enumerate(path) if t[f] > c), len(path))
        seen = [[0] * (len(path) + 1) for _ in range(2)]
        for n, x in enumerate((own, bad)):
            for t in x:
                seen[n][len(path) - step(t)] += 1
        cutoff = quality_rules._certified(*seen, p.error, p.false_rejection, quality_rules.QualityParams(good_weight=0))
        if cutoff is not None:
            used += 1
            failures += good_rate(dict(path[:len(path) - cutoff])) > p.false_rejection
    assert used > 100 and failures <= 150 * p.error + 8


def test_false_rejection_is_bounded():
    """The chosen cutoff rejects no more good texts than its share, also where bad and good overlap."""
    p = quality_rules.QualityParams()
    rng = random.Random(3)
    failures = 0
    for _ in range(200):
        good, bad = [0] * (p.grid + 1), [0] * (p.grid + 1)
        for _ in range(2000):
            good[min(p.grid, int(rng.expovariate(.12)))] += 1
            bad[min(p.grid, int(rng.expovariate(.02)))] += 1
        cutoff = quality_rules._certified(good, bad, .05, .01, quality_rules.QualityParams(good_weight=0))
        if cutoff is not None:
            failures += math.exp(-.12 * (cutoff + 1)) > .01
    assert failures <= 200 * .05 + 8


# ---------------------------------------------------------------- decontamination

def contaminated(docs, bench, **kw):
    out = decontamination.contamination(docs, bench, decontamination.WindowParams(**kw))
    assert "Python" not in plan_of(out) and "Cartesian" not in plan_of(out) and "NestedLoop" not in plan_of(out)
    out = out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("s"), "contaminated")
    return sorted((tuple(r) for r in out.collect()), key=repr)


@pytest.mark.parametrize("kw", [{}, {"block_bytes": 300}])
def test_windows_by_brute_force(spark, make_docs, edge_rows, kw):
    r = random.Random(11)
    word = lambda: r.choice(["the", "of", "Überall", "x1", "naïve", "and"])
    items = [(i, r.choice([" ", ", ", "--"]).join(word() for _ in range(r.choice([1, 2, 5, 13, 14, 20])))) for i in range(12)]
    items += [(3, "repeated id here"), (None, "a null id of some words"), (50, None), (51, ""), (52, "... --"), (2, items[2][1])]
    docs = list(edge_rows) + [(100, "a null id of some words")]
    for i in range(60):
        t = [word() for _ in range(r.randint(0, 60))]
        if i % 3 == 0:
            at = r.randrange(len(t) + 1)
            t[at:at] = brute.bench_words(r.choice(items)[1])
        docs.append((200 + i, r.choice([" ", "! "]).join(t).title()))
    bench = spark.createDataFrame([(*x, "x", "y") for x in items], "item_id long, text string, window string, rk string")
    assert contaminated(make_docs(docs), bench, **kw) == sorted(brute.contamination(docs, items), key=repr)


def test_decontamination_of_empty_tables(spark, make_docs):
    bench = spark.createDataFrame([(1, "some words")], "item_id long, text string")
    docs = make_docs([(1, "here are some words"), (2, None)])
    assert [x[2] for x in contaminated(docs, bench.limit(0))] == [0, 0]
    assert contaminated(docs.limit(0), bench) == []
    kept = decontamination.clean(docs, bench)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [2]


def test_plan_compares_spans_within_one_stage(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents").withColumn("rk", F.monotonically_increasing_id())
    windows = decontamination.prefix_windows(docs, table(spark, "/root/testdata/sf0.001", "benchmark"), decontamination.WindowParams())
    found = decontamination.occurrences(docs, windows, decontamination.WindowParams())
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "CartesianProduct" not in plan
