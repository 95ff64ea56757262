"""Near-duplicate classes by MinHash bands and sequential Bayesian verification.

1. Every text becomes its set of distinct word shingles (64-bit hashes), a
   128-bit digest of the set and a MinHash signature. Texts with equal sets form
   one class; only one row of each class goes on.
2. Bands of the signature are bucket keys. Within a sorted bucket the first class
   is the hub; each other class is paired with it, so a bucket of any size gives
   a linear number of pairs, streamed.
3. Each pair compares its signatures batch by batch. After m matches of h values
   the similarity has a Beta posterior; once the chance that it reaches the
   threshold falls below ``miss``, the pair is dropped.
4. Survivors are verified on the full sets: first one hub for every class, then
   the pairs that still lie between different components.
5. Classes of a bucket that have not met (neither is the hub) and lie in
   different components after that are compared in blocks of bounded size within
   tasks: the same test, in the first band that both share, and then their full
   sets. A block reports only links that join components, a forest.
6. Components are found by repeated minimum over neighbours (large and small
   stars) on distributed edges.

A link whose similarity is s is missed by the bands with probability
``(1 - s^rows)^bands`` (1e-7 at s = 0.8 with 5 rows and 40 bands) and by each
Bayesian step with at most ``miss``; no link is reported that the full sets do
not confirm. No cap on bucket sizes or partners.

Defined cases: null texts and texts without a word have an empty set, are linked
with nothing and are their own component. A text of fewer than ``shingle`` words
is one shingle. Rows that repeat a ``doc_id`` are rows of their own in one
component if their sets agree; a null ``doc_id`` never names a component unless
all its members are null. ``kept`` is false for a null id. Extra columns are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import (
    LOWER, materialize, mix64, shuffle_tasks, signed, span_hashes, text_slices, word_spans,
)


@dataclass(frozen=True)
class MinHashParams:
    shingle: int = 2
    percent: int = 80       # 100 * intersection >= percent * union
    bands: int = 40
    rows: int = 5
    batch: int = 20         # signature values compared at a time
    miss: float = 1e-7      # posterior chance below which a pair is dropped
    block: int = 512        # classes compared with one another at once in step 5


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int):
    """Distinct shingle hashes of all rows, sorted within each: hashes and the offsets of the rows' runs."""
    n = len(offsets) - 1
    data = LOWER[data]
    starts, ends, row = word_spans(data, offsets)
    words = span_hashes(data, starts, ends)
    count = np.bincount(row, minlength=n)
    h = np.zeros(max(0, len(words) - size + 1), np.uint64)
    for k in range(size):
        h = mix64(h * np.uint64(0x9FB21C651E98DF25) + words[k:k + len(h)] + np.uint64(k))
    at = row[:len(h)]
    inside = at == row[size - 1:] if len(h) else np.zeros(0, bool)
    h, at = h[inside], at[inside]
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):  # the whole sequence is one shingle
        first = np.cumsum(count) - count
        whole = [int(mix64(np.array([np.uint64(0xA5A5), *words[first[r]:first[r] + count[r]]], np.uint64)).sum()) & (2**64 - 1) for r in short]
        h, at = np.concatenate([h, np.array(whole, np.uint64)]), np.concatenate([at, short])
    order = np.lexsort((h, at))
    h, at = h[order], at[order]
    new = np.append(True, (h[1:] != h[:-1]) | (at[1:] != at[:-1]))[:len(h)]
    h, at = h[new], at[new]
    return h, np.concatenate([[0], np.cumsum(np.bincount(at, minlength=n))])


def _digests(h: np.ndarray, runs: np.ndarray) -> list[bytes]:
    """128-bit digest of each set: two independent sums of mixed hashes."""
    out = []
    for salt in (0x51ED270B9F1C8A35, 0xC3A5C85C97CB3127):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mix64(h ^ np.uint64(salt)), dtype=np.uint64)])
        out.append(mix64(sums[runs[1:]] - sums[runs[:-1]] + np.diff(runs).astype(np.uint64)))
    return [a + b for a, b in zip((x.tobytes() for x in out[0].astype(">u8")), (x.tobytes() for x in out[1].astype(">u8")), strict=True)]


def signature(h: np.ndarray, p: MinHashParams) -> bytes:
    """``bands * rows`` minima of independent hashes, 16 bits of each."""
    n = p.bands * p.rows
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.full(n, 2**32 - 1, np.uint32)
    for at in range(0, len(h), 2048):
        part = h[at:at + 2048]
        out = np.minimum(out, ((part[None, :] * a[:, None]) >> np.uint64(32)).astype(np.uint32).min(1))
    return (mix64(out.astype(np.uint64)) >> np.uint64(48)).astype("<u2").tobytes()


def least_matches(p: MinHashParams) -> np.ndarray:
    """After each batch the least number of matches with which a pair goes on: the
    posterior P(similarity >= t | m of h) under a uniform prior is
    P(Binomial(h + 1, t) <= m), and must be ``miss`` at least."""
    t, out = p.percent / 100, []
    for h in range(p.batch, p.bands * p.rows + 1, p.batch):
        tail, m = 0.0, 0
        for m in range(h + 2):
            tail += math.exp(math.lgamma(h + 2) - math.lgamma(m + 1) - math.lgamma(h + 2 - m) + m * math.log(t) + (h + 1 - m) * math.log1p(-t))
            if tail >= p.miss:
                break
        out.append(m)
    return np.array(out)


def survives(a: np.ndarray, b: np.ndarray, p: MinHashParams, least: np.ndarray) -> np.ndarray:
    """Sequential test of signature pairs (rows of ``a`` and ``b``), pruned after each batch."""
    alive = np.arange(len(a))
    matches = np.zeros(len(a), np.int32)
    for k, need in enumerate(least):
        part = slice(k * p.batch, (k + 1) * p.batch)
        matches[alive] += (a[alive, part] == b[alive, part]).sum(1)
        alive = alive[matches[alive] >= need]
    return alive


def _scan(docs: DataFrame, p: MinHashParams, what: str) -> DataFrame:
    """Per row with its position ``rk``: set size, class and signature, or class and set."""
    wide = what == "signature"

    def run(batches):
        for batch in batches:
            for first, n, data, offsets in text_slices(batch, "text", 1 << 20):
                h, runs = shingle_sets(data, offsets, p.shingle)
                digests = _digests(h, runs)
                sizes = np.diff(runs)
                last = [signature(h[runs[i]:runs[i + 1]], p) if sizes[i] else b"" for i in range(n)] if wide else [h[runs[i]:runs[i + 1]].tobytes() for i in range(n)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(first, n) for c in ("rk", "doc_id")), pa.array(sizes), pa.array(digests, pa.binary()), pa.array(last, pa.binary())],
                                                 names=["rk", "doc_id", "n_shingles", "cls", what])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("rk", "doc_id", "text").mapInArrow(run, f"rk long, doc_id {kind}, n_shingles long, cls binary, {what} binary")


def _bucket_rows(classes: DataFrame, p: MinHashParams) -> DataFrame:
    def run(batches):
        for batch in batches:
            sig = np.frombuffer(b"".join(batch.column("signature").to_pylist()), "<u2").reshape(batch.num_rows, p.bands, p.rows).astype(np.uint64)
            key = np.zeros(sig.shape[:2], np.uint64) + np.arange(p.bands, dtype=np.uint64)
            for r in range(p.rows):
                key = mix64(key * np.uint64(0x9FB21C651E98DF25) + sig[:, :, r])
            yield pa.RecordBatch.from_arrays([pa.array(signed(key.ravel())), batch.column("cls").take(pa.array(np.repeat(np.arange(batch.num_rows), p.bands)))], names=["bucket", "cls"])

    return classes.select("cls", "signature").mapInArrow(run, "bucket long, cls binary")


def _hub_pairs(buckets: DataFrame) -> DataFrame:
    """``bucket, hub, cls`` for each class but the first of its sorted bucket; one bucket is a
    stream, of which only its first class is held."""
    def run(batches):
        bucket, hub = None, None
        for batch in batches:
            keys = batch.column("bucket").to_numpy(zero_copy_only=False)
            new = np.append(True, keys[1:] != keys[:-1])[:len(keys)]
            if len(keys) and keys[0] == bucket:
                new[0] = False
            head = np.maximum.accumulate(np.where(new, np.arange(len(keys)), -1))
            rest = np.flatnonzero(~new)
            cls = batch.column("cls")
            hubs = cls.take(pa.array(np.maximum(head[rest], 0)))
            carried = head[rest] < 0
            if carried.any():
                hubs = pa.array([hub if c else h for c, h in zip(carried, hubs.to_pylist())], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(keys[rest]), hubs, cls.take(pa.array(rest))], names=["bucket", "hub", "cls"])
            if len(keys):
                bucket = keys[-1]
                hub = cls[int(head[-1])].as_py() if head[-1] >= 0 else hub

    return buckets.mapInArrow(run, "bucket long, hub binary, cls binary")


def _pairs_that_survive(pairs: DataFrame, signatures: DataFrame, p: MinHashParams) -> DataFrame:
    """``a, b`` pairs whose signatures pass the sequential test."""
    least = least_matches(p)
    width = p.bands * p.rows

    def run(batches):
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, width) for c in ("sa", "sb"))
            keep = pa.array(survives(a, b, p, least))
            yield pa.RecordBatch.from_arrays([batch.column(c).take(keep) for c in ("a", "b")], names=["a", "b"])

    joined = (pairs.join(signatures.select(F.col("cls").alias("a"), F.col("signature").alias("sa")), "a")
              .join(signatures.select(F.col("cls").alias("b"), F.col("signature").alias("sb")), "b"))
    return joined.select("a", "b", "sa", "sb").mapInArrow(run, "a binary, b binary")


def _confirmed(pairs: DataFrame, sets: DataFrame, p: MinHashParams) -> DataFrame:
    """Pairs whose full sets reach the threshold."""
    def run(batches):
        for batch in batches:
            keep = [i for i, (x, y) in enumerate(zip(batch.column("xa"), batch.column("xb"), strict=True))
                    if similar(*(np.frombuffer(z.as_buffer(), np.uint64) for z in (x, y)), p)]
            yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(keep, pa.int64())) for c in ("a", "b")], names=["a", "b"])

    joined = (pairs.join(sets.select(F.col("cls").alias("a"), F.col("members").alias("xa")), "a")
              .join(sets.select(F.col("cls").alias("b"), F.col("members").alias("xb")), "b"))
    return joined.select("a", "b", "xa", "xb").mapInArrow(run, "a binary, b binary")


def components(edges: DataFrame, name: str = "near-components") -> DataFrame:
    """``cls, root``: the least class reachable, for every class on an edge ``a, b``.

    Each round points every class at the least neighbour of its neighbourhood
    (large star, then small star); edges stay linear in number and rounds
    logarithmic in the size of a component."""
    def least_of(both: DataFrame) -> DataFrame:
        return both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))

    edges = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), name)
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(least_of(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        # every lower neighbour, and the class itself, then points to the least of them
        lows = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(lows, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(lows.select("u", F.col("m").alias("v"))).where("u != v").distinct())
        edges = materialize(small, name)
        now = edges.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("cls"), F.col("v").alias("root"))


def similar(x: np.ndarray, y: np.ndarray, p: MinHashParams) -> bool:
    """Whether two sorted sets reach the threshold."""
    small, large = min(len(x), len(y)), max(len(x), len(y))
    if 100 * small < p.percent * large:  # sizes alone rule it out
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= p.percent * (small + large - both)


def _links_of_block(rows: list[dict], p: MinHashParams, least: np.ndarray) -> list[tuple[bytes, bytes]]:
    """Links that join components among the rows of a pair of blocks of one bucket."""
    n, width = len(rows), p.bands * p.rows
    sig = np.frombuffer(b"".join(r["signature"] for r in rows), "<u2").reshape(n, width)
    mine = np.array([r["mine"] for r in rows])
    root = np.unique([r["root"] for r in rows], return_inverse=True)[1]
    bands = sig.reshape(n, p.bands, p.rows)
    # the band of this bucket: one in which all its rows agree, the first of them if there are several
    here = int((bands == bands[0]).all(2).all(0).argmax())
    within = rows[0]["i"] == rows[0]["j"]
    sets = [np.frombuffer(r["members"], np.uint64) for r in rows]
    found = []
    for a in range(n - 1):
        b = np.arange(a + 1, n)
        b = b[(root[b] != root[a]) & (within | (mine[b] != mine[a]))]
        if not len(b):
            continue
        b = b[survives(np.broadcast_to(sig[a], (len(b), width)), sig[b], p, least)]
        # a pair that shares several bands is compared in the first
        b = b[(bands[b] == bands[a]).all(2).argmax(1) >= here] if len(b) else b
        for k in b:
            if root[k] != root[a] and similar(sets[a], sets[k], p):
                found.append((rows[a]["cls"], rows[k]["cls"]))
                root[root == root[k]] = root[a]
    return found


def _block_links(members: DataFrame, p: MinHashParams) -> DataFrame:
    """``a, b``: links between components among classes that share a bucket.
    ``members``: bucket, cls, root, signature, members, blocks. A bucket is cut into
    blocks; each pair of blocks is one run of sorted rows, compared within a task."""
    least = least_matches(p)
    names = ["mine", "i", "j", "cls", "root", "signature", "members"]
    spread = (members.withColumn("mine", F.pmod(F.xxhash64("cls"), F.col("blocks")))
              .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
              .withColumns({"i": F.least("mine", "other"), "j": F.greatest("mine", "other")}).select("bucket", *names))

    def run(batches):
        key, held = None, []

        def out(pairs):
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in pairs], pa.binary()) for k in (0, 1)], names=["a", "b"])

        for batch in batches:
            found = []
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("bucket", "i", "j")), strict=True))
            edges = [k for k in range(len(keys)) if k == 0 or keys[k] != keys[k - 1]]
            for at, end in zip(edges, [*edges[1:], len(keys)], strict=True):
                if keys[at] != key:
                    found += _links_of_block(held, p, least) if len(held) > 1 else []
                    key, held = keys[at], []
                held += batch.slice(at, end - at).select(names).to_pylist()
            yield out(found)
        yield out(_links_of_block(held, p, least) if len(held) > 1 else [])

    n = shuffle_tasks(members)
    return (spread.repartition(n, "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
            .mapInArrow(run, "a binary, b binary"))


def near_duplicates(docs: DataFrame, params: MinHashParams = MinHashParams()) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs(doc_id, text)``."""
    rows, classes, _ = find_components(docs, params)
    out = rows.join(classes, "cls", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"), "rk", "first_rk", "cls")


def keep_one(docs: DataFrame, params: MinHashParams = MinHashParams()) -> DataFrame:
    """The rows of ``docs`` without further members of a component: the row with the
    smallest ``doc_id`` stays, and every row without a word. Its columns may have any
    name but ``__rk``."""
    rows, classes, _ = find_components(docs, params)
    gone = rows.join(classes, "cls").where("n_shingles > 0 AND rk != first_rk").select(F.col("rk").alias("__rk"))
    return docs.withColumn("__rk", F.monotonically_increasing_id()).join(gone, "__rk", "left_anti").select(*docs.columns)


def find_components(docs: DataFrame, p: MinHashParams) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Written tables: rows (rk, doc_id, n_shingles, cls), classes (cls, component_id,
    first_rk: the row that stays), links (a, b)."""
    docs = docs.select(F.monotonically_increasing_id().alias("rk"), "doc_id", "text")
    scanned = materialize(_scan(docs, p, "signature"), "near-signatures")
    rows = scanned.drop("signature")
    filled = scanned.where("n_shingles > 0")
    # One row of each class, the one with the least position, carries its signature on.
    first = filled.groupBy("cls").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "rk")).alias("first"), F.min("rk").alias("rk"))
    reps = first.select("cls", "rk", F.col("first.doc_id").alias("rep_id"), F.col("first.rk").alias("rep_rk"))
    signatures = scanned.join(reps.select("rk"), "rk", "left_semi").select("rk", "cls", "signature")

    n = shuffle_tasks(docs)
    buckets = _bucket_rows(signatures, p).repartition(n, "bucket").sortWithinPartitions("bucket", "cls")
    starred = materialize(_hub_pairs(buckets), "near-buckets")
    pairs = starred.select(F.col("hub").alias("a"), F.col("cls").alias("b")).distinct()
    survivors = materialize(_pairs_that_survive(pairs, signatures, p), "near-survivors")

    # Full sets of the classes that take part in a verification: one more pass over their texts.
    alone = starred.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    wanted = (survivors.select(F.explode(F.array("a", "b")).alias("cls"))
              .unionByName(starred.join(alone, "bucket", "left_semi").select("cls")).distinct())
    texts = docs.join(signatures.select("rk", "cls").join(wanted, "cls", "left_semi").select("rk"), "rk", "left_semi")
    sets = materialize(_scan(texts, p, "members").select("cls", "members"), "near-sets")

    # One hub for each class first; most components close with it.
    leading = survivors.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    linked = materialize(_confirmed(leading, sets, p), "near-links")
    roots = components(linked)
    open_pairs = _between(survivors.join(leading, ["a", "b"], "left_anti"), roots)
    linked = linked.unionByName(materialize(_confirmed(open_pairs, sets, p), "near-links"))
    roots = components(linked)

    # Classes that share a bucket with neither as its hub, in different components.
    rooted = starred.join(roots, "cls", "left").select("bucket", "cls", F.coalesce("root", "cls").alias("root"))
    mixed = (rooted.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("lo"), F.max("root").alias("hi"))
             .where("lo != hi").select("bucket", F.expr(f"(n + {p.block - 1}) div {p.block}").alias("blocks")))
    members = (rooted.join(mixed, "bucket").join(signatures.select("cls", "signature"), "cls").join(sets, "cls"))
    linked = linked.unionByName(materialize(_block_links(members, p), "near-links"))
    roots = components(linked)

    named = reps.join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    least = (named.groupBy("root").agg(F.min(F.struct(F.col("rep_id").isNull(), "rep_id", "rep_rk")).alias("least"))
             .select("root", F.col("least.rep_id").alias("component_id"), F.col("least.rep_rk").alias("first_rk")))
    classes = named.join(least, "root").select("cls", "component_id", "first_rk")
    return rows, classes, linked


def _between(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs whose ends lie in different components."""
    ra = roots.select(F.col("cls").alias("a"), F.col("root").alias("ra"))
    rb = roots.select(F.col("cls").alias("b"), F.col("root").alias("rb"))
    return (pairs.join(ra, "a", "left").join(rb, "b", "left")
            .where(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b"))
