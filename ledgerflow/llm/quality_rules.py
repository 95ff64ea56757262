"""Quality rules whose cutoffs are certified on labelled holdouts.

Fixed base rules reject a text of too few words or mostly repeated words. Beyond
them each feature (share of symbols, exclamation marks, capitals, repeated lines
and repeated words) may reject a text above a cutoff, per stratum. The cutoffs of
all features together are used only if the labelled good texts of the stratum
prove, at the exact binomial bound, that they reject at most ``false_rejection``
of its good texts. They are tested along one path of joint cutoffs, from lenient
to strict until one fails, which needs no correction (fixed sequence); the level
is ``error`` divided by the number of strata that are tested (Bonferroni). Of the
certified joint cutoffs the one with the best balance of rejected bad and good
texts is used.

The path is laid without the good texts it is tested on: from the bad texts and
the good texts of the other strata or, where these are under ``design_rows``,
from a fifth of the own ones, which the test then leaves out.

A stratum whose good labels cannot certify anything at that level is not tested
and does not tighten the level of others; the label counts alone decide this.
Such strata share the cutoffs certified on their pooled labels or, where these
are too few, on the labels of all strata: the bound then holds for the good texts
of the pool, not of each stratum in it. A stratum without a good label is in no
pool and gets none, as does every stratum if all labels together are too few.

Copies are no independent trials: each distinct text of a stratum counts once.

DataFrame functions only; the driver sees counts per stratum, feature and grid
cell, and per stratum and step of the path, and decides the cutoffs.

Defined cases: a null text has no words and fails the base rules. A null stratum
value is a stratum of its own. A text whose labels disagree, or whose quality is
null, is not used as good. Without labels only the base rules apply. Repeated rows are judged
alike. Extra columns are kept by ``keep_good`` under any name but the helper
names that start with two underscores.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import materialize

GAP = r"[\x20\x09-\x0D]+"
NOT_GAP = r"[^\x20\x09-\x0D]"
SYMBOL = r"[#*$%&|<>]+"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("symbols", "exclaims", "capitals", "dup_lines", "repeats")


@dataclass(frozen=True)
class QualityParams:
    min_words: int = 50
    max_repeat_percent: int = 50
    stratum: str = "lang"
    false_rejection: float = 0.02   # share of good texts the cutoffs may reject, all features together
    error: float = 0.05             # chance that any stratum exceeds it
    grid: int = 200                 # candidate cutoffs k / grid of every feature
    good_weight: int = 20           # one good text lost weighs as much as so many bad ones caught
    design_rows: int = 100          # good texts of other strata that suffice to lay a path


def _removed(text: Column, pattern: str) -> Column:
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("long")


def with_counts(docs: DataFrame) -> DataFrame:
    """``docs`` with the counts of its texts in columns ``__n_words`` ... and ``__features``.

    Repeated windows: the hashes of all 3-word windows of a text are sorted with
    their places only if some are equal; a window that equals a neighbour in that
    order is repeated, and words are counted from the places in order."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.withColumns({"__text": text, "__words": F.array_remove(F.split(text, GAP), "")})
    n = F.size("__words")
    d = d.withColumns({
        "__n_words": n.cast("long"),
        "__word_chars": F.length(F.array_join("__words", "")).cast("long"),
        "__n_symbols": _removed(F.col("__text"), SYMBOL),
        "__n_exclaims": _removed(F.col("__text"), "!+"),
        "__n_capitals": _removed(F.col("__text"), "[A-Z]+"),
        "__lines": F.filter(F.split("__text", "\n"), lambda x: x.rlike(NOT_GAP)),
        "__h": F.when(n > 2, F.transform(F.slice("__words", 1, F.greatest(n - 2, F.lit(1))),
                                         lambda x, i: F.xxhash64(x, F.get("__words", i + 1), F.get("__words", i + 2)))),
    }).drop("__text", "__words")
    d = d.withColumns({
        "__n_lines": F.size("__lines").cast("long"),
        "__n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "__s": F.when(F.size(F.array_distinct("__h")) < F.size("__h"),
                      F.sort_array(F.transform("__h", lambda x, i: F.struct(x.alias("h"), i.alias("p"))))),
    }).drop("__lines", "__h")
    same = lambda i, j: F.get("__s", i)["h"] == F.get("__s", j)["h"]
    d = d.withColumn("__p", F.sort_array(F.transform(F.filter("__s", lambda x, i: F.coalesce(same(i, i - 1), F.lit(False)) | F.coalesce(same(i, i + 1), F.lit(False))), lambda x: x["p"]))).drop("__s")
    covered = F.aggregate(F.transform("__p", lambda x, i: F.least(F.lit(3), F.coalesce(F.get("__p", i + 1) - x, F.lit(3)))), F.lit(0), lambda a, x: a + x)
    d = d.withColumn("__n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("__p")
    share = lambda a, b: F.least(F.lit(1.0), F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), F.lit(0.0)))
    return d.withColumn("__features", F.array(share("__n_symbols", "__word_chars"), share("__n_exclaims", "__n_words"),
                                              share("__n_capitals", "__word_chars"), share("__n_dup_lines", "__n_lines"),
                                              share("__n_repeat_words", "__n_words"))).drop("__n_exclaims", "__n_capitals", "__n_lines")


def base_failed(p: QualityParams) -> Column:
    return (F.col("__n_words") < p.min_words) | (100 * F.col("__n_repeat_words") > p.max_repeat_percent * F.col("__n_words"))


def binomial_tail(k: int, n: int, rate: float) -> float:
    """P(Binomial(n, rate) <= k)."""
    total = 0.0
    for i in range(k + 1):
        term = math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(rate) + (n - i) * math.log1p(-rate))
        total += term
        if i > n * rate and term < 1e-18:
            break
    return min(1.0, total)


def _certified(good: list[int], bad: list[int], level: float, rate: float, p: QualityParams) -> int | None:
    """Index of the cutoff to use. ``good[i]``, ``bad[i]``: texts that cutoff i - 1 and
    those below it reject, and cutoff i does not."""
    n, best, best_gain = sum(good), None, 0
    above_good = above_bad = 0
    for cutoff in range(len(good) - 2, -1, -1):  # from lenient to strict
        above_good += good[cutoff + 1]
        above_bad += bad[cutoff + 1]
        if n == 0 or above_good > n * rate or binomial_tail(above_good, n, rate) > level:
            break
        gain = above_bad - p.good_weight * above_good
        if gain > best_gain:
            best, best_gain = cutoff, gain
    return best


def _path(good: list[list[int]], bad: list[list[int]], p: QualityParams) -> list[tuple[int, int]]:
    """Steps (feature, grid cutoff) of a path of joint cutoffs: each lowers one feature's
    cutoff, to where it rejects further bad texts. Steps that reject few of the
    ``good`` texts come first, then features that reject many ``bad`` ones."""
    n = max(1, sum(good[0]))
    bounds = [0, *(p.false_rejection * x for x in (.25, .5, 1))]
    steps, caught = [], {}
    for f in range(len(FEATURES)):
        above_good = above_bad = 0
        for cutoff in range(p.grid - 1, -1, -1):
            above_good += good[f][cutoff + 1]
            above_bad += bad[f][cutoff + 1]
            if bad[f][cutoff + 1]:
                turn = next((i for i, x in enumerate(bounds) if above_good <= n * x), len(bounds) + above_good)
                steps.append((turn, f, cutoff))
                caught[turn, f] = above_bad
    return [(f, cutoff) for turn, f, cutoff in sorted(steps, key=lambda x: (x[0], -caught[x[:2]], x[1], -x[2]))]


def _families(goods: dict, p: QualityParams) -> tuple[list[dict], float]:
    """What is tested, from label counts alone: families of strata that share cutoffs,
    and the level of each. ``goods``: stratum -> good texts (all, design fold)."""
    total = sum(n for n, _ in goods.values())

    def family(uses, tested):
        n, fold = (sum(goods[s][i] for s in tested) for i in (0, 1))
        split = total - n < p.design_rows
        return {"uses": uses, "tested": set(tested), "split": split, "n": n - fold if split else n}

    strata = sorted((s for s in goods if goods[s][0]), key=lambda s: (-goods[s][0], repr(s)))
    for k in range(len(strata), -1, -1):  # the k best labelled strata alone, the others pooled
        level = p.error / max(1, k + (k < len(strata)))
        enough = lambda x: (1 - p.false_rejection) ** x["n"] <= level
        alone = [family([s], [s]) for s in strata[:k]]
        if all(map(enough, alone)):
            pools = [family(strata[k:], x) for x in (strata[k:], strata) if k < len(strata)]
            return alone + [x for x in pools if enough(x)][:1], level
    return [], p.error


def certify(features: DataFrame, labels: DataFrame, params: QualityParams = QualityParams()) -> dict:
    """Cutoffs: (stratum value, feature) -> value above which a text is rejected.
    ``features``: doc_id, stratum, text_hash, features."""
    p, size = params, params.grid + 1
    marks = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy(F.col("doc_id").alias("labelled"))
             .agg(F.min("quality").alias("lo"), F.max("quality").alias("hi")).where("lo = hi AND lo IN (0, 1)"))
    texts = (features.join(marks, F.col("doc_id") == F.col("labelled"))
             .groupBy("stratum", "text_hash").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("features").alias("features")).where("lo = hi")
             .select("stratum", F.col("hi").alias("quality"), (F.pmod(F.xxhash64(F.lit("design"), "text_hash"), F.lit(5)) == 0).alias("fold"),
                     F.transform("features", lambda x: F.ceil(x * p.grid).cast("int")).alias("cells")))
    texts = materialize(texts, "quality-labels")
    counts: dict = {}  # (stratum, fold, quality) -> feature -> cell -> texts
    for r in (texts.select("stratum", "fold", "quality", F.posexplode("cells").alias("feature", "cell"))
              .groupBy("stratum", "fold", "quality", "feature", "cell").count().collect()):
        counts.setdefault((r["stratum"], r["fold"], r["quality"]), [[0] * size for _ in FEATURES])[r["feature"]][r["cell"]] += r["count"]

    def histogram(wanted):
        found = [c for key, c in counts.items() if wanted(*key)]
        return [[sum(c[f][i] for c in found) for i in range(size)] for f in range(len(FEATURES))]

    of = lambda s, *folds: sum(sum(counts[s, x, 1][0]) for x in folds if (s, x, 1) in counts)
    families, level = _families({s: (of(s, True, False), of(s, True)) for s in {key[0] for key in counts}}, p)
    if not families:
        return {}
    bad = histogram(lambda s, fold, quality: quality == 0)
    rows = []
    for i, x in enumerate(families):
        good = histogram(lambda s, fold, quality: quality == 1 and (s in x["tested"] and fold if x["split"] else s not in x["tested"]))  # noqa: B023
        x["path"] = _path(good, bad, p)
        # per feature and cell the first step that rejects a text there
        first = [[len(x["path"])] * size for _ in FEATURES]
        for step, (f, cutoff) in reversed(list(enumerate(x["path"]))):
            first[f][cutoff + 1:] = [step] * (size - cutoff - 1)
        rows += [(i, s, x["split"], first) for s in x["tested"]]
    steps = features.sparkSession.createDataFrame(rows, f"family int, of {features.schema['stratum'].dataType.simpleString()}, split boolean, first array<array<int>>")
    hit = F.array_min(F.transform("cells", lambda cell, f: F.get(F.get("first", f), cell)))
    tested = (texts.join(F.broadcast(steps), F.col("stratum").eqNullSafe(F.col("of")))
              .where((F.col("quality") == 0) | ~F.col("split") | ~F.col("fold"))
              .groupBy("family", "quality", hit.alias("step")).count().collect())
    out = {}
    for i, x in enumerate(families):
        n = len(x["path"])
        seen = {q: [0] * (n + 1) for q in (0, 1)}
        for r in tested:
            if r["family"] == i:
                seen[r["quality"]][n - r["step"]] += r["count"]
        cutoff = _certified(seen[1], seen[0], level, p.false_rejection, p)
        if cutoff is not None:
            for f, k in x["path"][:n - cutoff]:
                out.update({(s, f): k / p.grid for s in x["uses"]})
    return out


def rejected(cutoffs: dict, stratum: Column) -> Column:
    """Whether a row's features exceed a cutoff of its stratum."""
    out = F.lit(False)
    for (value, feature), cutoff in cutoffs.items():
        here = stratum.isNull() if value is None else stratum.eqNullSafe(value)
        # compared on the grid, as certified
        out = out | (here & (F.ceil(F.get("__features", F.lit(feature)) * QualityParams.grid) > round(cutoff * QualityParams.grid)))
    return out


def _features(docs: DataFrame, p: QualityParams) -> DataFrame:
    """Counts and features of every row, without its text, written once: a filter over
    them would otherwise be moved below the steps that compute them."""
    rows = docs.select(F.monotonically_increasing_id().alias("__rk"), "doc_id", F.col(p.stratum).alias("stratum"), "text",
                       F.xxhash64("text").alias("text_hash"))
    return materialize(with_counts(rows).drop("text"), "quality-features")


def _cutoffs(scanned: DataFrame, labels: DataFrame, p: QualityParams) -> dict:
    return certify(scanned.select("doc_id", "stratum", "text_hash", F.col("__features").alias("features")), labels, p)


def judge(docs: DataFrame, labels: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """``doc_id``, the counts, ``base_failed`` and ``kept`` of every row; one pass over the texts."""
    scanned = _features(docs, params)
    cutoffs, failed = _cutoffs(scanned, labels, params), base_failed(params)
    return scanned.select("doc_id", *(F.col(f"__{c}").alias(c) for c in COUNTS), failed.alias("base_failed"),
                          (~failed & ~rejected(cutoffs, F.col("stratum"))).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with their columns."""
    scanned = _features(docs, params)
    cutoffs = _cutoffs(scanned, labels, params)
    bad = scanned.where(base_failed(params) | rejected(cutoffs, F.col("stratum"))).select("__rk")
    return docs.withColumn("__rk", F.monotonically_increasing_id()).join(bad, "__rk", "left_anti").select(*docs.columns)
