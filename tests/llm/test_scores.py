"""Language identification and language-model scores."""

import collections
import math
import zlib

import numpy as np
import pyarrow as pa
import pytest

from ledgerflow.llm import language_id, lm_score
from ledgerflow.llm.common import SLICE_BYTES, table

SF = "/root/testdata/sf0.01"


def tokens(text):
    return [*(text or "").encode().lower().split(), b""]


def fold(doc_id, n):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % n


def test_language_held_out_accuracy(spark):
    docs = table(spark, SF, "documents")
    lang = {r.doc_id: r.lang for r in docs.collect()}
    rows = language_id.identify(docs).collect()
    assert len(rows) == len(lang)
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (fold(r.doc_id, 3) == 1) for r in rows)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_centroids_by_brute_force(make_docs):
    texts = {"aa": "kala mala tala sala", "bb": "xyxx yxyx zyzy"}
    rows = [(i, f"{texts[k]} {'la ' * (i % 3)}", k) for i, k in enumerate(["aa", "bb"] * 12)]
    model = language_id.fit(make_docs(rows), language_id.LanguageParams(centroids=2))
    assert set(model["langs"]) == {"aa", "bb"} and len(model["langs"]) <= 4
    for r in language_id.predict(make_docs(rows), model).collect():
        v = language_id._vectors(language_id.ngram_counts(rows[r.doc_id][1], model["params"])[None], model["idf"])[0]
        cos = model["centroids"] @ v
        assert r.lang_pred == model["langs"][int(cos.argmax())] == rows[r.doc_id][2]
        assert r.score == pytest.approx(min(1, cos.max()), abs=1e-5)


def test_language_of_many_copies_keeps_its_sample(make_docs):
    """Copies, and texts without a letter, leave a language's sample of distinct texts as it is."""
    other = [(f"kala mala tala sala {'la ' * (i % 5)}{chr(97 + i % 20)}{chr(97 + i // 20)}", "aa") for i in range(40)]
    rows = other + [("kala kala", "aa")] * 3000 + [(str(i), "aa") for i in range(3000)] + [(f"xyxx yxyx zyzy {'yz ' * i}", "bb") for i in range(20)]
    rows = [(i, *r) for i, r in enumerate(rows)]
    model = language_id.fit(make_docs(rows), language_id.LanguageParams(fit_rows=24))
    assert model["langs"] == ["aa"] * 4 + ["bb"] * 4
    got = {r.doc_id: r.lang_pred for r in language_id.predict(make_docs(rows), model).collect()}
    assert all(got[i] == lang for i, text, lang in rows if not text.isdigit())


def test_language_counts_do_not_depend_on_pieces():
    text = "Der schnelle, braune Fuchs -- springt ÜBER 12 Hunde! " * 40
    whole = language_id.ngram_counts(text, language_id.LanguageParams())
    for size in (1, 2, 3, 7, 50, 1000):
        assert (language_id.ngram_counts(text, language_id.LanguageParams(piece_chars=size)) == whole).all()


def test_language_edges(make_docs, edge_rows):
    train = [(i, f"hello world the of and {i}", "en") for i in range(100, 130)] + [(200, "le la les", None)]
    rows = language_id.identify(make_docs(edge_rows + train)).collect()
    assert len(rows) == len(edge_rows) + len(train)
    by_id = collections.defaultdict(list)
    for r in rows:
        by_id[r.doc_id].append((r.lang_pred, r.score, r.rejected))
    for i in (2, 3, 4, 8):
        assert by_id[i] == [("und", 0.0, True)]
    assert sorted(x[0] for x in by_id[None]) == ["en", "und"]
    assert len(by_id[6]) == 2 and by_id[6][0] == by_id[6][1]
    assert by_id[9][0][0] == "en"  # the only language learned
    nothing = language_id.identify(make_docs([(1, "text", None)])).collect()
    assert [(r.lang_pred, r.score) for r in nothing] == [("und", 0.0)]
    assert language_id.identify(make_docs(train).limit(0)).count() == 0


def brute_scores(rows, folds=7, out=2):
    c = collections.Counter()
    for i, t in rows:
        if fold(i, folds) != out:
            c.update(tokens(t))
    total, distinct = sum(c.values()), len(c)
    return collections.Counter((i, len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), total,
                                round(sum(math.log10((c[w] + 1) / (total + distinct + 1)) for w in tokens(t)), 5)) for i, t in rows)


@pytest.mark.parametrize("hot", [1 << 18, 7])
def test_lm_base_scores(make_docs, edge_rows, hot):
    rows = edge_rows + [(i, f"the cat {i} sat on the mat {i % 3} rare{i}") for i in range(20, 60)]
    got = lm_score.score_folds(make_docs(rows), params=lm_score.LmParams(hot_words=hot, heads=8)).collect()
    assert collections.Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got) == brute_scores(rows)
    assert all(r.score < 0 for r in got)


def lm_by_brute_force(model, counts, word, before):
    """Natural log P(word | the cells of the two words before), by loops over all groups and cells."""
    w, cells = model.weights, model.cells
    r1, r2 = (w["r"][k].astype(float) for k in before)
    ctx = np.append(r1 * w["c"][0] + r2 * w["c"][1], 1.0)
    softmax = lambda rows: np.exp(rows @ ctx) / np.exp(rows @ ctx).sum()
    n = counts.get(word, 0)
    cell = cell_of(model, word) if n else 1
    group = int(np.searchsorted(cells.starts, cell, "right")) - 1
    first, last = cells.starts[group], cells.starts[group + 1]
    p = softmax(w["g"].astype(float))[group] * softmax(w["q"][first:last].astype(float))[cell - first]
    if cell in set(cells.hashed.tolist()):
        p *= (n - model.discount) / cells.left[cell]
    return math.log(p)


def cell_of(model, word):
    key = lm_score.END if word == b"" else lm_score.span_hashes(np.frombuffer(word, np.uint8), np.array([0]), np.array([len(word)]))[0]
    return int(model.cells.of(np.array([key], np.uint64))[0])


LM_ROWS = [(i, f"the cat {i % 9} sat on the mat {i % 3} rare{i}") for i in range(20, 90)] + [(5, None), (6, ""), (7, "dog Dog the"), (9, "never seen words " * 3)]


@pytest.mark.parametrize("hot", [1 << 18, 7])
def test_lm_scores_by_brute_force(make_docs, hot):
    docs = make_docs([(i, t) for i, t in LM_ROWS if i != 9])
    model = lm_score.fit(docs, lm_score.LmParams(heads=6, hot_words=hot))
    counts = collections.Counter(t for i, x in LM_ROWS if i != 9 for t in tokens(x))
    start = len(model.cells.share)
    got = {r.doc_id: r.score for r in lm_score.score(make_docs(LM_ROWS), model).collect()}
    for i, text in LM_ROWS:
        before, want = (start, start), 0.0
        for t in tokens(text):
            want += lm_by_brute_force(model, counts, t, before)
            before = (cell_of(model, t), before[0])
        assert got[i] == pytest.approx(want / math.log(10), abs=1e-3)
    # All known words, the end and the unknown word have the probability 1 together.
    for before in [(start, start), (0, start), (cell_of(model, b"the"), cell_of(model, b"rare33"))]:
        assert sum(math.exp(lm_by_brute_force(model, counts, t, before)) for t in [*counts, b"unknown"]) == pytest.approx(1, abs=1e-4)


def test_lm_every_word_has_a_vector_and_held_out_text_gains(spark):
    docs = table(spark, SF, "documents")
    lang = {r.doc_id: r.lang for r in docs.collect()}
    rows = [r for r in lm_score.score_folds(docs).collect() if r.held_out]
    for name in {x for x in lang.values() if x}:
        of = [r for r in rows if lang[r.doc_id] == name]
        assert sum(r.score for r in of) > sum(r.base_score for r in of)
    model = lm_score.fit(docs)
    assert (model.cells.share[model.cells.hashed] > 0).mean() > 0.95  # the tail meets its cells
    assert np.abs(model.weights["r"][model.cells.hashed]).sum(1).astype(bool).mean() > 0.95


def test_lm_cells_grow_and_ties_do_not_empty_the_hot_words(spark):
    p = lm_score.LmParams()
    sizes = []
    for words in (100, 10_000):
        keys = np.arange(10, 10 + words, dtype=np.uint64)
        cells = lm_score.make_cells(keys, np.full(words, 2), 5, np.full(64, 9.0), np.full(64, 3.0), 0.5, p)
        sizes.append(len(cells.share))
        assert cells.share.sum() == pytest.approx(1) and cells.group[-1] == len(cells.size) - 1
        assert (cells.group[cells.of(keys)] >= 0).all() and len(set(cells.of(keys).tolist())) == words
    assert sizes[1] > sizes[0]
    rng = np.random.default_rng(1)
    ties = spark.createDataFrame([(int(k), 3 if i < 5 else 1) for i, k in enumerate(rng.integers(-2**63, 2**63, 4000))], "key long, n long")
    got = [r.n for r in lm_score._most_frequent(ties, 1000).collect()]
    assert 980 <= len(got) <= 1000 and got.count(3) == 5


def test_nce_learns_what_follows_what():
    """On a stream in which each word has one successor, the model finds it, in groups of one and of several cells."""
    p = lm_score.LmParams(dim=8, noise=12, batch=64, heads=3)
    cells = lm_score.make_cells(np.array([7, 8, 9, 10], np.uint64), np.array([20, 20, 20, 20]), 20, np.full(1, 1.0), np.full(1, 1.0), 0.5, p)
    assert cells.size.max() > 1
    loop = np.concatenate([[0], cells.of(np.array([7, 8, 9, 10], np.uint64))])
    stream = np.tile(loop, 2000)
    w = lm_score.initial_parameters(p, cells)
    state = {k: np.zeros_like(v) for k, v in w.items()}
    met = {k: np.zeros(len(v)) for k, v in w.items()}
    rng = np.random.default_rng(0)
    for at in range(2, len(stream) - p.batch, p.batch):
        i = np.arange(at, at + p.batch)
        lm_score.nce_step(w, stream[i - 1], stream[i - 2], stream[i], cells, state, met, rng, p)
    model = lm_score.LanguageModel(p, w, cells, None, 0, 0, .5, None)
    got = np.exp(model.log_probability(loop[[1, 2, 3, 4]], loop[[0, 1, 2, 3]], loop[[4, 0, 1, 2]])[0])
    assert (got > 0.75).all()
    assert np.exp(model.log_probability(loop[[2]], loop[[0]], loop[[4]])[0])[0] < 0.1


def lm_tables(rng, groups, cells, dim=8):
    return {"r": rng.normal(0, 1, (cells, dim)).astype(np.float32), "g": rng.normal(0, 1, (groups, dim + 1)).astype(np.float32),
            "c": rng.normal(1, .2, (2, dim)).astype(np.float32)}


def test_lm_normaliser_takes_exponentials_by_cell_not_by_pair(monkeypatch):
    """With many pairs of few cells before, the products grow with the cells."""
    rng = np.random.default_rng(3)
    sizes = []
    product = lm_score._product
    monkeypatch.setattr(lm_score, "_product", lambda a, b: sizes.append(len(a) * b.shape[1]) or product(a, b))
    groups, cells = 50, 60
    w = lm_tables(rng, groups, cells) | {"q": np.zeros((groups, 9), np.float32)}
    one = lm_score.Cells(np.array([lm_score.END]), np.array([0]), np.arange(16), np.full(groups, 1 / groups), np.zeros(groups), np.zeros(groups), np.arange(groups + 1))
    model = lm_score.LanguageModel(lm_score.LmParams(), w, one, None, 0, 0, .5, None)
    h1, h2 = (x.ravel() for x in np.meshgrid(np.arange(cells - 1), np.arange(cells - 1)))
    target = rng.integers(0, groups, len(h1))
    got, unknown = model.log_probability(target, h1, h2)
    assert sum(sizes) <= 2 * cells * groups < len(h1) * groups / 10
    scores = lm_score._context(w, h1, h2).astype(float) @ w["g"].astype(float).T
    want = scores - np.log(np.exp(scores).sum(1, keepdims=True))
    assert got == pytest.approx(want[np.arange(len(h1)), target], abs=1e-4)
    assert unknown == pytest.approx(want[:, 1], abs=1e-4)


@pytest.mark.parametrize("scale", [1, 30])
def test_lm_normaliser_by_brute_force(scale, monkeypatch):
    """Also in several parts, with rows without a chance, and where exponentials would overflow."""
    rng = np.random.default_rng(4)
    w = lm_tables(rng, 70, 40)
    w["g"] *= scale
    w["g"][[3, 69], -1] = -1e9
    pairs = np.unique(rng.integers(0, 40, (500, 2)), axis=0)
    monkeypatch.setattr(lm_score, "TILE_BITS", 2)
    scores = lm_score._context(w, *pairs.T).astype(float) @ w["g"].astype(float).T
    top = scores.max(1, keepdims=True)
    want = top[:, 0] + np.log(np.exp(scores - top).sum(1))
    for sizes in ({}, {"held": 1, "rows": 5}):
        assert lm_score._log_pair_sums(w, *pairs.T, **sizes) == pytest.approx(want, rel=1e-4, abs=1e-4)


def test_lm_chance():
    assert lm_score._chance(np.array([-1e9, -1, 0, 1, 1e9], np.float32)) == pytest.approx([0, 1 / (1 + math.e), .5, math.e / (1 + math.e), 1], abs=1e-6)


def test_lm_key_table_and_blocks(make_docs):
    rng = np.random.default_rng(5)
    some = rng.integers(0, 2**64, 5000, dtype=np.uint64)
    for keys in (some[:0], some[:1], some, np.append(np.arange(3000, dtype=np.uint64), some), np.append(some, np.uint64(2**64 - 1))):
        keys = np.unique(keys)
        asked = np.concatenate([keys, some, rng.integers(0, 2**64, 500, dtype=np.uint64), np.array([0, 1, 2**64 - 1], np.uint64)])
        place = {k: i for i, k in enumerate(keys.tolist())}
        assert lm_score.KeyTable(keys).places(asked).tolist() == [place.get(k, -1) for k in asked.tolist()]
    texts = pa.record_batch({"text": ["a b " * (i % 7) for i in range(50)] + [None, "x" * (SLICE_BYTES + 1), "", "y z"]})
    whole = [(k, first + r) for first, n, keys, row in lm_score.word_keys(texts, 0) for k, r in zip(keys.tolist(), row.tolist())]
    for size in (1, 40, 1 << 20):
        blocks = list(lm_score.word_blocks(texts, 0, size))
        assert [(k, first + r) for first, n, keys, row in blocks for k, r in zip(keys.tolist(), row.tolist())] == whole
        assert [b[0] for b in blocks] == np.cumsum([0] + [b[1] for b in blocks])[:-1].tolist() and sum(b[1] for b in blocks) == 54


def test_lm_training_step_sums_rows_that_repeat():
    """One step, also where the contexts are no stream, moves each row by the sum of its gradients."""
    p = lm_score.LmParams(dim=4, noise=3, batch=32, heads=2)
    cells = lm_score.make_cells(np.array([7, 8, 9, 10], np.uint64), np.array([9, 8, 7, 6]), 9, np.full(2, 4.0), np.full(2, 1.0), 0.5, p)
    start = len(cells.share)
    rng = np.random.default_rng(6)
    stream = rng.integers(0, start, 34)
    for h1, h2 in ((stream[1:-1], stream[:-2]), (rng.integers(0, start + 1, 32), rng.integers(0, start + 1, 32)), (stream[:1], stream[1:2])):
        target = rng.integers(0, start, len(h1))
        w = lm_score.initial_parameters(p, cells)
        old = {k: v.copy() for k, v in w.items()}
        state, met = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros(len(v)) for k, v in w.items()}
        lm_score.nce_step(w, h1, h2, target, cells, state, met, np.random.default_rng(1), p)
        assert met["r"].tolist() == np.bincount(np.append(h1, h2), minlength=start + 1).tolist()
        assert met["g"].sum() == len(h1) + p.noise
        # The gradient by loops, with the same noise.
        again = np.random.default_rng(1)
        ctx = np.append(old["r"][h1] * old["c"][0] + old["r"][h2] * old["c"][1], np.ones((len(h1), 1)), 1).astype(float)
        noise = cells.draw_groups(again, p.noise)
        group = cells.group[target]
        grad = np.zeros_like(old["g"], dtype=float)
        chance = lambda k, i: 1 / (1 + np.exp(cells.log_group[k] + math.log(p.noise) - ctx[i] @ old["g"][k]))
        for i in range(len(h1)):
            grad[group[i]] += (1 - chance(group[i], i)) * ctx[i]
            for k in noise:
                grad[k] -= chance(k, i) * ctx[i]
        assert state["g"] == pytest.approx(grad ** 2, rel=1e-3, abs=1e-5)
        assert w["g"] - old["g"] == pytest.approx(p.rate * grad / np.sqrt(grad ** 2 + 1e-8), rel=1e-2, abs=1e-3)


def test_lm_without_training_rows(make_docs):
    out = lm_score.score_folds(make_docs([(i, "a b") for i in range(50) if fold(i, 7) == 2])).collect()
    assert out and all(r.n_known == 0 and r.train_tokens == 0 and r.n_tokens == 3 for r in out)
    assert lm_score.score_folds(make_docs([(1, "a")]).limit(0)).count() == 0


def test_word_longer_than_a_slice(make_docs):
    rows = [(1, "x" * (SLICE_BYTES + 10) + " y"), (2, "x" * (SLICE_BYTES + 10)), (4, "y")]
    got = lm_score.score_folds(make_docs(rows), params=lm_score.LmParams(heads=4)).collect()
    assert collections.Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got) == brute_scores(rows)
