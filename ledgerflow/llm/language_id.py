"""Language identification by the nearest of several centroids per language.

A text is a vector of hashed character 1- to 3-gram counts (letters only, lower
case, words joined by one space), weighted by 1 + log(count) and by inverse
document frequency and scaled to length 1. Document frequencies cover every
training row. Each language gets several centroids by spherical k-means on a
bounded sample of each language's distinct training texts, clustered on the
executors, one language per group. A text takes the language of the centroid with the largest cosine; where
that cosine lies below what nearly all sample members of that centroid reach,
the prediction is marked as rejected.

Defined cases: a null text, or one without a letter, gives ``und`` with score 0
and is rejected; with no training rows at all, so does every text. A null
``lang`` is never learned from. Equal cosines go to the first language in sort
order. Repeated rows are scored alike; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import id_remainder

UNDETERMINED = "und"
_LETTER: list[np.ndarray] = []


@dataclass(frozen=True)
class LanguageParams:
    dims: int = 4096           # hashed n-gram dimensions
    centroids: int = 4         # per language
    fit_rows: int = 1500       # distinct texts per language that the clustering sees at most, about
    iterations: int = 8
    reject_quantile: float = 0.005
    piece_chars: int = 1 << 18  # a longer text is counted piece by piece


def _letters() -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def ngram_counts(text: str | None, p: LanguageParams) -> np.ndarray | None:
    """Hashed 1- to 3-gram counts; None if the text has no letter."""
    if not text:
        return None
    shift, total, any_letter, tail = np.uint32(32 - (p.dims.bit_length() - 1)), None, False, np.array([32], np.uint32)
    for at in range(0, len(text), p.piece_chars):
        code = np.frombuffer(text[at:at + p.piece_chars].lower().encode("utf-32-le", "replace"), "<u4")
        letter = _letters()[code]
        any_letter |= bool(letter.any())
        code = np.where(letter, code, np.uint32(32)).astype(np.uint32)
        code = np.concatenate([tail, code, [np.uint32(32)] if at + p.piece_chars >= len(text) else []]).astype(np.uint32)
        keep = np.ones(len(code), bool)
        keep[1:] = (code[1:] != 32) | (code[:-1] != 32)
        code = code[keep]
        fresh = len(tail)
        a = code * np.uint32(0x9E3779B1)
        b = (code[1:] * np.uint32(0x85EBCA77)) ^ (code[:-1] * np.uint32(0xC2B2AE3D) + np.uint32(0x27D4EB2F))
        c = (b[1:] * np.uint32(0x165667B1)) ^ (code[:-2] * np.uint32(0x2545F491) + np.uint32(0x68E31DA4))
        # n-grams that end within the kept tail were counted with the piece before
        grams = np.concatenate([a[fresh:], (b * np.uint32(0x9E3779B1))[max(0, fresh - 1):], (c * np.uint32(0x9E3779B1))[max(0, fresh - 2):]])
        counts = np.bincount(grams >> shift, minlength=p.dims)
        total = counts if total is None else total + counts
        tail = code[-2:]
    return total.astype(np.float32) if any_letter else None


def _vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0).astype(np.float32) * idf
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def _document_frequencies(train: DataFrame, p: LanguageParams) -> tuple[np.ndarray, int]:
    """Per dimension the number of training rows with it: one partial vector a
    task, summed by Spark; ``dims`` + 1 rows reach the driver."""
    def count(batches):
        df, n = np.zeros(p.dims, np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                c = ngram_counts(text.as_py(), p)
                if c is not None:
                    df += c > 0
                    n += 1
        d = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(d, -1)), pa.array(np.append(df[d], n))], names=["dim", "n"])

    rows = train.select("text").mapInArrow(count, "dim long, n long").groupBy("dim").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(p.dims)
    n = 0
    for r in rows:
        if r.dim < 0:
            n = r.n
        else:
            df[r.dim] = r.n
    return df, n


def fit(train: DataFrame, params: LanguageParams = LanguageParams()) -> dict:
    """Centroids from ``text`` and ``lang`` of the given rows."""
    p = params
    train = train.where(F.col("lang").isNotNull()).select("text", "lang")
    df, n = _document_frequencies(train, p)
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)
    # The sample: the texts whose hash falls below a share that leaves about fit_rows of each language's
    # distinct texts, or all of them. A text without a letter has no vector and does not count; a character
    # unknown to Spark may be a letter.
    draw = F.xxhash64(F.lit("fit"), "text")
    sizes = (train.where(F.col("text").rlike(r"[\p{L}\p{Cn}]")).groupBy("lang", draw.alias("draw")).agg(F.lit(1))
             .groupBy("lang").count().collect())
    below = F.lit(0)
    for r in sizes:
        below = F.when(F.col("lang") == r["lang"], F.lit(min(1 << 30, (p.fit_rows << 30) // r["count"] + 1))).otherwise(below)
    sample = train.where(F.col("text").isNotNull() & (F.pmod(draw, F.lit(1 << 30)) < below)).withColumn("draw", draw)

    def vectors(batches):
        seen = set()  # copies within a task; as many entries as sampled texts at most
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                fresh = []
                for i, key in enumerate(zip(part.column("lang").to_pylist(), part.column("draw").to_pylist(), strict=True)):
                    if key not in seen:
                        seen.add(key)
                        fresh.append(i)
                part = part.take(pa.array(fresh, pa.int64()))
                counts = [ngram_counts(t, p) for t in part.column("text").to_pylist()]
                has = [i for i, c in enumerate(counts) if c is not None]
                if has:
                    v = _vectors(np.stack([counts[i] for i in has]), idf).astype(np.float16)
                    yield pa.RecordBatch.from_arrays([part.column("lang").take(pa.array(has)), part.column("draw").take(pa.array(has)), pa.array([x.tobytes() for x in v], pa.binary())], names=["lang", "draw", "v"])

    def cluster(key, pdf):
        x = np.stack([np.frombuffer(b, np.float16) for b in pdf.sort_values("draw")["v"]]).astype(np.float32)
        rng = np.random.default_rng(7)
        centre = x[rng.choice(len(x), min(p.centroids, len(x)), replace=False)]
        for _ in range(p.iterations):
            near = (x @ centre.T).argmax(1)
            for k in range(len(centre)):
                if (near == k).any():
                    centre[k] = x[near == k].mean(0)
            centre = centre / np.maximum(np.linalg.norm(centre, axis=1, keepdims=True), 1e-12)
        cos = x @ centre.T
        near = cos.argmax(1)
        floor = [float(np.quantile(cos[near == k, k], p.reject_quantile)) if (near == k).any() else 0.0 for k in range(len(centre))]
        return pd.DataFrame({"lang": key[0], "k": range(len(centre)), "floor": floor, "v": [c.astype(np.float32).tobytes() for c in centre]})

    # Copies of a text share a draw and become one row here, so a group stays near fit_rows whatever copies there are.
    rows = (sample.mapInArrow(vectors, "lang string, draw long, v binary")
            .groupBy("lang", "draw").agg(F.min("v").alias("v"))
            .groupBy("lang").applyInPandas(cluster, "lang string, k int, floor double, v binary").collect())
    rows = sorted(rows, key=lambda r: (r["lang"], r["k"]))
    return {"params": p, "idf": idf, "langs": [r["lang"] for r in rows], "floor": np.array([r["floor"] for r in rows]),
            "centroids": np.stack([np.frombuffer(r["v"], np.float32) for r in rows]) if rows else np.zeros((0, p.dims), np.float32)}


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` (cosine, 0 to 1), ``rejected`` for every row."""
    p, idf, centre, langs = model["params"], model["idf"], model["centroids"], model["langs"]
    floor = model["floor"]
    id_type = docs.schema["doc_id"].dataType

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                counts = [ngram_counts(t.as_py(), p) for t in part.column(1)] if langs else [None] * part.num_rows
                best = [(UNDETERMINED, 0.0, True)] * part.num_rows
                has = [i for i, c in enumerate(counts) if c is not None]
                if has:
                    cos = _vectors(np.stack([counts[i] for i in has]), idf) @ centre.T
                    for i, k, row in zip(has, cos.argmax(1), cos, strict=True):
                        score = float(row[k])
                        best[i] = (langs[k], min(1.0, max(0.0, score)), score < floor[k])
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(x, t) for x, t in zip(zip(*best), (pa.string(), pa.float64(), pa.bool_())))], names=["doc_id", "lang_pred", "score", "rejected"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type.simpleString()}, lang_pred string, score double, rejected boolean")


def identify(docs: DataFrame, folds: int = 3, held_out_fold: int = 1, params: LanguageParams = LanguageParams()) -> DataFrame:
    """Fit on the rows outside the held-out fold, predict for all."""
    held = id_remainder(F.col("doc_id"), folds) == held_out_fold
    return predict(docs, fit(docs.where(~held), params)).withColumn("held_out", held)
