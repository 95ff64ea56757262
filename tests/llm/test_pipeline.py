"""The pipeline against a plain run of the same rules, and the registered queries against DuckDB."""

import hashlib
import struct

import public_tokenizers
import pytest
import tiktoken

import __spark_entry__
import corpus_pipeline
from ledgerflow.llm import byte_bpe, queries
from ledgerflow.llm.common import table
from tests.oracle_compare import compare

from . import brute

SF = "/root/testdata/sf0.001"


def test_registered():
    names = __spark_entry__.queries()
    assert {f"op{n}" for n in range(1, 14)} == {x.split("_")[0] for x in names if x.startswith("op")}
    assert "pipeline" in names and set(__spark_entry__.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_duckdb(spark, name):
    assert compare(spark, SF, [name], verbose=False)[name][0] is True


def test_pipeline_by_brute_force(spark):
    docs = table(spark, SF, "documents").collect()
    rows = [(r.doc_id, r.text) for r in docs if not brute.quality(r.text)[-1]]  # too few labels for cutoffs here
    rows = [(i, t) for i, _, _, t in brute.line_dedup(rows)]
    first: dict = {}
    for (i, t), (n, _, root) in zip(rows, brute.components(rows, 5)):
        key = root if n else (i, "alone")
        first[key] = min(first.get(key, (i, t)), (i, t))
    rows = sorted(first.values())
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    rows = [x for x, c in zip(rows, brute.contamination(rows, items)) if not c[-1]]
    coder = byte_bpe.load_ranks(queries.VOCABULARY)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(coder)}, special_tokens={})
    want = []
    for i, t in rows:
        ids = library.encode_ordinary(t)
        want.append((i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, SF).collect()) == sorted(want)


def test_stages_keep_the_columns(spark, make_docs, edge_rows):
    docs = make_docs(edge_rows + [(i, " ".join(f"w{i}x{k}" for k in range(60))) for i in range(20, 30)])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        for given in (docs, docs.limit(0)):
            out = stage(spark, given, SF)
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
            assert out.count() <= given.count()
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()
