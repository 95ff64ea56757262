import pytest
from pyspark.sql import functions as F

#: Names that operators use inside; as extra columns they must not disturb.
CLASHING = ["key", "word", "rk", "n", "pos", "size", "shard", "bucket", "cls", "slot", "h", "features", "stratum", "n_lines", "value", "tie", "lang_pred", "kept", "w"]
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make_docs(spark):
    """Documents from ``(doc_id, text)`` or ``(doc_id, text, lang)``, with clashing extra columns."""
    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOC_SCHEMA).withColumns({c: F.lit("x") for c in CLASHING})
    return make


LONG = "aZ é\n" * 60_000


@pytest.fixture
def edge_rows():
    """Nulls, empties, white space, a very long text, repeated rows and ties."""
    base = [(1, "The quick brown fox jumps over the lazy dog"), (2, None), (3, ""), (4, " \t\n\x0b\x0c\r "), (None, "no id here at all"), (None, None),
            (5, LONG), (6, "one"), (6, "one"), (7, "One"), (8, "123 456 ..."), (9, "日本語 テキスト 😀"), (10, "ÀÉ àé Straße")]
    return base
