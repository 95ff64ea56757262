"""Fill-in-middle: documents as piece tables whose pieces are cut, permuted and put back.

A slice of documents is one immutable byte buffer. A piece is a descriptor
(document, buffer, start, end) over the text buffer or the small buffer of
sentinels; no text is moved before an output is written. Cutting replaces a
document's one descriptor by three (prefix, middle, suffix), arranging gathers
descriptors in the order of the document's form with the sentinels between them,
and the inverse permutation gathers the text pieces of an output in reading order
again. Digests stream over descriptors.

Cuts lie at the ends of units: a run of white space with the word behind it, or
white space at the end. What is cut where, and in which form, comes from a hash of
the seed and the document id, so every run and every retry gives the same output.

Defined cases: a null text is empty; empty texts and those that hold a sentinel stay
plain; a null id counts as ''. A cut may leave any of the pieces empty. Equal ids
are cut at the same draws. A very long text is a slice of its own and takes about
six bytes a byte of it. An empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import IS_SPACE, text_slices

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SENTINELS = PREFIX + SUFFIX + MIDDLE
FORMS = ("plain", "psm", "spm")
# The order of pieces in each form: 0 to 2 are prefix, middle, suffix; 3 to 5 the sentinels as they lie in SENTINELS.
ORDERS = {"psm": (3, 0, 4, 2, 5, 1), "spm": (4, 2, 3, 0, 5, 1)}


@dataclass(frozen=True)
class FimParams:
    seed: int = 42
    percent: int = 50         # of documents that are transformed
    spm_percent: int = 80     # of these in suffix-prefix-middle form


@dataclass(frozen=True)
class Pieces:
    """Descriptors in output order; ``row`` is ascending. Buffer 0 is the text, 1 the sentinels."""
    text: np.ndarray
    row: np.ndarray
    buffer: np.ndarray
    start: np.ndarray
    end: np.ndarray

    def take(self, index: np.ndarray) -> Pieces:
        return Pieces(self.text, self.row[index], self.buffer[index], self.start[index], self.end[index])

    def rows(self, n: int):
        """For each of ``n`` documents the views of its pieces, in order."""
        sources = memoryview(self.text), memoryview(SENTINELS)
        views = [sources[b][s:e] for b, s, e in zip(self.buffer.tolist(), self.start.tolist(), self.end.tolist())]
        edges = np.searchsorted(self.row, np.arange(n + 1)).tolist()
        return (views[a:b] for a, b in zip(edges, edges[1:]))


def whole(text: np.ndarray, offsets: np.ndarray) -> Pieces:
    """One descriptor a document."""
    n = len(offsets) - 1
    return Pieces(text, np.arange(n), np.zeros(n, np.int8), offsets[:-1], offsets[1:])


def cut(pieces: Pieces, first: np.ndarray, second: np.ndarray) -> Pieces:
    """Each descriptor split at two places of its buffer."""
    n = len(pieces.row)
    edges = np.stack([pieces.start, first, second, pieces.end], 1)
    return Pieces(pieces.text, np.repeat(pieces.row, 3), np.repeat(pieces.buffer, 3), edges[:, :3].reshape(3 * n), edges[:, 1:].reshape(3 * n))


def arrange(thirds: Pieces, form: np.ndarray) -> Pieces:
    """Cut documents in the order of their form (an index into FORMS); plain ones keep theirs."""
    n = len(form)
    at = np.arange(3)
    every = Pieces(thirds.text, np.repeat(np.arange(n), 6), np.tile(np.repeat(np.array([0, 1], np.int8), 3), n),
                   np.concatenate([thirds.start.reshape(n, 3), np.tile(3 * at, (n, 1))], 1).reshape(-1),
                   np.concatenate([thirds.end.reshape(n, 3), np.tile(3 * at + 3, (n, 1))], 1).reshape(-1))
    order = np.array([(0, 1, 2, -1, -1, -1), ORDERS["psm"], ORDERS["spm"]])[form]
    index = (np.arange(n)[:, None] * 6 + order)[order >= 0]
    return every.take(index)


def find_pieces(output: bytes, form: str) -> Pieces:
    """The piece table of an output that was read from somewhere: its sentinels are
    found by their text, since no transformed text holds one."""
    data = np.frombuffer(output, np.uint8)
    if form == "plain":
        return whole(data, np.array([0, len(data)]))
    start, end, at = [], [], 0
    marks = [(o - 3) * 3 for o in ORDERS[form] if o >= 3]
    for m in marks:
        here = output.index(SENTINELS[m:m + 3], at)
        end.append(here)
        at = here + 3
        start.append(at)
    if end[0] != 0:
        raise ValueError("an output begins with a sentinel")
    end = [*end[1:], len(output)]
    return Pieces(data, np.zeros(3, np.int64), np.zeros(3, np.int8), np.array(start), np.array(end))


def restore(pieces: Pieces, form: str) -> Pieces:
    """The text pieces of one output in the order of the document."""
    if form == "plain":
        return pieces
    held = [o for o in ORDERS[form] if o < 3]
    return pieces.take(np.argsort(held))


def unit_ends(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends of all units, and before which of them each document's begin (one more entry than documents)."""
    word = ~IS_SPACE[data]
    ends = np.zeros(len(data) + 1, bool)
    ends[1:] = word
    ends[1:-1] &= ~word[1:]
    filled = offsets[1:][offsets[1:] > offsets[:-1]]
    ends[filled] = True  # the last unit of a document ends with it, be it a word or white space
    places = np.flatnonzero(ends)
    return places, np.searchsorted(places, offsets, "right")


def draws(doc_id: Column, seed: int) -> list[Column]:
    """The first four groups of eight hex digits of sha256 of ``seed:id`` as numbers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def _slice(data: np.ndarray, offsets: np.ndarray, h: list[np.ndarray], params: FimParams):
    """Units, form and arranged pieces of the documents of a slice, and the characters in prefix and middle."""
    n = len(offsets) - 1
    places, first = unit_ends(data, offsets)
    units = np.diff(first)
    a, b = h[0] % (units + 1), h[1] % (units + 1)
    places = np.append(places, 0)
    at = [np.where(k == 0, offsets[:-1], places[np.maximum(first[:-1] + k - 1, 0)]) for k in (np.minimum(a, b), np.maximum(a, b))]
    held = data.tobytes()
    marked = np.zeros(n, bool)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        here = held.find(mark)
        while here >= 0:
            row = int(np.searchsorted(offsets, here, "right")) - 1
            marked[row] |= here + 3 <= offsets[row + 1]
            here = held.find(mark, here + 1)
    plain = marked | (units == 0) | (h[2] % 100 >= params.percent)
    form = np.where(plain, 0, np.where(h[3] % 100 < params.spm_percent, 2, 1))
    cuts = np.sort(np.concatenate([offsets[:-1], *at]))
    letters = (data & 0xC0) != 0x80
    before = np.zeros(len(cuts), np.int64)  # code points before each cut of the slice
    if len(cuts):
        parts = np.add.reduceat(np.append(letters, False), cuts, dtype=np.int64)
        parts[:-1][cuts[1:] == cuts[:-1]] = 0  # an empty stretch sums one entry there
        before[1:] = np.cumsum(parts[:-1])
    chars = lambda x, y: before[np.searchsorted(cuts, y)] - before[np.searchsorted(cuts, x)]
    return units, form, arrange(cut(whole(data, offsets), *at), form), chars(offsets[:-1], at[0]), chars(at[0], at[1])


def _apply(docs: DataFrame, params: FimParams, id_column: str, text_column: str, fields: str, kinds: list, fn) -> DataFrame:
    id_type = docs.schema[id_column].dataType.simpleString()
    schema = f"{id_column} {id_type}, n long, form string, prefix_chars long, middle_chars long, {fields}"
    names = [id_column, "n", "form", "prefix_chars", "middle_chars", *(x.split()[0] for x in fields.split(", "))]

    def run(batches):
        for batch in batches:
            h = [batch.column(2 + k).to_numpy() for k in range(4)]
            for first, n, data, offsets in text_slices(batch, 1):
                units, form, pieces, prefix, middle = _slice(data, offsets, [x[first:first + n] for x in h], params)
                made = [FORMS[f] for f in form.tolist()]
                plain = form == 0
                rest = [fn(views, f) for views, f in zip(pieces.rows(n), made)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n), pa.array(units.astype(np.int64)), pa.array(made, pa.string()),
                     pa.array(prefix, pa.int64(), mask=plain), pa.array(middle, pa.int64(), mask=plain),
                     *(pa.array(column, kind) for column, kind in zip(zip(*rest), kinds, strict=True))], names=names)

    return docs.select(id_column, text_column, *draws(F.col(id_column), params.seed)).mapInArrow(run, schema)


def transform(docs: DataFrame, params: FimParams = FimParams(), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, n, form, prefix_chars, middle_chars, output``: the text of every document in its form."""
    return _apply(docs, params, id_column, text_column, "output string", [pa.string()],
                  lambda views, form: (b"".join(views).decode(),))


def restored(outputs: DataFrame, form_column: str = "form", output_column: str = "output") -> DataFrame:
    """``outputs`` with the column ``restored``: the texts that ``transform`` was given,
    from nothing but the output and its form."""
    rest = [c for c in outputs.columns if c != "restored"]
    schema = outputs.select(*rest).schema

    def run(batches):
        for batch in batches:
            forms = batch.column(batch.schema.get_field_index(form_column))
            texts = batch.column(batch.schema.get_field_index(output_column))
            for at in range(0, batch.num_rows, 64):
                back = []
                for form, text in zip(forms.slice(at, 64).to_pylist(), texts.slice(at, 64).cast(pa.binary())):
                    found = find_pieces(text.as_buffer().to_pybytes() if text.is_valid else b"", form)
                    back.append(b"".join(next(restore(found, form).rows(1))).decode())
                part = batch.slice(at, 64)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(back, pa.string())], names=[*rest, "restored"])

    from pyspark.sql.types import StringType
    return outputs.select(*rest).mapInArrow(run, schema.add("restored", StringType()))


def round_trip(docs: DataFrame, params: FimParams = FimParams(), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Transform every document and restore it from its output: digests of both."""
    def digest(views, form):
        output, there, back = b"".join(views), hashlib.sha256(), hashlib.sha256()
        for v in views:
            there.update(v)
        for v in next(restore(find_pieces(output, form), form).rows(1)):
            back.update(v)
        return there.hexdigest(), back.hexdigest()

    return _apply(docs, params, id_column, text_column, "output_sha256 string, restored_sha256 string", [pa.string(), pa.string()], digest)
