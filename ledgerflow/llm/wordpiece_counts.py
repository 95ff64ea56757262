"""Greedy word-piece lengths by a linear longest-match automaton, without building pieces.

The vocabulary is a trie with two roots, one for pieces that start a word and one
for pieces that continue it. Every node has a failure link (the node that stands
for what is left once the longest pieces of its string are cut off) and the
number of pieces that are cut off on the way. A word then costs one step a byte:
where the trie has no edge, the number is added and the link followed; at the
end the links lead back to the continuation root, or to nothing, and then the
word is unknown and counts as one token.

All distinct words of a slice of documents walk the automaton in lockstep.

Defined cases: null and empty texts have no words and no tokens. With an empty
vocabulary every word is unknown. A very long word takes one step a byte.
Repeated rows are counted alike; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerflow.llm.common import span_hashes, text_slices, word_spans

CONTINUE = 1  # the node of the continuation root; 0 is that of word starts


@dataclass(frozen=True)
class Automaton:
    edges: np.ndarray    # sorted node * 256 + byte
    targets: np.ndarray  # node an edge leads to
    fail: np.ndarray     # failure link of each node; -1: none
    popped: np.ndarray   # pieces cut off on the way of the failure link


def build(starting: list[bytes], continuing: list[bytes]) -> Automaton:
    """The automaton of the pieces that start words and those that continue them."""
    step: list[dict[int, int]] = [{}, {}]
    final = [False, False]
    for root, pieces in ((0, starting), (CONTINUE, continuing)):
        for piece in pieces:
            at = root
            for byte in piece:
                nxt = step[at].get(byte)
                if nxt is None:
                    nxt = step[at][byte] = len(step)
                    step.append({})
                    final.append(False)
                at = nxt
            final[at] |= bool(piece)
    fail, popped = [-1] * len(step), [0] * len(step)
    layer = [0, CONTINUE]
    while layer:  # links of shorter strings come first
        below = []
        for node in layer:
            for byte, child in step[node].items():
                below.append(child)
                if final[child]:
                    fail[child], popped[child] = CONTINUE, 1
                    continue
                z, n = fail[node], popped[node]
                while z >= 0 and byte not in step[z]:
                    n += popped[z]
                    z = fail[z]
                if z >= 0:
                    fail[child], popped[child] = step[z][byte], n
        layer = below
    keys = np.array([node * 256 + byte for node, out in enumerate(step) for byte in out], np.int64)
    targets = np.array([child for out in step for child in out.values()], np.int64)
    order = np.argsort(keys)
    return Automaton(keys[order], targets[order], np.array(fail, np.int64), np.array(popped, np.int64))


def count_words(m: Automaton, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of each word ``data[start:end]`` (1 if unknown) and whether it is unknown."""
    n = len(starts)
    pieces, unknown, state = np.zeros(n, np.int64), np.zeros(n, bool), np.zeros(n, np.int64)
    if not len(m.edges):
        return np.ones(n, np.int64), np.ones(n, bool)

    def pop(who: np.ndarray) -> np.ndarray:
        """Follow one failure link; returns those that had one."""
        pieces[who] += m.popped[state[who]]
        state[who] = m.fail[state[who]]
        lost = state[who] < 0
        unknown[who[lost]] = True
        return who[~lost]

    lengths = ends - starts
    active = np.argsort(-lengths, kind="stable")
    for k in range(int(lengths.max()) if n else 0):
        active = active[:np.searchsorted(-lengths[active], -k)]  # words longer than k
        active = active[~unknown[active]]
        byte = data[starts[active] + k].astype(np.int64)
        who = active
        while len(who):
            key = state[who] * 256 + byte
            at = np.minimum(np.searchsorted(m.edges, key), len(m.edges) - 1)
            ok = m.edges[at] == key
            state[who[ok]] = m.targets[at[ok]]
            stuck = who[~ok]
            left = pop(stuck)
            byte = byte[~ok][~unknown[stuck]]
            who = left
    rest = np.flatnonzero(~unknown)
    while len(rest):
        rest = rest[state[rest] != CONTINUE]
        rest = pop(rest)
    pieces[unknown] = 1
    return pieces, unknown


def pieces_of(tokens: list[bytes], marker: bytes = b" ") -> tuple[list[bytes], list[bytes]]:
    """Split a vocabulary whose word-initial tokens carry ``marker`` into starting and continuing pieces."""
    starting = [t[len(marker):] for t in tokens if t.startswith(marker) and len(t) > len(marker)]
    return [t for t in starting if marker not in t], [t for t in tokens if marker not in t]


def token_counts(docs: DataFrame, starting: list[bytes], continuing: list[bytes]) -> DataFrame:
    """``doc_id, n_words, n_tokens, n_unknown`` of every row of ``docs(doc_id, text)``."""
    machine = build(starting, continuing)  # a few MB, as large as the vocabulary
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for first, n, data, offsets in text_slices(batch, 1):
                starts, ends, row = word_spans(data, offsets)
                _, one, of = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
                pieces, unknown = count_words(machine, data, starts[one], ends[one])
                sums = (np.bincount(row, minlength=n), np.bincount(row, pieces[of], n).astype(np.int64), np.bincount(row, unknown[of], n).astype(np.int64))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), *map(pa.array, sums)], names=["doc_id", "n_words", "n_tokens", "n_unknown"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_words long, n_tokens long, n_unknown long")
