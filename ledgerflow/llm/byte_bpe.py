"""Byte-level BPE: exact encoding by longest matches and compatible neighbours, and decoding.

The bytes of a pre-token are mapped to Latin-1, so that an Aho-Corasick automaton
over the vocabulary (pyahocorasick) gives the longest token at a place: its trie is
followed as far as the text goes, and the last token on that path is it. Merging by
rank has exactly one result in which every two neighbouring tokens are what merging
makes of their joint bytes; the encoder takes the longest token that is compatible
with the token before, tries its shorter prefixes, and steps back where none fits,
never trying a dead place twice. Compatibility of a pair is decided once by merging
its few bytes and remembered. A pre-token that is itself a token is that token.

Text is cut at single spaces between other characters, where the split pattern
always cuts; recently seen runs are remembered in two generations of bounded
size, so memory does not grow with the vocabulary of the corpus. The runs of a batch
that are not remembered are split together.

That holds for vocabularies in which every token is made by merges of lower rank,
as training leaves them; with any other one every pre-token is merged pair by
pair, which gives the same ids more slowly.

Defined cases: null and empty texts have no ids. Every byte string decodes to
itself. Very long texts are encoded pre-token by pre-token; a very long pre-token
takes memory in proportion to its length. Repeated rows and extra columns need
nothing special.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

_BUILT: dict[str, ByteBpe] = {}
_NEVER = 1 << 60
_UNASSIGNED = "\u0378"
#: Longer runs of text are encoded anew each time.
LONGEST_REMEMBERED = 64
#: Characters of a text that are cut into runs at a time.
PART_CHARS = 1 << 20
# A space between two characters that no reading takes for white space: what
# stands on either side of it is split alike with and without the other side.
_LOOSE = re.compile(r" \s|\s ")
_SAFE = re.compile(r"(?<=\S) (?=\S)")


def load_ranks(path: str) -> list[bytes]:
    """Tokens in rank order of a rank file (``base64 rank`` a line)."""
    pairs = [line.split() for line in open(path, "rb") if line.strip()]
    tokens = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


def merge(data: bytes, ranks: dict[bytes, int], until: int = 1) -> list[bytes]:
    """Merge neighbours by rank, leftmost first, until ``until`` parts are left or
    none can be merged: the definition of the encoding."""
    parts = [data[i:i + 1] for i in range(len(data))]
    while len(parts) > until:
        best, at = min((ranks.get(a + b, _NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if best == _NEVER:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts


def last_merges(tokens: list[bytes]) -> list[int]:
    """For each token the length of the left part of its last merge; 0 for a single
    byte, -1 for a token that merges of lower rank do not make."""
    ranks, out = {t: i for i, t in enumerate(tokens)}, []
    for i, t in enumerate(tokens):
        parts = merge(t, ranks, 2)
        whole = len(parts) == 2 and ranks.get(parts[0] + parts[1]) == i and max(ranks[x] for x in parts) < i
        out.append(0 if len(t) == 1 else len(parts[0]) if whole else -1)
    return out


# Letters and numbers that Unicode has only since version 17, as ranges of code
# points. The tokenizer library's tables end with version 16 and take them for other signs;
# ``regex`` may know them. A string here is "first-last" or one code point.
NEWER_LETTERS = """
558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 10EC5-10EC7
10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF6 187F8-187FF
18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96
1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD
323B0-33479 3D000-3FC3F
"""


def unknown_letters() -> str:
    """The characters of NEWER_LETTERS."""
    ranges = (x.split("-") for x in NEWER_LETTERS.split())
    return "".join(chr(c) for r in ranges for c in range(int(r[0], 16), int(r[-1], 16) + 1))


def _is_text(token: bytes) -> bool:
    try:
        token.decode()
    except UnicodeDecodeError:
        return False
    return True


class ByteBpe:
    """Encoder and decoder for one vocabulary and split pattern."""

    def __init__(self, tokens: list[bytes], pattern: str, left: list[int] | None = None, unknown: str = "",
                 remember: int = 250_000, pairs: int = 500_000):
        self.tokens = tokens
        self.ranks = {t: i for i, t in enumerate(tokens)}
        self.left = last_merges(tokens) if left is None else left
        self.find = regex.compile(pattern).findall
        self.unknown = dict.fromkeys(map(ord, unknown), _UNASSIGNED)
        self.unknown_set = frozenset(unknown)
        self.remember, self.max_pairs = remember, pairs
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}
        self.shorter = [-2] * len(tokens)  # -2: not looked up yet
        self.spines: tuple[dict, dict] = ({}, {})
        self.automaton = ahocorasick.Automaton()
        self.proper = min(self.left, default=0) >= 0
        for i, t in enumerate(tokens):
            self.automaton.add_word(t.decode("latin-1"), i)
        self.lengths = [len(t) for t in tokens]
        self.most = max(self.lengths, default=0)
        self.latin = {t.decode("latin-1"): i for i, t in enumerate(tokens)}
        self.whole = {t.decode(): struct.pack("<I", i) for i, t in enumerate(tokens) if _is_text(t)}

    def _spine(self, token: int, right: int) -> tuple[list[bytes], list[int]]:
        """The parts at one edge of a token while it is merged, smallest first, and
        the rank at which each grows into the next."""
        known = self.spines[right].get(token)
        if known is None:
            parts = [self.tokens[token]]
            while (n := self.left[self.ranks[parts[-1]]]) > 0:
                parts.append(parts[-1][n:] if right else parts[-1][:n])
            parts.reverse()
            known = self.spines[right][token] = parts, [*(self.ranks[x] for x in parts[1:]), _NEVER]
        return known

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging the joint bytes of two tokens gives just them: as both are
        merged in order of rank, no merge across the edge may come first."""
        key = a << 32 | b
        known = self.pairs.get(key)
        if known is not None:
            return known
        xs, grow_x = self._spine(a, 1)
        ys, grow_y = self._spine(b, 0)
        i = j = 0
        while True:
            across, nx, ny = self.ranks.get(xs[i] + ys[j], _NEVER), grow_x[i], grow_y[j]
            if across < nx and across <= ny:  # of equal ranks the leftmost goes first
                known = False
                break
            if nx == ny == _NEVER:
                known = True
                break
            if nx <= ny:
                i += 1
            else:
                j += 1
        if len(self.pairs) >= self.max_pairs:
            self.pairs.clear()
        self.pairs[key] = known
        return known

    def next_shorter(self, text: str) -> int:
        """The longest other token that starts the token ``text``; -1 if there is none."""
        token, found = self.latin[text], -1
        for n in range(len(text) - 1, 0, -1):
            found = self.latin.get(text[:n], -1)
            if found >= 0:
                break
        self.shorter[token] = found
        return found

    def _walk(self, text: str) -> list[int]:
        """Ids of one pre-token (mapped to Latin-1)."""
        lengths, pairs, shorter, out = self.lengths, self.pairs, self.shorter, []
        reach, find, most = self.automaton.longest_prefix, self.latin.get, self.most
        dead: set[int] = set()
        at, before, stop, token = 0, -1, len(text), -2
        while at < stop:
            if token == -2:  # the longest token here: on the way to where the trie ends
                rest = text[at:at + most]
                n = reach(rest)
                token = find(rest[:n], -1)
                while token < 0 and n > 1:
                    n -= 1
                    token = find(rest[:n], -1)
            while token >= 0:
                end = at + lengths[token]
                if end not in dead:
                    if before < 0:
                        break
                    fits = pairs.get(before << 32 | token)
                    if fits or fits is None and self.compatible(before, token):
                        break
                token = shorter[token]
                if token == -2:
                    token = self.next_shorter(text[at:end])
            if token >= 0:
                out.append(token)
                before, at, token = token, end, -2
            elif before < 0:
                raise ValueError("the vocabulary lacks a byte")
            else:
                dead.add(at)
                at -= lengths[out.pop()]
                token = shorter[before]
                if token == -2:
                    token = self.next_shorter(text[at:at + lengths[before]])
                before = out[-1] if out else -1
        return out

    def encode_piece(self, data: bytes) -> list[int]:
        """Ids of one pre-token."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        if not self.proper:
            return [self.ranks[x] for x in merge(data, self.ranks)]
        return self._walk(data.decode("latin-1"))

    def split(self, text: str) -> list[str]:
        """Pre-tokens of a text."""
        if text.isascii() or self.unknown_set.isdisjoint(text):
            return self.find(text)
        ends = list(accumulate(map(len, self.find(text.translate(self.unknown)))))
        return [text[a:b] for a, b in zip([0, *ends], ends)]

    def _packed(self, pieces: list[str]) -> list[bytes]:
        """Ids of each of many pre-tokens; each distinct one is encoded once."""
        known, whole, encode = {}, self.whole.get, self.encode_piece
        recent, older = self.recent.get, self.older.get
        for p in set(pieces):
            ids = whole(p)
            if ids is None and p[0] == " ":  # a remembered run may be this one pre-token
                ids = recent(p[1:]) or older(p[1:])
            if ids is None:
                got = encode(p.encode())
                ids = struct.pack(f"<{len(got)}I", *got)
            known[p] = ids
        return [known[p] for p in pieces]

    def _encode_runs(self, runs: list[str]) -> dict[str, bytes]:
        """Ids of runs of text, each with a space before it."""
        loose = [r for r in runs if r[-1:].isspace()]  # what follows would change how they are split
        runs = [r for r in runs if not r[-1:].isspace()]
        out = {r: b"".join(self._packed(self.split(" " + r))) for r in loose}
        if runs:
            pieces = self.split(" " + " ".join(runs))
            ends = np.searchsorted(np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces))),
                                   np.cumsum(np.fromiter(map(len, runs), np.int64, len(runs)) + 1)).tolist()
            ids, at = self._packed(pieces), 0
            for run, last in zip(runs, ends):
                out[run] = ids[at] if at == last else b"".join(ids[at:last + 1])
                at = last + 1
        return out

    def _known(self, runs: set[str]) -> dict[str, bytes]:
        """A table that holds the ids of all of ``runs``. Short ones are remembered: the newest
        in ``recent``, those before it in ``older``, from where used ones come back."""
        new = runs.difference(self.recent)
        if not new:
            return self.recent
        short = [r for r in new if len(r) <= LONGEST_REMEMBERED]
        if len(self.recent) + len(short) > self.remember:
            self.older, self.recent = self.recent, {}
            new, short = runs, [r for r in runs if len(r) <= LONGEST_REMEMBERED]
        for run in self.older.keys() & short:
            self.recent[run] = self.older[run]
        self.recent |= self._encode_runs([r for r in short if r not in self.recent])
        if len(short) == len(new):
            return self.recent
        return {r: self.recent[r] for r in runs if r in self.recent} | self._encode_runs([r for r in new if len(r) > LONGEST_REMEMBERED])

    def _runs(self, text: str):
        """Lists of runs of a text, cut at safe spaces; only the very first run has no space before it."""
        at = 0
        while len(text) - at > PART_CHARS and (cut := _SAFE.search(text, at + PART_CHARS)):
            yield _SAFE.split(text[at:cut.start()])
            at = cut.end()
        text = text[at:] if at else text
        tight = text[0] != " " != text[-1] and not _LOOSE.search(text)
        yield text.split(" ") if tight else _SAFE.split(text)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of texts as little-endian unsigned 32-bit integers."""
        out: list[list[bytes]] = [[] for _ in texts]
        waiting: list[tuple[int, list[str]]] = []
        held = 0

        def flush():
            known = self._known(set().union(*(runs for _, runs in waiting)))
            for i, runs in waiting:
                out[i] += map(known.__getitem__, runs)
            waiting.clear()

        for i, text in enumerate(texts):
            if not text:
                continue
            for part, runs in enumerate(self._runs(text)):
                if part == 0:
                    out[i].append(b"".join(self._packed(self.split(runs[0]))))
                    runs = runs[1:]
                for k in range(0, len(runs), self.remember):
                    block = runs[k:k + self.remember]
                    if held + len(block) > self.remember:
                        flush()
                        held = 0
                    waiting.append((i, block))
                    held += len(block)
        flush()
        return [b"".join(parts) for parts in out]

    def encode(self, text: str) -> bytes:
        """The ids of one text."""
        return self.encode_all([text])[0]

    def decode(self, ids: bytes) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[i] for i in memoryview(ids).cast("I")])


def _coder(*made_of) -> ByteBpe:
    """One encoder a worker process, vocabulary and pattern."""
    key = hashlib.sha256(repr(made_of).encode()).hexdigest()
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = ByteBpe(*made_of)
    return _BUILT[key]


def encode_documents(docs: DataFrame, vocabulary: str, pattern: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, ids`` (little-endian unsigned 32-bit integers) of every text."""
    return _apply(docs, vocabulary, pattern, id_column, text_column, "ids binary",
                  lambda coder, ids: (ids,))


def round_trip(docs: DataFrame, vocabulary: str, pattern: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Encode every text and decode its ids: ``n_tokens, ids_sha256, decoded_sha256``."""
    def digest(coder, ids):
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(coder.decode(ids)).hexdigest()

    return _apply(docs, vocabulary, pattern, id_column, text_column, "n_tokens long, ids_sha256 string, decoded_sha256 string", digest)


def _apply(docs, vocabulary, pattern, id_column, text_column, fields, fn) -> DataFrame:
    tokens = load_ranks(vocabulary)  # about 1 MB, read on the driver and sent with the function
    made_of = tokens, pattern, last_merges(tokens), unknown_letters()
    id_type = docs.schema[id_column].dataType.simpleString()
    kinds = {"binary": pa.binary(), "long": pa.int64(), "string": pa.string()}
    names = [f.split()[0] for f in fields.split(", ")]
    types = [kinds[f.split()[1]] for f in fields.split(", ")]

    def run(batches):
        coder = _coder(*made_of)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                texts = [t or "" for t in part.column(1).to_pylist()]
                rows = [fn(coder, ids) for ids in coder.encode_all(texts)]
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, k) for c, k in zip(zip(*rows), types, strict=True))], names=["doc_id", *names])

    return docs.select(id_column, text_column).mapInArrow(run, f"doc_id {id_type}, {fields}")
