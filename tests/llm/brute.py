"""Plain-Python versions of the operators' contracts."""

import collections
import hashlib
import re
import string

UPPER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text, size=2):
    w = words((text or "").translate(UPPER))
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < size else frozenset(zip(*(w[k:] for k in range(size))))


def components(rows, size=2, percent=80):
    """Per row: number of shingles and smallest id reachable (rows are vertices)."""
    sets = [shingles(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = collections.defaultdict(list)
    for i, s in enumerate(sets):
        shared = collections.Counter(j for g in s for j in holders[g])
        for j, both in shared.items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                root[find(i)] = find(j)
        for g in s:
            holders[g].append(i)
    members = collections.defaultdict(list)
    for i in range(len(rows)):
        members[find(i)].append(rows[i][0])
    least = {r: min((x for x in ids if x is not None), default=None) for r, ids in members.items()}
    return [(len(sets[i]), least[find(i)], find(i)) for i in range(len(rows))]


def line_dedup(rows, min_chars=20, min_docs=3):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(UPPER)
    held = collections.defaultdict(list)
    for i, t in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            if len(k) >= min_chars:
                held[k].append(i)
    keeper = {k: max((i for i in v if i is not None), default=None) for k, v in held.items() if len(v) >= min_docs}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in keeper or keeper[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def quality(text):
    w, lines = words(text), [x for x in (text or "").split("\n") if words(x)]
    seen = collections.Counter(zip(w, w[1:], w[2:]))
    covered = {k for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for k in (i, i + 1, i + 2)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered),
            len(w) < 50 or 100 * len(covered) > 50 * len(w))


def bench_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def contamination(docs, items, size=13):
    windows = collections.defaultdict(set)
    for i, t in items:
        w = bench_words(t)
        for k in range(max(1, len(w) - size + 1)):
            if w:
                windows[tuple(w[k:k + size])].add(i)
    sizes, out = {len(x) for x in windows}, []
    for i, t in docs:
        w, hit, found = bench_words(t), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (items_here := windows.get(tuple(w[k:k + n]))) is not None:
                    hit.update(range(k, k + n))
                    found |= items_here
        ids = sorted(str(x) for x in found if x is not None)
        out.append((i, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return out
