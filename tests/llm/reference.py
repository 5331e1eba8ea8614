"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def shingle_set(text: str | None) -> frozenset:
    w = words((text or "").translate(LOWER))
    if len(w) >= 4:
        return frozenset(tuple(w[i : i + 4]) for i in range(len(w) - 3))
    return frozenset([tuple(w)] if w else [])


def near_duplicate_groups(docs: list[tuple]) -> list[tuple]:
    """(doc_id, n_shingles, component_id) per row of (doc_id, text)."""
    sets = [shingle_set(t) for _, t in docs]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        common = defaultdict(int)
        for g in s:
            for j in holders[g]:
                common[j] += 1
            holders[g].append(i)
        for j, k in common.items():
            if 100 * k >= 85 * (len(s) + len(sets[j]) - k):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return [(d, len(sets[i]), least.get(find(i), d) if sets[i] else d) for i, (d, _) in enumerate(docs)]


def covered(tokens, width: int, doc_id, first: dict) -> list[bool]:
    mask = [False] * len(tokens)
    for k in range(len(tokens) - width + 1):
        if doc_id is not None and first[tokens[k : k + width]] < doc_id:
            mask[k : k + width] = [True] * width
    return mask


def first_holders(docs, width: int) -> dict:
    first = {}
    for doc_id, tokens in docs:
        for k in range(len(tokens) - width + 1):
            key = tokens[k : k + width]
            if doc_id is not None:
                first[key] = min(first.get(key, doc_id), doc_id)
    return first


def repeated_words(docs: list[tuple]) -> list[tuple]:
    rows = [(d, tuple(words(t))) for d, t in docs]
    first = first_holders(rows, 50)
    out = []
    for d, w in rows:
        gone = covered(w, 50, d, first)
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((d, len(w), sum(gone), sha(" ".join(kept).encode())))
    return out


def repeated_bytes(docs: list[tuple]) -> list[tuple]:
    rows = [(d, (t or "").encode()) for d, t in docs]
    first = first_holders(rows, 50)
    out = []
    for d, b in rows:
        gone = covered(b, 50, d, first)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((d, len(b), sum(gone), runs, sha(kept)))
    return out


def quality_base(text: str | None) -> tuple:
    t = text or ""
    w = words(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    places = defaultdict(list)
    for i in range(len(w) - 2):
        places[tuple(w[i : i + 3])].append(i)
    repeated = {i + k for v in places.values() if len(v) > 1 for i in v for k in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in t)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(repeated)
