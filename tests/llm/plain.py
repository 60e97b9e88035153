"""Plain versions of the text operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import xxhash

PATTERNS = (
    ("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
)


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def secrets(text: str | None) -> list[tuple[int, int, int]]:
    """start, kind, end of the fixed patterns' matches."""
    return sorted(
        (m.start(), kind, m.end())
        for kind, (_, pattern, group, least) in enumerate(PATTERNS)
        for m in pattern.finditer(text or "")
        if len(m.group(group)) >= least
    )


def without_repeats(texts: list[str | None], span: int) -> list[tuple[int, int, int, str]]:
    """n_bytes, n_removed, n_spans, kept_sha256 of each text."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + span] for d in data for i in range(len(d) - span + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - span + 1):
            if seen[d[i : i + span]] > 1:
                gone[i : i + span] = True
        runs = int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())
        kept = np.frombuffer(d, np.uint8)[~gone].tobytes()
        out.append((len(d), int(gone.sum()), runs, sha(kept)))
    return out


_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {i: i + 32 for i in range(65, 91)}


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").translate(_LOWER))


def contamination(
    texts: list[str | None], items: list[tuple[object, str | None]], span: int = 13
) -> list[tuple[int, int, int, str, bool]]:
    """n_words, n_hit, n_items, items_sha256, contaminated of each text."""
    wanted: dict[tuple[str, ...], set[str]] = {}
    for item, text in items:
        w = words(text)
        size = min(span, len(w))
        if size:
            for i in range(len(w) - size + 1):
                wanted.setdefault(tuple(w[i : i + size]), set()).add(str(item))
    sizes = {len(k) for k in wanted}
    out = []
    for text in texts:
        w = words(text)
        hit, found = [False] * len(w), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if named := wanted.get(tuple(w[i : i + size])):
                    found |= named
                    hit[i : i + size] = [True] * size
        n = sum(hit)
        out.append((len(w), n, len(found), sha(",".join(sorted(found))), n > 0 and 20 * n >= len(w)))
    return out


def simhash(text: str | None) -> int:
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_LOWER))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints: list[int], ids: list[int], radius: int = 3) -> list[int]:
    """Smallest id reachable from each row."""
    bits = np.array(prints, np.uint64)
    best = np.array(ids)
    near = [np.flatnonzero(np.bitwise_count(bits ^ b) <= radius) for b in bits]
    while True:
        new = np.array([best[n].min() for n in near])
        if (new == best).all():
            return best.tolist()
        best = new
