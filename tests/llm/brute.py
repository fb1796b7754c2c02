"""Plain restatements of what the queries must return, one document at a time."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PROBE = "</s>[INST] ok [/INST]"


def crc(x) -> int:
    return zlib.crc32(str(x).encode())


def words(text) -> list[str]:
    return WORD.findall(text or "")


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def quality(text) -> dict:
    w, seen, hit = words(text), Counter(), set()
    for i in range(len(w) - 7):
        seen[tuple(w[i : i + 8])] += 1
    for i in range(len(w) - 7):
        if seen[tuple(w[i : i + 8])] > 1:
            hit.update(range(i, i + 8))
    lines = [x for x in (text or "").split("\n") if words(x)]
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(hit),
        "base_failed": len(w) < 20 or 100 * len(hit) > 30 * len(w),
    }


def targets(sizes: dict[object, int]) -> dict[object, float]:
    order = sorted((s for s in sizes if s is not None), key=lambda s: s) + [s for s in sizes if s is None]
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        rest, ws = total - sum(fixed.values()), sum(weight[s] for s in free)
        over = [s for s in free if rest * weight[s] / ws > 3 * sizes[s]]
        if not over:
            return fixed | {s: rest * weight[s] / ws for s in free}
        fixed |= {s: 3.0 * sizes[s] for s in over}


def shingles(text, k: int = 4) -> set:
    w = lower(text or "").split() if False else words(lower(text or ""))
    if not w:
        return set()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or {tuple(w)}


def linked(texts: dict[int, str | None], k: int = 4, percent: int = 85) -> dict[int, int]:
    """doc_id to the smallest doc_id reachable by links."""
    sets = {d: shingles(t, k) for d, t in texts.items()}
    holders = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            holders[x].append(d)
    parent = {d: d for d in texts}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for d, s in sets.items():
        shared = Counter(e for x in s for e in holders[x] if e < d)
        for e, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[e]) - n):
                a, b = root(d), root(e)
                parent[max(a, b)] = min(a, b)
    return {d: root(d) for d in texts}


ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contamination(docs: dict, items: dict) -> dict[int, tuple[int, int, list]]:
    """doc_id to (words, hit words, item ids)."""
    windows = defaultdict(set)
    for item, text in items.items():
        w = tuple(ALNUM.findall(lower(text or "")))
        for i in range(max(1, len(w) - 9) if w else 0):
            windows[w[i : i + 10]].add(item)
    sizes = {len(x) for x in windows}
    out = {}
    for d, text in docs.items():
        w, hit, found = tuple(ALNUM.findall(lower(text or ""))), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if got := windows.get(w[i : i + n]):
                    hit.update(range(i, i + n))
                    found |= got
        out[d] = (len(w), len(hit), sorted(map(str, found)))
    return out
