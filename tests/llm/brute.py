"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re

WHITE = r"[\x20\x09-\x0D]+"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def exact(rows):
    """rows: (doc_id, text) -> {(doc_id, text): (keep_id, size, kept, sha)}"""
    groups: dict = {}
    for i, t in rows:
        groups.setdefault(re.sub(WHITE, "", t or ""), []).append((i, t or ""))
    out = {}
    for norm, members in groups.items():
        keep = min(members, key=lambda m: (-len(m[1]), m[0]))
        for m in members:
            out[m] = (keep[0], len(members), m[0] == keep[0] and len(m[1]) == len(keep[1]),
                      sha(norm))
    return out


def line_dedup(rows, width=3):
    """rows: (doc_id, text) in order of first occurrence -> list of texts"""
    seen, out = set(), []
    for _, text in rows:
        if text is None:
            out.append(None)
            continue
        lines = text.split("\n")
        gone: set = set()
        for p in range(len(lines) - width + 1):
            w = tuple(lines[p:p + width])
            if w in seen:
                gone.update(range(p, p + width))
            seen.add(w)
        out.append("\n".join(x for i, x in enumerate(lines) if i not in gone))
    return out


def words(text):
    return [w for w in re.split(WHITE, re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
            if w]


def shingles(text, k):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1)))


def near(rows, k, percent=80):
    """rows: (doc_id, text), distinct ids -> {doc_id: (n, component)}"""
    sets = [(i, shingles(t, k)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                p, q = find(i), find(j)
                parent[max(p, q)] = min(p, q)
    return {i: (len(a), find(i)) for i, a in sets}


def secret_spans(text):
    """Base spans: (start, kind, end), by start then kind."""
    text, out = text or "", []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                         r"""([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m.group(2)) >= 6:
            out.append((m.start(), 0, m.end(), "assign"))
    for m in re.finditer(r"AKIA[A-Z0-9]+", text):
        if len(m.group()) >= 20:
            out.append((m.start(), 1, m.end(), "access"))
    for m in re.finditer(r"[0-9a-f]+", text):
        if len(m.group()) >= 24:
            out.append((m.start(), 2, m.end(), "hex"))
    return [f"{k}:{s}:{e}" for s, _, e, k in sorted(out)]
