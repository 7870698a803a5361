"""The operators on small inputs in plain Python, straight from their definitions."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def shingles(text):
    found = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4)))


def jaccard_components(rows):
    """``(doc_id, text)`` rows to a list of ``(set size, component)`` per row."""
    sets = [shingles(text) for _, text in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        common = Counter(j for g in s for j in holders[g])
        for j, n in common.items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                parent[root(i)] = root(j)
        for g in s:
            holders[g].append(i)
    ids = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            ids[root(i)].append(doc)
    return [(len(s), min(ids[root(i)], default=rows[i][0])) for i, s in enumerate(sets)]


def rule_counts(text):
    found = words(text)
    windows = Counter(zip(found, found[1:], found[2:]))
    covered = {i + k for i in range(len(found) - 2) if windows[tuple(found[i : i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


def line_dedup(docs, min_lines=2):
    """``(doc_id, text)`` without repeated ids to ``{doc_id: (lines, removed, text)}``."""
    order = sorted(docs, key=lambda d: (d[0] is None, d[0]))
    filled = {d: [i for i, x in enumerate((t or "").split("\n")) if x.strip(" \t\x0b\x0c\r")] for d, t in order}
    seen, out = set(), {}
    for d, t in order:
        lines, places = (t or "").split("\n"), filled[d]
        gone = set()
        for k in range(len(places) - min_lines + 1):
            run = tuple(lines[i] for i in places[k : k + min_lines])
            if run in seen:
                gone |= set(places[k : k + min_lines])
            seen.add(run)
        kept = "\n".join(x for i, x in enumerate(lines) if i not in gone)
        out[d] = (len(places), len(gone), t if t is None else kept)
    return out


def suffix_dedup(docs, length=50):
    """``(doc_id, text)`` rows to ``{(doc_id, text): (bytes, removed, spans, digest)}``."""
    last = float("inf")
    keyed = [(last if d is None else d, (t or "").encode(), (d, t)) for d, t in docs]
    first = {}
    for d, b, _ in keyed:
        for k in range(len(b) - length + 1):
            first[b[k : k + length]] = min(first.get(b[k : k + length], last), d)
    out = {}
    for d, b, key in keyed:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if first[b[k : k + length]] < d:
                gone[k : k + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and (not k or not gone[k - 1]))
        out[key] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def luhn(text):
    digits = [int(c) for c in reversed(re.sub("[^0-9]", "", text))]
    if not 12 <= len(digits) <= 19:
        return False
    return sum(v if i % 2 == 0 else v * 2 - 9 * (v > 4) for i, v in enumerate(digits)) % 10 == 0


PII = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", luhn),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15),
)


def base_spans(text):
    found = [
        (m.start(), rank, f"{kind}:{m.start()}:{m.end()}")
        for rank, (kind, pattern, valid) in enumerate(PII)
        for m in re.finditer(pattern, text or "")
        if valid(m[0])
    ]
    return ",".join(x for _, _, x in sorted(found))
