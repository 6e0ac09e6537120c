"""Plain versions of the operators' results, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np


def digest(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def joined(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in sorted(spans))


def secret_spans(text):
    """Strong spans as (start, place, kind, end)."""
    text = text or ""
    rules = [
        ("assign", r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"
         r"|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 1, 6),
        ("access", r"AKIA[A-Z0-9]+", 0, 20),
        ("hex", r"[0-9a-f]+", 0, 24),
    ]
    return [
        (m.start(), i, kind, m.end())
        for i, (kind, pattern, group, least) in enumerate(rules)
        for m in re.finditer(pattern, text)
        if len(m[group]) >= least
    ]


def luhn(digits):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def pii_spans(text):
    text = text or ""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, "email", m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, "ip", m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, "card", m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, "phone", m.end()))
    return out


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text):
    found = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words(text)]
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4)))


def groups(n, linked):
    """For each of n items the smallest one reachable."""
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(n)]


def jaccard_components(rows):
    """`rows` of (id, text) to {id: (n, component id)}, for distinct ids."""
    sets = [shingles(t) for _, t in rows]

    def linked(i, j):
        a, b = sets[i], sets[j]
        common = len(a & b)
        return bool(a) and bool(b) and 100 * common >= 80 * (len(a) + len(b) - common)

    root = groups(len(rows), linked)
    least = {}
    for (doc, _), r in zip(rows, root):
        least[r] = min(least.get(r, doc), doc)
    return {doc: (len(s), least[r]) for (doc, _), s, r in zip(rows, sets, root)}


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Targets by source, filling up until no source is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped = set()
    total = share * sum(sizes.values())
    while True:
        free = [s for s in names if s not in capped]
        rest = total - sum(most * sizes[s] for s in capped)
        each = rest / sum(weight[s] for s in free) if free else 0.0
        over = [s for s in free if weight[s] * each >= most * sizes[s]]
        if not over:
            return {s: most * sizes[s] if s in capped else weight[s] * each for s in names}
        capped |= set(over)


def crc(text):
    return zlib.crc32((text or "").encode("utf-8"))


def usable(vector):
    return vector is not None and len(vector) > 0 and bool(np.isfinite(np.array(vector, float)).all()) and any(vector)


def gear_chunks(text):
    """Chunks as (bytes, start, end in characters), by the definition, byte by byte: cuts where the
    top six bits of the gear hash are zero, 32 bytes after the last cut at the earliest."""
    gear = [int(g) for g in np.random.default_rng(7).integers(0, 2**32, 256, dtype=np.uint32)]
    raw, ends, last, h = (text or "").encode("utf-8"), [], 0, 0
    for i, b in enumerate(raw):
        h = (2 * h + gear[b]) % 2**32
        if h >> 26 == 0 and i + 1 - last >= 32:
            ends.append(i + 1)
            last = i + 1
    if last < len(raw):
        ends.append(len(raw))
    starts = [0, *ends[:-1]]
    # A character whose bytes a cut parts counts to the chunk that holds its first byte.
    upto = [0]
    for b in raw:
        upto.append(upto[-1] + (b & 0xC0 != 0x80))
    return [(raw[a:b], upto[a], upto[b]) for a, b in zip(starts, ends)]


def repeated_runs(rows, least=150):
    """`rows` of (id, text) to (chunks, repeated, repeated characters, removable ones, spans) of each,
    ordered by id and place. A chunk counts where another row holds it too."""
    cut = [gear_chunks(t) for _, t in rows]
    holders, first = {}, {}
    for i in sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, i)):
        for raw, start, _ in cut[i]:
            holders.setdefault(raw, set()).add(i)
            first.setdefault(raw, (i, start))
    out = []
    for i, chunks in enumerate(cut):
        runs = []
        for raw, start, end in chunks:
            if len(holders[raw]) > 1:
                later = 0 if first[raw] == (i, start) else end - start
                if runs and runs[-1][1] == start:
                    runs[-1] = (runs[-1][0], end, runs[-1][2] + 1, runs[-1][3] + later)
                else:
                    runs.append((start, end, 1, later))
        runs = [r for r in runs if r[1] - r[0] >= least]
        out.append((len(chunks), sum(r[2] for r in runs), sum(r[1] - r[0] for r in runs), sum(r[3] for r in runs), [r[:2] for r in runs]))
    return out
