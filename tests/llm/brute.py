"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import collections
import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text, lower=False):
    text = text or ""
    return WORD.findall(text.translate(LOWER) if lower else text)


def shingles(held, width):
    if len(held) >= width:
        return [tuple(held[i : i + width]) for i in range(len(held) - width + 1)]
    return [tuple(held)] if held else []


def classes(docs, width, percent):
    """{id: (size of the set, least linked id)} by comparing all pairs."""
    sets = {i: set(shingles(words(t, True), width)) for i, t in docs}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                shared = len(sets[a] & sets[b])
                if 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                    low, high = sorted((root(a), root(b)))
                    parent[high] = low
    return {i: (len(sets[i]), root(i)) for i in ids}


def without_repeats(docs, width):
    """{id: (words, removed, kept text)}."""
    first = {}
    held = {i: words(t) for i, t in docs}
    for i in sorted(held):
        for at in range(len(held[i]) - width + 1):
            first.setdefault(tuple(held[i][at : at + width]), i)
    out = {}
    for i, w in held.items():
        gone = set()
        for at in range(len(w) - width + 1):
            if first[tuple(w[at : at + width])] < i:
                gone.update(range(at, at + width))
        out[i] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return out


def contaminated(docs, items, width=5, threshold=0.8):
    """{(doc, item): best similarity of a window as long as the item}."""
    out = {}
    for item, item_text in items:
        held = words(item_text, True)
        if len(held) < width:
            continue
        wanted = collections.Counter(shingles(held, width))
        for doc, text in docs:
            w = words(text, True)
            best = 0.0
            for at in range(max(1, len(w) - len(held) + 1)):
                window = w[at : at + len(held)]
                if len(window) < width:
                    continue
                found = collections.Counter(shingles(window, width))
                shared = sum((found & wanted).values())
                best = max(best, shared / (sum(found.values()) + sum(wanted.values()) - shared))
            if best >= threshold:
                out[doc, item] = max(best, out.get((doc, item), 0))
    return out


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _counts(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and _luhn(digits)
    if kind == "phone":
        return 10 <= len(digits) <= 15
    return True


def personal(text):
    """kind:start:end of all base entities, joined by commas."""
    spans = []
    for i, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            if _counts(kind, m.group()):
                spans.append((m.start(), i, m.end(), kind))
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(spans))


def targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Targets of {source: size}: caps are shared out again until none is above."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode())
    order += [None] if None in sizes else []
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), set(sizes), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        stop = {s for s in open_ if weight[s] * level >= most * sizes[s]}
        if not stop:
            out |= {s: weight[s] * level for s in open_}
            break
        out |= {s: most * sizes[s] for s in stop}
        left -= sum(most * sizes[s] for s in stop)
        open_ -= stop
    return out


def highest_quotients(claims, seats):
    """Sainte-Laguë by handing out one seat after the other."""
    won = [0] * len(claims)
    for _ in range(seats):
        best = max(range(len(claims)), key=lambda i: (claims[i] / (won[i] + 0.5), -i))
        won[best] += 1
    return won


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
