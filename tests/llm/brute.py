"""Plain Python versions of the operators' contracts, one text at a time."""

from __future__ import annotations

import hashlib
import re
import zlib

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    total = 0
    for i, x in enumerate(reversed(digits)):
        d = int(x) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def told(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def pii_row(text: str | None):
    spans = base_spans(text or "")
    n = [sum(k == kind for k, _, _ in spans) for kind in BASE]
    return (*n, hashlib.sha256(told(spans).encode()).hexdigest())


def shingles(text: str | None) -> frozenset:
    w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in WORDS.findall(text or "")]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def near_components(texts: dict[int, str | None]) -> dict[int, tuple[int, int]]:
    sets = {d: shingles(t) for d, t in texts.items()}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d: (len(sets[d]), root(d)) for d in ids}


def removed_rows(texts: dict[int, str | None], n: int = 50) -> dict[int, tuple]:
    first: dict[bytes, int] = {}
    out = {}
    for d in sorted(texts):
        b = (texts[d] or "").encode()
        covered = bytearray(len(b))
        new = []
        for i in range(len(b) - n + 1):
            w = b[i : i + n]
            if w in first:
                covered[i : i + n] = b"\1" * n
            else:
                new.append(w)
        for w in new:
            first[w] = d
        kept = bytes(x for x, c in zip(b, covered) if not c)
        spans = sum(c and not (i and covered[i - 1]) for i, c in enumerate(covered))
        out[d] = (len(b), sum(covered), spans, hashlib.sha256(kept).hexdigest())
    return out


def quality_row(text: str | None) -> tuple:
    t = text or ""
    w = WORDS.findall(t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORDS.search(line):
            dup += line in seen
            seen.add(line)
    grams: dict[tuple, list[int]] = {}
    for i in range(len(w) - 2):
        grams.setdefault(tuple(w[i : i + 3]), []).append(i)
    hit = {i + j for at in grams.values() if len(at) > 1 for i in at for j in range(3)}
    n = len(w)
    return n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(hit), n < 50 or 100 * len(hit) > 50 * n


def topk(vectors: dict[int, list], queries: list[int], k: int = 5) -> set[tuple]:
    import math

    good = {i: [math.floor(256 * float(x)) for x in v] for i, v in vectors.items() if v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = set()
    for q in queries:
        if q in good:
            s = sorted((-sum(a * b for a, b in zip(good[q], v)), i) for i, v in good.items() if i != q)[:k]
            out |= {(q, r + 1, i, -x) for r, (x, i) in enumerate(s)}
    return out


def crc(text: str) -> int:
    return zlib.crc32(text.encode())


def subsequence_kernel(a: str, b: str, decay: float, reach: int) -> float:
    """Kernel of two words of a-z by listing all their gapped subsequences of three letters, word ends included."""
    from collections import Counter
    from itertools import combinations

    def features(word: str) -> Counter:
        x, out = f"<{word}>", Counter()
        for i, j, k in combinations(range(len(x)), 3):
            if k - i < reach:
                out[x[i] + x[j] + x[k]] += decay ** (k - i + 1)
        return out

    def length(n: int) -> float:
        return sum(decay ** (2 * (k - i + 1)) for i, _, k in combinations(range(n), 3) if k - i < reach) ** 0.5

    f, g = features(a), features(b)
    return sum(v * g[s] for s, v in f.items()) / length(len(a) + 2) / length(len(b) + 2)


def hard_negatives(rows: list[tuple], every: int = 50, k: int = 5, m: int = 3) -> set[tuple]:
    """rows: (id, label, whole numbers)."""
    out = set()
    for a, label, v in rows:
        if a % every:
            continue
        s = sorted((-sum(x * y for x, y in zip(v, w)), i, o) for i, o, w in rows if i != a)
        for p, positive, _ in [x for x in s if x[2] == label][:k]:
            fits = [(n, i) for n, i, o in s if o != label and 50 * -p <= 100 * -n <= 95 * -p][:m]
            out |= {(a, positive, r, i, -p, -n) for r, (n, i) in enumerate(fits, 1)}
    return out


TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text: str | None) -> list[str]:
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERMS.findall(text or "")]


def lexical(docs: list[tuple], items: dict, k: int = 10) -> list[tuple]:
    """docs: (id, text) rows, items: text by id. (item, rank, doc, score), equal scores by ascending id, nulls last."""
    import math
    from collections import Counter

    held = [(d, Counter(terms(t))) for d, t in docs]
    n_docs = sum(bool(c) for _, c in held)
    length = sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items.items():
        asked, found = Counter(terms(text)), []
        for d, c in held:
            m = 25 + (75 * sum(c.values()) * n_docs) // max(1, length)
            s = sum(n * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t, n in asked.items() if c[t])
            if s > 0:
                found.append((-s, d is None, d))
        out += [(item, r, d, -s) for r, (s, _, d) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return out
