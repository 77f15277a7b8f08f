"""Plain single-process versions of the operators, written from their contracts."""

import hashlib
import re
import zlib

BASE_RULES = [
    ("assign", re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII),
     lambda m: len(m.group(1)) >= 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m.group()) >= 20),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m.group()) >= 24),
]
LOWER = {c: c + 32 for c in range(65, 91)}


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def held_out(doc_id) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def contamination_rows(docs, items, size=13):
    spans = {}
    for item_id, text in items:
        words = item_words(text)
        n = min(size, len(words))
        for k in range(len(words) - n + 1 if n else 0):
            spans.setdefault(tuple(words[k : k + n]), set()).add(str(item_id))
    sizes = {len(s) for s in spans}
    rows = []
    for doc_id, text in docs:
        words, hit, found = item_words(text), set(), set()
        for n in sizes:
            for k in range(len(words) - n + 1):
                own = spans.get(tuple(words[k : k + n]))
                if own:
                    hit.update(range(k, k + n))
                    found |= own
        rows.append((doc_id, len(words), len(hit), len(found), digest(",".join(sorted(found))), bool(hit) and 20 * len(hit) >= len(words)))
    return rows


def secret_row(doc_id, text):
    found = [[(m.start(), k, m.end()) for m in rx.finditer(text or "") if good(m)] for k, (_, rx, good) in enumerate(BASE_RULES)]
    base = sorted(s for own in found for s in own)
    said = ",".join(f"{BASE_RULES[k][0]}:{a}:{b}" for a, k, b in base)
    return (doc_id, *map(len, found), digest(said))


def substring_rows(docs, size=50):
    """docs: (doc_id, text). Rows (doc_id, n_words, n_removed, kept_sha256)."""
    words = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in docs]
    first: dict[tuple, int] = {}
    for d, own in sorted((w for w in words if w[0] is not None), key=lambda w: w[0]):
        for k in range(len(own) - size + 1):
            first.setdefault(tuple(own[k : k + size]), d)
    rows = []
    for d, own in words:
        gone = set()
        for k in range(len(own) - size + 1 if d is not None else 0):
            if first[tuple(own[k : k + size])] < d:
                gone.update(range(k, k + size))
        rows.append((d, len(own), len(gone), digest(" ".join(w for k, w in enumerate(own) if k not in gone))))
    return rows


def shingle_set(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    n = min(size, len(words))
    return {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if n else set()


def near_rows(docs, size=2, percent=80):
    """Rows (doc_id, n_shingles, component_id)."""
    sets = [(d, shingle_set(t, size)) for d, t in docs]
    parent = {d: d for d, _ in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            both = len(x & y)
            if both and 100 * both >= percent * (len(x) + len(y) - both):
                p, q = sorted((root(a), root(b)))
                parent[q] = p
    return [(d, len(s), root(d)) for d, s in sets]


def nearest_rows(rows, top=20, every=20):
    """rows: (vec_id, vector). {query_id: [(vec_id, score)]} in exact order."""
    import numpy as np

    good = [(i, np.asarray(v, dtype=np.float64)) for i, v in rows if i is not None and v and None not in v]
    good = [(i, v) for i, v in good if np.isfinite(v).all() and v.any()]
    return {i: sorted(((j, float(v @ w)) for j, w in good if j != i), key=lambda x: (-x[1], x[0]))[:top] for i, v in good if i % every == 0}


def audit_rows(docs, labels):
    """docs: (doc_id, text, source); labels: (doc_id, quality, toxic). Rows of the audit, every order played through."""
    from collections import defaultdict
    from itertools import permutations

    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    least = {}
    for d, t, _ in docs:
        if d is not None:
            least[t or ""] = min(least.get(t or "", d), d)
    parts = defaultdict(list)
    for d, t, s in docs:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
                 "D": bool(re.search(r"[#$%&*|]", t)), "E": d is not None and least[t] < d}
        parts[s or ""].append(({f for f, x in fails.items() if x}, d in good, d in toxic))
    rows = []
    for part, own in parts.items():
        played, total = [], defaultdict(int)
        for order in permutations("ABCDE"):
            left = list(own)
            for step, f in enumerate(order, start=1):
                out = [x for x in left if f in x[0]]
                left = [x for x in left if f not in x[0]]
                total[f] += len(out)
                played.append((f, (part, "".join(order), step, len(left), len(out), sum(f in x[0] for x in own) - len(out),
                                   sum(x[0] == {f} for x in own), sum(x[1] for x in out), sum(x[2] for x in out))))
        rows += [(*r, total[f]) for f, r in played]
    return rows


def line_rows(docs, chars=20, docs_each=3):
    """docs: (doc_id, text). Rows (doc_id, n_lines, n_dropped, kept_sha256)."""
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    rank = lambda d: float("-inf") if d is None else d
    holders = {}
    for d, t in docs:
        for line in (t or "").split("\n"):
            if len(key(line)) >= chars:
                holders.setdefault(key(line), set()).add(rank(d))
    rows = []
    for d, t in docs:
        lines = (t or "").split("\n")
        keep = [x for x in lines if len(holders.get(key(x), ())) < docs_each or rank(d) == max(holders[key(x)])]
        rows.append((d, len(lines), len(lines) - len(keep), digest("\n".join(keep))))
    return rows


def code_rows(rows, entries=64, rounds=2):
    """rows: (vec_id, vector, label). Rows (vec_id, code, error, label_error, codebooks_sha256), all in Python's integers."""
    import math
    from fractions import Fraction

    good = [(i, [math.floor(256 * Fraction(x)) for x in v], lab) for i, v, lab in rows
            if v is not None and None not in v and all(math.isfinite(x) for x in v)]
    if not any(i is not None for i, _, _ in good):
        return []
    width = -(-max(1, max(len(v) for _, v, _ in good)) // 16) * 16
    size = width // 16
    start = {}
    for i, v, _ in sorted((r for r in good if r[0] is not None), key=lambda r: (r[0], ",".join(map(str, r[1])))):
        start.setdefault(i, v)
    cut = lambda v: [(v + [0] * (width - len(v)))[k * size : (k + 1) * size] for k in range(16)]
    books = [list(b) for b in zip(*[cut(start[i]) for i in sorted(start)[:entries]], strict=True)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda p, k: min(range(len(books[k])), key=lambda e: far(p, books[k][e]))
    for _ in range(rounds):
        held = {}
        for _, v, _ in good:
            for k, p in enumerate(cut(v)):
                held.setdefault((k, near(p, k)), []).append(p)
        for (k, e), own in held.items():
            books[k][e] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    said = digest(",".join(str(x) for book in books for entry in book for x in entry))
    found = [(i, [near(p, k) for k, p in enumerate(cut(v))], cut(v), lab) for i, v, lab in good]
    found = [(i, "".join(f"{e:02x}" for e in es), sum(far(p, books[k][e]) for k, (p, e) in enumerate(zip(ps, es, strict=True))), lab)
             for i, es, ps, lab in found]
    limit = lambda x: x if x < 2**63 else None
    by = {}
    for _, _, e, lab in found:
        if limit(e) is not None:
            by[lab] = by.get(lab, 0) + e
    return [(i, c, limit(e), limit(by[lab]) if lab in by else None, said) for i, c, e, lab in found]


def toxicity_score(model, text):
    """The subword bag, character by character: mean weight of a window's n-grams, then worst and mean window."""
    import math

    from palisade.llm import toxicity as t

    spaced = " " + "".join(c if c.isalnum() or ord(c) >= 0x3000 else " " for c in (text or "").lower()) + " "
    codes = [ord(c) for c in re.sub(" +", " ", spaced)]
    windows = {}
    for n in t.SIZES:
        for at in range(len(codes) - n + 1):
            gram = codes[at : at + n]
            if 32 in gram[1:-1]:
                continue
            h = gram[0]
            for c in gram[1:]:
                h = (h * 0x9E3779B1 + c) % 2**32
            h = (h ^ (h >> 15)) * 0x85EBCA6B % 2**32
            windows.setdefault(at // t.WINDOW_CHARS, []).append(float(model.table[(h ^ (h >> 13)) >> (32 - t.BITS)]))
    odds = [sum(w) / len(w) + model.bias for w in windows.values()] or [model.bias]
    a, b, c = model.combine
    return 1 / (1 + math.exp(-min(30, max(-30, a * max(odds) + b * sum(odds) / len(odds) + c))))
