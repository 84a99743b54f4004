"""Plain versions of the operators for small inputs."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def order(doc_id):
    return (doc_id is not None, doc_id or 0)


def substring_dedup(rows, window=20):
    first = {}
    split = [(i, WORD.findall(t or "")) for i, t in rows]
    for i, w in split:
        for p in range(len(w) - window + 1):
            k = tuple(w[p : p + window])
            first[k] = min(first.get(k, (order(i), p)), (order(i), p))
    out = []
    for i, w in split:
        gone = set()
        for p in range(len(w) - window + 1):
            if first[tuple(w[p : p + window])] < (order(i), p):
                gone.update(range(p, p + window))
        out.append((i, len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    return out


def suffix_dedup(rows, window=200):
    texts = [(i, (t or "").encode()) for i, t in rows]
    counts = Counter(b[p : p + window] for _, b in texts for p in range(len(b) - window + 1))
    out = []
    for i, b in texts:
        gone = set()
        for p in range(len(b) - window + 1):
            if counts[b[p : p + window]] > 1:
                gone.update(range(p, p + window))
        spans = sum(1 for k in gone if k - 1 not in gone)
        out.append((i, len(b), len(gone), spans, sha(bytes(x for k, x in enumerate(b) if k not in gone))))
    return out


def shingles(text, size=5):
    w = WORD.findall((text or "").translate(FOLD))
    if len(w) < size:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[p : p + size]) for p in range(len(w) - size + 1))


def jaccard(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    holders = defaultdict(list)
    for k, (_, s) in enumerate(sets):
        for x in s:
            holders[x].append(k)
    parent = list(range(len(sets)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for k, (_, s) in enumerate(sets):
        overlap = Counter(j for x in s for j in holders[x] if j < k)
        for j, o in overlap.items():
            if 100 * o >= 80 * (len(s) + len(sets[j][1]) - o):
                parent[root(k)] = root(j)
    least = {}
    for k, (i, _) in enumerate(sets):
        least[root(k)] = min(least.get(root(k), (order(i), i)), (order(i), i), key=lambda x: x[0])
    return [(i, len(s), least[root(k)][1]) for k, (i, s) in enumerate(sets)]


BENCH = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def decontam(rows, items, window=13):
    windows = defaultdict(set)
    for item, text in items:
        w = BENCH.findall((text or "").translate(FOLD))
        for p in range(max(1, len(w) - window + 1) if w else 0):
            windows[tuple(w[p : p + window])].add(str(item))
    sizes = {len(k) for k in windows}
    out = []
    for i, t in rows:
        w = BENCH.findall((t or "").translate(FOLD))
        hit, found = set(), set()
        for k in sizes:
            for p in range(len(w) - k + 1):
                if tuple(w[p : p + k]) in windows:
                    hit.update(range(p, p + k))
                    found |= windows[tuple(w[p : p + k])]
        out.append((i, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def base_rules(text):
    text = text or ""
    w = WORD.findall(text)
    counts = Counter(tuple(w[p : p + 5]) for p in range(len(w) - 4))
    again = set()
    for p in range(len(w) - 4):
        if counts[tuple(w[p : p + 5])] > 1:
            again.update(range(p, p + 5))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again), len(w) < 10 or 100 * len(again) > 20 * len(w))


def statistics(text):
    """The classifier's sixteen statistics of one text, from its words, bytes and lines."""
    import math

    raw = (text or "").encode()
    if not raw:
        return [0.0] * 16
    w = [x.encode() for x in WORD.findall(text)]
    n, solid = len(w), sum(map(len, w))
    letters, some = max(solid, 1), max(n, 1)
    of = lambda chars: sum(b in chars for b in raw)
    lines = text.split("\n")
    lines = lines[:-1] if lines[-1] == "" else lines
    triples = [tuple(w[k : k + 3]) for k in range(n - 2)]
    return [
        math.log1p(n), solid / some, of(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ") / letters, of(b"0123456789") / letters, of(b"#*$%&|<>@^~_=+{}[]\\/") / letters, of(b"!?") / letters, of(b".,;:") / some,
        len(lines) / some, sum(b > 127 for b in raw) / letters, len(set(w)) / math.sqrt(some), max(Counter(w).values(), default=0) / some, sum(a == b for a, b in zip(w, w[1:])) / some,
        1 - len(set(triples)) / len(triples) if triples else 0.0, 1 - len(set(lines)) / max(len(lines), 1), math.log1p(n / max(len(lines), 1)), sum(len(x) > 15 for x in w) / some,
    ]


def isotonic(n, good):
    """The nondecreasing fit to good / n by its min-max formula."""
    mean = lambda a, b: sum(good[a : b + 1]) / sum(n[a : b + 1])
    return [max(min(mean(a, b) for b in range(i, len(n))) for a in range(i + 1)) for i in range(len(n))]
