"""Plain definitions of what the operators compute, over Python lists."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import zlib


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


def fingerprint(text, shingle=3):
    import xxhash

    w = words(text)
    if not w:
        return 0
    parts = [" ".join(w[i:i + shingle]) for i in range(max(1, len(w) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64)
               if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, bits=2):
    """Smallest index-free label: list of (id, fingerprint) -> id -> component id."""
    parent = {i: i for i, _ in prints}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for n, (i, a) in enumerate(prints):
        for j, b in prints[:n]:
            if (a ^ b).bit_count() <= bits:
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i, _ in prints}


def item_words(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", lower(text))


def contamination(text, benchmark, n=10):
    """(words, hit words, ids of items) for benchmark = [(id, text)]."""
    w = item_words(text)
    hit, items = set(), set()
    for item, body in benchmark:
        v = item_words(body)
        size = min(n, len(v))
        grams = {tuple(v[i:i + size]) for i in range(len(v) - size + 1)} if v else set()
        for i in range(len(w) - size + 1) if v else ():
            if tuple(w[i:i + size]) in grams:
                hit.update(range(i, i + size))
                items.add(item)
    return len(w), len(hit), sorted(map(str, items))


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def crc(text):
    return zlib.crc32(str(text).encode())


def unigram(docs):
    """doc id -> (n_tokens, n_known, N, base score); docs = [(id, text)]."""
    tokens = {i: [*words(t), None] for i, t in docs}
    counts = collections.Counter(
        t for i, _ in docs if crc(i) % 7 != 2 for t in tokens[i])
    n, v = sum(counts.values()), len(counts)
    return {i: (len(t), sum(counts[x] > 0 for x in t), n,
                sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in t))
            for i, t in tokens.items()}


def audit(rows, labels):
    """Documents removed step by step, order by order: rows of (key, text, part), labels of
    (key, quality, toxic) -> (part, order, step) -> the other columns."""
    from itertools import permutations

    good = {k for k, q, _ in labels if q == 1 and k is not None}
    toxic = {k for k, _, x in labels if x == 1 and k is not None}
    first = {}
    for k, t, _ in rows:
        if k is not None:
            first[t or ""] = min(first.get(t or "", k), k)

    def failed(k, t):
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        return {c for c, bad in (
            ("A", len(w) < 50), ("B", 100 * len(set(w)) < 65 * len(w)),
            ("C", 100 * len(re.findall("[A-Z]", t)) > 5 * len(t)),
            ("D", bool(re.search(r"[#$%&*|]", t))), ("E", k is not None and first[t] < k)) if bad}

    parts = collections.defaultdict(list)
    for k, t, part in rows:
        parts[part or ""].append((k, failed(k, t)))
    out = {}
    for part, docs in parts.items():
        total = collections.Counter()
        for order in permutations("ABCDE"):
            left = docs
            for step, c in enumerate(order, 1):
                gone = [k for k, bad in left if c in bad]
                left = [(k, bad) for k, bad in left if c not in bad]
                total[c] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(c in bad for _, bad in docs) - len(gone),
                    sum(bad == {c} for _, bad in docs), sum(k in good for k in gone),
                    sum(k in toxic for k in gone), c]
        for key in out:
            if key[0] == part:
                out[key][-1] = total[out[key][-1]]
    return {k: tuple(v) for k, v in out.items()}


def shingles(text, n=3):
    w = words(text)
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def jaccard_components(docs, num=9, den=10):
    """docs = [(id, text)] -> list of (id, set size, component id), one per row."""
    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and den * len(a & b) >= num * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(docs):
        if k is not None:
            least[find(i)] = min(least.get(find(i), k), k)
    return [(k, len(sets[i]), least.get(find(i))) for i, (k, _) in enumerate(docs)]


def hard_negatives(rows, is_anchor, k=5):
    """rows = [(id, vector, label)] -> tuples in the order of the operator's columns."""
    rows = {(i, tuple(math.floor(256 * x) for x in v), label) for i, v, label in rows
            if None not in (i, v, label) and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for a, q, label in rows:
        if not is_anchor(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, v)), i, c) for i, v, c in rows if i != a)
        for p, i, _ in [r for r in scored if r[2] == label][:k]:
            inside = [(-s, j) for s, j, c in scored if c != label and 80 * -p <= 100 * -s <= 100 * -p]
            out += [(a, i, n, j, -p, s) for n, (s, j) in enumerate(inside[:k], 1)]
    return sorted(out)
