"""Plain Python versions of the operators, over lists of (doc_id, text) rows."""

import itertools
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LAST = 2**63 - 1


def words(text):
    return WORD.findall(text or "")


def order(doc_id):
    return LAST if doc_id is None else doc_id


def shingle_set(text, k=5):
    w = words((text or "").translate(LOWER))
    if not w:
        return frozenset()
    k = min(k, len(w))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def jaccard(rows):
    """(doc_id, n_shingles, component_id) of each row."""
    sets = [shingle_set(text) for _, text in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for n, s in enumerate(sets):
        for shingle in s:
            holders[shingle].append(n)
    pairs = {pair for some in holders.values() for pair in itertools.combinations(some, 2)}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            parent[find(a)] = find(b)
    least = {}
    for n, (doc_id, _) in enumerate(rows):
        root = find(n)
        if root not in least or order(doc_id) < order(least[root]):
            least[root] = doc_id
    return [(doc_id, len(sets[n]), least[find(n)]) for n, (doc_id, _) in enumerate(rows)]


def substrings(rows, window=13):
    """(doc_id, n_words, n_removed, kept) of each row."""
    first = {}
    for doc_id, text in rows:
        w = words(text)
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            first[key] = min(first.get(key, LAST), order(doc_id))
    out = []
    for doc_id, text in rows:
        w = words(text)
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < order(doc_id):
                gone.update(range(i, i + window))
        out.append((doc_id, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def line_dedup(rows, window=3):
    """(doc_id, n_lines, n_removed, kept) of each row; rows of equal id and text are one occurrence."""
    first = {}
    for doc_id, text in sorted(set(rows), key=lambda r: (order(r[0]), r[1] or "")):
        lines = [] if text is None else text.split("\n")
        for i in range(len(lines) - window + 1):
            part = tuple(lines[i : i + window])
            if any(line.strip(" ") for line in part):
                first.setdefault(part, (doc_id, text, i))
    out = []
    for doc_id, text in rows:
        lines = [] if text is None else text.split("\n")
        gone = set()
        for i in range(len(lines) - window + 1):
            if first.get(tuple(lines[i : i + window]), (doc_id, text, i)) != (doc_id, text, i):
                gone.update(range(i, i + window))
        kept = text if not gone else "\n".join(x for i, x in enumerate(lines) if i not in gone)
        out.append((doc_id, len(lines), len(gone), kept))
    return out


def leaks(rows, items):
    """(doc_id, item_id) -> (similarity, start, n_words, n_windows), over every window of every document."""
    found = {}
    for item_id, item in items:
        iw = words((item or "").translate(LOWER))
        if not iw:
            continue
        k = min(5, len(iw))
        want = Counter(tuple(iw[i : i + k]) for i in range(len(iw) - k + 1))
        for doc_id, text in set(rows):
            w = words((text or "").translate(LOWER))
            if len(w) < k:
                continue
            shingles = [tuple(w[i : i + k]) for i in range(len(w) - k + 1)]
            if not any(s in want for s in shingles):
                continue
            size = min(len(iw), len(w))
            for start in range(len(w) - size + 1):
                have = Counter(shingles[start : start + size - k + 1])
                shared = sum((have & want).values())
                union = sum(have.values()) + sum(want.values()) - shared
                if 100 * shared >= 80 * union:
                    old = found.get((doc_id, item_id), (0, 0, 0, 0))
                    best = (shared / union, start, size) if shared / union > old[0] else old[:3]
                    found[doc_id, item_id] = (*best, old[3] + 1)
    return found


def targets(sizes, weights=(1, 2, 3), cap=3):
    """Target of each source; sizes by source."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[n % len(weights)] for n, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        open_ = [s for s in names if s not in capped]
        free = total - sum(cap * sizes[s] for s in capped)
        shared = sum(weight[s] for s in open_)
        target = {s: cap * sizes[s] if s in capped else free * weight[s] / shared for s in names}
        over = {s for s in open_ if target[s] > cap * sizes[s]}
        if not over:
            return target
        capped |= over


def chat_text(roles_and_texts):
    return "".join(f"{role or ''}\n{text or ''}\n" for role, text in roles_and_texts)


def top_k(rows, k=5, every=50):
    """(query_id, rank, vec_id, score) over rows (vec_id, vector), each row its own."""
    import math

    usable = [
        (n, i, [math.floor(256 * float(x)) for x in v])
        for n, (i, v) in enumerate(rows)
        if v and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for n, i, q in usable:
        if i is None or i % every:
            continue
        scored = [
            (-sum(a * b for a, b in zip(q, v, strict=True)), order(j), j) for m, j, v in usable if m != n and len(v) == len(q)
        ]
        out += [(i, r, j, -s) for r, (s, _, j) in enumerate(sorted(scored, key=lambda x: x[:2])[:k], 1)]
    return out


def groups(rows):
    """Number of the near-duplicate group of each row; rows without words are groups of their own."""
    sets = [shingle_set(text) for _, text in rows]
    group = list(range(len(rows)))
    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            old, new = group[b], group[a]
            group = [new if g == old else g for g in group]
    return group


def floor_log(ratio, factor=1000):
    import math

    return math.floor(factor * math.log(ratio))


def resampling(rows, targets, buckets=10_000, share=25, least=20, seed=7):
    """(doc_id, n_words, n_features, weight, score, rank) of each row, in no order."""
    import hashlib
    import math
    import zlib

    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def bag(text):
        w = word.findall((text or "").translate(LOWER))
        return len(w), [zlib.crc32(f.encode()) % buckets for f in w + [f"{a} {b}" for a, b in itertools.pairwise(w)]]

    bags = [bag(text) for _, text in rows]
    s = Counter(b for _, bag_ in bags for b in bag_)
    t = Counter(b for text in targets for b in bag(text)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: floor_log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))
    scored = []
    for (doc_id, _), (n, found) in zip(rows, bags, strict=True):
        weight = sum(map(gain, found)) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        scored.append((doc_id, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    able = sorted((r for r in scored if r[1] >= least), key=lambda r: (-r[4], order(r[0]), r[2], r[3], r[1]))
    drawn = len(able) * share // 100
    return [(*r, n if n <= drawn else None) for n, r in enumerate(able, 1)] + [(*r, None) for r in scored if r[1] < least]


def hard_negatives(rows, positives=5, negatives=5, share=80, every=100):
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) over rows (vec_id, vector, label), each row its own."""
    import math

    usable = [
        (n, i, label, [math.floor(256 * float(x)) for x in v])
        for n, (i, v, label) in enumerate(rows)
        if label is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for n, i, label, a in usable:
        if i is None or i % every:
            continue
        scored = sorted(
            (-sum(x * y for x, y in zip(a, v, strict=True)), order(j), m, j, other) for m, j, other, v in usable if m != n and len(v) == len(a)
        )
        for score, _, _, j, _ in [s for s in scored if s[4] == label][:positives]:
            fits = [s for s in scored if s[4] != label and share * -score <= 100 * -s[0] <= 100 * -score]
            out += [(i, j, r, s[3], -score, -s[0]) for r, s in enumerate(fits[:negatives], 1)]
    return out
