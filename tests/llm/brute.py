"""The contracts of the numbered queries in plain Python, over lists of rows."""

import hashlib
import math
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def lower(text):
    return (text or "").translate(UPPER)


def shingles(text):
    words = WORD.findall(lower(text))
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def near_duplicates(docs):
    """{doc_id: (n_shingles, component_id)}; docs: (doc_id, text)."""
    sets = [(i, shingles(t)) for i, t in docs]
    root = list(range(len(sets)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            one_id = sets[a][0] is not None and sets[a][0] == sets[b][0]
            if one_id or x and y and 100 * len(x & y) >= 75 * len(x | y):
                root[top(a)] = top(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        least[top(k)] = min(least.get(top(k), i), i)
    return sorted((i, len(s), least[top(k)]) for k, (i, s) in enumerate(sets))


def personal_data(text):
    """{kind: [(start, end)]} by the plain patterns of the contract."""
    text = text or ""
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }

    def fine(kind, match):
        digits = [int(c) for c in match if c in "0123456789"]
        if kind == "ip":
            return all(int(p) <= 255 for p in match.split("."))
        if kind == "phone":
            return 10 <= len(digits) <= 15
        if kind == "card":
            total = sum(
                d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits[::-1])
            )
            return 14 <= len(digits) <= 19 and total % 10 == 0
        return True

    return {
        k: [m.span() for m in re.finditer(p, text) if fine(k, m.group())]
        for k, p in patterns.items()
    }


def personal_digest(text):
    found = personal_data(text)
    kinds = list(found)
    every = sorted((s, kinds.index(k), e) for k in kinds for s, e in found[k])
    joined = ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in every)
    return [len(found[k]) for k in kinds], hashlib.sha256(joined.encode()).hexdigest(), joined


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    words = WORD.findall(text)
    lines = Counter(x for x in text.split("\n") if WORD.search(x))
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    n = len(words)
    return (
        n,
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        sum(c - 1 for c in lines.values()),
        len(covered),
        n < 50 or 100 * len(covered) > 50 * n,
    )


def targets(sizes, weights=(1, 2, 3), most=3):
    """{source: target} by sharing the excess until no source is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in capped)
        open_ = [s for s in names if s not in capped]
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = {s for s in open_ if share[s] >= most * sizes[s]}
        if not above:
            return share | {s: float(most * sizes[s]) for s in capped}
        capped |= above


def host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    return host.translate(UPPER), re.match(r"[^?#]*", rest[len(host) :]).group()


def listed(host, path, rules):
    fit = [
        (len(h + p), h + p, v)
        for h, p, v in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fit)[1:] if fit else (None, None)


def nearest(rows, k=10):
    """{query id: [(vec_id, distance)]} for ids divisible by 100."""
    good = [
        (i, v)
        for i, v in rows
        if i is not None and v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    found = {}
    for i, v in good:
        if i % 100 == 0:
            near = sorted((math.dist(v, w), j) for j, w in good if j != i and len(w) == len(v))
            found[i] = [(j, d) for d, j in near[:k]]
    return found


def licence_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}


def licences(text):
    words = licence_words(text)
    places, labels = [], set()
    for phrase, label in PHRASES.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i : i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return (
        len(words),
        len(places),
        min(places, default=None),
        max(places, default=None),
        ",".join(sorted(labels)),
    )


def repeats(docs, width=50):
    """[(doc_id, n_bytes, n_removed, n_spans, kept_sha256)]; docs: (doc_id, text)."""
    first = {}
    texts = [(i, (t or "").encode()) for i, t in docs]
    for i, b in texts:
        for k in range(len(b) - width + 1):
            w = b[k : k + width]
            first[w] = min(first.get(w, i), i)
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        for k in range(len(b) - width + 1):
            if first[b[k : k + width]] < i:
                gone[k : k + width] = b"\x01" * width
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def best_fit_bins(lengths, capacity):
    """Number of bins of best-fit decreasing, one length at a time."""
    import bisect

    left = []
    for n in sorted(lengths, reverse=True):
        k = bisect.bisect_left(left, n)
        rest = left.pop(k) - n if k < len(left) else capacity - n
        bisect.insort(left, rest)
    return len(left)


def grouped(pairs):
    out = defaultdict(list)
    for k, v in pairs:
        out[k].append(v)
    return out
