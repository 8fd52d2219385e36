"""Plain versions of the operators, one document at a time."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import regex
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BLANK = " \t\n\x0b\x0c\r"
LOWER = {ord(c): ord(c.lower()) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
M = (1 << 64) - 1


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def hash_text(s):
    return signed(xxhash.xxh64_intdigest(s.encode(), 42))


def hash_longs(values):
    h = 42
    for v in values:
        h = xxhash.xxh64_intdigest((v & M).to_bytes(8, "little"), h)
    return signed(h)


# ---- quality rules

def base(text):
    words = WORD.findall(text or "")
    seen = defaultdict(list)
    for i in range(len(words) - 2):
        seen[tuple(words[i:i + 3])].append(i)
    covered = {p + k for at in seen.values() if len(at) > 1 for p in at for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    n = len(words)
    return dict(n_words=n, word_chars=sum(map(len, words)), n_symbols=sum((text or "").count(c) for c in "#*$%&|<>"),
                n_dup_lines=len(lines) - len(set(lines)), n_repeat_words=len(covered),
                base_failed=n < 50 or 100 * len(covered) > 50 * n)


def grams(text, buckets):
    h = [hash_text(w) for w in WORD.findall(text or "")]
    return [x % buckets for x in h] + [hash_longs(p) % buckets for p in zip(h, h[1:])]


def ratios(docs, good, buckets, prior):
    raw, trusted = Counter(), Counter()
    for i, text in docs:
        g = grams(text, buckets)
        raw.update(g)
        if i in good:
            trusted.update(g)
    n_raw, n_good = sum(raw.values()), sum(trusted.values())
    return {b: round(1e6 * math.log((trusted[b] + prior) / (n_good * (raw[b] / n_raw) + prior))) for b in raw}


def quality_score(text, model, buckets):
    g = grams(text, buckets)
    return sum(model[b] for b in g) / (1e6 * len(g)) if g else None


# ---- near duplicates

def shingles(text, n):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return set()
    return {tuple(words)} if len(words) < n else {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}


def groups(texts, n, num, den):
    """Group number of every text (its first member), and the sets."""
    sets = [shingles(t, n) for t in texts]
    to = list(range(len(texts)))

    def find(i):
        while to[i] != i:
            i = to[i] = to[to[i]]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and den * min(len(a), len(b)) >= num * max(len(a), len(b)):
                both = len(a & b)
                if den * both >= num * (len(a) + len(b) - both):
                    to[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(texts))], sets


# ---- lines

def drop_lines(texts, min_docs):
    def key(line):
        return line.strip(BLANK).translate(LOWER)

    split = [(t or "").split("\n") for t in texts]
    found = Counter(k for lines in split for k in {key(x) for x in lines})
    out = []
    for lines in split:
        kept = [x for x in lines if not key(x) or found[key(x)] < min_docs]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


# ---- packing

def pieces(ids, most):
    out, at = [], 0
    while at < len(ids):
        size = most
        while size > len(ids) - at:
            size //= 2
        out.append((at, size, zlib.crc32(np.array(ids[at:at + size], "<u4").tobytes())))
        at += size
    return out


# ---- I-Match

def terms(text):
    return {hash_text(w) & -2 for w in regex.split(r"[^\p{L}\p{N}]+", (text or "").lower()) if w}


def fingerprint(text, lexicon, per_rate=16, rates=3):
    found = sorted(terms(text) & lexicon)
    out, sources = [], {0: found, 1: found}

    def part(source, group, rate, c):
        shift = 2 + 24 * group + 3 * rate
        return [t for t in source if ((t & M) >> shift) & 7 == c]

    for rate in range(rates):
        for group in (0, 1):
            for c in range(per_rate // 2):
                s = part(sources[group], group, rate, c)
                out.append(hash_longs(s) & 0x7FFFFFFF if s else None)
        sources = {g: part(sources[g], g, rate, 0) for g in (0, 1)}
    out.append((hash_longs(found) if found else hash_text(text or "")) & 0x7FFFFFFF)
    return out


def likeness(a, b, per_rate=16, rates=3):
    if a == b:
        return 1.0
    best = 0.0
    for r in range(rates):
        x, y = a[r * per_rate:(r + 1) * per_rate], b[r * per_rate:(r + 1) * per_rate]
        seen = sum(p is not None or q is not None for p, q in zip(x, y))
        best = max(best, sum(p == q and p is not None for p, q in zip(x, y)) / (1 + seen))
    return best


def sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()
