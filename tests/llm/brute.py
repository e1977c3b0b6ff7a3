"""Plain-Python versions of the operators' contracts, for small fixtures."""

import hashlib
import re

import xxhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fingerprint(text):
    w = WORD.findall((text or "").translate(LOWER))
    grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(fps):
    """Smallest index reachable for each fingerprint of a list."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def contamination(text, items):
    """(n_words, n_hit, sorted items) of one text."""
    w = ALNUM.findall((text or "").translate(LOWER))
    hit, found = set(), set()
    for item, body in items:
        b = ALNUM.findall((body or "").translate(LOWER))
        for s in range(max(1, len(b) - 12)) if b else ():
            g = b[s : s + 13]
            for i in range(len(w) - len(g) + 1):
                if w[i : i + len(g)] == g:
                    hit.update(range(i, i + len(g)))
                    if item is not None:
                        found.add(item)
    return len(w), len(hit), sorted(found)


def near(text, body, slop):
    """Whether some window of the item has every word within slop of its place."""
    w, b = (ALNUM.findall((t or "").translate(LOWER)) for t in (text, body))
    at = {}
    for i, x in enumerate(w):
        at.setdefault(x, []).append(i)
    for s in range(max(1, len(b) - 12)) if b else ():
        g = b[s : s + 13]
        for start in range(-len(g), len(w)):
            if all(any(abs(p - start - j) <= slop for p in at.get(x, ())) for j, x in enumerate(g)):
                return True
    return False


def counts(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    t = text or ""
    w = WORD.findall(t)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    seen = {}
    for i, g in enumerate(grams):
        seen.setdefault(g, []).append(i)
    covered = {p for at in seen.values() if len(at) > 1 for i in at for p in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


def copies(doc_id, mean, seed=17):
    """Poisson count of a document."""
    import math

    pieces = max(1, math.ceil(mean / 16))
    total = 0
    for piece in range(1, pieces + 1):
        u = int(hashlib.md5(f"{seed}:{piece}:{doc_id}".encode()).hexdigest()[:13], 16) / 2**52
        p = c = math.exp(-mean / pieces)
        k = 0
        while c <= u:
            k += 1
            p *= mean / pieces / k
            c += p
        total += k
    return total
