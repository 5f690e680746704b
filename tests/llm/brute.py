"""Plain Python versions of the operators, for small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def words(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def groups(items, linked):
    """For each item the group it is in, by links between places in the list."""
    parent = list(range(len(items)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in linked:
        parent[root(i)] = root(j)
    return [root(i) for i in range(len(items))]


def fingerprint(text, shingle=3):
    w = words(lower(text))
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i:i + shingle]).encode(), 42)
              for i in range(max(1, len(w) - shingle + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash(rows, bits=3):
    """(key, fingerprint, component) for (key, text) rows."""
    prints = [fingerprint(t) for _, t in rows]
    own = np.array(prints, np.uint64)
    linked = [(i, int(j)) for i in range(len(rows)) for j in np.flatnonzero(np.bitwise_count(own[:i] ^ own[i]) <= bits)]
    group = groups(rows, linked)
    least = {}
    for (key, _), g in zip(rows, group):
        least.setdefault(g, []).append(key)
    least = {g: min((k for k in ks if k is not None), default=None) for g, ks in least.items()}
    return [(key, p, least[g]) for (key, _), p, g in zip(rows, prints, group)]


def language_model(rows, prior, held=lambda key: zlib.crc32(str(key).encode()) % 7 == 2):
    """(key, held out, tokens, known, base score, score) and the number of training tokens."""
    token_count, pairs, n_docs = Counter(), Counter(), 0
    texts = [(key, ["<s>", *words(lower(text)), "</s>"]) for key, text in rows]
    for key, w in texts:
        if key is None or not held(key):
            n_docs += 1
            token_count.update(w[1:])
            pairs.update(zip(w, w[1:]))
    total, distinct = sum(token_count.values()), len(token_count)
    out = []
    for key, w in texts:
        base = score = 0.0
        for before, word in zip(w, w[1:]):
            p = (token_count[word] + 1) / (total + distinct + 1)
            seen = n_docs if before == "<s>" else token_count[before]
            base += math.log10(p)
            score += math.log10((pairs[before, word] + prior * p) / (seen + prior))
        out.append((key, key is not None and held(key), len(w) - 1, sum(token_count[x] > 0 for x in w[1:]), base, score))
    return out, total


def repeated_words(w, window=5):
    seen = Counter(tuple(w[i:i + window]) for i in range(len(w) - window + 1))
    return len({j for i in range(len(w) - window + 1) if seen[tuple(w[i:i + window])] > 1 for j in range(i, i + window)})


def quality(text):
    """(words, characters, symbols, repeated lines, repeated words, base failed, kept)."""
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    chars, symbols = sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text))
    twice, repeated = len(lines) - len(set(lines)), repeated_words(w)
    echo = sum(a == b for a, b in zip(w, w[1:]))
    capitals = len(re.findall("[A-Z]", text))
    base = len(w) < 10 or 100 * repeated > 20 * len(w)
    kept = not (base or 10 * symbols > len(w) or 2 * twice > len(lines) or 10 * echo > 3 * len(w)
                or 10 * capitals > 3 * chars)
    return len(w), chars, symbols, twice, repeated, base, kept


def without_repeats(rows, least=20):
    """(key, words, removed, text left) for (key, text) rows; a null key comes last."""
    def place(key, i):
        return math.inf if key is None else key, i

    first, texts = {}, [(key, words(text)) for key, text in rows]
    for key, w in texts:
        for i in range(len(w) - least + 1):
            window = tuple(w[i:i + least])
            first[window] = min(first.get(window, place(key, i)), place(key, i))
    out = []
    for key, w in texts:
        gone = set()
        for i in range(len(w) - least + 1):
            if first[tuple(w[i:i + least])] < place(key, i):
                gone.update(range(i, i + least))
        out.append((key, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def near_vectors(rows, threshold=0.95):
    """(key, links, component) for (key, vector) rows."""
    def fine(x):
        return x is not None and len(x) > 0 and all(c is not None and math.isfinite(c) for c in x) and any(x)

    def near(a, b):
        a, b = np.array(a, float), np.array(b, float)
        return len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold

    linked = [(i, j) for i in range(len(rows)) for j in range(i)
              if fine(rows[i][1]) and fine(rows[j][1]) and near(rows[i][1], rows[j][1])]
    group, degree = groups(rows, linked), Counter(x for pair in linked for x in pair)
    least = {}
    for (key, _), g in zip(rows, group):
        least[g] = min(least.get(g, key), key)
    return [(key, degree[i], least[g]) for i, ((key, _), g) in enumerate(zip(rows, group))]
