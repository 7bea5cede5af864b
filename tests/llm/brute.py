"""Plain versions of the operators, for small inputs."""

import hashlib
import re

import numpy as np
import xxhash

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def split(text):
    return [w for w in SPACE.split(text or "") if w]


class Groups:
    def __init__(self, nodes):
        self.parent = {n: n for n in nodes}

    def find(self, node):
        while self.parent[node] != node:
            node = self.parent[node]
        return node

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.parent[b] = a


def fingerprint(text, shingle=3):
    words = split(lowered(text))
    if not words:
        return 0
    runs = [words[i : i + shingle] for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64(" ".join(r).encode(), seed=42).intdigest() for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, radius=3):
    """prints: {id: fingerprint}."""
    groups, ids = Groups(prints), sorted(prints)
    values = np.array([prints[i] for i in ids], np.uint64)
    for n, i in enumerate(ids):
        for m in np.flatnonzero(np.bitwise_count(values[n] ^ values[n + 1 :]) <= radius):
            groups.join(i, ids[n + 1 + int(m)])
    return {i: groups.find(i) for i in ids}


def repeated_lines(documents, similarity=0.8, shingle=5):
    """documents: [(id, text)] in order. The (id, line number) of each line to remove."""
    seen, gone = [], set()
    for i, text in documents:
        for n, line in enumerate((text or "").split("\n")):
            words = split(lowered(line))
            if not words:
                continue
            tokens = {tuple(words[k : k + shingle]) for k in range(max(1, len(words) - shingle + 1))}
            if any(len(tokens & s) >= similarity * len(tokens | s) - 1e-9 for s in seen):
                gone.add((i, n))
            seen.append(tokens)
    return gone


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


def contamination(text, items, window=13):
    """items: [(id, text)]. Words, hit words, and the sorted items that occur."""
    words = item_words(text)
    hit, named = set(), set()
    for i, body in items:
        own = item_words(body)
        n = min(len(own), window)
        wanted = {tuple(own[k : k + n]) for k in range(len(own) - n + 1)} if own else set()
        for k in range(len(words) - n + 1):
            if n and tuple(words[k : k + n]) in wanted:
                hit.update(range(k, k + n))
                named |= {str(i)} - {"None"}
    return len(words), len(hit), sorted(named)


def sha(items):
    return hashlib.sha256(",".join(items).encode()).hexdigest()


def base_rules(text):
    words = split(text)
    n = len(words)
    seen, copies = set(), 0
    for line in (text or "").split("\n"):
        if split(line):
            copies += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(n - 2)]
    count = {}
    for w in windows:
        count[w] = count.get(w, 0) + 1
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}
    failed = n < 50 or 100 * len(covered) > 50 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), copies, len(covered), failed
