"""Plain-Python versions of the operators' definitions."""

import hashlib
import re
from collections import Counter


def letters(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_ascii(text))


def lower_ascii(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def blanks(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def contamination(text, items):
    """items: (id, text) pairs -> n_words, n_hit, item ids."""
    words = letters(text)
    hit, found = set(), set()
    for item_id, item in items:
        w = letters(item)
        n = min(13, len(w))
        windows = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if n else set()
        for i in range(len(words) - n + 1 if n else 0):
            if tuple(words[i:i + n]) in windows:
                hit.update(range(i, i + n))
                found.add("" if item_id is None else str(item_id))
    return len(words), len(hit), sorted(found)


def shingles(text):
    w = letters(text)
    if not w:
        return Counter()
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def similar(a, b, least=0.8):
    low = sum((a & b).values())
    return low >= least * sum((a | b).values()) - 1e-9


def near_classes(texts):
    """Class number of each text: components of the relation multiset Jaccard >= 0.8; wordless by equal text."""
    bags = [shingles(t) for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    index = {}
    for i, bag in enumerate(bags):
        if not bag:
            first = index.setdefault(("", texts[i] or ""), i)
            parent[root(i)] = root(first)
            continue
        seen = set()
        for s in bag:
            for j in index.get(s, ()):
                if j not in seen:
                    seen.add(j)
                    if root(i) != root(j) and similar(bag, bags[j]):
                        parent[root(i)] = root(j)
            index.setdefault(s, []).append(i)
    return [root(i) for i in range(len(texts))]
