"""Plain versions of the operators, for small tables."""

import math
import re
import zlib
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def fingerprint(text):
    words = WORD.findall(lower(text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(pairs, radius=4):
    """Smallest id that each (id, fingerprint) reaches."""
    parent = {i: i for i, _ in pairs}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k, (i, a) in enumerate(pairs):
        for j, b in pairs[:k]:
            if (a ^ b).bit_count() <= radius:
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return {i: find(i) for i in parent}


def similar(pairs):
    """Smallest id that each (id, text) reaches by links of 0.8 or more of the five-word shingles."""
    sets = []
    for _, text in pairs:
        words = WORD.findall(lower(text))
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    root = {i: i for i, _ in pairs}
    for k, (i, _) in enumerate(pairs):
        for n, (j, _) in enumerate(pairs[:k]):
            if 5 * len(sets[k] & sets[n]) >= 4 * len(sets[k] | sets[n]) and root[i] != root[j]:
                low, high = sorted((root[i], root[j]))
                root = {x: low if r == high else r for x, r in root.items()}
    return root


def bucket(doc_id, modulus):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % modulus


def quality(text):
    words = WORD.findall(text or "")
    grams = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for k in range(3)}
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), repeated, len(covered)


def host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return lower(host), re.match(r"[^?#]*", rest[len(host) :])[0]


def edit_distance_inside(item, text):
    """Fewest edits that turn ``item`` into a part of ``text``."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Target per source by repeated resharing; sizes is {source: words}."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, total, target = set(order), share * sum(sizes.values()), {}
    while left:
        unit = (total - sum(target.values())) / sum(weight[s] for s in left)
        full = {s for s in left if unit * weight[s] > most * sizes[s]}
        if not full:
            return target | {s: unit * weight[s] for s in left}
        target |= {s: most * sizes[s] for s in full}
        left -= full
    return target


def close(a, b):
    return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-6)
