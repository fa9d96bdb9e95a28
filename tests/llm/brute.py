"""Plain versions of the operators for tests."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def quality_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    again = {i + j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        dup += bool(WORD.search(line)) and line in seen
        seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(again)


def without_repeats(texts, length):
    """``(n_bytes, n_removed, n_spans, kept sha256)`` of each text."""
    raw = [(text or "").encode() for text in texts]
    starts = defaultdict(int)
    for data in raw:
        for i in range(len(data) - length + 1):
            starts[hashlib.md5(data[i : i + length]).digest()] += 1
    out = []
    for data in raw:
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if starts[hashlib.md5(data[i : i + length]).digest()] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def shingles(text):
    words = WORD.findall(text or "")
    return Counter([tuple(words[i : i + 5]) for i in range(len(words) - 4)] or ([tuple(words)] if words else []))


def probability_jaccard(one, two):
    both = set(one) & set(two)
    return sum(1 / sum(max(one[j] / one[i], two[j] / two[i]) for j in set(one) | set(two)) for i in both)


def near_classes(rows, least=0.8):
    """The class of each row of ``(doc_id, text)``: the least doc_id linked to it by equal or similar texts."""
    texts = [text or "" for _, text in rows]
    sets = [shingles(text) for text in texts]
    parent = list(range(len(rows)))

    def root(at):
        while parent[at] != at:
            at = parent[at]
        return at

    for i in range(len(rows)):
        for j in range(i):
            if texts[i] == texts[j] or (sets[i] and sets[j] and probability_jaccard(sets[i], sets[j]) >= least - 1e-12):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    members = defaultdict(list)
    for at in range(len(rows)):
        members[root(at)].append(rows[at][0])
    least_of = {key: min((doc for doc in docs if doc is not None), default=None) for key, docs in members.items()}
    return [least_of[root(at)] for at in range(len(rows))]


def top_products(vectors, every, k):
    """``(query_id, rank, vec_id, score)`` over ``(vec_id, integers)``."""
    out = []
    for query, asked in vectors:
        if query % every == 0:
            scores = [(-sum(a * b for a, b in zip(asked, other)), number) for number, other in vectors if number != query]
            out += [(query, rank, number, -score) for rank, (score, number) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def best_licence(text, templates, least):
    """``(licence, dice, matching units)`` without any pruning."""

    def grams(part):
        words = re.findall(r"[^\W_]+", part.lower())
        return set(zip(words, words[1:]))

    lines = (text or "").split("\n")
    units = [line for line in lines if line.strip()]
    paragraphs = [part for part in re.split(r"\n(?:[^\S\n]*\n)+", "\n" + (text or "") + "\n") if part.strip()]
    units += [part for part in paragraphs if "\n" in part.strip()]
    units += [text] * (len(paragraphs) > 1)
    found, count = None, 0
    for unit in units:
        own = grams(unit)
        matches = [
            (-2 * len(own & other) / (len(own) + len(other)), name) for name, texts in templates.items() for other in map(grams, texts) if own
        ]
        matches = [match for match in matches if -match[0] >= least]
        count += bool(matches)
        found = min([*matches, *([found] if found else [])], default=None)
    return (found[1], -found[0], count) if found else (None, None, 0)


def fill_middle(doc, text):
    text = text or ""
    n, digest = len(text), hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[at : at + 8], 16) for at in (0, 8, 16, 24))

    def sha(value):
        return hashlib.sha256(value.encode()).hexdigest()

    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return doc, n, "plain", None, None, sha(text), sha(text)
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = text[:low], text[low:high], text[high:]
    spm = h4 % 100 < 20
    output = f"<S>{suffix}<P>{prefix}<M>{middle}" if spm else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return doc, n, "spm" if spm else "psm", low, high - low, sha(output), sha(text)


def clusters(rows, count=16, rounds=3):
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` of each row."""
    vectors = [(doc, [math.floor(64 * x) for x in vector]) for doc, vector in rows]
    order = sorted(vectors, key=lambda row: (row[0] is None, hashlib.sha256(f"1:{row[0]}".encode()).hexdigest(), row[1]))
    centroids = [vector for _, vector in order[:count]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(vector, centroid)), at) for at, centroid in enumerate(centroids)) for _, vector in vectors]

    for _ in range(rounds):
        groups = defaultdict(list)
        for (_, vector), (_, at) in zip(vectors, assign()):
            groups[at].append(vector)
        centroids = [[sum(column) // len(groups[at]) for column in zip(*groups[at])] if at in groups else own for at, own in enumerate(centroids)]
    last = assign()
    inertia = Counter()
    for distance, at in last:
        inertia[at] += distance
    names = [hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest() for centroid in centroids]
    return [(doc, at, distance, inertia[at], sum(inertia.values()), names[at]) for (doc, _), (distance, at) in zip(vectors, last)]


def held_out(doc):
    return zlib.crc32(str(doc).encode()) % 4 == 2


def normal_text(text):
    return b" " + b"".join(word + b" " for word in re.findall(rb"[a-z0-9\x80-\xff]+", text.lower().encode()))
