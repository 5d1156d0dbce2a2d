"""Brute-force versions of the training-data operators: plain Python over lists
of (doc_id, text), written from the contracts and not from the operators."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LICENSE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
A_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def simhash(text, k=3):
    words = WORD.findall((text or "").translate(A_Z))
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(values, near):
    """Index of the component of each value, as its smallest index."""
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(values)):
        for j in range(i):
            if near(values[i], values[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def near_dups(docs, max_bits=2):
    fps = [simhash(t) for _, t in docs]
    which = components(fps, lambda a, b: (a ^ b).bit_count() <= max_bits)
    ids = defaultdict(list)
    for (i, _), c in zip(docs, which):
        ids[c] += [i] if i is not None else []
    return [(i, f"{f:016x}", min(ids[c], default=None)) for (i, _), f, c in zip(docs, fps, which)]


def key_of(line):
    return line.strip("\x20\x09\x0A\x0B\x0C\x0D").translate(A_Z)


def line_dedup(docs, min_docs=10):
    seen = defaultdict(set)
    for doc in docs:
        for line in (doc[1] or "").split("\n"):
            seen[key_of(line)].add(doc)
    out = []
    for i, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not key_of(x) or len(seen[key_of(x)]) < min_docs]
        out.append((i, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return out


def edited(docs):
    """(doc_id, n_chars, sha of the edited text, next document's text) by descending id."""
    rows = sorted(docs, key=lambda d: (d[0] is None, -(d[0] or 0)))
    out = []
    for n, (i, t) in enumerate(rows):
        t, after = t or "", rows[(n + 1) % len(rows)][1] or ""
        h = len(t) // 2
        out.append((i, len(t), sha(t[: len(t) - h] + after[:h])))
    return out


def winnow_sets(text, k, w):
    """All windows' substrings whose sharing must be seen: texts of w + k - 1."""
    return {text[i:i + w + k - 1] for i in range(len(text) - (w + k - 1) + 1)}


def crc(text):
    return zlib.crc32((text or "").encode())


def license_base(text):
    words = LICENSE_WORD.findall((text or "").translate(A_Z))
    places = [(i, label) for phrase, label in (("cc by", "cc-by"), ("general public license", "gpl"),
                                               ("all rights reserved", "reserved"))
              for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split()]
    at = [i for i, _ in places]
    return (len(words), len(places), min(at, default=None), max(at, default=None),
            ",".join(sorted({x for _, x in places})))


def quality(text):
    t = text or ""
    words = WORD.findall(t)
    grams = Counter(zip(words, words[1:], words[2:]))
    hit = {i + j for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for j in range(3)}
    lines, dup, seen = t.split("\n"), 0, set()
    for x in lines:
        if WORD.search(x):
            dup += x in seen
            seen.add(x)
    n = len(words)
    return (n, sum(map(len, words)), sum(t.count(c) for c in "#*$%&|<>"), dup, len(hit),
            n < 50 or 100 * len(hit) > 50 * n)


def substrings(docs, window=35):
    places = Counter()
    all_words = [WORD.findall(t or "") for _, t in docs]
    for ws in all_words:
        places.update(tuple(ws[s:s + window]) for s in range(len(ws) - window + 1))
    out = []
    for (i, _), ws in zip(docs, all_words):
        gone = {s + j for s in range(len(ws) - window + 1)
                if places[tuple(ws[s:s + window])] > 1 for j in range(window)}
        kept = " ".join(w for n, w in enumerate(ws) if n not in gone)
        out.append((i, len(ws), len(gone), sha(kept)))
    return out


def shingle_set(text, size=5):
    words = WORD.findall((text or "").translate(A_Z))
    return frozenset(" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))) \
        if words else frozenset()


def similar_groups(docs, percent=85):
    """(doc_id, set size, component_id, kept): all pairs that share a shingle are compared."""
    sets = [shingle_set(t) for _, t in docs]
    root, holders = list(range(len(sets))), defaultdict(list)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, s in enumerate(sets):
        common = Counter(j for x in s for j in holders[x])
        for x in s:
            holders[x].append(i)
        for j, k in common.items():
            if 100 * k >= percent * (len(s) + len(sets[j]) - k):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    ids = defaultdict(list)
    for n, (i, _) in enumerate(docs):
        ids[find(n)] += [i] if i is not None else []
    least = {k: min(v, default=None) for k, v in ids.items()}
    return [(i, len(s), least[find(n)], i == least[find(n)]) for n, ((i, _), s) in enumerate(zip(docs, sets))]


def aligned(docs, first, second, a_bytes, b_bytes):
    """op12's rows: ``first`` and ``second`` encode a whole text, ids to bytes by the tables."""
    groups = []
    for _, t in docs:
        raw = (" " + (t or "")).encode()
        a, b = (first(" " + t), second(t)) if t else ([], [])
        if not t or any(b"".join(table[i] for i in ids) != raw for ids, table in ((a, a_bytes), (b, b_bytes))):
            groups.append([])
            continue
        out, i, j, ea, eb, gi, gj = [], 0, 0, 0, 0, 0, 0
        while i < len(a) or j < len(b):
            if ea <= eb and i < len(a):
                ea += len(a_bytes[a[i]])
                i += 1
            else:
                eb += len(b_bytes[b[j]])
                j += 1
            if ea == eb:
                out.append((a[gi:i], b[gj:j]))
                gi, gj = i, j
        groups.append(out)
    count, best = Counter(), Counter()
    for g in groups:
        count.update({(x, y) for xs, ys in g for x in xs for y in ys})
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    rows = []
    for (i, _), g in zip(docs, groups):
        linked = [(x, y) for xs, ys in g for x in xs for y in ys]
        text = ";".join(",".join(map(str, xs)) + "|" + ",".join(map(str, ys)) for xs, ys in g)
        rows.append((i, sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), len(linked),
                     sum(count[p] == best[p[0]] for p in linked), sum(count[p] for p in linked),
                     sha(text) if g else ""))
    return rows
