"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def roots(nodes, links):
    """The smallest node that each node reaches."""
    near = defaultdict(set)
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    root = {}
    for n in sorted(nodes):
        if n in root:
            continue
        todo = [n]
        while todo:
            x = todo.pop()
            if x not in root:
                root[x] = n
                todo += near[x]
    return root


def shingles(text, size=5):
    own = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not own:
        return frozenset()
    return frozenset(tuple(own[i: i + size]) for i in range(max(1, len(own) - size + 1)))


def near_documents(docs, percent=85):
    """doc_id -> (n_shingles, component)."""
    sets = {d: shingles(t) for d, t in docs}
    posted = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            posted[x].append(d)
    common = Counter()
    for ids in posted.values():
        for i, a in enumerate(ids):
            for b in ids[i + 1:]:
                common[a, b] += 1
    links = [(a, b) for (a, b), n in common.items() if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n)]
    root = roots(sets, links)
    return {d: (len(s), root[d]) for d, s in sets.items()}


def repeated_passages(docs, window=35):
    """doc_id -> (n_words, n_removed, sha of the kept words)."""
    own = {d: words(t) for d, t in docs}
    seen = Counter(tuple(w[i: i + window]) for w in own.values() for i in range(len(w) - window + 1))
    result = {}
    for d, w in own.items():
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i: i + window])] > 1:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        result[d] = len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()
    return result


def near_vectors(rows, cosine=0.93):
    """vec_id -> (n_links, component)."""
    degree, links, ids = Counter(), [], [r[0] for r in rows]
    fine = [(i, np.array(v, float), label) for i, v, label in rows
            if v is not None and label is not None and len(v) and None not in list(v)
            and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float))]
    for k, (i, v, label) in enumerate(fine):
        for j, w, other in fine[k + 1:]:
            if label == other and len(v) == len(w):
                if float(v @ w) / (np.linalg.norm(v) * np.linalg.norm(w)) >= cosine:
                    links.append((i, j))
                    degree[i] += 1
                    degree[j] += 1
    root = roots(ids, links)
    return {i: (degree[i], root[i]) for i in ids}


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def removed_lines(docs, edits=2, min_chars=30, min_documents=10):
    """doc_id -> numbers of the lines that go; ids are distinct and not null."""
    places = defaultdict(list)
    for d, t in docs:
        for n, line in enumerate((t or "").split("\n")):
            if len(line) >= min_chars:
                places[line].append((d, n))
    lines = sorted(places)
    by_size = defaultdict(list)
    for x in lines:
        by_size[len(x)].append(x)
    links = [(x, y) for x in lines for k in range(edits + 1) for y in by_size[len(x) + k]
             if x != y and edit_distance(x, y) <= edits]
    root = roots(lines, links)
    classes = defaultdict(list)
    for x in lines:
        classes[root[x]] += places[x]
    gone = defaultdict(list)
    for own in classes.values():
        own.sort()
        if len({d for d, _ in own}) >= min_documents:
            for d, n in own[1:]:
                gone[d].append(n)
    return {d: sorted(gone[d]) for d, _ in docs}


def best_fit(lengths, capacity):
    """Number of sequences of best fit, largest first, a piece at a time."""
    gaps = []
    for n in sorted(lengths, reverse=True):
        fit = [g for g in gaps if g >= n]
        gap = min(fit) if fit else capacity
        if fit:
            gaps.remove(gap)
        gaps.append(gap - n)
    return len(gaps)


def base_secrets(text):
    """Base spans as the patterns are stated."""
    text = text or ""
    found = []
    name = r"(password|passwd|secret|token|api_?key)"
    ascii_any_case = re.sub("[a-z]", lambda m: f"[{m[0]}{m[0].upper()}]", name)
    for m in re.finditer(ascii_any_case + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 8:
            found.append((m.start(), 0, "assign", m.end()))
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return [f"{k}:{a}:{b}" for a, _, k, b in sorted(found)]


def usable(vector, zero=False):
    """The vector as doubles if it counts; zero vectors count only if ``zero``."""
    fine = vector and all(x is not None and np.isfinite(x) for x in vector)
    return [float(x) for x in vector] if fine and (zero or any(vector)) else None


def grid_codes(rows, parts=16, entries=64, rounds=2):
    """(vec_id, code, error, label_error) of (vec_id, vector, label), plainly in whole numbers."""
    last = max((i for i, *_ in rows if i is not None), default=0) + 1
    kept = [(i, [int(np.floor(256 * x)) for x in usable(v, True)], y) for i, v, y in rows if usable(v, True)]
    kept.sort(key=lambda r: (last if r[0] is None else r[0], r[1]))
    width = len(kept[0][1]) // parts
    cut = [[tuple(v[p * width: (p + 1) * width]) for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            own = defaultdict(list)
            for c in cut:
                own[nearest(p, c[p])[1]].append(c[p])
            for k, points in own.items():
                books[p][k] = tuple(sum(x) // len(points) for x in zip(*points))
    found = [[nearest(p, c[p]) for p in range(parts)] for c in cut]
    totals = Counter()
    for (_, _, y), f in zip(kept, found):
        totals[y] += sum(d for d, _ in f)
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [(i, "".join(f"{k:02x}" for _, k in f), sum(d for d, _ in f), totals[y]) for (i, _, y), f in zip(kept, found)], digest


def nearest_vectors(rows, asked, k=10):
    """(query_id, rank, vec_id, score) of (vec_id, vector) rows."""
    points = sorted({(i, tuple(usable(v))) for i, v in rows if i is not None and usable(v)})
    out = []
    for q, v in points:
        if asked(q):
            near = []
            for i, w in points:
                if i != q and len(w) == len(v):
                    total = 0.0
                    for a, b in zip(v, w):
                        total += (a - b) * (a - b)
                    near.append((math.sqrt(total), i))
            out += [(q, n + 1, i, s) for n, (s, i) in enumerate(sorted(near)[:k])]
    return out
