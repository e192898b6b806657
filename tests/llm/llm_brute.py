"""Brute-force forms that several tests compare with."""

import collections
import hashlib


def brute_near(rows, width, percent):
    sets = []
    for _, t in rows:
        w = (t or "").translate({c: c + 32 for c in range(65, 91)}).split()
        sets.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            both = rows[i][0] == rows[j][0] and rows[i][0] is not None and a and b
            if (a and b and rows[i][0] is not None and rows[j][0] is not None and 100 * len(a & b) >= percent * len(a | b)) or both:
                parent[root(i)] = root(j)
    out = []
    for i, (d, _) in enumerate(rows):
        same = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        c = min(same) if d is not None and sets[i] else d
        out.append((d, len(sets[i]), c, d == c))
    return sorted(out, key=str)


def brute_lines(rows):
    low = {c: c + 32 for c in range(65, 91)}
    key = lambda line: line.strip(" \t\n\r\x0b\x0c").translate(low)
    held = collections.defaultdict(set)
    for d, t in rows:
        for line in (t or "").split("\n"):
            held[key(line)].add(d)
    common = {k: max(d, key=lambda x: -1 if x is None else x) for k, d in held.items() if len(k) >= 40 and len(d) >= 5}
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if key(x) not in common or common[key(x)] == d]
        out.append((d, len(lines), len(lines) - len(stay), hashlib.sha256("\n".join(stay).encode()).hexdigest()))
    return sorted(out, key=str)
