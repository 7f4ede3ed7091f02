"""Plain, slow versions of the operators for small inputs."""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {k: k + 32 for k in range(65, 91)}


def words(text, lower=False):
    text = text or ""
    return WORD.findall(text.translate(LOWER) if lower else text)


def shingles(text, k):
    w = words(text, True)
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def components(docs, k, percent):
    """Least id reachable, per document of ``docs`` (id, text)."""
    sets = [(d, shingles(t, k)) for d, t in docs]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, j in itertools.combinations(range(len(sets)), 2):
        (d, a), (e, b) = sets[i], sets[j]
        if d is not None and e is not None and a and b and 100 * len(a & b) >= percent * len(a | b):
            parent[find(j)] = find(i)
    least = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [(d, len(s), least[find(i)] if d is not None else None) for i, (d, s) in enumerate(sets)]


def repeats(docs, size=13):
    first = {}
    for d, t in docs:
        w = words(t)
        for i in range(len(w) - size + 1):
            key = tuple(w[i:i + size])
            if d is not None:
                first[key] = min(first.get(key, d), d)
    out = []
    for d, t in docs:
        w = words(t)
        gone = set()
        for i in range(len(w) - size + 1):
            if d is not None and first[tuple(w[i:i + size])] < d:
                gone.update(range(i, i + size))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def statistics(text):
    text = text or ""
    w = words(text)
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    count = Counter(windows)
    covered = {i + j for i, x in enumerate(windows) if count[x] > 1 for j in range(8)}
    seen, duplicate = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            duplicate += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), duplicate, len(covered))


def edit_rows(a, b):
    """Edit distances of ``a`` to all beginnings of ``b``."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return row


def edit_distance(a, b):
    return edit_rows(a, b)[-1]


def leaks(docs, items, rate):
    out = {}
    for d, t in docs:
        w = words((t or "").lower())
        for i, x in items:
            v = words((x or "").lower())
            k = int(rate * len(v))
            found = [(min(edit_rows(v, w[s:s + len(v) + k])), s) for s in range(len(w))] if v else []
            if found and min(found)[0] <= k:
                out[d, i] = min(found)
    return out


def kneser_ney(docs, train):
    """(n_tokens, n_known, base, score) per text of ``docs``, trained on ``train``."""
    ends = lambda t: [*words(t, True), None]
    uni, pair = Counter(), Counter()
    for t in train:
        uni.update(ends(t))
        pair.update(zip([0, *ends(t)], ends(t)))
    n, v, kinds = sum(uni.values()), len(uni), len(pair)
    cont, total, seen = Counter(), Counter(), defaultdict(lambda: [0, 0, 0])
    for (a, b), c in pair.items():
        cont[b] += 1
        total[a] += c
        seen[a][min(c, 3) - 1] += 1

    def discount(values):
        c = Counter(values)
        plain = [0, 0.5, 1.0, 1.5]
        if not (c[1] and c[2] and c[3]):
            return plain
        y = c[1] / (c[1] + 2 * c[2])
        d = [0, *(k - (k + 1) * y * c[k + 1] / c[k] for k in (1, 2, 3))]
        return [x if 0 <= x <= k else plain[k] for k, x in enumerate(d)]
    dp, dc = discount(pair.values()), discount(cont.values())
    spare = sum(dc[min(x, 3)] for x in cont.values()) / kinds if kinds else 1.0

    def p(a, b):
        one = max(cont[b] - dc[min(cont[b], 3)], 0) / max(kinds, 1) + spare / (v + 1)
        if not total[a]:
            return one
        gamma = sum(dp[k + 1] * seen[a][k] for k in range(3)) / total[a]
        return max(pair[a, b] - dp[min(pair[a, b], 3)], 0) / total[a] + gamma * one
    out = []
    for t in docs:
        e = ends(t)
        out.append((len(e), sum(uni[x] > 0 for x in e),
                    sum(math.log10((uni[x] + 0.1) / (n + 0.1 * (v + 1))) for x in e),
                    sum(math.log10(p(a, b)) for a, b in zip([0, *e], e))))
    return out, p, list(uni)


def url_model(shapes, order=4):
    """Score function of the two character models; ``shapes``: (shape, verdict or None)."""
    pad, end = "\x02" * order, "\x03"
    grams = lambda s: [(pad + s + end)[i:i + order + 1] for i in range(len(s) + 1)]
    alphabet = {g[-1] for s, _ in shapes for g in grams(s)}
    models = {}
    for label in ("allow", "block"):
        count = defaultdict(Counter)
        for s, verdict in shapes:
            if verdict == label:
                for g in grams(s):
                    for k in range(order + 1):
                        count[g[order - k:order]][g[-1]] += 1
        models[label] = count

    def p(count, context, c):
        lower = p(count, context[1:], c) if context else 1 / len(alphabet)
        followers = count.get(context)
        if not followers:
            return lower
        return (followers[c] + len(followers) * lower) / (sum(followers.values()) + len(followers))
    return lambda s: sum(math.log(p(models["allow"], g[:-1], g[-1]) / p(models["block"], g[:-1], g[-1]))
                         for g in grams(s)) / (len(s) + 1)
