"""Plain versions of the operators, by definition."""

import re


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


def shingles(text, size=5):
    w = words(text)
    return {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} or ({tuple(w)} if w else set())


def groups(links):
    """Smallest member of each linked id's component."""
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {x: find(x) for x in root}


def near_duplicates(rows):
    sets = {i: shingles(t) for i, t in rows}
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    component = groups(links)
    return {i: (len(sets[i]), component.get(i, i), component.get(i, i) == i) for i in ids}


def targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Shares of sources by weight, those above ``most`` times their size stopped, the rest dealt again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, full = share * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in full]
        if not free:
            return full
        rest = total - sum(full.values())
        part = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if part[s] > most * sizes[s]]
        if not over:
            return full | part
        full |= {s: most * sizes[s] for s in over}
