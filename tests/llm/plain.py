"""Plain versions of the operators' contracts, row by row, for small inputs."""

import re
from collections import Counter, defaultdict

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lowered(text):
    return (text or "").translate(LOW)


def space_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lowered(text))


def alnum_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


def shingle_set(text):
    w = space_words(text)
    return set(zip(*(w[i:] for i in range(5)))) if len(w) >= 5 else {tuple(w)} if w else set()


def near_groups(docs):
    """{doc_id: (n_shingles, component_id)} of (doc_id, text) pairs with distinct ids."""
    sets = {d: shingle_set(t) for d, t in docs}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


def benchmark_hits(text, items):
    """(n_words, n_hit, sorted item ids)."""
    words = alnum_words(text)
    hit, found = set(), set()
    for item, item_text in items:
        own = alnum_words(item_text)
        n = min(10, len(own))
        for i in range(len(own) - n + 1 if n else 0):
            for j in range(len(words) - n + 1):
                if words[j:j + n] == own[i:i + n]:
                    hit.update(range(j, j + n))
                    found.add(str(item))
    return len(words), len(hit), sorted(found)


def without_repeated_lines(docs):
    """{doc_id: text} of (doc_id, text) pairs with distinct ids."""
    first, windows = {}, defaultdict(list)
    for d, text in sorted((d, t) for d, t in docs if t is not None):
        lines = text.split("\n")
        full = [i for i, x in enumerate(lines) if x.strip(" ")]
        for k in range(len(full) - 2):
            own = full[k:k + 3]
            seen = tuple(lines[i].strip(" ") for i in own)
            if first.setdefault(seen, (d, k)) != (d, k):
                windows[d] += own
    return {d: t if t is None else "\n".join(
        x for i, x in enumerate(t.split("\n")) if i not in windows[d]) for d, t in docs}


def base_spans(text):
    """The base secrets: kind, start, end."""
    rules = [("assign", r"((?:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
                        r"([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII, 2, 12),
             ("access", r"AKIA[A-Z0-9]+", 0, 0, 18), ("hex", r"[0-9a-f]+", 0, 0, 16)]
    return [(m.start(), i, f"{kind}:{m.start()}:{m.end()}")
            for i, (kind, pattern, flags, group, least) in enumerate(rules)
            for m in re.finditer(pattern, text or "", flags) if len(m[group]) >= least]


def unigrams(docs, learned):
    counts = Counter()
    for d, text in docs:
        if learned(d):
            counts.update([*space_words(text), None])
    return counts
