"""Plain Python versions of what the queries must return."""

import hashlib
import re
from collections import Counter, defaultdict

BLANK = "[^\x20\x09-\x0d]+"
TOKEN = "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def low(text):
    return (text or "").translate({ord(c): c.lower() for c in UPPER})


def blanks(text):
    return re.findall(BLANK, text or "")


def tokens(text):
    return re.findall(TOKEN, low(text))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def line_dedup(rows, least=10):
    """rows: (doc_id, text); result by position: (n_lines, n_dropped, kept text)."""
    seen = defaultdict(set)
    key = lambda line: low(line.strip(" \t\n\x0b\x0c\r"))
    for i, text in rows:
        for line in (text or "").split("\n"):
            seen[key(line)].add(i)
    out = []
    for _, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (key(x) and len(seen[key(x)]) >= least)]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def grams(words, n):
    if not words:
        return set()
    return {tuple(words[i : i + n]) for i in range(max(len(words) - n + 1, 1))}


def components(rows, n=3, percent=90):
    """rows: (doc_id, text); result: doc_id -> smallest id reachable."""
    sets = [(i, grams(blanks(low(t)), n)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                u, v = sorted((find(i), find(j)))
                root[v] = u
    return {i: find(i) for i in root}


def contaminated(rows, items, window=10):
    """Result by position: (n_words, n_hit, item ids sorted as strings)."""
    wanted = []
    for item, text in items:
        words = tokens(text)
        if words and len(words) < window:
            wanted.append((item, words))
        wanted += [(item, words[i : i + window]) for i in range(len(words) - window + 1)]
    out = []
    for _, text in rows:
        words, hit, ids = tokens(text), set(), set()
        for item, w in wanted:
            for i in range(len(words) - len(w) + 1):
                if words[i : i + len(w)] == w:
                    hit |= set(range(i, i + len(w)))
                    ids.add(item)
        out.append((len(words), len(hit), sorted(str(i) for i in ids if i is not None)))
    return out


def quality_counts(text):
    words, lines = blanks(text), (text or "").split("\n")
    with_word = [x for x in lines if blanks(x)]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    repeated = {
        i + k
        for i in range(len(words) - 4)
        if windows[tuple(words[i : i + 5])] > 1
        for k in range(5)
    }
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text or ""),
        len(with_word) - len(set(with_word)),
        len(repeated),
    )


def base_secrets(text):
    text = text or ""
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    spans = [
        ("assign", m.start(), m.end())
        for m in re.finditer(assign, text, re.I | re.A)
        if len(m[2]) >= 12
    ]
    spans += [
        ("access", m.start(), m.end())
        for m in re.finditer("AKIA[A-Z0-9]+", text)
        if len(m[0]) >= 18
    ]
    spans += [
        ("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16
    ]
    return sorted(spans, key=lambda s: (s[1], ["assign", "access", "hex"].index(s[0])))


def targets(sizes, weights=(1, 2, 3), repeats=3):
    """sizes: source -> words; the excess of capped sources is shared until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in capped]
        if not free:
            return capped
        rest = total - sum(capped.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        above = [s for s in free if share[s] > repeats * sizes[s]]
        if not above:
            return capped | share
        capped |= {s: float(repeats * sizes[s]) for s in above}
