"""Plain versions of the corpus operators, for small inputs."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np

from marquee.llm import mixing, quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACE = " \t\n\x0b\f\r"
LAST = 1 << 63


def rank(doc_id):
    return LAST if doc_id is None else doc_id


def covered(seqs, window):
    """For (id, sequence) rows, the places covered by a window that a smaller id has."""
    least = {}
    for doc_id, seq in seqs:
        for k in range(len(seq) - window + 1):
            key = seq[k : k + window]
            least[key] = min(least.get(key, LAST), rank(doc_id))
    found = []
    for doc_id, seq in seqs:
        gone = set()
        for k in range(len(seq) - window + 1):
            if least[seq[k : k + window]] < rank(doc_id):
                gone.update(range(k, k + window))
        found.append(gone)
    return found


def without_windows(rows):
    seqs = [(i, tuple(WORD.findall(t or ""))) for i, t in rows]
    return [
        (i, len(w), len(g), " ".join(x for k, x in enumerate(w) if k not in g))
        for (i, w), g in zip(seqs, covered(seqs, 50), strict=True)
    ]


def without_bytes(rows):
    seqs = [(i, (t or "").encode()) for i, t in rows]
    out = []
    for (i, b), g in zip(seqs, covered(seqs, 50), strict=True):
        runs = sum(1 for k in g if k - 1 not in g)
        out.append((i, len(b), len(g), runs, bytes(x for k, x in enumerate(b) if k not in g)))
    return out


def counts(text):
    """word, character, symbol, duplicate line and repeated word counts of a text."""
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = list(zip(words, words[1:], words[2:], strict=False))
    n = Counter(windows)
    again = {k + d for k, g in enumerate(windows) if n[g] > 1 for d in range(3)}
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(again)


def bag(text):
    w = WORD.findall(text or "")
    return Counter(tuple(w[k : k + 5]) for k in range(max(len(w) - 4, min(len(w), 1))))


def near_classes(rows):
    """Least id of the class of each (id, text) row."""
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    bags = [bag(t) for _, t in rows]
    for a in range(len(rows)):
        for b in range(a):
            common = sum((bags[a] & bags[b]).values())
            total = sum(bags[a].values()) + sum(bags[b].values()) - common
            if (rows[a][1] or "") == (rows[b][1] or "") or total and common >= 0.8 * total:
                parent[find(a)] = find(b)
    least = defaultdict(lambda: LAST)
    for k, (i, _) in enumerate(rows):
        least[find(k)] = min(least[find(k)], rank(i))
    return [least[find(k)] for k in range(len(rows))]


def common_lines(left, right):
    """Pairs of places of a longest common subsequence, by the plain table."""
    best = [[0] * (len(right) + 1) for _ in range(len(left) + 1)]
    for a in reversed(range(len(left))):
        for b in reversed(range(len(right))):
            best[a][b] = 1 + best[a + 1][b + 1] if left[a] == right[b] else max(best[a + 1][b], best[a][b + 1])
    found, a, b = [], 0, 0
    while a < len(left) and b < len(right):
        if left[a] == right[b]:
            found.append((a, b))
            a, b = a + 1, b + 1
        elif best[a + 1][b] >= best[a][b + 1]:
            a += 1
        else:
            b += 1
    return found


def lost_in_pair(left, right, least_words):
    """Places of the lines `right` that it loses to `left`: blocks of a longest common subsequence, then what is left in any order."""
    used, gone, block = set(), set(), []
    for pair in [*common_lines(left, right), (None, None)]:
        if block and pair != (block[-1][0] + 1, block[-1][1] + 1):
            if sum(len(WORD.findall(right[b])) for _, b in block) >= least_words:
                used |= {a for a, _ in block}
                gone |= {b for _, b in block}
            block = []
        block.append(pair)
    for b in range(len(right)):
        for a in range(len(left)):
            n = 0
            while (
                a + n < len(left) and b + n < len(right) and left[a + n] == right[b + n]
                and a + n not in used and b + n not in gone
            ):
                n += 1
            if sum(len(WORD.findall(x)) for x in right[b : b + n]) >= least_words:
                used |= set(range(a, a + n))
                gone |= set(range(b, b + n))
    return gone


def without_lines(rows, least_words=10):
    """(kept text, lines with a word, lines removed) of each (id, text) row, every text held against every earlier one."""
    rows = [(rank(i), t or "") for i, t in rows]
    least = {}
    for i, t in rows:
        least[t] = min(least.get(t, LAST), i)
    filled = {t: [(k, x.strip(SPACE)) for k, x in enumerate(t.split("\n")) if WORD.search(x)] for t in least}
    lost = defaultdict(set)
    order = sorted((i, t) for t, i in least.items())
    for n, (_, later) in enumerate(order):
        for _, earlier in order[:n]:
            found = lost_in_pair([x for _, x in filled[earlier]], [x for _, x in filled[later]], least_words)
            lost[later] |= {filled[later][b][0] for b in found}
    out = []
    for i, t in rows:
        n = len(filled[t])
        if i != least[t]:
            out.append(("", n, n))
        else:
            out.append(("\n".join(x for k, x in enumerate(t.split("\n")) if k not in lost[t]), n, len(lost[t])))
    return out


def item_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def hits(text, items):
    """(words, hit words, ids of the items with a window in the text)."""
    words = item_words(text)
    hit, found = set(), set()
    for item, body in items:
        w = item_words(body)
        n = min(10, len(w))
        windows = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if w else set()
        for k in range(len(words) - n + 1):
            if tuple(words[k : k + n]) in windows:
                hit.update(range(k, k + n))
                found.add("" if item is None else str(item))
    return len(words), len(hit), sorted(found)


def verdicts(rows):
    """Which (id, text) rows the quality rules keep, with the votes recomputed from plain counts."""
    found = []
    for _, t in rows:
        t = t or ""
        n, chars, symbols, dups, again = counts(t)
        lines = [x for x in t.split("\n") if WORD.search(x)]
        upper, letters = sum(c.isupper() for c in t), sum(c.isalpha() for c in t)
        marks = len(re.findall(r"!!|[|]", t))
        ended = sum(bool(re.search(r"[.!?:][\"')]?\s*$", x)) for x in lines)

        def vote(good, bad):
            return -1 if bad else int(good)

        pattern = (
            vote(50 * symbols <= n, 10 * symbols > n),
            vote(10 * letters >= 9 * chars, 10 * letters < 8 * chars),
            vote(100 * marks <= n, 10 * marks > n),
            vote(10 * upper <= letters, 2 * upper > letters),
            vote(dups == 0 and len(lines) > 1, 10 * dups > 4 * len(lines)),
            vote(10 * again <= n, 10 * again > 3 * n),
            vote(4 * n <= chars <= 7 * n, not 3 * n <= chars <= 10 * n),
            vote(10 * ended >= 8 * len(lines), 2 * ended < len(lines)),
        )
        found.append((pattern, n < 50 or 100 * again > 50 * n))
    good = good_probabilities([pattern for pattern, _ in found])
    return [not failed and p >= 0.5 for (_, failed), p in zip(found, good, strict=True)]


def good_probabilities(votes):
    """Expectation-maximisation over single documents, in probabilities: two classes, rules independent given the class."""
    votes = np.array(votes, float)
    n, n_rules = votes.shape
    prior = quality.PRIOR
    right = np.array([[quality.RIGHT_ON_GOOD] * n_rules, [quality.RIGHT_ON_BAD] * n_rules])

    def of_good():
        on_good = np.where(votes > 0, right[0], np.where(votes < 0, 1 - right[0], 1)).prod(axis=1) * prior
        on_bad = np.where(votes < 0, right[1], np.where(votes > 0, 1 - right[1], 1)).prod(axis=1) * (1 - prior)
        return on_good / (on_good + on_bad)

    for _ in range(quality.ROUNDS):
        good = of_good()[:, None]
        held = quality.HELD * n
        right = np.array([
            ((good * (votes > 0)).sum(axis=0) + held * quality.RIGHT_ON_GOOD) / ((good * (votes != 0)).sum(axis=0) + held),
            (((1 - good) * (votes < 0)).sum(axis=0) + held * quality.RIGHT_ON_BAD) / (((1 - good) * (votes != 0)).sum(axis=0) + held),
        ])
        prior = min(max(good.mean(), 0.01), 0.99)
    return of_good()


def copies(rows):
    """How often each (id, text, source) row is taken."""
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(names)}
    target, capped = {}, set()
    while True:
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in capped)
        open_ = [s for s in names if s not in capped]
        total = sum(weight[s] for s in open_)
        target = {s: weight[s] * left / total for s in open_} | {s: 3.0 * sizes[s] for s in capped}
        over = {s for s in open_ if target[s] > 3 * sizes[s]}
        if not over:
            break
        capped |= over
    out, seen = [], Counter()
    for i, t, s in rows:
        rate = target[s] / sizes[s] if sizes[s] else 0.0
        number = seen[i, t or "", s]
        seen[i, t or "", s] += 1
        key = f"{mixing.SEED}:{'' if i is None else i}:{hashlib.sha256((t or '').encode()).hexdigest()}:{number}"
        draw = int(hashlib.sha256(key.encode()).hexdigest()[:13], 16) / 2**52
        out.append(int(rate) + (draw < rate - int(rate)))
    return out
