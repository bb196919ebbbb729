"""Plain Python forms of the operators, for small inputs."""

from __future__ import annotations

import collections
import re


def words(text):
    return (text or "").encode().split()


def near_groups(texts, percent):
    sets = {}
    for key, text in texts.items():
        w = (text or "").encode().lower().split()
        whole = {tuple(w)} if w else set()
        sets[key] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else whole
    holders, shared = collections.defaultdict(list), collections.Counter()
    for key in sorted(sets):
        for shingle in sets[key]:
            for other in holders[shingle]:
                shared[other, key] += 1
            holders[shingle].append(key)
    root = {key: key for key in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, b), both in shared.items():
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {k: (len(sets[k]), find(k), find(k) == k) for k in sets}


def without_repeats(texts, size):
    """Per document: words, removed words, kept words joined by a space."""
    seen, out = set(), {}
    for key in sorted(texts):
        w = words(texts[key])
        gone = set()
        for i in range(len(w) - size + 1):
            run = tuple(w[i : i + size])
            if run in seen:
                gone |= set(range(i, i + size))
            seen.add(run)
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone).decode()
        out[key] = (len(w), len(gone), kept)
    return out


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
    return len(b) == len(a) + 1 and any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def kept_lines(texts, least=8):
    """Per document: text without repeated lines, lines with words, removed lines."""
    earlier, out = [], {}
    exact = set()
    for key in sorted(texts):
        if texts[key] is None:
            out[key] = (None, 0, 0)
            continue
        kept, n, gone = [], 0, 0
        for line in texts[key].split("\n"):
            w = tuple(words(line))
            if not w:
                kept.append(line)
                continue
            n += 1
            near = w in exact or len(w) >= least and any(
                abs(len(x) - len(w)) <= 1 and one_edit(w, x) for x in earlier
            )
            if near:
                gone += 1
            else:
                kept.append(line)
            if w not in exact:
                exact.add(w)
                if len(w) >= least:
                    earlier.append(w)
        out[key] = ("\n".join(kept), n, gone)
    return out


def contaminated(texts, items, size=13):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def split(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(lower))

    windows = collections.defaultdict(set)
    for text in items.values():
        w = split(text)
        for i in range(max(1, len(w) - size + 1)):
            if w:
                windows[len(w[i : i + size])].add(tuple(w[i : i + size]))
    bad = set()
    for key, text in texts.items():
        w, hit = split(text), set()
        for n, runs in windows.items():
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in runs:
                    hit |= set(range(i, i + n))
        if hit and 20 * len(hit) >= len(w):
            bad.add(key)
    return bad
