"""Plain Python versions, for small tables."""

import re

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def alphabetic(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def shingles(text, size=5):
    words = spaced((text or "").translate(LOW))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1)))


def groups(sets, linked):
    """Least key reachable by links, for each key of ``sets``."""
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    keys = list(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if sets[a] and sets[b] and linked(sets[a], sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {k: find(k) for k in sets}


def similar(a, b):
    both = len(a & b)
    return 100 * both >= 75 * (len(a) + len(b) - both)


def lines_repeated_anywhere(documents, min_words):
    """As repeated_lines, but by all earlier places of each line."""
    lines = {k: [x.strip() for x in t.split("\n")] for k, t in documents}
    gone = {k: set() for k in lines}
    for key, own in lines.items():
        for other, source in lines.items():
            for shift in range(1 - len(own), len(source)):
                if other > key or other == key and shift >= 0:
                    continue
                run = []
                for i in range(len(own) + 1):
                    if i < len(own) and 0 <= i + shift < len(source) and own[i] == source[i + shift]:
                        run.append(i)
                        continue
                    if sum(len(own[j].split()) for j in run) >= min_words:
                        gone[key] |= set(run)
                    run = []
    return gone


def repeated_lines(documents, min_words):
    """Line numbers to delete of each (key, text), keys in order, by the definition."""
    seen, runs = {}, {}
    lines = {k: [x.strip() for x in t.split("\n")] for k, t in documents}
    for key, _ in documents:
        own, gone = lines[key], set()
        for a in range(len(own)):
            total, b = 0, a - 1
            while total < min_words and b + 1 < len(own):
                b += 1
                total += len(own[b].split())
            if total < min_words or not own[a]:
                continue
            window = tuple(own[a:b + 1])
            if window not in seen:
                seen[window] = (key, a)
                continue
            other, at = seen[window]
            source, x, y = lines[other], a, b
            while x > 0 and x + at - a > 0 and own[x - 1] == source[x - 1 + at - a]:
                x -= 1
            while y + 1 < len(own) and y + 1 + at - a < len(source) and own[y + 1] == source[y + 1 + at - a]:
                y += 1
            gone |= set(range(x, y + 1))
        runs[key] = gone
    return runs
