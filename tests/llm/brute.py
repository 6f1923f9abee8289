"""Plain versions of the operators, for small inputs."""

import re
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def shingle_set(text):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def near(rows):
    """{id: (set size, component)} of (id, text)."""
    sets = {i: shingle_set(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    inverted = defaultdict(list)
    for i in sorted(sets):
        common = Counter(o for s in sets[i] for o in inverted[s])
        for o, n in common.items():
            if 100 * n >= 75 * (len(sets[o]) + len(sets[i]) - n):
                a, b = find(o), find(i)
                parent[max(a, b)] = min(a, b)
        for s in sets[i]:
            inverted[s].append(i)
    return {i: (len(sets[i]), find(i)) for i in sets}


def luhn(digits):
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (2 if place % 2 else 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in PII.items():
        for hit in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", hit[0])
            if kind == "ip" and any(int(part) > 255 for part in hit[0].split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, hit.start(), hit.end()))
    return out


def quality_counts(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    return [
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
        len(covered),
    ]
