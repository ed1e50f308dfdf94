"""Plain versions of what the operators compute."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
RULES = {
    "assign": (re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 12),
    "access": (re.compile("AKIA[A-Z0-9]+"), 0, 18),
    "hex": (re.compile("[0-9a-f]+"), 0, 16),
}


def python_spans(text: str) -> list[tuple[int, int]]:
    return sorted((m.start(), m.end()) for p, g, n in RULES.values() for m in p.finditer(text) if len(m.group(g)) >= n)


def brute_components(texts: dict[int, str]) -> dict[int, tuple[int, int]]:
    sets = {}
    for i, t in texts.items():
        w = WORD.findall(re.sub("[A-Z]", lambda m: m.group(0).lower(), t))
        sets[i] = frozenset(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) if w else frozenset()
    root = {i: i for i in sets}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in ids}
