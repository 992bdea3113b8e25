"""Brute-force versions that several test modules share."""

import re
from collections import Counter

from plumbline.llm import pii

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measures(text):
    w = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = Counter(zip(w, w[1:], w[2:]))
    hit = {i + k for i, x in enumerate(zip(w, w[1:], w[2:])) if windows[x] > 1 for k in range(3)}
    return (len(w), sum(map(len, w)), sum((text or "").count(s) for s in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit))


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+".replace(r"\x20-", " -"), "phone": r"\+[0-9][ ().0-9-]+[0-9]"}


def base_brute(text):
    found = {k: [m.span() for m in re.finditer(p, text)] for k, p in BASE.items()}
    digits = lambda s: "".join(c for c in s if c in "0123456789")
    found["ip"] = [(a, b) for a, b in found["ip"] if all(int(x) <= 255 for x in text[a:b].split("."))]
    found["card"] = [(a, b) for a, b in found["card"] if 13 <= len(digits(text[a:b])) <= 19 and pii.luhn(digits(text[a:b]))]
    found["phone"] = [(a, b) for a, b in found["phone"] if 9 <= len(digits(text[a:b])) <= 15]
    return found


def shingle_set(text, width):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    return frozenset([tuple(w)] if 0 < len(w) < width else zip(*(w[k:] for k in range(width))))


def brute_components(rows, width):
    sets = {}
    parent = {}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, t in rows:
        sets.setdefault(i, []).append(shingle_set(t, width))
        parent[i] = i
    flat = [(i, s) for i, ss in sets.items() for s in ss if s]
    for k, (i, a) in enumerate(flat):
        for j, b in flat[:k]:
            if 100 * min(len(a), len(b)) >= 80 * max(len(a), len(b)) and 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return {i: root(i) for i in parent}
