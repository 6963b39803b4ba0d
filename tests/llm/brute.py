"""Plain versions that the operators are held against."""

import hashlib
import math
import re
from itertools import combinations

PII = (
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), lambda m: True),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), lambda m: all(int(x) <= 255 for x in m.split("."))),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+"), lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m))),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda m: 9 <= len(digits(m)) <= 15),
)
KEYWORD = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
SECRETS = (
    ("assign", re.compile(rf"({KEYWORD})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"), lambda m: len(m[2]) >= 6),
    ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24),
)


def digits(s):
    return re.sub("[^0-9]", "", s)


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        v = int(c)
        total += (v if i % 2 == 0 else v * 2 - 9 if v > 4 else v * 2)
    return total % 10 == 0


def pii(text):
    """(counts, spans by kind and start)."""
    found = [[(k, m.start(), m.end()) for m in p.finditer(text or "") if ok(m[0])] for k, p, ok in PII]
    return [len(x) for x in found], ",".join("%s:%d:%d" % x for own in found for x in own)


def secrets(text):
    """(counts, spans by start and kind)."""
    found = [[(m.start(), k, name, m.end()) for m in p.finditer(text or "") if ok(m)] for k, (name, p, ok) in enumerate(SECRETS)]
    return [len(x) for x in found], ",".join(f"{n}:{s}:{e}" for s, _, n, e in sorted(sum(found, [])))


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def components(docs, k, percent):
    """Smallest linked id of each (id, text)."""
    sets, root = {}, {}
    for i, t in docs:
        sets.setdefault(i, []).append(shingles(t, k))
        root[i] = i

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, y in combinations(sorted(sets), 2):
        for a in sets[x]:
            for b in sets[y]:
                if a and b and min(len(a), len(b)) * 100 >= percent * max(len(a), len(b)) and 100 * len(a & b) >= percent * len(a | b):
                    p, q = find(x), find(y)
                    root[max(p, q)] = min(p, q)
    return {i: find(i) for i in root}


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def contamination(text, items, size=10):
    """(words, hit words, items)."""
    w, hit, found = words(text), set(), set()
    for item, t in items:
        v = words(t)
        for i in range(max(1, len(v) - size + 1) if v else 0):
            part = v[i : i + size]
            for j in range(len(w) - len(part) + 1):
                if w[j : j + len(part)] == part:
                    hit |= set(range(j, j + len(part)))
                    found.add(item)
    return len(w), len(hit), found


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def bucket(gram: bytes, bits: int) -> int:
    """The hash bucket of an n-gram."""
    key = 0
    for c in gram:
        key = (key * 16777619 + c) % 2**32
    key = ((key ^ (key >> 15)) * 0x9E3779B1 + len(gram) * 0x85EBCA6B) % 2**32
    return ((key ^ (key >> 13)) * 0xC2B2AE35) % 2**32 >> (32 - bits)


def grams(word: bytes, sizes, bits: int) -> list[int]:
    """The buckets of a word's n-grams with a boundary on either side."""
    padded = b"\0" + word + b"\0"
    return [bucket(padded[i : i + n], bits) for n in sizes for i in range(len(padded) - n + 1)]


def rejected(text, model, table: bytes, sizes, bits: int) -> bool:
    """Whether a language model turns a text away: the plain average of its n-grams' commonness, odds, threshold."""
    if not re.search(r"[^\W\d_]", text or ""):
        return True
    counted: dict[bytes, int] = {}
    for w in text.encode().translate(table).split(b"\0"):
        if w:
            counted[w] = counted.get(w, 0) + 1
    total, n = 0.0, 0
    for w, k in counted.items():
        for g in grams(w, sizes, bits):
            n += k
            total += k * float(model.table[g, -1])
    common, sure = max(total / max(n, 1), -16) / 4, 1 / math.sqrt(max(n, 1))
    odds = sum(x * float(v) for x, v in zip((1, common, sure, common * sure), model.weights))
    return 1 / (1 + math.exp(-max(-60.0, min(60.0, odds)))) < model.reject


def redacted(text, model, token: str, mark: str = "[SECRET]"):
    """A text without its secrets: stated patterns, and tokens that the character model calls random."""
    if text is None:
        return None
    base = [(m.start(), m.end()) for _, p, ok in SECRETS for m in p.finditer(text) if ok(m)]
    more = [(m.start(), m.end()) for m in re.finditer(token, text) if not any(a <= m.start() and m.end() <= b for a, b in base) and model.mean_ratio(m[0]) >= model.threshold(len(m[0]))]
    merged = []
    for a, b in sorted(base + more):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    for a, b in reversed(merged):
        text = text[:a] + mark + text[b:]
    return text
