"""Plain Python versions of the contracts, quadratic where that is simplest."""

import hashlib
import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def op1(text):
    text = text or ""
    ws = words(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    win = [tuple(ws[i:i + 5]) for i in range(len(ws) - 4)]
    c = Counter(win)
    covered = {i + k for i, w in enumerate(win) if c[w] > 1 for k in range(5)}
    failed = len(ws) < 10 or 100 * len(covered) > 20 * len(ws)
    return (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed)


def luhn(d):
    t = 0
    for i, c in enumerate(reversed(d)):
        v = int(c)
        if i % 2:
            v = v * 2 if v < 5 else v * 2 - 9
        t += v
    return t % 10 == 0


def op4(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub(r"[^0-9]", "", m.group())
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub(r"[^0-9]", "", m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    out.sort()
    kinds = ("email", "ip", "card", "phone")
    said = ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in out)
    return tuple(sum(k == i for _, k, _ in out) for i in range(4)) + (hashlib.sha256(said.encode()).hexdigest(),)


def op6(texts, n=35):
    ws = [words(t) for t in texts]
    c = Counter(tuple(w[i:i + n]) for w in ws for i in range(len(w) - n + 1))
    out = []
    for w in ws:
        gone = {i + k for i in range(len(w) - n + 1) if c[tuple(w[i:i + n])] > 1 for k in range(n)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def lower(t):
    return re.sub("[A-Z]", lambda m: m.group().lower(), t or "")


def op8(ids, texts, n=5):
    sets = []
    for t in texts:
        w = words(lower(t))
        sets.append({tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
    root = {i: i for i in range(len(ids))}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * min(len(a), len(b)) >= 80 * max(len(a), len(b)):
                k = len(a & b)
                if 100 * k >= 80 * (len(a) + len(b) - k):
                    x, y = find(i), find(j)
                    root[x] = y
    least = {}
    for i, d in enumerate(ids):
        least[find(i)] = min(d, least.get(find(i), d))
    return [(len(s), least[find(i)]) for i, s in enumerate(sets)]


def crc(ids):
    return zlib.crc32(b"".join(int(i).to_bytes(4, "little") for i in ids))
