"""Plain single-threaded versions of the operators, for small inputs."""

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def order(i):
    return (i is None, i if i is not None else 0)


def quality(text):
    w = words(text)
    grams = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    count, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if count[g] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    n = len(w)
    return (n, sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered),
            n < 20 or 100 * len(covered) > 30 * n)


def shingles(text, n=5):
    w = words(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if len(w) < n:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1))


def jaccard(docs):
    """docs: (id, text); returns (id, size, component) rows."""
    sets = [shingles(t) for _, t in docs]
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (key, _) in enumerate(docs):
        least[root(i)] = min(least.get(root(i), key), key, key=order)
    return [(key, len(sets[i]), least[root(i)] if sets[i] else key) for i, (key, _) in enumerate(docs)]


def suffix_removal(docs, length=100):
    """docs: distinct (id, text); returns (id, bytes, removed, spans, digest) rows."""
    seen, out = set(), []
    for key, text in sorted(docs, key=lambda d: order(d[0])):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            window = data[p:p + length]
            if window in seen:
                gone[p:p + length] = b"\1" * length
            seen.add(window)
        out.append((key, len(data), sum(gone), len(re.findall(b"\1+", bytes(gone))),
                    sha(bytes(c for c, g in zip(data, gone) if not g))))
    return out


def window_removal(docs, length=35):
    count = Counter()
    lists = [(key, words(text)) for key, text in docs]
    for _, w in lists:
        count.update(tuple(w[p:p + length]) for p in range(len(w) - length + 1))
    out = []
    for key, w in lists:
        gone = [False] * len(w)
        for p in range(len(w) - length + 1):
            if count[tuple(w[p:p + length])] > 1:
                gone[p:p + length] = [True] * length
        out.append((key, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g))))
    return out


PII = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
       "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def pii(text):
    found = []
    for kind, pattern in PII.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if (kind == "ip" and max(int(p) for p in m.group().split(".")) > 255
                    or kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits))
                    or kind == "phone" and not 9 <= len(digits) <= 15):
                continue
            found.append(f"{kind}:{m.start()}:{m.end()}")
    return found


def exact(docs):
    """docs: (id, text); returns (id, keep, size, kept, digest) rows."""
    groups = {}
    for key, text in docs:
        groups.setdefault("".join(words(text)), []).append((key, text or ""))
    out = []
    for bare, own in groups.items():
        keep = min(own, key=lambda d: (-len(d[1]), order(d[0])))[0]
        out += [(key, keep, len(own), key == keep, sha(bare)) for key, _ in own]
    return out


def verdict(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else None
    if rest is None:
        return "", "", None, default
    host = re.sub("[A-Z]", lambda m: m.group().lower(), re.match(r"[^/?#]*", rest).group())
    path = re.match(r"[^/?#]*([^?#]*)", rest).group(1)
    fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[4] if best else default
