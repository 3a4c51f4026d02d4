"""Plain Python versions of the operators, for small tables."""

import collections
import hashlib
import math
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def shingles(text):
    w = words((text or "").translate(UPPER))
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def components(texts):
    """Least id of the group of each id, by all pairs."""
    sets = {i: shingles(t) for i, t in texts.items()}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def held_items(texts, items):
    """(doc, item, shared, size) of each item that a document holds."""
    wanted = {i: shingles(t) for i, t in items.items()}
    found = set()
    for d, text in texts.items():
        own = shingles(text)
        found |= {(d, i, len(own & s), len(s)) for i, s in wanted.items() if s and 100 * len(own & s) >= 75 * len(s)}
    return found


def without_shared_lines(texts):
    """Text, lines and dropped lines of each id."""
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(UPPER)
    lines = {i: (t or "").split("\n") for i, t in texts.items()}
    holders = collections.defaultdict(set)
    for i, own in lines.items():
        for line in own:
            if len(key(line)) >= 40:
                holders[key(line)].add(i)
    out = {}
    for i, own in lines.items():
        kept = [line for line in own if len(holders.get(key(line), ())) < 5 or max(holders[key(line)]) == i]
        out[i] = ("\n".join(kept), len(own), len(own) - len(kept))
    return out


def targets(sizes):
    """Targets by repeated resharing; ``sizes`` by source, None among them."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    out, open_, left = {}, set(order), float(sum(sizes.values()))
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 3 * sizes[s]}
        for s in over or set(open_):
            out[s] = 3.0 * sizes[s] if over else level * weight[s]
        left -= sum(out[s] for s in over)
        open_ -= over or open_
    return out


def luhn(digits):
    d = [int(c) for c in reversed(digits)]
    return (sum(d[0::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


def pii(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def secrets(text):
    pattern = r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out = [("assign", *m.span()) for m in re.finditer(pattern, text) if len(m[2]) >= 6]
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return out + [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]


def digest(spans, kinds):
    ordered = sorted(spans, key=lambda s: (s[1], kinds.index(s[0])))
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in ordered).encode()).hexdigest()


class KneserNey:
    """The bigram model in dictionaries; None ends a text, 0 begins it."""

    def __init__(self, texts):
        tokens = [self.tokens(t) for t in texts]
        self.unigrams = collections.Counter(w for t in tokens for w in t)
        self.pairs = collections.Counter(p for t in tokens for p in zip([0, *t[:-1]], t))
        self.n, self.v = sum(self.unigrams.values()), len(self.unigrams)
        self.before = collections.Counter(b for _, b in self.pairs)
        self.d1, self.d2 = self.discounts(self.before), self.discounts(self.pairs)
        self.total, self.rest = collections.Counter(), collections.Counter()
        for (a, _), c in self.pairs.items():
            self.total[a] += c
            self.rest[a] += self.d2[min(c, 3) - 1]

    @staticmethod
    def tokens(text):
        return [*words((text or "").translate(UPPER)), None]

    @staticmethod
    def discounts(counts):
        n = [sum(1 for c in counts.values() if c == k) for k in (1, 2, 3, 4)]
        if not all(n):
            return 0.5, 1.0, 1.5
        y = n[0] / (n[0] + 2 * n[1])
        d = tuple(k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3))
        return d if all(0 < x <= k for x, k in zip(d, (1, 2, 3))) else (0.5, 1.0, 1.5)

    def alone(self, w):
        c, size = self.before.get(w, 0), len(self.pairs)
        if not size:
            return 1.0
        spare = sum(self.d1[min(x, 3) - 1] for x in self.before.values()) / size
        return (c - self.d1[min(c, 3) - 1] if c else 0) / size + spare / (self.v + 1)

    def chance(self, a, w):
        if a not in self.total:
            return self.alone(w)
        c = self.pairs.get((a, w), 0)
        return (c - self.d2[min(c, 3) - 1] if c else 0) / self.total[a] + self.rest[a] / self.total[a] * self.alone(w)

    def scores(self, text):
        t = self.tokens(text)
        base = math.fsum(math.log10((self.unigrams.get(w, 0) + 1) / (self.n + self.v + 1)) for w in t)
        return len(t), sum(w in self.unigrams for w in t), base, math.fsum(math.log10(self.chance(a, w)) for a, w in zip([0, *t[:-1]], t))


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode() if doc_id is not None else b"") % 7 == 2
