"""Small inputs with the awkward cases, and plain versions of what the queries must give."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import xxhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, words int, shard string"
WHITE = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, texts, lang="en", source="a"):
    """Documents with extra columns whose names the operators use themselves."""
    rows = [(i, t, lang if isinstance(lang, str) else lang[i], source if isinstance(source, str) else source[i],
             len(t or ""), "x", 1, "y") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


AWKWARD = [None, "", "   \n\t ", "a", "a b", "word " * 30_000, "same text here", "same text here", "x" * 200_000,
           "é ü 漢字 \x1c \x85 end.", "<|endoftext|> A<|STARTOFTEXT|>b don't, stop.", "\n\n1.2.3.4\n", "..., ..."]


def words(text):
    return WHITE.findall(text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def crc(value, of):
    return zlib.crc32(("" if value is None else str(value)).encode()) % of


def stats(text):
    own = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    windows = Counter(tuple(own[i:i + 3]) for i in range(len(own) - 2))
    hit = {j for i in range(len(own) - 2) if windows[tuple(own[i:i + 3])] > 1 for j in range(i, i + 3)}
    n = len(own), sum(map(len, own)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit)
    return *n, n[0] < 50 or 100 * n[4] > 50 * n[0]


def personal(text):
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", m.start(), m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()][::-1]
        if 14 <= len(digits) <= 19 and sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0:
            out.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(("phone", m.start(), m.end()))
    kinds = ["email", "ip", "card", "phone"]
    out.sort(key=lambda x: (x[1], kinds.index(x[0])))
    return out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def windows(docs, items, size=10):
    """(n_words, hit word numbers, item ids) of each text."""
    known = {}
    for name, text in items:
        own = ALNUM.findall(lower(text))
        for i in range(max(1, len(own) - size + 1) if own else 0):
            known.setdefault(tuple(own[i:i + size]), set()).add(str(name))
    out = []
    for text in docs:
        own, hit, names = ALNUM.findall(lower(text)), set(), set()
        for k in {len(w) for w in known}:
            for i in range(len(own) - k + 1):
                if tuple(own[i:i + k]) in known:
                    hit.update(range(i, i + k))
                    names |= known[tuple(own[i:i + k])]
        out.append((len(own), hit, names))
    return out


def simhash(text, size=4):
    own = lower(text).encode().split()
    runs = [b" ".join(own[i:i + size]) for i in range(max(1, len(own) - size + 1))] if own else []
    bits = [0] * 64
    for h in (xxhash.xxh64_intdigest(r, 42) for r in runs):
        for i in range(64):
            bits[i] += h >> i & 1
    return sum(1 << i for i in range(64) if 2 * bits[i] > len(runs))


def groups(ids, values, radius=4):
    """Smallest id linked to each, over all pairs."""
    distinct = np.unique(np.array(values, dtype=np.uint64))
    root = list(range(len(distinct)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(distinct)):
        for j in np.flatnonzero(np.bitwise_count(distinct[i + 1:] ^ distinct[i]) <= radius):
            a, b = find(i), find(i + 1 + int(j))
            root[max(a, b)] = min(a, b)
    place = {int(v): i for i, v in enumerate(distinct)}
    own = [find(place[v]) for v in values]
    least = {}
    for r, i in zip(own, ids, strict=True):
        least[r] = min(i, least.get(r, i))
    return [least[r] for r in own]
