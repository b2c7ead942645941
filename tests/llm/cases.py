"""Small awkward inputs, and brute-force versions of the operators."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [
    None, "", "", " \t\n", "one", "one two", "One TWO", "a b c " * 50, "a b c " * 50, "x " * 100, "w" + "w " * 2000, "long" * 30_000,
    "é à ü ñ " * 30, "a\x1cb c\xa0d <|endoftext|> don't I'll 123 ①", "you stupid idiot. not an idiot! he said: kill",
    "mail a@b.com and 4111 1111 1111 1111 or +1 (212) 555-1234 from 10.0.0.1", "1 " * 5000, "a@b" + ".c" * 5000,
]


def awkward(spark, docs, rows: int = 300):
    """Rows of a documents table, odd texts, repeated rows, null ids and columns with clashing names."""
    odd = [(10**9 + i, t) for i, t in enumerate(ODD)] + [(10**9, None), (10**9 + 7, ODD[7]), (None, "one two three four"), (None, None)]
    extra = spark.createDataFrame(odd, "doc_id long, text string").withColumns({"lang": F.lit(None).cast("string"), "source": F.lit(None).cast("string"), "n_chars": F.lit(None).cast("long")})
    out = docs.where(F.col("doc_id") < rows).unionByName(extra)
    return out.withColumns({c: F.lit(1) for c in ("n", "size", "score", "id", "h1", "th", "root", "part", "place", "rank", "kept", "v", "m", "label", "host_", "pii_email")})


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def jaccard(rows, n, p):
    """Counter of (doc_id, n_shingles, n_links, component_id)."""
    sets = []
    for _, text in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append(frozenset(tuple(w[k:k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)]) if w else frozenset())
    held = defaultdict(list)
    for a, s in enumerate(sets):
        for g in s:
            held[g].append(a)
    up, degree, least = list(range(len(rows))), Counter(), {}

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x
    for a, s in enumerate(sets):
        for b, k in Counter(b for g in s for b in held[g] if b > a).items():
            if k * 100 >= p * (len(s) + len(sets[b]) - k):
                up[find(a)] = find(b)
                degree[a] += 1
                degree[b] += 1
    for a, (i, _) in enumerate(rows):
        if i is not None:
            least[find(a)] = min(least.get(find(a), i), i)
    return Counter((i, len(sets[a]), degree[a], least.get(find(a))) for a, (i, _) in enumerate(rows))


def repeats(rows, length):
    """Counter of (doc_id, words, removed, sha256 of what is kept)."""
    places, out = Counter(), Counter()
    words = [WORD.findall(t or "") for _, t in rows]
    for w in words:
        places.update(tuple(w[k:k + length]) for k in range(len(w) - length + 1))
    for (i, _), w in zip(rows, words, strict=True):
        gone = {x for k in range(len(w) - length + 1) if places[tuple(w[k:k + length])] > 1 for x in range(k, k + length)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out[i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def base_spans(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [(m.start(), 0, m.end(), "email") for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end(), "ip") for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(m.start(), 2, m.end(), "card") for m in CARD.finditer(text) if 12 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [(m.start(), 3, m.end(), "phone") for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15]
    return sorted(out)
