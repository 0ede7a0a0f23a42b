"""Plain versions of the operators, and small tables with every odd case."""

import hashlib
import re

import xxhash
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BASE = " ".join(f"w{i % 41}x{i * 7 % 13}" for i in range(90))

TEXTS = [
    (0, "The quick brown fox jumps over the lazy dog. " * 3, "en"),
    (1, BASE, "en"),
    (2, BASE, "en"),  # an exact copy
    (3, BASE.replace("w5x9", "other", 1), "en"),  # a near copy
    (4, None, "en"),
    (5, "", "de"),
    (6, " \t\n\x0b\x0c\r ", "de"),
    (7, "12345 67890 !!! ???", None),
    (8, "one", "fr"),
    (9, "one two", "fr"),
    (10, "Ünïcode wörds mit ß und éàç ende x 😀 é", "de"),
    (11, "prefix words here " + BASE + " and a suffix", "en"),
    (12, "mail ann.lee@example.org or +49 (170) 123-4567, host 10.0.0.255, card 4111 1111 1111 1111 <|endoftext|> ok", "en"),
    (13, "a" * 5000 + " " + "b1" * 3000 + "  \n\n " + "word " * 4000, "en"),
    (14, "le la les des une un et que qui dans", "fr"),
    (15, "der die das und ist nicht ein eine mit", "de"),
    (15, "der die das und ist nicht ein eine mit", "de"),  # a repeated row
    (None, BASE, "en"),
    (None, None, None),
]


def table(spark, rows=TEXTS):
    """doc_id, text, lang and columns whose names clash with the operators' own."""
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    odd = {"source": F.lit("s"), "n_chars": F.char_length("text").cast("long")}
    return df.withColumns(odd | {c: F.lit("x") for c in ("home", "kind", "keys", "fp", "id", "slot", "vslot", "words", "window", "block", "ids", "bytes", "size", "entries", "component", "score", "lang_pred", "a.b", "_spans", "_base")})


def empty(spark):
    return table(spark, TEXTS).where("false")


def words(text):
    return WORD.findall(text or "")


def simhash(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = words(lower)
    shingles = [" ".join(w[i : i + 3]) for i in range(max(len(w) - 2, 1))] if w else []
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def closed(items, linked):
    """The smallest item that each item reaches."""
    parent = {i: i for i in items}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    items = sorted(parent)
    for n, a in enumerate(items):
        for b in items[n + 1 :]:
            if linked(a, b):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in items}


def repeats(rows, window=13):
    """(doc_id, text) rows to (n_words, n_removed, kept) for each row, in order."""
    first = {}
    for i, t in rows:
        w = words(t)
        if i is not None:
            for j in range(len(w) - window + 1):
                k = tuple(w[j : j + window])
                first[k] = min(first.get(k, i), i)
    out = []
    for i, t in rows:
        w = words(t)
        gone = [False] * len(w)
        if i is not None:
            for j in range(len(w) - window + 1):
                if first[tuple(w[j : j + window])] < i:
                    gone[j : j + window] = [True] * window
        out.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base_spans(text):
    def passes(kind, value):
        digits = re.sub("[^0-9]", "", value)
        return {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in value.split(".")), "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]

    kinds = list(PII)
    found = sorted((m.start(), kinds.index(k), m.end()) for k, p in PII.items() for m in re.finditer(p, text or "") if passes(k, m.group()))
    return ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in found)
