"""Fingerprint trees against digests and leaves written out here."""

import hashlib
import random
import re
import zlib
from collections import Counter

from tidemark.llm import merkle


def digest(kind, data, size):
    return hashlib.blake2b(kind + data.encode(), digest_size=size).hexdigest()


def pieces(line):
    out = []
    for s in re.split(r"(?<=[.!?;:|])\s+", line.strip()):
        w = s.split()
        if len(w) <= 16:
            out.append(s)
            continue
        ends = [i + 1 for i, x in enumerate(w) if zlib.crc32(x.encode()) % 8 == 0 or i + 1 == len(w)]
        out += [" ".join(w[a:b]) for a, b in zip([0, *ends], ends)]
    return out


def tree(text):
    """(root, [[(paragraph digest, [leaf digest])]]) of a text."""
    sections = [[]]
    for line in text.split("\n"):
        if not line.strip():
            sections.append([])
            continue
        own = [digest(b"leaf", x, 4) for x in pieces(line)]
        d = digest(b"paragraph", ",".join(own), 4)
        sections[-1].append((d, own))
        if int(d, 16) % 8 == 0:
            sections.append([])
    sections = [s for s in sections if s]
    tops = [digest(b"section", ",".join(d for d, _ in s), 8) for s in sections]
    return digest(b"root", hashlib.blake2b(text.encode(), digest_size=16).hexdigest() + ",".join(tops), 16), tops, sections


def random_text(rng, n):
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 5)))
    return "\n".join("" if rng.random() < 0.15 else " ".join(word() + rng.choice(["", "", "", ".", ";"]) for _ in range(rng.choice([1, 5, 12, 40]))) for _ in range(n))


def test_tree_and_likeness():
    rng = random.Random(1)
    texts = ["", " \n\t", "one", "x" * 5000, "same. same. same.", "same. same."] + [random_text(rng, rng.randint(1, 30)) for _ in range(25)]
    texts += [t[: len(t) // 2] + u[: len(u) // 2] for t, u in zip(texts, texts[1:])]
    shown = [merkle.fingerprint(t) for t in texts]
    for t, f in zip(texts, shown):
        root, tops, sections = tree(t)
        body = "|".join(f"{top}:" + ";".join(f"{d}={','.join(own)}" for d, own in s) for top, s in zip(tops, sections))
        assert f == f"{root}/{body}"
    for t, f in zip(texts, shown):
        for u, g in zip(texts, shown):
            a, b = (Counter(x for s in tree(v)[2] for _, own in s for x in own) for v in (t, u))
            expected = 1.0 if t == u else 2 * (a & b).total() / (a.total() + b.total()) if a or b else 0.0
            assert abs(merkle.likeness(f, g) - expected) < 1e-12


def test_an_insertion_shifts_nothing():
    rng = random.Random(2)
    lines = [f"paragraph {i} says {rng.random()}" for i in range(200)]
    before = merkle.fingerprint("\n".join(lines))
    after = merkle.fingerprint("\n".join([*lines[:77], "a new one", *lines[77:]]))
    sections = lambda f: [s for s, _ in merkle._tree(f)[1]]
    assert len(sections(before)) > 10 and len(set(sections(before)) - set(sections(after))) == 1
    assert merkle.differing(before, after) == [] and len(merkle.differing(after, before)) == 1
    (i, j), = merkle.differing(after, before)
    assert merkle._tree(after)[1][i][1][j][1] == [digest(b"leaf", "a new one", 4)]
    gone = merkle.fingerprint("\n".join([*lines[:50], *lines[51:]]))
    assert len(merkle.differing(before, gone)) == 1


def test_half_of_one_long_sentence():
    rng = random.Random(3)
    for _ in range(50):
        w = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(120)]
        assert merkle.likeness(merkle.fingerprint(" ".join(w)), merkle.fingerprint(" ".join(w[:60]))) > 0.25
