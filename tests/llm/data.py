"""A small corpus with the awkward cases, and plain versions of the operators to hold them against."""

import random
import re
from itertools import accumulate

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names the operators use themselves.
CLASHES = "th long, size string, shard string, slot string, fp string, name string, key string, start string, items string, n_hit string, copies string, h string, words string, root string"
ALNUM, SPACE = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", r"[^\x20\x09-\x0D]+"


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" + rng.choice(["", "", "", ",", ".\n", "é"]) for _ in range(n))


def items():
    rng = random.Random(11)
    return [(i, prose(rng, n, 5000)) for i, n in enumerate((40, 12, 10, 4, 1))] + [(7, None), (8, ""), (None, prose(rng, 15, 5000))]


def corpus():
    """[(doc_id, text, lang, source, n_chars)]"""
    rng = random.Random(3)
    texts = [prose(rng, rng.choice((1, 3, 20, 60, 150))) for _ in range(40)]
    bench = [t for _, t in items() if t]
    passage, line = prose(rng, 70), "Fair winds carry the small boat over the long grey water tonight"
    texts += [texts[4]] * 6 + [texts[9] + " end"] * 2
    texts += [prose(rng, 30) + " " + bench[0] + " " + prose(rng, 9), bench[1], bench[2] + " " + bench[2], "x " + bench[3] + " y", bench[5] if len(bench) > 5 else ""]
    texts += [prose(rng, 25) + " " + passage + " " + prose(rng, 25) for _ in range(3)] + [passage + " " + prose(rng, 5) + " " + passage]
    texts += [prose(rng, 8) + "\n" + line + "\n" + prose(rng, 8), line.upper() + "!\n" + line + "s", "\n\n" + line]
    texts += ["All rights reserved. all RIGHTS reserved", "Under the GNU General Public License, CC BY.", "Licensed under the Apache License, Version 2.0.",
              "Permission is hereby granted, free of charge, to any one person obtaining a copy of this software and the associated documentation "
              "files, to deal in the Software without restriction"]
    texts += [None, "", " \t\n", "...", prose(rng, 4000)]
    rows = [(i, t, rng.choice(("en", "de", None)), rng.choice(("a", "b", "c", "hot", "hot", "hot", None)), len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], rows[50], (None, texts[7], None, None, 1), (None, None, None, "a", 0)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def clashing(spark, rows):
    return spark.createDataFrame([(*r, 1, *["x"] * 13) for r in rows], f"{SCHEMA}, {CLASHES}")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def alnum(text):
    return re.findall(ALNUM, lower(text))


def spaced(text):
    return re.findall(SPACE, text or "")


class Union:
    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def find(self, n):
        while self.up[n] != n:
            n = self.up[n]
        return n

    def link(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def simhash(text, k, words=None):
    import xxhash

    words = spaced(lower(text)) if words is None else words
    grams = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def bits(a, b):
    return (a ^ b).bit_count()


def window_hits(text, wanted, size=10):
    """(words, hit positions, ids) of exact windows of the items."""
    words, hit, ids = alnum(text), set(), set()
    for item, t in wanted:
        own = alnum(t)
        for i in range(max(len(own) - size + 1, 1) if own else 0):
            w = own[i:i + size]
            for s in range(len(words) - len(w) + 1):
                if words[s:s + len(w)] == w:
                    hit |= set(range(s, s + len(w)))
                    ids.add(item)
    return words, hit, ids


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        row = list(accumulate(zip(row, row[1:], b), lambda left, x: min(left + 1, x[1] + 1, x[0] + (c != x[2])), initial=i))
    return row[-1]
