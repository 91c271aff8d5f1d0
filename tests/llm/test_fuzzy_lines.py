"""Fuzzy lines against a brute force on edit similarity alone."""

import random
from collections import defaultdict

import numpy as np
import pytest

from keepsake.llm import lines
from tests.llm import data


alike = lines.similar  # itself held against a plain edit distance in test_operators.py


def texts(most=None):
    """Lines of 10 to 60 words, each with copies in which words are replaced, added or left out (two at most, or a word in ten); short lines."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 9)))
    out = []
    for n in range(10, 61, 5):
        words = [word() for _ in range(n)]
        out.append(" ".join(words))
        for edits in (1, 2, most or n // 10):
            new = list(words)
            for _ in range(edits):
                at = rng.randrange(len(new))
                new[at:at + 1] = rng.choice(([word()], [new[at], word()], []))
            out.append(" ".join(new))
    out += ["la ja", "la ra", "eding in", "eding enin", "page twelve", "page twelfe", "abcd", "abce", "x" * 15 + " y", "x" * 15 + " z"]
    rng.shuffle(out)
    return out


def test_shared_keys():
    """Short lines that are alike always share a key; of the others, copies of copies close to the bound among them, nearly all."""
    rng, found = random.Random(4), 0
    for _ in range(3000):
        a = "".join(rng.choice("ab c") for _ in range(rng.randrange(4, 15))).strip() or "a"
        at = rng.randrange(len(a))
        b = (a[:at] + rng.choice(("", "d", a[at:at + 1] + "d")) + a[at + 1:]).strip() or "a"
        if max(len(a), len(b)) <= lines.EXACT and alike(a, b):
            found += 1
            x, y = lines.keys([a.encode(), b.encode()])
            assert set(x) & set(y), (a, b)
    assert found > 500
    all_ = texts()
    keys = [set(k) for k in lines.keys([t.encode() for t in all_])]
    pairs = [(i, j) for j in range(len(all_)) for i in range(j) if alike(all_[i], all_[j])]
    assert len(pairs) > 25 and sum(bool(keys[i] & keys[j]) for i, j in pairs) >= 0.95 * len(pairs)


@pytest.mark.parametrize("group", [lines.GROUP, 2])
def test_groups_by_edit_similarity(spark, monkeypatch, group):
    monkeypatch.setattr(lines, "GROUP", group)
    all_ = texts(1)
    u = data.Union(range(len(all_)))
    for j, b in enumerate(all_):
        for i in range(j):
            if alike(all_[i], b):
                u.link(i, j)
    want = defaultdict(list)
    for i in range(len(all_)):
        if u.find(i) != i:
            want[i // 10].append(i % 10)
    docs = spark.createDataFrame([(d, "\n".join(all_[d * 10:d * 10 + 10])) for d in range(-(-len(all_) // 10))], "doc_id long, text string")
    got = {r.doc_id: list(r.removed) for r in lines.mark(docs.union(docs.filter("doc_id = 3"))).collect()}
    assert {d: x for d, x in got.items() if x} == want


def test_long_line_in_parts(monkeypatch):
    line = " ".join(f"word{i}" for i in range(500)).encode()
    whole = lines.keys([line, b"short", line[:100]])
    monkeypatch.setattr(lines, "CHUNK", 64)
    assert lines.keys([line, b"short", line[:100]]) == whole


def test_far_lines_are_told_by_place():
    """No alike pair fails the test on places of 3-grams or the abandoned distance; lines with the same 3-grams elsewhere fail it."""
    rng, met = random.Random(6), 0
    for _ in range(400):
        a = "".join(rng.choice("abcde ") for _ in range(rng.randrange(3, 300)))
        b = a
        for _ in range(rng.randrange(int(len(a) * 0.3) + 1)):
            at = rng.randrange(len(b) + 1)
            b = b[:at] + rng.choice(("", "x", b[at:at + 1] + "yz")) + b[at + 1:]
        most, true = int(max(len(a), len(b)) * (1 - lines.SIMILARITY) + 1e-9), data.levenshtein(a, b)
        got = lines.distance(a, b, most)
        assert (got == true) if true <= most else got > most
        if true <= most and min(len(a), len(b)) > 2:
            met += 1
            for x, y in ((a, b), (b, a)):
                assert lines._near(lines._grams(x), lines._placed(lines._grams(y)), len(y) - len(x), most)
    assert met > 150
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(60)]
    a, b = " ".join(words), " ".join(words[30:] + words[:30])
    assert not lines._near(lines._grams(a), lines._placed(lines._grams(b)), 0, int(len(a) * 0.2))


def test_buckets_of_two_sizes_are_not_compared(spark, monkeypatch):
    """Two lines that share a key and differ too much in size are told apart before their texts are fetched."""
    sent = []
    fetched = lines._fetched
    monkeypatch.setattr(lines, "_fetched", lambda docs, spots: sent.append(spots.count()) or fetched(docs, spots))
    short = "one two three four five six seven eight"
    docs = spark.createDataFrame([(1, short), (2, f"{short} {short} {short}"), (3, "nine ten eleven twelve thirteen"), (4, "nine ten eleven twelve fourteen")],
                                 "doc_id long, text string")
    assert set(lines.keys([short.encode()])[0]) & set(lines.keys([f"{short} {short} {short}".encode()])[0])
    lines.mark(docs.filter("doc_id < 3")).collect()
    assert sent == [0]
    assert {r.doc_id: list(r.removed) for r in lines.mark(docs).collect()} == {1: [], 2: [], 3: [], 4: [0]}
    assert sent[1] > 0


def test_bounds_of_the_distance():
    """The walk never finds less than the true distance and settles most alike pairs; tests on sets and places of 3- and 4-grams lose none."""
    rng, met, found = random.Random(9), 0, 0
    for _ in range(400):
        a = "".join(rng.choice("abcdefgh é你") for _ in range(rng.randrange(4, 300)))
        b = a
        for _ in range(rng.randrange(int(len(a) * 0.3) + 1)):
            at = rng.randrange(len(b) + 1)
            b = b[:at] + rng.choice(("", "x", b[at:at + 1] + "yz")) + b[at + 1:]
        most, true = int(max(len(a), len(b)) * (1 - lines.SIMILARITY) + 1e-9), data.levenshtein(a, b)
        for x, y in ((a, b), (b, a)):
            assert lines._bound(x, y, most) >= true
            g, h = ([k, lines._wider(k)] for k in (lines._grams(x), lines._grams(y)))
            assert lines._alike(x, y, g, h) == (true <= most)
            if true <= most:
                met, found = met + 1, found + (lines._bound(x, y, most) <= most)
                for width, i, j in ((3, g[0], h[0]), (4, g[1], h[1])):
                    sets = lines._sets([i, j], max(len(x), len(y)))
                    assert lines._missing(sets[0], sets[1]) <= width * most
                    assert lines._near(i, lines._placed(j), len(y) - len(x), most, width)
                    near = lines._all_near([i, i[:0]], lines._placed(j), np.array([len(y) - len(x), 0]), np.array([most, 1]), width)
                    assert near.tolist() == [True, True]
    assert met > 300 and found > 100


def test_rounds_and_gaps(spark, monkeypatch):
    """The same lines go however many rounds send them; lines of a key are sent only with others that they fit."""
    sent = []
    fetched = lines._fetched
    monkeypatch.setattr(lines, "_fetched", lambda docs, spots: sent.append(spots.count()) or fetched(docs, spots))
    all_ = texts(1)
    docs = spark.createDataFrame([(d, "\n".join(all_[d * 10:d * 10 + 10])) for d in range(-(-len(all_) // 10))], "doc_id long, text string")
    found = lambda: {r.doc_id: list(r.removed) for r in lines.mark(docs).collect()}
    want, whole = found(), list(sent)
    assert len(whole) == 1 and any(want.values())
    sent.clear()
    monkeypatch.setattr(lines, "ROUND", 1)
    assert found() == want
    assert len(sent) > 1 and sum(sent) == whole[0]
    first = "struct<null_id:boolean,doc_id:long,th:long,line_no:int,size:int,keys:array<long>>"
    each = spark.createDataFrame([((False, i, 0, 0, n, [1]),) for i, n in enumerate((10, 12, 14, 30, 31, 90))], f"first {first}")
    rows = lines.buckets(each).collect()
    assert sorted(r.doc_id for r in rows) == [0, 1, 2, 3, 4] and len({r.key for r in rows if r.doc_id < 3}) == 1
    assert len({r.key for r in rows}) == 2


@pytest.mark.parametrize("letters", [lines.LETTERS, 4])
def test_distances_at_once(monkeypatch, letters):
    """Pairs tested together come out as each one alone, however many are left open and if rare characters share a number."""
    monkeypatch.setattr(lines, "LETTERS", letters)
    monkeypatch.setattr(lines, "PAIRS", 512)
    rng, all_ = random.Random(12), []
    for _ in range(500):
        a = "".join(rng.choice("abcdefgh é你") for _ in range(rng.randrange(1, 400)))
        b = a
        for _ in range(rng.randrange(int(len(a) * 0.4) + 2)):
            at = rng.randrange(len(b) + 1)
            b = b[:at] + rng.choice(("", "x", b[at:at + 1] + "yz")) + b[at + 1:]
        all_ += [a, b or "z"]
    chart = lines._chart(all_)
    a, b = np.arange(0, len(all_), 2), np.arange(1, len(all_), 2)
    b[::5] = np.roll(b[::5], 1)
    fit = lines._meet(chart[2], np.full(len(all_), -1), a, b)
    a, b = a[fit], b[fit]
    want = [alike(all_[i], all_[j]) for i, j in zip(a, b)]
    assert lines._tested(chart, all_, a, b).tolist() == want and 100 < sum(want) < len(want) - 20


def test_places_of_runs(spark, monkeypatch):
    """Lines that share runs at places too far apart are not fetched; a run that stands twice tells no place; no alike pair with an unedited run fails."""
    rng, met = random.Random(13), 0
    for _ in range(300):
        a = "".join(rng.choice("abcdefghé") for _ in range(rng.randrange(20, 200)))
        b = a
        for _ in range(rng.randrange(1, int(len(a) * 0.15))):
            at = rng.randrange(len(b) + 1)
            b = b[:at] + rng.choice(("", "x", b[at:at + 1] + "yz")) + b[at + 1:]
        if alike(a, b):
            ends, keys, places = lines._keyed([a.encode(), b.encode()])
            x, y = (dict(zip(keys[i:j].tolist(), places[i:j].tolist())) for i, j in zip(ends, ends[1:]))
            size = np.array([len(a), len(b)])
            shared = set(x) & set(y)
            fine = [lines._meet(size, np.array([x[k], y[k]]), np.array([0]), np.array([1])).all() for k in shared]
            met += bool(fine)
            assert sum(fine) >= 0.9 * len(fine)
    assert met > 100
    line = "0 0 0 0 0 0 0 0 0 0 0 0 0 0 1 0"
    docs = spark.createDataFrame([(1, line), (2, "0 1" + line[3:])], "doc_id long, text string")
    assert sorted(list(r.removed) for r in lines.mark(docs).collect()) == [[], [0]]
    sent = []
    fetched = lines._fetched
    monkeypatch.setattr(lines, "_fetched", lambda docs, spots: sent.append(spots.count()) or fetched(docs, spots))
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6))
    common, rest = " ".join(word() for _ in range(14)), [[word() for _ in range(16)] for _ in range(2)]
    docs = spark.createDataFrame([(1, f"{common} {' '.join(rest[0])}"), (2, f"{' '.join(rest[1])} {common}")], "doc_id long, text string")
    x, y = (set(k) for k in lines.keys([r.text.encode() for r in docs.collect()]))
    assert x & y
    assert [list(r.removed) for r in lines.mark(docs).collect()] == [[], []]
    assert sent == [0]
