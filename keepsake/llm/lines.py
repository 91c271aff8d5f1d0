"""Line dedup over fuzzy lines.

Lines are normalised; two are alike if their edit similarity is SIMILARITY or
more, and each group that such pairs connect keeps one occurrence. Pairs to
compare come from buckets: lines that share a key. Keys are bands of min-hashes
of the byte runs of a line (its 8-grams; for short lines also 4-grams); lines of
up to EXACT characters also have what deletions leave of them as keys, so that
among them no pair is missed. Edit similarity alone decides on a pair; a bucket
is cut where the sizes of its lines leave a gap and compared in blocks that
bound a task. Tests on 3-grams that alike lines cannot fail and a bound from
above spare most edit distances. Texts are sent to be compared in rounds of
about the size of the table.
"""

from __future__ import annotations

from itertools import combinations, product
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keepsake.llm.common import discard, require, stored, text_key
from keepsake.llm.components import components
from keepsake.llm.simhash import MAX_BITS, SEED, _bits

SIMILARITY = 0.8
BLOCKS = MAX_BITS + 2
#: (bytes in a gram, bands, min-hashes in a band, bytes of the longest line that has them; 0: any)
BANDS = ((8, 8, 2, 0), (4, 12, 3, 128))
#: Characters of the lines whose deletions are keys.
EXACT = 14
#: Lines of a bucket that one task compares with as many others.
GROUP = 1000
#: Bytes of lines hashed at once.
CHUNK = 1 << 16
#: Bytes that begin no character; the place of a run in a band of so many rows that tells none.
FOLLOWING, ANY = [bytes([x]) for x in range(0x80, 0xC0)], {2: (1 << 15) - 1, 3: (1 << 10) - 1}
#: Characters of lines that a round of comparing sends at least, whatever the size of the table.
ROUND = 1 << 26
#: Lines of a bucket from which on sets of 3-grams, all lines at once, cost less than they spare.
FEW = 16
#: Bits of such a set for each character of the longest line, and bits at most.
WIDTH, WIDEST = 8, 1 << 15
#: Characters that two lines must share in a row after a difference, for the bound from above.
ANCHOR = 8
#: Characters of a line from which on its bucket is compared line by line, with Python's long integers as bit vectors.
LONG = 4096
#: Pairs of lines whose distance is bounded at once, and in a round of `_forest` about; numbers for characters then.
PAIRS, AT_ONCE, LETTERS = 1 << 12, 1 << 20, 256
#: Written tables free their exchange files at once: otherwise these stay until the driver collects garbage.
FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _mixed(h):
    import numpy as np

    h = h * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _minima(lines: list[bytes], gram: int, n: int):
    """n min-hashes of the byte runs of length `gram` (8 at most) of each line, and how many characters begin before each; a shorter line is one run.

    The place is -1 where the run stands twice in the line.
    """
    import numpy as np

    odd = _mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(SEED)) | np.uint64(1)
    mask, most = np.uint64((1 << 8 * gram) - 1), np.iinfo(np.uint64).max
    high = ~np.uint64((1 << 17) - 1)  # the other bits of a hash tell the place instead
    out, places = np.full((n, len(lines)), most), np.full((n, len(lines)), -1)

    def flush(ids: list[int], parts: list[bytes], before: list[int]) -> None:
        body = np.frombuffer(b"".join([p + bytes(8) for p in parts]), np.uint8)
        size = np.array([len(p) for p in parts])
        starts, count = np.r_[0, np.cumsum(size + 8)[:-1]], np.maximum(size - gram + 1, 1)
        first = np.r_[0, np.cumsum(count)[:-1]]
        every = np.lib.stride_tricks.as_strided(body[:8].view("<u8"), (len(body) - 7,), (1,))
        place = np.arange(first[-1] + count[-1]) - np.repeat(first, count)
        at = place + np.repeat(starts, count)
        runs, place, chars = _mixed(every[at] & mask), place.astype(np.uint64), np.cumsum((body & 0xC0) != 0x80)
        spots, met, next_ = np.empty_like(runs), np.empty((n, len(first)), np.uint64), np.empty((n, len(first)), np.uint64)
        for k in range(n):
            np.multiply(runs, odd[k], spots)
            np.bitwise_and(spots, high, spots)
            np.bitwise_or(spots, place, spots)
            np.minimum.reduceat(spots, first, out=met[k])
            spots[first + (met[k] & ~high).view(np.int64)] = most
            np.minimum.reduceat(spots, first, out=next_[k])
        here = chars[at[first + (met & ~high).view(np.int64)]] - chars[starts] + ((body[starts] & 0xC0) != 0x80) - 1 + before
        least, old = met & high, out[:, ids]
        here[((next_ & high) == least) | (least == old)] = -1
        places[:, ids] = np.where(least <= old, here, places[:, ids])
        out[:, ids] = np.minimum(old, least)

    ids, parts, before, size = [], [], [], 0
    for i, line in enumerate(lines):
        done = 0
        for at in range(0, max(len(line) - gram + 1, 1), CHUNK):  # a very long line: in parts
            if size and (at or size + len(line) > CHUNK):
                flush(ids, parts, before)
                ids, parts, before, size = [], [], [], 0
            part = line[at:at + CHUNK + gram - 1]
            ids.append(i), parts.append(part), before.append(done)
            size += len(part) + 1
            if len(line) > CHUNK:
                done += len(part[:CHUNK]) - sum(part.count(x, 0, CHUNK) for x in FOLLOWING)
    if ids:
        flush(ids, parts, before)
    return out.T, places.T


def _deletions(line: str) -> set[str]:
    """What is left of a short line without any of as many characters as an alike line of up to EXACT characters may differ in."""
    most = int(min(EXACT, int(len(line) / SIMILARITY + 1e-9)) * (1 - SIMILARITY) + 1e-9)
    return {"".join(x) for n in range(most + 1) for x in combinations(line, len(line) - n)}


def keys(lines: list[bytes]) -> list[list[int]]:
    """Keys of each normalised line, as signed longs: lines that share none are not compared."""
    ends, found, _ = _keyed(lines)
    return [sorted(set(found[a:b].tolist())) for a, b in zip(ends, ends[1:])]


def _keyed(lines: list[bytes]):
    """(ends, keys, places): keys of all lines, those of line i from ends[i] to ends[i + 1], and the places of the runs of each.

    These are one number, 30 // rows bits for each of the rows of a band, ANY
    where one tells no place; bit 30 is set if there are three; -1: none tells.
    """
    import numpy as np
    import xxhash

    sizes, found, places = [], [], []
    for family, (gram, bands, rows, longest) in enumerate(BANDS):
        ids = np.array([i for i, x in enumerate(lines) if not longest or len(x) <= longest], np.int64)
        low, at = (x.reshape(len(ids), bands, rows) for x in _minima([lines[i] for i in ids], gram, bands * rows))
        key = np.broadcast_to(np.arange(bands, dtype=np.uint64) + np.uint64(100 * family + 1), low.shape[:2])
        where = np.full(key.shape, rows - 2 << 30, np.int64)
        for r in range(rows):
            key = _mixed(key ^ low[:, :, r])
            where |= np.where((at[:, :, r] < 0) | (at[:, :, r] > ANY[rows]), ANY[rows], at[:, :, r]) << 30 // rows * r
        sizes.append(np.repeat(ids, bands)), found.append(key.view(np.int64).ravel()), places.append(where.ravel())
    for i, x in enumerate(lines):
        if len(x) <= 4 * EXACT and len(text := x.decode()) <= EXACT:
            left = [xxhash.xxh64_intdigest(d, SEED) for d in _deletions(text)]
            sizes.append(np.full(len(left), i)), found.append(np.array(left, np.uint64).view(np.int64)), places.append(np.full(len(left), -1))
    line = np.concatenate(sizes)
    order = np.argsort(line, kind="stable")
    return np.r_[0, np.cumsum(np.bincount(line, minlength=len(lines)))], np.concatenate(found)[order], np.concatenate(places)[order]


def normalised(text: Column) -> Column:
    """Lower case, with every run of other characters than letters, digits and line ends as one space."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}\n]+", " ")


def _lines(body: bytes) -> list[bytes]:
    """The normalised lines of a normalised text; empty if they have no letter or digit."""
    return [x.strip(b" ") for x in body.split(b"\n")]


def occurrences(docs: DataFrame) -> DataFrame:
    """(doc_id, th, line_no, name, size, keys, places): all lines; name is md5 of the normalised line, null as size (in characters), keys and places are where it is empty."""

    def run(batches):
        import hashlib

        import pyarrow as pa

        for b in batches:
            rows, number, each, seen = [], [], [], {}
            for i, body in enumerate(b.column(2)):
                for n, x in enumerate(_lines(body.as_py())):
                    rows.append(i), number.append(n), each.append(seen.setdefault(x, len(seen)) if x else None)
            names = pa.array([hashlib.md5(x).digest() for x in seen], pa.binary())
            sizes = pa.array([len(x.decode()) for x in seen], pa.int32())
            ends, *keyed = _keyed(list(seen)) if seen else ([0], [], [])
            found, places = (pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, kind)) for x, kind in zip(keyed, (pa.int64(), pa.int32())))
            each, at = pa.array(each, pa.int64()), pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array(number, pa.int32()), names.take(each), sizes.take(each), found.take(each), places.take(each)],
                                             ["doc_id", "th", "line_no", "name", "size", "keys", "places"])

    kind = dict(docs.dtypes)["doc_id"]
    return _texts(docs).mapInArrow(run, f"doc_id {kind}, th long, line_no int, name binary, size int, keys array<long>, places array<int>")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", text_key(F.col("text")).alias("th"), normalised(F.coalesce("text", F.lit(""))).cast("binary").alias("text"))


def pigeonhole_keys() -> list[tuple[int, int]]:
    """Masks of two blocks each: fingerprints that differ in at most MAX_BITS bits agree on one (for `simhash.links`)."""
    ends = [64 * i // BLOCKS for i in range(BLOCKS + 1)]
    blocks = [_bits(range(a, b)) for a, b in zip(ends, ends[1:])]
    return [(-1, a | b) for a, b in combinations(blocks, 2)]


def _least(up: int, down: int, rows: int, at: int, columns: int) -> int:
    """What the edit distance is at least, by the column `at` of its table: up and down are the steps from cell to cell."""
    import numpy as np

    up, down = (np.unpackbits(np.frombuffer(x.to_bytes(rows // 8 + 1, "little"), np.uint8), bitorder="little")[:rows].astype(np.int32) for x in (up, down))
    cells = at + np.r_[0, np.cumsum(up - down)]
    return int((cells + np.abs(rows - np.arange(rows + 1) - (columns - at))).min())


def distance(a: str, b: str, most: int) -> int:
    """Edit distance by bit vectors over the differing middle; more than `most` may come back as any larger number."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > most:
        return most + 1
    at = 0
    while at < len(a) and a[at] == b[at]:
        at += 1
    end = 0
    while end < len(a) - at and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[at:len(a) - end], b[at:len(b) - end]
    if not a:
        return len(b)
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    mask, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, score = mask, 0, len(a)
    step = max(len(b) // 8, 32)
    for first in range(0, len(b), step):
        if first and _least(up, down, len(a), first, len(b)) > most:
            return most + 1
        part = b[first:first + step]
        for left, c in zip(range(len(b) - first - 1, -1, -1), part):
            eq = where.get(c, 0)
            diagonal = (((eq & up) + up) ^ up) | eq | down
            plus, minus = (down | ~(diagonal | up)) & mask, up & diagonal
            score += bool(plus & top) - bool(minus & top)
            if score - left > most:
                return most + 1
            plus, minus = (plus << 1 | 1) & mask, (minus << 1) & mask
            up, down = (minus | ~(diagonal | plus)) & mask, plus & diagonal
    return score


def similar(a: str, b: str, least: float = SIMILARITY) -> bool:
    longest = max(len(a), len(b))
    most = int(longest * (1 - least) + 1e-9)
    return distance(a, b, most) <= most


def _grams(text: str):
    """Hashes of the 3-grams of a line, in their order."""
    import numpy as np

    c = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return (c[:-2] * np.uint32(0x9E3779B1) ^ c[1:-1] * np.uint32(0x85EBCA6B) ^ c[2:] * np.uint32(0xC2B2AE35)) * np.uint32(0x27D4EB2F)


def _sets(grams: list, longest: int):
    """The hashed 3-grams (or wider ones) of each line as a set of bits: an edit takes three of them (the width) from a line at most."""
    import numpy as np

    bits = min(max(1 << (WIDTH * longest - 1).bit_length(), 64), WIDEST)
    every = np.zeros((len(grams), bits), bool)
    for line, g in zip(every, grams):
        line[g >> np.uint32(33 - bits.bit_length())] = True
    return np.packbits(every, axis=1).view(np.uint64)


def _missing(a, b):
    """How many bits of the sets `a` are in none of `b`."""
    import numpy as np

    return np.bitwise_count(a & ~b).sum(axis=-1, dtype=np.int64)


def _placed(grams):
    """The 3-grams of a line with their places, sorted (for `_near`)."""
    import numpy as np

    return np.sort(grams.astype(np.int64) << 31 | np.arange(len(grams)))


def _near(grams, placed, more: int, most: int, width: int = 3) -> bool:
    """Whether enough 3-grams (or of another width) of a line stand near their place in another, `placed`, that is `more` characters longer.

    `most` edits leave all grams but three each (the width); a gram that s characters more
    precede in the other line has at least |s| edits before it and |more - s|
    after it, so s is at least (more - most) / 2 and at most (more + most) / 2.
    """
    import numpy as np

    least = len(grams) - width * most
    if least <= 0:
        return True
    if not len(placed):
        return False
    low = (grams.astype(np.int64) << 31) + np.arange(len(grams)) + -((most - more) // 2)
    at = np.searchsorted(placed, low)
    met = placed[np.minimum(at, len(placed) - 1)]
    return int(((met >= low) & (met <= low + most)).sum()) >= least


def _wider(grams):
    """Hashes of the 4-grams from those of the 3-grams."""
    import numpy as np

    return (grams[:-1] * np.uint32(0x85EBCA6B) ^ grams[1:] * np.uint32(0xC2B2AE35)) * np.uint32(0x27D4EB2F)


def _all_near(lines: list, placed, more, most, width: int):
    """`_near` for many lines in one."""
    import numpy as np

    if not len(placed):
        return np.array([_near(g, placed, 0, int(m), width) for g, m in zip(lines, most)], bool)
    n = np.array([len(g) for g in lines])
    each = np.repeat(np.arange(len(lines)), n)
    place = np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)
    low = (np.concatenate(lines).astype(np.int64) << 31) + place + -((most - more) // 2)[each]
    met = placed[np.minimum(np.searchsorted(placed, low), len(placed) - 1)]
    return np.bincount(each, (met >= low) & (met <= low + most[each]), len(lines)) >= n - width * most


def _bound(a: str, b: str, most: int) -> int:
    """An edit distance that a walk finds, so at least the true one; beyond `most` the walk ends."""
    i = j = cost = 0
    while True:
        step = 64
        while step:
            if i + step <= len(a) and a[i:i + step] == b[j:j + step]:
                i, j = i + step, j + step
            else:
                step //= 2
        rest = cost + max(len(a) - i, len(b) - j)
        if rest <= most or i >= len(a) or j >= len(b):
            return rest
        for skip in range(min(most - cost, len(a) - i - ANCHOR) + 1):
            to = b.find(a[i + skip:i + skip + ANCHOR], j, j + most - cost + ANCHOR)
            if to >= 0:
                break
        else:
            return rest
        i, j, cost = i + skip, to, cost + max(skip, to - j)


def _alike(a: str, b: str, x: list, y: list) -> bool:
    """`similar` for lines whose 3- and 4-grams x and y have passed `_near` in the order y, x."""
    most = int(max(len(a), len(b)) * (1 - SIMILARITY) + 1e-9)
    if _bound(a, b, most) <= most:
        return True
    return all(_near(g, _placed(h), len(b) - len(a), most, w) for w, g, h in ((3, x[0], y[0]), (4, x[1], y[1]))) and distance(a, b, most) <= most


def _chart(texts: list[str]):
    """(codes, first, size, exact): the lines as one array of small numbers, where each begins, their lengths, and whether no two characters share a number.

    0 stands after every line, and for no character of one.
    """
    import numpy as np

    points = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le"), np.uint32)
    size = np.array([len(t) for t in texts], np.int64)
    often = np.bincount(points)
    often[ord("\n")] = 0
    known = np.flatnonzero(often)
    if not (exact := len(known) < LETTERS):  # the rare ones share the last number
        known = known[np.argsort(-often[known], kind="stable")]
    number = np.zeros(len(often), np.uint8)
    number[known] = np.minimum(np.arange(1, len(known) + 1), LETTERS - 1)
    return number[points], np.cumsum(size + 1) - size - 1, size, exact


def _few(length: int) -> int:
    """Pairs of lines of this length up to which a distance for each costs less than one for all at once."""
    return max(PAIRS // 256, int(length) // 40)


def _near_enough(chart, a, b, most):
    """(found, open): where the edit distance of the lines a and b (arrays of places, a no longer than b) is at most `most`, for many pairs at once, and where that stays open.

    Rows (a) go by in blocks of 64, as bits; columns (b) are those that a path
    of `most` edits can reach: j - i is at least (n - m - most) / 2 and at most
    (n - m + most) / 2. Other cells come out too large at most. A pair goes as
    soon as no cell of a block's last row can lead to `most`; the last few stay
    open. Both lines are continued by as many zeros as fill the last block,
    which adds no edit.
    """
    import numpy as np

    codes, start, size, _ = chart
    one, full = np.uint64(1), np.uint64(2**64 - 1)
    either, both, exclusive, invert, plus_, shift = np.bitwise_or, np.bitwise_and, np.bitwise_xor, np.invert, np.add, np.left_shift
    found, wait, more = np.zeros(len(a), bool), np.zeros(len(a), bool), size[b] - size[a]
    low, high = int(((most - more) // 2).max()) + 1, int(((most + more) // 2).max()) + 1
    kinds, alive, base, last = int(codes.max()) + 1, np.arange(len(a)), 0, 64 + high
    score, above, few = np.zeros(len(a), np.int64), (), _few(size[a].min())
    for row in range(0, int(size[a].max()), 64):
        n, width = len(alive), last - base
        lines, each = np.unique(a[alive], return_inverse=True)
        rows = codes[np.minimum(start[lines][:, None] + np.arange(row, row + 64), (start + size)[lines][:, None])]
        table, every = np.zeros((len(lines), kinds), np.uint64), np.arange(len(lines))
        for r in range(64):
            table[every, rows[:, r]] |= one << np.uint64(r)
        key = codes.take(np.minimum(start[b[alive]] + np.arange(base, last)[:, None], (start + size)[b[alive]]))
        met = table.ravel().take(key + each * kinds)
        rises, falls = np.empty((width, n), np.uint64), np.empty((width, n), np.uint64)
        up, down, x, y, z = np.full(n, full), np.zeros(n, np.uint64), *(np.empty(n, np.uint64) for _ in range(3))
        always, never = np.ones(n, np.uint64), np.zeros(n, np.uint64)
        known = len(above[0]) if above else 0
        for t, (eq, plus, minus) in enumerate(zip(met, rises, falls)):
            rise, fall = (above[0][t], above[1][t]) if t < known else (always, never)
            either(eq, down, x)
            either(eq, fall, eq)
            both(eq, up, y)
            plus_(y, up, y)
            exclusive(y, up, y)
            either(y, eq, y)
            both(up, y, minus)
            either(y, up, y)
            invert(y, y)
            either(y, down, plus)
            shift(plus, one, y)
            either(y, rise, y)
            shift(minus, one, z)
            either(z, fall, z)
            both(y, x, down)
            either(x, y, x)
            invert(x, x)
            either(x, z, up)
        rises >>= np.uint64(63)
        falls >>= np.uint64(63)
        cells = np.cumsum((rises - falls).view(np.int64), axis=0, dtype=np.int32) + (score + 64).astype(np.int32)
        aim = more[alive].astype(np.int32) + np.int32(row + 63 - base)  # the column of the last cell, had the lines only this many rows
        least = np.minimum(np.abs(aim - np.arange(width, dtype=np.int32)[:, None]).__iadd__(cells).min(axis=0), score + 64 + np.abs(aim + 1))
        ends = size[a][alive] <= row + 64
        found[alive[ends]] = cells[aim[ends], np.flatnonzero(ends)] <= most[alive[ends]]
        keep = np.flatnonzero(~ends & (least <= most[alive]))
        if len(keep) < few:
            wait[alive[keep]] = True
            break
        skip = max(0, row + 64 - low) - base
        score = (cells[skip - 1] if skip else score + 64)[keep].astype(np.int64)
        above = rises[skip:, keep], falls[skip:, keep]
        alive, base, last = alive[keep], base + skip, row + 128 + high
    return found, wait


def _tested(chart, texts: list[str], a, b):
    """Which of the pairs a, b of lines are alike."""
    import numpy as np

    _, _, size, exact = chart
    swap = size[a] > size[b]
    a, b = np.where(swap, b, a), np.where(swap, a, b)
    most = (size[b] * (1 - SIMILARITY) + 1e-9).astype(np.int64)
    order, out, first = np.argsort(size[a], kind="stable"), np.zeros(len(a), bool), 0
    shorter, grams = size[a][order], {}

    def of(line: int) -> list:
        if line not in grams:
            grams[line] = [g := _grams(texts[line]), _wider(g)]
        return grams[line]

    def walked(p: int) -> bool:
        return _bound(texts[a[p]], texts[b[p]], int(most[p])) <= most[p]

    def alike(p: int) -> bool:
        x, y, k = a[p], b[p], int(most[p])
        return all(_near(h, _placed(g), int(size[x] - size[y]), k, w) for w, g, h in zip((3, 4), of(x), of(y))) and _alike(texts[x], texts[y], of(x), of(y))

    while first < len(order):
        last = min(first + PAIRS, int(np.searchsorted(shorter, max(shorter[first] * 1.8, 64), "right")))
        part, few = order[first:last], _few(shorter[first])
        if shorter[first] > 256 or len(part) < few:  # a walk settles most alike pairs
            out[part] = [walked(p) for p in part.tolist()]
            part = part[~out[part]]
        first = last
        rest = np.ones(len(part), bool)
        if len(part) >= few:
            out[part], rest = _near_enough(chart, a[part], b[part], most[part])
            if not exact:
                rest |= out[part]
        for p in part[rest].tolist():
            out[p] = alike(p)
    return out


def _meet(size, places, a, b):
    """Whether the lines a and b (arrays) may be alike by their sizes and by the places of the runs that both have.

    A run that stands once in each and that no edit of an alike pair falls on
    moves by s characters, with |s| edits before it and |more - s| after it at
    least; two such runs, by s and then t: |s|, |t - s| and |more - t|.
    """
    import numpy as np

    swap = size[a] > size[b]
    a, b = np.where(swap, b, a), np.where(swap, a, b)
    more, most = size[b] - size[a], (size[b] * (1 - SIMILARITY) + 1e-9).astype(np.int64)
    ok, three = more <= most, places >= 1 << 30
    bits, any_ = np.where(three, 10, 15), np.where(three, ANY[3], ANY[2])
    at = [np.where((places < 0) | ((x := (places >> bits * row) & any_) == any_) | (~three & (row == 2)), -1, x) for row in range(3)]
    moved = []
    for x in at:
        s, known = x[b] - x[a], (x[a] >= 0) & (x[b] >= 0)
        ok &= ~known | (np.abs(s) + np.abs(more - s) <= most)
        moved.append((x[a], s, known))
    for (x, s, k), (y, t, m) in combinations(moved, 2):
        s, t = np.where(x <= y, s, t), np.where(x <= y, t, s)
        ok &= ~(k & m) | (np.abs(s) + np.abs(t - s) + np.abs(more - t) <= most)
    return ok


def _pairs(size, places, side, first, count):
    """The pairs of lines, as two arrays, that `_meet` in the buckets of `count` lines from `first` on; if the lines of one are of two blocks, those across them."""
    import numpy as np

    mixed, pairs = np.repeat(np.maximum.reduceat(side, first) > np.minimum.reduceat(side, first), count), [np.zeros((2, 0), np.int64)]
    for n in np.unique(count[count > 1]).tolist():
        i, j = np.triu_indices(n, 1)
        at, step = first[count == n], max(1, CHUNK // len(i))
        for part, some in product((at[x:x + step] for x in range(0, len(at), step)), [slice(x, x + CHUNK) for x in range(0, len(i), CHUNK)]):
            a, b = (part[:, None] + i[some]).ravel(), (part[:, None] + j[some]).ravel()
            fit = _meet(size, places, a, b) & (~mixed[a] | (side[a] != side[b]))
            pairs.append(np.stack([a[fit], b[fit]]))
    return np.concatenate(pairs, axis=1)


def _forest(texts: list[str], bucket, side, places) -> list[tuple[int, int]]:
    """`_verified` for many buckets at once: lines, the bucket of each (ascending) and its block; edges as places of lines.

    Of the pairs whose lines are not connected yet, each line is compared with
    one, then with four times as many in each round.
    """
    import numpy as np

    chart = _chart(texts)
    size = chart[2]
    first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    count = np.diff(np.r_[first, len(bucket)])
    a, b = _pairs(size, places, side, first, count)
    order = np.argsort(a, kind="stable")
    a, b = a[order], b[order]
    up, edges, some = list(range(len(texts))), [], 1

    def root(x: int) -> int:
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    while len(a):
        new = np.r_[True, a[1:] != a[:-1]]
        rank = np.arange(len(a)) - np.maximum.accumulate(np.where(new, np.arange(len(a)), 0))
        now = rank < some
        met = np.flatnonzero(now)[_tested(chart, texts, a[now], b[now])]
        for x, y in zip(a[met].tolist(), b[met].tolist()):
            if (r := root(x)) != (s := root(y)):
                up[r] = s
                edges.append((x, y))
        a, b, some = a[~now], b[~now], some * 4
        if len(met) and len(a):
            roots = np.array([root(x) for x in range(len(texts))])
            apart = roots[a] != roots[b]
            a, b = a[apart], b[apart]
    return edges


def _linked(column):
    """Edges (name, name) of the buckets in `column`, a list array of (name, place, block, norm)."""
    import numpy as np

    rows, count = column.flatten(), np.diff(column.offsets.to_numpy())
    name, place, side, norm = (rows.field(x) for x in ("name", "place", "block", "norm"))
    place = place.to_numpy().astype(np.int64)
    names, side = name.to_pylist(), side.to_numpy()
    texts = [x.decode() for x in norm.to_pylist()]
    end = np.cumsum(count)
    size = np.array([len(t) for t in texts], np.int64)
    bucket, out, some, pairs, chars = np.repeat(np.arange(len(count)), count), [], [], 0, 0

    def flush() -> None:
        at = np.concatenate([np.arange(end[k] - count[k], end[k]) for k in some])
        out.extend((names[at[x]], names[at[y]]) for x, y in _forest([texts[i] for i in at.tolist()], bucket[at], side[at], place[at]))

    for k in np.flatnonzero(count > 1).tolist():
        own = slice(end[k] - count[k], end[k])
        if size[own].max() > LONG:
            out += _verified([{"name": n, "place": p, "block": s, "norm": t} for n, p, s, t in zip(names[own], place[own].tolist(), side[own].tolist(), texts[own])])
            continue
        some.append(k)
        pairs, chars = pairs + int(count[k]) ** 2 // 2, chars + int(size[own].sum())
        if pairs > AT_ONCE or chars > AT_ONCE * 8:
            flush()
            some, pairs, chars = [], 0, 0
    if some:
        flush()
    return out


def _verified(items: list[dict]) -> list[tuple[bytes, bytes]]:
    """A spanning forest of the links between alike lines; if the lines are of two blocks, of the links across them."""
    import numpy as np

    items = [x for _, x in sorted({x["name"]: x for x in items}.items())]
    texts = [x["norm"] for x in items]
    if len(items) == 2 and abs(len(texts[0]) - len(texts[1])) > int(max(map(len, texts)) * (1 - SIMILARITY) + 1e-9):
        return []  # most buckets are small: no arrays for these
    size = np.array([len(t) for t in texts])
    grams = {3: [_grams(t) for t in texts]}
    grams[4] = [_wider(g) for g in grams[3]]
    sets = {w: _sets(g, int(size.max())) for w, g in grams.items()} if len(items) > FEW else {}
    side, places = (np.array([x[n] for x in items], np.int64) for n in ("block", "place"))
    cross, left, edges = len(set(side)) > 1, np.ones(len(items), bool), []
    for first in range(len(items)):
        queue = [first] if left[first] else []
        left[first] = False
        while queue:
            at = queue.pop()
            longest = np.maximum(size, size[at])
            most = (longest * (1 - SIMILARITY) + 1e-9).astype(np.int64)
            may = left & (longest - np.minimum(size, size[at]) <= most)
            if cross:
                may &= side != side[at]
            may = np.flatnonzero(may)
            may = may[_meet(size, places, np.full(len(may), at), may)]
            for width, bits in sets.items():
                may = may[_missing(bits[may], bits[at]) <= width * most[may]]
                may = may[_missing(bits[at], bits[may]) <= width * most[may]]
            for width, each in grams.items():
                if len(may):
                    placed, step = _placed(each[at]), max(CHUNK // int(size[may].max()), 1)
                    parts = [may[i:i + step] for i in range(0, len(may), step)]
                    may = np.concatenate([x[_all_near([each[k] for k in x], placed, size[at] - size[x], most[x], width)] for x in parts])
            for k in may.tolist():
                if _alike(texts[at], texts[k], [g[at] for g in grams.values()], [g[k] for g in grams.values()]):
                    edges.append((items[at]["name"], items[k]["name"]))
                    left[k] = False
                    queue.append(k)
    return edges


def _fetched(docs: DataFrame, spots: DataFrame) -> DataFrame:
    """`spots` (doc_id, th, line_no, key, place, block, blocks) as key, place, block, blocks, name and norm, the normalised line; only texts with a spot are normalised."""

    def run(batches):
        import hashlib

        import pyarrow as pa

        seen = set()
        for b in batches:
            out = []
            for doc, th, body, wanted in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3).to_pylist()):
                if (doc, th) in seen:  # rows that repeat doc_id and text
                    continue
                seen.add((doc, th))
                each = _lines(body.as_py())
                out += [(w["key"], w["place"], w["block"], w["blocks"], hashlib.md5(each[w["line_no"]]).digest(), each[w["line_no"]]) for w in wanted]
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], kind) for i, kind in enumerate(kinds)], ["key", "place", "block", "blocks", "name", "norm"])

    lists = spots.groupBy("doc_id", "th").agg(F.collect_list(F.struct("line_no", "key", "place", "block", "blocks")).alias("wanted")).withColumnsRenamed(
        {"doc_id": "_d", "th": "_t"})
    keyed = docs.select("doc_id", text_key(F.col("text")).alias("th"), "text")
    met = keyed.join(lists, keyed["doc_id"].eqNullSafe(lists["_d"]) & (keyed["th"] == lists["_t"]))
    text = normalised(F.coalesce("text", F.lit(""))).cast("binary").alias("text")
    return met.select("doc_id", "th", text, "wanted").mapInArrow(run, "key long, place int, block int, blocks int, name binary, norm binary")


def _written(df: DataFrame, label: str) -> DataFrame:
    """`stored`; the files of its exchanges are removed at its end."""
    conf = df.sparkSession.conf
    old = conf.get(FREE, None)
    conf.set(FREE, "true")
    try:
        return stored(df, label)
    finally:
        conf.unset(FREE) if old is None else conf.set(FREE, old)


def _fits(less: Column, more: Column) -> Column:
    """Whether lines of these sizes may be alike; no where one is null."""
    return F.coalesce(more - less <= F.floor(more * (1 - SIMILARITY) + 1e-9), F.lit(False))


def _cut(spots: DataFrame, runs: list[str], row: int) -> DataFrame:
    """`spots` of a key and `runs` in runs of places (of one row of a band) without a gap that no pair of them can take; `_meet` has the rule for a pair."""
    wide = F.col("place") >= 1 << 30
    part = lambda bits, rows: F.when(F.shiftright("place", bits * row).bitwiseAND(ANY[rows]) < ANY[rows], F.shiftright("place", bits * row).bitwiseAND(ANY[rows]))
    spots = spots.withColumn("at", F.when(F.col("place") >= 0, F.when(wide, part(10, 3)).otherwise(part(15, 2) if row < 2 else F.lit(None))))
    by = Window.partitionBy("key", *runs).orderBy("at")
    all_ = by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    most = F.floor(F.max("size").over(all_) * (1 - SIMILARITY) + 1e-9)
    spots = spots.withColumns({"reach": most + F.least(most, F.max("size").over(all_) - F.min("size").over(all_)), "free": F.max(F.col("at").isNull()).over(all_),
                               "before": F.lag("at").over(by), "after": F.lead("at").over(by), "first": F.lag("size").over(by).isNull(), "last": F.lead("size").over(by).isNull()})
    spots = spots.withColumns({"starts": F.col("first") | (~F.col("free") & ((F.col("at") - F.col("before")) * 2 > F.col("reach"))),
                               "ends": F.col("last") | (~F.col("free") & ((F.col("after") - F.col("at")) * 2 > F.col("reach")))})
    run = F.sum(F.col("starts").cast("int")).over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return spots.withColumn(f"run{row}", run).filter(~(F.col("starts") & F.col("ends"))).drop("at", "reach", "free", "before", "after", "first", "last", "starts", "ends")


def buckets(each: DataFrame) -> DataFrame:
    """(doc_id, th, line_no, size, key, place, blocks, block): the lines to compare, by bucket.

    A bucket holds lines of one key, in the order of sizes without a step that
    alike lines cannot take: two lines are only alike if all sizes between theirs
    are steps that fit. So with the places of the runs that make the key. Buckets
    of the same lines are one, without places.
    """
    places = F.col("first.places") if "places" in each.schema["first"].dataType.names else F.transform("first.keys", lambda _: F.lit(-1))
    keyed = each.select("first.doc_id", "first.th", "first.line_no", "first.size", F.explode(F.arrays_zip(F.col("first.keys").alias("key"), places.alias("place"))).alias("k"))
    keyed = keyed.select("doc_id", "th", "line_no", "size", "k.key", "k.place")
    by = Window.partitionBy("key").orderBy("size")
    keyed = keyed.withColumns({"starts": ~_fits(F.lag("size").over(by), F.col("size")), "ends": ~_fits(F.col("size"), F.lead("size").over(by))})
    run = F.sum(F.col("starts").cast("int")).over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    spots, runs = keyed.withColumn("run", run).filter(~(F.col("starts") & F.col("ends"))).drop("starts", "ends"), ["run"]
    for row in range(3):
        spots = _cut(spots, runs, row)
        runs.append(f"run{row}")
    spots = _written(spots.withColumn("key", F.xxhash64("key", *runs)).drop(*runs), "line-spots")
    h = F.xxhash64(F.col("doc_id").isNull(), "doc_id", "th", "line_no")
    sets = spots.groupBy("key").agg(F.count("*").alias("n"), F.bit_xor(h).alias("x"), F.bit_xor(F.xxhash64(h)).alias("y"))
    distinct = sets.groupBy("n", "x", "y").agg(F.min("key").alias("key"), F.count("*").alias("alike")).select(
        "key", F.ceil(F.col("n") / GROUP).cast("int").alias("blocks"), (F.col("alike") > 1).alias("any"))
    distinct = _written(distinct, "line-buckets")
    wanted = _written(spots.join(distinct, "key").withColumns(
        {"block": F.pmod(h, F.col("blocks")).cast("int"), "place": F.when(F.col("any"), F.lit(-1)).otherwise(F.col("place"))}).drop("any"), "line-wanted")
    discard(spots)
    discard(distinct)
    met = _written(_partnered(wanted), "line-partnered")
    discard(wanted)
    return met


def _partnered(wanted: DataFrame) -> DataFrame:
    """`wanted` without the lines that `_meet` no other of their bucket; buckets of several blocks stay as they are."""
    names = [n for n in wanted.columns if n != "key"]
    lists = wanted.filter("blocks = 1").groupBy("key").agg(F.collect_list(F.struct(*names)).alias("items"))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            rows, count = b.column(1).flatten(), np.diff(b.column(1).offsets.to_numpy())
            if not len(rows):
                continue
            size, places = (rows.field(n).to_numpy().astype(np.int64) for n in ("size", "place"))
            first = np.cumsum(count) - count
            at = np.unique(_pairs(size, places, np.zeros(len(rows), np.int64), first, count))
            each = b.column(0).take(pa.array(np.repeat(np.arange(len(count)), count)[at]))
            yield pa.RecordBatch.from_arrays([each, *(rows.field(n).take(pa.array(at)) for n in names)], ["key", *names])

    kinds = dict(wanted.dtypes)
    met = lists.mapInArrow(run, ", ".join(f"`{n}` {kinds[n]}" for n in ("key", *names)))
    return met.unionByName(wanted.filter("blocks > 1"))


def _links(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(a, b): names of alike lines that meet in a bucket of `wanted`."""
    texts = _fetched(docs, wanted.drop("size"))
    spread = texts.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tasks = spread.groupBy("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")).agg(
        F.collect_list(F.struct("name", "place", "block", "norm")).alias("items"))

    def run(batches):
        import pyarrow as pa

        for b in batches:
            out = _linked(b.column(0))
            yield pa.RecordBatch.from_arrays([pa.array([e[i] for e in out], pa.binary()) for i in (0, 1)], ["a", "b"])

    return tasks.select("items").mapInArrow(run, "a binary, b binary")


def groups(found: DataFrame, each: DataFrame, docs: DataFrame) -> DataFrame:
    """(name, keep): for each distinct line the occurrence (null_id, doc_id, th, line_no) that its group keeps."""
    wanted = buckets(each)
    place = F.struct("first.null_id", "first.doc_id", "first.th", "first.line_no").alias("first")
    named = _written(each.select("name", place), "line-named")
    discard(each)
    load = wanted.agg(F.sum(F.col("size").cast("long") * F.col("blocks"))).first()[0] or 0
    rounds = max(1, ceil(load / max(found.agg(F.sum("size")).first()[0] or 0, ROUND)))
    turn = F.pmod(F.xxhash64("key"), F.lit(rounds))
    parts = [_written(_links(docs, wanted.filter(turn == i)), "line-links") for i in range(rounds)]
    discard(wanted)
    links = parts[0]
    for part in parts[1:]:
        links = links.unionByName(part)
    comp = components(links)
    rooted = named.join(comp, F.col("name") == F.col("node"), "left").select("name", "first", F.coalesce("root", "name").alias("root"))
    rooted = _written(rooted, "line-roots")
    discard(named)
    # stored before it is joined back: a group may hold most rows, and AQE can split only plain exchanges
    keep = _written(rooted.groupBy("root").agg(F.min("first").alias("keep")), "line-keep")
    return _written(rooted.select("name", "root").join(keep, "root").select("name", "keep"), "line-groups")


def mark(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, th, n_lines, removed (numbers of the lines that go, ascending from 0).

    Of each group of lines that verified links connect the first occurrence
    stays, by doc_id (nulls last), text hash and line number. Lines without a
    letter or digit, null and empty texts are kept and not counted; rows that
    repeat doc_id and text are the same occurrence, kept or dropped alike; an
    empty table gives an empty table; other columns are ignored.
    """
    require(docs, "doc_id", "text")
    docs = docs.select("doc_id", "text")
    keyed = _written(occurrences(docs), "line-occurrences")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("null_id"), "doc_id", "th", "line_no", "size", "keys", "places")).alias("first")
    each = _written(keyed.filter(F.col("name").isNotNull()).groupBy("name").agg(first), "line-distinct")
    found = _written(keyed.drop("keys", "places"), "line-places")
    discard(keyed)
    keep = groups(found, each, docs)
    all_ = found.drop("size").join(keep, "name", "left")
    kept = F.col("doc_id").eqNullSafe(F.col("keep.doc_id")) & (F.col("th") == F.col("keep.th")) & (F.col("line_no") == F.col("keep.line_no"))
    gone = F.col("name").isNotNull() & ~kept
    per = all_.groupBy("doc_id", "th").agg(
        F.sum((F.col("line_no") == 0).cast("int")).alias("times"), F.count("name").alias("n"),
        F.sort_array(F.collect_set(F.when(gone, F.col("line_no")))).alias("removed"))
    return per.select("doc_id", "th", (F.col("n") / F.col("times")).cast("long").alias("n_lines"), "removed",
                      F.explode(F.sequence(F.lit(1), F.col("times"))).alias("_")).drop("_")


def deduplicate(docs: DataFrame) -> DataFrame:
    """`docs` with the removed lines cut out of text; a null text stays null."""
    names = docs.columns
    gone = mark(docs).dropDuplicates(["doc_id", "th"]).select(F.col("doc_id").alias("_d"), F.col("th").alias("_t"), F.col("removed").alias("_gone"))
    keyed = docs.withColumn("_k", text_key(F.col("text")))
    out = keyed.join(gone, keyed["doc_id"].eqNullSafe(gone["_d"]) & (F.col("_k") == F.col("_t")), "left")
    kept = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains(F.coalesce("_gone", F.array().cast("array<int>")), i)), "\n")
    return out.withColumn("text", kept).select(*names)
