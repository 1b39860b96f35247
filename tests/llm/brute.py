"""Plain versions of the operators, and tables with the rows that break things."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

ASCII_LOWER = {c: c + 32 for c in range(65, 91)}
LONG = " ".join(f"word{i % 977} Über{i % 31}" for i in range(30_000))
DOCS = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, k bigint, r bigint, fp bigint, token string, "
    "copy int, rate double, bin_id bigint, keep boolean, kept string, spans array<int>, words int, places string"
)
_MORE = ("x", 1, 2, 3, "t", 7, 0.5, 9, False, "kept", [1], 4, "p")


def messy(spark, extra=()):
    """Documents with nulls, empty and long texts, repeated rows and columns named like those the operators use."""
    passage = "The MIT License grants what follows to any person, and this sentence is long enough to be found again. " * 3
    rows = [
        (1, "Plain words here, and then some more of them.", "en", "a", 45),
        (2, None, "en", "a", None),
        (3, "", "de", None, 0),
        (4, " \t\n ", None, "b", 4),
        (5, LONG, "en", "a", len(LONG)),
        (6, LONG, "en", "a", len(LONG)),
        (7, "one two", "fr", "b", 7),
        (7, "one two", "fr", "b", 7),
        (7, "another text under the same id, cc by-nc", "fr", "b", 40),
        (None, "no id at all", "en", "c", 12),
        (None, None, None, None, None),
        (8, passage + "First tail é.", "en", "a", 0),
        (9, "A head. " + passage + "Second tail.", "en", "c", 0),
        (10, "Apache License, Version 2.0 <|endoftext|> don't É é 中文 x\x1cy", "en", "a", -5),
        *extra,
    ]
    return spark.createDataFrame([(*row, *_MORE) for row in rows], DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII_LOWER))


def fingerprint(text):
    w = words(text)
    shingles = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def near_groups(rows, distance=4):
    """(fingerprint, least id of the group) per (id, text)."""
    fps = [fingerprint(text) for _, text in rows]
    distinct = sorted(set(fps))
    parent = {fp: fp for fp in distinct}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if (a ^ b).bit_count() <= distance:
                parent[find(a)] = find(b)
    least = {}
    for (key, _), fp in zip(rows, fps):
        if key is not None:
            least[find(fp)] = min(least.get(find(fp), key), key)
    return [(f"{fp:016x}", least.get(find(fp))) for fp in fps]


def removed(texts, length):
    """(bytes, removed, runs, sha256 of the rest, the rest) per text."""
    raw = [(t or "").encode() for t in texts]
    starts = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if starts[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        rest = bytes(c for c, g in zip(b, gone) if not g)
        out.append((len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(rest).hexdigest(), rest))
    return out


def license_places(text, phrases):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(ASCII_LOWER))
    found = [(i, label) for label, phrase in phrases for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in found]
    return len(w), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({label for _, label in found}))


def held_out(key):
    return zlib.crc32(("" if key is None else str(key)).encode()) % 7 == 2


def katz(rows, discounts):
    """Per (id, text): held out, tokens, known tokens, training tokens, base score, score; and the chance function."""
    docs = [(held_out(key), words(text)) for key, text in rows]
    count, pairs, first = Counter(), Counter(), Counter()
    for held, w in docs:
        if not held:
            count.update([*w, "\0end"])
            first.update(["\0start", *w])
            pairs.update(zip(["\0start", *w], [*w, "\0end"]))
    n, v = sum(count.values()), len(count)
    of_counts = lambda c: [sum(x == r for x in c.values()) for r in range(1, 7)]
    dw, dp = discounts(of_counts(count)), discounts(of_counts(pairs))
    cut = lambda d, c: d[c] * c if c <= 5 else c
    left = 1 - sum(cut(dw, c) for c in count.values()) / n if n else 1.0
    unknown = left if left > 1e-12 else 1 / (n + v + 1)
    scale = (1 - unknown) / (1 - left) if left < 1 else 1.0
    word = lambda w: scale * cut(dw, count[w]) / n if count[w] else unknown
    after = defaultdict(dict)
    for (h, w), c in pairs.items():
        after[h][w] = c

    def chance(w, h):
        if not first[h]:
            return word(w)
        taken = sum(cut(dp, c) for c in after[h].values()) / first[h]
        tight = 1 - taken <= 1e-12
        if w in after[h]:
            return cut(dp, after[h][w]) / first[h] * (first[h] / (first[h] + 1) if tight else 1)
        rest = 1 / (first[h] + 1) if tight else 1 - taken
        return rest / (1 - sum(word(x) for x in after[h])) * word(w)

    out = []
    for held, w in docs:
        tokens = [*w, "\0end"]
        base = sum(math.log10((count[t] + 1) / (n + v + 1)) for t in tokens)
        score = sum(math.log10(chance(t, h)) for t, h in zip(tokens, ["\0start", *w]))
        out.append((held, len(tokens), sum(count[t] > 0 for t in tokens), n, base, score))
    return out, chance, count
