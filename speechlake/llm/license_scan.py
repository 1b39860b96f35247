"""Licence scans with a positional rare-token index.

Every template is a row of words. The index holds, per licence word, the templates it occurs in and its places there.
In each file the places of licence words are noted; from a template's words with the highest IDF (over all files) the
template is laid on the file at ``place - place in the template``, and the postings of its other words are intersected
by relative position. A template is found where its mandatory key phrase stands in full and enough of it agrees.
"""

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@dataclass(frozen=True)
class Template:
    """``words`` of a licence text; ``must`` is the part of it that has to stand there in full (all of it if empty)."""

    label: str
    words: str
    must: str = ""


# The phrases that are counted as base places.
BASE = (
    Template("mit", "under the mit license"),
    Template("apache-2", "apache license version 2"),
    Template("cc-by-nc", "cc by nc"),
)
# Further templates, short forms and first sentences of public licences.
FURTHER = (
    Template("mit", "the mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "free of charge to any person"),
    Template("apache-2", "licensed under the apache license version 2 0", "apache license version 2"),
    Template("gpl-3", "gnu general public license version 3", "general public license version 3"),
    Template("gpl-2", "gnu general public license version 2", "general public license version 2"),
    Template("lgpl", "gnu lesser general public license", "lesser general public license"),
    Template("agpl", "gnu affero general public license", "affero general public license"),
    Template("mpl-2", "subject to the terms of the mozilla public license v 2 0", "mozilla public license v 2"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "source and binary forms"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee", "distribute this software for any purpose"),
    Template("cc-by-nc", "creative commons attribution noncommercial", "attribution noncommercial"),
    Template("cc-by-sa", "creative commons attribution sharealike", "attribution sharealike"),
    Template("cc-by", "licensed under a creative commons attribution license", "creative commons attribution license"),
    Template("cc0", "cc0 public domain dedication", "public domain dedication"),
    Template("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
)


def words_of(text: str | bytes | None) -> list[bytes]:
    """Words of a text: A-Z lower-cased, cut at every ASCII character that is no letter or digit."""
    raw = text.encode() if isinstance(text, str) else text or b""
    return WORD.findall(raw.lower())  # bytes.lower changes A-Z only


class Index:
    """Templates as positional postings, with the anchors from which each is laid on a file."""

    def __init__(self, base, further, idf: dict[bytes, float], anchors: int, least: float):
        self.least, self.idf = least, idf
        self.templates = [(t, t.words.encode().split(), k < len(base)) for k, t in enumerate([*base, *further])]
        self.vocabulary = {w for _, words, _ in self.templates for w in words}
        self.must = []
        self.postings: dict[bytes, list[tuple[int, int]]] = {}
        for k, (template, words, exact) in enumerate(self.templates):
            phrase = (template.must or template.words).encode().split()
            start = next(i for i in range(len(words)) if words[i : i + len(phrase)] == phrase)
            self.must.append(range(start, start + len(phrase)))
            # Anchors come from the key phrase: it has to stand there, so each of its words proposes every place.
            rarest = sorted(self.must[k], key=lambda i: (-idf.get(words[i], 0.0), i))
            for i in rarest[: 1 if exact else anchors]:
                self.postings.setdefault(words[i], []).append((k, i))

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int, float]], list[tuple[int, int]]]:
        """(template, start, share of its IDF that agrees) of all found places, and (start, template) of base places."""
        vocabulary = self.vocabulary
        at = {i: w for i, w in enumerate(words) if w in vocabulary}
        found, base, seen = [], [], set()
        for place, word in at.items():
            for k, i in self.postings.get(word, ()):
                start = place - i
                if (k, start) in seen:
                    continue
                seen.add((k, start))
                _, own, exact = self.templates[k]
                if any(at.get(start + j) != own[j] for j in self.must[k]):
                    continue
                agree = sum(self.idf.get(w, 0.0) for j, w in enumerate(own) if at.get(start + j) == w)
                whole = sum(self.idf.get(w, 0.0) for w in own)
                share = agree / whole if whole else 1.0
                if exact:
                    base.append((start, k))
                if exact or share >= self.least:
                    found.append((k, start, min(share, 1.0)))
        return found, base


def _seen_words(vocabulary: set[bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, files = dict.fromkeys(vocabulary, 0), 0
        for batch in batches:
            for value in batch.column(0):
                files += 1
                for word in vocabulary.intersection(words_of(value.as_py())):
                    counts[word] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([None, *[w.decode() for w in counts]], pa.string()), pa.array([files, *counts.values()], pa.int64())], names=["word", "files"]
        )

    return run


def word_idf(docs: DataFrame, text: str, vocabulary: set[bytes]) -> dict[bytes, float]:
    """IDF over all files of the template words: log((1 + files) / (1 + files with the word)) + 1.

    The result has one number per template word, so it is bounded by the templates.
    """
    rows = docs.select(text).mapInArrow(_seen_words(vocabulary), "word string, files bigint").groupBy("word").agg(F.sum("files").alias("n")).collect()
    counts = {row.word: row.n for row in rows}
    files = counts.pop(None, 0)
    return {w: math.log((1 + files) / (1 + counts.get(w.decode(), 0))) + 1 for w in vocabulary}


RESULT = (
    "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double, "
    "places array<struct<label:string,word:bigint,share:double>>"
)


def scan_licenses(
    docs: DataFrame, key: str = "doc_id", text: str = "text", base=BASE, further=FURTHER, anchors: int = 3, least: float = 0.75
) -> DataFrame:
    """One row per row of ``docs``: the licence places of its whole text.

    ``n_base``, ``first_word``, ``last_word`` and ``base_labels`` describe the exact places of ``base``; ``labels`` also
    has those of ``further`` whose key phrase stands in full and of which at least ``least`` of the IDF agrees at one
    start (``anchors`` words of the key phrase propose starts). ``score`` is the best agreement found, 1 for a base
    place, 0 without any; ``places`` lists all found. A null or empty text has no words and no labels; repeated rows
    are all returned; an empty table gives no rows; further columns are not read.
    """
    vocabulary = {w for t in [*base, *further] for w in t.words.encode().split()}
    index = Index(base, further, word_idf(docs, text, vocabulary), anchors, least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column(1):
                words = words_of(value.as_py())
                found, places = index.scan(words)
                starts = [start for start, _ in places]
                own = sorted({index.templates[k][0].label for _, k in places})
                labels = sorted({index.templates[k][0].label for k, _, _ in found})
                rows.append((
                    len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(own), ",".join(labels),
                    max((share for _, _, share in found), default=0.0),
                    [{"label": index.templates[k][0].label, "word": start, "share": share} for k, start, share in sorted(found, key=lambda f: (f[1], f[0]))],
                ))
            columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), _KINDS)] if rows else [pa.array([], kind) for kind in _KINDS]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["key", *_NAMES])

    selected = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = selected.schema["key"].dataType.simpleString()
    return selected.mapInArrow(run, f"key {kind}, {RESULT}").withColumnRenamed("key", key)


_NAMES = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "places"]
_KINDS = [
    pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(),
    pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64()), ("share", pa.float64())])),
]
