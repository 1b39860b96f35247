"""Text expressions against plain Python on random and odd strings."""

import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from speechlake.functions import text as X

EDGES = [
    None, "", " ", "...", " ... ", "....", "\x1c...\x1f", "...\n", "NA", " null\x1f", "NaN", "<na>", "N/A", "none", "nan.",
    "ng'ombe", "ng’ombe", "ĩ", "ĩ", "ж", "नमस्ते", "ʼ", "²",
    "ª", "a\x1cb", 'say "hi"\nthere', " x　y z", "µ", "ﬁ", "\U0001f600", "가", "a-b", "‑",
]


def strings(count=3000, seed=1):
    rng = random.Random(seed)
    pool = [chr(c) for c in [*range(32, 127), *range(0xA0, 0x250), *range(0x300, 0x330), *range(0x1E00, 0x1EFF)]]
    pool += [c for t in EDGES if t for c in t] * 5
    return EDGES + ["".join(rng.choice(pool) for _ in range(rng.randint(0, 25))) for _ in range(count)]


def verdicts():
    """Per code point, from its category and name: "keep", "drop" or "foreign" (a letter of another script)."""
    table = {}
    for point in range(0x110000):
        char = chr(point)
        kind, name = unicodedata.category(char), unicodedata.name(char, "")
        letter = kind[0] == "L"
        digit = kind == "Nd" or (kind == "No" and unicodedata.digit(char, None) is not None)
        if digit or char.isspace() or char in "'-" or (letter and name[:5] == "LATIN"):
            table[point] = "keep"
        else:
            table[point] = "foreign" if letter else "drop"
    return table


VERDICTS = verdicts()
DROPPED = {point: None for point, verdict in VERDICTS.items() if verdict != "keep"}
# Written by hand: text and what cleaning makes of it.
PAIRS = [
    (None, "..."), ("", "..."), (" ... ", "..."), ("....", "..."), ("ng'ombe", "ng'ombe"), ("ng\u2019ombe", "ngombe"), ("i\u0303", "\u0129"),
    ("\u0436", "..."), ("\u02bc", "..."), ("a\x1cb", "a b"), ('say "hi"\nthere', "say hi there"), ("a-b", "a-b"), ("\u2011", "..."), ("\u00aa", "..."), ("NA", "NA"),
]


def composed(t):
    return unicodedata.normalize("NFC", t or "")


def cleaned(t):
    words = composed(t).translate(DROPPED).split()
    return "..." if not words or (t or "").strip() == "..." else " ".join(words)


def foreign(t):
    return "foreign" in map(VERDICTS.get, map(ord, composed(t)))


def scrubbed(t):
    if t is None or t.strip().lower() in {"", "nan", "null", "none", "na", "n/a", "<na>"}:
        return "..."
    return t


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.createDataFrame([(t,) for t in strings()], "t string")
    return df.select(
        "t",
        X.nfc("t").alias("nfc"),
        X.keep_latin("t").alias("kept"),
        X.squash_spaces("t").alias("squashed"),
        X.strip("t").alias("stripped"),
        X.is_blank("t").alias("blank"),
        X.normalize_text("t").alias("cleaned"),
        X.has_foreign("t").alias("foreign"),
        X.scrub("t").alias("scrubbed"),
    ).collect()


def test_functions_equal_plain_python(rows):
    for r in rows:
        assert r.cleaned == cleaned(r.t), repr(r.t)
        assert r.foreign == foreign(r.t), repr(r.t)
        assert r.scrubbed == scrubbed(r.t), repr(r.t)
        if r.t is None:
            assert r.nfc is r.kept is r.squashed is r.blank is None
            continue
        assert r.nfc == unicodedata.normalize("NFC", r.t), repr(r.t)
        assert r.kept == r.t.translate(DROPPED), repr(r.t)
        assert r.squashed == re.sub(r"\s+", " ", r.t).strip(), repr(r.t)
        assert r.stripped == r.t.strip(), repr(r.t)
        assert r.blank == (r.t.strip() == ""), repr(r.t)


def test_written_pairs(spark):
    df = spark.createDataFrame(PAIRS, "t string, want string").select("t", "want", X.normalize_text("t").alias("got"))
    assert [(r.t, r.got) for r in df.collect()] == [(t, want) for t, want in PAIRS]


def test_every_character(spark):
    """The keep rule and the foreign rule over all code points."""
    points = spark.range(1, 0x110000).filter("id < 55296 or id > 57343")
    char = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32")
    got = points.select("id", X.keep_latin(char).alias("k"), X.has_foreign(char).alias("f")).toArrow().to_pylist()
    wrong = [r for r in got if (r["k"] != "") != (VERDICTS[r["id"]] == "keep") or r["f"] != foreign(chr(r["id"]))]
    assert wrong == []


def test_paths(spark):
    df = spark.createDataFrame(
        [("/a/manifest_7.jsonl",), ("/a/manifest_10.x.json",), ("lake/language=swa/part-0",), ("plain",)], "p string"
    )
    got = df.select(X.shard_index("p").alias("s"), X.basename("p").alias("b"), X.path_value("p", "language").alias("v")).collect()
    assert [r.s for r in got] == ["7", "10", "", ""]
    assert [r.b for r in got] == ["manifest_7.jsonl", "manifest_10.x.json", "part-0", "plain"]
    assert got[2].v == "swa"
