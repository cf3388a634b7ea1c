"""Documents with every awkward case, and brute-force helpers."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, version string, `row` long, key string, bucket int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def prose(seed, n, vocabulary=None):
    rng = random.Random(seed)
    vocabulary = vocabulary or [a + b for a in "the an re on st".split() for b in "er in ou ea ti ed".split()]
    out, line = [], []
    for _ in range(n):
        line.append(rng.choice(vocabulary))
        if rng.random() < 0.12:
            out.append(" ".join(line).capitalize() + rng.choice([". ", ".\n", "! "]))
            line = []
    return "".join(out) + " ".join(line)


GERMAN = [a + b for a in "sch ein und ver über".split() for b in "ung en lich äß te".split()]


def documents():
    """Plain documents, then nulls, empty and very long texts, repeated rows, and odd characters."""
    base = prose(1, 120)
    near = base.split(" ")
    near[60] = "changed"
    rows = [
        (1, base, "en", "a", 1),
        (2, base, "en", "a", 1),
        (3, " ".join(near), "en", "a", 1),
        (4, prose(2, 300), "en", "b", 2),
        (5, prose(3, 90, GERMAN), "de", "b", 3),
        (6, prose(4, 60) + " " + prose(5, 60, GERMAN), "en", "c", None),
        (7, None, "en", "a", None),
        (8, "", None, None, 0),
        (9, " \n\t ", "de", "c", 4),
        (10, "one", None, "a", 3),
        (11, "one two three four", "en", "a", 3),
        (12, "One two three four", "en", "a", 3),
        (13, "x" * 3000 + " " + "😀é" * 40, "en", "c", 9),
        (14, prose(6, 12_000), "en", "a", 9),
        (15, "\x00   ß İ — … ١٢", None, "c", 1),
        (16, prose(7, 40) * 3, "de", "c", 1),
        (16, prose(8, 80), "de", "c", 1),
        (17, prose(9, 50), "en", "b", 1),
        (17, prose(9, 50), "en", "b", 1),
        (None, prose(10, 70), "en", "b", 1),
        (None, None, None, None, None),
        (18, "!!! ??? 123 456", "en", "b", 1),
    ]
    return [(*row, 0.5, "v", 7, "k", 3) for row in rows]


def frame(spark, rows=None, parts=3):
    return spark.createDataFrame(documents() if rows is None else rows, SCHEMA).repartition(parts)


def plain(spark, rows, schema="doc_id long, text string, lang string, source string"):
    return spark.createDataFrame(rows, schema)
