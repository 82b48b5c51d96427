"""Rows that operators must not stumble over, and plain versions of what they compute."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def prose(seed, n, vocabulary=400):
    """n words of invented prose."""
    out, x = [], seed * 7919 + 17
    for _ in range(n):
        x = (x * 1103515245 + 12345) % 2**31
        out.append("w" + "abcdefghij"[x // 7 % 10] * (x // 70 % 3 + 1) + str(x // 3 % vocabulary))
    return " ".join(out)


ROWS = [
    (1, prose(1, 120)),
    (2, prose(1, 60) + "\n" + prose(2, 50)),
    (3, prose(1, 120)),
    (4, None),
    (5, ""),
    (6, " \t\n "),
    (7, "one two"),
    (8, "one  two"),
    (9, prose(3, 3000)),
    (10, "x " * 500),
    (11, "é ß   naïve 漢字 \U0001f600"),
    (12, prose(1, 118) + " tail end"),
    (12, prose(1, 118) + " tail end"),
    (None, prose(4, 80)),
    (None, None),
    (13, prose(4, 80)),
    (14, prose(5, 30) + " " + prose(1, 25)),
    (15, "A" * 5000 + " " + prose(6, 30)),
    (16, prose(5, 30)),
]


def words(text):
    return WORD.findall(text or "")


def frame(spark, rows=None, parts=3):
    """The rows with further columns, among them names that operators use themselves."""
    rows = ROWS if rows is None else rows
    table = [(i, t, "en" if i is None or i % 2 else None, "s", None if t is None else len(t), i, "x", 0.5, t, [1]) for i, t in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long, doc long, tag string, score double, row string, ids array<int>"
    return spark.createDataFrame(table, schema).repartition(parts)


def empty(spark):
    return frame(spark, [], 1)
