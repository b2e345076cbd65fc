"""Small hostile tables shared by the tests."""

import random

DOC_SCHEMA = ("doc_id bigint, text string, source string, rid string, id string, t string, n string, size string, "
              "name string, shard string, taken string, score string, kept string, spans string")


def docs_frame(spark, rows):
    """(doc_id, text, source) rows, with extra columns whose names the operators use."""
    return spark.createDataFrame([(*r, *["x"] * 11) for r in rows], DOC_SCHEMA)


def hostile(seed=3):
    """Null, empty, blank and very long texts, ties, repeated rows, a hot text."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdé") for _ in range(rnd.randint(1, 4)))
    text = lambda n: " ".join(word() for _ in range(n))
    rows = [(1, None, "a"), (2, "", "a"), (3, " \t\n\r\x0b\x0c ", None), (4, "A b", "b"), (5, "aB", "b"), (6, "A  b ", "c"),
            (7, "A b", None), (8, text(20000), "a"), (9, "x" * 30000, "b"), (10, text(60), "c"), (10, text(61), "c")]
    rows += [(11, "same row", "a")] * 3
    rows += [(None, "no id", "a"), (None, None, None), (12, "nbsp stays here", "d")]
    hot = text(40)
    rows += [(100 + k, hot, "a") for k in range(40)]
    rows += [(200 + k, text(rnd.randint(1, 80)), rnd.choice("abc")) for k in range(60)]
    return rows


def strip_blank(s):
    return "".join(c for c in s if c not in " \t\n\x0b\x0c\r")


def split_words(s):
    return (s or "").encode().lower().split()
