"""Small hostile tables for the operators."""

import os
import random

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def prose(seed, count):
    rng = random.Random(seed)
    return " ".join(rng.choice("ab cde fgh ij klm no pqr stu vw xyz é ß".split()) + str(rng.randrange(40)) for _ in range(count))


def texts():
    base = prose(1, 120)
    close = base.replace(base.split()[60], "changed", 1)
    passage = prose(2, 70)
    return [
        (1, base),
        (2, base),
        (3, close),
        (4, None),
        (5, ""),
        (6, "one two three"),
        (7, "One\ttwo  THREE"),
        (8, prose(3, 80) + "\n" + passage),
        (9, passage + " " + prose(4, 90)),
        (10, "    "),
        (10, "    "),
        (11, prose(5, 30_000)),
        (12, "word " * 3_000),
        (None, "no id at all"),
        (13, "İstanbul ſ Σίσυφος ΟΔΟΣ 漢字 \U0001f600 á b\x1cc\x85d"),
        (14, base.upper()),
        (15, passage),
    ]


def documents(spark, rows=None):
    """Rows with further columns whose names the operators use inside."""
    rows = texts() if rows is None else rows
    clash = [(i, t, "en", "src", len(t or ""), i, "x", 0, None) for i, t in rows]
    return spark.createDataFrame(
        clash,
        "doc_id long, text string, lang string, source string, n_chars long, "
        "block long, key string, part int, component long",
    )
