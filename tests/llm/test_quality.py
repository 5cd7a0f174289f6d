import math
import random
from collections import Counter

from sheafwork.llm import quality
from tests.llm import data

TOP = quality.ORDER


def model(texts):
    """Interpolated modified Kneser-Ney with dictionaries, for tuples of symbols."""
    counts = {k: Counter() for k in range(1, TOP + 1)}
    for text in texts:
        codes = [1] * (TOP - 1) + quality.symbols(text).tolist()
        counts[TOP].update(tuple(codes[i : i + TOP]) for i in range(len(codes) - TOP + 1))
    for k in range(TOP - 1, 0, -1):
        counts[k].update(gram[1:] for gram in counts[k + 1])
    cuts = {k: quality.discounts(*([*counts[k].values()].count(t) for t in range(1, 5))) for k in counts}
    contexts = {k: {} for k in counts}
    for k, grams in counts.items():
        for gram, n in grams.items():
            own = contexts[k].setdefault(gram[:-1], [0, 0.0])
            own[0] += n
            own[1] += cuts[k][min(n, 3) - 1]

    def probability(gram):
        value = 1 / quality.SYMBOLS
        for k in range(1, TOP + 1):
            own = gram[TOP - k :]
            if own[:-1] in contexts[k]:
                total, left = contexts[k][own[:-1]]
                n = counts[k][own]
                value = (n - (cuts[k][min(n, 3) - 1] if n else 0) + left * value) / total
        return value

    return probability


def log_sum(probability, text):
    codes = [1] * (TOP - 1) + quality.symbols(text).tolist()
    return sum(math.log(probability(tuple(codes[i : i + TOP]))) for i in range(len(codes) - TOP + 1))


def labels(spark, rows):
    return spark.createDataFrame([(*row, "x", 1) for row in rows], "doc_id long, quality int, toxic int, text string, block int")


def test_scores_against_dictionaries(spark):
    rows = [(i, t) for i, t in data.texts() if len(t or "") < 10_000] + [(50 + k, data.prose(k, 50)) for k in range(30)]
    marks = [(i, 1, 0) for i in range(1, 80, 2)] + [(2, 1, None), (3, 0, 0), (5, 1, 1), (7, None, 0), (None, 1, 0), (999, 1, 0)]
    found = quality.scores(data.documents(spark, rows), labels(spark, marks)).collect()
    trusted = {row.doc_id: row.trusted for row in found}
    assert trusted[3] == trusted[7] == trusted[5] == trusted[None] == 0 < trusted[1]
    assert {trusted[k] for k in range(51, 80, 2)} == {1, 2}
    probability = model([t or "" for i, t in rows if trusted[i] == 2])
    expected = sorted((str(i), len(t or ""), round(log_sum(probability, t or ""), 2)) for i, t in rows)
    assert len(found) == len(rows)
    for row, (i, chars, total) in zip(sorted(found, key=lambda r: (str(r.doc_id), r.chars, r.log_sum)), expected):
        assert (str(row.doc_id), row.chars) == (i, chars)
        assert abs(row.log_sum - total) < 0.02 + abs(total) * 1e-4


def test_probabilities_add_up():
    probability = model(["abab cab", "bab"])
    start = tuple(quality.symbols("abab").tolist())
    seen = [start + (ord(c),) for c in "ab c"]
    rest = probability(start + (4000,)) * (quality.SYMBOLS - 4)
    assert abs(sum(map(probability, seen)) + rest - 1) < 1e-9


def test_given_labels(spark):
    docs = spark.read.parquet(f"{data.SF_DIR}/documents.parquet")
    marks = spark.read.parquet(f"{data.SF_DIR}/labels.parquet")
    found = {row.doc_id: row.accepted for row in quality.classify(docs, marks).collect()}
    assert len(found) == docs.count()
    good = [found[r.doc_id] for r in marks.collect() if r.quality == 1 and not r.toxic]
    bad = [found[r.doc_id] for r in marks.collect() if r.quality == 0]
    assert sum(good) / len(good) > 0.97 and sum(bad) / len(bad) < 0.5


def test_blocks_do_not_matter(spark, monkeypatch):
    docs, marks = data.documents(spark), labels(spark, [(1, 1, 0), (8, 1, 0), (11, 1, 0)])
    one = sorted(map(str, quality.classify(docs, marks).collect()))
    monkeypatch.setattr(quality, "BLOCK_CHARS", 3_000)
    monkeypatch.setattr(quality, "_SLICE_CHARS", 100)
    assert sorted(map(str, quality.classify(docs, marks).collect())) == one


def test_rows_are_told_apart(spark):
    """Numbers are carried along, and rows of one id keep their own."""
    rows = [(7, "a b c"), (7, "x y"), (None, "none"), (None, None), (7, "a b c")]
    frame = spark.createDataFrame([(i, t, None, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, own long")
    found = quality.classify(frame, labels(spark, [(7, 1, 0)]), "own").collect()
    assert sorted((r.own, r.doc_id, r.chars) for r in found if r.doc_id) == [(0, 7, 5), (1, 7, 3), (4, 7, 5)]
    assert sorted((r.own, r.chars) for r in found if not r.doc_id) == [(2, 4), (3, 0)]


def test_nothing_known(spark):
    none = labels(spark, [])
    assert quality.classify(data.documents(spark, []), none).collect() == []
    found = quality.classify(data.documents(spark), none).collect()
    assert [row.accepted for row in found] == [row.chars > 0 for row in found]


def test_characters_of_one_script_are_told_apart(spark):
    """Shuffled characters of a script are much less likely than its text."""
    rng = random.Random(5)
    word = ["\u0915\u092e\u0932", "\u0928\u0926\u0940", "\u4e2d\u6587\u5b57", "\uac00\ub098\ub2e4", "\U00020000\U00020001"]
    rows = [(k, " ".join(rng.choice(word) for _ in range(60))) for k in range(60)]
    rows += [(100 + k, "".join(rng.sample(t, len(t)))) for k, t in rows[:20]]
    found = quality.scores(data.documents(spark, rows), labels(spark, [(k, 1, 0) for k in range(60)])).collect()
    costs = {r.doc_id: -r.log_sum / r.chars for r in found}
    assert min(costs[100 + k] for k in range(20)) > 2 * max(costs[k] for k in range(60))
    assert len(set(quality.symbols("".join(word)).tolist())) == len(set("".join(word)))
