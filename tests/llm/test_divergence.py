import re
from collections import Counter, defaultdict

from sheafwork.llm import divergence
from tests.llm import data

SCHEMA = "doc_id long, text string, lang string, source string, n long, total long, slice int, tile string, term string"


def brute_force(rows):
    langs, sources, docs = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")
        found = [re.sub("[A-Z]", lambda x: chr(ord(x[0]) + 32), term) for term in found]
        docs[lang].update(set(found)), sources[lang, source].update(found), langs[lang].update(found)
    kept = {lang: [t for t, n in docs[lang].items() if n >= 30] for lang in langs}

    def chances(counts, terms):
        whole = sum(counts[t] for t in terms) + 5 * len(terms)
        return {t: 1 + 10**9 * (counts[t] + 5) // whole for t in terms}

    own = {key: chances(counts, kept[key[0]]) for key, counts in sources.items()}
    out = []
    for (lang, source), p in own.items():
        q = chances(langs[lang], kept[lang])
        pair = [
            (-sum(abs(p[t] - other[t]) for t in kept[lang]), name.encode())
            for (where, name), other in own.items()
            if where == lang and name != source
        ]
        term = [(q[t] - p[t], t.encode()) for t in kept[lang] if sources[lang, source][t] and p[t] > q[t]]
        for part, found in (("pair", sorted(pair)), ("term", sorted(term)[:50])):
            out += [(lang, source, part, item.decode(), -value, i) for i, (value, item) in enumerate(found, 1)]
    return sorted(out)


def result(frame):
    return sorted(map(tuple, divergence.audit(frame).select("lang", "source", "part", "item", "value", "rank").collect()))


def frame(spark, rows):
    return spark.createDataFrame([(i, *row, 1, 1, 1, "t", "x") for i, row in enumerate(rows)], SCHEMA)


def hostile():
    rows = [(data.prose(i, 60 + i), "en", f"s{i % 5}") for i in range(90)]
    rows += [(data.prose(3, 63), "en", f"s{i % 4}") for i in range(120)]  # copies in several sources
    rows += [("Über ÜBER straße naïve I'm x1y2 漢字 漢字。 \U0001f600", None, f"t{i % 3}") for i in range(31)]
    rows += [("seldom", "de", "s1"), ("words", "de", "s2"), (None, "de", None), ("", "de", "Ä"), ("1 2 3", "fr", "s")]
    rows += [("tie one two three " * 40, "es", "é"), ("three two one tie", "es", "z")] * 20
    return rows + [("word " * 20_000 + data.prose(9, 500), "en", "s1")]


def test_hostile_rows(spark):
    assert result(frame(spark, hostile())) == brute_force(hostile())


def test_slices_and_tiles(spark, monkeypatch):
    """More slices, tiles and partial counts than one."""
    monkeypatch.setattr(divergence, "_SLICE_TERMS", 10)
    monkeypatch.setattr(divergence, "_TILE_SOURCES", 2)
    assert result(frame(spark, hostile())) == brute_force(hostile())


def test_no_rows(spark):
    assert result(frame(spark, [])) == []


def test_large_numbers():
    import numpy as np

    counts = np.array([0, 1, 10**12, 9 * 10**14], np.int64)
    size = np.int64(10**15 + 7)
    expected = [1 + 10**9 * (int(c) + 5) // int(size) for c in counts]
    assert divergence._probabilities(counts, size).tolist() == expected


def test_texts_are_cut_once(spark):
    rows = [("one two", "en", f"s{i % 3}") for i in range(30)] + [("one two", "de", "s")]
    found = divergence.collapsed(frame(spark, rows)).collect()
    assert sorted((r.lang, sorted(map(tuple, r.sources))) for r in found) == [
        ("de", [("s", 1)]),
        ("en", [("s0", 10), ("s1", 10), ("s2", 10)]),
    ]
