import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from sheafwork.llm import packing, simple8b, tokens
from tests.llm import data

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("top", [1, 2, 9, 300, 50_000, 2**20, 2**45, 2**60, 2**64])
@pytest.mark.parametrize("number", [0, 1, 5, 1023, 1024, 1025, 5000])
def test_simple8b_round_trip(top, number):
    rng = np.random.default_rng(number)
    values = rng.integers(0, top - 1, number, np.uint64, endpoint=True)
    values[rng.random(number) < 0.3] = 0
    words, offsets = simple8b.encode(values)
    assert (simple8b.decode(words, offsets, number) == values).all()
    if 0 < top <= 2**15 and number:
        assert len(words) <= number / 4 + len(offsets)


def expected(rows):
    coder = Tokenizer.from_file(PATH)
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda row: (row[0] is not None, row[0] or 0)):
        ids = coder.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_files_read_back(spark, tmp_path):
    folder = str(tmp_path / "ids")
    tokens.write_ids(data.documents(spark), PATH, folder)
    found = [tuple(row) for row in tokens.file_digests(spark, folder).collect()]
    assert sorted(found, key=lambda row: row[1]) == expected(data.texts())


def test_words_and_punctuation():
    """Letters, marks and signs in any order have the ids of the whole text."""
    rng, whole = random.Random(6), Tokenizer.from_file(PATH)
    parts = list("aeéüßøŁİıſ×÷ĳ1९٣漢가\u0301\u0308\u200b\u00a0 \n\t.,;:!?'\"()[]<|>#%&*_-–…“”«»\x1c")
    parts += ["le", "word", "don't", "it's", "'s", "'S", "...", "?!", "<|endoftext|>", "e.g.", "l'été.", "ﬁ", "Ω!"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(1, 60))) for _ in range(4_000)]
    texts += [" ".join(rng.choices(parts, k=rng.randrange(1, 60))) for _ in range(1_000)] + ["", " ", "."]
    coder = tokens.WordEncoder(PATH)
    found = coder.encode([text.encode() for text in texts])
    for text, ids in zip(texts, found):
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_words_leave_the_cache(monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_WORDS", 3)
    coder, whole = tokens.WordEncoder(PATH), Tokenizer.from_file(PATH)
    for text in ["a bc def", "bc ghij a a", "", "klm a no bc", "def def"]:
        ids = np.frombuffer(coder.encode([text.encode()])[0], "<u4").tolist()
        assert ids == whole.encode(text, add_special_tokens=False).ids


def test_no_rows(spark, tmp_path):
    assert packing.pack(data.documents(spark, []), PATH).collect() == []
    tokens.write_ids(data.documents(spark, []), PATH, str(tmp_path / "ids"))
    assert tokens.file_digests(spark, str(tmp_path / "ids")).collect() == []


def test_packing(spark):
    length = 64
    pieces = packing.pack(data.documents(spark), PATH, length).cache()
    rows = sorted(pieces.collect(), key=lambda row: (row.sequence_id, row.offset))
    coder = Tokenizer.from_file(PATH)
    place = 0
    by_doc = {}
    for row in rows:
        assert (row.sequence_id, row.offset) == divmod(place, length)
        assert row.length == len(row.ids) // 4 and row.offset + row.length <= length
        assert row.ids_crc32 == zlib.crc32(row.ids)
        place += row.length
        by_doc.setdefault(row.doc_id, []).append(row)
    texts = {}
    for doc_id, text in data.texts():
        texts.setdefault(doc_id, []).append(text or "")
    assert by_doc.keys() == texts.keys()
    for doc_id, own in by_doc.items():
        ids = coder.encode(texts[doc_id][0], add_special_tokens=False).ids + [2]
        joined = np.frombuffer(b"".join(row.ids for row in own), "<u4").tolist()
        assert joined == ids * len(texts[doc_id])
        assert all(row.doc_tokens == len(ids) for row in own)
    laid = {row.sequence_id: row for row in packing.sequences(pieces, length).collect()}
    assert all(len(row.ids) == length for row in laid.values() if row.length & (row.length - 1))
    assert sum(row.length for row in laid.values()) == place
    pieces.unpersist()


def test_words_are_encoded_as_in_the_text():
    coder, whole = tokens.WordEncoder(PATH), Tokenizer.from_file(PATH)
    texts = [
        "The THE the, the. the; The.. a., ,. . it's It'S, 'tis don't. x'",
        "Ünïcode STRASSE straße ẞ İI iİ ŉ ſ ǰ J̌ ̧c Ç, क़, 漢字. \U0001f600.",
        "<|endoftext|> <|ENDOFTEXT|> a<|startoftext|>b <|x",
        "12, 3.4 5. ١٢. abc1. 1abc, é. É, \x1f a\x1cb\x85c d e.",
    ]
    for text in texts:
        ids = np.frombuffer(coder.encode([text.encode()])[0], "<u4").tolist()
        assert ids == whole.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("first", [0, 3])
def test_what_is_behind_a_stem_is_cut_out_of_the_words(first):
    words = ["", "...", "a", "é,", "ab!?", "日本.", "x" * 300 + ")", "<|a|>"]
    stems = ["", "", "a", "é", "ab", "日本", "x" * 300, "<|a|>"]
    cut = tokens._behind(pa.array(words).slice(first), pa.array(stems).slice(first))
    cut.validate(full=True)
    assert cut.to_pylist() == [word[len(stem) :].encode() for word, stem in zip(words[first:], stems[first:])]
    assert tokens._behind(pa.array([], pa.string()), pa.array([], pa.string())).to_pylist() == []
