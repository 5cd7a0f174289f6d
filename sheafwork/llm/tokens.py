"""Token ids in Simple-8b files, in ascending order of documents."""

from __future__ import annotations

import os
import string
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sheafwork.llm import simple8b
from sheafwork.llm.hashing import raw
from sheafwork.session import shared_folder

END = 2
#: Bytes of the texts that are encoded together, and words that each of two generations keeps.
#: ``lean`` asks for half of each, for workers whose memory other stages need too.
SLICE_BYTES = 8 << 20
KEPT_WORDS = 400_000
_TOGETHER = 256
# Ends with a digit or a Latin letter that turns into one letter.
_LETTER = r"[0-9A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}]$"
_GROUP_IDS = 1 << 19

#: A row is a run of documents: where it stands in its part, and its ids as words.
FILE_SCHEMA = (
    "part int, first long, doc_ids array<long>, doc_tokens array<long>, "
    "words binary, offsets binary"
)


class WordEncoder:
    """Ids of texts, encoded word by word.

    It is for tokenizers that ignore case and drop white space without joining across
    it: a text then has the ids of its words one after the other, and words repeat. Two
    generations of words are kept, so the memory is bounded and frequent words stay.
    """

    def __init__(self, path: str, lean: bool = False) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.kept = KEPT_WORDS // 2 if lean else KEPT_WORDS
        self.tokenizer = Tokenizer.from_file(path)
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        #: Whether an id ends a word, where the vocabulary tells.
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[k for token, k in vocabulary.items() if token.endswith("</w>")]] = True

    def _one(self, word: str) -> bytes:
        return self._ids(word).tobytes()

    def _ids(self, text: str) -> np.ndarray:
        # This call leaves out the offsets, which are a quarter of the other's time.
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _together(self, some: list[str]) -> list[bytes]:
        """Ids of words of Latin letters, each of which ends where an ending id stands."""
        ids = self._ids(" ".join(some))
        cuts = 4 * (np.flatnonzero(self.ends[ids]) + 1)
        if len(cuts) != len(some):
            return [self._one(word) for word in some]
        whole = ids.tobytes()
        return [whole[a:b] for a, b in zip([0, *cuts.tolist()], cuts.tolist())]

    def _learn(self, words: set[bytes]) -> None:
        """Encode words that are in neither generation."""
        plain = []
        for word in words:
            text = word.decode()
            # Up to here no letter is taken apart or turns into more than letters.
            if text.isalpha() and max(text) < "\u0250" and "\u0130" not in text:
                plain.append(text)
            else:
                self.young[word] = self._one(text)
        for at in range(0, len(plain), _TOGETHER):
            some = plain[at : at + _TOGETHER]
            self.young.update(zip(map(str.encode, some), self._together(some)))

    def _known(self, words: list[bytes]) -> list[bytes]:
        """The ids of distinct words."""
        coded = list(map(self.young.get, words))
        fresh = [word for word, ids in zip(words, coded) if ids is None]
        if not fresh:
            return coded
        if len(self.young) + len(fresh) > self.kept and self.young:
            self.old, self.young, fresh = self.young, {}, words
        known = [(word, self.old[word]) for word in fresh if word in self.old]
        self.young.update(known)
        self._learn(set(fresh).difference(word for word, _ in known))
        return list(map(self.young.__getitem__, words))

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text.

        Words are split and numbered for all texts at once, so only distinct ones are looked up,
        and punctuation behind a letter or digit by itself, as the tokenizer takes it.
        """
        split = pc.ascii_split_whitespace(pa.array(list(map(_folded, texts)), pa.string()))
        words = split.flatten().dictionary_encode()
        whole = words.dictionary
        stems = pc.utf8_rtrim(whole, string.punctuation)
        apart = pc.and_(pc.match_substring_regex(stems, _LETTER), pc.invert(pc.match_substring(whole, "<|")))
        stems = pc.if_else(apart, stems, whole)
        parts = pa.concat_arrays([stems.cast(pa.binary()), _behind(whole, stems)]).dictionary_encode()
        coded = self._known(parts.dictionary.to_pylist())
        sizes = np.fromiter(map(len, coded), np.int32, len(coded)) // 4
        ids = np.frombuffer(b"".join(coded), "<u4")
        # A slice has under 2**31 ids, and the arrays are as long as they are many.
        starts = np.cumsum(sizes, dtype=np.int32) - sizes
        both = parts.indices.to_numpy().reshape(2, -1).T
        number = both[words.indices.to_numpy()].ravel()
        counts = sizes[number]
        ends = np.zeros(len(counts) + 1, np.int32)
        np.cumsum(counts, out=ends[1:])
        edges = ends[2 * (split.offsets.to_numpy() - split.offsets[0].as_py())]
        # The ids of each part from its first one on.
        place = np.repeat(starts[number] - ends[:-1], counts)
        place += np.arange(len(place), dtype=np.int32)
        found = ids[place]
        return [found[a:b].tobytes() for a, b in zip(edges, edges[1:])]


def _behind(whole: pa.Array, stems: pa.Array) -> pa.Array:
    """What stands behind each stem in its whole word, cut out of the words' own bytes."""
    _, offsets, data = whole.buffers()
    lengths = pc.binary_length(stems).to_numpy()
    ends = np.frombuffer(offsets, np.int32, len(whole) + 1, 4 * whole.offset)
    sizes = np.diff(ends) - lengths
    cuts = np.zeros(len(whole) + 1, np.int32)
    np.cumsum(sizes, out=cuts[1:])
    place = np.repeat(ends[:-1] + lengths - cuts[:-1], sizes) + np.arange(cuts[-1], dtype=np.int32)
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return pa.Array.from_buffers(pa.binary(), len(whole), [None, pa.py_buffer(cuts), pa.py_buffer(held[place])])


def _folded(text: bytes) -> bytes:
    """A-Z in lower case where that cannot change how the text is read.

    With a combining mark behind it a letter may compose in one case only, and the
    tokenizer's special tokens are written in lower case.
    """
    if b"\xcc" in text or b"\xcd" in text or b"<|" in text:
        return text
    return text.lower()


def _slices(texts: pa.Array, most: int) -> Iterator[tuple[int, pa.Array]]:
    """Neighbouring texts and the place of the first, by their size."""
    first, size = 0, 0
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    for k, length in enumerate(sizes, 1):
        size += length
        if size >= most or k == len(sizes):
            yield first, texts.slice(first, k - first)
            first, size = k, 0


_ENCODERS: dict[tuple[str, bool], WordEncoder] = {}


def encoder(path: str, lean: bool = False) -> WordEncoder:
    """The worker's encoder for a file; its words outlive a task."""
    if (path, lean) not in _ENCODERS:
        _ENCODERS[path, lean] = WordEncoder(path, lean)
    return _ENCODERS[path, lean]


def _file_rows(path: str, lean: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = pa.schema(
        [
            ("part", pa.int32()),
            ("first", pa.int64()),
            ("doc_ids", pa.list_(pa.int64())),
            ("doc_tokens", pa.list_(pa.int64())),
            ("words", pa.binary()),
            ("offsets", pa.binary()),
        ]
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, first = encoder(path, lean), TaskContext.get().partitionId(), 0
        ids: list[int | None] = []
        coded: list[bytes] = []

        def row() -> pa.RecordBatch:
            values = np.frombuffer(b"".join(coded), "<u4")
            words, offsets = simple8b.encode(values)
            sizes = [len(x) // 4 for x in coded]
            blobs = [[words.astype("<u8").tobytes()], [offsets.astype("<u4").tobytes()]]
            return pa.record_batch([[part], [first], [ids], [sizes], *blobs], schema=schema)

        end = np.array([END], "<u4").tobytes()
        size = 0
        for batch in batches:
            doc_ids = batch["doc_id"].to_pylist()
            for at, texts in _slices(batch["text"], SLICE_BYTES // 2 if lean else SLICE_BYTES):
                for doc_id, code in zip(doc_ids[at:], coder.encode(raw(texts))):
                    ids.append(doc_id), coded.append(code + end)
                    size += len(code) // 4 + 1
                    if size >= _GROUP_IDS:
                        yield row()
                        first, size, ids, coded = first + size, 0, [], []
        if ids:
            yield row()
        # The worker waits for its next task without what slices took.
        pa.default_memory_pool().release_unused()

    return rows


def write_ids(docs: DataFrame, tokenizer: str, folder: str, lean: bool = False) -> None:
    """Write the ids of ``docs(doc_id, text)`` as files below ``folder``.

    Documents are dealt by ranges of ``doc_id`` and sorted, so the files' parts in order
    hold ascending ids. A null text is empty; every document ends with the id 2. Rows
    without ``doc_id`` come first, repeated ones stand together in any order. ``lean`` takes
    less memory of a worker and some more time.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    dealt = docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    rows = dealt.mapInArrow(_file_rows(tokenizer, lean), FILE_SCHEMA)
    rows.write.option("compression", "zstd").parquet(folder)


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of the files and ``base``, the number of ids in all earlier parts.

    Totals are one row of two numbers for each part, that is for each task that wrote;
    only they are summed in one place and sent to every task.
    """
    rows = spark.read.schema(FILE_SCHEMA).parquet(folder)
    size = F.aggregate("doc_tokens", F.lit(0).cast("long"), lambda total, n: total + n)
    totals = rows.groupBy("part").agg(F.sum(size).alias("total"))
    before = F.sum("total").over(W.orderBy("part")) - F.col("total")
    return rows.join(F.broadcast(totals.select("part", before.alias("base"))), "part")


def documents(batch: pa.RecordBatch) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """``(doc_id, ids of all documents before it, its ids)`` of rows of :func:`read_files`."""
    for row in batch.to_pylist():
        words, offsets = np.frombuffer(row["words"], "<u8"), np.frombuffer(row["offsets"], "<u4")
        sizes = row["doc_tokens"]
        ids = simple8b.decode(words, offsets.astype(np.int64), sum(sizes)).astype("<u4")
        at, start = 0, row["base"] + row["first"]
        for doc_id, size in zip(row["doc_ids"], sizes):
            yield doc_id, start + at, ids[at : at + size]
            at += size


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [
            (doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
            for doc_id, start, ids in documents(batch)
        ]
        names = ["doc_id", "start", "n_tokens", "ids_crc32"]
        columns = list(zip(*rows)) or [()] * 4
        yield pa.record_batch([pa.array(x, pa.int64()) for x in columns], names=names)


def file_digests(spark: SparkSession, folder: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of the documents in the files."""
    return read_files(spark, folder).mapInArrow(
        _digests, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def token_files(docs: DataFrame, tokenizer: str, lean: bool = False) -> str:
    """Write the ids of ``docs`` to a new folder and name it."""
    folder = shared_folder(docs.sparkSession)
    write_ids(docs, tokenizer, folder, lean)
    return folder
