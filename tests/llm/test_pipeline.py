import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from sheafwork.llm import decontaminate, quality
from sheafwork.llm.tables import table, written
from tests.llm import data
from tests.llm.test_minhash import brute_force as groups
from tests.llm.test_pii import plain


def test_stages(spark):
    """Each stage against a plain computation on what it was given."""
    docs = table(spark, data.SF_DIR, "documents")
    columns, given, out = docs.columns, docs, {}
    for name, stage in corpus_pipeline.STAGES:
        given, before = written(stage(spark, given, data.SF_DIR)), given
        out[name] = ({row.doc_id: row for row in before.collect()}, given)
        assert name == "packing" or given.columns == columns

    before, after = out["quality classifier"]
    judged = quality.classify(docs, table(spark, data.SF_DIR, "labels")).collect()
    accepted = {row.doc_id for row in judged if row.accepted}
    assert {row.doc_id: row for row in after.collect()} == {i: before[i] for i in accepted}

    before, after = out["MinHash near-dedup"]
    kept = {row[0] for row in groups([(i, row.text) for i, row in before.items()]) if row[3]}
    assert {row.doc_id: row for row in after.collect()} == {i: before[i] for i in kept}

    before, after = out["benchmark decontamination"]
    items = ["".join(map(chr, decontaminate.folded(r.text))) for r in table(spark, data.SF_DIR, "benchmark").collect()]
    after = {row.doc_id: row for row in after.collect()}
    assert after.keys() == before.keys()
    for doc_id, row in after.items():
        was, now = ("".join(map(chr, decontaminate.folded(x.text))) for x in (before[doc_id], row))
        hit = any(item in was for item in items)
        assert not any(item in now for item in items) and row.n_chars == len(row.text)
        assert hit or row.text == before[doc_id].text or len(row.text) < len(before[doc_id].text)

    before, after = out["PII"]
    for row in after.collect():
        assert not plain(row.text) and row.n_chars == len(row.text)

    before, after = out["packing"]
    coder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = {}
    for row in after.orderBy("sequence_id", "offset").collect():
        pieces.setdefault(row.doc_id, []).append(row)
    assert pieces.keys() == before.keys()
    for doc_id, own in pieces.items():
        ids = coder.encode(before[doc_id].text, add_special_tokens=False).ids + [2]
        assert b"".join(row.ids for row in own) == np.array(ids, "<u4").tobytes()
        assert all(row.ids_crc32 == zlib.crc32(row.ids) for row in own)


def test_run_and_hostile_rows(spark):
    assert corpus_pipeline.run(spark, data.SF_DIR).count() > 0
    for rows in (None, []):
        given = data.documents(spark, rows).select("doc_id", "text", "lang", "source", "n_chars")
        for _, stage in corpus_pipeline.STAGES:
            given = written(stage(spark, given, data.SF_DIR))
        assert rows is None or given.count() == 0


def test_rows_that_share_an_id(spark):
    """Rows are judged by their own text: of copies one stays, other texts of the id stay as well."""
    docs = table(spark, data.SF_DIR, "documents")
    columns = docs.columns
    texts = [r.text for r in quality.classify(docs, table(spark, data.SF_DIR, "labels")).where("accepted").join(docs, "doc_id").orderBy("doc_id").limit(40).collect()]
    kept = set(texts)
    alike = {row[0]: row[2] for row in groups(list(enumerate(texts)))}
    rows = [(-7, t, "en", "s", len(t)) for t in texts] + [(None, t, "en", "s", len(t)) for t in texts]
    rows += [(-7, "\u4e00" * 60, "en", "s", 60), (-8, texts[0], "en", "s", 1)]
    added = spark.createDataFrame(rows, docs.select("doc_id", "text", "lang", "source", "n_chars").schema)
    given = written(docs.select(added.columns).union(added))
    assert set(given.columns) == set(columns)
    accepted = corpus_pipeline.quality_stage(spark, given, data.SF_DIR)
    assert accepted.columns == given.columns
    own = written(accepted.where("doc_id < 0 OR doc_id IS NULL"))
    found = own.collect()
    assert {r.text for r in found if r.doc_id == -7} == {r.text for r in found if r.doc_id is None} == kept
    single = corpus_pipeline.near_duplicate_stage(spark, own, data.SF_DIR).collect()
    assert len(single) == len(set(alike.values()))
    assert {r.doc_id for r in single} == {-8, -7}
