"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns
for every operator and stage, each with its stated result."""

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from martwright.llm import dac, fingerprints, jaccard, licenses, mixing, packing, quality, secrets, sharding, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 7919}x{i % 13}" for i in range(60_000))
ROWS = [
    (1, "", "en", "a", 0),
    (2, None, "en", "a", None),
    (3, LONG, "en", "a", len(LONG)),
    (4, "two words", None, "b", 9),
    (4, "two words", None, "b", 9),
    (5, LONG, "de", None, len(LONG)),
    (None, "a text without an id but with words", "en", "b", 35),
    (7, "   \n\t ", "en", "b", 6),
    (8, "Ünï çødé <|endoftext|> \x0b\x1c\x85 emoji \U0001f600\U0001f600 end", "en", "b", 40),
]
#: Names that operators use inside or return.
CLASHES = ["row_key", "row", "n", "class", "component", "copy", "mix_key", "shard", "slot", "size", "length", "start",
           "_key", "_salt", "_source", "directory", "score", "kept", "spans", "hidden", "_next", "_range", "_halo", "line"]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    return df.select("*", *[F.lit("x").alias(c) for c in CLASHES])


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(4, 1, 1), (4, 0, 0), (8, 1, 0), (None, 1, 1), (99, 0, 1)], "doc_id long, quality int, toxic int")


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_codes(docs, none):
    got = rows(dac.read_documents(dac.write_codes(docs)))
    assert len(got) == len(ROWS)
    assert sum(r["n_tokens"] for r in got) == max(r["start"] + r["n_tokens"] for r in got)
    assert next(r for r in got if r["doc_id"] is None)["start"] == 0  # nulls first
    assert {r["n_tokens"] for r in got if r["doc_id"] in (1, 2, 7)} == {1}
    assert rows(dac.read_documents(dac.write_codes(none))) == []


def test_packing(docs, none):
    got = rows(packing.packed_digests(docs))
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in pieces] == np.cumsum([0] + [r["length"] for r in pieces])[:-1].tolist()
        assert sum(r["length"] for r in pieces) <= 4096
    assert sum(r["length"] for r in got) == sum(r["doc_tokens"] for r in got if r["start"] == 0)
    assert rows(packing.packed_digests(none)) == []


def test_jaccard(docs, none):
    got = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows(jaccard.jaccard_components(docs))}
    assert {(1, 0, 1), (2, 0, 2), (7, 0, 7), (4, 1, 4)} <= got
    assert {c for d, n, c in got if d in (3, 5)} == {3}
    assert (None, 4, None) in got
    assert rows(jaccard.jaccard_components(none)) == []
    kept = rows(jaccard.drop_near_duplicates(docs))
    assert sorted(str(r["doc_id"]) for r in kept) == sorted(["1", "2", "3", "4", "None", "7", "8"])
    assert rows(jaccard.drop_near_duplicates(none)) == []


def test_quality(docs, none):
    got = rows(quality.quality_signals(docs))
    assert len(got) == len(ROWS)
    assert {r["doc_id"] for r in got if r["kept"]} == {3, 5}
    assert all(r["n_words"] == 0 and r["base_failed"] for r in got if r["doc_id"] in (1, 2, 7))
    assert rows(quality.quality_signals(none)) == []
    cleaned = quality.filter_quality(docs)
    assert cleaned.columns == docs.columns and {r["doc_id"] for r in rows(cleaned)} == {3, 5}
    assert rows(quality.filter_quality(none)) == []


def test_secrets(docs, none):
    got = rows(secrets.scan_secrets(docs))
    assert len(got) == len(ROWS) and all(r["spans"] == "" and r["n_assign"] == 0 for r in got if r["doc_id"] != 8)
    assert rows(secrets.scan_secrets(none)) == []
    masked = secrets.mask_secrets(docs)
    assert masked.columns == docs.columns and masked.count() == len(ROWS)
    assert rows(secrets.mask_secrets(none)) == []


def test_mixing(docs, none):
    got = mixing.mix(docs)
    assert [c for c in got.columns if c in ("copy", "mix_key")] == ["copy", "mix_key"]
    copies = got.where("doc_id = 4").groupBy("copy").count().collect()
    assert all(r["count"] == 2 for r in copies)  # repeated rows are repeated alike
    assert rows(mixing.mix(none)) == []


def test_sharding(docs, none):
    got = rows(sharding.shard_documents(docs))
    assert len(got) == len(ROWS) and max(r["slot"] for r in got) == 0  # fewer rows than shards
    assert all(r["size"] == 1 for r in got if r["doc_id"] in (1, 2))
    assert rows(sharding.shard_documents(none)) == []


def test_fingerprints(docs, none, spark):
    got = rows(fingerprints.edited_fingerprints(docs))
    assert len(got) == len(ROWS)
    assert len({r["fingerprint"] for r in got if r["doc_id"] in (3, 5)}) == 1
    assert {r["fingerprint"] for r in got if r["doc_id"] in (1, 2, 7)} == {",".join(["-"] * 64)}
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    assert rows(fingerprints.edited_fingerprints(none)) == []
    only = rows(fingerprints.edited_fingerprints(spark.createDataFrame([ROWS[3]], SCHEMA)))
    assert only[0]["near_next"] == 1.0  # an only document follows itself


def test_licences(docs, none, spark):
    got = rows(licenses.scan_licences(licenses.document_files(docs)))
    assert len(got) == len(ROWS) and all(r["licence"] is None for r in got)
    assert rows(licenses.scan_licences(licenses.document_files(none))) == []


def test_toxicity(docs, none, labels):
    got = rows(toxicity.score_toxicity(docs, labels))
    assert len(got) == len(ROWS) and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (1, 2, 7)}) == 1
    assert rows(toxicity.score_toxicity(none, labels)) == []
    assert len({r["score"] for r in rows(toxicity.score_toxicity(docs, labels.limit(0)))}) == 1


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages(spark, docs, none, name, stage):
    for table in (docs.select(SCHEMA.replace(" long", "").replace(" string", "").split(", ")), none):
        out = stage(spark, table, None)
        if name != "packing":
            assert out.columns == table.columns
            assert [f.dataType for f in out.schema] == [f.dataType for f in table.schema]
        out.collect()
