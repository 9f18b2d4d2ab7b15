"""Registered queries against their SQL twins, or against plain Python over the same rows."""

import hashlib
import struct
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as contract
import compare
from conftest import SF
from martloom.llm import queries


@pytest.fixture(scope="module")
def con():
    return compare.database(SF)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_same_rows_as_sql(spark, con, name):
    assert compare.differences(queries.QUERIES[name](spark, SF), con, queries.ORACLE[name]) is None


def test_all_and_the_pipeline_are_registered():
    names = contract.queries().keys()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, len(queries.QUERIES) + 1))
    assert "pipeline" in names


def _texts(con):
    return con.execute("select doc_id, text from documents order by doc_id").fetchall()


def test_bpe_equals_the_library(spark, con):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = {r["doc_id"]: r for r in queries.op3_bpe_roundtrip(spark, SF).collect()}
    for doc_id, text in _texts(con):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        back = tokenizer.decode(ids, skip_special_tokens=False)
        expected = (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(back.encode()).hexdigest())
        assert tuple(found[doc_id])[1:] == expected


def test_arrow_files_equal_the_library(spark, con):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    found = {r["doc_id"]: r for r in queries.op8_arrow_tokens(spark, SF).collect()}
    start = 0
    for doc_id, text in _texts(con):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        assert tuple(found[doc_id]) == (doc_id, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        start += len(ids)


def test_quality_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    labels = dict(duckdb.sql(f"select doc_id, quality from '{folder}/labels.parquet'").fetchall())
    rows = [r for r in queries.op2_quality_classifier(spark, folder).collect() if r["held_out"] and r["doc_id"] in labels]
    scores, truth = np.array([r["score"] for r in rows]), np.array([labels[r["doc_id"]] for r in rows])
    assert ((scores >= 0) & (scores <= 1)).all()
    assert (scores[truth == 1][:, None] > scores[truth == 0][None]).mean() > 0.95
    assert (np.array([r["predicted"] for r in rows])[truth == 1] == 1).mean() > 0.95
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)


def test_embedding_links_against_all_pairs(spark, con):
    rows = con.execute("select vec_id, embedding from embeddings order by vec_id").fetchall()
    vectors = np.array([v for _, v in rows], dtype=float)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    near = vectors @ vectors.T >= 0.95
    np.fill_diagonal(near, False)
    found = {r["vec_id"]: r["n_links"] for r in queries.op7_embedding_near_dedup(spark, SF).collect()}
    assert [found[i] for i, _ in rows] == near.sum(axis=1).tolist()


def test_mixing_reaches_its_targets(spark):
    from martloom.llm import mixing

    rows = queries.op9_soft_mixing(spark, "/root/testdata/sf0.01").collect()
    assert all(abs(r["p_plain"] + r["p_toxic"] + r["p_poor"] - 1) < 1e-9 and r["rate"] >= 0 for r in rows)
    totals = {d: sum(r["rate"] * r["n_tokens"] * r[f"p_{d}"] for r in rows) for d in mixing.DOMAINS}
    for d, target in mixing.TARGETS.items():
        assert abs(totals[d] / sum(totals.values()) - target) < 0.001
        assert abs(totals[d] - rows[0][f"reached_{d}"]) < 1e-6 * sum(totals.values())
        assert abs(totals[d] - rows[0][f"wanted_{d}"]) < 0.001 * sum(r["n_tokens"] for r in rows)
