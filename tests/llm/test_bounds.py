"""Bounds that hold at any size: supports, remembered tokens, tables on the way; repeated rows; plans as shipped."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lodestone.llm import common, exact_dedup, licenses, packing, toxicity
from lodestone.llm.common import Durable, temporary

SF = "/root/testdata/sf0.001"


def test_supports_of_large_tables(spark):
    for total in (0, 1, 10**6, 10**9, 10**11, 10**13, 10**16):
        share, bar = exact_dedup._bars(total)
        assert 1e-4 <= share <= exact_dedup.SUPPORT and total / bar <= exact_dedup.MOST + 1
        spark.range(3).stat.freqItems(["id"], share).collect()
    share, bar = exact_dedup._bars(10**11)
    assert 10**11 * share > bar  # then the counts name the hot digests


def test_hot_by_count(spark, monkeypatch):
    """Digests that the summary passes over are hot by their exact count, with the same rows in the end."""
    df = spark.range(2000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("warm"), F.col("id") % 20)).otherwise(F.concat(F.lit("t"), F.floor(F.col("id") / 5))).alias("text"))
    want = sorted(map(tuple, exact_dedup.group_copies(df).collect()))
    kept = sorted(map(tuple, exact_dedup.drop_copies(df).collect()))
    monkeypatch.setattr(exact_dedup, "_bars", lambda total: (0.9, 10))
    assert sorted(map(tuple, exact_dedup.group_copies(df).collect())) == want and sorted(map(tuple, exact_dedup.drop_copies(df).collect())) == kept
    rows, winners, cold = exact_dedup._groups(df, "doc_id", F.col("text"), None)
    assert winners.count() > 1 and cold.where("n > 10").count() == 0 and cold.count() > 0


def test_clashing_digest_column(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "a", "y"), (3, None, "z")], "doc_id long, text string, __digest string")
    assert sorted((r.doc_id, r["__digest"]) for r in exact_dedup.drop_copies(df).collect()) == [(2, "y"), (3, "z")]


def test_toxic_tokens_are_remembered_within_bytes(monkeypatch):
    known = toxicity._Known()
    known.keep("x" * 1_000_000, frozenset({1}))
    assert not known
    monkeypatch.setattr(toxicity, "REMEMBERED", 10_000)
    known = toxicity._Known()
    for k in range(1000):
        known.keep(f"token{k}", frozenset(range(k % 7)))
        assert sum(200 + 100 * len(v) for v in known.values()) <= 10_000
    assert known


def test_packed_words_are_remembered_up_to_a_length():
    tokens = packing.Tokens(packing.default_vocabulary(), packing.EOS)
    texts = ["a short text, and " + "QUJD" * 5000 + " then; " + "x" * 3000 + "...", "again a short text", "y" * 200 + ","]
    plain = [np.array(tokens.tokenizer.encode(t, add_special_tokens=False).ids + [packing.EOS], "<u4").tobytes() for t in texts]
    assert tokens.encode(texts) == plain and tokens.encode(texts) == plain
    assert max(map(len, tokens.known)) <= packing.LONG and "short" in tokens.known


def test_license_rows_of_one_id(spark):
    notice = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software. Released under the MIT License."
    rows = [(1, notice), (1, notice), (2, notice), (3, None), (None, notice), (3, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit("clash"))
    got = sorted(map(tuple, licenses.summary(df).collect()), key=repr)
    one = {r[1:] for r in got if r[0] in (1, 2, None)}
    assert len(got) == 6 and len(one) == 1 and [r for r in got if r[0] == 3] == [(3, 0, 0, 0, "", 0.0)] * 2
    assert licenses.summary(df.limit(0)).count() == 0


def test_license_query_is_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    for r in licenses.op3_licenses(spark, SF).collect():
        found = licenses.brute(docs[r.doc_id])
        known = [x for x in found if x[1] != licenses.UNKNOWN]
        assert (r.n_licensed, r.n_unknown, r.n_confirmed) == (len(known), len(found) - len(known), sum(x[3] for x in found))
        assert r.families == ",".join(sorted({x[1] for x in known})) and abs(r.score - max([x[2] for x in known], default=0.0)) < 2e-6


def test_plan_is_near_its_bound(spark):
    lengths = packing.pieces(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), "doc_id", "text", None).groupBy("length").count()
    plan = packing.plan_packing(dict(map(tuple, lengths.collect())))
    assert plan.bound <= plan.sequences <= 1.002 * plan.bound + 1


def test_tables_on_the_way_are_removed(spark, tmp_path):
    with temporary():
        store = Durable(spark, "gone")
        path = store.write(spark.range(3))._durable_path
        assert os.path.isdir(path.removeprefix("file://"))
    assert not os.path.exists(store.root.removeprefix("file://"))
    kept = Durable(spark, "kept")
    assert kept.write(spark.range(3)).count() == 3


@pytest.mark.parametrize("rows", [True, False])
def test_pipeline_leaves_its_result_only(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "shared_dir", lambda _: str(tmp_path / "shared"))
    folder = tmp_path / "in"
    for t in ("documents", "labels", "benchmark"):
        df = spark.read.parquet(f"{SF}/{t}.parquet")
        (df if rows else df.limit(0)).write.parquet(str(folder / f"{t}.parquet"))
    out = corpus_pipeline.run(spark, str(folder))
    assert (out.count() > 0) == rows
    left = [p for p in (tmp_path / "shared" / "lodestone").glob("*/*") if not p.name.startswith(".")]
    assert len(left) == 1 and left[0].parent.name.startswith("pipeline")
