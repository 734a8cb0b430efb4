import os
import sys
from collections import Counter

import pytest
from pyspark.sql import functions as F

import compare
import corpus_pipeline
from netvitals.llm.preference import preference_rows, trained_spans
from netvitals.llm.queries import ORACLES, QUERIES
from netvitals.plans.shared import fresh_path

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.duck(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, con, name):
    assert compare.difference(spark, con, SMALL, QUERIES[name], ORACLES[name]) is None


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def turns(spark, *pairs):
    kind = "array<struct<role:string,text:string>>"
    return spark.createDataFrame(list(pairs), f"id int, chosen {kind}, rejected {kind}")


def test_preference_rows_by_hand(spark):
    u, a, b = ("user", "hi <|end|>"), ("assistant", "yes"), ("assistant", "no")
    frame = turns(spark, (1, [u, a], [u, b]), (2, [u, a], [u, a]), (3, [a], [b, u]), (4, None, []), (5, [u], [u, a, u, b])).withColumn("prompt", F.lit(0))
    got = {r.id: r for r in preference_rows(frame).collect()}
    assert got[1].prompt == "<|user|>\nhi < |end|><|end|>\n" and got[1].n_common == 1
    assert got[1].chosen == "<|assistant|>\nyes<|end|>\n" and got[1].rejected == "<|assistant|>\nno<|end|>\n"
    for r in got.values():
        for text, spans in ((r.chosen, r.chosen_spans), (r.rejected, r.rejected_spans)):
            assert [text[s.first : s.last] for s in spans] == [x.split("|>\n")[-1] + "<|end|>" for x in text.split("<|end|>\n")[:-1] if x.startswith("<|assistant|>")]
    assert (got[2].n_common, got[2].chosen, got[2].rejected) == (2, "", "")
    assert (got[3].n_common, got[3].prompt) == (0, "")
    assert (got[4].prompt, got[4].chosen, got[4].chosen_spans) == ("", "", [])
    assert got[5].n_common == 1 and got[5].chosen == "" and len(got[5].rejected_spans) == 2
    empty = spark.createDataFrame([], "t array<struct<role:string,text:string>>")
    assert empty.select(trained_spans(F.col("t"))).count() == 0


def test_conversations_with_gaps(spark, tmp_path):
    rows = [(0, 0, "user", None), (0, 1, None, "x"), (0, 1, "assistant", "a"), (0, 1, "assistant", "a"), (1, None, "assistant", "b"),
            (None, 0, "user", "lost"), (5, 0, "assistant", "alone"), (6, 0, "user", "no answer")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in QUERIES["op1_preference_chat"](spark, str(tmp_path)).collect()}
    assert set(got) == {0, 1, 5, 6} and got[6].chosen == got[6].rejected == ""
    assert "b<|end|>" in got[0].rejected and got[0].n_common == 2
    assert got[5].rejected == "" and got[5].chosen.startswith("<|assistant|>\nalone")


def test_pipeline_stages_on_planted_rows(spark):
    base = spark.read.parquet(f"{SMALL}/documents.parquet")
    kinds = [f.dataType for f in base.schema]
    text = base.filter("doc_id = 7").first()["text"]
    long_ = " ".join(w for r in base.orderBy("doc_id").limit(9).collect() for w in r["text"].split()[:40])
    plant = [
        (90_001, text, "en", "src1", 1), (90_002, text, "en", "src2", 1), (90_003, long_, "en", "src1", 1),
        (90_004, long_ + " zzz", "en", "src2", 1), (90_005, None, None, None, None), (90_006, "", "en", "src1", 0),
    ]
    docs = base.unionByName(spark.createDataFrame(plant, base.schema))
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, SMALL)
        path = fresh_path(spark, "stage")
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        sizes.append(docs.count())
        ids = Counter(r.doc_id for r in docs.select("doc_id").collect())
        if name != "sentencepiece":
            assert [f.dataType for f in docs.schema] == kinds and docs.columns == before.columns
        if name == "toxicity":
            assert {i for i, *_ in plant} <= set(ids)
        if name == "exact_dedup":
            assert 90_002 in ids and 90_001 not in ids and 7 not in ids
            assert sizes[-1] == before.select(F.coalesce("text", F.lit(""))).distinct().count()
        if name == "near_dedup":
            assert len({90_003, 90_004} & set(ids)) == 1
        if name == "mixing":
            assert max(ids.values()) <= 2
    assert sizes[-1] == sizes[-2] and docs.filter("NOT round_trip").count() == 0
