"""Every stage of the pipeline on nulls, empty texts, repeated rows, clashing columns and no rows."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from loadvane.llm import bpe
from loadvane.llm.queries import RANKS

SMALL = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use for columns of their own.
CLASHES = ("size", "score", "repeats", "source_size", "target", "prefix", "added", "whole", "mark", "row", "cut", "ids", "class_id", "keep")
STAGES = dict(corpus_pipeline.STAGES)


def odd_documents(spark):
    word = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    rows = [(i, " ".join(word[(i * k) % 10] + str(i) for k in range(1, 30)), "en", "ab"[i % 2], i) for i in range(12)]
    rows += [(20, None, None, "a", None), (21, "", "en", None, 0), (22, " \n", "de", "c", 2), (None, "no id " * 9, "en", "b", 1)]
    rows += [(3, *rows[3][1:])] * 2 + [(23, "long " * 20_000, "fr", "b", 1)]
    df = spark.createDataFrame(rows, COLUMNS)
    return df.select("*", *(F.concat(F.lit(f"{name}-"), F.coalesce(F.col("lang"), F.lit("none"))).alias(name) for name in CLASHES))


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stage_keeps_whole_rows(spark, name):
    docs = odd_documents(spark)
    out = STAGES[name](spark, docs, SMALL)
    assert out.columns == docs.columns
    known, got = {tuple(r) for r in docs.collect()}, [tuple(r) for r in out.collect()]
    assert got and set(got) <= known
    if name == "toxicity":
        assert sorted(map(str, got)) == sorted(str(tuple(r)) for r in docs.collect())
    if name == "near_duplicates":
        assert len(got) == len(set(got))
    assert STAGES[name](spark, docs.filter("doc_id < 0"), SMALL).count() == 0


def test_last_stage_returns_ids(spark):
    docs = odd_documents(spark)
    out = corpus_pipeline.encode_texts(spark, docs, SMALL)
    rows = out.collect()
    assert len(rows) == docs.count()
    assert all(len(r.ids) == r.n_tokens for r in rows)
    back = bpe.decode(out.select("doc_id", "ids"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    texts = sorted((str(r.doc_id), r.text or "") for r in docs.collect())
    assert sorted((str(r.doc_id), bytes(r.decoded).decode()) for r in back.collect()) == texts
    assert corpus_pipeline.encode_texts(spark, docs.filter("doc_id < 0"), SMALL).count() == 0
