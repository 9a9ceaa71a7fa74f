"""Vector searches and URL rules against brute force, and the whole queries on the small table."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadvane.llm import annscan, pivots, urlrules
from loadvane.llm.queries import QUERIES, URL_RULES


def table(spark, n=700, dim=12):
    rng = np.random.default_rng(0)
    vectors = rng.normal(size=(n, dim))
    vectors[: n // 3] = vectors[0] + rng.normal(size=(n // 3, dim)) * 0.01
    vectors[5] = vectors[6]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(2000, None), (2020, [0.0] * dim), (2040, [1.0, None] + [0.0] * (dim - 2)), (2060, [float("nan")] * dim), (None, [1.0] * dim), (2080, [])]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>"), vectors


def best(vectors, at, k, ids):
    score = vectors @ vectors[at]
    score[at] = -np.inf
    order = np.lexsort((ids, -score))[:k]
    return ids[order].tolist(), score[order]


def test_pivot_search_is_exact(spark, monkeypatch):
    monkeypatch.setattr(pivots, "ROWS", 150)
    df, vectors = table(spark)
    whole = np.floor(64 * vectors)
    column = F.transform("embedding", lambda x: F.when(F.abs(x) < float("inf"), F.floor(x * 64).cast("double")))
    got = pivots.top_k(df, "vec_id", column, F.col("id") % 20 == 0, 20).toPandas()
    full = np.vstack([whole, np.zeros(whole.shape[1])])
    ids = np.array([*range(len(whole)), 2020])  # a vector of zeros takes part here
    for at in [*range(0, len(whole), 20), len(whole)]:
        part = got[got["query_id"] == ids[at]].sort_values("rank")
        want, score = best(full, at, 20, ids)
        assert part["vec_id"].tolist() == want and np.array_equal(part["score"], score)
    assert set(got["query_id"]) == {*range(0, len(whole), 20), 2020}
    assert pivots.top_k(df.limit(0), "vec_id", column, F.col("id") % 20 == 0, 20).count() == 0


def test_ann_recall(spark, monkeypatch):
    monkeypatch.setattr(annscan, "ROWS", 100)
    df, vectors = table(spark)
    got = annscan.nearest(df, "vec_id", F.col("embedding"), F.col("id") % 20 == 0, 20).toPandas()
    ids, hits = np.arange(len(vectors)), 0
    for at in range(0, len(vectors), 20):
        part = got[got["query_id"] == at].sort_values("rank")
        assert part["rank"].tolist() == list(range(1, 21)) and at not in set(part["vec_id"])
        assert np.allclose(part["score"], vectors[part["vec_id"]] @ vectors[at], rtol=1e-12)
        hits += len(set(best(vectors, at, 20, ids)[0]) & set(part["vec_id"]))
    assert set(got["query_id"]) == set(range(0, len(vectors), 20))
    assert hits >= 0.9 * len(got)
    assert annscan.nearest(df.limit(0), "vec_id", F.col("embedding"), F.col("id") % 20 == 0, 20).count() == 0
    few = annscan.nearest(df.where("vec_id < 5"), "vec_id", F.col("embedding"), F.col("id") % 20 == 0, 20)
    assert sorted(r.vec_id for r in few.collect()) == [1, 2, 3, 4]


def test_url_rules_and_mined_rules(spark):
    good = [(i, f"http://a.example.org/en/{i}") for i in range(40)]
    bad = [(100 + i, f"http://b.example.org/spam/{i}") for i in range(40)]
    other = [
        (500, None), (501, "no scheme"), (502, "HTTP://A.Example.NET"), (503, "x://example.net/en/q?://y"), (504, "x://sub.Example.COM/de/#t"),
        (505, "x://badexample.com/de/"), (506, "x://q.org/fr/1"), (507, "x://z.example.org/spam/new"), (508, "http://b.example.org/spam/5"), (508, "://"),
        (509, "x://example.net/deep/en/"),
    ]
    pages = spark.createDataFrame(good + bad + other, "page_id long, url string")
    labels = spark.createDataFrame([(i, False) for i, _ in good] + [(i, True) for i, _ in bad] + [(None, True), (9999, True)], "id long, blocked boolean")
    got = urlrules.judge(pages, labels, URL_RULES)
    by = {}
    for r in got.collect():
        by.setdefault(r.page_id, []).append((r.host, r.path, r.rule, r.verdict))
    assert sum(map(len, by.values())) == len(good + bad + other)
    assert by[500] == by[501] == [("", "", None, "allow")]
    assert by[502] == [("a.example.net", "", None, "allow")]  # the path does not begin with /
    assert by[503] == [("example.net", "/en/q", "example.net/en/", "allow")]
    assert by[504] == [("sub.example.com", "/de/", "example.com/de/", "block")]
    assert by[505] == [("badexample.com", "/de/", None, "allow")]
    assert by[506] == [("q.org", "/fr/1", "org/fr/", "allow")]
    assert by[507] == [("z.example.org", "/spam/new", None, "block")]
    assert sorted(by[508]) == [("", "", None, "allow"), ("b.example.org", "/spam/5", None, "block")]
    assert by[509][0][2:] == ("net/", "block")
    assert {v[0][3] for k, v in by.items() if k < 100} == {"allow"} and {v[0][3] for k, v in by.items() if 100 <= k < 200} == {"block"}
    none = urlrules.judge(pages, labels.limit(0), URL_RULES)
    assert {r.verdict for r in none.where("rule is null").collect()} == {"allow"}
    assert urlrules.judge(pages.limit(0), labels, URL_RULES).count() == 0


def test_the_pipeline_and_every_query_are_registered():
    import corpus_pipeline

    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "mixing", "byte_bpe"]
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 11))


def test_pipeline_stages_keep_the_columns(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    assert labels.count() > 0
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept, folder)
        assert out.columns == docs.columns
        assert out.count() > 0
        kept = out
    last = corpus_pipeline.STAGES[-1][1](spark, kept, folder)
    assert last.count() == kept.count()


@pytest.mark.parametrize("name", ["op8_ann_scan", "op9_pivot_search"])
def test_vector_queries_answer_every_query_row(spark, name):
    folder = "/root/testdata/sf0.001"
    n = spark.read.parquet(f"{folder}/embeddings.parquet").where("vec_id % 20 = 0").count()
    got = QUERIES[name](spark, folder)
    assert got.count() == 20 * n and got.select("query_id").distinct().count() == n


def test_rules_of_a_rare_host_in_a_large_table(spark):
    # 12 of 4000 labelled urls lie under a tenth of what a share of 1% asks for, among labels without signal
    plain = [(i, f"http://h{i % 7}.example.org/en/{i}", i % 4 == 0) for i in range(3988)]
    rare = [(5000 + i, f"http://spam.example.org/x/{i}", True) for i in range(12)]
    # one long url many times: its tokens are one item, not 2^40 combinations
    long = [(6000 + i, "http://l.example.org/" + "/".join(f"d{j}" for j in range(40)), i % 4 == 0) for i in range(40)]
    pages = spark.createDataFrame([r[:2] for r in plain + rare + long] + [(9000, "http://spam.example.org/y"), (9001, "http://q.example.org/x")], "page_id long, url string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in plain + rare + long], "id long, blocked boolean")
    got = {r.page_id: r.verdict for r in urlrules.judge(pages, labels, ()).collect()}
    assert {k for k, v in got.items() if v == "block"} == {*range(5000, 5012), 9000, 9001}
    assert urlrules.least_count(0.25) < 12 < urlrules.least_count(0.75)
