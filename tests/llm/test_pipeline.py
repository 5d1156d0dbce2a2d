"""The pipeline stage by stage against brute force, and its edge cases."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from shelfscan.llm import bpe, mixing, quality_model
from tests.llm import brute
from tests.llm.conftest import SCHEMA, odd_rows

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    """Documents and labels: real ones of the smallest tables, odd rows beside them."""
    d = tmp_path_factory.mktemp("sf")
    real = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    odd = spark.createDataFrame(odd_rows(), SCHEMA).withColumn("doc_id", F.col("doc_id") + 1000)
    real.unionByName(odd).write.parquet(f"{d}/documents.parquet")
    spark.read.parquet("/root/testdata/sf0.001/labels.parquet").write.parquet(f"{d}/labels.parquet")
    return str(d)


def stages(spark, sf, tmp_path_factory):
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), []
    for i, (_, stage) in enumerate(P.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(i))
        stage(spark, docs, sf).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((docs, after))
        docs = after
    return out


@pytest.fixture(scope="module")
def done(spark, sf, tmp_path_factory):
    return stages(spark, sf, tmp_path_factory)


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stage_order_and_columns(done):
    assert [n for n, _ in P.STAGES] == ["quality classifier", "line dedup", "simhash near-dedup",
                                        "source mixing", "bpe encoding"]
    for before, after in done[:4]:
        assert before.columns == after.columns == COLUMNS and before.dtypes == after.dtypes


def test_quality_stage(spark, sf, done):
    before, after = done[0]
    verdict = quality_model.classify(before, spark.read.parquet(f"{sf}/labels.parquet"))
    keep = {(r.doc_id, r.k1) for r in verdict.where("keep").collect()}
    keyed = before.withColumn("k1", F.xxhash64("doc_id", "text")).collect()
    want = Counter(tuple(r)[:5] for r in keyed if (r.doc_id, r.k1) in keep)
    assert Counter(tuple(r) for r in after.collect()) == want
    assert 0 < sum(want.values()) < before.count()


def test_line_stage(done):
    before, after = done[1]
    rows = pairs(before)
    want = Counter((i, s) for i, _, _, s in brute.line_dedup(rows))
    assert Counter((i, brute.sha(t or "")) for i, t in pairs(after)) == want
    assert all(r.n_chars == len(r.text) for r in after.where("text is not null").collect())


def test_near_dedup_stage(done):
    before, after = done[2]
    ids = {c for _, _, c in brute.near_dups(pairs(before))}
    got = Counter(i for i, _ in pairs(after))
    assert set(got) - {None} == ids - {None} and max(got.values()) == 1
    texts = set(pairs(before))
    assert all(p in texts for p in pairs(after))


def test_mixing_stage(done):
    """Every leaf holds full epochs and the longest seeded prefix within its budget."""
    before, after = done[3]
    got = Counter((r.doc_id, r.text) for r in after.collect())
    leaf_of, tokens = {}, Counter()
    for r in before.withColumn("domain", mixing.domain_of(F.col("source"))).collect():
        leaf = (r.domain, r.lang or "", r.source or "")
        leaf_of[(r.doc_id, r.text)] = leaf
        tokens[leaf] += len(brute.WORD.findall(r.text or ""))
    spark = before.sparkSession
    leaves = spark.createDataFrame([(*k, v) for k, v in tokens.items()],
                                   "domain string, lang string, source string, tokens long")
    budget = int(sum(tokens.values()) * mixing.SHARE)
    plan = {(r.domain, r.lang, r.source): r for r in mixing.leaf_budgets(leaves, budget).collect()}
    by_leaf = defaultdict(list)
    for doc, leaf in leaf_of.items():
        by_leaf[leaf].append(doc)
    want = Counter()
    for leaf, docs in by_leaf.items():
        p = plan[leaf]
        order = spark.createDataFrame([(d[0],) for d in docs], "i long").select(
            "i", mixing.order_of(F.lit(p.epochs), F.col("i")).alias("o")).collect()
        place = {r.i: r.o for r in order}
        run = 0
        for d in sorted(docs, key=lambda d: (place[d[0]], d[0] is not None, d[0])):
            run += len(brute.WORD.findall(d[1] or ""))
            n = p.epochs + (p.prefix > 0 and run <= p.prefix)
            if n:
                want[d] += n
    assert got == want


def test_encoding_stage(done):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(bpe.vocabulary_path())
    before, after = done[4]
    want = Counter()
    for i, text in pairs(before):
        ids = t.encode(text or "", add_special_tokens=False).ids
        want[(i, len(ids), tuple(ids))] += 1
    assert Counter((r.doc_id, r.n_tokens, tuple(r.ids)) for r in after.collect()) == want


def test_run_equals_the_stages(spark, sf, done):
    got = Counter((r.doc_id, r.n_tokens, tuple(r.ids)) for r in P.run(spark, sf).collect())
    assert got == Counter((r.doc_id, r.n_tokens, tuple(r.ids)) for r in done[-1][1].collect())


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet")
    assert P.run(spark, str(tmp_path)).collect() == []


def test_extra_columns_pass_through(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumns(
        {n: F.lit(n) for n in ("k1", "keep", "fp", "copies", "tokens", "host", "p")})
    for _, stage in P.STAGES[:4]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns and out.where("k1 <> 'k1' or p <> 'p'").isEmpty()
    assert P.STAGES[4][1](spark, docs, sf).columns == ["doc_id", "n_tokens", "ids"]
