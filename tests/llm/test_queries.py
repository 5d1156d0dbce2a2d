"""Registered queries: complete, over whole tables, equal to their SQL."""

from collections import Counter

import duckdb
import pytest

from shelfscan.llm import bpe, sharding, simhash, winnow
from shelfscan.llm.oracle import ORACLE
from shelfscan.llm.queries import QUERIES
from tests.llm import brute
from tests.llm.conftest import SF


def test_one_query_per_operator():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cur = con.execute(ORACLE[name])
    cols = [d[0] for d in cur.description]
    df = QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(cols)
    assert Counter(tuple(r) for r in df.select(*cols).collect()) == Counter(cur.fetchall())


def test_queries_without_sql(spark, real_pairs):
    rows = lambda n, *cols: Counter(tuple(r) for r in QUERIES[n](spark, SF).select(*cols).collect())
    assert rows("op1_simhash_near_dedup", "doc_id", "fingerprint", "component_id") == Counter(
        brute.near_dups(real_pairs))
    assert rows("op3_document_fingerprints", "doc_id", "n_chars", "edited_sha256") == Counter(
        brute.edited(real_pairs))
    assert rows("op4_sharding", "doc_id", "size", "text_crc32") == Counter(
        (i, len((t or "").encode()) + 1, brute.crc(t)) for i, t in real_pairs)
    assert rows("op6_license_scan", "doc_id", "n_words", "n_base", "first_word", "last_word",
                "base_labels") == Counter((i, *brute.license_base(t)) for i, t in real_pairs)
    labels = QUERIES["op6_license_scan"](spark, SF).collect()
    assert all(set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) for r in labels)
    assert all(0 <= r.score <= 1 for r in labels)
    assert QUERIES["op8_quality_classifier"](spark, SF).count() == len(real_pairs)


def test_fingerprint_columns(spark, real_pairs):
    """Equal texts have equal fingerprints; likeness is that of the texts."""
    got = QUERIES["op3_document_fingerprints"](spark, SF).collect()
    text = dict(real_pairs)
    by_text = {}
    for r in got:
        assert by_text.setdefault(text[r.doc_id], r.fingerprint) == r.fingerprint
        assert r.fingerprint == winnow.encode(winnow.winnow(text[r.doc_id]))
    order = sorted(text, reverse=True)
    after = {i: order[(n + 1) % len(order)] for n, i in enumerate(order)}
    for r in got:
        if text[r.doc_id] == text[after[r.doc_id]]:
            assert r.near_next == 1.0 and r.near_edited > 0
    long = [r for r in got if r.n_chars > 500 and text[r.doc_id] != text[after[r.doc_id]]]
    mean = lambda xs: sum(xs) / len(xs)
    assert 0.3 < mean([r.near_edited for r in long]) < 0.8 and mean([r.near_next for r in long]) < 0.1


def test_production_parameters():
    assert (simhash.SHINGLE, simhash.MAX_BITS, simhash.HASH_SEED) == (3, 2, 42)
    assert sharding.OVERFULL >= 1 and bpe.vocabulary_path().endswith("word_bpe_49k.json")


def test_native_queries_run_no_python(spark):
    for name in ("op4_sharding", "op5_source_mixing", "op6_license_scan"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not any(w in plan for w in ("Python", "Arrow", "Pandas")), name
