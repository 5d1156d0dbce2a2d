"""Each operator against brute force, on odd rows and on real documents."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfscan.llm import (bpe, license_scan, line_dedup, mixing, quality_model, quality_rules,
                           sharding, simhash, substring, winnow)
from shelfscan.llm.common import narrow
from shelfscan.llm.components import connected_components
from tests.llm import brute


def bag(df):
    return Counter(tuple(r) for r in df.collect())


# 1 -----------------------------------------------------------------------

def groups(docs, **options):
    return bag(simhash.near_dup_groups(docs, **options).select(
        "doc_id", simhash.fingerprint_hex("fp"), "component_id"))


@pytest.mark.parametrize("bucket_pairs", [64, 1])
def test_simhash_groups(odd, pairs, real, real_pairs, bucket_pairs):
    assert groups(odd, bucket_pairs=bucket_pairs) == Counter(brute.near_dups(pairs))
    assert groups(real, bucket_pairs=bucket_pairs) == Counter(brute.near_dups(real_pairs))


@pytest.mark.parametrize("max_bits,segments,bucket_pairs", [
    (2, 16, 64), (2, 16, 1), (2, 8, 4), (1, 4, 3), (3, 16, 2), (4, 9, 8)])
def test_links_equal_all_pairs(spark, max_bits, segments, bucket_pairs):
    rng = random.Random(max_bits * 100 + bucket_pairs)
    values = set()
    for _ in range(6):
        center = rng.getrandbits(64)
        for _ in range(12):
            x = center
            for _ in range(rng.randrange(6)):
                x ^= 1 << rng.randrange(64)
            values.add(x)
    values = sorted(values)
    df = spark.createDataFrame([(simhash._signed(v),) for v in values], "fp long")
    edges = simhash.links(df, max_bits, segments, bucket_pairs)
    got = edges.collect()
    assert all(((r.a ^ r.b) & (1 << 64) - 1).bit_count() <= max_bits for r in got)
    root = {r.node: r.root for r in connected_components(edges).collect()}
    want = brute.components(values, lambda a, b: (a ^ b).bit_count() <= max_bits)
    by_value = {v: simhash._signed(v) for v in values}
    classes = {}
    for v, c in zip(values, want):
        classes.setdefault(c, set()).add(by_value[v])
    mine = {}
    for v in by_value.values():
        mine.setdefault(root.get(v, v), set()).add(v)
    assert sorted(map(sorted, classes.values())) == sorted(map(sorted, mine.values()))


def test_simhash_blocks(monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 7)
    text = " ".join(f"Word{i % 13}" for i in range(101))
    assert simhash.simhash(text.encode()) == brute.simhash(text)


def test_one_per_group(odd, pairs):
    kept = simhash.keep_one_per_group(odd)
    assert kept.columns == odd.columns
    want = {c if c is not None else "null" for _, _, c in brute.near_dups(pairs)}
    rows = kept.collect()
    assert Counter(r.doc_id for r in rows if r.doc_id is not None).most_common(1)[0][1] == 1
    assert {r.doc_id for r in rows if r.doc_id is not None} == want - {"null"}


def test_components(spark):
    edges = [(1, 2), (2, 3), (5, 4), (9, 9), (7, 8), (8, 10), (10, 11), (11, 12), (12, 7)]
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted((r.node, r.root) for r in got) == [
        (1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (7, 7), (8, 7), (10, 7), (11, 7), (12, 7)]


# 2 -----------------------------------------------------------------------

@pytest.mark.parametrize("min_docs", [10, 2])
def test_line_dedup(odd, pairs, real, real_pairs, min_docs):
    for docs, rows in ((odd, pairs), (real, real_pairs)):
        marks = line_dedup.keep_bitmaps(docs, min_docs=min_docs)
        want = Counter(brute.line_dedup(rows, min_docs))
        assert bag(line_dedup.digests(docs, marks)) == want
        assert sum(n for _, _, n, _ in want) > 0


def test_line_runs_over_many_tasks(spark):
    """A hot line spread over tasks, and lines just below and above the limit."""
    rows = [(i, "hot\n" + ("nine\n" if i < 9 else "") + ("ten\n" if 40 <= i < 50 else "") + f"own {i}")
            for i in range(300)] + [(i, "hot\nten") for i in (5, 5, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in ("1", "7", "60"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
            marks = line_dedup.keep_bitmaps(docs)
            assert bag(line_dedup.digests(docs, marks)) == Counter(brute.line_dedup(rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_bitmaps_and_text(odd, pairs):
    marks = line_dedup.keep_bitmaps(odd)
    for r in marks.collect():
        bits = np.unpackbits(np.frombuffer(zlib.decompress(r.keep), np.uint8), bitorder="little")
        assert r.n_lines - bits[: r.n_lines].sum() == r.n_dropped > 0
    out = line_dedup.apply_bitmaps(odd, marks)
    assert out.columns == odd.columns and out.schema["n_chars"].dataType == odd.schema["n_chars"].dataType
    got = Counter((r.doc_id, brute.sha(r.text or ""), r.n_chars) for r in out.collect())
    want = Counter()
    for (i, t), (_, _, _, s) in zip(pairs, brute.line_dedup(pairs)):
        want[(i, s)] += 1
    assert Counter(x[:2] for x in got.elements()) == want
    assert all(r.text is None if r.doc_id == 1 else True for r in out.collect())


# 3 -----------------------------------------------------------------------

@pytest.mark.parametrize("parts", ["1", "8", "40"])
def test_edit_report(spark, odd, pairs, real, real_pairs, parts):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = bag(winnow.edit_report(real).select("doc_id", "n_chars", "edited_sha256"))
        assert got == Counter(brute.edited(real_pairs))
        unique = [p for p in pairs if p[0] not in (None, 7)]
        docs = odd.where("doc_id is not null and doc_id <> 7")
        out = winnow.edit_report(docs).collect()
        assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in out) == Counter(brute.edited(unique))
        assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in out)
        assert winnow.edit_report(odd).count() == len(pairs)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_edit_report_likeness(real, real_pairs):
    """Every likeness is that of the winnowed texts; tasks of 20 documents, so that borders matter."""
    rows = sorted(real_pairs, key=lambda r: -r[0])
    sets = [set(winnow.winnow(t)[0].tolist()) for _, t in rows]
    dice = lambda a, b: 2 * len(a & b) / (len(a) + len(b)) if a or b else 1.0
    got = {r.doc_id: r for r in winnow.edit_report(real, rows_per_task=20).collect()}
    for n, (i, t) in enumerate(rows):
        after = rows[(n + 1) % len(rows)][1]
        half = len(t) // 2
        edited = set(winnow.winnow(t[: len(t) - half] + after[:half])[0].tolist())
        assert got[i].near_next == dice(sets[n], sets[(n + 1) % len(rows)])
        assert got[i].near_edited == dice(sets[n], edited)


def test_edit_report_of_hot_ids(spark):
    """A third of the ids null, and very many equal rows: no task gets them all."""
    rows = [(None, f"text {i} " * (i % 5)) for i in range(3000)] + [(7, "the same text")] * 3000
    rows += [(i, f"other {i}") for i in range(100, 3100)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    dealt, often = winnow._dealt(df, "doc_id", "text", 300)
    tasks = dealt.groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 12 and max(r["count"] for r in tasks) < 3 * 6000 / len(tasks)
    assert sum(r["more"] for r in often.collect()) == 2999 + 599
    out = winnow.edit_report(df, rows_per_task=300)
    assert Counter(r.doc_id for r in out.collect()) == Counter(i for i, _ in rows)
    same = [r for r in out.where("doc_id = 7").collect()]
    assert sum(r.near_next == 1.0 for r in same) >= 2999      # all but the last are followed by themselves


def test_winnow_guarantee_and_positions(monkeypatch):
    rng = random.Random(3)
    k, w = 5, 7
    text = lambda n: "".join(rng.choice("abcé🙂 ") for _ in range(n))
    for block in (1 << 18, 10):
        monkeypatch.setattr(winnow, "BLOCK", block)
        for _ in range(30):
            shared = text(w + k - 1)
            a, b = text(40) + shared + text(9), text(3) + shared + text(70)
            (ha, pa_), (hb, pb) = winnow.winnow(a, k, w), winnow.winnow(b, k, w)
            common = set(ha) & set(hb)
            assert any(x in common for x, p in zip(ha, pa_) if 40 <= p <= 40 + w - 1)
            # positions: equal hashes stand on equal grams
            by_hash = {h: a[p:p + k] for h, p in zip(ha, pa_)}
            assert all(b[p:p + k] == by_hash[h] for h, p in zip(hb, pb) if h in by_hash)
            # every window has a chosen position
            chosen = set(pa_.tolist())
            n = len(a) - k + 1
            assert all(chosen & set(range(i, i + w)) for i in range(n - w + 1))
    # ties: the rightmost of equal hashes
    assert winnow.winnow("a" * 20, 5, 4)[1].tolist() == list(range(3, 16))
    assert winnow.winnow("", 5, 4)[0].size == 0 and winnow.winnow("ab", 5, 4)[0].size == 1


def test_fingerprints_same_in_any_block(monkeypatch):
    text = " ".join(str(i * i % 977) for i in range(3000))
    whole = winnow.encode(winnow.winnow(text))
    monkeypatch.setattr(winnow, "BLOCK", 100)
    assert winnow.encode(winnow.winnow(text)) == whole


# 4 -----------------------------------------------------------------------

def check_shards(docs, rows, n):
    out = sharding.shard_documents(docs, n).collect()
    assert len(out) == len(rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == Counter(
        (i, len((t or "").encode()) + 1, brute.crc(t)) for i, t in rows)
    total, largest = [0] * n, max(r.size for r in out)
    for s in range(n):
        own = [r for r in out if r.shard == s]
        assert sorted(r.slot for r in own) == list(range(len(own)))
        total[s] = sum(r.size for r in own)
    assert max(total) - min(total) <= 2 * largest
    assert {r.law for r in out} == {"bytes"} and {r.grown_shard for r in out} == {None}


def test_shards(odd, pairs, real, real_pairs):
    check_shards(real, real_pairs, 8)
    check_shards(odd, pairs, 8)
    check_shards(odd, pairs, 3)


def test_shards_with_hot_group(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_RANGE", 20)
    rows = [(i, "copy of one text") for i in range(600)] + [(i, f"text {i} " * (i % 7)) for i in range(900)]
    check_shards(spark.createDataFrame(rows, "doc_id long, text string"), rows, 8)


def test_last_record_small_beside_the_total(spark):
    """A last record far below a millionth of a shard stays in the last shard, and a record
    that begins one byte before a cut in the shard before it."""
    sizes = [4 * 10 ** 9 - 1] + [4 * 10 ** 9] * 7 + [1]
    docs = spark.createDataFrame([(i, n) for i, n in enumerate(sizes)], "doc_id long, bytes long")
    out = sharding.shard_records(docs, F.lit(0), F.col("doc_id"), F.col("bytes"), 8, F.col("doc_id"))
    got = sorted((r.doc_id, r.size, r.shard, r.slot) for r in out.collect())
    assert got == [(0, sizes[0], 0, 0), (1, sizes[1], 0, 1)] + [
        (i, sizes[i], i - 1, 0) for i in range(2, 8)] + [(8, 1, 7, 0)]


# 5 -----------------------------------------------------------------------

def mixed(docs, **options):
    return [r.asDict() for r in mixing.mix(docs, **options).collect()]


def test_mix_follows_the_tree(odd, pairs):
    """Greedy one-token water-filling gives every leaf its budget."""
    rows = odd.groupBy().agg(F.count("*")).first()[0]
    assert rows == len(pairs)
    tokens = {}
    for r in odd.select(mixing.domain_of(F.col("source")).alias("domain"), "lang", "source", "text").collect():
        leaf = (r.domain, r.lang or "", r.source or "")
        tokens[leaf] = tokens.get(leaf, 0) + len(brute.WORD.findall(r.text or ""))
    leaves = odd.sparkSession.createDataFrame(
        [(*k, v) for k, v in tokens.items()], "domain string, lang string, source string, tokens long")
    for budget in (0, 500, 3000, 9000, 10 ** 9):
        plan = {(r.domain, r.lang, r.source): r for r in mixing.leaf_budgets(leaves, budget).collect()}
        assert sum(r.budget for r in plan.values()) == min(budget, 2 * sum(tokens.values()))
        want = tree(tokens, min(budget, 2 * sum(tokens.values())))
        for k, r in plan.items():
            assert abs(r.budget - want[k]) <= 3.01, (budget, k)
            assert r.epochs * r.tokens + r.prefix == r.budget <= 2 * r.tokens


def tree(tokens, budget):
    """Continuous hierarchical water-filling by bisection."""
    def divide(give, kids):
        lo, hi = 0.0, 1e12
        for _ in range(200):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if sum(min(c, w * mid) for c, w in kids) < give else (lo, mid)
        return [min(c, w * hi) for c, w in kids]
    out = {}
    cap = lambda pre: sum(2 * v for k, v in tokens.items() if k[: len(pre)] == pre)

    def go(pre, give):
        if len(pre) == 3:
            out[pre] = give
            return
        table = [mixing.DOMAIN_WEIGHTS, mixing.LANG_WEIGHTS, {}][len(pre)]
        kids = sorted({k[: len(pre) + 1] for k in tokens if k[: len(pre)] == pre})
        for kid, got in zip(kids, divide(give, [(cap(k), table.get(k[-1], 1)) for k in kids])):
            go(kid, got)
    go((), budget)
    return out


def test_mix_prefixes(odd, pairs):
    rows = mixed(odd, share=0.5)
    spent = Counter()
    for r in rows:
        spent[(r["domain"], r["lang"], r["source"])] += r["tokens"] * r["copies"]
    assert all(0 < r["copies"] <= 2 for r in rows)
    total = sum(len(brute.WORD.findall(t or "")) for _, t in pairs)
    assert sum(spent.values()) <= total // 2
    assert Counter(map(str, rows)) == Counter(map(str, mixed(odd.repartition(3), share=0.5)))
    out = mixing.mixed_rows(odd, mixing.mix(odd, share=2.0))
    assert out.columns == odd.columns
    with_words = lambda rows: Counter(t for t in rows if brute.WORD.search(t or ""))
    twice = with_words(t for _, t in pairs)
    assert with_words(r.text for r in out.collect()) == twice + twice


# 6 -----------------------------------------------------------------------

def test_license_base(odd, pairs, real, real_pairs):
    for docs, rows in ((odd, pairs), (real, real_pairs)):
        got = Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)
                      for r in license_scan.report(docs).collect())
        assert got == Counter((i, *brute.license_base(t)) for i, t in rows)


def test_license_spans(spark):
    gpl = "this work is licensed under the gnu general public license version 3"
    rows = [(1, f"Intro. {gpl.title()}. Outro"), (2, gpl.replace("work", "fine work")),
            (3, "this work is licensed under nothing version 3"), (4, "released under the MIT license!"),
            (5, f"{gpl} and {gpl}"), (6, "Licensed under CC BY-NC 4.0."),
            (7, " ".join(reversed(gpl.split()))), (8, "the gnu license version 3 is general public")]
    got = {r.doc_id: r for r in license_scan.report(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].labels == "gpl,gpl-3.0" and got[1].score == 1.0 and got[1].first_word == 8
    assert got[2].labels == "gpl,gpl-3.0" and got[2].score == 1.0
    assert got[3].labels == "" and got[4].labels == "mit" and got[4].n_base == 0
    assert got[5].n_base == 2 and (got[5].first_word, got[5].last_word) == (7, 20)
    assert got[6].labels == "cc-by,cc-by-nc-4.0" and got[6].base_labels == "cc-by"
    assert got[7].labels == "" and got[8].labels == "" and got[8].score == 0.0


# 7 -----------------------------------------------------------------------

def test_quality_rules(odd, pairs, real, real_pairs):
    for docs, rows in ((odd, pairs), (real, real_pairs)):
        out = quality_rules.report(docs).collect()
        got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
                       r.base_failed) for r in out)
        assert got == Counter((i, *brute.quality(t)) for i, t in rows)
        assert not any(r.kept and r.base_failed for r in out)


def test_cascade_order_keeps_verdicts(spark, odd):
    rules = quality_rules.RULES
    measured = spark.createDataFrame(
        [(r.name, 10, i, 1.0 / (i + 1)) for i, r in enumerate(rules)],
        "rule string, n long, rejected long, seconds double")
    order = quality_rules.cascade_order(measured)
    assert [r.name for r in order] == [r.name for r in reversed(rules)]
    a = bag(quality_rules.cascade(odd, rules).select("doc_id", "kept"))
    b = bag(quality_rules.cascade(odd, tuple(reversed(rules))).select("doc_id", "kept"))
    assert a == b and {k for _, k in a} == {True, False}


def test_repeat_words_of_wide_vocabularies(monkeypatch):
    monkeypatch.setattr(quality_rules, "WIDE", 4)
    text = "a b c d e f a b c x a b y z b c d"
    assert quality_rules.Features(text.encode()).n_repeat_words == brute.quality(text)[4]


# 8 -----------------------------------------------------------------------

def test_classifier_held_out(spark):
    d = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    labels = spark.read.parquet(f"{d}/labels.parquet")
    held = F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(3)) == 0
    out = quality_model.classify(docs, labels.where(~held))
    rows = out.join(labels.where(held), "doc_id").select("keep", "quality").collect()
    good = [r.keep for r in rows if r.quality == 1]
    bad = [r.keep for r in rows if r.quality == 0]
    assert len(bad) > 100
    assert sum(good) / len(good) > 0.99 and sum(bad) / len(bad) < 0.25


def test_sites_shrink(spark):
    rows = [(f"h{i % 3}", f"p{i % 2}", 0.9 if i % 3 else 0.2) for i in range(600)] + [("rare", "p", 0.0)]
    scored = spark.createDataFrame(rows, "host string, path string, p double")
    sites, worth, mean = quality_model.site_posteriors(scored)
    by = {(r.host, r.path): r for r in sites.collect()}
    assert worth >= 1 and 0.6 < mean < 0.7
    assert abs(by["h0", "p0"].host_posterior - 0.2) < 0.05        # a large site speaks for itself
    assert by["rare", "p"].host_posterior > 0.2 * mean            # a sparse one stays near the mean
    assert by["h1", "p1"].n == 100


def test_classifier_without_labels(odd, spark, nothing):
    none = spark.createDataFrame([], "doc_id long, quality int")
    out = quality_model.classify(odd, none)
    assert out.count() == odd.count() and out.where("not keep").count() == 0
    half = spark.createDataFrame([(4, None), (None, 0), (5, 1), (5, 0), (6, 1)], "doc_id long, quality int")
    assert quality_model.classify(odd, half).count() == odd.count()
    assert quality_model.keep_good(odd, half).columns == odd.columns


# 9 -----------------------------------------------------------------------

@pytest.mark.parametrize("window,prefix,group_rows", [(35, 8, 20_000), (35, 8, 2), (6, 2, 3), (6, 5, 20_000)])
def test_substrings(odd, pairs, real, real_pairs, window, prefix, group_rows):
    for docs, rows in ((odd, pairs), (real, real_pairs)):
        out = substring.substring_dedup(docs, window=window, prefix=prefix, group_rows=group_rows)
        want = Counter(brute.substrings(rows, window))
        assert bag(out.select("doc_id", "n_words", "n_removed", "kept_sha256")) == want
        assert sum(n for _, _, n, _ in want) > 0


@pytest.mark.parametrize("window,prefix,group_bytes", [(35, 8, 3000), (35, 8, 600), (12, 3, 400)])
def test_substrings_of_one_phrase(spark, window, prefix, group_bytes):
    """A phrase with many different surroundings: its prefix is made longer until the
    different bundles of each key fit."""
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choice("abcdefghijklmnop") + str(rng.randrange(99)) for _ in range(n))
    phrase, long, left = text(8), text(17), text(20)
    rows = [(i, f"{text(30)} {phrase} {text(30)}") for i in range(40)]
    rows += [(100 + i, f"{text(30)} {phrase} {long} {text(20)}") for i in range(40)]
    rows += [(200 + i, f"{left} {phrase} {text(7 + i % 30)}") for i in range(40)]
    rows += [(300 + i, rows[3 * i][1]) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = substring.substring_dedup(docs, window=window, prefix=prefix, group_bytes=group_bytes)
    want = Counter(brute.substrings(rows, window))
    assert bag(out.select("doc_id", "n_words", "n_removed", "kept_sha256")) == want
    d = narrow(docs).select("doc_id", "k1", "k2", "body")
    grams = d.select("k1", "k2", "body").mapInArrow(
        substring._grams(window, prefix), "g long, n long, size long, k1 long, k2 long")
    assert grams.groupBy("g").agg(F.sum("size").alias("s")).agg(F.max("s")).first()[0] > 2 * group_bytes
    bundles, _ = substring._groups(d, d, grams, window, prefix, 1000, group_bytes)
    one = bundles.where("length(words) > 0").select("g", "n", "words").distinct()
    sizes = [r.s for r in one.groupBy("g").agg(F.sum(F.length("words")).alias("s")).collect()]
    assert sizes and max(sizes) <= group_bytes


def test_longer_prefixes():
    """Parts cover the windows of the bundles lengthened, each once, and hold their prefix."""
    words = [f"{i * i % 61}".encode() for i in range(300)]
    for window, prefix in ((35, 8), (12, 3), (9, 4)):
        hot = []
        want = {s for s in range(len(words) - window + 1)}
        for length in substring.prefix_lengths(window, prefix):
            g, pos, first, last = substring.parts(words, hot, window, prefix)
            starts = [s for a, z in zip(first.tolist(), last.tolist()) for s in range(a, z + 1)]
            assert len(starts) == len(set(starts)) and set(starts) == want
            by_window = {}
            for key, a, z in zip(g.tolist(), first.tolist(), last.tolist()):
                for s in range(a, z + 1):
                    assert by_window.setdefault(tuple(words[s: s + window]), key) == key
            hot.append(g.tolist())


def test_substring_blocks(monkeypatch):
    words = [f"{i * i % 89}".encode() for i in range(400)]
    whole = substring.anchors(words)
    monkeypatch.setattr(substring, "BLOCK", 50)
    parts = substring.anchors(words)
    spread = lambda a: {(int(g), int(p), s) for g, p, f, t in zip(*a) for s in range(f, t + 1)}
    assert spread(whole) == spread(parts)


# 10 ----------------------------------------------------------------------

def test_bpe_equals_the_library(odd, pairs, real, real_pairs):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(bpe.vocabulary_path())
    for docs, rows in ((odd, pairs), (real, real_pairs)):
        want = Counter()
        for i, text in rows:
            ids = t.encode(text or "", add_special_tokens=False).ids
            want[(i, len(ids), brute.sha(" ".join(map(str, ids))),
                  brute.sha(t.decode(ids, skip_special_tokens=False)))] += 1
        assert bag(bpe.digests(docs)) == want
    enc = bpe.decode(bpe.encode(odd)).collect()
    got = Counter((r.doc_id, r.n_tokens, brute.sha(" ".join(map(str, r.ids))), brute.sha(r.decoded))
                  for r in enc)
    assert got == Counter(tuple(r) for r in bpe.digests(odd).collect())


def test_bpe_on_strange_texts():
    from tokenizers import Tokenizer
    with open(bpe.vocabulary_path(), encoding="utf-8") as f:
        e = bpe.Encoder(f.read())
    t = Tokenizer.from_file(bpe.vocabulary_path())
    rng = random.Random(1)
    pools = ["abcdefghij 's't \n\t.,!-_0123", "éàÀßẞİıſKḰ̈ ñ", "日本語カナ ١٢٣ ßΑΣς ǅ",
             "🙂👍🏽‍  \x00\x1f\x7f\x85 a", "<|endoftext|> <|startoftext|x", "aaaaaaabbbb'll'VE"]
    for n in range(3000):
        text = "".join(rng.choice(rng.choice(pools)) for _ in range(rng.randrange(40)))
        if n % 7 == 0:
            text += "<|endoftext|>" + text[:3]
        want = t.encode(text, add_special_tokens=False).ids
        assert e.encode(text).tolist() == want, repr(text)
        assert e.decode(want) == t.decode(want, skip_special_tokens=False)


def test_forced_boundaries():
    with open(bpe.vocabulary_path(), encoding="utf-8") as f:
        e = bpe.Encoder(f.read())
    word = "hello" + chr(0x65E5) * 3 + "qzxj"
    symbols = "".join(e.table[b] for b in word.encode())
    parts = e.fragments(symbols)
    assert "".join(parts) == symbols and len(parts) > 1
    for a, b in zip(parts, parts[1:]):
        assert not any(a[-1] + b[0] in t for t in e.vocab)


def test_bpe_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 3)
    with open(bpe.vocabulary_path(), encoding="utf-8") as f:
        e = bpe.Encoder(f.read())
    a = e.encode("many different words here so that the cache overflows again and again").tolist()
    assert len(e.by_word) <= 3 and len(e.by_word.older) <= 3 and len(e.by_chunk) <= 3
    assert a == e.library.encode("many different words here so that the cache overflows again and again").ids
    long = "ab" * bpe.CACHED_CHARS + "9z" * bpe.CACHED_CHARS
    assert e.encode(long).tolist() == e.library.encode(long).ids
    known = [*e.by_word, *e.by_word.older, *e.by_chunk, *e.by_chunk.older]
    assert max(map(len, known)) <= bpe.CACHED_CHARS


# all ---------------------------------------------------------------------

def every(docs, labels):
    return {
        1: simhash.near_dup_groups(docs), 11: simhash.keep_one_per_group(docs),
        2: line_dedup.digests(docs, line_dedup.keep_bitmaps(docs)),
        12: line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs)),
        3: winnow.edit_report(docs), 13: winnow.fingerprints(docs), 4: sharding.shard_documents(docs),
        5: mixing.mix(docs), 15: mixing.mixed_rows(docs, mixing.mix(docs)), 6: license_scan.report(docs),
        7: quality_rules.report(docs), 8: quality_model.classify(docs, labels),
        18: quality_model.keep_good(docs, labels), 9: substring.substring_dedup(docs),
        10: bpe.digests(docs), 20: bpe.encode(docs)}


def test_empty_tables(spark, nothing):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for n, df in every(nothing, labels).items():
        assert df.collect() == [], n


def test_clashing_columns(spark, odd, clashing):
    labels = spark.createDataFrame([(4, 1), (12, 0), (16, 0), (6, 1)], "doc_id long, quality int")
    plain, more = every(odd, labels), every(clashing, labels)
    for n in plain:
        a, b = plain[n], more[n]
        if n in (11, 12, 15, 18):
            assert b.columns == clashing.columns
            b = b.select(*a.columns)
        assert Counter(map(str, a.collect())) == Counter(map(str, b.collect())), n
