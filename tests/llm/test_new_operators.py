"""Embedding whitening, tokenizer alignment and MinHash near-dedup against brute force."""

import math
import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfscan.llm import alignment, minhash, whitening
from shelfscan.llm.queries import QUERIES
from tests.llm import brute
from tests.llm.conftest import SCHEMA, SF


def bag(df):
    return Counter(tuple(r) for r in df.collect())


# 11 ------------------------------------------------------------------------

@pytest.mark.parametrize("kind", ["spread", "steep", "repeated", "low rank"])
@pytest.mark.parametrize("dims", [1, 3, 20, 48])
def test_leading_pairs_equal_dense_ones(dims, kind):
    rng = np.random.default_rng(dims)
    q, _ = np.linalg.qr(rng.standard_normal((dims, dims)))
    values = {"spread": rng.random(dims) * 1e3, "steep": 10.0 ** -np.linspace(0, 10, dims),
              "repeated": np.repeat(rng.random(dims // 4 + 1), 4)[:dims],
              "low rank": np.r_[np.zeros(dims // 2), np.ones(dims - dims // 2)]}[kind]
    v = (q * values) @ q.T
    v = (v + v.T) / 2
    e, x = whitening.leading(v, 16)
    want = np.sort(values[values > 1e-12])[::-1][:16]
    assert np.allclose(e, want, rtol=0, atol=1e-13 * want[0])
    assert np.abs(v @ x - x * e).max() < 1e-13 * want[0]
    assert np.abs(x.T @ x - np.eye(len(e))).max() < 1e-13


def test_inertia_counts():
    rng = np.random.default_rng(3)
    a = rng.standard_normal((30, 30))
    a = a + a.T
    e = np.linalg.eigvalsh(a)
    for s in [*rng.uniform(-15, 15, 40), 0.0]:
        assert whitening.count_above(a, s) == (e > s).sum()
    assert whitening.count_above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1     # no pivot on the diagonal


def test_exact_products():
    rng = np.random.default_rng(4)
    y = rng.integers(-(1 << 41), 1 << 41, (50, 4))
    want = [[sum(int(a) * int(b) for a, b in zip(y[:, i], y[:, j])) for j in range(4)] for i in range(4)]
    assert whitening.exact_products(y).tolist() == want


def dense_whitening(rows):
    """{id: (deviation, whitened)} and explained, exact up to the eigenpairs."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [tuple(math.floor(64 * c) + 1_000_000 for c in v) for _, v in kept]
    fit = sorted(set(x))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    z = [[Fraction(n * a - s, n) for a, s in zip(f, sums)] for f in fit]
    d = len(sums)
    v = np.array([[float(sum(r[i] * r[j] for r in z) / n) for j in range(d)] for i in range(d)])
    e, y = np.linalg.eigh(v)
    e, y = e[::-1][:16], y[:, ::-1][:, :16]
    return n, e / np.trace(v), [(i, sum((n * a - s) ** 2 for a, s in zip(f, sums)),
                                 (np.array([float(Fraction(n * a - s, n)) for a, s in zip(f, sums)]) @ y) / np.sqrt(e))
                                for (i, _), f in zip(kept, x)]


def assert_whitened(got, rows):
    n, explained, want = dense_whitening(rows)
    by_row = {}
    for r in got:
        assert (r.n, r.explained) == (n, pytest.approx(explained[r.component - 1], rel=1e-9))
        assert r.identity_error < 1e-9
        by_row.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r.whitened)
    first = np.array([[by_row[i, d][c + 1][0] for c in range(len(explained))] for i, d, _ in want])
    dense = np.array([w for *_, w in want])
    signs = np.sign((first * dense).sum(axis=0))
    assert np.abs(first * signs - dense).max() < 1e-8
    assert len(got) == len(want) * len(explained)


def test_whitening_of_the_table(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    assert_whitened(QUERIES["op11_embedding_whitening"](spark, SF).collect(),
                    [(r.vec_id, r.embedding) for r in table.collect()])


def test_whitening_of_odd_rows(spark):
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-3, 3) * (k + 1) for k in range(5)]) for i in range(60)]
    rows += [(7, rows[7][1]), (None, rows[8][1]), (90, None), (91, [1.0, None, 1.0, 1.0, 1.0]),
             (92, [float("nan")] * 5), (93, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (94, [-0.001] * 5)]
    rows += [(200 + i, rows[3][1]) for i in range(300)]         # a hot vector is fitted once
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    clash = df.withColumns({c: F.lit("extra") for c in ("x", "v", "n", "component", "i")})
    assert_whitened(whitening.whiten(clash).collect(), rows)
    short = spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0]), (3, [])], df.schema)
    padded = spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 0.0]), (3, [0.0, 0.0])], df.schema)
    assert bag(whitening.whiten(short)) == bag(whitening.whiten(padded)) and whitening.whiten(short).count() == 6
    huge = spark.createDataFrame([(1, [1e300, 2.0]), (2, [3.0, -1e300])], df.schema)
    assert {r.deviation for r in whitening.whiten(huge).collect()} == {None}


def test_whitening_without_spread(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [])]):
        out = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
        assert out.columns[0] == "vec_id" and out.count() == 0


# 12 ------------------------------------------------------------------------

@pytest.fixture(scope="module")
def tokenizers_of():
    import sentencepiece
    from tokenizers import Tokenizer
    a, b = alignment.default_paths()
    first = Tokenizer.from_file(a)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=b)
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    byte = {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}
    a_bytes = {i: bytes(byte[c] for c in t) if set(t) <= set(byte) else t.encode()
               for t, i in first.get_vocab().items()}
    pieces = [second.id_to_piece(i) for i in range(second.vocab_size())]
    b_bytes = [bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode()
               for i, p in enumerate(pieces)]
    return (lambda t: first.encode(t, add_special_tokens=False).ids), second.encode, a_bytes, b_bytes


TEXTS = ["  two  spaces ", "\n\nx\n y", " ", "a\x00b", "½ ①  ①", "▁ a", "a ▁b c", "é" * 50,
         " <s> </s> <unk> <0x0A> <|endoftext|> x", "🙂🙂 🙂", "你好 世界　 x", "  x  y  \t z", "x" * 3000,
         "a a  a   a\r\n b", "İ Σς ffi ﬁ", "́ a ́b", "it's 'tis don't I'LL.", "end. Next, é! x; y: z?", " a", "a ",
         "0 , 0. ٣, _. _, ².", "abab " * 500, "a" * 4001 + " b"]


def test_alignment(odd, pairs, real, real_pairs, spark, tokenizers_of):
    rng = random.Random(8)
    texts = TEXTS + ["".join(rng.choice(" abé\n\t🙂好'1.,") for _ in range(rng.randrange(1, 40)))
                     for _ in range(200)]
    made = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in made], SCHEMA).repartition(3)
    for docs, rows in ((df, made), (odd, pairs), (real, real_pairs)):
        want = Counter(brute.aligned(rows, *tokenizers_of))
        assert bag(alignment.align(docs)) == want
    # every pair looked up by the join, and all but a few broadcast
    assert bag(alignment.align(df, frequent=1)) == bag(alignment.align(df, frequent=1 << 40))


def test_alignment_of_large_groups_and_caches(monkeypatch, tokenizers_of):
    first, second = (open(p, "rb").read() for p in alignment.default_paths())
    monkeypatch.setattr(alignment, "SMALL", 1)
    monkeypatch.setattr(alignment, "CACHE", 5)
    monkeypatch.setattr(alignment, "TOGETHER", 3)
    aligner = alignment.Aligner(first.decode(), second)
    want = brute.aligned(list(enumerate(TEXTS)), *tokenizers_of)
    for _ in range(2):
        got = [aligner.document(aligner.facts([t])[0]) for t in TEXTS]
        assert [g[:5] for g in got] == [(*w[1:5], w[7]) for w in want]
        assert all(len(set(g[5].tolist())) == len(g[5]) and g[6].sum() == g[3] for g in got)


def test_alignment_of_a_very_long_text(tokenizers_of):
    first, second = (open(p, "rb").read() for p in alignment.default_paths())
    aligner = alignment.Aligner(first.decode(), second)
    rng = random.Random(1)
    text = " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 9))) for _ in range(400_000))
    got = aligner.document(aligner.facts([text])[0])
    assert (got[0], got[1]) == (len(tokenizers_of[0](" " + text)), len(tokenizers_of[1](text)))


def test_alignment_of_nothing(nothing, clashing, odd):
    assert alignment.align(nothing).count() == 0
    assert bag(alignment.align(clashing)) == bag(alignment.align(odd))


# 13 ------------------------------------------------------------------------

def similar(docs, **options):
    return bag(minhash.near_dup_groups(docs, **options).select(
        "doc_id", "n_shingles", "component_id", "kept"))


def want_groups(rows):
    return Counter(brute.similar_groups(rows))


@pytest.mark.parametrize("rounds", [3, 0])
def test_near_duplicates(odd, pairs, real, real_pairs, rounds):
    assert similar(odd, rounds=rounds) == want_groups(pairs)
    assert similar(real, rounds=rounds) == want_groups(real_pairs)


def planted(seed):
    """Groups of near copies round the threshold, chains, and texts that share a passage."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    texts = []
    for size in (2, 5, 40):
        base = [word() for _ in range(120)]
        for _ in range(size):
            t = base[:]
            for _ in range(rng.randrange(5)):
                t[rng.randrange(len(t))] = word()
            texts.append(t)
    t = [word() for _ in range(100)]
    for _ in range(12):                         # each is like the one before, not like the first
        t = t[4:] + [word() for _ in range(4)]
        texts.append(t)
    passage = [word() for _ in range(60)]
    texts += [passage + [word() for _ in range(25)] for _ in range(40)]
    texts += [texts[0][:], ["one"], ["one"], ["One", "two"], []]
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed,rounds", [(1, 3), (2, 1), (3, 0)])
def test_planted_groups(spark, seed, rounds):
    rows = planted(seed)
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA).repartition(4)
    assert similar(df, rounds=rounds) == want_groups(rows)


def test_pairs_are_not_all_compared(spark, monkeypatch):
    """A group of copies with one word changed each is settled by pivots."""
    rng = random.Random(6)
    base = [f"w{rng.randrange(3000)}" for _ in range(200)]
    rows = [(i, " ".join(base[:i] + [f"x{i}"] + base[i + 1:])) for i in range(200)]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA)
    seen = []
    confirm = minhash.confirm
    monkeypatch.setattr(minhash, "confirm", lambda p, s, t: seen.append(p.count()) or confirm(p, s, t))
    assert {r.component_id for r in minhash.near_dup_groups(df).collect()} == {0}
    assert sum(seen) < 200 * 30 < 200 * 199 // 2


def test_half_keys_agree_as_often_as_sets():
    rng = np.random.default_rng(5)
    x = rng.integers(0, 1 << 63, 5000).astype(np.uint64)
    a, b = x[:4500], x[500:]                    # similarity 0.8
    same = (minhash.half_keys(a, 1, 400) == minhash.half_keys(b, 1, 400)).mean()
    assert abs(same - 0.8) < 0.05


def test_minhash_of_nothing(nothing, clashing, odd):
    assert minhash.near_dup_groups(nothing).count() == 0
    assert similar(clashing) == similar(odd)


# shared ----------------------------------------------------------------------

def test_likely_rows_lose_none(spark):
    from shelfscan.llm import common
    keyed = spark.range(3000).select(F.xxhash64("id").alias("k1"), F.xxhash64("id", F.lit(1)).alias("k2"), "id")
    wanted = keyed.where("id % 30 = 0").select("k1", "k2")
    got = common.likely_rows(keyed, wanted)
    assert got.columns == keyed.columns
    ids = {r.id for r in got.collect()}
    assert {i for i in range(0, 3000, 30)} <= ids and len(ids) < 110
    assert common.likely_rows(keyed, wanted.limit(0)).count() == 0


def test_sharding_of_equal_rows(spark, monkeypatch):
    """Very many equal rows without an id: a sample of them reaches the driver, and no range holds
    them all."""
    from shelfscan.llm import sharding
    seen = []
    draw = sharding._draw
    monkeypatch.setattr(sharding, "_draw", lambda *a: seen.append(draw(*a)) or seen[-1])
    monkeypatch.setattr(sharding, "ROWS_PER_RANGE", 500)
    rows = [(None, "the same text")] * 6000 + [(i, f"text {i}") for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = sharding.shard_documents(df, 8).collect()
    assert sum(map(len, seen)) < 256 * 32 * 3
    size, slots = [0] * 8, [[] for _ in range(8)]
    for r in out:
        size[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert max(size) - min(size) <= 2 * 14 and [sorted(s) for s in slots] == [list(range(len(s))) for s in slots]
    keys = df.select(F.lit(1).cast("long").alias("g"), F.lit(2).cast("long").alias("d"),
                     F.xxhash64(F.monotonically_increasing_id()).alias("t"), F.lit(1).cast("long").alias("size")).cache()
    _, counts = sharding._ranges(keys, 20, 12_000)
    assert max(n for n, _ in counts) <= 2 * sharding.OVERFULL * 12_000 / 20


def test_documents_without_an_id_have_places_of_their_own(spark):
    from shelfscan.llm import mixing
    df = spark.range(3000).select(F.xxhash64("id").alias("k1"), F.xxhash64("id", F.lit(1)).alias("k2"))
    place = mixing.order_of(F.lit(1), F.lit(None).cast("long"), F.col("k1"), F.col("k2"))
    assert df.select(place.alias("o")).distinct().count() == 3000
    with_id = spark.range(5).select(mixing.order_of(F.lit(1), F.col("id")).alias("a"),
                                    mixing.order_of(F.lit(1), F.col("id"), F.lit(9)).alias("b"))
    assert all(r.a == r.b for r in with_id.collect())


# licenses --------------------------------------------------------------------

def test_edited_licenses_are_found_and_others_are_not(spark):
    """Every statement and notice with a word put in at every place, long ones with one left out,
    among texts that share much with them."""
    from shelfscan.llm import license_scan
    rng = random.Random(12)
    filler = lambda n: " ".join(rng.choice(["lorem", "ipsum", "dolor", "sit", "the", "of", "license"]) for _ in range(n))
    rows, truth = [], []
    for phrase, label, is_base, k in license_scan.templates():
        if is_base:
            continue
        words = phrase.split()
        edits = [words] + [words[:i] + ["well"] + words[i:] for i in range(1, len(words))]
        if len(words) > 16:
            edits += [words[:i] + words[i + 1:] for i in range(1, len(words) - 1)]
        for e in edits:
            rows.append((len(rows), f"{filler(9)}. {' '.join(e).title()}; {filler(7)}"))
            truth.append(label)
    n = len(rows)
    rows += [(n + i, f"{filler(20)} licensed under the terms of a license {filler(20)} software version") for i in range(100)]
    rows += [(n + 100 + i, " ".join(rng.sample(license_scan.NOTICES["mit"][0].split(), 30))) for i in range(50)]
    out = {r.doc_id: set(r.labels.split(",")) - {"", "gpl", "cc-by", "reserved"} for r in license_scan.report(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    hit = sum(truth[i] in out[i] for i in range(n))
    named = sum(len(v) for v in out.values())
    right = sum(truth[i] in out[i] for i in range(n))
    assert hit >= 0.95 * n and right >= 0.95 * named
    assert all(not out[i] for i in range(n, len(rows)))


def test_merging_diagonals_decides(spark, monkeypatch):
    """Words put in shift the rest of a notice: no diagonal alone covers enough, the merged ones do."""
    from shelfscan.llm import license_scan
    words = license_scan.NOTICES["gpl-3.0"][0].split()
    text = " ".join(words[:18] + ["truly"] + words[18:])
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    found = license_scan.report(df).first()
    assert found.labels == "gpl,gpl-3.0"
    spans = license_scan.scan(df)[1].where("label = 'gpl-3.0'").collect()
    assert len(spans) == 1 and 0 < spans[0].coverage < 1
    assert spans[0]["last"] - spans[0]["first"] + 1 == len(words) + 1
    monkeypatch.setattr(license_scan, "DRIFT", 0)
    assert license_scan.report(df).first().labels == "gpl"


# sites -----------------------------------------------------------------------

def brute_posteriors(rows, weight=0.5):
    """(p, host, path) -> (host posterior, path posterior without the own score, posterior)."""
    def worth(groups, center):
        n = [len(g) for g in groups.values()]
        mean = {k: sum(g) / len(g) for k, g in groups.items()}
        within = sum((x - mean[k]) ** 2 for k, g in groups.items() for x in g) / max(1, sum(n) - len(n))
        spread = sum(len(g) * (mean[k] - center(k)) ** 2 for k, g in groups.items())
        between = max((spread - len(n) * within) / max(1, sum(n)), 1e-6)
        return min(max(within / between, 1.0), 1e6)

    hosts, paths = {}, {}
    for p, h, q in rows:
        hosts.setdefault(h, []).append(p)
        paths.setdefault((h, q), []).append(p)
    mean = sum(p for p, *_ in rows) / len(rows)
    m = worth(hosts, lambda k: mean)
    host = {h: (sum(g) + m * mean) / (len(g) + m) for h, g in hosts.items()}
    w = worth(paths, lambda k: host[k[0]])
    logit = lambda x: math.log(min(max(x, 1e-4), 1 - 1e-4) / (1 - min(max(x, 1e-4), 1 - 1e-4)))
    out = []
    for p, h, q in rows:
        g = paths[h, q]
        path = (sum(g) - p + w * host[h]) / (len(g) - 1 + w)
        odds = logit(p) + weight * (logit(path) - logit(mean))
        out.append((host[h], path, 1 / (1 + math.exp(-odds))))
    return out


def test_posteriors_of_sites_of_unequal_size(spark, monkeypatch):
    """Large bad and good sites turn verdicts, a site of one document does not."""
    from shelfscan.llm import quality_model
    rng = random.Random(21)
    rows = []
    for host, path, n, low, high in (("good", "a", 300, 0.7, 0.99), ("good", "b", 5, 0.2, 0.5), ("bad", "a", 200, 0.02, 0.3),
                                     ("bad", "b", 40, 0.1, 0.5), ("mixed", "a", 60, 0.05, 0.95), ("mixed", "b", 3, 0.4, 0.6)):
        rows += [(round(rng.uniform(low, high), 6), host, path) for _ in range(n)]
    rows += [(0.45, "good", "a"), (0.47, "good", "a"), (0.56, "bad", "a"), (0.6, "bad", "b")]
    rows += [(0.52, f"single{i}", "x") for i in range(5)]
    df = spark.createDataFrame([(i, f"text {i}", h, q, p) for i, (p, h, q) in enumerate(rows)],
                               "doc_id long, text string, source string, lang string, p double").repartition(4)
    probability = {i: p for i, (p, *_) in enumerate(rows)}
    fixed = F.create_map(*[F.lit(x) for kv in probability.items() for x in kv])

    class Known:
        def probability(self, x):
            return F.element_at(fixed, F.col("doc_id"))

    monkeypatch.setattr(quality_model, "train", lambda *a, **k: Known())
    labels = spark.createDataFrame([], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality_model.classify(df, labels).collect()}
    turned = set()
    for i, (want, (p, host, _)) in enumerate(zip(brute_posteriors(rows), rows)):
        r = got[i]
        assert (r.host_posterior, r.path_posterior, r.posterior) == pytest.approx(want, abs=2e-6)
        if abs(want[2] - 0.5) > 1e-5:
            assert r.keep == (want[2] >= 0.5)
        if r.keep != (p >= 0.5):
            turned.add((host, r.keep))
    assert {("good", True), ("bad", False)} <= turned
    assert all(got[i].keep for i in range(len(rows) - 5, len(rows)))


def test_very_long_texts(spark):
    """One text of some 10 MB beside short ones goes through the operators on whole texts."""
    from shelfscan.llm import license_scan, line_dedup, simhash, winnow
    rng = random.Random(2)
    words = [f"w{i}" for i in range(5000)]
    long = " ".join(rng.choice(words) for _ in range(1_700_000))
    rows = [(1, long), (2, long + " end"), (3, "short text"), (4, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert len(long) > 9_000_000
    assert {r.doc_id: r.component_id for r in minhash.near_dup_groups(df).collect()} == {1: 1, 2: 1, 3: 3, 4: 4}
    assert winnow.edit_report(df).count() == 4
    assert license_scan.report(df).where("doc_id = 1").first().n_words == 1_700_000
    assert simhash.near_dup_groups(df).count() == 4
    assert line_dedup.digests(df, line_dedup.keep_bitmaps(df)).where("n_lines = 1").count() == 4
