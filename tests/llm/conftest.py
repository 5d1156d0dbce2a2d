import random

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def odd_rows():
    """Nulls, blanks, ties, repeated rows, long texts, copies and near copies."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)] + ["É", "ß", "naïve", "İx", "ΑΣ", "日本", "🙂"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base, passage = text(120), text(60)
    rows = [(1, None), (2, ""), (3, "   \n\t "), (4, "One"), (5, "one TWO"), (None, "no id here"),
            (None, None), (6, base), (7, base), (7, base), (8, base.upper()), (9, base + " tail"),
            (10, text(30) + " " + passage + " " + text(20)), (11, passage + "\n" + text(50)),
            (12, "same " * 80), (13, "a\n\n a \nA\n" + text(60)),
            (14, text(5000) + "\n" + passage), (15, "Licensed under CC BY-NC 4.0."),
            (16, "x" * 5000), (17, "<|endoftext|> don't <|startoftext|>It's 12 o'clock"),
            (18, "cc by cc by all rights reserved General Public License"), (-5, "negative id")]
    rows += [(100 + i, "shared line\n" + text(4) + "\n shared LINE \n\nonly " + str(i)) for i in range(14)]
    rows += [(200 + i, text(3) + "\nnine of these\n" + text(3)) for i in range(9)]
    rows += [(300 + i, base + f" {i}") for i in range(12)]
    return [(i, t, ["en", "de", None, ""][n % 4], [f"src{n % 9}", None, "src0"][n % 3],
             None if t is None else len(t)) for n, (i, t) in enumerate(rows)]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def pairs():
    return [(r[0], r[1]) for r in odd_rows()]


@pytest.fixture(scope="session")
def real(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def real_pairs(real):
    return [(r.doc_id, r.text) for r in real.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(odd):
    """Extra columns named like the operators' own."""
    names = ["k1", "k2", "body", "fp", "g", "d", "c", "size", "shard", "slot", "pos", "o", "keep",
             "tokens", "copies", "domain", "words", "x", "p", "host", "path", "n_words"]
    return odd.withColumns({n: F.lit("extra") for n in names})
