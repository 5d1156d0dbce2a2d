"""Mixing sources to target weights by hierarchical budgeting, in DataFrame
operations only.

A token budget flows down a tree of domain, language and source.  Every node
divides its budget among its children by weight; a child takes no more than
its subtree can give (its tokens times ``max_epochs``) and what it leaves goes
to its siblings by weight.  Because a node never gets more than its subtree
holds, a shortage is made up by siblings first and reaches an ancestor's
siblings only when the whole subtree is short.

A leaf serves its budget from seeded epochs: every full epoch takes all its
documents once, and the last epoch a prefix, in that epoch's seeded order, of
the documents whose tokens fit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfscan.llm.common import cut, prepare, row_key, same

WORD = r"[^\x20\x09-\x0D]+"
LEVELS = ("domain", "lang", "source")
SEED = 17
BUCKETS = 4096          # steps of a leaf's seeded order that are summed before any row is sorted
ORDER_HEX = 15          # hex digits of the order's hash: 60 bits, never negative as a long
BIG = "decimal(38,0)"

# Target weights of the registered query (whole numbers; a node that is not
# listed weighs 1).  The documents carry no domain, so it is derived from the
# source: sources numbered below 7, below 14 and the others.
DOMAIN_WEIGHTS = {"web": 2, "books": 3, "reference": 5}
LANG_WEIGHTS = {"en": 6, "de": 2, "fr": 1, "es": 1}
SHARE = 0.6             # budget: this share of all tokens
MAX_EPOCHS = 2


def domain_of(source: Column) -> Column:
    """``web``, ``books`` or ``reference`` from the number that ends a source's name."""
    number = F.regexp_extract(F.coalesce(source, F.lit("")), r"([0-9]{1,9})$", 1)
    number = F.when(number != "", number).cast("int")
    return (F.when(number < 7, "web").when(number < 14, "books").otherwise("reference"))


def weight_of(level: str) -> Column:
    """Weight of a node among its siblings."""
    table = {"domain": DOMAIN_WEIGHTS, "lang": LANG_WEIGHTS, "source": {}}[level]
    out = F.lit(1)
    for name, weight in sorted(table.items()):
        out = F.when(F.col(level) == name, weight).otherwise(out)
    return out.cast("long")


def order_of(epoch: Column, doc_id: Column, *row: Column, seed: int = SEED) -> Column:
    """Seeded place of a document in an epoch: 60 bits of an MD5 over its id, or over ``row``
    where it has none, so that documents without an id do not share one place."""
    nameless = F.concat_ws(":", F.lit("null"), *[c.cast("string") for c in row])
    name = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"),
                       F.coalesce(doc_id.cast("string"), nameless))
    return F.conv(F.substring(F.md5(name), 1, ORDER_HEX), 16, 10).cast("long")


def share_out(children: DataFrame, parent: list[str], order: Column) -> DataFrame:
    """Adds ``budget``: the parent's ``give`` divided by ``weight`` among its
    children, none above its ``cap``.

    Children are taken in order of cap over weight: one is filled to its cap
    when the rest, divided evenly by weight, would give it at least that; the
    others share what is left.  All whole numbers: leftovers of rounding go
    out by running sums, so a parent's budget is given away exactly.
    """
    w = Window.partitionBy(*parent).orderBy(F.col("cap").cast("double") / F.col("weight"), order)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    after = w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy(*parent)
    big = lambda c: F.col(c).cast(BIG)
    x = (children.withColumn("taken", F.coalesce(F.sum("cap").over(before), F.lit(0)).cast("long"))
         .withColumn("open", F.sum("weight").over(after).cast("long")))
    # cap / weight <= (give - taken) / open, in whole numbers
    fits = big("cap") * big("open") <= (big("give") - big("taken")) * big("weight")
    x = x.withColumn("full", fits & (F.col("cap") <= F.col("give")))
    # once one is not full, none after it is
    x = x.withColumn("full", F.min("full").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    x = (x.withColumn("rest", F.col("give") - F.coalesce(
        F.sum(F.when(F.col("full"), F.col("cap"))).over(whole), F.lit(0)))
        .withColumn("open", F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(whole))
        .withColumn("upto", F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(
            w.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    part = lambda upto: F.expr(
        f"(cast(rest as {BIG}) * cast({upto} as {BIG})) div cast(open as {BIG})")
    given = F.when(F.col("full"), F.col("cap")).otherwise(part("upto") - part("upto - weight"))
    return x.withColumn("budget", given.cast("long")).drop("taken", "open", "full", "rest", "upto")


def leaf_budgets(leaves: DataFrame, budget: int, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``domain, lang, source, tokens, budget, epochs, prefix`` per leaf, from
    ``domain, lang, source, tokens``: ``epochs`` full passes and a prefix of
    ``prefix`` tokens."""
    caps = leaves.withColumn("cap", (F.col("tokens") * max_epochs).cast("long"))
    level = None
    for depth, name in enumerate(LEVELS):
        path = list(LEVELS[: depth + 1])
        node = caps.groupBy(*path).agg(F.sum("cap").cast("long").alias("cap"))
        node = node.withColumn("weight", weight_of(name))
        if level is None:
            node = node.withColumn("give", F.least(
                F.lit(budget).cast("long"),
                F.sum("cap").over(Window.partitionBy(F.lit(1))).cast("long")))
            level = share_out(node, ["give"], F.col(name))
        else:
            up = level.select(*path[:-1], F.col("budget").alias("give"))
            level = share_out(node.join(up, path[:-1]), path[:-1], F.col(name))
        level = level.select(*path, "budget")
    return leaves.join(level, list(LEVELS)).withColumns({
        "epochs": F.expr("case when tokens > 0 then budget div tokens else 0 end"),
        "prefix": F.expr("case when tokens > 0 then budget % tokens else 0 end")})


def mix(docs: DataFrame, budget: int | None = None, share: float = SHARE,
        max_epochs: int = MAX_EPOCHS, seed: int = SEED, id_col: str = "doc_id",
        text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``doc_id, k1, k2, domain, lang, source, tokens, copies`` for every
    document that the mix takes; ``copies`` is how many epochs take it.

    ``budget`` counts tokens (white-space words); by default ``share`` of all.
    Null languages and sources are the empty name.  Rows that repeat a
    document are taken together, each as often as ``copies`` says, and their
    tokens count each time.  Documents without tokens cost nothing: they
    come with full epochs and with a prefix that they precede.  An empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    did, text = docs[id_col].cast("long"), docs[text_col]
    rows = cut(docs.select(
        did.alias("doc_id"), *row_key(did, text), domain_of(docs[source_col]).alias("domain"),
        F.coalesce(docs[lang_col], F.lit("")).alias("lang"),
        F.coalesce(docs[source_col], F.lit("")).alias("source"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("tokens"))
        .groupBy("doc_id", "k1", "k2", *LEVELS).agg(F.sum("tokens").alias("tokens")))
    leaves = rows.groupBy(*LEVELS).agg(F.sum("tokens").cast("long").alias("tokens"))
    if budget is None:
        total = rows.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
        budget = int(total * share)
    plan = cut(leaf_budgets(leaves, budget, max_epochs)
               .select(*LEVELS, "epochs", "prefix"))
    placed = rows.join(plan, list(LEVELS)).withColumn(
        "o", order_of(F.col("epochs"), F.col("doc_id"), F.col("k1"), F.col("k2"), seed=seed))
    step = (1 << (4 * ORDER_HEX)) // BUCKETS
    placed = placed.withColumn("b", F.expr(f"o div {step}L"))
    # Running tokens per step of each leaf's order; only the step where the
    # prefix ends is looked at row by row.
    steps = placed.groupBy(*LEVELS, "b").agg(F.sum("tokens").alias("t"))
    w = Window.partitionBy(*LEVELS).orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    steps = steps.withColumn("before", F.coalesce(F.sum("t").over(w), F.lit(0)))
    placed = placed.join(steps, [*LEVELS, "b"])
    sure = (F.col("prefix") > 0) & (F.col("before") + F.col("t") <= F.col("prefix"))
    row = Window.partitionBy(*LEVELS, "b").orderBy("o", "doc_id", "k1", "k2").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    edge = (placed.where((F.col("prefix") > 0) & ~sure & (F.col("before") <= F.col("prefix")))
            .withColumn("in", F.col("before") + F.sum("tokens").over(row) <= F.col("prefix")))
    rest = (placed.where((F.col("prefix") == 0) | sure | (F.col("before") > F.col("prefix")))
            .withColumn("in", sure))
    cols = ["doc_id", "k1", "k2", *LEVELS, "tokens"]
    out = edge.unionByName(rest).select(
        *cols, (F.col("epochs") + F.col("in").cast("long")).cast("int").alias("copies"))
    return out.where("copies > 0")


def mixed_rows(docs: DataFrame, taken: DataFrame, id_col: str = "doc_id",
               text_col: str = "text", lang_col: str = "lang",
               source_col: str = "source") -> DataFrame:
    """Rows of ``docs`` that the mix takes, each ``copies`` times."""
    k1, k2 = row_key(docs[id_col].cast("long"), docs[text_col])
    keyed = docs.select("*", k1.alias("_k1"), k2.alias("_k2"),
                        F.coalesce(docs[lang_col], F.lit("")).alias("_lang"),
                        F.coalesce(docs[source_col], F.lit("")).alias("_source"))
    facts = taken.select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"),
                         F.col("lang").alias("_lang"), F.col("source").alias("_source"),
                         F.col("copies").alias("_copies"))
    kept = keyed.join(facts, ["_k1", "_k2", "_lang", "_source"])
    return (kept.withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
            .select(*same(docs)))
