"""Run page extraction and the row index with injected first-attempt task
failures on a retrying local master; print a JSON summary.

Run as a separate process (it needs its own SparkContext)."""

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession, functions as F  # noqa: E402


def main():
    sf, ckpt, marks = sys.argv[1], sys.argv[2], sys.argv[3]
    spark = (SparkSession.builder.master("local[4,3]")      # up to 3 attempts per task
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", "6").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    spark.sparkContext.setCheckpointDir(ckpt)
    from shelfscan.operators import extract as X
    from shelfscan.operators.ordering import with_row_index
    from shelfscan.plans import driver_inputs as D
    from shelfscan import specs

    def flaky_rows(h):
        tc = TaskContext.get()
        if tc is not None and tc.attemptNumber() == 0 and tc.partitionId() % 2 == 1:
            open(os.path.join(marks, f"walk-{tc.stageId()}-{tc.partitionId()}"), "w").close()
            raise RuntimeError("injected loss of a parse task")
        return X.read_tiles(h, specs.TILE_ATTR)

    pages = D.attr_tile_pages(spark, sf)
    flaky = X.walk_pages(pages, ["page_id"], "html", flaky_rows, X.tile_fields(specs.TILE_ATTR))
    clean = X.explode_tiles(pages, "tile_attr")
    cols = ["page_id", "tile_pos", "product_id", "price_raw"]
    a = sorted(tuple(r) for r in flaky.select(*cols).collect())
    b = sorted(tuple(r) for r in clean.select(*cols).collect())

    @F.udf("long")
    def flaky_key(k):
        tc = TaskContext.get()
        if tc.attemptNumber() == 0 and tc.partitionId() == 0:
            open(os.path.join(marks, f"index-{tc.stageId()}-{tc.partitionId()}"), "w").close()
            raise RuntimeError("injected loss upstream of the row index")
        return k

    part = D.table(spark, sf, "part").select(
        flaky_key("p_partkey").alias("k"), F.lower("p_type").alias("category"),
        F.col("p_retailprice").alias("price"))
    idx = with_row_index(part, ["price", "k"], ["category"], "rn")
    got = {r.k: r.rn for r in idx.collect()}
    rows = sorted(((r.category, r.price, r.k) for r in part.collect()))
    want, seen = {}, {}
    for c, p, k in rows:
        want[k] = seen.get(c, 0)
        seen[c] = want[k] + 1
    fired = sorted(os.listdir(marks))
    print(json.dumps({"tiles_equal": a == b, "n_tiles": len(a), "index_equal": got == want,
                      "n_rows": len(got),
                      "walk_failures": sum(f.startswith("walk") for f in fired),
                      "index_failures": sum(f.startswith("index") for f in fired)}))
    spark.stop()


if __name__ == "__main__":
    main()
