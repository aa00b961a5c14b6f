"""Print the physical plans of the main operators (used to write PLANS.md).

Run: python tests/show_plans.py [sf_dir]   (saves indexes to a scratch folder)
"""

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

import vecspark as vs  # noqa: E402
from vecspark.operators import kmeans as km  # noqa: E402
from vecspark.session import local_session  # noqa: E402
from vecspark.sources.tables import embeddings  # noqa: E402


def show(title, df):
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    tree = plan.split("\n\n")[0]
    scans = [ln for ln in plan.splitlines() if re.match(r"^(PushedFilters|PartitionFilters|ReadSchema):", ln)]
    print(f"### {title}\n\n```\n{tree.strip()}\n" + "\n".join(scans) + "\n```\n")


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    emb = embeddings(spark, sf)
    root = tempfile.mkdtemp(prefix="vecspark-plans-")
    vs.save_index(vs.build_index(emb, 64, tag_columns=["label"]), f"{root}/flat")
    vs.save_index(vs.build_index(emb, 64, "ivf_flat", nlist=16, iterations=3, nprobe=2, shard=F.col("id") % 2),
                  f"{root}/ivf")
    vs.save_index(vs.build_index(emb, 64, "ivf_pq", nlist=4, m=8, ks=16, iterations=2, nprobe=2), f"{root}/pq")
    flat, ivf, pq = (vs.load_index(spark, f"{root}/{n}") for n in ("flat", "ivf", "pq"))
    q = emb.select("id", "vector")
    show("Exact 10-NN with a tag filter (broadcast query batch, postings scanned in place)",
         vs.knn(flat, q, 10, where=F.col("label") == 3))
    show("IVF 10-NN, nprobe 2, per-shard index (probe, then probed lists only)", vs.knn(ivf, q, 10))
    show("IVF 10-NN, tiled plan (neither side broadcast)", vs.knn(ivf, q, 10, strategy="tiled"))
    show("IVF-PQ 10-NN (codes decoded in place)", vs.knn(pq, q, 10))
    train = emb.select(F.lit(0).alias("shard_id"), F.col("id").alias("_id"), F.col("vector").alias("_v"))
    cents = ivf.centroids.where("shard_id = 0")
    show("One Lloyd iteration (assignment + partial sums in the task, narrow aggregate)",
         km.combine_sums(km.partial_sums(train, cents, dim=64, metric="l2", group_keys=["shard_id"]), cents,
                         dim=64, group_keys=["shard_id"]))
    local = vs.knn(ivf, q, 10, scope="shard")
    lists = local.groupBy("query_idx", "shard_id").agg(
        F.array_sort(F.collect_list(F.struct("ranking", "vector_idx", "distance"))).alias("s")).select(
        "query_idx", F.expr("transform(s, x -> x.vector_idx)").alias("idxs"),
        F.expr("transform(s, x -> x.distance)").alias("distances"))
    show("Merge of per-shard top-k lists (partial top-k below the exchange)", vs.rank_lists(lists, 10, by=["query_idx"]))
    spark.stop()


if __name__ == "__main__":
    main()
