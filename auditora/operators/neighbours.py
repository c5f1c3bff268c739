"""Exact nearest texts by cosine over an inverted index, with lists of common grams left out where their weights cannot matter.

Every gram has a list of the training texts that hold it, its length and its
greatest weight.  Open lists (at most `longest` entries) of a query give partial
similarities, the k-th best of which is a floor.  Of the longer lists, rarest
first, a query takes as many as it must until what the others could add at most
(the greater weights times its own, or by Cauchy-Schwarz) stays below the floor:
a text in none of the lists taken cannot be among the nearest.  Candidates whose
partial similarity plus that rest stays below the floor go; the others get their
whole similarity.  A long list is divided into parts of about `longest` entries,
so no task joins one whole.

Steps that several later ones read are written in the shared folder; scratch.release() deletes them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..scratch import written

LONGEST = 1000
# Sums of products of weights differ by the order of their terms; closer than this is equal.
SLACK = 1e-8


def lists(train: DataFrame, longest: int = LONGEST) -> DataFrame:
    """block, gram, parts (how many of about longest entries its list has), n and most (the greatest weight)."""
    seen = train.groupBy("block", "gram").agg(F.count("*").alias("n"), F.max("w").alias("most"))
    return seen.withColumn("parts", F.ceil(F.col("n") / longest).cast("int"))


def _with_part(train: DataFrame, index: DataFrame, longest: int) -> DataFrame:
    """Entries of long lists, each in its part."""
    long = index.filter(F.col("n") > longest).select("block", "gram", "parts")
    return train.join(long, ["block", "gram"]).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")).drop("parts")


def nearest(asked: DataFrame, train: DataFrame, k: int, longest: int = LONGEST) -> DataFrame:
    """block, query, id, sim and rank (from 1) of the k nearest of train that share a gram, ties (to nine places) by id.

    asked: block, query, gram, v; train: block, id, gram, w; both of length 1.  Blocks are apart from each other."""
    index = written(lists(train, longest), "gram-lists", keep=True)
    query = W.partitionBy("block", "query")
    after = query.orderBy(F.col("n"), "gram").rowsBetween(1, W.unboundedFollowing)
    most = F.least(F.coalesce(F.sum(F.col("v") * F.col("most")).over(after), F.lit(0.0)), F.sqrt(F.coalesce(F.sum(F.col("v") * F.col("v")).over(after), F.lit(0.0))))
    # Grams of each query, rarest first, and what those behind one could add at most.
    terms = written(asked.join(index, ["block", "gram"]).withColumn("rest", most), "query-grams", keep=True)
    open_ = terms.filter(F.col("n") <= longest).select("block", "gram", "query", "v").join(train, ["block", "gram"])
    partial = written(open_.groupBy("block", "query", "id").agg(F.sum(F.col("v") * F.col("w")).alias("p")), "partial-similarities", keep=True)
    # The k-th best partial similarity; without k candidates nothing can be left out.
    best = partial.withColumn("place", F.row_number().over(query.orderBy(F.desc("p")))).filter(F.col("place") <= k)
    floors = best.groupBy("block", "query").agg(F.when(F.count("*") == k, F.min("p")).otherwise(F.lit(0.0)).alias("floor"))
    # A long list is taken unless those before it leave less than the floor.
    before = F.lag("rest").over(query.orderBy(F.col("n"), "gram"))
    taken = F.col("left").isNull() | (F.col("left") + SLACK >= F.coalesce("floor", F.lit(0.0)))
    told = written(terms.withColumn("left", before).join(floors, ["block", "query"], "left").withColumn("taken", (F.col("n") <= longest) | taken), "told-grams", keep=True)
    long = told.filter(F.col("n") > longest)
    dealt = long.filter("taken").select("block", "query", "gram", "v", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    common = dealt.join(_with_part(train, index, longest), ["block", "gram", "part"]).groupBy("block", "query", "id").agg(F.sum(F.col("v") * F.col("w")).alias("p"))
    found = partial.unionByName(common).groupBy("block", "query", "id").agg(F.sum("p").alias("p"))
    # What the lists not taken could add to a candidate: the rest behind the last one taken.
    spare = told.groupBy("block", "query").agg(F.coalesce(F.min(F.when(F.col("taken"), F.col("rest"))), F.lit(0.0)).alias("spare"))
    ranked = found.join(spare, ["block", "query"]).withColumn("place", F.row_number().over(query.orderBy(F.desc("p"))))
    floor = F.max(F.when(F.col("place") == k, F.col("p"))).over(query)
    kept = ranked.withColumn("floor", floor).filter(F.col("floor").isNull() | (F.col("p") + F.col("spare") + SLACK >= F.col("floor"))).select("block", "query", "id", "p")
    kept = written(kept, "kept-candidates", keep=True)
    # Their share from the lists not taken, looked up from the candidates' side.
    skipped = long.filter(~F.col("taken")).select("block", "query", "gram", "v")
    entries = _with_part(train, index, longest).select("block", "id", "gram", "w")
    more = kept.select("block", "query", "id").join(entries, ["block", "id"]).join(skipped, ["block", "query", "gram"]).groupBy("block", "query", "id").agg(F.sum(F.col("v") * F.col("w")).alias("more"))
    sims = kept.join(more, ["block", "query", "id"], "left").select("block", "query", "id", (F.col("p") + F.coalesce("more", F.lit(0.0))).alias("sim"))
    return sims.withColumn("rank", F.row_number().over(query.orderBy(F.desc(F.round("sim", 9)), "id"))).filter(F.col("rank") <= k)
