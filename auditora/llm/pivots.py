"""Approximate nearest neighbours by a permutation index.

A vector is represented by its nearest pivots in order, by angle.  Pivot inverted
files post it under the first few of them; a query reads the files of its own
nearest pivots only.  Rows met there are ranked by the footrule distance of the
two orders, a pivot that one of them lacks counting as ranked behind all; those
within a cut are ranked again by the exact inner product in double precision.

The measure is the inner product, so a long vector may be found at a wide angle.
Rows are told apart by ranges of their norms, half an octave each, and how many
files a row is posted in and the footrule cut depend on its range.  These depths
and the number of files read are fitted on a bounded sample (SAMPLE rows, ASKED
queries of it): they are the least that reach the share GOAL of the sample's own
true neighbours, with the fewest copies of rows and queries.  Neighbours among all rows
are nearer than those of a sample, so what reaches these reaches them.  Every row
is indexed, at every size of the table; a query whose files hold fewer rows than
asked for is answered by all rows.

Postings and reads meet by pivot; long files are dealt into blocks by a hash of
the id and their readers into groups, so a task holds bounded parts of both.  A
pair that shares several files is ranked in the first of them only.

Edge cases: vectors that are null, zero or that hold null or non-finite components
take no part; vectors of different lengths have no product, so each length is
searched by itself; equal scores go to the smaller id; with fewer candidates than
asked all are found; rows that repeat an id are not candidates of each other; ids
are cast to long, null ones take no part; other columns are not read whatever
their names; a table without vectors gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import written

PIVOTS = 512
SAMPLE = 8192
ASKED = 400
GOAL = 0.96
READ_SHARES = (1 / 128, 1 / 64, 1 / 32, 1 / 16, 1 / 8, 1 / 4)
RANGES = 16
PREFIX = 32
BLOCK_ROWS = 16384
GROUP_QUERIES = 8192


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Far-apart directions of the sample: each next pivot is the one least like those before."""
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    chosen, nearest = [0], unit @ unit[0]
    while len(chosen) < min(count, len(unit)):
        k = int(np.argmin(nearest))
        if nearest[k] > 1 - 1e-12:
            break
        chosen.append(k)
        nearest = np.maximum(nearest, unit @ unit[k])
    return unit[chosen]


def permutation(vectors: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    """The nearest pivots of each vector by angle, nearest first, ties to the smaller pivot."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = -np.round(unit @ pivots.T, 12)
    if length >= len(pivots):
        return np.argsort(near, axis=1, kind="stable").astype(np.int16)
    few = np.sort(np.argpartition(near, length, axis=1)[:, : length + 1], axis=1)
    own = np.take_along_axis(near, few, axis=1)
    return np.take_along_axis(few, np.argsort(own, axis=1, kind="stable"), axis=1)[:, :length].astype(np.int16)


def ranks_of(orders: np.ndarray, pivots: int, prefix: int) -> np.ndarray:
    """Rank of every pivot with each vector, prefix where it comes behind the prefix."""
    out = np.full((len(orders), pivots), prefix, np.int16)
    np.put_along_axis(out, orders[:, :prefix], np.arange(min(prefix, orders.shape[1]), dtype=np.int16)[None, :], axis=1)
    return out


def footrule(ranks: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Footrule distance of rows, given their ranks, to a query's order, over the query's prefix."""
    return np.abs(ranks[:, order] - np.arange(len(order), dtype=np.int16)).sum(axis=1)


@dataclass
class Index:
    """What is fitted on the sample: pivots, files read, and by range of norms the files posted in and the footrule cut."""

    pivots: np.ndarray
    most: float
    read: int
    posted: np.ndarray
    cut: np.ndarray
    load: np.ndarray  # share of all rows in each file, as in the sample
    touched: float

    @property
    def prefix(self) -> int:
        return min(PREFIX, len(self.pivots))

    def ranges(self, vectors: np.ndarray) -> np.ndarray:
        ratio = self.most / np.linalg.norm(vectors, axis=1)
        return np.clip(np.floor(2 * np.log2(np.maximum(1.0, ratio)) + 1e-9), 0, RANGES - 1).astype(np.int64)


def _upward(depth: np.ndarray) -> np.ndarray:
    """Ranges of longer vectors are as deep as those of shorter ones at least."""
    return np.maximum.accumulate(depth[::-1])[::-1]


def fit(sample: np.ndarray, most: float, k: int, count: int = PIVOTS, goal: float = GOAL, asking: float = 0.05, seed: int = 0) -> Index:
    """The index that reaches goal of the sample's neighbours with the fewest copies of rows and, a share asking of them, queries.

    most is the longest norm of all."""
    index = Index(choose_pivots(sample, count), most, 1, np.ones(RANGES, np.int64), np.zeros(RANGES, np.int64), np.zeros(0), 1.0)
    m = len(index.pivots)
    orders, ranges = permutation(sample, index.pivots, m), index.ranges(sample)
    asked = np.sort(np.random.default_rng(seed).permutation(len(sample))[:ASKED])
    score = sample[asked] @ sample.T
    score[np.arange(len(asked)), asked] = -np.inf
    top = np.argsort(-score, axis=1, kind="stable")[:, : min(k, max(1, len(sample) - 1))]
    # All of a table that is asked for whole is to be found.
    goal = 1.0 if len(sample) <= k + 1 else goal
    best, least = index, np.inf
    for read in sorted({max(1, round(share * m)) for share in READ_SHARES}):
        reads = np.zeros((len(asked), m), bool)
        np.put_along_axis(reads, orders[asked][:, :read].astype(np.int64), True, axis=1)
        need = np.stack([reads[i][orders[top[i]]].argmax(axis=1) + 1 for i in range(len(asked))])
        posted = np.ones(RANGES, np.int64)
        for r in range(RANGES):
            own = need[ranges[top] == r]
            posted[r] = int(np.ceil(np.quantile(own, goal))) if len(own) else 1
        posted = _upward(posted)
        copies = posted[ranges].mean() + asking * read
        if copies < least:
            there = np.arange(posted.max())[None, :] < posted[ranges][:, None]
            touched = np.mean([(reads[i][orders[:, : posted.max()]] & there).any(axis=1).mean() for i in range(min(32, len(asked)))])
            best, least = Index(index.pivots, most, read, posted, index.cut, index.load, float(touched)), copies
    ranks = ranks_of(orders, m, best.prefix)
    distance = np.stack([footrule(ranks[top[i]], orders[asked[i], : best.prefix]) for i in range(len(asked))])
    cut = np.array([np.quantile(own, 1 - (1 - goal) / 2) if len(own := distance[ranges[top] == r]) else 0 for r in range(RANGES)])
    best.cut = _upward(np.ceil(cut).astype(np.int64))
    there = np.arange(best.posted.max())[None, :] < best.posted[ranges][:, None]
    best.load = np.bincount(orders[:, : best.posted.max()][there].astype(np.int64), minlength=m) / len(sample)
    return best


def search_file(index: Index, ids: np.ndarray, places: np.ndarray, orders: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, query_orders: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best k of the file's rows for each of its readers: (query row, file row, score).

    places: how many files of its own a row has before this one."""
    ranks = ranks_of(orders, len(index.pivots), index.prefix)
    cut = index.cut[index.ranges(vectors)]
    at, found, scores = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
    for q, order in enumerate(query_orders):
        reads = np.zeros(len(index.pivots), bool)
        reads[order[: index.read]] = True
        here = ids != query_ids[q]
        for j in range(int(places.max(initial=0))):
            here &= ~((places > j) & reads[orders[:, j]])
        near = np.flatnonzero(here)
        distance = footrule(ranks[near], order[: index.prefix])
        near = near[distance <= cut[near]]
        score = np.einsum("ij,j->i", vectors[near], queries[q])
        best = _best(ids[near], score, k)
        at.append(np.full(len(best), q))
        found.append(near[best])
        scores.append(score[best])
    return np.concatenate(at), np.concatenate(found), np.concatenate(scores)


def _best(ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, equal ones by id."""
    few = np.arange(len(ids))
    if len(ids) > 4 * k:
        few = np.flatnonzero(score >= np.partition(score, len(ids) - k)[len(ids) - k])
    return few[np.lexsort((ids[few], -score[few]))[:k]]


def usable(vector: Column) -> Column:
    """Whether a vector takes part: no null or non-finite component, not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.ChunkedArray | pa.Array, length: int, kind: object) -> np.ndarray:
    """Rows of a binary column of equal sizes."""
    if not len(column):
        return np.zeros((0, length), kind)
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), length)


def _post_task(batches: Iterator[pa.RecordBatch], index: Index, length: int, kind: str, parts: np.ndarray, readers: bool) -> Iterator[pa.RecordBatch]:
    """A row for every file that a vector is posted in (readers: that it reads), and for every part of the other side."""
    depth = max(index.prefix, int(index.posted.max()), index.read)
    for batch in batches:
        for a in range(0, batch.num_rows, 1024):
            some = batch.slice(a, 1024)
            vectors = some.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, length)
            orders = permutation(vectors.astype(np.float64), index.pivots, depth)
            files = np.full(len(orders), index.read) if readers else index.posted[index.ranges(vectors.astype(np.float64))]
            row = np.repeat(np.arange(len(orders)), files)
            place = np.arange(len(row)) - np.repeat(np.cumsum(files) - files, files)
            pivot = orders[row, place].astype(np.int64)
            # A block of the file or a group of its readers by the id, and one copy for every part of the others.
            own = some.column(1).to_numpy().astype(np.uint64)[row] % parts[int(readers)][pivot].astype(np.uint64)
            copies = parts[1 - int(readers)][pivot]
            again = np.repeat(np.arange(len(row)), copies)
            other = np.arange(len(again)) - np.repeat(np.cumsum(copies) - copies, copies)
            row, place, pivot, own = row[again], place[again], pivot[again], own[again].astype(np.int64)
            block, group = (other, own) if readers else (own, other)
            keep = pa.array(row)
            # A place is needed of rows, and what comes before it of the order.
            short = [orders[k, : max(index.prefix, index.read if readers else int(files[k]))].tobytes() for k in range(len(orders))]
            whole = [v.tobytes() for v in np.ascontiguousarray(vectors.astype(kind))]
            for b in range(0, len(row), 8192):
                part = slice(b, b + 8192)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x[part].astype(np.int32)) for x in (pivot, block, group, place)] + [some.column(0).take(keep[part]), pa.array([short[k] for k in row[part].tolist()], pa.binary()), pa.array([whole[k] for k in row[part].tolist()], pa.binary())],
                    names=["pivot", "block", "group", "place", "id", "ranked", "vector"],
                )


_POSTED = "pivot int, block int, group int, place int, id long, ranked binary, vector binary"


def _orders(column: pa.ChunkedArray, prefix: int) -> np.ndarray:
    rows = [np.frombuffer(b, np.int16) for b in column.to_pylist()]
    out = np.zeros((len(rows), max([prefix, *map(len, rows)])), np.int16)
    for k, r in enumerate(rows):
        out[k, : len(r)] = r
    return out


def _search_length(rows: DataFrame, length: int, count: int, asking: int, most: float, k: int, id_col: str, pivots: int, sample: int, goal: float, block_rows: int, group_queries: int) -> DataFrame:
    """query_id, id and score of the k best of every query among the rows of one length."""
    kind = "<f4" if isinstance(rows.schema["vector"].dataType.elementType, T.FloatType) else "<f8"
    chosen = rows.select("hash", "id", "vector").orderBy("hash", "id").limit(sample).select("vector").toArrow().column("vector").combine_chunks()
    points = chosen.flatten().to_numpy(zero_copy_only=False).reshape(-1, length).astype(np.float64)
    index = fit(points, most, k, min(pivots, max(1, int(4 * count**0.5))), goal, asking / count)
    # Blocks of the files, groups of their readers: by the sample's loads, twice for those it saw few of.
    blocks = np.ceil((index.load + 1 / len(points)) * count / block_rows).astype(np.int64)
    groups = np.maximum(1, np.ceil((index.load / max(index.load.sum(), 1e-9) + 1 / len(points)) * asking * index.read / group_queries)).astype(np.int64)
    parts = np.stack([blocks, groups])

    def posted(some: DataFrame, readers: bool) -> DataFrame:
        return some.select("id", "hash", "vector").mapInArrow(lambda b: _post_task(b, index, length, kind, parts, readers), _POSTED)

    def tile(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, query_ids = left.column("id").to_numpy(), right.column("id").to_numpy()
        if not len(ids) or not len(query_ids):
            return pa.table({"query_id": pa.array([], pa.int64()), id_col: pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        vectors, queries = (_matrix(t.column("vector"), length, kind).astype(np.float64) for t in (left, right))
        orders, query_orders = _orders(left.column("ranked"), index.prefix), _orders(right.column("ranked"), index.prefix)
        q, r, score = search_file(index, ids, left.column("place").to_numpy(), orders, vectors, query_ids, query_orders, queries, k)
        return pa.table({"query_id": query_ids[q], id_col: ids[r], "score": score})

    key = ("pivot", "block", "group")
    met = posted(rows, False).groupBy(*key).cogroup(posted(rows.filter("asks"), True).groupBy(*key)).applyInArrow(tile, f"query_id long, {id_col} long, score double")
    return _ranked(met, id_col, k)


def _ranked(met: DataFrame, id_col: str, k: int) -> DataFrame:
    order = W.partitionBy("query_id").orderBy(F.desc("score"), id_col)
    return met.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", id_col, "score")


def _search_all(asked: DataFrame, rows: DataFrame, length: int, k: int, id_col: str) -> DataFrame:
    """The k best of all rows for queries that their files left short, in blocks of both."""
    spread = lambda n, name: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)
    blocks = max(1, -(-rows.count() // BLOCK_ROWS))
    groups = max(1, -(-asked.count() // GROUP_QUERIES))
    left = rows.select(F.pmod("hash", F.lit(blocks)).cast("int").alias("block"), spread(groups, "group"), "id", F.col("vector").cast("array<double>").alias("vector"))
    right = asked.select(spread(blocks, "block"), F.pmod("hash", F.lit(groups)).cast("int").alias("group"), "id", F.col("vector").cast("array<double>").alias("vector"))

    def tile(data: pa.Table, queries: pa.Table) -> pa.Table:
        out = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        if data.num_rows and queries.num_rows:
            ids, query_ids = data.column("id").to_numpy(), queries.column("id").to_numpy()
            vectors, points = (t.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, length) for t in (data, queries))
            for q, point in enumerate(points):
                near = np.flatnonzero(ids != query_ids[q])
                score = np.einsum("ij,j->i", vectors[near], point)
                best = _best(ids[near], score, k)
                for column, values in zip(out, (np.full(len(best), query_ids[q]), ids[near[best]], score[best]), strict=True):
                    column.append(values)
        return pa.table({n: np.concatenate(c) for n, c in zip(("query_id", id_col, "score"), out, strict=True)})

    met = left.groupBy("block", "group").cogroup(right.groupBy("block", "group")).applyInArrow(tile, f"query_id long, {id_col} long, score double")
    return _ranked(met, id_col, k)


def search(vectors: DataFrame, queries: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", pivots: int = PIVOTS, sample: int = SAMPLE, goal: float = GOAL, block_rows: int = BLOCK_ROWS, group_queries: int = GROUP_QUERIES) -> DataFrame:
    """query_id, rank (from 1), the found row's id and score for the rows where queries holds.

    sample bounds the rows the index is fitted on, those of the smallest hashes of their ids; goal is the
    share of their neighbours that each of the index's two prunings must leave."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"), F.coalesce(queries, F.lit(False)).alias("asks"), F.xxhash64(F.col(id_col).cast("long")).alias("hash"))
    if not isinstance(rows.schema["vector"].dataType.elementType, (T.FloatType, T.DoubleType)):
        rows = rows.withColumn("vector", F.col("vector").cast("array<double>"))
    rows = rows.filter(F.col("id").isNotNull() & usable(F.col("vector")))
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda t, x: t + x.cast("double") * x.cast("double")))
    shapes = rows.groupBy(F.size("vector").alias("length")).agg(F.count("*").alias("n"), F.count_if("asks").alias("asking"), F.max(norm).alias("most")).filter("asking > 0").orderBy("length").collect()
    found = spark.createDataFrame([], f"query_id long, rank int, {id_col} long, score double")
    for shape in shapes:
        own = rows.filter(F.size("vector") == shape["length"])
        best = written(_search_length(own, shape["length"], shape["n"], shape["asking"], shape["most"], k, id_col, pivots, sample, goal, block_rows, group_queries), "nearest")
        full = best.groupBy("query_id").agg(F.max("rank").alias("rank")).filter(F.col("rank") >= min(k, shape["n"] - 1))
        short = written(own.filter("asks").join(full, F.col("id") == F.col("query_id"), "left_anti"), "short-of-rows")
        if not short.isEmpty():
            late = _search_all(short, own, shape["length"], k, id_col)
            best = best.join(late.select("query_id").distinct(), "query_id", "left_anti").unionByName(late)
        found = found.unionByName(best)
    return found.select("query_id", "rank", id_col, "score")
