"""Mixing sources to target weights by balanced sampling with the cube method.

A source's target over its size gives each of its documents whole copies and
an inclusion probability for one more.  The cube method moves the vector of
those probabilities through the null space of two balancing constraints, the
source's words and its documents, until all but two are 0 or 1.  Documents are
dealt to cells of bounded size by a hash of their id, so a hot source has many
cells; the few open units of all cells go on to the next round, and the last
two of a source land on the rounding that keeps its words nearest to target,
mended where they are too large for that.

Edge cases: null and empty texts have size 0 and are taken 0 words; the null
source is a source, the last; repeated rows draw apart; sources of size 0 have
target 0; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import written
from . import text as tx

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
CELL_DOCS = 4096
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""

    @F.arrow_udf("long")
    def count(column: pa.Array) -> pa.Array:
        offsets, data = tx.column_bytes(column)
        out = np.zeros(len(column), np.int64)
        for i, j in tx.slices(offsets):
            _, _, first = tx.word_spans(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            out[i:j] = np.diff(first)
        return pa.array(out)

    return count(text)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """source, source_size, target: one row per source.

    Sources by code point, null last, weigh weights in turn and share share times
    all words; a target stops at most times its source's size, and the excess is
    shared by weight again.  Ordered by size over weight, the stopped sources are
    a prefix, and running sums find where it ends: one pass for any number."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = (F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    totals = totals.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")))
    totals = totals.withColumn("limit", most * F.col("source_size")).withColumn("ratio", F.col("limit") / F.col("weight"))
    order = W.orderBy("ratio", F.col("source").asc_nulls_last())
    every = W.partitionBy(F.lit(0))
    before, after = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(0, W.unboundedFollowing)
    level = (share * F.sum("source_size").over(every) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    totals = totals.withColumn("level", level)
    final = F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(every)
    return totals.select("source", "source_size", F.when(final.isNull(), F.col("limit")).otherwise(F.least(F.col("limit"), final * F.col("weight"))).alias("target"))


def flight(chance: np.ndarray, size: np.ndarray, seed: int) -> np.ndarray:
    """Moves chance until at most two entries lie strictly between 0 and 1; sums of chance and of chance * size stay."""
    random = np.random.default_rng(seed)
    p = chance.astype(float).tolist()
    x = size.astype(float).tolist()
    live = [i for i, v in enumerate(p) if 0.0 < v < 1.0]
    draws = random.random(len(live) + 1).tolist()
    active = live[:3]
    follow = 3
    while len(active) == 3:
        a, b, c = active
        u = (x[b] - x[c], x[c] - x[a], x[a] - x[b])
        if u == (0.0, 0.0, 0.0):
            u = (1.0, -1.0, 0.0)
        up = down = float("inf")
        for i, d in zip(active, u, strict=True):
            if d > 0:
                up, down = min(up, (1 - p[i]) / d), min(down, p[i] / d)
            elif d < 0:
                up, down = min(up, -p[i] / d), min(down, -(1 - p[i]) / d)
        move = up if draws.pop() < down / (up + down) else -down
        kept = []
        for i, d in zip(active, u, strict=True):
            p[i] += move * d
            if p[i] < 1e-9:
                p[i] = 0.0
            elif p[i] > 1 - 1e-9:
                p[i] = 1.0
            else:
                kept.append(i)
        while len(kept) < 3 and follow < len(live):
            kept.append(live[follow])
            follow += 1
        active = kept
    return np.array(p)


def landing(chance: np.ndarray, size: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Rounds the last open entries so that the words differ least from their expectation before the flight.

    What is still off, as when a huge document is one of them, is mended by the
    one or two documents of the cell whose change of state brings it nearest."""
    out = chance.copy()
    live = np.flatnonzero((chance > 0) & (chance < 1))
    if len(live):
        choices = (np.arange(1 << len(live))[:, None] >> np.arange(len(live))) & 1
        off = np.abs((choices - chance[live]) @ size[live])
        out[live] = choices[np.lexsort((np.abs((choices - chance[live]).sum(axis=1)), off))[0]]
    free = np.flatnonzero((before > 0) & (before < 1))
    off = float((out - before) @ size)
    for _ in range(8):
        if abs(off) < 0.5 or len(free) < 2:
            break
        change = np.where(out[free] > 0.5, -size[free], size[free])
        order = np.argsort(change, kind="stable")
        ordered = change[order]
        mate = np.clip(np.searchsorted(ordered, -off - change), 1, len(free) - 1)
        mate = np.where(np.abs(off + change + ordered[mate - 1]) <= np.abs(off + change + ordered[mate]), mate - 1, mate)
        mate = order[mate]
        pair = np.where(mate == np.arange(len(free)), np.inf, np.abs(off + change + change[mate]))
        i, single = int(np.argmin(pair)), int(np.argmin(np.abs(off + change)))
        flips = [single] if abs(off + change[single]) <= pair[i] else [i, int(mate[i])]
        if abs(off + change[flips].sum()) >= abs(off) - 1e-9:
            break
        off += float(change[flips].sum())
        out[free[flips]] = 1 - out[free[flips]]
    return out


def _cell(frame: pd.DataFrame, last: bool, cell_docs: int = CELL_DOCS) -> pd.DataFrame:
    """Flies a cell; lands too in the last round and where a cell is all of its source."""
    frame = frame.sort_values(["size", "order", "key"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
    size, before = frame["size"].to_numpy(float), frame["chance"].to_numpy(float)
    chance = flight(before, size, int(frame["order"].iloc[0]) & 0x7FFFFFFF)
    return frame.assign(chance=landing(chance, size, before) if last or frame["docs"].iloc[0] <= cell_docs else chance)


def row_mark(id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> Column:
    """Never null; equal for rows that agree in id, source and text."""
    return F.xxhash64(id_col, F.col(source_col).isNull(), source_col, F.col(text_col).isNull(), text_col)


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, cell_docs: int = CELL_DOCS, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", seed: int = 0) -> DataFrame:
    """doc_id, source, size, source_size, target, copies (how often the mix takes the document) and row_mark of each row.

    Cells, order and draws follow from hashes of the id and the text, so reruns agree whatever the partitioning."""
    sizes = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)).alias("order"), row_mark(id_col, source_col, text_col).alias("mark"))
    # Repeated rows share all columns; a number among them tells them apart.
    sizes = written(sizes.withColumn("copy", F.row_number().over(W.partitionBy("doc_id", "source", "order", "size").orderBy("order"))), "mix-sizes")
    targets = source_targets(sizes, weights, share, most)
    counts = sizes.groupBy("source").agg(F.count("*").alias("docs"))
    # One row per source; Spark broadcasts it or not by its size.
    known = targets.alias("t").join(counts.alias("c"), F.col("t.source").eqNullSafe(F.col("c.source"))).select("t.source", "source_size", "target", "docs")
    known = written(known, "mix-sources")
    rows = sizes.alias("d").join(known.alias("k"), F.col("d.source").eqNullSafe(F.col("k.source"))).select("d.*", "source_size", "target", "docs")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rows = rows.withColumn("whole", F.floor(rate)).withColumn("chance", rate - F.col("whole")).withColumn("order", F.xxhash64("order", "copy"))
    rows = rows.withColumn("chance", F.when(F.col("size") == 0, 0.0).otherwise(F.col("chance")))
    rows = rows.withColumn("key", F.col("doc_id").cast("string"))
    rows = rows.withColumn("cell", F.pmod("order", F.ceil(F.col("docs") / cell_docs)))
    fields = "key string, source string, size long, source_size long, target double, whole long, order long, docs long, cell long, chance double, mark long"
    names = [f.split()[0] for f in fields.split(", ")]
    open_rows = rows.select(names)
    # A cell leaves two open units, so every round divides them by thousands; the last has one cell a source.
    flown = open_rows.groupBy("source", "cell").applyInPandas(lambda f: _cell(f, False, cell_docs), fields)
    flown = written(flown, "mix-flight")
    closed = (F.col("chance") <= 0) | (F.col("chance") >= 1)
    done, left = flown.filter(closed), flown.filter(~closed)
    while left.groupBy("source").count().filter(F.col("count") > cell_docs).limit(1).count():
        heavy = left.groupBy("source").agg(F.count("*").alias("open"))
        left = left.alias("d").join(heavy.alias("h"), F.col("d.source").eqNullSafe(F.col("h.source"))).select("d.*", "open")
        left = left.withColumn("cell", F.pmod(F.xxhash64("order", F.lit(1)), F.ceil(F.col("open") / cell_docs))).select(names)
        flown = written(left.groupBy("source", "cell").applyInPandas(lambda f: _cell(f, False, cell_docs), fields), "mix-flight")
        done, left = done.unionByName(flown.filter(closed)), flown.filter(~closed)
    landed = left.withColumn("cell", F.lit(0).cast("long")).groupBy("source", "cell").applyInPandas(lambda f: _cell(f, True), fields)
    copies = (F.col("whole") + F.round("chance").cast("long")).alias("copies")
    return done.unionByName(landed).select(F.col("key").cast(docs.schema[id_col].dataType).alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", copies, "mark")
