"""Exact Jaccard self-join of word-shingle sets by prefixes and pivots, and its components.

Equal sets are one class, known by a 64-bit hash.  Shingles have a global order,
rare ones first: by a count sketch of fixed size over the whole corpus, then by
hash.  Sets that link
share a shingle of their prefixes in that order, so the prefixes are posted.
To keep a group of near copies from emitting all its pairs:

1. pairs of a short list (fewer than SHORT sets) are counted in it, and the
   counts of all short lists are summed per pair; a pair goes on if the sum, with
   the long lists both might share, leaves room for a link, and if the sets'
   parity sketches differ in few enough bits;
2. a long list is tied to its least set, the pivot, and the whole overlaps of
   pivot and members are counted; those of a similarity of FAMILY go on.  By the
   triangle inequality of the Jaccard distance a link that is left joins two
   members of which one is below FAMILY from the pivot and the other below
   FAMILY + 1 - threshold; those few pairs go on too;
3. the members of a pivot are a group, in which links that the pivot does not
   show are sought; pairs of short lists that go on tie families, which are groups
   where small and are counted pair by pair where large.  Groups that known links
   join already are done; in the others all pairs are counted in tasks of bounded
   size, which emit a forest of links.

Overlaps are counted by fragments of the order of hashes, one after the other in
the task that holds both sets, and summed per pair: vertical partitions of a
task's work, not of the join's.  No pair that links is lost, and none is capped.

Edge cases: null and empty texts, and texts without words, have no shingles and
link with nothing; fewer words than a shingle count as one shingle; a document
without links is its own component; repeated rows count as rows of a class;
null ids come out as they are; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import shingles as sh
from . import text as tx
from .components import connected_components
from .shared import bucketed, passing, written

PERCENT = 80
FAMILY = 25
CELL_BITS = 21
BLOCKS = 64
# Cells that hold 2 ** HOT_RANK beyond chance have their lists dealt out in parts.
HOT_RANK = 16
TILE = 1024
TILE_SHINGLES = 1 << 20
STAR = 256
LIST = 256
SHORT = 32
FRAGMENTS = 4
WANTED = 1 << 20


def needed(n: np.ndarray, percent: int) -> np.ndarray:
    """Least overlap with any set that links, of a set of n."""
    return -(-percent * n // 100)


def parities(row: np.ndarray, key: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of each row's parity sketch, and their edges (rows + 1): bit h mod m flips for every shingle hash h.

    m is a power of two of n to 2 n bits, 64 at least.  Two sets differ in as many shingles as their sketches in bits at least."""
    words = np.int64(1) << np.ceil(np.log2(np.maximum(1, counts / 64))).astype(np.int64)
    edges = np.append(0, np.cumsum(words))
    out = np.zeros(edges[-1], np.uint64)
    place = key & ((words << 6).astype(np.uint64) - np.uint64(1))[row]
    np.bitwise_xor.at(out, edges[row] + (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63)))
    return out, edges


_DESCRIBED = "doc_id long, mark long, n_shingles long, sig long, parity array<long>, part int, block int, cells binary"


def _describe_task(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """Each document's set size, signature and parity sketch, then the task's count sketch in blocks."""
    cells = np.zeros(1 << CELL_BITS, np.int32)
    names = [f.split()[0] for f in _DESCRIBED.split(", ")]
    for batch in batches:
        for i, j, row, key in sh.column_shingles(batch.column(2), words):
            counts, sig = sh.signatures(row, key, j - i)
            np.add.at(cells, (key >> np.uint64(64 - CELL_BITS)).astype(np.int64), np.int32(1))
            size = j - i
            parity, edges = parities(row, key, counts)
            sketch = pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(tx.signed(parity)))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, size), batch.column(1).slice(i, size), pa.array(counts.astype(np.int64)), pa.array(tx.signed(sig)), sketch, pa.nulls(size, pa.int32()), pa.nulls(size, pa.int32()), pa.nulls(size, pa.binary())], names=names)
    part = TaskContext.get().partitionId()
    for k, own in enumerate(np.split(cells, BLOCKS)):
        yield pa.RecordBatch.from_arrays([*[pa.nulls(1, pa.int64())] * 4, pa.nulls(1, pa.list_(pa.int64())), pa.array([part], pa.int32()), pa.array([k], pa.int32()), pa.array([own.tobytes()], pa.binary())], names=names)


def _sum_cells(table: pa.Table, kind: type = np.int64) -> pa.Table:
    total = sum(np.frombuffer(v.as_buffer(), kind).astype(np.int64) for v in table.column("cells"))
    return pa.table({"block": table.column("block")[:1], "cells": pa.array([total.tobytes()], pa.binary())})


def rarity(cells: np.ndarray, mean: float) -> np.ndarray:
    """For each cell 0, or the logarithm of what it holds beyond chance: hot shingles come last in the order."""
    excess = cells - (mean + 6 * mean**0.5)
    return np.where(excess > 0, 1 + np.log2(np.maximum(1, excess)), 0).astype(np.uint8)


def _prefix_task(batches: Iterator[pa.RecordBatch], words: int, percent: int, ranks: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(tok, part, n, sig) of the prefixes, once for each set that the task meets; part is not 0 where the list is hot."""
    seen: set[int] = set()
    for batch in batches:
        for i, j, row, key in sh.column_shingles(batch.column(0), words):
            counts, sig = sh.signatures(row, key, j - i)
            fresh = np.zeros(j - i, bool)
            for r in np.flatnonzero(counts).tolist():
                if (s := int(sig[r])) not in seen:
                    seen.add(s)
                    fresh[r] = True
            keep = fresh[row]
            row, key = row[keep], key[keep]
            if not len(row):
                continue
            rank = ranks[(key >> np.uint64(64 - CELL_BITS)).astype(np.int64)]
            order = np.lexsort((key, rank, row))
            row, key, rank = row[order], key[order], rank[order]
            size = np.where(fresh, counts, 0)
            place = np.arange(len(row)) - (np.cumsum(size) - size)[row]
            keep = place < (counts - needed(counts, percent) + 1)[row]
            row, key, rank = row[keep], key[keep], rank[keep]
            parts = np.int64(1) << np.clip(rank.astype(np.int64) - HOT_RANK, 0, 62)
            dealt = np.where(parts > 1, 1 + (tx.mix(sig)[row] & (parts - 1).astype(np.uint64)).astype(np.int64), 0)
            for a in range(0, len(row), 1 << 18):
                part = slice(a, a + (1 << 18))
                yield pa.RecordBatch.from_arrays([pa.array(tx.signed(key[part])), pa.array(dealt[part]), pa.array(counts[row[part]].astype(np.int32)), pa.array(tx.signed(sig[row[part]]))], names=["tok", "part", "n", "sig"])


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of each group, from batches sorted by their first columns (key1, key2, key3)."""
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy() for c in range(3)])
        edges = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            now = tuple(keys[:, a].tolist())
            if held and now != last:
                yield pa.Table.from_batches(held)
                held = []
            last = now
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _sets(texts: pa.ChunkedArray, words: int) -> tuple[np.ndarray, np.ndarray]:
    rows, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for i, _, row, key in sh.column_shingles(texts, words):
        rows.append(row + i)
        keys.append(key)
    return np.concatenate(rows), np.concatenate(keys)


def fragments(row: np.ndarray, key: np.ndarray, count: int = FRAGMENTS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The vertical partitions: rows and hashes of equal ranges of the order of hashes."""
    order = np.argsort(key, kind="stable")
    row, key = row[order], key[order]
    edges = np.searchsorted(key, np.array([(k << 64) // count for k in range(count)], np.uint64))
    for a, b in zip(edges, [*edges[1:], len(key)], strict=True):
        yield row[a:b], key[a:b]


def _star_task(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """Overlap of every member of a group with its pivot."""
    for table in _grouped(batches):
        sig = table.column("sig").to_numpy()
        pivot = int(table.column("key1")[0].as_py())
        row, key = _sets(table.column("text"), words)
        at = np.flatnonzero(sig == pivot)
        if not len(at):
            raise ValueError("a group lacks its pivot")
        counts = np.bincount(row, minlength=len(sig))
        overlap = np.zeros(len(sig), np.int64)
        for r, k in fragments(row, key):
            own = k[r == at[0]]
            overlap += np.bincount(r[np.isin(k, own)], minlength=len(sig))
        member = sig != pivot
        size = int(member.sum())
        yield pa.RecordBatch.from_arrays([pa.array(np.full(size, pivot, np.int64)), pa.array(sig[member]), pa.array(overlap[member]), pa.array(np.full(size, counts[at[0]], np.int64) + counts[member] - overlap[member])], names=["a", "b", "inter", "uni"])


def pair_overlaps(row: np.ndarray, key: np.ndarray, sets: int) -> np.ndarray:
    """Matrix of the overlaps of all pairs of sets, summed over fragments."""
    total = np.zeros(sets * sets, np.int32)
    for r, k in fragments(row, key):
        begin = np.flatnonzero(np.append(True, k[1:] != k[:-1])[: len(k)])
        size = np.diff(np.append(begin, len(k)))
        for d in np.unique(size[(size > 1) & (size <= 12)]).tolist():
            lists = np.sort(r[begin[size == d][:, None] + np.arange(d)], axis=1)
            for x in range(d - 1):
                for y in range(x + 1, d):
                    np.add.at(total, lists[:, x] * sets + lists[:, y], 1)
        hot = np.flatnonzero(size > 12)
        for a in range(0, len(hot), 1024):
            part = hot[a : a + 1024]
            there = np.zeros((sets, len(part)), np.float32)
            column = np.repeat(np.arange(len(part)), size[part])
            at = np.repeat(begin[part] - (np.cumsum(size[part]) - size[part]), size[part]) + np.arange(int(size[part].sum()))
            there[r[at], column] = 1
            total += (there @ there.T).astype(np.int32).ravel()
    return np.triu(total.reshape(sets, sets), 1)


def forest(a: np.ndarray, b: np.ndarray, nodes: int) -> list[tuple[int, int]]:
    """A spanning forest of the links."""
    parent = list(range(nodes))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = root(x), root(y)
        if p != q:
            parent[p] = q
            out.append((x, y))
    return out


def _family_task(batches: Iterator[pa.RecordBatch], words: int, percent: int) -> Iterator[pa.RecordBatch]:
    """A forest of the links in a group of bounded size."""
    for table in _grouped(batches):
        sig = table.column("sig").to_numpy()
        _, first = np.unique(sig, return_index=True)
        table, sig = table.take(pa.array(first)), sig[first]
        row, key = _sets(table.column("text"), words)
        counts = np.bincount(row, minlength=len(sig)).astype(np.int64)
        overlap = pair_overlaps(row, key, len(sig))
        a, b = np.nonzero(overlap)
        inter = overlap[a, b].astype(np.int64)
        linked = 100 * inter >= percent * (counts[a] + counts[b] - inter)
        links = forest(a[linked], b[linked], len(sig))
        if links:
            yield pa.RecordBatch.from_arrays([pa.array(sig[[x for x, _ in links]]), pa.array(sig[[y for _, y in links]])], names=["a", "b"])


def row_mark(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """Never null; tells rows apart that differ in id or text, also where ids are null or repeat."""
    return F.xxhash64(id_col, text_col)


class NgramJoin:
    """The join over one table of documents; each step's result lies in the shared folder."""

    def __init__(self, docs: DataFrame, percent: int = PERCENT, words: int = sh.WORDS, id_col: str = "doc_id", text_col: str = "text") -> None:
        self.docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), row_mark(id_col, text_col).alias("mark"), F.col(text_col).cast("string").alias("text"))
        self.percent, self.words = percent, words
        described = written(self.docs.mapInArrow(lambda b: _describe_task(b, words), _DESCRIBED), "shingle-sets")
        self.sets = described.filter("block IS NULL").select("doc_id", "mark", "n_shingles", "sig")
        # One row a class: equal sets have equal sketches.
        one = F.min(F.struct("mark", F.col("n_shingles").alias("n"), "parity")).alias("c")
        self.classes = written(described.filter("block IS NULL AND n_shingles > 0").groupBy("sig").agg(one).select("sig", "c.*"), "set-classes")
        self.shingles = self.sets.agg(F.sum("n_shingles")).first()[0] or 0
        self.ranks = self._ranks(described.filter("block IS NOT NULL").select("part", "block", "cells"), self.shingles)

    @staticmethod
    def _ranks(sketches: DataFrame, total: int) -> np.ndarray:
        """Sums the tasks' sketches, some dozens at a time, and ranks cells by rarity: a table of fixed size."""
        schema, mean = "block int, cells binary", total / (1 << CELL_BITS)

        def ranked(table: pa.Table) -> pa.Table:
            cells = np.frombuffer(_sum_cells(table).column("cells")[0].as_buffer(), np.int64)
            return pa.table({"block": table.column("block")[:1], "cells": pa.array([rarity(cells, mean).tobytes()], pa.binary())})

        some = sketches.withColumn("part", F.floor(F.col("part") / 64)).groupBy("block", "part").applyInArrow(lambda t: _sum_cells(t, np.int32), schema)
        whole = some.groupBy("block").applyInArrow(ranked, schema).orderBy("block").collect()
        if not whole:
            return np.zeros(1 << CELL_BITS, np.uint8)
        return np.concatenate([np.frombuffer(r["cells"], np.uint8) for r in whole])

    def _texts(self, wanted: DataFrame) -> DataFrame:
        """sig, n and text of one document of each wanted class; one shuffle of the wanted texts."""
        # Written first, so that its size is known: texts are not shuffled by mark while it holds at most WANTED rows of three numbers.
        own = written(self.classes.select("sig", "mark", "n").join(wanted.select("sig").distinct(), "sig", "left_semi"), "wanted")
        own = F.broadcast(own) if own.count() <= WANTED else own
        rows = self.docs.select("mark", "text").join(own, "mark").select("sig", "n", "text")
        # A shingle has some ten bytes of its own.
        return bucketed(rows, ["sig"], "texts", 10 * self.shingles, distinct=True)

    def _near(self, pairs: DataFrame) -> DataFrame:
        """Those of the pairs (a, b) that their parity sketches leave a chance to link; none that links is lost."""
        own = lambda c: self.classes.select(F.col("sig").alias(c), F.col("n").alias(f"n{c}"), F.col("parity").alias(f"p{c}"))
        both = pairs.join(own("a"), "a").join(own("b"), "b")
        swap = F.size("pa") > F.size("pb")
        both = both.withColumns({"s": F.when(swap, F.col("pb")).otherwise(F.col("pa")), "l": F.when(swap, F.col("pa")).otherwise(F.col("pb"))})
        # The longer sketch is folded onto the shorter's length.
        folded = F.transform("s", lambda x, i: F.aggregate(F.sequence(i, F.size("l") - 1, F.size("s")), x, lambda t, k: t.bitwiseXOR(F.get("l", k))))
        differ = F.aggregate(folded, F.lit(0), lambda t, x: t + F.bit_count(x))
        return both.filter((100 + self.percent) * differ <= (100 - self.percent) * (F.col("na") + F.col("nb"))).select("a", "b")

    def _counted(self, members: DataFrame, texts: DataFrame, task: Callable, schema: str) -> DataFrame:
        """Runs task over the groups (key1, key2, key3) of members, whose texts come by sig."""
        rows = members.join(texts.select("sig", "text"), "sig").select("key1", "key2", "key3", "sig", "text")
        return rows.repartition("key1", "key2", "key3").sortWithinPartitions("key1", "key2", "key3").mapInArrow(task, schema)

    def _stars(self, pairs: DataFrame, texts: DataFrame) -> DataFrame:
        """a, b, inter, uni of the pairs (a, b): groups of at most about STAR members about a."""
        words = self.words
        heavy = written(pairs.groupBy("a").agg(F.ceil(F.count("*") / STAR).alias("parts")), "stars")
        members = pairs.join(heavy, "a").select(F.col("a").alias("key1"), F.pmod(F.xxhash64("b"), F.col("parts")).alias("key2"), F.lit(0).cast("long").alias("key3"), F.col("b").alias("sig"))
        members = members.unionByName(members.select("key1", "key2", "key3", F.col("key1").alias("sig")).distinct())
        return written(self._counted(members, texts, lambda b: _star_task(b, words), "a long, b long, inter long, uni long"), "overlaps")

    def _all_pairs(self, groups: DataFrame, texts: DataFrame) -> DataFrame:
        """Links (a, b) inside the groups (family, sig), in tiles of two blocks of about TILE sets and TILE_SHINGLES shingles at most."""
        words, percent = self.words, self.percent
        groups = groups.join(texts.select("sig", "n"), "sig")
        size = written(groups.groupBy("family").agg(F.greatest(F.ceil(F.count("*") / TILE), F.ceil(F.sum("n") / TILE_SHINGLES)).alias("blocks")), "tiles")
        placed = groups.join(size, "family").withColumn("own", F.pmod(F.xxhash64("sig"), F.col("blocks")))
        other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
        members = placed.select("family", "own", "sig", other).select(F.col("family").alias("key1"), F.least("own", "other").alias("key2"), F.greatest("own", "other").alias("key3"), "sig")
        return self._counted(members, texts, lambda b: _family_task(b, words, percent), "a long, b long")

    def _may_link(self, c: Column, n: Column, m: Column) -> Column:
        """Whether sets of n and m with c or fewer common shingles in their prefixes can link.

        Beyond the prefix that ends first only that set's other shingles can be common."""
        least = F.ceil(self.percent * (n + m) / (100.0 + self.percent) - 1e-6)
        beyond = F.ceil(self.percent * F.greatest(n, m) / 100.0 - 1e-9) - 1
        fits = (self.percent * n <= 100 * m) & (self.percent * m <= 100 * n)
        return fits & (c >= least - beyond)

    def links(self) -> DataFrame:
        """Links (a, b) between classes that join all of each component."""
        words, percent, ranks = self.words, self.percent, self.ranks
        rows = self.docs.select("text").mapInArrow(lambda b: _prefix_task(b, words, percent, ranks), "tok long, part long, n int, sig long")
        # The least set of a list, or of a part of a hot one, is known as the sorted rows stream by; nothing is gathered.
        order = W.partitionBy("tok", "part").orderBy("n", "sig")
        running = order.rowsBetween(W.unboundedPreceding, W.currentRow)
        rows = rows.withColumn("pivot", F.first(F.struct("n", "sig")).over(running)).withColumn("again", F.lag("sig").over(order).eqNullSafe(F.col("sig")))
        lists = written(rows.filter(~F.col("again") & ((F.col("pivot.sig") != F.col("sig")) | (F.col("part") > 0))).select("tok", "n", "sig", F.col("pivot.n").alias("pn"), F.col("pivot.sig").alias("psig")), "lists")
        # Tables of one row a key are written before joins, so that Spark may split the other side's hot keys.
        sizes = written(lists.groupBy("tok").agg(F.count("*").alias("size"), F.min(F.struct("pn", "psig")).alias("p")), "list-sizes")
        lists = written(lists.select("tok", "n", "sig").join(sizes.select("tok", "size", "p.*"), "tok").filter("sig <> psig"), "sized-lists")
        short, long = lists.filter(F.col("size") < SHORT), lists.filter(F.col("size") >= SHORT)
        # Of how many long lists a set is a member: shingles in common that short lists do not count.
        hot = long.select("sig", "tok").unionByName(long.select(F.col("psig").alias("sig"), "tok").distinct()).groupBy("sig").agg(F.count("*").alias("hot"))

        # Short lists: the partial overlaps of all their pairs, summed per pair.
        full = short.select("tok", "n", "sig").unionByName(short.select("tok", F.col("pn").alias("n"), F.col("psig").alias("sig")).distinct())
        x, y = full.alias("x"), full.alias("y")
        fits = (percent * F.col("x.n") <= 100 * F.col("y.n")) & (percent * F.col("y.n") <= 100 * F.col("x.n"))
        both = x.join(y, (F.col("x.tok") == F.col("y.tok")) & (F.col("x.sig") < F.col("y.sig")) & fits)
        counted = both.groupBy(F.col("x.sig").alias("a"), F.col("y.sig").alias("b")).agg(F.count("*").alias("common"), F.first("x.n").alias("n"), F.first("y.n").alias("m"))
        counted = counted.join(hot.select(F.col("sig").alias("a"), F.col("hot").alias("ha")), "a", "left").join(hot.select(F.col("sig").alias("b"), F.col("hot").alias("hb")), "b", "left")
        more = F.least(F.coalesce("ha", F.lit(0)), F.coalesce("hb", F.lit(0)))
        edges = self._near(counted.filter(self._may_link(F.col("common") + more, F.col("n"), F.col("m"))).select("a", "b"))

        texts = certain = None
        groups: list[DataFrame] = []
        if long.limit(1).count():
            # Long lists: pivots and members, then what the triangle inequality leaves.
            long = written(long, "long-lists")
            pairs = long.filter(100 * F.col("pn") >= FAMILY * F.col("n")).select(F.col("psig").alias("a"), F.col("sig").alias("b")).distinct()
            edges = written(edges, "pairs")
            wanted = edges.select(F.col("a").alias("sig")).unionByName(edges.select(F.col("b").alias("sig"))).unionByName(long.select("sig")).unionByName(long.select(F.col("psig").alias("sig")))
            texts = self._texts(wanted)
            stars = self._stars(pairs, texts)
            certain = stars.filter(100 * F.col("inter") >= percent * F.col("uni")).select("a", "b")
            known = long.join(stars.select(F.col("a").alias("psig"), F.col("b").alias("sig"), "inter", "uni"), ["psig", "sig"], "left")
            share = F.coalesce(100 * F.col("inter") / F.col("uni"), F.lit(0.0))
            rest = known.withColumn("share", share).filter(F.col("share") < FAMILY + 100 - percent).select("tok", "n", "sig", "share")
            of_list = rest.groupBy("tok").agg(F.min("share").alias("least"), F.count("*").alias("size")).filter((F.col("least") < FAMILY) & (F.col("size") > 1))
            of_list = written(of_list, "open-lists")
            rest = written(rest.join(of_list.select("tok", "size"), "tok"), "rest")
            every = lists.select("sig", "tok").unionByName(lists.select(F.col("psig").alias("sig"), "tok").distinct()).groupBy("sig").agg(F.count("*").alias("lists"))
            few = rest.filter(F.col("size") <= LIST).join(every, "sig")
            x, y = few.alias("x"), few.alias("y")
            may = self._may_link(F.least("x.lists", "y.lists"), F.col("x.n"), F.col("y.n"))
            left = x.join(y, (F.col("x.tok") == F.col("y.tok")) & (F.col("x.sig") < F.col("y.sig")) & (F.least("x.share", "y.share") < FAMILY) & may)
            edges = edges.unionByName(self._near(left.select(F.col("x.sig").alias("a"), F.col("y.sig").alias("b")).distinct())).distinct()
            # Two links make a similarity of 2 percent - 100 at least: members that link with the pivot can only
            # tie others of that similarity to it, and the rest are compared among themselves.
            share = 100 * F.col("inter") / F.col("uni")
            apart = stars.filter((share >= FAMILY) & (share < percent)).select(F.xxhash64("a", F.lit(1)).alias("family"), F.col("b").alias("sig"))
            close = stars.filter((share >= FAMILY) & (share >= 2 * percent - 100)).select(F.xxhash64("a", F.lit(2)).alias("family"), F.col("b").alias("sig"))
            groups = [apart, close, rest.filter(F.col("size") > LIST).select(F.col("tok").alias("family"), "sig").distinct()]
        # Pairs of short lists: small families are compared whole, the pairs of large ones one by one.
        edges = written(edges, "candidates")
        family = written(connected_components(edges).select(F.col("node").alias("sig"), F.col("component").alias("family")), "families")
        if texts is None:
            texts = self._texts(family)
        large = family.groupBy("family").agg(F.count("*").alias("size")).filter(F.col("size") > LIST).select("family")
        single = edges.join(family.join(large, "family").select(F.col("sig").alias("a")), "a", "left_semi")
        singly = self._stars(single, texts).filter(100 * F.col("inter") >= percent * F.col("uni")).select("a", "b")
        certain = singly if certain is None else certain.unionByName(singly)
        every = family.join(large, "family", "left_anti").select("family", "sig")
        for some in groups:
            every = every.unionByName(some)
        # A group that is joined by links already known has nothing left to find.
        parts = connected_components(certain).withColumnRenamed("node", "sig")
        every = every.join(parts, "sig", "left").withColumn("part", F.coalesce("component", "sig"))
        tied = written(every.select("family", "sig", "part"), "groups")
        divided = tied.groupBy("family").agg(F.min("part").alias("p"), F.max("part").alias("q")).filter("p <> q").select("family")
        divided = written(tied.join(divided, "family", "left_semi").select("family", "sig"), "open-families")
        return written(self._all_pairs(divided, texts).unionByName(certain), "links")

    def _classes(self, *columns: str) -> DataFrame:
        """columns of every row's set and its group, null for rows without shingles."""
        classes = connected_components(self.links())
        joined = self.sets.join(classes.withColumnRenamed("node", "sig"), "sig", "left")
        # Documents without shingles stand alone; classes without links are their own.
        group = F.when(F.col("n_shingles") > 0, F.coalesce("component", "sig"))
        return written(joined.select(*columns, group.alias("group")), "classes", keep=True)

    def components(self) -> DataFrame:
        """doc_id, n_shingles, component_id (least document reachable by links, itself included)."""
        joined = self._classes("doc_id", "n_shingles")
        least = written(joined.filter("group IS NOT NULL").groupBy("group").agg(F.min("doc_id").alias("least")), "components", keep=True)
        return joined.join(least, "group", "left").select("doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"))


def first_marks(docs: DataFrame, percent: int = PERCENT, words: int = sh.WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """mark of one row of each component: the smallest id, null last; and, alone, the marks of rows without shingles."""
    with passing(docs.sparkSession):
        rows = NgramJoin(docs, percent, words, id_col, text_col)._classes("doc_id", "mark")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")).alias("r")
    first = rows.filter("group IS NOT NULL").groupBy("group").agg(least).select("r.mark", F.lit(False).alias("alone"))
    return first.unionByName(rows.filter("group IS NULL").select("mark", F.lit(True).alias("alone")).distinct())


def near_duplicates(docs: DataFrame, percent: int = PERCENT, words: int = sh.WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document with its set size and the component of documents at percent or more."""
    with passing(docs.sparkSession):
        return NgramJoin(docs, percent, words, id_col, text_col).components()
