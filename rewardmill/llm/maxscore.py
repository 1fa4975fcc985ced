"""Exact top-k search by inner product over integer terms: MaxScore on shards, then a merge.

Every dimension is a term; its postings in a shard are the shard's non-zero weights with
the smallest and largest of them. For a query a term's bound is the largest product its
postings can give. Terms are sorted by bound; the *essential* ones are the shortest
leading part such that all others together can't lift a document over the current k-th
score. A shard is traversed block by block: essential postings of the block for all its
documents; the others are probed, most promising first, only for documents whose partial
score plus remaining bounds is still competitive. After every block the k-th score, and
with it the threshold, rises, and fewer terms are essential for the next. Shards' top k are
merged by score, ties to the smaller id.

A query first searches the shard it lies in itself; the k-th score found there goes with it
to all other shards as their first threshold. Candidates move once, to their shard, and stay;
queries are streamed past them in Arrow batches, so a task holds one shard and one batch.
Rows are dealt by a row number of the written table, so copies of one id or vector spread.

Scores are exact 64-bit integers: products in double precision where they can't reach 2^53,
in 64-bit integers beyond. Pairs whose score could leave 64 bits on the way are scored one
by one in Python integers.

Defined results: rows with a null id, a null vector, a null or non-finite component, or
another length than the query take no part; a floor(64 x) or a score among the k best
that doesn't fit 64 bits is an error; repeated ids are candidates each on their own, and
a query skips every row of its own id; equal scores are ranked by id; a query row gets its
own ranks, even if its id is repeated; fewer than k candidates: all of them; long vectors
are read whole; an empty table gives an empty result; extra columns are ignored, whatever
they are called.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rewardmill.llm.common import materialise, ship, shuffle_partitions

SHARD_ROWS = 8_192
#: Rows of a shard between two rises of the threshold; the first time sooner.
FIRST_STEP, BLOCK_STEP = 1_024, 4_096
PROBE_STEP = 8


def quantised(
    vectors: DataFrame, is_query: Column, id_col: str, vector_col: str, scale: int = 64
) -> DataFrame:
    """(id, asks, terms): floor(scale * x) of every component in double precision."""
    x = F.transform(F.col(vector_col), lambda v: v.cast("double"))
    usable = F.forall(x, lambda v: F.coalesce(F.abs(v) < float("inf"), F.lit(False)))
    fits = lambda v: F.abs(v * scale) < float(1 << 63)
    too_large = F.raise_error(F.lit("maxscore: a component's term doesn't fit 64 bits")).cast("long")
    return (
        vectors.select(F.col(id_col).alias("id"), F.coalesce(is_query, F.lit(False)).alias("asks"), x.alias("x"))
        .filter(F.col("id").isNotNull() & F.col("x").isNotNull() & usable)
        .select("id", "asks", F.transform("x", lambda v: F.when(fits(v), F.floor(v * scale)).otherwise(too_large)).alias("terms"))
    )


class Shard:
    """Term-major postings of one shard (ids ascending) with their weight bounds."""

    def __init__(self, ids: np.ndarray, terms: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.size = ids[order], terms.shape[1]
        rows = terms[order].astype(np.int64)
        self.most = int(np.abs(rows).max(initial=0))
        self.low = np.minimum(rows.min(axis=0, initial=0), 0)
        self.high = np.maximum(rows.max(axis=0, initial=0), 0)
        self.tables = {np.int64: (rows, np.ascontiguousarray(rows.T))}

    def in_kind(self, kind) -> tuple[np.ndarray, np.ndarray]:
        """Rows and postings as numbers of one kind."""
        if kind not in self.tables:
            self.tables[kind] = tuple(t.astype(kind) for t in self.tables[np.int64])
        return self.tables[kind]

    def top(self, own: int, query: np.ndarray, k: int, floor: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best rows but those of id ``own``, best first; of those
        below ``floor``, a score that k rows elsewhere reach, some may be left out."""
        query = query.astype(np.int64)
        bound = np.maximum(query * self.low, query * self.high)
        order = np.argsort(-bound, kind="stable")
        rest = np.append(np.cumsum(bound[order][::-1])[::-1], 0)  # bound of terms from here on
        small = self.most * int(np.abs(query).max(initial=0)) * self.size < 1 << 53
        kind = np.float64 if small else np.int64
        rows, postings = self.in_kind(kind)
        weights = query.astype(kind)
        best_ids, best = np.empty(0, np.int64), np.empty(0, np.int64)
        threshold, at = floor, 0
        while at < len(self.ids):
            upto = min(len(self.ids), at + (BLOCK_STEP if at or threshold is not None else FIRST_STEP))
            essential = len(order)
            if threshold is not None and (rest < threshold).any():
                essential = int(np.argmax(rest < threshold))
            terms = order[:essential]
            if essential == len(order):
                partial = rows[at:upto] @ weights
            else:
                partial = weights[terms] @ postings[terms, at:upto]
            alive = np.arange(at, upto)
            keep = self.ids[at:upto] != own
            if threshold is not None:
                keep &= partial + rest[essential] >= threshold
            alive, partial = alive[keep], partial[keep]
            for step in range(essential, len(order), PROBE_STEP):
                terms = order[step : step + PROBE_STEP]
                partial = partial + rows[np.ix_(alive, terms)] @ weights[terms]
                keep = partial + rest[min(step + PROBE_STEP, len(order))] >= threshold
                alive, partial = alive[keep], partial[keep]
            ids = np.r_[best_ids, self.ids[alive]]
            scores = np.r_[best, partial.astype(np.int64)]
            first = np.lexsort((ids, -scores))[:k]
            best_ids, best = ids[first], scores[first]
            if len(best) == k:
                threshold = int(best[-1]) if threshold is None else max(threshold, int(best[-1]))
            at = upto
        return best_ids, best


def narrow(terms: np.ndarray) -> np.ndarray:
    """Which rows' scores among each other, and all partial sums, stay within 62 bits."""
    limit = math.isqrt((1 << 62) // max(1, terms.shape[1]))
    return (np.abs(terms) <= limit).all(axis=1)


def exact_top(ids: np.ndarray, terms: np.ndarray, own: int, query: np.ndarray, k: int) -> tuple[list, list]:
    """``Shard.top`` in Python integers, whatever their size."""
    q = query.tolist()
    best = heapq.nsmallest(k, ((-sum(a * b for a, b in zip(q, row)), i)
                               for i, row in zip(ids.tolist(), terms.tolist()) if i != own))
    if any(not -(1 << 63) <= -s < 1 << 63 for s, _ in best):
        raise OverflowError(f"maxscore: a score of query {own} doesn't fit 64 bits")
    return [i for _, i in best], [-s for s, _ in best]


FOUND = "row long, query_id long, id long, score long"


def _search(rows: DataFrame, asked: DataFrame, shards: int, k: int) -> DataFrame:
    """``FOUND`` of the k best rows of ``asked``'s shard for each of its rows.

    Rows of a shard come first and make it; then queries pass by, batch after batch.
    """
    spark = rows.sparkSession
    none = F.lit(None).cast("long")
    dealt = (
        rows.select("shard", F.lit(0).alias("role"), "row", "id", none.alias("floor"), "terms")
        .unionByName(asked.select("shard", F.lit(1).alias("role"), "row", "id", "floor", "terms"))
        .repartition(max(shards, shuffle_partitions(spark)), "shard")
        .sortWithinPartitions("shard", "role")
    )

    def run(batches):
        now, gathered, by_size = None, [], {}

        def build():
            for pdf in gathered:
                for size, part in pdf.groupby(pdf["terms"].map(len)):
                    by_size.setdefault(size, []).append(
                        (part["id"].to_numpy(np.int64), np.stack(part["terms"].to_numpy()).astype(np.int64))
                    )
            gathered.clear()
            for size, parts in by_size.items():
                ids, terms = (np.concatenate(x) for x in zip(*parts))
                fine = narrow(terms)
                by_size[size] = (Shard(ids[fine], terms[fine]) if fine.any() else None, ids[~fine], terms[~fine])

        for pdf in batches:
            out = []
            for shard, part in pdf.groupby("shard"):
                if shard != now:
                    now, gathered, by_size = shard, [], {}
                own = part["role"] == 0
                if own.any():
                    gathered.append(part.loc[own, ["id", "terms"]])
                ask = part[~own]
                if len(ask) and gathered:
                    build()
                for row, q, floor, query in zip(ask["row"], ask["id"], ask["floor"], ask["terms"]):
                    if len(query) not in by_size:
                        continue
                    own_shard, ids, terms = by_size[len(query)]
                    query = np.asarray(query, np.int64)
                    floor = None if pd.isna(floor) else int(floor)
                    parts = []
                    if narrow(query[None, :])[0]:
                        if own_shard is not None:
                            parts.append(own_shard.top(q, query, k, floor))
                        if len(ids):
                            parts.append(exact_top(ids, terms, q, query, k))
                    else:
                        if own_shard is not None:
                            parts.append(exact_top(own_shard.ids, own_shard.in_kind(np.int64)[0], q, query, k))
                        if len(ids):
                            parts.append(exact_top(ids, terms, q, query, k))
                    out += [pd.DataFrame({"row": row, "query_id": q, "id": i, "score": s}, dtype=np.int64) for i, s in parts]
            if out:
                yield pd.concat(out)

    return dealt.mapInPandas(run, FOUND)


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id",
    vector_col: str = "embedding", scale: int = 64,
) -> DataFrame:
    """query_id, rank (from 1), id_col, score of every query's k best other rows."""
    ship(vectors.sparkSession)
    items = quantised(vectors, is_query, id_col, vector_col, scale)
    rows = materialise(items.withColumn("row", F.monotonically_increasing_id()))  # fixed by being written
    shards = max(1, -(-rows.count() // SHARD_ROWS))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))
    asked = rows.filter("asks")
    home = materialise(_search(rows, asked.withColumn("floor", F.lit(None).cast("long")), shards, k))
    found = home
    if shards > 1:
        least = home.groupBy("row").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).select(
            "row", F.when(F.col("n") >= k, F.col("least")).alias("floor")
        )
        others = F.filter(F.sequence(F.lit(0), F.lit(shards - 1)), lambda x: x != F.col("shard"))
        away = asked.join(least, "row", "left").withColumn("shard", F.explode(others))
        found = home.unionByName(_search(rows, away, shards, k))
    order = Window.partitionBy("row").orderBy(F.desc("score"), "id")
    return (
        found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        .select("query_id", "rank", F.col("id").alias(id_col), "score")
    )
