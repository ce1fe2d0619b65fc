"""Nearest neighbours by an inverted multi-index.

Each half of a vector is quantised by itself, so k centroids a half give k * k cells. A query meets
the cells in order of the summed scores of their two centroids, with a heap over centroid pairs, and
the entries of the cells it visits are ranked again by their exact score.

A first search of a few cells gives the score that its last neighbour has to beat; the second visits
every cell whose summed score, with `slack` times what its entries' residuals usually add, reaches
that score. So how many cells a query visits follows from the vectors, and there is no cap.
"""

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sunsieve.llm.common import Batches
from sunsieve.sources.shared import landed

#: Vectors that the centroids are fitted to: those with the smallest hashes of their ids.
SAMPLE = 20_000
#: Centroids of a half: at least and at most.
CENTROIDS = (64, 1024)
#: Entries of a block of the index, and queries that meet it at once.
BLOCK, CHUNK = 8_192, 256
#: Neighbours wanted times this many entries are visited in the first search.
OPENING = 10
#: How many deviations of the residual's score a cell is granted.
SLACK = 3.0


@dataclass(frozen=True)
class Index:
    """Centroids of both halves, how far entries lie from them, and where the cells' entries are."""

    centroids: tuple[np.ndarray, np.ndarray]
    spread: tuple[np.ndarray, np.ndarray]
    counts: np.ndarray
    first: np.ndarray
    n_blocks: np.ndarray

    @property
    def k(self) -> int:
        return len(self.centroids[0])


def nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.argmax(x @ centroids.T - (centroids**2).sum(axis=1) / 2, axis=1)


def kmeans(x: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    """At most k centroids of the rows; an empty cluster keeps its centroid."""
    x = np.ascontiguousarray(x)
    rng = np.random.default_rng(seed)
    centroids = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        at = nearest(x, centroids)
        n = np.bincount(at, minlength=len(centroids))
        for d in range(x.shape[1]):
            total = np.bincount(at, x[:, d], len(centroids))
            centroids[:, d] = np.where(n > 0, total / np.maximum(n, 1), centroids[:, d])
    return centroids


def traverse(scores: tuple[np.ndarray, np.ndarray]) -> Iterator[tuple[float, int, int]]:
    """Centroid pairs by descending summed score, from a heap of the pairs next in line."""
    first, second = (np.argsort(-s, kind="stable") for s in scores)
    a, b = scores[0][first].tolist(), scores[1][second].tolist()
    rows, columns = first.tolist(), second.tolist()
    heap = [(-(a[0] + b[0]), 0, 0)]
    while heap:
        score, i, j = heapq.heappop(heap)
        yield -score, rows[i], columns[j]
        if j + 1 < len(b):
            heapq.heappush(heap, (-(a[i] + b[j + 1]), i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (-(a[i + 1] + b[0]), i + 1, 0))


def visit(index: Index, query: np.ndarray, enough: int, beat: float | None, slack: float) -> list[int]:
    """Cells that a query visits: until `enough` entries, or while a cell can still reach `beat`."""
    half = len(query) // 2
    parts = query[:half], query[half:]
    scores = tuple(c @ p for c, p in zip(index.centroids, parts))
    cells, seen = [], 0
    if beat is not None:
        # What a residual adds: its mean square along a direction, for either half.
        add = [s * float(p @ p) / len(p) for s, p in zip(index.spread, parts)]
        most = slack * float(np.sqrt(add[0].max() + add[1].max()))
    for score, i, j in traverse(scores):
        if beat is not None and score + most < beat:
            break
        cell = i * index.k + j
        n = int(index.counts[cell])
        if n and (beat is None or score + slack * (add[0][i] + add[1][j]) ** 0.5 >= beat):
            cells.append(cell)
            seen += n
        if beat is None and seen >= enough:
            break
    return cells


def _valid(df: DataFrame, id_col: str, vector: str) -> DataFrame:
    """(vec_id, v): rows with an id and a usable vector of the usual length, in double precision."""
    v = F.col(vector).cast("array<double>")
    # NaN and infinities fail the comparison with the largest finite number, or beat it.
    sound = F.coalesce(F.forall("v", lambda x: x.isNotNull() & (F.abs(x) <= 1.7976931348623157e308)), F.lit(False))
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where("vec_id IS NOT NULL")
    rows = rows.where(sound & F.exists("v", lambda x: x != 0))
    usual = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("v") == F.lit(usual.d if usual else 0))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.float64).reshape(-1, d)


def build(df: DataFrame, id_col: str, vector: str, sample: int = SAMPLE, seed: int = 0) -> tuple[Index | None, DataFrame, DataFrame]:
    """The index, all entries (vec_id, v, cell), landed, and blocks of entries packed in a row each."""
    rows = _valid(df, id_col, vector)
    few = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()
    schema = "vec_id long, v binary, cell int, away0 double, away1 double"
    if not few:
        empty = df.sparkSession.createDataFrame([], schema)
        return None, empty, empty
    x = np.array([r.v for r in few])
    half, n = x.shape[1] // 2, rows.count()
    k = int(np.clip((n / 64) ** 0.5, *CENTROIDS))
    found = tuple(kmeans(part, k, seed + s) for s, part in enumerate((x[:, :half], x[:, half:])))
    k = min(map(len, found))
    known = df.sparkSession.sparkContext.broadcast(tuple(c[:k] for c in found))

    def assign(batches: Batches) -> Batches:
        for batch in batches:
            v = np.asarray(batch.column("v").flatten(), dtype=np.float64).reshape(batch.num_rows, -1)
            parts = v[:, :half], v[:, half:]
            at = [nearest(p, c) for p, c in zip(parts, known.value)]
            away = [((p - c[a]) ** 2).sum(axis=1) for p, c, a in zip(parts, known.value, at)]
            raw = pa.array([r.tobytes() for r in v], pa.binary())
            cell = pa.array((at[0] * k + at[1]).astype(np.int32))
            columns = [batch.column("vec_id"), raw, cell, pa.array(away[0]), pa.array(away[1])]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "v", "cell", "away0", "away1"])

    entries = landed(rows.mapInArrow(assign, schema), "entries")
    totals = entries.groupBy("cell").agg(F.count("*").alias("n"), F.sum("away0").alias("a"), F.sum("away1").alias("b")).collect()
    counts, away = np.zeros(k * k, dtype=np.int64), np.zeros((2, k * k))
    for r in totals:  # a row per cell at most: its number is bounded by CENTROIDS
        counts[r.cell], away[0, r.cell], away[1, r.cell] = r.n, r.a, r.b
    # Cells share blocks in their order; one that is larger than a block has several to itself.
    n_blocks = np.maximum(1, -(-counts // BLOCK))
    shared = np.where(n_blocks == 1, counts, 0)
    place = np.cumsum(shared) // BLOCK
    large = np.cumsum(np.where(n_blocks > 1, n_blocks, 0)) - n_blocks + place[-1] + 1
    first = np.where(n_blocks == 1, place, large)
    by_half = [counts.reshape(k, k).sum(axis=1), counts.reshape(k, k).sum(axis=0)]
    spread = [away[0].reshape(k, k).sum(axis=1), away[1].reshape(k, k).sum(axis=0)]
    spread = tuple(s / np.maximum(1, c) for s, c in zip(spread, by_half))
    index = Index(tuple(c[:k] for c in found), spread, counts, first, n_blocks)
    where = df.sparkSession.sparkContext.broadcast((first, n_blocks))

    def deal(batches: Batches) -> Batches:
        for batch in batches:
            cell, salt = np.asarray(batch.column("cell")), np.asarray(batch.column("salt"))
            block = where.value[0][cell] + salt % where.value[1][cell]
            yield pa.RecordBatch.from_arrays([pa.array(block), *batch.columns[:3]], names=["block", "vec_id", "v", "cell"])

    dealt = entries.select("vec_id", "v", "cell", F.xxhash64("vec_id").alias("salt"))
    dealt = dealt.mapInArrow(deal, "block long, vec_id long, v binary, cell int")
    # A block holds BLOCK entries and one small cell more at most.
    packed = dealt.groupBy("block").agg(F.collect_list(F.struct("vec_id", "cell", "v")).alias("entries"))
    return index, entries, packed


def _search(queries: DataFrame, packed: DataFrame, index: Index, k: int, slack: float, n_queries: int) -> DataFrame:
    """(query_id, vec_id, score): the k best entries of the visited cells, for each query (query_id, v, beat)."""
    d = len(index.centroids[0][0]) + len(index.centroids[1][0])
    known = queries.sparkSession.sparkContext.broadcast(index)

    def route(batches: Batches) -> Batches:
        own = known.value
        for batch in batches:
            rows: list[tuple] = []
            for q, v, beat in zip(*(batch.column(c).to_pylist() for c in ("query_id", "v", "beat"))):
                cells = np.array(visit(own, np.frombuffer(v), OPENING * k, beat, slack), dtype=np.int64)
                blocks = np.concatenate([own.first[cells], *(own.first[cells] + s for s in range(1, int(own.n_blocks[cells].max(initial=1))))])
                reps = len(blocks) // max(1, len(cells))
                real = np.concatenate([own.n_blocks[cells] > s for s in range(reps)]) if reps else np.empty(0, bool)
                block, cell = blocks[real], np.tile(cells, reps)[real].astype(np.int32)
                by_block = np.argsort(block, kind="stable")  # once a query, then cut where the block changes
                block, cell = block[by_block], cell[by_block]
                cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
                rows += [(int(block[a]), q, v, cell[a:b]) for a, b in zip(cuts, cuts[1:]) if b > a]
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int32())]
            columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)] if rows else [pa.array([], kind) for kind in kinds]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "query_id", "v", "cells"])

    def rank(batches: Batches) -> Batches:
        names = ["query_id", "vec_id", "score"]
        for batch in batches:
            for asked, held in zip(batch.column("asked"), batch.column("entries")):
                asked, held = asked.values, held.values
                ids = np.asarray(held.field("vec_id"))
                v, q = _matrix(held.field("v"), d), _matrix(asked.field("v"), d)
                local, cell = np.unique(np.asarray(held.field("cell")), return_inverse=True)
                open_ = np.zeros((len(q), len(local)), dtype=bool)
                for row, cells in enumerate(asked.field("cells")):
                    cells = np.asarray(cells.values)
                    open_[row, np.searchsorted(local, cells[np.isin(cells, local)])] = True
                some = open_.any(axis=0)[cell]  # entries that any of these queries visits
                by_id = np.flatnonzero(some)[np.argsort(ids[some], kind="stable")]
                ids, v, cell = ids[by_id], v[by_id], cell[by_id]
                new = np.flatnonzero(np.diff(ids, prepend=ids[:1] - 1))  # where each id's rows start
                rough = np.where(open_[:, cell], q @ v.T, -np.inf)
                out: list[tuple] = []
                for row, query in enumerate(np.asarray(asked.field("query_id"))):
                    rough[row, ids == query] = -np.inf
                    near = rough[row]
                    if len(new) > k:  # the cut counts ids, each by its best row
                        own = near if len(new) == len(near) else np.maximum.reduceat(near, new)
                        least = np.partition(own, len(own) - k)[len(own) - k]
                        best = np.flatnonzero(near >= least - 1e-9 * (1 + abs(least)) if np.isfinite(least) else near > -np.inf)
                    else:
                        best = np.flatnonzero(near > -np.inf)
                    exact = (v[best] * q[row]).sum(axis=1)
                    order = np.lexsort((ids[best], -exact))
                    _, once = np.unique(ids[best][order], return_index=True)  # an id repeated counts once
                    for at in order[np.sort(once)][:k]:
                        out.append((query, ids[best[at]], exact[at]))
                columns = [pa.array(c) for c in zip(*out)] if out else [pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    chunks = max(1, -(-n_queries // CHUNK))
    # Few bytes but much work: dealt by the queries' number, which Spark would merge into one task by size.
    routed = queries.repartition(chunks).mapInArrow(route, "block long, query_id long, v binary, cells array<int>")
    # Hashing spreads queries evenly over chunks; a chunk is sized by the entries' count of a block.
    routed = routed.withColumn("chunk", F.pmod(F.xxhash64("query_id", "v"), F.lit(chunks)))
    asked = routed.groupBy("block", "chunk").agg(F.collect_list(F.struct("query_id", "v", "cells")).alias("asked"))
    met = asked.join(packed, "block").select("asked", "entries")
    return _ranked(met.mapInArrow(rank, "query_id long, vec_id long, score double"), k)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query's finds, each vec_id once."""
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def neighbours(
    df: DataFrame, asked: Column, k: int, id_col: str = "vec_id", vector: str = "embedding", slack: float = SLACK, sample: int = SAMPLE
) -> DataFrame:
    """query_id, rank, vec_id, score: for each row with `asked` its k nearest others by inner product.

    Ties go to the smaller vec_id. Rows without an id, or whose vector is null, zero, of another
    length than most or has null or non-finite components, take no part. Rows that repeat an id
    count once, with their better score; `asked` is a condition on vec_id. The index is fitted to
    `sample` vectors and holds every row. Fewer candidates than k give all of them.
    """
    index, entries, packed = build(df, id_col, vector, sample)
    if index is None:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    packed = landed(packed, "blocks")
    queries = entries.where(asked).select(F.col("vec_id").alias("query_id"), "v")
    n = queries.count()
    first = landed(_search(queries.withColumn("beat", F.lit(None).cast("double")), packed, index, k, slack, n), "first")
    # What the last neighbour has to beat; with fewer than k found, everything is visited.
    beat = first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    beat = beat.select("query_id", F.when(F.col("n") == k, F.col("least")).alias("least"))
    second = queries.join(beat, "query_id", "left")
    second = second.select("query_id", "v", F.coalesce("least", F.lit(float("-inf"))).alias("beat"))
    finds = ["query_id", "vec_id", "score"]
    found = _search(second, packed, index, k, slack, n).select(finds).union(first.select(finds))
    return _ranked(found, k).select("query_id", "rank", "vec_id", "score")
