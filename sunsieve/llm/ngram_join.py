"""Near-duplicate documents by a Jaccard self-join on word n-grams, with rare-first prefix filters.

Texts with the same shingle set are one node. A node's shingles are ordered rare first (by a
fixed-size count of all documents, ties by hash); two sets that overlap enough share a shingle
among the first n - ceil(t n) + 1 of each, so only these prefixes are indexed and joined. Length,
positional and suffix filters drop what cannot reach the threshold, and each remaining pair is
verified once, on the whole sets.

A shingle's group of m nodes is never expanded into pairs. First each node meets only one of its
groups' leaders, the nodes in which a shingle stands earliest. The components of those links are
then taken as known, and only pairs of different components are tried: first of nodes and other
leaders, then all others of groups that hold several components. These are cut into blocks by
component and size, and only blocks whose sizes and positions allow a link meet, so a passage that
many documents share under the threshold makes no pairs at all. What is left out lies inside a
component already, so the components are those of all links.
"""

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sunsieve.llm.common import Batches, maybe_broadcast, runs, text_of
from sunsieve.llm.components import components
from sunsieve.llm.shingles import mix, shingle_sets, signature
from sunsieve.sources.shared import landed

WIDTH = 5
#: Similarity in percent from which two sets link.
PERCENT = 80
#: Counters that order shingles by frequency; the size of the only broadcast, 8 MB.
COUNTERS = 1 << 21
CHUNKS = 64
#: Nodes a task remembers so as not to index copies again.
REMEMBERED = 1 << 20
#: Nodes of a group that one task looks at together; a group whose counter says more is cut by node.
CROWD = 20_000
#: Nodes of a group that meet another block of the group under one key.
BLOCK = 1024

_BINS = 4  # of the suffix filter, a byte each


def _slots(shingles: np.ndarray, counters: int) -> np.ndarray:
    return (shingles & np.uint64(counters - 1)).astype(np.int64)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))


def _scan(docs: DataFrame, width: int, counters: int) -> DataFrame:
    """Per document its set's size and signature; per task its shingle counts, in chunks."""
    schema = "doc_id long, n_shingles long, node long, chunk int, counts binary"
    names = ["doc_id", "n_shingles", "node", "chunk", "counts"]
    size = counters // CHUNKS

    def step(batches: Batches) -> Batches:
        counts = np.zeros(counters, dtype=np.int64)
        for batch in batches:
            for run in runs(batch, "text", 1 << 20):
                sets = list(shingle_sets(run.column("text"), width))
                counts += np.bincount(_slots(np.concatenate(sets), counters), minlength=counters)
                n = len(sets)
                columns = [
                    run.column("doc_id"),
                    pa.array([len(x) for x in sets], pa.int64()),
                    pa.array([signature(x) for x in sets], pa.int64()),
                    pa.nulls(n, pa.int32()),
                    pa.nulls(n, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)
        small = np.minimum(counts, 65_535).astype("<u2").reshape(CHUNKS, size)
        for k in np.flatnonzero(small.any(axis=1)):
            columns = [pa.nulls(1, pa.int64())] * 3 + [pa.array([k], pa.int32()), pa.array([small[k].tobytes()])]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return _texts(docs).mapInArrow(step, schema)


def _frequencies(scanned: DataFrame, counters: int) -> np.ndarray:
    """The counters of all tasks, added up; their number is fixed, whatever the corpus."""
    size = counters // CHUNKS

    def add(batches: Batches) -> Batches:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, raw in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist()):
                total[k] = total.get(k, 0) + np.frombuffer(raw, "<u2").astype(np.int64)
        for k, values in total.items():
            packed = np.minimum(values, 2**32 - 1).astype("<u4").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([packed])], names=["chunk", "counts"])

    rows = scanned.where("chunk IS NOT NULL").select("chunk", "counts").repartition(CHUNKS, "chunk")
    out = np.zeros(counters, dtype=np.uint32)
    for row in rows.mapInArrow(add, "chunk int, counts binary").toLocalIterator():
        out[row.chunk * size : (row.chunk + 1) * size] = np.frombuffer(row.counts, "<u4")
    return out


def _suffix_bins(bins: np.ndarray, prefix: int) -> np.ndarray:
    """For each prefix position the counts, by bin, of the shingles behind it; a byte a bin, 255 at most."""
    out = np.zeros(prefix, dtype=np.uint32)
    for b in range(_BINS):
        hit = (bins == b).astype(np.int64)
        behind = hit.sum() - np.cumsum(hit[:prefix])
        out |= np.minimum(behind, 255).astype(np.uint32) << np.uint32(8 * b)
    return out.view(np.int32)


def _index(docs: DataFrame, frequencies: np.ndarray, width: int, percent: int, crowd: int = CROWD) -> DataFrame:
    """A row per prefix shingle of each node: token, node, size, pos, suffix, part, parts.

    A token that by its counter may have more than `crowd` nodes has several parts, by node. Where
    tokens share counters, eight times their mean is the least bound, so that few tokens are cut.
    """
    spark = docs.sparkSession
    known = spark.sparkContext.broadcast(frequencies)
    names = ["token", "node", "size", "pos", "suffix", "part", "parts"]
    crowd = max(crowd, 8 * math.ceil(frequencies.mean()))

    def step(batches: Batches) -> Batches:
        counts, done = known.value, set()
        for batch in batches:
            for run in runs(batch, "text", 1 << 20):
                parts: list[tuple] = []
                for x in shingle_sets(run.column("text"), width):
                    n, node = len(x), signature(x)
                    if not n or node in done:
                        continue
                    if len(done) < REMEMBERED:
                        done.add(node)
                    often = counts[_slots(x, len(counts))]
                    order = np.argsort(often, kind="stable")
                    prefix = n - math.ceil(percent * n / 100) + 1
                    x = x[order]
                    bins = (mix(x) >> np.uint64(62)).astype(np.int64)
                    whole = np.full(prefix, node, dtype=np.int64), np.full(prefix, n, dtype=np.int32)
                    cuts = often[order[:prefix]].astype(np.int64) // crowd + 1
                    place = np.arange(prefix, dtype=np.int32), _suffix_bins(bins, prefix), (node % cuts).astype(np.int32), cuts.astype(np.int32)
                    parts.append((x[:prefix].view(np.int64), *whole, *place))
                if parts:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts)], names=names)

    return _texts(docs).mapInArrow(step, "token long, node long, size int, pos int, suffix int, part int, parts int")


def _may_link(a: str, b: str, percent: int) -> Column:
    """Length, positional and suffix filters at a shingle that two nodes share.

    They hold at the first shingle that two similar sets share: what they have in common then lies
    at and behind it. `a` and `b` are prefixes of column names.
    """
    size_a, size_b, pos_a, pos_b = (F.col(f"{x}{c}") for c in ("size", "pos") for x in (a, b))
    need = F.ceil(percent * (size_a + size_b) / (100 + percent))
    behind_a, behind_b = size_a - pos_a - 1, size_b - pos_b - 1
    length = (100 * size_a >= percent * size_b) & (100 * size_b >= percent * size_a)
    positional = 1 + F.least(behind_a, behind_b) >= need

    def of(x: str, k: int) -> Column:
        return F.shiftright(F.col(f"{x}suffix"), 8 * k).bitwiseAND(F.lit(255))

    apart = sum((F.abs(of(a, k) - of(b, k)) for k in range(1, _BINS)), F.abs(of(a, 0) - of(b, 0)))
    suffix = 2 * (need - 1) <= behind_a + behind_b - apart
    return length & positional & suffix


def _verified(pairs: DataFrame, docs: DataFrame, members: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose whole sets are similar enough. Only their texts are read again."""
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = landed(members.join(nodes, "node").groupBy("node").agg(F.min("doc_id").alias("doc_id")), "wanted")
    few = maybe_broadcast(wanted.select(F.col("doc_id").alias("wanted")).distinct(), wanted.count())
    texts = _texts(docs)
    texts = texts.join(few, F.col("doc_id").eqNullSafe(F.col("wanted")), "left_semi")

    def step(batches: Batches) -> Batches:
        for batch in batches:
            for run in runs(batch, "text", 1 << 20):
                sets = list(shingle_sets(run.column("text"), width))
                columns = [
                    pa.array([signature(x) for x in sets], pa.int64()),
                    pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "shingles"])

    sets = landed(texts.mapInArrow(step, "node long, shingles array<long>"), "sets")
    if sets.count() > sets.select("node").distinct().count():  # rows that repeat a doc_id
        sets = landed(sets.dropDuplicates(["node"]), "sets")
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))
    both = F.size(F.array_intersect("of_a", "of_b"))
    similar = 100 * both >= percent * (F.size("of_a") + F.size("of_b") - both)
    # Few pairs meet the sets where these lie; only the sets of pairs are then shuffled.
    found = right.join(maybe_broadcast(pairs, pairs.count()), "b")
    return found.join(left, "a").where(similar).select("a", "b")


def _ordered(a: str, b: str) -> tuple[Column, Column]:
    return F.least(a, b).alias("a"), F.greatest(a, b).alias("b")


def _shared(index: DataFrame) -> DataFrame:
    """The rows of tokens that several nodes have, each with its group's leader."""
    group = Window.partitionBy("token", "part")
    leader = F.min(F.struct("pos", "size", "node", "suffix")).over(group).alias("leader")
    ends = (F.min("node").over(group).alias("first"), F.max("node").over(group).alias("last"))
    rows = landed(index.select("token", "node", "size", "pos", "suffix", "parts", leader, *ends).where("parts > 1 OR first <> last"), "shared")
    cut = rows.where("parts > 1").groupBy("token").agg(F.min("leader").alias("leader"), F.min("first").alias("first"), F.max("last").alias("last"))
    cut = landed(cut.where("first <> last").select("token", "leader"), "cut")
    columns = ["token", "node", "size", "pos", "suffix", "leader"]
    again = rows.where("parts > 1").drop("leader").join(maybe_broadcast(cut, cut.count()), "token")
    return rows.where("parts = 1").select(columns).union(again.select(columns))


def near_duplicates(
    docs: DataFrame,
    width: int = WIDTH,
    percent: int = PERCENT,
    counters: int = COUNTERS,
    crowd: int = CROWD,
    block: int = BLOCK,
) -> DataFrame:
    """doc_id, n_shingles and component_id of every document, the smallest doc_id its links reach.

    A null text is empty; texts without words have no shingle, link with nothing and are their own
    component. Equal sets are linked. Repeated rows give repeated rows; a null doc_id is kept and
    counts as a component's name only if the component has no other. Other columns are not read.
    Sets are compared by 64-bit hashes of shingles, and equal sets found by a 64-bit hash. `crowd`
    and `block` bound what one task sees of a group and do not change the result.
    """
    scanned = landed(_scan(docs, width, counters), "shingled")
    members = scanned.where("chunk IS NULL").select("doc_id", "n_shingles", "node")
    full = members.where("n_shingles > 0")
    shared = _shared(_index(docs, _frequencies(scanned, counters), width, percent, crowd))

    met = shared.select("node", "size", "pos", "suffix", *(F.col(f"leader.{c}").alias(f"leader_{c}") for c in ("node", "size", "pos", "suffix")))
    led = met.where("node <> leader_node").where(_may_link("", "leader_", percent))
    led = landed(led.groupBy("node", "leader_node").agg(F.count("*").alias("n")), "led")

    # Each node's best leader first; then the other leaders, then all other pairs, of different components.
    best = led.groupBy("node").agg(F.max_by("leader_node", F.struct("n", "leader_node")).alias("leader_node"))
    known = None
    tried = pairs = landed(best.select(*_ordered("node", "leader_node")).distinct(), "pairs")
    for find in (lambda: _apart(led, known), lambda: _across(shared, known, percent, block), None):
        links = landed(_verified(pairs, docs, full, width, percent), "verified")
        if known is None or not links.isEmpty():
            old = [] if known is None else [known.select(F.col("node").alias("a"), F.col("label").alias("b"))]
            known = landed(components(reduce(DataFrame.union, old, links)), "known")
        if find:
            pairs = landed(find().join(tried, ["a", "b"], "left_anti"), "pairs")
            tried = tried.union(pairs)
    return _named(members, known)


def _apart(led: DataFrame, known: DataFrame) -> DataFrame:
    """The pairs of nodes and leaders that are not in one component."""
    other = known.select(F.col("node").alias("leader_node"), F.col("label").alias("leader_label"))
    n = known.count()
    pairs = led.join(maybe_broadcast(known, n), "node", "left").join(maybe_broadcast(other, n), "leader_node", "left")
    one = F.coalesce("label", "node") == F.coalesce("leader_label", "leader_node")
    return pairs.where(~one).select(*_ordered("node", "leader_node")).distinct()


def _blocked(shared: DataFrame, known: DataFrame, percent: int, block: int) -> DataFrame:
    """Rows (x_, y_) of nodes that share a prefix shingle, by blocks that may hold a link.

    x is the smaller of a pair. By its position a node can link with no larger partner than
    `reach`, and from most of its prefix it can link with smaller partners only, so it is no x
    there. Cells hold the nodes of a group of about one size and, where a component has many in the
    group, of one component; two cells meet if sizes and reaches allow it and they are not of one
    component. Each pair of their blocks is a key of its own.
    """
    own = shared.select("token", "node", "size", "pos", "suffix")
    own = own.join(maybe_broadcast(known, known.count()), "node", "left").withColumn("label", F.coalesce("label", "node"))
    groups = own.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    groups = landed(groups.where("low <> high").select("token"), "groups")
    reach = F.floor((100 + percent) * (F.col("size") - F.col("pos")) / percent) - F.col("size")
    level = F.floor(8 * F.log2("size")).cast("int")
    mixed = own.join(maybe_broadcast(groups, groups.count()), "token").distinct()
    mixed = landed(mixed.withColumns({"reach": reach, "level": level}), "mixed")

    large = mixed.groupBy("token", "label").agg(F.count("*").alias("n")).where(F.col("n") >= block)
    large = landed(large.select("token", "label", F.lit(True).alias("large")), "large")
    rows = mixed.join(maybe_broadcast(large, large.count()), ["token", "label"], "left")
    rows = rows.withColumn("large", F.coalesce("large", F.lit(False)))
    cell = ["token", "level", "large", "of"]
    rows = rows.withColumn("of", F.when(F.col("large"), F.col("label")).otherwise(F.lit(0)))
    as_x = F.col("reach") >= F.col("size")
    cells = landed(
        rows.groupBy(cell).agg(
            F.count("*").alias("n"),
            F.count_if(as_x).alias("n_x"),
            F.min(F.when(as_x, F.col("size"))).alias("least_x"),
            F.max(F.when(as_x, F.col("reach"))).alias("reach_x"),
            F.min("size").alias("least"),
            F.max("size").alias("most"),
            F.max("reach").alias("reach"),
        ),
        "cells",
    )
    x, y = (cells.select("token", *(F.col(c).alias(f"{p}_{c}") for c in cells.columns[1:])) for p in "xy")
    meet = x.where("x_n_x > 0").join(y, "token").where(
        "y_most >= x_least_x AND y_least <= x_reach_x AND x_least_x <= y_reach AND NOT (x_large AND y_large AND x_of = y_of)"
    )
    # Written once with their names: every later pass reads the same.
    meet = meet.select(
        F.monotonically_increasing_id().alias("meet"),
        "token",
        *(F.col(f"{p}_{c}") for p in "xy" for c in cell[1:]),
        F.ceil(F.col("x_n_x") / block).cast("int").alias("x_blocks"),
        F.ceil(F.col("y_n") / block).cast("int").alias("y_blocks"),
    )
    meet = landed(meet, "meet")
    n = meet.count()

    def side(rows: DataFrame, p: str, other: str) -> DataFrame:
        named = meet.select("meet", "token", *(F.col(f"{p}_{c}").alias(c) for c in cell[1:]), "x_blocks", "y_blocks")
        found = rows.join(maybe_broadcast(named, n), cell)
        mine = F.pmod("node", F.col(f"{p}_blocks")).cast("int").alias(f"{p}_block")
        theirs = F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1)).alias(f"{other}_block")
        return found.select("meet", mine, theirs, *(F.col(c).alias(f"{p}_{c}") for c in ("node", "size", "pos", "suffix", "label", "reach")))

    once = (F.col("x_size") < F.col("y_size")) | ((F.col("x_size") == F.col("y_size")) & (F.col("x_node") < F.col("y_node")))
    near = (F.col("y_size") <= F.col("x_reach")) & (F.col("x_size") <= F.col("y_reach"))
    met = side(rows.where(as_x), "x", "y").join(side(rows, "y", "x"), ["meet", "x_block", "y_block"])
    return met.where(once & near & (F.col("x_label") != F.col("y_label")))


def _across(shared: DataFrame, known: DataFrame, percent: int, block: int) -> DataFrame:
    """Pairs of nodes from different components that share a prefix shingle and pass the filters."""
    met = _blocked(shared, known, percent, block).where(_may_link("x_", "y_", percent))
    return met.select(*_ordered("x_node", "y_node")).distinct()


def _looked_up(rows: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """The rows with the columns of `found`, unique by key, which tells in `n` how many rows a key has.

    Keys of many rows, at most 100,000 of them, are found by broadcast, so that no task gets all
    rows of such a key; the others meet in a shuffle.
    """
    total = found.agg(F.sum("n")).first()[0] or 0
    many = max(1000, total // 100_000)
    busy = landed(found.where(F.col("n") > many).drop("n"), "busy")
    hot = rows.join(F.broadcast(busy), key)
    rest = rows.join(F.broadcast(busy.select(key)), key, "left_anti").join(found.where(F.col("n") <= many).drop("n"), key)
    return hot.unionByName(rest)


def _named(members: DataFrame, known: DataFrame) -> DataFrame:
    full = members.where("n_shingles > 0")
    own = landed(full.groupBy("node").agg(F.min("doc_id").alias("own"), F.count("*").alias("n")), "own")
    # Components of several nodes by their label, then all nodes by what they are called.
    linked = landed(known.join(own, "node").select("node", "label", "own"), "linked")
    names = landed(linked.groupBy("label").agg(F.min("own").alias("component_id"), F.count("*").alias("n")), "names")
    called = _looked_up(linked.select("node", "label"), names, "label").select("node", "label", "component_id")
    nodes = own.join(called, "node", "left")
    nodes = landed(nodes.select("node", "n", F.when(F.col("label").isNull(), F.col("own")).otherwise(F.col("component_id")).alias("component_id")), "called")
    linked = _looked_up(full, nodes, "node").select("doc_id", "n_shingles", "component_id")
    return linked.union(members.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
