"""Approximate nearest neighbours by inner product, with balanced posting lists.

Largest inner product becomes smallest distance by one more dimension (the square
root of the largest squared norm less the vector's own; 0 for queries). Centroids
are fitted on a bounded sample by k-means that splits clusters that grow too large,
so lists are balanced. A graph of each centroid's nearest centroids stays in memory;
a best-first search in it finds the nearest centroids of vectors and queries. Every
vector goes to its nearest list, and vectors near a boundary also to the lists whose
centroids are hardly farther (their distance within a ratio of the nearest). A query
reads the lists whose centroids are within a ratio of its nearest one; the ratio, the
most lists and the width of the search are fitted in the job, by the true neighbours (all
vectors compared) of a bounded set of queries, so they grow with the number of lists.
Each query's few nearest lists are searched first; of the others, vectors that score less
than the last of what these gave are left out. Only lists give results.

Equal vectors are one entry with the smallest ids, as many as a result may need, so
a vector that very many rows share is searched once. Lists longer than ``list_rows``
and query groups larger than ``query_rows`` are cut into parts, each one task's work.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import block_count, pick, store


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten() if len(column) else pa.array([], pa.float64())
    return np.asarray(flat, float).reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _squared(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x**2).sum(1)[:, None] - 2 * x @ centres.T + (centres**2).sum(1), 0)


def _closest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The nearest centroid of each row, of 1024 rows at a time."""
    return np.concatenate([_squared(x[at : at + 1024], centres).argmin(1) for at in range(0, len(x), 1024)])


def balanced_centroids(sample: np.ndarray, count: int, rounds: int = 12, most: float = 2.0, seed: int = 42) -> np.ndarray:
    """About ``count`` centroids; a cluster with more than ``most`` times its fair share
    is split in two, and empty ones go."""
    rng = np.random.default_rng(seed)
    count = max(1, min(count, len(sample)))
    centres = sample[rng.choice(len(sample), count, replace=False)].copy()
    for step in range(rounds):
        near = _closest(sample, centres)
        sizes = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, sample)
        centres = sums[sizes > 0] / sizes[sizes > 0, None]
        if step < rounds - 2:
            large = np.flatnonzero(sizes > most * len(sample) / count)
            for c in large:
                mine = sample[near == c]
                spread = mine.std(0)
                at = int(spread.argmax())
                high = mine[:, at] > np.median(mine[:, at])
                if high.any() and not high.all():
                    centres = np.r_[centres, [mine[high].mean(0)]]
    return centres


class Graph:
    """Centroids, each with its nearest ones and a few at random, searched best first."""

    def __init__(self, centres: np.ndarray, degree: int = 16, seed: int = 7, step: int = 4):
        self.centres, self.squared, self.step = centres, (centres**2).sum(1), step
        n = len(centres)
        degree = min(degree, max(n - 1, 1))
        rng = np.random.default_rng(seed)
        links = np.zeros((n, degree + 4), np.int64)
        for at in range(0, n, 1024):  # the distances of 1024 centroids at once
            apart = _squared(centres[at : at + 1024], centres)
            links[at : at + 1024, :degree] = np.argsort(apart, axis=1, kind="stable")[:, 1 : degree + 1] if n > 1 else 0
        links[:, degree:] = rng.integers(0, n, (n, 4))
        self.links = links
        self.entries = rng.choice(n, min(8, n), replace=False)

    def search(self, x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` nearest centroids that a best-first search of that beam width
        finds for each row, nearest first (-1 and inf where there are fewer), and
        their squared distances."""
        rows, centres = len(x), self.centres
        if width >= len(centres):
            return _order(x, centres)
        ids = np.full((rows, width), -1)
        apart = np.full((rows, width), np.inf)
        open_ = np.zeros((rows, width), bool)
        seen = np.zeros((rows, len(centres)), bool)
        new = np.tile(self.entries, (rows, 1))
        active = np.arange(rows)
        while len(active):
            d = (x[active] ** 2).sum(1)[:, None] - 2 * np.einsum("ijk,ik->ij", centres[new], x[active]) + self.squared[new]
            order = np.argsort(new, axis=1, kind="stable")
            new, d = np.take_along_axis(new, order, 1), np.maximum(np.take_along_axis(d, order, 1), 0)
            known = seen[active[:, None], new]
            known[:, 1:] |= new[:, 1:] == new[:, :-1]
            d[known] = np.inf
            seen[active[:, None], new] = True
            all_d = np.c_[apart[active], d]
            best = np.argsort(all_d, axis=1, kind="stable")[:, :width]
            near = np.take_along_axis(all_d, best, 1)
            ids[active] = np.where(np.isfinite(near), np.take_along_axis(np.c_[ids[active], new], best, 1), -1)
            apart[active] = near
            open_[active] = np.take_along_axis(np.c_[open_[active], np.isfinite(d)], best, 1)
            active = active[open_[active].any(1)]
            if len(active):
                # The nearest few whose links were not followed yet, or else the nearest again.
                far = np.where(open_[active], apart[active], np.inf)
                at = np.argsort(far, axis=1, kind="stable")[:, : self.step]
                at = np.where(np.isfinite(np.take_along_axis(far, at, 1)), at, at[:, :1])
                open_[active[:, None], at] = False
                new = self.links[ids[active[:, None], at]].reshape(len(active), -1)
        return ids, apart


def _within(apart: np.ndarray, ratio: float, most: int, radius: float) -> np.ndarray:
    """Which of the nearest centroids count: distance at most ratio times the least (or
    the usual radius, where a vector is its own centroid)."""
    least = np.maximum(np.sqrt(apart[:, :1]), radius)
    ok = np.isfinite(apart) & (np.sqrt(apart) <= ratio * least + 1e-12)
    ok[:, most:] = False
    return ok


def _order(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All centroids by their distance from each row, and the squared distances."""
    apart = _squared(x, centres)
    ids = np.argsort(apart, axis=1, kind="stable")
    return ids, np.take_along_axis(apart, ids, 1)


def _top(q: np.ndarray, v: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of q, row of v, score) of the ``n`` largest inner products of each row of q,
    and of all that equal the last."""
    n = min(n, len(v))
    near = q @ v.T
    last = np.partition(near, len(v) - n, axis=1)[:, len(v) - n]
    row, col = np.nonzero(near >= (last - 1e-9 * np.abs(last))[:, None])
    return row, col, np.einsum("ij,ij->i", q[row], v[col])


def fitted_probes(x: np.ndarray, graph: Graph, held: np.ndarray, probes: int, ratio: float, radius: float, goal: float) -> tuple[int, float, int]:
    """The most lists, the ratio and the width of the graph's search that reach ``goal`` of
    the true neighbours of the queries ``x`` (lifted) with the fewest lists read; no less
    than those given. ``held``: (row of x, neighbour, list), one row for each list that
    holds one."""
    count = len(graph.centres)
    _, pair = np.unique(held[:, :2], axis=0, return_inverse=True)
    row = np.zeros(pair.max() + 1, int)
    row[pair.ravel()] = held[:, 0]
    need = int(np.ceil(goal * len(row)))
    width = min(4 * probes, count)
    while True:
        ids, apart = graph.search(x, width)
        far = np.sqrt(apart) / np.maximum(np.maximum(np.sqrt(apart[:, :1]), radius), 1e-300)
        place = np.full((len(x), count), width)
        found = np.nonzero(ids >= 0)
        place[found[0], ids[found]] = found[1]
        first = np.full(len(row), width)  # the place of a neighbour's nearest list
        np.minimum.at(first, pair.ravel(), place[held[:, 0], held[:, 2]])
        at = np.where(first < width, far[row, np.minimum(first, width - 1)], np.inf)
        best, most = None, min(probes, width)
        while True:
            inside = np.sort(at[first < most])
            if len(inside) >= need:
                r = max(ratio, float(inside[need - 1]) * (1 + 1e-9))
                read = float((far[:, :most] <= r).sum(1).mean())
                if best is None or read < best[0]:
                    best = (read, most, r)
            if most == width:
                break
            most = min(width, most + max(8, most // 4))
        if best is not None:
            return best[1], best[2], width
        width = min(2 * width, count)


def _valid(vectors: DataFrame) -> DataFrame:
    """vec_id, v (doubles) of the rows that take part."""
    rows = vectors.withColumn("v", F.col("v").cast("array<double>")).where("v is not null and vec_id is not null and size(v) > 0")
    rows = rows.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))))
    rows = rows.where(F.exists("v", lambda x: x != 0))
    usual = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (usual["n"] if usual else 0))


def nearest(
    vectors: DataFrame,
    is_query: Column | None = None,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 20,
    max_sample: int = 40_000,
    list_size: int = 150,
    max_centroids: int = 4096,
    replicas: int = 4,
    boundary_ratio: float = 1.1,
    probes: int = 64,
    probe_ratio: float = 1.25,
    list_rows: int = 8192,
    query_rows: int = 4096,
    first_lists: int = 8,
    goal: float = 0.95,
    trials: int = 256,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` nearest found, by falling
    inner product of the original vectors in double precision, ties to the smaller id.

    ``is_query``: an expression over ``vec_id`` (default: divisible by 20). Candidates
    are all rows but the query's own. NULL or zero vectors, such with NULL or non-finite
    components or of another length than most, and NULL ids take no part; of rows that
    share an id each is a candidate. Fewer candidates than ``k``: all of them. A sample
    of at most ``max_sample`` distinct vectors fits the centroids, about one for each
    ``list_size`` vectors, at most ``max_centroids``; every vector is indexed.
    """
    rows = store(_valid(pick(vectors, vec_id=id_col, v=vector_col)), "ann-rows")
    query = F.pmod(F.col("vec_id"), F.lit(20)) == 0 if is_query is None else is_query
    # One entry for equal vectors, with the k + 1 smallest ids: a query's own may be one.
    key = F.xxhash64("v")
    least = F.slice(F.sort_array(F.collect_list("vec_id")), 1, k + 1)
    parts = rows.select("vec_id", "v", key.alias("h"), F.pmod(F.xxhash64("vec_id"), F.lit(block_count(rows.count()))).alias("salt"))
    numbered = parts.withColumn("nth", F.row_number().over(Window.partitionBy("h", "v", "salt").orderBy("vec_id")))
    first = numbered.where(F.col("nth") <= k + 1).groupBy("h", "v").agg(least.alias("ids"))
    first = first.withColumns({"entry": F.monotonically_increasing_id(), "first": F.col("ids")[0]})
    entries = store(first, "ann-entries")
    size = entries.count()
    empty = vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    if not size:
        return empty
    norm = float(entries.agg(F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))).first()[0])
    sample = entries.select("entry", "v").orderBy(F.xxhash64("entry"), "entry").limit(max_sample).toArrow()
    points = _matrix(sample["v"].combine_chunks())

    def lifted(x: np.ndarray) -> np.ndarray:
        return np.c_[x, np.sqrt(np.maximum(norm - (x**2).sum(1), 0))]

    graph = Graph(balanced_centroids(lifted(points), min(max_centroids, -(-size // list_size))))
    radius = float(np.median(np.sqrt(_squared(lifted(points[:2000]), graph.centres).min(1))))
    queries = rows.where(query).select("vec_id", "v", key.alias("h"))
    wanted = queries.select("h", "v").distinct()
    asked = store(entries.join(wanted, ["h", "v"], "left_semi").select("entry", "first", "v"), "ann-queries")

    def assign(ratio: float, most: int, width: int, sizes: np.ndarray | None = None):
        """Lists of entries, or of queries if the lists' ``sizes`` are known: then more
        lists are read until they must hold enough different vectors."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for at in range(0, whole.num_rows, 512):
                    batch = whole.slice(at, 512)
                    x = _matrix(batch["v"])
                    x = lifted(x) if sizes is None else np.c_[x, np.zeros(len(x))]
                    wide = width
                    while True:
                        ids, apart = graph.search(x, wide)
                        ok = _within(apart, ratio, most, radius)
                        if sizes is None:
                            break
                        held = np.cumsum(np.where(ids >= 0, sizes[ids], 0), axis=1)
                        enough = (k + 1) * replicas
                        ok |= (ids >= 0) & (np.c_[np.zeros(len(x)), held[:, :-1]] < enough)
                        if wide >= len(graph.centres) or (held[:, -1] >= enough).all():
                            break
                        wide *= 2
                    row, col = np.nonzero(ok)
                    yield pa.RecordBatch.from_pydict(
                        {"entry": batch["entry"].take(pa.array(row)), "first": batch["first"].take(pa.array(row)), "list": pa.array(ids[row, col], pa.int64()), "place": pa.array(col, pa.int64()), "v": batch["v"].take(pa.array(row))}
                    )

        return run

    kind = "entry bigint, first bigint, list bigint, place bigint, v array<double>"
    posted = store(entries.select("entry", "first", "v").mapInArrow(assign(boundary_ratio, replicas, replicas + 32), kind), "ann-lists")
    sizes = np.zeros(len(graph.centres), np.int64)
    for r in posted.groupBy("list").count().collect():  # one row a centroid
        sizes[r["list"]] = r["count"]
    # The trial queries' true neighbours, and the lists that hold them.
    trial = asked.select("entry", "v").orderBy(F.xxhash64("entry"), "entry").limit(trials).toArrow()
    tried, tried_entry = _matrix(trial["v"].combine_chunks()), trial["entry"].to_numpy()

    def true_ones(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.zeros((0, 2), np.int64), np.zeros(0)  # (trial, entry) and scores of this task
        for batch in batches:
            row, col, score = _top(tried, _matrix(batch["v"]), k + 1)
            other = batch["entry"].to_numpy()[col]
            pairs = np.r_[best[0], np.c_[row, other][other != tried_entry[row]]]
            score = np.r_[best[1], score[other != tried_entry[row]]]
            order = np.lexsort((pairs[:, 1], -score, pairs[:, 0]))
            pairs, score = pairs[order], score[order]
            kept = np.arange(len(pairs)) - np.searchsorted(pairs[:, 0], pairs[:, 0]) < k
            best = pairs[kept], score[kept]
        yield pa.RecordBatch.from_pydict({"trial": pa.array(best[0][:, 0], pa.int64()), "entry": pa.array(best[0][:, 1], pa.int64()), "score": pa.array(best[1], pa.float64())})

    width = 4 * probes
    if len(tried) and size > 1:
        true = entries.select("entry", "v").mapInArrow(true_ones, "trial bigint, entry bigint, score double")
        true = true.withColumn("nth", F.row_number().over(Window.partitionBy("trial").orderBy(F.desc("score"), "entry"))).where(F.col("nth") <= k)
        held = posted.join(F.broadcast(true.select("trial", "entry")), "entry").select("trial", "entry", "list").toArrow()
        held = np.c_[held["trial"].to_numpy(), held["entry"].to_numpy(), held["list"].to_numpy()]
        probes, probe_ratio, width = fitted_probes(np.c_[tried, np.zeros(len(tried))], graph, held, probes, probe_ratio, radius, goal)
    probing = store(asked.mapInArrow(assign(probe_ratio, probes, width, sizes), kind), "ann-probes")
    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out_q, out_e, out_s = [], [], []
        if left.num_rows and right.num_rows:
            v, q = _matrix(left["v"].combine_chunks()), _matrix(right["v"].combine_chunks())
            entry, asker = left["entry"].to_numpy(), right["entry"].to_numpy()
            first, least = left["first"].to_numpy(), right["least"].to_numpy()
            n = min(k + 1, len(v))
            for at in range(0, len(q), 256):
                # All that reach the last score, in exact order: ties to the smaller id.
                row, col, score = _top(q[at : at + 256], v, n)
                enough = score >= least[at + row] - 1e-9 * np.abs(least[at + row])
                row, col, score = row[enough], col[enough], score[enough]
                order = np.lexsort((first[col], -score, row))
                row, col, score = row[order], col[order], score[order]
                place = np.arange(len(row)) - np.searchsorted(row, row)
                out_q.append(asker[at + row[place < n]])
                out_e.append(entry[col[place < n]])
                out_s.append(score[place < n])
        return pa.table(
            {
                "query": pa.array(np.concatenate(out_q) if out_q else np.zeros(0, np.int64), pa.int64()),
                "entry": pa.array(np.concatenate(out_e) if out_e else np.zeros(0, np.int64), pa.int64()),
                "score": pa.array(np.concatenate(out_s) if out_s else np.zeros(0), pa.float64()),
            }
        )

    def searched(probing: DataFrame) -> DataFrame:
        """(query, entry, score): the best of each list read, none under ``least``."""
        # Lists and query groups in parts of bounded size; a query part meets every list part.
        list_parts = F.ceil(F.col("n") / F.lit(list_rows)).cast("int")
        lists = posted.groupBy("list").agg(F.count("*").alias("n")).select("list", list_parts.alias("list_parts"))
        groups = probing.groupBy("list").agg(F.count("*").alias("n")).select("list", F.ceil(F.col("n") / F.lit(query_rows)).cast("int").alias("query_parts"))
        cut = store(lists.join(groups, "list"), "ann-parts")  # one row a centroid
        small = F.broadcast(cut)  # at most max_centroids and their splits
        many = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        list_side = posted.join(small, "list").select("list", F.pmod(F.xxhash64("entry"), F.col("list_parts")).cast("int").alias("lp"), many("query_parts").alias("qp"), "entry", "first", "v")
        query_side = probing.join(small, "list").select("list", F.pmod(F.xxhash64("entry"), F.col("query_parts")).cast("int").alias("qp"), many("list_parts").alias("lp"), "entry", "v", "least")
        keys = ["list", "lp", "qp"]
        return list_side.groupBy(*keys).cogroup(query_side.groupBy(*keys)).applyInArrow(search, "query bigint, entry bigint, score double")

    # A query's last score in its nearest lists; fewer than k + 1 there give no bound.
    nearest_lists = F.col("place") < first_lists
    near = store(searched(probing.where(nearest_lists).withColumn("least", F.lit(float("-inf")))), "ann-near")
    by_score = Window.partitionBy("query").orderBy(F.desc("score"), "entry")
    ranked = near.groupBy("query", "entry").agg(F.max("score").alias("score")).withColumn("nth", F.row_number().over(by_score))
    bounds = ranked.where(F.col("nth") == k + 1).select(F.col("query").alias("entry"), F.col("score").alias("least"))
    rest = probing.where(~nearest_lists).join(bounds, "entry", "left").withColumn("least", F.coalesce("least", F.lit(float("-inf"))))
    # A vector in several lists is found several times, with the same score.
    hits = near.union(searched(rest))
    hits = hits.groupBy("query", "entry").agg(F.max("score").alias("score"))
    hits = hits.join(entries.select("entry", "ids"), "entry").select("query", "score", F.explode("ids").alias("vec_id"))
    place = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    best = hits.withColumn("place", F.row_number().over(place)).where(F.col("place") <= k + 1)
    found = best.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("found"))
    found = store(found.join(entries.select(F.col("entry").alias("query"), "h", "v"), "query").select("h", "v", "found"), "ann-found")
    own = queries.select(F.col("vec_id").alias("query_id"), "h", "v").join(found, ["h", "v"])
    others = F.slice(_without_own(), 1, k)
    return own.select("query_id", F.posexplode(others).alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score")
    )


def _without_own() -> Column:
    """The found ones without the query's own row: one of them, if its id repeats."""
    own = F.array_position(F.transform("found", lambda x: x["vec_id"]), F.col("query_id"))
    return F.filter("found", lambda x, i: (own == 0) | (i + 1 != own))
