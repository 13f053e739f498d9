"""Approximate nearest neighbours over balanced posting lists.

Centroids are fitted on a bounded sample and linked in a graph in memory, in
which a best-first search finds the centroids near a vector. Every vector goes
to the list of its nearest centroid and, where it lies near a boundary, to some
more: those within `boundary` times the least squared distance, `copies` lists
at the most. A list longer than `list_rows` is split into sublists by hash, so
lists are balanced whatever the data. There is a list for each `rows_per_list`
vectors, as far as the sample can fit them (an eighth of `sample_rows`); many
centroids are fitted in two levels.

A query reads the lists whose squared distance is within a ratio of that of the
nearest. The ratio is tuned: some rows of the sample, as queries, have their
nearest of the sample in lists at known ratios, and the one that reaches the
share `recall` of these is taken. The sample serves these two fits alone; every
answer comes from a list.

The measure is the largest inner product. It is searched as Euclidean distance
in one more dimension: vectors, scaled by the largest norm, are lifted to the
unit sphere, and queries get a zero there; distances then order as products do.

Of equal vectors only the least `k` + 1 ids can be among the `k` nearest of any
query, since ties go to the smaller id; longer groups of equal vectors are cut
to these before they are indexed, without an effect on the result.

Queries and vectors meet in groups of a sublist and a block of queries, both
bounded, so no group grows with the data. A query first reads its `first` nearest
lists; of the others only rows that reach the k-th best of these are sent on.
Each partition keeps the k best of a query before anything is sent.

Edge cases: vectors that are null, zero, or hold null or non-finite numbers,
and rows without id, take no part. Vectors of different lengths have no
product: each length is searched by itself. Fewer candidates than k: all. Rows
that repeat id and vector are one row. Rows that repeat an id with another
vector are rows of their own: each may be an answer, each is a query with k
answers of its own under that id, and leaves out itself alone. Ties go to the
smaller id. Only the id and the vector are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skysift.llm.common import written
from skysift.llm.vectors import matrix, number_kind, packed_vectors, widths


class CentroidGraph:
    """Centroids, and for each its nearest others, those it is among the very nearest of, and a few far ones."""

    def __init__(self, centroids: np.ndarray, near: int = 16, far: int = 4, seed: int = 7):
        self.c = centroids
        self.norm = (centroids**2).sum(1)
        n = len(centroids)
        near = min(near, n - 1)
        links = np.zeros((n, near), np.int64)
        for a in range(0, n, 1024):
            d = self.norm[None, :] - 2 * centroids[a : a + 1024] @ centroids.T
            d[np.arange(len(d)), np.arange(a, a + len(d))] = np.inf
            some = np.argpartition(d, near - 1, axis=1)[:, :near] if near else np.zeros((len(d), 0), np.int64)
            links[a : a + 1024] = np.take_along_axis(some, np.argsort(np.take_along_axis(d, some, 1), axis=1), 1)
        own = np.arange(n)
        to = [[*a, *b] for a, b in zip(links.tolist(), np.random.default_rng(seed).integers(0, n, (n, far)).tolist(), strict=True)]
        # Links back, or a centroid that lies apart is no one's neighbour and never found.
        for i, row in enumerate(links[:, :4].tolist()):
            for k in row:
                to[k].append(i)
        width = max(map(len, to))
        self.links = np.array([list(dict.fromkeys(t)) + [i] * (width - len(dict.fromkeys(t))) for i, t in zip(own.tolist(), to, strict=True)])
        self.entry = np.argsort(((centroids - centroids.mean(0)) ** 2).sum(1))[: min(n, 8)]

    def search(self, x: np.ndarray, k: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(centroids, squared distances), nearest first, k of each row of x; -1 where there are fewer."""
        n, m = len(x), len(self.c)
        k = min(k, m)
        beam = min(max(beam, k), m)
        own = (x**2).sum(1)
        seen, rows = np.zeros((n, m), bool), np.arange(n)[:, None]
        ids = np.tile(self.entry, (n, 1))
        seen[rows, ids] = True
        dist = own[:, None] + self.norm[ids] - 2 * np.einsum("nd,nkd->nk", x, self.c[ids])
        open_ = np.ones(ids.shape, bool)
        for _ in range(4 * beam):
            waiting = np.where(open_, dist, np.inf)
            best = waiting.argmin(1)
            live = np.nonzero(np.isfinite(waiting[np.arange(n), best]))[0]
            if not len(live):
                break
            open_[live, best[live]] = False
            next_ = self.links[ids[live, best[live]]]
            new = ~seen[live[:, None], next_]
            seen[live[:, None], next_] = True
            d = own[live][:, None] + self.norm[next_] - 2 * np.einsum("nd,nkd->nk", x[live], self.c[next_])
            more_ids, more_d, more_open = np.full((n, next_.shape[1]), -1), np.full((n, next_.shape[1]), np.inf), np.zeros((n, next_.shape[1]), bool)
            more_ids[live], more_d[live], more_open[live] = next_, np.where(new, d, np.inf), new
            ids, dist, open_ = np.hstack([ids, more_ids]), np.hstack([dist, more_d]), np.hstack([open_, more_open])
            keep = np.argsort(dist, axis=1, kind="stable")[:, :beam]
            ids, dist, open_ = np.take_along_axis(ids, keep, 1), np.take_along_axis(dist, keep, 1), np.take_along_axis(open_, keep, 1)
        ids = np.where(np.isfinite(dist), ids, -1)
        return ids[:, :k], np.maximum(dist[:, :k], 0)


def balanced_centroids(x: np.ndarray, k: int, *, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """k-means in which large clusters repel: a cluster's size, relative to the mean, is added to its distances.

    More than 1,024 are fitted in two levels: some clusters, and in each its share.
    """
    rng = np.random.default_rng(seed)
    if k > 1024:
        coarse = balanced_centroids(x, int(np.sqrt(k)), rounds=rounds, seed=seed)
        own = ((coarse**2).sum(1)[None, :] - 2 * x @ coarse.T).argmin(1)
        parts = [x[own == i] for i in range(len(coarse))]
        return np.concatenate([balanced_centroids(p, max(1, round(k * len(p) / len(x))), rounds=rounds, seed=seed) for p in parts if len(p)])
    c = x[rng.choice(len(x), k, replace=False)].copy()
    weight, spread = np.ones(k), x.var(0).sum()
    for _ in range(rounds):
        d = (c**2).sum(1)[None, :] - 2 * x @ c.T + 0.1 * spread * (weight - 1)[None, :]
        own = d.argmin(1)
        size = np.bincount(own, minlength=k)
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        c = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], x[rng.integers(0, len(x), k)])
        weight = np.minimum(size / (len(x) / k), 4.0)
    return c


def _norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x**2).sum(1))


class Index:
    """Centroids, their graph, the way vectors and queries are placed, and the tuned ratio."""

    def __init__(self, sample: np.ndarray, n: int, most: float, *, k: int, lists: int, copies: int, boundary: float, recall: float, ratio: float | None, tune_queries: int = 256):
        self.most, self.copies, self.boundary = most, copies, boundary
        lifted = self.lift(sample)
        self.graph = CentroidGraph(balanced_centroids(lifted, min(lists, len(sample))))
        self.ratio, self.probes = ratio or 1.0, len(self.graph.c)
        if ratio is None and len(sample) > 1:
            self._tune(sample, max(1, round(k * len(sample) / n)), recall, tune_queries)

    def lift(self, x: np.ndarray) -> np.ndarray:
        x = x / self.most
        return np.hstack([x, np.sqrt(np.maximum(0, 1 - (x**2).sum(1)))[:, None]])

    def homes(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) of every list that a vector goes to."""
        ids, dist = self.graph.search(self.lift(x), self.copies, 24)
        row, col = np.nonzero((ids >= 0) & (dist <= np.maximum(dist[:, :1], 1e-12) * self.boundary))
        return row, ids[row, col]

    def _as_query(self, x: np.ndarray) -> np.ndarray:
        return np.hstack([x / _norms(x)[:, None], np.zeros((len(x), 1))])

    def lists_of(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) of the lists that a query reads."""
        ids, dist = self.graph.search(self._as_query(x), self.probes, self.probes + 16)
        row, col = np.nonzero((ids >= 0) & (dist <= np.maximum(dist[:, :1], 1e-12) * self.ratio))
        return row, ids[row, col]

    def _tune(self, sample: np.ndarray, near: int, recall: float, queries: int) -> None:
        """The least ratio at which lists hold the share `recall` of the nearest rows within the sample."""
        asked = sample[:queries]
        lifted = self._as_query(asked)
        dist = np.maximum((lifted**2).sum(1)[:, None] + self.graph.norm[None, :] - 2 * lifted @ self.graph.c.T, 0)
        dist /= np.maximum(dist.min(1, keepdims=True), 1e-12)
        products = asked @ sample.T
        products[np.arange(len(asked)), np.arange(len(asked))] = -np.inf
        near = min(near, len(sample) - 1)
        wanted = np.argpartition(products, -near, axis=1)[:, -near:]
        some, which = np.unique(wanted, return_inverse=True)
        row, home = self.homes(sample[some])
        ratio = np.full(wanted.size, np.inf)
        asker = np.repeat(np.arange(len(asked)), near)
        order = np.argsort(which.ravel(), kind="stable")
        first = np.searchsorted(which.ravel()[order], np.arange(len(some) + 1))
        for r, h in zip(row, home, strict=True):
            at = order[first[r] : first[r + 1]]
            ratio[at] = np.minimum(ratio[at], dist[asker[at], h])
        self.ratio = float(np.quantile(ratio, recall, method="higher")) * (1 + 1e-9)
        self.probes = min(len(self.graph.c), int(1.5 * (dist <= self.ratio).sum(1).max()) + 1)


def nearest(df: DataFrame, *, k: int = 20, query_every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", **params) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every row whose id divides by `query_every`, against all rows.

    Other parameters are those of `search`.
    """
    kind = number_kind(df, vector_col)
    packed = packed_vectors(df, id_col=id_col, vector_col=vector_col).filter("v is not null and vec_id is not null")
    packed = written(packed.dropDuplicates(["vec_id", "v"]).withColumn("h", F.xxhash64("v")), "vectors")
    found = [search(packed.filter(F.length("v") == w), w, kind, k=k, query_every=query_every, **params) for w in widths(packed)]
    return reduce(DataFrame.unionByName, found) if found else df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")


def search(packed: DataFrame, width: int, kind: str, *, k: int, query_every: int, sample_rows: int = 131_072, rows_per_list: int = 256, lists: int | None = None, copies: int = 4, boundary: float = 1.15, recall: float = 0.9, first: int = 4, ratio: float | None = None, list_rows: int = 2000, query_rows: int = 2000) -> DataFrame:
    """The answers among vectors of one length: `packed` has vec_id, v and its hash h, each row once.

    `lists` and `ratio` are set from the data where they are not given.
    """
    # Equal vectors: row_number up to a limit is cut before the exchange too.
    equal = Window.partitionBy("v").orderBy("vec_id")
    index = written(packed.withColumn("n", F.row_number().over(equal)).filter(F.col("n") <= k + 1).select("vec_id", "v", "h"), "indexed-vectors")
    queries = packed.filter(F.col("vec_id") % query_every == 0)

    def norms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array([float(_norms(matrix(batch.column(0), width, kind)).max())]), pa.array([batch.num_rows], pa.int64())], names=["m", "n"])

    most, n = index.select("v").mapInArrow(norms, "m double, n long").agg(F.max("m"), F.sum("n")).first()
    lists = lists or max(1, round(np.sqrt(n)), n // rows_per_list)
    lists = min(lists, max(1, sample_rows // 8))
    taken = min(sample_rows, max(8192, 8 * lists))
    sample = index.orderBy(F.xxhash64("h", "vec_id"), "vec_id").limit(taken).select("v").toArrow()  # the bounded sample
    placed = Index(matrix(sample.column("v"), width, kind), n, most, k=k, lists=lists, copies=copies, boundary=boundary, recall=recall, ratio=ratio)

    def place(of) -> object:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for a in range(0, batch.num_rows, 512):
                    part = batch.slice(a, 512)
                    row, to = of(matrix(part.column(1), width, kind))
                    take = pa.array(row)
                    yield pa.RecordBatch.from_arrays([pa.array(to, pa.int64()), *(c.take(take) for c in part.columns)], names=["list", "id", "v", "h"])

        return run

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                row, to = placed.lists_of(matrix(part.column(1), width, kind))
                ends = np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.ListArray.from_arrays(pa.array(ends), pa.array(to, pa.int64()))], names=["id", "v", "h", "lists"])

    postings = written(index.mapInArrow(place(placed.homes), "list long, id long, v binary, h long"), "postings")
    probes = written(queries.select("vec_id", "v", "h").mapInArrow(ask, "id long, v binary, h long, lists array<bigint>"), "probes")
    # One row a list: into how many sublists and query blocks it is cut.
    asked = probes.select(F.explode("lists").alias("list"))
    cuts = postings.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / list_rows).alias("subs"))
    blocks = asked.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / query_rows).alias("blocks"))
    plan = written(cuts.join(blocks, "list"), "list-cuts")
    each = lambda count: F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))
    left = postings.join(plan, "list").withColumn("sub", F.pmod(F.xxhash64("h", "id"), F.col("subs"))).withColumn("block", each("blocks")).select("list", "sub", "block", "id", "v", "h")

    def met_in(nearest_first: Column, asks: DataFrame) -> DataFrame:
        """The answers of the lists that `nearest_first` names, for `asks` with a bound: (query_id, query_h, vec_id, h, score)."""
        right = asks.select(F.explode(nearest_first).alias("list"), "id", "v", "h", "bound").join(plan, "list")
        right = right.withColumn("block", F.pmod(F.xxhash64("h", "id"), F.col("blocks"))).withColumn("sub", each("subs")).select("list", "sub", "block", "id", "v", "h", "bound")
        return left.groupBy("list", "sub", "block").cogroup(right.groupBy("list", "sub", "block")).applyInArrow(meet, "query_id long, query_h long, vec_id long, h long, score double")

    out_schema = pa.schema([("query_id", pa.int64()), ("query_h", pa.int64()), ("vec_id", pa.int64()), ("h", pa.int64()), ("score", pa.float64())])

    def meet(vectors: pa.Table, asks: pa.Table) -> pa.Table:
        if not vectors.num_rows or not asks.num_rows:
            return out_schema.empty_table()
        x, q = matrix(vectors.column("v"), width, kind), matrix(asks.column("v"), width, kind)
        (ids, h), (q_ids, q_h) = ((t.column("id").to_numpy(), t.column("h").to_numpy()) for t in (vectors, asks))
        bound = asks.column("bound").to_numpy()
        found = []
        for a in range(0, len(q), 256):
            s = q[a : a + 256] @ x.T
            s[(q_ids[a : a + 256, None] == ids[None, :]) & (q_h[a : a + 256, None] == h[None, :])] = -np.inf
            least = bound[a : a + 256]
            if s.shape[1] > k:
                least = np.maximum(least, np.partition(s, -k, axis=1)[:, -k])
            row, col = np.nonzero((s >= (least - 1e-9 * np.abs(least).clip(0, 1e300))[:, None]) & (s > -np.inf))  # ties with the k-th stay
            # Summed row by row, so that a pair has the same score in every list.
            found.append((q_ids[a + row], q_h[a + row], ids[col], h[col], (q[a + row] * x[col]).sum(1)))
        return pa.table([np.concatenate(c) for c in zip(*found, strict=True)], schema=out_schema)

    # A vector may come from several lists, each time with the same rank.
    best = Window.partitionBy("query_id", "query_h").orderBy(F.desc("score"), "vec_id", "h")
    top = lambda met: met.withColumn("rank", F.dense_rank().over(best)).filter(F.col("rank") <= k).dropDuplicates(["query_id", "query_h", "vec_id", "h"])
    near = written(top(met_in(F.slice("lists", 1, first), probes.withColumn("bound", F.lit(float("-inf"))))), "first-answers")
    bounds = near.groupBy(F.col("query_id").alias("id"), F.col("query_h").alias("h")).agg(F.max(F.when(F.col("rank") == k, F.col("score"))).alias("bound"))
    bounded = probes.join(written(bounds, "bounds"), ["id", "h"], "left").withColumn("bound", F.coalesce("bound", F.lit(float("-inf"))))
    far = met_in(F.slice("lists", F.lit(first + 1), F.greatest(F.size("lists"), F.lit(1))), bounded)
    return top(near.drop("rank").unionByName(far)).select("query_id", "rank", "vec_id", "score")
