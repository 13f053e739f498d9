"""Embedding near-dedup by spherical-cap filters.

A filter is a direction; a vector passes it where its cosine with it exceeds a
threshold. The directions are a random product code: the space is cut in two
halves, each with a codebook of random unit vectors, and every pair of code
words is a direction. So the cosines with all C * C directions are sums of two
of 2 * C numbers, and the filters a vector passes are listed by decoding, not
by trying them all. Vectors that share a filter are compared.

The threshold is set so that a vector passes about `passes` filters of a code;
one that passes fewer gets its nearest `passes` all the same. C * C follows the
number of vectors, without an end, so a filter holds about `filter_rows`
vectors at any size. Two vectors at the link threshold share no filter of one
code the more often the more filters there are, so there are as many codes,
each in a random rotation of the space, as it takes for at most `miss` of such
pairs to be missed in all of them. That is measured on random pairs at exactly
that cosine before a vector is read; a rotation makes any pair as good as a
random one, so the measured rate holds for any vectors. Nearer pairs are missed
more rarely.

What is sent for each filter is an id and a sketch: `bits` signs of random
projections. A row stays in a filter if some row there has a sketch as near as
a linked pair's, with five standard deviations to spare (this is part of the
measured miss). Only for these rows do the vectors follow, to be compared in
double precision. A pair is counted in the first filter that it shares (each
row brings along its list of filters), so pairs are
never sent anywhere: a group gives partial link counts and the edges of a
spanning forest. A filter with more than `group_rows` rows is cut into blocks,
and each pair of blocks is a group.

Equal vectors are one row with a count. They link with each other and share
their links; no pairs of them are made.

Edge cases: vectors that are null, zero, or hold null or non-finite numbers
link with nothing. Vectors of different lengths have no cosine: each length is
a table of its own. Rows that repeat an id are vectors of their own. Rows
without id link and count like others, but name no component: theirs is the
smallest id reachable, null if there is none, and `kept` is then true. Only the
id and the vector are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skysift.llm.common import written
from skysift.llm.components import components, with_least
from skysift.llm.vectors import matrix, number_kind, packed_vectors, widths


class ProductCode:
    """Two codebooks of unit vectors, one for each half of the space."""

    def __init__(self, dims: int, size: int, passes: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.cut, self.passes, self.size = max(1, dims // 2), passes, size
        self.books = []
        for d in (self.cut, dims - self.cut):
            book = rng.standard_normal((size, max(d, 1)))
            self.books.append(book / np.linalg.norm(book, axis=1, keepdims=True) / np.sqrt(2))
        # The threshold: that share of random unit vectors' cosines lies above it.
        x = rng.standard_normal((2000, dims))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        a, b = self._parts(x)
        some = a[:, rng.integers(0, size, 400)] + b[:, rng.integers(0, size, 400)]
        self.threshold = float(np.quantile(some, 1 - min(0.5, passes / size**2)))

    def _parts(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first = x[:, : self.cut] @ self.books[0].T
        rest = x[:, self.cut :]
        return first, rest @ self.books[1].T if rest.shape[1] else np.zeros((len(x), self.size))

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, filter number) of all filters that the rows of x (unit vectors) pass."""
        p, q = self._parts(x)
        order_p, order_q = np.argsort(-p, axis=1), np.argsort(-q, axis=1)
        p, q = np.take_along_axis(p, order_p, 1), np.take_along_axis(q, order_q, 1)
        rows, filters, total = [], [], np.zeros(len(x), np.int64)
        live = np.arange(len(x))
        for i in range(self.size):
            # p falls, so the words of the second book that still reach the threshold get fewer.
            live = live[p[live, i] + q[live, 0] >= self.threshold]
            if not len(live):
                break
            reach = (q[live] >= (self.threshold - p[live, i])[:, None]).sum(1)
            total[live] += reach
            row = np.repeat(live, reach)
            j = np.arange(len(row)) - np.repeat(np.cumsum(reach) - reach, reach)
            rows.append(row)
            filters.append(order_p[row, i] * self.size + order_q[row, j])
        few = np.nonzero(total < self.passes)[0]
        if len(few):  # the nearest: within the first `passes` of both orders
            n = min(self.passes, self.size)
            s = (p[few, :n, None] + q[few, None, :n]).reshape(len(few), -1)
            near = np.argsort(-s, axis=1, kind="stable")[:, : self.passes]
            row = np.repeat(few, near.shape[1])
            short = total < self.passes
            filters = [f[~short[r]] for f, r in zip(filters, rows, strict=True)] + [order_p[row, near.ravel() // n] * self.size + order_q[row, near.ravel() % n]]
            rows = [r[~short[r]] for r in rows] + [row]
        return np.concatenate(rows), np.concatenate(filters)


class Filters:
    """Product codes in random rotations, and sketches: at most `miss` of the pairs at cosine `threshold` share no filter or lie too far apart in their sketches."""

    def __init__(self, dims: int, size: int, passes: int, threshold: float, miss: float, bits: int = 256, seed: int = 7):
        rng = np.random.default_rng([seed, 1])
        self.codes: list[tuple[np.ndarray, ProductCode]] = []
        self.plane = rng.standard_normal((dims, bits))
        differ = np.arccos(threshold) / np.pi
        self.far = int(np.ceil(bits * differ + 5 * np.sqrt(bits * differ * (1 - differ))))
        pairs = int(np.ceil(20 / miss))
        x, y = rng.standard_normal((2, pairs, dims))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        y -= (x * y).sum(1, keepdims=True) * x
        y /= np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-300)
        y = threshold * x + np.sqrt(max(0.0, 1 - threshold**2)) * y
        lost = np.zeros(pairs, bool) if dims < 2 else np.bitwise_count(self.sketch(x) ^ self.sketch(y)).sum(1) > self.far
        apart = ~lost
        while True:
            turn = np.linalg.qr(rng.standard_normal((dims, dims)))[0]
            self.codes.append((turn, ProductCode(dims, size, passes, seed + len(self.codes))))
            at = np.nonzero(apart)[0]
            keys = [row * size**2 + f for row, f in (self._one(-1, v[at]) for v in (x, y))]
            apart[at[np.unique(np.intersect1d(*keys) // size**2)]] = False
            missed = int((lost | apart).sum())
            # Two standard errors are left for the draw of the pairs.
            if dims < 2 or missed + 2 * np.sqrt(missed) <= miss * pairs or not apart.any():
                break

    def _one(self, k: int, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        turn, code = self.codes[k]
        return code.decode(x @ turn)

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, filter number) over all codes, sorted, of the rows of x (unit vectors)."""
        found = [(row, f + k * code.size**2) for k, (_, code) in enumerate(self.codes) for row, f in [self._one(k, x)]]
        row, f = (np.concatenate(c) for c in zip(*found, strict=True))
        order = np.lexsort((f, row))
        return row[order], f[order]

    def sketch(self, x: np.ndarray) -> np.ndarray:
        """The signs of the projections, as 64-bit words."""
        return np.packbits(x @ self.plane > 0, axis=1).view(np.uint64)


def _near_sketches(rows: pa.Table, far: int, out: pa.Schema) -> pa.Table:
    """The rows of one filter's group (or pair of blocks) that have another within the sketch distance."""
    words = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint64).reshape(rows.num_rows, -1)
    some = np.zeros(len(words), bool)
    for a in range(0, len(words), 256):
        distance = sum(np.bitwise_count(words[a : a + 256, None, k] ^ words[None, :, k]).astype(np.int16) for k in range(words.shape[1]))
        near = distance <= far
        near[np.arange(len(near)), np.arange(a, a + len(near))] = False
        some[a : a + 256] = near.any(1)
    kept = pa.array(np.nonzero(some)[0])
    return pa.table([rows.column("filter").take(kept), rows.column("node").take(kept)], schema=out)


def _count_links(rows: pa.Table, width: int, kind: str, threshold: float, out: pa.Schema) -> pa.Table:
    """Partial link counts and forest edges of one filter's group, or of a pair of its blocks."""
    x = matrix(rows.column("v"), width, kind)
    nodes, copies = rows.column("node").to_numpy(), rows.column("copies").to_numpy()
    side, one_block = rows.column("side").to_numpy(), rows.column("lower")[0].as_py() == rows.column("upper")[0].as_py()
    norm = np.sqrt((x**2).sum(1))
    near = (x @ x.T) / (norm[:, None] * norm[None, :]) >= threshold
    np.fill_diagonal(near, False)
    if not one_block:
        near &= side[:, None] != side[None, :]
    if not near.any():
        return out.empty_table()
    some = np.nonzero(near.any(1))[0]
    near = near[np.ix_(some, some)]
    # Pairs that share a filter with a smaller number are counted there.
    own = rows.column("filter")[0].as_py()
    before = [f[f < own] for f in (np.frombuffer(f, "<i8") for f in rows.column("filters").take(pa.array(some)).to_pylist())]
    flat = np.concatenate(before)
    shared = np.zeros((len(some), len(some)), bool)
    if len(flat):
        names, where = np.unique(flat, return_inverse=True)
        has = np.zeros((len(some), len(names)), np.float32)
        has[np.repeat(np.arange(len(some)), [len(b) for b in before]), where] = 1
        shared = has @ has.T > 0
    links = ((near & ~shared) * copies[some][None, :]).sum(1)
    label = np.arange(len(some))
    while True:
        new = np.minimum(label, np.where(near, label[None, :], len(some)).min(1))
        if (new == label).all():
            break
        label = new
    return pa.table([nodes[some], links.astype(np.int64), nodes[some][label]], schema=out)


def _in_blocks(rows: DataFrame, group_rows: int) -> DataFrame:
    """`rows` (filter, node, ...) with side, lower and upper: a filter of many rows is cut into blocks, and a row goes to each pair of blocks that has its own."""
    sizes = written(rows.groupBy("filter").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select("filter", F.ceil(F.col("m") / group_rows).cast("int").alias("blocks")), "filter-sizes")
    cut = rows.join(sizes, "filter").withColumn("side", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least(F.col("side"), o).alias("lower"), F.greatest(F.col("side"), o).alias("upper")))
    return cut.withColumn("pair", F.explode(pairs)).select(*rows.columns, "side", "pair.lower", "pair.upper")


def near_vectors(df: DataFrame, *, threshold: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding", **params) -> DataFrame:
    """One row a vector: vec_id, n_links, component_id, kept. Other parameters are those of `linked`."""
    kind = number_kind(df, vector_col)
    packed = written(packed_vectors(df, id_col=id_col, vector_col=vector_col), "vectors")
    distinct = packed.filter("v is not null").groupBy("v").agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("copies"))
    # The number is written with the row, so it stays.
    distinct = written(distinct.withColumn("node", F.monotonically_increasing_id()), "distinct-vectors")
    found = [linked(distinct.filter(F.length("v") == w), n, w, kind, threshold, **params) for w, n in widths(distinct).items()]
    joined = packed.join(reduce(DataFrame.unionByName, found), "v", "left") if found else packed.withColumns({"n_links": F.lit(0), "component_id": F.col("vec_id")})
    component = F.when(F.col("v").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def linked(distinct: DataFrame, n: int, width: int, kind: str, threshold: float, *, passes: int = 2, filter_rows: int = 256, group_rows: int = 512, miss: float = 0.001) -> DataFrame:
    """(v, n_links, component_id) of `distinct`: n different vectors v of one length, each with node, least vec_id and number of copies."""
    dims = width // np.dtype(kind).itemsize
    filters = Filters(dims, int(max(4, np.ceil(np.sqrt(n * passes / filter_rows)))), passes, threshold, miss)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 2000):
                part = batch.slice(a, 2000)
                x = matrix(part.column(0), width, kind)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                row, found = filters.decode(x)
                ends = np.searchsorted(row, np.arange(len(x) + 1)) * 8
                lists, words = found.astype("<i8").tobytes(), [w.tobytes() for w in filters.sketch(x)]
                yield pa.RecordBatch.from_arrays([part.column(1), pa.array([lists[s:e] for s, e in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)], pa.binary()), pa.array(words, pa.binary())], names=["node", "filters", "sketch"])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [np.frombuffer(f, "<i8") for f in batch.column(1).to_pylist()]
            take = pa.array(np.repeat(np.arange(len(lists)), [len(f) for f in lists]))
            if len(take):
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(lists)), batch.column(0).take(take), batch.column(2).take(take)], names=["filter", "node", "sketch"])

    decoded = written(distinct.select("v", "node").mapInArrow(decode, "node long, filters binary, sketch binary"), "filter-lists")
    passed = written(decoded.mapInArrow(spread, "filter long, node long, sketch binary"), "passed-filters")
    named = pa.schema([("filter", pa.int64()), ("node", pa.int64())])
    counted = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("other", pa.int64())])
    keys, far = ["filter", "lower", "upper"], filters.far

    def sift(key: tuple, rows: pa.Table) -> pa.Table:
        return _near_sketches(rows, far, named)

    def count(key: tuple, rows: pa.Table) -> pa.Table:
        return _count_links(rows, width, kind, threshold, counted)

    near = written(_in_blocks(passed, group_rows).groupBy(*keys).applyInArrow(sift, "filter long, node long").distinct(), "near-sketches")
    full = distinct.select("node", "copies", "v").join(decoded.select("node", "filters"), "node")
    rows = near.join(full, "node")
    partial = written(_in_blocks(rows, group_rows).groupBy(*keys).applyInArrow(count, "node long, links long, other long"), "partial-links")
    links = partial.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(partial.filter("node != other").select(F.col("node").alias("a"), F.col("other").alias("b")))
    component = with_least(distinct, roots, "node", "vec_id")
    found = distinct.join(links, "node", "left").join(component, "node", "left")
    return written(found.select("v", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")), "vector-links")
