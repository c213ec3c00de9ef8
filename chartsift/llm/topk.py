"""Exact top-k search with multi-resolution segment statistics.

A vector is cut into segments; with each segment's mean and deviation, (a - b)^2 summed over a segment of n components
is at least n ((mean_a - mean_b)^2 + (dev_a - dev_b)^2), so squared distances have a lower bound from a few numbers. As
|a|^2 and |b|^2 are known, a lower bound of the distance is an upper bound of the inner product. Coarse segments are
tried first, finer ones on what survives, and whole vectors on the rest. What a query must reach is known from the
start: its k-th best product in a sample of the rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import table

#: Segments at each resolution.
LEVELS = (4, 16)
#: Bytes of queries that are broadcast at once; more are done in further blocks over the same rows.
QUERY_BYTES = 16 << 20
#: Rows whose products with a query say what its best must reach at least; exact for any number.
SAMPLE = 4096
#: Pairs of a query and a row that are compared at once, and doubles that pairs' vectors may take in one step: what a task
#: holds beside the queries and a batch of rows doesn't grow with their number.
PAIRS, STEP = 1 << 19, 1 << 20
#: Result rows that a task hands on at once.
ROWS = 4096


def tiles(queries: int, rows: int):
    """Slices (of the queries, of the rows) with ``PAIRS`` pairs at most."""
    wide = min(rows, max(1, int(PAIRS**0.5)))
    high = max(1, PAIRS // max(1, wide))
    for c in range(0, rows, wide or 1):
        for r in range(0, queries, high):
            yield slice(r, r + high), slice(c, c + wide)


def segment_stats(x: np.ndarray, count: int) -> np.ndarray:
    """sqrt(n) * means and sqrt(n) * deviations of ``count`` near-equal segments, side by side."""
    parts = [p for p in np.array_split(np.arange(x.shape[1]), min(count, max(1, x.shape[1]))) if len(p)]
    means = np.stack([x[:, p].mean(axis=1) for p in parts], axis=1) if parts else np.zeros((len(x), 0))
    devs = np.stack([x[:, p].std(axis=1) for p in parts], axis=1) if parts else np.zeros((len(x), 0))
    root = np.sqrt([len(p) for p in parts])
    return np.concatenate([means * root, devs * root], axis=1)


def steps(pairs: int, width: int):
    """Slices of so many pairs that their vectors of ``width`` numbers take ``STEP`` doubles at most."""
    n = max(1, STEP // max(1, width))
    return (slice(at, at + n) for at in range(0, pairs, n))


def survivors(qs: np.ndarray, xs: np.ndarray, q2: np.ndarray, x2: np.ndarray, floor: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the (query, row) pairs those whose distance bound allows an inner product of ``floor`` at least."""
    keep = []
    for s in steps(len(rows), qs.shape[1]):
        r, c = rows[s], cols[s]
        low = ((qs[r] - xs[c]) ** 2).sum(axis=1)
        bound = (q2[r] + x2[c] - low) / 2
        keep.append(bound + 1e-6 * (q2[r] + x2[c]) + 0.5 >= floor[r])
    keep = np.concatenate(keep) if keep else np.empty(0, bool)
    return rows[keep], cols[keep]


def candidates(qs: np.ndarray, xs: np.ndarray, q2: np.ndarray, x2: np.ndarray, floor: np.ndarray) -> np.ndarray:
    """For all pairs of a tile at once whether the same bound allows ``floor``: with |s_q - s_x|^2 multiplied out, the bound
    is the product of small matrices plus a number for each query and one for each row."""
    of_q = (0.5 + 1e-6) * q2 - (qs**2).sum(axis=1) / 2 + 0.5 - np.maximum(floor, -1e300)
    of_x = (0.5 + 1e-6) * x2 - (xs**2).sum(axis=1) / 2
    return np.c_[qs, of_q, np.ones(len(qs))] @ np.c_[xs, np.ones(len(xs)), of_x].T >= 0


def products(qs: np.ndarray, xs: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Inner products of the (query, row) pairs; in whole numbers of any size where doubles might not hold them."""
    if len(rows) and np.sqrt((qs**2).sum(axis=1).max() * (xs**2).sum(axis=1).max()) >= 2.0**52:
        return np.array([sum(int(a) * int(b) for a, b in zip(qs[r], xs[c])) for r, c in zip(rows, cols)], object)
    return np.concatenate([np.einsum("ij,ij->i", qs[rows[s]], xs[cols[s]]) for s in steps(len(rows), qs.shape[1])] or [np.empty(0)])


def matrices(batch: pa.RecordBatch):
    """The vectors of a batch by length: (ids, matrix) for each."""
    ids, lists = batch.column("id").to_numpy(zero_copy_only=False), batch.column("v")
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    flat, ends = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(lengths)
    for n in np.unique(lengths):
        own = np.nonzero(lengths == n)[0]
        yield int(n), own, ids[own], flat[(ends[own] - n)[:, None] + np.arange(n)[None, :]].astype(np.float64)


def at_most(score: np.ndarray) -> np.ndarray:
    """Scores as doubles, not above the scores themselves."""
    f = score.astype(np.float64)
    return np.where(np.abs(f) >= 2.0**52, f - np.abs(f) * 1e-15, f)


class Block:
    """A block of queries of one length with the ``k`` best candidates so far, as arrays."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, floor: np.ndarray | None = None):
        self.ids, self.x, self.k = ids, vectors, k
        self.x2 = (vectors**2).sum(axis=1)
        self.stats = [segment_stats(vectors, n) for n in LEVELS]
        self.found = np.zeros(len(ids), np.int64)  # candidates kept of each query
        self.score, self.of = np.zeros((len(ids), k)), np.zeros((len(ids), k), np.int64)  # best first
        self.floor = np.full(len(ids), -np.inf) if floor is None else floor.copy()

    def offer(self, ids: np.ndarray, x: np.ndarray) -> None:
        x2 = (x**2).sum(axis=1)
        stats = [segment_stats(x, n) for n in LEVELS]
        for r, c in tiles(len(self.ids), len(ids)):
            self._tile(r, ids[c], x[c], x2[c], [s[c] for s in stats])

    def _tile(self, r: slice, ids: np.ndarray, x: np.ndarray, x2: np.ndarray, stats: list) -> None:
        floor, q2, own = self.floor[r], self.x2[r], [s[r] for s in self.stats]
        keep = candidates(own[0], stats[0], q2, x2, floor)
        level = 1
        while level < len(LEVELS) and np.count_nonzero(keep) * 8 > keep.size:  # most are left: all at once again
            keep &= candidates(own[level], stats[level], q2, x2, floor)
            level += 1
        if np.count_nonzero(keep) * 8 > keep.size and np.sqrt(q2.max() * x2.max()) < 2.0**52:
            # whole numbers below 2^52, so that no order of summing makes a difference
            score = self.x[r] @ x.T
            rows, cols = np.nonzero(keep & (score >= floor[:, None]))
            score = score[rows, cols]
        else:
            rows, cols = np.nonzero(keep)
            for at in range(level, len(LEVELS)):
                rows, cols = survivors(own[at], stats[at], q2, x2, floor, rows, cols)
            score = products(self.x[r], x, rows, cols)
        high = (self.ids[r][rows] != ids[cols]) & (score >= floor[rows]).astype(bool)
        self._keep(rows[high] + r.start, ids[cols[high]], score[high])

    def _keep(self, rows: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        """Merges candidates into the best of their queries; a candidate that is there already counts once."""
        if not len(rows):
            return
        if score.dtype == object and self.score.dtype != object:
            self.score = self.score.astype(object)
        touched = np.unique(rows)
        old, place = np.nonzero(np.arange(self.k) < self.found[touched, None])
        rows = np.r_[rows, touched[old]]
        ids, score = np.r_[ids, self.of[touched[old], place]], np.r_[score, self.score[touched[old], place]]
        order = np.lexsort((ids, -score, rows))
        rows, ids, score = rows[order], ids[order], score[order]
        new = np.r_[True, (rows[1:] != rows[:-1]) | (ids[1:] != ids[:-1]) | (score[1:] != score[:-1]).astype(bool)]
        rows, ids, score = rows[new], ids[new], score[new]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        rows, ids, score, place = (a[place < self.k] for a in (rows, ids, score, place))
        self.of[rows, place], self.score[rows, place] = ids, score
        self.found[touched] = np.searchsorted(rows, touched, "right") - np.searchsorted(rows, touched)
        full = touched[self.found[touched] == self.k]
        self.floor[full] = np.maximum(self.floor[full], at_most(self.score[full, self.k - 1]))

    def best(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Queries, candidates and scores."""
        rows, place = np.nonzero(np.arange(self.k) < self.found[:, None])
        return self.ids[rows], self.of[rows, place], self.score[rows, place]


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``(id, v)`` with v the components floor(1024 x) as doubles, for vectors without null or non-finite components."""
    v = F.col(vec_col)
    whole = v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return df.where(whole & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.transform(v, lambda x: F.floor(x.cast("double") * 1024).cast("double")).alias("v"))


def top_k(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 10) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each query its ``k`` highest integer inner products, ties to smaller ids.

    Candidates are all rows but those with the query's own id; vectors that are null or hold a null or non-finite
    component take no part; a query meets candidates of its own length only. Rows that repeat an id are candidates of their
    own (those of one score count once), and queries that repeat one with the same vector are one query. Queries are broadcast in
    blocks of ``QUERY_BYTES`` and compared ``PAIRS`` at a time, each with the floor that a sample of the rows (the smallest hashed ids) sets it; every
    partition keeps ``k`` candidates a query, and these meet by query. Fewer than ``k`` candidates give as many rows; an
    empty table none; extra columns play no part.
    """
    spark = vectors.sparkSession
    rows, asked = usable(vectors, id_col, vec_col), usable(queries, id_col, vec_col).distinct()
    sample: dict[int, tuple[list, list]] = {}
    for r in {r.id: r for r in rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect()}.values():
        sample.setdefault(len(r.v), ([], []))[0].append(r.id)
        sample[len(r.v)][1].append(r.v)
    known = spark.sparkContext.broadcast({n: (np.array(i, np.int64), np.array(v, np.float64).reshape(len(i), n)) for n, (i, v) in sample.items()})

    def floors(batches):
        for batch in batches:
            out = np.full(batch.num_rows, -np.inf)
            for n, own, ids, q in matrices(batch):
                if n in known.value:
                    of, x = known.value[n]
                    if len(of) < k:
                        continue
                    high = max(1, PAIRS // len(of))
                    for at in range(0, len(ids), high):
                        score = np.where(of[None, :] == ids[at : at + high, None], -np.inf, q[at : at + high] @ x.T)
                        out[own[at : at + high]] = np.partition(score, -k, axis=1)[:, -k]
            # a product that doubles don't hold exactly may be off by its last places
            out = out - np.abs(np.where(np.isfinite(out), out, 0)) * 1e-9
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), pa.array(out)], ["id", "v", "floor"])

    def search(block: list) -> DataFrame:
        by_length: dict[int, list] = {}
        for q in block:
            by_length.setdefault(len(q[1]), []).append(q)
        sent = spark.sparkContext.broadcast({n: (np.array([q[0] for q in own], np.int64), np.array([q[1] for q in own], np.float64).reshape(len(own), n), np.array([q[2] for q in own])) for n, own in by_length.items()})

        def work(batches):
            blocks = {n: Block(ids, x, k, floor) for n, (ids, x, floor) in sent.value.items()}
            for batch in batches:
                for n, _, ids, x in matrices(batch):
                    if n in blocks:
                        blocks[n].offer(ids, x)
            for b in blocks.values():
                query, vec, score = b.best()
                for at in range(0, len(query), ROWS):
                    yield pa.RecordBatch.from_arrays([pa.array(query[at : at + ROWS]), pa.array(vec[at : at + ROWS]), pa.array([int(s) for s in score[at : at + ROWS].tolist()], pa.int64())], ["query_id", "vec_id", "score"])

        return rows.mapInArrow(work, "query_id long, vec_id long, score long")

    found, block, held = None, [], 0
    for row in asked.mapInArrow(floors, "id long, v array<double>, floor double").toLocalIterator():
        block.append((row.id, np.array(row.v, np.float64), row.floor))
        held += 8 * len(row.v) + 64
        if held >= QUERY_BYTES:
            part, block, held = search(block), [], 0
            found = part if found is None else found.unionByName(part)
    if block or found is None:
        part = search(block)
        found = part if found is None else found.unionByName(part)
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.distinct().select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)


def op8_exact_topk(spark, sf_dir: str) -> DataFrame:
    """Contract query: every row whose id is divisible by 100 against every other row of ``embeddings``."""
    rows = table(spark, sf_dir, "embeddings")
    return top_k(rows, rows.where(F.col("vec_id") % 100 == 0))


ORACLE_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""
