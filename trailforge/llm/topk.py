"""Exact top-k by inner product over an impact-ordered index, one score level at a time.

Vectors are packed into blocks; each block of candidates is indexed by segments: for every
dimension, the postings whose quantised impact |x| >> shift is the same. For a block of
queries, segments are processed by descending impact, and every posting adds its exact
product to its candidate's score. What is still to come is bounded by Cauchy-Schwarz: the
norm of a candidate's unprocessed components times the norm of the query. Processing stops
when the bounds prove that few enough candidates can still be among the best k; those are
scored exactly. Queries pass every block of candidates; a block never leaves its task's memory.

Defined cases: vectors that are null, or hold a null or a non-finite component, take no part,
nor do rows without an id; missing components of shorter vectors count as 0; rows that repeat
an id and vector count once; rows with the query's id are not its neighbours; ties go to the
smaller id; empty tables give no rows; other columns are ignored. Components must stay under
2**53 / 1024 in size, and scores under 2**63.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SCALE = 1024
#: Rows in a block of candidates and of queries: 4096 * 512 scores of 8 bytes are 16 MB.
CANDIDATES, QUERIES = 4096, 512
_LEVEL_BITS = 4
_BLOCK = "block long, width int, ids binary, parts binary"
_FOUND = "query_id long, vec_id long, score long"


def _packer(rows: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors, made = [], [], 0
        task = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32

        def block() -> pa.RecordBatch:
            width = max((len(v) for v in vectors), default=0)
            parts = np.zeros((len(vectors), width), "<i8")
            for row, v in zip(parts, vectors):
                row[: len(v)] = v
            return pa.RecordBatch.from_arrays(
                [pa.array([task + made]), pa.array([width], pa.int32()), pa.array([np.array(ids, "<i8").tobytes()]), pa.array([parts.tobytes()])],
                names=["block", "width", "ids", "parts"],
            )

        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1)):
                if i is None or not v.is_valid:
                    continue
                x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if v.values.null_count or not np.isfinite(x).all():
                    continue
                ids.append(i)
                vectors.append(np.floor(SCALE * x).astype(np.int64))
                if len(ids) == rows:
                    yield block()
                    ids, vectors, made = [], [], made + 1
        if ids:
            yield block()

    return pack


def blocks(df: DataFrame, rows: int, key: str, vector: str) -> DataFrame:
    """The usable rows of `df`, packed where they are: no shuffle."""
    return df.select(F.col(key).cast("long"), F.col(vector)).mapInArrow(_packer(rows), _BLOCK)


def _unpack(width: int, ids: bytes, parts: bytes) -> tuple[np.ndarray, np.ndarray]:
    names = np.frombuffer(ids, "<i8")
    return names, np.frombuffer(parts, "<i8").reshape(len(names), width)


class Index:
    """Posting segments of a block, from the highest quantised impact down."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        _, first = np.unique(np.column_stack([ids, vectors]), axis=0, return_index=True)
        first.sort()
        self.ids, self.vectors = ids[first], vectors[first]
        size = np.abs(self.vectors)
        shift = max(0, int(size.max(initial=0)).bit_length() - _LEVEL_BITS)
        level = size >> shift
        square = self.vectors.astype(np.float64) ** 2
        self.levels = []
        for at in range(int(level.max(initial=0)), -1, -1):
            segments = []
            for d in range(self.vectors.shape[1]):
                hit = np.flatnonzero((level[:, d] == at) & (size[:, d] > 0))
                if len(hit):
                    segments.append((d, hit, self.vectors[hit, d]))
            if segments:
                self.levels.append((segments, np.sqrt(np.where(level < at, square, 0).sum(axis=1))))

    def best(self, names: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query row, candidate row and score of everything that may be among a query's k best in this block."""
        width = max(queries.shape[1], self.vectors.shape[1])
        queries = np.pad(queries, ((0, 0), (0, width - queries.shape[1])))
        n = len(self.ids)
        score = np.zeros((n, len(names)), np.int64)
        own = self.ids[:, None] == names[None, :]
        norms = np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1))
        total = sum(len(hit) for segments, _ in self.levels for _, hit, _ in segments)
        done, asked = 0, 0.5
        for segments, rest in self.levels:
            for d, hit, impact in segments:
                score[hit] += impact[:, None] * queries[None, :, d]
                done += len(hit)
            if done == total:
                break
            if done >= asked * total and n > k:
                asked = (1 + done / total) / 2
                possible = self._possible(score, own, rest[:, None] * norms[None, :] * (1 + 1e-9) + 1, k)
                if possible.sum() * width <= (total - done) * len(names):
                    row, query = np.nonzero(possible)
                    exact = np.concatenate(
                        [np.einsum("ij,ij->i", self.vectors[r], queries[q, : self.vectors.shape[1]]) for r, q in zip(_cut(row), _cut(query))] or [np.zeros(0, np.int64)]
                    )
                    return query, row, exact
        row, query = np.nonzero(self._possible(score, own, np.zeros((1, 1)), k))
        return query, row, score[row, query]

    @staticmethod
    def _possible(score: np.ndarray, own: np.ndarray, bound: np.ndarray, k: int) -> np.ndarray:
        """Which candidates the bounds can't rule out: their most is not under the k-th best least."""
        if len(score) <= k + 1 and len(score) - own.sum(axis=0).max(initial=0) <= k:
            return ~own
        least = np.where(own, -np.inf, score - bound)
        kth = np.partition(least, len(score) - k, axis=0)[len(score) - k]
        return (score + bound >= kth) & ~own


def _cut(x: np.ndarray, at: int = 65_536) -> list[np.ndarray]:
    return [x[i : i + at] for i in range(0, len(x), at)]


def _search(k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of rows sorted by part, candidates before queries: the best of each part's candidates for every query."""
        part, held = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if part != row["part"]:
                    part, held = row["part"], []
                if not row["turn"]:
                    held.append(Index(*_unpack(row["width"], row["ids"], row["parts"])))
                    continue
                names, queries = _unpack(row["width"], row["ids"], row["parts"])
                for index in held:
                    query, at, score = index.best(names, queries, k)
                    order = np.lexsort((index.ids[at], -score, query))
                    query, at, score = query[order], at[order], score[order]
                    keep = np.arange(len(query)) - np.searchsorted(query, query) < k
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(names[query[keep]]), pa.array(index.ids[at[keep]]), pa.array(score[keep])], names=["query_id", "vec_id", "score"]
                    )

    return search


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 10, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each row of `queries` its k best rows of `candidates`.

    A block of candidates is shuffled once and stands still while all blocks of queries pass it.
    """
    n = candidates.count()
    groups = max(1, -(-n // CANDIDATES))
    asked = queries.count()
    packed = blocks(queries.repartition(max(1, -(-asked // QUERIES)), key), QUERIES, key, vector)
    spread = packed.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("part"), F.lit(1).alias("turn"), "width", "ids", "parts")
    indexed = blocks(candidates, CANDIDATES, key, vector).select(F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int").alias("part"), F.lit(0).alias("turn"), "width", "ids", "parts")
    passed = indexed.unionByName(spread).repartition("part").sortWithinPartitions("part", "turn")
    found = passed.mapInArrow(_search(k), _FOUND).distinct()
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
