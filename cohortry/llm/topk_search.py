"""Exact top-k inner products by columnar branch and bound: candidates lie in tiles, dimension block by dimension block; sums
grow block by block, and what the remaining blocks can add at most decides who stays."""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortry.llm.common import staged, table

#: Vectors in a tile, queries in a block, dimensions that are summed at a time.
TILE, BLOCK, DIMENSIONS = 1024, 128, 16
#: Tiles, and blocks of queries, in a file.
FILE_TILES, FILE_BLOCKS = 8, 32
#: Bytes of scores, the k best of each query, that a task keeps.
SCORES = 64 << 20
#: While more than this share of a block's pairs is left, whole columns are multiplied; below it, the pairs that are left.
DENSE = 0.25
#: Below the first, sums of floats are exact; beyond the second, sums of doubles are not and Python's whole numbers take over.
SINGLE, EXACT = float(1 << 24), float(1 << 53)


def whole_components(vector: Column) -> Column:
    """floor(1024 x) of each component; null for a null vector and for one with a null or non-finite component."""
    doubles = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(doubles, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~F.coalesce(bad, F.lit(False)), F.transform(doubles, lambda x: F.floor(x * 1024).cast("long")))


def packed(rows: DataFrame, count: int, size: int, width: int, name: str, together: int) -> DataFrame:
    """Rows (uid, id, whole) as tiles of about ``size``, staged with about ``together`` in a file: ``name`` (number of the tile), uids,
    ids, and the components as a matrix of the narrowest numbers that hold them, one dimension after another."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            while n >= size:
                rows = pa.Table.from_batches(held)
                yield tile(rows.slice(0, size))
                held, n = rows.slice(size).to_batches(), n - size
        if n:
            yield tile(pa.Table.from_batches(held))

    def tile(rows: pa.Table) -> pa.RecordBatch:
        whole = rows.column("whole").combine_chunks()
        lengths = np.diff(whole.offsets.to_numpy())
        matrix = np.zeros((width, rows.num_rows), np.int64)
        row = np.repeat(np.arange(rows.num_rows), lengths)
        matrix[np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths), row] = whole.flatten().to_numpy()
        kind = next((k for k in (np.int16, np.int32) if matrix.size and np.iinfo(k).min <= matrix.min() and matrix.max() <= np.iinfo(k).max), np.int64)
        matrix, uid = matrix.astype(kind), rows.column("uid").to_numpy()
        return pa.RecordBatch.from_arrays([pa.array([int(uid[0])]), pa.array([uid.tobytes()], pa.binary()), pa.array([rows.column("id").to_pylist()], pa.list_(pa.int64())), pa.array([matrix.tobytes()], pa.binary())], [name, "uids", "ids", "matrix"])

    parts = max(1, -(-count // (size * together)))
    return staged(rows.repartition(parts).mapInArrow(pack, f"{name} long, uids binary, ids array<bigint>, matrix binary"), f"{name}s")


def unpacked(matrix: pa.Scalar, width: int, n: int) -> np.ndarray:
    """The matrix of ``n`` vectors, of the width of number that it was packed in."""
    return np.frombuffer(matrix.as_buffer(), np.dtype(f"i{len(matrix.as_buffer()) // (width * n)}") if width else np.int64).reshape(width, n)


def norms(matrix: np.ndarray, block: int) -> np.ndarray:
    """Euclidean norms of each vector in each block of dimensions, a little above the true ones."""
    squares = np.add.reduceat(matrix.astype(np.float64) ** 2, np.arange(0, len(matrix), block), axis=0)
    return np.sqrt(squares) * (1 + 1e-9)


def best_in_tile(queries: np.ndarray, tile: np.ndarray, known: np.ndarray, own: np.ndarray, k: int, block: int = DIMENSIONS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query, place in the tile and score of all pairs that may be among the k best: every pair with a score of at least
    ``known`` (the query's k-th best so far) that at least k others in the tile do not surely beat.

    Matrices have a row for each dimension. ``own``: pairs that do not count. The bound of a pair is its sum so far and, for
    each block still to come, the product of both norms there. Blocks go by the queries' mass, the largest first. What others
    in the tile surely reach is only asked while a query has no k-th best. Vectors that no query needs are compacted away.
    """
    n_q, n_t, width = queries.shape[1], tile.shape[1], len(tile)
    if not width:
        q, t = np.nonzero(~own)
        return q, t, np.zeros(len(q), np.int64)
    norm_q, norm_t = norms(queries, block), norms(tile, block)
    most = norm_q.sum(0).max() * norm_t.sum(0).max()
    if not (most < EXACT):
        q, t = np.nonzero(~own)  # sums of doubles would not be exact
        return q, t, np.einsum("ij,ij->j", queries[:, q].astype(object), tile[:, t].astype(object)) if len(q) else np.zeros(0, np.int64)
    kind = np.float32 if most < SINGLE else np.float64
    order = np.argsort(-norm_q.sum(1), kind="stable")
    norm_q = (norm_q[order] * (1 + (len(order) + 4) * np.finfo(kind).eps)).astype(kind)  # above what rounding takes off
    as_q, as_t, norm_t = queries.astype(kind), tile.astype(kind), norm_t[order].astype(kind)
    place, sums, done, floor, open_ended = np.arange(n_t), np.zeros((n_q, n_t), kind), 0, known.astype(kind)[:, None], np.isneginf(known).any()
    alive = (norm_q.T @ norm_t + 2 >= floor) & ~own
    while done < len(order) and np.count_nonzero(alive) > DENSE * n_q * n_t:
        columns = alive.any(0)
        if 2 * np.count_nonzero(columns) < len(columns):
            place, sums, alive, as_t, norm_t = place[columns], sums[:, columns], alive[:, columns], as_t[:, columns], norm_t[:, columns]
        rows = slice(order[done] * block, (order[done] + 1) * block)
        sums += as_q[rows].T @ as_t[rows]
        done += 1
        rest = norm_q[done:].T @ norm_t[done:] + 2 if done < len(order) else 0  # sums are exact, so 2 is above the rounding of both
        if open_ended and len(place) > k:
            least = np.where(alive, sums - rest, -np.inf)
            floor = np.maximum(floor, np.partition(least, len(place) - k, axis=1)[:, len(place) - k, None])
        alive &= sums + rest >= floor
    q, t = np.divmod(np.flatnonzero(alive), len(place))
    score = sums[q, t]
    for b in range(done, len(order)):  # few are left: pair by pair
        rows = slice(order[b] * block, (order[b] + 1) * block)
        score += np.einsum("ij,ij->j", as_q[rows][:, q], as_t[rows][:, t])
        rest = np.einsum("ij,ij->j", norm_q[b + 1 :, q], norm_t[b + 1 :, t]) + 2 if b + 1 < len(order) else 0
        stay = score + rest >= floor[q, 0]
        q, t, score = q[stay], t[stay], score[stay]
    return q, place[t], np.rint(score).astype(np.int64)


def search(pairs: DataFrame, k: int, width: int) -> DataFrame:
    """Pairs of a block of queries and a tile: the rows that may be among a query's k best."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: OrderedDict[int, np.ndarray] = OrderedDict()  # by block, the k best scores of each query in this task so far
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                uq, ut = (np.frombuffer(row[c].as_buffer(), np.int64) for c in ("q_uids", "uids"))
                queries, tile = unpacked(row["q_matrix"], width, len(uq)), unpacked(row["matrix"], width, len(ut))
                name = row["block"].as_py()
                top = best.pop(name, None)
                top = np.full((len(uq), k), -np.inf) if top is None else top
                at = np.searchsorted(sorted_t := np.sort(ut), uq)
                own = np.zeros((len(uq), len(ut)), bool)
                mine = np.nonzero((at < len(ut)) & (sorted_t[np.minimum(at, len(ut) - 1)] == uq))[0]
                own[mine, np.argsort(ut, kind="stable")[at[mine]]] = True
                q, t, score = best_in_tile(queries, tile, top[:, 0], own, k)
                ids = row["ids"].values.fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)
                turn = np.lexsort((ids[t], -score, q)) if score.dtype != object else np.array(sorted(range(len(q)), key=lambda j: (q[j], -score[j], ids[t[j]])), np.int64)
                q, t, score = q[turn], t[turn], score[turn]
                within = np.arange(len(q)) - np.searchsorted(q, q)
                q, t, score = q[within < k], t[within < k], score[within < k]  # k a query and tile, ties by id
                grown = np.concatenate([top, np.full((len(uq), k), -np.inf)], axis=1)
                grown[q, k + within[within < k]] = np.array(score, np.float64)
                best[name] = np.sort(grown, axis=1)[:, k:]
                if len(best) > 1 and len(best) * BLOCK * k * 8 > SCORES:
                    best.popitem(last=False)
                score = np.array([min(max(int(s), -(1 << 63)), (1 << 63) - 1) for s in score], np.int64) if score.dtype == object else score
                found = row["ids"].values.to_numpy(zero_copy_only=False) if row["ids"].values.null_count == 0 else None
                vec = pa.array(found[t], pa.int64()) if found is not None else row["ids"].values.take(pa.array(t))
                yield pa.RecordBatch.from_arrays([pa.array(uq[q]), row["q_ids"].values.take(pa.array(q)), vec, pa.array(score, pa.int64())], ["q_uid", "query_id", "vec_id", "score"])

    return pairs.mapInArrow(run, "q_uid long, query_id long, vec_id long, score long")


def topk_search(df: DataFrame, is_query: Column, *, vec_id: str = "vec_id", vector: str = "embedding", k: int = 10) -> DataFrame:
    """For each row that ``is_query`` says of (null: no), its k best other rows by inner product of floor(1024 x):
    query_id, rank (from 1), vec_id, score. All others, if fewer; ties go to the lesser id, null ids last.

    Vectors that are null or hold a null or non-finite component take no part. Of vectors of different lengths, missing
    components count as 0. Rows with equal ids are rows of their own: each may be found, and each searches. Scores are
    exact; beyond a long they are the nearest long. Other columns are not read; an empty table gives an empty one.

    Every tile meets every block of queries: both are staged, and each part of one is read with each part of the other, so nothing is
    broadcast or copied to bring pairs together. A task streams its tiles and holds its blocks and their queries' scores.
    Each pair of a block and a tile returns at most k rows a query, which a ranked window with a limit before its shuffle merges.
    """
    rows = df.select(F.col(vec_id).cast("long").alias("id"), whole_components(F.col(vector)).alias("whole"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = staged(rows.where(F.col("whole").isNotNull()).withColumn("uid", F.monotonically_increasing_id()), "vectors")
    count, asking, width = rows.agg(F.count(F.lit(1)), F.count_if("asks"), F.max(F.size("whole"))).first()
    width = width or 0
    tiles = packed(rows.select("uid", "id", "whole"), count, TILE, width, "tile", FILE_TILES)
    blocks = packed(rows.where("asks").select("uid", "id", "whole"), asking, BLOCK, width, "block", FILE_BLOCKS)
    blocks = blocks.select("block", F.col("uids").alias("q_uids"), F.col("ids").alias("q_ids"), F.col("matrix").alias("q_matrix"))
    pairs = tiles.drop("tile").hint("shuffle_replicate_nl").crossJoin(blocks)
    found = search(pairs, k, width)
    ranked = Window.partitionBy("q_uid").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op11_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


QUERIES = {"op11_topk_search": op11_topk_search}

ORACLE = {
    "op11_topk_search": """WITH doubles AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS d FROM embeddings WHERE embedding IS NOT NULL),
v AS (SELECT vec_id, row_number() OVER () AS uid, list_transform(d, lambda x: floor(x * 1024)) AS e FROM doubles WHERE len(list_filter(d, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.uid, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score FROM v AS q JOIN v AS c ON q.uid <> c.uid WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY score DESC, vec_id NULLS LAST) AS r FROM scored) AS x WHERE r <= 10"""
}
