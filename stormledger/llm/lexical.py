"""Ranked lexical search by grouping on presence masks.

1. Postings. Every text becomes one row: its number of terms and, for the terms that a block of items asks for,
   the term numbers and counts. Document counts of the terms and the corpus totals are sums over these rows.
2. Masks. A task holds a block of documents as a term x document matrix. For one item, the rows of its terms are
   packed into one bitmap per document, its mask; equal masks are one group.
3. Order. A mask's highest possible score is the sum, over its bits, of the weight times the best share that any
   document of the block has for that term. Masks are scored exactly from the highest bound down, and the rest is
   left as soon as the next bound is below the score that the item's ``k`` th best document has already.
4. The ``k`` best of every task meet in a window per item. What a task may leave early starts from scores of
   ``SEED_DOCS`` documents; any documents give a right bound, so the result does not depend on them.

Items go in blocks of at most ``ITEM_BYTES`` of text, one after the other, each finished and written before the next
is planned; only one block's terms are on the driver and travel with a task.

Defined cases: null texts and texts without terms are in no result and no total; items without terms, or whose terms
occur nowhere, have no rows; rows that repeat an item are ranked each by themselves, rows that repeat a document are
ranked each; a null doc_id comes after all others of its score; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, stage

ITEM_BYTES = 1 << 20
ITEM_COUNT = 4096
SEED_DOCS = 4096
BLOCK_DOCS = 1024
BLOCK_CELLS = 1 << 23
FIRST_MASKS = 32
ABSENT = -1
# every byte that ends a term becomes a blank, A-Z become a-z
TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def terms_of(raw: bytes) -> list[bytes]:
    """Terms of a UTF-8 text: runs of ASCII letters, digits and characters outside ASCII."""
    return raw.translate(TERM_BYTES).split()


def item_blocks(items: DataFrame, most_bytes: int = ITEM_BYTES, most: int = ITEM_COUNT) -> Iterator[list[tuple]]:
    """(item_id, text) rows in blocks of bounded size; the driver holds one block and one partition of ``items``."""
    block, size = [], 0
    for row in items.select("item_id", "text").toLocalIterator():
        raw = (row["text"] or "").encode()
        if block and (size + len(raw) > most_bytes or len(block) == most):
            yield block
            block, size = [], 0
        block.append((row["item_id"], raw))
        size += len(raw)
    if block:
        yield block


def postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs) of every text with a term; only terms of ``vocabulary`` are listed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, get = max(len(vocabulary), 1), vocabulary.get
        for batch in slices(batches):
            raws = batch.column(batch.schema.get_field_index("text")).cast(pa.binary()).to_pylist()
            words = [terms_of(r) if r else [] for r in raws]
            n = np.fromiter(map(len, words), np.int64, len(words))
            known = np.fromiter((get(w, ABSENT) for w in chain.from_iterable(words)), np.int64, int(n.sum()))
            key = (np.repeat(np.arange(len(n)), n) * size + known)[known >= 0]
            key, tf = np.unique(key, return_counts=True)
            ends = np.searchsorted(key, np.arange(len(n) + 1) * size).astype(np.int32)
            lists = [
                pa.ListArray.from_arrays(pa.array(ends), pa.array(v.astype(np.int32))) for v in (key % size, tf)
            ]
            out = {"doc_id": batch.column(batch.schema.get_field_index("doc_id")), "n": pa.array(n)}
            rows = pa.RecordBatch.from_pydict(out | {"terms": lists[0], "tfs": lists[1]})
            yield rows.filter(pa.array(n > 0))

    chosen = docs.select(F.col("doc_id").cast("long"), "text")
    return chosen.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>")


def weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Ranker:
    """The k best documents per item over the blocks of one task.

    ``wanted``: per item (numbers of its terms, their weights times repeats); ``least``: per item a score that k
    documents are known to reach.
    """

    def __init__(self, wanted: list[tuple[np.ndarray, np.ndarray]], n_docs: int, n_terms: int, least: list[int], k: int, size: int):
        self.wanted, self.n_docs, self.n_terms, self.k = wanted, n_docs, n_terms, k
        self.least = [max(x, 1) for x in least]
        self.best: list[list[tuple]] = [[] for _ in wanted]
        self.row_of = np.full(size, ABSENT, np.int64)

    def block(self, ids: list, n: np.ndarray, ends: np.ndarray, terms: np.ndarray, tfs: np.ndarray) -> None:
        """One block of documents: ``ends[i]`` to ``ends[i + 1]`` are the postings of document i."""
        used, row = np.unique(terms, return_inverse=True)
        if len(ids) > 1 and len(used) * len(ids) > BLOCK_CELLS:
            half = len(ids) // 2
            for lo, hi in ((0, half), (half, len(ids))):
                a, b = ends[lo], ends[hi]
                self.block(ids[lo:hi], n[lo:hi], ends[lo : hi + 1] - a, terms[a:b], tfs[a:b])
            return
        # documents of any length and number: the product may pass 64 bits, so it is formed in Python
        m = np.array([100 - 25 + 25 * x * self.n_docs // self.n_terms for x in n.tolist()], np.int64)
        doc = np.repeat(np.arange(len(ids)), np.diff(ends))
        share = np.zeros((len(used), len(ids)), np.int32)
        tf = tfs.astype(np.int64)
        share[row, doc] = 1_000_000_000 * tf // (1000 * tf + 12 * m[doc])
        top = share.max(axis=1, initial=0).astype(np.float64)
        self.row_of[used] = np.arange(len(used))
        for i, (numbers, weights) in enumerate(self.wanted):
            rows = self.row_of[numbers]
            here = rows >= 0
            rows, weights = rows[here], weights[here]
            if len(rows) and over(float(weights @ top[rows])) >= self.least[i]:
                self.item(i, ids, share[rows], weights, weights * top[rows])
        self.row_of[used] = ABSENT

    def item(self, i: int, ids: list, share: np.ndarray, weights: np.ndarray, highest: np.ndarray) -> None:
        """Score the documents of the block for item ``i``, mask by mask from the highest bound down."""
        packed = np.packbits(share > 0, axis=0)
        wide = -len(packed) % 8
        if wide:
            packed = np.concatenate([packed, np.zeros((wide, packed.shape[1]), np.uint8)])
        masks = np.ascontiguousarray(packed.T)
        if masks.shape[1] == 8:
            _, first, group = np.unique(masks.view(np.uint64)[:, 0], return_index=True, return_inverse=True)
        else:
            _, first, group = np.unique(masks, axis=0, return_index=True, return_inverse=True)
            group = group.reshape(-1)
        bound = over((share[:, first] > 0).T @ highest)
        at, take = 0, FIRST_MASKS
        possible = np.flatnonzero(bound >= self.least[i])
        order = possible[np.argsort(-bound[possible], kind="stable")]
        while at < len(order) and bound[order[at]] >= self.least[i]:
            chosen = np.zeros(len(bound), bool)
            chosen[order[at : at + take]] = True
            docs = np.flatnonzero(chosen[group])
            scores = weights @ share[:, docs].astype(np.int64)
            good = scores >= self.least[i]
            found = [(-s, ids[d] is None, ids[d] or 0) for d, s in zip(docs[good].tolist(), scores[good].tolist())]
            if found:
                self.best[i] = sorted(self.best[i] + found)[: self.k]
                if len(self.best[i]) == self.k:
                    self.least[i] = max(self.least[i], -self.best[i][-1][0])
            at += take
            take *= 2

    def rows(self) -> pa.RecordBatch:
        flat = [(i, None if null else d, -s) for i, best in enumerate(self.best) for s, null, d in best]
        columns = list(zip(*flat)) or [[], [], []]
        kinds = (pa.int32(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_pydict({c: pa.array(v, t) for c, v, t in zip(("item", "doc_id", "score"), columns, kinds)})


def over(bound):
    """A floating sum of whole numbers, made safe as an upper bound."""
    return bound * (1 + 1e-9) + 1


def best_per_task(posted: DataFrame, wanted, n_docs: int, n_terms: int, least: list[int], k: int, size: int) -> DataFrame:
    """(item, doc_id, score): per task and item the k best documents that reach ``least``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranker = Ranker(wanted, n_docs, n_terms, least, k, size)
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK_DOCS):
                part = whole.slice(at, BLOCK_DOCS)
                get = lambda name: part.column(part.schema.get_field_index(name))  # noqa: B023, E731
                lists = get("terms")
                ends = lists.offsets.to_numpy().astype(np.int64)
                values = [np.asarray(get(c).flatten()) for c in ("terms", "tfs")]
                ranker.block(get("doc_id").to_pylist(), np.asarray(get("n")), ends - ends[0], *values)
        yield ranker.rows()

    return posted.mapInArrow(run, "item int, doc_id long, score long")


def first_k(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search_block(docs: DataFrame, block: list[tuple], k: int) -> DataFrame:
    """(item, rank, doc_id, score) for one block of (item_id, text); ``item`` is the place in the block."""
    spark = docs.sparkSession
    asked = [terms_of(raw) for _, raw in block]
    vocabulary = {w: i for i, w in enumerate(sorted(set(chain.from_iterable(asked))))}
    posted = stage(postings(docs, vocabulary), "postings")
    totals = posted.agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    counts = posted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect()
    # at most one row per term of the block; a term that all documents hold may weigh nothing
    weights = np.zeros(max(len(vocabulary), 1), np.int64)
    for term, df in counts:
        weights[term] = weight(df, totals.docs)
    wanted = []
    for words in asked:
        numbers, repeats = np.unique([vocabulary[w] for w in words] or np.zeros(0, np.int64), return_counts=True)
        numbers = numbers.astype(np.int64)
        some = weights[numbers] > 0
        wanted.append((numbers[some], (weights[numbers] * repeats)[some]))
    if not totals.docs:
        return spark.createDataFrame([], "item int, doc_id long, score long, rank int")
    rank = lambda rows, least: best_per_task(rows, wanted, totals.docs, totals.terms, least, k, len(weights))
    seeds = first_k(rank(posted.limit(SEED_DOCS), [0] * len(block)), k).where(F.col("rank") == k)
    least = [0] * len(block)
    for row in seeds.select("item", "score").collect():
        least[row.item] = row.score
    return first_k(rank(posted, least), k)


def search(docs: DataFrame, items: DataFrame, k: int = 20, block_bytes: int = ITEM_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` highest-scoring documents of every item with a score above 0."""
    spark, kind = docs.sparkSession, items.schema["item_id"].dataType
    results = []
    for block in item_blocks(items, block_bytes):
        names = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", kind)])
        ids = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(block)], names)
        ranked = search_block(docs, block, k).join(F.broadcast(ids), "item")
        results.append(stage(ranked.select("item_id", F.col("rank").cast("int"), "doc_id", "score"), "ranked"))
    if not results:
        schema = T.StructType([T.StructField("item_id", kind)]).add("rank", "integer").add("doc_id", "long").add("score", "long")
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, results)
