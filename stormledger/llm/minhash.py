"""Near-duplicate groups: fast similarity sketching, banding, exact verification, components.

A document is the set of its distinct word shingles (64-bit hashes). Documents of equal sets are one class and
go on as one representative. The sketch has ``BANDS * ROWS`` coordinates: in each round every
shingle is thrown into one bin, which keeps the smallest value of the first round that reached it; the
last rounds throw all shingles into one bin after the other, so that every coordinate fills.
Documents that agree in a whole band meet in a bucket. The member of a bucket with the most
encounters over all buckets is compared with every other member. Where a bucket still holds several
components, its members outside the hub's component meet all members of other components, in blocks of bounded
size inside tasks that return only links that connect something new. So no pair of a
bucket is left out but those that are connected already, and pairs are not written out.
Candidates are confirmed on their full sets.

A pair of similarity 0.8 shares no bucket with probability (1 - 0.8**6)**40, about 5e-6.

Defined cases: null and empty texts (or texts of white space) have an empty set and stand alone; a text of fewer
words than a shingle is one shingle; rows that repeat an id and its text are each returned; where an id has several
texts, each of them has its own links, and the group of each is named after the smallest id in it; a
null id stands alone; further columns are ignored by ``near_duplicates``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormledger.operators.row_ids import global_row_id

from .common import slices, stage
from .quality import text_bytes

BANDS = 40
ROWS = 6
WORDS = 5
PERCENT = 80
BLOCK = 1024
SLICE_BYTES = 2 << 20
COLUMNS = 4096

LOWER = np.arange(256, dtype=np.uint64)
LOWER[65:91] += np.uint64(32)
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def constants(start: int, n: int) -> np.ndarray:
    return mix(np.arange(start, start + n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def word_hashes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word (runs of bytes that are not ASCII white space, A-Z lowered) and its document."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    inside = ~SPACE[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    edge = ends[:-1][ends[:-1] < len(data)]
    opens[edge] = inside[edge]
    at = np.flatnonzero(opens)
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    place = np.arange(len(data)) - at[np.maximum(np.cumsum(opens) - 1, 0)]
    weight = constants(1 << 20, int(place.max()) + 1)
    letters = np.where(inside, (LOWER[data] + np.uint64(1)) * weight[place], np.uint64(0))
    return mix(np.add.reduceat(letters, at)), np.searchsorted(ends, at, side="right")


def shingle_sets(data: np.ndarray, ends: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every document, sorted within it, and where each document's end."""
    word, doc = word_hashes(data, ends)
    n = len(word)
    coefficient = constants(7, words)
    count = np.bincount(doc, minlength=len(ends))
    shingle, of = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if n >= words:
        full = np.flatnonzero(doc[: n - words + 1] == doc[words - 1 :])
        total = np.zeros(len(full), np.uint64)
        for j in range(words):
            total += word[full + j] * coefficient[j]
        shingle, of = mix(total), doc[full]
    short = np.flatnonzero((count > 0) & (count < words))
    if len(short):
        first = np.cumsum(count) - count
        tail = [
            mix((word[first[d] : first[d] + count[d]] * coefficient[: count[d]]).sum(dtype=np.uint64, keepdims=True) + np.uint64(count[d]))[0]
            for d in short
        ]
        shingle, of = np.concatenate([shingle, np.array(tail, np.uint64)]), np.concatenate([of, short])
        order = np.argsort(of, kind="stable")
        shingle, of = shingle[order], of[order]
    stop = np.cumsum(np.bincount(of, minlength=len(ends)))
    begin = 0
    for end in stop.tolist():
        shingle[begin:end].sort()
        begin = end
    keep = np.ones(len(shingle), bool)
    keep[1:] = (shingle[1:] != shingle[:-1]) | (of[1:] != of[:-1])
    return shingle[keep], np.cumsum(np.bincount(of[keep], minlength=len(ends)))


def sketches(shingle: np.ndarray, stop: np.ndarray, size: int) -> np.ndarray:
    """Fast similarity sketches, one row of ``size`` values per document (rows of empty sets are not meant to be used)."""
    docs = len(stop)
    count = np.diff(np.concatenate([[0], stop]))
    of = np.repeat(np.arange(docs), count)
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full(docs * size, empty)
    salt = constants(1 << 30, 2 * size)
    live, at = shingle, of
    for i in range(2 * size):
        value = mix(live ^ salt[i])
        value[value == empty] = 0
        if i < size:
            slot = at * size + (((value >> np.uint64(32)) * np.uint64(size)) >> np.uint64(32)).astype(np.int64)
        else:
            slot = at * size + (i - size)
        free = out[slot] == empty
        np.minimum.at(out, slot[free], value[free])
        open_docs = (out.reshape(docs, size) == empty).any(axis=1)
        keep = open_docs[at]
        if not keep.any():
            break
        if not keep.all():
            live, at = live[keep], at[keep]
    return out.reshape(docs, size)


def band_keys(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = sketch.reshape(len(sketch), bands, rows) * constants(99, rows)
    return mix(parts.sum(axis=2, dtype=np.uint64) ^ constants(500, bands))


def sketch_table(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, n_shingles, set_a, set_b, bands) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=SLICE_BYTES):
            data, ends = text_bytes(batch.column(batch.schema.get_field_index("text")))
            shingle, stop = shingle_sets(data, ends, words)
            sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(x)]) for x in (mix(shingle + np.uint64(5)), mix(shingle ^ constants(3, 1)))]
            start = np.concatenate([[0], stop[:-1]])
            keys = band_keys(sketches(shingle, stop, BANDS * ROWS), BANDS, ROWS).view(np.int64)
            n = stop - start
            filled = n > 0
            offsets = np.concatenate([[0], np.cumsum(np.where(filled, BANDS, 0))]).astype(np.int32)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column(batch.schema.get_field_index("doc_id")),
                    "n_shingles": pa.array(n, pa.int64()),
                    "set_a": pa.array((sums[0][stop] - sums[0][start]).view(np.int64)),
                    "set_b": pa.array((sums[1][stop] - sums[1][start]).view(np.int64)),
                    "bands": pa.ListArray.from_arrays(offsets, pa.array(keys[filled].ravel())),
                }
            )

    schema = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def verify(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough. ``docs``: (doc_id, text) of the ids involved."""
    left = docs.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = docs.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(iter([whole]), "text_b"):
                get = lambda name: batch.column(batch.schema.get_field_index(name))  # noqa: B023, E731
                b, stop_b = shingle_sets(*text_bytes(get("text_b")), words)
                ids = get("a").to_numpy(zero_copy_only=False)
                fresh = np.ones(len(ids), bool)
                fresh[1:] = ids[1:] != ids[:-1]
                a, stop_a = shingle_sets(*text_bytes(get("text_a").filter(pa.array(fresh))), words)
                start_a, start_b = (np.concatenate([[0], s[:-1]]) for s in (stop_a, stop_b))
                good = []
                for i, j in enumerate((np.cumsum(fresh) - 1).tolist()):
                    x, y = a[start_a[j] : stop_a[j]], b[start_b[i] : stop_b[i]]
                    if not len(x) or not len(y):
                        good.append(False)
                        continue
                    spot = np.searchsorted(x, y)
                    same = int((x[np.minimum(spot, len(x) - 1)] == y).sum())
                    good.append(100 * same >= percent * (len(x) + len(y) - same))
                yield pa.RecordBatch.from_pydict({"a": get("a"), "b": get("b")}).filter(pa.array(good, pa.bool_()))

    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(run, "a long, b long")


def verify_rest(placed: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Links between components that share a bucket.

    ``placed``: (key, id, hub, c), the members of every bucket and their components so far.
    """
    of_hub = placed.where("id = hub").select("key", F.col("c").alias("hub_c"))
    rows = placed.join(of_hub, "key").withColumn("outside", F.col("c") != F.col("hub_c"))
    blocks = (
        rows.groupBy("key")
        .agg(
            F.ceil(F.sum(F.when(F.col("outside"), 1).otherwise(0)) / BLOCK).cast("int").alias("nx"),
            F.ceil(F.count("*") / BLOCK).cast("int").alias("ny"),
            F.count("*").alias("n"),
        )
        .where("nx > 0 AND n > 2")
    )
    rows = rows.where("id <> hub").join(blocks, "key")
    slot = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asks = rows.where("outside").select("key", "id", "c", slot("nx").alias("x"), every("ny").alias("y"), F.lit(0).alias("side"))
    told = rows.select("key", "id", "c", every("nx").alias("x"), slot("ny").alias("y"), F.lit(1).alias("side"))
    both = asks.unionByName(told).join(docs.withColumnRenamed("doc_id", "id"), "id")
    ordered = both.select("key", "x", "y", "side", "id", "c", "text").repartition("key", "x", "y")
    ordered = ordered.sortWithinPartitions("key", "x", "y", "side", "id")

    def solve(held: tuple[list, list]) -> pa.RecordBatch:
        sets = []
        for side in held:
            data, ends = text_bytes(pa.array([r[2] for r in side], pa.string()))
            sets.append(shingle_sets(data, ends, words))
        x, y = ([(r[0], r[1]) for r in side] for side in held)
        found = new_links(x, y, similar(*sets, percent))
        return pa.RecordBatch.from_pydict(
            {"a": pa.array([min(p) for p in found], pa.int64()), "b": pa.array([max(p) for p in found], pa.int64())}
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, ([], [])
        for whole in batches:
            for r in zip(*(whole.column(i).to_pylist() for i in range(whole.num_columns))):
                if r[:3] != group:
                    if held[0] and held[1]:
                        yield solve(held)
                    group, held = r[:3], ([], [])
                held[r[3]].append(r[4:])
        if held[0] and held[1]:
            yield solve(held)

    return ordered.mapInArrow(run, "a long, b long").distinct()


def similar(x: tuple, y: tuple, percent: int) -> np.ndarray:
    """Which sets of ``x`` and ``y`` are similar enough, as a matrix; counts by products of presence matrices."""
    (xs, x_stop), (ys, y_stop) = x, y
    nx, ny = np.diff(np.concatenate([[0], x_stop])), np.diff(np.concatenate([[0], y_stop]))
    vocabulary = np.intersect1d(xs, ys)
    common = np.zeros((len(nx), len(ny)), np.float32)
    places = []
    for s, n in ((xs, nx), (ys, ny)):
        at = np.searchsorted(vocabulary, s)
        known = vocabulary[np.minimum(at, max(len(vocabulary) - 1, 0))] == s if len(vocabulary) else np.zeros(len(s), bool)
        places.append((np.repeat(np.arange(len(n)), n)[known], at[known]))
    for start in range(0, len(vocabulary), COLUMNS):
        parts = []
        for (row, col), n in zip(places, (nx, ny)):
            here = (col >= start) & (col < start + COLUMNS)
            part = np.zeros((len(n), min(COLUMNS, len(vocabulary) - start)), np.float32)
            part[row[here], col[here] - start] = 1
            parts.append(part)
        common += parts[0] @ parts[1].T
    same = np.rint(common).astype(np.int64)
    union = nx[:, None] + ny[None, :] - same
    return (100 * same >= percent * union) & (nx[:, None] > 0) & (ny[None, :] > 0)


def new_links(x: list, y: list, linked: np.ndarray) -> list[tuple[int, int]]:
    """Of the linked (id, component) pairs those that connect what is not connected yet."""
    root: dict[int, int] = {}

    def find(c: int) -> int:
        while root.get(c, c) != c:
            c = root[c]
        return c

    out = []
    for i, j in zip(*np.nonzero(linked)):
        a, b = find(x[i][1]), find(y[j][1])
        if a != b:
            root[max(a, b)] = min(a, b)
            out.append((x[i][0], y[j][0]))
    return out


def components(links: DataFrame) -> DataFrame:
    """(id, component): every linked id and the smallest id reachable, by alternating star contraction.

    Each round is a written table; hot ids are aggregated before they are shuffled.
    """
    spark = links.sparkSession
    edges = stage(links.where("a <> b").distinct(), "links")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        edges = stage(small, "components")
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if now == state:
            return spark.createDataFrame([], "id long, component long") if not now["n"] else edges.select(
                F.col("a").alias("id"), F.col("b").alias("component")
            )
        state = now


def groups_of(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row, where no id has two texts."""
    rows = stage(sketch_table(docs, words), "sketches")
    usable = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    copies = (
        rows.where(usable)
        .groupBy("set_a", "set_b", "n_shingles")
        .agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
        .where("copies > 1")
        .drop("copies")
    )
    copies = stage(copies, "copies")  # both sides of the join are scans, so that it can split a hot set
    member = rows.join(copies, ["set_a", "set_b", "n_shingles"], "left").select(
        "doc_id",
        "n_shingles",
        F.when(usable, F.coalesce("rep", "doc_id")).alias("rep"),
        F.when(F.col("doc_id") == F.coalesce("rep", "doc_id"), F.col("bands")).alias("bands"),
    )
    member = stage(member, "members")
    in_band = member.where(usable & F.col("bands").isNotNull()).select(F.explode("bands").alias("key"), F.col("doc_id").alias("id"))
    buckets = in_band.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("top")).where("low < top").select("key")
    buckets = stage(buckets, "keys")
    met = stage(in_band.join(buckets, "key"), "buckets")  # every member of every bucket of two or more
    involved = met.select(F.col("id").alias("doc_id")).distinct()
    texts = stage(docs.select("doc_id", "text").join(involved, "doc_id", "left_semi").dropDuplicates(["doc_id"]), "candidates")

    sizes = met.groupBy("key").agg(F.count("*").alias("n"))
    weight = met.join(sizes, "key").groupBy("id").agg(F.sum("n").alias("w"))
    best = F.max(F.struct("w", (-F.col("id")).alias("down"))).alias("best")
    hubs = met.join(weight, "id").groupBy("key").agg(best).select("key", (-F.col("best.down")).alias("hub"))
    stars = met.join(hubs, "key").where("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    links = stage(verify(stars, texts, words, percent), "links")
    group = components(links).withColumnRenamed("component", "c")
    placed = met.join(hubs, "key").join(group, "id", "left").select("key", "id", "hub", F.coalesce("c", "id").alias("c"))
    more = verify_rest(stage(placed, "placed"), texts, words, percent)
    final = components(links.unionByName(more)).withColumnsRenamed({"id": "rep", "component": "found"})
    return member.join(final, "rep", "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("found", "rep", "doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("found", "rep", "doc_id"), F.lit(True)).alias("kept"),
    )


def by_node(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``docs`` with ids that each have one text, and (node, id) of the ids that had to be given.

    Where an id has several texts, each of these gets a number that no id has, so that links of one text are not taken for links
    of the other. Without such ids ``docs`` stays as it is.
    """
    keys = [F.xxhash64("text").alias("__t1"), F.xxhash64(F.lit(1), "text").alias("__t2")]
    keyed = docs.select("*", *keys).where("doc_id IS NOT NULL")
    ends = [f(c).alias(f"{c}{i}") for c in ("__t1", "__t2") for i, f in enumerate((F.min, F.max))]
    several = keyed.groupBy("doc_id").agg(*ends).where("__t10 < __t11 OR __t20 < __t21")
    several = stage(several.select("doc_id"), "several-texts")
    if several.isEmpty():
        return docs, None
    versions = keyed.join(several, "doc_id", "left_semi").select("doc_id", "__t1", "__t2").distinct()
    low, high, n = docs.agg(F.min("doc_id"), F.max("doc_id")).first() + (versions.count(),)
    if low - n >= -(2**63):
        first = low - n - 1
    elif high + n < 2**63:
        first = high
    else:
        raise ValueError("no numbers are left beside the ids")
    numbered = global_row_id(versions, ["doc_id", "__t1", "__t2"], "__node", first + 1)
    named = stage(numbered, "nodes")
    given = docs.select("*", *keys).join(named, ["doc_id", "__t1", "__t2"], "left")
    renamed = given.withColumn("doc_id", F.coalesce("__node", "doc_id")).select(*docs.columns)
    return stage(renamed, "renamed"), named.select(F.col("__node").alias("node"), F.col("doc_id").alias("id"))


def solve(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(docs, groups): ``docs`` by node, and (doc_id, n_shingles, component_id, kept, node, stays) of every row.

    ``stays``: the row's text is the one of its group that is kept.
    """
    own, names = by_node(docs)
    found = groups_of(own, words, percent)
    if names is None:
        return own, found.withColumns({"node": F.col("doc_id"), "stays": F.col("kept")})
    found = stage(found.join(names, found["doc_id"] == names["node"], "left").select(
        F.coalesce("id", "doc_id").alias("doc_id"), "n_shingles", F.col("component_id").alias("c"), F.col("doc_id").alias("node")
    ), "groups")
    # a group's name is its smallest id, which need not be its smallest node
    least = found.groupBy("c").agg(F.min(F.struct("doc_id", "node")).alias("least"))
    return own, found.join(least, "c", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.col("least.doc_id")).alias("component_id"),
        F.coalesce(F.col("doc_id") == F.col("least.doc_id"), F.lit(True)).alias("kept"),
        "node",
        F.coalesce(F.col("node") == F.col("least.node"), F.lit(True)).alias("stays"),
    )


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row; linked: 100 * common >= percent * united."""
    return solve(docs, words, percent)[1].select("doc_id", "n_shingles", "component_id", "kept")


def keep_one(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each group of near duplicates; rows of null id all stay."""
    own, found = solve(docs, words, percent)
    kept = found.where("stays AND node IS NOT NULL").select(F.col("node").alias("doc_id"), F.col("doc_id").alias("__id")).distinct()
    one = own.join(kept, "doc_id").dropDuplicates(["doc_id"])
    named = one.withColumn("doc_id", F.col("__id")).select(*docs.columns)
    return named.unionByName(docs.where("doc_id IS NULL"))
