"""Exact duplicate passages by column-wise construction over aligned segments.

A byte is a duplicate if a string of ``LENGTH`` bytes that covers it also starts anywhere else.

1. Anchors. Every window of ``LENGTH`` bytes picks the positions of its smallest ``GRAM``-byte hash. Equal
   windows pick the same places, so that two equal windows share an anchor at one offset. A text
   has about one anchor in 170 bytes; only anchors whose hash occurs again go on.
2. Segments. An anchor's segment is all bytes of the windows around it. Equal segments are one, with a count
   (summed before the shuffle): what occurs twice is a duplicate as a whole.
3. Columns. The differing segments of an anchor are a collection of strings aligned at the anchor. It is built
   from the last column to the first: each round puts one symbol per string in front,
   sorts the strings stably by it (the symbols in sorted order are that column of the
   collection's Burrows-Wheeler transform) and derives the common prefixes of neighbours
   from range minima of the round before. A window is a duplicate if a neighbour shares ``LENGTH`` symbols.

A collection of more than ``MOST_SEGMENTS`` segments is split before it is built. Its windows are dealt out by where they start, in classes
of neighbouring starts; all windows of a class hold the same middle, and equal windows have equal middles. So a class and a middle are a collection
of their own, built in the same way. Classes get narrower (``CLASSES``) until a collection fits a task; at one start the middle is the
window itself, and collections of any size are just windows that are equal. No anchor, however common, meets in one task.

Defined cases: null and empty texts have no bytes; texts shorter than ``LENGTH`` lose nothing; repeated rows are
duplicates of each other; strings overlap freely and never cross rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, slices, stage
from .minhash import constants, mix
from .quality import text_bytes

LENGTH = 400
GRAM = 64
BACK = LENGTH - GRAM
WIDTH = BACK + LENGTH
PAD = 0xFF  # no byte of UTF-8
SLICE_BYTES = 1 << 20
BLOCK_SEGMENTS = 12_000
MOST_SEGMENTS = 100_000
CLASSES = (42, 6, 1)  # starts per class
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
BYTES = constants(1 << 40, 256)
STEPS = constants(1 << 41, 8)
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick over x[i : i + width] for every i that has a whole window."""
    span = 1
    while 2 * span <= width:
        x = pick(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return pick(x[:-rest], x[rest:]) if rest else x


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the anchors of all texts and their hashes."""
    n = len(data)
    if n < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h, span = BYTES[data], 1
    for c in STEPS[: GRAM.bit_length() - 1]:
        h = h[:-span] * c + h[span:]
        span *= 2
    h ^= h >> np.uint64(32)
    h *= BASE
    h ^= h >> np.uint64(29)
    h[h == 0] = 1
    start = np.concatenate([[0], ends[:-1]]).tolist()
    for s, e in zip(start, ends.tolist()):
        h[max(s, e - GRAM + 1) : e] = NONE
    low = sliding(h, BACK + 1, np.minimum)
    for s, e in zip(start, ends.tolist()):
        low[max(s, e - LENGTH + 1) : e] = 0
    # a position is an anchor if it is the least of any window that holds it
    padded = np.zeros(len(h) + BACK, dtype=np.uint64)
    padded[BACK : BACK + len(low)] = low
    high = sliding(padded, BACK + 1, np.maximum)
    at = np.flatnonzero((high == h) & (h != NONE))
    return at, h[at]


def occurrence_table(rows: DataFrame) -> DataFrame:
    """(k1, k2, anchor, segment, at) of every anchor of every text; ``at`` packs its place (see ``unpacked``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=SLICE_BYTES):
            get = lambda name: batch.column(batch.schema.get_field_index(name))  # noqa: B023, E731
            data, ends = text_bytes(get("text"))
            at, h = anchors(data, ends)
            if not len(at):
                continue
            doc = np.searchsorted(ends, at, side="right")
            first = np.concatenate([[0], ends[:-1]])[doc]
            lo, hi = np.maximum(first, at - BACK), np.minimum(ends[doc], at + LENGTH)
            up, down = powers(BASE, len(data)), powers(INVERSE, len(data))
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTES[data] * up, dtype=np.uint64)])
            body = (sums[hi] - sums[lo]) * down[lo]
            shape = ((at - lo) * 1024 + (hi - at)).astype(np.uint64)
            segment = mix(body ^ mix(shape + np.uint64(1)))
            pick = pa.array(doc)
            yield pa.RecordBatch.from_pydict(
                {
                    "k1": get("k1").take(pick),
                    "k2": get("k2").take(pick),
                    "anchor": pa.array(h.view(np.int64)),
                    "segment": pa.array(segment.view(np.int64)),
                    "at": pa.array(((at - first) << 20) | ((at - lo) << 10) | (hi - at), pa.int64()),
                }
            )

    schema = "k1 long, k2 long, anchor long, segment long, at long"
    return rows.select("k1", "k2", "text").mapInArrow(run, schema)


def cut_segments(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(anchor, segment, back, ahead, body) of the wanted occurrences."""
    lists = wanted.groupBy("k1", "k2").agg(F.collect_list(F.struct("anchor", "segment", "pos", "back", "ahead")).alias("cuts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out: dict[str, list] = {k: [] for k in ("anchor", "segment", "back", "ahead", "body")}
            for row in batch.select(["text", "cuts"]).to_pylist():
                raw = row["text"].encode()
                for c in row["cuts"]:
                    for k in ("anchor", "segment", "back", "ahead"):
                        out[k].append(c[k])
                    out["body"].append(raw[c["pos"] - c["back"] : c["pos"] + c["ahead"]])
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_pydict({k: pa.array(v, t) for (k, v), t in zip(out.items(), types)})

    joined = rows.join(lists, ["k1", "k2"]).select("text", "cuts")
    return joined.mapInArrow(run, "anchor long, segment long, back int, ahead int, body binary")


def build_columns(symbols: np.ndarray, group: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last column at which a string's window of LENGTH symbols equals that of another of its group.

    ``symbols``: WIDTH x strings, strings in order of ``group``; first, last: where a string's windows start
    that hold no padding. -1, -1: no such window.
    """
    n = symbols.shape[1]
    least, most = np.full(n, -1, np.int32), np.full(n, -1, np.int32)
    order, common = np.arange(n), np.zeros(n + 1, np.int16)
    base = np.cumsum(np.concatenate([[0], group[1:] != group[:-1]])).astype(np.int32) << 8
    for c in range(WIDTH - 1, -1, -1):
        key = base + symbols[c][order]
        if (key[1:] >= key[:-1]).all():
            same = np.flatnonzero(key[1:] == key[:-1]) + 1
            grown = np.zeros(n + 1, np.int16)
            grown[same] = np.minimum(common[same] + 1, LENGTH)
        else:
            new = np.argsort(key, kind="stable")
            key = key[new]
            same = np.flatnonzero(key[1:] == key[:-1]) + 1
            grown = np.zeros(n + 1, np.int16)
            if len(same):
                bounds = np.empty(2 * len(same), np.int64)
                bounds[0::2], bounds[1::2] = new[same - 1] + 1, new[same] + 1
                grown[same] = np.minimum(np.minimum.reduceat(common, bounds)[0::2] + 1, LENGTH)
            order = order[new]
        common = grown
        if c <= BACK:
            hit = np.flatnonzero(common >= LENGTH)
            if len(hit):
                both = np.concatenate([order[hit - 1], order[hit]])
                both = both[(first[both] <= c) & (c <= last[both])]
                least[both] = c
                fresh = both[most[both] < 0]
                most[fresh] = c
    return least, most


def shared_windows(segments: DataFrame) -> DataFrame:
    """(anchor, segment, start, stop) relative to the anchor: what a segment shares with others of its collection.

    ``segments``: (coll, anchor, segment, back, ahead, lo, hi, body); windows from column ``lo`` to ``hi`` count.
    """

    def solve(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(rows)
        number = lambda name: t[name].to_numpy().astype(np.int64)
        back, ahead = number("back"), number("ahead")
        body = t["body"].combine_chunks()
        body = body.chunk(0) if isinstance(body, pa.ChunkedArray) else body
        offset = np.frombuffer(body.buffers()[1], np.int32)[body.offset : body.offset + len(body) + 1]
        data = np.frombuffer(body.buffers()[2], np.uint8)
        symbols = np.full((len(back), WIDTH), PAD, np.uint8)
        for i in range(len(back)):
            symbols[i, BACK - back[i] : BACK + ahead[i]] = data[offset[i] : offset[i + 1]]
        first, last = np.maximum(BACK - back, number("lo")), np.minimum(BACK + ahead - LENGTH, number("hi"))
        least, most = build_columns(np.ascontiguousarray(symbols.T), number("coll"), first, last)
        return pa.RecordBatch.from_pydict(
            {
                "anchor": t["anchor"].combine_chunks(),
                "segment": t["segment"].combine_chunks(),
                "start": pa.array(least - BACK, pa.int32()),
                "stop": pa.array(most - BACK + LENGTH, pa.int32()),
            }
        ).filter(pa.array(least >= 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count = 0
        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            if count < BLOCK_SEGMENTS:
                continue
            t = pa.Table.from_batches(held).combine_chunks()
            coll = t["coll"].to_numpy()
            last = int(np.searchsorted(coll, coll[-1]))  # the last collection may go on in the next batch
            if last:
                yield solve(t.slice(0, last).to_batches())
            held = t.slice(last).to_batches()
            count = t.num_rows - last
        if count:
            yield solve(held)

    ordered = segments.repartition("coll").sortWithinPartitions("coll", "segment")
    return ordered.mapInArrow(run, "anchor long, segment long, start int, stop int")


def as_collections(segments: DataFrame) -> DataFrame:
    """An anchor is a collection, and all its windows count."""
    return segments.select(F.col("anchor").alias("coll"), "*", F.lit(0).alias("lo"), F.lit(BACK).alias("hi"))


def classes_of(segments: DataFrame, width: int) -> DataFrame:
    """(anchor, segment, lo, hi, m1, m2): a row per class of ``width`` starts in which a segment has windows, and its middle.

    ``segments``: (anchor, segment, back, ahead, lo, hi, body).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                out: dict[str, list] = {k: [] for k in ("anchor", "segment", "lo", "hi", "m1", "m2")}
                for r in whole.slice(at, 256).to_pylist():
                    begin = BACK - r["back"]
                    first, last = max(begin, r["lo"]), min(BACK + r["ahead"] - LENGTH, r["hi"])
                    for lo in range(r["lo"], r["hi"] + 1, width):
                        hi = min(lo + width - 1, r["hi"])
                        if first > hi or last < lo:
                            continue
                        middle = hashlib.blake2b(r["body"][hi - begin : lo + LENGTH - begin], digest_size=16).digest()
                        values = (r["anchor"], r["segment"], lo, hi, *np.frombuffer(middle, "<i8").tolist())
                        for c, v in zip(out.values(), values):
                            c.append(v)
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_pydict({k: pa.array(v, t) for (k, v), t in zip(out.items(), kinds)})

    return segments.select("anchor", "segment", "back", "ahead", "lo", "hi", "body").mapInArrow(
        run, "anchor long, segment long, lo int, hi int, m1 long, m2 long"
    )


def split_collections(bodies: DataFrame) -> DataFrame:
    """:func:`shared_windows` for anchors with more segments than a task should hold."""
    bodies = stage(bodies, "crowded")
    parts, asked = [], as_collections(bodies).drop("coll")
    for width in CLASSES:
        dealt = stage(classes_of(asked, width), "classes")
        keys = ["anchor", "lo", "m1", "m2"]
        sizes = stage(dealt.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1"), "middles")
        if width == 1:  # the middle is the whole window
            equal = dealt.join(sizes.select(*keys), keys, "left_semi")
            start = (F.col("lo") - BACK).alias("start")
            parts.append(equal.select("anchor", "segment", start, (F.col("lo") - BACK + LENGTH).alias("stop")))
            break
        fit = dealt.join(sizes.where(F.col("n") <= MOST_SEGMENTS).select(*keys), keys)
        fit = fit.select("anchor", "segment", "lo", "hi", F.xxhash64(*keys).alias("coll")).join(bodies, ["anchor", "segment"])
        parts.append(shared_windows(fit))
        crowded = sizes.where(F.col("n") > MOST_SEGMENTS)
        if crowded.isEmpty():
            break
        left = dealt.join(crowded.select(*keys), keys).select("anchor", "segment", "lo", "hi")
        asked = left.join(bodies, ["anchor", "segment"])
    return reduce(DataFrame.unionByName, parts)


def with_keys(docs: DataFrame, *columns: str) -> DataFrame:
    """128 bits that name a row by its id and text, so that ids may repeat or be null."""
    return docs.select(
        *columns,
        "text",
        F.xxhash64("doc_id", "text").alias("k1"),
        F.xxhash64(F.lit(1), "text", "doc_id").alias("k2"),
    )


def unpacked(rows: DataFrame) -> DataFrame:
    """``at`` as pos (of the anchor in its text), back and ahead (bytes of the segment before and from it)."""
    low = lambda shift: F.shiftright("at", shift).bitwiseAND(1023).cast("int")
    return rows.withColumns({"pos": F.shiftright("at", 20), "back": low(10), "ahead": low(0)}).drop("at")


def duplicate_spans(docs: DataFrame) -> DataFrame:
    """(k1, k2, spans): per text with duplicates the (start, stop) byte ranges to remove; ranges may overlap."""
    rows = with_keys(docs)
    seen = stage(occurrence_table(rows), "anchors")
    again = (
        seen.groupBy("anchor")
        .agg(F.count("*").alias("n"), F.min("segment").alias("low"), F.max("segment").alias("high"))
        .where("n > 1")
        .select("anchor", (F.col("low") < F.col("high")).alias("mixed"))
    )
    again = stage(again, "repeated-anchors")  # both sides of the join are scans, so that it can split hot anchors
    repeated = stage(unpacked(seen.join(again, "anchor")), "repeated")
    discard(seen)
    copied = repeated.groupBy("anchor", "segment").agg(F.count("*").alias("copies")).where("copies > 1")
    copied = stage(copied.select("anchor", "segment"), "copied")
    place = F.struct("k1", "k2", "pos", "back", "ahead")
    kinds = (
        repeated.where("mixed")
        .groupBy("anchor", "segment")
        .agg(F.count("*").alias("copies"), F.min(place).alias("at"))
        .select("anchor", "segment", "copies", "at.*")
    )
    kinds = stage(kinds, "segments")
    size = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"))
    large = size.where(F.col("kinds") > MOST_SEGMENTS)
    if large.isEmpty():
        shared = shared_windows(as_collections(cut_segments(rows, kinds)))
    else:
        few, many = kinds.join(large, "anchor", "left_anti"), kinds.join(large, "anchor", "left_semi")
        shared = shared_windows(as_collections(cut_segments(rows, few))).unionByName(split_collections(cut_segments(rows, many)))
    once = kinds.where("copies = 1").join(shared, ["anchor", "segment"])
    whole = repeated.join(copied, ["anchor", "segment"])
    spans = once.select("k1", "k2", (F.col("pos") + F.col("start")).alias("start"), (F.col("pos") + F.col("stop")).alias("stop"))
    spans = spans.unionByName(
        whole.select("k1", "k2", (F.col("pos") - F.col("back")).alias("start"), (F.col("pos") + F.col("ahead")).alias("stop"))
    )
    return spans.distinct().groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))


def merged(spans: list) -> list[tuple[int, int]]:
    """Maximal runs of overlapping or touching ranges."""
    out: list[tuple[int, int]] = []
    for s in sorted((x["start"], x["stop"]) for x in spans or ()):
        if out and s[0] <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], s[1]))
        else:
            out.append(s)
    return out


def without(raw: bytes, runs: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for start, stop in runs:
        parts.append(raw[at:start])
        at = stop
    return b"".join([*parts, raw[at:]])


def removal_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": []}
            for row in batch.select(["text", "spans"]).to_pylist():
                raw = (row["text"] or "").encode()
                runs = merged(row["spans"])
                kept = without(raw, runs)
                for k, v in zip(out, (len(raw), len(raw) - len(kept), len(runs), hashlib.sha256(kept).hexdigest())):
                    out[k].append(v)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(batch.schema.get_field_index("doc_id")), **out})

    joined = with_keys(docs, "doc_id").join(duplicate_spans(docs), ["k1", "k2"], "left")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return joined.select("doc_id", "text", "spans").mapInArrow(run, schema)


def remove_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with duplicate bytes taken out of ``text``; a letter that is cut in two goes as a whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            kept = []
            for row in batch.select(["text", "spans"]).to_pylist():
                runs = merged(row["spans"])
                kept.append(without(row["text"].encode(), runs).decode(errors="ignore") if runs else row["text"])
            columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names) if n != "spans"}
            yield pa.RecordBatch.from_pydict(columns | {"text": pa.array(kept, pa.string())})

    found = duplicate_spans(docs)
    keys = with_keys(docs, *[c for c in docs.columns if c != "text"]).join(found, ["k1", "k2"], "left").drop("k1", "k2")
    return keys.select(*docs.columns, "spans").mapInArrow(run, docs.schema)
