"""Runs of repeated words: maximal stretches with a small period, found tile by tile.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart are identical) and at least
``max(LEAST_LENGTH, LEAST_EXPONENT * q)`` words that no neighbouring word extends.

1. Octaves. Periods from ``P`` to ``2 P - 1`` are one octave. A document is exploded into tiles of that octave, one around every
   ``P``-th word, which overlap their neighbours; no octave goes beyond a quarter of the document.
2. Tiles. A hash of every stretch of ``P`` words says, for all tiles of an octave at once, which can hold a period: a run leaves
   ``P`` equal words on one side of each boundary inside it. These tiles are solved by themselves: Z-functions from the boundary onwards and, reversed, from it
   back tell for each period of the octave how far it reaches to both sides, and whether a divisor of it is a period as well.
   What ends inside the tile is a run or nothing; what reaches the tile's edge is a fragment of something longer.
3. Stitching. Fragments are shuffled by document and period; those that overlap are one run.

Hashes only choose tiles, the Z-functions compare the words. The work of a document grows like its length times the octaves.

Defined cases: null and empty texts have no words and no runs; repeated rows have the same runs; ids may repeat or be null;
further columns pass through or are ignored; an empty table gives none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, stage
from .minhash import constants, mix
from .suffixes import with_keys

LEAST_LENGTH = 6
LEAST_EXPONENT = 4
SLICE_BYTES = 1 << 20
SHORT_TILE = 8
WORDS = constants(1 << 42, 1)[0]
STEPS = constants(1 << 43, 64)
FRAGMENT = pa.struct([("period", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())])
FRAGMENTS = T.ArrayType(T.StructType().add("period", "long").add("start", "long").add("stop", "long"))


def words_of(raw: bytes) -> list[bytes]:
    """Words of a UTF-8 text: what stands between blanks, tabs and line ends of ASCII."""
    return raw.split()


def z_function(s: list) -> list[int]:
    """For each place the length of the common prefix of ``s`` and of ``s`` from there."""
    n = len(s)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


@lru_cache(1 << 16)
def prime_factors(n: int) -> list[int]:
    out, p = [], 2
    while p * p <= n:
        if n % p == 0:
            out.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return out + [n] * (n > 1)


def solve_tile(words: list, boundary: int, periods: list[int], octave: int) -> list[tuple[int, int, int]]:
    """(period, start, stop) for periods of the octave that hold around ``boundary``.

    From ``start`` to ``stop`` each word equals the one a period later. A stretch that ends inside the tile is listed only if it is a run.
    """
    reach = max(SHORT_TILE, 2 * octave)
    low, high = max(0, boundary - reach), min(len(words), boundary + 2 * octave + reach)
    ahead = z_function(words[boundary:high])
    edge = min(len(words), boundary + 2 * octave)
    # the words before the boundary, backwards; then those before each of the places a period later
    back = z_function(words[low:boundary][::-1] + [None] + words[low:edge][::-1])
    shift = boundary - low + 1 + edge
    out = []
    for p in periods:
        if any(ahead[p // r] >= p - p // r for r in prime_factors(p)):
            continue  # a power of a shorter word: its own octave has it
        right = min(ahead[p], reach) if p < len(ahead) else 0
        left = min(back[shift - boundary - p], reach) if boundary > low else 0
        if left == reach or right == reach or left + right + p >= max(LEAST_LENGTH, LEAST_EXPONENT * p):
            out.append((p, boundary - left, boundary + right))
    return out


def fragments(docs: list[list]) -> list[list[tuple[int, int, int]]]:
    """Fragments and runs of each document (a list of word numbers), octave by octave."""
    found: list[list] = [[] for _ in docs]
    n = np.array([len(d) for d in docs], np.int64)
    octave = 1
    chosen = np.flatnonzero(n >= LEAST_LENGTH)
    while len(chosen):
        # one row of numbers with a number of its own after each document: no equal stretch spans it
        first = np.concatenate([[0], np.cumsum(n[chosen] + 1)])
        row = np.fromiter(chain.from_iterable(chain(docs[d], (-1 - i,)) for i, d in enumerate(chosen)), np.int64, int(first[-1]))
        hashes, span, step = mix(row.view(np.uint64) * WORDS), 1, max(2, octave)
        for c in STEPS[: step.bit_length() - 1]:
            hashes = np.concatenate([hashes[:-span] * c + hashes[span:], hashes[len(hashes) - span :]])
            span *= 2
        while len(chosen):
            doc = np.repeat(np.arange(len(chosen)), n[chosen] + 1)
            place = np.arange(len(row)) - first[doc]
            if octave == 1:
                at = np.flatnonzero(place % 2 == 1)
                boundary = at - 1
            else:
                at = np.flatnonzero(place >= octave)
                boundary = at - place[at] % octave - octave
            same = hashes[at] == hashes[boundary]
            inner = np.flatnonzero(place[boundary] >= span)
            same[inner] |= hashes[at[inner] - span] == hashes[boundary[inner] - span]
            at, boundary = at[same], boundary[same]
            for b, periods in grouped(boundary, at):
                d = int(doc[b])
                found[chosen[d]] += solve_tile(docs[chosen[d]], b - int(first[d]), [p - b for p in periods], octave)
            octave *= 2
            long = n[chosen] >= max(LEAST_LENGTH, LEAST_EXPONENT * octave)
            if 2 * long.sum() < len(long) or not long.any():
                chosen = chosen[long]
                break
            if octave > span:
                hashes = np.concatenate([hashes[:-span] * STEPS[span.bit_length() - 1] + hashes[span:], hashes[len(hashes) - span :]])
                span *= 2
    return found


def grouped(boundary: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, list[int]]]:
    """(boundary, its places in ascending order)."""
    order = np.lexsort((at, boundary))
    boundary, at = boundary[order], at[order]
    cuts = np.flatnonzero(np.diff(boundary)) + 1
    for b, places in zip(boundary[np.concatenate([[0], cuts])].tolist() if len(boundary) else [], np.split(at, cuts)):
        yield b, places.tolist()


def numbered(raws: list[bytes | None]) -> tuple[list[list[bytes]], list[list[int]]]:
    """Words of each text, and the same as numbers."""
    number: dict[bytes, int] = {}
    words = [words_of(r) if r else [] for r in raws]
    return words, [[number.setdefault(w, len(number)) for w in doc] for doc in words]


def sha(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()


def scan(docs: DataFrame, columns: list[str], with_digests: bool) -> DataFrame:
    """``columns``, k1, k2 and the ``fragments`` of every row that has any.

    ``with_digests``: rows without fragments too, with the digest of their words; the others keep their text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=SLICE_BYTES):
            get = lambda name: batch.column(batch.schema.get_field_index(name))  # noqa: B023, E731
            words, numbers = numbered(get("text").cast(pa.binary()).to_pylist())
            found = fragments(numbers)
            out = {c: get(c) for c in (*columns, "k1", "k2")}
            listed = [[dict(zip(("period", "start", "stop"), f)) for f in fs] for fs in found]
            out["fragments"] = pa.array(listed, pa.list_(FRAGMENT))
            some = pa.array([bool(f) for f in found], pa.bool_())
            if with_digests:
                out["collapsed_sha256"] = pa.array([None if f else sha(b" ".join(w)) for f, w in zip(found, words)], pa.string())
                kept = [t if f else None for f, t in zip(found, get("text").to_pylist())]
                yield pa.RecordBatch.from_pydict(out | {"text": pa.array(kept, pa.string())})
            else:
                yield pa.RecordBatch.from_pydict(out).filter(some)

    keyed = with_keys(docs, *columns)
    fields = [keyed.schema[c] for c in (*columns, "k1", "k2")]
    schema = T.StructType(fields).add("fragments", FRAGMENTS)
    if with_digests:
        schema = schema.add("collapsed_sha256", "string").add("text", "string")
    return keyed.mapInArrow(run, schema)


def stitched(found: DataFrame) -> DataFrame:
    """(k1, k2, runs): fragments of a document and period that overlap are one; runs by start, then period."""
    pieces = found.select("k1", "k2", F.explode("fragments").alias("f")).select("k1", "k2", "f.*").distinct()
    by_start = W.partitionBy("k1", "k2", "period").orderBy("start", "stop")
    before = F.max("stop").over(by_start.rowsBetween(W.unboundedPreceding, -1))
    starts = pieces.withColumn("new", F.coalesce(F.col("start") > before, F.lit(True)).cast("int"))
    whole = (
        starts.withColumn("number", F.sum("new").over(by_start.rowsBetween(W.unboundedPreceding, 0)))
        .groupBy("k1", "k2", "period", "number")
        .agg(F.min("start").alias("start"), (F.max("stop") - F.min("start") + F.col("period")).alias("length"))
    )
    enough = F.greatest(F.lit(LEAST_LENGTH), LEAST_EXPONENT * F.col("period"))
    listed = F.sort_array(F.collect_list(F.struct("start", "period", "length")))
    return whole.where(F.col("length") >= enough).groupBy("k1", "k2").agg(listed.alias("runs"))


def find_runs(docs: DataFrame) -> DataFrame:
    """(k1, k2, runs) of the texts that have runs; k1, k2 as in ``suffixes.with_keys``."""
    return stitched(scan(docs, [], False))


def collapsed(words: list[bytes], runs: list) -> bytes:
    """The words joined by blanks, without those that repeat a run's first period."""
    gone: set[int] = set()
    for r in runs:
        gone.update(range(r["start"] + r["period"], r["start"] + r["length"]))
    return b" ".join(w for i, w in enumerate(words) if i not in gone) if gone else b" ".join(words)


def collapse_runs(docs: DataFrame) -> DataFrame:
    """``docs`` with ``runs`` and with texts in which each run is cut down to its first period; null texts stay."""
    columns = [c for c in docs.columns if c not in ("text", "runs")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = batch.select(["text", "runs"]).to_pylist()
            texts = [None if r["text"] is None else collapsed(words_of(r["text"].encode()), r["runs"] or []).decode() for r in rows]
            kept = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            yield pa.RecordBatch.from_pydict(kept | {"text": pa.array(texts, pa.string())})

    keyed = with_keys(docs, F.struct(*(F.col(f"`{c}`") for c in columns)).alias("row"))  # no name of theirs clashes
    joined = keyed.join(find_runs(docs), ["k1", "k2"], "left").select("row", "text", "runs")
    return joined.mapInArrow(run, joined.schema).select("row.*", "text", "runs")


def run_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256) of every row.

    start, length and period are those of the longest run (then the first, then that of the smallest period). Texts without a
    fragment are done after one pass; only the others are joined with their runs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out: dict[str, list] = {c: [] for c in ("n_runs", "start", "length", "period", "runs_sha256", "collapsed_sha256")}
            for row in batch.select(["text", "runs"]).to_pylist():
                runs = row["runs"] or []
                top = min(runs, key=lambda r: (-r["length"], r["start"], r["period"])) if runs else dict.fromkeys(("start", "length", "period"))
                lines = "".join(f"{r['start']},{r['length']},{r['period']}\n" for r in runs)
                values = (len(runs), top["start"], top["length"], top["period"], sha(lines.encode()), sha(collapsed(words_of(row["text"].encode()), runs)))
                for c, v in zip(out, values):
                    out[c].append(v)
            kinds = (*[pa.int64()] * 4, pa.string(), pa.string())
            new = {c: pa.array(v, t) for (c, v), t in zip(out.items(), kinds)}
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(batch.schema.get_field_index("doc_id"))} | new)

    seen = stage(scan(docs.withColumn("doc_id", F.col("doc_id").cast("long")), ["doc_id"], True), "fragments")
    some, none = seen.where("text is not null"), seen.where("text is null")
    schema = "doc_id long, n_runs long, start long, length long, period long, runs_sha256 string, collapsed_sha256 string"
    runs = stitched(some.select("k1", "k2", "fragments"))
    repeated = some.join(runs, ["k1", "k2"], "left").select("doc_id", "text", "runs").mapInArrow(run, schema)
    no = F.lit(None).cast("long")
    plain = none.select(
        "doc_id", F.lit(0).cast("long").alias("n_runs"), no.alias("start"), no.alias("length"), no.alias("period"),
        F.lit(sha(b"")).alias("runs_sha256"), "collapsed_sha256",
    )
    return repeated.unionByName(plain).withColumn("exponent_milli", F.expr("1000 * length div period"))
