"""Document quality from a linear-chain conditional random field over lines.

Each line is good or bad. Its features are bins of plain measures (symbols, capitals, digits, repeated
words, length, repeated line) of the line and of both neighbours. Forward-backward gives the marginal of
every line, and a document's score is their mean weighted by line length. The field is
fitted on a bounded sample of labelled documents (``SAMPLE_ROWS``, ``SAMPLE_BYTES``; a line
takes its document's label); every text is scored whole.

Measures are taken from UTF-8 bytes of a whole slice of documents at once. Defined cases: null and
empty texts are one empty line; without labelled rows every score is 0.5; further columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import byte_ends, slices

SAMPLE_ROWS = 4000
SAMPLE_BYTES = 20_000
STEPS = 150
RATE = 0.2
PENALTY = 1e-3
MEASURES = ("symbols", "capitals", "digits", "shouts", "repeats", "length", "copy")
CUTS = {
    "symbols": (0.001, 0.02, 0.08),
    "capitals": (0.001, 0.08, 0.3),
    "digits": (0.001, 0.05, 0.2),
    "shouts": (0.001, 0.02),
    "repeats": (0.01, 0.1, 0.4),
    "length": (1, 30, 120, 400),
    "copy": (0.5,),
}
NEIGHBOURS = ("symbols", "capitals", "repeats", "copy")
WORD_WEIGHTS = np.random.default_rng(7).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)

SYMBOL, UPPER, DIGIT, SHOUT, SPACE, OTHER = range(6)
BYTE_CLASS = np.full(256, OTHER, dtype=np.uint8)
BYTE_CLASS[[i for i in range(33, 127) if not chr(i).isalnum() and chr(i) not in ".,;:'\"!?()-"]] = SYMBOL
BYTE_CLASS[65:91] = UPPER
BYTE_CLASS[48:58] = DIGIT
BYTE_CLASS[[33, 63]] = SHOUT
BYTE_CLASS[[9, 10, 11, 12, 13, 32]] = SPACE


@dataclass
class Lines:
    """Lines of a slice of documents; document i has lines first[i] to first[i + 1]."""

    first: np.ndarray
    length: np.ndarray
    bins: dict[str, np.ndarray]


@dataclass
class Model:
    weights: np.ndarray  # one log-odds weight per feature, good against bad
    stay_good: float
    stay_bad: float


def text_bytes(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and where each row ends (null: empty)."""
    import pyarrow.compute as pc

    flat = pc.fill_null(values, "").combine_chunks() if isinstance(values, pa.ChunkedArray) else pc.fill_null(values, "")
    ends = byte_ends(flat)
    offsets = np.frombuffer(flat.buffers()[1], dtype=np.int32)[flat.offset : flat.offset + len(flat) + 1]
    data = np.frombuffer(flat.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, ends


def running(flags: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])


def split_lines(data: np.ndarray, ends: np.ndarray) -> Lines:
    starts = np.concatenate([[0], ends[:-1]])
    breaks = np.flatnonzero(data == 10)
    doc_of_break = np.searchsorted(ends, breaks, side="right")
    per_doc = np.bincount(doc_of_break, minlength=len(ends)) + 1
    first = np.concatenate([[0], np.cumsum(per_doc)])
    line_start = np.empty(first[-1], dtype=np.int64)
    line_end = np.empty(first[-1], dtype=np.int64)
    at = np.arange(len(breaks)) + doc_of_break  # the line that each break ends
    line_start[first[:-1]] = starts
    line_end[first[1:] - 1] = ends
    line_end[at] = breaks
    line_start[at + 1] = breaks + 1
    size = line_end - line_start
    kind = BYTE_CLASS[data]
    per = np.maximum(size, 1).astype(float)

    def share(k: int) -> np.ndarray:
        total = running(kind == k)
        return (total[line_end] - total[line_start]) / per

    # words: runs of bytes that are not space; a document's end also ends a word
    inside = kind != SPACE
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    edge = starts[(starts > 0) & (starts < len(data))]
    opens[edge] = inside[edge]
    word_at = np.flatnonzero(opens)
    copies = np.zeros(first[-1])
    repeats = np.zeros(first[-1])
    if len(word_at):
        word_no = np.cumsum(opens) - 1
        place = np.arange(len(data)) - word_at[np.maximum(word_no, 0)]
        mixed = np.where(inside, (data.astype(np.uint64) + np.uint64(1)) * WORD_WEIGHTS[place & 63], np.uint64(0))
        word = np.add.reduceat(mixed, word_at)
        same = np.zeros(len(word), dtype=np.int64)
        same[1:] = word[1:] == word[:-1]
        lo, hi = np.searchsorted(word_at, line_start), np.searchsorted(word_at, line_end)
        total, doc_first = running(same), hi > lo
        within = np.maximum(lo + 1, 0)
        repeats = np.where(doc_first, (total[hi] - total[np.minimum(within, hi)]) / np.maximum(hi - lo, 1), 0.0)
        # a line that stands in its document before: equal sums of its words
        odd = (np.arange(len(word), dtype=np.uint64) * np.uint64(0)) + word * np.uint64(0x9E3779B97F4A7C15)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(odd, dtype=np.uint64)])
        mark = sums[hi] - sums[lo]
        doc = np.repeat(np.arange(len(ends)), per_doc)
        order = np.lexsort((mark, doc))
        again = (doc[order][1:] == doc[order][:-1]) & (mark[order][1:] == mark[order][:-1])
        copies[order[1:][again]] = 1.0
        copies[size == 0] = 0.0
    values = {
        "symbols": share(SYMBOL),
        "capitals": share(UPPER),
        "digits": share(DIGIT),
        "shouts": share(SHOUT),
        "repeats": repeats,
        "length": size,
        "copy": copies,
    }
    return Lines(first, size, {k: np.digitize(v, CUTS[k]).astype(np.int8) for k, v in values.items()})


def blocks() -> list[tuple[str, int, int]]:
    """(measure, shift to the line it is taken from, number of bins) of every feature block."""
    own = [(m, 0, len(CUTS[m]) + 1) for m in MEASURES]
    return own + [(m, d, len(CUTS[m]) + 2) for m in NEIGHBOURS for d in (-1, 1)]


def feature_ids(lines: Lines) -> np.ndarray:
    """lines x blocks: the one feature of each block that holds; the last bin of a neighbour block: no such line."""
    n, at, ids = lines.first[-1], 0, []
    is_first, is_last = np.zeros(n, bool), np.zeros(n, bool)
    is_first[lines.first[:-1]] = True
    is_last[lines.first[1:] - 1] = True
    for measure, shift, width in blocks():
        b = lines.bins[measure].astype(np.int32)
        if shift:
            b = np.roll(b, -shift)
            b[is_first if shift < 0 else is_last] = width - 1
        ids.append(b + at)
        at += width
    return np.stack(ids, axis=1)


def step(x: np.ndarray, stay_good: float, stay_bad: float) -> np.ndarray:
    """Log-odds that pass one link of the chain."""
    return np.logaddexp(x + stay_good, 0) - np.logaddexp(x, stay_bad)


def forward_backward(emission: np.ndarray, first: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds from the left (own emission included) and from the right, per line."""
    count = np.diff(first)
    order = np.argsort(-count, kind="stable")
    start, count = first[:-1][order], count[order]
    left, right = emission.copy(), np.zeros_like(emission)
    for p in range(1, int(count.max(initial=0))):
        at = start[: np.searchsorted(-count, -p, side="left")] + p
        left[at] += step(left[at - 1], model.stay_good, model.stay_bad)
    last = start + count - 1
    for p in range(1, int(count.max(initial=0))):
        at = last[: np.searchsorted(-count, -p, side="left")] - p
        right[at] = step(emission[at + 1] + right[at + 1], model.stay_good, model.stay_bad)
    return left, right


def line_scores(lines: Lines, model: Model) -> np.ndarray:
    emission = model.weights[feature_ids(lines)].sum(axis=1)
    left, right = forward_backward(emission, lines.first, model)
    return 1 / (1 + np.exp(-np.clip(left + right, -60, 60)))


def document_scores(lines: Lines, model: Model) -> np.ndarray:
    weight = lines.length + 1.0
    total = np.add.reduceat(weight, lines.first[:-1])
    return np.clip(np.add.reduceat(weight * line_scores(lines, model), lines.first[:-1]) / total, 0, 1)


def fit_model(texts: list[str], labels: list[int]) -> Model | None:
    """Gradient ascent on the likelihood of the chains, with Adam's step sizes."""
    if not texts:
        return None
    data, ends = text_bytes(pa.array(texts, pa.string()))
    lines = split_lines(data, ends)
    ids, first = feature_ids(lines), lines.first
    count = np.diff(first)
    per_line = np.repeat(1 / count, count)  # a document weighs the same whatever its lines
    y = np.repeat(np.array(labels, dtype=float), count)
    link = np.ones(len(y), bool)
    link[first[1:] - 1] = False
    here = np.flatnonzero(link)
    size = int(ids.max()) + 1
    width = sum(w for _, _, w in blocks())
    theta, m, v = np.zeros(width + 2), np.zeros(width + 2), np.zeros(width + 2)
    for t in range(1, STEPS + 1):
        model = Model(theta[:width], theta[width], theta[width + 1])
        e = model.weights[ids].sum(axis=1)
        left, right = forward_backward(e, first, model)
        p = 1 / (1 + np.exp(-np.clip(left + right, -60, 60)))
        grad = np.zeros(width + 2)
        miss = (y - p) * per_line
        for k in range(ids.shape[1]):
            grad[:size] += np.bincount(ids[:, k], miss, minlength=size)[:size]
        a, b = left[here], e[here + 1] + right[here + 1]
        logs = np.stack([a + b + model.stay_good, a, b, np.full_like(a, model.stay_bad)])
        pair = np.exp(logs - np.logaddexp.reduce(logs, axis=0))
        both = y[here]
        grad[width] = np.sum((both - pair[0]) * per_line[here])
        grad[width + 1] = np.sum(((1 - both) - pair[3]) * per_line[here])
        grad = grad / len(count) - PENALTY * theta
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta = theta + RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return Model(theta[:width], float(theta[width]), float(theta[width + 1]))


def draw_sample(docs: DataFrame, labels: DataFrame, training: Column, label: str) -> list:
    """At most SAMPLE_ROWS labelled texts, the first in an order that depends on doc_id alone."""
    ids = (
        labels.where(F.col(label).isNotNull() & training)
        .select("doc_id", F.col(label).alias("label"), F.xxhash64(F.col("doc_id").cast("string")).alias("h"))
        .orderBy("h", "doc_id", "label")
        .limit(SAMPLE_ROWS)
    )
    short = docs.select("doc_id", "text").where(F.octet_length("text") <= SAMPLE_BYTES)
    rows = short.join(F.broadcast(ids), "doc_id").orderBy("h", "doc_id", "label", "text").limit(SAMPLE_ROWS)
    return rows.select("text", "label").collect()


def train(docs: DataFrame, labels: DataFrame, training: Column | None = None, label: str = "quality") -> Model | None:
    rows = draw_sample(docs, labels, F.lit(True) if training is None else training, label)
    return fit_model([r["text"] for r in rows], [r["label"] for r in rows])


def score(docs: DataFrame, model: Model | None, column: str = "text") -> DataFrame:
    """Adds ``score``; a column of that name is replaced."""
    kept = [f for f in docs.schema.fields if f.name != "score"]
    schema = T.StructType([*kept, T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, column):
            if model is None:
                scores = np.full(batch.num_rows, 0.5)
            else:
                data, ends = text_bytes(batch.column(batch.schema.get_field_index(column)))
                scores = document_scores(split_lines(data, ends), model)
            old = {f.name: batch.column(batch.schema.get_field_index(f.name)) for f in kept}
            yield pa.RecordBatch.from_pydict(old | {"score": pa.array(scores, pa.float64())})

    return docs.mapInArrow(run, schema)
