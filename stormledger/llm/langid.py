"""Language ID with string kernels: presence of n-grams, Nyström landmarks, kernel ridge regression.

A text is the sets of its 1-, 2- and 3-grams over a small alphabet. The kernel of two texts is the
mean over the orders of |common grams| / sqrt(|grams of one| * |grams of the other|). A bounded
sample of landmark texts spans the Nyström features, and one ridge regression per language
separates it from the rest. As the kernel is linear in a text's presence vector, landmark
matrix, Nyström map and regression fold into one matrix, so that a batch of texts is
scored by one matrix product.

Only the training sample is bounded (``LANDMARKS``, ``SAMPLE_PER_LANGUAGE``, ``SAMPLE_CHARS``); every text is
scored whole. Defined cases: null texts and texts without a letter are ``und`` with score 0; without labelled
rows every text is ``und``; ties go to the first language in alphabetical order; further columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import letters, slices

LANDMARKS = 96
SAMPLE_PER_LANGUAGE = 400
SAMPLE_CHARS = 20_000
MOST_LANGUAGES = 1000
RIDGE = 0.1
SHARPNESS = 8.0
LEAST_SCORE = 0.3
# A text is familiar if it shares this part of what all but the strangest hundredth of the sample share with the landmarks.
FAMILIAR_PART, STRANGEST = 0.8, 0.01
# Texts of fewer characters say too little to be strange.
LEAST_CHARS = 20
BITS = 6
OTHER = 63
ORDERS = (1, 2, 3)
UNDETERMINED = "und"
BLOCK = 256
# Dense features of a block take rows x landmark grams floats; beyond this many bytes a block is scored in fewer rows at once.
FEATURE_BYTES = 32 << 20
LONG = 1 << 20


@dataclass
class Model:
    languages: list[str]
    classes: np.ndarray  # letter class of each code point of the basic plane
    columns: list[np.ndarray]  # per order, the grams that a landmark has
    weights: np.ndarray  # columns of all orders x languages
    bias: np.ndarray
    least_familiar: float  # share of a text's 2- and 3-grams that some landmark must have


def letter_classes(texts: list[str]) -> np.ndarray:
    """0: not a letter; 1 to 62: the most frequent letters of the sample; 63: any other letter."""
    counts = np.zeros(1 << 16, dtype=np.int64)
    for t in texts:
        points = code_points(t)
        counts += np.bincount(points, minlength=1 << 16)
    alphabetic = np.array([chr(i).isalpha() for i in range(1 << 16)])
    counts[~alphabetic] = 0
    classes = np.where(alphabetic, OTHER, 0).astype(np.uint8)
    top = np.argsort(-counts, kind="stable")[: OTHER - 1]
    top = top[counts[top] > 0]
    classes[top] = np.arange(1, len(top) + 1)
    return classes


def code_points(text: str) -> np.ndarray:
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return np.where(points < 1 << 16, points, 0xFFFF).astype(np.intp) if len(points) else points.astype(np.intp)


def presence(text: str, classes: np.ndarray, flags: list[np.ndarray]) -> bool:
    """Set the flags of the grams of a text; says whether it has a letter."""
    for f in flags:
        f[:] = 0
    for start in range(0, len(text), LONG):
        c = classes[code_points(text[max(0, start - 2) : start + LONG])].astype(np.int32)
        flags[0][c] = 1
        pair = (c[:-1] << BITS) | c[1:]
        flags[1][pair] = 1
        flags[2][(pair[:-1] << BITS) | c[2:]] = 1
    return bool(flags[0][1:].any())


def new_flags() -> list[np.ndarray]:
    return [np.zeros(1 << (BITS * n), dtype=np.uint8) for n in ORDERS]


def features(texts: list[str], classes, columns, flags) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of presence over the landmarks' grams, divided by sqrt(grams of the text); has-a-letter; familiarity.

    Familiarity is the share of a text's grams that some landmark has, the mean over the orders 2 and 3 that the text has
    (1 for a text of fewer than ``LEAST_CHARS`` characters). The margins compare languages with each other; this compares a text with all of them.
    """
    width = sum(map(len, columns))
    out = np.zeros((len(texts), width), dtype=np.float32)
    lettered = np.zeros(len(texts), dtype=bool)
    familiar = np.ones(len(texts))
    for i, t in enumerate(texts):
        if not t:
            continue
        lettered[i] = presence(t, classes, flags)
        at, shares = 0, []
        for order, f, cols in zip(ORDERS, flags, columns):
            n = int(f.sum(dtype=np.int64))
            if n:
                known = f[cols]
                np.multiply(known, np.float32(1 / np.sqrt(n)), out=out[i, at : at + len(cols)])
                if order > 1:
                    shares.append(int(known.sum(dtype=np.int64)) / n)
            at += len(cols)
        if shares and len(t) >= LEAST_CHARS:
            familiar[i] = sum(shares) / len(shares)
    return out, lettered, familiar


def fit_model(sample: list[tuple[str, str]]) -> Model | None:
    """From (language, text) pairs, already in a fixed random order."""
    languages = sorted({lang for lang, _ in sample})
    if not languages:
        return None
    by = {lang: [t for x, t in sample if x == lang] for lang in languages}
    each = max(1, LANDMARKS // len(languages))
    landmarks = [t for lang in languages for t in by[lang][:each]]
    classes, flags = letter_classes([t for _, t in sample]), new_flags()
    seen = new_flags()
    for t in landmarks:
        presence(t, classes, flags)
        for s, f in zip(seen, flags):
            s |= f
    columns = [np.flatnonzero(s) for s in seen]
    base, _, _ = features(landmarks, classes, columns, flags)
    base /= len(ORDERS)
    x, _, familiar = features([t for _, t in sample], classes, columns, flags)
    own = (base * len(ORDERS)) @ base.T
    values, vectors = np.linalg.eigh(own.astype(np.float64))
    good = values > 1e-6 * values.max(initial=1e-12)
    nystroem = base.T.astype(np.float64) @ (vectors[:, good] / np.sqrt(values[good]))
    phi = np.hstack([x.astype(np.float64) @ nystroem, np.ones((len(x), 1))])
    y = np.array([[1.0 if lang == other else -1.0 for other in languages] for lang, _ in sample])
    counts = np.array([len(by[lang]) for lang, _ in sample], dtype=float)
    w = (1 / counts)[:, None]  # each language weighs the same
    penalty = RIDGE * np.eye(phi.shape[1]) / len(x)
    beta = np.linalg.solve(phi.T @ (w * phi) + penalty, phi.T @ (w * y))
    weights, bias = (nystroem @ beta[:-1]).astype(np.float32), beta[-1].astype(np.float32)
    return Model(languages, classes, columns, weights, bias, FAMILIAR_PART * float(np.quantile(familiar, STRANGEST)))


def draw_sample(docs: DataFrame, training: Column) -> list[tuple[str, str]]:
    """A bounded sample of labelled texts per language, in an order that depends on doc_id alone."""
    usable = docs.where(training & F.col("lang").isNotNull())
    counts = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()}
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not counts:
        return []
    order = F.xxhash64(F.col("doc_id").cast("string"))
    share = F.create_map(
        *(F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, 2.0 * SAMPLE_PER_LANGUAGE / n)))
    )[F.col("lang")]
    near = (order / F.lit(2.0**64) + 0.5) < share
    rows = (
        usable.where(near & F.col("text").isNotNull() & (F.length("text").between(1, SAMPLE_CHARS)))
        .select("lang", "text", order.alias("h"))
        .orderBy("h", "lang", "text")
        .limit(3 * SAMPLE_PER_LANGUAGE * len(counts))
        .collect()
    )
    taken: dict[str, int] = {}
    sample = []
    for r in rows:
        if taken.get(r["lang"], 0) < SAMPLE_PER_LANGUAGE:
            taken[r["lang"]] = taken.get(r["lang"], 0) + 1
            sample.append((r["lang"], r["text"]))
    return sample


def train(docs: DataFrame, training: Column | None = None) -> Model | None:
    return fit_model(draw_sample(docs, F.lit(True) if training is None else training))


def predict(texts: list[str | None], model: Model | None, flags: list[np.ndarray]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, scores and familiarity of a block of texts."""
    names, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
    if model is None:
        return names, scores, np.zeros(len(texts))
    rows, parts = feature_rows(model), []
    for at in range(0, max(1, len(texts)), rows):
        x, has, known = features(texts[at : at + rows], model.classes, model.columns, flags)
        parts.append(((x @ model.weights + model.bias).astype(np.float64), has, known))
        del x
    margins = np.vstack([p[0] for p in parts])
    lettered = np.concatenate([p[1] for p in parts])
    familiar = np.concatenate([p[2] for p in parts])
    best = margins.argmax(axis=1)
    top = 1 / np.exp(SHARPNESS * (margins - margins.max(axis=1, keepdims=True))).sum(axis=1)
    for i, t in enumerate(texts):
        if t and (lettered[i] or letters(t)):
            names[i], scores[i] = model.languages[best[i]], top[i]
    return names, scores, familiar


def feature_rows(model: Model) -> int:
    """Rows scored at once: the whole block while its dense features fit ``FEATURE_BYTES``, else a multiple of 32 rows."""
    width = max(1, int(model.weights.shape[0]))
    if BLOCK * width * 4 <= FEATURE_BYTES:
        return BLOCK
    return max(32, FEATURE_BYTES // (4 * width) // 32 * 32)


def blocks(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, list]]:
    for whole in slices(batches, column):
        for at in range(0, whole.num_rows, BLOCK):
            batch = whole.slice(at, BLOCK)
            yield batch, batch.column(batch.schema.get_field_index(column)).to_pylist()


def classify(docs: DataFrame, model: Model | None, column: str = "text") -> DataFrame:
    """Adds ``lang_pred`` and ``score``; columns of these names are replaced."""
    kept = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score")]
    schema = T.StructType([*kept, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = new_flags()
        for batch, texts in blocks(batches, column):
            names, scores, _ = predict(texts, model, flags)
            old = {f.name: batch.column(batch.schema.get_field_index(f.name)) for f in kept}
            yield pa.RecordBatch.from_pydict(
                old | {"lang_pred": pa.array(names, pa.string()), "score": pa.array(scores, pa.float64())}
            )

    return docs.mapInArrow(run, schema)


def keep_identified(docs: DataFrame, model: Model | None, least: float = LEAST_SCORE, column: str = "text") -> DataFrame:
    """``docs`` without the texts that are in no learned language: without a letter (``und``), of a score below ``least``, or less
    familiar than the training sample lets one expect. Without a model nothing can be rejected.
    """
    if model is None:
        return docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = new_flags()
        for batch, texts in blocks(batches, column):
            names, scores, familiar = predict(texts, model, flags)
            known = (scores >= least) & (familiar >= model.least_familiar)
            keep = [n != UNDETERMINED and bool(k) for n, k in zip(names, known)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
