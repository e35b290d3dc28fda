"""Toxicity of obfuscated text by a noisy channel.

1. A character language model: bigram counts of the letters of all texts, each task counting its own part.
2. Restoration: a token is a lattice. A letter stands for itself, a digit or symbol for the letters it
   imitates or for nothing, a repeated character for one letter or more, and a run of
   single characters, with any white space between and marks at its ends, is one token. A token may also be several,
   joined by marks, and a few tokens one, torn by blanks. Viterbi finds the likeliest letters. Words of the
   toxic lexicon are paths of the same lattice with a prior of their own (``WORD_PRIOR``): the
   likelier of the two is the restored token.
3. Scoring: weights of restored words, learned from a bounded sample of labelled rows (``SAMPLE_ROWS``). For
   the score alone, only tokens whose lattice holds a lexicon word are decoded: no other token can
   become one. They are found for all new tokens at once: without imitations all paths of a lattice share a shape; with
   some, which may also stand for nothing, a word has all letters of the token and no letter that none of its characters can be.

Only the training sample is bounded; texts are scored whole, tokens and runs of any length included. Near copies of one training text count once per
word (by a fingerprint of the text), so that words of a copied text do not enter the lexicon. Defined cases:
null and empty texts get the score of a text without a lexicon word; without labelled rows every score is 0;
further columns pass through.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, stage

SAMPLE_ROWS = 20_000
SAMPLE_CHARS = 20_000
LEAST_TEXTS = 5
LEAST_LOG_ODDS = 3.0
LEAST_LETTERS = 3
CACHED_TOKENS = 500_000
BACK_BYTES = 64 << 20
SYMBOLS = 60  # 0: end of a word, 1 to 26: a to z, 27 to 58: letters of Latin-1, 59: other letters
OTHER = 59

# The letters that digits and symbols imitate.
IMITATES = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i",
}
# End of fixed values.
COST_IMITATE = math.log(0.05)
COST_DROP = math.log(0.001)
COST_REPEAT = math.log(0.2)
WORD_PRIOR = math.log(1e-5)

TOKEN = re.compile(r"\S+")
EDGE = ".,;:?\"'()[]{}<>«»“”‘’…-_*#%&~^=/\\"
MARKS = re.escape(EDGE + "!|+")
SINGLE = r"(?:[^\W_]|[@$!|+(€£¡])"
SPACED = re.compile(rf"(?:(?<!\S)|(?<=[{MARKS}])){SINGLE}(?:\s+{SINGLE})+(?=[{MARKS}]*(?!\S))")
INNER = (re.compile(r"(?:[^\w@$!|+(€£¡]|_)+"), re.compile(r"[\W_]+"))  # marks that imitate no letter; all marks
PLAIN = re.compile(r"(?:([^\W\d_])(?!\1))*")


def symbol(char: str) -> int:
    if "a" <= char <= "z":
        return ord(char) - 96
    point = ord(char)
    if 0xDF <= point <= 0xFF and point != 0xF7:
        return point - 0xDF + 27 if point < 0xF7 else point - 0xE0 + 27
    return OTHER if char.isalpha() else 0


def symbol_table() -> np.ndarray:
    """Symbol of each code point of the basic plane (lower case)."""
    return np.array([symbol(chr(i)) for i in range(1 << 16)], dtype=np.uint8)


def bigram_counts(docs: DataFrame, column: str = "text") -> np.ndarray:
    """Counts of letter pairs, word ends included, over every text of ``docs``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, total = symbol_table(), np.zeros(SYMBOLS * SYMBOLS, dtype=np.int64)
        for batch in slices(batches, column):
            texts = batch.column(batch.schema.get_field_index(column)).to_pylist()
            points = np.frombuffer(" ".join(t or "" for t in texts).lower().encode("utf-32-le"), "<u4")
            c = classes[np.where(points < 1 << 16, points, 32)].astype(np.int32)
            total += np.bincount(c[:-1] * SYMBOLS + c[1:], minlength=len(total))
        pairs = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"pair": pa.array(pairs, pa.int32()), "n": pa.array(total[pairs], pa.int64())})

    rows = docs.select(column).mapInArrow(count, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(SYMBOLS * SYMBOLS)
    for r in rows:
        counts[r["pair"]] = r["n"]
    return counts.reshape(SYMBOLS, SYMBOLS)


def char_model(counts: np.ndarray) -> np.ndarray:
    """log P(next | last), smoothed."""
    return np.log((counts + 0.1) / (counts + 0.1).sum(axis=1, keepdims=True))


@dataclass
class Model:
    language: np.ndarray
    weights: dict[str, float]  # restored word -> log-odds
    base: float  # log-odds of a text without any of them
    shapes: dict[str, list[str]] = field(init=False)  # what a lattice has in common with the words it accepts

    def __post_init__(self):
        self.shapes = {}
        for w in sorted(self.weights):
            self.shapes.setdefault(shape(w), []).append(w)


ALIKE = str.maketrans({**{k: v[0] for k, v in IMITATES.items()}, "l": "i"})


def shape(token: str) -> str:
    """Equal for all tokens without imitations whose lattices share a path: repeats and all but letters left out."""
    out = []
    for c in token.translate(ALIKE):
        if c.isalpha() and (not out or out[-1] != c):
            out.append(c)
    return "".join(out)


def letter_bit(letter: str) -> int:
    return 1 << ord(letter) % 64


def letter_sets(token: str) -> tuple[int, int]:
    """Bits of the letters that every path of the lattice has, and of those that any path has."""
    sure = possible = 0
    for c in token:
        if c.isalpha():
            sure |= letter_bit(c)
        for x in options(c):
            possible |= letter_bit(x)
    return sure, possible


def options(char: str) -> str:
    return char if char.isalpha() else IMITATES.get(char, "")


def path_cost(token: str, word: str) -> float:
    """Channel cost of the best path of the lattice of ``token`` that spells ``word``; -inf without one."""
    at = {0: 0.0}
    for c in token:
        letters = options(c)
        price = 0.0 if c.isalpha() else COST_IMITATE
        step: dict[int, float] = {}

        def reach(k: int, cost: float, step=step) -> None:
            step[k] = max(cost, step.get(k, -math.inf))

        for k, cost in at.items():
            if k < len(word) and word[k] in letters:
                reach(k + 1, cost + price)
            if not c.isalpha():
                reach(k, cost + COST_DROP)
            if k and word[k - 1] in letters:
                reach(k, cost + price + COST_REPEAT)
        at = step
    return at.get(len(word), -math.inf)


def spelled(chars: str, words: list[str]) -> set[str]:
    """The words that the lattice of any stretch of ``chars`` spells; bit k of a word: its first k + 1 letters are read."""
    words = [w for w in words if w]
    masks: dict[str, int] = {}
    starts = at = 0
    ends = []
    for w in words:
        starts |= 1 << at
        for x in w:
            masks[x] = masks.get(x, 0) | 1 << at
            at += 1
        ends.append(1 << at - 1)
    done = sum(ends)
    read = seen = 0
    for c in chars:
        here = 0
        for x in options(c):
            here |= masks.get(x, 0)
        read = ((read << 1 | starts) | read) & here | (0 if c.isalpha() else read)
        seen |= read & done
    return {w for w, end in zip(words, ends) if seen & end}


def viterbi(tokens: list[str], language: np.ndarray) -> list[tuple[str, float]]:
    """The likeliest letters of each token's lattice and their log-probability.

    Tokens of one length are decoded together, up to ``BACK_BYTES`` of steps at a time; one token of any length is.
    """
    out: dict[str, tuple[str, float]] = dict.fromkeys(tokens, ("", -math.inf))
    by_length: dict[int, list[str]] = {}
    for t in tokens:
        by_length.setdefault(len(t), []).append(t)
    names: dict[int, str] = {}
    groups = []
    for length, group in by_length.items():
        most = max(1, BACK_BYTES // (SYMBOLS * max(1, length)))
        groups += [(length, group[i : i + most]) for i in range(0, len(group), most)]
    for length, group in groups:
        n = len(group)
        score = np.full((n, SYMBOLS), -np.inf)
        score[:, 0] = 0.0
        back = np.zeros((length, n, SYMBOLS), dtype=np.int8)
        rows = np.arange(n)
        for p in range(length):
            fresh = np.full_like(score, -np.inf)
            source = np.broadcast_to(np.arange(SYMBOLS, dtype=np.int8), score.shape).copy()
            chars = [t[p] for t in group]
            skips = np.array([not c.isalpha() for c in chars])
            fresh[skips] = score[skips] + COST_DROP
            choices = [options(c) for c in chars]
            for k in range(max(map(len, choices), default=0)):
                has = rows[[len(x) > k for x in choices]]
                letter = np.array([symbol(choices[i][k]) for i in has], dtype=np.int64)
                for i in has:
                    names.setdefault(symbol(choices[i][k]), choices[i][k])
                price = np.array([0.0 if chars[i].isalpha() else COST_IMITATE for i in has])
                reach = score[has] + language[:, letter].T
                best = reach.argmax(axis=1)
                value = reach[np.arange(len(has)), best] + price
                stay = score[has, letter] + COST_REPEAT + price  # a repeat of the letter before
                repeat = stay > value
                value, best = np.where(repeat, stay, value), np.where(repeat, -1, best)
                better = value > fresh[has, letter]
                fresh[has[better], letter[better]] = value[better]
                source[has[better], letter[better]] = best[better]
            back[p], score = source, fresh
        score = score + language[:, 0]
        score[:, 0] = np.where(np.isfinite(score[:, 0]), score[:, 0], -np.inf)
        state = score.argmax(axis=1)
        value = score.max(axis=1)
        spelled: list[list[str]] = [[] for _ in group]
        for p in range(length - 1, -1, -1):
            origin = back[p, rows, state]
            for i in range(n):
                o, s = int(origin[i]), int(state[i])
                if o == -1:
                    continue  # a repeat: the letter is written where it began
                if o != s or (group[i][p].isalpha()):
                    c = group[i][p]
                    spelled[i].append(c if symbol(c) == s and c.isalpha() else names.get(s, ""))
                    state[i] = o
        for t, letters_, x in zip(group, spelled, value.tolist()):
            out[t] = "".join(reversed(letters_)), x
    return [out[t] for t in tokens]


def clean(token: str) -> str:
    return token.strip(EDGE)


def parts(core: str) -> set[str]:
    """What the marks inside a token part."""
    return {p for marks in INNER for p in marks.split(core) if len(p) >= LEAST_LETTERS and p != core}


def shape_keys(tokens: list[str], classes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """A hash of the shape of every token: the letters after imitation, without repeats."""
    points = np.frombuffer("\n".join([*tokens, ""]).encode("utf-32-le", "surrogatepass"), "<u4")
    ends = np.flatnonzero(points == 10)
    code = classes[np.where(points < 1 << 16, points, 0xFFFF)].astype(np.uint64)
    token = np.searchsorted(ends, np.arange(len(points)))
    kept = np.flatnonzero(code)
    code, token = code[kept], token[kept]
    fresh = np.ones(len(code), bool)
    fresh[1:] = (code[1:] != code[:-1]) | (token[1:] != token[:-1])
    code, token = code[fresh], token[fresh]
    first = np.searchsorted(token, np.arange(len(tokens)))
    place = np.arange(len(code)) - first[token]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(code * weights[place % len(weights)], dtype=np.uint64)])
    last = np.searchsorted(token, np.arange(len(tokens)), side="right")
    return sums[last] - sums[first]


class Restorer:
    """Restores tokens; each distinct one once in a task."""

    def __init__(self, model: Model):
        self.model = model
        self.seen: set[str] = set()
        self.toxic: dict[str, set[str]] = {}
        self.torn: dict[str, str] = {}  # tokens that begin a lexicon word, with their shape
        self.begins = {x[:k] for x in self.model.shapes for k in range(1, len(x) + 1)}
        self.begin_keys = np.zeros(0, np.uint64)
        self.restored: dict[str, str] = {}
        self.singles: set[str] = set()
        table = np.zeros(1 << 16, dtype=np.uint32)
        for i in range(1, 1 << 16):
            c = chr(i).translate(ALIKE)
            table[i] = ord(c) if len(c) == 1 and c.isalpha() else 0
        self.classes = table
        self.mix = np.random.default_rng(11).integers(1, 2**63, 61, dtype=np.uint64) | np.uint64(1)
        self.begin_keys = np.sort(shape_keys(sorted(self.begins), table, self.mix))
        self.keys = np.sort(shape_keys(sorted(self.model.shapes), table, self.mix))
        self.sets = {w: letter_sets(w)[0] for w in sorted(self.model.weights)}
        self.bits = np.zeros((2, 1 << 16), dtype=np.uint64)
        self.imitates = np.zeros(1 << 16, dtype=bool)
        for i in range(1 << 16):
            self.bits[:, i] = letter_sets(chr(i))
            self.imitates[i] = chr(i) in IMITATES
        self.bits[1, 0xFFFF] = np.uint64(2**64 - 1)  # all beyond the basic plane
        self.least = min((len(set(x)) for x in self.model.shapes), default=1 << 30)

    def lexicon(self, core: str) -> list[str]:
        """All words that the lattice of a token may hold."""
        if not any(c in IMITATES for c in core):
            return self.model.shapes.get(shape(core), [])
        sure, possible = letter_sets(core)
        return [w for w, own in self.sets.items() if not sure & ~own and not own & ~possible]

    def likely(self, cores: list[str]) -> np.ndarray:
        """The tokens with any such word."""
        points = np.frombuffer("\n".join([*cores, ""]).encode("utf-32-le", "surrogatepass"), "<u4")
        ends = np.flatnonzero(points == 10)
        points = np.where(points < 1 << 16, points, 0xFFFF)
        starts = np.concatenate([[0], ends[:-1] + 1])
        noisy = np.logical_or.reduceat(self.imitates[points], starts)
        found = ~noisy & np.isin(shape_keys(cores, self.classes, self.mix), self.keys)
        at = np.flatnonzero(noisy)
        sure, possible = (np.bitwise_or.reduceat(b[points], starts)[at] for b in self.bits)
        for own in set(self.sets.values()):
            own = np.uint64(own)
            found[at[((sure & ~own) | (own & ~possible)) == 0]] = True
        return np.flatnonzero(found)

    def decode(self, cores: list[str]) -> list[str]:
        """The likelier of the free path and the lexicon paths of each token."""
        plain = {c for c in cores if PLAIN.fullmatch(c)}
        noisy = [c for c in dict.fromkeys(cores) if c not in plain]
        free = dict(zip(noisy, viterbi(noisy, self.model.language)))
        out = []
        for core in cores:
            word, best = (core, 0.0) if core in plain else free[core]
            for w in self.lexicon(core):
                x = WORD_PRIOR + path_cost(core, w)
                if x > best or w == core:
                    word, best = w, x
            out.append(word)
        return out

    def learn(self, tokens: set[str]) -> None:
        """Find the new tokens that become lexicon words."""
        if len(self.seen) > CACHED_TOKENS:
            self.seen.clear()
        new = sorted(tokens - self.seen)
        self.seen.update(new)
        if not new or not len(self.keys):
            return
        cores = [clean(t) for t in new]
        self.singles.update(t for t, c in zip(new, cores) if len(t) == 1 or len(c.strip("!|+(")) == 1)
        for i in np.flatnonzero(np.isin(shape_keys(cores, self.classes, self.mix), self.begin_keys)):
            if shape(cores[i]) in self.begins:
                self.torn[new[i]] = shape(cores[i])
        for trim in ("", "!|+("):  # at the end these are letters or punctuation
            likely = self.likely([c.rstrip(trim) for c in cores] if trim else cores)
            for i, word in zip(likely, self.decode([cores[i].rstrip(trim) if trim else cores[i] for i in likely])):
                if word in self.model.weights:
                    self.toxic.setdefault(new[i], set()).add(word)
        joined = [(t, part) for t, core in zip(new, cores) if not core.isalnum() for part in parts(core)]
        pieces = sorted({p for _, p in joined})
        if pieces:
            likely = self.likely(pieces)
            found = {pieces[i]: w for i, w in zip(likely, self.decode([pieces[i] for i in likely])) if w in self.model.weights}
            for t, part in joined:
                if part in found:
                    self.toxic.setdefault(t, set()).add(found[part])

    def mended(self, text: str) -> list[tuple[int, int, str]]:
        """(start, stop, word) where tokens beside each other spell a word that is likelier than they are by themselves."""
        out, spans = [], [(m.start(), m.end(), m[0]) for m in TOKEN.finditer(text)]
        i = 0
        while i < len(spans):
            key, best = self.torn.get(spans[i][2]), None
            j = i + 1
            while key in self.begins and j < len(spans):
                core = clean(spans[j][2])
                key = shape(key + shape(core))
                j += 1
                if key in self.model.shapes:
                    cores = [clean(x[2]) for x in spans[i:j]]
                    apart = sum(x for _, x in viterbi(cores, self.model.language))
                    for w in self.model.shapes[key]:
                        if WORD_PRIOR + path_cost("".join(cores), w) + COST_DROP * (j - i - 1) > apart:
                            best = (spans[i][0], spans[j - 1][1], w), j
            if best:
                out.append(best[0])
            i = best[1] if best else i + 1
        return out

    def spaced(self, run: str) -> set[str]:
        """Lexicon words spelled by a run of single characters, found anywhere in it."""
        return spelled("".join(run.split()), list(self.model.weights))

    def words(self, texts: list[str | None]) -> list[set[str]]:
        """The lexicon words of each text."""
        low = [(t or "").lower() for t in texts]
        tokens = [set(t.split()) for t in low]
        self.learn(set().union(*tokens) if tokens else set())
        out = []
        for t, own in zip(low, tokens):
            hits = set().union(*(self.toxic[x] for x in self.toxic.keys() & own))
            if self.torn.keys() & own:
                hits |= {w for _, _, w in self.mended(t)}
            if len(self.singles & own) >= self.least:
                for m in SPACED.finditer(t):
                    hits |= self.spaced(m[0])
            out.append(hits)
        return out

    def restore(self, text: str) -> str:
        text = SPACED.sub(lambda m: "".join(m[0].split()) if self.spaced(m[0]) else m[0], text.lower())
        self.learn(set(text.split()))
        for start, stop, word in reversed(self.mended(text)):
            text = text[:start] + word + text[stop:]
        if len(self.restored) > CACHED_TOKENS:
            self.restored.clear()
        new = sorted(set(text.split()) - self.restored.keys())
        cores = [clean(t) for t in new]
        for t, core, word in zip(new, cores, self.decode(cores)):
            bare = core.rstrip("!|+(")
            if word not in self.model.weights and bare != core:
                trimmed = self.decode([bare])[0]
                word = trimmed if trimmed in self.model.weights else word
            if word not in self.model.weights:
                for marks in INNER:
                    own = [p for p in marks.split(core) if p != core and self.decode([p])[0] in self.model.weights] if not core.isalnum() else []
                    if own:
                        word = core
                        for p in own:
                            word = word.replace(p, self.decode([p])[0])
                        break
            self.restored[t] = word
        return TOKEN.sub(lambda m: self.restored[m[0]], text)


def learn_words(docs: DataFrame, labels: DataFrame, training: Column, label: str) -> tuple[dict[str, float], float]:
    """Log-odds of the words that mark label 1, and those of a text without any."""
    ids = (
        labels.where(F.col(label).isNotNull() & training)
        .select("doc_id", F.col(label).alias("label"), F.xxhash64(F.col("doc_id").cast("string")).alias("h"))
        .orderBy("h", "doc_id", "label")
        .limit(SAMPLE_ROWS)
    )
    texts = docs.select("doc_id", "text").where(F.length("text").between(1, SAMPLE_CHARS))
    sample = texts.join(F.broadcast(ids), "doc_id").select("text", "label")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words, labels_, marks = [], [], []
            for row in batch.to_pylist():
                tokens = [clean(t) for t in row["text"].lower().split()]
                mark = min((zlib_hash(f"{a} {b}") for a, b in zip(tokens, tokens[1:])), default=0)
                for w in {t for t in tokens if len(t) >= LEAST_LETTERS and t.isalpha()} | {""}:
                    words.append(w)
                    labels_.append(row["label"])
                    marks.append(mark)
            yield pa.RecordBatch.from_pydict(
                {"word": pa.array(words, pa.string()), "label": pa.array(labels_, pa.int32()), "mark": pa.array(marks, pa.int64())}
            )

    seen = sample.withColumn("label", F.col("label").cast("int")).mapInArrow(split, "word string, label int, mark long")
    seen = stage(seen.dropDuplicates(["word", "label", "mark"]), "toxicity-words")
    n = seen.groupBy("word").agg(
        F.sum(F.when(F.col("label") == 1, 1).otherwise(0)).alias("bad"),
        F.sum(F.when(F.col("label") == 1, 0).otherwise(1)).alias("good"),
    )
    total = n.where("word = ''").collect()
    if not total:
        return {}, -math.inf
    bad, good = total[0]["bad"], total[0]["good"]
    odds = lambda b, g: math.log((b + 0.5) / (bad + 1)) - math.log((g + 0.5) / (good + 1))
    rows = n.where((F.col("word") != "") & (F.col("bad") >= LEAST_TEXTS) & (F.col("bad") > F.col("good"))).collect()
    weights = {r["word"]: odds(r["bad"], r["good"]) for r in rows}
    weights = {w: x for w, x in weights.items() if x >= LEAST_LOG_ODDS}
    marked = seen.where(F.col("word").isin(*weights)).select("label", "mark").distinct() if weights else seen.limit(0)
    with_word = {r["label"]: r["count"] for r in marked.groupBy("label").count().collect()}
    rest_bad, rest_good = bad - with_word.get(1, 0), good - sum(c for x, c in with_word.items() if x != 1)
    return weights, math.log((max(rest_bad, 0) + 0.5) / (max(rest_good, 0) + 0.5))


def zlib_hash(text: str) -> int:
    import zlib

    return (zlib.crc32(text.encode()) * 0x9E3779B1 + 0x7F4A7C15) & 0xFFFFFFFF


def train(docs: DataFrame, labels: DataFrame, training: Column | None = None, label: str = "toxic") -> Model:
    weights, base = learn_words(docs, labels, F.lit(True) if training is None else training, label)
    return Model(char_model(bigram_counts(docs)), weights, base)


def score(docs: DataFrame, model: Model, column: str = "text") -> DataFrame:
    """Adds ``score``; a column of that name is replaced."""
    kept = [f for f in docs.schema.fields if f.name != "score"]
    schema = T.StructType([*kept, T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model)
        for batch in slices(batches, column):
            scores = []
            for found in restorer.words(batch.column(batch.schema.get_field_index(column)).to_pylist()):
                x = model.base + sum(model.weights[w] for w in sorted(found))
                scores.append(1 / (1 + math.exp(-max(-60.0, min(60.0, x)))) if math.isfinite(x) else 0.0)
            old = {f.name: batch.column(batch.schema.get_field_index(f.name)) for f in kept}
            yield pa.RecordBatch.from_pydict(old | {"score": pa.array(scores, pa.float64())})

    return docs.mapInArrow(run, schema)


def restore(docs: DataFrame, model: Model, column: str = "text") -> DataFrame:
    """Adds ``restored``, the text with its tokens decoded (lower case; white space kept)."""
    kept = [f for f in docs.schema.fields if f.name != "restored"]
    schema = T.StructType([*kept, T.StructField("restored", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model)
        for batch in slices(batches, column):
            texts = batch.column(batch.schema.get_field_index(column)).to_pylist()
            new = [None if t is None else restorer.restore(t) for t in texts]
            old = {f.name: batch.column(batch.schema.get_field_index(f.name)) for f in kept}
            yield pa.RecordBatch.from_pydict(old | {"restored": pa.array(new, pa.string())})

    return docs.mapInArrow(run, schema)
