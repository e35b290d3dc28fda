"""BPE encoding and decoding with a given vocabulary file, by a pair occurrence index.

A task cuts its texts into slices and each slice into pre-tokens; distinct pre-tokens it does not remember are
encoded together, in blocks bounded in bytes. Their symbols stand in one flat list. An index maps each pair that has a
rank to all positions where it occurs; the active ranks are taken in ascending order, a
rank is applied at all its positions, and the lists of the neighbouring pairs are updated. A
merge makes pairs of higher rank only (checked on load), so one ascending pass is complete.

Defined cases: a null text is an empty text; an empty text has no ids and decodes to an empty string; strings of special
tokens inside a text are special tokens, as in the library; further columns pass through.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import slices

DEFAULT_VOCABULARY = "word_bpe_49k.json"
SLICE_BYTES = 2 << 20
# What a task remembers: words with their ids and the objects around them, in two halves of this size.
CACHE_BYTES = 48 << 20
WORD_OVERHEAD = 200
# Bytes of new words that are encoded together.
LEARN_BYTES = 1 << 18
FIRST_DISPUTED = "\u0530"


def vocabulary_path(name: str = DEFAULT_VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where it is printable, else the next from U+0100."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Codec:
    """Encoder and decoder of a vocabulary file; lives in one task."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        pairs = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
        self.rank = {(vocab[a], vocab[b]): r for r, (a, b) in enumerate(pairs)}
        self.made = [vocab[a + b] for a, b in pairs]
        born = {t: r for r, t in enumerate(self.made)}
        if any(born.get(x, -1) >= r for (a, b), r in self.rank.items() for x in (a, b)):
            raise ValueError("a merge comes before the merges that make its parts")
        symbols = byte_symbols()
        self.inner = [vocab[s] for s in symbols]
        self.final = [vocab[s + suffix] for s in symbols]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_split = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))))
        steps = spec["pre_tokenizer"]["pretokenizers"]
        self.path, self.pattern, self.rare = path, steps[0]["pattern"]["Regex"], None
        self.find = regex.compile(self.pattern).findall
        size = max(*vocab.values(), *self.special.values()) + 1
        self.text_of = [b""] * size
        for t, i in chain(vocab.items(), self.special.items()):
            self.text_of[i] = t.encode()
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.cached = 0

    def pre_tokens(self, text: str) -> list:
        """Words of the normalised text; an int is a special token's id."""
        parts = [text]
        if "<|" in text:
            parts, at = [], 0
            for m in self.special_split.finditer(text):
                parts += [text[at : m.start()], self.special[m[0]]]
                at = m.end()
            parts.append(text[at:])
        if len(parts) == 1:
            return self.words(text)
        return list(chain.from_iterable([p] if isinstance(p, int) else self.words(p) for p in parts))

    def words(self, text: str) -> list[str]:
        """Normalised words. Where Unicode versions may disagree on a character, the file's own library decides."""
        if text and max(text) >= FIRST_DISPUTED and any(unicodedata.category(c) == "Cn" for c in set(text)):
            if self.rare is None:
                from tokenizers import Regex, Tokenizer
                from tokenizers.pre_tokenizers import Split

                normal = Tokenizer.from_file(self.path).normalizer.normalize_str
                cut = Split(Regex(self.pattern), "removed", invert=True).pre_tokenize_str
                self.rare = lambda t: [w for w, _ in cut(normal(t))]
            return self.rare(text)
        return self.find(self.normal(text))

    @staticmethod
    def normal(text: str) -> str:
        if not text.isascii():
            # letter by letter: a final sigma has no form of its own
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()

    def learn(self, words: list[str]) -> None:
        """Encode distinct words together and keep their ids (little-endian 32-bit)."""
        sym: list[int] = []
        starts = []
        for w in words:
            starts.append(len(sym))
            raw = w.encode()
            sym += [self.inner[b] for b in raw[:-1]]
            sym.append(self.final[raw[-1]])
            sym.append(-1)
        n = len(sym)
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        rank, made = self.rank, self.made
        index: dict[int, list[int]] = {}
        for i, pair in enumerate(zip(sym, sym[1:])):
            r = rank.get(pair)
            if r is not None:
                index.setdefault(r, []).append(i)
        active = list(index)
        heapq.heapify(active)
        pair_of = self.pair_of
        while active:
            r = heapq.heappop(active)
            a, b = pair_of[r]
            new = made[r]
            for i in sorted(index.pop(r)):
                if sym[i] != a:
                    continue
                j = right[i]
                if sym[j] != b:
                    continue
                after = right[j]
                sym[i], sym[j] = new, -2
                right[i], left[after] = after, i
                before = left[i]
                for at, pair in ((before, (sym[before], new) if before >= 0 else None), (i, (new, sym[after]))):
                    q = rank.get(pair)
                    if q is not None:
                        if q in index:
                            index[q].append(at)
                        else:
                            index[q] = [at]
                            heapq.heappush(active, q)
        flat = np.array(sym, dtype="<i4")
        keep = flat >= 0
        ends = np.concatenate([np.cumsum(keep), [0]])
        ids = flat[keep].tobytes()
        for w, s, e in zip(words, starts, [*starts[1:], n]):
            lo = int(ends[s - 1]) if s else 0
            self.remember(w, ids[4 * lo : 4 * int(ends[e - 1])])

    def remember(self, word, ids: bytes) -> None:
        self.cache[word] = ids
        self.cached += WORD_OVERHEAD + len(ids) + (len(word) if isinstance(word, str) else 0)

    @property
    def pair_of(self):
        if not hasattr(self, "_pair_of"):
            self._pair_of = list(self.rank)
        return self._pair_of

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        cut = [self.pre_tokens(t) if t else [] for t in texts]
        if self.cached > CACHE_BYTES:  # words not used again by the time the cache is full once more are forgotten
            self.older, self.cache, self.cached = self.cache, {}, 0
        cache = self.cache
        new, size = [], 0
        for w in {w for words in cut for w in words if w not in cache}:
            if isinstance(w, int):
                self.remember(w, w.to_bytes(4, "little"))
            elif w in self.older:
                self.remember(w, self.older[w])
            else:
                new.append(w)
        new.sort()
        at = 0
        for i, w in enumerate(new):
            size += len(w)
            if size >= LEARN_BYTES:
                self.learn(new[at : i + 1])
                at, size = i + 1, 0
        if at < len(new):
            self.learn(new[at:])
        return [b"".join(map(cache.__getitem__, words)) for words in cut]

    def decode(self, ids: bytes) -> bytes:
        """Tokens joined by a space, in UTF-8: the vocabulary names no decoder of its own."""
        return b" ".join(map(self.text_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _with_columns(docs: DataFrame, fields: list[tuple[str, T.DataType, pa.DataType]], make, column: str) -> DataFrame:
    """Append columns that ``make(values)`` yields for a slice of ``column``; same-named ones are replaced."""
    names = {f[0] for f in fields}
    kept = [f for f in docs.schema.fields if f.name not in names]
    schema = T.StructType([*kept, *(T.StructField(n, t) for n, t, _ in fields)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict = {}
        for batch in slices(batches, column, SLICE_BYTES):
            new = make(state, batch.column(batch.schema.get_field_index(column)).to_pylist())
            old = {f.name: batch.column(batch.schema.get_field_index(f.name)) for f in kept}
            added = {n: pa.array(v, t) for (n, _, t), v in zip(fields, new)}
            yield pa.RecordBatch.from_pydict(old | added)

    return docs.mapInArrow(run, schema)


def encode(docs: DataFrame, column: str = "text", path: str | None = None) -> DataFrame:
    """Adds ``ids`` (array of int)."""
    path = path or vocabulary_path()

    def make(state, texts):
        codec = state.setdefault("codec", None) or state.update(codec=Codec(path)) or state["codec"]
        return [[np.frombuffer(x, "<i4") for x in codec.encode(texts)]]

    return _with_columns(docs, [("ids", T.ArrayType(T.IntegerType()), pa.list_(pa.int32()))], make, column)


def round_trip(docs: DataFrame, column: str = "text", path: str | None = None, with_ids: bool = False) -> DataFrame:
    """Adds n_tokens, ids_sha256 and decoded_sha256: encoded, then decoded from the ids alone; on request the ids too."""
    path = path or vocabulary_path()

    def make(state, texts):
        codec = state.setdefault("codec", None) or state.update(codec=Codec(path)) or state["codec"]
        sha = lambda b: hashlib.sha256(b).hexdigest()
        ids = codec.encode(texts)
        new = [[len(x) // 4 for x in ids], [sha(x) for x in ids], [sha(codec.decode(x)) for x in ids]]
        return new + [[np.frombuffer(x, "<i4") for x in ids]] * with_ids

    fields = [
        ("n_tokens", T.LongType(), pa.int64()),
        ("ids_sha256", T.StringType(), pa.string()),
        ("decoded_sha256", T.StringType(), pa.string()),
    ] + [("ids", T.ArrayType(T.IntegerType()), pa.list_(pa.int32()))] * with_ids
    return _with_columns(docs, fields, make, column)


def decode(docs: DataFrame, column: str = "ids", path: str | None = None) -> DataFrame:
    """Adds ``decoded`` (text) from a column of ids; null ids decode to an empty text."""
    path = path or vocabulary_path()
    schema = T.StructType([f for f in docs.schema.fields if f.name != "decoded"]).add("decoded", "string")

    def run(batches):
        codec = Codec(path)
        for batch in batches:
            rows = {n: batch.column(i) for i, n in enumerate(batch.schema.names) if n != "decoded"}
            ids = batch.column(batch.schema.get_field_index(column)).to_pylist()
            texts = [codec.decode(np.array(x or [], "<u4").tobytes()).decode() for x in ids]
            yield pa.RecordBatch.from_pydict(rows | {"decoded": pa.array(texts, pa.string())})

    return docs.mapInArrow(run, schema)
