"""Mixture-controlled packing: deficit round-robin over one queue of tokens per source.

1. Tokens. Every document becomes the ids of its text and an end mark. A task lays its documents end to end, one
   queue per source, and notes where each begins; these rows are written, so a retried task can't move anything.
2. Places. Sums per task and source say where a task's stretch begins in the whole queue of its source.
3. Rounds. In every window each queue that still holds tokens is visited once. A visit adds the queue's quantum (its
   share of the window) to its deficit, takes the whole tokens of the deficit from the queue's head and carries the
   rest, so after any number of windows a queue has had its share to within a token. Once a queue runs dry, its share
   goes to the others.
4. Pieces. With the quanta fixed, the deficits before a window follow from its number: in ``w`` windows a queue takes ``w`` quanta,
   cut to whole tokens. Thus every document finds its windows, sequences and offsets from its own place; no task
   waits for the windows of another.

A window holds ``window`` sequences of ``length`` tokens, give or take the carried parts of a token. Nothing is padded but the
tail, which is cut into sequences of descending powers of two and so needs no padding either.

Targets: a share per source, relative to the other sources; by default the tokens that a source has, which spreads
every source evenly over the whole output. Sources without a target have none of it until the others are dry.

Defined cases: a null text is an empty one and an empty text is its end mark alone; a null source is the source ``''``; rows
that repeat are packed each; further columns are ignored; an empty table gives no pieces. More than ``MOST_QUEUES`` sources
raise: put them into groups first.
"""

from __future__ import annotations

import base64
import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stormledger.operators.joins import skew_safe_join

from .common import slices, stage

VOCABULARY = "byte_bpe_50k.json"
END_ID = 1
LENGTH = 2048
WINDOW = 16
MOST_QUEUES = 256
SLICE_BYTES = 1 << 20
KEPT_WINDOWS = 4096
# The fast library searches a run of blanks step by step and gives up on very long ones.
LONG_BLANK = re.compile(r"\s{10000}")


class Tokens:
    """Ids of a byte-level vocabulary file, as its own library gives them.

    The same vocabulary as ranks encodes about six times as fast; on every single character and in the tests both agree.
    Texts with strings of special tokens or very long runs of blanks go to the library itself.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.special = [t.content for t in self.slow.get_added_tokens_decoder().values()]
        ranks_of = path.removesuffix(".json") + ".tiktoken"
        self.fast = None
        try:
            with open(ranks_of, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        except FileNotFoundError:
            return
        named = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.fast = named.encode_ordinary

    def own(self, text: str) -> bool:
        """True if the file's own library has to encode the text."""
        return any(s in text for s in self.special) or (len(text) >= 10_000 and LONG_BLANK.search(text) is not None)

    def encode(self, text: str) -> list[int]:
        if self.fast is None or self.own(text):
            return self.slow.encode(text, add_special_tokens=False).ids
        return self.fast(text)


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenise(docs: DataFrame, path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """(doc_id, queue, task, place, doc_tokens, ids): ``ids`` are little-endian unsigned 32-bit integers, ``place`` the tokens of the
    queue before them in this task.
    """
    path = path or vocabulary_path()
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, filled = Tokens(path), {}
        for batch in slices(batches, most=SLICE_BYTES):
            texts, queues = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("text", "queue"))
            ids = [(np.array(tokens.encode(t), "<u4").tobytes() if t else b"") + end for t in texts]
            places = []
            for queue, x in zip(queues, ids):
                at = filled.get(queue, 0)
                places.append(at)
                filled[queue] = at + len(x) // 4
            rows = {c: batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "queue", "task")}
            rows |= {"place": pa.array(places, pa.int64()), "doc_tokens": pa.array([len(x) // 4 for x in ids], pa.int64())}
            yield pa.RecordBatch.from_pydict(rows | {"ids": pa.array(ids, pa.binary())})

    chosen = docs.select(
        F.col("doc_id").cast("long"),
        "text",
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("queue"),
        F.spark_partition_id().alias("task"),
    )
    return chosen.mapInArrow(run, "doc_id long, queue string, task int, place long, doc_tokens long, ids binary")


class Phase:
    """Windows in which the same queues are visited with the same quanta.

    ``first``: tokens of the output before it; a window holds about ``size``. ``own``: queue -> its parts of the ``whole`` window, in
    the order of the visits. ``taken``: queue -> its tokens taken earlier.
    """

    def __init__(self, first: int, windows: int, size: int, own: dict[str, int], taken: dict[str, int]):
        self.first, self.windows, self.size, self.own, self.taken = first, windows, size, own, taken
        self.whole = sum(own.values())
        self.begins: dict[int, dict[str, int]] = {}

    def head(self, queue: str, windows: int) -> int:
        """Tokens that the queue has given after so many windows: all its quanta less the deficit it carries on."""
        return windows * self.size * self.own[queue] // self.whole

    def length(self) -> int:
        return sum(self.head(q, self.windows) for q in self.own)

    def begin(self, queue: str, window: int) -> int:
        """Output position of the queue's visit in a window."""
        if window not in self.begins:
            if len(self.begins) > KEPT_WINDOWS:
                self.begins.clear()
            at, visits = self.first + sum(self.head(q, window) for q in self.own), {}
            for q in self.own:
                visits[q] = at
                at += self.head(q, window + 1) - self.head(q, window)
            self.begins[window] = visits
        return self.begins[window][queue]

    def stretches(self, queue: str, start: int, stop: int) -> Iterator[tuple[int, int]]:
        """(output position, tokens) of the queue's tokens from ``start`` to ``stop`` of this phase, window by window."""
        window = start * self.whole // (self.size * self.own[queue])
        while start < stop:
            low, high = self.head(queue, window), self.head(queue, window + 1)
            if high > start:
                n = min(stop, high) - start
                yield self.begin(queue, window) + start - low, n
                start += n
            window += 1


def schedule(totals: dict[str, int], size: int, targets: dict[str, float] | None = None) -> list[Phase]:
    """Phases that empty all queues; ``size``: tokens of a window."""
    left = {q: n for q, n in sorted(totals.items()) if n}
    weights = {q: Fraction(targets.get(q, 0) if targets else n).limit_denominator(10**9) for q, n in left.items()}
    if any(w < 0 for w in weights.values()):
        raise ValueError("a target is negative")
    phases: list[Phase] = []
    first, taken = 0, dict.fromkeys(left, 0)

    def add(windows: int, size: int, own: dict[str, int]) -> None:
        nonlocal first
        phase = Phase(first, windows, size, own, dict(taken))
        phases.append(phase)
        first += phase.length()
        for q in own:
            n = phase.head(q, windows)
            taken[q] += n
            left[q] -= n

    while total := sum(left.values()):
        active = {q: weights[q] for q in left if left[q] and weights[q]} or {q: Fraction(left[q]) for q in left if left[q]}
        scale = math.lcm(*(w.denominator for w in active.values()))
        own = {q: int(w * scale) for q, w in active.items()}
        whole = sum(own.values())
        windows = min(left[q] * whole // (size * own[q]) for q in own)  # as long as every queue can pay its quantum
        if any(windows * size * part // whole for part in own.values()):
            add(windows, size, own)
            continue
        # one window that empties the short queues; what they lack the others give
        quota, room = dict.fromkeys(own, 0), min(size, total)
        rest = dict(own)
        while room and rest:
            sum_rest, before, given = sum(rest.values()), 0, {}
            for q, part in rest.items():
                upto = (before + part) * room // sum_rest - before * room // sum_rest
                given[q] = min(upto, left[q] - quota[q])
                before += part
            for q, n in given.items():
                quota[q] += n
                room -= n
            rest = {q: part for q, part in rest.items() if quota[q] < left[q]}
        # targets without a token left: the sources without a target follow in the same window
        for q in [q for q in left if q not in quota and left[q]]:
            n = min(room, left[q])
            quota[q] = n
            room -= n
        add(1, sum(quota.values()), {q: n for q, n in quota.items() if n})
    return phases


def pieces_of(position: int, tokens: int, total: int, length: int) -> Iterator[tuple[int, int, int]]:
    """(sequence, offset, tokens) of a stretch of the output; past the last whole sequence come powers of two."""
    whole = total // length
    while tokens:
        sequence, offset, size = position // length, position % length, length
        if sequence >= whole:
            sequence, offset, bit = whole, position - whole * length, length
            tail = total - whole * length
            while True:
                bit >>= 1
                if not tail & bit:
                    continue
                if offset < bit:
                    break
                offset -= bit
                sequence += 1
            size = bit
        n = min(tokens, size - offset)
        yield sequence, offset, n
        position += n
        tokens -= n


def pack(
    docs: DataFrame,
    targets: dict[str, float] | None = None,
    length: int = LENGTH,
    window: int = WINDOW,
    path: str | None = None,
    end_id: int = END_ID,
) -> DataFrame:
    """(doc_id, source, start, length, doc_tokens, ids, sequence_id, offset), a row per piece of a document."""
    if length & (length - 1):
        raise ValueError("length must be a power of two")
    rows = stage(tokenise(docs, path, end_id), "tokens")
    sums = stage(rows.groupBy("task", "queue").agg(F.sum("doc_tokens").alias("n")), "queues")
    totals = {r.queue: r.n for r in sums.groupBy("queue").agg(F.sum("n").alias("n")).limit(MOST_QUEUES + 1).collect()}
    if len(totals) > MOST_QUEUES:
        raise ValueError(f"more than {MOST_QUEUES} sources; put them into groups")
    total = sum(totals.values())
    phases = schedule(totals, length * window, targets)
    # a row per task and source: one source's rows are as many as tasks that read it
    before = W.partitionBy("queue").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    stretch = lambda: F.concat_ws(":", "task", "queue").alias("stretch")
    heads = sums.select(stretch(), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("head"))
    placed = skew_safe_join(rows.select("*", stretch()), heads, "stretch")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("doc_id", "source", "start", "length", "doc_tokens", "ids", "sequence_id", "offset")
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64())
        plans: dict[str, tuple[list[Phase], list[int]]] = {}
        for batch in slices(batches, "ids"):
            out: dict[str, list] = {c: [] for c in names}
            for row in batch.to_pylist():
                queue, ids = row["queue"], row["ids"]
                if queue not in plans:
                    own = [p for p in phases if queue in p.own]
                    plans[queue] = own, [p.taken[queue] for p in own]
                own, taken = plans[queue]
                at, start, n = row["head"] + row["place"], 0, row["doc_tokens"]
                while start < n:
                    i = bisect_right(taken, at) - 1
                    phase = own[i]
                    stop = min(n - start, (taken[i + 1] if i + 1 < len(own) else totals[queue]) - at)
                    for position, tokens in phase.stretches(queue, at - taken[i], at - taken[i] + stop):
                        for sequence, offset, k in pieces_of(position, tokens, total, length):
                            piece = (row["doc_id"], queue, start, k, n, ids[4 * start : 4 * (start + k)], sequence, offset)
                            for c, v in zip(names, piece):
                                out[c].append(v)
                            start += k
                    at += stop
            yield pa.RecordBatch.from_pydict({c: pa.array(v, t) for (c, v), t in zip(out.items(), kinds)})

    schema = "doc_id long, source string, start long, length long, doc_tokens long, ids binary, sequence_id long, offset long"
    return placed.mapInArrow(run, schema)


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids): whole sequences, of at most ``length`` ids each, from the pieces."""
    joined = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("pieces"))
    whole = F.aggregate("pieces", F.lit(b""), lambda ids, p: F.concat(ids, p.ids))
    return joined.select("sequence_id", whole.alias("ids"))
