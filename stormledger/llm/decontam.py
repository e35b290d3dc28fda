"""Benchmark decontamination under edit distance.

Texts and items are compared in a plain form: letters of ASCII and Latin-1 lowered, every run of other ASCII
characters but digits and of other punctuation, symbols and spaces of the basic plane one space, all other bytes as
they are. A window of a text is as long as an item and aligned with it by any ``GRAM`` bytes that both have, wherever
they stand: no words are needed, so scripts without spaces and glued words are no special case. From these bytes on,
towards the longer side of the item, the CGK random walk embeds both strings: it emits the byte under its pointer and
a random bit that depends on step and byte moves the pointer, so that strings a few edits apart fall into step again and edit distance
becomes Hamming distance. ``WALKS * SAMPLES`` samples of ``BITS`` coordinates each are drawn; a window that
agrees with the item on all coordinates of any sample is verified by exact edit distance on the
item-sized window, and counts up to ``EDITS`` of the item's length.

Recall: an item with d edits in the embedded stretch of ``STEPS`` coordinates differs in some share s of them; one
anchor finds it with 1 - (1 - (1 - s)**BITS)**(WALKS * SAMPLES), 0.999 at s = 0.3, and every place of the item is an
anchor. A text is missed only if no ``GRAM`` bytes stand untouched or every sample of every anchor is hit by an edit;
the target is 0.97 up to ``EDITS``. The walk covers about ``STEPS / 2`` bytes from the anchor; anchors in all parts of
the item sample the rest, and the exact check sees the whole. Items of fewer than ``SHORT`` bytes are found without sampling: one of the pieces between their edits stands untouched.

The items travel with the plan in parts of about ``PART_BYTES`` of text (some 17 times that once prepared), one pass over the texts for each;
a pass is written before the next part is read, so that one part is on the driver and in a plan at a time. Texts are not
shuffled. Defined cases: null, empty and wordless texts and items match nothing; items of equal text are all
reported; repeated rows of a text are each reported; further columns are ignored.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, slices, stage
from .quality import text_bytes

GRAM = 9
SHORT = 64
STEPS = 96
WALKS = 3
SAMPLES = 20
BITS = 6
EDITS = 0.2
PART_BYTES = 1 << 20
RECORDS = 1 << 14
KEPT_BYTES = 64 << 20
CHUNK = 1 << 16

BLANKS = {"Pc", "Pd", "Ps", "Pe", "Pi", "Pf", "Po", "Sm", "Sc", "Sk", "So", "Zs", "Zl", "Zp", "Cc", "Cf"}
PLAIN = np.arange(256, dtype=np.uint8)
PLAIN[:128] = 32
PLAIN[48:58] = np.arange(48, 58)
PLAIN[97:123] = np.arange(97, 123)
PLAIN[65:91] = np.arange(97, 123)
BLANK = np.array([unicodedata.category(chr(i)) in BLANKS for i in range(1 << 16)])

RANDOM = np.random.default_rng(20)
WALK = RANDOM.integers(0, 2, (WALKS, STEPS, 256), dtype=np.uint8)
PLACES = RANDOM.random((WALKS, SAMPLES, BITS))
ODD = np.uint64(0x9E3779B97F4A7C15)


def blank_out(data: np.ndarray, form: np.ndarray) -> None:
    """Blanks in ``form`` for characters of two and three bytes that are neither letters, digits nor marks."""
    lead = np.flatnonzero(data >= 0xC2)
    for size, low, high in ((2, 0xC2, 0xE0), (3, 0xE0, 0xF0)):
        at = lead[(data[lead] >= low) & (data[lead] < high) & (lead + size <= len(data))]
        point = data[at].astype(np.int64) & (0x1F if size == 2 else 0x0F)
        for k in range(1, size):
            point = point << 6 | data[at + k] & 0x3F
        at = at[BLANK[point]]
        for k in range(size):
            form[at + k] = 32


def plain(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Plain form of all texts, where each ends in it, and the place of every byte in the original."""
    form = PLAIN[data]
    if len(form):  # capitals of Latin-1 are C3 80 to C3 9E, their small letters 20 higher
        form[1:][(data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)] += 32
    blank_out(data, form)
    space = form == 32
    drop = space.copy()
    if len(drop):
        drop[1:] &= space[:-1]
        first = np.concatenate([[0], ends[:-1]])
        first = first[first < len(data)]
        drop[first] = False
    kept = np.flatnonzero(~drop)
    return form[kept], np.searchsorted(kept, ends), kept


def grams(form: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes from each place on."""
    n = max(0, len(form) - GRAM + 1)
    out = np.ndarray((n,), "<u8", form.tobytes() + bytes(8), strides=(1,)) * ODD
    for k in range(8, GRAM):
        out += form[k : n + k] * np.uint64(0xD6E8FEB86659FD93 + 2 * k)
    return out


def embed(form: np.ndarray, at: np.ndarray, forward: np.ndarray) -> np.ndarray:
    """CGK embeddings of the strings that start at ``at`` and run forward or backward: a row of WALKS * STEPS bytes for each.

    ``form`` has a zero at both ends, which stands for what lies beyond.
    """
    order = np.argsort(forward, kind="stable")
    backward = len(at) - int(forward.sum())
    out = np.empty((WALKS * STEPS, len(at)), np.uint8)
    for lo, hi, move in ((0, backward, np.subtract), (backward, len(at), np.add)):
        if lo == hi:
            continue
        step = np.empty(hi - lo, np.uint8)
        for w in range(WALKS):
            here = at[order[lo:hi]]
            for j in range(STEPS):
                byte = out[w * STEPS + j, lo:hi]
                form.take(here, out=byte, mode="clip")
                WALK[w, j].take(byte, out=step, mode="clip")
                move(here, step, out=here)
    rows = np.empty((len(at), WALKS * STEPS), np.uint8)
    rows[order] = out.T
    return rows


def sample_masks() -> np.ndarray:
    """Bits of the coordinates of each sample for every number of coordinates filled: WALKS x SAMPLES x 2 x (STEPS + 1)."""
    bits = np.zeros((WALKS, SAMPLES, STEPS + 1, 128), np.uint8)
    for fill in range(8, STEPS + 1):
        skip = min(2 * GRAM, fill // 2)
        at = (skip + PLACES * (fill - skip)).astype(np.int64)
        for w in range(WALKS):
            for s in range(SAMPLES):
                bits[w, s, fill, at[w, s]] = 1
    return np.ascontiguousarray(np.packbits(bits, axis=3).view(np.uint64).transpose(0, 1, 3, 2))


@dataclass
class Items:
    ids: list[int]
    forms: list[bytes]
    text: np.ndarray  # all forms, a zero before, between and after them
    base: np.ndarray  # where each form starts in it
    word: np.ndarray  # the bytes of each anchor, sorted
    item: np.ndarray
    offset: np.ndarray
    short: list[int]
    tables: tuple | None = field(default=None)  # made once in a task

    def length(self, item: np.ndarray) -> np.ndarray:
        return np.diff(self.base, append=len(self.text))[item] - 1

    def frames(self, record: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each runs forward, and the coordinates that the form can fill."""
        n, offset = self.length(self.item[record]), self.offset[record].astype(np.int64)
        forward = n - offset >= offset + GRAM
        fill = np.minimum(STEPS, np.maximum(8, np.where(forward, n - offset, offset + GRAM) * 5 // 4))
        return forward, fill

    def embedding(self, record: np.ndarray, forward: np.ndarray) -> np.ndarray:
        start = self.base[self.item[record]] + self.offset[record] + np.where(forward, 0, GRAM - 1)
        return embed(self.text, start, forward)

    def prepared(self) -> tuple:
        """Filter of the anchors, and the embeddings of all of them if these are few."""
        if self.tables is None:
            shift = np.uint64(64 - min(27, max(16, len(self.word).bit_length() + 4)))
            seen = np.zeros(1 << (64 - int(shift)), bool)
            seen[self.word >> shift] = True
            every = np.arange(len(self.word))
            few = len(every) * WALKS * STEPS <= KEPT_BYTES
            kept = self.embedding(every, self.frames(every)[0]) if few else None
            self.tables = shift, seen, kept, sample_masks()
        return self.tables


def prepare(items: list[tuple[int, str]]) -> Items | None:
    ids, forms = [], []
    for item_id, text in items:
        data, ends = text_bytes(pa.array([text], pa.string()))
        form = plain(data, ends)[0].tobytes().strip(b" ")
        if form:
            ids.append(item_id)
            forms.append(form)
    if not ids:
        return None
    short = [i for i, f in enumerate(forms) if len(f) < SHORT]
    text = np.frombuffer(b"\0" + b"".join(f + b"\0" for f in forms), np.uint8)
    size = np.array([len(f) for f in forms])
    base = 1 + np.concatenate([[0], np.cumsum(size + 1)[:-1]])
    count = np.where(size < SHORT, 0, size - GRAM + 1)
    item = np.repeat(np.arange(len(ids), dtype=np.int32), count)
    offset = np.arange(len(item)) - np.repeat(np.cumsum(count) - count, count)
    word = grams(text)[base[item] + offset]
    order = np.argsort(word, kind="stable")
    return Items(ids, forms, text, base, word[order], item[order], offset[order].astype(np.int32), short)


def best_match(pattern: bytes, text: bytes, most: int) -> tuple[int, int]:
    """(distance, end) of the substring of ``text`` nearest to ``pattern`` (bit-parallel columns); distance > most: none."""
    m = len(pattern)
    masks: dict[int, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best, end = most + 1, 0
    for j, c in enumerate(text):
        eq = masks.get(c, 0)
        vertical = eq | down
        across = ((((eq & up) + up) ^ up) | eq) & full
        plus = (down | ~(across | up)) & full
        minus = up & across
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus, minus = (plus << 1) & full, (minus << 1) & full
        up = (minus | ~(vertical | plus)) & full
        down = plus & vertical
        if score < best:
            best, end = score, j + 1
    return best, end


def candidates(form: np.ndarray, stop: np.ndarray, items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, item, start in the plain form) of the windows that agree with an item on a sample."""
    out = [short_candidates(form, items)]
    if len(items.word):
        pos, first, count = anchors_in(form, items)
        total = np.cumsum(count)
        ringed = np.concatenate([[np.uint8(0)], form, [np.uint8(0)]])
        for block in range(0, int(total[-1]) if len(total) else 0, RECORDS):
            stop_at = min(block + RECORDS, int(total[-1]))
            lo, hi = np.searchsorted(total, [block, stop_at - 1], side="right")
            ends = np.minimum(total[lo : hi + 1], stop_at) - block
            of = lo + np.repeat(np.arange(hi + 1 - lo), np.diff(ends, prepend=0))
            record = first[of] + np.arange(block, stop_at) - (total[of] - count[of])
            found = agree_on_a_sample(ringed, pos[of], of - lo, items, record)
            out.append((items.item[record[found]].astype(np.int64), pos[of[found]] - items.offset[record[found]], pos[of[found]]))
    item, start, at = (np.concatenate(x) for x in zip(*out))
    return np.searchsorted(stop, at, side="right"), item, start


def anchors_in(form: np.ndarray, items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places with the bytes of an anchor; first and number of the records of these bytes."""
    shift, seen, *_ = items.prepared()
    likely = []
    for lo in range(0, len(form), CHUNK):  # small arrays stay in the processor's cache
        key = grams(form[lo : lo + CHUNK + GRAM - 1])
        at = np.flatnonzero(seen[key >> shift])
        likely.append((at + lo, key[at]))
    if not likely:
        return (np.zeros(0, np.int64),) * 3
    pos, key = (np.concatenate(x) for x in zip(*likely))
    first = np.searchsorted(items.word, key)
    hit = np.flatnonzero(items.word[np.minimum(first, len(items.word) - 1)] == key)
    return pos[hit], first[hit], np.searchsorted(items.word, key[hit], side="right") - first[hit]


def short_candidates(form: np.ndarray, items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(item, start, place of the piece) wherever one of the pieces of a short item stands, one more than it may have edits."""
    rows = []
    raw = form.tobytes() if items.short else b""
    for i in items.short:
        f = items.forms[i]
        pieces = int(EDITS * len(f)) + 1
        for p in range(pieces):
            offset = p * len(f) // pieces
            piece = f[offset : (p + 1) * len(f) // pieces]
            at = raw.find(piece)
            while at >= 0:
                rows.append((i, at - offset, at))
                at = raw.find(piece, at + 1)
    return tuple(np.array(rows, np.int64).reshape(-1, 3).T)


def agree_on_a_sample(form, pos, hit, items: Items, record) -> np.ndarray:
    """Whether each record agrees with the text at ``pos`` on a sample; ``hit`` numbers the places in ascending order."""
    forward, fill = items.frames(record)
    spot = hit * 2 + forward  # a place is embedded once in each direction
    used = np.zeros(2 * int(hit[-1]) + 2, np.int64)
    used[spot] = 1
    own_at = np.cumsum(used)[spot] - 1
    start, way = np.empty(own_at.max() + 1, np.int64), np.empty(own_at.max() + 1, bool)
    start[own_at], way[own_at] = pos + 1 + np.where(forward, 0, GRAM - 1), forward
    own = embed(form, start, way)
    _, _, theirs, masks = items.prepared()
    their_at = record
    if theirs is None:
        few, their_at = np.unique(record, return_inverse=True)
        theirs = items.embedding(few, items.frames(few)[0])
    equal = np.zeros((len(record), WALKS, 16), np.uint8)
    equal[:, :, : STEPS // 8] = np.packbits(own[own_at] == theirs[their_at], axis=1).reshape(-1, WALKS, STEPS // 8)
    equal = equal.view(np.uint64)
    found = np.zeros(len(record), bool)
    for full in (True, False):
        which = np.flatnonzero((fill == STEPS) == full)
        size = fill[which]
        agree = np.zeros(len(which), bool)
        for w in range(WALKS):
            low, high = equal[which, w].T.copy()
            for s in range(SAMPLES):
                a, b = masks[w, s, :, STEPS] if full else (masks[w, s, 0].take(size), masks[w, s, 1].take(size))
                agree |= ((low & a) == a) & ((high & b) == b)
        found[which] = agree
    return found


def pieces(text: bytes, size: int) -> np.ndarray:
    """The ``size`` (at most 4) bytes from each place on as one number."""
    t = np.frombuffer(text, np.uint8).astype(np.uint32)
    n = max(0, len(t) - size + 1)
    out = t[:n].copy()
    for k in range(1, size):
        out = out << np.uint32(8) | t[k : n + k]
    return out


@lru_cache(1 << 12)
def pieces_of_item(pattern: bytes, size: int) -> np.ndarray:
    return pieces(pattern, size)


def may_match(pattern: bytes, window: bytes, most: int) -> bool:
    """False if too few pieces of three or four bytes stand within ``most`` places of their own: an edit spoils as many pieces.

    ``window`` begins ``most`` bytes before the pattern's place and ends as many after it.
    """
    if len(window) != len(pattern) + 2 * most:
        return False  # it lies outside the text
    near = 2 * most + 1
    rows = max(1, (1 << 22) // near)
    for size in (4, 3):
        p, t = pieces_of_item(pattern, size), pieces(window, size)
        found = 0
        for r in range(0, len(p), rows):
            own = p[r : r + rows, None]
            found += int((np.ndarray((len(own), near), t.dtype, t, r * 4, (4, 4)) == own).any(axis=1).sum())
        if found < len(pattern) - size + 1 - size * most:
            return False
    return True


def whole_characters(data: np.ndarray, start: int, stop: int, first: int) -> tuple[int, int]:
    """The span widened to whole characters and counted from ``first``."""
    while start > first and data[start] & 0xC0 == 0x80:
        start -= 1
    while stop < len(data) and data[stop] & 0xC0 == 0x80:
        stop += 1
    return start - first, stop - first


def leaks_of(data: np.ndarray, ends: np.ndarray, items: Items) -> list[tuple[int, int, int, int, int]]:
    """(text, item, distance, start, stop), start and stop in bytes of the original; the best per text and item."""
    form, stop, place = plain(data, ends)
    docs, item, start = candidates(form, stop, items)
    raw = form.tobytes()
    begin = np.concatenate([[0], stop[:-1]])
    first = np.concatenate([[0], ends[:-1]])
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    verified: dict[tuple[int, int], int] = {}
    for d, i, s in sorted(set(zip(docs.tolist(), item.tolist(), start.tolist()))):
        pattern = items.forms[i]
        most = int(EDITS * len(pattern))
        if s - verified.get((d, i), s - most - 2) <= most + 1 or best.get((d, i), (1,))[0] == 0:
            continue
        at, past = s - most, s + len(pattern) + most
        window = raw[max(at, int(begin[d])) : min(past, int(stop[d]))]
        if not may_match(pattern, bytes(max(0, int(begin[d]) - at)) + window + bytes(max(0, past - int(stop[d]))), most):
            continue
        verified[d, i] = s  # its window holds those of the next ``most + 1`` places
        lo, hi = max(int(begin[d]), s - 2 * most - 1), min(int(stop[d]), s + len(pattern) + 2 * most + 2)
        text = raw[lo:hi]
        exact = text.find(pattern)
        distance, end = (0, exact + len(pattern)) if exact >= 0 else best_match(pattern, text, most)
        if distance > most:
            continue
        if exact < 0:
            back, length = best_match(pattern[::-1], text[:end][::-1], most)
            from_ = end - length
        else:
            from_ = exact
        span = (distance, *whole_characters(data, int(place[lo + from_]), int(place[lo + end - 1]) + 1, int(first[d])))
        best[d, i] = min(best.get((d, i), span), span)
    return [(d, i, *v) for (d, i), v in sorted(best.items())]


def count_parts(items: DataFrame) -> int:
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, -(-size // PART_BYTES))


def item_parts(items: DataFrame, parts: int) -> Iterator[list[tuple[int, str]]]:
    """The items in parts that are small enough to send with a plan; the next is read when it is asked for."""
    for p in range(parts):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == p).where("text IS NOT NULL")
        yield [(r["item_id"], r["text"]) for r in own.select("item_id", "text").orderBy("item_id", "text").collect()]


def find_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, distance, start, stop) of every text and item that it contains."""
    schema = "doc_id long, item_id long, distance long, start long, stop long"

    def passes(prepared: Items | None) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                if prepared is None:
                    return
                data, ends = text_bytes(batch.column(batch.schema.get_field_index("text")))
                rows = leaks_of(data, ends, prepared)
                pick = pa.array([r[0] for r in rows], pa.int64())
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column(batch.schema.get_field_index("doc_id")).take(pick),
                        "item_id": pa.array([prepared.ids[r[1]] for r in rows], pa.int64()),
                        **{n: pa.array([r[c] for r in rows], pa.int64()) for c, n in ((2, "distance"), (3, "start"), (4, "stop"))},
                    }
                )

        return docs.select("doc_id", "text").mapInArrow(run, schema)

    parts = count_parts(items)
    if parts == 1:
        return passes(prepare(next(item_parts(items, 1))))
    return reduce(DataFrame.unionByName, [stage(passes(prepare(part)), "leaks") for part in item_parts(items, parts)])


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the texts that contain an item; rows are judged one by one."""

    def passes(prepared: Items | None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                keep = np.ones(batch.num_rows, bool)
                if prepared is not None:
                    data, ends = text_bytes(batch.column(batch.schema.get_field_index("text")))
                    keep[[r[0] for r in leaks_of(data, ends, prepared)]] = False
                yield batch.filter(pa.array(keep))

        return run

    parts, before = count_parts(items), None
    for i, part in enumerate(item_parts(items, parts)):
        docs = docs.mapInArrow(passes(prepare(part)), docs.schema)
        if i < parts - 1:
            docs = stage(docs, "clean")
            if before is not None:
                discard(before)
            before = docs
    return docs
