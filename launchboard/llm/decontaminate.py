"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit check.

A leak is a window of a document, of any length, within edit distance
``floor(EDIT_RATE * words)`` of a benchmark item (words lower-cased, in words). So it has
up to that many words more or fewer than the item, and may be all of a short text.

The CGK random walk turns edit distance into Hamming distance: a pointer goes along
the words; step j writes the word under it and moves on or stays by a random bit of
(step, word). Items and windows that few edits part have embeddings that differ in
few places, so keys of ``BITS`` sampled places of the embedding collide often. Walk
and sample are repeated with fresh randomness until windows at the largest allowed
distance collide at least once with probability ``RECALL``; how many repetitions
that takes grows steeply with the length, so items of similar length form a class,
and each class is measured on copies of its own items with as many random edits as are
allowed, followed by other words, as in a text. Embedded are the item's number of words
from a start on; what collides with an item is then compared by exact edit distance, with
the end that suits best. A class that does not reach
``RECALL`` within ``MAX_REPETITIONS`` and ``MAX_STEPS`` (long items) uses no walk: each
of its windows is compared exactly with every item whose seed it holds, which misses
nothing.

Only windows that can be near an item are embedded: an item of n words with at most
k edits keeps a run of floor((n - k) / (k + 1)) words unedited, so such a window has
a run of words in common with the item, at nearly the same place. This seed test is
exact and skips nothing; windows around one seed differ by at most k places.

Documents are read once per block of items, never shuffled. Items are taken in
blocks of at most ``BLOCK_ITEM_BYTES`` of text, and a block travels as a broadcast
of that size.

Defined cases: items without a word, or of null text, match nothing; items whose id is
null or no long take part and are reported with a null item id (once for equal texts); null and empty texts
leak nothing; repeated rows are each reported; a null id is reported as null; items
of equal text are each reported; empty tables give no rows; other columns are
ignored (``drop_leaking`` passes them on).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from launchboard.llm.words import U64, Words, blocks, mix, window_hashes

EDIT_RATE = 0.2
BITS = 3
RECALL = 0.99
MAX_REPETITIONS = 512
#: Steps of all walks of a window: beyond, comparing the seeded items is cheaper.
MAX_STEPS = 1 << 14
BLOCK_ITEM_BYTES = 4 << 20
#: Text that a task holds at a time.
BLOCK = 2 << 20
#: Windows that are embedded or compared together, and words of all of them.
BATCH = 1 << 15
BATCH_WORDS = 1 << 21
#: Longest over shortest item of a class.
CLASS_RATIO = 1.25

OUT = "item_id long, start long, n_words long, distance long"


def allowed(n: int, rate: float = EDIT_RATE) -> int:
    return int(rate * n)


def seed_length(n: int, k: int) -> int:
    return max(1, (n - k) // (k + 1))


def length_class(sizes: np.ndarray) -> np.ndarray:
    return np.floor(np.log(np.maximum(sizes, 1)) / np.log(CLASS_RATIO) + 1e-9).astype(np.int64)


def spans(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... (count[0] numbers), first[1], ..."""
    return np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())


@dataclass
class Repetition:
    """One walk and one sample: ``seed`` draws the walk's bits; ``places`` are
    positions of the embedding as fractions of the walk."""

    seed: int
    places: np.ndarray


def embed_keys(words: np.ndarray, sizes: np.ndarray, r: Repetition) -> np.ndarray:
    """Keys of the sampled places of each row's embedding. ``words`` is padded with
    zeros to the longest row; a walk of n words takes 2n steps, which the pointer,
    moving every other step, needs to see them all."""
    n_rows = len(words)
    places = np.sort((r.places[None, :] * 2 * sizes[:, None]).astype(np.int64), axis=1)
    key = mix(sizes.astype(U64) + U64(r.seed))
    if not n_rows:
        return key
    steps = int(places.max()) + 1
    # the pointer moves on once a step at most, and reads 0 behind a row's words
    width = max(steps, words.shape[1])
    padded = np.zeros((n_rows, width), dtype=U64)
    padded[:, :words.shape[1]] = words
    flat, at = padded.ravel(), np.arange(n_rows) * width
    seen = np.empty((steps, n_rows), dtype=U64)
    salts = mix(np.arange(1, steps + 1, dtype=U64) * U64(0xD6E8FEB86659FD93) + U64(r.seed))
    for step in range(steps):
        word = np.take(flat, at, out=seen[step])
        # the words are hashes: one multiplication spreads what the salt changes
        at += (((word ^ salts[step]) * U64(0x9E3779B97F4A7C15)) >> U64(63)).astype(np.int64)
    rows = np.arange(n_rows)
    for column in places.T:
        key = mix(key * U64(0x9E3779B97F4A7C15) + seen[column, rows])
    return key


def distances_within(items: np.ndarray, windows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Word edit distance of each item to the best beginning of its window, and the
    beginning's length (of equal ones the nearest to the item's); k + 1 where it exceeds k.
    Windows are padded with 0, which is no word: to use it never pays. Pairs whose rows
    exceed k go on the way."""
    (n, size), width = items.shape, windows.shape[1]
    out, length = np.full(n, k + 1, dtype=np.int64), np.zeros(n, dtype=np.int64)
    alive, j = np.arange(n), np.arange(width + 1, dtype=np.int32)
    row = np.broadcast_to(j, (n, width + 1))
    for i in range(size):
        if i % 8 == 7:
            near = row.min(axis=1) <= k
            if not near.all():
                alive, row, items, windows = alive[near], row[near], items[near], windows[near]
            if not len(alive):
                return out, length
        new = np.empty(row.shape, dtype=np.int32)
        new[:, 0] = i + 1
        new[:, 1:] = np.minimum(row[:, :-1] + (windows != items[:, i:i + 1]), row[:, 1:] + 1)
        # insertions: the least of all earlier cells plus their distance
        row = np.minimum.accumulate(new - j, axis=1) + j
    away = np.abs(j - size)
    best = (row.astype(np.int64) * (2 * width + 3) + 2 * away + (j > size)).argmin(axis=1)
    out[alive] = np.minimum(row[np.arange(len(row)), best], k + 1)
    length[alive] = best
    return out, length


def edited(words: np.ndarray, k: int, random: np.random.Generator) -> np.ndarray:
    """The first words, as many as there are, of a text that begins with ``words`` after k
    random edits."""
    out = list(words)
    for _ in range(k):
        kind, at = random.integers(3), int(random.integers(max(len(out), 1)))
        fresh = U64(random.integers(1, 1 << 62))
        if kind == 0 and out:
            out[at] = fresh
        elif kind == 1:
            out.insert(at, fresh)
        elif out:
            del out[at]
    out = (out + [U64(x) for x in random.integers(1, 1 << 62, len(words))])[:len(words)]
    return np.array(out, dtype=U64)


@dataclass
class Index:
    """A block of items in memory: seeds, and keys of every repetition of each class
    of lengths."""

    items: list[tuple[int, np.ndarray]]
    rate: float
    #: by class; None where the class is compared exactly
    repetitions: dict[int, list[Repetition] | None] = field(default_factory=dict)

    def __post_init__(self):
        self.items = [(i, w) for i, w in self.items if len(w)]
        self.sizes = np.array([len(w) for _, w in self.items], dtype=np.int64)
        self.k = np.array([allowed(n, self.rate) for n in self.sizes], dtype=np.int64)
        self.kind = length_class(self.sizes)
        # seeds by length: hash, item, place in the item
        self.seeds: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        lengths = np.array([seed_length(n, k) for n, k in zip(self.sizes, self.k)], dtype=np.int64)
        for q in sorted(set(lengths.tolist())):
            hashes, item, place = [], [], []
            for row in np.flatnonzero(lengths == q):
                h = window_hashes(self.items[row][1], q)[:self.sizes[row] - q + 1]
                hashes.append(h)
                item.append(np.full(len(h), row))
                place.append(np.arange(len(h)))
            hashes, item, place = map(np.concatenate, (hashes, item, place))
            order = np.argsort(hashes, kind="stable")
            self.seeds[q] = hashes[order], item[order], place[order]
        self.keys: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for kind in sorted(set(self.kind.tolist())):
            if kind not in self.repetitions:
                self.repetitions[kind] = self.calibrate(kind)
            rows = np.flatnonzero(self.kind == kind)
            self.keys[kind] = []
            for r in self.repetitions[kind] or []:
                key = embed_keys(self.padded(rows), self.sizes[rows], r)
                order = np.argsort(key, kind="stable")
                self.keys[kind].append((key[order], rows[order]))

    def padded(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros((len(rows), int(self.sizes[rows].max()) if len(rows) else 0), dtype=U64)
        for at, row in enumerate(rows):
            out[at, :self.sizes[row]] = self.items[row][1]
        return out

    def calibrate(self, kind: int, samples: int = 64, seed: int = 11) -> list[Repetition] | None:
        """Add repetitions until copies of the class's items with the largest number of
        edits are found with the wanted probability; None if they never are."""
        random = np.random.default_rng([seed, kind])
        rows = random.choice(np.flatnonzero(self.kind == kind), size=samples)
        words, sizes = self.padded(rows), self.sizes[rows]
        copies = np.zeros_like(words)
        for at, row in enumerate(rows):
            n = int(sizes[at])
            copies[at, :n] = edited(words[at, :n], int(self.k[row]), random)
        found: list[Repetition] = []
        rates = np.zeros(samples)
        while len(found) < min(MAX_REPETITIONS, MAX_STEPS // (2 * int(sizes.min()))):
            r = Repetition(int(random.integers(1 << 40)), random.random(BITS))
            found.append(r)
            rates += embed_keys(copies, sizes, r) == embed_keys(words, sizes, r)
            n = len(found)
            # a sample's chance of a collision in n repetitions, from its observed rate
            if n >= 16 and (1 - (1 - rates / n) ** n).mean() >= RECALL:
                return found
        return None

    def seeded(self, hashes: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, item row) of the windows around every seed; ``room``: words to the
        text's end."""
        pairs = [np.zeros((0, 2), np.int64)]
        for q, (known, item, place) in self.seeds.items():
            at = np.flatnonzero(room >= q)
            h = window_hashes(hashes, q)[at]
            lo, hi = np.searchsorted(known, h, "left"), np.searchsorted(known, h, "right")
            entry = spans(lo, hi - lo)
            row = item[entry]
            pair = np.unique(np.stack([np.repeat(at, hi - lo) - place[entry], row], 1), axis=0)
            begin, row = pair[:, 0], pair[:, 1]
            span = 2 * self.k[row] + 1
            start, row = spans(begin - self.k[row], span), np.repeat(row, span)
            good = (start >= 0) & (start < len(room))
            start, row = start[good], row[good]
            # a window lies inside one text, and has no more than k words too few
            good = room[start] >= np.maximum(self.sizes[row] - self.k[row], 1)
            pairs.append(np.unique(np.stack([start[good], row[good]], 1), axis=0))
        found = np.concatenate(pairs)
        return found[:, 0], found[:, 1]

    def starts(self, hashes: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, words) of the windows around every seed."""
        start, row = self.seeded(hashes, room)
        found = np.unique(np.stack([start, self.sizes[row]], 1), axis=0)
        return found[:, 0], found[:, 1]

    def leaks(self, hashes: np.ndarray, room: np.ndarray) -> np.ndarray:
        """Rows start, item row, distance, words of all leaks."""
        start, row = self.seeded(hashes, room)
        exact = np.isin(self.kind[row], [c for c, r in self.repetitions.items() if r is None])
        out = [self.compare(hashes, room, start[exact], row[exact])]
        size = self.sizes[row[~exact]]
        window = np.unique(np.stack([start[~exact], size], 1), axis=0)
        number, *rest = self.match(hashes, room, window[:, 0], window[:, 1])
        out.append(np.stack([window[number, 0], *rest]))
        return np.concatenate(out, axis=1)

    def windows(self, hashes: np.ndarray, room: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Words from each start on, as many as a leak of an item of ``size`` words can have,
        padded with 0 from the text's end on."""
        most = np.minimum(size + (self.rate * size).astype(np.int64), room[start])
        place = np.arange(int(most.max()) if len(most) else 0)
        words = hashes[np.minimum(start[:, None] + place, len(hashes) - 1)]
        return np.where(place < most[:, None], words, U64(0))

    def compare(self, hashes: np.ndarray, room: np.ndarray, start: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Rows start, item row, distance, words of the pairs that are leaks, each compared."""
        out = [np.zeros((4, 0), np.int64)]
        for n in np.unique(self.sizes[row]).tolist():
            of = np.flatnonzero(self.sizes[row] == n)
            k = allowed(n, self.rate)
            # equal windows are compared with an item once
            window = window_hashes(hashes, n + k)[start[of]] ^ mix(np.minimum(room[start[of]], n + k).astype(U64))
            _, first, number = np.unique(mix(window + mix(row[of].astype(U64))),
                                         return_index=True, return_inverse=True)
            found = np.empty((2, len(first)), dtype=np.int64)
            step = max(1, min(BATCH, BATCH_WORDS // n))
            for lo in range(0, len(first), step):
                part = of[first[lo:lo + step]]
                found[:, lo:lo + step] = distances_within(self.padded(row[part]), self.windows(
                    hashes, room, start[part], np.full(len(part), n)), k)
            distance, length = found[:, number.ravel()]
            good = distance <= k
            out.append(np.stack([start[of][good], row[of][good], distance[good], length[good]]))
        return np.concatenate(out, axis=1)

    def match(self, hashes: np.ndarray, room: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Rows window number, item row, distance, words of all leaks."""
        out = [np.zeros((4, 0), np.int64)]
        kinds = length_class(size)
        for kind, repetitions in self.repetitions.items():
            of = np.flatnonzero(kinds == kind)
            width = int(size[of].max()) if len(of) else 1
            step = max(1, min(BATCH, BATCH_WORDS // width))
            for lo in range(0, len(of), step):
                part = of[lo:lo + step]
                found = self.match_class(hashes, room, start[part], size[part], kind, repetitions)
                found[0] = part[found[0]]
                out.append(found)
        return np.concatenate(out, axis=1)

    def match_class(self, hashes: np.ndarray, room: np.ndarray, s: np.ndarray, n: np.ndarray, kind: int,
                    repetitions: list[Repetition] | None) -> np.ndarray:
        # equal windows of items of one size are compared once
        both = np.concatenate([n[:, None].astype(U64), self.windows(hashes, room, s, n)], axis=1)
        both, number = np.unique(both, axis=0, return_inverse=True)
        number, sizes, words = number.ravel(), both[:, 0].astype(np.int64), both[:, 1:]
        # embedded are as many words as the item has
        head = np.zeros((len(words), max(int(n.max()), words.shape[1])), dtype=U64)
        head[:, :words.shape[1]] = words
        head = np.where(np.arange(head.shape[1]) < sizes[:, None], head, U64(0))
        if repetitions is None:  # no seed is known here: all items of the class
            rows = np.flatnonzero(self.kind == kind)
            pair = (np.arange(len(words))[:, None] * len(self.items) + rows).ravel()
        else:
            candidates = []
            for r, (known, row) in zip(repetitions, self.keys[kind]):
                key = embed_keys(head, sizes, r)
                a, b = np.searchsorted(known, key, "left"), np.searchsorted(known, key, "right")
                candidates.append(np.repeat(np.arange(len(words)), b - a) * len(self.items) + row[spans(a, b - a)])
            pair = np.unique(np.concatenate(candidates))
        window, item = pair // len(self.items), pair % len(self.items)
        good = sizes[window] == self.sizes[item]
        window, item = window[good], item[good]
        distance, length = np.zeros((2, len(window)), dtype=np.int64)
        for m in np.unique(self.sizes[item]):
            rows, k = np.flatnonzero(self.sizes[item] == m), allowed(int(m), self.rate)
            distance[rows], length[rows] = distances_within(
                self.padded(item[rows]), words[window[rows], :m + k], k)
        good = distance <= self.k[item]
        window, item, distance, length = window[good], item[good], distance[good], length[good]
        # back to all windows with these words
        by = np.argsort(number, kind="stable")
        first = np.searchsorted(number[by], np.arange(len(words) + 1))
        c = np.diff(first)[window]
        return np.stack([by[spans(first[window], c)], *(np.repeat(x, c) for x in (item, distance, length))])


def leaks_of(texts: pa.Array, index: Index) -> list[tuple[int, int, int, int, int]]:
    """(text, item id, first word, words, distance): the best window of each item in
    each text, the earliest of equal ones."""
    w = Words(pc.utf8_lower(texts))
    if not len(w) or not index.items:
        return []
    hashes, text = w.hashes(), w.text_of_word()
    best: dict = {}
    for at, i, d, n in index.leaks(hashes, w.room()).T.tolist():
        key, found = (int(text[at]), i), (d, at, n)
        if key not in best or found < best[key]:
            best[key] = found
    return [(t, index.items[i][0], at - int(w.first[t]), n, d)
            for (t, i), (d, at, n) in sorted(best.items())]


def item_blocks(items: DataFrame, rate: float = EDIT_RATE) -> Iterator[Index]:
    """Items in blocks of bounded size: the block of an item follows from its id."""
    rows = items.select(F.col("item_id").try_cast("long").alias("item_id"), "text").where("length(text) > 0")
    size = rows.agg(F.sum(F.octet_length("text").cast("long") + 64)).first()[0] or 0
    n = -(-2 * size // BLOCK_ITEM_BYTES)
    for k in range(n):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) if n > 1 else rows
        found = sorted(part.distinct().collect(), key=lambda r: (r["item_id"] is None, r["item_id"] or 0, r["text"]))
        w = Words(pc.utf8_lower(pa.array([r["text"] for r in found], pa.string())))
        hashes = w.hashes()
        yield Index([(r["item_id"], hashes[a:b]) for r, a, b in zip(found, w.first, w.first[1:])], rate)


def find_leaks(docs: DataFrame, items: DataFrame, rate: float = EDIT_RATE) -> DataFrame:
    """(doc_id, item_id, start, n_words, distance) per document row and leaked item."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text")
    out = None
    for index in item_blocks(items, rate):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for block in blocks(batches, "text", BLOCK):
                found = leaks_of(block.column(1), shared.value)
                if found:
                    text, *rest = zip(*found)
                    yield pa.RecordBatch.from_arrays(
                        [block.column(0).take(pa.array(text)), *(pa.array(c, pa.int64()) for c in rest)],
                        ["doc_id", "item_id", "start", "n_words", "distance"])
        part = rows.mapInArrow(run, f"doc_id {kind}, {OUT}")
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], f"doc_id {kind}, {OUT}")


def drop_leaking(docs: DataFrame, items: DataFrame, rate: float = EDIT_RATE) -> DataFrame:
    """The rows of ``docs`` without a leak, all columns unchanged."""
    spark = docs.sparkSession
    for index in item_blocks(items, rate):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for block in blocks(batches, "text", BLOCK):
                text = block.column(block.schema.get_field_index("text"))
                keep = np.ones(block.num_rows, dtype=bool)
                keep[[t for t, *_ in leaks_of(text, shared.value)]] = False
                yield block.filter(pa.array(keep))
        docs = docs.mapInArrow(run, docs.schema)
    return docs
