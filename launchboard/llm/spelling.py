"""Spelling variants: vocabulary words within one edit of each other, by finite-state
composition.

The vocabulary acceptor A is minimised; composing A, a transducer that makes exactly
one edit, and A again accepts the pairs of words one inserted, deleted or replaced
code point apart. The composed machine is never written out: its states are (p) before
the edit, where both tapes have read the same and a deterministic acceptor is in one
state, and (p, q) after it. Accepted pairs are enumerated breadth-first, all states of
a depth at once. A path carries the rank of its word on either tape (the number of
words that sort before it, summed from the arcs), so that no strings are built. An edit
is placed where the two words part, so each pair has one path.

Partitions are initial states: the words that share their first ``PREFIX`` code points,
which both tapes read before any edit. A pair that parts earlier shares its last code
points, as words have at least ``MIN_LENGTH``, and is found by the same machine over
reversed words. An initial state that more than ``STATE_WORDS`` words share is split by
length class and by a prefix of half the class's length: class c holds words of c and
c + 1 code points, and answers for pairs whose shorter word has c. Two words of at
least c code points and one edit share half of c at one end, so no pair is lost.
Initial states are dealt to groups of about ``STATE_WORDS`` words.

States are merged by 64-bit signatures of their right languages.

Defined cases: null and empty texts have no words; a row of null id counts its words
as they are; rows that repeat count again; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from launchboard.llm.store import Scratch
from launchboard.llm.words import U64, Words, blocks, mix

MIN_LENGTH = 7
MIN_COUNT = 2
#: A variant's form is at least so many times as frequent.
DOMINANCE = 10
#: One (document, run) in so many loses a code point.
TYPO_EVERY = 31
PREFIX = 3
STATE_WORDS = 20_000

_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LATIN_LEAD = 0xC3  # U+00C0 to U+00FF are this byte and a continuation byte


class Runs(Words):
    """Maximal runs of letters A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased; only
    those of ``at_least`` code points stay."""

    def __init__(self, column: pa.Array, at_least: int = MIN_LENGTH):
        super().__init__(column, lower=True)
        whole = np.cumsum(np.r_[0, (self.data & 0xC0) != 0x80])
        length = whole[self.ends] - whole[self.starts]
        good = length >= at_least
        self.space[~self.space] = np.repeat(~good, self.ends - self.starts)
        text = self.text_of_word()[good]
        self.starts, self.ends, self.length = self.starts[good], self.ends[good], length[good]
        self.counts = np.bincount(text, minlength=len(self.counts))
        self.first = np.r_[0, np.cumsum(self.counts)]

    @staticmethod
    def separators(data: np.ndarray) -> np.ndarray:
        lead = data == _LATIN_LEAD
        letter = _LETTER[data] | lead
        letter[1:] |= lead[:-1]
        return ~letter

    def strings(self) -> pa.Array:
        offsets = np.r_[0, np.cumsum(self.ends - self.starts)].astype(np.int64)
        return pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(self), [None, pa.py_buffer(offsets), pa.py_buffer(self.data[~self.space])])


def _crc_shifts() -> list[np.ndarray]:
    """Tables that carry a CRC-32 over 1, 2, 4, ... zero bytes, a byte lane each: the
    polynomial's remainder is linear in the register's bits."""
    byte = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        byte = np.where(byte & 1, (byte >> 1) ^ np.uint32(0xEDB88320), byte >> 1)
    bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
    images = byte[bits & 255] ^ (bits >> np.uint32(8))
    tables = []
    for _ in range(31):
        lanes = np.zeros((4, 256), dtype=np.uint32)
        for b in range(8):
            has = (np.arange(256) >> b & 1).astype(bool)
            lanes[:, has] ^= images[b::8][:, None]
        tables.append(lanes)
        images = _carry(lanes, images)
    return tables


def _carry(lanes: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return (lanes[0][crc & 255] ^ lanes[1][crc >> 8 & 255] ^ lanes[2][crc >> 16 & 255] ^ lanes[3][crc >> 24])


_SHIFTS = _crc_shifts()


def crc_joined(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of concatenations from those of the parts; ``length`` of the second."""
    out = first.astype(np.uint32)
    for k, lanes in enumerate(_SHIFTS[:int(length.max(initial=0)).bit_length()]):
        on = np.flatnonzero(length >> k & 1)
        out[on] = _carry(lanes, out[on])
    return out ^ second


def word_counts(docs: DataFrame, typo_every: int = TYPO_EVERY, at_least: int = MIN_LENGTH) -> DataFrame:
    """(word, n) of one row per block and word; a run of a document whose CRC-32 with
    the document's id ``typo_every`` divides loses one code point (0: none does)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            runs = Runs(block.column(1), at_least)
            if not len(runs):
                continue
            coded = runs.strings().dictionary_encode()
            words, number = coded.dictionary.to_pylist(), np.asarray(coded.indices).astype(np.int64)
            pairs, at, count = np.unique(runs.text_of_word() * len(words) + number,
                                         return_index=True, return_counts=True)
            doc, number, length = pairs // len(words), pairs % len(words), runs.length[at]
            found: dict[bytes, int] = {}
            if typo_every:
                ids = block.column(0).to_pylist()
                of_doc = np.array([zlib.crc32(f"{i}:".encode()) for i in ids], dtype=np.uint32)
                of_word = np.array([zlib.crc32(w) for w in words], dtype=np.uint32)
                size = np.array([len(w) for w in words])
                crc = crc_joined(of_doc[doc], of_word[number], size[number])
                typo = (crc % typo_every == 0) & np.array([i is not None for i in ids])[doc]
                for i in np.flatnonzero(typo & (length > at_least)).tolist():
                    text, place = words[number[i]].decode(), int(crc[i]) % int(length[i])
                    short = (text[:place] + text[place + 1:]).encode()
                    found[short] = found.get(short, 0) + int(count[i])
                number, count = number[~typo], count[~typo]
            left = np.bincount(number, count, len(words)).astype(np.int64)
            kept = np.flatnonzero(left)
            yield pa.RecordBatch.from_arrays([
                pa.array([words[k] for k in kept.tolist()] + list(found), pa.binary()).cast(pa.string()),
                pa.array(left[kept].tolist() + list(found.values()), pa.int64())], ["word", "n"])
    return docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInArrow(
        run, "word string, n long")


def vocabulary(docs: DataFrame, at_least: int = MIN_LENGTH, min_count: int = MIN_COUNT,
               typo_every: int = TYPO_EVERY) -> DataFrame:
    """(word, n): words of ``at_least`` code points that occur ``min_count`` times."""
    return word_counts(docs, typo_every, at_least).groupBy("word").agg(F.sum("n").alias("n")).where(
        F.col("n") >= min_count)


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... for each range in turn."""
    return np.arange(size.sum()) + np.repeat(first - (np.cumsum(size) - size), size)


class Acceptor:
    """The minimal acceptor of words of several initial states, and the rank of each word.

    ``unit``: initial state of each word (0, 1, ...); ``symbols``: the words' code points
    one after the other; ``length``: of each word. Words are sorted by unit and code
    points and are distinct. ``start[u]`` is the state of unit u."""

    def __init__(self, unit: np.ndarray, symbols: np.ndarray, length: np.ndarray):
        first = np.cumsum(length) - length
        node, units = unit.astype(np.int64), int(unit[-1]) + 1
        final, levels, n = [np.zeros(units, bool)], [], units
        np.logical_or.at(final[0], node[length == 0], True)
        active, depth = np.flatnonzero(length > 0), 0
        while len(active):
            parent, symbol = node[active], symbols[first[active] + depth]
            new = np.r_[True, (parent[1:] != parent[:-1]) | (symbol[1:] != symbol[:-1])]
            node[active] = n + np.cumsum(new) - 1
            levels.append((parent[new], symbol[new], n))
            depth += 1
            ends = np.zeros(int(new.sum()), bool)
            ends[node[active][length[active] == depth] - n] = True
            final.append(ends)
            n += len(ends)
            active = active[length[active] > depth]
        # signatures and numbers of accepted words, from the longest paths up
        ends = np.concatenate(final)
        signature, words = mix(ends.astype(U64) + U64(1)), ends.astype(np.int64)
        for parent, symbol, at in reversed(levels):
            child = slice(at, at + len(parent))
            one = mix(signature[child] ^ mix(symbol.astype(U64) + U64(7)))
            cut = np.flatnonzero(np.r_[True, parent[1:] != parent[:-1]])
            signature[parent[cut]] = mix(signature[parent[cut]] + np.add.reduceat(one, cut))
            words[parent[cut]] += np.add.reduceat(words[child], cut)
        _, shown, state = np.unique(signature, return_index=True, return_inverse=True)
        self.final, count = ends[shown], words[shown]
        # the arcs of a state are those of the first node that it stands for
        parents = np.concatenate([p for p, _, _ in levels]) if levels else np.zeros(0, np.int64)
        labels = np.concatenate([s for _, s, _ in levels]) if levels else np.zeros(0, np.uint32)
        mine = np.flatnonzero(shown[state[parents]] == parents)
        source = state[parents[mine]]
        order = mine[np.lexsort((labels[mine], source))]
        self.source, self.label = state[parents[order]], labels[order].astype(np.int64)
        self.target = state[units + order]
        self.first = np.searchsorted(self.source, np.arange(len(shown) + 1))
        # words before an arc: those that end in its state and those of earlier arcs
        inside = np.r_[0, np.cumsum(count[self.target])]
        self.before = self.final[self.source].astype(np.int64) + inside[:-1] - inside[self.first[self.source]]
        self.key = self.source << 21 | self.label
        self.start, self.rank = state[:units], np.searchsorted(unit, np.arange(units))

    def arcs(self, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All arcs of the states: (position of its state, arc)."""
        size = self.first[state + 1] - self.first[state]
        return np.repeat(np.arange(len(state)), size), _ranges(self.first[state], size)

    def one_edit(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ranks of the accepted pairs, each once, in either order."""
        state, rank = self.start, self.rank
        edited = tuple(np.zeros(0, np.int64) for _ in range(5))  # p, q, rank, rank, symbol not to read next
        while len(state) or len(edited[0]):
            row, arc = self.arcs(state)
            to, at = self.target[arc], rank[row] + self.before[arc]
            # replaced: two arcs of a state, each with those after it
            last = self.first[state[row] + 1]
            later = last - arc - 1
            one = np.repeat(np.arange(len(arc)), later)
            other = _ranges(arc + 1, later)
            free = np.full(len(one), -1)
            # inserted: one tape reads an arc, the other nothing, and reads another symbol next
            parts = [(to[one], self.target[other], at[one], rank[row[one]] + self.before[other], free),
                     (to, state[row], at, rank[row], self.label[arc])]
            # read on where both tapes have the same symbol
            p, q, x, y, ban = edited
            row, arc = self.arcs(p)
            key = q[row] << 21 | self.label[arc]
            match = np.searchsorted(self.key, key)
            match[match == len(self.key)] = 0
            same = (self.key[match] == key) & (self.label[arc] != ban[row]) if len(self.key) else np.zeros(0, bool)
            row, arc, match = row[same], arc[same], match[same]
            parts.append((self.target[arc], self.target[match], x[row] + self.before[arc],
                          y[row] + self.before[match], np.full(len(row), -1)))
            edited = tuple(map(np.concatenate, zip(*parts)))
            done = self.final[edited[0]] & self.final[edited[1]]
            if done.any():
                yield edited[2][done], edited[3][done]
            state, rank = to, at


def _pairs_of_group(rows: pa.Table) -> pa.Table:
    """Near pairs (a, b) with their numbers n of all initial states in the group."""
    units = rows["unit"].to_pylist()
    rest = rows["rest"].to_pylist()
    order = sorted(range(len(rest)), key=lambda i: (units[i], rest[i]))
    unit = np.cumsum([0] + [units[a] != units[b] for a, b in zip(order, order[1:])])
    ordered = [rest[i] for i in order]
    symbols = np.frombuffer("".join(ordered).encode("utf-32-le"), dtype=np.uint32)
    machine = Acceptor(unit, symbols, np.array([len(x) for x in ordered], dtype=np.int64))
    found = list(machine.one_edit())
    a, b = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in (0, 1))
    order = np.array(order)
    columns = {}
    for name, at in (("a", order[a]), ("b", order[b])):
        columns[name] = rows["word"].take(pa.array(at))
        columns[f"n_{name}"] = rows["n"].take(pa.array(at))
    at = pa.array(order[a])
    return pa.table(columns | {c: rows[c].take(at) for c in ("side", "class", "hot_front")})


def _front(word: str | Column, size: Column | int) -> Column:
    return F.substring(word, F.lit(1), F.lit(size) if isinstance(size, int) else size)


def initial_states(words: DataFrame) -> DataFrame:
    """One row per word and initial state it has a path from: (word, n, side, class, unit,
    rest, hot_front). Side 0 reads forward, 1 backward; class is null unless the state
    of ``PREFIX`` code points was split; ``rest`` is what the machine reads."""
    paths = words.select("word", "n", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("word").alias("path")),
        F.struct(F.lit(1).alias("side"), F.reverse("word").alias("path")))).alias("p")).select("word", "n", "p.*")
    paths = paths.withColumn("front", _front("path", PREFIX))
    # at most one front in STATE_WORDS words can be hot
    hot = paths.groupBy("side", "front").agg(F.count(F.lit(1)).alias("c")).where(
        F.col("c") > STATE_WORDS).select("side", "front", F.lit(True).alias("hot"))
    front = hot.where("side = 0").select(F.col("front").alias("word_front"), F.col("hot").alias("hot_front"))
    paths = (paths.join(hot, ["side", "front"], "left")
             .withColumn("word_front", _front("word", PREFIX)).join(front, "word_front", "left"))
    long = F.length("path")
    split = F.when(F.col("hot"), F.filter(F.array(long - 1, long), lambda c: c >= MIN_LENGTH))
    rows = paths.withColumn("class", F.explode(F.coalesce(split, F.array(F.lit(None).cast("int")))))
    read = F.when(F.col("class").isNull(), F.lit(PREFIX)).otherwise(F.floor(F.col("class") / 2).cast("int"))
    return rows.select(
        "word", "n", "side", "class", F.coalesce("hot_front", F.lit(False)).alias("hot_front"),
        F.concat_ws("|", "side", F.coalesce(F.col("class").cast("string"), F.lit("")), _front("path", read)).alias("unit"),
        F.substring(F.col("path"), read + 1, long).alias("rest"))


def near_pairs(words: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b, n_a, n_b): each unordered pair of ``words`` (word, n; distinct, each of at
    least ``MIN_LENGTH`` code points) that exactly one edit parts, once."""
    groups = max(1, -(-words.count() // STATE_WORDS))
    rows = initial_states(words).withColumn("group", F.pmod(F.xxhash64("unit"), F.lit(2 * groups)))
    found = rows.groupBy("group").applyInArrow(
        _pairs_of_group, "a string, n_a long, b string, n_b long, side int, class int, hot_front boolean")
    shorter = F.least(F.length("a"), F.length("b"))
    half = F.floor(shorter / 2).cast("int")
    # what the forward machine finds as well: words alike in all that it reads before the edit
    forward = (_front("a", PREFIX) == _front("b", PREFIX)) & (
        ~F.col("hot_front") | (_front("a", half) == _front("b", half)))
    return scratch.keep(found.where(F.col("class").isNull() | (F.col("class") == shorter))
                        .where((F.col("side") == 0) | ~forward).select("a", "b", "n_a", "n_b"), "pairs")


def follow(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, root) for (word, form) without cycles: the last word that forms lead to.
    Each round doubles the steps taken, so chains of k forms take log k rounds."""
    roots, step = forms.select("word", F.col("form").alias("root")), 0
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = roots.join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        moved = scratch.keep(moved, f"roots-{step}")
        roots, step = moved.select("word", "root"), step + 1
        if moved.where("moved").isEmpty():
            return roots


def variants(words: DataFrame, scratch: Scratch, dominance: int = DOMINANCE) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each word of a written vocabulary."""
    pairs = near_pairs(words, scratch)
    both = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("n_a").alias("n"), F.col("b").alias("near"), F.col("n_b").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("n_b").alias("n"), F.col("a").alias("near"), F.col("n_a").alias("near_n")),
    )).alias("p")).select("p.*")
    near = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"))
    # the most frequent near word is the form if it dominates; so only those that do are compared
    best = (both.where(F.col("near_n") >= dominance * F.col("n")).groupBy("word")
            .agg(F.min(F.struct((-F.col("near_n")).alias("order"), "near")).alias("best"))
            .select("word", F.col("best.near").alias("form"), (-F.col("best.order")).alias("form_n")))
    forms = scratch.keep(best, "forms")
    roots = follow(forms, scratch)
    return (words.join(near, "word", "left").join(forms, "word", "left").join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                    F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"))


def spelling_variants(docs: DataFrame) -> DataFrame:
    """Words of ``docs`` (doc_id, text) with their spelling forms; see ``variants``."""
    scratch = Scratch(docs.sparkSession, "spelling")
    return variants(scratch.keep(vocabulary(docs), "words"), scratch)
