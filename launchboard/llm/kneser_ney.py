"""Interpolated modified Kneser-Ney bigram model: counted in Spark, kept as sorted
hash arrays, memory-mapped by the workers that score.

Counting. Each block of training texts sends its distinct bigrams with their counts
to shards of the bigrams' hash space, so a frequent bigram is one entry a block; the
hash space is worked in ``PASSES`` passes, which bounds the shuffle on disk. A shard
adds up, stores sorted hashes and counts as two plain files, and passes on what words
need: occurrences, continuations (distinct words before), and per context the total
and how many followers were seen once, twice and more. Word shards add these up the
same way. Only a handful of sums reach the driver.

Scoring. A worker maps the files and looks up a block's distinct bigrams and words
by binary search; pages are read as needed and shared, memory stays bounded by a
block. With ``D(c)`` the discounts of the counts of counts,

    p(b|a) = max(c(ab) - D(c(ab)), 0) / c(a.) + gamma(a) p(b)
    p(b)   = max(c(.b) - D'(c(.b)), 0) / c(..) + gamma' / (V + 1)

where the last term also is the whole probability of an unknown word; unseen
contexts use p(b). All tokens and the unknown word have a total probability of 1.

Files live in the shared scratch folder. Where that is no mounted path, a worker
copies a file to its temporary folder before mapping it.

Defined cases: null and empty texts hold the end token alone; rows of null id are
scored but never train; repeated rows count each; without training tokens every
known probability is uniform over the unknown word (score 0, base as the formula
says); other columns are ignored.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from launchboard.llm.slices import SHARD_BYTES, by_shard
from launchboard.llm.store import Scratch
from launchboard.llm.words import U64, Words, blocks, mix, unpack

#: Hashes of the marks before and after a text.
START, END = U64(0x5BD1E9955BD1E995), U64(0x27D4EB2F165667C5)
#: Columns of a word's statistics.
COUNT, CONT, TOTAL, ONCE, TWICE, MORE = range(6)
HOLD_OUT = 10
BASE_ADD = 0.1
#: Passes over the texts, each counting its share of the hash space: a pass's
#: shuffle is gone before the next one begins.
PASSES = 4


def pair_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * U64(0x9E3779B97F4A7C15) + mix(b))


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(previous, token, first): first[i]:first[i + 1] are the tokens of text i."""
    w = Words(texts, lower=True)
    n = len(w.counts)
    token = np.empty(len(w) + n, dtype=U64)
    first = w.first + np.arange(n + 1)
    token[first[1:] - 1] = END
    token[np.arange(len(w)) + w.text_of_word()] = w.hashes()
    previous = np.empty_like(token)
    previous[1:] = token[:-1]
    previous[first[:-1]] = START
    return previous, token, first


# files -------------------------------------------------------------------------

def _mounted(uri: str) -> str | None:
    parts = urlparse(uri)
    return parts.path if parts.scheme in ("", "file") else None


def write_array(uri: str, values: np.ndarray) -> None:
    """Whole files only: a task that runs again replaces its own file."""
    path = _mounted(uri)
    if path:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        handle, temporary = tempfile.mkstemp(dir=os.path.dirname(path))
        with os.fdopen(handle, "wb") as f:
            f.write(np.ascontiguousarray(values).data)
        os.replace(temporary, path)
    else:
        from pyarrow import fs
        store, name = fs.FileSystem.from_uri(uri)
        store.create_dir(os.path.dirname(name), recursive=True)
        with store.open_output_stream(name) as f:
            f.write(np.ascontiguousarray(values).data)


def map_array(uri: str, dtype, width: tuple[int, ...] = ()) -> np.ndarray:
    """The file's values; a file that is not there holds none (an empty shard)."""
    path, local = _mounted(uri), None
    if not path:
        from pyarrow import fs
        store, name = fs.FileSystem.from_uri(uri)
        if store.get_file_info(name).type != fs.FileType.File:
            return np.zeros((0, *width), dtype)
        local = tempfile.NamedTemporaryFile()  # noqa: SIM115  the mapping outlives the name
        with store.open_input_stream(name) as f:
            while chunk := f.read(1 << 22):
                local.write(chunk)
        local.flush()
        path = local.name
    if not os.path.exists(path) or not os.path.getsize(path):
        return np.zeros((0, *width), dtype)
    return np.memmap(path, dtype=dtype, mode="r").reshape(-1, *width)


# counting ----------------------------------------------------------------------

def _count_block(shards: int, turn: int, passes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            a, b, _ = tokens(block.column(0))
            key, at, count = np.unique(pair_key(a, b), return_index=True, return_counts=True)
            a, b, count = a[at], b[at], count.astype(np.uint32)
            out = []
            for shard, where in by_shard(key, shards):
                if shard % passes != turn:
                    continue
                # equal contexts side by side compress well on the way
                where = where[np.argsort(a[where], kind="stable")]
                out.append((shard, a[where].tobytes(), b[where].tobytes(), count[where].tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), k) for c, k in zip(zip(*out), (pa.int32(), *[pa.binary()] * 3))],
                    ["shard", "a", "b", "count"])
    return run


def _sums(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sums of their rows."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(values[order], first, axis=0)


def pack_counts(stats: np.ndarray) -> bytes:
    """Six columns, most of them small numbers and zeros."""
    raw = np.ascontiguousarray(stats.T).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack_counts(value: bytes) -> np.ndarray:
    size = int.from_bytes(value[:8], "little")
    return unpack(pa.decompress(value[8:], size, codec="zstd", asbytes=True), np.int64).reshape(6, -1).T


PAIR_OUT = "shard int, counts array<long>, word_shard int, words binary, stats binary"


def _store_pairs(path: str, word_shards: int):
    def run(table: pa.Table) -> pa.Table:
        a, b = (np.concatenate([unpack(x, np.uint64) for x in table[c].to_pylist()]) for c in ("a", "b"))
        count = np.concatenate([unpack(x, np.uint32) for x in table["count"].to_pylist()]).astype(np.int64)
        shard, key = table["shard"][0].as_py(), pair_key(a, b)
        order = np.argsort(key, kind="stable")
        key, a, b, count = key[order], a[order], b[order], count[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        key, a, b, count = key[first], a[first], b[first], np.add.reduceat(count, first)
        write_array(f"{path}/pair-keys-{shard}", key)
        write_array(f"{path}/pair-counts-{shard}", np.minimum(count, 0xFFFFFFFF).astype(np.uint32))
        words, number = np.unique(np.concatenate([b, a]), return_inverse=True)
        after, before = number[:len(key)], number[len(key):]
        add = lambda at, x=None: np.bincount(at, x, len(words)).astype(np.int64)
        stats = np.stack([add(after, count), add(after), add(before, count), add(before, count == 1),
                          add(before, count == 2), add(before, count > 2)], axis=1)
        out = [(shard, [int((count == k).sum()) for k in (1, 2, 3, 4)], None, None, None)]
        for part, where in by_shard(words, word_shards):
            out.append((shard, None, part, words[where].tobytes(),
                        pack_counts(stats[where])))
        kinds = (pa.int32(), pa.list_(pa.int64()), pa.int32(), pa.binary(), pa.binary())
        return pa.table([pa.array(list(c), k) for c, k in zip(zip(*out), kinds)],
                        names=["shard", "counts", "word_shard", "words", "stats"])
    return run


WORD_OUT = "word_shard int, sums array<long>"


def _store_words(path: str):
    def run(table: pa.Table) -> pa.Table:
        words = np.concatenate([unpack(x, np.uint64) for x in table["words"].to_pylist()])
        stats = np.concatenate([unpack_counts(x) for x in table["stats"].to_pylist()])
        words, stats = _sums(words, stats)
        shard = table["word_shard"][0].as_py()
        write_array(f"{path}/word-keys-{shard}", words)
        write_array(f"{path}/word-stats-{shard}", stats)
        cont = stats[:, CONT]
        sums = [int(stats[:, COUNT].sum()), int((stats[:, COUNT] > 0).sum()), int(cont.sum()),
                *(int((cont == k).sum()) for k in (1, 2, 3, 4))]
        return pa.table([pa.array([shard], pa.int32()), pa.array([sums], pa.list_(pa.int64()))],
                        names=["word_shard", "sums"])
    return run


def discounts(counts: list[int]) -> np.ndarray:
    """D(0) to D(3 and more) from how many n-grams occur once to four times; where
    too few occur for the estimates, half a count less than each count."""
    n1, n2, n3, n4 = counts
    plain = np.array([0, 0.5, 1.0, 1.5])
    if not n1 or not n2 or not n3:
        return plain
    y = n1 / (n1 + 2 * n2)
    d = np.array([0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3])
    return np.where((d >= 0) & (d <= np.arange(4)), d, plain)


@dataclass
class Model:
    """What a scoring task needs to open the files, and the model's sums."""

    path: str
    pair_shards: int
    word_shards: int
    n_tokens: int
    n_types: int
    n_pairs: int
    pair_discounts: np.ndarray
    cont_discounts: np.ndarray
    cont_gamma: float


def fit(texts: DataFrame, scratch: Scratch | None = None) -> Model:
    """Count the bigrams of column ``text`` and store the model."""
    scratch = scratch or Scratch(texts.sparkSession, "kneser-ney")
    texts = texts.select("text")
    size = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    pair_shards = max(1, -(-size // SHARD_BYTES))
    word_shards = max(1, -(-size // (4 * SHARD_BYTES)))
    path = f"{scratch.path}/model"
    pairs = None
    for turn in range(PASSES):
        part = scratch.keep(
            texts.mapInArrow(_count_block(pair_shards, turn, PASSES), "shard int, a binary, b binary, count binary")
            .groupBy("shard").applyInArrow(_store_pairs(path, word_shards), PAIR_OUT), f"pairs-{turn}")
        scratch.release()
        pairs = part if pairs is None else pairs.unionByName(part)
    words = scratch.keep(
        pairs.where("word_shard is not null").select("word_shard", "words", "stats")
        .groupBy("word_shard").applyInArrow(_store_words(path), WORD_OUT), "words")
    sums = lambda column, n: [F.sum(F.col(column)[k]).alias(f"s{k}") for k in range(n)]
    counts = [x or 0 for x in pairs.agg(*sums("counts", 4)).first()]
    n_tokens, n_types, n_pairs, *conts = [x or 0 for x in words.agg(*sums("sums", 7)).first()]
    for turn in range(PASSES):
        scratch.drop(f"pairs-{turn}")
    scratch.release()
    cont_d = discounts(conts)
    seen = np.array([conts[0], conts[1], n_types - conts[0] - conts[1]])
    return Model(path, pair_shards, word_shards,
                 n_tokens, n_types, n_pairs, discounts(counts), cont_d,
                 float((cont_d[1:] * seen).sum() / n_pairs) if n_pairs else 1.0)


# scoring -----------------------------------------------------------------------

class Mapped:
    """A model's files, mapped in a worker as they are asked for."""

    _open: dict = {}

    def __init__(self, model: Model):
        self.model, self.files = model, {}

    @classmethod
    def of(cls, model: Model) -> Mapped:
        if model.path not in cls._open:
            cls._open.clear()  # a worker serves one model at a time
            cls._open[model.path] = cls(model)
        return cls._open[model.path]

    def _arrays(self, kind: str, shard: int):
        if (kind, shard) not in self.files:
            path = self.model.path
            dtype, width, name = (np.uint32, (), "counts") if kind == "pair" else (np.int64, (6,), "stats")
            self.files[kind, shard] = (map_array(f"{path}/{kind}-keys-{shard}", np.uint64),
                                       map_array(f"{path}/{kind}-{name}-{shard}", dtype, width))
        return self.files[kind, shard]

    def look_up(self, kind: str, keys: np.ndarray) -> np.ndarray:
        """Values of sorted distinct keys; zeros for unknown ones."""
        shards, width = (self.model.pair_shards, ()) if kind == "pair" else (self.model.word_shards, (6,))
        out = np.zeros((len(keys), *width), dtype=np.int64)
        for shard, where in by_shard(keys, shards):
            stored, values = self._arrays(kind, shard)
            if len(stored):
                at = np.minimum(np.searchsorted(stored, keys[where]), len(stored) - 1)
                known = stored[at] == keys[where]
                out[where[known]] = values[at[known]]
        return out

    def log_probabilities(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(log10 p(b|a), count of b) per token."""
        m = self.model
        words, number = np.unique(np.concatenate([a, b]), return_inverse=True)
        stats = self.look_up("word", words)
        cont = stats[:, CONT]
        uniform = m.cont_gamma / (m.n_types + 1)
        p_one = np.maximum(cont - m.cont_discounts[np.minimum(cont, 3)], 0) / max(m.n_pairs, 1) + uniform
        spared = (m.pair_discounts[1] * stats[:, ONCE] + m.pair_discounts[2] * stats[:, TWICE]
                  + m.pair_discounts[3] * stats[:, MORE])
        total = stats[:, TOTAL]
        gamma = np.where(total > 0, spared / np.maximum(total, 1), 1.0)
        keys, at, pair = np.unique(pair_key(a, b), return_index=True, return_inverse=True)
        count = self.look_up("pair", keys)
        context, word = number[:len(a)][at], number[len(a):][at]
        p = (np.maximum(count - m.pair_discounts[np.minimum(count, 3)], 0) / np.maximum(total[context], 1)
             + gamma[context] * p_one[word])
        return np.log10(p)[pair], stats[number[len(a):], COUNT]


OUT = "n_tokens long, n_known long, base_score double, score double"


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) per row: log10 probabilities of
    the whole text under an add-0.1 unigram base and under the model."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        mapped = Mapped.of(m)
        for block in blocks(batches, "text", 1 << 20):
            a, b, first = tokens(block.column(1))
            logs, count = mapped.log_probabilities(a, b)
            base = np.log10((count + BASE_ADD) / (m.n_tokens + BASE_ADD * (m.n_types + 1)))
            add = lambda x: np.add.reduceat(x, first[:-1])  # noqa: E731  no text is without tokens
            yield pa.RecordBatch.from_arrays(
                [block.column(0), pa.array(np.diff(first).astype(np.int64)),
                 pa.array(add((count > 0).astype(np.int64))), pa.array(add(base)), pa.array(add(logs))],
                ["doc_id", "n_tokens", "n_known", "base_score", "score"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {OUT}")


def part(doc_id: Column, parts: int = HOLD_OUT) -> Column:
    """The part of the data a row belongs to; part 0 is held out, null for a null id."""
    return F.crc32(doc_id.cast("string")) % parts
