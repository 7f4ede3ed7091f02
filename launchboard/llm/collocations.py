"""Phrase collocations: frequent contiguous word sequences and how strongly their parts
belong together, from an FM-index per shard of the documents.

Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends, and pieces
into words at spaces and tabs. Everything is counted per language (null: ``und``): a
word of two languages is two words.

1. Each shard, some ``SHARD_BYTES`` of text, becomes a sequence of word numbers with
   separators between pieces, written once. Word counts of all shards are summed by hash
   first, which leaves out nearly all rare words; those that remain are summed as they are,
   and words of ``min_count`` occurrences get a global number. No frequent phrase has
   others: the rest separate as well.
2. A bidirectional FM-index (see ``fm_index``) of each sequence is written. From the
   words on, patterns are extended by one word, to the right and to the left in turn,
   up to ``DEPTH`` words.
3. After each level the counts are summed across shards: a shard sends each pattern
   once, named by the global numbers of its two parts that are one word shorter (the
   pattern less its last and its first word), to one of the hash shards, which answers
   with the pattern's own global number if it is frequent. Only those are extended. A
   pattern whose parts are not both frequent is not sent: it cannot be.

The parts' numbers link each phrase to its prefixes and suffixes, and these to their
left and right extensions, so that scores and containment are joins of small tables.

A phrase of a occurrences, cut after k words into parts of l and r occurrences, scores
floor(2000000 a / (l + r)); the lowest cut counts. A phrase is dropped if a longer
frequent phrase that contains it has at least 80 % of its occurrences. Any such longer
phrase contains an extension by one word that has as many, so extensions tell.

Defined cases: null and empty texts have no words; rows of any id take part, and rows
that repeat count again; ties end with the phrase's bytes; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from launchboard.llm.fm_index import DEPTH, FMIndex, Patterns, containing
from launchboard.llm.slices import by_shard
from launchboard.llm.store import Scratch
from launchboard.llm.words import U64, Words, blocks, mix

MIN_COUNT = 30
SCORE_UNIT = 2_000_000
#: A longer phrase with this share of the occurrences replaces a shorter one (percent).
REPLACES = 80
TOP = 2000
UNKNOWN = "und"
#: Text of an indexed shard, and of a hash shard's values.
SHARD_BYTES = 5 << 20
HASH_SHARD_BYTES = 8 << 20
BLOCK_BYTES = 2 << 20

_PIECE = np.zeros(256, dtype=bool)
_PIECE[[ord(c) for c in ".,;:!?"] + [10, 11, 12, 13]] = True
_GAP = _PIECE.copy()
_GAP[[0x20, 9]] = True


class Pieces(Words):
    """Words of pieces; ``opens`` tells which are the first of their piece."""

    def __init__(self, column: pa.Array):
        super().__init__(column, lower=True)
        cuts = np.cumsum(np.r_[0, _PIECE[self.data]])
        text = self.text_of_word()
        self.opens = np.ones(len(self), dtype=bool)
        self.opens[1:] = (cuts[self.starts[1:]] != cuts[self.ends[:-1]]) | (text[1:] != text[:-1])

    @staticmethod
    def separators(data: np.ndarray) -> np.ndarray:
        return _GAP[data]

    def strings(self) -> pa.Array:
        offsets = np.r_[0, np.cumsum(self.ends - self.starts)].astype(np.int64)
        return pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(self), [None, pa.py_buffer(offsets), pa.py_buffer(self.data[~self.space])])


class _Shard:
    """Words and their sequence, gathered block by block."""

    def __init__(self, number: int):
        self.number, self.size = number, 0
        self.numbers: dict[str, dict[bytes, int]] = {}  # of each language's words
        self.count = 0
        self.parts: list[np.ndarray] = []

    def add(self, block: pa.RecordBatch) -> None:
        pieces = Pieces(block.column(0))
        self.size += len(pieces.data) + 64 * block.num_rows
        if not len(pieces):
            return
        coded = pieces.strings().dictionary_encode()
        lang = block.column(1).dictionary_encode()
        langs, words = lang.dictionary.to_pylist(), coded.dictionary.to_pylist()
        key = np.asarray(lang.indices).astype(np.int64)[pieces.text_of_word()] * len(words) + np.asarray(coded.indices)
        kinds, of = np.unique(key, return_inverse=True)
        local = np.empty(len(kinds), dtype=np.int32)
        for k, key in enumerate(kinds.tolist()):
            known = self.numbers.setdefault(langs[key // len(words)], {})
            local[k] = number = known.setdefault(words[key % len(words)], self.count + 1)
            self.count = max(self.count, number)
        sequence = np.zeros(len(of) + int(pieces.opens.sum()), dtype=np.int32)
        sequence[np.arange(len(of)) + np.cumsum(pieces.opens)] = local[of]
        self.parts.append(sequence)

    def row(self) -> pa.RecordBatch:
        """The sequence, and its words in the order of their numbers."""
        langs, words = [""] * self.count, [b""] * self.count
        for lang, known in self.numbers.items():
            for word, k in known.items():
                langs[k - 1], words[k - 1] = lang, word
        sequence = np.concatenate(self.parts)
        body = pa.compress(sequence.tobytes(), codec="zstd", asbytes=True)
        return pa.RecordBatch.from_arrays([
            pa.array([self.number], pa.int64()), pa.array([self.size], pa.int64()),
            pa.array([len(sequence).to_bytes(8, "little") + body], pa.binary()),
            pa.array([_pack_words(langs, words)], pa.binary())], ["shard", "n_bytes", "payload", "words"])


def _pack_words(langs: list[str], words: list[bytes]) -> bytes:
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(words, pa.binary())], ["lang", "word"])
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _sequence(body: bytes) -> np.ndarray:
    n = int.from_bytes(body[:8], "little")
    return np.frombuffer(pa.decompress(body[8:], 4 * n, codec="zstd", asbytes=True), np.int32)


def _words_of(payload: bytes, words: bytes) -> tuple[pa.RecordBatch, np.ndarray, np.ndarray]:
    """(lang and word by number, count of each, 64-bit hash of each)."""
    with pa.ipc.open_stream(words) as source:
        known = source.read_next_batch()
    count = np.bincount(_sequence(payload), minlength=known.num_rows + 1)[1:]
    # words hold no white space, so that joined they are the words of a text
    hashes = Words(pa.array([b" ".join(known.column(1).to_pylist())], pa.binary())).hashes()
    lang = known.column(0).dictionary_encode()
    of_lang = np.array([zlib.crc32(x.encode()) for x in lang.dictionary.to_pylist()], dtype=U64)
    return known, count, mix(hashes ^ mix(of_lang)[np.asarray(lang.indices)])


def _ask_words(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                _, count, hashes = _words_of(batch.column(1)[i].as_py(), batch.column(2)[i].as_py())
                for k, at in by_shard(hashes, shards):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k], pa.int32()), batch.column(0).slice(i, 1),
                         pa.array([(hashes[at] >> U64(32)).astype(np.uint32).tobytes()], pa.binary()),
                         pa.array([count[at].astype(np.uint32).tobytes()], pa.binary())],
                        ["hash_shard", "shard", "hashes", "counts"])
    return run


def _answer_words(min_count: int):
    """A bit for each word: whether words of its hash are frequent together."""
    def run(table: pa.Table) -> pa.Table:
        hashes = [np.frombuffer(x, np.uint32) for x in table["hashes"].to_pylist()]
        counts = np.concatenate([np.frombuffer(x, np.uint32) for x in table["counts"].to_pylist()])
        _, number = np.unique(np.concatenate(hashes), return_inverse=True)
        good = (np.bincount(number, counts) >= min_count)[number]
        cuts = np.cumsum([0, *map(len, hashes)])
        return pa.table({"shard": table["shard"], "hash_shard": table["hash_shard"], "body": pa.array(
            [np.packbits(good[a:b]).tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())})
    return run


def _candidates(shards: int):
    """Words of frequent hashes, and in a row without a word all words of a language."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                known, count, hashes = _words_of(batch.column(1)[i].as_py(), batch.column(2)[i].as_py())
                bodies = {r["hash_shard"]: r["body"] for r in batch.column(3)[i].as_py()}
                good = np.zeros(len(hashes), dtype=bool)
                for k, at in by_shard(hashes, shards):
                    good[at] = np.unpackbits(np.frombuffer(bodies[k], np.uint8), count=len(at)) > 0
                lang = known.column(0).dictionary_encode()
                totals = np.bincount(np.asarray(lang.indices), count, len(lang.dictionary)).astype(np.int64)
                some = pa.array(np.flatnonzero(good))
                n = len(some) + len(totals)
                none = len(totals)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n, batch.column(0)[i].as_py())),
                    pa.array(np.r_[np.asarray(some) + 1, np.zeros(none)].astype(np.int32)),
                    pa.concat_arrays([known.column(0).take(some), lang.dictionary]),
                    pa.concat_arrays([known.column(1).take(some).cast(pa.string()), pa.nulls(none, pa.string())]),
                    pa.array(np.r_[count[np.asarray(some)], totals].astype(np.int64))],
                    ["shard", "local", "lang", "word", "n"])
    return run


def _sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    shard = _Shard(number)
    for block in blocks(batches, "text", BLOCK_BYTES):
        shard.add(block)
        if shard.size >= SHARD_BYTES:
            if shard.parts:
                yield shard.row()
            shard = _Shard(shard.number + 1)
    if shard.parts:
        yield shard.row()


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The index of each shard's sequence of frequent words."""
    for batch in batches:
        for i in range(batch.num_rows):
            sequence = _sequence(batch.column(1)[i].as_py())
            local, number = (np.asarray(batch.column(c).slice(i, 1).flatten()) for c in (2, 3))
            symbol = np.zeros(max(int(sequence.max(initial=0)), int(local.max(initial=0))) + 1, dtype=np.int32)
            symbol[local] = np.arange(1, len(local) + 1)
            text = symbol[sequence]
            text = np.pad(text[(text > 0) | np.r_[True, text[:-1] > 0][:len(text)]], 1)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(i, 1), pa.array([FMIndex.of(text).pack()], pa.binary()),
                pa.array([_pack_numbers(number)], pa.binary())], ["shard", "payload", "numbers"])


class Level:
    """A shard's frequent patterns of one length, and their extensions."""

    def __init__(self, payload: bytes, numbers: bytes):
        self.index = FMIndex.unpack(payload)
        self.patterns = self.index.symbols(_unpack_numbers(numbers))
        self.length = 1

    def extend(self) -> tuple[Patterns, np.ndarray, np.ndarray]:
        """Patterns one word longer, with the numbers of their parts: less the last word,
        less the first word."""
        old = self.patterns
        side = "right" if self.length % 2 else "left"
        new, of = self.index.extend(old, side)
        if side == "right":
            other = containing(old.reverse_low, old.size, new.reverse_low)
            left, right = old.number[of], old.number[other]
        else:
            other = containing(old.low, old.size, new.low)
            left, right = old.number[other], old.number[of]
        good = np.flatnonzero(other >= 0)
        return new.take(good), left[good], right[good]

    def go_on(self, answers: dict[int, bytes], shards: int) -> None:
        """The next length: extensions that got a number."""
        new, left, right = self.extend()
        for shard, at in by_shard(_name(left, right), shards):
            new.number[at] = _read(answers[shard], len(at))
        self.patterns = new.take(np.flatnonzero(new.number >= 0))
        self.length += 1


def _name(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(mix(left.astype(U64)) + right.astype(U64))


def _squeeze(values: np.ndarray) -> bytes:
    """Whole numbers, byte by byte of all: the high ones, nearly all zero, take no room."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _spread(body: bytes, n: int, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(body, n * size, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, n).T).view(kind).ravel()


def _pack_numbers(number: np.ndarray) -> bytes:
    return len(number).to_bytes(8, "little") + _squeeze(number.astype(np.int64))


def _unpack_numbers(body: bytes) -> np.ndarray:
    return _spread(body[8:], int.from_bytes(body[:8], "little"), np.int64)


def _write(number: np.ndarray) -> bytes:
    """Numbers, -1 for most: a bit each, then the others."""
    some = number >= 0
    return np.packbits(some).tobytes() + _squeeze(number[some])


def _read(body: bytes, n: int) -> np.ndarray:
    cut = -(-n // 8)
    out = np.full(n, -1, dtype=np.int64)
    some = np.unpackbits(np.frombuffer(body[:cut], np.uint8), count=n) > 0
    out[some] = _spread(body[cut:], int(some.sum()), np.int64)
    return out


def _ask(level: int, shards: int):
    """Each extension once: its parts' numbers and its count."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                state = Level(batch.column(1)[i].as_py(), batch.column(2)[i].as_py())
                replies = batch.column(3)[i].as_py() or []
                for length in range(2, level):
                    state.go_on({r["hash_shard"]: r["body"] for r in replies if r["level"] == length}, shards)
                new, left, right = state.extend()
                # one message at a time: together they are many megabytes in the executor
                for k, at in by_shard(_name(left, right), shards):
                    parts = left[at], right[at], new.size[at].astype(np.uint32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k], pa.int32()), batch.column(0).slice(i, 1),
                         pa.array([len(at)], pa.int32()), *(pa.array([_squeeze(x)], pa.binary()) for x in parts)],
                        ["hash_shard", "shard", "n", "lefts", "rights", "counts"])
    return run


def _answer(level: int, shards: int, min_count: int):
    """Sums of one hash shard: numbers of frequent patterns, for each shard that asked in
    the order of its question, and the patterns themselves."""
    def run(table: pa.Table) -> pa.Table:
        part = table["hash_shard"][0].as_py()
        sizes = table["n"].to_pylist()
        left, right, count = (np.concatenate([_spread(x, n, kind) for x, n in zip(table[c].to_pylist(), sizes)])
                              for c, kind in (("lefts", np.int64), ("rights", np.int64), ("counts", np.uint32)))
        count = count.astype(np.int64)
        order = np.lexsort((right, left))
        new = np.r_[True, (left[order][1:] != left[order][:-1]) | (right[order][1:] != right[order][:-1])]
        head = order[new]
        total = np.add.reduceat(count[order], np.flatnonzero(new))
        good = total >= min_count
        # numbers stay small, so that they pack well
        number = np.where(good, (np.cumsum(good) - 1) * shards + part, -1)
        answer = np.empty(len(left), dtype=np.int64)
        answer[order] = number[np.cumsum(new) - 1]
        cuts = np.cumsum([0, *sizes])
        asked, kept = len(sizes), int(good.sum())
        return pa.table({
            "shard": pa.concat_arrays([table["shard"].combine_chunks(), pa.nulls(kept, pa.int64())]),
            "level": pa.array([level] * (asked + kept), pa.int32()),
            "hash_shard": pa.array([part] * (asked + kept), pa.int32()),
            "body": pa.array([_write(answer[a:b]) for a, b in zip(cuts, cuts[1:])] + [None] * kept, pa.binary()),
            **{c: pa.concat_arrays([pa.nulls(asked, pa.int64()), pa.array(v[good])])
               for c, v in (("number", number), ("left", left[head]), ("right", right[head]), ("a", total))}})
    return run


ANSWER = ("shard long, level int, hash_shard int, body binary, "
          "number long, left long, right long, a long")


def frequent_phrases(docs: DataFrame, scratch: Scratch, min_count: int = MIN_COUNT) -> tuple[DataFrame, list[DataFrame]]:
    """(lang, n) of all words, and for each length from 1 on the frequent phrases: (number,
    lang, words, a, prefixes, suffixes), where the arrays hold the counts of the phrase's
    proper prefixes and suffixes from one word on; ``left`` and ``right``, from two words
    on, are the numbers of the phrase less its last and less its first word."""
    spark = docs.sparkSession
    source = docs.select("text", F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"))
    sequences = scratch.keep(source.mapInArrow(
        _sequences, "shard long, n_bytes long, payload binary, words binary"), "sequences", packed=True)
    size = sequences.agg(F.sum("n_bytes")).first()[0] or 0
    shards = max(1, -(-size // HASH_SHARD_BYTES))
    bits = scratch.keep(sequences.select("shard", "payload", "words").mapInArrow(
        _ask_words(shards), "hash_shard int, shard long, hashes binary, counts binary")
        .repartition(shards, "hash_shard").groupBy("hash_shard").applyInArrow(
        _answer_words(min_count), "shard long, hash_shard int, body binary"), "word-bits")
    per_shard = bits.groupBy("shard").agg(F.collect_list(F.struct("hash_shard", "body")).alias("replies"))
    written = scratch.keep(sequences.join(per_shard.hint("shuffle_hash"), "shard").select(
        "shard", "payload", "words", "replies").mapInArrow(
        _candidates(shards), "shard long, local int, lang string, word string, n long"), "entries")
    entries = written.where("word is not null")
    totals = scratch.keep(written.where("word is null").groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    counted = scratch.keep(entries.groupBy("lang", "word").agg(F.sum("n").alias("a")), "words")
    scratch.release()
    # once written, ids by partition and row are fixed; mixed they are small and pack well
    words = scratch.keep(counted.where(F.col("a") >= min_count).withColumn(
        "id", F.monotonically_increasing_id()), "frequent-words")
    parts = (words.agg(F.max(F.shiftright("id", 33))).first()[0] or 0) + 1
    words = words.withColumn("number", F.col("id").bitwiseAND((1 << 33) - 1) * parts + F.shiftright("id", 33))
    # two lists of numbers take a third of the bytes of a list of pairs; a row adds to both at once
    of_shard = entries.join(words.select("lang", "word", "number"), ["lang", "word"]).groupBy("shard").agg(
        F.collect_list("local").alias("locals"), F.collect_list("number").alias("numbers"))
    indexes = scratch.keep(sequences.join(of_shard.hint("shuffle_hash"), "shard").select(
        "shard", "payload", "locals", "numbers").mapInArrow(
        _build, "shard long, payload binary, numbers binary"), "indexes", packed=True)
    scratch.drop("sequences")
    scratch.release()
    found = [words.select("number", "lang", F.array("word").alias("words"), "a",
                          *(F.array().cast("array<long>").alias(c) for c in ("prefixes", "suffixes")))]
    empty = F.lit(None).cast("array<struct<level:int,hash_shard:int,body:binary>>").alias("replies")
    asked, replies = indexes.select("shard", "payload", "numbers", empty), None
    for level in range(2, DEPTH + 1):
        questions = asked.mapInArrow(
            _ask(level, shards), "hash_shard int, shard long, n int, lefts binary, rights binary, counts binary")
        answers = scratch.keep(questions.repartition(shards, "hash_shard").groupBy("hash_shard").applyInArrow(
            _answer(level, shards, min_count), ANSWER), f"answers-{level}")
        of_level = answers.where("body is not null").select("shard", "level", "hash_shard", "body")
        replies = of_level if replies is None else replies.unionByName(of_level)
        per_shard = replies.groupBy("shard").agg(
            F.collect_list(F.struct("level", "hash_shard", "body")).alias("replies"))
        # shards without an extension have nothing more to say
        asked = indexes.join(per_shard.hint("shuffle_hash"), "shard").select("shard", "payload", "numbers", "replies")
        grams = answers.where("number is not null").select("number", "left", "right", "a")
        found.append(scratch.keep(_linked(grams, found[-1]), f"phrases-{level}"))
        scratch.release()
    return totals, found


def _linked(grams: DataFrame, parts: DataFrame) -> DataFrame:
    left = parts.select(F.col("number").alias("left"), "lang", F.col("words").alias("front"),
                        F.col("prefixes").alias("pre"), F.col("a").alias("left_a"))
    right = parts.select(F.col("number").alias("right"), F.element_at("words", -1).alias("last"),
                         F.col("suffixes").alias("suf"), F.col("a").alias("right_a"))
    return grams.join(left, "left").join(right, "right").select(
        "number", "lang", F.concat("front", F.array("last")).alias("words"), "a",
        F.concat("pre", F.array("left_a")).alias("prefixes"),
        F.concat("suf", F.array("right_a")).alias("suffixes"), "left", "right")


def scored(phrases: list[DataFrame], replaces: int = REPLACES) -> DataFrame:
    """(lang, phrase, a, l, r, score, left_extension, right_extension) of the phrases of two
    words or more that no longer one replaces. The extensions are the counts of the most
    frequent phrase that has a word more on that side (null: none is frequent)."""
    out = None
    for k in range(1, len(phrases)):
        n_words, here = k + 1, phrases[k]
        longer = phrases[k + 1] if k + 1 < len(phrases) else None
        if longer is None:
            here = here.withColumns({c: F.lit(None).cast("long") for c in ("left_extension", "right_extension")})
        else:
            for part, name in (("left", "right_extension"), ("right", "left_extension")):
                most = longer.groupBy(F.col(part).alias("number")).agg(F.max("a").alias(name))
                here = here.join(most, "number", "left")
            most = F.greatest(*(F.coalesce(c, F.lit(0)) for c in ("left_extension", "right_extension")))
            here = here.where(100 * most < replaces * F.col("a"))
        cuts = [F.struct(
            F.expr(f"(cast(a as decimal(20, 0)) * {SCORE_UNIT}) div "
                   f"(cast(prefixes[{i}] as decimal(20, 0)) + suffixes[{n_words - 2 - i}])").alias("score"),
            F.lit(i + 1).alias("k"), F.expr(f"prefixes[{i}]").alias("l"),
            F.expr(f"suffixes[{n_words - 2 - i}]").alias("r")) for i in range(n_words - 1)]
        part = here.withColumn("cut", F.array_min(F.array(*cuts))).select(
            "lang", F.concat_ws(" ", "words").alias("phrase"), "a", "cut.l", "cut.r", "cut.score",
            "left_extension", "right_extension")
        out = part if out is None else out.unionByName(part)
    return out


def top_collocations(docs: DataFrame, top: int = TOP, min_count: int = MIN_COUNT) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score, left_extension, right_extension): the ``top``
    phrases of each language by score, count and phrase."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "collocations")
    totals, phrases = frequent_phrases(docs, scratch, min_count)
    order = [F.col("score").desc(), F.col("a").desc(), "phrase"]
    # the best of a language are among the best of its parts, so no task holds a language
    salt = F.pmod(F.xxhash64("phrase"), F.lit(int(spark.conf.get("spark.sql.shuffle.partitions"))))
    rows = scored(phrases).withColumn("salt", salt)
    for keys in (["lang", "salt"], ["lang"]):
        rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(
            F.col("rank") <= top)
    return rows.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score",
        "left_extension", "right_extension")
