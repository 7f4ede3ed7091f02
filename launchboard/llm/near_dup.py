"""MinHash near-dedup with bottom-k sketches of one hash function.

A document's set are the distinct hashes of its ``words``-word shingles; its sketch
keeps the ``SKETCH`` least. Equal sets form one class, which takes part once, so
exact copies cost a partial aggregation however many there are. Then

1. inverted lists of retained values generate overlaps: a list holds the classes
   that retain a value. Pairs that pass step 2 share a known part of their sketches,
   so each class enters only the lists of its rarest values, as many as make a
   shared one certain (the prefix principle). Values of passages that many documents
   share are common and drop out without a cap. This is done twice: with the sketches of
   all classes, which leaves classes that have a candidate at all, and for those with the
   ``SECOND`` least values, which for most are all they have. There the places of a shared
   value among both classes' values, rarest first, bound what they can have in common
   from it on: the near copies of one source that are too far from each other differ in
   their rarest values, and do not meet;
2. the union sketch, the least ``SKETCH`` values of both, estimates the Jaccard
   similarity; pairs ``SIGMAS`` standard deviations below the threshold go;
3. the exact similarity of the full sets decides.

Only components are wanted, so a pair whose ends are already connected needs no
check. Each list is worked in rounds: in a round a few members, chosen by hash, are
hubs and meet the members that come after them; what they link is contracted, lists
inside one component end, and the next round takes ``GROWTH`` times as many hubs. Each
pair of a list thus meets once or is settled by connection, and no link between
components is lost. Members of a list that are similar, but not enough to be linked,
do meet each other where the second lists have them.

A pair at the threshold is missed with a probability below 1e-7.

Defined cases: null and empty texts have no shingles and link with nothing; texts
with fewer words are one shingle; a row of null id is kept and links nothing (its
component is null); rows that repeat an id are kept or dropped together when their
texts are equal, and judged by their own texts otherwise; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from launchboard.llm.components import contract
from launchboard.llm.slices import by_shard
from launchboard.llm.store import Scratch
from launchboard.llm.words import U64, Words, blocks, mix, unpack, window_hashes

SKETCH = 48
SECOND = 2048
SIGMAS = 6.0
#: Values of the second sketches to a hash shard, and the largest count that is told apart.
SHARD_VALUES = 1 << 20
MOST = (1 << 16) - 1
#: Text that a task holds at a time, and that of a block of second sketches.
BLOCK, SECOND_BLOCK = 1 << 20, 2 << 20
#: Hubs of a list in the first round, and their growth from round to round.
HUBS, GROWTH = 2.0, 16.0


def shingle_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes (as signed numbers) of each text."""
    w = Words(texts, lower=True)
    hashes = w.hashes()
    full = window_hashes(hashes, words).view(np.int64) if len(w) else hashes.view(np.int64)
    out = []
    for a, b in zip(w.first, w.first[1:]):
        if b - a >= words:
            out.append(np.unique(full[a:b - words + 1]))
        elif b > a:
            out.append(window_hashes(hashes[a:b], int(b - a)).view(np.int64)[:1])
        else:
            out.append(np.zeros(0, np.int64))
    return out


def set_digest(shingles: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums over a set: equal for equal sets, else different."""
    u = shingles.view(np.uint64)
    first = mix(u).sum(dtype=np.uint64)
    second = mix(u ^ U64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
    return int(first.view(np.int64)), int(second.view(np.int64))


def text_hash() -> Column:
    """Tells rows of one id apart that have different texts."""
    return F.xxhash64("text")


def sketches(docs: DataFrame, words: int, size: int = SKETCH) -> DataFrame:
    """(doc_id, text_hash, n_shingles, digest, digest2, sketch) per row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", BLOCK):
            sets = shingle_sets(block.column(1), words)
            digests = np.array([set_digest(s) for s in sets], dtype=np.int64).reshape(-1, 2)
            least = [s[:size] for s in sets]
            offsets = np.cumsum([0, *map(len, least)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [block.column(0), block.column(2), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(digests[:, 0]), pa.array(digests[:, 1]),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(least)))],
                ["doc_id", "text_hash", "n_shingles", "digest", "digest2", "sketch"])
    return docs.select(F.col("doc_id").cast("long"), "text", text_hash().alias("text_hash")).mapInArrow(
        run, "doc_id long, text_hash long, n_shingles long, digest long, digest2 long, sketch array<long>")


def least_estimate(percent: int, size: int = SKETCH) -> float:
    share = percent / 100
    return share - SIGMAS * math.sqrt(share * (1 - share) / size)


def listed_values(n: np.ndarray, percent: int) -> np.ndarray:
    """How many of its rarest retained values list a class of n shingles in the second
    lists. If it and all it can be linked with have ``SECOND`` at most, sets are whole and
    the share of common values is exact."""
    kept = np.minimum(n, SECOND)
    exact = -(-kept * percent // 100)
    rough = np.ceil(kept * least_estimate(percent, SECOND)).astype(np.int64)
    return kept - np.where(n * 100 <= SECOND * percent, exact, rough) + 1


def can_be_linked(percent: int) -> Column:
    """Whether a member and a hub of a list have enough values from the shared one on; known
    where all values of both, and of all they can be linked with, are retained. Values
    before the first one that a pair shares are not common, so no link fails there."""
    whole = F.greatest("n", "hub_n") * 100 <= SECOND * percent
    rest = F.least(F.col("n") - F.col("place"), F.col("hub_n") - F.col("hub_place"))
    return ~whole | (rest * (100 + percent) >= percent * (F.col("n") + F.col("hub_n")))


def _second_sketches(texts: DataFrame, words: int, scratch: Scratch) -> DataFrame:
    """Blocks of classes with their ``SECOND`` least values, as packed arrays."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for block in blocks(batches, "text", SECOND_BLOCK):
            sets = shingle_sets(block.column(1), words)
            least = np.concatenate([s[:SECOND] for s in sets])
            yield pa.RecordBatch.from_arrays([
                pa.array([number], pa.int64()), pa.array([len(least)], pa.int64()),
                *(pa.array([x.astype(np.int64).tobytes()], pa.binary()) for x in (
                    block.column(0).to_numpy(zero_copy_only=False), np.array([len(s) for s in sets]), least))],
                ["block", "n_values", "nodes", "sizes", "least"])
            number += 1
    return scratch.keep(texts.select("node", "text").mapInArrow(
        run, "block long, n_values long, nodes binary, sizes binary, least binary"), "second")


def _block_values(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values of a block, each value's number among them, and how often each is there."""
    return np.unique(unpack(row["least"], np.uint64), return_inverse=True, return_counts=True)


def _second_index(texts: DataFrame, words: int, percent: int, scratch: Scratch) -> DataFrame:
    """Members of the second lists. How many classes retain a value is counted in hash
    shards: a block sends each value once, and gets its number back."""
    sketches = _second_sketches(texts, words, scratch)
    total = sketches.agg(F.sum("n_values")).first()[0] or 0
    shards = max(1, -(-total // SHARD_VALUES))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                values, _, count = _block_values(row)
                for shard, at in by_shard(values, shards):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([shard], pa.int32()), pa.array([row["block"]], pa.int64()),
                         pa.array([(values[at] >> U64(32)).astype(np.uint32).tobytes()], pa.binary()),
                         pa.array([count[at].astype(np.uint32).tobytes()], pa.binary())],
                        ["shard", "block", "hashes", "counts"])

    def answer(table: pa.Table) -> pa.Table:
        hashes = [unpack(x, np.uint32) for x in table["hashes"].to_pylist()]
        counts = np.concatenate([unpack(x, np.uint32) for x in table["counts"].to_pylist()])
        _, number = np.unique(np.concatenate(hashes), return_inverse=True)
        df = np.minimum(np.bincount(number, counts)[number], MOST).astype(np.uint16)
        cuts = np.cumsum([0, *map(len, hashes)])
        return pa.table({"block": table["block"], "shard": table["shard"],
                         "df": pa.array([df[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())})

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                values, number, _ = _block_values(row)
                bodies = {r["shard"]: r["df"] for r in row["replies"]}
                df = np.empty(len(values), dtype=np.int64)
                for shard, at in by_shard(values, shards):
                    df[at] = unpack(bodies[shard], np.uint16)
                nodes, n = unpack(row["nodes"], np.int64), unpack(row["sizes"], np.int64)
                kept = np.minimum(n, SECOND)
                of = np.repeat(np.arange(len(nodes)), kept)
                # each class's values by rarity, and then by value
                order = np.lexsort((number, df[number], of))
                place = np.arange(len(order)) - np.repeat(np.cumsum(kept) - kept, kept)
                some_at = np.flatnonzero((place < listed_values(n, percent)[of]) & (df[number[order]] > 1))
                some = order[some_at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values[number[some]].view(np.int64)), pa.array(nodes[of[some]]), pa.array(n[of[some]]),
                     pa.array(place[some_at])], ["value", "node", "n", "place"])

    answers = scratch.keep(sketches.select("block", "least").mapInArrow(
        ask, "shard int, block long, hashes binary, counts binary").repartition(shards, "shard").groupBy(
        "shard").applyInArrow(answer, "block long, shard int, df binary"), "second-counts")
    replies = answers.groupBy("block").agg(F.collect_list(F.struct("shard", "df")).alias("replies"))
    listed = scratch.keep(sketches.join(replies.hint("shuffle_hash"), "block").select("nodes", "sizes", "least", "replies").mapInArrow(
        members, "value long, node long, n long, place long"), "second-index")
    df = listed.groupBy("value").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    return listed.join(df, "value")


def _index(classes: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Members of the first lists: (value, df, node, n) with df members to a list."""
    kept = classes.select("node", "n", F.size("sketch").alias("k"), F.explode("sketch").alias("value"))
    common = kept.groupBy("value").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    rows = kept.join(common, "value")
    # rare values first; values of one class alone come before all that are listed
    rank = F.row_number().over(Window.partitionBy("node").orderBy("df", "value"))
    alone = F.col("k") - F.count(F.lit(1)).over(Window.partitionBy("node"))
    prefix = F.col("k") - F.ceil(F.col("k") * least_estimate(percent)) + 1
    listed = (rows.withColumn("__at", rank + alone).where(F.col("__at") <= prefix)
              .select("value", "node", "n"))
    listed = scratch.keep(listed, "index")
    df = listed.groupBy("value").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    return listed.join(df, "value")


def _estimate(a: Column, b: Column, n_a: Column, n_b: Column) -> Column:
    """Jaccard estimate from two sketches; exact where both hold their whole sets."""
    union = F.array_sort(F.array_union(a, b))
    least = F.when((n_a <= SKETCH) & (n_b <= SKETCH), union).otherwise(F.slice(union, 1, SKETCH))
    return F.size(F.array_intersect(F.array_intersect(least, a), b)) / F.size(least)


def _verify(words: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(iter([batch]), "text_a", 2 << 20):
                left, right = shingle_sets(block.column(2), words), shingle_sets(block.column(3), words)
                common = np.array([len(np.intersect1d(x, y, assume_unique=True))
                                   for x, y in zip(left, right)], dtype=np.int64)
                union = np.array([len(x) + len(y) for x, y in zip(left, right)], dtype=np.int64) - common
                good = pa.array(100 * common >= percent * union)
                yield pa.RecordBatch.from_arrays(
                    [block.column(0), block.column(1)], ["a", "b"]).filter(good)
    return run


def _texts(docs: DataFrame, classes: DataFrame, members: DataFrame, words: int) -> DataFrame:
    """(node, text): one text for each class among ``members``."""
    wanted = classes.join(members, "node", "left_semi").select(
        "node", F.col("first_doc").alias("__doc"))
    found = docs.select(F.col("doc_id").cast("long").alias("__id"), "text").join(
        wanted.hint("shuffle_hash"), F.col("__id") == F.col("__doc")).select("node", "text")

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows that repeat an id may have another text
        for block in blocks(batches, "text", BLOCK):
            nodes = block.column(0).to_pylist()
            digests = [set_digest(s)[0] for s in shingle_sets(block.column(1), words)]
            yield block.filter(pa.array([n == d for n, d in zip(nodes, digests)]))
    return found.mapInArrow(own, "node long, text string")


def link_classes(docs: DataFrame, classes: DataFrame, words: int, percent: int,
                 scratch: Scratch) -> DataFrame:
    """(node, comp) of the classes that are in a list."""
    least = least_estimate(percent)
    first = scratch.keep(_index(classes, percent, scratch).select("node").distinct(), "first")
    texts = _texts(docs, classes, first, words)
    # rows that repeat id and text: one is enough
    texts = texts.dropDuplicates(["node"])
    texts_path = f"{scratch.path}/texts"
    texts.write.option("compression", "zstd").parquet(texts_path)
    texts = scratch.spark.read.schema("node long, text string").parquet(texts_path)
    scratch.release()
    members = scratch.keep(_second_index(texts, words, percent, scratch), "members-0")
    for done_with in ("second", "second-counts", "second-index", "index"):
        scratch.drop(done_with)
    scratch.release()
    labels = scratch.keep(members.select("node").distinct().withColumn("comp", F.col("node")), "labels")
    chance = (F.xxhash64("node").bitwiseAND((1 << 40) - 1) / float(1 << 40)).alias("chance")
    done, step = 0.0, 0
    sketch = classes.select("node", "sketch", F.col("n").alias("size"))
    while not members.isEmpty():
        # hubs of the round: members whose place in their list, by hash, is in [done, upto)
        upto = HUBS * GROWTH ** step
        rows = members if step else members.withColumn("comp", F.col("node"))
        rows = rows.select("value", "node", "n", "place", "comp", chance, "df")
        place = F.col("chance") * F.col("df")
        rows = rows.where(place >= done)
        hubs = rows.where(place < upto).select(
            "value", *(F.col(c).alias(f"hub_{c}") for c in ("node", "n", "place", "comp", "chance")))
        pairs = (rows.join(hubs, "value")
                 .where((F.col("comp") != F.col("hub_comp"))
                        & (F.struct("chance", "node") > F.struct("hub_chance", "hub_node"))
                        & (100 * F.least("n", "hub_n") >= percent * F.greatest("n", "hub_n"))
                        & can_be_linked(percent))
                 .select(F.col("node").alias("a"), F.col("hub_node").alias("b")).distinct())
        passed = (pairs.join(sketch.toDF("a", "sketch_a", "n_a"), "a")
                  .join(sketch.toDF("b", "sketch_b", "n_b"), "b")
                  .withColumn("estimate", _estimate(*map(F.col, ("sketch_a", "sketch_b", "n_a", "n_b"))))
                  .where(F.col("estimate") >= least).select("a", "b"))
        passed = scratch.keep(passed, f"passed-{step}")
        linked = (passed.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")
                  .select("a", "b", "text_a", "text_b")
                  .mapInArrow(_verify(words, percent), "a long, b long"))
        edges = (linked.join(labels.toDF("a", "comp_a"), "a").join(labels.toDF("b", "comp_b"), "b")
                 .select(F.col("comp_a").alias("a"), F.col("comp_b").alias("b")))
        labels = contract(labels, edges, scratch, f"contract-{step}")
        # lists go on with their members behind the hubs, while these can meet another component
        left = rows.where(place >= upto).select("value", "node", "n", "place", "df").join(labels, "node")
        open_lists = rows.select("value", "node").join(labels, "node").groupBy("value").agg(
            F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("value")
        members = scratch.keep(left.join(open_lists, "value"), f"members-{step + 1}")
        scratch.release()
        done, step = upto, step + 1
    return labels


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, kept) per row: ``component_id`` is
    the least id reachable over links of Jaccard similarity ``percent`` or more."""
    scratch = Scratch(docs.sparkSession, "near-dup")
    rows = scratch.keep(sketches(docs, words), "sketches")
    # a class is named by its digest
    classes = scratch.keep(
        rows.where("doc_id is not null and n_shingles > 0")
        .groupBy("n_shingles", "digest", "digest2")
        .agg(F.min("doc_id").alias("first_doc"), F.first("sketch").alias("sketch"))
        .select(F.col("digest").alias("node"), "digest2", F.col("n_shingles").alias("n"),
                "first_doc", "sketch"), "classes")
    labels = link_classes(docs, classes, words, percent, scratch)
    named = classes.select("node", "digest2", "first_doc").join(labels, "node", "left").withColumn(
        "comp", F.coalesce("comp", "node"))
    least = named.groupBy("comp").agg(F.min("first_doc").alias("component_id"))
    named = scratch.keep(named.join(least, "comp").select(
        F.col("node").alias("digest"), "digest2", "component_id"), "named")
    of_set = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return (rows.select("doc_id", "text_hash", "n_shingles", "digest", "digest2")
            .join(named, ["digest", "digest2"], "left")
            .select("doc_id", "text_hash", "n_shingles",
                    F.when(F.col("doc_id").isNotNull(), of_set).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def drop_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns unchanged. Only the dropped
    rows' ids and text hashes travel to the documents."""
    found = near_duplicates(docs, words, percent).where("not kept").select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    found = found.hint("shuffle_hash")
    same = (docs["doc_id"].cast("long") == found["__id"]) & (F.xxhash64(docs["text"]) == found["__hash"])
    return docs.join(found, same, "left_anti")
