"""Quality rules: base statistics and a linear-chain CRF over lines.

Every line that has a word gets the label content or boilerplate: Viterbi decoding
finds the best label sequence of a document under a linear-chain conditional
random field. A document stays if its base statistics pass and the words in
content lines are at least ``CONTENT_SHARE`` of its words.

The field's weights are fitted on a bounded sample of labelled documents
(``TRAIN_DOCS`` documents of at most ``TRAIN_LINES`` lines, by least hash of id). Only
documents have labels; those of their lines are found by expectation-maximisation, with
the document's label as evidence for each line, so a good text may have boilerplate lines
and a bad one content. Of several labels of one id the least counts. Without labels of
both kinds the fixed ``DEFAULT`` weights hold. Everything else covers all rows and whole
texts.

Defined cases: null and empty texts have no words and fail the base rules; a row
with a null id is judged like any other; repeated rows are judged each; an empty
table gives no rows; other columns are ignored (``keep_clean`` passes them on).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from launchboard.llm.words import U64, Words, blocks, mix, window_hashes

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
REPEAT_WINDOW = 8
CONTENT_SHARE = 0.5
#: Bytes of text measured at once: some ten arrays have an element per byte.
BLOCK = 1 << 20
TRAIN_DOCS = 800
TRAIN_LINES = 60
#: What a document's label says for or against content in a line, as a log odds.
EVIDENCE = 2.0
TRANSITION_PRIOR = 0.3

STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
OUT = f"{STATS}, n_content_words long, base_failed boolean, kept boolean"

FEATURES = ("bias", "symbols", "bars", "shouts", "capitals", "digits", "repeated_words",
            "repeated_windows", "duplicate", "short", "long_words")

# byte classes: 1 symbol, 2 bar, 3 exclamation mark, 4 capital, 5 small letter, 6 digit
BYTE_CLASS = np.zeros(256, dtype=np.int64)
for _chars, _code in ((b"#*$%&<>", 1), (b"|", 2), (b"!", 3), (bytes(range(65, 91)), 4),
                      (bytes(range(97, 123)), 5), (bytes(range(48, 58)), 6)):
    BYTE_CLASS[list(_chars)] = _code


@dataclass
class Field:
    """Weights of the content label's features, and transitions [from, to] where
    label 1 is content."""

    weights: np.ndarray
    transitions: np.ndarray


#: Used where no labels are given: symbols, bars, capitals and repetition speak
#: against content, and neighbouring lines agree.
DEFAULT = Field(np.array([3.0, -6.0, -6.0, -4.0, -8.0, -4.0, -4.0, -4.0, -1.0, -0.5, -1.0]),
                np.array([[0.5, -0.5], [-0.5, 0.5]]))


@dataclass
class Lines:
    """Lines of a block that have a word, and the statistics of its texts."""

    text: np.ndarray
    words: np.ndarray
    features: np.ndarray
    stats: dict


def measure(column: pa.Array) -> Lines:
    w = Words(column)
    n_texts, data = len(w.counts), w.data
    hashes, text = w.hashes(), w.text_of_word()
    sizes = np.diff(w.offsets)
    text_of_byte = np.repeat(np.arange(n_texts), sizes)
    # a line starts at each text's first byte and after each line feed
    begins = np.zeros(len(data), dtype=bool)
    begins[w.offsets[:-1][sizes > 0]] = True
    begins[1:] |= data[:-1] == 10
    line_of_byte = np.cumsum(begins) - 1
    n_lines = int(line_of_byte[-1]) + 1 if len(data) else 0
    kinds = np.bincount(line_of_byte * 7 + BYTE_CLASS[data], minlength=n_lines * 7).reshape(n_lines, 7)
    line = line_of_byte[w.starts]
    words = np.bincount(line, minlength=n_lines)
    size = np.bincount(line_of_byte, minlength=n_lines)
    line_text = text_of_byte[begins]

    # words in windows that the text holds twice or more
    at = np.flatnonzero(w.room() >= REPEAT_WINDOW)
    covered = np.zeros(len(w) + 1, dtype=np.int64)
    if len(at):
        key = window_hashes(hashes, REPEAT_WINDOW)[at] ^ mix(text[at].astype(U64))
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        twice = at[order[np.r_[same, False] | np.r_[False, same]]]
        np.add.at(covered, twice, 1)
        np.add.at(covered, twice + REPEAT_WINDOW, -1)
    repeated = np.cumsum(covered)[:-1] > 0

    # a word that its line already holds
    again = np.zeros(len(w), dtype=bool)
    if len(w):
        order = np.lexsort((hashes, line))
        again[order[1:]] = (hashes[order][1:] == hashes[order][:-1]) & (line[order][1:] == line[order][:-1])

    # lines equal to an earlier one of their text, line ends left out
    ends = np.r_[np.flatnonzero(begins)[1:], len(data)][:n_lines]
    starts = np.flatnonzero(begins)
    raw, duplicate = data.tobytes(), np.zeros(n_lines, dtype=bool)
    seen: set = set()
    last = -1
    for k in np.flatnonzero(words):
        if line_text[k] != last:
            seen, last = set(), line_text[k]
        content = raw[starts[k]:ends[k]].rstrip(b"\n")
        if content in seen:
            duplicate[k] = True
        else:
            seen.add(content)

    has = np.flatnonzero(words)
    n = np.maximum(size[has], 1).astype(float)
    k, nw = kinds[has], words[has].astype(float)
    letters = np.maximum(k[:, 4] + k[:, 5], 1)
    features = np.stack([
        np.ones(len(has)), *(np.minimum(10 * k[:, i] / n, 1) for i in (1, 2, 3)),
        k[:, 4] / letters, k[:, 6] / n,
        np.bincount(line, again, n_lines)[has] / nw, np.bincount(line, repeated, n_lines)[has] / nw,
        duplicate[has].astype(float), (nw <= 3).astype(float),
        np.minimum(np.bincount(line, w.ends - w.starts, n_lines)[has] / nw / 50, 1)], axis=1)

    lead = ((data & 0xC0) != 0x80) & ~w.space
    per_text = lambda x: np.bincount(text_of_byte, x, n_texts).astype(np.int64)
    stats = {
        "n_words": w.counts.astype(np.int64), "word_chars": per_text(lead),
        "n_symbols": per_text((BYTE_CLASS[data] == 1) | (BYTE_CLASS[data] == 2)),
        "n_dup_lines": np.bincount(line_text, duplicate, n_texts).astype(np.int64),
        "n_repeat_words": np.bincount(text, repeated, n_texts).astype(np.int64)}
    return Lines(line_text[has], words[has], features, stats)


def _grid(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts that have lines by falling line count: their first line, their line
    counts, and for each step how many texts still have a line."""
    ids, first, count = np.unique(text, return_index=True, return_counts=True)
    order = np.argsort(-count, kind="stable")
    first, count = first[order], count[order]
    steps = int(count[0]) if len(count) else 0
    active = len(count) - np.searchsorted(count[::-1], np.arange(steps), side="right")
    return first, count, active


def viterbi(text: np.ndarray, emission: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Best labels (1 content) of each text's lines; ``emission`` is the content
    label's score. Texts advance together, line by line. Ties go to content."""
    first, count, active = _grid(text)
    labels = np.zeros(len(text), dtype=np.int8)
    back = np.zeros((len(text), 2), dtype=np.int8)
    score = np.zeros((len(first), 2))
    if not len(first):
        return labels
    score[:, 1] = emission[first]
    for t in range(1, len(active)):
        m, at = active[t], first[:active[t]] + t
        step = score[:m, :, None] + transitions
        best = (step[:, 1] >= step[:, 0]).astype(np.int8)
        back[at] = best
        score[:m] = np.where(best, step[:, 1], step[:, 0])
        score[:m, 1] += emission[at]
    state = (score[:, 1] >= score[:, 0]).astype(np.int8)
    for t in range(len(active) - 1, -1, -1):
        m = active[t]
        at = first[:m] + t
        labels[at] = state[:m]
        state[:m] = back[at, state[:m]]
    return labels


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis)
    return top + np.log(np.exp(x - np.expand_dims(top, axis)).sum(axis=axis))


def _marginals(x: np.ndarray, mask: np.ndarray, weights: np.ndarray, trans: np.ndarray,
               evidence: np.ndarray | float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """Probability of content for each line (text, step), and expected transitions, by
    forward and backward sums. ``evidence`` speaks for content in each line of a text."""
    n, steps = mask.shape
    e = np.zeros((n, steps, 2))
    e[:, :, 1] = x @ weights + np.reshape(evidence, (-1, 1))
    alpha, beta = np.zeros((n, steps, 2)), np.zeros((n, steps, 2))
    alpha[:, 0] = e[:, 0]
    for t in range(1, steps):
        new = _logsum(alpha[:, t - 1, :, None] + trans, 1) + e[:, t]
        alpha[:, t] = np.where(mask[:, t, None], new, alpha[:, t - 1])
    norm = _logsum(alpha[:, -1], 1)
    pair = np.zeros((2, 2))
    for t in range(steps - 2, -1, -1):
        onward = e[:, t + 1] + beta[:, t + 1]
        live = mask[:, t + 1]
        beta[:, t] = np.where(live[:, None], _logsum(trans + onward[:, None, :], 2), 0)
        joint = alpha[:, t, :, None] + trans + onward[:, None, :] - norm[:, None, None]
        pair += np.exp(joint[live]).sum(0)
    return np.exp(alpha[:, :, 1] + beta[:, :, 1] - norm[:, None]) * mask, pair


def fit_field(texts: list[np.ndarray], labels: list[int], passes: int = 5, rounds: int = 25, rate: float = 0.1,
              prior: float = 0.02, evidence: float = EVIDENCE) -> Field:
    """Expectation-maximisation over the labels of lines, of which only the document's
    label is known: it is evidence for each of its lines, not their label. Each pass takes
    the lines' probabilities and transitions under the field and that evidence, and fits
    the field to them by Adam; it starts from ``DEFAULT``.

    ``texts``: features of each text's lines; ``labels``: the texts' labels. ``prior``:
    strength of the Gaussian prior about ``DEFAULT``; that of the transitions is stronger,
    as labels of whole documents don't tell where lines change.
    """
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    count = np.array([len(texts[i]) for i in order])
    steps, n = int(count.max()), len(order)
    x = np.zeros((n, steps, len(FEATURES)))
    for r, i in enumerate(order):
        x[r, :count[r]] = texts[i]
    y = np.array([labels[i] for i in order])
    mask = np.arange(steps) < count[:, None]
    start = np.r_[DEFAULT.weights, DEFAULT.transitions.ravel()]
    both, total, size = start.copy(), mask.sum(), len(FEATURES)
    hold = np.r_[np.full(size, prior / n), np.full(4, TRANSITION_PRIOR)]
    for _ in range(passes):
        wanted, pairs = _marginals(x, mask, both[:size], both[size:].reshape(2, 2), evidence * (2 * y - 1))
        kept = (np.zeros(len(both)), np.zeros(len(both)))
        for r in range(1, rounds + 1):
            marginal, pair = _marginals(x, mask, both[:size], both[size:].reshape(2, 2))
            grad = np.r_[np.einsum("ntf,nt->f", x, wanted - marginal), (pairs - pair).ravel()] / total
            grad -= hold * (both - start)
            kept[0][:] = 0.9 * kept[0] + 0.1 * grad
            kept[1][:] = 0.99 * kept[1] + 0.01 * grad ** 2
            both = both + rate * kept[0] / (1 - 0.9 ** r) / (np.sqrt(kept[1] / (1 - 0.99 ** r)) + 1e-8)
    return Field(both[:size], both[size:].reshape(2, 2))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches, "text", BLOCK):
        lines = measure(block.column(0))
        first, last = (np.searchsorted(lines.text, np.arange(block.num_rows), side=s)
                       for s in ("left", "right"))
        keep = np.flatnonzero((last > first) & (last - first <= TRAIN_LINES))
        yield pa.RecordBatch.from_arrays(
            [block.column(1).take(pa.array(keep)),
             pa.array([lines.features[first[i]:last[i]].tobytes() for i in keep], pa.binary())],
            ["quality", "features"])


def fit(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> Field:
    """Fit on the ``train_docs`` labelled documents of least hash, half of each label."""
    marked = (labels.select(F.col("doc_id").alias("__id"), F.col("quality").cast("int").alias("quality"))
              .where("quality in (0, 1) and __id is not null")
              .groupBy("__id").agg(F.min("quality").alias("quality"))
              .withColumn("__h", F.xxhash64("__id")))
    sample = None
    for label in (0, 1):
        # a few more than asked for, as some have too many lines or are not in the table
        part = (marked.where(F.col("quality") == label).orderBy("__h", "__id").limit(train_docs))
        sample = part if sample is None else sample.unionByName(part)
    chosen = docs.select(F.col("doc_id").alias("__id"), "text").join(
        F.broadcast(sample), "__id").select("text", "quality")
    rows = chosen.mapInArrow(_features, "quality int, features binary").collect()
    texts = [np.frombuffer(r["features"]).reshape(-1, len(FEATURES)) for r in rows]
    quality = [r["quality"] for r in rows]
    if len(set(quality)) < 2:
        return DEFAULT
    by = {k: [i for i, q in enumerate(quality) if q == k][:train_docs // 2] for k in (0, 1)}
    order = sorted(by[0] + by[1], key=lambda i: (len(texts[i]), texts[i].tobytes()))
    return fit_field([texts[i] for i in order], [quality[i] for i in order])


def judge(column: pa.Array, field: Field) -> dict[str, np.ndarray]:
    """Statistics and verdicts of a block of texts."""
    lines = measure(column)
    labels = viterbi(lines.text, lines.features @ field.weights, field.transitions)
    s = lines.stats
    content = np.bincount(lines.text, lines.words * labels, len(s["n_words"])).astype(np.int64)
    failed = (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > MAX_REPEAT_PERCENT * s["n_words"])
    return s | {"n_content_words": content, "base_failed": failed,
                "kept": ~failed & (content >= CONTENT_SHARE * s["n_words"])}


def quality_rules(docs: DataFrame, field: Field) -> DataFrame:
    """Statistics, content words and verdict per row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", BLOCK):
            found = judge(block.column(1), field)
            yield pa.RecordBatch.from_arrays([block.column(0), *map(pa.array, found.values())],
                                             ["doc_id", *found])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {OUT}")


def keep_clean(docs: DataFrame, field: Field) -> DataFrame:
    """The rows of ``docs`` that pass, all columns unchanged."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", BLOCK):
            text = block.column(block.schema.get_field_index("text"))
            yield block.filter(pa.array(judge(text, field)["kept"]))
    return docs.mapInArrow(run, docs.schema)
