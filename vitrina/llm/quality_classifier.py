"""Quality classifier: random-indexing word vectors, pooled, and a two-layer network.

Words are hashed.  A hash spells an index vector of +1 and -1.  A word's vector is its own
index vector plus, by random indexing, the sum of the index vectors of its neighbours in the
training texts; the table of these sums has a fixed number of buckets.  The ending of a word and
each triple of words have index vectors as well.  A document is the mean of its vectors,
their lengths (a mean over many equal vectors stays long, so they measure repetition), and
the logarithm of its number of words.

The network is trained on at most ``sample`` labelled documents, the first in a hashed order;
that is the only bound, and it bounds what reaches the driver.  A temperature is fitted on
labelled documents that the network has not seen.  Every whole text is scored.

Learning uses only rows whose crc32(id as text) mod 5 is not 0.  The id decides nothing else.

Defined results
  null, empty text     a score like any other: that of a text without words
  null id              held out: such rows are never learned from
  null label           not learned from; repeated labels of an id count once, the largest
  repeated ids         of their texts the smallest is learned from; each is scored
  repeated rows        equal scores
  no labels of a kind  every score is the share of label 1, or 0.5 without labels
  empty table          empty result
  extra columns        ``scores`` ignores them; ``accepted`` returns them
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrina.llm.text import texts
from vitrina.session import stored

FOLDS = 5
THRESHOLD = 0.3
SAMPLE = 6000
DIM = 64
BUCKETS = 1 << 12
WINDOW = 2
HIDDEN = 32
PIECE = 1 << 20  # bytes of a text that are pooled at a time
ROWS = 1 << 15  # vectors that are unpacked at a time

_PRIME = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
PARTS = 3  # words, endings, triples
FEATURES = PARTS * DIM + PARTS + 1


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX
    x = (x ^ (x >> np.uint64(27))) * _PRIME
    return x ^ (x >> np.uint64(31))


def word_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and of its last three bytes."""
    raw = np.frombuffer(text, dtype=np.uint8)
    edges = np.diff(np.concatenate(([0], (~_SPACE[raw]).view(np.int8), [0])))
    begin, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    if not len(begin):
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    # Scrambled bytes by their place in the word, added up for all words in one pass.
    starts = np.zeros(len(raw), dtype=np.int64)
    starts[begin] = begin
    place = np.arange(len(raw)) - np.maximum.accumulate(starts)
    scrambled = _mixed(raw.astype(np.uint64) + (place.astype(np.uint64) << np.uint64(8)))
    scrambled[_SPACE[raw]] = 0
    words = _mixed(np.add.reduceat(scrambled, begin))
    tail = np.zeros(len(begin), dtype=np.uint64)
    for back in range(1, 4):
        at = end - back
        tail = tail << np.uint64(8) | np.where(at >= begin, raw[np.maximum(at, 0)], 0).astype(np.uint64)
    return words, _mixed(tail + _PRIME)


def index_vectors(hashes: np.ndarray) -> np.ndarray:
    """The +1 and -1 that a hash spells, as 0 and 1 bits."""
    return np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1)[:, :DIM]


def _signed_sum(hashes: np.ndarray) -> np.ndarray:
    """Sum of index vectors."""
    total = np.zeros(DIM)
    for begin in range(0, len(hashes), ROWS):
        part = hashes[begin : begin + ROWS]
        total += 2.0 * index_vectors(part).sum(axis=0, dtype=np.int64) - len(part)
    return total


def _triples(words: np.ndarray) -> np.ndarray:
    return _mixed(words[:-2] + _mixed(words[1:-1] + _mixed(words[2:]))) if len(words) > 2 else words[:0]


def _buckets(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(40)).astype(np.int64) % BUCKETS


def _pieces(text: bytes) -> Iterator[bytes]:
    """The text in bounded pieces that end at white space, where there is any."""
    begin = 0
    while len(text) - begin > PIECE:
        end = max(text.rfind(b" ", begin, begin + PIECE), text.rfind(b"\n", begin, begin + PIECE))
        end = begin + PIECE if end <= begin else end
        yield text[begin:end]
        begin = end
    yield text[begin:]


def pooled(text: bytes, contexts: np.ndarray) -> np.ndarray:
    """The features of one text; ``contexts`` has a row of context sums per bucket."""
    sums = np.zeros((PARTS, DIM))
    counts = np.zeros(PARTS)
    for piece in _pieces(text):
        words, endings = word_hashes(piece)
        triples = _triples(words)
        near = np.zeros(DIM)
        for begin in range(0, len(words), ROWS):
            near += contexts[_buckets(words[begin : begin + ROWS])].sum(axis=0)
        sums += _signed_sum(words) + near, _signed_sum(endings), _signed_sum(triples)
        counts += len(words), len(endings), len(triples)
    means = sums / np.maximum(counts, 1)[:, None]
    # Squared length of a mean of n vectors, in units of what n different vectors would have.
    lengths = np.log((means**2).mean(axis=1) * np.maximum(counts, 1) + 0.1)
    return np.concatenate((means.ravel(), lengths, [np.log1p(counts[0])])).astype(np.float32)


def _context_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: for each bucket, the summed index vectors of its words' neighbours, and its count."""
    table = np.zeros((BUCKETS, DIM + 1))
    for batch in batches:
        for text in texts(batch, "text"):
            for piece in _pieces(text):
                words = word_hashes(piece)[0]
                at = _buckets(words)
                np.add.at(table[:, DIM], at, 1)
                for begin in range(0, len(words), ROWS):
                    part = 2.0 * index_vectors(words[begin : begin + ROWS + WINDOW]) - 1
                    here = at[begin : begin + len(part)]
                    for step in range(1, WINDOW + 1):
                        np.add.at(table[:, :DIM], here[step:], part[:-step])
                        np.add.at(table[:, :DIM], here[:-step], part[step:])
    yield pa.RecordBatch.from_arrays([pa.array([table.astype(np.float32).tobytes()])], ["table"])


@dataclass
class Model:
    """Context vectors, scaling, both layers and the temperature."""

    contexts: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]
    temperature: float
    constant: float | None = None

    def logits(self, features: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.tanh((features - self.mean) / self.scale @ w1 + b1) @ w2 + b2

    def scores(self, features: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(features), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.logits(features) / self.temperature, -30, 30)))


def _train(x: np.ndarray, y: np.ndarray, rounds: int = 400, rate: float = 0.01, decay: float = 1e-3) -> list[np.ndarray]:
    """Full-batch Adam on the cross-entropy, seeded."""
    draw = np.random.default_rng(7)
    sizes = [(x.shape[1], HIDDEN), (HIDDEN,), (HIDDEN,), ()]
    layers = [draw.normal(0, 1 / np.sqrt(s[0]), s) if i % 2 == 0 else np.zeros(s) for i, s in enumerate(sizes)]
    first, second = [np.zeros(s) for s in sizes], [np.zeros(s) for s in sizes]
    for step in range(1, rounds + 1):
        w1, b1, w2, b2 = layers
        hidden = np.tanh(x @ w1 + b1)
        error = (1 / (1 + np.exp(-np.clip(hidden @ w2 + b2, -30, 30))) - y) / len(y)
        back = np.outer(error, w2) * (1 - hidden**2)
        slopes = [x.T @ back + decay * w1, back.sum(axis=0), hidden.T @ error + decay * w2, error.sum()]
        for i, slope in enumerate(slopes):
            first[i] = 0.9 * first[i] + 0.1 * slope
            second[i] = 0.999 * second[i] + 0.001 * slope**2
            unbiased = second[i] / (1 - 0.999**step)
            layers[i] = layers[i] - rate * first[i] / (1 - 0.9**step) / (np.sqrt(unbiased) + 1e-8)
    return layers


def _temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits with the smallest cross-entropy, from a fine grid."""
    grid = np.geomspace(0.25, 8, 61)

    def loss(t: float) -> float:
        return float(np.mean(np.logaddexp(0, logits / t) - y * logits / t))

    return float(min(grid, key=loss)) if len(y) else 1.0


def fold(id_: Column) -> Column:
    """crc32 of the id as text, mod 5; null for a null id."""
    return F.pmod(F.crc32(id_.cast("string").cast("binary")), F.lit(FOLDS))


def fit(docs: DataFrame, labels: DataFrame, id_column: str, text_column: str, label: str, sample: int) -> Model:
    """Train on labelled documents outside fold 0; of these, fold 1 only sets the temperature."""
    id_ = F.col(id_column)
    chosen = labels.where(F.col(label).isNotNull() & (fold(id_) != 0)).groupBy(id_.alias("id"))
    chosen = chosen.agg(F.max(label).cast("int").alias("label")).orderBy(F.md5(F.col("id").cast("string"))).limit(sample)
    texts_ = docs.select(id_.alias("id"), F.col(text_column).alias("text"))
    # At most ``sample`` rows of an id and a label.
    known = texts_.join(F.broadcast(chosen), "id").groupBy("id", "label").agg(F.min("text").alias("text"))
    # Stored, so that all tasks search the documents, once, and few tasks read the bounded rest.
    known = stored(known, "labelled")
    tables = known.select("text").coalesce(8).mapInArrow(_context_sums, "table binary").collect()
    counts = np.zeros((BUCKETS, DIM + 1))
    for row in tables:
        counts += np.frombuffer(row.table, np.float32).reshape(counts.shape)
    contexts = (counts[:, :DIM] / np.maximum(counts[:, DIM:], 1)).astype(np.float32)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [pooled(text, contexts).tobytes() for text in texts(batch, "text")]
            columns = [batch.column("id"), batch.column("label"), pa.array(rows, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "label", "features"])

    shown = known.select(F.col("id").cast("string").alias("id"), "label", "text")
    found = shown.mapInArrow(features, "id string, label int, features binary")
    rows = sorted(found.withColumn("fold", fold(F.col("id"))).collect(), key=lambda row: row.id)
    y = np.array([row.label for row in rows], dtype=float)
    none = [np.zeros((FEATURES, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), np.zeros(())]
    if len(set(y)) < 2:
        share = float(y.mean()) if len(y) else 0.5
        return Model(contexts, np.zeros(FEATURES), np.ones(FEATURES), none, 1.0, share)
    x = np.array([np.frombuffer(row.features, np.float32) for row in rows], dtype=float)
    tune = np.array([row.fold == 1 for row in rows])
    if len(set(y[~tune])) < 2:
        tune[:] = False
    mean, scale = x[~tune].mean(axis=0), x[~tune].std(axis=0) + 1e-3
    model = Model(contexts, mean, scale, _train((x[~tune] - mean) / scale, y[~tune]), 1.0)
    model.temperature = _temperature(model.logits(x[tune]), y[tune])
    return model


def _scored(docs: DataFrame, model: Model, text_column: str, keep: list[str], score: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [pooled(text, model.contexts) for text in texts(batch, at)]
            if rows:
                columns = [batch.column(i) for i in range(len(keep))]
                found = pa.array(model.scores(np.array(rows, dtype=float)))
                yield pa.RecordBatch.from_arrays([*columns, found], names=[*keep, score])

    # The text comes last if it is not kept anyway.
    at = (keep + [text_column]).index(text_column)
    chosen = docs.select(*keep) if at < len(keep) else docs.select(*keep, text_column)
    schema = ", ".join(f"`{name}` {docs.schema[name].dataType.simpleString()}" for name in keep)
    return chosen.mapInArrow(run, f"{schema}, `{score}` double")


def scores(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label: str = "quality",
    threshold: float = THRESHOLD,
    sample: int = SAMPLE,
) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    model = fit(docs, labels, id_column, text_column, label, sample)
    found = _scored(docs, model, text_column, [id_column], "__score")
    score = F.col("__score")
    return found.select(
        F.col(id_column).alias("doc_id"),
        F.coalesce(fold(F.col(id_column)) == 0, F.lit(True)).alias("held_out"),
        score.alias("score"),
        F.when(score >= threshold, 1).otherwise(0).alias("predicted"),
    )


def accepted(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label: str = "quality",
    threshold: float = THRESHOLD,
    sample: int = SAMPLE,
) -> DataFrame:
    """The input rows whose score reaches the threshold, with all their columns."""
    model = fit(docs, labels, id_column, text_column, label, sample)
    found = _scored(docs, model, text_column, docs.columns, "__score")
    return found.where(F.col("__score") >= threshold).drop("__score")
