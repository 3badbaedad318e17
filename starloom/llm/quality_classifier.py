"""Quality classifier: supervised subword embeddings.

Words, pairs of words and character n-grams are hashed to rows of a table of vectors. The
vectors of a document are averaged over all its features and a softmax layer gives the
classes. Vectors and layer are learned together by stochastic gradient descent in numpy on
a bounded sample of labelled documents. Because the layer is linear in the average, a
fitted model scores a document by the average of one number per feature.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.batches import add_text_columns
from starloom.llm.words import BASE, BYTE_VALUES, Stretches, Words, find_words

BUCKET_BITS = 17
DIMENSIONS = 8
GRAMS = (3, 4, 5)
# Passes over the sample, at least so many and at least so many documents in all.
EPOCHS, LEAST_STEPS = 5, 12_000
RATE = 0.5
# Most labelled documents that the model is fitted on, and most bytes of their text.
SAMPLE_ROWS, SAMPLE_BYTES = 2500, 32 << 20
# Texts of more than this share of the bytes come last, by their length.
LARGE = 1 / 32
THRESHOLD = 0.7


@dataclass(frozen=True)
class Model:
    """``logits[f]``: what feature f adds to the log odds of class 1, before averaging."""

    logits: np.ndarray
    bias: float


def features(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashed features, family by family: those of all texts in a row, and where each text begins."""
    words: Words = find_words(texts)
    shift, spread = np.uint64(64 - BUCKET_BITS), np.uint64(BASE)
    stretches = Stretches(BYTE_VALUES[words.content])
    hashes = stretches.hashes(words.begins, words.ends)
    yield hashes >> shift, words.starts

    # Neighbouring words; a word said twice is a feature of its own, whatever the word.
    inner = np.ones(len(hashes) + 1, bool)
    inner[words.starts] = False
    both = np.flatnonzero(inner[:-1])  # words with another one before them
    pairs = hashes[both - 1] * np.uint64(3) + hashes[both]
    pairs[hashes[both - 1] == hashes[both]] = 1
    yield (pairs * spread) >> shift, np.searchsorted(both, words.starts)

    # Character n-grams begin and end at a character, and reach over the spaces at a word's
    # sides, so that beginnings and ends differ from what is inside.
    chars = np.flatnonzero((words.content & 0xC0) != 0x80)
    bounds = np.append(chars, len(words.content))
    texts_at = np.searchsorted(chars, words.bounds)
    owner = words.owner
    first = np.maximum(np.searchsorted(chars, words.begins) - 1, texts_at[owner])
    last = np.minimum(np.searchsorted(chars, words.ends) + 1, texts_at[owner + 1])
    # The end of the word that a character belongs to, or that it stands before.
    word_end = np.zeros(len(chars), np.int64)
    word_end[first] = last
    np.maximum.accumulate(word_end, out=word_end)
    room = word_end - np.arange(len(chars))
    for size in GRAMS:
        at = np.flatnonzero(room >= size)
        grams = stretches.raw(bounds[at], bounds[at + size])
        yield (grams * spread) >> shift, np.searchsorted(at, texts_at)


def score(texts: pa.Array, model: Model) -> np.ndarray:
    """Probability of class 1 for every text. A text without words has the model's prior."""
    sums, sizes = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
    for found, starts in features(texts):
        running = np.concatenate([[0.0], np.cumsum(model.logits[found], dtype=np.float64)])
        sums += running[starts[1:]] - running[starts[:-1]]
        sizes += np.diff(starts)
    return 1 / (1 + np.exp(-np.clip(sums / np.maximum(sizes, 1) + model.bias, -60, 60)))


def fit(texts: list[str], labels: np.ndarray, seed: int = 0) -> Model:
    """Stochastic gradient descent, one document a step, with a falling rate."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (1 << BUCKET_BITS, DIMENSIONS)).astype(np.float32)
    layer, bias = np.zeros((2, DIMENSIONS), np.float32), np.zeros(2, np.float32)
    layer[1] = rng.normal(0, 0.1, DIMENSIONS)
    examples = []
    for text in texts:
        found = np.concatenate([found for found, _ in features(pa.array([text], pa.string()))])
        rows, counts = np.unique(found, return_counts=True)
        examples.append((rows.astype(np.int32), (counts / max(len(found), 1)).astype(np.float32)))
    epochs = max(EPOCHS, -(-LEAST_STEPS // max(len(examples), 1)))
    steps, step = epochs * len(examples), 0
    for _ in range(epochs if examples else 0):
        for i in rng.permutation(len(examples)):
            rows, shares = examples[i]
            average = shares @ vectors[rows]
            logits = layer @ average + bias
            chances = np.exp(logits - logits.max())
            chances /= chances.sum()
            chances[labels[i]] -= 1
            rate = np.float32(RATE * (1 - step / steps))
            step += 1
            back = layer.T @ chances
            layer -= rate * np.outer(chances, average)
            bias -= rate * chances
            # Each vector moves by its share; dividing by the root of the squared shares makes
            # the step of a document independent of its length.
            scale = rate / max(float(shares @ shares), 1e-6) ** 0.5 if len(rows) else rate
            vectors[rows] -= scale * shares[:, None] * back
    return Model((vectors @ (layer[1] - layer[0])).astype(np.float32), float(bias[1] - bias[0]))


def sample_rows(labels: DataFrame, key: str = "doc_id", rows: int = SAMPLE_ROWS) -> DataFrame:
    """At most ``rows`` of the labelled keys, one row each, those with the least hash: the same in every run.

    Of several rows of a key the first one in the order of its other columns is taken.
    """
    others = [c for c in labels.columns if c != key]
    each = labels.groupBy(key).agg(F.min(F.struct(*others)).alias("_row")).select(key, *[F.col(f"_row.{c}") for c in others])
    return each.orderBy(F.xxhash64(F.col(key).cast("string")), key).limit(rows).select(*labels.columns)


def train_classifier(
    labelled: DataFrame, text: str = "text", label: str = "label", key: str = "doc_id", most_bytes: int = SAMPLE_BYTES
) -> Model:
    """Fit on the rows given, a bounded sample (``sample_rows``), in one task.

    Rows without a label or text are left out, and of several rows of a key the shortest text counts. Whole documents
    are taken in the order of the hash of their key until ``most_bytes`` of text are reached, texts above a small share
    of that after all others. They are chosen by key and length, and only the texts chosen, one per key, meet in
    the task. It returns the model; without any document it is undecided, 0.5 for every text.
    """
    usable = labelled.filter(F.col(label).isNotNull() & F.col(text).isNotNull()).select(
        F.col(key).cast("string").alias("key"),
        F.col(text).alias("text"),
        F.col(label).cast("int").alias("label"),
        F.octet_length(text).alias("size"),
        F.xxhash64(text).alias("mark"),
    )
    each = usable.groupBy("key").agg(F.min(F.struct("size", "mark", "label")).alias("at"))
    each = each.select("key", "at.*", F.xxhash64("key").alias("turn"))
    late = F.greatest("size", F.lit(int(most_bytes * LARGE)))
    # One short row per key of the sample, so this ordering without a key stays small.
    before = Window.orderBy(late, "turn", "key").rowsBetween(Window.unboundedPreceding, -1)
    chosen = each.withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0)))
    chosen = chosen.filter((F.col("before") == 0) | (F.col("before") + F.col("size") <= most_bytes))
    chosen = chosen.select(F.col("key").alias("own"), F.col("mark").alias("own_mark"), F.col("label").alias("own_label"), "before")
    on = F.col("key").eqNullSafe(F.col("own")) & (F.col("mark") == F.col("own_mark")) & (F.col("label") == F.col("own_label"))
    chosen = usable.join(F.broadcast(chosen), on).dropDuplicates(["own"])
    chosen = chosen.repartition(1).sortWithinPartitions("before", "own")

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        contents, marks = [], []
        for batch in batches:
            contents += batch.column(0).to_pylist()
            marks += batch.column(1).to_pylist()
        model = fit(contents, (np.array(marks, np.int64) > 0).astype(np.int64))
        yield pa.RecordBatch.from_arrays(
            [pa.array([model.logits.tobytes()], pa.binary()), pa.array([model.bias])], ["logits", "bias"]
        )

    fitted = chosen.select("text", "label").mapInArrow(train, "logits binary, bias double").first()
    if fitted is None:
        return Model(np.zeros(1 << BUCKET_BITS, np.float32), 0.0)
    return Model(np.frombuffer(bytes(fitted.logits), np.float32), fitted.bias)


def add_quality_score(df: DataFrame, model: Model, text: str = "text", score_name: str = "score") -> DataFrame:
    """Add the probability of class 1 for every whole text; null texts count as empty.

    The model, a number per bucket, goes to the executors in a broadcast of fixed size.
    """
    sent = df.sparkSession.sparkContext.broadcast((model.logits, model.bias))

    def make():
        fitted = Model(*sent.value)
        return lambda texts: {score_name: score(texts, fitted)}

    return add_text_columns(df, text, f"`{score_name}` double", make)
