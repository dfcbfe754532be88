"""Language identification with string kernels.

A text is the set of its byte n-grams, ``ORDERS`` long, blended (all lengths in one set, hashed into
``BINS`` bins); the kernel of two texts is the number of n-grams that both have, divided by the
geometric mean of their set sizes. ``LANDMARKS`` training texts give the Nyström approximation of
the kernel; on it one ridge regression per language is solved against the rest. Both steps
collapse into one matrix, so scoring is a product of a batch of presence rows with the
landmarks and one with that matrix.

Training uses at most ``SAMPLE`` different labelled texts, the same number for each language where there
are so many and all of a language that has fewer, chosen by the hash of the text; they reach the driver as n-gram sets of ``BINS``
bits. Everything else runs over all documents, whole texts, in the tasks.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; so is everything if there
is nothing to learn from; a row without id counts as not held out; repeated rows are predicted
alike; an empty table gives an empty result; columns other than doc_id, text and lang are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perkline.llm import tokens
from perkline.llm.sharding import text_key
from perkline.llm.shipping import ship_library
from perkline.llm.storage import stored

ORDERS = (1, 2, 3, 4)
BINS = 1 << 14
SAMPLE = 2000
LANDMARKS = 128
RIDGE = 1e-3
SHARPNESS = 4.0
AT_ONCE = 64
UNKNOWN = "und"

# ASCII letters in lower case, other ASCII as space, all else as it is.
_PLAIN = np.arange(256, dtype=np.uint64)
_PLAIN[:128] = 0x20
for _c in range(ord("a"), ord("z") + 1):
    _PLAIN[_c] = _PLAIN[_c - 32] = _c


def held_out(doc_id: Column) -> Column:
    """One of four folds of the documents, by the checksum of the id as text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def presence(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, rows of zeros and ones): which n-grams each text has."""
    for start, _, data, offsets in tokens.text_chunks(column):
        plain = _PLAIN[data]
        hashed = []
        for n in ORDERS:
            codes = np.zeros(max(0, len(plain) - n + 1), np.uint64)
            for i in range(n):
                codes = (codes << np.uint64(8)) | plain[i : i + len(codes)]
            codes = (codes + np.uint64(n << 40)) * np.uint64(tokens.BASE)
            hashed.append((codes >> np.uint64(64 - 14)).astype(np.int32))
        for low in range(0, len(offsets) - 1, AT_ONCE):
            high = min(low + AT_ONCE, len(offsets) - 1)
            rows = np.zeros((high - low, BINS), np.float32)
            for i in range(low, high):
                for n, bins in zip(ORDERS, hashed):
                    rows[i - low, bins[offsets[i] : max(offsets[i], offsets[i + 1] - n + 1)]] = 1
            yield start + low, rows


def kernel(rows: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Shared n-grams of all pairs, divided by the geometric mean of the set sizes."""
    norm = lambda x: np.sqrt(np.maximum(1, x.sum(axis=1)))
    return (rows @ others.T) / norm(rows)[:, None] / norm(others)[None, :]


class Model:
    """Landmarks and one column of weights per language."""

    def __init__(self, rows: np.ndarray, labels: list[str]):
        self.languages = sorted(set(labels))
        # Landmarks in turn from each language.
        turn: dict[str, int] = {}
        rank = []
        for label in labels:
            turn[label] = turn.get(label, 0) + 1
            rank.append((turn[label], label))
        chosen = sorted(range(len(labels)), key=lambda i: rank[i])[:LANDMARKS]
        self.landmarks = rows[chosen]
        inner = kernel(self.landmarks, self.landmarks).astype(np.float64)
        values, vectors = np.linalg.eigh(inner)
        kept = values > 1e-6 * values[-1]
        root = vectors[:, kept] / np.sqrt(values[kept])
        features = kernel(rows, self.landmarks) @ root
        wanted = np.where(np.array(labels)[:, None] == np.array(self.languages)[None, :], 1.0, -1.0)
        gram = features.T @ features + RIDGE * len(labels) * np.eye(features.shape[1])
        self.weights = (root @ np.linalg.solve(gram, features.T @ wanted)).astype(np.float32)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Between 0 and 1, adding up to 1 per row."""
        raw = SHARPNESS * (kernel(rows, self.landmarks) @ self.weights).astype(np.float64)
        raw = np.exp(raw - raw.max(axis=1, keepdims=True))
        return raw / raw.sum(axis=1, keepdims=True)


def train(docs: DataFrame, sample: int = SAMPLE) -> Model | None:
    """From the documents that are not held out and have a language; none without such documents."""
    ship_library(docs.sparkSession)
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    keyed = labelled.select("lang", "text", text_key(F.col("text")).alias("key"))
    # Copies of a text have one key, and count once.
    keys = stored(keyed.select("lang", "key").distinct(), "language-keys")
    n_languages = keys.select("lang").distinct().count()
    if not n_languages:
        return None
    each = max(1, sample // n_languages)
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("key"))
    # The smallest keys of each language, all of them where there are few; tasks pass on ``each`` at most.
    last = keys.withColumn("nth", nth).where(F.col("nth") <= each).groupBy("lang").agg(F.max("key").alias("last"))
    below = F.lit(-1).cast("long")
    for r in last.collect():
        below = F.when(F.col("lang") == r["lang"], F.lit(r["last"])).otherwise(below)
    picked = keyed.where(F.col("key") <= below)
    picked = picked.groupBy("lang", "key").agg(F.first("text").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [np.packbits(row > 0).tobytes() for _, rows in presence(batch.column("text")) for row in rows]
            yield pa.record_batch([batch.column("lang"), batch.column("key"), pa.array(bits, pa.binary())], names=["lang", "key", "bits"])

    # At most ``sample`` texts of BINS / 8 bytes (one per language if there are more languages).
    found = picked.mapInArrow(work, "lang string, key long, bits binary").collect()
    rows, labels = [], []
    for r in sorted(found, key=lambda r: (r["key"], r["lang"])):
        rows.append(np.unpackbits(np.frombuffer(bytes(r["bits"]), np.uint8)).astype(np.float32))
        labels.append(r["lang"])
    return Model(np.stack(rows), labels)


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, lang_pred and score."""
    ship_library(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # LANDMARKS rows of BINS numbers

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            column = batch.column("text")
            names, scores = [UNKNOWN] * len(column), np.zeros(len(column))
            for first, rows in presence(column) if known is not None else ():
                got = known.scores(rows)
                best = got.argmax(axis=1)
                for i, b in enumerate(best):
                    text = column[first + i].as_py()
                    if text and any(c.isalpha() for c in text):
                        names[first + i] = known.languages[b]
                        scores[first + i] = got[i, b]
            yield pa.record_batch([batch.column("doc_id"), pa.array(names), pa.array(scores)], names=["doc_id", "lang_pred", "score"])

    fields = [docs.schema["doc_id"], *T.StructType.fromDDL("lang_pred string, score double").fields]
    return docs.select("doc_id", "text").mapInArrow(work, T.StructType(fields))
