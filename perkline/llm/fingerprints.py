"""Fingerprints of documents by locally consistent parsing.

A text is a sequence of symbols, at first its bytes. A run of one symbol becomes one symbol, so
neighbours differ. Deterministic coin tossing then labels every symbol with the place and value of the
lowest bit in which it differs from its predecessor; a few rounds of the same on the labels, and a last
step that looks at both neighbours, leave three labels, never two equal ones side by side. A phrase
starts at every local maximum, so it has two to four symbols, and its name is a hash of them. The
names are the symbols of the next level, up to a single one, the name of the whole text.

Where a phrase starts depends on a handful of symbols around it and on nothing else. So equal
substrings are cut alike at every level, but for a few phrases at their ends, wherever they stand.
The fingerprint is the name of the text, and of its phrases of level 3 (about 15
characters; an occurrence is told from the next) the number and the ``SLOTS`` smallest hashes; texts with few of
them also give those of level 1. The likeness of two fingerprints estimates the share of common phrases,
2 * common / (one + other).

Defined cases: null is empty; equal texts have equal fingerprints and likeness 1; an empty text is
like nothing but another empty one; documents go by descending id, those without id last, ties by a
hash of the text; repeated rows follow each other; a text of any length is parsed whole, in memory in
proportion to the longest single text; no rows give no rows. Columns other than id and text are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from perkline.llm.shipping import ship_library
from perkline.llm.storage import stored
from perkline.llm.tokens import BASE, CHUNK_BYTES, mixed

SLOTS = 48
LEVEL, LOW_LEVEL = 3, 1
FEW, MANY = 8, 16  # phrases of LEVEL below which the lower one is compared, and below which it is kept
RUN_STEPS = (16, 6, 2)  # so many repeats of a symbol of level 0, 1, 2 in a run are about as long as a phrase
SYMBOLS = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))


def collapse_runs(symbols: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of one symbol become one, named by the symbol and the length. ``ends`` bound the texts (first: 0).

    Returns the new symbols and bounds, and the old symbol and the length of each run.
    """
    first = np.ones(len(symbols), bool)
    first[1:] = symbols[1:] != symbols[:-1]
    first[ends[:-1][ends[:-1] < ends[1:]]] = True
    starts = np.flatnonzero(first)
    lengths = np.diff(starts, append=len(symbols))
    kept = symbols[starts]
    out = kept.copy()
    runs = lengths > 1
    out[runs] = mixed(out[runs] * np.uint64(BASE) + lengths[runs].astype(np.uint64))
    return out, np.searchsorted(starts, ends), kept, lengths


def _tossed(values: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Twice the lowest bit that differs from the predecessor, plus its value. A text's first value has an opposite predecessor."""
    before = np.empty_like(values)
    before[1:] = values[:-1]
    before[heads] = ~values[heads]
    differs = values ^ before
    one = values.dtype.type(1)
    low = np.bitwise_count((differs & (~differs + one)) - one)
    return (2 * low + ((values >> low.astype(values.dtype)) & one).astype(np.uint8)).astype(np.uint8)


def labelled(symbols: np.ndarray, heads: np.ndarray, tails: np.ndarray) -> np.ndarray:
    """0, 1 or 2 for every symbol, different from its neighbours'. Neighbouring symbols of a text differ."""
    labels = _tossed(symbols, heads)  # below 128
    for _ in range(3):  # below 14, 8, 6
        labels = _tossed(labels, heads)
    none = np.uint8(255)
    for value in (3, 4, 5):
        at = np.flatnonzero(labels == value)
        left, right = labels[at - 1], labels[np.minimum(at + 1, len(labels) - 1)]
        left[np.isin(at, heads, assume_unique=True)] = none
        right[np.isin(at, tails, assume_unique=True)] = none
        free = [(left != v) & (right != v) for v in (0, 1)]
        labels[at] = np.where(free[0], 0, np.where(free[1], 1, 2))
    return labels


def phrases(symbols: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One level up: names of phrases, and the bounds of the texts. Every text has two symbols at least."""
    heads, tails = ends[:-1], ends[1:] - 1
    labels = labelled(symbols, heads, tails)
    top = np.zeros(len(symbols), bool)
    top[1:-1] = (labels[1:-1] > labels[:-2]) & (labels[1:-1] > labels[2:])
    top[tails] = False
    top[heads] = True
    starts = np.flatnonzero(top)
    lengths = np.diff(starts, append=len(symbols))
    names = lengths.astype(np.uint64)
    for i in range(int(lengths.max())):
        longer = lengths > i
        names[longer] = names[longer] * np.uint64(BASE) + mixed(symbols[starts[longer] + i])
    return mixed(names), np.searchsorted(starts, ends)


def parsed(texts: list[bytes]) -> tuple[np.ndarray, dict[int, tuple[np.ndarray, np.ndarray]]]:
    """The name of every text, and for both levels of the fingerprint (number of the text, name) of all phrases.

    A run below level 3 leaves one phrase of any length there, so it adds its symbol as often as is in proportion.
    """
    lengths = np.array([len(t) for t in texts], np.int64)
    names, levels = np.zeros(len(texts), np.uint64), {}
    owners = np.flatnonzero(lengths)
    ends = np.concatenate([[0], np.cumsum(lengths[owners])])
    symbols = SYMBOLS[np.frombuffer(b"".join(texts), np.uint8)]
    level, repeated = 0, []
    while len(owners):
        symbols, ends, kept, lengths = collapse_runs(symbols, ends)
        sizes = np.diff(ends)
        if level < LEVEL:
            times = lengths // RUN_STEPS[level]
            repeated.append((np.repeat(np.repeat(owners, sizes), times), np.repeat(kept, times)))
        done = sizes == 1
        names[owners[done]] = symbols[ends[:-1][done]]
        symbols = symbols[np.repeat(~done, sizes)]
        owners, sizes = owners[~done], sizes[~done]
        if not len(owners):
            break
        symbols, ends = phrases(symbols, np.concatenate([[0], np.cumsum(sizes)]))
        level += 1
        if level in (LOW_LEVEL, LEVEL):
            levels[level] = np.repeat(owners, np.diff(ends)), symbols
    if repeated:
        parts = [levels[LEVEL], *repeated] if LEVEL in levels else repeated
        levels[LEVEL] = tuple(np.concatenate(columns) for columns in zip(*parts))
    return names, levels


def _sketches(owners: np.ndarray, names: np.ndarray, n: int) -> list[tuple[int, np.ndarray]]:
    """For each of ``n`` texts the number of its phrases and the smallest of their 32-bit hashes.

    The second, third, … occurrence of a phrase in a text has a hash of its own.
    """
    text = owners.astype(np.uint64) << np.uint64(32)
    found = np.sort(text | (mixed(names) >> np.uint64(32)))
    new = np.ones(len(found), bool)
    new[1:] = found[1:] != found[:-1]
    starts = np.flatnonzero(new)
    occurrence = np.arange(len(found)) - np.repeat(starts, np.diff(starts, append=len(found)))
    hashes = mixed((found << np.uint64(32)) + (occurrence.astype(np.uint64) + np.uint64(1)) * np.uint64(BASE))
    found = np.sort((found >> np.uint64(32) << np.uint64(32)) | (hashes >> np.uint64(32)))
    bounds = np.searchsorted(found, np.arange(n + 1, dtype=np.uint64) << np.uint64(32))
    low = found.astype(np.uint32)
    return [(int(e - s), low[s : min(e, s + SLOTS)]) for s, e in zip(bounds[:-1], bounds[1:])]


def fingerprints(texts: list[bytes]) -> list[bytes]:
    """Name of the text (8 bytes), then for level 3, and for level 1 where it is kept: size and number of hashes (4 bytes each), hashes."""
    names, levels = parsed(texts)
    none = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    main = _sketches(*levels.get(LEVEL, none), len(texts))
    owners, low_names = levels.get(LOW_LEVEL, none)
    short = np.array([size < MANY for size, _ in main], bool)
    kept = short[owners]
    low = _sketches(owners[kept], low_names[kept], len(texts))
    pack = lambda size, hashes: np.array([size, len(hashes)], ">u4").tobytes() + hashes.astype(">u4").tobytes()
    return [
        int(name).to_bytes(8, "big") + pack(*main[i]) + (pack(*low[i]) if short[i] else b"")
        for i, name in enumerate(names)
    ]


def _unpacked(fingerprint: bytes) -> list[tuple[int, np.ndarray]]:
    out, at = [], 8
    while at < len(fingerprint):
        size, count = np.frombuffer(fingerprint, ">u4", 2, at)
        out.append((int(size), np.frombuffer(fingerprint, ">u4", count, at + 8)))
        at += 8 + 4 * int(count)
    return out


def likeness(one: bytes, other: bytes) -> float:
    """Estimated share of common phrases, from 0 to 1."""
    if one[:8] == other[:8]:
        return 1.0
    a, b = _unpacked(one), _unpacked(other)
    level = 1 if min(a[0][0], b[0][0]) < FEW and len(a) == len(b) == 2 else 0
    (size_a, hashes_a), (size_b, hashes_b) = a[level], b[level]
    if not size_a or not size_b:
        return 0.0
    union = np.union1d(hashes_a, hashes_b)
    if size_a > SLOTS or size_b > SLOTS:
        union = union[:SLOTS]  # the smallest of both sets together
    common = np.isin(union, hashes_a) & np.isin(union, hashes_b)
    jaccard = common.sum() / len(union)
    return float(2 * jaccard / (1 + jaccard))


def edited(text: str, following: str) -> str:
    """The last third of the characters replaced by the first as many of the following text."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


RESULT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.binary()),
        ("edited_fingerprint", pa.binary()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
        ("part", pa.int32()),
        ("first", pa.bool_()),
        ("last", pa.bool_()),
        ("text", pa.string()),
    ]
)
SCHEMA = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("n_chars", LongType()),
        StructField("edited_sha256", StringType()),
        StructField("fingerprint", BinaryType()),
        StructField("edited_fingerprint", BinaryType()),
        StructField("near_edited", DoubleType()),
        StructField("near_next", DoubleType()),
        StructField("part", IntegerType()),
        StructField("first", BooleanType()),
        StructField("last", BooleanType()),
        StructField("text", StringType()),
    ]
)


def _compared(texts: list[str], prints: list[bytes], following: list[str], next_prints: list[bytes]) -> dict[str, list]:
    changed = [edited(t, f).encode() for t, f in zip(texts, following)]
    changed_prints = fingerprints(changed)
    return {
        "n_chars": [len(t) for t in texts],
        "edited_sha256": [hashlib.sha256(c).hexdigest() for c in changed],
        "fingerprint": prints,
        "edited_fingerprint": changed_prints,
        "near_edited": [likeness(a, b) for a, b in zip(prints, changed_prints)],
        "near_next": [likeness(a, b) for a, b in zip(prints, next_prints)],
    }


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts, about CHUNK_BYTES of them at a time."""
    for batch in batches:
        ids, texts, size = [], [], 0
        for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
            text = text.as_py() or ""
            ids.append(doc_id.as_py())
            texts.append(text)
            size += len(text)
            if size >= CHUNK_BYTES:
                yield ids, texts
                ids, texts, size = [], [], 0
        if ids:
            yield ids, texts


def _along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order, each compared with the next; the last one of the task is left open.

    The texts of the task's first and last row are given along, so that the open rows can be closed.
    """
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    waiting = None  # id, text and fingerprint of the last row so far
    first = True

    def rows(ids, columns, **ends) -> pa.RecordBatch:
        n = len(ids)
        more = {"doc_id": ids, "part": [part] * n, "first": [False] * n, "last": [False] * n, "text": [None] * n}
        more.update(columns)
        more.update(ends)
        columns = [pa.array(more.get(f.name, [None] * n), f.type) for f in RESULT]
        return pa.RecordBatch.from_arrays(columns, schema=RESULT)

    for ids, texts in _stretches(batches):
        prints = fingerprints([t.encode() for t in texts])
        if first:
            yield rows([ids[0]], {"fingerprint": prints[:1]}, first=[True], text=[texts[0]])
            first = False
        if waiting is not None:
            ids, texts, prints = [waiting[0], *ids], [waiting[1], *texts], [waiting[2], *prints]
        waiting = ids[-1], texts[-1], prints[-1]
        if len(ids) > 1:
            yield rows(ids[:-1], _compared(texts[:-1], prints[:-1], texts[1:], prints[1:]))
    if waiting is not None:
        yield rows([waiting[0]], {"fingerprint": [waiting[2]]}, last=[True], text=[waiting[1]])


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Closes the open rows: the last of each task with the first of the next."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    schema = pa.schema([RESULT.field(n) for n in names])
    for batch in batches:
        for i in range(batch.num_rows):  # a text or two of any length at a time
            row = batch.slice(i, 1).to_pydict()
            done = _compared(row["text"], row["fingerprint"], row["next_text"], row["next_fingerprint"])
            done["doc_id"] = row["doc_id"]
            yield pa.RecordBatch.from_arrays([pa.array(done[f.name], f.type) for f in schema], schema=schema)


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and their likeness, and the likeness to the next document.

    The next document is the one with the next smaller id; the last one's is the first. Texts are
    moved once, into id order; only a task's first and last text are handed on.
    """
    spark = docs.sparkSession
    ship_library(spark)
    wanted = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    keyed = wanted.withColumns({"_text": F.xxhash64("text"), "_row": F.monotonically_increasing_id()})
    order = [F.col("doc_id").desc_nulls_last(), F.col("_text").asc(), F.col("_row").asc()]
    placed = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    rows = stored(placed.mapInArrow(_along, SCHEMA), "fingerprints")

    # One number per task that had rows; each task's last row goes on with the next one's first.
    parts = sorted(r["part"] for r in rows.where("last").select("part").collect())
    pairs = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part int, next int")
    heads = rows.where("first").select(
        F.col("part").alias("next"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_fingerprint")
    )
    tails = rows.where("last").select("part", "doc_id", "text", "fingerprint").join(pairs, "part").join(heads, "next")
    schema = StructType(SCHEMA.fields[:7])
    closed = tails.select("doc_id", "text", "fingerprint", "next_text", "next_fingerprint").mapInArrow(_across, schema)
    return rows.where("not first and not last").select(*schema.names).unionByName(closed)
