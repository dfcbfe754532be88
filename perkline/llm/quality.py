"""Quality rules: counts of a text, and lines that too many documents of a host share.

Base rules look at one text: too few words, or too many of its words in five-word windows that
repeat inside it. The method proper looks across documents. Lines are normalised (runs of
anything but letters and digits become one space, lower case) and hashed; for every host the
distinct documents of each line are counted. Lines above the host's limit are removed, and a
document is rejected if too little of it is left.

"Distinct documents" are counted exactly: one for each different set of normalised lines of a host. Copies, also
those with lines in another order, count once; texts that differ in a word are different documents, as near
copies are another step's business. The limit is a share of the host's distinct documents.

Defined cases: a null text is empty and fails; lines without a letter or digit are never counted
or removed; a missing host is a host of its own; repeated rows count as copies; of equal lines in a text all
go or stay; a text of any length is measured whole, its lines in memory; an empty table gives an empty
result; other columns are kept and ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perkline.llm import tokens
from perkline.llm.names import unused
from perkline.llm.shipping import ship_library
from perkline.llm.storage import stored

WINDOW = 5
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
SYMBOLS = "#*$%&|<>"
MIN_DOCUMENTS = 10  # a line of fewer different documents of a host is never removed
MAX_SHARE = 0.10  # of a host's documents
MIN_LEFT_PERCENT = 20  # of a document's words

_IS_SYMBOL = np.zeros(256, np.int64)
_IS_SYMBOL[[ord(c) for c in SYMBOLS]] = 1
_STARTS_CODE_POINT = (np.arange(256) & 0xC0) != 0x80
_IS_WORD_CODE_POINT = (_STARTS_CODE_POINT & tokens.NOT_SPACE).astype(np.int64)
_SEPARATORS = re.compile(r"[\W_]+")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LINES = "line_hashes array<long>, line_words array<long>, host string"
_COUNTS = "key long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def document_key() -> Column:
    return F.xxhash64(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")))


def _named(host: str) -> Column:
    """The host as a text that is never null: a missing host differs from an empty one."""
    return F.coalesce(F.concat(F.lit("="), F.col(host).cast("string")), F.lit(""))


def _plain(line: str) -> str:
    return _SEPARATORS.sub(" ", line).strip().lower()


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def line_hash(line: str) -> int | None:
    """Of the normalised line; none if nothing is left of it."""
    plain = _plain(line)
    return _hash(plain) if plain else None


def _repeated_words(grams: np.ndarray, n_words: int) -> int:
    """Words inside windows that occur twice or more among ``grams``, the windows of one text."""
    order = np.argsort(grams, kind="stable")
    same = grams[order][1:] == grams[order][:-1]
    if not same.any():
        return 0
    found = np.zeros(len(grams), bool)
    found[order[1:][same]] = True
    found[order[:-1][same]] = True
    step = np.zeros(n_words + 1, np.int64)
    at = np.flatnonzero(found)
    np.add.at(step, at, 1)
    np.add.at(step, at + WINDOW, -1)
    return int((np.cumsum(step[:-1]) > 0).sum())


def _lines(text: str) -> tuple[int, list[int], list[int]]:
    """Repeated lines, and hash and words of each different normalised line."""
    seen: set[str] = set()
    repeated, words = 0, {}
    for line in text.split("\n"):
        n = len(_WORD.findall(line))
        if not n:
            continue
        if line in seen:
            repeated += 1
        seen.add(line)
        plain = _plain(line)
        if plain:
            h = _hash(plain)
            words[h] = words.get(h, 0) + n
    return repeated, list(words), list(words.values())


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column("text")
        columns: list[list] = [[] for _ in range(5)]
        hashes, words = [], []
        for first, last, data, offsets in tokens.text_chunks(column):
            starts, ends, rows = tokens.word_bounds(data, offsets)
            grams = tokens.gram_hashes(tokens.word_hashes(data, starts, ends, lower=False), WINDOW)
            sums = [np.concatenate([[0], np.cumsum(x[data])]) for x in (_IS_WORD_CODE_POINT, _IS_SYMBOL)]
            n_words = np.diff(rows)
            columns[0] += n_words.tolist()
            for total, out in zip(sums, columns[1:3]):
                out += (total[offsets[1:]] - total[offsets[:-1]]).tolist()
            for i in range(last - first):
                repeated, line_hashes, line_words = _lines(column[first + i].as_py() or "")
                columns[3].append(repeated)
                many = n_words[i] >= WINDOW
                columns[4].append(_repeated_words(grams[rows[i] : rows[i + 1] - WINDOW + 1], n_words[i]) if many else 0)
                hashes.append(np.array(line_hashes, np.int64))
                words.append(np.array(line_words, np.int64))
        yield pa.record_batch(
            [
                batch.column("doc_id"),
                batch.column("key"),
                *[pa.array(c, pa.int64()) for c in columns],
                tokens.list_column(hashes, pa.int64()),
                tokens.list_column(words, pa.int64()),
                batch.column("host"),
            ],
            names=["doc_id", *[c.split()[0] for c in _COUNTS.split(", ")], "line_hashes", "line_words", "host"],
        )


def judge(
    docs: DataFrame,
    host: str = "source",
    min_documents: int = MIN_DOCUMENTS,
    max_share: float = MAX_SHARE,
    min_left_percent: int = MIN_LEFT_PERCENT,
) -> DataFrame:
    """Per row: doc_id, key (of doc_id and text), host, the counts, base_failed, removed (hashes of the lines to
    remove; null for none), words_left and kept."""
    ship_library(docs.sparkSession)
    read = docs.select("doc_id", document_key().alias("key"), "text", _named(host).alias("host"))
    measured = stored(
        read.mapInArrow(
            _measure,
            T.StructType([docs.schema["doc_id"], *T._parse_datatype_string(f"{_COUNTS}, {_LINES}").fields]),
        ),
        "quality-counts",
    )
    # One row per host and set of lines: copies are gone.
    sets = measured.select("host", F.xxhash64(F.array_sort("line_hashes")).alias("document"), "line_hashes")
    sets = stored(sets.dropDuplicates(["host", "document"]), "quality-sets")
    hosts = sets.groupBy("host").agg(F.count("*").alias("of_host"))
    lines = sets.select("host", F.explode("line_hashes").alias("line"))
    counted = lines.groupBy("host", "line").agg(F.count("*").alias("documents"))
    limit = F.greatest(F.lit(min_documents), F.col("of_host") * max_share)
    common = stored(
        counted.where(F.col("documents") > min_documents)
        .join(hosts, "host")
        .where(F.col("documents") > limit)
        .select("host", "line"),
        "quality-common",
    )
    removed = (
        measured.select("key", "host", F.explode(F.arrays_zip("line_hashes", "line_words")).alias("l"))
        .select("key", "host", F.col("l.line_hashes").alias("line"), F.col("l.line_words").alias("words"))
        .join(common, ["host", "line"])
        # Repeated rows have the same key, host and lines.
        .distinct()
        .groupBy("key", "host")
        .agg(F.sum("words").alias("words_removed"), F.collect_list("line").alias("removed"))
    )
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED_PERCENT
    )
    left = F.col("n_words") - F.coalesce("words_removed", F.lit(0))
    depleted = F.col("removed").isNotNull() & (
        (F.col("words_left") < MIN_WORDS) | (F.col("words_left") * 100 < F.col("n_words") * min_left_percent)
    )
    return (
        measured.drop("line_hashes", "line_words")
        .join(removed, ["key", "host"], "left")
        .withColumn("words_left", left)
        .withColumn("base_failed", base_failed)
        .withColumn("kept", ~F.col("base_failed") & ~depleted)
        .drop("words_removed")
    )


def _without(removed_column: str):
    def clean_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, removed in zip(batch.column("text").to_pylist(), batch.column(removed_column).to_pylist()):
                if removed:
                    gone = set(removed)
                    text = "\n".join(line for line in text.split("\n") if line_hash(line) not in gone)
                texts.append(text)
            at = batch.schema.get_field_index("text")
            batch = batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
            yield batch.drop_columns([removed_column])

    return clean_texts


def clean(docs: DataFrame, host: str = "source", **limits) -> DataFrame:
    """The documents that are kept, in the columns of ``docs``, without their common lines.

    A column n_chars, if there is one, is counted anew.
    """
    key, at_host, removed = unused(docs.columns, "_key", "_host", "_removed")
    verdicts = judge(docs, host, **limits).where("kept").select("key", "host", "removed").dropDuplicates(["key", "host"])
    kept = (
        docs.withColumns({key: document_key(), at_host: _named(host)})
        .join(verdicts.toDF(key, at_host, removed), [key, at_host])
        .select(*docs.columns, removed)
    )
    cleaned = kept.mapInArrow(_without(removed), docs.schema)
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        cleaned = cleaned.withColumn("n_chars", F.char_length("text").cast(kind))
    return cleaned
