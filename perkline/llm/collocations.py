"""Phrases whose words occur together far more often than apart, with an FM-index per shard.

Texts are cut into pieces at punctuation and line ends, pieces into words. Whole texts go into shards of
about ``SHARD_WORDS`` words, as sequences of word ids with a mark before every piece.

First the shards find out together what may be frequent: each counts its words, and its pairs and triples of
neighbouring words, by hash into buckets, and the counts of all shards are summed, one slice of the buckets after
the other. What has a bucket that stays below the limit is rare. Only the other buckets' numbers go back
to the shards that have them, so no shard or task sees all. Buckets grow with the texts.

A shard then cuts its sequence where a pair is rare, and indexes what remains: of all places, sorted by the words
that follow (to the depth of the longest phrase), the word before, which is the Burrows-Wheeler transform;
and the same for the sequence read backwards. A phrase is an interval of places in both. It is extended to the left
by the words before its places: the places with one word are, in their order among all places with
that word, the interval of the longer phrase; in the other index that is the part of the interval after
all smaller words. To the right it is the same with the two exchanged. Only triples that may be frequent
are extended, and only to where the rest of the longer phrase is one too. The phrases found in this way
and their counts are summed over all shards, again by slices. The sums are exact, because whether a phrase is
looked for depends on sums over all shards only.

Defined cases: null texts are empty; a null language is ``und``; texts without words count
nothing; repeated rows count as often as they are there; the lowest-scoring cut of a phrase counts, of equal
ones the shortest first part; equal scores go by count, then by the bytes of the phrase; a text of any length is
in one shard, whole; no rows give no phrases. Columns other than text and language are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perkline.llm.ordering import numbered
from perkline.llm.shipping import ship_library
from perkline.llm.storage import discard_folder, release_shuffles, stored
from perkline.llm.tokens import BASE, LOWERED, mixed, text_chunks, word_bounds, word_hashes
from perkline.session import shared_dir

SHARD_WORDS = 1 << 19
SHARD_BITS = 24  # of a shard's number, for the shards of one task
BUCKET_BYTES = 48  # one bucket for so many bytes of text
SLICE_BITS = 20  # buckets that are summed together
SKETCHED = 3  # words of the longest phrases that are counted by buckets
MORE_SLICES = 2  # bits by which the slices of phrases are smaller
SALTS = 64
CODEC = "zstd"
BREAKS = np.zeros(256, bool)
BREAKS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
WORD = ~BREAKS
WORD[[0x20, 0x09]] = False
SMALL = LOWERED.astype(np.uint8)


# --- One shard --------------------------------------------------------------------


def words_of(texts: pa.Array) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Stretches of texts: all words in lower case, whether a piece starts with them, and the row of each."""
    for first, _, data, offsets in text_chunks(texts):
        starts, ends, rows = word_bounds(data, offsets, WORD)
        if not len(starts):
            continue
        bounds = np.zeros(len(starts) + 1, np.int32)
        np.cumsum(ends - starts, out=bounds[1:])
        letters = SMALL[data[WORD[data]]]
        words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(letters))
        so_far = np.cumsum(BREAKS[data])
        new = np.ones(len(starts), bool)
        new[1:] = so_far[starts[1:]] != so_far[ends[:-1] - 1]
        counts = np.diff(rows)
        new[rows[:-1][counts > 0]] = True
        yield words, new, first + np.repeat(np.arange(len(counts)), counts)


def sequence_of(words: pa.Array, new: np.ndarray, lang: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Word ids from 1 with a zero before every piece, and word and language of each id; frequent words have small ids."""
    found = words.dictionary_encode()
    n_words = len(found.dictionary)
    kinds, ids, counts = np.unique(lang * n_words + found.indices.to_numpy(), return_inverse=True, return_counts=True)
    by_count = np.argsort(-counts, kind="stable")
    numbers = np.empty(len(kinds), np.int32)
    numbers[by_count] = np.arange(1, len(kinds) + 1)
    symbols = np.zeros(len(new) + int(new.sum()), np.int32)
    symbols[np.arange(len(new)) + np.cumsum(new)] = numbers[ids]
    kinds = kinds[by_count]
    return symbols, found.dictionary.take(pa.array(kinds % n_words)), kinds // n_words


def _text_hashes(texts: pa.Array, lang: np.ndarray, langs: list[str]) -> np.ndarray:
    def of(column: pa.Array) -> np.ndarray:
        out = [word_hashes(data, ends[:-1], ends[1:], lower=False) for _, _, data, ends in text_chunks(column)]
        return np.concatenate([np.zeros(0, np.uint64), *out])

    return mixed(of(texts) ^ mixed(of(pa.array(langs, pa.string())) + np.uint64(1))[lang])


def _hashes(words: pa.Array, lang: np.ndarray, langs: list[str]) -> np.ndarray:
    """A hash of word and language for each id, the same in all shards; 0 for the mark."""

    return np.concatenate([np.zeros(1, np.uint64), _text_hashes(words, lang, langs)])


def _buckets(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of phrases and of the word after them to hashes of the longer phrases."""
    return mixed(left * np.uint64(BASE) + right)


def bucket_counts(symbols: np.ndarray, hashes: np.ndarray, bits: int, longest: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sorted buckets and their counts, of words, pairs, … up to ``longest`` words."""
    out, at, size = [], np.flatnonzero(symbols), len(hashes)
    phrase, values = symbols, hashes
    for length in range(1, longest + 1):
        if length > 1:
            at = at[at < len(symbols) - length + 1]
            last = symbols[at + length - 1]
            at, last = at[last > 0], last[last > 0]
            keys, of, counts = np.unique(phrase[at].astype(np.int64) * size + last, return_inverse=True, return_counts=True)
            values = _joined(values[keys // size], hashes[keys % size])
            phrase = np.zeros(len(symbols), np.int32)
            phrase[at] = of
            numbers = values
        else:
            counts = np.bincount(symbols, minlength=size)[1:]
            numbers = hashes[1:]
        buckets, of = np.unique(_buckets(numbers, bits), return_inverse=True)
        out.append((buckets, np.bincount(of, counts, len(buckets)).astype(np.int64)))
    return out


def packed(numbers: np.ndarray) -> bytes:
    """32-bit numbers compressed, byte by byte of equal weight: small numbers take little more than a byte."""
    weights = np.ascontiguousarray(numbers, np.int32).view(np.uint8).reshape(-1, 4).T
    return pa.compress(weights.tobytes(), CODEC, asbytes=True)


def unpacked(data: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.int32)
    weights = np.frombuffer(pa.decompress(data, 4 * n, CODEC), np.uint8).reshape(4, n)
    return np.ascontiguousarray(weights.T).view(np.int32)[:, 0]


def packed_texts(texts: pa.Array) -> tuple[np.ndarray, int, bytes]:
    """Bytes of each text, of all, and the texts without gaps, compressed."""
    if texts.offset:
        texts = pa.concat_arrays([texts])
    sizes = pc.binary_length(texts).to_numpy()
    size = int(sizes.sum())
    letters = texts.buffers()[2]
    return sizes, size, pa.compress(letters.slice(0, size) if size else b"", CODEC, asbytes=True)


def unpacked_texts(sizes: np.ndarray, size: int, data: bytes) -> pa.Array:
    ends = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=ends[1:])
    letters = pa.decompress(data, size, CODEC) if size else pa.py_buffer(b"")
    return pa.StringArray.from_buffers(len(sizes), pa.py_buffer(ends), letters)


def _ranks(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Ranks of pairs of numbers."""
    keys = left.astype(np.int64) * (int(right.max()) + 1) + right
    order = np.argsort(keys)
    ranked = keys[order]
    ranks = np.empty(len(keys), np.int32)
    ranks[order] = np.concatenate([[0], np.cumsum(ranked[1:] != ranked[:-1], dtype=np.int32)])
    return ranks


def transform(symbols: np.ndarray, depth: int) -> np.ndarray:
    """The symbol before every place, in the order of the ``depth`` symbols from the place on; the text is a ring."""
    ranks, known = symbols, 1
    while known < depth:
        step = min(known, depth - known)
        ranks = _ranks(ranks, np.roll(ranks, -step))
        known += step
    return symbols[np.argsort(ranks, kind="stable") - 1]


def extended(before: np.ndarray, low: np.ndarray, size: np.ndarray, other: np.ndarray):
    """All extensions by one word of disjoint intervals, sorted by ``low``.

    ``before`` is one of the shard's transforms, ``low`` and ``size`` the intervals in it, ``other``
    where they start in the opposite one. Returns starts and sizes of the longer intervals, their starts in
    the opposite transform, the number of the interval that was extended, and the word.
    """
    counts = np.bincount(before)
    blocks = np.cumsum(counts) - counts
    # Where the n-th place with a word leads: to the n-th place that starts with it.
    by_word = np.argsort(before.astype(np.uint16) if len(counts) <= 1 << 16 else before, kind="stable")
    leads = np.empty(len(before), np.int64)
    leads[by_word] = np.arange(len(before))

    begins = np.cumsum(size) - size
    places = np.arange(int(size.sum())) - np.repeat(begins - low, size)
    keys = np.repeat(np.arange(len(low)) * len(counts), size) + before[places]
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    of, word = keys[first] // len(counts), keys[first] % len(counts)
    start = leads[np.minimum.reduceat(places[order], first)]
    real = word > 0
    sizes, others = np.diff(first, append=len(keys)), other[of] + first - begins[of]
    return start[real], sizes[real], others[real], of[real], word[real]


def phrases_of(
    symbols: np.ndarray, words: pa.Array, longest: int, may_be_frequent: Callable[[np.ndarray], np.ndarray]
) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Phrases of two words and more in a sequence: texts, counts, and the id of a word of each.

    ``may_be_frequent`` says so of rows of three word ids.
    """
    if not len(symbols):
        return
    to_left, to_right = transform(symbols, longest), transform(symbols[::-1], longest)
    counts = np.bincount(symbols)
    ids = np.flatnonzero(counts)[1:]
    low, size = (np.cumsum(counts) - counts)[ids], counts[ids]
    other, texts, ids = low, words.take(pa.array(ids - 1)), ids[:, None]
    for length in range(2, longest + 1):
        if not len(low):
            return
        # To the left and to the right by turns.
        backwards = bool(length % 2)
        own, opposite = (other, low) if backwards else (low, other)
        order = np.argsort(own)
        own, old = own[order], size[order]
        start, size, there, of, word = extended(to_right if backwards else to_left, own, old, opposite[order])
        rest = np.searchsorted(own, start, "right") - 1
        of = order[of]
        if length <= SKETCHED:
            joined = (ids[of], word[:, None]) if backwards else (word[:, None], ids[of])
            longer = np.concatenate(joined, axis=1)
        if length == SKETCHED:
            known = may_be_frequent(longer)
        else:
            known = (rest >= 0) & (start < own[rest] + old[rest])
        if length <= SKETCHED:
            ids = longer[known]
        start, size, there, of, word = start[known], size[known], there[known], of[known], word[known]
        low, other = (there, start) if backwards else (start, there)
        one, before = words.take(pa.array(word - 1)), texts.take(pa.array(of))
        texts = pc.binary_join_element_wise(*((before, one) if backwards else (one, before)), " ")
        yield texts, size, word


def cut_sequence(symbols: np.ndarray, alive: np.ndarray) -> np.ndarray:
    """Only the words of pairs that are ``alive`` (for each place and the next), with one zero wherever others stood."""
    kept = np.zeros(len(symbols), bool)
    kept[:-1] |= alive
    kept[1:] |= alive
    # A run of kept words ends where the pair with the next word is not alive.
    joined = np.concatenate([[False], alive])
    starts = kept & ~joined
    out = np.zeros(int(kept.sum() + starts.sum()), symbols.dtype)
    at = np.cumsum(kept) + np.cumsum(starts) - 1
    out[at[kept]] = symbols[kept]
    return out


# --- Tasks --------------------------------------------------------------------------

#: A shard's own row has its texts; the others have a slice of its bucket counts each.
SHARD = pa.schema(
    [
        ("counts", pa.bool_()),
        ("shard", pa.int64()),
        ("langs", pa.list_(pa.string())),
        ("sizes", pa.list_(pa.int64())),
        ("n_words", pa.int64()),
        ("numbers", pa.binary()),
        ("size", pa.int64()),
        ("words", pa.binary()),
        ("places", pa.int64()),
        ("symbols", pa.binary()),
        ("length", pa.int32()),
        ("slice", pa.int64()),
        ("n", pa.int64()),
        ("buckets", pa.binary()),
    ]
)
SHARD_SQL = (
    "counts boolean, shard long, langs array<string>, sizes array<long>, n_words long, numbers binary, size long, words binary, "
    "places long, symbols binary, length int, slice long, n long, buckets binary"
)


def _row(schema: pa.Schema, **values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([values.get(f.name)], f.type) for f in schema], schema=schema)


def _sharded(shard_words: int, sketched: int, bits: int, slice_bits: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId() << SHARD_BITS
        parts, langs, n = [], {}, 0

        def finished() -> Iterator[pa.RecordBatch]:
            new, lang = (np.concatenate([p[i] for p in parts]) for i in (1, 2))
            symbols, words, word_langs = sequence_of(pa.concat_arrays([p[0] for p in parts]), new, lang)
            hashes = _hashes(words, word_langs, list(langs))
            sizes, size, letters = packed_texts(words)
            yield _row(
                SHARD, counts=False, shard=shard, langs=list(langs), sizes=np.bincount(lang, minlength=len(langs)),
                n_words=len(words), numbers=packed(np.concatenate([word_langs, sizes])), size=size, words=letters,
                places=len(symbols), symbols=packed(symbols),
            )
            for length, (buckets, counts) in enumerate(bucket_counts(symbols, hashes, bits, sketched), 1):
                slices, starts = np.unique(buckets >> slice_bits, return_index=True)
                for number, start, end in zip(slices, starts, [*starts[1:], len(buckets)]):
                    own = buckets[start:end] & ((1 << slice_bits) - 1)
                    data = packed(np.concatenate([np.diff(own, prepend=0), counts[start:end]]))
                    yield _row(SHARD, counts=True, shard=shard, length=length, slice=number, n=end - start, buckets=data)

        for batch in batches:
            names = batch.column("lang").to_pylist()
            for words, new, rows in words_of(batch.column("text")):
                first, last = int(rows[0]), int(rows[-1])
                numbers = np.array([langs.setdefault(v, len(langs)) for v in names[first : last + 1]], np.int64)
                parts.append((words, new, numbers[rows - first]))
                n += len(words)
                if n >= shard_words:
                    yield from finished()
                    shard += 1
                    parts, langs, n = [], {}, 0
        if parts:
            yield from finished()

    return build


FREQUENT = pa.schema([("shard", pa.int64()), ("length", pa.int32()), ("slice", pa.int64()), ("n", pa.int64()), ("buckets", pa.binary())])
FREQUENT_SQL = "shard long, length int, slice long, n long, buckets binary"


def _summed(least: int, slice_bits: int):
    def frequent(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        """One slice: sums the counts of all shards; each gets back which of its buckets are frequent."""
        total = np.zeros(1 << slice_bits, np.int64)
        sizes = table["n"].to_pylist()

        def buckets_and_counts(i: int) -> tuple[np.ndarray, np.ndarray]:
            both = unpacked(table["buckets"][i].as_py(), 2 * sizes[i])
            return np.cumsum(both[: sizes[i]]), both[sizes[i] :]

        for i in range(len(sizes)):
            buckets, counts = buckets_and_counts(i)
            total[buckets] += counts
        out = []
        for i in range(len(sizes)):
            buckets, _ = buckets_and_counts(i)
            buckets = buckets[total[buckets] >= least]
            if len(buckets):
                data = packed(np.diff(buckets, prepend=0))
                out.append(_row(FREQUENT, shard=table["shard"][i], length=key[0].as_py(), slice=key[1].as_py(), n=len(buckets), buckets=data))
        return pa.Table.from_batches(out, FREQUENT)

    return frequent


#: Phrases of one shard in one slice: numbers of languages, bytes of the texts and counts; and the texts without gaps.
COUNTED = pa.schema([("slice", pa.int64()), ("n", pa.int64()), ("langs", pa.list_(pa.string())), ("numbers", pa.binary()), ("size", pa.int64()), ("texts", pa.binary())])
COUNTED_SQL = "slice long, n long, langs array<string>, numbers binary, size long, texts binary"
PHRASES = pa.schema([("lang", pa.string()), ("length", pa.int32()), ("phrase", pa.string()), ("n", pa.int64())])
PHRASES_SQL = "lang string, length int, phrase string, n long"


def _counted(longest: int, bits: int, slice_bits: int):
    def count(own: pa.Table, frequent: pa.Table) -> pa.Table:
        """One shard: its frequent words, and all phrases of which every pair is frequent."""
        if not len(own) or not len(frequent):
            return COUNTED.empty_table()
        (row,) = own.to_pylist()
        langs = row["langs"]
        word_langs, sizes = np.split(unpacked(row["numbers"], 2 * row["n_words"]), 2)
        words = unpacked_texts(sizes, row["size"], row["words"])
        symbols = unpacked(row["symbols"], row["places"])
        hashes = _hashes(words, word_langs, langs)
        buckets = {length: [] for length in range(1, SKETCHED + 1)}
        for piece in frequent.sort_by([("length", "ascending"), ("slice", "ascending")]).to_pylist():
            numbers = np.cumsum(unpacked(piece["buckets"], piece["n"]), dtype=np.int64)
            buckets[piece["length"]].append(numbers + (piece["slice"] << slice_bits))
        known = {k: np.concatenate([*v, np.full(1, -1)]) for k, v in buckets.items()}  # sorted, but for the -1 at the end

        def is_known(length: int, values: np.ndarray) -> np.ndarray:
            found = _buckets(values, bits)
            return known[length][np.searchsorted(known[length][:-1], found)] == found

        word_known = is_known(1, hashes)
        word_known[0] = False
        alive = word_known[symbols[:-1]] & word_known[symbols[1:]]
        at = np.flatnonzero(alive)
        alive[at] = is_known(2, _joined(hashes[symbols[at]], hashes[symbols[at + 1]]))

        def may_be_frequent(ids: np.ndarray) -> np.ndarray:
            values = hashes[ids[:, 0]]
            for i in range(1, SKETCHED):
                values = _joined(values, hashes[ids[:, i]])
            return is_known(SKETCHED, values)


        ids = np.flatnonzero(word_known)
        found = [(words.take(pa.array(ids - 1)), np.bincount(symbols, minlength=len(hashes))[ids], ids)]
        found += phrases_of(cut_sequence(symbols, alive), words, longest, may_be_frequent)
        texts = pa.concat_arrays([f[0] for f in found])
        counts = np.concatenate([f[1] for f in found])
        lang = word_langs[np.concatenate([f[2] for f in found]) - 1]
        slices = _buckets(_text_hashes(texts, lang, langs), bits - slice_bits + MORE_SLICES)
        order = np.argsort(slices, kind="stable")
        numbers, starts = np.unique(slices[order], return_index=True)
        out = []
        for number, start, end in zip(numbers, starts, [*starts[1:], len(order)]):
            at = order[start:end]
            sizes, size, letters = packed_texts(texts.take(pa.array(at)))
            data = packed(np.concatenate([lang[at], sizes, counts[at]]))
            out.append(_row(COUNTED, slice=number, n=len(at), langs=langs, numbers=data, size=size, texts=letters))
        return pa.Table.from_batches(out, COUNTED)

    return count


def _frequent_of(least: int):
    def total(table: pa.Table) -> pa.Table:
        """One slice: the phrases that are frequent in all shards together."""
        langs, texts, of, counts = {}, [], [], []
        for row in table.to_batches(max_chunksize=1):
            row = row.to_pylist()[0]
            lang, sizes, n = np.split(unpacked(row["numbers"], 3 * row["n"]), 3)
            own = np.array([langs.setdefault(name, len(langs)) for name in row["langs"]], np.int64)
            texts.append(unpacked_texts(sizes, row["size"], row["texts"]))
            of.append(own[lang])
            counts.append(n)
        found = pa.chunked_array(texts, pa.string()).dictionary_encode().unify_dictionaries().combine_chunks()
        names = found.dictionary
        kinds, at = np.unique(np.concatenate(of) * len(names) + found.indices.to_numpy(), return_inverse=True)
        sums = np.bincount(at, np.concatenate(counts)).astype(np.int64)
        kinds, sums = kinds[sums >= least], sums[sums >= least]
        phrases = names.take(pa.array(kinds % len(names)))
        lengths = pc.add(pc.count_substring(phrases, " "), 1).cast(pa.int32())
        lang = pa.array(list(langs), pa.string()).take(pa.array(kinds // len(names)))
        return pa.Table.from_arrays([lang, lengths, phrases, pa.array(sums)], schema=PHRASES)

    return total


# --- All shards -------------------------------------------------------------------


def frequent_phrases(docs: DataFrame, longest: int = 5, least: int = 100, shard_words: int = SHARD_WORDS) -> tuple[DataFrame, DataFrame]:
    """(lang, length, phrase, n) of all phrases with ``least`` occurrences, and (lang, words), the number of all words, of ``docs`` (text, lang)."""
    spark = docs.sparkSession
    ship_library(spark)
    texts = docs.select("text", F.coalesce("lang", F.lit("und")).alias("lang")).where("text is not null")
    size = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    bits = max(SLICE_BITS, (size // BUCKET_BYTES).bit_length())

    path = shared_dir(spark, "shards")
    texts.mapInArrow(_sharded(shard_words, min(SKETCHED, longest), bits, SLICE_BITS), SHARD_SQL).write.partitionBy("counts").parquet(path)
    rows = spark.read.schema(SHARD_SQL).parquet(path)
    slices = rows.where("counts").select("shard", "length", "slice", "n", "buckets").groupBy("length", "slice")
    frequent = stored(slices.applyInArrow(_summed(least, SLICE_BITS), FREQUENT_SQL), "frequent")
    discard_folder(spark, f"{path}/counts=true")
    release_shuffles(spark)

    shards = spark.read.schema(SHARD_SQL).parquet(path).where("not counts")
    sizes = shards.select(F.explode(F.arrays_zip("langs", "sizes")).alias("s"))
    totals = stored(sizes.groupBy(F.col("s.langs").alias("lang")).agg(F.sum("s.sizes").alias("words")), "words")
    own = shards.select("shard", "langs", "n_words", "numbers", "size", "words", "places", "symbols").groupBy("shard")
    found = own.cogroup(frequent.groupBy("shard")).applyInArrow(_counted(longest, bits, SLICE_BITS), COUNTED_SQL)
    phrases = stored(found.groupBy("slice").applyInArrow(_frequent_of(least), PHRASES_SQL), "phrases")
    discard_folder(spark, path)
    release_shuffles(spark)
    return phrases, totals


def with_parts(phrases: DataFrame, longest: int) -> list[DataFrame]:
    """By length from 2, the phrases with the counts of their first words (``starts``) and of their last words
    (``ends``), from one word to all but one, and the phrases without the last word (``lead``) and the first (``rest``)."""
    none = F.array().cast("array<long>")
    shorter = phrases.where("length = 1").select("lang", "phrase", "n", none.alias("starts"), none.alias("ends"))
    out = []
    for length in range(2, longest + 1):
        # The words' lengths say where a phrase is cut: words hold no blank.
        first, last = F.substring_index("phrase", " ", 1), F.substring_index("phrase", " ", -1)
        here = phrases.where(F.col("length") == length).select(
            "lang",
            "phrase",
            "n",
            F.substr("phrase", F.lit(1), F.length("phrase") - F.length(last) - 1).alias("lead"),
            F.substr("phrase", F.length(first) + 2).alias("rest"),
        )
        begun = shorter.select("lang", F.col("phrase").alias("lead"), F.array_append("starts", F.col("n")).alias("starts"))
        ended = shorter.select("lang", F.col("phrase").alias("rest"), F.array_append("ends", F.col("n")).alias("ends"))
        shorter = stored(here.join(begun, ["lang", "lead"]).join(ended, ["lang", "rest"]), "phrases")
        out.append(shorter)
    return out


def weakest_cut(a: Column, n: Column, starts: Column, ends: Column) -> Column:
    """(score, k, l, r) of the cut with the lowest floor(1000 * a * n / (l * r)), in exact arithmetic."""
    big = lambda c: c.cast("decimal(20,0)")

    def cut(left: Column, k: Column) -> Column:
        right = F.element_at(ends, F.size(ends) - k.cast("int"))
        return F.struct(big(left).alias("l"), big(right).alias("r"), (k + 1).cast("int").alias("k"))

    scored = F.transform(
        F.transform(starts, cut),
        lambda c: F.struct(
            F.call_function("div", big(a) * F.lit(1000).cast("decimal(4,0)") * big(n), c["l"] * c["r"]).alias("score"),
            c["k"].alias("k"),
            c["l"].cast("long").alias("l"),
            c["r"].cast("long").alias("r"),
        ),
    )
    return F.array_min(scored)


def collocations(
    docs: DataFrame, longest: int = 5, least: int = 100, top: int = 2000, shard_words: int = SHARD_WORDS
) -> DataFrame:
    """The ``top`` phrases of every language: lang, rank, phrase, a, l, r, n, score.

    Left out are phrases that never occur but inside a longer one, of up to ``longest`` words: then one that is
    longer by a word to the left or to the right has the same count.
    """
    phrases, totals = frequent_phrases(docs, longest, least, shard_words)
    by_length = with_parts(phrases, longest)
    kept = []
    for shorter, longer in zip(by_length, [*by_length[1:], None]):
        if longer is not None:
            covers = longer.select("lang", F.explode(F.array("lead", "rest")).alias("phrase"), "n")
            shorter = shorter.join(covers, ["lang", "phrase", "n"], "left_anti")
        kept.append(shorter.select("lang", "phrase", F.col("n").alias("a"), "starts", "ends"))
    every = kept[0]
    for more in kept[1:]:
        every = every.unionByName(more)
    cut = weakest_cut(F.col("a"), F.col("words"), F.col("starts"), F.col("ends"))
    scored = every.join(totals, "lang").withColumn("cut", cut)
    scored = scored.select("lang", "phrase", "a", "cut.l", "cut.r", F.col("words").alias("n"), "cut.score")
    # Only the best of each salted part are ranked, so no task sorts all phrases of a language.
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*best)
    scored = scored.withColumn("place", F.row_number().over(part)).where(F.col("place") <= top).drop("place")
    ranked = numbered(scored, "lang", best).withColumn("rank", F.col("position") + 1)
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
