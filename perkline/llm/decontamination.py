"""Benchmark decontamination by winnowing, with DataFrame operations only.

A text is its sequence of words. Of every ``window`` consecutive k-grams the smallest hash
(the rightmost of equals) is a fingerprint; two texts that share a span of ``k + window - 1``
words choose the same fingerprint in it. Training and test fingerprints are joined, and every
match is extended: the spans around it are compared word by word, so hash collisions are
harmless and no long enough shared span is missed.

Items shorter than a span (but not empty) are one window: their whole hash is looked up among
the hashes of as many consecutive words.

Only documents with a matching fingerprint are read again for the comparison. Fingerprints
are joined by hash with the few distinct ones of the benchmark; the planner broadcasts those
only if they are small.

Defined cases: null texts have no words; documents without id, repeated ids and repeated rows
are judged each by its own text; items without words match nothing; items with null id take
part in hits, but are not named; an empty benchmark hits nothing. A very long text takes time in proportion to its words, in
one task. Of k-grams with equal hashes in a window the rightmost counts; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perkline.llm.names import unused
from perkline.llm.storage import stored

SPAN, GRAM = 10, 5
NOT_A_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words_of(text: Column) -> Column:
    words = F.split(lower_ascii(F.coalesce(text, F.lit(""))), NOT_A_WORD)
    # Separators at either end leave an empty word there.
    return F.array_remove(words, "")


def _fingerprints(texts: DataFrame, span: int, gram: int, short_lengths: list[int]) -> DataFrame:
    """Rows (.., n_words, at, length, print): one with ``at`` -1 per text, and one per fingerprint.

    ``length`` is the span that the print stands for, ``at`` where its k-gram (or short
    window) begins.
    """
    window = span - gram + 1
    rows = texts.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w))).drop("words")
    rows = rows.select(
        *[c for c in rows.columns if c != "hashes"],
        F.size("hashes").cast("long").alias("n_words"),
        "hashes",
        F.explode(F.sequence(F.lit(-1), F.size("hashes") - 1)).alias("start"),
    )

    def gram_at(offset: int, length: int) -> Column:
        return F.xxhash64(*[F.get("hashes", F.col("start") + (offset + i)) for i in range(length)])

    kept = [c for c in rows.columns if c not in ("hashes", "start")]
    names = [f"h{i}" for i in range(-1, window)]
    rows = rows.select(
        *kept,
        "start",
        *[gram_at(i, gram).alias(n) for i, n in zip(range(-1, window), names)],
        *[gram_at(0, n).alias(f"short{n}") for n in short_lengths],
    )

    def choice(window_names: list[str]) -> tuple[Column, Column]:
        least = reduce(lambda a, b: F.least(a, b), map(F.col, window_names))
        offset = F.lit(0)
        for i, name in enumerate(window_names):
            offset = F.when(F.col(name) == least, i).otherwise(offset)
        return least, offset

    now, now_at = choice(names[1:])
    _, before_at = choice(names[:-1])
    fits = F.col("start") + span <= F.col("n_words")
    fresh = (F.col("start") == 0) | (now_at != before_at - 1)
    # One column per length of span, then one row per column that holds a print.
    prints = {
        "0": F.when(F.col("start") < 0, F.lit(0).cast("long")),
        str(span): F.when((F.col("start") >= 0) & fits & fresh, now),
    }
    for n in short_lengths:
        prints[str(n)] = F.when((F.col("start") >= 0) & (F.col("start") + n <= F.col("n_words")), F.col(f"short{n}"))
    at = F.when(F.col("start") < 0, -1).otherwise(F.col("start"))
    rows = rows.select(*kept, at.alias("at"), now_at.alias("offset"), *[p.alias(n) for n, p in prints.items()])
    rows = rows.unpivot([*kept, "at", "offset"], list(prints), "length", "print").where(F.col("print").isNotNull())
    length = F.col("length").cast("int")
    at = F.when(length == span, F.col("at") + F.col("offset")).otherwise(F.col("at"))
    return rows.select(*kept, at.alias("at"), length.alias("length"), "print")


def contaminated_spans(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """All documents as (doc_id, key, n_words), and the spans found in them as (key, start, end, item_id).

    ``key`` stands for id and text together. ``start`` and ``end`` (exclusive) count words; a
    span is shared with the item and at least as long as one of its windows.
    """
    items = (
        benchmark.select("item_id", words_of(F.col("text")).alias("words"))
        .where(F.size("words") > 0)
        .select("item_id", "words", F.size("words").alias("n_item"))
    )
    lengths = items.where(F.col("n_item") < span).select("n_item").distinct()
    short_lengths = sorted(r[0] for r in lengths.collect())  # fewer than `span` numbers

    # Every window of an item with the prints that lead to it.
    item_prints = _fingerprints(
        items.select("item_id", "n_item", F.col("words").alias("item_words"), "words"), span, gram, short_lengths
    ).where((F.col("at") >= 0) & ((F.col("length") == span) | (F.col("length") == F.col("n_item"))))
    item_prints = stored(item_prints.select("item_id", "item_words", "at", "length", "print"), "benchmark-prints")

    key = F.xxhash64(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")))
    texts = docs.select("doc_id", key.alias("key"), words_of(F.col("text")).alias("words"))
    wanted = item_prints.select("length", "print").distinct().withColumn("hit", F.lit(True))
    matches = _fingerprints(texts, span, gram, short_lengths).join(wanted, ["length", "print"], "left")
    matches = matches.where((F.col("at") < 0) | F.col("hit"))
    matches = stored(matches.select("doc_id", "key", "n_words", "at", "length", "print"), "fingerprint-matches")

    everything = matches.where(F.col("at") < 0).select("doc_id", "key", "n_words")
    hits = matches.where(F.col("at") >= 0).select("key", "at", "length", "print").distinct()

    # Extend: how many words before and after the matching k-gram agree, as far as its windows reach.
    hit_keys = hits.select("key").distinct()
    again = (
        docs.select(key.alias("key"), "text")
        .join(hit_keys, "key", "left_semi")
        .dropDuplicates(["key"])
        .select("key", words_of(F.col("text")).alias("words"))
    )
    reach = span - gram
    low = F.greatest(F.col("at") - reach, F.lit(0))
    around = hits.join(again, "key").select(
        "key", "at", "length", "print", low.alias("low"), F.slice("words", low + 1, span + reach).alias("near")
    )
    pairs = around.join(item_prints.withColumnRenamed("at", "item_at"), ["length", "print"])
    long = F.col("length") == span

    def agree(offset: int) -> Column:
        here = F.get("near", F.col("at") - F.col("low") + offset)
        there = F.get("item_words", F.col("item_at") + offset)
        return F.coalesce(here == there, F.lit(False))

    def run(offsets: list[int]) -> Column:
        """How many of the words at ``offsets`` agree before the first that does not."""
        length = F.lit(len(offsets))
        for i in reversed(range(len(offsets))):
            length = F.when(~agree(offsets[i]), i).otherwise(length)
        return length

    core = F.when(long, run(list(range(gram)))).otherwise(run(list(range(span - 1))))
    spans = (
        pairs.select(
            "key",
            "at",
            "length",
            "item_id",
            core.alias("core"),
            F.when(long, run([-1 - i for i in range(reach)])).otherwise(F.lit(0)).alias("before"),
            F.when(long, run([gram + i for i in range(reach)])).otherwise(F.lit(0)).alias("after"),
        )
        .where(
            F.when(long, (F.col("core") == gram) & (F.col("before") + gram + F.col("after") >= span)).otherwise(
                F.col("core") >= F.col("length")
            )
        )
        .select(
            "key",
            (F.col("at") - F.col("before")).alias("start"),
            (F.col("at") + F.when(long, F.lit(gram)).otherwise(F.col("length")) + F.col("after")).alias("end"),
            "item_id",
        )
        .distinct()
    )
    return everything, spans


def decontaminate(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """Per document: doc_id, n_words, n_hit (words inside any window of an item), items (their ids, sorted
    as strings), contaminated, and key (of id and text)."""
    everything, spans = contaminated_spans(docs, benchmark, span, gram)
    spans = stored(spans, "benchmark-spans")
    reached = F.max("end").over(
        Window.partitionBy("key").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    )
    new_words = F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce("reached", F.lit(0))))
    hit = (
        spans.select("key", "start", "end")
        .distinct()
        .withColumn("reached", reached)
        .groupBy("key")
        .agg(F.sum(new_words).cast("long").alias("n_hit"))
    )
    # An item occurs in a document once here, so the list is as long as the items that hit it.
    named = (
        spans.select("key", F.col("item_id").cast("string").alias("item"))
        .distinct()
        .groupBy("key")
        .agg(F.sort_array(F.collect_list("item")).alias("items"))
    )
    return (
        everything.join(hit.join(named, "key", "left"), "key", "left")
        .select(
            "doc_id",
            "key",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            F.col("n_hit").isNotNull().alias("contaminated"),
        )
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """The documents that share no window with an item."""
    _, spans = contaminated_spans(docs, benchmark, span, gram)
    (name,) = unused(docs.columns, "_key")
    found = spans.select(F.col("key").alias(name)).distinct()
    key = F.xxhash64(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")))
    return docs.withColumn(name, key).join(found, name, "left_anti").select(*docs.columns)
