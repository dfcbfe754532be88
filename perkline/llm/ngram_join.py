"""N-gram Jaccard self-join of documents by vertical partitioning.

A document is the set of its word n-grams. All n-grams stand in one global order: n-grams that
are frequent in the corpus last, all others by hash. The order is cut into fragments (ranges of
hashes); a pair's common n-grams are counted separately in each fragment and summed per pair.
That is exact, so a pair links if and only if its Jaccard similarity reaches the threshold.

Which pairs are counted at all:

* Documents with equal sets form a class; only one of a class takes part.
* Similar sets share an n-gram among the first few of each set in the global order (prefix
  filter). Lengths and positions of the shared n-gram rule out more pairs.
* Before all fragments of a pair are counted, the first one is: if the sets already differ in more
  n-grams there than similar sets may differ in all, the others need not be looked at.
* Every set has a sketch of ``SKETCH_BITS`` bits, each the parity of the n-grams that fall on it. An
  n-gram that only one of two sets has flips one bit, so sketches that differ in more bits than
  similar sets may differ in n-grams rule a pair out for sure.
* In each list of documents that share such an n-gram, the documents are first compared with
  the first of the list only. That ties large groups of near copies together with as many
  pairs as documents. Then the documents of a list that are still in different components are
  compared with each other. Links inside a component would not change it, so no component
  is missed, and no group is expanded into all its pairs.

The order by frequency affects only how many pairs are compared, never the result, so the list
of frequent n-grams may be bounded (``MOST_FREQUENT``) and is broadcast.

Defined cases: texts without words (or null) are empty and link with nothing, not even with each
other; texts of fewer words than an n-gram have one shingle, all their words; repeated rows
are equal documents; an id that stands for several texts is a document for each of them;
documents without id are kept, with a null component, and link with nothing; columns other than
doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perkline.llm import tokens
from perkline.llm.components import connected_components
from perkline.llm.names import unused
from perkline.llm.shipping import ship_library
from perkline.llm.storage import discard, release_shuffles, stored

MOST_FREQUENT = 200_000  # n-grams whose frequency moves them to the end of the order
FREQUENT_FROM = 8  # repeats from which an n-gram may count as frequent
COUNT_TOGETHER = 1 << 21  # n-grams whose repeats are counted at once in a task
FRAGMENT_BITS = 3
SKETCH_BITS = 512
BROADCAST_ROWS = 2_000_000  # of three numbers each
SHORT_LIST = 8  # lists up to this length are compared before their sketches are looked up
SPREAD = 32  # pairs with one document from which its side of a join is repeated, once for so many pairs


def _prefix_length(n: int, percent: int) -> int:
    """So many n-grams of a set of ``n``: similar sets share one of them."""
    return n - -(-n * percent // 100) + 1


def _digest(grams: np.ndarray) -> int:
    """Of a set of hashes, in any order."""
    return int(tokens.mixed(grams + np.uint64(1)).sum(dtype=np.uint64).astype(np.int64))


def _sets(docs: DataFrame, n: int) -> DataFrame:
    """Per document (kind 0) its key, size and a 128-bit digest of its set; and (kind 1) n-grams that
    repeat in a task, with their repeats."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] = []
        held = 0

        def repeats() -> pa.RecordBatch:
            grams, counts = np.unique(np.concatenate(waiting), return_counts=True)
            grams, counts = grams[counts > 1], counts[counts > 1]
            none = pa.nulls(len(grams), pa.int64())
            return pa.record_batch(
                [none, none, pa.array(counts), pa.array(tokens.as_long(grams)), none, pa.array(np.ones(len(grams), np.int32))],
                names=names,
            )

        names = ["doc_id", "key", "n", "a", "b", "kind"]
        for batch in batches:
            sizes, first, second = [], [], []
            for grams in tokens.shingle_sets(batch.column("text"), n):
                sizes.append(len(grams))
                first.append(_digest(grams))
                second.append(_digest(grams ^ np.uint64(tokens.BASE)))
                waiting.append(grams)
                held += len(grams)
                if held >= COUNT_TOGETHER:
                    yield repeats()
                    waiting, held = [], 0
            digest = [pa.array(x, pa.int64()) for x in (first, second)]
            kind = pa.array(np.zeros(len(sizes), np.int32))
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("key"), pa.array(sizes, pa.int64()), *digest, kind], names=names
            )
        if waiting:
            yield repeats()

    keyed = docs.select("doc_id", document_key().alias("key"), "text")
    return keyed.mapInArrow(work, "doc_id long, key long, n long, a long, b long, kind int")


def document_key() -> Column:
    return F.xxhash64(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")))


def _frequent(repeats: DataFrame) -> np.ndarray:
    """At most ``MOST_FREQUENT`` n-grams, the most frequent ones, as sorted hashes."""
    counted = repeats.groupBy("a").agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT_FROM)
    counted = counted.withColumn("step", F.floor(F.log2("n") * 8))
    steps = {r["step"]: r["count"] for r in counted.groupBy("step").count().collect()}  # at most 8 * 64
    total, lowest = 0, None
    for step in sorted(steps, reverse=True):
        total += steps[step]
        if total > MOST_FREQUENT:
            break
        lowest = step
    if lowest is None:
        return np.zeros(0, np.uint64)
    found = counted.where(F.col("step") >= lowest).select("a").toArrow().column("a")
    return np.sort(found.to_numpy().view(np.uint64))


def _prefixes(docs: DataFrame, n: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """Per document the first n-grams of its set in the global order, and the sketch of the set."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        late = shared.value
        for batch in batches:
            sizes, first, prefixes, sketches = [], [], [], []
            for grams in tokens.shingle_sets(batch.column("text"), n):
                sizes.append(len(grams))
                first.append(_digest(grams))
                sketches.append(_sketch(grams))
                length = _prefix_length(len(grams), percent) if len(grams) else 0
                if len(late) and len(grams):
                    at = np.minimum(np.searchsorted(late, grams), len(late) - 1)
                    common = late[at] == grams
                    grams = np.concatenate([grams[~common], grams[common]])
                prefixes.append(tokens.as_long(grams[:length]))
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(first, pa.int64()),
                    tokens.list_column(prefixes, pa.int64()),
                    tokens.list_column(sketches, pa.int64()),
                ],
                names=["doc_id", "n", "a", "prefix", "sketch"],
            )

    return docs.select("doc_id", "text").mapInArrow(work, "doc_id long, n long, a long, prefix array<long>, sketch array<long>")


def _sketch(grams: np.ndarray) -> np.ndarray:
    bits = np.bincount((grams & np.uint64(SKETCH_BITS - 1)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def _sketches_allow(a: str, b: str, na: Column, nb: Column, percent: int) -> Column:
    """Whether structs ``a`` and ``b`` of sketch words differ in no more bits than similar sets in n-grams."""
    differing = F.lit(0)
    for i in range(SKETCH_BITS // 64):
        differing = differing + F.bit_count(F.col(f"{a}.w{i}").bitwiseXOR(F.col(f"{b}.w{i}")))
    return differing * (100 + percent) <= (na + nb) * (100 - percent)


def _fragments(docs: DataFrame, n: int, first_only: bool) -> DataFrame:
    """Per document and fragment of the order the n-grams in it; or only the first fragment, even if empty."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A doc_id may stand for several texts; `a` tells which of them is the node.
        edges = (np.arange(1, 1 << FRAGMENT_BITS, dtype=np.uint64)) << np.uint64(64 - FRAGMENT_BITS)
        for batch in batches:
            nodes, digests = (batch.column(x).to_numpy() for x in ("node", "a"))
            owner, fragment, parts, size = [], [], [], 0
            for node, digest, grams in zip(nodes, digests, tokens.shingle_sets(batch.column("text"), n)):
                if digest != _digest(grams):
                    continue
                cuts = [0, *np.searchsorted(grams, edges), len(grams)]
                for f in range(1 if first_only else len(cuts) - 1):
                    if first_only or cuts[f] < cuts[f + 1]:
                        owner.append(node)
                        fragment.append(f)
                        parts.append(tokens.as_long(grams[cuts[f] : cuts[f + 1]]))
                size += int(cuts[1]) if first_only else len(grams)
                if size > COUNT_TOGETHER:
                    yield _fragment_batch(owner, fragment, parts)
                    owner, fragment, parts, size = [], [], [], 0
            yield _fragment_batch(owner, fragment, parts)

    return docs.select("node", "a", "text").mapInArrow(work, "node long, fragment int, grams array<long>")


def _fragment_batch(owner: list, fragment: list, parts: list) -> pa.RecordBatch:
    return pa.record_batch(
        [pa.array(owner, pa.int64()), pa.array(fragment, pa.int32()), tokens.list_column(parts, pa.int64())],
        names=["node", "fragment", "grams"],
    )


def _may_link(a: str, b: str, percent: int) -> Column:
    """From sizes and positions of one shared n-gram: whether the pair can still reach the threshold."""
    na, nb, pa_, pb = (F.col(f"{x}.{y}") for y in ("n", "at") for x in (a, b))
    most = F.least(pa_, pb) + 1 + F.least(na - pa_ - 1, nb - pb - 1)
    return (F.least(na, nb) * 100 >= F.greatest(na, nb) * percent) & (
        most * (100 + percent) >= (na + nb) * percent
    )


def _with_close_sketches(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b, na, nb) that their sketches do not rule out."""
    return (
        pairs.join(sketches.toDF("a", "sketch_a"), "a")
        .join(sketches.toDF("b", "sketch_b"), "b")
        .where(_sketches_allow("sketch_a", "sketch_b", F.col("na"), F.col("nb"), percent))
        .select("a", "b", "na", "nb")
    )


def _spread_over(pairs: DataFrame, right: DataFrame, keys: list[str], spread: int = SPREAD) -> DataFrame:
    """``pairs`` (a stored table) joined with ``right`` on ``keys``, of which ``b`` is one.

    The first document of a long list is in very many pairs. Its few rows in ``right`` are repeated, and its pairs dealt
    to the repeats, so that about ``spread`` rows of a document meet in one place.
    """
    often = pairs.groupBy("b").agg(F.count("*").alias("n")).where(F.col("n") > spread)
    often = stored(often.select("b", F.ceil(F.col("n") / spread).cast("int").alias("repeats")), "ngram-often")
    if often.count() <= BROADCAST_ROWS:
        often = F.broadcast(often)
    repeats = F.coalesce("repeats", F.lit(1))
    dealt = pairs.join(often, "b", "left").withColumn("repeat", F.pmod(F.xxhash64("a"), repeats).cast("int"))
    repeated = right.join(often, "b", "left").withColumn("repeat", F.explode(F.sequence(F.lit(0), repeats - 1)))
    return dealt.drop("repeats").join(repeated.drop("repeats"), [*keys, "repeat"]).drop("repeat")


def _near_in_first(pairs: DataFrame, first: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` that do not differ too much in the first fragment alone."""
    left, right = (first.select(F.col("node").alias(s), F.col("grams").alias(f"grams_{s}")) for s in "ab")
    common = F.size(F.array_intersect("grams_a", "grams_b"))
    differing = F.size("grams_a") + F.size("grams_b") - 2 * common
    return (
        _spread_over(pairs, right, ["b"])
        .join(left, "a")
        .where(differing * (100 + percent) <= (F.col("na") + F.col("nb")) * (100 - percent))
        .select("a", "b", "na", "nb")
        .distinct()
    )


def _links(pairs: DataFrame, fragments: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b, na, nb) that reach the threshold: partial overlaps, summed."""
    left = fragments.select(F.col("node").alias("a"), "fragment", F.col("grams").alias("left_grams"))
    right = fragments.select(F.col("node").alias("b"), "fragment", F.col("grams").alias("right_grams"))
    each = pairs.select("*", F.explode(F.sequence(F.lit(0), F.lit((1 << FRAGMENT_BITS) - 1))).alias("fragment"))
    partial = (
        _spread_over(each, right, ["b", "fragment"], SPREAD << FRAGMENT_BITS)
        .join(left, ["a", "fragment"])
        .select("a", "b", "na", "nb", "fragment", F.size(F.array_intersect("left_grams", "right_grams")).alias("common"))
    )
    # Repeated rows of a document repeat its fragments: the largest of equal counts is one of them.
    partial = partial.groupBy("a", "b", "na", "nb", "fragment").agg(F.max("common").alias("common"))
    overlap = partial.groupBy("a", "b", "na", "nb").agg(F.sum("common").alias("common"))
    linked = F.col("common") * (100 + percent) >= (F.col("na") + F.col("nb")) * percent
    return overlap.where(linked).select("a", "b")


def ngram_join(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``docs`` (doc_id and text): doc_id, n_shingles, component_id, the smallest doc_id that
    links lead to, and key (of doc_id and text). Documents link from a Jaccard similarity of
    ``percent`` / 100."""
    ship_library(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sets = stored(_sets(docs, n), "ngram-sets")
    members = sets.where("kind = 0").select("doc_id", "key", "n", "a", "b")
    frequent = _frequent(sets.where("kind = 1").select("a", "n"))

    # One row per different set. Its node is its smallest doc_id; further sets of that id get a hash.
    classes = members.where("n > 0 AND doc_id IS NOT NULL").groupBy("a", "b", "n").agg(F.min("doc_id").alias("doc_id"))
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy("a", "b"))
    node = F.when(nth == 1, F.col("doc_id")).otherwise(-F.shiftrightunsigned(F.xxhash64("a", "b"), 1) - 1)
    classes = stored(classes.withColumn("node", node), "ngram-classes")

    prefixes = (
        _prefixes(docs, n, percent, frequent)
        .join(classes.select("doc_id", "a", "node"), ["doc_id", "a"])
        .select("node", "n", "prefix", "sketch")
    )
    prefixes = stored(prefixes, "ngram-prefixes")
    release_shuffles(docs.sparkSession)
    words = F.struct(*[F.get("sketch", F.lit(i)).alias(f"w{i}") for i in range(SKETCH_BITS // 64)])
    sketches = prefixes.groupBy("node").agg(F.first(words).alias("sketch"))
    sketches = stored(sketches, "ngram-sketches")
    postings = prefixes.select("node", "n", F.posexplode("prefix").alias("at", "gram"))
    ends = postings.groupBy("gram").agg(
        F.min("node").alias("lead"), F.max("node").alias("last"), F.min_by("n", "node").alias("lead_n")
    )
    postings = stored(
        postings.join(ends.where("lead < last").drop("last"), "gram").select(
            "gram", "lead", "lead_n", F.struct("node", "n", "at").alias("x")
        ),
        "ngram-postings",
    )
    discard(prefixes)
    release_shuffles(docs.sparkSession)

    # With the first of each list.
    first_pairs = (
        postings.where("x.node > lead")
        .select(F.col("x.node").alias("a"), F.col("lead").alias("b"), F.col("x.n").alias("na"), F.col("lead_n").alias("nb"))
        .where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
        .distinct()
    )
    first_pairs = _with_close_sketches(first_pairs, sketches, percent)
    first_pairs = stored(first_pairs, "ngram-pairs")

    links = stored(_verified(docs, classes, first_pairs, n, percent), "ngram-links")
    release_shuffles(docs.sparkSession)
    components = connected_components(links)

    # Documents of one list that are still apart.
    placed = (
        postings.withColumn("node", F.col("x.node"))
        .join(components, "node", "left")
        .select("gram", "node", "x", F.coalesce("component", "node").alias("component"))
    )
    apart = placed.groupBy("gram").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("length")
    )
    placed = stored(placed.join(apart.where("low < high").select("gram", "length"), "gram"), "ngram-apart")
    release_shuffles(docs.sparkSession)

    def across(lists: DataFrame, sketched: bool) -> DataFrame:
        extra = ["sketch"] if sketched else []
        sides = [
            lists.select("gram", F.col("x").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in ["component", *extra]])
            for s in "xy"
        ]
        pairs = sides[0].join(sides[1], "gram").where("x_component < y_component").where(_may_link("x", "y", percent))
        if sketched:
            pairs = pairs.where(_sketches_allow("x_sketch", "y_sketch", F.col("x.n"), F.col("y.n"), percent))
        later = F.col("x.node") > F.col("y.node")
        a, b = F.when(later, F.col("x")).otherwise(F.col("y")), F.when(later, F.col("y")).otherwise(F.col("x"))
        return pairs.select(a["node"].alias("a"), b["node"].alias("b"), a["n"].alias("na"), b["n"].alias("nb"))

    # In long lists the sketches decide before any pair leaves the join.
    long = placed.where(F.col("length") > SHORT_LIST).join(sketches, "node")
    more_pairs = across(placed.where(F.col("length") <= SHORT_LIST), False).unionByName(across(long, True))
    more_pairs = more_pairs.distinct().join(first_pairs.select("a", "b"), ["a", "b"], "left_anti")
    more_pairs = _with_close_sketches(more_pairs, sketches, percent)
    more_pairs = stored(more_pairs, "ngram-pairs")
    release_shuffles(docs.sparkSession)
    more_links = _verified(docs, classes, more_pairs, n, percent)
    every_link = stored(links.unionByName(more_links), "ngram-links")
    components = connected_components(every_link)

    found = classes.join(components, "node", "left").withColumn("component", F.coalesce("component", "node"))
    lowest = found.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    found = found.join(lowest, "component").select("a", "b", "component_id")
    return members.join(found, ["a", "b"], "left").select(
        "doc_id",
        "key",
        F.col("n").alias("n_shingles"),
        F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def _pair_fragments(docs: DataFrame, classes: DataFrame, pairs: DataFrame, n: int, first_only: bool) -> DataFrame:
    """Fragments of all documents in ``pairs``. While these are few, texts are not moved to find them."""
    nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = stored(classes.join(nodes, "node", "left_semi").select("doc_id", "node", "a"), "ngram-wanted")
    if wanted.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    fragments = stored(_fragments(docs.join(wanted, "doc_id"), n, first_only), "ngram-fragments")
    release_shuffles(docs.sparkSession)
    return fragments


def _verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame, n: int, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b, na, nb; a stored table) that reach the threshold."""
    first = _pair_fragments(docs, classes, pairs, n, first_only=True)
    near = stored(_near_in_first(pairs, first, percent), "ngram-near")
    discard(first)
    return _links(near, _pair_fragments(docs, classes, near, n, first_only=False), percent)


def one_of_each_group(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The documents that link with nothing, and of each group of linked ones that with the smallest id.

    Of repeated rows one stays. Documents without words or without id link with nothing.
    """
    (key,) = unused(docs.columns, "_key")
    grouped = ngram_join(docs, n, percent)
    single = (F.col("n_shingles") == 0) | F.col("doc_id").isNull()
    first = (
        grouped.where(~single)
        .where(F.col("doc_id") == F.col("component_id"))
        .groupBy("component_id")
        # An id with several texts in the group: one of them.
        .agg(F.min("key").alias(key))
        .select(key)
    )
    kept = first.unionByName(grouped.where(single).select(F.col("key").alias(key))).distinct()
    return (
        docs.withColumn(key, F.xxhash64(F.col("doc_id").cast("long"), F.coalesce("text", F.lit(""))))
        .join(kept, key, "left_semi")
        .dropDuplicates([key])
        .select(*docs.columns)
    )
