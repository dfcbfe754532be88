"""Personal data: fixed patterns, and contextual extraction bootstrapped from what they find.

Entities found by the fixed patterns (email, ip, card, phone) are the seeds. The words around a seed
make lexical patterns: the word before it, the word after it, and both. The same patterns are
collected around all other tokens that could be an identifier. That gives a graph of patterns and
instances, an instance being a string (in lower case, without white space), wherever and however often it
occurs. Spark scores it in rounds until no score changes by ``TOLERANCE`` or more:

* the score of a pattern for a kind is the mean score of the different instances it surrounds: a seed
  counts 1 for its kind and 0 for the others, an unknown string ``TRUST`` of its score so far, or 1 once it is
  accepted; ``DOUBT`` imaginary instances that are wrong are added, so a pattern must be seen often;
* the score of an unknown instance for a kind is that of its best pattern.

Without ``TRUST`` a pattern would vouch for itself: S seeds among any number of unknown strings would end at
S / (S + DOUBT). Scores never fall from round to round, so they settle.

Patterns count that surround at least ``MIN_SEEDS`` different seeds or accepted instances, in at least
``MIN_DOCUMENTS`` different texts; so what is accepted leads to further patterns. Unknown instances that
reach ``MIN_SCORE``, whose shape fits the kind, become spans where they stand in a pattern that reaches it,
or, with ``everywhere``, wherever they occur. A token is unknown if it has at least ``MIN_DIGITS`` digits (or, for
emails, an at sign between letters) and does not touch a seed. Neighbouring tokens of digits, with brackets,
dots and hyphens, are one unknown string if they have the digits of a card or phone number together; for
that kind they are then none by themselves. Ordinary words are never candidates.

A context with S different seeds and more than about 2.8 S - 8 different unknown strings is not accepted, as plain numbers
behind a common word look the same; its strings are found only if other contexts vouch for them.

Defined cases: a null text is empty; a very long text is read whole, by one task; no seeds give no patterns and so no further spans; a token
that fits several kinds gets the best one, the first kind listed of equals; repeated texts count as
one document and all get the spans; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perkline.llm.shipping import ship_library
from perkline.llm.storage import stored

KINDS = ("email", "ip", "card", "phone")
DOUBT = 2.0
TRUST = 0.76
TOLERANCE = 0.01
MAX_ROUNDS = 500  # an error, not a limit
MIN_SCORE, MIN_SEEDS, MIN_DOCUMENTS, MIN_DIGITS = 0.6, 5, 5, 4

# The patterns of the four kinds.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_DIGIT = re.compile(r"[0-9]")
_SPACE = re.compile(r"[\x20\x09-\x0D]+")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_RUN_TOKEN = re.compile(r"[+(]*[0-9][().0-9/-]*[,;:!?\"']*")
_RUN_END = re.compile(r"[,;:!?\"']$")
_RUN_DIGITS = {"card": (14, 19), "phone": (7, 15)}
_WORD_EDGES = ".,;:!?()[]{}<>\"'"
_SHAPES = {
    "email": re.compile(r"[^@\s]*[A-Za-z][^@\s]*(@|\(at\)|\[at\])[^@\s]*[A-Za-z][^@\s]*"),
    "ip": re.compile(r"[0-9]+([.:][0-9]+)+"),
    "card": re.compile(r"[0-9][0-9-]*[0-9]"),
    "phone": re.compile(r"[+(]?[0-9][().0-9/-]+[0-9]"),
}


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind as listed."""
    found = []
    if "@" in text:
        found += [("email", m.start(), m.end()) for m in EMAIL.finditer(text)]
    if _DIGIT.search(text):
        if "." in text:
            for m in IP.finditer(text):
                # A part of thousands of digits is no number to convert.
                parts = [p.lstrip("0") for p in m[0].split(".")]
                if all(len(p) <= 3 and int(p or "0") <= 255 for p in parts):
                    found.append(("ip", m.start(), m.end()))
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and _luhn(digits):
                found.append(("card", m.start(), m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= len(_DIGIT.findall(m[0])) <= 15:
                    found.append(("phone", m.start(), m.end()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _context_word(text: str, start: int, end: int) -> str:
    return text[start:end].strip(_WORD_EDGES).lower()


def _contexts(text: str, spans: list[tuple[str, int, int]]) -> list[tuple]:
    """(kind or null, start, end, word before, word after, kinds whose shape fits) of seeds and unknown tokens."""
    around = list(_TOKEN.finditer(text))
    out = []
    starts = [m.start() for m in around]
    ends = [m.end() for m in around]

    def context(first: int, last: int) -> tuple[str, str]:
        before = _context_word(text, starts[first - 1], ends[first - 1]) if first > 0 else "^"
        after = _context_word(text, starts[last + 1], ends[last + 1]) if last + 1 < len(around) else "$"
        return before, after

    touched: set[int] = set()
    at = 0
    for kind, start, end in spans:
        while ends[at] <= start:
            at += 1
        last = at
        while last + 1 < len(around) and starts[last + 1] < end:
            last += 1
        touched.update(range(at, last + 1))
        out.append((kind, start, end, *context(at, last), [kind]))
    # Maximal runs of at least two tokens of digits; those with the digits of a kind are whole candidates.
    in_run: dict[int, set[str]] = {}
    i = 0
    while i < len(around):
        first = i
        while i < len(around) and i not in touched and _RUN_TOKEN.fullmatch(around[i][0]):
            i += 1
            if _RUN_END.search(around[i - 1][0]):
                break
        if i - first >= 2:
            start = starts[first]
            run = text[start : ends[i - 1]].rstrip(".,;:!?\"'(/-")
            if run.endswith(")") and run.count(")") > run.count("("):
                run = run[:-1]
            n = len(_DIGIT.findall(run))
            fits = [k for k, (low, high) in _RUN_DIGITS.items() if low <= n <= high and _SHAPES[k].fullmatch(_SPACE.sub("", run))]
            if fits:
                out.append((None, start, start + len(run), *context(first, i - 1), fits))
                in_run.update((j, set(fits)) for j in range(first, i))
        i = max(i, first + 1)
    for i, m in enumerate(around):
        if i in touched:
            continue
        token = m[0].strip(_WORD_EDGES.replace("(", "").replace(")", "").replace("[", "").replace("]", ""))
        if not token or not ("@" in token or len(_DIGIT.findall(token)) >= MIN_DIGITS or "at)" in token or "at]" in token):
            continue
        fits = [k for k in KINDS if _SHAPES[k].fullmatch(token) and (k == "email" or len(_DIGIT.findall(token)) >= MIN_DIGITS)]
        fits = [k for k in fits if k not in in_run.get(i, ())]
        if fits:
            start = m.start() + m[0].index(token)
            out.append((None, start, start + len(token), *context(i, i), fits))
    return out


def instance_hash(found: str) -> int:
    return xxhash.xxh64_intdigest(_SPACE.sub("", found).lower()) - (1 << 63)


_SPAN = "array<struct<kind:string,start:int,end:int>>"
_CONTEXT = "array<struct<kind:string,start:int,end:int,before:string,after:string,fits:array<string>,instance:long>>"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    context = pa.list_(
        pa.struct(
            [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("before", pa.string()), ("after", pa.string()), ("fits", pa.list_(pa.string())), ("instance", pa.int64())]
        )
    )
    for batch in batches:
        digests, spans, contexts = [], [], []
        for value in batch.column("text"):
            text = value.as_py() or ""
            digests.append(xxhash.xxh64_intdigest(text) - (1 << 63))
            if not ("@" in text or "(at)" in text or "[at]" in text or _DIGIT.search(text)):
                spans.append([])
                contexts.append([])
                continue
            found = base_spans(text)
            spans.append([dict(zip(("kind", "start", "end"), s)) for s in found])
            names = ("kind", "start", "end", "before", "after", "fits", "instance")
            contexts.append([dict(zip(names, (*c, instance_hash(text[c[1] : c[2]])))) for c in _contexts(text, found)])
        yield pa.record_batch(
            [batch.column("doc_id"), pa.array(digests, pa.int64()), pa.array(spans, span), pa.array(contexts, context)],
            names=["doc_id", "digest", "spans", "contexts"],
        )


def _bootstrapped(contexts: DataFrame, everywhere: bool) -> DataFrame:
    """New spans (row, kind, start, end) from contexts (row, text, kind, start, end, before, after, fits, instance)."""
    patterns = F.array(
        F.struct(F.lit("before").alias("side"), F.col("before").alias("before"), F.lit("").alias("after")),
        F.struct(F.lit("after").alias("side"), F.lit("").alias("before"), F.col("after").alias("after")),
        F.struct(F.lit("both").alias("side"), F.col("before").alias("before"), F.col("after").alias("after")),
    )
    places = contexts.withColumn("pattern", F.explode(patterns)).where(
        ~((F.col("pattern.side") == "before") & F.col("before").isin("", "^"))
        & ~((F.col("pattern.side") == "after") & F.col("after").isin("", "$"))
    )
    places = places.withColumn("pattern", F.xxhash64("pattern"))
    # Copies of a text, and of a string in one pattern of a text, are gone.
    edges = stored(
        places.select("pattern", "instance", F.explode("fits").alias("of"), F.col("kind").isNotNull().alias("seed"), "text").distinct(),
        "pii-edges",
    )
    # Only patterns in enough texts can ever be accepted, and none without an unknown instance has a use.
    useful = (
        edges.select("pattern", "of", "text", "seed").distinct().groupBy("pattern", "of")
        .agg(F.count_distinct("text").alias("texts"), F.min("seed").alias("only_seeds"))
        .where((F.col("texts") >= MIN_DOCUMENTS) & ~F.col("only_seeds"))
    )
    known = edges.where("seed").select("instance", "of").distinct().withColumn("known", F.lit(1.0))
    # Whether accepted strings of a pattern stand in MIN_DOCUMENTS texts is seen from that many texts of each string:
    # a string that has them all kept counts them all, one that has more is enough alone. So rounds join
    # different strings, however many texts hold them.
    kept = F.dense_rank().over(Window.partitionBy("pattern", "of", "instance").orderBy("text")) <= MIN_DOCUMENTS
    graph = stored(
        edges.join(useful.select("pattern", "of"), ["pattern", "of"], "left_semi")
        .withColumn("kept", kept).where("kept").select("pattern", "of", "instance", "text").distinct()
        .join(known, ["instance", "of"], "left"),
        "pii-graph",
    )
    # What a pattern surrounds: the strings that fit the kind, and the seeds of other kinds.
    of_kind = graph.groupBy("pattern", "of").agg(F.count_distinct("instance").alias("n"))
    seeds = edges.where("seed").select("pattern", F.col("of").alias("kind"), "instance").distinct()
    of_others = (
        graph.select("pattern", "of").distinct().join(seeds, "pattern").where("kind != of")
        .groupBy("pattern", "of").agg(F.count("*").alias("others"))
    )
    sizes = stored(
        of_kind.join(of_others, ["pattern", "of"], "left")
        .select("pattern", "of", (F.col("n") + F.coalesce("others", F.lit(0)) + DOUBT).alias("size")),
        "pii-sizes",
    )

    none = graph.sparkSession.createDataFrame([], "instance long, of string, score double")
    scores, total = none, 0.0
    for _ in range(MAX_ROUNDS):
        now = graph.join(scores, ["instance", "of"], "left").withColumn("score", F.coalesce("known", "score", F.lit(0.0)))
        accepted = F.col("score") >= MIN_SCORE
        each = now.groupBy("pattern", "of", "instance").agg(F.first("score").alias("score"))
        sums = each.groupBy("pattern", "of").agg(
            F.sum(F.when(accepted, 1.0).otherwise(F.col("score") * TRUST)).alias("sum"), F.count_if(accepted).alias("sure")
        )
        texts = now.where(accepted).select("pattern", "of", "text").distinct().groupBy("pattern", "of").agg(F.count("*").alias("texts"))
        scored = stored(
            sums.where(F.col("sure") >= MIN_SEEDS)
            .join(texts.where(F.col("texts") >= MIN_DOCUMENTS), ["pattern", "of"])
            .join(sizes, ["pattern", "of"])
            .select("pattern", "of", (F.col("sum") / F.col("size")).alias("pattern_score")),
            "pii-pattern-scores",
        )
        before = scores
        scores = stored(
            graph.where("known is null").select("pattern", "of", "instance").distinct().join(scored, ["pattern", "of"])
            .groupBy("instance", "of").agg(F.max("pattern_score").alias("score")),
            "pii-scores",
        )
        change = scores.join(before.withColumnRenamed("score", "old"), ["instance", "of"], "left")
        change = change.agg(F.max(F.col("score") - F.coalesce("old", F.lit(0.0)))).first()[0]
        if change is None or change < TOLERANCE:
            break
    else:
        raise RuntimeError(f"scores did not settle in {MAX_ROUNDS} rounds")
    sure = scores.where(F.col("score") >= MIN_SCORE)
    if everywhere:
        # A string that is a seed elsewhere needs no context either.
        sure = sure.unionByName(known.select("instance", "of", F.col("known").alias("score")))
        unknown = contexts.where("kind is null").select("row", "instance", "start", "end", F.explode("fits").alias("of"))
        found = unknown.join(sure, ["instance", "of"]).select("row", "start", "end", "of", "score")
    else:
        unknown = places.where("kind is null").select("row", "pattern", "start", "end", F.explode("fits").alias("of"))
        found = (
            unknown.join(scored.where(F.col("pattern_score") >= MIN_SCORE), ["pattern", "of"])
            .groupBy("row", "start", "end", "of").agg(F.max("pattern_score").alias("score"))
        )
    best = F.row_number().over(
        Window.partitionBy("row", "start", "end").orderBy(F.desc("score"), _kind_order(F.col("of")))
    )
    return found.withColumn("nth", best).where("nth = 1").select("row", F.col("of").alias("kind"), "start", "end")


def _kind_order(kind: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, KINDS)), kind)


def find_personal_data(docs: DataFrame, everywhere: bool = False) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, base and found, both arrays of (kind, start, end) in code
    points, end exclusive, by start, then kind. ``found`` has the base spans and those discovered: in
    accepted contexts or, with ``everywhere``, all occurrences of the accepted strings."""
    ship_library(docs.sparkSession)
    fields = [docs.schema["doc_id"], *T.StructType.fromDDL(f"digest long, spans {_SPAN}, contexts {_CONTEXT}").fields]
    scanned = docs.select("doc_id", "text").mapInArrow(_scan, T.StructType(fields))
    scanned = stored(scanned.withColumn("row", F.monotonically_increasing_id()), "pii-spans")
    contexts = scanned.select("row", "digest", F.explode("contexts").alias("c")).select("row", F.col("digest").alias("text"), "c.*")
    added = _bootstrapped(contexts, everywhere).groupBy("row").agg(
        F.collect_list(F.struct("kind", F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end"))).alias("added")
    )
    joined = F.concat("spans", F.coalesce("added", F.array().cast(_SPAN)))
    ordered = F.transform(
        F.array_sort(F.transform(joined, lambda s: F.struct(s["start"].alias("start"), _kind_order(s["kind"]).alias("order"), s["end"].alias("end"), s["kind"].alias("kind")))),
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")),
    )
    return scanned.join(added, "row", "left").select("doc_id", F.col("spans").alias("base"), ordered.alias("found"))


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
