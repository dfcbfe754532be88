"""URL filter: rules first, then the likelihood ratio of two character models.

Rules name a host (with all its subdomains) and the beginning of a path; the longest fitting rule
decides. URLs that a rule decides teach two smoothed variable-order Markov models, one of
allowed and one of blocked URLs: the probability of a character after its context of ``ORDER``
characters is interpolated with that after the next shorter context, down to no context at
all, each by its own counts. URLs without a rule are allowed if their log-likelihood
difference per character reaches a threshold. The threshold is calibrated on a fold of the
rule-decided URLs that the models have not seen.

All counts are made in Spark over all rule-decided URLs. A character with its full context is a
window; the difference is computed once per different window, and URLs are joined with it, so
the models need not fit anywhere.

Defined cases: null, or without ``://``: empty host and path, no rule, and the models judge the
text as it is; without rule-decided URLs of both kinds everything without a rule is allowed; rows
without id and repeated rows are judged by their URL; an empty table gives an empty result. A very long URL is a row per
character like others; of equally good thresholds the one nearest to 0 counts; columns of ``pages`` with the names of
results give way to these, others stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perkline.llm.decontamination import LOWER, UPPER
from perkline.llm.names import unused
from perkline.llm.storage import stored

RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
ORDER = 4
TRUST = 4.0  # observations of a context that weigh as much as all shorter contexts together
ALPHABET = 256.0
BEGIN, END = "\x02", "\x03"
HOT = 10_000  # windows that make up this part of all are joined apart
FOLDS = 5  # one of them calibrates
STEP = 0.02  # of thresholds


def host_and_path(url: Column) -> tuple[Column, Column]:
    known = F.coalesce(url.contains("://"), F.lit(False))
    rest = F.substring(url, F.instr(url, "://") + 3, F.char_length(url))
    rest = F.regexp_replace(rest, r"(?s)[?#].*$", "")
    host = F.regexp_extract(rest, r"(?s)^[^/]*", 0)
    path = F.substring(rest, F.char_length(host) + 1, F.char_length(rest))
    empty = F.lit("")
    return F.when(known, F.translate(host, UPPER, LOWER)).otherwise(empty), F.when(known, path).otherwise(empty)


def apply_rules(pages: DataFrame, rules=RULES) -> DataFrame:
    """Adds host, path, rule and ruled (allow, block or null)."""
    host, path = host_and_path(F.col("url"))
    pages = pages.withColumns({"host": host, "path": path})
    rule, ruled = F.lit(None).cast("string"), F.lit(None).cast("string")
    for verdict, text in sorted(rules, key=lambda r: len(r[1])):
        name, slash, start = text.partition("/")
        fits = (F.col("host") == name) | F.col("host").endswith("." + name)
        fits = fits & F.col("path").startswith(slash + start)
        rule = F.when(fits, text).otherwise(rule)
        ruled = F.when(fits, verdict).otherwise(ruled)
    return pages.withColumns({"rule": rule, "ruled": ruled})


def _windows(urls: DataFrame) -> DataFrame:
    """Per character of a URL (and its end) that character with the ``ORDER`` before it."""
    text = F.coalesce("url", F.lit(""))
    text = F.when(text.contains("://"), F.substring(text, F.instr(text, "://") + 3, F.char_length(text))).otherwise(text)
    urls = urls.withColumn("_text", F.concat(F.lit(BEGIN * ORDER), text, F.lit(END))).drop("url")
    at = F.explode(F.sequence(F.lit(1), F.char_length("_text") - ORDER))
    return urls.withColumn("_at", at).withColumn("window", F.expr(f"substring(_text, _at, {ORDER + 1})")).drop("_text", "_at")


def _differences(counts: DataFrame) -> DataFrame:
    """Per window (window, allowed, blocked: how often each kind has it) the difference of the log-likelihoods."""
    probability = {"allowed": F.lit(1.0 / ALPHABET), "blocked": F.lit(1.0 / ALPHABET)}
    table = counts
    for k in range(ORDER + 1):
        # k characters of context and the character itself: the end of the window.
        for part, start, length in (("gram", ORDER + 1 - k, k + 1), ("context", ORDER + 1 - k, k)):
            key = F.substring("window", start, length)
            sums = counts.groupBy(key.alias("_key")).agg(
                F.sum("allowed").alias(f"_allowed_{part}"), F.sum("blocked").alias(f"_blocked_{part}")
            )
            # There are no more keys of at most one character than characters.
            table = table.withColumn("_key", key).join(F.broadcast(sums) if length <= 1 else sums, "_key").drop("_key")
        for kind in probability:
            seen, context = F.col(f"_{kind}_gram"), F.col(f"_{kind}_context")
            table = table.withColumn(f"_p_{kind}", (seen + TRUST * probability[kind]) / (context + TRUST))
            table = table.drop(f"_{kind}_gram", f"_{kind}_context").withColumnRenamed(f"_p_{kind}", f"_q_{kind}_{k}")
            probability[kind] = F.col(f"_q_{kind}_{k}")
    return table.select("window", (F.log(probability["allowed"]) - F.log(probability["blocked"])).alias("difference"))


def _scores(windows: DataFrame, differences: DataFrame, counts: DataFrame) -> DataFrame:
    """(_url, score): the mean difference of the windows of each URL.

    The beginnings of addresses stand in nearly all of them. A window that makes up a 1 / ``HOT`` of all is one of at
    most ``HOT``, so these are sent around; no other is frequent enough to be too much for the task that joins it.
    """
    total = counts.agg(F.sum("seen")).first()[0] or 0
    hot = F.broadcast(counts.where(F.col("seen") * HOT >= total).select("window"))
    frequent = windows.join(F.broadcast(differences.join(hot, "window", "left_semi")), "window")
    others = windows.join(hot, "window", "left_anti").join(differences.join(hot, "window", "left_anti"), "window")
    # Each part is summed per URL before they meet.
    sums = [part.groupBy("_url").agg(F.sum("difference").alias("sum"), F.count("*").alias("n")) for part in (frequent, others)]
    return sums[0].unionByName(sums[1]).groupBy("_url").agg((F.sum("sum") / F.sum("n")).alias("score"))


def _threshold(calibrating: DataFrame) -> float:
    """The one that parts the two kinds (ruled, score) best, both weighing the same; of equals, nearest to 0."""
    step = F.floor(F.col("score") / STEP)
    counted = calibrating.groupBy(step.alias("step"), "ruled").count().collect()  # scores are logarithms: few steps
    kinds = {k: {r["step"]: r["count"] for r in counted if r["ruled"] == k} for k in ("allow", "block")}
    allow, block = sum(kinds["allow"].values()), sum(kinds["block"].values())
    if not allow or not block:
        return 0.0
    steps = sorted({0, *kinds["allow"], *kinds["block"]})

    def parts(t: int) -> float:
        passed = sum(n for s, n in kinds["allow"].items() if s >= t) / allow
        stopped = sum(n for s, n in kinds["block"].items() if s < t) / block
        return passed + stopped

    return max(steps, key=lambda t: (round(parts(t), 9), -abs(t))) * STEP


def judge_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """Adds host, path, rule, score (log-likelihood difference per character) and verdict to ``pages`` (url)."""
    columns = [c for c in pages.columns if c not in ("host", "path", "rule", "score", "verdict")]
    # Own columns of pages may have the names used here.
    key, ruled = unused(pages.columns, "_url", "_ruled")
    others = [F.col(f"`{c}`").alias(ruled if c == "ruled" else c) for c in columns]
    judged = apply_rules(pages.select(*others), rules).withColumn(key, F.xxhash64("url"))
    urls = stored(
        judged.groupBy(F.col(f"`{key}`").alias("_url")).agg(
            F.first("url").alias("url"), F.first("ruled").alias("ruled"), F.count("*").alias("rows")
        ),
        "urls",
    )
    fold = F.pmod(F.col("_url"), F.lit(FOLDS))
    learn = urls.where(F.col("ruled").isNotNull() & (fold != 0)).select("url", "ruled", "rows")
    counts = _windows(urls.select("url").withColumn("ruled", F.lit(None).cast("string")).withColumn("rows", F.lit(0)).unionByName(learn))
    counts = counts.groupBy("window").agg(
        F.count("*").alias("seen"),
        *[F.sum(F.when(F.col("ruled") == k, F.col("rows")).otherwise(0)).alias(n) for k, n in (("allow", "allowed"), ("block", "blocked"))]
    )
    counts = stored(counts, "url-windows")
    differences = stored(_differences(counts.drop("seen")), "url-model")
    scores = stored(_scores(_windows(urls.select("_url", "url")), differences, counts), "url-scores")
    threshold = _threshold(urls.where(F.col("ruled").isNotNull() & (fold == 0)).join(scores, "_url").select("ruled", "score"))
    by_model = F.when(F.col("score") >= threshold, "allow").otherwise("block")
    judged = judged.withColumn("verdict", F.col("ruled")).join(scores.withColumnRenamed("_url", key), key)
    return judged.select(
        *[F.col(f"`{ruled if c == 'ruled' else c}`").alias(c) for c in columns],
        "host", "path", "rule", "score", F.coalesce("verdict", by_model).alias("verdict"),
    )
