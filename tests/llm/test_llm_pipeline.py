"""The five stages on a small corpus with planted cases, each against brute force on its own input."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from test_llm_decontamination import brute as hits
from test_llm_mixing import brute_targets, size
from test_llm_ngram_join import brute as groups
from test_llm_quality import brute as counts

MENU = "Start | Contact | Imprint of the company and all its many branches"


def corpus():
    rng = random.Random(21)
    vocabulary = [f"t{i}" for i in range(500)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(25)) for i in range(6)]
    texts = [f"{text(40)}\n{text(60)}" for _ in range(120)]  # clean
    texts += [f"{text(40)}\n{MENU}\n{text(20)}" for _ in range(60)]  # with a common line
    texts += [f"{MENU}\n{MENU} again\nrest" for _ in range(3)]  # little but common lines
    base = text(120)
    texts += [base] * 10 + [base.replace(w, "edit") for w in base.split()[:20]]  # copies
    texts += [f"{text(20)} {items[i % 6][1].upper()} {text(20)}" for i in range(12)]  # benchmark
    texts += ["too short", "", None, "again and again and " * 40]
    sources = [rng.choice(["a", "b"]) if i % 3 else "hot" for i in range(len(texts))]
    return [(1000 + i, t, "en", s, len(t or "")) for i, (t, s) in enumerate(zip(texts, sources))], items


def common_lines(rows):
    """Per source the normalised lines of more than 10 documents and 10 %, copies counting once."""
    plain = lambda line: re.sub(r"[\W_]+", " ", line).strip().lower()
    documents = defaultdict(int)
    places = defaultdict(lambda: defaultdict(set))
    for _, text, _, source, _ in rows:
        documents[source] += 1
        lines = {plain(x) for x in (text or "").split("\n")} - {""}
        for line in lines:
            places[source][line].add(frozenset(lines - {line}))
    return {s: {x for x, p in own.items() if len(p) > max(10, documents[s] / 10)} for s, own in places.items()}, plain


@pytest.fixture(scope="module")
def stages(session, tmp_path_factory):
    """Input and output rows of every stage, and the folder of the tables."""
    folder = str(tmp_path_factory.mktemp("tables"))
    rows, items = corpus()
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    session.createDataFrame(rows, schema).repartition(3).write.parquet(f"{folder}/documents.parquet")
    session.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs, seen = session.read.parquet(f"{folder}/documents.parquet"), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(session, docs, folder).write.parquet(f"{folder}/stage{i}")
        docs = session.read.parquet(f"{folder}/stage{i}")
        if i < 4:
            assert docs.columns == before.columns
        seen.append((before.collect(), docs.collect()))
    return seen, items, folder


def test_quality(stages):
    before, after = stages[0][0]
    common, plain = common_lines(before)
    assert all(MENU_LINE in common[s] for s in common for MENU_LINE in [plain(MENU)])
    want = {}
    for doc_id, text, _, source, _ in before:
        n_words, failed = counts(text)[0], counts(text)[5]
        lines = (text or "").split("\n")
        kept = [x for x in lines if plain(x) not in common[source]]
        left = len(" ".join(kept).split())
        if not failed and (len(kept) == len(lines) or (left >= 10 and left * 5 >= n_words)):
            want[doc_id] = "\n".join(kept)
    assert {r["doc_id"]: r["text"] for r in after} == want
    assert all(r["n_chars"] == len(r["text"]) for r in after)
    assert 0 < len(want) < len(before)


def test_near_duplicates(stages):
    before, after = stages[0][1]
    pairs = [(r["doc_id"], r["text"]) for r in before]
    assert {r["doc_id"] for r in after} == {component for _, _, component in groups(pairs, 5, 80)}
    assert len(after) < len(before)


def test_decontamination(stages):
    before, after = stages[0][2]
    clean = {r["doc_id"] for r in before if not hits(r["text"], stages[1])[3]}
    assert {r["doc_id"] for r in after} == clean and len(after) == len(before) - 12


def test_mixture(stages):
    before, after = stages[0][3]
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in before:
        sizes[r["source"]] += size(r["text"])
    for r in after:
        taken[r["source"]] += size(r["text"])
    longest = max(size(r["text"]) for r in before)
    for source, target in brute_targets(sizes).items():
        assert abs(taken[source] - target) <= longest / 2 + 1
    assert max(Counter(r["doc_id"] for r in after).values()) <= 2


def test_shards(stages):
    before, after = stages[0][4]
    key = lambda r: (r["doc_id"], r["text"])
    assert Counter(map(key, before)) == Counter(map(key, after))
    slots, sizes = defaultdict(list), defaultdict(int)
    for r in after:
        slots[r["shard"]].append(r["slot"])
        sizes[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(sizes.values()) - min(sizes.values()) <= 2 * max(r["size"] for r in after)


def test_run_gives_the_rows_of_the_stages(session, stages):
    shape = lambda rows: Counter((r["doc_id"], r["size"], r["shard"]) for r in rows)
    assert shape(corpus_pipeline.run(session, stages[2]).collect()) == shape(stages[0][4][1])


def test_empty_tables(session, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    session.createDataFrame([], schema).write.parquet(f"{tmp_path}/documents.parquet")
    session.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(session, str(tmp_path)).count() == 0
