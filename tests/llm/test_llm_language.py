from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from perkline.llm import language


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(6)
    parts = {"xx": ["ka", "lo", "mi", "tu"], "yy": ["strö", "über", "sch", "ung"], "zz": ["eau", "tion", "oir", "ché"]}
    out = []
    for i in range(600):
        lang = rng.choice(list(parts))
        words = ["".join(rng.choice(parts[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(3, 60))]
        out.append((i, " ".join(words).capitalize() + ".", lang))
    return out


SCHEMA = "doc_id long, text string, lang string, score double"


def build(session, rows):
    return session.createDataFrame([(*r, 0.5) for r in rows], SCHEMA).repartition(3)


def test_held_out_accuracy(session, rows):
    docs = build(session, rows)
    got = {r["doc_id"]: r for r in language.identify(docs, language.train(docs)).collect()}
    held = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    folds = docs.select("doc_id", language.held_out(docs["doc_id"]).alias("h")).collect()
    assert {r["doc_id"] for r in folds if r["h"]} == set(held)
    right = [got[i]["lang_pred"] == lang for i, _, lang in rows if i in set(held)]
    assert sum(right) >= 0.97 * len(right)
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_labels_of_held_out_rows_teach_nothing(session, rows):
    wrong = [(i, t, "no" if zlib.crc32(str(i).encode()) % 4 == 2 else lang) for i, t, lang in rows]
    model = language.train(build(session, wrong))
    assert model.languages == ["xx", "yy", "zz"]


def test_presence_and_kernel_equal_brute_force():
    texts = ["Ab ba", "", "über ab", "a", None]
    rows = np.concatenate([r for _, r in language.presence(pa.array(texts))])

    def grams(text):
        plain = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in (text or "").encode())
        return {plain[i : i + n] for n in language.ORDERS for i in range(len(plain) - n + 1)}

    sets = [grams(t) for t in texts]
    assert rows.sum(axis=1).tolist() == [len(s) for s in sets]
    got = language.kernel(rows, rows)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            assert got[i, j] == pytest.approx(len(a & b) / np.sqrt(max(1, len(a)) * max(1, len(b))), abs=1e-6)


def test_odd_rows(session, rows, odd_texts):
    docs = build(session, rows)
    model = language.train(docs)
    odd = build(session, [(d, t, None) for d, t in odd_texts] + [(70, "12 34 !?", "xx"), (71, "²", "xx"), (72, "東", None)])
    got = sorted(((r["doc_id"], r["lang_pred"], r["score"]) for r in language.identify(odd, model).collect()), key=repr)
    unknown = [(d, s) for d, lang, s in got if lang == "und"]
    assert sorted(unknown, key=repr) == sorted([(1, 0.0), (2, 0.0), (3, 0.0), (None, 0.0), (70, 0.0), (71, 0.0)], key=repr)
    assert len(got) == len(odd_texts) + 3
    assert language.train(odd.where("lang is null")) is None
    assert {r["lang_pred"] for r in language.identify(odd, None).collect()} == {"und"}
    assert language.identify(docs.where("false"), model).count() == 0


def test_sample_is_bounded(session, rows):
    copies = [(10_000 + i, rows[0][1], rows[0][2]) for i in range(900)]
    model = language.train(build(session, rows + copies), sample=60)
    assert len(model.landmarks) <= 60


def test_a_language_of_many_copies_of_few_texts_is_learned(session, rows):
    few = [(20_000 + i, f"quo{i % 5} vadis domine{i % 5} quod erat", "cc") for i in range(2000)]
    docs = build(session, rows + few)
    model = language.train(docs, sample=40)
    assert model.languages == ["cc", "xx", "yy", "zz"]
    # Ten of each of the others, all five of this one.
    assert len(model.landmarks) == 35
    got = language.identify(docs.where("lang = 'cc'"), model).groupBy("lang_pred").count().collect()
    assert [tuple(r) for r in got] == [("cc", 2000)]
