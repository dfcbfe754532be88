from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from perkline.llm import collocations as co

SCHEMA = "doc_id long, text string, lang string, shard string, number string, low string, n string, rank string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def build(session, rows, parts=3):
    return session.createDataFrame([(i, t, v, "a", "b", "c", "d", "e") for i, (t, v) in enumerate(rows)], SCHEMA).repartition(parts)


def pieces_of(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
        words = re.findall(r"[^\x20\x09]+", piece)
        if words:
            yield words


def brute(rows, longest, least, top):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for words in pieces_of(text):
            totals[lang] += len(words)
            for m in range(1, longest + 1):
                for i in range(len(words) - m + 1):
                    counts[lang][tuple(words[i : i + m])] += 1
    out = []
    for lang, found in counts.items():
        ranked = []
        for phrase, a in found.items():
            m = len(phrase)
            if m < 2 or a < least:
                continue
            inside = lambda q: any(q[i : i + m] == phrase for i in range(len(q) - m + 1))
            if any(len(q) > m and c >= a and inside(q) for q, c in found.items()):
                continue
            cuts = [(1000 * a * totals[lang] // (found[phrase[:k]] * found[phrase[k:]]), k) for k in range(1, m)]
            score, k = min(cuts)
            ranked.append((-score, -a, " ".join(phrase).encode(), found[phrase[:k]], found[phrase[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def rows():
    rng = random.Random(11)
    vocabulary = ["the", "of", "New", "york", "é", "city", "Hall", "東京", "a", "b"]
    weights = [9, 7, 4, 4, 3, 3, 2, 2, 1, 1]
    out = []
    for i in range(150):
        words = rng.choices(vocabulary, weights, k=rng.randint(0, 30))
        if i % 3 == 0:
            words += ["once", "upon", "a", "time", "there", "was"]
        text = "".join(w + rng.choice([" ", " ", " ", "\t", "  ", ", ", ".", "\n", "\r\n", "; "]) for w in words)
        out.append((text, rng.choice(["en", "en", "en", "fr", None, "und", ""])))
    out += [(None, "en"), ("", "en"), (" \t.,\n", None), ("alone", "xx"), ("the the the the the the", "en")]
    out += [("repeated row of words", "en")] * 9 + [("long " * 30_000 + "end", "long")]
    return out


@pytest.mark.parametrize(("shard_words", "longest"), [(1, 5), (300, 5), (10**6, 5), (300, 3), (300, 2)])
def test_equals_brute_force(session, rows, shard_words, longest):
    got = found(co.collocations(build(session, rows), longest=longest, least=4, top=25, shard_words=shard_words))
    assert got == brute(rows, longest, 4, 25)


def test_frequent_only_in_all_shards_together(session):
    # Every shard sees the phrase once; a word of one shard is frequent there alone.
    rows = [("rare phrase here", "en")] * 12 + [("busy " * 40, "en")]
    got = found(co.collocations(build(session, rows, 5), least=12, shard_words=1))
    assert got == brute(rows, 5, 12, 2000) and any(r[2] == "rare phrase here" for r in got)


@pytest.mark.parametrize("rows", [[], [(None, None)], [("one two three", "en")]])
def test_nothing_frequent(session, rows):
    assert found(co.collocations(build(session, rows), least=2)) == []


def test_equal_scores_take_the_first_cut_and_byte_order(session):
    rows = [("x y z", "en")] * 3 + [("Z q", "en"), ("z Q", "en"), ("z q", "en"), ("É k", "en"), ("é k", "en"), ("É k", "en"), ("é k", "en")]
    got = found(co.collocations(build(session, rows), longest=3, least=2))
    assert got == brute(rows, 3, 2, 2000)


def test_large_products_are_exact(session):
    from pyspark.sql import functions as F

    a, n, left, right = 3_000_000_007, 9_000_000_000_011, 4_000_000_009, 5_000_000_021
    row = session.range(1).select(
        co.weakest_cut(F.lit(a), F.lit(n), F.array(F.lit(left)), F.array(F.lit(right))).alias("c")
    ).first()["c"]
    assert (row["score"], row["l"], row["r"]) == (1000 * a * n // (left * right), left, right)


def test_index_intervals():
    # Extensions in both directions against the positions of a random text.
    rng = random.Random(2)
    text = "".join(rng.choice("ab c.") for _ in range(4000))
    ((words, new, rows),) = co.words_of(pa.array([text]))
    symbols, names, _ = co.sequence_of(words, new, rows.astype(np.int64))
    names = names.to_pylist()
    left, right = co.transform(symbols, 3), co.transform(symbols[::-1], 3)
    counts = np.bincount(symbols)
    low, size = (np.cumsum(counts) - counts)[1:], counts[1:]
    two = Counter(tuple(p[i : i + 2]) for p in pieces_of(text) for i in range(len(p) - 1))
    lows, sizes, others, of, word = co.extended(left, low, size, low)
    assert {(names[a - 1], names[b]): s for a, b, s in zip(word, of, sizes)} == dict(two)
    # The backward index has the same pairs, and says where they lie in the forward one.
    back = co.extended(right, low, size, low)
    assert sorted(zip(others, sizes, lows)) == sorted(zip(back[0], back[1], back[2]))
    order = np.argsort(others)
    assert (np.diff(others[order]) >= sizes[order][:-1]).all()


def test_cut_sequence():
    symbols = np.array([0, 1, 2, 3, 0, 4, 5, 0, 6], np.int32)
    pairs = {(1, 2), (4, 5)}
    alive = np.array([(a, b) in pairs for a, b in zip(symbols, symbols[1:])])
    assert co.cut_sequence(symbols, alive).tolist() == [0, 1, 2, 0, 4, 5]
    chain = np.array([0, 1, 2, 3, 4], np.int32)
    assert co.cut_sequence(chain, np.array([False, True, False, True])).tolist() == [0, 1, 2, 0, 3, 4]
    assert co.cut_sequence(chain, np.array([False, True, True, False])).tolist() == [0, 1, 2, 3]
    assert co.cut_sequence(chain, np.zeros(4, bool)).tolist() == []


def test_few_and_small_slices(session, rows, monkeypatch):
    # Many words share a bucket, and every shard's buckets lie in many slices.
    monkeypatch.setattr(co, "SLICE_BITS", 3)
    monkeypatch.setattr(co, "BUCKET_BYTES", 2000)
    got = found(co.collocations(build(session, rows), least=4, top=25, shard_words=300))
    assert got == brute(rows, 5, 4, 25)
