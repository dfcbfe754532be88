from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from perkline.llm import fingerprints as fp
from perkline.llm.queries import QUERIES

MASK = (1 << 64) - 1


def mix(x):
    return int(fp.mixed(np.array([x & MASK], np.uint64))[0])


def toss(values, bits):
    out = []
    for i, v in enumerate(values):
        before = values[i - 1] if i else ~v & ((1 << bits) - 1)
        low = 0
        while (v >> low & 1) == (before >> low & 1):
            low += 1
        out.append(2 * low + (v >> low & 1))
    return out


def labels_of(symbols):
    labels = toss(symbols, 64)
    for _ in range(3):
        labels = toss(labels, 8)
    assert max(labels) < 6
    for value in (3, 4, 5):
        for i, v in enumerate(labels):
            if v == value:
                beside = labels[max(0, i - 1) : i] + labels[i + 1 : i + 2]
                labels[i] = min(set(range(3)) - set(beside))
    return labels


def levels_of(text):
    """All levels of one text, symbol by symbol: symbols after each cut, and the runs found before it."""
    symbols, cuts, runs = [int(fp.SYMBOLS[b]) for b in text], [], []
    while symbols:
        merged, found = [], []
        for s in symbols:
            if found and found[-1][0] == s:
                found[-1][1] += 1
            else:
                found.append([s, 1])
        runs.append(found)
        merged = [s if n == 1 else mix(s * fp.BASE + n) for s, n in found]
        if len(merged) == 1:
            return merged[0], cuts, runs
        labels = labels_of(merged)
        starts = [0] + [i for i in range(1, len(labels) - 1) if labels[i - 1] < labels[i] > labels[i + 1]]
        symbols = []
        for a, b in zip(starts, [*starts[1:], len(merged)]):
            name = b - a
            for s in merged[a:b]:
                name = (name * fp.BASE + mix(s)) & MASK
            symbols.append(mix(name))
        cuts.append(symbols)
    return 0, cuts, runs


def brute(text):
    name, cuts, runs = levels_of(text)
    bags = {level: list(cuts[level - 1]) if level <= len(cuts) else [] for level in (1, 3)}
    for found, step in zip(runs[:3], fp.RUN_STEPS):
        bags[3] += [s for s, n in found for _ in range(n // step)]
    out = name.to_bytes(8, "big")
    for level in (3, 1):
        seen, hashes = {}, []
        for s in bags[level]:
            short = mix(s) >> 32
            seen[short] = seen.get(short, 0) + 1
            hashes.append(mix((short << 32) + seen[short] * fp.BASE) >> 32)
        if level == 3 or len(bags[3]) < fp.MANY:
            low = sorted(hashes)[: fp.SLOTS]
            out += b"".join(int(v).to_bytes(4, "big") for v in (len(hashes), len(low), *low))
    return out


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 9))) for _ in range(n))


def test_parsing_equals_brute_force():
    rng = random.Random(3)
    texts = ["", "a", "ab", "aaaa", "aab", "ab" * 40, "x" * 500, "Eres " * 300, "é東", prose(rng, 5), prose(rng, 40), prose(rng, 400)]
    texts += ["".join(rng.choice("ab") for _ in range(n)) for n in range(3, 80)]
    texts = [t.encode() for t in texts]
    assert fp.fingerprints(texts) == [brute(t) for t in texts]
    assert fp.fingerprints(texts[::-1]) == fp.fingerprints(texts)[::-1]


def test_labels_differ_and_cut_into_short_phrases():
    rng = random.Random(4)
    symbols = fp.mixed(np.array([rng.randrange(1, 50) for _ in range(20_000)], np.uint64))
    symbols, ends, _, _ = fp.collapse_runs(symbols, np.array([0, 9_000, 20_000]))
    labels = fp.labelled(symbols, ends[:-1], ends[1:] - 1)
    inside = np.ones(len(labels), bool)
    inside[ends[:-1]] = False
    assert (labels[1:] != labels[:-1])[inside[1:]].all() and labels.max() == 2
    top = np.flatnonzero((labels[1:-1] > labels[:-2]) & (labels[1:-1] > labels[2:]))
    assert 2 <= np.diff(top).min() and np.diff(top).max() <= 5


def test_equal_substrings_share_their_interior():
    rng = random.Random(5)
    shared = prose(rng, 2000)
    for lead in ("", "x", "xyz ", prose(rng, 17), prose(rng, 300)):
        one, other = levels_of(shared.encode())[1], levels_of((lead + shared + prose(rng, 50)).encode())[1]
        for level in range(4):
            inner = one[level][8:-8]
            text, where = other[level], "-".join(map(str, other[level]))
            assert len(inner) > 20 and "-".join(map(str, inner)) in where and len(text) >= len(inner)


def test_likeness():
    rng = random.Random(6)
    text = prose(rng, 900)
    half = text[: len(text) // 2]
    same, edited, other, nothing = fp.fingerprints([t.encode() for t in (text, half + prose(rng, 450), prose(rng, 900), "")])
    assert fp.likeness(same, same) == 1 == fp.likeness(nothing, nothing)
    assert 0.3 < fp.likeness(same, edited) < 0.7 and fp.likeness(same, other) < 0.1
    assert fp.likeness(same, nothing) == 0 == fp.likeness(nothing, same)


def expected(pairs):
    pairs = sorted(((d, t or "") for d, t in pairs), key=lambda p: (p[0] is None, -(p[0] or 0)))
    out = []
    for (d, text), (_, after) in zip(pairs, pairs[1:] + pairs[:1]):
        changed = fp.edited(text, after)
        a, b, c = fp.fingerprints([text.encode(), changed.encode(), after.encode()])
        out.append((d, len(text), hashlib.sha256(changed.encode()).hexdigest(), a.hex(), b.hex(), fp.likeness(a, b), fp.likeness(a, c)))
    return sorted(out, key=repr)


def result(df):
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return sorted(
        (tuple(bytes(v).hex() if isinstance(v, (bytes, bytearray)) else v for v in r) for r in df.select(*names).collect()), key=repr
    )


@pytest.mark.parametrize("partitions", [1, 7])
def test_documents(session, documents, partitions):
    rng = random.Random(7)
    pairs = [(i * 3 % 101, prose(rng, rng.randint(0, 60))) for i in range(101)] + [(500, None), (501, ""), (502, "ü" * 10)]
    pairs += [(600, prose(rng, 40_000)), (-5, "first of all ids"), (None, "without id")]
    before = session.conf.get("spark.sql.shuffle.partitions"), session.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    session.conf.set("spark.sql.shuffle.partitions", partitions)
    session.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = result(fp.fingerprint_documents(documents(pairs)))
    finally:
        session.conf.set("spark.sql.shuffle.partitions", before[0])
        session.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])
    assert got == expected(pairs)


def test_odd_rows(documents, odd_texts):
    got = result(fp.fingerprint_documents(documents(odd_texts)))
    assert len(got) == len(odd_texts)
    # The next document of the first of two repeated rows is the second.
    (name,) = fp.fingerprints([b"One two three four five six."])
    same = [r for r in got if r[0] == 6 and r[3] == name.hex()]
    assert len(same) == 2 and 1.0 in {r[6] for r in same}


@pytest.mark.parametrize("pairs", [[], [(1, "alone in the table")]])
def test_empty_and_single(documents, pairs):
    assert result(fp.fingerprint_documents(documents(pairs))) == expected(pairs)


def test_query(session):
    rows = QUERIES["op13_fingerprints"](session, "/root/testdata/sf0.001").collect()
    texts = session.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert [tuple(r)[:3] + tuple(r)[3:5] for r in sorted(rows)] == [e[:5] for e in sorted(expected([tuple(t) for t in texts]))]
    assert sum(r["near_edited"] for r in rows) / len(rows) > 0.6
