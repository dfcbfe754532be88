from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from perkline.llm import manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, tree string, node string"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, more=0):
    doc_id, text, lang, source, n = row
    n = None if n is None else n + more
    fields = (doc_id, source, lang, n, text)
    return digest("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def tree(nodes):
    """Root, and each leaf's siblings as (side, node)."""
    groups, proofs = [[i] for i in range(len(nodes))], [[] for _ in nodes]
    while len(nodes) > 1:
        above, merged = [], []
        for i in range(0, len(nodes), 2):
            pair = nodes[i : i + 2]
            for member in groups[i]:
                proofs[member].append((">", pair[1]) if len(pair) == 2 else None)
            if len(pair) == 2:
                for member in groups[i + 1]:
                    proofs[member].append(("<", pair[0]))
            above.append(digest("".join(pair)))
            merged.append(sum(groups[i : i + 2], []))
        nodes, groups = above, merged
    return nodes[0], proofs


def brute(rows):
    langs = sorted({r[2] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    parts = []
    for lang in langs:
        own = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        parts.append((own, *tree([leaf_of(r) for r in own])))
    root, tops = tree([p[1] for p in parts])
    out = []
    for (own, subroot, proofs), top in zip(parts, tops):
        for row, proof in zip(own, proofs):
            path = [*proof, *top]
            out.append((row[0], leaf_of(row), subroot, root, ["" if s is None else s[0] + s[1] for s in path]))
    return sorted(out, key=repr)


def build(session, rows):
    return session.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(4)


def found(df):
    got = df.select("kept.doc_id", "leaf", "subroot", "root", "witness").collect()
    return sorted(((r[0], r[1], r[2], r[3], list(r[4])) for r in got), key=repr)


@pytest.fixture
def rows():
    out = [(i, f"text {i} é" * (i % 4), "en", None if i % 5 else "s", i % 9 if i % 11 else None) for i in range(37)]
    out += [(i, f"t{i}", "de", "s", 1) for i in range(40, 48)]
    out += [(100, None, None, None, None), (101, "", "", "s", 0), (None, "no id", "fr", "s", 5), (None, "other", "fr", "s", 5)]
    out += [(200, "same", "fr", "s", 4)] * 3 + [(200, "tie", "fr", "s", 3), (300, "long " * 200_000, "ñ", "s", 10**6)]
    return out


@pytest.mark.parametrize("height", [1, 2, 10])
def test_trees_and_witnesses(session, rows, monkeypatch, height):
    # Small blocks: several levels of appended block roots, and more trees than a block holds.
    monkeypatch.setattr(manifest, "HEIGHT", height)
    monkeypatch.setattr(manifest, "BLOCK", 1 << height)
    if height != 10:
        monkeypatch.setattr(manifest, "_append_blocks", small_blocks(height))
    assert found(manifest.merkle_manifest(build(session, rows))) == brute(rows)


def small_blocks(height):
    def append(batches):
        from perkline.llm import manifest as here

        here.HEIGHT, here.BLOCK = height, 1 << height
        try:
            yield from here._append_blocks(batches)
        finally:
            here.HEIGHT, here.BLOCK = 10, 1 << 10

    return append


def test_more_leaves_than_a_block(session):
    rows = [(i, "t", "en", "s", i) for i in range(2100)]
    assert found(manifest.merkle_manifest(build(session, rows))) == brute(rows)


def test_folding_finds_changes(session, rows):
    keep = {"doc_id": F.col("doc_id"), "n_chars": F.col("n_chars")}
    made = manifest.merkle_manifest(build(session, rows), keep=keep)
    changed = F.when(F.col("kept.doc_id") % 3 == 0, F.sha2(F.col("leaf"), 256)).otherwise(F.col("leaf"))
    got = made.select("kept.doc_id", (manifest.folded(changed, F.col("witness")) == F.col("root")).alias("ok"))
    assert all(r["ok"] == (r["doc_id"] is None or r["doc_id"] % 3 != 0) for r in got.collect())


def test_proof_digest(session, rows):
    made = manifest.merkle_manifest(build(session, rows))
    for r in made.select("witness", manifest.proof_digest(F.col("witness")).alias("p")).collect():
        assert r["p"] == digest("".join(s[1:] for s in r["witness"]))


@pytest.mark.parametrize("rows", [[], [(1, "alone", None, None, None)]])
def test_empty_and_single(session, rows):
    assert found(manifest.merkle_manifest(build(session, rows))) == (brute(rows) if rows else [])


def test_crc_of_ids():
    assert zlib.crc32(b"123456789") == 0xCBF43926
