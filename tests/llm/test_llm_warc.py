from __future__ import annotations

import gzip
import hashlib
import re
from pathlib import Path

import pytest

from perkline.llm import warc

warc_stored = warc.stored

SCHEMA = "page_id long, url string, html string, digest string, shard int"


def build(session, rows):
    return session.createDataFrame([(*r, "clash", 7) for r in rows], SCHEMA).repartition(3)


def brute(rows):
    out = []
    for page_id, url, html in rows:
        payload = (html or "").encode()
        refers = None
        if len(payload) >= warc.MIN_REVISIT:
            last = max((p for p, _, h in rows if h == html and p is not None), default=None)
            refers = last if page_id != last else None
        out.append((page_id, url, "response" if refers is None else "revisit", len(payload), hashlib.sha1(payload).hexdigest(), refers))
    return sorted(out, key=repr)


@pytest.fixture
def pages():
    rows = [(i, f"http://x/{i}", f"<p>{i}</p>" * (i % 40)) for i in range(300)]
    rows += [(1000 + i, "http://copy/", "é" * 600) for i in range(90)]
    rows += [(2000 + i, None, "short copy") for i in range(5)]
    rows += [(5, "http://x/5", "<p>5</p>" * 5), (None, "http://none/ü?a=b%20c\r\nX: y", None), (None, None, "é" * 600), (1089, "http://copy/", "é" * 600)]
    rows += [(9000, "http://long/", "long " * 300_000)]
    return rows


def test_round_trip(session, folder, pages):
    manifest = warc.write_archives(build(session, pages), folder, shard_bytes=200_000, roll_bytes=4_000)
    got = sorted((tuple(r) for r in warc.read_archives(manifest, folder).collect()), key=repr)
    assert got == brute(pages)
    files = manifest.collect()
    assert len({r["shard"] for r in files}) > 2 and len(files) > len({r["shard"] for r in files})
    assert sum(r["records"] for r in files) == len(pages)
    for r in files:
        data = Path(folder, r["file"]).read_bytes()
        assert (len(data), hashlib.sha256(data).hexdigest()) == (r["bytes"], r["sha256"])
        assert gzip.decompress(data).count(b"WARC/1.1\r\n") == r["records"]
    assert sorted(p.name for p in Path(folder).iterdir() if "shard-" not in p.name and not p.name.startswith(".")) == ["manifest"]
    # The folder alone is enough to read the archive.
    alone = warc.read_archives(warc.read_manifest(session, folder), folder)
    assert sorted((tuple(r) for r in alone.collect()), key=repr) == brute(pages)


def test_same_bytes_from_rows_in_any_order(session, tmp_path, pages):
    folders = []
    for i, rows in enumerate((pages, pages[::-1])):
        folders.append(tmp_path / str(i))
        warc.write_archives(build(session, rows), str(folders[-1]), shard_bytes=200_000, roll_bytes=4_000)
    first, second = ({p.name: p.read_bytes() for p in f.glob("*.gz")} for f in folders)
    assert first == second and first


def test_files_that_the_manifest_does_not_name_are_ignored(session, folder, pages):
    manifest = warc.write_archives(build(session, pages[:20]), folder)
    Path(folder, ".left-over-shard-000000-00000.warc.gz").write_bytes(b"half a file")
    Path(folder, "shard-000099-00000.warc.gz").write_bytes(b"of another attempt")
    assert warc.read_archives(manifest, folder).count() == 20


def test_files_of_a_broken_attempt_go_with_the_commit(session, folder, pages):
    broken = Path(folder, warc.TEMPORARY, "0" * 32 + "-shard-000000-00000.warc.gz")
    broken.parent.mkdir()
    broken.write_bytes(b"half a file")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        warc.read_manifest(session, folder).count()  # unfinished
    warc.write_archives(build(session, pages[:20]), folder)
    assert not broken.parent.exists() and warc.read_manifest(session, folder).count() == 1
    with pytest.raises(FileExistsError):
        warc.write_archives(build(session, pages[:20]), folder)


def test_a_shard_is_written_by_a_task_of_its_own(session, folder, pages, monkeypatch):
    taken = []
    monkeypatch.setattr(warc, "stored", lambda df, purpose: taken.append(df) or warc_stored(df, purpose))
    manifest = warc.write_archives(build(session, pages), folder, shard_bytes=200_000, roll_bytes=4_000)
    plan = taken[-1]._jdf.queryExecution().executedPlan().toString()
    shards = {r["shard"] for r in manifest.collect()}
    assert re.search(r"Exchange \w*passthrough\w*\(", plan, re.I), re.findall("Exchange.*", plan)
    assert len(shards) > 2


def test_damage_is_noticed(session, folder, pages):
    manifest = warc.write_archives(build(session, pages[:20]), folder)
    path = next(Path(folder).glob("shard*"))
    path.write_bytes(path.read_bytes()[:-30])
    with pytest.raises(Exception):
        warc.read_archives(manifest, folder).count()


def test_no_rows(session, folder):
    manifest = warc.write_archives(build(session, [(1, "u", "h")]).where("false"), folder)
    assert manifest.count() == 0 and warc.read_archives(manifest, folder).count() == 0
