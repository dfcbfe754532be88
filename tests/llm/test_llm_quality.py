from __future__ import annotations

import random
import re
from collections import Counter

from perkline.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), repeated, len(covered), failed)


def counts(r):
    return tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))


def test_counts_equal_brute_force(documents, odd_texts):
    pairs = odd_texts + [
        (20, "a b c d e f a b c d e f # * <tag> a b c d e"),
        (21, "same line\nsame line\n\n\n  \nsame  line\nsame line"),
        (22, "x " * 500),
        (23, "ende\r\nende\r\nende"),
    ]
    got = Counter((r["doc_id"], counts(r)) for r in quality.judge(documents(pairs)).collect())
    assert got == Counter((d, brute(t)) for d, t in pairs)


def filler(i, n=12):
    return " ".join(f"own{i}x{k}" for k in range(n))


def test_common_lines_go_and_depleted_documents_are_rejected(documents):
    menu = "Home | Products, and all about Us: contact & imprint of the company"
    pairs = [(i, f"{filler(i)}\n{menu}\n{filler(i + 500, 13)}z") for i in range(30)]
    pairs += [(100 + i, f"{menu.upper()}\nshort rest {i}") for i in range(5)]
    sources = ["host"] * len(pairs)
    judged = {r["doc_id"]: r for r in quality.judge(documents(pairs, sources)).collect()}
    assert all(judged[i]["kept"] and len(judged[i]["removed"]) == 1 for i in range(30))
    assert not any(judged[100 + i]["kept"] for i in range(5))
    cleaned = {r["doc_id"]: r for r in quality.clean(documents(pairs, sources)).collect()}
    assert set(cleaned) == set(range(30))
    assert cleaned[3]["text"] == f"{filler(3)}\n{filler(503, 13)}z"
    assert cleaned[3]["n_chars"] == len(cleaned[3]["text"])


def test_hosts_are_counted_apart(documents):
    line = "a line that many hosts have but each only a few times"
    pairs = [(i, f"{filler(i)}\n{line}") for i in range(60)]
    kept = quality.judge(documents(pairs, [f"host{i % 10}" for i in range(60)])).collect()
    assert all(r["kept"] and r["removed"] is None for r in kept)


def brute_verdicts(rows, min_documents=10, max_share=0.1, min_left=20):
    """(doc_id, kept, words of removed lines) of (doc_id, text, host) rows: distinct line sets are documents."""

    def plain(line):
        return re.sub(r"[\W_]+", " ", line).strip().lower()

    def lines(text):
        return frozenset(filter(None, map(plain, (text or "").split("\n"))))

    sets = {(host, lines(text)) for _, text, host in rows}
    of_host = Counter(host for host, _ in sets)
    count = Counter((host, line) for host, own in sets for line in own)
    common = {k for k, n in count.items() if n > max(min_documents, max_share * of_host[k[0]])}
    out = []
    for doc_id, text, host in rows:
        n, failed = brute(text)[0], brute(text)[-1]
        gone = [line for line in (text or "").split("\n") if (host, plain(line)) in common]
        left = n - sum(len(WORD.findall(line)) for line in gone)
        depleted = bool(gone) and (left < 10 or 100 * left < min_left * n)
        out.append((doc_id, not failed and not depleted, n - left))
    return Counter(out)


def verdicts(df):
    return Counter((r["doc_id"], r["kept"], r["n_words"] - r["words_left"]) for r in df.collect())


def test_verdicts_equal_brute_force(documents):
    rng = random.Random(12)
    shared = [f"shared line number {k} of all the hosts, with some words" for k in range(12)]
    rows = []
    for i in range(400):
        own = [filler(rng.randrange(300), rng.randint(1, 14)) for _ in range(rng.randint(0, 3))]
        text = "\n".join(rng.sample(own + rng.sample(shared, rng.randint(0, 6)), k=len(own)) + rng.sample(shared, rng.randint(0, 5)))
        rows.append((i, rng.choice([None, text, text.upper(), text + "\n***\n\n"]), rng.choice(["hot", "hot", "a", "", None])))
    rows += rows[:50]
    docs = documents([r[:2] for r in rows], [r[2] for r in rows])
    assert verdicts(quality.judge(docs)) == brute_verdicts(rows)
    assert verdicts(quality.judge(docs, min_documents=3, max_share=0.02)) == brute_verdicts(rows, 3, 0.02)


def test_copies_do_not_reject_each_other(documents):
    text = "\n".join(filler(k) for k in range(6))
    pairs = [(i, text) for i in range(40)]
    pairs += [(100 + i, "\n".join(reversed(text.split("\n"))) + "\n" * i) for i in range(40)]
    pairs += [(200 + i, filler(1000 + i)) for i in range(40)]
    assert all(r["kept"] for r in quality.judge(documents(pairs, ["host"] * 120)).collect())


def test_a_footer_is_found_whatever_the_own_lines_look_like(documents):
    """Own lines made by a template differ in a word only; their documents are different all the same."""
    footer = [f"footer line {k} that is on every page of the host" for k in range(6)]
    own = {
        "words": lambda i: [filler(i)],
        "template": lambda i: [f"Posted by user{i} on the public forum today"],
        "two": lambda i: [f"Posted by user{i} on the public forum today", f"There are {i} answers to this question so far"],
    }
    for lines in own.values():
        pairs = [(i, "\n".join([*lines(i), *footer])) for i in range(300)]
        judged = quality.judge(documents(pairs, ["host"] * 300)).collect()
        assert all(len(r["removed"]) == 6 for r in judged)


def test_documents_that_are_mostly_template_are_found(documents):
    """Twenty lines of a template and two own ones: every template line is in every document."""
    for n_template in (20, 5):
        template = "\n".join(f"part {k} of the template that all pages of this host have" for k in range(n_template))
        pairs = [(i, f"{filler(i)}\n{template}\n{filler(i + 5000)}") for i in range(300)]
        judged = quality.judge(documents(pairs, ["host"] * 300)).collect()
        assert {len(r["removed"] or []) for r in judged} == {n_template}
        assert all(r["words_left"] == 24 for r in judged)
    pairs = [(i, f"{template}\n{template.replace('part', 'block')}\nown{i} word{i}") for i in range(300)]
    assert not any(r["kept"] for r in quality.judge(documents(pairs, ["host"] * 300)).collect())


def test_columns_with_names_of_helpers_stay(documents):
    pairs = [(i, f"{filler(i)}\n{filler(9999)}") for i in range(40)]
    docs = documents(pairs, ["host"] * 40).selectExpr("*", "doc_id as _key", "'mine' as _host", "1.5 as _removed")
    got = quality.clean(docs).collect()
    assert len(got) == 40 and all((r["_key"], r["_host"], float(r["_removed"])) == (r["doc_id"], "mine", 1.5) for r in got)
    assert all(r["text"] == filler(r["doc_id"]) for r in got)


def test_odd_rows(documents, odd_texts):
    assert quality.judge(documents(odd_texts).where("false")).count() == 0
    assert quality.clean(documents(odd_texts).where("false")).count() == 0
    cleaned = quality.clean(documents(odd_texts, [None, ""] + ["a"] * 11))
    assert cleaned.columns == documents(odd_texts).columns
    # Fewer than ten words each, but for the long ones.
    assert sorted(r["doc_id"] for r in cleaned.collect()) == [7, 8]
