"""Runs of words against brute force, and the registered query against its contract replayed in Python."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from kpiloom.llm import periodic_runs, queries
from kpiloom.llm.common import table
from tests.conftest import SF_DIR

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_lyndon(text):
    """Longest Lyndon word: up to the next smaller suffix."""
    out = []
    for i in range(len(text)):
        k = 1
        while i + k < len(text) and not text[i + k:] < text[i:]:
            k += 1
        out.append(k)
    return out


def brute_runs(words, least):
    """Every stretch that keeps its smallest period and that no neighbour continues."""
    n, out = len(words), []
    for period in range(1, n // 2 + 1):
        start = 0
        while start + period < n:
            if words[start] != words[start + period]:
                start += 1
                continue
            end = start + period
            while end < n and words[end] == words[end - period]:
                end += 1
            if end - start >= max(least, 2 * period):
                part = words[start:end]
                if all(part[q:] != part[:-q] for q in range(1, period)):
                    out.append((start, end - start, period))
            start = end - period + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def kept(words, runs):
    return [w for i, w in enumerate(words) if not any(s + p <= i < s + n for s, n, p in runs)]


@pytest.mark.parametrize("seed", range(4))
def test_lyndon_lengths_and_runs(seed):
    rng = random.Random(seed)
    for _ in range(150):
        letters = rng.randint(1, 4)
        words = [rng.randrange(letters) for _ in range(rng.randint(0, 40))]
        if rng.random() < 0.5:
            words = (words + words[: rng.randint(1, 7)] * 7)[:70]
        ranks = [sorted(set(words)).index(w) for w in words]
        assert periodic_runs.lyndon_lengths(ranks) == brute_lyndon(ranks)
        least = rng.choice([1, 2, 3, 6, 11, 12])
        text = [str(w) for w in words]
        assert periodic_runs.runs_of_words(text, least) == brute_runs(text, least)


def test_words_that_defeat_prefix_hashes():
    # The Thue-Morse word has colliding polynomial hashes modulo powers of two.
    words = [str(bin(i).count("1") % 2) for i in range(1 << 13)]
    for start, length, period in periodic_runs.runs_of_words(words):
        part = words[start:start + length]
        assert part[period:] == part[:-period] and length >= max(12, 2 * period)
        assert start == 0 or words[start - 1] != words[start - 1 + period]
        assert start + length == len(words) or words[start + length] != words[start + length - period]
    fib = ["0"], ["0", "1"]
    while len(fib[1]) < 300:
        fib = fib[1], fib[1] + fib[0]
    assert periodic_runs.runs_of_words(fib[1]) == brute_runs(fib[1], 12)


def test_find_on_odd_rows(spark, documents, odd):
    line = " ".join("abcdef") + "\n"
    rows = odd + [(20, line * 3 + "tail"), (21, line * 3 + "tail"), (22, line * 2 + " ".join("abc"))]
    got = periodic_runs.find(documents(rows, extra="runs")).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for doc_id, text in rows:
        words = WORD.findall(text or "")
        r = by_id[doc_id]
        assert r.n_words == len(words)
        runs = [(x["start"], x["length"], x["period"]) for x in r.runs]
        if len(words) < 200:
            assert runs == brute_runs(words, 12)
        assert r.collapsed == " ".join(kept(words, runs))
    assert [tuple(x) for x in by_id[5].runs] == [(0, 30000, 1)] and by_id[5].collapsed == "word"
    assert by_id[20].collapsed == "a b c d e f tail" and by_id[22].collapsed == "a b c d e f"
    assert [tuple(x) for x in by_id[22].runs] == [(0, 15, 6)]
    assert periodic_runs.find(documents([(1, "x")]).limit(0)).count() == 0


def replay(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words, 12)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    return (
        len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()).hexdigest(),
        hashlib.sha256(" ".join(kept(words, runs)).encode()).hexdigest())


def test_registered_query(spark):
    docs = table(spark, SF_DIR, "documents")
    short = docs.where(F.length("text") < 6000).collect()
    assert len(short) > 150
    got = {r.doc_id: tuple(r)[1:] for r in queries.op11_periodic_runs(spark, SF_DIR).collect()}
    assert len(got) == docs.count()
    assert {d.doc_id: got[d.doc_id] for d in short} == {d.doc_id: replay(d.doc_id, d.text) for d in short}
    assert sum(v[0] > 0 for v in got.values()) >= 10
