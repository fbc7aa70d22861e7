"""The operators on documents against brute force, and on rows that need a defined result."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from kpiloom.llm import (
    decision_list, jaccard_join, line_templates, mixing, packing, personal_data, quality_fm, suffix_dedup)
from kpiloom.llm.queries import tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


def near_copies(seed: int) -> list[tuple[int, str]]:
    """Families with edits, exact copies, and texts around a shared passage."""
    rng = random.Random(seed)
    passage, rows, n = prose(rng, 90), [], 0
    for _ in range(6):
        base = prose(rng, 60).split()
        for _ in range(8):
            words = list(base)
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = prose(rng, 1)
            rows.append((n := n + 1, " ".join(words)))
        rows.append((n := n + 1, " ".join(base)))
        rows.append((n := n + 1, " ".join(base).upper()))
    for _ in range(6):
        rows.append((n := n + 1, f"{prose(rng, 40)} {passage} {prose(rng, 30)}"))
    rng.shuffle(rows)
    return rows


def shingle_set(text: str | None) -> frozenset:
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def edited(rng: random.Random, words: list[str], edits: int) -> str:
    """The words with some of them replaced by new ones."""
    words = list(words)
    for at in rng.sample(range(len(words)), edits):
        words[at] = f"w{rng.getrandbits(40)}"
    return " ".join(words)


def edited_copies(seed: int, n: int, words: int, edits: int) -> list[tuple[int, str]]:
    """Near copies of one text that is not among them."""
    rng = random.Random(seed)
    original = [f"o{rng.getrandbits(40)}" for _ in range(words)]
    return [(i, edited(rng, original, edits)) for i in range(n)]


def brute_components(rows) -> dict:
    sets = [(i, shingle_set(t)) for i, t in rows]
    label = {k: k for k in range(len(sets))}
    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                old, new = label[a], label[b]
                label = {k: new if v == old else v for k, v in label.items()}
    least: dict = {}
    for k, v in label.items():
        if sets[k][0] is not None:
            least[v] = min(least.get(v, sets[k][0]), sets[k][0])
    return {sets[k][0]: (len(sets[k][1]), least.get(label[k])) for k in label}


@pytest.mark.parametrize("settings", [
    jaccard_join.Settings(), jaccard_join.Settings(frequent=4, flush=200, run_rows=2)])
def test_jaccard_components_match_all_pairs(documents, odd, settings):
    rows = near_copies(1) + [(None if i is None else i + 1000, t) for i, t in odd]
    found = jaccard_join.components(documents(rows, "sig"), settings).collect()
    want = brute_components(rows)
    assert len(found) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == want


@pytest.mark.parametrize("settings", [
    jaccard_join.Settings(group=1), jaccard_join.Settings(group=2, frequent=4, flush=200, run_rows=2)])
@pytest.mark.parametrize("seed", [3, 4])
def test_jaccard_components_through_hubs(documents, settings, seed):
    rows = near_copies(seed) + edited_copies(seed, 40, 60, 1) + edited_copies(seed + 9, 40, 90, 3)
    rows = [(i, text) for i, (_, text) in enumerate(rows)]
    found = jaccard_join.components(documents(rows), settings).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_components(rows)


def test_jaccard_near_copies_without_original_meet_rarely(documents, monkeypatch):
    """They gave 24,376 pairs when all classes of a shingle were paired."""
    met = []
    verified = jaccard_join._verified
    monkeypatch.setattr(jaccard_join, "_verified", lambda pairs, *more: met.append(pairs.count()) or verified(pairs, *more))
    rng, n = random.Random(6), 300
    rows = edited_copies(6, n, 150, 3)
    # Some are linked with one other that has one more edit.
    rows += [(n + i, edited(rng, rows[i][1].split(), 1)) for i in range(0, n, 30)]
    found = jaccard_join.components(documents(rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_components(rows)
    assert sum(met) <= 10 * len(rows)


def test_jaccard_rows_of_a_shingle_carry_no_list(documents, monkeypatch):
    """A list per shingle grows with the square of a text; a pair is counted once its end is all that travels."""
    kinds, cut, stored = {}, jaccard_join.cut, jaccard_join.stored

    def noted(write):
        def run(df):
            kinds[tuple(df.columns)] = [f.dataType.typeName() for f in df.schema]
            return write(df)
        return run

    monkeypatch.setattr(jaccard_join, "cut", noted(cut))
    monkeypatch.setattr(jaccard_join, "stored", noted(stored))
    base = " ".join(f"w{i}" for i in range(120))
    rows = [(i, base.replace(f"w{9 * i} ", f"x{i} ").replace(f"w{70 - i} ", "y ")) for i in range(8)]
    assert jaccard_join.components(documents(rows)).count() == 8
    by_shingle = {c: k for c, k in kinds.items() if "token" in c}
    assert by_shingle and not any("array" in k for k in by_shingle.values())


def test_jaccard_worker_counts_repeats_in_place():
    for values in ([], [5], [3, 3], [1, 2, 3], [7, 1, 7, 2, 1, 7], [4] * 9):
        own = np.array(values, dtype=np.uint64)
        found, counts = jaccard_join._repeated(own)
        wanted = {v: n for v, n in Counter(values).items() if n > 1}
        assert dict(zip(found.tolist(), counts.tolist())) == wanted


def test_jaccard_keeps_one_of_each_group(documents, odd):
    rows = near_copies(2) + [(None if i is None else i + 1000, t) for i, t in odd]
    want = brute_components(rows)
    kept = jaccard_join.keep_one(documents(rows, "component_id"))
    ids = [r.doc_id for r in kept.collect()]
    assert "component_id" in kept.columns
    assert sorted(i for i in ids if i is not None) == sorted(i for i, (_, c) in want.items() if i is not None and i == c)


def test_jaccard_keeps_groups_whose_ids_do_not_tell_them_apart(documents):
    rng = random.Random(12)
    texts = [prose(rng, 30) for _ in range(9)]
    near = f"{texts[0]} {prose(rng, 2)}"
    rows = [(None, t) for t in texts[:4]] + [(None, near), (None, ""), (None, texts[1])]
    rows += [(7, t) for t in texts[4:7]] + [(7, " "), (7, texts[5])]
    rows += [(None, texts[7]), (9, f"{texts[7]} {prose(rng, 2)}"), (9, texts[8])]
    got = Counter((r.doc_id, r.text) for r in jaccard_join.keep_one(documents(rows)).collect())
    assert got[None, texts[0]] + got[None, near] == 1
    want = [r for r in rows if r not in ((None, texts[0]), (None, near), (None, texts[7]))]
    assert {k: n for k, n in got.items() if k not in ((None, texts[0]), (None, near))} == dict.fromkeys(want, 1)


def test_jaccard_prefixes_share_enough():
    rng = np.random.default_rng(3)
    settings = jaccard_join.Settings()
    for _ in range(50):
        pool = rng.integers(1, 1 << 60, 130).astype(np.uint64)
        pool = np.unique(pool)
        counts = {int(p): float(rng.integers(1, 50)) for p in pool}
        x, y = pool[:120], pool[rng.integers(0, 10) :]
        both = len(np.intersect1d(x, y))
        if 100 * both < 80 * (len(x) + len(y) - both):
            continue
        chosen = []
        for s in (x, y):
            places, matches = jaccard_join.prefix(s, np.array([counts[int(v)] for v in s]), settings)
            chosen.append((set(s[places].tolist()), matches))
        assert len(chosen[0][0] & chosen[1][0]) >= min(chosen[0][1], chosen[1][1])


def brute_suffix(rows, size):
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(d[i : i + size] for d in data for i in range(len(d) - size + 1))
    out = []
    for (doc, _), d in zip(rows, data):
        gone = [False] * len(d)
        for i in range(len(d) - size + 1):
            if seen[d[i : i + size]] > 1:
                gone[i : i + size] = [True] * size
        kept = bytes(b for b, g in zip(d, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc, len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("group", [1, 4096])
def test_suffix_dedup_matches_all_windows(documents, group):
    rng = random.Random(4)
    rows = near_copies(4)[:30] + [(900, "ab" * 120), (901, "xyz" * 50 + prose(rng, 10)), (902, None), (903, ""),
                                 (904, "é" * 90), (905, "same same same " * 9), (905, "same same same " * 9)]
    settings = suffix_dedup.Settings(threshold=60, gram=12, group=group)
    found = suffix_dedup.remove_repeated(documents(rows, "kept"), settings)
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found.collect()), key=str)
    assert got == brute_suffix(rows, 60)


def test_suffix_runs_cover_each_window_once():
    rng = random.Random(5)
    data = prose(rng, 400).encode()
    settings = suffix_dedup.Settings(threshold=100, gram=16)
    _, _, first, last = suffix_dedup.runs(data, settings)
    assert [x for a, z in zip(first, last) for x in range(a, z + 1)] == list(range(len(data) - 99))


def test_packing_is_a_round_trip(documents, odd):
    from tokenizers import Tokenizer

    rng = random.Random(6)
    rows = [(i, prose(rng, rng.randint(0, 900))) for i in range(100, 160)] + odd
    settings = packing.Settings(tokenizer(), window=512, shard_tokens=20000)
    found = packing.pack(documents(rows, "ids"), settings).collect()
    plain = Tokenizer.from_file(settings.tokenizer)
    want = Counter()
    for doc, text in rows:
        want[doc, np.array(plain.encode(text or "", add_special_tokens=False).ids + [2], "<u4").tobytes()] += 1
    by_sequence: dict = {}
    for r in found:
        assert r.length * 4 == len(r.ids) and r.length > 0
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == 512 or at & (at - 1) == 0
    # Pieces of a text are found by its id; of rows with one id and text, any copy's pieces fit.
    got: dict = {}
    for r in found:
        got.setdefault(r.doc_id, []).append(r)
    for (doc, ids), copies in want.items():
        pieces = Counter((r.start, bytes(r.ids)) for r in got[doc])
        assert sum(len(b) * n for (_, b), n in pieces.items()) == sum(len(i) * c for (d, i), c in want.items() if d == doc)
        if copies == 1 and sum(d == doc for d, _ in want) == 1:
            assert b"".join(b for _, b in sorted(pieces)) == ids


def test_plain_words_skip_the_first_steps_of_the_tokenizer():
    """Same ids as the whole tokenizer's, which only odd words go through."""
    words = packing._Words(tokenizer(), 100_000)
    rng = random.Random(8)
    letters = "abcrstvemld'019.,-_$#|" + packing._LATIN
    plain = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(3000)] + ["don't", "we'll,", "\u00e9t\u00e9s."]
    strange = ["\u00c9", "\u0130x", "e\u0301", "\u00b2a", "\u03a3\u03c2", "\u4e2d\u6587"]
    want = {w: words.encode(w) for w in plain + strange}
    called = []
    words.encode = lambda w, whole=words.encode: called.append(w) or whole(w)
    words.tokenizer = type("Whole", (), {"encode": lambda self, text, t=words.tokenizer, **k: called.append(text) or t.encode(text, **k)})()
    words.learn(plain)
    assert not called
    words.learn(strange)
    assert called and {w: words[w] for w in want} == want


def test_packing_takes_related_texts_together():
    rng = np.random.default_rng(7)
    a, b = np.arange(10, 60, dtype=np.uint16), np.arange(500, 550, dtype=np.uint16)
    parts = [rng.permutation(x)[:40] for x in (a, b, a, b, a, b, a, b)]
    settings = packing.Settings("", window=160)
    windows = list(packing._windows([len(p) for p in parts], parts, settings))
    assert {frozenset(d % 2 for d, _, _ in w) for w in windows} == {frozenset([0]), frozenset([1])}


def test_mixing_meets_targets(documents, odd):
    rng = random.Random(8)
    rows = [(i, prose(rng, rng.randint(1, 400)), f"s{min(9, i % 14)}") for i in range(300)]
    rows += [(None if i is None else i + 1000, t, None) for i, t in odd]
    settings = mixing.Settings(block=32, bucket_rows=16, shard_slots=20)
    got = mixing.taken(documents(rows, "target"), settings).collect()
    assert len(got) == len(rows)
    size = Counter()
    for _, t, s in rows:
        size[s] += len(WORD.findall(t or ""))
    names = sorted((s for s in size if s is not None)) + [None]
    share, capped = sum(size.values()) * 1.5, {}
    while True:
        free = [s for s in names if s not in capped]
        weight = sum((5, 2, 1)[names.index(s) % 3] for s in free)
        level = (share - sum(capped.values())) / weight if weight else 0
        over = [s for s in free if level * (5, 2, 1)[names.index(s) % 3] > 2 * size[s]]
        if not over:
            break
        capped |= {s: 2.0 * size[s] for s in over}
    want = {s: capped.get(s, level * (5, 2, 1)[names.index(s) % 3]) for s in names}
    taken = Counter()
    for r in got:
        assert r.source_size == size[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 33 for s in names)
    again = mixing.taken(documents(rows, partitions=7), settings).collect()
    assert Counter((r.doc_id, r.size, r.taken) for r in again) == Counter((r.doc_id, r.size, r.taken) for r in got)
    mixed = mixing.mixed(documents(rows, "_words"), settings)
    words = Counter()
    texts = {}
    for i, t, _ in rows:
        texts.setdefault(i, set()).update(WORD.findall(t or ""))
    for r in mixed.collect():
        words[r.source] += len(WORD.findall(r.text))
        assert set(WORD.findall(r.text)) <= texts[r.doc_id] and r.n_chars == len(r.text)
    assert words == +taken


def test_line_templates_drop_boilerplate_only(documents, odd):
    rng = random.Random(9)
    rows = [(i, f"{prose(rng, 12)}\nSigned by user {rng.randint(1, 99999)} at gate {i}\n{prose(rng, 9)}") for i in range(100, 130)]
    copied = "\n".join(prose(rng, 10) for _ in range(4))
    rows += [(i, copied) for i in range(200, 230)] + odd
    found = line_templates.drop_lines(documents(rows, "n_lines")).collect()
    texts = Counter((i, t) for i, t in rows)
    assert len(found) == len(rows)
    for r in found:
        if r.doc_id is not None and 100 <= r.doc_id < 130:
            old = next(t for i, t in rows if i == r.doc_id).split("\n")
            assert r.text == f"{old[0]}\n{old[2]}" and (r.n_lines, r.n_dropped) == (3, 1)
        else:
            assert (r.doc_id, r.text) in texts and r.n_dropped == 0


@pytest.mark.parametrize("n", [300, 6000])
def test_line_template_fields_at_two_sizes(documents, n):
    """Two fields of 100 values, a small template in the same leaf: the same outcome at both sizes."""
    rng = random.Random(10)
    values = prose(rng, 400).split()[:200]
    lines = [
        f"this was written by {rng.choice(values[:100])} for the {rng.choice(values[100:])} of paper" for _ in range(n)]
    lines += [f"this was written by hand on {rng.choice(values)} paper with ink" for _ in range(20)]
    lines += [f"this was written by {prose(rng, 6)}" for _ in range(20)]
    rows = [(i, f"{prose(rng, 9)}\n{line}") for i, line in enumerate(lines)]
    found = {r.doc_id: r.n_dropped for r in line_templates.drop_lines(documents(rows)).collect()}
    assert found == {i: int(i < n + 20) for i in range(n + 40)}


def test_lines_and_contexts_of_many_texts_at_once(documents):
    """A batch of texts gives what each text gives alone."""
    rng = np.random.default_rng(4)
    texts = ["", "\n\n", None, "a b c d\n\na b c d\n"] + [
        "\n".join(" ".join(rng.choice(list("abc"), rng.integers(0, 6))) for _ in range(rng.integers(1, 9))) for _ in range(200)]
    docs = documents(list(enumerate(texts)))
    single, batch = (
        Counter(map(tuple, line_templates._lines(docs, line_templates.Settings(chunk=n)).collect())) for n in (1, 1 << 17))
    assert single == batch and len(batch) > 400
    for _ in range(50):
        m = int(rng.integers(1, 30))
        key, leaf = np.sort(rng.integers(0, 6, m)), rng.permutation(1000)[:m]
        words, count = rng.integers(1, 9, m), 2 ** rng.integers(1, 6, m)
        total = np.array([words[key == k].sum() + 7 * k for k in key])
        alone = [line_templates.contexts(*(x[key == k] for x in (key, leaf, words, count, total)), 0.25) for k in np.unique(key)]
        assert (np.concatenate(alone) == line_templates.contexts(key, leaf, words, count, total, 0.25)).all()


@pytest.mark.parametrize("seed", range(4))
def test_line_templates_of_texts_that_share_several_lines(documents, seed):
    """Short unrelated texts with the same lines lose them; near copies with a line of their own keep theirs."""
    rng = random.Random(seed)
    common = [prose(rng, 1), prose(rng, 6), prose(rng, 7), prose(rng, 5)]
    copied = [prose(rng, 10) for _ in range(5)]
    rows = [(i, "\n".join([prose(rng, 11), *common])) for i in range(40)]
    rows += [(i, "\n".join([*copied, prose(rng, 4)])) for i in range(100, 140)]
    found = {r.doc_id: r for r in line_templates.drop_lines(documents(rows)).collect()}
    for i, text in rows:
        if i < 40:
            assert found[i].n_dropped == 3 and found[i].text == "\n".join(text.split("\n")[:2])
        else:
            assert found[i].n_dropped == 0 and found[i].text == text


def base_numbers(text):
    words = WORD.findall(text or "")
    n = len(words)
    windows = Counter(tuple(words[i : i + 5]) for i in range(n - 4))
    covered = {k for i in range(n - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(i, i + 5)}
    seen, dups = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dups += line in seen
            seen.add(line)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dups, len(covered)


def test_decision_list_statistics_and_rules(spark, documents, odd):
    rng = random.Random(10)
    rows = [(i, prose(rng, 40)) for i in range(1000, 1400)]
    rows += [(i, " ".join(w + rng.choice(("***", "$$$")) for w in prose(rng, 40).split())) for i in range(2000, 2200)]
    labels = [(i, int(i < 2000), 0) for i, _ in rows]
    rows += odd + [(3000, "a b c d e f g a b c d e f g\nx\nx")]
    labels = spark.createDataFrame(labels + [(None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    got, rules = decision_list.judge(documents(rows, "kept"), labels)
    found = got.collect()
    want = Counter((i, *base_numbers(t)) for i, t in rows)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found) == want
    assert rules
    for r in found:
        failed = r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words
        assert r.base_failed == failed
        if r.doc_id is not None and r.doc_id >= 1000 and r.doc_id < 3000:
            assert r.kept == (r.doc_id < 2000)
    none, rules = decision_list.judge(documents(odd), labels.limit(0))
    assert not rules and all(r.kept == (not r.base_failed) for r in none.collect())


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


BASE = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(re.sub(r"\D", "", m)) <= 19 and luhn(re.sub(r"\D", "", m))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(re.sub(r"\D", "", m)) <= 15),
}


def brute_spans(text):
    found = [(m.start(), k, m.end()) for k, (rx, ok) in enumerate(BASE.values()) for m in re.finditer(rx, text or "") if ok(m[0])]
    return ",".join(f"{list(BASE)[k]}:{a}:{z}" for a, k, z in sorted(found))


def test_personal_data_base_spans(documents, odd):
    rng = random.Random(11)
    parts = ["a@b.com_x@y.org", "a.b@c-d.e.f.", "@x.y", "a@b", "1.2.3.4.5.6.7.8", "300.1.1.1", "01.002.3.255", "4111 1111 1111 1111",
             "4111-1111-1111-1112", "+1 (988) 555-2485", "+12", "+49 30 1234567890", "x" * 30, "é\U0001f600", "12 34", "\n", "a@b.c@d.e.f"]
    rows = [(i, rng.choice(["", " "]).join(rng.choice(parts) for _ in range(rng.randint(0, 12)))) for i in range(1000, 1200)]
    rows += odd + [(2000, "1" * 3000), (2001, "a" * 2000 + "@"), (2002, "1 " * 20000)]
    want = Counter((i, hashlib.sha256(brute_spans(t).encode()).hexdigest()) for i, t in rows)
    got = personal_data.find(documents(rows, "spans")).collect()
    assert Counter((r.doc_id, r.base_sha256) for r in got) == want
    by_kind = {(r.doc_id): (r.n_email, r.n_ip, r.n_card, r.n_phone) for r in got if r.doc_id and r.doc_id >= 1000}
    for i, t in rows:
        if i and i >= 1000:
            assert by_kind[i] == tuple(Counter(s.split(":")[0] for s in brute_spans(t).split(",") if s)[k] for k in BASE)


def test_personal_data_discovers_obfuscated_ones(documents):
    rows = [(i, f"words before please write to user{i}@mail{i}.example.com for more") for i in range(20)]
    rows += [(100, "others please write to jane(at)home(dot)example for more"), (101, "we met sue(at)pub(dot)example once")]
    got = {r.doc_id: r.spans for r in personal_data.find(documents(rows)).collect()}
    text = rows[20][1]
    start = text.index("jane")
    assert got[100] == f"email:{start}:{text.index(' for more')}"
    assert got[101] == ""


def test_quality_learns_held_out_rows(spark, documents, odd):
    rng = random.Random(12)
    rows = [(i, prose(rng, 60)) for i in range(1000, 1500)]
    rows += [(i, " ".join(w.upper() + "!!" for w in prose(rng, 60).split())) for i in range(2000, 2250)]
    labels = spark.createDataFrame([(i, int(i < 2000), 0) for i, _ in rows] + [(None, 0, 0), (3, None, 1)], "doc_id long, quality int, toxic int")
    docs = documents(rows + odd, "score")
    model = quality_fm.fit(docs, labels)
    got = quality_fm.score(docs, model).withColumn("held", quality_fm.held_out(F.col("doc_id"))).collect()
    assert len(got) == len(rows) + len(odd) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    held = [r for r in got if r.held and r.doc_id and r.doc_id >= 1000]
    assert all(r.held == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id)
    assert len(held) > 50 and np.mean([r.predicted == int(r.doc_id < 2000) for r in held]) > 0.95


def test_machine_score_is_all_pairs_in_linear_time():
    rng = np.random.default_rng(13)
    w, v = rng.normal(size=20), rng.normal(size=(20, 3))
    index, value = np.array([1, 4, 9, 13]), rng.normal(size=4)
    pairs = sum(value[a] * value[b] * (v[index[a]] @ v[index[b]]) for a in range(4) for b in range(a))
    margin, _ = quality_fm._margin(w, v, 0.5, index, value, np.array([0]))
    assert margin[0] == pytest.approx(0.5 + w[index] @ value + pairs)


def test_quality_without_labels(documents, odd, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = quality_fm.fit(documents(odd), labels)
    assert {r.score for r in quality_fm.score(documents(odd), model).collect()} == {0.5}


def test_empty_tables(spark, documents):
    none = documents([(1, "x")]).limit(0)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert jaccard_join.components(none).count() == 0
    assert jaccard_join.keep_one(none).count() == 0
    assert suffix_dedup.remove_repeated(none).count() == 0
    assert packing.pack(none, packing.Settings(tokenizer())).count() == 0
    assert mixing.taken(none).count() == 0
    assert mixing.mixed(none).count() == 0
    assert line_templates.drop_lines(none).count() == 0
    assert personal_data.find(none).count() == 0
    assert decision_list.judge(none, labels)[0].count() == 0
    assert quality_fm.score(none, quality_fm.fit(none, labels)).count() == 0
