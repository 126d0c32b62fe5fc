import hashlib
import random
import re

import numpy as np
import pytest

from tarifa.llm import superkmers

DOCS = "doc_id long, text string, lang string, source string, key int, n long, places string, words string, doc string"


def document(i, t):
    return (i, t, "en", "s", 1, 2, "p", "w", "d")


N = superkmers.WINDOW
LAST = superkmers.LAST


def brute(rows):
    """(id, words, removed, digest) of each row, window by window."""
    split = [(r[0], re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows]
    least = {}
    for i, w in split:
        for at in range(len(w) - N + 1):
            window = tuple(w[at : at + N])
            least[window] = min(least.get(window, LAST), LAST if i is None else i)
    out = []
    for i, w in split:
        gone = set()
        for at in range(len(w) - N + 1):
            if least[tuple(w[at : at + N])] < (LAST if i is None else i):
                gone.update(range(at, at + N))
        kept = " ".join(x for at, x in enumerate(w) if at not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def result(df, **kw):
    return sorted((tuple(r) for r in superkmers.removed(df, **kw).collect()), key=repr)


def text(rng, n, names=400):
    return " ".join(f"{rng.choice(['w', 'é', 'Ü'])}{rng.randrange(names)}" for _ in range(n))


@pytest.fixture(scope="module")
def shared_passages():
    """Passages of 49 to 300 words in several documents, near copies, copies, one word repeated."""
    rng = random.Random(8)
    passages = [text(rng, n) for n in (49, 50, 51, 120, 300)]
    rows = [document(i, text(rng, rng.randint(0, 90)) + " " + rng.choice(passages) + "\n" + text(rng, rng.randint(0, 200))) for i in range(60)]
    base = text(rng, 180).split(" ")
    for i in range(80):  # near copies: one word differs
        at = rng.randrange(180)
        rows.append(document(100 + i, "  ".join([*base[:at], f"x{i}", *base[at + 1 :]])))
    rows += [document(300 + i, passages[3] + " \t" + passages[4]) for i in range(40)]
    rows += [document(400, "la " * 900), document(401, "la " * 700 + "end"), document(402, "la " * 49), document(403, passages[1] + "\x0b" + passages[1]), document(404, passages[1].replace(" ", "\x85"))]
    rng.shuffle(rows)
    return rows


def test_equals_brute_force(spark, shared_passages):
    got = result(spark.createDataFrame(shared_passages, DOCS).repartition(6))
    assert got == brute(shared_passages)
    assert sum(r[2] > 0 for r in got) > 100


def test_hot_buckets_are_dealt_out_again(spark, shared_passages):
    df = spark.createDataFrame(shared_passages, DOCS).repartition(3)
    assert result(df, hot=3) == brute(shared_passages)


def test_nasty_rows(spark, nasty):
    rows = [tuple(r) for r in nasty.collect()]
    assert result(nasty) == brute(rows)
    texts = {r[0]: r for r in superkmers.removed(nasty, keep_text=True).collect()}
    assert texts[301].kept == b"" and texts[303].n_words == 0


def test_many_rows_of_one_id(spark):
    """Rows that share an id, or have none, remove nothing from one another; a smaller id removes from all."""
    rng = random.Random(4)
    passage = text(rng, 60)
    rows = [document(None, passage + f" {i}") for i in range(50)] + [document(9, passage + f" {i}") for i in range(50)]
    got = result(spark.createDataFrame(rows, DOCS))
    assert got == brute(rows)
    assert {r[2] for r in got if r[0] == 9} == {0} and {r[2] for r in got if r[0] is None} == {61}


def test_empty(spark, nothing):
    assert result(nothing) == []


def test_super_kmers_cover_each_window_once():
    rng = random.Random(2)
    texts = [text(rng, n, 5).encode() for n in (0, 49, 50, 51, 400, 3, 1200)] + [b"a " * 700]
    which, start, windows, key = superkmers.super_kmers(texts)
    seen = [(t, s + i) for t, s, w in zip(which.tolist(), start.tolist(), windows.tolist(), strict=True) for i in range(w)]
    assert seen == [(t, i) for t, x in enumerate(texts) for i in range(len(x.split()) - N + 1)]
    assert windows.max() <= superkmers.LONGEST
    # equal windows have equal minimisers
    by_window = {}
    for t, s, w, k in zip(which.tolist(), start.tolist(), windows.tolist(), key.tolist(), strict=True):
        parts = texts[t].split()
        for i in range(s, s + w):
            assert by_window.setdefault(tuple(parts[i : i + N]), k) == k


def test_ranks_are_those_of_windows():
    rng = np.random.default_rng(1)
    codes = np.concatenate([np.tile(rng.integers(0, 3, 70), 4), rng.integers(0, 2, 200), np.zeros(130, np.int64)])
    windows = [tuple(codes[i : i + N]) for i in range(len(codes) - N + 1)]
    rank = superkmers.window_ranks(codes)
    assert len(rank) == len(windows)
    assert len(set(zip(rank.tolist(), windows, strict=True))) == len(set(windows)) == len(set(rank.tolist()))


def test_unique_text_does_not_travel(spark):
    """Super-k-mers whose minimiser is in one document only are not cut out."""
    rng = random.Random(6)
    rows = [document(i, text(rng, 300, 100_000)) for i in range(30)] + [document(100, "pre " + text(random.Random(7), 80, 100_000)), document(101, text(random.Random(7), 80, 100_000))]
    found = superkmers.removed(spark.createDataFrame(rows, DOCS))
    assert sorted((r.doc_id, r.n_removed) for r in found.collect() if r.n_removed) == [(101, 80)]
