import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tarifa.llm import collocations

DOCS = "doc_id long, text string, lang string, source string, a long, l string, r int, n int, range int, bucket int, chunk string"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def document(i, text, lang="en"):
    return (i, text, lang, "s", 1, "x", 2, 3, 4, 5, "c")


def brute(rows, most=4, least=3, top=2000, cover=80, unit=2_000_000):
    counts, n = defaultdict(Counter), Counter()
    for row in rows:
        lang = "und" if row[2] is None else row[2]
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (row[1] or "").translate(UPPER)):
            w = tuple(re.findall(r"[^\x20\x09]+", piece))
            n[lang] += len(w)
            for k in range(1, most + 1):
                counts[lang].update(w[i : i + k] for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        longest = Counter()
        for p, a in candidates.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    longest[p[i : i + k]] = max(longest[p[i : i + k]], a)
        kept = []
        for p, a in candidates.items():
            if 100 * longest[p] >= cover * a:
                continue
            score, _, l, r = min((unit * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))  # noqa: E741
            kept.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(kept)[:top], 1):  # noqa: E741
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def result(df, **kw):
    found = collocations.collocations(df, **kw)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in found.collect())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    words = ["the", "Of", "été", "ÄB", "x\x00y", "new", "york", "city", "a\x85b", "it's"]

    def text():
        parts = [rng.choice(words) if rng.random() < 0.8 else rng.choice(["New York", "new york city", "the new york city"]) for _ in range(rng.randrange(60))]
        return "".join(p + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "?!", " \x0b"]) for p in parts)

    out = [document(i, text(), rng.choice(["en", "en", "de", None, "und", ""])) for i in range(150)]
    out += [document(500 + i, "la la la la la la", "en") for i in range(40)]  # overlaps
    out += [document(1, None), document(2, ""), document(None, " . , "), document(3, "lonely", "fr"), document(4, "the new york city " * 3000, "de")]
    out += [document(5, text()) for _ in range(3)]  # repeated ids
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("chunk", [collocations.CHUNK, 2_000])
def test_equals_brute_force(spark, rows, chunk):
    got = result(spark.createDataFrame(rows, DOCS).repartition(3), least=3, chunk=chunk)
    assert got == brute(rows)
    assert {len(r[2].split(" ")) for r in got} == {2, 3, 4}


def test_parameters(spark, rows):
    df = spark.createDataFrame(rows, DOCS)
    assert result(df, least=5, top=7, cover=40, most=3) == brute(rows, 3, 5, 7, 40)


def test_empty(spark, rows):
    df = spark.createDataFrame(rows, DOCS)
    assert result(df.limit(0)) == []
    assert result(df.where("text is null or text in ('', 'lonely')"), least=1) == []


def test_products_beyond_64_bits(spark):
    big = 9_000_000_000_000
    row = spark.createDataFrame([(big, [big, big + 1, big], [big, big + 2, big])], "a long, heads array<long>, tails array<long>")
    cut = row.select(collocations._cut(3, 2_000_000).alias("c")).first().c
    assert (cut.score, cut.k, cut.l, cut.r) == (min((2_000_000 * big // (2 * big + 2), 1), (2_000_000 * big // (2 * big + 1), 2))[0], 1, big, big + 2)


def test_sequence_and_pairs():
    codes, words = collocations.sequence([b"A b, c d", b"a  b"])
    assert [words[i] if i >= 0 else None for i in codes] == [b"a", b"b", None, b"c", b"d", None, b"a", b"b"]
    assert collocations.sequence([b"", b" ."])[0].tolist() == []
    names = np.array([7, 9, -1, 4])  # c has no id
    seq, pairs = collocations.paired(codes, names)
    assert [tuple(pairs[i]) if i >= 0 else None for i in seq][:1] == [(7, 9)]
    assert sorted(map(tuple, pairs.tolist())) == [(7, 9)] and (seq == 0).sum() == 2
    assert collocations.paired(codes, np.full(4, -1))[1].shape == (0, 2)
