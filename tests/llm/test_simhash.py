import re

import numpy as np
import xxhash

from tarifa.llm import simhash


def fingerprint(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0d]+", lower)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(ids, prints, most=2):
    label = list(range(len(prints)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= most:
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    roots = [find(i) for i in range(len(prints))]
    least = {}
    for i, r in enumerate(roots):
        if ids[i] is not None:
            least[r] = min(least.get(r, ids[i]), ids[i])
    return [least.get(r) for r in roots], len(set(roots))


def check(docs, **kw):
    rows = docs.collect()
    prints = [fingerprint(r["text"]) for r in rows]
    parts, _ = brute([r["doc_id"] for r in rows], prints)
    want = sorted(((r["doc_id"], format(p, "016x"), c) for r, p, c in zip(rows, prints, parts, strict=True)), key=str)
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs, **kw).collect()), key=str)
    assert got == want


def test_brute_force(nasty):
    check(nasty)


def test_hot_keys_are_dealt_again(nasty):
    check(nasty, hot=1)


def test_one_of_each_group_stays(nasty):
    rows = simhash.kept_rows(nasty)
    assert rows.columns == nasty.columns
    stored = nasty.collect()
    assert rows.count() == brute([r["doc_id"] for r in stored], [fingerprint(r["text"]) for r in stored])[1]


def test_empty(nothing):
    assert simhash.near_duplicates(nothing).collect() == []
    assert simhash.kept_rows(nothing).collect() == []


def test_words_within_two_errors_share_a_key():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 3000)
    keys = [set() for _ in words]
    for i, k in zip(*simhash.code_keys(words), strict=True):
        keys[i].add(k)
    assert max(map(len, keys)) <= 6
    for a in range(23):
        b = (a * 7 + 3) % 23
        which, index = simhash.code_keys(words ^ (1 << a) ^ (1 << b))
        met = np.zeros(len(words), bool)
        for i, k in zip(which, index, strict=True):
            met[i] |= k in keys[i]
        assert met.all()


def test_lookup_finds_the_links_of_pairs():
    """Large groups are looked up; the components are those of the comparison of all pairs."""
    rng = np.random.default_rng(2)
    centre = rng.integers(0, 1 << 63, dtype=np.uint64)
    prints = np.unique(np.array([centre ^ np.uint64(1 << int(a)) ^ np.uint64(1 << int(b)) ^ np.uint64(1 << int(c)) for a, b, c in rng.integers(0, 64, (300, 3))], np.uint64))
    key = np.zeros(len(prints), np.int64)
    for pairwise in (10**6, 1):
        a, b = simhash.linked(key, prints, pairwise=pairwise)
        label = {int(p): int(p) for p in prints}
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            label[x] = y
        groups = sorted(label.values())
        if pairwise > 1:
            want = groups
    assert groups == want and len(a) < len(prints)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    roots = {r.node: r.root for r in simhash.components(edges).collect()}
    assert roots == {i: 0 for i in range(1, 61)} | {101: 100}


def test_shingles_of_a_long_text_in_blocks():
    text = " ".join(f"w{i % 977} Ü{i % 31}" for i in range(30_000))
    assert int(simhash.fingerprints_of([text.encode(), b""], block=1000)[0]) == fingerprint(text)
