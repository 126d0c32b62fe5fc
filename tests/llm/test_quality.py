import zlib

import numpy as np

from tarifa.llm import quality


def labelled(spark, ids):
    return spark.createDataFrame([(i, int(i % 2 == 0)) for i in ids] + [(None, 1), (3, None)], "doc_id long, quality int")


def corpus(spark, n=400):
    good = lambda i: " ".join(f"word{i * j % 97} and" for j in range(5 + i % 40))
    bad = lambda i: " ".join(f"junk{j % 7}$$$" for j in range(5 + i % 40))
    return spark.createDataFrame([(i, good(i) if i % 2 == 0 else bad(i)) for i in range(n)], "doc_id long, text string")


def test_learns_and_marks_held_out(spark):
    rows = quality.judged(corpus(spark), labelled(spark, range(400))).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == (r.doc_id % 2 == 0) for r in held]) > 0.95
    assert all(r.predicted == (r.score >= 0.3) for r in rows)


def test_held_out_accuracy_on_the_tables(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = quality.judged(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")).where("held_out").collect()
    hits = [r.predicted == labels[r.doc_id] for r in rows if r.doc_id in labels]
    assert np.mean(hits) > 0.9


def test_held_out_labels_do_not_matter(spark):
    docs = corpus(spark, 200)
    labels = labelled(spark, range(200))
    from pyspark.sql import functions as F

    turned = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (quality.train(docs, x) for x in (labels, turned))
    assert all((a[k] == b[k]).all() for k in a)


def test_nasty(nasty, spark):
    rows = quality.judged(nasty, labelled(spark, range(40))).collect()
    assert len(rows) == nasty.count() and all(0 <= r.score <= 1 for r in rows)
    kept = quality.kept_rows(nasty, None)
    assert kept.columns == nasty.columns and kept.count() == nasty.count()


def test_without_labels_and_empty(nasty, nothing, spark):
    rows = quality.judged(nasty, labelled(spark, [])).collect()
    assert {r.score for r in rows} == {0.5}
    assert quality.judged(nothing, labelled(spark, range(5))).collect() == []


def test_chunks_cover_the_whole_text():
    for n in (0, 1, 7, quality.CHUNK, quality.CHUNK + 1, 5000, 100_003):
        chunks, lengths = quality.chunks_of(bytes(n))
        starts = quality.chunk_starts(n)
        assert starts[0] == 0 and starts[-1] + lengths[-1] == n
        assert all(b - a <= quality.STEP for a, b in zip(starts, starts[1:], strict=False))


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    model = quality.fresh()
    texts = [bytes(rng.integers(0, 255, n, np.uint8)) for n in (0, 40, 300)]
    parts = [quality.chunks_of(t) for t in texts]
    chunks, lengths = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    first = np.cumsum([0, *(len(p[1]) for p in parts[:-1])])
    labels, weights = np.array([1, 0, 1]), np.ones(3, np.float32)
    model = {k: v.astype(np.float64) for k, v in model.items()}
    _, g = quality.gradients(model, chunks, lengths, first, labels, weights)
    for k in model:
        at = tuple(rng.integers(0, s) for s in model[k].shape)
        if k == "embed":
            at = (int(chunks[1, 3]), 2)
        old, e = model[k][at], 1e-4
        ends = []
        for step in (e, -e):
            model[k][at] = old + step
            ends.append(quality.gradients(model, chunks, lengths, first, labels, weights)[0])
        model[k][at] = old
        assert abs((ends[0] - ends[1]) / (2 * e) - g[k][at]) < 1e-2 * max(1, abs(g[k][at]))


def test_scores_do_not_depend_on_company():
    model = quality.fresh()
    texts = [b"", b"short", b"x" * 3000, bytes(range(256)) * 9]
    alone = [quality.probabilities(model, [t])[0] for t in texts]
    assert np.allclose(alone, quality.probabilities(model, texts), atol=1e-5)


def test_forward_pass_by_loops():
    """Every number of the network computed one by one, over the whole text."""
    model = {k: v.astype(np.float64) for k, v in quality.fresh(9).items()}

    def number(chunk):
        units = [[*chunk[i : i + 2], *[quality.PAD] * 2][:2] for i in range(0, quality.CHUNK, 2)]
        units += [[quality.PAD] * 2] * (quality.CHUNK // 2 - len(units))
        vectors = [np.concatenate([model["embed"][b] for b in u]) for u in units]
        maxima = []
        for f in range(quality.FILTERS):
            places = range(max(1, -(-len(chunk) // 2) - quality.TAPS + 1))
            maxima.append(max(sum(float(vectors[p + j] @ model["filters"][:, j, f]) for j in range(quality.TAPS)) for p in places) + model["bias"][f])
        m = np.array([*np.tanh(maxima), np.log1p(len(chunk)) / 4])
        return float(np.tanh(m @ model["in"] + model["in_bias"]) @ model["out"])

    rng = np.random.default_rng(4)
    for n in (0, 3, 127, 128, 500):
        text = bytes(rng.integers(0, 255, n, np.uint8))
        numbers = [number(list(text[a : a + quality.CHUNK])) for a in quality.chunk_starts(n)]
        logit = min(numbers) * model["mix"][0] + sum(numbers) / len(numbers) * model["mix"][1] + model["mix"][2]
        assert abs(quality.probabilities(model, [text])[0] - 1 / (1 + np.exp(-logit))) < 1e-5


def test_junk_at_any_place_of_a_long_text_is_learned():
    """No part of a sampled text is left out of training."""
    rng = np.random.default_rng(0)
    good = lambda n: " ".join(f"word{k} and" for k in rng.integers(0, 97, n)).encode()
    junk = b" junk3$$$ junk5$$$ junk1$$$ junk2$$$"
    texts = [good(400) for _ in range(80)]
    texts += [t[:k] + junk + t[k:] for t, k in ((good(400), int(rng.integers(0, 3500))) for _ in range(80))]
    labels = np.array([1] * 80 + [0] * 80)
    p = quality.probabilities(quality.fit(texts, labels), texts)
    assert ((p >= 0.5) == labels).mean() > 0.95
