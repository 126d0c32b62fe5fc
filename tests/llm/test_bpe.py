import base64
import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tarifa.llm import bpe
from tarifa.llm.queries import op10_byte_bpe, tokenizer_path

tiktoken = pytest.importorskip("tiktoken")
P = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(tokenizer_path(), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(texts):
    own = bpe.vocabulary(tokenizer_path())
    ids, upto = own.encode(texts)
    data, at = own.decode(ids, upto, own.ends(ids, upto))
    assert [data[a:b].tobytes() for a, b in zip(at, at[1:], strict=False)] == [t.encode() for t in texts]
    return [ids[a:b].tolist() for a, b in zip(upto, upto[1:], strict=False)]


piece = st.sampled_from(["'", "'s", "'ll", "'t", "'R", " ", "  ", "\n", "\t", "a", "Bé", "12", "²", "!?", "\x85", "　", "漢字", "😀", "́", "\0", "<|endoftext|>", "\x1c"])


def test_texts_like_the_library(reference):
    @given(st.lists(st.one_of(st.lists(piece, max_size=12).map("".join), st.text(max_size=20)), max_size=6))
    @settings(max_examples=300, deadline=None)
    def check(texts):
        texts = [t.encode("utf-8", "ignore").decode() for t in texts]
        assert ids_of(texts) == [reference.encode_ordinary(t) for t in texts]

    check()


def test_every_code_point(reference):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000][::7]
    texts = ["x%s1 %s!%s a" % (chr(c), chr(c), chr(c)) for c in points]
    assert ids_of(texts) == [reference.encode_ordinary(t) for t in texts]


def test_long_slices(reference):
    texts = ["a" * 30_000, " " * 5000 + "x", "'" * 400 + "s", "ab" * 4000, "é" * 3000]
    assert ids_of(texts) == [reference.encode_ordinary(t) for t in texts]


def test_both_merges_agree():
    own = bpe.vocabulary(tokenizer_path())
    for text in ("thanedble", "intionthe", "xyzzy" * 9, "öäü", "aaaaaaa"):
        assert own.merge(text.encode()) == own.merge_long(text.encode()) or text.encode() in own.ranks


def test_cache_is_emptied(monkeypatch, reference):
    monkeypatch.setattr(bpe, "CACHED", 3)
    assert ids_of(["some words here", "more words there"]) == [reference.encode_ordinary(t) for t in ("some words here", "more words there")]


def check(rows, docs, reference):
    want = sorted((str(r["doc_id"]), reference.encode_ordinary(r["text"] or ""), r["text"] or "") for r in docs)
    digest = lambda b: hashlib.sha256(b).hexdigest()
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows) == sorted((i, len(x), digest(" ".join(map(str, x)).encode()), digest(t.encode())) for i, x, t in want)


def test_query(spark, sf_dir, reference):
    check(op10_byte_bpe(spark, sf_dir).collect(), spark.read.parquet(f"{sf_dir}/documents.parquet").collect(), reference)


def test_nasty(nasty, reference):
    check(bpe.round_trip(nasty, tokenizer_path()).collect(), nasty.collect(), reference)


def test_two_steps_and_offsets(nasty):
    tokens = bpe.encoded(nasty.select("doc_id", "text"), tokenizer_path(), offsets=True)
    rows = tokens.collect()
    own = bpe.vocabulary(tokenizer_path())
    for r in rows:
        at = 0
        for i, end in zip(r.ids, r.ends, strict=True):
            at += len(own.tokens[i])
            assert at == end
    for back in (bpe.decoded(tokens, tokenizer_path()), bpe.decoded(tokens.drop("ends"), tokenizer_path())):
        assert sorted(bytes(r.decoded) for r in back.collect()) == sorted((r["text"] or "").encode() for r in nasty.collect())


def test_offsets_place_the_bytes():
    own = bpe.vocabulary(tokenizer_path())
    ids, upto = own.encode(["some words", "", "more"])
    ends = own.ends(ids, upto)
    ends[0] += 1
    with pytest.raises(ValueError, match="offsets"):
        own.decode(ids, upto, ends)


def test_empty(nothing):
    assert bpe.round_trip(nothing, tokenizer_path()).collect() == []
