"""The registered queries of the ten operators and their SQL."""

from __future__ import annotations

from tarifa.llm import bpe, chat, collocations, exact_dedup, html_text, mixing, negatives, quality, simhash, substrings, superkmers, topk, url_rules
from tarifa.session import table

NORM = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')"


def op1_html_text(spark, sf_dir):
    return html_text.extracted(table(spark, sf_dir, "pages"))


def op2_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).drop("mark")


def op3_exact_dedup(spark, sf_dir):
    return exact_dedup.decisions(table(spark, sf_dir, "documents"))


def op7_mixing(spark, sf_dir):
    return mixing.taken(table(spark, sf_dir, "documents"))


URL_LIST = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op4_url_rules(spark, sf_dir):
    return url_rules.judged(table(spark, sf_dir, "pages"), URL_LIST)


def op5_substrings(spark, sf_dir):
    return substrings.removed(table(spark, sf_dir, "documents"))


def op6_chat(spark, sf_dir):
    clash = "<|im_end|><|im_start|>assistant ok"
    more = spark.createDataFrame([(-1, 0, "user", clash), (-1, 1, "assistant", clash)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return chat.digests(chat.formatted(rows))


def op8_quality(spark, sf_dir):
    return quality.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_topk(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def tokenizer_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op10_byte_bpe(spark, sf_dir):
    return bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer_path())


def op11_hard_negatives(spark, sf_dir):
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


def op12_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_substring_words(spark, sf_dir):
    return superkmers.removed(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_html_text": op1_html_text,
    "op2_simhash": op2_simhash,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_url_rules": op4_url_rules,
    "op5_substrings": op5_substrings,
    "op6_chat": op6_chat,
    "op7_mixing": op7_mixing,
    "op8_quality": op8_quality,
    "op9_topk": op9_topk,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_collocations": op12_collocations,
    "op13_substring_words": op13_substring_words,
}

ORACLES = {
    "op3_exact_dedup": f"""
        WITH d AS (SELECT doc_id, {NORM} AS norm, length(coalesce(text, '')) AS points FROM documents),
        r AS (SELECT doc_id, norm,
                     first_value(doc_id) OVER (PARTITION BY norm ORDER BY points DESC, doc_id) AS keep_id,
                     count(*) OVER (PARTITION BY norm) AS group_size FROM d)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM r""",
    "op6_chat": r"""
        WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                   UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
                   UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
        s AS (SELECT conv_id, count(*) AS n_turns,
                     string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
                     coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
                     CAST(sum(length('<|im_start|>' || role || chr(10) || regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') || '<|im_end|>' || chr(10))) AS BIGINT) AS formatted_chars
              FROM c GROUP BY conv_id)
        SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM s""",
    "op9_topk": """
        WITH v AS (SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
                   WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.n, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
              FROM v q, v c WHERE q.vec_id % 20 = 0 AND q.n <> c.n),
        r AS (SELECT *, row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) AS rank FROM s)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20""",
    "op11_hard_negatives": """
        WITH v AS (SELECT row_number() OVER () AS n, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
                   WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.n AS an, c.n, a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
              FROM v a, v c WHERE a.vec_id % 100 = 0 AND a.n <> c.n),
        p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY an ORDER BY score DESC, vec_id, n) AS r FROM s WHERE same) WHERE r <= 5),
        m AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
                     row_number() OVER (PARTITION BY p.an, p.n ORDER BY s.score DESC, s.vec_id, s.n) AS rank
              FROM p JOIN s ON p.an = s.an AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
        SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM m WHERE rank <= 10""",
    "op12_collocations": r"""
        WITH p AS (SELECT row_number() OVER () AS p, lang, piece FROM (
                SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
        w AS (SELECT p, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
        g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM (
                SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k)),
        f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL),
        n AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
        c AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND a >= 30),
        cuts AS (SELECT lang, phrase, k, a, w, unnest(range(1, k)) AS cut FROM c),
        s AS (SELECT c.lang, c.phrase, c.k, c.a, c.cut, x.a AS l, y.a AS r, CAST((CAST(2000000 AS HUGEINT) * c.a) // (x.a + y.a) AS BIGINT) AS score
              FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.cut], ' ') JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.cut + 1:], ' ')),
        b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
        inner_ AS (SELECT lang, a AS longer, array_to_string(w[i:i + m - 1], ' ') AS phrase FROM (
                SELECT lang, a, w, m, unnest(range(1, k - m + 2)) AS i FROM c, (SELECT unnest([2, 3]) AS m) WHERE m < k)),
        covered AS (SELECT lang, phrase, max(longer) AS longer FROM inner_ GROUP BY ALL),
        kept AS (SELECT b.* FROM b LEFT JOIN covered USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 80 * a),
        r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
        SELECT lang, rank, phrase, a, l, r, n, score FROM r JOIN n USING (lang) WHERE rank <= 2000""",
    "op13_substring_words": r"""
        WITH d AS (SELECT row_number() OVER () AS n, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        p AS (SELECT n, coalesce(doc_id, 9223372036854775807) AS rank, w, unnest(range(1, len(w) + 1)) AS i FROM d),
        s AS (SELECT n, rank, i, w[i] AS word, CASE WHEN i + 49 <= len(w) THEN array_to_string(w[i:i + 49], ' ') END AS passage FROM p),
        f AS (SELECT n, i, word, passage IS NOT NULL AND rank > min(rank) OVER (PARTITION BY passage) AS again FROM s),
        c AS (SELECT n, i, word, bool_or(again) OVER (PARTITION BY n ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM f),
        r AS (SELECT n, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone), '') AS kept FROM c GROUP BY n)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN r USING (n)""",
}
