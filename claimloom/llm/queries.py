"""Registered queries of this subpackage and their SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm import (
    byte_bpe,
    centroid_clustering,
    chat_format,
    conversation_trie,
    decontaminate,
    minhash_dedup,
    substring_dedup,
    token_counts,
    topk_search,
    toxicity,
    url_filter,
    warc,
    word_bpe,
)

#: Fixed values of the url query.
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
#: A small labelled url table (1: block) for hosts and paths that no rule fits.
LABELLED_URLS = [
    ("http://cheap-pills.example.com/en/1", 1),
    ("https://www.cheap-pills.example.net/buy/now", 1),
    ("http://best-cheap-pills.example.org/offer.html", 1),
    ("https://spam-farm.example.net/en/17", 1),
    ("http://www.spam-farm.example.org/de/5?ref=x", 1),
    ("https://spam-links.example.com/page1.html", 1),
    ("http://free-casino.example.com/bonus", 1),
    ("https://casino-online.example.net/win/jackpot", 1),
    ("http://m.casino-slots.example.org/spin", 1),
    ("http://replica-watches.example.com/shop", 1),
    ("https://cheap-watches.example.net/sale.html", 1),
    ("http://adult-dating.example.com/join", 1),
    ("http://xxx-videos.example.net/watch/1", 1),
    ("https://payday-loans.example.org/apply", 1),
    ("http://seo-links.example.com/buy-links", 1),
    ("https://clickbait-farm.example.net/top10", 1),
    ("http://free-download-crack.example.com/keygen.exe", 1),
    ("https://pills-online.example.org/viagra", 1),
    ("https://news.example.com/en/2024/05/story", 0),
    ("https://www.university.example.org/research/paper.html", 0),
    ("https://blog.example.net/en/123", 0),
    ("http://library.example.org/catalog/item/5", 0),
    ("https://m.example.com/en/4242", 0),
    ("https://docs.example.com/guide/install.html", 0),
    ("https://www.museum.example.org/fr/visite", 0),
    ("http://weather.example.net/de/berlin", 0),
    ("https://blog.tiontion.example.com/en/853/", 0),
    ("https://therin.example.net/en/750#top", 0),
    ("http://ththre.example.com/fr/825?page=2&ref=x", 0),
    ("https://ththble.example.net/es/797#top", 0),
    ("http://thther.example.org/fr/414", 0),
    ("https://m.ththth.example.net/en/25#top", 0),
    ("https://school.example.org/en/lessons/7.html", 0),
    ("https://wiki.example.org/article/Bread", 0),
    ("https://forum.example.net/thread/991", 0),
    ("http://city.example.com/en/council/minutes", 0),
]

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    turns = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", control), (-1, 1, "assistant", control)], turns.schema)
    return chat_format.digests(chat_format.conversations(chat_format.chains(turns.union(extra))))


def op2_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encoded = byte_bpe.encode(_table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)
    return byte_bpe.digests(byte_bpe.decode(encoded, ranks))


def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    vocabulary = token_counts.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    return token_counts.counts(_table(spark, folder, "documents"), vocabulary, public_tokenizers.PATTERN)


def op4_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    weights = url_filter.train(spark.createDataFrame(LABELLED_URLS, "url string, label int"))
    return url_filter.judge(_table(spark, folder, "pages"), URL_RULES, weights)


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    found = toxicity.scored(docs, toxicity.fit(docs, _table(spark, folder, "labels"))).withColumnRenamed("_score", "score")
    return found.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.leaks(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op7_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.repeats(_table(spark, folder, "documents"), width=35)


def op8_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    return topk_search.top(_table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


def op9_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = minhash_dedup.groups(_table(spark, folder, "documents"), percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(_table(spark, folder, "pages"))


def op11_centroid_clustering(spark: SparkSession, folder: str) -> DataFrame:
    cells = centroid_clustering.cells(_table(spark, folder, "embeddings"), dim=64, scale=256)
    centroids = centroid_clustering.fit(cells, k=40, rounds=5, seed="2:")
    return centroid_clustering.described(centroid_clustering.assigned(cells, centroids), centroids)


def op12_word_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    tokenizer = word_bpe.read(public_tokenizers.path("word_bpe_49k.json"))
    encoded = word_bpe.encode(_table(spark, folder, "documents"), tokenizer)
    return word_bpe.digests(word_bpe.decode(encoded, tokenizer))


def op13_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    convs, rows = conversation_trie.with_shared_heads(_table(spark, folder, "conversations"))
    return conversation_trie.trie(convs, rows)


SQL = {
    "op7_substring_dedup": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
        ), w AS (
            SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS p FROM d
        ), g AS (
            SELECT r, p, word, count(*) OVER f AS size, sha256(string_agg(word, ' ') OVER f) AS passage
            FROM w WINDOW f AS (PARTITION BY r ORDER BY p ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)
        ), c AS (
            SELECT r, p, word, CASE WHEN size = 35 AND count(*) OVER (PARTITION BY size = 35, passage) > 1 THEN 1 ELSE 0 END AS again FROM g
        ), m AS (
            SELECT r, p, word, max(again) OVER (PARTITION BY r ORDER BY p ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) = 1 AS gone FROM c
        ), a AS (
            SELECT r, count(*) FILTER (gone) AS n, string_agg(word, ' ' ORDER BY p) FILTER (NOT gone) AS kept FROM m GROUP BY r
        )
        SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM d LEFT JOIN a USING (r)
    """,
    "op9_minhash_dedup": r"""
        WITH RECURSIVE d AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
        ), s AS (
            SELECT DISTINCT r, shingle FROM (
                SELECT r, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                    ELSE [array_to_string(w[i : i + 4], ' ') for i in range(1, len(w) - 3)] END) AS shingle FROM d)
        ), n AS (
            SELECT r, count(*) AS n FROM s GROUP BY r
        ), k AS (
            SELECT a.r AS x, b.r AS y, count(*) AS k FROM s a JOIN s b ON a.shingle = b.shingle AND a.r < b.r GROUP BY ALL
        ), e AS (
            SELECT x, y FROM k JOIN n p ON p.r = x JOIN n q ON q.r = y WHERE 100 * k >= 85 * (p.n + q.n - k)
        ), b AS (
            SELECT x, y FROM e UNION ALL SELECT y, x FROM e
        ), t AS (
            SELECT r AS x, r AS y FROM d UNION SELECT t.x, b.y FROM t JOIN b ON t.y = b.x
        ), c AS (
            SELECT t.x AS r, min(doc_id) AS component_id FROM t JOIN d ON d.r = t.y GROUP BY t.x
        )
        SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
        FROM d JOIN c USING (r) LEFT JOIN n USING (r)
    """,
    "op8_topk_search": """
        WITH v AS (
            SELECT row_number() OVER () AS row, vec_id, [floor(256 * x::DOUBLE)::BIGINT for x in embedding] AS cells FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
        ), s AS (
            SELECT q.row, q.vec_id AS query_id, c.vec_id,
                list_sum([z[1] * z[2] for z in list_zip(q.cells, c.cells)])::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(c.cells) = len(q.cells)
        ), r AS (
            SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s
        )
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """,
    "op10_warc": """
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
        ), f AS (
            SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1
        )
        SELECT page_id, payload_bytes, payload_digest,
            CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN first IS NULL OR first = page_id THEN NULL ELSE first END AS refers_to
        FROM p LEFT JOIN f USING (payload_digest)
    """,
    "op1_chat_format": """
        WITH t AS (
            SELECT conv_id, turn, role, text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
        ), e AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM t
        ), n AS (
            SELECT *, {escaped} AS body FROM e
        )
        SELECT conv_id, count(*)::BIGINT AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
            coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
            sum(2 + length(role) + 3 + length(body) + 5)::BIGINT AS formatted_chars
        FROM n GROUP BY conv_id
    """,
}


def _clustering_sql(k: int = 40, rounds: int = 5) -> str:
    kept = """
        v AS (
            SELECT row_number() OVER () AS r, vec_id, [floor(256 * x::DOUBLE)::BIGINT for x in embedding] AS cells FROM embeddings
            WHERE len(embedding) = 64 AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
        ), c0 AS (
            SELECT (row_number() OVER (ORDER BY sha256('2:' || coalesce(vec_id::VARCHAR, '')), cells))::INTEGER - 1 AS cluster, cells AS centre
            FROM v QUALIFY cluster < {k}
        )"""
    near = """, a{n} AS (
            SELECT r, vec_id, any_value(cells) AS cells, arg_min(cluster, d * 1000 + cluster) AS cluster, min(d) AS distance FROM (
                SELECT r, vec_id, cells, cluster, list_sum([(z[1] - z[2]) * (z[1] - z[2]) for z in list_zip(cells, centre)])::BIGINT AS d FROM v, c{n}
            ) GROUP BY r, vec_id
        )"""
    move = """, m{n} AS (
            SELECT cluster, list(x ORDER BY i) AS centre FROM (
                SELECT cluster, i, (sum(x)::BIGINT - (sum(x)::BIGINT % count(*) + count(*)) % count(*)) // count(*) AS x
                FROM (SELECT cluster, unnest(cells) AS x, generate_subscripts(cells, 1) AS i FROM a{n}) GROUP BY cluster, i
            ) GROUP BY cluster
        ), c{next} AS (
            SELECT cluster, coalesce(m{n}.centre, c{n}.centre) AS centre FROM c{n} LEFT JOIN m{n} USING (cluster)
        )"""
    steps = "".join((near + move).format(n=n, next=n + 1) for n in range(rounds)) + near.format(n=rounds)
    return f"""WITH {kept.format(k=k)}{steps}
        SELECT vec_id, cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia, sum(distance) OVER ()::BIGINT AS inertia,
            sha256(array_to_string(centre, ',')) AS centroid_sha256
        FROM a{rounds} JOIN c{rounds} USING (cluster)
    """


#: CRC-32 of the decimal conversation id, bit by bit.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, [ord(x)::BIGINT for x in string_split(conv_id::VARCHAR, '')]), lambda c, b:
            list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""
SQL["op11_centroid_clustering"] = _clustering_sql()
SQL["op13_conversation_trie"] = f"""
    WITH t AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
    ), o AS (
        SELECT conv_id, list(struct_pack(role, text) ORDER BY turn NULLS FIRST, sha256(concat(strlen(role), ':', role, text))) AS turns FROM t GROUP BY conv_id
    ), h AS (
        SELECT o.conv_id, {_CRC.replace("conv_id", "o.conv_id")} % 6 AS h, o.turns, b.turns AS base
        FROM o LEFT JOIN o b ON b.conv_id = o.conv_id - o.conv_id % 100
    ), r AS (
        SELECT conv_id, list_concat(CASE WHEN h > 0 THEN coalesce(base, [])[:h] ELSE [] END, turns[h + 1:]) AS turns FROM h
    ), p AS (
        SELECT conv_id, len(turns) AS length, unnest(range(0, len(turns) + 1)) AS depth, turns FROM r
    ), k AS (
        SELECT conv_id, length, depth, CASE WHEN depth > 0 THEN turns[:depth] ELSE [] END AS node,
            CASE WHEN depth > 1 THEN turns[:depth - 1] WHEN depth = 1 THEN [] END AS parent, CASE WHEN depth > 0 THEN length(turns[depth].text) ELSE 0 END AS n FROM p
    ), n AS (
        SELECT node, any_value(parent) AS parent, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(n) AS saved,
            sha256(coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (length = depth), '')) AS ends_sha256
        FROM k GROUP BY node, depth
    ), c AS (
        SELECT parent, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY parent
    ), m AS (
        SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN c ON c.parent = n.node
    ), a AS (
        SELECT DISTINCT u.conv_id AS x, u.depth AS y, m.conv_id, m.depth, m.saved, m.n_children
        FROM k JOIN m ON m.node = k.node JOIN (SELECT k.conv_id AS via, n.* FROM k JOIN n ON n.node = k.node) u ON u.via = k.conv_id AND u.depth <= m.depth
    ), s AS (
        SELECT x, y, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves FROM a GROUP BY x, y
    )
    SELECT m.conv_id, m.depth::BIGINT AS depth, f.conv_id AS parent_conv_id, m.n_convs::BIGINT AS n_convs, m.n_children::BIGINT AS n_children,
        s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, m.ends_sha256
    FROM m JOIN s ON s.x = m.conv_id AND s.y = m.depth LEFT JOIN n f ON m.depth > 0 AND f.node = m.parent
"""


def _escaped_sql() -> str:
    text = "replace(text, chr(92), repeat(chr(92), 2))"
    for control in chat_format.CONTROL:
        text = f"replace({text}, '{control}', '{control[0]}' || chr(92) || '{control[1:]}')"
    return text


def queries() -> dict[str, Query]:
    return {name: f for name, f in globals().items() if name.startswith("op")} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {name: text.replace("{escaped}", _escaped_sql()) for name, text in SQL.items()}
