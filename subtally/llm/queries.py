"""One query for each operator, over its whole table, and the SQL it must equal where SQL can express it."""

from __future__ import annotations

import importlib.util
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subtally.llm import alignment, chat, chunks, langid, lexical, lm, packing, pieces, quality, secrets, simhash, topk, urls
from subtally.llm.common import id_crc, stored, table
from subtally.session import shared_dir

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer(name: str) -> str:
    """Path of a public vocabulary file on the driver; tasks get its content."""
    from public_tokenizers import path

    return path(name)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = id_crc() % 4 == 2
    model = langid.fit(docs.filter(~held_out))
    found = langid.identify(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pieces.encode_decode(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"), digests_only=True)
    return rows.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = id_crc() % 7 == 2
    found = lm.scores(docs, ~held_out, id_crc() % 7 == 6)
    return found.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


# The given rules.
URL_RULES = [
    urls.Rule("allow", "org", "/"),
    urls.Rule("block", "example.org", "/es/"),
    urls.Rule("block", "example.org", "/en/1"),
    urls.Rule("allow", "com", "/fr/"),
    urls.Rule("block", "com", "/de/"),
]


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    statistics = stored(quality.with_statistics(docs, "doc_id"), "quality")
    verdict = quality.fit(statistics, table(spark, sf_dir, "labels"))
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return quality.judge(statistics, verdict).select("doc_id", *base, "base_failed", "kept", "score")


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


OP6_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = len(embedding)
), pairs AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs
) WHERE rank <= 5
"""


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.repeated_passages(table(spark, sf_dir, "documents"))


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = secrets.Ledger(spark, shared_dir(spark, "ledger"))
    return secrets.digest_columns(secrets.with_findings(docs, ledger))


def op9_sql() -> str:
    """For each rule the matches and what lies between them; a match starts after all that is before it."""
    found = []
    for kind, (name, (pattern, least)) in enumerate(secrets.RULES.items()):
        quoted = "'" + pattern.replace("'", "''") + "'"
        counts = f"length(regexp_extract(own, {quoted}, 2)) >= {least}" if least else "TRUE"
        found.append(f"""
    SELECT doc_id, n, '{name}' AS name, {kind} AS kind, start, start + length(own) AS stop FROM (
        SELECT doc_id, n, ms[i] AS own, list_sum(list_transform(gs[1:i], lambda x: length(x)))
            + coalesce(list_sum(list_transform(ms[1:i-1], lambda x: length(x))), 0) AS start
        FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM (
            SELECT doc_id, n, regexp_extract_all(t, {quoted}) AS ms, string_split_regex(t, {quoted}) AS gs FROM d))
    ) WHERE {counts}""")
    return f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS n, coalesce(text, '') AS t FROM documents),
found AS ({" UNION ALL ".join(found)}),
by_doc AS (
    SELECT n, count(*) FILTER (name = 'assign') AS n_assign, count(*) FILTER (name = 'access') AS n_access,
        count(*) FILTER (name = 'hex') AS n_hex,
        string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, kind) FILTER (kind < 3) AS base,
        string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, kind) AS spans
    FROM found GROUP BY n
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
    sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN by_doc USING (n)
"""


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = stored(simhash.fingerprints(table(spark, sf_dir, "documents"), "doc_id"), "prints")
    found = simhash.near_duplicates(prints)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return alignment.aligned_documents(docs, tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model")).drop("groups")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.top_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_sql() -> str:
    def terms(name: str, key: str) -> str:
        lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
        return f"""
    SELECT {key}, unnest(regexp_extract_all({lower}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM {name}"""

    return f"""
WITH d AS (SELECT doc_id, text, row_number() OVER () AS doc FROM documents),
b AS (SELECT item_id, text, row_number() OVER () AS item FROM benchmark),
dt AS ({terms("d", "doc")}),
bt AS (SELECT DISTINCT item, term FROM ({terms("b", "item")})),
sizes AS (SELECT doc, count(*) AS n FROM dt GROUP BY doc),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
tf AS (SELECT doc, term, count(*) AS tf FROM dt WHERE term IN (SELECT term FROM bt) GROUP BY doc, term),
w AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
    FROM tf, totals GROUP BY term
),
scored AS (
    SELECT item, doc, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms)))) AS BIGINT) AS score
    FROM bt JOIN tf USING (term) JOIN w USING (term) JOIN sizes USING (doc), totals GROUP BY item, doc
),
ranked AS (
    SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank
    FROM scored JOIN d USING (doc) JOIN b USING (item) WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""


# The conversation that the contract adds to the table.
PROBE = "</s>[INST] ok [/INST]"


def op13_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", PROBE), (-1, 1, "assistant", PROBE)], rows.schema)
    found = chat.read_back(chat.format_replies(chat.as_replies(rows.unionByName(probe))))
    return found.select(F.col("tree").alias("conv_id"), *chat.digest_columns(found))


def op13_sql() -> str:
    def escaped(column: str) -> str:
        text = f"replace({column}, '\\', '\\\\')"
        for mark in (chat.BEGIN, chat.END, chat.OPEN, chat.CLOSE):
            text = f"replace({text}, '{mark}', '{mark[0]}\\{mark[1:]}')"
        return text

    marks = len(chat.OPEN + chat.CLOSE + chat.END)
    return f"""
WITH c AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, role IS NULL AS r, text IS NULL AS t FROM conversations
    UNION ALL SELECT -1, 0, 'user', '{PROBE}', false, false
    UNION ALL SELECT -1, 1, 'assistant', '{PROBE}', false, false
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, r, role, t, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, t, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST({len(chat.BEGIN)} + sum({marks} + length({escaped("role")}) + length({escaped("text")})) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""


def queries() -> dict[str, Query]:
    named = {
        "op1_language_id": op1_language_id,
        "op2_sentencepiece": op2_sentencepiece,
        "op3_lm_scoring": op3_lm_scoring,
        "op4_url_filters": op4_url_filters,
        "op5_packing": op5_packing,
        "op6_top_k": op6_top_k,
        "op7_substring_dedup": op7_substring_dedup,
        "op8_quality": op8_quality,
        "op9_secret_scans": op9_secret_scans,
        "op10_simhash": op10_simhash,
        "op11_tokenizer_alignment": op11_tokenizer_alignment,
        "op12_lexical_search": op12_lexical_search,
        "op13_chat_formatting": op13_chat_formatting,
    }
    if importlib.util.find_spec("corpus_pipeline"):
        import corpus_pipeline

        named["pipeline"] = corpus_pipeline.run
    return named


def statements() -> dict[str, str]:
    return {
        "op6_top_k": OP6_SQL,
        "op9_secret_scans": op9_sql(),
        "op12_lexical_search": op12_sql(),
        "op13_chat_formatting": op13_sql(),
    }
