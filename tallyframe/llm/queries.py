"""The operators of this package as registered queries over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyframe.llm import (
    classlm, leaks, mixing, nearcopies, neighbours, outliers, packing, pieces, ranking, replies, rollups, toxicity, variants
)
from tallyframe.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def registered(sql: str | None = None):
    """Register a query under its function name, with its SQL where SQL can express it."""

    def add(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[build.__name__] = build
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build

    return add


@registered()
def op2_quality_outliers(spark: SparkSession, folder: str) -> DataFrame:
    return outliers.quality_verdicts(table(spark, folder, "documents"))


@registered()
def op5_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return leaks.scan_report(table(spark, folder, "documents"))


@registered()
def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.scored(docs, toxicity.fit(docs, table(spark, folder, "labels")))


#: One conversation with the marks of the template inside its texts.
MARKED = [(-7, 0, "user", r"\### Assistant: </turn> ok"), (-7, 1, "assistant", r"\### Assistant: </turn> ok")]

_RUNS = r"len({0}) - len(regexp_replace({0}, '#{{3,}}', '', 'g'))"
_ESCAPED = f"len({{0}}) + len({{0}}) - len(replace({{0}}, chr(92), '')) + (len({{0}}) - len(replace({{0}}, '</turn>', ''))) // 7 + {_RUNS}"


@registered(
    f"""WITH all_turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', chr(92) || '### Assistant: </turn> ok'
        UNION ALL SELECT -7, 1, 'assistant', chr(92) || '### Assistant: </turn> ok'
    ), whole AS (
        SELECT conv_id, count(*) AS n_turns,
               string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
               coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '') AS learned,
               CAST(sum(15 + {_ESCAPED.format("role")} + {_ESCAPED.format("text")}) AS bigint) AS formatted_chars
        FROM all_turns GROUP BY conv_id
    )
    SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, len(learned) AS loss_chars, sha256(learned) AS loss_sha256,
           formatted_chars FROM whole"""
)
def op4_reply_trees(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    marked = spark.createDataFrame(MARKED, "conv_id long, turn long, role string, text string")
    return replies.conversation_report(rows.unionByName(marked))


@registered()
def op6_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    mixed = mixing.mix(docs, F.array(F.col("source").cast("string")), mixing.n_words(F.col("text")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


@registered()
def op10_token_rollups(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return rollups.corpus_rollup(docs, labels, "/opt/tokenizers/byte_bpe_50k.tiktoken", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")


@registered()
def op1_nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(table(spark, folder, "embeddings"), F.col("id") % 20 == 0)


@registered()
def op3_near_copies(spark: SparkSession, folder: str) -> DataFrame:
    return nearcopies.near_copies(table(spark, folder, "documents"), shingle=2)


@registered()
def op8_class_bigrams(spark: SparkSession, folder: str) -> DataFrame:
    return classlm.held_out_scores(table(spark, folder, "documents"))


@registered()
def op9_piece_lattice(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.encoded(table(spark, folder, "documents"), pieces.read_pieces(), fold="viterbi")


_TERMS = r"""unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term"""


@registered(
    f"""WITH doc_terms AS (
        SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, {_TERMS} FROM documents) GROUP BY doc_id, term
    ), sizes AS (
        SELECT doc_id, CAST(sum(tf) AS bigint) AS n FROM doc_terms GROUP BY doc_id
    ), totals AS (
        SELECT count(*) AS docs, CAST(sum(n) AS bigint) AS words FROM sizes
    ), weights AS (
        SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS bigint) AS w
        FROM doc_terms, totals GROUP BY term, docs
    ), item_terms AS (
        SELECT item_id, term, count(*) AS times FROM (SELECT item_id, {_TERMS} FROM benchmark) GROUP BY item_id, term
    ), scores AS (
        SELECT item_id, doc_id,
               CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // words)))) AS bigint) AS score
        FROM item_terms JOIN doc_terms USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id), totals
        GROUP BY item_id, doc_id
    ), ranked AS (
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS int) AS rank, doc_id, score
        FROM scores WHERE score > 0
    )
    SELECT * FROM ranked WHERE rank <= 20"""
)
def op11_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.ranked_search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@registered()
def op12_window_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.piece_report(packing.pack(table(spark, folder, "documents"), "/opt/tokenizers/word_bpe_49k.json"))


@registered()
def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return variants.spelling_variants(table(spark, folder, "documents"))
