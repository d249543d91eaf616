"""Queries over documents: corpus, tokens, inverted index and curated text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rondel.functions.tokens import STOP_WORDS
from rondel.operators import curation, text_index
from rondel.plans import match_results as matches
from rondel.plans.registry import query
from rondel.plans.standins import PLAYS_SQL, plays, table
from rondel.session import scratch_path
from rondel.sources import files, layout

# ---- corpus and tokens -----------------------------------------------------------------------


@query("corpus_build", f"""
    SELECT doc_id, text, date, _map, team_1, team_2
    FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY text, date, _map, team_1, team_2) AS place
          FROM (SELECT CAST(match_id AS VARCHAR) || '_' || _map AS doc_id,
                       concat_ws(' ', team_1, team_2, _map, CAST(result_1 AS VARCHAR), CAST(result_2 AS VARCHAR)) AS text,
                       date, _map, team_1, team_2
                FROM {PLAYS_SQL}) AS docs) AS placed
    WHERE place = 1
""")
def corpus_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches.corpus(plays(spark, sf_dir))


_PIECES = {
    "nonword": r"regexp_split_to_array(lower(text), '[\s\W]+')",
    "alnum": r"regexp_split_to_array(regexp_replace(lower(text), '[^a-z0-9\s]', ' ', 'g'), '\s+')",
}


def _raw_sql(rule: str) -> str:
    return (f"(SELECT * FROM (SELECT doc_id, unnest({_PIECES[rule]}) AS token FROM documents) AS t "
            "WHERE length(token) > 0) AS raw")


def _kept_sql(rule: str) -> str:
    words = ", ".join(f"'{w}'" for w in STOP_WORDS[rule])
    return f"length(token) >= 2 AND token NOT IN ({words})"


def _tokens_sql(rule: str) -> str:
    return f"SELECT doc_id, token FROM {_raw_sql(rule)} WHERE {_kept_sql(rule)}"


@query("tokenize", _tokens_sql("nonword"))
def tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_index.tokenize(table(spark, sf_dir, "documents"), rule="nonword")


@query("tokenize_alnum", _tokens_sql("alnum"))
def tokenize_alnum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_index.tokenize(table(spark, sf_dir, "documents"), rule="alnum")


def _reduction_sql(rule: str) -> str:
    return f"""
        SELECT '{rule}' AS rule, count(*) AS tokens_raw, count(*) FILTER (WHERE {_kept_sql(rule)}) AS tokens_clean,
               CAST(count(*) - count(*) FILTER (WHERE {_kept_sql(rule)}) AS DOUBLE) * 100 / count(*) AS reduction_pct
        FROM {_raw_sql(rule)}"""


@query("token_reduction", f"{_reduction_sql('nonword')} UNION ALL {_reduction_sql('alnum')}")
def token_reduction(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sides = [text_index.token_reduction(docs, rule=r).select(F.lit(r).alias("rule"), "*") for r in ("nonword", "alnum")]
    return sides[0].unionByName(sides[1])


# ---- inverted index --------------------------------------------------------------------------

# Documents per posting block; small here, so that the test tables fill several blocks.
_WIDTH = 256
# A frequent term, two of middle frequency, a stop word and one that does not occur.
_WORDS = ("ci", "que", "der", "the", "zzzmissing")


def _blocked_index(spark: SparkSession, sf_dir: str, rule: str, distinct: bool) -> DataFrame:
    tokens = text_index.tokenize(table(spark, sf_dir, "documents"), rule=rule)
    return text_index.inverted_index(tokens, block=text_index.id_block("doc_id", _WIDTH), distinct=distinct)


def _index_sql(rule: str, distinct: bool) -> str:
    ids = "DISTINCT doc_id" if distinct else "doc_id"
    return f"""
        SELECT token, CAST(floor(doc_id / {_WIDTH}) AS BIGINT) AS block,
               string_agg({ids}, '|' ORDER BY doc_id) AS doc_ids, count(*) AS freq
        FROM (SELECT token, doc_id FROM ({_tokens_sql(rule)}) AS t0) AS t GROUP BY ALL"""


def _joined(index: DataFrame) -> DataFrame:
    return index.withColumn("doc_ids", F.array_join(F.col("doc_ids").cast("array<string>"), "|"))


@query("inverted_index_list", _index_sql("nonword", False))
def inverted_index_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(_blocked_index(spark, sf_dir, "nonword", distinct=False))


@query("inverted_index_set", _index_sql("alnum", True))
def inverted_index_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(_blocked_index(spark, sf_dir, "alnum", distinct=True))


def stored_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "index")
    text_index.write_index(_blocked_index(spark, sf_dir, "alnum", distinct=True), path)
    return spark.read.parquet(path)


def lookup_words(spark: SparkSession, index: DataFrame) -> DataFrame:
    return text_index.lookup_terms(spark, index, _WORDS)


_TERMS_SQL = ", ".join(f"('{w}')" for w in _WORDS)


@query("index_lookup", f"""
    SELECT term, count(DISTINCT doc_id) AS hits, count(doc_id) AS freq
    FROM (VALUES {_TERMS_SQL}) AS v(term) LEFT JOIN ({_tokens_sql("alnum")}) AS t ON t.token = v.term
    GROUP BY term
""")
def index_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup_words(spark, stored_index(spark, sf_dir))


@query("index_postings", f"""
    SELECT DISTINCT token, doc_id FROM ({_tokens_sql("alnum")}) AS t
    WHERE token IN ({", ".join(f"'{w}'" for w in _WORDS)})
""")
def index_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_index.postings(stored_index(spark, sf_dir), _WORDS)


@query("index_top_terms", f"""
    SELECT token, count(*) AS postings, count(*) AS freq, count(DISTINCT CAST(floor(doc_id / {_WIDTH}) AS BIGINT)) AS blocks
    FROM ({_tokens_sql("nonword")}) AS t GROUP BY token ORDER BY freq DESC, token LIMIT 20
""")
def index_top_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_index.top_terms(_blocked_index(spark, sf_dir, "nonword", distinct=False), 20)


@query("index_csv_roundtrip", _index_sql("alnum", True))
def index_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "index_csv")
    text_index.index_to_csv(_blocked_index(spark, sf_dir, "alnum", distinct=True), path)
    return _joined(text_index.index_from_csv(spark, path, "bigint"))


@query("storage_footprint")
def storage_footprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes depend on the writer, so there is no SQL counterpart."""
    docs = matches.corpus(plays(spark, sf_dir))
    paths = {fmt: scratch_path(spark, f"corpus_{fmt}") for fmt in ("parquet", "csv")}
    docs.write.parquet(paths["parquet"])
    files.write_csv(spark.read.parquet(paths["parquet"]), paths["csv"])
    return layout.footprint_ratio(layout.layout_stats(spark, paths), "parquet", "csv")


# ---- curated text ----------------------------------------------------------------------------

_RESOLVED_SQL = f"""
    (SELECT *, CASE WHEN map_winner = 1 THEN team_1 ELSE team_2 END AS winner_team,
               CASE WHEN map_winner = 1 THEN team_2 ELSE team_1 END AS loser_team,
               CASE WHEN map_winner = 1 THEN result_1 ELSE result_2 END AS winner_score,
               CASE WHEN map_winner = 1 THEN result_2 ELSE result_1 END AS loser_score
     FROM {PLAYS_SQL}) AS resolved"""
_NARRATIVE_SQL = f"""
    SELECT CAST(match_id AS VARCHAR) || '_' || _map AS doc_id, date, _map, winner_team, loser_team, event_id,
           concat_ws(' ', 'On', CAST(date AS VARCHAR), 'in CS:GO event', CAST(event_id AS VARCHAR), ',', winner_team,
                     'defeated', loser_team, 'on', _map, 'with a score of', CAST(winner_score AS VARCHAR), 'to',
                     CAST(loser_score AS VARCHAR), '. Team 1 world ranking:', CAST(rank_1 AS VARCHAR),
                     ', Team 2 world ranking:', CAST(rank_2 AS VARCHAR), '.') AS text,
           'HLTV_CSGO' AS source, 'v1.0' AS version
    FROM {_RESOLVED_SQL}"""


@query("render_narrative", _NARRATIVE_SQL)
def render_narrative(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches.narratives(plays(spark, sf_dir)).drop("curated_at", "content_hash")


@query("curate_narrative", f"""
    SELECT * EXCLUDE (place)
    FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS place
          FROM ({_NARRATIVE_SQL}) AS n WHERE length(text) >= 100) AS placed
    WHERE place = 1
""")
def curate_narrative(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The time and the 64-bit hash have no SQL counterpart and are left out."""
    return matches.curated_narratives(plays(spark, sf_dir)).drop("curated_at", "content_hash")


@query("curate_text", """
    SELECT doc_id, lang, source, n_chars, sha256(text) AS text_key
    FROM (SELECT *, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) AS place
          FROM documents WHERE length(text) >= 100) AS placed
    WHERE place = 1
""")
def curate_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = curation.curate_text(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "lang", "source", "n_chars", curation.content_key().alias("text_key"))


@query("curation_quality", """
    WITH e AS (SELECT count(*) AS total_before, count(*) FILTER (WHERE text IS NULL) AS null_text,
                      count(*) FILTER (WHERE length(text) < 100) AS too_short,
                      count(*) FILTER (WHERE length(text) >= 100) AS eligible,
                      count(DISTINCT CASE WHEN length(text) >= 100 THEN sha256(text) END) AS total_after
               FROM documents)
    SELECT total_before, null_text, too_short, eligible - total_after AS duplicate, total_after,
           CAST(total_after AS DOUBLE) / total_before AS pass_ratio
    FROM e
""")
def curation_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.curation_quality(table(spark, sf_dir, "documents"))


@query("dataset_card", """
    SELECT 'Documents' AS name, 'test tables' AS source, 'v1.0' AS version, count(*) AS size_rows,
           CAST(sum(length(text)) AS BIGINT) AS size_chars, CAST(min(length(text)) AS INT) AS min_chars,
           CAST(max(length(text)) AS INT) AS max_chars, '{"doc_id":"bigint","text":"string","lang":"string","source":"string","n_chars":"bigint"}' AS schema,
           'at least 100 characters; each different text once' AS quality_filters, 'retrieval' AS intended_use
    FROM (SELECT text FROM documents WHERE length(text) >= 100 GROUP BY text) AS kept
""")
def dataset_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.dataset_card(
        curation.curate_text(table(spark, sf_dir, "documents")), name="Documents", source="test tables",
        version="v1.0", intended_use="retrieval", filters=["at least 100 characters", "each different text once"])
