import pytest
from pyspark.sql import functions as F

from rondel.functions.tokens import token_array
from rondel.operators import curation, text_index
from rondel.plans import match_results as matches
from rondel.plans.catalog import QUERIES

DOCS = [(1, "Natus Vincere a-b_c  Dust2"), (2, " É lead"), (3, ""), (4, None), (5, "the of")]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id bigint, text string")


def tokens_of(frame):
    return sorted((r["doc_id"], r["token"]) for r in frame.collect())


def test_nonword_rule(docs):
    assert tokens_of(text_index.tokenize(docs, rule="nonword")) == [
        (1, "b_c"), (1, "dust2"), (1, "natus"), (1, "vincere"), (2, "lead")]


def test_alnum_rule(docs):
    assert tokens_of(text_index.tokenize(docs, rule="alnum")) == [
        (1, "dust2"), (1, "natus"), (1, "vincere"), (2, "lead")]


def test_unknown_rule(docs):
    with pytest.raises(ValueError):
        text_index.tokenize(docs, rule="none")


def test_reduction_counts(docs):
    row = text_index.token_reduction(docs, rule="nonword").first()
    assert (row["tokens_raw"], row["tokens_clean"]) == (8, 5)
    assert row["reduction_pct"] == pytest.approx(37.5)


@pytest.fixture
def index(spark):
    docs = spark.createDataFrame(
        [(i, "hot " + ("hot " if i == 3 else "") + f"word{i}") for i in range(10)], "doc_id bigint, text string")
    tokens = text_index.tokenize(docs, rule="alnum")
    return lambda distinct: text_index.inverted_index(
        tokens, block=text_index.id_block("doc_id", 4), distinct=distinct)


def test_repeated_token_in_one_document(index):
    for distinct, size in ((True, 10), (False, 11)):
        stats = text_index.term_stats(index(distinct)).filter("token = 'hot'").first()
        assert (stats["postings"], stats["freq"], stats["blocks"]) == (size, 11, 3)


def test_no_block_covers_more_documents_than_its_width(index):
    assert index(True).agg(F.max(F.size("doc_ids"))).first()[0] <= 4


def test_index_invariants(index):
    assert index(True).filter(F.size("doc_ids") > F.col("freq")).count() == 0
    assert index(True).agg(F.sum("freq")).first()[0] == 21


def test_lookup_of_present_missing_and_stop_words(spark, index):
    found = {r["term"]: (r["hits"], r["freq"]) for r in
             text_index.lookup_terms(spark, index(True), ["hot", "word3", "nothing", "the"]).collect()}
    assert found == {"hot": (10, 11), "word3": (1, 1), "nothing": (0, 0), "the": (0, 0)}


def test_lookup_reads_only_wanted_tokens(spark, index, tmp_path):
    path = str(tmp_path / "index")
    text_index.write_index(index(True), path)
    stored = spark.read.parquet(path)
    plan = text_index.postings(stored, ["hot"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(token), EqualTo(token,hot)" in plan
    assert "ReadSchema: struct<token:string,doc_ids:array<bigint>>" in plan
    assert text_index.postings(stored, ["hot"]).count() == 10
    pruned = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "bucket" in pruned and "xxhash64" not in pruned  # only one directory is listed
    looked = {r["term"]: (r["hits"], r["freq"]) for r in text_index.lookup_terms(spark, stored, ["hot", "word3", "none"]).collect()}
    assert looked == {"hot": (10, 11), "word3": (1, 1), "none": (0, 0)}


def test_top_terms_break_ties_by_token(index):
    top = [r["token"] for r in text_index.top_terms(index(True), 3).collect()]
    assert top == ["hot", "word0", "word1"]


def test_csv_round_trip(spark, index, tmp_path):
    path = str(tmp_path / "csv")
    text_index.index_to_csv(index(False), path)
    assert sorted(text_index.index_from_csv(spark, path, "bigint").collect()) == sorted(index(False).collect())


def test_block_count_grows_with_the_corpus():
    assert [text_index.blocks_for(n, 100) for n in (0, 1, 100, 101, 10_000)] == [1, 1, 1, 2, 100]


def test_corpus_needs_every_id_part(spark):
    rows = spark.createDataFrame(
        [(1, "dust2", "a", None), (None, "nuke", "a", "b"), (1, "nuke", "a", "b"), (1, "nuke", "a", "c")],
        "match_id int, _map string, team_1 string, team_2 string")
    built = text_index.corpus_build(
        rows, id_parts=["match_id", "_map"], text_parts=["team_1", "team_2", "_map"], required=["match_id", "_map"])
    assert sorted(built.collect()) == [("1_dust2", "a dust2"), ("1_nuke", "a b nuke")]


@pytest.fixture
def texts(spark):
    same = "s" * 120
    return spark.createDataFrame(
        [(2, same), (1, same), (3, "x" * 99), (4, "y" * 100), (5, None)], "doc_id int, text string")


def test_curation_keeps_the_first_copy_and_the_inclusive_length(texts):
    assert sorted(r["doc_id"] for r in curation.curate_text(texts).collect()) == [1, 4]


def test_quality_adds_up(texts):
    row = curation.curation_quality(texts).first().asDict()
    assert row == {"total_before": 5, "null_text": 1, "too_short": 1, "duplicate": 1, "total_after": 2, "pass_ratio": 0.4}
    assert row["total_after"] == curation.curate_text(texts).count()


def test_quality_of_nothing(spark):
    row = curation.curation_quality(spark.createDataFrame([], "text string")).first()
    assert (row["total_before"], row["total_after"], row["pass_ratio"]) == (0, 0, None)


def test_narrative_skips_missing_values(spark):
    clean = spark.createDataFrame(
        [("2020-03-01", "a", "b", "dust2", 16, 9, 1, 7, 1, None, 5)],
        "date string, team_1 string, team_2 string, _map string, result_1 int, result_2 int, map_winner int, "
        "event_id int, match_id int, rank_1 int, rank_2 int")
    row = matches.narratives(clean).first()
    assert row["text"] == ("On 2020-03-01 in CS:GO event 7 , a defeated b on dust2 with a score of 16 to 9 "
                           ". Team 1 world ranking: , Team 2 world ranking: 5 .")
    assert row["doc_id"] == "1_dust2" and row["source"] == "HLTV_CSGO"


def test_schema_rows(texts):
    assert [tuple(r) for r in curation.schema_rows(texts).collect()] == [
        (0, "doc_id", "int", True), (1, "text", "string", True)]


def test_rendered_sentences_are_curated_without_being_stored_or_shuffled(spark, sf_dir):
    plan = QUERIES["curate_narrative"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    shuffled = [line for line in plan.splitlines() if "partial_min" in line]
    assert len(shuffled) == 1 and "text" not in shuffled[0]


def test_rendered_and_stored_sentences_keep_the_same_rows(spark):
    clean = spark.createDataFrame(
        # equal sentences under different ids, one id twice, a null date and team that shorten the sentence
        [("2020-03-01", f"team{'x' * 40}{i % 3}", None if i % 5 == 0 else "b", "dust2", 16, 9, 1, 7, i % 11, None if i % 2 else 3, 5)
         for i in range(60)] + [(None, "a", "b", "m", 1, 2, 2, 7, 99, None, None)],
        "date string, team_1 string, team_2 string, _map string, result_1 int, result_2 int, map_winner int, "
        "event_id int, match_id int, rank_1 int, rank_2 int")
    stored, rendered = (sorted(tuple(r) for r in df.drop("curated_at").collect()) for df in (
        matches.curated(matches.narratives(clean)), matches.curated_narratives(clean)))
    assert rendered == stored and 1 < len(rendered) < 60


def test_alnum_pieces_come_from_one_pass_and_are_the_same(spark):
    texts = ["", " ", "a", " a", "a ", "A_b-c  d", "\té\n", "x y z", "\U0001f600a\U0001f600", "É1", "\x0b2\x1c3", "İi", None]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    two_passes = F.split(F.regexp_replace(F.lower("text"), r"[^a-z0-9\s]", " "), r"\s+")
    both = docs.select(token_array(F.col("text"), "alnum").alias("one"), two_passes.alias("two"))
    assert [r["one"] for r in both.collect()] == [r["two"] for r in both.collect()]
    assert "regexp_replace" not in docs.select(token_array(F.col("text"), "alnum"))._jdf.queryExecution().toString()
