"""One registered query per operator, over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rondel.llm import (
    alignment, best_fit, chat, decontaminate, line_dedup, merkle, neighbours, packing, quality, simhash, substring_dedup,
    token_files, url_filter)
from rondel.llm.registry import QUERIES, SQL, query  # noqa: F401
from rondel.llm.shared import LOWER, UPPER, table
from rondel.llm.tokens import vocabulary
from rondel.session import scratch_path

_WORDS_SQL = (f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), "
              r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")


@query("op1_decontaminate", f"""
    WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_WORDS_SQL} AS w FROM documents),
    i AS (SELECT item_id, {_WORDS_SQL} AS w FROM benchmark),
    n AS MATERIALIZED (
        SELECT DISTINCT item_id, least(10, len(w)) AS n,
               array_to_string(list_slice(w, s, s + least(10, len(w)) - 1), ' ') AS t
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS s FROM i WHERE len(w) > 0)),
    p AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS s FROM d),
    o AS MATERIALIZED (
        SELECT p.r, p.s, q.n, n.item_id FROM p, (SELECT DISTINCT n FROM n) AS q, n
        WHERE p.s + q.n - 1 <= len(p.w) AND n.n = q.n
          AND array_to_string(list_slice(p.w, p.s, p.s + q.n - 1), ' ') = n.t),
    h AS (SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS x FROM o) GROUP BY r),
    e AS (SELECT r, count(DISTINCT item_id) AS n_items,
                 sha256(string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR))) AS items
          FROM o GROUP BY r)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           coalesce(items, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN h USING (r) LEFT JOIN e USING (r)""")
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    names = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), "contaminated")


@query("op2_quality")
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = quality.document_labels(table(spark, sf_dir, "labels"))
    scored = quality.score(table(spark, sf_dir, "documents"), labels)
    return scored.select("doc_id", "good_probability", (F.col("good_probability") >= quality.MIN_GOOD).alias("accepted"))


@query("op3_substring_dedup")
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substring_dedup.without_repeats(table(spark, sf_dir, "documents"))
    return done.select("doc.doc_id", "n_words", "n_removed",
                       F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query("op4_simhash")
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id")


CONTROL = (-7, "\\### Assistant: </turn> ok")


@query("op5_chat", """
    WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
               UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
               UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok')
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
           CAST(sum(14 + 2 * length(role) - length(translate(role, '\\#<:', '')) + 2 * length(text)
                    - length(translate(text, '\\#<', ''))) AS BIGINT) AS formatted_chars
    FROM c GROUP BY conv_id""")
def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    number, text = CONTROL
    control = spark.range(2).select(
        F.lit(number).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(chat.ASSISTANT).alias("role"), F.lit(text).alias("text"))
    return chat.read_back(chat.format_conversations(rows.unionByName(control)))


@query("op6_line_dedup")
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    done = line_dedup.with_removals(docs)
    return done.select("doc.doc_id", "text", "doc.lang", "doc.source", "doc.n_chars", "n_removed")


@query("op7_token_files")
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-files")
    token_files.write_ids(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), folder)
    return token_files.read_ids(spark, folder, digest=True)


RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def _shrunk_sql(level: str, counts: str) -> str:
    """Posteriors of one level from ``counts (name, n, good, centre)``, as in the operator."""
    return f"""
    {level}_w AS (SELECT least(greatest(1 / least(greatest(coalesce(CASE WHEN sum(n * (n - 1)) > 0 THEN
        (sum((good - n * centre) * (good - n * centre) / greatest(centre * (1 - centre), 1e-6)) - sum(n))
        / sum(n * (n - 1)) END, 0.1), 1e-9), 1 - 1e-9) - 1, 0.5), 1000) AS w FROM {counts}),
    {level} AS (SELECT c.*, w * centre + good AS a, w * (1 - centre) + n - good AS b,
                (w * centre + good) / (w + n) AS mean FROM {counts} AS c, {level}_w)"""


_SHARED_SQL = ", ".join(f"'{s}'" for s in url_filter.SHARED_SUFFIXES)


def _domain_sql(n: int) -> str:
    return f"array_to_string(list_slice(l, greatest(len(l) - {n}, 1), len(l)), '.')"


@query("op8_url_filter", f"""
    WITH u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
                      regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
    l AS (SELECT DISTINCT host, string_split(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '.') AS l FROM u),
    m AS (SELECT host, CASE WHEN {_domain_sql(1)} IN ({_SHARED_SQL}) THEN {_domain_sql(1)} ELSE l[-1] END AS suffix,
                 CASE WHEN {_domain_sql(1)} IN ({_SHARED_SQL}) THEN {_domain_sql(2)} ELSE {_domain_sql(1)} END AS domain FROM l),
    h0 AS (SELECT host, domain, suffix, CAST(count(*) AS DOUBLE) AS n,
                  sum(CASE WHEN quality = 1 AND toxic = 0 THEN 1.0::DOUBLE ELSE 0 END) AS good
           FROM u JOIN labels ON doc_id = page_id JOIN m USING (host) WHERE quality IS NOT NULL AND toxic IS NOT NULL
           GROUP BY ALL),
    top AS (SELECT coalesce(sum(good), 0) + 1 AS a, coalesce(sum(n), 0) - coalesce(sum(good), 0) + 1 AS b FROM h0),
    s0 AS (SELECT suffix, sum(n) AS n, sum(good) AS good, any_value(a / (a + b)) AS centre FROM h0, top GROUP BY suffix),
    {_shrunk_sql("s", "s0")},
    d0 AS (SELECT domain, sum(h0.n) AS n, sum(h0.good) AS good, any_value(s.mean) AS centre
           FROM h0 JOIN s USING (suffix) GROUP BY domain),
    {_shrunk_sql("d", "d0")},
    h1 AS (SELECT host, h0.n, h0.good, d.mean AS centre FROM h0 JOIN d USING (domain)),
    {_shrunk_sql("h", "h1")},
    p AS (SELECT m.host, coalesce(h.a, d.a, s.a, top.a) AS a, coalesce(h.b, d.b, s.b, top.b) AS b
          FROM m LEFT JOIN h USING (host) LEFT JOIN d USING (domain) LEFT JOIN s USING (suffix), top),
    r AS (SELECT page_id, host, path, a, b, CASE
            WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
            WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
            WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
            WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
          FROM u JOIN p USING (host))
    SELECT page_id, host, path, rule, CASE
        WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
        WHEN least(a / (a + b) + {url_filter.Z!r} * sqrt(a / (a + b) * (1 - a / (a + b)) / (a + b + 1)), 1) < {url_filter.MIN_GOOD}
        THEN 'block' ELSE 'allow' END AS verdict FROM r""")
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    outcomes = labels.filter("quality IS NOT NULL AND toxic IS NOT NULL").select(F.col("doc_id").alias("page_id"), good.alias("good"))
    found = url_filter.judge(table(spark, sf_dir, "pages"), outcomes, RULES)
    return found.select("page_id", "host", "path", "rule", "verdict")


@query("op9_neighbours")
def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query("op10_packing")
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def _crc32_sql(value: str) -> str:
    """The unsigned CRC-32 of the ASCII text ``value``, with the table of its remainders from their rule."""
    table = ("list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), "
             "lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))")
    signs = f"list_prepend(4294967295, list_transform(string_split({value}, ''), lambda s: CAST(ascii(s) AS BIGINT)))"
    return f"xor(list_reduce({signs}, lambda c, b: xor(c >> 8, ({table})[(xor(c, b) & 255) + 1])), 4294967295)"


def _leaf_sql(*values: str) -> str:
    return "sha256(" + " || ".join(f"CASE WHEN {v} IS NULL THEN '-' ELSE strlen(CAST({v} AS VARCHAR)) || ':' || {v} END"
                                   for v in values) + ")"


def _tree_sql(name: str, group: str, levels: int) -> str:
    """Levels of a tree over ``<name>_n0 (group, n, g, h)``, and ``<name>_f`` (its leaf rows with what they fold to)."""
    parts = []
    for i in range(levels):
        run = f"PARTITION BY {group}, g // 3 ORDER BY g ROWS BETWEEN"
        parts.append(f"""
    {name}_s{i} AS MATERIALIZED (SELECT *, n > {3 ** i} AS more,
        coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
        coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}_n{i}),
    {name}_n{i + 1} AS MATERIALIZED (SELECT {group}, n, g // 3 AS g,
        CASE WHEN n > {3 ** i} THEN sha256(string_agg(h, '' ORDER BY g)) ELSE any_value(h) END AS h
        FROM {name}_n{i} GROUP BY {group}, n, g // 3),
    {name}_f{i + 1} AS MATERIALIZED (SELECT f.* EXCLUDE (acc, proof), CASE WHEN more THEN sha256(l || acc || r) ELSE acc END AS acc,
        proof || l || r AS proof FROM {name}_f{i} AS f JOIN {name}_s{i} AS s
        ON f.{group} IS NOT DISTINCT FROM s.{group} AND s.g = f.p // {3 ** i})""")
    return ",".join(parts)


LEAF_COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
_LEVELS = 12  # of the SQL: up to 3 ** 12 rows of a source and sources


@query("op11_merkle", f"""
    WITH x AS (SELECT doc_id, source, {_leaf_sql(*LEAF_COLUMNS)} AS leaf,
                      CASE WHEN {_crc32_sql("CAST(doc_id AS VARCHAR)")} & 1 = 0
                      THEN {_leaf_sql(*LEAF_COLUMNS[:-1], "replace(text, chr(10), '')")} END AS changed FROM documents),
    d_f0 AS MATERIALIZED (SELECT doc_id, source, leaf, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p,
        count(*) OVER (PARTITION BY source) AS n, coalesce(changed, leaf) AS acc, '' AS proof FROM x),
    d_n0 AS MATERIALIZED (SELECT source, n, p AS g, leaf AS h FROM d_f0),
    {_tree_sql("d", "source", _LEVELS)},
    t_n0 AS MATERIALIZED (SELECT 0 AS one, count(*) OVER () AS n, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS g, h, source
        FROM d_n{_LEVELS}),
    t_f0 AS MATERIALIZED (SELECT f.* EXCLUDE (p), t.one, t.g AS p, t.h AS subroot FROM d_f{_LEVELS} AS f
        JOIN t_n0 AS t ON f.source IS NOT DISTINCT FROM t.source),
    {_tree_sql("t", "one", _LEVELS)}
    SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, acc AS folded_root, acc = h AS verified
    FROM t_f{_LEVELS}, (SELECT h FROM t_n{_LEVELS})""")
def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("doc_id").cast("string").cast("binary")
    tampered = F.when(F.crc32(name) % 2 == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))
    found = merkle.manifest(table(spark, sf_dir, "documents"), "doc_id", "source", LEAF_COLUMNS, {"text": tampered})
    found = found.withColumn("folded_root", merkle.folded(F.col("claimed"), F.col("path")))
    return found.select(F.col("key").alias("doc_id"), "leaf", "subroot", "root",
                        F.sha2(merkle.siblings(F.col("path")), 256).alias("proof_sha256"), "folded_root",
                        (F.col("folded_root") == F.col("root")).alias("verified"))


@query("op12_alignment")
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alignment.align(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"),
                            vocabulary("piece_bpe_32k.model"), digest=True)
    return found.withColumnRenamed("groups", "groups_sha256")


@query("op13_best_fit")
def op13_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = best_fit.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
    piece = F.expr(f"cast(start div {packing.SEQUENCE_IDS} as int)").alias("piece")
    return placed.select("doc_id", piece, "start", "length", "ids_crc32", "sequence_id", "offset")
