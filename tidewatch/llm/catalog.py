"""The registered queries of the training-data operators and the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import decontaminate, hard_negatives, kneser_ney, langid, line_windows, minhash, mixing, prefix_trie, secret_scan, sharding, token_blocks, vector_join, warc
from tidewatch.llm.common import table
from tidewatch.session import configure

# Window hashes are the windows themselves here; documents have distinct ids in the given tables.
LINE_WINDOWS = r"""
WITH lines AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
windows AS (
    SELECT doc_id, i AS pos, l[i + 1] || chr(10) || l[i + 2] || chr(10) || l[i + 3] AS w
    FROM (SELECT doc_id, l, unnest(generate_series(0, len(l) - 3)) AS i FROM lines WHERE len(l) >= 3)
),
filled AS (SELECT * FROM windows WHERE length(trim(replace(w, chr(10), ''))) > 0),
firsts AS (SELECT w, min((doc_id, pos)) AS f FROM filled GROUP BY w HAVING count(*) > 1),
later AS (
    SELECT doc_id, CASE WHEN doc_id = f[1] THEN greatest(pos, f[2] + 3) ELSE pos END AS low, pos + 2 AS high
    FROM filled JOIN firsts USING (w) WHERE NOT (doc_id = f[1] AND pos = f[2])
),
covered AS (SELECT doc_id, list(DISTINCT line) AS c FROM (SELECT doc_id, unnest(generate_series(low, high)) AS line FROM later) GROUP BY doc_id),
kept AS (
    SELECT doc_id, l, c, CASE WHEN c IS NULL THEN text ELSE
        coalesce(array_to_string([x FOR x, i IN l IF NOT list_contains(c, i - 1)], chr(10)), '') END AS t
    FROM lines LEFT JOIN covered USING (doc_id)
)
SELECT doc_id, coalesce(len(l), 0)::BIGINT AS n_lines, coalesce(len(c), 0)::BIGINT AS removed, length(t)::BIGINT AS kept_chars, sha256(t) AS kept_sha256 FROM kept
"""


WARC = """
WITH p AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, url, strlen(html) AS n, sha256(html) AS digest, min(page_id) OVER (PARTITION BY sha256(html)) AS first FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest, url,
    CASE WHEN n >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN n >= 100 AND page_id > first THEN first END AS refers_to
FROM d
"""


_REACHED = """both_ways AS (SELECT a AS me, b AS other FROM links UNION ALL SELECT b, a FROM links),
reach(node, seen) AS (SELECT id, id FROM nodes UNION SELECT r.node, l.other FROM reach r JOIN both_ways l ON l.me = r.seen),
reached AS (SELECT node AS id, min(seen) AS component_id FROM reach GROUP BY node)"""

# All pairs that share a shingle are counted here; fit for the small tables it is compared on.
NEAR_DUPLICATES = rf"""
WITH RECURSIVE nodes AS (SELECT doc_id AS id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (SELECT DISTINCT id, unnest(CASE WHEN len(w) >= 4 THEN [array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)]
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM nodes),
sizes AS (SELECT id, count(*) AS n FROM shingles GROUP BY id),
shared AS (SELECT x.id AS a, y.id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s AND x.id < y.id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.id = a JOIN sizes y ON y.id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
{_REACHED}
SELECT id AS doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, id = component_id AS kept FROM reached LEFT JOIN sizes USING (id)
"""

NEAR_VECTORS = f"""
WITH RECURSIVE nodes AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings),
links AS (SELECT x.id AS a, y.id AS b FROM nodes x JOIN nodes y ON x.id < y.id WHERE list_cosine_similarity(x.v, y.v) >= 0.9),
{_REACHED}
SELECT id AS vec_id, (SELECT count(*) FROM both_ways WHERE me = id)::BIGINT AS n_links, component_id, id = component_id AS kept FROM reached
"""


# CRC-32 of the decimal digits by the usual table of 256 remainders, which the first step makes.
PREFIX_TRIE = """
WITH tab AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
turns AS (SELECT conv_id AS c, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS own FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
heads AS (
    SELECT c, own, xor(list_reduce(list_concat([4294967295], list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
        lambda a, x: xor(a // 256, t[xor(a % 256, x) + 1])), 4294967295) % 6 AS h FROM turns, tab
),
whole AS (SELECT x.c, list_concat(coalesce(b.own[1:x.h], []), x.own[x.h + 1:]) AS seq FROM heads x LEFT JOIN turns b ON b.c = x.c - x.c % 100),
steps AS (SELECT c, len(seq) AS ends, unnest(range(len(seq) + 1)) AS d, seq FROM whole),
nodes AS (
    SELECT seq[1:d] AS node, d, min(c) AS conv_id, count(*) AS n_convs, coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends = d), '') AS ends
    FROM steps GROUP BY ALL
),
children AS (SELECT node[1:d - 1] AS node, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
facts AS (
    SELECT n.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * CASE WHEN d = 0 THEN 0 ELSE length(n.node[d].t) END AS saved
    FROM nodes n LEFT JOIN children k ON k.node = n.node
),
sums AS (
    SELECT node[1:up] AS node, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
    FROM (SELECT *, unnest(range(d + 1)) AS up FROM facts) GROUP BY 1
)
SELECT f.conv_id, f.d AS depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, s.n_leaves, s.saved_tokens::BIGINT AS saved_tokens, sha256(f.ends) AS ends_sha256
FROM facts f JOIN sums s ON s.node = f.node LEFT JOIN facts p ON f.d > 0 AND p.node = f.node[1:f.d - 1]
"""

HARD_NEGATIVES = """
WITH q AS (
    SELECT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END) AS label, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
    FROM embeddings WHERE label IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
s AS (
    SELECT a.vec_id AS a, c.vec_id AS c, a.label = c.label AS same, list_inner_product(a.v, c.v)::BIGINT AS score
    FROM q a JOIN q c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id
),
p AS (SELECT a, c, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, c) <= 5)
SELECT p.a AS anchor_id, p.c AS positive_id, row_number() OVER (PARTITION BY p.a, p.c ORDER BY s.score DESC, s.c)::INTEGER AS rank, s.c AS negative_id,
    p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.a = p.a AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score
QUALIFY rank <= 5
"""


def _secret_sql() -> str:
    parts = []
    for rank, rule in enumerate(secret_scan.RULES):
        p = rule.pattern.replace("'", "''")
        parts.append(
            f"SELECT doc_id, {rank} AS rank, '{rule.kind}' AS kind, {rule.base} AS base, {rule.least} AS least, "
            f"regexp_extract_all(t, '{p}') AS m, regexp_extract_all(t, '{p}', {rule.group}) AS v, string_split_regex(t, '{p}') AS g FROM texts"
        )
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({' UNION ALL '.join(parts)}),
placed AS (
    SELECT doc_id, rank, kind, base, length(v[i]) AS size, least, length(m[i]) AS chars,
        coalesce(list_sum([length(x) FOR x IN g[1:i]]), 0) + coalesce(list_sum([length(x) FOR x IN m[1:i - 1]]), 0) AS start
    FROM (SELECT *, unnest(generate_series(1, len(m))) AS i FROM found WHERE len(m) > 0 AND list_max([length(x) FOR x IN v]) >= least)
),
spans AS (SELECT *, kind || ':' || start::BIGINT || ':' || (start + chars)::BIGINT AS s FROM placed WHERE size >= least),
joined AS (
    SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
        string_agg(s, ',' ORDER BY start, rank) FILTER (base) AS b, string_agg(s, ',' ORDER BY start, rank) AS spans
    FROM spans GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
    sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN joined USING (doc_id)
"""


SECRETS = _secret_sql()

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TWINS: dict[str, str] = {}


def query(name: str, twin: str | None = None):
    def add(function):
        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(configure(spark), sf_dir)

        QUERIES[name] = run
        if twin is not None:
            TWINS[name] = twin
        return run

    return add


@query("op8_source_mix")
def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sizes(table(spark, sf_dir, "documents"))


@query("op3_minhash_near_duplicates", NEAR_DUPLICATES)
def minhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4)


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    """Where the installed vocabulary lies; every executor has the same package."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query("op2_token_blocks")
def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_blocks.tokens_round_trip(table(spark, sf_dir, "documents"), tokenizer_file())


@query("op4_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


@query("op1_benchmark_leaks")
def benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op6_secret_scan", SECRETS)
def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_report(table(spark, sf_dir, "documents"))


@query("op10_line_windows", LINE_WINDOWS)
def repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long").alias("n_lines"))
    return line_windows.remove_repeated(docs, removed="removed").select(
        "doc_id", "n_lines", "removed", F.length("text").cast("long").alias("kept_chars"), F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    )


@query("op10_sentence_windows")
def repeated_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_windows.remove_repeated(table(spark, sf_dir, "documents").select("doc_id", "text"), removed="removed", sentences=True).select(
        "doc_id", "removed", F.length("text").cast("long").alias("kept_chars"), F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    )


@query("op5_warc_archive", WARC)
def warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("record_id"), "url", F.col("html").alias("payload"))
    return warc.archive_round_trip(pages).select(
        F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to", "url"
    )


@query("op9_vector_range_join", NEAR_VECTORS)
def near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_join.near_vectors(table(spark, sf_dir, "embeddings"))


@query("op7_kneser_ney_quality")
def text_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op11_packed_shards")
def packed_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_places(table(spark, sf_dir, "documents"))


@query("op12_prefix_trie", PREFIX_TRIE)
def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations")).drop("k1", "k2")


@query("op13_hard_negatives", HARD_NEGATIVES)
def mined_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine_embeddings(table(spark, sf_dir, "embeddings"))
