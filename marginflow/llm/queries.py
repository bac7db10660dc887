"""The operators' queries on whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_format, conv_repair, decontaminate, fingerprint, hard_negatives, html_extract, license_scan, line_dedup, mixing, near_dedup, quality_rules, secret_scan, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_OP1_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(text)
    + len(regexp_extract_all(text, '\[\\*/?INST\]|<\\*/?s>|<\\*<SYS>>|<\\*</SYS>>'))
    + CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 7
      ELSE 16 + length(role) + 2 * len(regexp_extract_all(role, '[%\n<\[]')) END) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""


@query("op1_chat_format", _OP1_SQL)
def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", hard), (-1, 1, "assistant", hard)],
                                  "conv_id long, turn long, role string, text string")
    return chat_format.read_back(chat_format.format_chat(given.unionByName(extra)))


@query("op2_secret_scan")
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(table(spark, sf_dir, "documents"))
    spans = F.transform(F.arrays_zip("kinds", "starts", "ends"),
                        lambda x: F.concat_ws(":", x["kinds"], x["starts"].cast("string"), x["ends"].cast("string")))
    base = [r.kind for r in secret_scan.BASE_RULES]
    count = [F.size(F.expr(f"filter(kinds, x -> x = '{k}')")).cast("long").alias(f"n_{k}") for k in base]
    only = F.filter(F.col("spans"), lambda x: F.split_part(x, F.lit(":"), F.lit(1)).isin(*base))
    return (found.withColumn("spans", spans)
            .select("doc_id", *count,
                    F.sha2(F.array_join(only, ",").cast("binary"), 256).alias("base_sha256"),
                    F.array_join("spans", ",").alias("spans")))


@query("op7_near_dedup")
def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def fold(n: int):
    """crc32 of doc_id as text, modulo ``n``."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n))


def fit_toxicity(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    return toxicity.fit(docs, labels.where(fold(3) != 1))


@query("op10_toxicity")
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return (toxicity.score(docs, model, keep=["doc_id"])
            .select("doc_id", (fold(3) == 1).alias("held_out"), "score",
                    (F.col("score") >= 0.7).cast("int").alias("predicted")))


@query("op4_quality")
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_rules.fit(docs, table(spark, sf_dir, "labels").where(fold(5) != 0))
    return (quality_rules.score(docs, model, keep=["doc_id"])
            .select("doc_id", (fold(5) == 0).alias("held_out"), "score",
                    (F.col("score") >= 0.3).cast("int").alias("predicted")))


_OP8_SQL = r"""
WITH cut AS (
  SELECT doc_id, text, coalesce(source, '') AS site, string_split(text, chr(10)) AS parts FROM documents WHERE text <> ''),
keyed AS (
  SELECT doc_id, site, parts, list_transform(parts, lambda x: CASE WHEN trim(lower(x)) <> ''
    THEN CAST('0x' || substr(md5(trim(lower(x))), 1, 15) AS BIGINT) END) AS keys FROM cut),
least AS (
  SELECT *, list_sort(list_distinct(list_filter(keys, lambda x: x IS NOT NULL))) AS low FROM keyed),
exploded AS (
  SELECT doc_id, site, low, list_filter(keys, lambda x: x IS NOT NULL) AS same, unnest(keys) AS key, unnest(parts) AS part,
    unnest(range(len(keys))) AS pos FROM least),
lines AS (
  SELECT *, CASE WHEN key = low[1] THEN low[2] ELSE low[1] END AS context FROM exploded WHERE key IS NOT NULL),
bad AS (
  SELECT key FROM lines GROUP BY key
  HAVING count(DISTINCT site) >= 5 AND (count(DISTINCT same) >= 5
    OR count(context) > 0 AND count(DISTINCT context) >= count(context) * 0.75)),
marked AS (SELECT e.*, b.key IS NOT NULL AS gone FROM exploded e LEFT JOIN bad b ON e.key = b.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
  coalesce(string_agg(part, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text
FROM marked GROUP BY doc_id
UNION ALL SELECT doc_id, 0, 0, text FROM documents WHERE text IS NULL OR text = ''
"""


@query("op8_line_dedup", _OP8_SQL)
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return line_dedup.remove_boilerplate(docs).select("doc_id", "n_lines", "n_removed", "text")


@query("op6_decontaminate")
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


MIX_BUDGET = 0.3  # share of the tokens that the mixture draws


@query("op5_mixing", mixing.oracle_sql(MIX_BUDGET))
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    weighed = mixing.weigh(docs, mixing.fit_mixture(docs, MIX_BUDGET))
    return weighed.select("doc_id", "topic", "n_tokens", F.round("weight", 6).alias("weight"),
                          F.round("probability", 6).alias("probability"), "selected")


@query("op3_fingerprint")
def op3_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, sf_dir, "documents"))


@query("op9_license_scan")
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licences(table(spark, sf_dir, "documents"))


@query("op11_html_extract")
def op11_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def _op12_sql() -> str:
    """The backward programme with whole scripts: per state the least (cost, audit, rows), from the last row to the first."""
    after = {0: 2, 1: 2, 2: 3, 3: 2}
    fits = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}

    def moved(s, cost, letter, line):
        return f"{{'c': {s}.c + {cost}, 'a': '{letter}' || {s}.a, 'o': {line} || {s}.o}}"

    def best(s):
        keep = " ".join(f"WHEN kind = '{x}' THEN {moved(f'p.s{t}', 'extra', 'K', 'line')}" for (f, x), t in fits.items() if f == s)
        role = "user" if after[s] == 2 else "assistant"
        new = f"chr(10) || '{role}:' || text"
        return (f"list_min([{moved(f'p.s{s}', 4, 'D', repr(''))}, CASE WHEN must THEN NULL {keep} END, "
                f"CASE WHEN NOT must THEN {moved(f'p.s{after[s]}', '3 + extra', 'R', new)} END])")

    def inserted(s, of):
        role = "user" if after[s] == 2 else "assistant"
        return moved(of, 3, "I", f"(chr(10) || '{role}:')")

    closed = lambda s, x, y: f"list_min([{x}{s}, {inserted(s, f'{y}{after[s]}')}])"
    every = range(4)
    return f"""
WITH RECURSIVE coded AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    flatten(list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
      lambda x: [CAST(ascii(x) AS BIGINT), 0, 0, 0, 0, 0, 0, 0])) AS bits
  FROM conversations),
summed AS (
  SELECT *, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], bits),
    lambda a, x: xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1))), 4294967295) % 20 AS kind FROM coded),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM summed),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS n,
    rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS solid FROM damaged),
told AS (
  SELECT *, CASE WHEN solid = '' THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'duplicate'
      WHEN right(solid, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
    lag(role) OVER (PARTITION BY conv_id ORDER BY n) AS prior FROM placed),
steps AS (
  SELECT conv_id, n, text, left(role, 1) AS kind, coalesce(fault IN ('blank', 'duplicate'), FALSE) AS must,
    CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS extra, chr(10) || role || ':' || text AS line FROM told),
walk AS (
  SELECT conv_id, CAST(max(n) + 1 AS BIGINT) AS n, {{'c': 0, 'a': '', 'o': ''}} AS s0,
    {{'c': 6, 'a': 'II', 'o': chr(10) || 'user:' || chr(10) || 'assistant:'}} AS s1,
    {{'c': 3, 'a': 'I', 'o': chr(10) || 'assistant:'}} AS s2, {{'c': 0, 'a': '', 'o': ''}} AS s3
  FROM steps GROUP BY conv_id
  UNION ALL
  SELECT conv_id, n, {", ".join(closed(s, "t", "u") + f" AS s{s}" for s in every)}
  FROM (SELECT *, {", ".join(closed(s, "t", "t") + f" AS u{s}" for s in every)}
    FROM (SELECT x.conv_id, x.n, {", ".join(best(s) + f" AS t{s}" for s in every)}
      FROM walk p JOIN steps x ON x.conv_id IS NOT DISTINCT FROM p.conv_id AND x.n = p.n - 1))),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
    count(*) FILTER (WHERE fault = 'truncated') AS truncated,
    count(*) FILTER (WHERE n > 1 AND left(prior, 1) || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal
  FROM told GROUP BY conv_id)
SELECT o.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
  coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, CAST(coalesce(w.s0.c, 0) AS BIGINT) AS cost,
  coalesce(w.s0.a, '') AS audit, sha256(coalesce(substr(w.s0.o, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN walk w ON w.conv_id IS NOT DISTINCT FROM o.conv_id AND w.n = 1
"""


@query("op12_conv_repair", _op12_sql())
def op12_conv_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return conv_repair.report(conv_repair.damage(given), given)


_OP13_SQL = """
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
  s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""


@query("op13_hard_negatives", _OP13_SQL)
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings").withColumn("label", moved), "vec_id % 50 = 0")
