"""The registered queries of this package: thin digests of the operators' real outputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.llm import (
    ball_tree, decision_list, host_reputation, jaccard_join, line_templates, mixing, packing, page_templates,
    periodic_runs, personal_data, prefix_trie, quality_fm, suffix_dedup,
)
from kpiloom.llm.common import WORD_CLASS, table, without


#: Each query vector against every other row, ranked.
TOP_K = """
WITH usable AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


def _line_sql(lines: str) -> str:
    even = f"list_transform({lines}, lambda x: trim(regexp_replace(x, '[\\x20\\x09-\\x0D]+', ' ', 'g'), ' '))"
    return f"list_distinct(list_filter({even}, lambda x: len(string_split(x, ' ')) >= 8))"


def _decoded_sql(text: str) -> str:
    for reference, char in host_reputation.REFERENCES:
        text = f"replace({text}, '{reference}', '{char.replace(chr(39), 2 * chr(39))}')"
    return text


def _level_sql(children: str, keys: str) -> str:
    """Prior weight by moments and posterior mean for children with n, k and the mean above."""
    return f"""
  SELECT {keys}, n, k, weight, (k + weight * above) / (n + weight) AS mean
  FROM {children}, (
    SELECT (1 - held) / held AS weight FROM (
      SELECT least(greatest(coalesce(sum((k - n * above) * (k - n * above) - n * above * (1 - above))
               / nullif(sum(n * (n - 1) * above * (1 - above)), 0), 1 / 1001.0::DOUBLE), 1 / 1001.0::DOUBLE), 0.5::DOUBLE) AS held
      FROM {children}))"""


_BLOCKS = "regexp_split_to_array(regexp_replace(html, '{hidden}', ' ', 'g'), '<[^>]*>')".format(
    hidden=host_reputation.HIDDEN)
_AS_IS = "regexp_matches(host, '^[0-9.]*$|^\\[')"
_NAME = "regexp_extract(host, '(?s)^(?:.*@)?([^:]*)', 1)"

#: Rules, and the shrunk reputation of the host where no rule fits.
REPUTATION = f"""
WITH parts AS (
  SELECT page_id, url, html, regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host
  FROM pages
), judged AS (
  SELECT doc_id, min(CASE WHEN quality = 1 AND coalesce(toxic, 0) = 0 THEN 1 ELSE 0 END) AS good
  FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY 1
), telling AS (
  SELECT line, min(good) AS good
  FROM (SELECT unnest({_line_sql("string_split(text, chr(10))")}) AS line, good FROM documents JOIN judged USING (doc_id))
  GROUP BY line HAVING min(good) = max(good)
), shown AS (
  SELECT host, url, html, unnest({_line_sql(f"list_transform({_BLOCKS}, lambda x: {_decoded_sql('x')})")}) AS line
  FROM (SELECT DISTINCT host, url, html FROM parts)
), outcomes AS (
  SELECT host, 2 * sum(good) >= count(*) AS good FROM shown JOIN telling USING (line) GROUP BY host, url, html
), hosts AS (
  SELECT host, CAST(coalesce(n, 0) AS DOUBLE) AS n, CAST(coalesce(k, 0) AS DOUBLE) AS k,
         CASE WHEN {_AS_IS} THEN host ELSE regexp_extract({_NAME}, '{host_reputation.DOMAIN_PATTERN}', 1) END AS domain,
         CASE WHEN {_AS_IS} THEN '' ELSE regexp_extract({_NAME}, '{host_reputation.SUFFIX_PATTERN}', 1) END AS suffix
  FROM (SELECT DISTINCT host FROM parts)
  LEFT JOIN (SELECT host, count(*) AS n, count(*) FILTER (good) AS k FROM outcomes GROUP BY host) USING (host)
), whole AS (SELECT (sum(k) + 1) / (sum(n) + 2) AS above FROM hosts),
top AS (SELECT suffix, sum(n) AS n, sum(k) AS k, any_value(above) AS above FROM hosts, whole GROUP BY suffix),
suffixes AS ({_level_sql("top", "suffix")}),
middle AS (
  SELECT h.suffix, h.domain, sum(h.n) AS n, sum(h.k) AS k, any_value(s.mean) AS above
  FROM hosts h JOIN suffixes s USING (suffix) GROUP BY ALL),
domains AS ({_level_sql("middle", "suffix, domain")}),
low AS (SELECT h.host, h.n, h.k, d.mean AS above FROM hosts h JOIN domains d USING (suffix, domain)),
known AS (
  SELECT host, mean - 1.645::DOUBLE * sqrt(mean * (1 - mean) / (n + weight + 1)) AS bound
  FROM ({_level_sql("low", "host")})
), ruled AS (
  SELECT *, CASE WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
                 WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
                 WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
                 WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
                 WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM parts
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN bound >= 0.5 THEN 'allow' ELSE 'block' END AS verdict
FROM ruled LEFT JOIN known USING (host)
"""


def tokenizer(name: str = "word_bpe_49k.json") -> str:
    """Path of a public tokenizer; the operators take it as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, packing.Settings(tokenizer())).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return jaccard_join.components(docs).select("doc_id", "n_shingles", "component_id")


def op3_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality_fm.fit(docs, labels)
    return quality_fm.score(docs, model).select(
        "doc_id", quality_fm.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op4_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    judged, _ = decision_list.judge(docs, labels)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.find(table(spark, sf_dir, "documents"))


def op6_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_tree.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # A cut can fall inside a character, so the remaining text shows what is left of one as U+FFFD.
    return suffix_dedup.remove_repeated(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256",
        F.make_valid_utf8(F.col("kept").cast("string")).alias("text"))


def op8_page_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_templates.main_text(table(spark, sf_dir, "pages"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.taken(docs).select("doc_id", "size", "source_size", "target", "taken")


def op10_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return line_templates.drop_lines(docs).select("doc_id", "n_lines", "n_dropped", "text")


def repeated_ends(docs: DataFrame) -> DataFrame:
    """Documents of which a tenth, picked by a checksum of the id, end in copies of a passage.

    Such a text becomes its words, joined by one space: the first ``a``, then the ``p`` words after
    them again and again up to the old number of words.
    """
    own = without(docs, "_words", "_h")
    h = F.crc32(F.col("doc_id").cast("string"))
    picked = own.withColumn("_h", h).withColumn(
        "_words", F.when(F.col("_h") % 10 == 0, F.regexp_extract_all("text", F.lit(f"({WORD_CLASS}+)"), 1)))
    n, g = F.size("_words").cast("bigint"), F.expr("_h div 10")
    sized = picked.withColumn("_n", n).withColumn("_a", F.when(F.col("_n") > 0, g % F.col("_n")))
    sized = sized.withColumn("_p", F.expr("cast(1 + (_n - _a) div (3 + (_h div 10) % 8) as int)"))
    a, copies = F.col("_a").cast("int"), F.expr("cast((_n - _a) div _p + 1 as int)")
    tail = F.flatten(F.array_repeat(F.slice("_words", a + 1, F.col("_p")), copies))
    rebuilt = F.concat(
        F.slice("_words", F.lit(1), a), F.slice(tail, F.lit(1), (F.col("_n") - F.col("_a")).cast("int")))
    text = F.when(F.col("_n") > 0, F.array_join(rebuilt, " ")).otherwise(F.col("text"))
    return sized.withColumn("text", text).drop("_words", "_h", "_n", "_a", "_p")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = repeated_ends(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic_runs.find(docs).withColumn("_best", periodic_runs.greatest(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise(F.lit(""))
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "_best.start", "_best.length", "_best.period",
        F.expr("1000 * _best.length div _best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


# The rules of the url filter.
URL_RULES = (
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
    ("block", "net/es/"), ("block", "net/fr/"),
)


def op12_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    outcomes = host_reputation.page_outcomes(
        pages, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    rules = [host_reputation.Rule(*r) for r in URL_RULES]
    return host_reputation.judge(pages.select("page_id", "url"), rules, outcomes).drop("url")


def regrown(conversations: DataFrame) -> DataFrame:
    """Sequences of the conversations, each of which starts with the first turns of its group's first.

    Conversation c opens with h turns of conversation c - c mod 5 and goes on with its own turns
    after its first h. A group's turns meet in one shuffle.
    """
    one = prefix_trie.turn(F.col("turn"), F.col("role"), F.col("text"))
    group = conversations.where("conv_id is not null").select(
        (F.col("conv_id") - F.pmod("conv_id", F.lit(5))).alias("_base"), F.struct("conv_id", one.alias("turn")).alias("_one"))
    held = group.groupBy("_base").agg(F.sort_array(F.collect_list("_one")).alias("_all"))
    each = held.select("_base", "_all", F.explode(F.array_distinct(F.transform("_all", lambda t: t["conv_id"]))).alias("conv_id"))

    def of(conv: str):
        return F.transform(F.filter("_all", lambda t: t["conv_id"] == F.col(conv)), lambda t: t["turn"])

    h = (F.crc32(F.col("conv_id").cast("string")) % 9).cast("int")
    parts = each.select("conv_id", h.alias("_h"), of("_base").alias("_first"), of("conv_id").alias("_own"))
    turns = F.concat(
        F.slice("_first", F.lit(1), F.col("_h")), F.slice("_own", F.col("_h") + 1, F.size("_own")))
    return parts.select("conv_id", turns.alias("_turns")).select("conv_id", *prefix_trie.as_sequence(F.col("_turns")))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.nodes(regrown(table(spark, sf_dir, "conversations")))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_packing": op1_packing,
        "op2_jaccard_join": op2_jaccard_join,
        "op3_quality_fm": op3_quality_fm,
        "op4_decision_list": op4_decision_list,
        "op5_personal_data": op5_personal_data,
        "op6_ball_tree": op6_ball_tree,
        "op7_suffix_dedup": op7_suffix_dedup,
        "op8_page_templates": op8_page_templates,
        "op9_mixing": op9_mixing,
        "op10_line_templates": op10_line_templates,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_host_reputation": op12_host_reputation,
        "op13_prefix_trie": op13_prefix_trie,
    }


def statements() -> dict[str, str]:
    """SQL for the queries that SQL can express."""
    return {"op6_ball_tree": TOP_K, "op12_host_reputation": REPUTATION}
