"""The registered queries of the operators, and their SQL where it can say the same.

Each query is thin: it runs its operator over its whole table and derives the
columns that its contract names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortlake.llm import chat_format, collocations, decontaminate, exact_dedup, lm_score, mixing, near_dup, quality_classifier, quality_rules, secret_scan, substring_dedup, turn_repair, warc
from cohortlake.llm.common import table
from cohortlake.session import scratch_path


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(table(spark, sf_dir, "documents"))


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.range(2).select(F.lit(-7).cast("long"), F.col("id"), F.when(F.col("id") == 0, "user").otherwise("assistant"), F.lit("</s>[INST] ok [/INST]"))
    return chat_format.read_back(chat_format.format_conversations(turns.union(more)))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"), window=10)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "llm-archives")
    warc.write_archives(table(spark, sf_dir, "pages"), path, min_bytes=1000)
    made = warc.transactions(warc.read_archives(spark, path))
    page = lambda fields: F.nullif(fields["page-id"], F.lit("")).cast("long")
    revisit = F.col("type") == "revisit"
    return made.select(
        page(F.col("metadata.fields")).alias("page_id"),
        F.when(revisit, F.col("original.payload_bytes")).otherwise(F.col("payload.payload_bytes")).alias("payload_bytes"),
        F.when(revisit, F.col("original.payload_sha1")).otherwise(F.col("payload.payload_sha1")).alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.when(revisit, page(F.col("original.fields"))).alias("refers_to"),
    )


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.Mixture(table(spark, sf_dir, "documents"), weights=(3, 1, 2), share_percent=150, cap=2).taken()


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.lm_scores(table(spark, sf_dir, "documents"), columns=["doc_id"])


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = quality_classifier.train(docs, table(spark, sf_dir, "labels"))
    made = quality_classifier.scored(docs, weights)
    return made.select("doc_id", quality_classifier.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    number = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda x: x["kind"].isin(*secret_scan.KINDS[:3]))
    return found.select(
        "doc_id", number("assign"), number("access"), number("hex"), F.sha2(secret_scan.span_list(base), 256).alias("base_sha256"), secret_scan.span_list(F.col("spans")).alias("spans")
    )


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    made = turn_repair.repair_conversations(turn_repair.damaged(turns))
    rows = made.report.unionByName(turn_repair.digests(made.turns), allowMissingColumns=True).unionByName(turns.select("conv_id").distinct(), allowMissingColumns=True)
    numbers = [F.coalesce(F.max(c), F.lit(0)).alias(c) for c in ("gaps", *turn_repair.COUNTS, "cost")]
    return rows.groupBy("conv_id").agg(
        *numbers, F.coalesce(F.max("audit"), F.lit("")).alias("audit"), F.coalesce(F.max("sha256"), F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("sha256").alias("text_sha256"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_substring_dedup, op2_chat_formatting, op3_benchmark_decontamination, op4_warc, op5_minhash_near_dedup,
        op6_mixing, op7_lm_scoring, op8_quality_classifier, op9_quality_rules, op10_secret_scans,
        op11_collocations, op12_structure_repair, op13_exact_dedup,
    )
}

AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
BLANK_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _escaped(column: str) -> str:
    out = f"coalesce({column}, '')"
    for pattern in chat_format.CONTROLS:
        out = f"regexp_replace({out}, '{pattern}', '\\1\\2\\\\\\3', 'g')"
    return out


ORACLES = {
    "op2_chat_formatting": f"""
WITH turns AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(coalesce(role, '') || chr(10) || coalesce(text, '') || chr(10), '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(coalesce(text, '')) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN coalesce(text, '') ELSE '' END, '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST)) AS loss_sha256,
  CAST(sum({len(chat_format.TURN + chat_format.TEXT + chat_format.END)} + length({_escaped('role')}) + length({_escaped('text')})) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id""",
    "op3_benchmark_decontamination": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), {AZ}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {AZ}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(len(w), 10) AS l, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
ls AS (SELECT DISTINCT l FROM iw),
dw AS (SELECT r, l, i, array_to_string(w[i:i + l - 1], ' ') AS win FROM (SELECT r, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM d, ls WHERE len(w) >= l)),
h AS (SELECT r, i, dw.l, item_id FROM dw JOIN iw ON dw.l = iw.l AND dw.win = iw.win),
n AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + l)) AS p FROM h) GROUP BY r),
t AS (SELECT r, count(*) AS n, string_agg(k, ',' ORDER BY k) AS ids FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS k FROM h WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n.n, 0) AS n_hit, coalesce(t.n, 0) AS n_items, sha256(coalesce(t.ids, '')) AS items_sha256, coalesce(n.n, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN t USING (r)""",
    "op4_warc": """
SELECT page_id, bytes AS payload_bytes, digest AS payload_digest,
  CASE WHEN bytes >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN bytes >= 1000 AND page_id < last THEN last END AS refers_to
FROM (SELECT page_id, CAST(strlen(h) AS BIGINT) AS bytes, sha1(h) AS digest, max(page_id) OVER (PARTITION BY h) AS last
  FROM (SELECT page_id, coalesce(html, '') AS h FROM pages))""",
    "op5_minhash_near_dedup": f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {AZ}), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 85 * (na.n + nb.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach(a, b) AS (SELECT DISTINCT a, a FROM e UNION SELECT reach.a, e.b FROM reach JOIN e ON e.a = reach.b),
c AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.m, w.doc_id) AS component_id, coalesce(c.m, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.a = w.doc_id""",
    "op9_quality_rules": f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {BLANK_WORDS} AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM documents),
g AS (SELECT r, i, array_to_string(w[i:i + 7], ' ') AS win FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM t WHERE len(w) >= 8)),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS c FROM g) WHERE c > 1) GROUP BY r),
m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(length(text) - length(regexp_replace(text, '[!?]', '', 'g')) AS BIGINT) AS n_marks,
    CAST(len(list_filter(w, lambda x: lower(x) IN ({', '.join(repr(x) for x in quality_rules.STOP_WORDS)}))) AS BIGINT) AS n_stop_words,
    CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words
  FROM t LEFT JOIN rep USING (r)),
f AS (SELECT *, n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {' AND '.join(f'100 * {a} >= {low} * {b}' for _, a, b, low, _ in quality_rules.RULES if low is not None)}
  AND {' AND '.join(f'100 * {a} <= {high} * {b}' for _, a, b, _, high in quality_rules.RULES if high is not None)} AS kept
FROM f""",
    "op11_collocations": f"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), {AZ}), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
f AS MATERIALIZED (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS s, count(*) AS f
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, range(1, 6) AS r(k) WHERE len(w) >= k) GROUP BY ALL),
t AS (SELECT lang, sum(f)::HUGEINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, s, string_split(s, ' ') AS w, f AS a FROM f WHERE k >= 2 AND f >= 100),
inner_ AS (SELECT lang, array_to_string(w[i:j], ' ') AS s, max(a) AS most FROM (SELECT *, unnest(range(i + 1, k + 1)) AS j FROM (SELECT *, unnest(range(1, k)) AS i FROM c)) WHERE j - i + 1 < k GROUP BY ALL),
cut AS (SELECT c.lang, c.s, c.a, m AS m, x.f AS l, y.f AS r, n, (1000::HUGEINT * c.a * n) // (x.f::HUGEINT * y.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS m FROM c) c JOIN f x ON x.lang = c.lang AND x.s = array_to_string(c.w[1:m], ' ') JOIN f y ON y.lang = c.lang AND y.s = array_to_string(c.w[m + 1:], ' ') JOIN t ON t.lang = c.lang),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, s ORDER BY score, m) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, s) AS rank, s AS phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM best b LEFT JOIN inner_ i USING (lang, s) WHERE most IS NULL OR 100 * most < 100 * a QUALIFY rank <= 2000""",
    "op12_structure_repair": f"""
WITH RECURSIVE original AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: unicode(x)::BIGINT),
      lambda c, b: list_reduce([xor(c, b)] || range(8), lambda x, k: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 20 AS kind
  FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) FROM original)),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again, left(role, 1) AS x
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged)),
faults AS (
  SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS ended,
    lag(x) OVER (PARTITION BY conv_id ORDER BY i) || x AS pair FROM ordered),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (NOT blank AND again) AS duplicate,
    count(*) FILTER (NOT blank AND NOT again AND NOT ended) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
  FROM faults GROUP BY conv_id),
-- after: what the output ends with (nothing, s, u, a); ins: turns inserted to come there from a state.
ins(p, q, audit, made) AS (VALUES ('', '', '', ''), ('s', 's', '', ''), ('u', 'u', '', ''), ('a', 'a', '', ''),
  ('', 'u', 'I', 'u'), ('', 'a', 'II', 'ua'), ('s', 'u', 'I', 'u'), ('s', 'a', 'II', 'ua'), ('a', 'u', 'I', 'u'), ('u', 'a', 'I', 'a')),
out(p, q) AS (VALUES ('', 's'), ('', 'u'), ('s', 'u'), ('u', 'a'), ('a', 'u')),
parse(conv_id, i, p, cost, audit, repaired) AS (
  SELECT conv_id, 0::BIGINT, '', 0::BIGINT, '', []::VARCHAR[] FROM counts
  UNION ALL
  SELECT conv_id, i, p, best.cost, best.audit, best.repaired FROM (
    SELECT conv_id, i, p, min({{'cost': cost, 'audit': audit, 'repaired': repaired}}) AS best FROM (
      SELECT t.conv_id, f.i, t.p, t.cost + 3 AS cost, t.audit || 'D' AS audit, t.repaired FROM parse t JOIN faults f ON f.conv_id IS NOT DISTINCT FROM t.conv_id AND f.i = t.i + 1
      UNION ALL
      SELECT t.conv_id, f.i, out.q, t.cost + 2 * length(ins.audit) + CASE WHEN op = 'R' THEN 2 ELSE 0 END + CASE WHEN f.ended THEN 0 ELSE 1 END, t.audit || ins.audit || op,
        t.repaired || CASE ins.made WHEN '' THEN [] WHEN 'u' THEN ['user:'] WHEN 'a' THEN ['assistant:'] ELSE ['user:', 'assistant:'] END
          || [CASE WHEN op = 'K' THEN f.role WHEN out.q = 'u' THEN 'user' ELSE 'assistant' END || ':' || f.text]
      FROM parse t JOIN faults f ON f.conv_id IS NOT DISTINCT FROM t.conv_id AND f.i = t.i + 1 JOIN ins ON ins.p = t.p JOIN out ON out.p = ins.q, (VALUES ('K'), ('R')) AS ops(op)
      WHERE NOT f.blank AND NOT f.again AND CASE WHEN op = 'K' THEN f.x = out.q ELSE out.q <> 's' END)
    GROUP BY conv_id, i, p)),
ends AS (
  SELECT t.conv_id, min({{'cost': t.cost + 2 * length(ins.audit), 'audit': t.audit || ins.audit,
    'repaired': t.repaired || CASE ins.made WHEN '' THEN [] WHEN 'a' THEN ['assistant:'] ELSE ['user:', 'assistant:'] END}}) AS best
  FROM parse t JOIN counts c ON c.conv_id IS NOT DISTINCT FROM t.conv_id AND c.n = t.i JOIN ins ON ins.p = t.p WHERE ins.q IN ('', 'a') GROUP BY t.conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(best.cost, 0) AS cost, coalesce(best.audit, '') AS audit, sha256(coalesce(array_to_string(best.repaired, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM o.conv_id""",
    "op13_exact_dedup": """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents) WINDOW w AS (PARTITION BY t)""",
}
