"""Registered queries of the subpackage and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadcast.llm import chat
from roadcast.llm.alignment import align_tokenizers
from roadcast.llm.common import Steps, table
from roadcast.llm.decontaminate import find_leaks
from roadcast.llm.exact_dedup import exact_dedup
from roadcast.llm.language import predict, train
from roadcast.llm.licenses import COPYRIGHT_LINE, KNOWN, SPELLINGS, scan_licenses
from roadcast.llm.manifest import build_manifest, leaf_digest, proofs
from roadcast.llm.mixing import mix
from roadcast.llm.near_dedup import near_dedup
from roadcast.llm.simhash import simhash_groups
from roadcast.llm.substring_dedup import find_repeats
from roadcast.llm.token_output import read_tokens, write_tokens
from roadcast.llm.url_filter import build_index, judge_urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# --- 2: licences ----------------------------------------------------------------------------------------------------


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _canonical_sql(text: str) -> str:
    lines = f"regexp_replace(lower({text}), {_quote(COPYRIGHT_LINE)}, chr(10), 'g')"
    plain = f"' ' || regexp_replace({lines}, '[^\\p{{L}}\\p{{N}}]+', '  ', 'g') || ' '"
    for spelling, usual in SPELLINGS:
        plain = f"replace({plain}, ' {spelling} ', ' {usual} ')"
    return f"trim(regexp_replace({plain}, ' +', ' ', 'g'))"


def _license_sql() -> str:
    known = ", ".join(f"({_quote(name)}, {_quote(text)})" for name, text in KNOWN)
    return f"""
WITH known AS (SELECT sha256({_canonical_sql('t')}) AS digest, min(n) AS license FROM (VALUES {known}) v(n, t) GROUP BY 1),
docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
lines AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs),
notices AS (SELECT r, count(*) AS n, string_agg(DISTINCT license, ',' ORDER BY license) AS names
  FROM (SELECT r, sha256({_canonical_sql('line')}) AS digest FROM lines WHERE length(trim(line)) > 0) l JOIN known USING (digest) GROUP BY r),
whole AS (SELECT r, doc_id, sha256({_canonical_sql('text')}) AS text_digest FROM docs)
SELECT doc_id, text_digest, k.license, coalesce(n, 0) AS n_notices, coalesce(names, '') AS notices
FROM whole LEFT JOIN known k ON k.digest = text_digest LEFT JOIN notices USING (r)"""


QUERIES["op2_licenses"] = op2_licenses
ORACLES["op2_licenses"] = _license_sql()

# --- 3: mixing ------------------------------------------------------------------------------------------------------

MIX_WEIGHTS, MIX_REPEAT, MIX_SEED = (5, 2, 1), 3, "mix-1"


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mix(table(spark, sf_dir, "documents"), weights=MIX_WEIGHTS, max_repeat=MIX_REPEAT, seed=MIX_SEED)
    return rows.select("doc_id", "size", "source_size", "target", "taken")


# The target is found from the sources in order of cap by weight: those before the first one whose cap is above the level are full.
_MIX_SQL = f"""
WITH sized AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, CAST(CASE (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS DOUBLE) AS w,
  CAST(3 AS DOUBLE) * source_size AS cap FROM sources),
ranked AS (SELECT *, coalesce(sum(cap) OVER before, 0) AS spent, sum(w) OVER onward AS share, sum(source_size) OVER () AS total FROM weighed
  WINDOW before AS (ORDER BY cap / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), onward AS (ORDER BY cap / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
level AS (SELECT max((total - spent) / share) AS level FROM ranked),
targets AS (SELECT source, source_size, least(w * level, cap) AS target FROM weighed, level),
rated AS (SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, size, source_size, target, CAST((floor(rate) + CASE WHEN CAST(('0x' || substr(md5('{MIX_SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12)) AS BIGINT) / CAST(281474976710656 AS DOUBLE)
  < rate - floor(rate) THEN 1 ELSE 0 END) * size AS BIGINT) AS taken FROM rated"""

QUERIES["op3_mixing"] = op3_mixing
ORACLES["op3_mixing"] = _MIX_SQL

# --- 7: urls --------------------------------------------------------------------------------------------------------

URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge_urls(table(spark, sf_dir, "pages"), build_index(rules))


_URL_SQL = f"""
WITH rules AS (SELECT * FROM (VALUES {', '.join(str(r) for r in URL_RULES)}) v(rule_host, rule_path, verdict)),
rest AS (SELECT row_number() OVER () AS r, page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT r, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
fits AS (SELECT r, arg_max(struct_pack(rule := rule_host || rule_path, verdict := verdict), length(rule_host || rule_path)) AS best FROM parts JOIN rules
  ON (host = rule_host OR suffix(host, '.' || rule_host)) AND prefix(path, rule_path) GROUP BY r)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict FROM parts LEFT JOIN fits USING (r)"""

QUERIES["op7_url_filter"] = op7_url_filter
ORACLES["op7_url_filter"] = _URL_SQL

# --- 9: conversations -----------------------------------------------------------------------------------------------

PROBE = "</s>[INST] ok [/INST]"


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = Steps(spark)
    kinds = "conv_id long, turn long, role string, text string"
    probe = spark.createDataFrame([(-1, 0, "user", PROBE), (-1, 1, "assistant", PROBE)], kinds)
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    formatted = steps.write(chat.format_conversations(chat.linear_trees(rows, steps), steps))
    return chat.read_back(formatted).drop("leaf", "rank")


def _escaped_sql(text: str) -> str:
    out = f"replace({text}, '\\', '\\\\')"
    for c in chat.CONTROL:
        out = f"replace({out}, '{c}', '{c[0]}\\{c[1:]}')"
    return out


_CHAT_SQL = f"""
WITH rows AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '{PROBE}'), (-1, 1, 'assistant', '{PROBE}')))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, md5(text))) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, md5(text)) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum({len(chat.OPEN + chat.HEAD_END + chat.CLOSE)} + length({_escaped_sql('role')}) + length({_escaped_sql('text')})) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id"""

QUERIES["op9_chat"] = op9_chat
ORACLES["op9_chat"] = _CHAT_SQL

# --- 10: exact copies -----------------------------------------------------------------------------------------------


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


QUERIES["op10_exact_dedup"] = op10_exact_dedup
ORACLES["op10_exact_dedup"] = """
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
ranked AS (SELECT doc_id, text, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  row_number() OVER (PARTITION BY text ORDER BY doc_id DESC NULLS LAST) AS place FROM docs WINDOW w AS (PARTITION BY text))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(text) AS text_sha256 FROM ranked"""

# --- 6, 8: near copies and repeated passages; tested against brute force ---------------------------------------------


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_repeats(table(spark, sf_dir, "documents"))


QUERIES["op6_near_dedup"] = op6_near_dedup
QUERIES["op8_substring_dedup"] = op8_substring_dedup

# --- 4, 5: benchmark leaks, against brute force; languages, by accuracy on held-out documents -------------------------


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predict(docs, train(docs))


QUERIES["op4_decontaminate"] = op4_decontaminate
QUERIES["op5_language_id"] = op5_language_id

# --- 1: token ids; an exact round trip -------------------------------------------------------------------------------


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Steps(spark).path()
    write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read_tokens(spark, path)


QUERIES["op1_token_output"] = op1_token_output

# --- 11: manifest ----------------------------------------------------------------------------------------------------

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    plain = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    altered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, leaf_digest([*plain[:-1], F.translate("text", UPPER, LOWER)]))
    rows = docs.select(F.col("lang").alias("group"), F.col("doc_id").cast("long").alias("doc_id"), leaf_digest(plain).alias("digest"), altered.alias("altered"))
    return proofs(build_manifest(rows)).drop("path")


def _field_sql(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || {value}, '-')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(_field_sql(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


_CRC_BIT = "xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384::BIGINT ELSE 0 END)"
_CRC_BYTE = f"list_reduce(range(8), lambda x, k: {_CRC_BIT}, xor(c, b))"
_CRC = f"xor(4294967295::BIGINT, list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: ascii(d)::BIGINT), lambda c, b: {_CRC_BYTE}, 4294967295::BIGINT))"


def _climb_sql(name: str, start: str) -> str:
    return f"""{name}(tree, level, pos, n, digest) AS ({start}
  UNION ALL SELECT tree, level + 1, pos // 8, max((n + 7) // 8), sha256(string_agg(digest, '' ORDER BY pos)) FROM {name} WHERE n > 1 GROUP BY tree, level, pos // 8),
{name}_kin AS (SELECT a.tree, a.level, a.pos, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
  FROM {name} a JOIN {name} b ON a.tree = b.tree AND a.level = b.level AND a.pos // 8 = b.pos // 8 WHERE a.n > 1 GROUP BY a.tree, a.level, a.pos)"""


_MANIFEST_SQL = f"""
WITH RECURSIVE docs AS (SELECT row_number() OVER () AS row, doc_id, lang, {_leaf_sql('text')} AS leaf,
  CASE WHEN {_CRC} % 3 = 0 THEN {_leaf_sql(f"translate(text, '{UPPER}', '{LOWER}')")} ELSE {_leaf_sql('text')} END AS told FROM documents),
langs AS (SELECT lang, count(*) AS n, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS tree FROM docs GROUP BY lang),
leaves AS (SELECT row, doc_id, leaf, told, tree, n, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM docs JOIN langs ON docs.lang IS NOT DISTINCT FROM langs.lang),
{_climb_sql('low', "SELECT tree, 0::BIGINT, pos, n, leaf FROM leaves")},
{_climb_sql('top', "SELECT -1::BIGINT, 0::BIGINT, tree, count(*) OVER (), digest FROM low WHERE n = 1")},
up(row, tree, level, pos, proof, told) AS (SELECT row, tree, 0::BIGINT, pos, '', told FROM leaves
  UNION ALL SELECT row, tree, level + 1, pos // 8, proof || l || r, sha256(l || told || r) FROM up JOIN low_kin USING (tree, level, pos)),
over(row, tree, level, pos, proof, told) AS (SELECT row, -1::BIGINT, 0::BIGINT, tree, proof, told FROM (SELECT *, row_number() OVER (PARTITION BY row ORDER BY level DESC) AS k FROM up) WHERE k = 1
  UNION ALL SELECT row, tree, level + 1, pos // 8, proof || l || r, sha256(l || told || r) FROM over JOIN top_kin USING (tree, level, pos)),
whole AS (SELECT row, proof, told FROM (SELECT *, row_number() OVER (PARTITION BY row ORDER BY level DESC) AS k FROM over) WHERE k = 1)
SELECT doc_id, leaf, low.digest AS subroot, top.digest AS root, sha256(proof) AS proof_sha256, whole.told AS folded_root, whole.told = top.digest AS verified
FROM leaves JOIN whole USING (row) JOIN low ON low.tree = leaves.tree AND low.n = 1 JOIN top ON top.n = 1"""

QUERIES["op11_manifest"] = op11_manifest
ORACLES["op11_manifest"] = _MANIFEST_SQL

# --- 12, 13: near copies by SimHash and tokens that end together; against brute force ----------------------------------


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES["op12_simhash"] = op12_simhash
QUERIES["op13_alignment"] = op13_alignment
