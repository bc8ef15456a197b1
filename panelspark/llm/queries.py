"""One query per operator of the subpackage, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.llm import bpe, collocations, decontaminate, lexical_search, line_dedup, packing, pii, quality_nbsvm, quality_rules, simhash, substring_dedup, toxicity, warc
from panelspark.llm.common import crc_mod, table


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = warc.write(table(spark, sf_dir, "pages"))
    return warc.read(archive).select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest",
                                     "record_type", "refers_to")


def _scored(scores: DataFrame, mod: int, held: int) -> DataFrame:
    return scores.select("doc_id", (crc_mod(F.col("doc_id"), mod) == held).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), "toxic", 5, 0)
    return _scored(toxicity.score(docs, model), 5, 0)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pii.personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])

    def number(i):
        return F.size(F.filter("base", lambda x: x["k"] == i)).cast("bigint")

    counts = [number(i).alias(f"n_{k}") for i, k in enumerate(pii.BASE)]
    return rows.select("doc_id", *counts, F.sha2(pii.joined("base"), 256).alias("base_sha256"),
                       pii.joined("spans").alias("spans"))


def op4_quality_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_nbsvm.train(docs, table(spark, sf_dir, "labels"), "quality", 3, 1)
    return _scored(quality_nbsvm.score(docs, model), 3, 1)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.simhash_components(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"),
                      F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.drop_lines(table(spark, sf_dir, "documents"), counts=True)
    return out.select("doc_id", "source", "text", "n_lines", "n_dropped")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.quality_rules(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.drop_repeats(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_toxicity": op2_toxicity,
    "op3_pii": op3_pii,
    "op4_quality_nbsvm": op4_quality_nbsvm,
    "op5_packing": op5_packing,
    "op6_simhash": op6_simhash,
    "op7_decontamination": op7_decontamination,
    "op8_bpe": op8_bpe,
    "op9_line_dedup": op9_line_dedup,
    "op10_quality_rules": op10_quality_rules,
    "op11_lexical_search": op11_lexical_search,
    "op12_collocations": op12_collocations,
    "op13_substring_dedup": op13_substring_dedup,
}

_OP1_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages),
g AS (SELECT html, max(page_id) AS winner FROM p GROUP BY html),
s AS (
  SELECT p.page_id, octet_length(encode(p.html)) AS payload_bytes, sha1(p.html) AS h, winner,
         p.page_id IS NOT DISTINCT FROM winner AS first
  FROM p JOIN g USING (html))
SELECT page_id, payload_bytes,
       list_reduce(list_transform(range(32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                1 + ((CAST('0x' || substr(h, 5 * (i // 4) + 1, 5) AS INTEGER) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31), 1)),
         lambda a, b: a || b) AS payload_digest,
       CASE WHEN first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first THEN NULL ELSE winner END AS refers_to
FROM s"""

_BLANK = r"chr(32) || chr(9) || chr(13) || chr(11) || chr(12)"

_OP9_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, text,
                  coalesce(string_split(text, chr(10)), []) AS lines FROM documents),
l AS (SELECT r, source, unnest(list_distinct(list_filter(list_transform(lines, lambda x: trim(x, {_BLANK})), lambda x: x <> ''))) AS line
      FROM d),
n AS (SELECT source, line, count(*) AS n FROM l GROUP BY ALL HAVING count(*) >= {line_dedup.MIN_PAGES}),
t AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
b AS (SELECT n.source, list(line) AS bad
      FROM n JOIN t ON n.source IS NOT DISTINCT FROM t.source
      WHERE n.n > {line_dedup.MAX_RATIO} * t.pages GROUP BY n.source),
c AS (SELECT d.*, list_filter(lines, lambda x: trim(x, {_BLANK}) = '' OR NOT list_contains(coalesce(bad, []), trim(x, {_BLANK}))) AS kept
      FROM d LEFT JOIN b ON d.source IS NOT DISTINCT FROM b.source),
k AS (SELECT *, len(list_filter(kept, lambda x: trim(x, {_BLANK}) <> '')) > 0 AS ok FROM c)
SELECT doc_id, source, CASE WHEN ok THEN array_to_string(kept, chr(10)) ELSE text END AS text,
       CAST(len(lines) AS BIGINT) AS n_lines,
       CAST(CASE WHEN ok THEN len(lines) - len(kept) ELSE 0 END AS BIGINT) AS n_dropped
FROM k"""


def _op10_sql() -> str:
    q = quality_rules
    word = r"'[^\x20\x09-\x0D]+'"
    n_of = lambda x, chars: f"(length({x}) - length(translate({x}, '{chars}', '')))"
    n = f"len(regexp_extract_all(x, {word}))"
    notice = " OR ".join(f"contains(lower(x), '{p}')" for p in q.NOTICES)
    end = r"""'[.!?:;,"''…”»)]$'"""  # RE2: the end of the text
    fails = (f"{n_of('x', q.SYMBOLS)} > {q.SYMBOL_RATIO} * {n} OR {n_of('x', '!?')} > {q.SHOUT_RATIO} * {n} "
             f"OR {n_of('x', q.SEPARATORS)} > {q.SEPARATOR_RATIO} * {n} "
             f"OR ({n} <= {q.MENU_WORDS} AND NOT regexp_matches(rtrim(x, {_BLANK}), {end})) OR {notice}")
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, {word}) AS ws,
             list_filter(string_split(text, chr(10)), lambda x: {n} > 0) AS ls,
             list_filter(string_split(text, chr(10)), lambda x: {n} = 0 OR NOT ({fails})) AS good FROM d),
g AS (SELECT r, unnest(range(1, len(ws) - 1)) AS i, ws FROM w WHERE len(ws) >= 3),
h AS (SELECT r, i, [ws[i], ws[i + 1], ws[i + 2]] AS g FROM g),
f AS (SELECT r, i FROM h QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
p AS (SELECT r, i, i - coalesce(lag(i) OVER (PARTITION BY r ORDER BY i), -9) AS gap FROM f),
c AS (SELECT r, sum(least(3, gap)) AS n FROM p GROUP BY r),
o AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
             CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
             CAST({n_of('text', q.SYMBOLS)} AS BIGINT) AS n_symbols,
             CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
             CAST(length(array_to_string(list_transform(good, lambda x: array_to_string(regexp_extract_all(x, {word}), '')), '')) AS BIGINT) AS left_chars
      FROM w LEFT JOIN c USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.MAX_REPEAT_PCT} * n_words AS base_failed,
       NOT (n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.MAX_REPEAT_PCT} * n_words)
         AND left_chars >= {1 - q.MAX_LOSS} * word_chars AS kept
FROM o"""


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TERMS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

_OP11_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS ts FROM documents),
s AS (SELECT count(*) AS nd, CAST(sum(len(ts)) AS BIGINT) AS total FROM d WHERE len(ts) > 0),
q AS (SELECT row_number() OVER () AS i, item_id, list_distinct({_TERMS}) AS ts FROM benchmark),
qt AS (SELECT i, item_id, unnest(ts) AS t FROM q),
o AS (SELECT r, unnest(ts) AS t FROM d),
dt AS (SELECT r, t, count(*) AS tf FROM o GROUP BY ALL),
w AS (SELECT t, CAST(floor(1000 * ln((2 * any_value(nd) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM dt, s GROUP BY t),
m AS (SELECT r, doc_id, 100 - 50 + (50 * len(ts) * nd) // total AS m FROM d, s WHERE len(ts) > 0),
sc AS (SELECT i, item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
       FROM qt JOIN w USING (t) JOIN dt USING (t) JOIN m USING (r) GROUP BY ALL HAVING score > 0)
SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM sc QUALIFY rank <= {lexical_search.TOP}"""

_OP12_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, 'und') AS lang,
                  translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS t FROM documents),
p AS (SELECT lang, r, unnest(regexp_extract_all(t, '[^.,;:!?\\x0A-\\x0D]+')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM p),
n AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, 1 AS k, unnest(ws) AS g FROM w
      UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) FROM w
      UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(ws) - 1),
                                                      lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) FROM w),
f AS (SELECT lang, k, g, count(*) AS c FROM g GROUP BY ALL HAVING c >= {collocations.MIN_COUNT}),
c AS (SELECT *, string_split(g, ' ') AS ws, unnest(range(1, k)) AS cut FROM f WHERE k > 1),
s AS (SELECT c.lang, c.k, c.g, c.ws, c.c AS a, cut, x.c AS l, y.c AS r,
             CAST((1000000 * CAST(c.c AS HUGEINT) * c.c) // (CAST(x.c AS HUGEINT) * y.c) AS BIGINT) AS score
      FROM c JOIN f AS x ON x.lang = c.lang AND x.g = array_to_string(ws[1:cut], ' ')
             JOIN f AS y ON y.lang = c.lang AND y.g = array_to_string(ws[cut + 1:], ' ')
      QUALIFY row_number() OVER (PARTITION BY c.lang, c.g ORDER BY score, cut) = 1),
longer AS (SELECT lang, h, max(a) AS most FROM (
      SELECT lang, a, ws[1] || ' ' || ws[2] AS h FROM s WHERE k = 3
      UNION ALL SELECT lang, a, ws[2] || ' ' || ws[3] FROM s WHERE k = 3) GROUP BY ALL),
kept AS (SELECT s.* FROM s LEFT JOIN longer ON k = 2 AND longer.lang = s.lang AND h = g
         WHERE most IS NULL OR 100 * most < {collocations.SHARE} * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank, g AS phrase, a, l, r, n, score
FROM kept JOIN n USING (lang) QUALIFY rank <= {collocations.TOP}"""

_OP13_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT r, ws, unnest(range(1, len(ws) - {substring_dedup.WINDOW} + 2)) AS i FROM d
      WHERE len(ws) >= {substring_dedup.WINDOW}),
h AS (SELECT r, i, array_to_string(ws[i:i + {substring_dedup.WINDOW} - 1], ' ') AS w FROM g),
f AS (SELECT r, i FROM h QUALIFY count(*) OVER (PARTITION BY w) > 1),
p AS (SELECT DISTINCT r, unnest(range(i, i + {substring_dedup.WINDOW})) AS k FROM f),
c AS (SELECT r, list(k) AS ks FROM p GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(ks), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(list_filter(ws, lambda w, i: NOT list_contains(coalesce(ks, []), i)), ' ')) AS kept_sha256
FROM d LEFT JOIN c USING (r)"""


ORACLE_SQL: dict[str, str] = {
    "op1_warc": _OP1_SQL,
    "op9_line_dedup": _OP9_SQL,
    "op10_quality_rules": _op10_sql(),
    "op11_lexical_search": _OP11_SQL,
    "op12_collocations": _OP12_SQL,
    "op13_substring_dedup": _OP13_SQL,
}
