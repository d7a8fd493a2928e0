"""One registered query for each operator, with production parameters over its whole table."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ebbtide.llm import (
    decontaminate,
    language_id,
    line_dedup,
    main_text,
    mixing,
    quality,
    secret_scan,
    simhash,
    spelling,
    substring_dedup,
    token_alignment,
    token_counts,
    token_files,
)

# The same results in DuckDB's SQL, by plain counting.
OP10 = r"""
WITH lines AS (
  SELECT rowid AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM (SELECT *, row_number() OVER () AS rowid FROM documents)
), each AS (
  SELECT r, doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS n FROM lines
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM each
), shared AS (
  SELECT k, min(doc_id) AS holder FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) > 1
), marked AS (
  SELECT keyed.*, shared.k IS NOT NULL AND doc_id <> holder AS gone FROM keyed LEFT JOIN shared USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id
"""

OP8 = r"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), windows AS (
  SELECT r, unnest(range(1, len(ws) - 33)) AS s FROM texts WHERE len(ws) >= 35
), hashed AS (
  SELECT r, s, md5(array_to_string(ws[s:s + 34], ' ')) AS w FROM windows JOIN texts USING (r)
), hits AS (
  SELECT r, s FROM hashed WHERE w IN (SELECT w FROM hashed GROUP BY w HAVING count(*) > 1)
), covered AS (
  SELECT DISTINCT r, unnest(range(s, s + 35)) AS p FROM hits
), marks AS (
  SELECT r, count(*) AS n, list(p) AS ps FROM covered GROUP BY r
), places AS (
  SELECT r, doc_id, len(ws) AS n_words, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM texts
), kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY p) AS kept FROM places ANTI JOIN covered USING (r, p) GROUP BY r
)
SELECT doc_id, len(ws) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM texts LEFT JOIN marks USING (r) LEFT JOIN kept USING (r)
"""

OP5 = r"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), windows AS (
  SELECT r, s, array_to_string(ws[s:s + 7], ' ') AS w FROM (SELECT r, ws, unnest(range(1, len(ws) - 6)) AS s FROM texts WHERE len(ws) >= 8)
), hits AS (
  SELECT r, s FROM windows SEMI JOIN (SELECT r, w FROM windows GROUP BY r, w HAVING count(*) > 1) USING (r, w)
), covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(s, s + 8)) AS p FROM hits) GROUP BY r
), lines AS (
  SELECT r, count(*) - count(DISTINCT line) AS n FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM texts)
  WHERE NOT regexp_full_match(line, '[\x20\x09-\x0D]*') GROUP BY r
), base AS (
  SELECT t.r, doc_id, lang, len(ws) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
         coalesce(l.n, 0) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
         length(regexp_replace(text, '[^a-z]+', '', 'g')) AS lo, length(regexp_replace(text, '[^A-Z]+', '', 'g')) AS up,
         length(regexp_replace(text, '[^0-9]+', '', 'g')) AS di, length(regexp_replace(text, '[^!-/:-@\[-`{-~]+', '', 'g')) AS ma
  FROM texts t LEFT JOIN covered c ON t.r = c.r LEFT JOIN lines l ON t.r = l.r
), sums AS (
  SELECT lang, sum(n_words) AS words, sum(word_chars) AS chars, sum(lo) AS lo, sum(up) AS up, sum(di) AS di, sum(ma) AS ma FROM base GROUP BY lang
), class_pairs AS (
  SELECT r, unnest([b.lo, b.up, b.di, b.ma, b.word_chars - b.lo - b.up - b.di - b.ma]) / word_chars AS p,
         unnest([s.lo, s.up, s.di, s.ma, s.chars - s.lo - s.up - s.di - s.ma]) / s.chars AS q
  FROM base b JOIN sums s USING (lang) WHERE word_chars > 0
), class_distance AS (
  SELECT r, sqrt(greatest(0, sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2)) AS d
  FROM class_pairs GROUP BY r
), words AS (
  SELECT r, lang, unnest(ws) AS word FROM texts
), common AS (
  SELECT lang, word, count(*) / any_value(s.words) AS q FROM words JOIN sums s USING (lang) GROUP BY lang, word HAVING count(*) >= 0.002 * any_value(s.words)
), own AS (
  SELECT r, lang, word, count(*) AS n FROM words GROUP BY r, lang, word
), slots AS (
  SELECT b.r, c.q, coalesce(o.n, 0) / b.n_words AS p FROM base b JOIN common c USING (lang) LEFT JOIN own o ON o.r = b.r AND o.word = c.word WHERE b.n_words > 0
  UNION ALL
  SELECT b.r, 1 - coalesce(k.q, 0), coalesce(u.n, 0) / b.n_words FROM base b LEFT JOIN (SELECT lang, sum(q) AS q FROM common GROUP BY lang) k USING (lang)
  LEFT JOIN (SELECT r, sum(n) AS n FROM own o ANTI JOIN common c USING (lang, word) GROUP BY r) u ON u.r = b.r WHERE b.n_words > 0
), word_distance AS (
  SELECT r, sqrt(greatest(0, sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2)) AS d
  FROM slots GROUP BY r
)
SELECT doc_id, b.n_words, b.word_chars, n_symbols, n_dup_lines, n_repeat_words,
       b.n_words < 20 OR 100 * n_repeat_words > 30 * b.n_words AS base_failed,
       NOT (b.n_words < 20 OR 100 * n_repeat_words > 30 * b.n_words)
       AND (b.n_words < 50 OR s.words < 2000 OR coalesce(c.d, 0) <= 0.3 AND coalesce(w.d, 0) <= 0.5) AS kept
FROM base b JOIN sums s USING (lang) LEFT JOIN class_distance c USING (r) LEFT JOIN word_distance w USING (r)
"""

OP12 = r"""
WITH RECURSIVE steps AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS t FROM range(256) r(i)
), runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY ALL
), bytes AS (
  SELECT run, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS h FROM runs
), sums AS (
  SELECT run, n, xor(list_reduce(list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295) AS crc FROM bytes, steps
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN crc % 199 = 0 THEN substr(run, 1, crc % length(run)) || substr(run, crc % length(run) + 2) ELSE run END AS word, n FROM sums)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), gaps AS (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)
), pairs AS (
  SELECT a.word, b.word AS near FROM gaps a JOIN gaps b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT g.word, w.word FROM gaps g JOIN words w ON g.rest = w.word
  UNION SELECT w.word, g.word FROM gaps g JOIN words w ON g.rest = w.word
), ranked AS (
  SELECT p.word, near, w.n AS near_n, count(*) OVER (PARTITION BY p.word) AS n_near,
    row_number() OVER (PARTITION BY p.word ORDER BY w.n DESC, near) AS k FROM pairs p JOIN words w ON p.near = w.word
), formed AS (
  SELECT w.word, CASE WHEN near_n >= 5 * n THEN near END AS form, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * n THEN near_n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND k = 1
), ways AS (
  SELECT word, word AS root FROM formed
  UNION ALL SELECT ways.word, f.form FROM ways JOIN formed f ON f.word = ways.root WHERE f.form IS NOT NULL
), ends AS (
  SELECT ways.word, root FROM ways JOIN formed f ON f.word = ways.root WHERE f.form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)
"""


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, folder), public_tokenizers.path("word_bpe_49k.json"))


def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, folder), width=4, radius=4)


def op3_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.secrets(documents(spark, folder), owner="source", repository=("source", "lang"))


def op4_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return main_text.extracted(spark.read.parquet(f"{folder}/pages.parquet"))


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    rows = quality.judged(documents(spark, folder), class_limit=0.3, word_limit=0.5, least_words=50)
    return rows.drop("class_distance", "word_distance")


def op6_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    return decontaminate.report(documents(spark, folder), benchmark, size=12, least_cover=0.25, any_case=True, partial=True)


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed(documents(spark, folder), weights=(1, 2, 3), most=3)


def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.without_repeats(documents(spark, folder), width=35).drop("kept")


def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.languages(documents(spark, folder))


def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.digests(line_dedup.dedup_corpus(documents(spark, folder), least=10))


def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    files = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return token_alignment.alignment(documents(spark, folder), *files)


def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(documents(spark, folder), modulus=199, least_length=6, least=5, ratio=5)


def op13_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.token_files(documents(spark, folder), public_tokenizers.path("word_bpe_49k.json"), end=2)


def queries() -> dict:
    return {
        "op1_token_counts": op1_token_counts,
        "op2_simhash": op2_simhash,
        "op3_secrets": op3_secrets,
        "op4_main_text": op4_main_text,
        "op5_quality": op5_quality,
        "op6_decontaminate": op6_decontaminate,
        "op7_mixing": op7_mixing,
        "op8_substring_dedup": op8_substring_dedup,
        "op9_language_id": op9_language_id,
        "op10_line_dedup": op10_line_dedup,
        "op11_alignment": op11_alignment,
        "op12_spelling": op12_spelling,
        "op13_token_files": op13_token_files,
    }


def oracle_sql() -> dict[str, str]:
    return {"op5_quality": OP5, "op8_substring_dedup": OP8, "op10_line_dedup": OP10, "op12_spelling": OP12}
