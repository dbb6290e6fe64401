"""The registered queries of this subpackage, with production parameters, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmart.llm import (
    decontaminate, fingerprints, fixity, licenses, line_dedup, ngram_join, packing, quality, ranked_search, spelling,
    token_files, trie_bpe, url_rules,
)
from haulmart.sources.binding import scan

# Fixed values of the URL query: host, path, verdict.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file; they are never part of this repository."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.grouped_fingerprints(scan(spark, sf_dir, "documents"))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules.judge_urls(scan(spark, sf_dir, "pages"), rules)


def damaged(pages: DataFrame) -> DataFrame:
    """A replica with damage by fixed rules: some bodies with another first byte, the last page of some files lost."""
    place = F.col("page_id") % fixity.RECORDS_PER_FILE
    lost = place == fixity.RECORDS_PER_FILE - 1
    rotten = F.concat(F.lit("#"), F.substring("html", 2, 2**31 - 1))
    body = F.when(F.col("page_id") % 97 == 13, rotten).otherwise(F.col("html"))
    return pages.where(~F.coalesce(lost, F.lit(False))).select("page_id", "url", body.alias("html"))


def op3_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = scan(spark, sf_dir, "pages").select("page_id", "url", "html")
    return fixity.audit(fixity.placed_records(pages), fixity.placed_records(damaged(pages)))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(scan(spark, sf_dir, "documents"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(scan(spark, sf_dir, "documents"))


def op6_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    templates = spark.createDataFrame(licenses.TEMPLATES, "template string, text string")
    return licenses.scan_licenses(scan(spark, sf_dir, "documents"), templates)


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = scan(spark, sf_dir, "documents")
    return token_files.write_token_files(docs, vocabulary("word_bpe_49k.json"), end_id=2).documents()


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its lines, how many were taken out, and the SHA-256 of the text that stays."""
    docs = scan(spark, sf_dir, "documents").select("doc_id", "text")
    before = docs.withColumn("n_lines", F.size(F.split(F.coalesce("text", F.lit("")), "\n")))
    clean = line_dedup.without_repeats(before)
    # A text without any line left is empty, as is one of a single empty line.
    left = F.when(F.col("text") == "", 0).otherwise(F.size(F.split("text", "\n")))
    return clean.select("doc_id", "n_lines", left.alias("n_left"), F.sha2("text", 256).alias("clean_sha256"))


def op9_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = scan(spark, sf_dir, "documents")
    return trie_bpe.encode_and_decode(docs, vocabulary("word_bpe_49k.json"), digests=True)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = scan(spark, sf_dir, "documents")
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"), end_id=0, capacity=2048, with_ids=False)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(scan(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.rank(scan(spark, sf_dir, "documents"), scan(spark, sf_dir, "benchmark"), top=20)


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_items(scan(spark, sf_dir, "documents"), scan(spark, sf_dir, "benchmark"), window=10)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


QUERIES = {
    "op1_fingerprints": op1_fingerprints,
    "op2_url_filters": op2_url_filters,
    "op3_warc_fixity": op3_warc_fixity,
    "op4_quality_rules": op4_quality_rules,
    "op5_ngram_join": op5_ngram_join,
    "op6_license_scans": op6_license_scans,
    "op7_token_files": op7_token_files,
    "op8_line_dedup": op8_line_dedup,
    "op9_trie_bpe": op9_trie_bpe,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_ranked_search": op12_ranked_search,
    "op13_decontamination": op13_decontamination,
}


def _url_rules_sql() -> str:
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
    return f"""
WITH r(rule_host, rule_path, rule_verdict) AS (VALUES {rules}),
rests AS (
  SELECT page_id, CASE WHEN url IS NULL OR position('://' IN url) = 0 THEN ''
                  ELSE substr(url, position('://' IN url) + 3) END AS rest FROM pages),
hosts AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS host,
         substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1) AS tail FROM rests),
parts AS (
  SELECT page_id, translate(host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(tail, '^[^?#]*') AS path FROM hosts)
SELECT page_id, host, path, rule_host || rule_path AS rule, coalesce(rule_verdict, 'allow') AS verdict
FROM parts LEFT JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC) = 1"""


def _fixity_sql() -> str:
    line = "chr(13) || chr(10)"

    def records(source: str) -> str:
        return f"""
  SELECT 'warc-' || (page_id // 256) AS file, page_id, sha256(record) AS digest,
         coalesce(sum(strlen(record)) OVER (PARTITION BY page_id // 256 ORDER BY page_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place
  FROM (SELECT page_id, 'WARC/1.1' || {line} || 'WARC-Type: resource' || {line} || 'WARC-Target-URI: '
          || coalesce(url, '') || {line} || 'Content-Type: text/html' || {line} || 'Content-Length: '
          || strlen(coalesce(html, '')) || {line} || {line} || coalesce(html, '') || {line} || {line} AS record
        FROM {source})"""

    return f"""
WITH replica AS (
  SELECT page_id, url, CASE WHEN page_id % 97 = 13 THEN '#' || substr(html, 2) ELSE html END AS html
  FROM pages WHERE page_id % 256 <> 255),
ours AS ({records('pages')}),
theirs AS ({records('replica')})
SELECT coalesce(o.file, t.file) AS file, CAST(coalesce(o.place, t.place) AS BIGINT) AS "offset",
       coalesce(o.page_id, t.page_id) AS page_id,
       CASE WHEN t.digest IS NULL THEN 'missing' WHEN o.digest IS NULL THEN 'extra' ELSE 'changed' END AS damage,
       o.digest AS expected_sha256, t.digest AS found_sha256
FROM ours o FULL JOIN theirs t ON o.file = t.file AND o.place = t.place
WHERE o.digest IS DISTINCT FROM t.digest"""


def _licenses_sql() -> str:
    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def shingled(source: str, name: str) -> str:
        return f"""
  SELECT {name}, i, array_to_string(w[i + 1:i + 5], ' ') AS s FROM (
    SELECT {name}, w, unnest(range(0, greatest(len(w) - 4, 1))) AS i FROM (
      SELECT {name}, list_filter(string_split_regex(lower(text), '[^a-z0-9]+'), lambda x: x <> '') AS w FROM {source})
    WHERE len(w) > 0)"""

    rows = ", ".join(f"({quoted(name)}, {quoted(text)})" for name, text in licenses.TEMPLATES)
    return f"""
WITH templates(template, text) AS (VALUES {rows}),
wanted AS (SELECT DISTINCT template, s FROM ({shingled('templates', 'template')})),
sizes AS (SELECT template, count(*) AS n_shingles FROM wanted GROUP BY template),
own AS ({shingled('documents', 'doc_id')}),
found AS (
  SELECT doc_id, template, count(DISTINCT s) AS n_found, min(i) AS first_word
  FROM own JOIN wanted USING (s) GROUP BY doc_id, template)
SELECT doc_id, template, n_shingles, n_found, first_word FROM found JOIN sizes USING (template)
WHERE 100 * n_found >= {licenses.CONTAINED_PERCENT} * n_shingles"""


def _quality_sql() -> str:
    words = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
    ratios = {
        "word_length": "1000 * word_chars // nullif(n_words, 0)",
        "symbols": "1000 * n_symbols // nullif(n_words, 0)",
        "repeated_lines": "1000 * n_dup_lines // nullif(n_lines, 0)",
        "repeated_words": "1000 * n_repeat_words // nullif(n_words, 0)",
    }
    long_form = " UNION ALL ".join(
        f"SELECT lang, source, '{name}' AS ratio, CAST(coalesce({sql}, 0) AS BIGINT) AS v FROM counted WHERE NOT base_failed"
        for name, sql in ratios.items()
    )

    def quartiles(keys: str) -> str:
        by = f"{keys}, ratio" if keys else "ratio"
        return f"""
  SELECT {by}, max(total) AS total, min(CASE WHEN 4 * upto >= total THEN cell END) AS low,
         min(CASE WHEN 4 * upto >= 3 * total THEN cell END) AS high FROM (
    SELECT {by}, cell, sum(n) OVER (PARTITION BY {by} ORDER BY cell) AS upto, sum(n) OVER (PARTITION BY {by}) AS total
    FROM (SELECT {by}, cell, sum(n) AS n FROM cells GROUP BY {by}, cell)) GROUP BY {by}"""

    slack = " ".join(f"WHEN '{name}' THEN {n}" for name, n in quality.SLACK.items())
    least = quality.LEAST_DOCUMENTS
    side = (
        f"CASE WHEN o.total >= {least} THEN o.{{0}} WHEN l.total >= {least} THEN l.{{0}} ELSE a.{{0}} END AS {{0}}"
    )
    fits = " AND ".join(
        f"coalesce(coalesce({sql}, 0) <= most_{name}, FALSE)" for name, sql in ratios.items()
    )
    return f"""
WITH tokens AS (
  SELECT doc_id, lang, source, {words} AS w, coalesce(text, '') AS text FROM documents),
windows AS (
  SELECT doc_id, i, w[i:i + 2] AS g FROM (
    SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM tokens WHERE len(w) >= 3)),
again AS (
  SELECT doc_id, unnest([i, i + 1, i + 2]) AS place FROM windows
  QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
repeated AS (SELECT doc_id, count(DISTINCT place) AS n_repeat_words FROM again GROUP BY doc_id),
lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM tokens)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
counted AS (
  SELECT doc_id, lang, source, len(w) AS n_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words,
         len(w) < {quality.LEAST_WORDS}
           OR 100 * coalesce(n_repeat_words, 0) > {quality.MOST_REPEATED_PERCENT} * len(w) AS base_failed
  FROM tokens LEFT JOIN repeated USING (doc_id) LEFT JOIN lines USING (doc_id)),
cells AS (
  SELECT lang, source, ratio, (v >> greatest(length(bin(v)) - 8, 0)) << greatest(length(bin(v)) - 8, 0) AS cell,
         count(*) AS n FROM ({long_form}) GROUP BY ALL),
o AS ({quartiles('lang, source')}),
l AS ({quartiles('lang')}),
a AS ({quartiles('')}),
chosen AS (
  SELECT o.lang, o.source, o.ratio, {side.format('low')}, {side.format('high')}
  FROM o JOIN l ON o.lang IS NOT DISTINCT FROM l.lang AND o.ratio = l.ratio JOIN a ON o.ratio = a.ratio),
reached AS (
  SELECT *, greatest({quality.REACH} * (high - low), CASE ratio {slack} END) AS reach FROM chosen),
limits AS (
  SELECT lang, source, min(CASE WHEN ratio = 'word_length' THEN low - reach END) AS least_word_length,
         {', '.join(f"min(CASE WHEN ratio = '{n}' THEN high + reach END) AS most_{n}" for n in ratios)}
  FROM reached GROUP BY lang, source)
SELECT doc_id, c.lang, c.source, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce({ratios['word_length']} >= least_word_length, FALSE) AND {fits} AS kept
FROM counted c LEFT JOIN limits t
  ON c.lang IS NOT DISTINCT FROM t.lang AND c.source IS NOT DISTINCT FROM t.source"""


def _lower_sql(column: str) -> str:
    return f"translate(coalesce({column}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _ranked_sql() -> str:
    words = f"regexp_extract_all({_lower_sql('text')}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
    return f"""
WITH d AS (SELECT doc_id, {words} AS w FROM documents),
lengths AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n FROM d WHERE len(w) > 0),
totals AS (SELECT CAST(count(*) AS BIGINT) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM lengths),
asked AS (SELECT item_id, unnest({words}) AS term FROM benchmark),
wanted AS (SELECT item_id, term, count(*) AS times FROM asked GROUP BY item_id, term),
tf AS (
  SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM d)
  WHERE term IN (SELECT term FROM wanted) GROUP BY doc_id, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
  FROM tf, totals GROUP BY term, big_n),
impacts AS (
  SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * big_n) // big_l))) AS s
  FROM tf JOIN lengths USING (doc_id) JOIN weights USING (term), totals),
scores AS (
  SELECT item_id, doc_id, CAST(sum(times * s) AS BIGINT) AS score FROM wanted JOIN impacts USING (term) GROUP BY item_id, doc_id),
ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM scores WHERE score > 0)
SELECT * FROM ranked WHERE rank <= {ranked_search.TOP}"""


def _decontamination_sql() -> str:
    def words(name: str, source: str) -> str:
        return f"""
  SELECT {name}, regexp_extract_all({_lower_sql('text')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM {source}"""

    size = decontaminate.WINDOW
    return f"""
WITH d AS ({words('doc_id', 'documents')}), i AS ({words('item_id', 'benchmark')}),
asked AS (
  SELECT item_id, k, array_to_string(w[p:p + k - 1], ' ') AS words FROM (
    SELECT item_id, w, least(len(w), {size}) AS k, unnest(range(1, greatest(len(w) - {size} + 1, 1) + 1)) AS p
    FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM asked),
own AS (
  SELECT doc_id, k, p, array_to_string(w[p:p + k - 1], ' ') AS words FROM (
    SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, sizes WHERE len(w) >= k)),
met AS (SELECT doc_id, item_id, p, own.k FROM own JOIN asked ON own.k = asked.k AND own.words = asked.words),
hit AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS place FROM met) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (
    SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM met) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)"""


# The others can't be said in SQL, or not at the size of whole tables; tests/llm has brute force for them.
ORACLE: dict[str, str] = {
    "op2_url_filters": _url_rules_sql(),
    "op3_warc_fixity": _fixity_sql(),
    "op4_quality_rules": _quality_sql(),
    "op6_license_scans": _licenses_sql(),
    "op12_ranked_search": _ranked_sql(),
    "op13_decontamination": _decontamination_sql(),
}
