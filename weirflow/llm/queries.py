"""The numbered queries over the given tables, with SQL where SQL can express them."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.llm import contamination, divergence, language, line_dedup, packing, passage_dedup, periodic, quality, sharding, simhash, suffix_dedup, token_files, url_rules
from weirflow.llm.common import stored, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


def _query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each document, those taken out, and a digest of the text that is left."""
    found = line_dedup.without_repeated_lines(table(spark, sf_dir, "documents"))
    return found.select("doc.doc_id", "n_lines", "n_removed", F.sha2("doc.text", 256).alias("kept_sha256"))


SQL["op1_line_dedup"] = r"""
WITH line AS (
  SELECT doc_id, pos, raw, trim(raw) AS norm
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS pos
        FROM documents)
), firsts AS (
  SELECT norm, min(doc_id * 1000000 + pos) AS place, length(norm) AS n FROM line WHERE norm <> '' GROUP BY norm
), variant AS (
  SELECT norm, place, k, n - 1 AS size, hash(norm[1:k - 1] || norm[k + 1:]) AS v
  FROM (SELECT *, unnest(range(1, n + 1)) AS k FROM firsts WHERE n >= 17)
), pairs AS (
  SELECT a.norm AS a, b.norm AS b, a.place AS pa, b.place AS pb FROM variant a JOIN variant b ON a.v = b.v AND a.k = b.k AND a.size = b.size AND a.place > b.place
  UNION ALL
  SELECT f.norm, v.norm, f.place, v.place FROM firsts f JOIN variant v ON hash(f.norm) = v.v AND f.n = v.size WHERE f.n >= 17
), linked AS (
  SELECT * FROM pairs WHERE levenshtein(a, b) <= 1
), near AS (
  SELECT a AS norm FROM linked WHERE pb < pa UNION SELECT b FROM linked WHERE pa < pb
), kept AS (
  SELECT doc_id, pos, raw, norm = '' OR (norm NOT IN (SELECT norm FROM near) AND place = doc_id * 1000000 + pos) AS stays
  FROM line LEFT JOIN firsts USING (norm)
), texts AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_removed,
         coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (stays), '') AS kept
  FROM kept GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
       CASE WHEN d.text IS NOT NULL THEN sha256(coalesce(kept, '')) END AS kept_sha256
FROM documents d LEFT JOIN texts USING (doc_id)
"""


@_query
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows found in each document."""
    found = contamination.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        contamination.is_contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


SQL["op2_decontaminate"] = rf"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, {_WORDS}) AS w FROM documents
), item AS (
  SELECT item_id, regexp_extract_all({_LOWER}, {_WORDS}) AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, len(g) AS size, array_to_string(g, ' ') AS gram FROM (
    SELECT item_id, unnest(list_transform(range(1, greatest(1, len(w) - 12) + 1), lambda k: w[k:k + 12])) AS g
    FROM item WHERE len(w) > 0)
), grams AS (
  SELECT r, pos, size, array_to_string(w[pos:pos + size - 1], ' ') AS gram
  FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS pos
        FROM doc, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)
), hits AS (
  SELECT r, pos, g.size AS size, item_id FROM grams g JOIN windows USING (gram)
), covered AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(pos, pos + size)) AS p FROM hits) GROUP BY r
), named AS (
  SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS i FROM hits WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, coalesce(len(w), 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= coalesce(len(w), 0) AS contaminated
FROM doc LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""


@_query
def op3_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of each document that occur in others too, and those that go."""
    found = passage_dedup.remove_passages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_paragraphs", "n_repeated_words", "n_removed_words", F.size("removed").alias("n_removed"), "first_doc_ids")


def tokenizer_path() -> str:
    """Where the public tokenizer files have the byte-level vocabulary of 50,257 ids."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@_query
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of each document in packed sequences."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


@_query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and adaptive thresholds for each document."""
    return quality.judge(table(spark, sf_dir, "documents"))


def _mixed_sql(keys: str, prior: str) -> str:
    """Sketches merged over all but ``keys``, mixed with the shares of what is above."""
    same = " AND ".join(["g.rate = p.rate"] + ["g.lang IS NOT DISTINCT FROM p.lang"] * ("source" in keys))
    named = ", ".join(f"g.{k}" for k in keys.split(", "))
    return f"""SELECT *, sum(weight) OVER (PARTITION BY {keys}, rate) AS total FROM (
      SELECT {keys}, rate, bucket, sum(weight) AS weight FROM (
        SELECT {keys}, rate, bucket, {quality.UNIT} * n AS weight FROM sketch
        UNION ALL
        SELECT {named}, g.rate, p.bucket, {quality.PRIOR_ROWS} * p.share
        FROM (SELECT DISTINCT {keys}, rate FROM sketch) g JOIN {prior} p ON {same})
      GROUP BY ALL)"""


_SHARE_SQL = f"weight // (total // {quality.UNIT}) AS share"
_RATE_SQL = "symbols, dup_lines, repeats, word_length"


def _end_sql(bucket: str) -> str:
    return f"({bucket} + (1::BIGINT << greatest(length(bin({bucket})) - 6, 0)) - 1)"


SQL["op5_quality"] = rf"""
WITH doc AS (
  SELECT doc_id, lang, source, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t-\r]+'), lambda w: w <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \t-\r]')) AS lines,
         length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]+', '', 'g')) AS n_symbols
  FROM documents
), win AS (
  SELECT doc_id, pos, w[pos:pos + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS pos FROM doc WHERE len(w) > 2)
), twice AS (
  SELECT doc_id, unnest(list(pos)) AS pos FROM win GROUP BY doc_id, g HAVING count(*) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([pos, pos + 1, pos + 2]) AS p FROM twice) GROUP BY doc_id
), measured AS (
  SELECT d.doc_id, lang, source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, n_symbols,
         len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
  FROM doc d LEFT JOIN covered USING (doc_id)
), rated AS (
  SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         n_symbols * 10000 // nullif(word_chars, 0) AS symbols, n_dup_lines * 10000 // nullif(n_lines, 0) AS dup_lines,
         n_repeat_words * 10000 // nullif(n_words, 0) AS repeats, word_chars * 100 // nullif(n_words, 0) AS word_length
  FROM measured
), value AS (
  SELECT lang, source, rate, v FROM rated UNPIVOT (v FOR rate IN ({_RATE_SQL})) WHERE NOT base_failed
), sketch AS (
  SELECT lang, source, rate, (v >> drop) << drop AS bucket, count(*) AS n
  FROM (SELECT *, greatest(length(bin(v)) - 6, 0) AS drop FROM value) GROUP BY ALL
), of_all AS (
  SELECT rate, bucket, {_SHARE_SQL} FROM (
    SELECT *, sum(weight) OVER (PARTITION BY rate) AS total
    FROM (SELECT rate, bucket, sum({quality.UNIT} * n) AS weight FROM sketch GROUP BY ALL))
), of_lang AS (
  SELECT lang, rate, bucket, {_SHARE_SQL} FROM ({_mixed_sql("lang", "of_all")})
), own AS (
  SELECT *, sum(weight) OVER (PARTITION BY lang, source, rate ORDER BY bucket) AS up_to FROM ({_mixed_sql("lang, source", "of_lang")})
), fence AS (
  SELECT lang, source, rate, greatest(2 * bottom - {_end_sql("middle")}, 0) AS low, 2 * {_end_sql("top")} - middle AS high FROM (
    SELECT lang, source, rate, min(bucket) FILTER (up_to >= total // {quality.TAIL}) AS bottom, min(bucket) FILTER (up_to >= total // 2) AS middle,
           min(bucket) FILTER (up_to >= total - total // {quality.TAIL}) AS top
    FROM own GROUP BY ALL)
), outside AS (
  SELECT DISTINCT doc_id FROM (
    SELECT doc_id, lang, source, rate, v FROM (
      SELECT doc_id, lang, source, greatest(n_symbols - {quality.EVENT["symbols"]}, 0) * 10000 // nullif(word_chars, 0) AS symbols,
             greatest(n_dup_lines - {quality.EVENT["dup_lines"]}, 0) * 10000 // nullif(n_lines, 0) AS dup_lines,
             greatest(n_repeat_words - {quality.EVENT["repeats"]}, 0) * 10000 // nullif(n_words, 0) AS repeats, word_length
      FROM rated WHERE NOT base_failed) UNPIVOT (v FOR rate IN ({_RATE_SQL}))) r
  JOIN fence f ON r.lang IS NOT DISTINCT FROM f.lang AND r.source IS NOT DISTINCT FROM f.source AND r.rate = f.rate
  WHERE v > high OR (r.rate = 'word_length' AND v < low)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM outside) AS kept
FROM rated
"""


@_query
def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of each document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    aside = language.held_out(F.col("doc_id"))
    found = language.identify(docs, docs.where(~aside))
    return found.select("doc_id", aside.alias("held_out"), "lang_pred", "score")


@_query
def op7_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document without strings of 200 bytes that occur elsewhere."""
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


@_query
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's ids as read back from the written segments."""
    files = stored(token_files.segments(table(spark, sf_dir, "documents"), tokenizer_path()))
    return token_files.read(files)


URL_RULES = [
    url_rules.Rule(url_rules.BLOCK, "net", "/"),
    url_rules.Rule(url_rules.ALLOW, "example.net", "/en/"),
    url_rules.Rule(url_rules.BLOCK, "example.com", "/de/"),
    url_rules.Rule(url_rules.ALLOW, "org", "/fr/"),
]
# Words in a host that speak for advertising, gambling, adult pages or link farms.
HOST_WORDS = ["ads-", "adult", "bets", "casino", "pills", "spam"]


@_query
def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on each page's url."""
    return url_rules.judge(table(spark, sf_dir, "pages"), URL_RULES, [f"*{word}*/**" for word in HOST_WORDS])


_FITS_SQL = " ".join(
    f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{r.name}'"
    for r in sorted(URL_RULES, key=lambda r: -len(r.name))
)
_VERDICT_SQL = " ".join(f"WHEN '{r.name}' THEN '{r.verdict}'" for r in URL_RULES)
SQL["op9_url_rules"] = rf"""
WITH part AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), ruled AS (SELECT *, CASE {_FITS_SQL} END AS rule FROM part)
SELECT page_id, host, path, rule, CASE rule {_VERDICT_SQL} ELSE
         CASE WHEN {" OR ".join(f"contains(host, '{word}')" for word in HOST_WORDS)} THEN 'block' ELSE 'allow' END END AS verdict
FROM ruled
"""


@_query
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of each document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.withColumn("fingerprint", F.lpad(F.lower(F.hex("fingerprint")), 16, "0"))


@_query
def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How each source of a language differs from the others, and in which terms."""
    return divergence.audit(table(spark, sf_dir, "documents"))


def _share_sql(count: str, total: str, terms: str) -> str:
    return f"1 + ({divergence.SCALE}::HUGEINT * ({count} + {divergence.SMOOTH})) // ({total} + {divergence.SMOOTH} * {terms})"


SQL["op11_divergence"] = rf"""
WITH doc AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all({_LOWER.replace("text", "coalesce(text, '')", 1)}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), word AS (
  SELECT lang, source, r, term, count(*) AS n FROM (SELECT lang, source, r, unnest(w) AS term FROM doc) GROUP BY ALL
), kept AS (
  SELECT lang, term FROM word GROUP BY lang, term HAVING count(*) >= {divergence.MIN_DOCS}
), term_count AS (
  SELECT lang, source, term, sum(n) AS n FROM word SEMI JOIN kept USING (lang, term) GROUP BY ALL
), grp AS (
  SELECT DISTINCT lang, source FROM doc
), sized AS (
  SELECT lang, source, coalesce(n, 0) AS total, coalesce(v, 0) AS v
  FROM grp LEFT JOIN (SELECT lang, source, sum(n) AS n FROM term_count GROUP BY ALL) USING (lang, source)
  LEFT JOIN (SELECT lang, count(*) AS v FROM kept GROUP BY ALL) USING (lang)
), share AS (
  SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n, {_share_sql("coalesce(c.n, 0)", "total", "v")} AS p
  FROM sized s JOIN kept k USING (lang) LEFT JOIN term_count c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term
), language AS (
  SELECT lang, term, {_share_sql("n", "total", "v")} AS q
  FROM (SELECT lang, term, sum(n) AS n FROM term_count GROUP BY ALL)
  JOIN (SELECT lang, sum(total) AS total, max(v) AS v FROM sized GROUP BY lang) USING (lang)
), pair AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM share a JOIN share b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM share JOIN language USING (lang, term) WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM found QUALIFY part = 'pair' OR rank <= {divergence.TOP}
"""


def _made_periodic(doc_ids: list[int | None], numbers: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The contract's repeats: a tenth of the documents goes on with a period from some word on."""
    numbers = numbers.copy()
    for doc_id, start, end in zip(doc_ids, starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        g, chosen = divmod(zlib.crc32(str(doc_id).encode()), 10)
        if doc_id is not None and chosen == 0 and end > start:
            n = end - start
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            numbers[start + a : end] = numbers[start + a + np.arange(n - a) % p]
    return numbers


@_query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of words with a period in each document, and what is left with one period of each."""
    found = periodic.collapse(table(spark, sf_dir, "documents"), rewrite=_made_periodic)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.withColumn("best", longest).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.p")).alias("period"),
        F.expr("1000 * best.length div -best.p").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


SHARDS = 24


@_query
def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard and slot of each document."""
    found = sharding.shard(table(spark, sf_dir, "documents"), SHARDS)
    return found.select(
        "doc.doc_id",
        "size",
        F.crc32(F.coalesce("doc.text", F.lit(""))).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


# The step of CRC-32 for each byte, from the digests of single bytes.
_CRC_TABLE = ", ".join(str(zlib.crc32(bytes([255 - k])) ^ 0xFF000000) for k in range(256))


def _crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes."""
    codes = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: CAST('0x' || x AS BIGINT))"
    step = f"xor(c >> 8, ([{_CRC_TABLE}])[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce({codes}, lambda c, b: {step}, CAST(4294967295 AS BIGINT)), 4294967295)"


SQL["op13_sharding"] = f"""
WITH placed AS (
  SELECT doc_id, coalesce(text, '') AS text, octet_length(encode(coalesce(text, ''))) + 8 AS size,
         sum(octet_length(encode(coalesce(text, ''))) + 8) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING) AS up_to,
         sum(octet_length(encode(coalesce(text, ''))) + 8) OVER () AS total
  FROM documents
), dealt AS (
  SELECT *, CAST(least((2 * up_to - size) * {SHARDS} // (2 * total), {SHARDS - 1}) AS INTEGER) AS shard FROM placed
)
SELECT doc_id, size, {_crc32_sql("text")} AS text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM dealt
"""
