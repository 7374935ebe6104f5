"""The registered queries of this folder and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import (
    automata, decontaminate, language, lexical, manifest, mixing, personal, quality_model, quality_rules, simhash, suffixes,
    token_counts, token_files,
)
from shelfcast.llm.quality_model import in_fold
from shelfcast.llm.workers import with_package
from shelfcast.shared import written_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(function):
    QUERIES[function.__name__] = lambda spark, folder: function(with_package(spark), folder)
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _rules_sql(rules: quality_rules.QualityRules) -> str:
    """The quality rules in SQL, histograms as rows of (document, kind, bin)."""
    vocabulary = rules.vocabulary()
    known = ", ".join(f"'{x}'" for v in vocabulary for x in (v, v.capitalize(), v.upper()))
    signs = {"upper": "[^A-Z]+", "digit": "[^0-9]+", "mark": """[^.,;:!?''"()-]+""", "ends": "[^\\x00-\\x1F]+"}
    counted = ", ".join(f"length(regexp_replace(signs, '{r}', '', 'g')) AS {c}" for c, r in signs.items())
    languages = ", ".join(f"'{x}'" for x in rules.common_words)
    return f"""
WITH d AS (
  SELECT doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
    regexp_replace(coalesce(text, ''), '[a-z \\x7F-\\x{{10FFFF}}]+', '', 'g') AS signs FROM documents),
b AS (
  SELECT *, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines, {counted} FROM d),
win AS (
  SELECT doc_id, i, array_to_string(list_slice(w, i, i + 7), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS n FROM win) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT k) AS n_repeat FROM (SELECT doc_id, unnest(range(i, i + 8)) AS k FROM twice) GROUP BY 1),
bins AS (
  SELECT doc_id, lang, 'class' AS kind, unnest(['upper', 'digit', 'mark', 'ends', 'other', 'wide', 'rest']) AS bin,
    unnest([upper, digit, mark, ends, length(signs) - upper - digit - mark - ends, strlen(t) - length(t), length(t) - length(signs)]) AS n FROM b
  UNION ALL
  SELECT doc_id, lang, 'word', CASE WHEN x IN ({known}) THEN lower(x) ELSE '' END, count(*)
  FROM (SELECT doc_id, lang, unnest(w) AS x FROM d) GROUP BY ALL),
totals AS (SELECT doc_id, kind, sum(n) AS total FROM bins GROUP BY ALL),
refs AS (SELECT lang, kind, bin, sum(n) AS n FROM bins WHERE lang IN ({languages}) GROUP BY ALL),
sizes AS (SELECT lang, kind, sum(n) AS total FROM refs GROUP BY ALL),
grid AS (  -- every document with every reference and every bin of either
  SELECT t.doc_id, z.lang, t.kind, r.bin, coalesce(x.n, 0) / t.total AS p, r.n / z.total AS q
  FROM totals t JOIN sizes z ON t.kind = z.kind AND t.total > 0 AND z.total > 0 JOIN refs r ON r.lang = z.lang AND r.kind = z.kind
  LEFT JOIN bins x ON x.doc_id = t.doc_id AND x.kind = t.kind AND x.bin = r.bin
  UNION ALL
  SELECT x.doc_id, z.lang, x.kind, x.bin, x.n / t.total, 0
  FROM bins x JOIN totals t ON t.doc_id = x.doc_id AND t.kind = x.kind AND t.total > 0 JOIN sizes z ON z.kind = x.kind AND z.total > 0
  WHERE NOT EXISTS (SELECT 1 FROM refs r WHERE r.lang = z.lang AND r.kind = x.kind AND r.bin = x.bin)),
js AS (
  SELECT doc_id, lang, kind, sqrt(greatest(sum((CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
    + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2), 0)) AS far
  FROM grid GROUP BY ALL),
near AS (
  SELECT doc_id, min(far) FILTER (WHERE kind = 'class') AS class_far, min(far) FILTER (WHERE kind = 'word') AS word_far FROM js GROUP BY 1),
judged AS (
  SELECT b.*, coalesce(n_repeat, 0) AS n_repeat_words, n_words < {rules.min_words}
    OR 100 * coalesce(n_repeat, 0) > {rules.max_repeat_percent} * n_words AS base_failed,
    (strlen(t) >= {rules.min_class_chars} AND coalesce(class_far, 0) > {rules.max_class_distance})
    OR (n_words >= {rules.min_histogram_words} AND coalesce(word_far, 0) > {rules.max_word_distance}) AS far
  FROM b LEFT JOIN rep USING (doc_id) LEFT JOIN near USING (doc_id))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
  base_failed, NOT base_failed AND NOT far AS kept
FROM judged"""


ORACLES["op9_distribution_rules"] = _rules_sql(quality_rules.QualityRules())


@_query
def op9_distribution_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and verdict of every document."""
    rules = quality_rules.QualityRules()
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    words = quality_rules.further_words(docs, rules)
    narrow = written_table(
        quality_rules.measure(docs, rules, words=words).select(F.struct("_row.doc_id", "_row.lang").alias("_row"), "_counts"), "counts"
    )
    further = None if words is None else quality_rules.further_references(narrow)
    judged = quality_rules.verdict(narrow, quality_rules.language_references(narrow, rules, "lang"), rules, further=further)
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged.select("_row.doc_id", *[F.col(f"_rules.{c}") for c in counts])


@_query
def op10_hypergeometric_mix(spark: SparkSession, folder: str) -> DataFrame:
    """What the mix takes of every document."""
    return mixing.mixed_sizes(table(spark, folder, "documents").select("doc_id", "text", "source"))


@_query
def op3_ranked_byte_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Token files of all documents, read back."""
    return token_files.TokenFiles.write(table(spark, folder, "documents").select("doc_id", "text")).read()


@_query
def op8_digest_cache_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Token counts of all documents, through a cache that is empty at first."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs.select("doc_id", "text"), token_counts.CountCache(spark))
    return counted.select("_row.doc_id", "n_bytes", "n_tokens", "over_limit")


ORACLES["op2_fm_index_decontamination"] = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
p AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(list_slice(w, i, i + least(13, len(w)) - 1), ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, 2 + greatest(0, len(w) - 13))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM p),
t AS (
  SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, 2 + len(w) - n)) AS i FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT t.doc_id, t.i, p.n, p.item_id FROM t JOIN p ON t.n = p.n AND t.s = p.s),
covered AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY 1),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS names
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@_query
def op2_fm_index_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark words in every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.contamination(docs, table(spark, folder, "benchmark"), text="text")
    return found.select("_row.doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@_query
def op5_ngram_language(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, learned from two thirds of them."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(in_fold("doc_id", 3) == 1, F.lit(False))
    model = language.train(docs.filter(in_fold("doc_id", 3) != 1))
    found = language.predict(docs.select("doc_id", "text", held_out.alias("held_out")), model)
    return found.select("_row.doc_id", "_row.held_out", "lang_pred", "score")


@_query
def op4_pairwise_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document, learned from the labels of four fifths of them."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held_out = F.coalesce(in_fold("doc_id", 5) == 0, F.lit(False))
    model = quality_model.learn(docs, table(spark, folder, "labels").filter(in_fold("doc_id", 5) != 0))
    found = quality_model.predict(docs.select("doc_id", "text", held_out.alias("held_out")), model)
    return found.select("_row.doc_id", "_row.held_out", "score", "predicted")


@_query
def op6_bk_tree_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(table(spark, folder, "documents"))


ORACLES["op1_automaton_substring_dedup"] = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
t AS (
  SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 49), ' ')) AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
f AS (SELECT s, min(doc_id) AS first FROM t GROUP BY s HAVING min(doc_id) < max(doc_id)),
c AS (
  SELECT doc_id, list(DISTINCT k) AS ks FROM (
    SELECT t.doc_id, unnest(range(i, i + 50)) AS k FROM t JOIN f ON t.s = f.s AND f.first < t.doc_id) GROUP BY 1),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM d WHERE len(w) > 0),
gone AS (SELECT doc_id, unnest(ks) AS k, TRUE AS cut FROM c),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY k) FILTER (WHERE cut IS NULL) AS line
  FROM words LEFT JOIN gone USING (doc_id, k) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(ks), 0) AS BIGINT) AS n_removed,
  sha256(coalesce(line, '')) AS kept_sha256
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


@_query
def op1_automaton_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every document without the windows that an earlier one has."""
    found = automata.without_repeats(table(spark, folder, "documents"))
    return found.drop("kept", "spans")


@_query
def op7_two_stage_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every document without the strings of 400 bytes that occur elsewhere."""
    found = suffixes.without_repeated_bytes(table(spark, folder, "documents"))
    return found.drop("kept", "spans")


ORACLES["op11_pipelined_lexical_search"] = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w, row_number() OVER () AS k FROM documents),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark),
size AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d WHERE len(w) > 0),
tf AS (SELECT k, term, count(*) AS tf FROM (SELECT k, unnest(w) AS term FROM d) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
part AS (
  SELECT tf.k, term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT)
    * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * len(w) * n_docs) // n_terms))) AS given
  FROM tf JOIN df USING (term) JOIN d ON d.k = tf.k, size WHERE term IN (SELECT term FROM q)),
score AS (SELECT item_id, k, CAST(sum(given) AS BIGINT) AS score FROM q JOIN part USING (term) GROUP BY 1, 2),
ranked AS (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS place
  FROM score JOIN d USING (k) WHERE score > 0)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 50
"""


@_query
def op11_pipelined_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    """The fifty best documents for each benchmark item."""
    return lexical.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


ORACLES["op12_interval_manifest"] = """
WITH RECURSIVE e AS (
  SELECT doc_id, coalesce('s' || source, '-') AS tree, text,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
    -- the checksum, bit by bit, over the digits of the number
    list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
      lambda c, b: list_reduce(list_prepend(xor(c, b), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])),
        lambda a, z: xor(a >> 1, (a & 1) * CAST(3988292384 AS BIGINT)))) AS crc
  FROM documents),
l AS (
  SELECT doc_id, tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(t2) || ':' || t2, '-')) AS altered
  FROM (SELECT *, CASE WHEN crc & 1 = 1 THEN replace(text, chr(10), '') ELSE text END AS t2 FROM e)),
r AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, altered) - 1 AS i,
    count(*) OVER (PARTITION BY tree) AS n, row_number() OVER () AS k FROM l),
up(tree, level, i, h, n) AS (
  SELECT tree, 0, i, leaf, n FROM r
  UNION ALL SELECT tree, level + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (n + 2) // 3 FROM up WHERE n > 1 GROUP BY tree, level, i // 3, n),
subroots AS (SELECT tree, h, level AS height FROM up WHERE n = 1),
top(level, i, h, n) AS (
  SELECT 0, row_number() OVER (ORDER BY tree) - 1, h, count(*) OVER () FROM subroots
  UNION ALL SELECT level + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (n + 2) // 3 FROM top WHERE n > 1 GROUP BY level, i // 3, n),
seats AS (SELECT tree, h, height, row_number() OVER (ORDER BY tree) - 1 AS seat FROM subroots),
sides AS (
  SELECT a.tree, a.level, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.i < a.i), '') AS before,
    coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.i > a.i), '') AS after
  FROM up a JOIN up b ON a.tree = b.tree AND a.level = b.level AND a.i // 3 = b.i // 3 WHERE a.n > 1 GROUP BY ALL),
upper_sides AS (
  SELECT a.level, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.i < a.i), '') AS before,
    coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.i > a.i), '') AS after
  FROM top a JOIN top b ON a.level = b.level AND a.i // 3 = b.i // 3 WHERE a.n > 1 GROUP BY ALL),
fold(k, tree, level, i, h, proof) AS (
  SELECT k, tree, 0, i, altered, '' FROM r
  UNION ALL SELECT k, f.tree, f.level + 1, f.i // 3, sha256(before || h || after), proof || before || after
  FROM fold f JOIN sides s ON f.tree = s.tree AND f.level = s.level AND f.i = s.i),
under AS (
  SELECT f.k, s.seat, f.h, f.proof FROM fold f JOIN seats s ON f.tree = s.tree AND f.level = s.height),
fold2(k, level, i, h, proof) AS (
  SELECT k, 0, seat, h, proof FROM under
  UNION ALL SELECT k, f.level + 1, f.i // 3, sha256(before || h || after), proof || before || after
  FROM fold2 f JOIN upper_sides s ON f.level = s.level AND f.i = s.i),
done AS (SELECT k, h, proof FROM fold2 WHERE level = (SELECT max(level) FROM top))
SELECT r.doc_id, leaf, s.h AS subroot, t.h AS root, sha256(proof) AS proof_sha256, d.h AS folded_root, d.h = t.h AS verified
FROM r JOIN done d USING (k) JOIN seats s ON r.tree = s.tree, (SELECT h FROM top WHERE n = 1) t
"""


@_query
def op12_interval_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's place in the manifest, and whether its row, half of them altered, leads to the root."""
    return manifest.verify(table(spark, folder, "documents"))


@_query
def op13_weakly_supervised_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document: the strict spans, and those that the trained classifier adds."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = personal.find(docs, personal.learn(docs))
    return found.select("_row.doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")
