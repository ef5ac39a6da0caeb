"""The registered queries on the corpus, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.llm import bpe, collocations, decontamination, licenses, near_duplicates, neighbours, quality, repair, repeats, secrets, sharding, token_files, toxicity
from tripweave.llm.columns import read


def _op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


RANKS = "byte_bpe_50k.tiktoken"
TOKENIZER = "byte_bpe_50k.json"
SHARDS = 24


def _op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(RANKS)
    return bpe.encode_texts(read(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, with_ids=False)


def _op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(TOKENIZER)
    return token_files.read_tokens(spark, token_files.write_tokens(read(spark, sf_dir, "documents"), path))


def _op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(read(spark, sf_dir, "documents"))


def _op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def _op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def _op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(read(spark, sf_dir, "documents"), digest=True)


def _op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % neighbours.QUERY_EVERY == 0)


def _op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read(spark, sf_dir, "documents"), SHARDS)


def _op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets(read(spark, sf_dir, "documents"))


def _op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licenses(read(spark, sf_dir, "documents"))


def _op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


def _op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(read(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality_classifier": _op1,
        "op2_byte_bpe": _op2,
        "op3_token_files": _op3,
        "op4_ngram_jaccard_join": _op4,
        "op5_toxicity": _op5,
        "op6_benchmark_decontamination": _op6,
        "op7_repeated_passages": _op7,
        "op8_nearest_neighbours": _op8,
        "op9_sharding": _op9,
        "op10_secret_scans": _op10,
        "op11_license_scans": _op11,
        "op12_collocations": _op12,
        "op13_conversation_repair": _op13,
    }


_OP6 = r"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
item_windows AS (
  SELECT item_id, least(13, len(w)) AS n,
         array_to_string(w[unnest(range(1, greatest(len(w) - 12, 1) + 1)) :][: least(13, len(w))], ' ') AS s
  FROM item_words WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM item_windows),
doc_words AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
doc_windows AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc_words, sizes WHERE len(w) >= n)),
hits AS (SELECT d.doc_id, d.i, d.n, b.item_id FROM doc_windows d JOIN item_windows b ON b.s = d.s AND b.n = d.n),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY 1),
hit_items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY 1)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(t.n_items, 0) AS n_items,
       sha256(coalesce(t.items, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.w) AS contaminated
FROM doc_words d LEFT JOIN hit_words h USING (doc_id) LEFT JOIN hit_items t USING (doc_id)
"""


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""


def _rows(rows: list[tuple]) -> str:
    """A list of tuples of texts and numbers as SQL."""
    return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in row) + ")" for row in rows)


def _op11_sql() -> str:
    """Every block against every template, by counting common words."""
    index = licenses.entries(licenses.TEMPLATES, licenses.THRESHOLD)
    words = [(e.template.name, e.step, w) for e in index for w in sorted(e.words)]
    marks = {e.template.name: set(licenses.words_of(e.template.marks)) for e in index}
    marked = [(name, w) for name, some in marks.items() for w in sorted(some)]
    about = [(e.template.name, e.template.label, len(e.words), e.need, len(marks[e.template.name])) for e in index]
    phrases = [(phrase, label, len(phrase.split())) for phrase, label in licenses.PHRASES.items()]
    return f"""
WITH template_words(name, step, word) AS (VALUES {_rows(words)}),
template_marks(name, word) AS (VALUES {_rows(marked)}),
templates(name, label, size, need, n_marks) AS (VALUES {_rows(about)}),
phrases(phrase, label, m) AS (VALUES {_rows(phrases)}),
d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
each AS (SELECT r, unnest(w) AS word, unnest(range(len(w))) AS p FROM d),
held AS (SELECT DISTINCT r, name, b, word FROM
  (SELECT r, name, word, unnest([p // step, p // step - 1]) AS b FROM each JOIN template_words USING (word)) WHERE b >= 0),
counted AS (SELECT r, name, b, count(*) AS common, count(m.word) AS told
  FROM held LEFT JOIN template_marks m USING (name, word) GROUP BY ALL),
found AS (SELECT r, CASE WHEN told = n_marks THEN label END AS label, common / size AS share
  FROM counted JOIN templates USING (name) WHERE common >= need),
starts AS (SELECT r, w, m, phrase, label, unnest(range(len(w) - m + 1)) AS p FROM d, phrases WHERE len(w) >= m),
places AS (SELECT r, p, label FROM starts WHERE array_to_string(w[p + 1 : p + m], ' ') = phrase),
base AS (SELECT r, count(*) AS n, min(p) AS first_p, max(p) AS last_p, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM places GROUP BY 1),
every AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM (SELECT r, label FROM found UNION ALL SELECT r, label FROM places) GROUP BY 1),
best AS (SELECT r, max(share) AS share FROM found GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_base, first_p AS first_word, last_p AS last_word,
       coalesce(base.labels, '') AS base_labels, coalesce(every.labels, '') AS labels,
       CASE WHEN n > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0)::DOUBLE END AS score
FROM d LEFT JOIN base USING (r) LEFT JOIN every USING (r) LEFT JOIN best USING (r)
"""


# Every phrase of every piece counted by its text, and every cut of every candidate looked up.
_OP12 = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang,
  unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
pieces AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM d),
totals AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM pieces GROUP BY 1),
placed AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, range(1, 6) AS t(k) WHERE len(w) >= k),
counts AS (SELECT lang, k AS m, array_to_string(w[i : i + k - 1], ' ') AS phrase, count(*)::HUGEINT AS f
  FROM placed GROUP BY ALL HAVING count(*) >= 100),
candidates AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE m > 1),
cuts AS (SELECT lang, phrase, a, w, m, unnest(range(1, m)) AS k FROM candidates),
scored AS (
  SELECT c.lang, c.phrase, c.a, l.f AS l, r.f AS r, n, (1000 * a * n) // (l.f * r.f) AS score,
         row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY (1000 * a * n) // (l.f * r.f), k) AS nth
  FROM cuts c JOIN totals USING (lang)
  JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(w[1 : k], ' ')
  JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(w[k + 1 : c.m], ' ')),
lengths AS (SELECT lang, w, a, m, unnest(range(2, m)) AS k FROM candidates),
spans AS (SELECT lang, w, a, k, unnest(range(1, m - k + 2)) AS i FROM lengths),
inside AS (SELECT lang, array_to_string(w[i : i + k - 1], ' ') AS phrase, max(a) AS most FROM spans GROUP BY ALL),
ranked AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank
  FROM scored s LEFT JOIN inside i ON i.lang = s.lang AND i.phrase = s.phrase
  WHERE nth = 1 AND (most IS NULL OR 100 * most < 100 * a))
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked WHERE rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {"op6_benchmark_decontamination": _OP6, "op11_license_scans": _op11_sql(), "op12_collocations": _OP12}
