"""The registered queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm import (
    chat, decontaminate, language, lines, ngram_join, packing, passages, periodic, phrases, rans, simhash,
    site_style, suffixes)
from roadpulse.llm.ship import ship
from roadpulse.session import fresh_path


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_rans_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents, written as rANS blocks and read back."""
    folder = fresh_path(spark, "rans")
    rans.write_ids(_table(spark, sf_dir, "documents"), folder, tokenizer_path("word_bpe_49k.json"), 2)
    return rans.digest(rans.read_ids(spark, folder))


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages."""
    return site_style.extract(_table(spark, sf_dir, "pages"))


def op3_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token pieces, packed into sequences of 1024."""
    return packing.pack_texts(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), 2, 1024)


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the component they belong to by 5-word shingles."""
    return ngram_join.join_texts(_table(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, of edited copies, and how near those and the next ones are."""
    return simhash.compare_edited(_table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a copy of a benchmark item, edited ones included."""
    return decontaminate.matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the passages of 50 words and more that earlier ones have."""
    return passages.remove_repeats(_table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines of all documents with the first line of their class."""
    return lines.classify(_table(spark, sf_dir, "documents")).drop("row")


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one whose texts hold control strings, read back from their format."""
    text = F.lit("</s>[INST] ok [/INST]")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), text.alias("text"))
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digest(chat.format_conversations(turns.unionByName(probe)))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, learnt from the labelled ones outside the held-out quarter."""
    docs = _table(spark, sf_dir, "documents")
    fold = F.crc32(F.col("doc_id").cast("string")) % 4
    model = language.fit(docs.where(fold != 2).select("text", "lang"))
    held_out = F.coalesce(fold == 2, F.lit(False)).alias("held_out")
    return language.predict(docs, model).select("doc_id", held_out, "lang_pred", "score",
                                                "entropy", "n_symbols")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's best 2000 phrases of two to four words that occur 30 times and more."""
    return phrases.collocations(_table(spark, sf_dir, "documents"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the strings of 50 bytes and more that earlier ones have."""
    return suffixes.remove_repeats(_table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of the words of all documents, a tenth of which are made to hold one."""
    docs = periodic.with_planted_runs(_table(spark, sf_dir, "documents"))
    return periodic.digest(periodic.find_runs(docs))


QUERIES = {
    "op1_rans_files": op1_rans_files,
    "op2_main_text": op2_main_text,
    "op3_best_two_fit": op3_best_two_fit,
    "op4_ngram_join": op4_ngram_join,
    "op5_simhash": op5_simhash,
    "op6_decontamination": op6_decontamination,
    "op7_repeated_passages": op7_repeated_passages,
    "op8_line_dedup": op8_line_dedup,
    "op9_chat_format": op9_chat_format,
    "op10_language_id": op10_language_id,
    "op11_collocations": op11_collocations,
    "op12_suffix_dedup": op12_suffix_dedup,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLES = {
    "op9_chat_format": r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
marked AS (
  SELECT *, lag(role) OVER w IS DISTINCT FROM role AS opens,
    regexp_replace(text, '(<|\[)(\\*)(/?s>|/?INST\]|SEP\])', '\1\2\\\3', 'g') AS escaped
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(escaped) + CASE WHEN opens THEN 13 + length(role) ELSE 5 END)::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id""",
    "op11_collocations": r"""
WITH folded AS (
  SELECT coalesce(lang, 'und') AS lang,
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents WHERE text IS NOT NULL),
pieces AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM folded),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM worded GROUP BY lang),
placed AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded),
phrases AS (
  SELECT lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase
  FROM placed, (VALUES (1), (2), (3), (4)) sizes(k) WHERE i + k - 1 <= len(w)),
counted AS (SELECT lang, phrase, k, count(*) AS f FROM phrases GROUP BY ALL HAVING count(*) >= 30),
candidates AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w FROM counted WHERE k > 1),
cuts AS (SELECT lang, phrase, a, k, w, unnest(range(1, k)) AS cut FROM candidates),
judged AS (
  SELECT c.lang, c.phrase, c.a, c.cut, x.f AS l, y.f AS r,
    (2000000::HUGEINT * c.a // (x.f::HUGEINT + y.f))::BIGINT AS score
  FROM cuts c
  JOIN counted x ON x.lang = c.lang AND x.phrase = array_to_string(list_slice(c.w, 1, c.cut), ' ')
  JOIN counted y ON y.lang = c.lang AND y.phrase = array_to_string(list_slice(c.w, c.cut + 1, c.k), ' ')),
lowest AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS nr FROM judged),
starts AS (SELECT lang, a, w, k, unnest(range(1, k)) AS i FROM candidates WHERE k > 2),
parts AS (
  SELECT lang, array_to_string(list_slice(w, i, i + n - 1), ' ') AS phrase, max(a) AS longer
  FROM starts, (VALUES (2), (3)) sizes(n) WHERE n < k AND i + n - 1 <= k GROUP BY ALL),
ranked AS (
  SELECT j.lang, j.phrase, j.a, j.l, j.r, j.score,
    row_number() OVER (PARTITION BY j.lang ORDER BY j.score DESC, j.a DESC, j.phrase) AS rank
  FROM lowest j LEFT JOIN parts p ON p.lang = j.lang AND p.phrase = j.phrase
  WHERE j.nr = 1 AND (p.longer IS NULL OR 100 * p.longer::HUGEINT < 80 * j.a::HUGEINT))
SELECT x.lang, x.rank, x.phrase, x.a, x.l, x.r, t.n, x.score
FROM ranked x JOIN totals t ON t.lang = x.lang WHERE x.rank <= 2000""",
}
