"""Text, vocabulary and weighting queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.fixed import CLEAN_STOP, ENGLISH_STOP, POOLED_STOP, SHORT_STOP
from ..operators import terms as tt, vectors
from ..operators.distribute import materialize
from ..sources import wordvectors
from .registry import query, scratch, sql_list, sql_tokens, table


def _joined(spark, d, words, sep=" "):
    return table(spark, d, "documents").select("doc_id", words.alias("w")).select(
        "doc_id", F.size("w").cast("long").alias("n"), F.array_join("w", sep).alias("words"))


def _sql_joined(words: str, sep: str = " ") -> str:
    return (f"SELECT doc_id, len(w) AS n, coalesce(array_to_string(w, '{sep}'), '') AS words "
            f"FROM (SELECT doc_id, {words} AS w FROM documents)")


@query(_sql_joined(sql_tokens("text")))
def text_tokens(spark: SparkSession, d: str) -> DataFrame:
    return _joined(spark, d, tx.tokens("text"))


@query(_sql_joined(sql_tokens("text", POOLED_STOP)))
def text_tokens_pooled_stop(spark, d):
    return _joined(spark, d, tx.tokens("text", POOLED_STOP))


@query(_sql_joined(sql_tokens("text", SHORT_STOP)))
def text_tokens_short_stop(spark, d):
    return _joined(spark, d, tx.tokens("text", SHORT_STOP))


@query(_sql_joined(sql_tokens("text", ENGLISH_STOP, 2)))
def text_tokens_min2_english(spark, d):
    return _joined(spark, d, tx.tokens("text", ENGLISH_STOP, 2))


@query(_sql_joined("flatten(list_transform(string_split(text, chr(10)), lambda l: "
                   + sql_tokens("l") + "))"))
def text_nested_tokens(spark, d):
    return _joined(spark, d, tx.nested_tokens(F.split("text", "\n")))


@query("WITH t AS (SELECT doc_id, " + sql_tokens("text", SHORT_STOP) + " AS t FROM documents), "
       "b AS (SELECT doc_id, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]) AS w FROM t) "
       "SELECT doc_id, len(w) AS n, coalesce(array_to_string(w, '|'), '') AS words FROM b")
def text_bigrams(spark, d):
    return _joined(spark, d, tx.ngrams(tx.tokens("text", SHORT_STOP), 2), "|")


@query("WITH t AS (SELECT doc_id, " + sql_tokens("text", SHORT_STOP) + " AS t FROM documents), "
       "b AS (SELECT doc_id, t || list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]) AS w FROM t) "
       "SELECT doc_id, len(w) AS n, coalesce(array_to_string(w, '|'), '') AS words FROM b")
def text_tokens_and_bigrams(spark, d):
    return _joined(spark, d, tx.tokens_and_bigrams("text", SHORT_STOP), "|")


_STEM = ("CASE WHEN ends_with(w, 'ing') THEN left(w, length(w) - 3) "
         "WHEN ends_with(w, 'ed') THEN left(w, length(w) - 2) "
         "WHEN ends_with(w, 's') AND NOT ends_with(w, 'ss') THEN left(w, length(w) - 1) ELSE w END")


def sql_clean(text: str) -> str:
    kept = (f"list_filter(regexp_extract_all(lower(coalesce({text}, '')), '[a-z]+'), "
            f"lambda w: length(w) > 2 AND w NOT IN ({sql_list(CLEAN_STOP)}))")
    return f"list_filter(list_transform({kept}, lambda w: {_STEM}), lambda w: length(w) > 2)"


@query(f"SELECT doc_id, coalesce(array_to_string({sql_clean('text')}, ' '), '') AS cleaned FROM documents")
def text_clean_stem(spark, d):
    return table(spark, d, "documents").select("doc_id", tx.clean_text("text").alias("cleaned"))


@query("SELECT conv_id, turn, round(ln(1 + len(" + sql_tokens("text", SHORT_STOP) + ")), 6) AS log_len "
       "FROM conversations")
def text_length_log1p(spark, d):
    return table(spark, d, "conversations").select(
        "conv_id", "turn", F.round(tx.log_length(tx.tokens("text", SHORT_STOP)), 6).alias("log_len"))


def two_text_columns(spark, d):
    """Documents and conversation turns as the two text columns of one table."""
    docs = table(spark, d, "documents").select(
        F.concat(F.lit("d"), "doc_id").alias("key"), F.col("text").alias("a"), F.lit(None).cast("string").alias("b"))
    turns = table(spark, d, "conversations").select(
        F.concat_ws("-", F.lit("c"), "conv_id", "turn").alias("key"), F.lit(None).cast("string").alias("a"),
        F.col("text").alias("b"))
    return docs.unionByName(turns)


_POOLED = ("w AS (SELECT unnest(" + sql_tokens("text") + ") AS term FROM "
           "(SELECT text FROM documents UNION ALL SELECT text FROM conversations)), "
           "c AS (SELECT term, count(*) AS n FROM w GROUP BY term), "
           "top AS (SELECT term, n, row_number() OVER (ORDER BY n DESC, term) - 1 AS idx FROM c)")


@query(f"WITH {_POOLED} SELECT term, idx, n FROM top WHERE idx < 100")
def vocab_pooled_top100(spark, d):
    return tt.pooled_vocabulary(two_text_columns(spark, d), ["a", "b"], 100).select("term", "idx", "n")


@query(f"WITH {_POOLED} SELECT term, row_number() OVER (ORDER BY term) - 1 AS idx, n FROM c")
def vocab_pooled_all(spark, d):
    return tt.pooled_vocabulary(two_text_columns(spark, d), ["a", "b"]).select("term", "idx", "n")


@query("WITH t AS (SELECT doc_id, " + sql_tokens("text") + " AS t FROM documents), "
       "w AS (SELECT doc_id, unnest(t) AS term, generate_subscripts(t, 1) AS pos FROM t), "
       "c AS (SELECT term, count(*) AS n, min(doc_id * 1000000 + pos) AS first FROM w GROUP BY term) "
       "SELECT term, row_number() OVER (ORDER BY n DESC, first) - 1 AS idx, n FROM c "
       "QUALIFY idx < 500")
def vocab_first_seen(spark, d):
    return tt.first_seen_vocabulary(table(spark, d, "documents"), "doc_id", ["text"], 500)


_BY_LANG = ("w AS (SELECT doc_id, lang, unnest(" + sql_tokens("text", SHORT_STOP) + ") AS term FROM documents), "
            "tf AS (SELECT doc_id, lang, term, count(*) AS tf FROM w GROUP BY ALL), "
            "v AS (SELECT lang, term, CAST(sum(tf) AS BIGINT) AS n, count(*) AS doc_freq FROM tf GROUP BY ALL "
            "HAVING sum(tf) >= 5), "
            "idf AS (SELECT lang, term, n, doc_freq, row_number() OVER (PARTITION BY lang ORDER BY term) - 1 AS idx, "
            "ln(((SELECT count(*) FROM documents) + 1.0e0) / (doc_freq + 1.0e0)) + 1.0e0 AS idf FROM v)")


def _lang_terms(spark, d):
    return tt.term_table(table(spark, d, "documents"), "doc_id", ["text"], stop=SHORT_STOP, keep=["lang"])


@query(f"WITH {_BY_LANG} SELECT lang, term, idx, n, doc_freq FROM idf")
def vocab_per_group_minfreq5(spark, d):
    vocabulary = tt.full_vocabulary(tt.count_terms(_lang_terms(spark, d), ["lang"]), 5, by="lang")
    return vocabulary.select("lang", "term", "idx", "n", "doc_freq")


_DOC_VOCAB = ("w AS (SELECT doc_id, unnest(" + sql_tokens("text", ENGLISH_STOP, 2) + ") AS term FROM documents), "
              "tf AS (SELECT doc_id, term, count(*) AS tf FROM w GROUP BY ALL), "
              "c AS (SELECT term, CAST(sum(tf) AS BIGINT) AS n, count(*) AS doc_freq FROM tf GROUP BY term "
              "HAVING count(*) >= 3 ORDER BY n DESC, term LIMIT 400), "
              "v AS (SELECT *, row_number() OVER (ORDER BY term) - 1 AS idx, "
              "ln(((SELECT count(*) FROM documents) + 1.0e0) / (doc_freq + 1.0e0)) + 1.0e0 AS idf FROM c)")


def _doc_terms(spark, d):
    return tt.term_table(table(spark, d, "documents"), "doc_id", ["text"], stop=ENGLISH_STOP, min_len=2)


@query(f"WITH {_DOC_VOCAB} SELECT term, idx, n, doc_freq FROM v")
def vocab_mindf_maxfeat(spark, d):
    return tt.document_vocabulary(tt.count_terms(_doc_terms(spark, d)), 3, 400).select("term", "idx", "n", "doc_freq")


@query(f"WITH {_POOLED}, r AS (SELECT 'd' || doc_id AS key, 'a' AS col, 0 AS ord, text FROM documents UNION ALL "
       "SELECT 'c-' || conv_id || '-' || turn, 'b', 100, text FROM conversations), "
       "x AS (SELECT key, col, ord, unnest(" + sql_tokens("text") + ") AS term FROM r) "
       "SELECT key, col, ord + idx AS idx, CAST(count(*) AS DOUBLE) AS value FROM x JOIN top USING (term) "
       "WHERE idx < 100 GROUP BY key, col, ord, idx")
def bow_pooled(spark, d):
    rows = two_text_columns(spark, d)
    vocabulary = tt.pooled_vocabulary(rows, ["a", "b"], 100)
    terms = tt.term_table(rows, "key", ["a", "b"])
    return tt.bag_of_words(terms, vocabulary, 100).select(F.col("row_id").alias("key"), "col", "idx", "value")


def _lang_vocabulary(spark, d):
    """Vocabulary per language with IDF over all documents."""
    docs = table(spark, d, "documents")
    vocabulary = tt.full_vocabulary(tt.count_terms(_lang_terms(spark, d), ["lang"]), 5, by="lang")
    return tt.add_idf(vocabulary, docs.agg(F.count(F.lit(1))).scalar())


@query(f"WITH {_BY_LANG} SELECT lang, term, doc_freq, round(idf, 6) AS idf FROM idf")
def idf_smoothed(spark, d):
    return _lang_vocabulary(spark, d).select("lang", "term", "doc_freq", F.round("idf", 6).alias("idf"))


@query(f"WITH {_BY_LANG} SELECT doc_id, lang, term, round(ln(1.0e0 + tf) * idf, 6) AS weight "
       "FROM tf JOIN idf USING (lang, term)")
def tfidf_log1p(spark, d):
    vocabulary = _lang_vocabulary(spark, d)
    weights = tt.term_weights(_lang_terms(spark, d), vocabulary, by="lang", tf="log1p")
    return weights.select(F.col("row_id").alias("doc_id"), "lang", "term", F.round("value", 6).alias("weight"))


@query(f"WITH {_DOC_VOCAB}, x AS (SELECT doc_id, idx, (1.0e0 + ln(tf)) * idf AS w FROM tf JOIN v USING (term)) "
       "SELECT doc_id, idx, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM x")
def tfidf_l2(spark, d):
    terms = _doc_terms(spark, d)
    n_docs = table(spark, d, "documents").agg(F.count(F.lit(1))).scalar()
    vocabulary = tt.add_idf(tt.document_vocabulary(tt.count_terms(terms), 3, 400), n_docs)
    weights = tt.term_weights(terms, vocabulary, tf="sublinear", norm="l2")
    return weights.select(F.col("row_id").alias("doc_id"), "idx", F.round("value", 6).alias("weight"))


@query("WITH w AS (SELECT doc_id, unnest(" + sql_tokens("text") + ") AS term FROM documents), "
       "tf AS (SELECT doc_id, term, count(*) AS tf FROM w GROUP BY ALL), "
       "v AS (SELECT term, row_number() OVER (ORDER BY sum(tf) DESC, term) - 1 AS idx FROM tf GROUP BY term), "
       "e AS (SELECT term, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS dim "
       "FROM v JOIN embeddings ON idx = vec_id), "
       "m AS (SELECT doc_id, dim, sum(tf * CAST(x AS DOUBLE)) / sum(tf) AS x FROM tf JOIN e USING (term) GROUP BY ALL) "
       "SELECT doc_id, dim, round(coalesce(x, 0), 6) + 0.0e0 AS x "
       "FROM (SELECT doc_id, unnest(range(1, 65)) AS dim FROM documents) LEFT JOIN m USING (doc_id, dim)")
def avg_embedding(spark, d):
    """The n-th vector is the word vector of the n-th most frequent word."""
    docs = table(spark, d, "documents")
    vecs = table(spark, d, "embeddings")
    terms = tt.term_table(docs, "doc_id", ["text"])
    vocabulary = tt.top_vocabulary(tt.count_terms(terms), vecs.count())
    words = materialize(vocabulary.join(vecs, vocabulary["idx"] == vecs["vec_id"]).select(
        F.col("term").alias("word"), F.col("embedding").alias("vec")))
    means = vectors.zero_filled(docs, vectors.average_vectors(terms, words, 64), "doc_id", 1, 64)
    return (means.select(F.col("row_id").alias("doc_id"), F.posexplode("vec").alias("pos", "v"))
            .select("doc_id", (F.col("pos") + 1).cast("long").alias("dim"), (F.round("v", 6) + 0.0).alias("x")))


@query("SELECT 'w' || vec_id AS word, dim, round(CAST(x AS DOUBLE), 6) AS x FROM (SELECT vec_id, "
       "unnest(embedding) AS x, generate_subscripts(embedding, 1) AS dim FROM embeddings) WHERE vec_id % 13 <> 0")
def embedding_text_scan(spark, d):
    """Vectors written as text lines, every 13th with an unreadable number, read back."""
    rows = table(spark, d, "embeddings").select(
        F.concat(F.lit("w"), "vec_id").alias("word"),
        F.when(F.col("vec_id") % 13 == 0, F.array(F.lit("1"), F.lit("x"), F.lit("2")))
        .otherwise(F.col("embedding").cast("array<string>")).alias("vec"))
    path = scratch(spark)
    wordvectors.write_word_vectors(rows, path)
    back = wordvectors.read_word_vectors(spark, path)
    return (back.select("word", F.posexplode("vec").alias("pos", "v"))
            .select("word", (F.col("pos") + 1).cast("long").alias("dim"),
                    F.round(F.col("v").cast("double"), 6).alias("x")))
