"""Vocabularies, sequences, TF-IDF, label encoding, splits, classifiers and their evaluation."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from gazetick.functions.text import STOPWORDS, avg_word_length, char_count, clean_and_tokenize
from gazetick.operators import models as M
from gazetick.operators import textfeatures as T
from gazetick.operators.annotate import embed_text, zip_embeddings
from gazetick.operators.cooccur import token_embedding as embed_tokens
from gazetick.operators.svm import linear_svm as fit_svm
from gazetick.operators.svm import svm_scores
from gazetick.queries import sqltext as S
from gazetick.queries.registry import query, r6, sql_r6, table
from gazetick.session import stage

VOCAB = f"""words AS (SELECT doc_id, unnest(w) AS token, generate_subscripts(w, 1) AS pos FROM (SELECT doc_id, {S.sequence_tokens('text')} AS w FROM documents)),
    firsts AS (SELECT token, count(*) AS n, min((doc_id, pos)) AS place FROM words GROUP BY token),
    numbered AS (SELECT token, n, (row_number() OVER (ORDER BY place) + 1)::BIGINT AS id FROM firsts),
    vocab AS (SELECT token, id FROM numbered WHERE n >= 2)"""


def vocabulary(spark, sf):
    return T.build_vocab(table(spark, sf, "documents"), "doc_id", clean_and_tokenize(F.col("text")))


@query("build_vocab", f"WITH {VOCAB} SELECT token, id FROM vocab")
def build_vocab(spark, sf):
    return vocabulary(spark, sf)


@query("vocab_size", f"WITH {VOCAB} SELECT max(id) + 1 AS size FROM vocab")
def vocab_size(spark, sf):
    return T.vocab_size(vocabulary(spark, sf))


@query(
    "vocab_lookup",
    f"""WITH {VOCAB} SELECT doc_id, count(*) AS tokens, md5(string_agg(coalesce(id, 1)::VARCHAR, ' ' ORDER BY pos)) AS ids
    FROM words LEFT JOIN vocab USING (token) GROUP BY doc_id""",
)
def vocab_lookup(spark, sf):
    """Ids of all tokens of the whole texts, as a digest."""
    docs = table(spark, sf, "documents")
    ids = T.vocab_lookup(docs, "doc_id", clean_and_tokenize(F.col("text")), stage(vocabulary(spark, sf)))
    return ids.filter(F.size("ids") > 0).select("doc_id", F.size("ids").cast("bigint").alias("tokens"), F.md5(F.concat_ws(" ", F.col("ids").cast("array<string>"))).alias("ids"))


@query(
    "text_to_sequence",
    f"""WITH {VOCAB}, found AS (SELECT doc_id, pos, coalesce(id, 1) AS id FROM words LEFT JOIN vocab USING (token) WHERE pos <= 40),
    kept AS (SELECT doc_id, list(id ORDER BY pos) AS ids FROM found GROUP BY doc_id)
    SELECT doc_id, array_to_string(list_resize(coalesce(ids, []), 40, 0), ' ') AS sequence FROM documents LEFT JOIN kept USING (doc_id)""",
)
def text_to_sequence(spark, sf):
    """The reference's own cut at 40 tokens, padded with 0."""
    made = T.text_to_sequence(table(spark, sf, "documents"), "doc_id", "text", stage(vocabulary(spark, sf)))
    return made.select("doc_id", F.concat_ws(" ", F.col("sequence").cast("array<string>")).alias("sequence"))


def sql_grams(low: int, high: int, stop: bool = False) -> str:
    """Statements ``words1`` to ``grams (doc_id, n, pos, term)``."""
    ahead = ", ".join(f"lead(t, {k}) OVER (PARTITION BY doc_id ORDER BY pos) AS t{k}" for k in range(1, high)) or "1 AS one"
    sizes = [f"SELECT doc_id, {n} AS n, pos, {' || chr(32) || '.join(['t', *[f't{k}' for k in range(1, n)]])} AS term FROM ahead {f'WHERE t{n - 1} IS NOT NULL' if n > 1 else ''}" for n in range(low, high + 1)]
    return f"""words1 AS (SELECT doc_id, unnest(w) AS t, generate_subscripts(w, 1) AS pos FROM (SELECT doc_id, {S.terms('text', stop)} AS w FROM documents)),
    ahead AS (SELECT *, {ahead} FROM words1),
    grams AS ({' UNION ALL '.join(sizes)})"""


@query(
    "ngrams",
    f"""WITH {sql_grams(1, 3)}, joined AS (SELECT doc_id, count(*)::INTEGER AS n, md5(string_agg(term, '|' ORDER BY n, pos)) AS grams FROM grams GROUP BY doc_id)
    SELECT doc_id, coalesce(n, 0) AS n, coalesce(grams, md5('')) AS grams FROM documents LEFT JOIN joined USING (doc_id)""",
)
def ngrams(spark, sf):
    words = table(spark, sf, "documents").select("doc_id", T.terms(F.col("text")).alias("w"))
    grams = words.select("doc_id", T.ngrams(F.col("w"), 1, 3).alias("g"))
    return grams.select("doc_id", F.size("g").alias("n"), F.md5(F.array_join("g", "|")).alias("grams"))


def sql_tfidf(ngram=(1, 1), max_features=None, min_df=1, max_df=1.0, sublinear=False, stop=False, name="weights") -> str:
    tf = "ln(tf) + 1" if sublinear else "tf::DOUBLE"
    limit = f"QUALIFY row_number() OVER (ORDER BY corpus_tf DESC, term) <= {max_features}" if max_features else ""
    return f"""{sql_grams(*ngram, stop)},
    counts AS (SELECT doc_id, term, count(*) AS tf FROM grams GROUP BY doc_id, term),
    n AS (SELECT count(*)::DOUBLE AS n FROM documents),
    terms AS (SELECT term, count(*) AS df, sum(tf) AS corpus_tf FROM counts GROUP BY term),
    kept AS (SELECT term, ln((1 + n) / (1 + df)) + 1 AS idf FROM terms, n WHERE df >= {min_df} AND df <= n * {max_df}::DOUBLE {limit}),
    raw AS (SELECT doc_id, term, ({tf}) * idf AS w FROM counts JOIN kept USING (term)),
    {name} AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM raw)"""


# The reference's three matrices (trigrams, bigrams, topics), and single words.
TFIDF = {
    "tfidf_words": dict(ngram=(1, 1), max_features=5000),
    "tfidf_bigrams": dict(ngram=(1, 2), max_features=5000, min_df=2, max_df=0.95, sublinear=True, stop=True),
    "tfidf_trigrams": dict(ngram=(1, 3), max_features=50_000, min_df=2, sublinear=True),
    "tfidf_topics": dict(ngram=(1, 2), max_features=5000, min_df=2, max_df=0.95, stop=True),
}


def weights(spark, sf, stop=False, **options):
    return T.tfidf(table(spark, sf, "documents"), "doc_id", "text", stopwords=STOPWORDS if stop else None, **options)


def _tfidf(name, options):
    @query(name, f"WITH {sql_tfidf(**options)} SELECT doc_id, term, {sql_r6('weight')} AS weight FROM weights")
    def run(spark, sf):
        return weights(spark, sf, **options).withColumn("weight", r6("weight"))


for _name, _options in TFIDF.items():
    _tfidf(_name, _options)


@query("label_encode", "SELECT doc_id, (dense_rank() OVER (ORDER BY lang) - 1)::INTEGER AS label_idx FROM documents WHERE lang IS NOT NULL")
def label_encode(spark, sf):
    return T.label_encode(table(spark, sf, "documents").select("doc_id", "lang"), "lang").select("doc_id", "label_idx")


_STEP = """keep{i} AS (SELECT *, sum(n{i}) OVER () AS total, sum(n{i}) OVER () - ceil(sum(n{i}) OVER () * {size}::DOUBLE - 1e-9::DOUBLE)::BIGINT AS keep FROM {source}),
    share{i} AS (SELECT *, keep * n{i} // total AS low, row_number() OVER (ORDER BY keep * n{i} % total DESC, lang) AS place FROM keep{i}),
    part{i} AS (SELECT * EXCLUDE (total, keep, low, place), low + (place <= keep - sum(low) OVER ())::INTEGER AS p{i} FROM share{i})"""


@query(
    "stratified_split",
    f"""WITH classes AS (SELECT lang, count(*) AS n0 FROM documents GROUP BY lang), {_STEP.format(i=0, size=0.3, source='classes')},
    rest AS (SELECT *, n0 - p0 AS n1 FROM part0), {_STEP.format(i=1, size=0.5, source='rest')},
    placed AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY ('0x' || left(md5('42|' || doc_id), 15))::BIGINT, doc_id) AS place FROM documents)
    SELECT doc_id, CASE WHEN place <= p0 THEN 'train' WHEN place <= p0 + p1 THEN 'validation' ELSE 'test' END AS split
    FROM placed JOIN part1 USING (lang)""",
)
def stratified_split(spark, sf):
    return T.stratified_split(table(spark, sf, "documents").select("doc_id", "lang"), "lang", "doc_id").select("doc_id", "split")


def sparse(spark, sf, options=TFIDF["tfidf_bigrams"]):
    """Sparse rows of all documents, and the width of the matrix."""
    found = stage(weights(spark, sf, **options))
    index = stage(T.term_index(found))
    return stage(T.sparse_rows(found, index, "doc_id", table(spark, sf, "documents"))), index.count()


INDEXED = f"""{sql_tfidf(**TFIDF['tfidf_bigrams'])}, idx AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS idx FROM (SELECT DISTINCT term FROM weights))"""


@query(
    "sparse_rows",
    f"""WITH {INDEXED}, found AS (SELECT doc_id, string_agg(idx::VARCHAR, ' ' ORDER BY idx) AS idx, sum(weight * idx) AS total FROM weights JOIN idx USING (term) GROUP BY doc_id)
    SELECT doc_id, coalesce(idx, '') AS idx, {sql_r6('coalesce(total, 0)')} AS total FROM documents LEFT JOIN found USING (doc_id)""",
)
def sparse_rows(spark, sf):
    """Every document is a row, also without a kept term."""
    rows, _ = sparse(spark, sf)
    total = F.aggregate(F.zip_with("idx", "val", lambda i, v: i * v), F.lit(0.0), lambda s, x: s + x)
    return rows.select("doc_id", F.concat_ws(" ", F.col("idx").cast("array<string>")).alias("idx"), r6(total).alias("total"))


@query(
    "hstack_features",
    f"""WITH {INDEXED}, found AS (SELECT doc_id, count(*) AS n, sum(weight) AS total FROM weights GROUP BY doc_id),
    dense AS (SELECT doc_id, length(text)::DOUBLE AS chars, coalesce(length(array_to_string({S.split('text')}, ''))::DOUBLE / nullif(len({S.split('text')}), 0), 0) AS average FROM documents)
    SELECT doc_id, (coalesce(n, 0) + 2)::INTEGER AS n, ((SELECT count(*) FROM idx) + 1)::INTEGER AS last, {sql_r6('coalesce(total, 0) + chars + average')} AS total
    FROM dense LEFT JOIN found USING (doc_id)""",
)
def hstack_features(spark, sf):
    rows, width = sparse(spark, sf)
    dense = table(spark, sf, "documents").select("doc_id", char_count(F.col("text")).alias("chars"), avg_word_length(F.col("text")).alias("average"))
    both = M.hstack_features(rows, dense, "doc_id", width, ["chars", "average"])
    total = F.aggregate("val", F.lit(0.0), lambda s, x: s + x)
    return both.select("doc_id", F.size("idx").alias("n"), F.element_at("idx", -1).alias("last"), r6(total).alias("total"))


# --- classifiers -------------------------------------------------------------------------------


def quality_rows(spark, sf):
    """Sparse rows of all documents with their quality label, null where there is none."""
    rows, width = sparse(spark, sf)
    return stage(rows.join(table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label_idx")), "doc_id", "left")), width


@query(
    "multinomial_nb",
    f"""WITH {INDEXED}, train AS (SELECT doc_id, quality AS label FROM labels),
    sums AS (SELECT label, term, sum(weight) AS s FROM train JOIN weights USING (doc_id) GROUP BY label, term),
    classes AS (SELECT label, ln(count(*)::DOUBLE / sum(count(*)) OVER ()) AS prior FROM train GROUP BY label),
    mass AS (SELECT c.label, prior, coalesce(sum(s), 0) AS mass FROM classes c LEFT JOIN sums USING (label) GROUP BY c.label, prior),
    width AS (SELECT count(*) AS width FROM idx),
    cells AS (SELECT w.doc_id, m.label, sum(weight * (ln(coalesce(s, 0) + 1) - ln(mass + width))) AS gain
      FROM weights w CROSS JOIN mass m CROSS JOIN width LEFT JOIN sums USING (label, term) GROUP BY w.doc_id, m.label),
    scores AS (SELECT d.doc_id, m.label, prior + coalesce(gain, 0) AS score FROM documents d CROSS JOIN mass m LEFT JOIN cells c ON c.doc_id = d.doc_id AND c.label = m.label)
    SELECT doc_id, arg_max(label, (score, -label))::INTEGER AS prediction, {sql_r6('max(score)')} AS score FROM scores GROUP BY doc_id""",
)
def multinomial_nb(spark, sf):
    rows, width = quality_rows(spark, sf)
    scored = M.multinomial_nb(rows.filter("label_idx is not null"), rows, "doc_id", "label_idx", width)
    return scored.select("doc_id", "prediction", r6("score").alias("score"))


def _classifier(fit):
    def run(spark, sf):
        rows, width = quality_rows(spark, sf)
        vectors = M.to_vectors(rows, width)
        model = fit(vectors.filter("label_idx is not null"))
        return M.predict(model, vectors).select("doc_id", "label_idx", "prediction")

    return run


@query("linear_svm")
def linear_svm(spark, sf):
    rows, width = quality_rows(spark, sf)
    return svm_scores(fit_svm(rows, width), rows).select("doc_id", "label_idx", "prediction")


query("logistic_regression")(_classifier(M.logistic_regression))


# --- evaluation --------------------------------------------------------------------------------

REPORT = f"""y AS (SELECT quality AS y, toxic AS p FROM labels), total AS (SELECT count(*)::DOUBLE AS n FROM y),
    per AS (SELECT c.y, (SELECT count(*) FROM y WHERE y.y = c.y)::DOUBLE AS true_n, (SELECT count(*) FROM y WHERE y.p = c.y)::DOUBLE AS guessed,
      (SELECT count(*) FROM y WHERE y.y = c.y AND y.p = c.y)::DOUBLE AS hits FROM (SELECT DISTINCT y FROM y) c),
    rated AS (SELECT *, coalesce(hits / nullif(guessed, 0), 0) AS precision, coalesce(hits / nullif(true_n, 0), 0) AS recall FROM per),
    report AS (SELECT sum(hits) / n AS accuracy, sum(true_n * precision) / n AS precision, sum(true_n * recall) / n AS recall,
      sum(true_n * coalesce(2 * precision * recall / nullif(precision + recall, 0), 0)) / n AS f1 FROM rated, total GROUP BY n)"""


@query("classification_report", f"WITH {REPORT} SELECT {', '.join(f'{sql_r6(c)} AS {c}' for c in ('accuracy', 'precision', 'recall', 'f1'))} FROM report")
def classification_report(spark, sf):
    """Toxicity flags read as predictions of quality."""
    report = M.classification_report(table(spark, sf, "labels"), "quality", "toxic")
    return report.select(*[r6(c).alias(c) for c in report.columns])


@query(
    "best_models",
    f"""WITH parts AS (SELECT doc_id % 3 AS model, quality AS y, toxic AS p FROM labels)
    SELECT model, {sql_r6('avg((y = p)::INTEGER)')} AS accuracy, (row_number() OVER (ORDER BY avg((y = p)::INTEGER) DESC))::BIGINT AS place FROM parts GROUP BY model""",
)
def best_models(spark, sf):
    """Reports of three parts of the labels, best accuracy first."""
    parts = table(spark, sf, "labels").withColumn("model", F.col("doc_id") % 3)
    ordered = M.best_models(M.classification_report(parts, "quality", "toxic", ["model"]), "accuracy")
    return ordered.select("model", r6("accuracy").alias("accuracy"), (F.monotonically_increasing_id() + 1).alias("place"))


@query(
    "binary_eval",
    f"""WITH x AS (SELECT embedding[1]::DOUBLE AS x, label % 2 AS y FROM embeddings)
    SELECT {sql_r6('avg(greatest(x, 0) - x * y + ln(1 + exp(-abs(x))))')} AS loss, {sql_r6('avg(((x >= 0)::INTEGER = y)::INTEGER)')} AS accuracy FROM x""",
)
def binary_eval(spark, sf):
    x = table(spark, sf, "embeddings").select(F.col("embedding")[0].cast("double").alias("x"), (F.col("label") % 2).alias("y"))
    return M.binary_eval(x, "x", "y").select(r6("loss").alias("loss"), r6("accuracy").alias("accuracy"))


@query(
    "multiclass_eval",
    f"SELECT {sql_r6('avg((list_position(embedding, list_max(embedding)) - 1 = label)::INTEGER) * 100')} AS accuracy FROM embeddings",
)
def multiclass_eval(spark, sf):
    return M.multiclass_eval(table(spark, sf, "embeddings"), "embedding", "label").select(r6("accuracy").alias("accuracy"))


# --- embeddings and sequence models; trained in the job, so checked by rows and invariants ---------


@query(
    "zip_embeddings",
    f"""SELECT doc_id, len(embedding)::INTEGER AS size, {sql_r6('embedding[1]::DOUBLE')} AS first
    FROM documents LEFT JOIN embeddings ON doc_id = vec_id""",
)
def zip_embeddings_query(spark, sf):
    """Every document beside the vector of its id; documents outnumber vectors."""
    zipped = zip_embeddings(table(spark, sf, "documents").select("doc_id"), table(spark, sf, "embeddings"), "doc_id", "vec_id")
    size = F.when(F.col("embedding").isNotNull(), F.size("embedding"))
    return zipped.select("doc_id", size.alias("size"), r6(F.col("embedding")[0].cast("double")).alias("first"))


@query("embed_text")
def embed_text_query(spark, sf):
    """Vectors of all documents by reduced TF-IDF."""
    embedded = embed_text(table(spark, sf, "documents").select("doc_id", "text"), "doc_id", "text")
    return embedded.select("doc_id", "embedding")


VECTOR_SIZE = 256


def token_rows(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("y"))
    docs = table(spark, sf, "documents").select("doc_id", clean_and_tokenize(F.col("text")).alias("tokens"))
    return stage(docs.join(labels, "doc_id", "left"))


@query("token_embedding")
def token_embedding(spark, sf):
    vectors = embed_tokens(token_rows(spark, sf), "tokens", VECTOR_SIZE)
    return vectors.select("word", vector_to_array("vector").alias("vector"))


@query("token_classifier")
def token_classifier(spark, sf):
    """Quality of all documents from pooled token vectors, learned from the labelled ones."""
    docs = token_rows(spark, sf)
    vectors = stage(embed_tokens(docs, "tokens", VECTOR_SIZE))
    features = M.token_features(docs, "doc_id", "tokens", vectors, VECTOR_SIZE)
    model = M.token_classifier(features.filter("y is not null"))
    return M.predict(model, features).select("doc_id", "y", "prediction")
