"""Section I and text features: tokens, stop words, lemmas, TF-IDF."""

from __future__ import annotations

from pyspark.sql import functions as F

from hirelattice.functions import text as x
from hirelattice.operators import olap
from hirelattice.operators import tokens as tok
from hirelattice.operators.tfidf import tfidf, vocabulary, term_counts
from hirelattice.queries import Tables, query
from hirelattice.queries.matchers import _tokens_cte
from hirelattice.sources.loads import layer_path


@query("i1_tokenize", f"with {_tokens_cte('x', 'documents', 'doc_id', 'text')} select doc_id, token from x")
def i1(t: Tables):
    return tok.tokens(t("documents"), "doc_id", "text", t.bind("stopwords"))


CUSTOM = ", ".join(f"('{w}')" for w in tok.CUSTOM_STOPWORDS)


@query("i2_stopwords_with_custom", f"""
    with s as (select word from stopwords union select * from (values {CUSTOM}) as c(word)),
    w as (select conv_id, unnest(string_split(lower(text), ' ')) as token from conversations)
    select token, count(*) as n from w where token not in (select word from s) group by 1""")
def i2(t: Tables):
    words = t("conversations").select(F.explode(F.split(F.lower("text"), " ")).alias("token"))
    stop = tok.with_custom(t.bind("stopwords")).withColumnRenamed("word", "token")
    return words.join(stop, "token", "left_anti").groupBy("token").agg(F.count("*").alias("n"))


# a lemma dictionary by rule: plural words of the conversations lose their s
LEMMAS = """select distinct w as word, left(w, length(w) - 1) as lemma from (
    select unnest(string_split(regexp_replace(strip_accents(lower(text)), '[^a-z0-9]+', ' ', 'g'), ' ')) as w from conversations)
    where length(w) > 3 and w like '%s'"""


@query("i3_lemmatize", f"""
    with lem as ({LEMMAS}),
    p as (select conv_id, turn, string_split(trim(regexp_replace(strip_accents(lower(text)), '[^a-z0-9]+', ' ', 'g')), ' ') as a from conversations),
    w as (select conv_id, turn, generate_subscripts(a, 1) as pos, unnest(a) as word from p),
    l as (select w.*, coalesce(lem.lemma, w.word) as l from w left join lem using (word)
          where word <> '' and not regexp_full_match(word, '[0-9]+') and word not in (select word from stopwords)),
    k as (select * from l where length(l) >= 2 and l not in (select word from stopwords)),
    j as (select conv_id, turn, string_agg(l, ' ' order by pos) as text from k group by 1, 2)
    select c.conv_id * 1000 + c.turn as id, coalesce(j.text, '') as text from conversations c left join j using (conv_id, turn)""")
def i3(t: Tables):
    conv = t("conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "text")
    words = conv.select(F.explode(F.split(F.regexp_replace(x.clean_v2(F.col("text")), "[^a-z0-9]+", " "), " ")).alias("word"))
    lemmas = words.filter("length(word) > 3 and word like '%s'").distinct().withColumn("lemma", F.expr("left(word, length(word) - 1)"))
    return x.lemmatize(conv, "id", "text", lemmas, t.bind("stopwords"))


@query("i5_layer_paths", """
    select n_name, case when n_regionkey = 0 then 'silver' else lower(r_name) end || '/' || lower(n_name) as path
    from nation join region on n_regionkey = r_regionkey""")
def i5(t: Tables):
    rows = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    layer = F.when(F.col("n_regionkey") != 0, F.col("r_name"))
    # the path rule is the loader's own, said for a table of tables
    default = layer_path(None, "x").split("/")[0]
    return rows.select("n_name", F.concat_ws("/", F.lower(F.trim(F.coalesce(layer, F.lit(default)))), F.lower("n_name")).alias("path"))


@query("d18_token_frequency", f"with {_tokens_cte('x', 'documents', 'doc_id', 'text')} select token as value, count(*) as n from x group by 1")
def d18(t: Tables):
    return olap.value_counts(tok.tokens(t("documents"), "doc_id", "text", t.bind("stopwords")), "token")


def _terms(source, id_column, bigrams):
    runs = " union all select {0}, w[p] || ' ' || w[p + 1] from (select {0}, w, unnest(range(1, len(w))) as p from words)".format(id_column) if bigrams else ""
    return f"""words as (select {id_column}, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}') as w from {source}),
    terms as (select {id_column}, unnest(w) as term from words{runs}),
    tf as (select {id_column}, term, count(*) as tf from terms group by 1, 2)"""


TFIDF = """
    v as (select term, count(*) as df, sum(tf) as total, (select count(*) from {src}) as n from tf group by 1),
    k as (select term, df, ln((1.0 + n) / (1.0 + df)) + 1 as idf from v where {cond} {top}),
    w as (select {id}, term, tf * idf as w from tf join k using (term))
    select {id}, term, round(w / sqrt(sum(w * w) over (partition by {id})), 6) as weight from w"""


@query("k1_tfidf", f"with {_terms('documents', 'doc_id', False)}, " + TFIDF.format(
    src="documents", id="doc_id", cond="df >= 2 and df <= 0.5 * n", top="order by total desc, term limit 500"))
def k1(t: Tables):
    return tfidf(t("documents"), "doc_id", "text", (1, 1), 2, 0.5, 500).withColumn("weight", F.round("weight", 6))


@query("k1_tfidf_bigrams", f"with {_terms('benchmark', 'item_id', True)}, " + TFIDF.format(src="benchmark", id="item_id", cond="df >= 1", top=""))
def k1b(t: Tables):
    return tfidf(t("benchmark"), "item_id", "text", (1, 2)).withColumn("weight", F.round("weight", 6))


@query("k1_vocabulary", f"""with {_terms('documents', 'doc_id', False)}
    select term, count(*) as df from tf group by 1 having count(*) >= 3 order by sum(tf) desc, term limit 200""")
def k1v(t: Tables):
    docs = t("documents")
    return vocabulary(term_counts(docs, "doc_id", "text"), docs.agg(F.count("*")).scalar(), 3, 1.0, 200).select("term", "df")
