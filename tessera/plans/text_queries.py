"""Text, sentiment and page queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import ordered as O
from ..operators import pages as PG
from ..operators import text as TX
from ..operators.panel import group_score_mean, ordered_digest, parts_digest, parts_digest_sql
from .fixtures import SQL_DAILY_ORDERS, SQL_NEWS, daily_orders, news
from .registry import query, round_doubles, table

_STOP = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in X.STOP_WORDS) + "]"
_CLEAN = r"regexp_replace(lower(regexp_replace({t}, 'https?://\S+', '', 'g')), '[^a-z0-9\-+%\s]', '', 'g')"


def _tok_sql(t: str) -> str:
    s = f"regexp_replace({t}, '%', ' % ', 'g')"
    s = f"regexp_replace({s}, '--', ' -- ', 'g')"
    for w, parts in X.CONTRACTION_SPLITS:
        s = f"regexp_replace({s}, '\\b{w}\\b', '{parts}', 'g')"
    return rf"list_filter(string_split_regex(trim({s}), '\s+'), lambda x: x <> '')"


def _stop_sql(toks: str) -> str:
    return f"list_filter({toks}, lambda x: NOT list_contains({_STOP}, x))"


_TOKS = _stop_sql(_tok_sql(_CLEAN.format(t="text")))


@query("clean_text", f"SELECT doc_id, {_CLEAN.format(t='text')} AS cleaned FROM documents")
def q_clean_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.clean_text(F.col("text")).alias("cleaned"))


@query("tokenize", f"""SELECT doc_id, CAST(len(t) AS INT) AS n_tokens, md5(array_to_string(t, '|')) AS tokens_md5
FROM (SELECT doc_id, {_tok_sql(_CLEAN.format(t='text'))} AS t FROM documents)""")
def q_tokenize(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", X.tokenize(X.clean_text(F.col("text"))).alias("t"))
    return d.select("doc_id", F.size("t").alias("n_tokens"), F.md5(F.array_join("t", "|")).alias("tokens_md5"))


@query("remove_stopwords", f"""SELECT doc_id, CAST(len(t) AS INT) AS n_tokens, md5(array_to_string(t, '|')) AS tokens_md5
FROM (SELECT doc_id, {_TOKS} AS t FROM documents)""")
def q_remove_stopwords(spark, sf):
    d = TX.tokens_of(table(spark, sf, "documents"), "text", "t")
    return d.select("doc_id", F.size("t").alias("n_tokens"), F.md5(F.array_join("t", "|")).alias("tokens_md5"))


_LEMMA_SQL = f"""toks AS (SELECT doc_id, {_TOKS} AS t FROM documents),
vocab AS (SELECT DISTINCT unnest(t) AS form FROM toks),
cands AS ({" UNION ALL ".join(
    f"SELECT form, {i} AS rule, substr(form, 1, length(form) - {len(s)}) || '{r}' AS lemma FROM vocab "
    f"WHERE suffix(form, '{s}') AND length(form) >= {len(s)}" for i, (s, r) in enumerate(TX.NOUN_SUFFIX_RULES))}),
lem AS (SELECT form, arg_min(lemma, length(lemma) * 100 + rule) AS lemma FROM cands WHERE lemma <> '' AND lemma IN (SELECT form FROM vocab) GROUP BY form),
ex AS (SELECT doc_id, t[g.pos] AS form, g.pos FROM toks, LATERAL (SELECT unnest(generate_series(1, len(toks.t))) AS pos) g),
lm AS (SELECT ex.doc_id, list(coalesce(lem.lemma, ex.form) ORDER BY pos) AS l FROM ex LEFT JOIN lem USING (form) GROUP BY ex.doc_id)"""


@query("lemmatize", f"""WITH {_LEMMA_SQL}
SELECT toks.doc_id, md5(array_to_string(coalesce(l, []), '|')) AS lemmas_md5 FROM toks LEFT JOIN lm USING (doc_id)""")
def q_lemmatize(spark, sf):
    t = TX.tokens_of(table(spark, sf, "documents").select("doc_id", "text"), "text")
    out = TX.lemmatize(t, "doc_id", "tokens")
    return out.select("doc_id", F.md5(F.array_join("lemmas", "|")).alias("lemmas_md5"))


@query("join_tokens", f"""SELECT doc_id, md5(array_to_string(t, ' ')) AS joined_md5, CAST(length(array_to_string(t, ' ')) AS INT) AS n_chars
FROM (SELECT doc_id, {_TOKS} AS t FROM documents)""")
def q_join_tokens(spark, sf):
    t = TX.tokens_of(table(spark, sf, "documents"), "text")
    j = X.join_tokens(F.col("tokens"))
    return t.select("doc_id", F.md5(j).alias("joined_md5"), F.length(j).alias("n_chars"))


def _noise_sql(c: str) -> str:
    low = f"lower({c})"
    whens = " ".join(f"WHEN instr({low}, '{n}') > 0 THEN trim(substr({low}, instr({low}, '{n}') + {len(n)}))"
                     for n in X.NOISE_SOURCES)
    return f"CASE {whens} ELSE {low} END"


@query("remove_noise", f"""SELECT doc_id, md5({_noise_sql("array_to_string(t, ' ')")}) AS text_md5
FROM (SELECT doc_id, {_TOKS} AS t FROM documents)""")
def q_remove_noise(spark, sf):
    t = TX.tokens_of(table(spark, sf, "documents"), "text")
    return t.select("doc_id", F.md5(X.remove_noise(X.join_tokens(F.col("tokens")))).alias("text_md5"))


@query("news_clean_chain", f"""WITH {SQL_NEWS}, {_LEMMA_SQL.replace("FROM documents", "FROM news")}
SELECT n.date, n.doc_id, md5({_noise_sql("array_to_string(coalesce(l, []), ' ')")}) AS text_md5
FROM news n LEFT JOIN lm USING (doc_id)""")
def q_news_clean_chain(spark, sf):
    out = TX.news_clean(news(spark, sf), "doc_id")
    return out.select("date", "doc_id", F.md5("joined_text").alias("text_md5"))


@query("text_split_strip", """SELECT doc_id, replace(trim(string_split(text, ' ')[2]), ',', '') AS word FROM documents""")
def q_text_split_strip(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.nth_word(F.col("text"), 2).alias("word"))


def _paras_sql(part: str) -> str:
    """Texts of the paragraphs of ``part``: from each start tag to its end or to what ends it, without tags, entities decoded."""
    own = rf"regexp_extract(p, '(?s)^(.*?)(?:</p>|</article>|</div>|<footer|<div|<h1|$)', 1)"
    text = rf"regexp_replace(regexp_replace({own}, '<br>', ' ', 'g'), '<[^>]+>', '', 'g')"
    for entity, char in (("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        text = f"replace({text}, '{entity}', '{char}')"
    text = rf"trim(regexp_replace({text}, '\s+', ' ', 'g'))"
    return rf"list_filter(list_transform(string_split_regex({part}, '<p(?:\s[^>]*)?>')[2:], lambda p: {text}), lambda p: p <> '')"


@query("join_paragraphs", f"""SELECT page_id, array_to_string({_paras_sql("html")}, chr(10)) AS text FROM pages""")
def q_join_paragraphs(spark, sf):
    got = PG.paragraphs(table(spark, sf, "pages"), ["page_id"], within=())
    return got.select("page_id", X.join_paragraphs(F.col("paragraphs"), "\n").alias("text"))


@query("truncate_tokens", f"""SELECT doc_id, CAST(len(t[1:512]) AS INT) AS n_tokens, md5(array_to_string(t[1:512], '|')) AS tokens_md5
FROM (SELECT doc_id, {_TOKS} AS t FROM documents)""")
def q_truncate_tokens(spark, sf):
    t = TX.tokens_of(table(spark, sf, "documents"), "text").withColumn("t", X.truncate_tokens(F.col("tokens"), 512))
    return t.select("doc_id", F.size("t").alias("n_tokens"), F.md5(F.array_join("t", "|")).alias("tokens_md5"))


@query("extract_links", r"""SELECT page_id, replace(CASE WHEN href LIKE '/%' THEN regexp_extract(url, '^(https?://[^/?#]+)', 1) || href ELSE href END, '&amp;', '&') AS link
FROM (SELECT page_id, url, unnest(regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1), '<a\s[^>]*href="([^"]*)"', 1)) AS href FROM pages)""")
def q_extract_links(spark, sf):
    return PG.extract_links(table(spark, sf, "pages"), within=(("nav", {}), ("ul", {})))


@query("extract_article", rf"""SELECT page_id, array_to_string(ps, ' ') AS article, CAST(len(ps) AS INT) AS n_paragraphs,
  CAST(CAST(try_strptime(nullif(regexp_extract(html, 'Published\s+([0-9]{{2}}-[0-9]{{2}}-[0-9]{{4}})', 1), ''), '%d-%m-%Y') AS DATE) AS TIMESTAMP) AS published
FROM (SELECT page_id, html, {_paras_sql("regexp_extract(html, '(?s)<article[^>]*>(.*?)</article>', 1)")} AS ps FROM pages)""")
def q_extract_article(spark, sf):
    return PG.extract_article(table(spark, sf, "pages"))


def price_pages(spark, sf):
    """History pages written from the daily orders series, one page per month, in the
    site's format (``Jun 4, 2025`` dates, ``24,620.20`` closes)."""
    d = daily_orders(spark, sf)
    rows = F.concat(F.lit("<tr><td>"), F.date_format("date", "MMM d, yyyy"), F.lit("</td><td>1</td><td>"),
                    F.format_number("value", 2), F.lit("</td></tr>"))
    g = d.groupBy(F.date_format("date", "yyyyMM").cast("long").alias("page_id")).agg(
        F.array_join(F.array_sort(F.collect_list(F.struct("date", rows.alias("r")))).getField("r"), "").alias("body"))
    return g.select("page_id", F.concat(F.lit("<table><tr><th>Date</th><th>Open</th><th>Close</th></tr>"),
                                        F.col("body"), F.lit("</table>")).alias("html"))


@query("extract_price_table", f"""WITH {SQL_DAILY_ORDERS}
SELECT CAST(strftime(date, '%Y%m') AS BIGINT) AS page_id, date, value AS close FROM daily""")
def q_extract_price_table(spark, sf):
    return PG.extract_price_table(price_pages(spark, sf))


def lexicon(spark, sf):
    return TX.word_lexicon(table(spark, sf, "documents"), table(spark, sf, "labels"))


_LEX_SQL = f"""lab AS (SELECT d.doc_id, l.quality, list_distinct({_TOKS}) AS t FROM documents d JOIN labels l USING (doc_id)),
lw AS (SELECT word, least(greatest(avg(quality) - (SELECT avg(quality) FROM labels), -1), 1) AS weight FROM (
  SELECT doc_id, quality, unnest(t) AS word FROM lab) GROUP BY word HAVING count(*) >= 2),
sc AS (SELECT doc_id, avg(weight) AS score FROM (SELECT doc_id, unnest(t) AS word FROM (
  SELECT doc_id, {_TOKS} AS t FROM documents)) JOIN lw USING (word) GROUP BY doc_id)"""


@query("score_texts", f"""WITH {_LEX_SQL} SELECT d.doc_id, round(sc.score, 6) AS score FROM documents d LEFT JOIN sc USING (doc_id)""")
def q_score_texts(spark, sf):
    s = TX.score_texts(table(spark, sf, "documents").select("doc_id", "text"), "doc_id", lexicon=lexicon(spark, sf))
    return round_doubles(s.select("doc_id", "score"))


@query("score_texts_model")
def q_score_texts_model(spark, sf):
    """Every document scored by a fitted model, whole texts in windows of 512 tokens."""
    d = table(spark, sf, "documents").select("doc_id", "text")
    load = TX.word_model(spark, *TX.fit_word_model(d, table(spark, sf, "labels")))
    return round_doubles(TX.score_with_model(TX.tokens_of(d, "text"), "doc_id", load, every=True).select("doc_id", "score"))


@query("daily_sentiment", f"""WITH {SQL_NEWS}, {_LEX_SQL},
own AS (SELECT date, doc_id, round(score, 6) AS score, coalesce(CAST(round(score, 6) AS VARCHAR), 'null') AS said FROM news LEFT JOIN sc USING (doc_id))
SELECT date, CAST(count(*) AS INT) AS n_news, round(avg(score), 6) AS mean_sentiment_score, any_value(scores_md5) AS scores_md5
FROM own JOIN {parts_digest_sql("own", "date", "said", "doc_id", "scores_md5")} USING (date) GROUP BY date""")
def q_daily_sentiment(spark, sf):
    s = TX.score_texts(news(spark, sf), "doc_id", lexicon=lexicon(spark, sf)).drop("text").withColumn("score", F.round("score", 6))
    s = s.withColumn("said", F.coalesce(F.col("score").cast("string"), F.lit("null")))
    s = s.select("date", "doc_id", "score", "said").checkpoint(eager=True)  # counted, cut and put in order: scored once
    items, means = TX.daily_sentiment(s, text="said")
    means = means.select("date", F.col("n_news").cast("int").alias("n_news"), "mean_sentiment_score")
    return round_doubles(O._join(means, parts_digest(items, "date", "news", "scores_md5"), ["date"]))


@query("group_score_mean", f"""WITH {SQL_NEWS}, {_LEX_SQL}
SELECT date, round(avg(score), 6) AS mean_sentiment_score, md5(string_agg(text, chr(31) ORDER BY doc_id)) AS news_md5
FROM news LEFT JOIN sc USING (doc_id) GROUP BY date""")
def q_group_score_mean(spark, sf):
    s = TX.score_texts(news(spark, sf), "doc_id", lexicon=lexicon(spark, sf))
    s = s.select("date", "doc_id", "score", "text").checkpoint(eager=True)  # counted, cut and put in order: scored once
    items, means = group_score_mean(s, "date", "text", "score", ["doc_id"])
    return round_doubles(O._join(means.select("date", "mean_sentiment_score"), ordered_digest(items, "date", "news", "\u001f", "news_md5"), ["date"]))
