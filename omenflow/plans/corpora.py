"""Queries on text, records, linguistics, retrieval, decoding and generation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import forecasts as fc
from ..functions import text as tx
from ..operators import corpus, frames, learning, linguistic, matching, providers, rows, sequences, similarity
from .catalog import JUDGED, LOWER, TOKENS, judged, load, query, rounded

SPACE = r"[ \t\n\x0B\f\r]"


def cases(spark, schema: str, *values):
    """A table of known inputs."""
    return spark.createDataFrame(list(values), schema)


#: Contractions by row, and what they become; the last stays as it is.
SHORT = ("can't", "don't", "won't", "I'm", "it's", "they'll", "weren't", "we've", "y'all")
LONG = ("cannot", "do not", "will not", "I am", "it is", "they will", "were not", "we have", "y'all")


@query("SELECT c_custkey, c_name || ' ' || ([" + ", ".join("'" + x.replace("'", "''") + "'" for x in LONG) + "])[c_custkey % 9 + 1] || ' rise (' || c_mktsegment || ') can''t. ' || ([" + ", ".join("'" + x.replace("'", "''") + "'" for x in LONG) + "])[c_nationkey % 9 + 1] AS expanded FROM customer")
def expanded_contractions(spark, d):
    """Contractions written out, token by token: not those with a full stop behind."""
    pick = lambda k: F.get(F.array(*map(F.lit, SHORT)), (F.col(k) % 9).cast("int"))
    text = F.concat("c_name", F.lit("   "), pick("c_custkey"), F.lit(" rise  ("), "c_mktsegment", F.lit(") can't. "), pick("c_nationkey"))
    return load(spark, d, "customer").select("c_custkey", tx.expand(text, fc.CONTRACTIONS).alias("expanded"))


@query(rf"SELECT doc_id, regexp_replace(text, '[^a-zA-Z \t\n\x0B\f\r]', ' ', 'g') AS letters FROM documents")
def letters_only(spark, d):
    """All but letters as spaces."""
    return load(spark, d, "documents").select("doc_id", tx.letters_only(F.col("text")).alias("letters"))


@query(r"SELECT page_id, trim(regexp_replace(regexp_replace(html, '<[^<>]*>', ' ', 'g'), '[ \t\n\x0B\f\r]+', ' ', 'g'), ' ') AS plain FROM pages")
def tagless_pages(spark, d):
    """Marked-up text without its tags (F8)."""
    return load(spark, d, "pages").select("page_id", tx.without_tags(F.col("html")).alias("plain"))


@query("SELECT doc_id, len(list_filter(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x, ' ')), lambda x: x <> ''))::INT AS n FROM documents")
def answer_lines(spark, d):
    """An answer's lines that aren't blank."""
    return load(spark, d, "documents").select("doc_id", F.size(tx.lines(F.col("text"))).alias("n"))


@query("SELECT doc_id, len(string_split(text, ' '))::INT AS n FROM documents WHERE text IS NOT NULL")
def single_space_pieces(spark, d):
    """Pieces between single spaces, empty ones too."""
    return load(spark, d, "documents").where("text is not null").select("doc_id", F.size(tx.pieces(F.col("text"))).alias("n"))


@query("SELECT n_nationkey, (n_nationkey * 7)::INT AS version, n_nationkey % 2 = 0 AS dated FROM nation")
def file_versions(spark, d):
    """Versions and dates read from names."""
    k = (F.col("n_nationkey") * 7).cast("string")
    name = F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("run-2024-08-21-v"), k, F.lit(".csv"))).when(F.col("n_nationkey") % 3 == 0, F.concat(F.lit("run_v"), k)).otherwise(F.concat(F.lit("run-"), k, F.lit(".csv")))
    return load(spark, d, "nation").select("n_nationkey", tx.version_of(name).alias("version"), tx.dated(name).alias("dated"))


NAMED = "concat(c_mktsegment, CASE c_custkey % 4 WHEN 0 THEN concat('-v', c_custkey, '.csv') WHEN 1 THEN concat('-', c_custkey, '.json') WHEN 2 THEN concat('_v', c_custkey) ELSE concat('-old', c_custkey, '.csv') END)"


@query(f"SELECT {NAMED} AS name, c_custkey::INT AS version FROM customer WHERE c_mktsegment = 'BUILDING' AND c_custkey % 4 < 3 ORDER BY c_custkey DESC LIMIT 1")
def latest_version(spark, d):
    """The file with the largest version."""
    from ..sources import readers

    return readers.latest(load(spark, d, "customer").select(F.expr(NAMED).alias("name")), "BUILDING")


@query("SELECT doc_id, CASE WHEN length(text) > 30 THEN substr(text, 1, 30) || '...' ELSE text END AS short FROM documents")
def shortened_texts(spark, d):
    """A title's first letters."""
    return load(spark, d, "documents").select("doc_id", fc.shortened(F.col("text")).alias("short"))


BRACKETED = "CASE c_custkey % 4 WHEN 0 THEN concat('[', c_name, ']') WHEN 1 THEN concat(c_name, ' [', c_mktsegment, '] [') WHEN 2 THEN c_name ELSE concat(']]', c_mktsegment, '[[]') END"


@query(f"SELECT c_custkey, replace(replace({BRACKETED}, '[', ''), ']', '') AS bare FROM customer")
def bare_brackets(spark, d):
    """Brackets taken off."""
    return load(spark, d, "customer").select("c_custkey", fc.without_brackets(F.expr(BRACKETED)).alias("bare"))


#: Entity labels and terms of each kind, made of a row's own values: ``i`` is its id, ``n`` its length, ``w`` its first word.
ENTITY_LABELS = ("LOC", "LOC_1", "LOCATION", "FAC", "WORK_OF_ART", "CARDINAL", "ORG")
ENTITY_TERMS = "w, concat('Q', n % 4 + 1, ' of ', 2000 + n % 30), concat('Quarter ', n % 4 + 1), concat(n % 40, '°C'), concat('-', n % 9 + 1, '°F'), concat(n % 28 + 1, ' November ', 1990 + n % 40), 'Weather Underground', concat(n % 12, ' °C')"


@query(r"""WITH e AS (SELECT doc_id, doc_id AS i, n_chars AS n, regexp_extract(coalesce(text, ''), '[^ \t\n\x0B\f\r]+') AS w FROM documents),
t AS (SELECT doc_id, ([""" + ", ".join(f"'{x}'" for x in ENTITY_LABELS) + """])[i % 7 + 1] AS label, ([""" + ENTITY_TERMS + r"""])[i // 7 % 8 + 1] AS term FROM e)
SELECT doc_id, label, term, CASE WHEN label = 'LOC' OR starts_with(label, 'LOC_') THEN 'GPE' WHEN label = 'FAC' THEN 'PERSON'
WHEN label = 'WORK_OF_ART' AND regexp_matches(term, '^(Q[0-9] of [0-9]{4}|Quarter [0-9]|[0-9] Q[0-9])') THEN 'DATE' WHEN label = 'WORK_OF_ART' AND term = 'Weather Underground' THEN 'ORG'
WHEN label = 'CARDINAL' AND regexp_matches(term, '^[0-9]{1,2} [a-zA-Z]+ [0-9]{4}') THEN 'DATE' WHEN label = 'CARDINAL' AND regexp_matches(term, '^-?[0-9]+°[CF]') THEN 'TEMPERATURE' ELSE label END AS corrected FROM t""")
def corrected_entities(spark, d):
    """Entity labels put right by rules, over entities cut from documents (F16)."""
    word = F.regexp_extract(F.coalesce("text", F.lit("")), rf"[^ \t\n\x0B\f\r]+", 0)
    e = load(spark, d, "documents").select("doc_id", F.col("doc_id").alias("i"), F.col("n_chars").alias("n"), word.alias("w"))
    label = F.get(F.array(*map(F.lit, ENTITY_LABELS)), (F.col("i") % 7).cast("int"))
    term = F.get(F.expr(f"array({ENTITY_TERMS})"), (F.floor(F.col("i") / 7) % 8).cast("int"))
    return e.select("doc_id", label.alias("label"), term.alias("term")).withColumn("corrected", tx.corrected_entity(F.col("label"), F.col("term")))


@query("SELECT doc_id, regexp_replace(strip_accents(text), '[^A-Za-z .,;'']', '', 'g') AS letters FROM documents")
def ascii_texts(spark, d):
    """Letters without accents."""
    return load(spark, d, "documents").select("doc_id", fc.ascii_letters("text").alias("letters"))


BETS = "CASE c_custkey % 6 WHEN 0 THEN concat('they bet $', c_custkey, ',000 $5 on it') WHEN 1 THEN concat('$', c_custkey, ' or ', '$7') WHEN 2 THEN 'no stake' WHEN 3 THEN concat('$ ', c_custkey) WHEN 4 THEN concat('for $', c_acctbal) ELSE concat(c_name, ' $1,000,000   $', c_custkey, ' $3') END"


@query(rf"SELECT c_custkey, regexp_extract({BETS}, '\$[0-9,]+(\s+\$[0-9,]+)?') AS stake FROM customer")
def stake_amounts(spark, d):
    """Amounts read from text."""
    return load(spark, d, "customer").select("c_custkey", fc.stakes(F.expr(BETS)).alias("stake"))


@query("SELECT o_orderkey, CASE WHEN year(o_orderdate) >= 2000 THEN strftime(o_orderdate, '%Y/%m/%d') || '|' || year(o_orderdate)::VARCHAR || ' Q3' ELSE '' END AS dates FROM orders")
def dates_in_text(spark, d):
    """Dates in sentences by rules."""
    text = F.concat(F.lit("From "), F.date_format("o_orderdate", "yyyy/MM/dd"), F.lit(" to "), F.date_format("o_orderdate", "yyyy"), F.lit(" Q3 or later"))
    return load(spark, d, "orders").select("o_orderkey", F.array_join(fc.dates_in(text), "|").alias("dates"))


@query("SELECT n_nationkey, 'Task: judge' || chr(10) || 'Sentence: ' || n_name || chr(10) || 'Answer with 0 or 1.' AS prompt FROM nation")
def composed_prompts(spark, d):
    """Prompts from a template."""
    return load(spark, d, "nation").select("n_nationkey", tx.composed("Task: {task}\nSentence: {text}\nAnswer with 0 or 1.", task=F.lit("judge"), text=F.col("n_name")).alias("prompt"))


@query()
def name_codes(spark, d):
    """Names by how they sound."""
    return load(spark, d, "nation").select("n_nationkey", F.soundex("n_name").alias("code"))


@query(r"""WITH l AS (SELECT DISTINCT page_id, url, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS l FROM pages), b AS (SELECT *, regexp_extract(url, '^([^:/?#]+://[^/?#]*)', 1) AS host, regexp_replace(url, '[?#].*$', '') AS plain FROM l),
p AS (SELECT *, regexp_extract(plain[len(host) + 1:], '^(.*/)', 1) AS dir FROM b) SELECT page_id, l AS link, CASE WHEN regexp_matches(l, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN l WHEN starts_with(l, '/') THEN host || l ELSE host || (CASE WHEN dir = '' THEN '/' ELSE dir END) || l END AS whole,
'n=' || len(l) || '&page=' || page_id AS params FROM p""")
def absolute_links(spark, d):
    """Links of pages made whole, and parameters of a url."""
    found = load(spark, d, "pages").select("page_id", "url", F.explode(F.regexp_extract_all("html", F.lit(r'href="([^"]*)"'), 1)).alias("link")).distinct()
    pairs = F.create_map(F.lit("page"), F.col("page_id").cast("string"), F.lit("n"), F.length("link").cast("string"))
    return found.select("page_id", "link", fc.absolute(F.col("link"), F.col("url")).alias("whole"), fc.query_string(pairs).alias("params"))


@query("SELECT doc_id, contains(lower(coalesce(text, '')), 'the') AS has FROM documents")
def keyword_containment(spark, d):
    """A word anywhere in a text."""
    return load(spark, d, "documents").select("doc_id", fc.contains_pattern(F.col("text"), "the").alias("has"))


@query("""SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN '' WHEN 1 THEN c_name WHEN 2 THEN c_name || ', ' || c_mktsegment ELSE '' END AS no_property, CASE c_custkey % 5 WHEN 1 THEN 'it''s here, b' WHEN 3 THEN c_mktsegment ELSE '' END AS source,
CASE c_custkey % 5 WHEN 3 THEN c_name ELSE '' END AS target, CASE c_custkey % 5 WHEN 4 THEN c_nationkey::VARCHAR ELSE '' END AS date, CASE c_custkey % 5 WHEN 4 THEN c_name || ', ' || c_name ELSE '' END AS outcome FROM customer""")
def extracted_properties(spark, d):
    """Properties from answers that print a dict of lists, or don't."""
    k, name, segment, nation = F.col("c_custkey") % 5, F.col("c_name"), F.col("c_mktsegment"), F.col("c_nationkey").cast("string")
    said = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))
    answer = F.when(k == 0, said("no dict of ", name)).when(k == 1, said("{0: ['", name, "'], 1: ['it's here', 'b'], '2': []}")).when(k == 2, said("{'0': ['", name, "', '", segment, "']}"))
    answer = answer.when(k == 3, said('{"1": ["', segment, '"], "2": ["', name, '"]}')).otherwise(said("{3: ['", nation, "'], 4: ['", name, "', '", name, "']}"))
    return providers.extracted(load(spark, d, "customer").withColumn("answer", answer), "c_custkey", "answer")


@query("SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN c_name || ', b c' WHEN 1 THEN c_mktsegment WHEN 2 THEN '' END AS first, CASE c_custkey % 4 WHEN 1 THEN c_name || ', ' || c_nationkey WHEN 0 THEN '' END AS second FROM customer")
def loose_properties(spark, d):
    """The same where items stand without quotes."""
    k = F.col("c_custkey") % 4
    said = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))
    text = F.when(k == 0, said("{0: [", F.col("c_name"), ", b c], '1': []}")).when(k == 1, said('{"1": [', F.col("c_name"), ' , "', F.col("c_nationkey").cast("string"), "\"], 0:['", F.col("c_mktsegment"), "']}")).when(k == 2, "{0: [ , ]}").otherwise(F.col("c_name"))
    m = fc.loose_lists(text)
    return load(spark, d, "customer").select("c_custkey", m["0"].alias("first"), m["1"].alias("second"))


def users(spark, d):
    text = F.when(F.col("c_custkey") % 10 == 0, "broken").otherwise(F.concat(F.lit("{'handle': '"), "c_name", F.lit("', 'followers': "), F.col("c_custkey").cast("string"), F.lit("}")))
    return load(spark, d, "customer").select("c_custkey", text.alias("profile"))


@query("SELECT c_custkey, c_name AS handle, c_custkey::INT AS followers FROM customer WHERE c_custkey % 10 <> 0")
def expanded_users(spark, d):
    """Printed profiles as columns."""
    return fc.read_users(users(spark, d), "profile", "handle STRING, followers INT")[0]


@query("SELECT c_custkey, 'broken' AS profile FROM customer WHERE c_custkey % 10 = 0")
def unreadable_users(spark, d):
    """Profiles that can't be read."""
    return fc.read_users(users(spark, d), "profile", "handle STRING, followers INT")[1]


def event_records(spark, d):
    event = lambda kind: F.concat(F.lit('{"Event": "'), kind, F.lit('", "Time": "t'), F.col("n_nationkey").cast("string"), F.lit('", "Subject": "'), F.col("n_name"), F.lit('"}'))
    kind = F.when(F.col("n_nationkey") % 2 == 0, "prediction").otherwise("report")
    return load(spark, d, "nation").select("n_nationkey", F.concat(F.lit('{"title": "'), "n_name", F.lit('", "event_list_extraction": [['), event(kind), F.lit("], ["), event(F.lit("other")), F.lit("]]}")).alias("record"))


@query("SELECT n_nationkey, n_name AS title FROM nation WHERE n_nationkey % 2 = 0")
def nested_events(spark, d):
    """Records with a word in any value of any nested event."""
    return fc.nested_events(event_records(spark, d), "record").select("n_nationkey", "title")


@query("SELECT n_name AS title, 't' || n_nationkey AS time, NULL::VARCHAR AS location, n_name AS subject, NULL::VARCHAR AS object FROM nation WHERE n_nationkey % 2 = 0")
def flat_events(spark, d):
    """Nested events of a kind as rows."""
    return fc.flat_events(fc.nested_events(event_records(spark, d), "record"))


@query("""WITH t AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN regexp_extract(text, '[0-9]{1,7}([.][0-9]+)?') WHEN 1 THEN (n_chars // 7) || '.' || n_chars % 10 WHEN 2 THEN lang ELSE n_chars || ' ' END AS raw FROM documents)
SELECT doc_id, raw, coalesce(trunc(try_cast(raw AS DOUBLE))::INT, -1) AS number FROM t""")
def coerced_numbers(spark, d):
    """Numbers read from what documents have, -1 where they can't be."""
    found = F.regexp_extract("text", r"[0-9]{1,7}(?:[.][0-9]+)?", 0)
    n, i = F.col("n_chars"), F.col("doc_id") % 4
    raw = F.when(i == 0, found).when(i == 1, F.concat(F.floor(n / 7).cast("string"), F.lit("."), (n % 10).cast("string"))).when(i == 2, F.col("lang")).otherwise(F.concat(n.cast("string"), F.lit(" ")))
    return load(spark, d, "documents").select("doc_id", raw.alias("raw")).withColumn("number", fc.number_or(F.col("raw")))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderdate END AS parsed FROM orders")
def parsed_timestamps(spark, d):
    """Timestamps read from text."""
    raw = F.when(F.col("o_orderkey") % 7 == 0, "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"))
    return load(spark, d, "orders").select("o_orderkey", F.try_to_timestamp(raw).alias("parsed"))


@query("SELECT event_type, strftime(max(ts), '%Y-%m-%d') AS run_day, count(*) FILTER (ts >= date_trunc('day', ts)) AS n FROM events GROUP BY event_type")
def run_date(spark, d):
    """The day of each kind's last run, as runs are named."""
    e = load(spark, d, "events")
    return e.groupBy("event_type").agg(fc.run_day(F.max("ts")).alias("run_day"), F.count_if(F.col("ts") >= F.date_trunc("day", "ts")).alias("n"))


@query("SELECT n_nationkey, n_nationkey::FLOAT AS x, -1::FLOAT AS z, 3 AS n FROM nation")
def printed_vectors(spark, d):
    """Vectors read from print."""
    v = fc.printed_vector(F.concat(F.lit("["), F.col("n_nationkey").cast("string"), F.lit(" 0.5  -1.0]")))
    return load(spark, d, "nation").select("n_nationkey", F.get(v, F.lit(0)).alias("x"), F.get(v, F.lit(2)).alias("z"), F.size(v).alias("n"))


@query("SELECT event_id, round(1 / (1 + exp(-value / 100)), 6) AS exact, round(pow(2.718, value / 100) / (pow(2.718, value / 100) + 1), 6) AS rough FROM events")
def squashed_values(spark, d):
    """The sigmoid, with e and with another base."""
    x = F.col("value") / 100
    return load(spark, d, "events").select("event_id", F.round(fc.sigmoid(x), 6).alias("exact"), F.round(fc.sigmoid(x, 2.718), 6).alias("rough"))


@query("SELECT event_id, round(value, 4) AS value FROM events")
def restored_scale(spark, d):
    """Scaled values brought back."""
    e = load(spark, d, "events")
    stats = e.agg(F.avg("value").alias("m"), F.stddev_pop("value").alias("s"))
    m, s = stats.select("m").scalar(), stats.select("s").scalar()
    return e.select("event_id", F.round(fc.restored(fc.standardized(F.col("value"), m, s), m, s), 4).alias("value"))


@query("SELECT n_nationkey, len(n_name)::INT AS letters, instr('abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ .,;''', n_name[1])::INT - 1 AS first FROM nation")
def letter_places(spark, d):
    """Letters by their places in an alphabet."""
    places = tx.letter_places(F.col("n_name"))
    return load(spark, d, "nation").select("n_nationkey", F.size(places).alias("letters"), F.get(places, F.lit(0)).alias("first"))


@query("SELECT doc_id, sha256(coalesce(text, '')) AS id FROM documents")
def content_ids(spark, d):
    """Ids from contents, and all else as a map."""
    return similarity.stores(load(spark, d, "documents").select("doc_id", "text"), "text").select(F.col("meta")["doc_id"].cast("long").alias("doc_id"), "id")


@query("SELECT c_custkey, 'WHO: ' || c_name || '; NUMBER: ' || c_name[10:] || '; WHAT: ' || c_mktsegment AS marked FROM customer")
def marked_spans(spark, d):
    """Marked pieces of a text."""
    n, m = F.length("c_name"), F.length("c_mktsegment")
    mark = lambda a, b, label: F.struct(a.alias("start"), b.alias("end"), F.lit(label).alias("label"))
    marks = F.array(mark(m + 1, m + 1 + n, "WHO"), mark(m + 10, m + 1 + n, "NUMBER"), mark(F.lit(0), m, "WHAT"))
    pieces = tx.spans(F.concat("c_mktsegment", F.lit(" "), "c_name", F.lit(" will rise")), marks)
    return load(spark, d, "customer").select("c_custkey", F.array_join(F.transform(pieces, lambda x: F.concat(x["label"], F.lit(": "), x["piece"])), "; ").alias("marked"))


# Linguistics and features


@query(f"SELECT term, coalesce(sum(n) FILTER (lang = 'de'), 0)::BIGINT AS de, coalesce(sum(n) FILTER (lang = 'en'), 0)::BIGINT AS en, coalesce(sum(n) FILTER (lang = 'es'), 0)::BIGINT AS es, coalesce(sum(n) FILTER (lang = 'fr'), 0)::BIGINT AS fr FROM (SELECT lang, term, count(*) AS n FROM (SELECT lang, unnest({LOWER}) AS term FROM documents) GROUP BY ALL) GROUP BY term")
def term_document_matrix(spark, d):
    """Terms against groups of documents, 0 where there is none."""
    counts = load(spark, d, "documents").select("lang", F.explode(tx.tokens(F.lower("text"))).alias("term")).groupBy("lang", "term").agg(F.count("*").alias("n"))
    return frames.matrix(counts, "term", "lang", "n", ["de", "en", "es", "fr"])


@query("WITH t AS (SELECT role AS a, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS b FROM conversations) SELECT a, coalesce(sum((b = 'assistant')::INT), 0)::BIGINT AS assistant, coalesce(sum((b = 'user')::INT), 0)::BIGINT AS \"user\" FROM t WHERE b IS NOT NULL GROUP BY a")
def cooccurrence_matrix(spark, d):
    """Neighbouring pairs as a matrix, 0 where there is none."""
    t = rows.transitions(load(spark, d, "conversations"), "conv_id", "turn", "role").withColumnRenamed("state", "a")
    return frames.matrix(t, "a", "next_state", "n", ["assistant", "user"])


@query(f"WITH t AS (SELECT doc_id, {LOWER} AS t FROM documents), f AS (SELECT doc_id, len(t) AS size, unnest(t) AS term FROM t), c AS (SELECT doc_id, term, any_value(size) AS size, count(*) AS tf FROM f GROUP BY doc_id, term), a AS (SELECT term, sum(tf) AS n FROM c GROUP BY term) SELECT doc_id, term, round(tf / size * ln((SELECT count(*) FROM documents) / (n + 1)), 6) AS score FROM c JOIN a USING (term)")
def smoothed_idf(spark, d):
    """TF-IDF by occurrences in all."""
    return rounded(corpus.smoothed_idf(load(spark, d, "documents")), "score")


@query(f"WITH t AS (SELECT doc_id, {LOWER} AS t FROM documents), p AS (SELECT doc_id, len(t) AS n, len(list_filter(t, lambda x: x = 'the')) AS a, len(list_filter(t, lambda x: x = 'und')) AS b FROM t) SELECT doc_id, round(coalesce(2 * a / nullif(n, 0) * ((CASE WHEN a > 0 THEN 0 ELSE ln(1e6) END) - 3) * 3 + b / nullif(n, 0) * ((CASE WHEN b > 0 THEN 0 ELSE ln(1e6) END) - 1), 0), 6) AS score FROM p")
def keyword_scores(spark, d):
    """A query's weighted score in each document."""
    return rounded(corpus.keyword_score(load(spark, d, "documents"), ["the", "und", "the"], {"the": 3.0}), "score")


@query("SELECT doc_id, " + ", ".join(f"round(coalesce(list_avg(list_transform({LOWER}, lambda w: (ord(w) % {i + 2})::DOUBLE)), 0), 6) AS v{i}" for i in range(4)) + " FROM documents")
def mean_word_vectors(spark, d):
    """The mean of a text's word vectors, zeros if it has none."""
    docs = load(spark, d, "documents")
    words = docs.select(F.explode(tx.tokens(F.lower("text"))).alias("word")).distinct()
    table = words.withColumn("vector", F.array(*((F.ascii("word") % (i + 2)).cast("float") for i in range(4))))
    out = matching.mean_of_words(docs, "doc_id", tx.tokens(F.lower("text")), table, 4)
    return out.select("doc_id", *(F.round(F.get("vector", F.lit(i)), 6).alias(f"v{i}") for i in range(4)))


@query(f"SELECT doc_id, array_to_string({TOKENS.format('text')}, ' ') AS words FROM documents WHERE text IS NOT NULL")
def split_words(spark, d):
    """Sentences as words."""
    return load(spark, d, "documents").where("text is not null").select("doc_id", F.array_join(tx.tokens(F.col("text")), " ").alias("words"))


@query("SELECT doc_id, n_chars::DOUBLE AS first, embedding[1]::DOUBLE AS second, len(embedding)::INT + 1 AS n FROM documents JOIN embeddings ON doc_id = vec_id")
def joined_features(spark, d):
    """Features side by side in one vector."""
    v = load(spark, d, "embeddings").withColumnRenamed("vec_id", "doc_id")
    both = load(spark, d, "documents").join(v, "doc_id")
    x = F.concat(F.array(F.col("n_chars").cast("double")), F.col("embedding").cast("array<double>"))
    return both.select("doc_id", F.get(x, F.lit(0)).alias("first"), F.get(x, F.lit(1)).alias("second"), F.size(x).alias("n"))


@query(f"SELECT lang, source, count(*) AS n FROM documents WHERE lang IS NOT NULL AND source IS NOT NULL GROUP BY ALL")
def graph_edges(spark, d):
    """Edges of a graph with their weights."""
    return load(spark, d, "documents").na.drop(subset=["lang", "source"]).groupBy("lang", "source").agg(F.count("*").alias("n"))


@query("SELECT count(*) AS sentences FROM documents")
def validated_count(spark, d):
    """As many tense rows as sentences."""
    docs = load(spark, d, "documents")
    tokens = docs.select("doc_id", F.explode(tx.tokens(F.concat_ws(" ", F.lit("x"), "text"))).alias("w"), F.lit("X").alias("pos"), F.lit("XX").alias("tag"))
    return frames.same_length(docs, sequences.tense(tokens, "doc_id")).withColumnRenamed("rows", "sentences")


#: A customer's sentence, and whether it forecasts.
SAID = ("{n} will rise", "{n} rose", "the can of {n} is full", "{n} can move", "in May {n} fell", "it may move {n}", "his will was with {n}", "{n} should not go", "MUST {n} fall?")
FORECASTS = (1, 0, 0, 1, 0, 1, 0, 1, 1)


@query("SELECT c_custkey, ([" + ", ".join(map(str, FORECASTS)) + "])[c_custkey % 9 + 1]::INT AS future FROM customer")
def modal_tense(spark, d):
    """Sentences with a future modal, found by tokens' parts of speech and tags."""
    text = F.get(F.array(*(tx.composed(t, n=F.col("c_name")) for t in SAID)), (F.col("c_custkey") % len(SAID)).cast("int"))
    return sequences.tense(linguistic.tokens(load(spark, d, "customer").select("c_custkey", text.alias("text")), "c_custkey", "text"), "c_custkey")


@query("""SELECT c_custkey, 'DATE' AS label, CASE WHEN c_custkey % 3 = 0 THEN 'Q' || (c_custkey % 4 + 1) || ' 20' || (10 + c_nationkey) ELSE '20' || (10 + c_nationkey) END AS term FROM customer
UNION ALL SELECT c_custkey, 'PERCENT', c_custkey || '%' FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT c_custkey, 'CARDINAL', c_custkey::VARCHAR FROM customer WHERE c_custkey % 2 = 1
UNION ALL SELECT c_custkey, 'MONEY', '$' || c_nationkey || CASE WHEN c_custkey % 5 = 0 THEN ' million' ELSE '' END FROM customer""")
def found_entities(spark, d):
    """Entities with their places by rules (L2, L3)."""
    k, nation = F.col("c_custkey"), F.col("c_nationkey")
    share = F.concat(k.cast("string"), F.when(k % 2 == 0, "%").otherwise(" points"))
    money = F.concat(F.lit("$"), nation.cast("string"), F.when(k % 5 == 0, " million").otherwise(" or so"))
    year = F.concat(F.when(k % 3 == 0, F.concat(F.lit("Q"), (k % 4 + 1).cast("string"), F.lit(" 20"))).otherwise("20"), (10 + nation).cast("string"))
    text = F.concat(F.lit("profits fall by "), share, F.lit(" to "), money, F.lit(" in "), year)
    return linguistic.entities(load(spark, d, "customer").select("c_custkey", text.alias("text")), "c_custkey", "text").select("c_custkey", "label", "term")


# Retrieval, pairs, groups


SEARCH = f"""WITH t AS (SELECT doc_id, {LOWER} AS t FROM documents), f AS (SELECT doc_id, unnest(t) AS term FROM t), tf AS (SELECT doc_id, term, count(*) AS tf FROM f GROUP BY ALL),
s AS (SELECT count(*) AS n, avg(len(t)) AS a FROM t), i AS (SELECT term, ln(n - count(*) + 0.5) - ln(count(*) + 0.5) AS raw FROM tf, s GROUP BY term, n),
x AS (SELECT term, CASE WHEN raw < 0 THEN 0.25 * (SELECT avg(raw) FROM i) ELSE raw END AS idf FROM i),
q AS (SELECT query_id, term, count(*) AS qn FROM (SELECT item_id AS query_id, unnest({LOWER}) AS term FROM benchmark) GROUP BY ALL),
b AS (SELECT query_id, doc_id, sum(qn * idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len(t) / a))) AS score FROM tf JOIN x USING (term) JOIN q USING (term) JOIN t USING (doc_id), s GROUP BY ALL),
l AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS r FROM b) """


def lexical(spark, d, k: int = 10):
    return corpus.bm25_search(load(spark, d, "documents"), load(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), "text"), k)


@query(SEARCH + "SELECT query_id, doc_id, round(score, 4) AS score FROM l WHERE r <= 10")
def lexical_search(spark, d):
    """The best documents of every query by BM25."""
    return lexical(spark, d).withColumn("score", F.round("score", 4))


@query(SEARCH + """, e AS (SELECT a.vec_id AS query_id, b.vec_id AS doc_id, list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS score FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE a.vec_id IN (SELECT item_id FROM benchmark)),
d AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS r FROM e), u AS (SELECT query_id, doc_id, max(score) AS score FROM (SELECT query_id, doc_id, score FROM l WHERE r <= 10 UNION ALL SELECT query_id, doc_id, score FROM d WHERE r <= 10) GROUP BY ALL),
h AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rank FROM u), k AS (SELECT query_id, doc_id, score - 0.001 * n_chars AS score FROM h JOIN documents USING (doc_id) WHERE rank <= 15)
SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id)::INT AS rank FROM k QUALIFY rank <= 5""")
def hybrid_search(spark, d):
    """Lexical and dense lists joined, then ranked again by another score."""
    v = load(spark, d, "embeddings")
    asked = v.join(load(spark, d, "benchmark").select(F.col("item_id").alias("vec_id")), "vec_id", "left_semi")
    dense = corpus.nearest(v, asked, 10).select("query_id", F.col("vec_id").alias("doc_id"), F.col("cosine").alias("score"))
    found = similarity.hybrid(lexical(spark, d), dense, 15).join(load(spark, d, "documents").select("doc_id", "n_chars"), "doc_id")
    return matching.reranked(found.withColumnRenamed("score", "first"), F.col("first") - 0.001 * F.col("n_chars"), 5).select("query_id", "doc_id", "rank")


@query(SEARCH + "SELECT query_id, string_agg(doc_id::VARCHAR, ' ' ORDER BY r) AS matches FROM l WHERE r <= 3 GROUP BY query_id")
def match_table(spark, d):
    """What was found for each query, as lists."""
    from pyspark.sql.window import Window

    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc(F.round("score", 9)), "doc_id"))
    return matching.with_observations(lexical(spark, d, 3).withColumn("rank", rank), "query_id", "rank", "doc_id").withColumn("matches", F.array_join(F.transform("matches", lambda x: x.cast("string")), " "))


@query("SELECT item_id, 'Use only these pieces:' || chr(10) || ' - ' || text || chr(10) || 'Is it true?' AS prompt FROM benchmark")
def retrieval_prompts(spark, d):
    """Prompts from what was found."""
    found = load(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), F.lit(1).alias("rank"), "text", F.lit("Is it true?").alias("question"))
    return similarity.prompts(found, "question", "text").withColumnRenamed("query_id", "item_id")


@query("SELECT text, doc_id, lang, source FROM documents")
def packed_rows(spark, d):
    """A text and all else in one column."""
    return matching.packed(load(spark, d, "documents").select("doc_id", "text", "lang", "source"), "text").select("text", "meta.*")


@query()
def all_searches(spark, d):
    """Every kind of search over a store."""
    v = load(spark, d, "embeddings")
    return matching.Store(v).query(v.where("vec_id % 50 = 0"), "all", 5, 0.3)


@query("SELECT a.n_nationkey AS a, b.n_nationkey AS b, round((jaro_winkler_similarity(a.n_name, b.n_name) + (a.n_regionkey = b.n_regionkey)::INT) / 2, 6) AS score FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey < b.n_nationkey")
def resolution_scores(spark, d):
    """Pairs of a block by the mean of several likenesses."""
    n = load(spark, d, "nation")
    a, b = n.alias("a"), n.alias("b")
    pairs = a.join(b, (F.col("a.n_regionkey") == F.col("b.n_regionkey")) & (F.col("a.n_nationkey") < F.col("b.n_nationkey")))
    of = lambda x: {"name": F.col(f"{x}.n_name"), "region": F.col(f"{x}.n_regionkey")}
    score = matching.comparison(of("a"), of("b"), {"name": fc.jaro_winkler, "region": lambda x, y: (x == y).cast("int")})
    return pairs.select(F.col("a.n_nationkey").alias("a"), F.col("b.n_nationkey").alias("b"), F.round(score, 6).alias("score"))


@query("SELECT a.item_id AS a, b.item_id AS b, round(coalesce(list_cosine_similarity(x.embedding::DOUBLE[], y.embedding::DOUBLE[]), 0), 5) AS likeness FROM benchmark a JOIN benchmark b ON b.item_id = a.item_id + 1 JOIN embeddings x ON x.vec_id = a.item_id JOIN embeddings y ON y.vec_id = b.item_id")
def text_likeness(spark, d):
    """Likeness of texts by their vectors."""
    e = load(spark, d, "benchmark").join(load(spark, d, "embeddings"), F.col("item_id") == F.col("vec_id")).select("item_id", "embedding")
    pairs = e.select(F.col("item_id").alias("a"), F.col("embedding").alias("x")).join(e.select(F.col("item_id").alias("b"), F.col("embedding").alias("y")), F.col("b") == F.col("a") + 1)
    return pairs.select("a", "b", F.round(similarity.cosine(F.col("x"), F.col("y")), 5).alias("likeness"))


@query("SELECT c_custkey, s_suppkey, 1 AS label FROM customer JOIN supplier ON c_nationkey = s_nationkey WHERE c_acctbal > s_acctbal")
def certified_pairs(spark, d):
    """Pairs of a block that a judge accepts."""
    c = load(spark, d, "customer").select("c_custkey", "c_acctbal", F.col("c_nationkey").alias("nation"))
    pairs = matching.sharing(c, load(spark, d, "supplier").select("s_suppkey", "s_acctbal", F.col("s_nationkey").alias("nation")), "nation")
    return matching.certified(pairs, (F.col("c_acctbal") > F.col("s_acctbal")).cast("int")).select("c_custkey", "s_suppkey", "label")


@query("WITH RECURSIVE e AS (SELECT a.p_partkey AS a, b.p_partkey AS b FROM part a JOIN part b ON b.p_partkey = a.p_partkey + 1 AND a.p_size + b.p_size > 50), r AS (SELECT p_partkey AS node, p_partkey AS least FROM part UNION SELECT e.b, r.least FROM r JOIN e ON e.a = r.node) SELECT node, min(least) AS cluster FROM r GROUP BY node")
def linked_groups(spark, d):
    """Single-link clusters as connected components."""
    p = load(spark, d, "part").select(F.col("p_partkey").alias("a"), F.col("p_size").alias("x"))
    pairs = p.join(p.select((F.col("a") - 1).alias("a"), F.col("a").alias("b"), F.col("x").alias("y")), "a").where(F.col("x") + F.col("y") > 50).select("a", "b")
    return matching.linked_groups(pairs, p.select(F.col("a").alias("node")))


# Decoding, models, generation


def hmm(spark, d) -> tuple:
    """Words (a turn's number modulo 5), and the model of roles: transitions and emissions."""
    c = load(spark, d, "conversations").select("conv_id", "turn", "role", (F.col("turn") % 5).cast("string").alias("word"))
    words = c.select(F.col("conv_id").alias("sequence"), F.col("turn").alias("pos"), "word")
    return words, rows.transitions(c, "conv_id", "turn", "role"), sequences.emissions(c, "role", "word")


@query("""WITH RECURSIVE c AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k, turn, role, (turn % 5)::VARCHAR AS word FROM conversations),
em AS (SELECT role AS s, word, count(*) / sum(count(*)) OVER (PARTITION BY role) AS p FROM c GROUP BY role, word),
tr AS (SELECT a, b, n / sum(n) OVER (PARTITION BY a) AS p FROM (SELECT a, b, count(*) AS n FROM (SELECT role AS a, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS b FROM c) WHERE b IS NOT NULL GROUP BY a, b)),
st AS (SELECT DISTINCT role AS s FROM c), w AS (SELECT DISTINCT word FROM c),
first AS (SELECT word, arg_max(s, q) AS tag FROM (SELECT w.word, st.s, coalesce(em.p, 1e-6) AS q FROM w CROSS JOIN st LEFT JOIN em ON em.s = st.s AND em.word = w.word ORDER BY st.s) GROUP BY word),
step AS (SELECT prev, word, arg_max(s, q) AS tag FROM (SELECT a.s AS prev, w.word, st.s, coalesce(tr.p, 1e-6) * coalesce(em.p, 1e-6) AS q FROM st a CROSS JOIN w CROSS JOIN st LEFT JOIN tr ON tr.a = a.s AND tr.b = st.s LEFT JOIN em ON em.s = st.s AND em.word = w.word ORDER BY st.s) GROUP BY prev, word),
g AS (SELECT conv_id, k, turn, c.word, tag FROM c JOIN first USING (word) WHERE k = 1 UNION ALL SELECT c.conv_id, c.k, c.turn, c.word, step.tag FROM g JOIN c ON c.conv_id = g.conv_id AND c.k = g.k + 1 JOIN step ON step.prev = g.tag AND step.word = c.word)
SELECT conv_id AS sequence, turn AS pos, word, tag FROM g""")
def greedy_decoding(spark, d):
    """Tags found step by step (C17)."""
    return sequences.decode(*hmm(spark, d), greedy=True)


@query("""WITH RECURSIVE c AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k, turn, role, (turn % 5)::VARCHAR AS word FROM conversations),
em AS (SELECT role AS s, word, count(*) / sum(count(*)) OVER (PARTITION BY role) AS p FROM c GROUP BY role, word),
tr AS (SELECT a, b, n / sum(n) OVER (PARTITION BY a) AS p FROM (SELECT a, b, count(*) AS n FROM (SELECT role AS a, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS b FROM c) WHERE b IS NOT NULL GROUP BY a, b)),
st AS (SELECT DISTINCT role AS s FROM c), w AS (SELECT DISTINCT word FROM c),
says AS (SELECT w.word, list(ln(coalesce(em.p, 1e-6)) ORDER BY st.s) AS e FROM w CROSS JOIN st LEFT JOIN em ON em.s = st.s AND em.word = w.word GROUP BY w.word),
moves AS (SELECT list(r ORDER BY b) AS m, (SELECT list(s ORDER BY s) FROM st) AS names FROM (SELECT y.s AS b, list(ln(coalesce(tr.p, 1e-6)) ORDER BY x.s) AS r FROM st x CROSS JOIN st y LEFT JOIN tr ON tr.a = x.s AND tr.b = y.s GROUP BY y.s)),
v AS (SELECT conv_id, k, e AS best, list_transform(range(1, len(e) + 1), lambda s: [s]) AS paths FROM c JOIN says USING (word) WHERE k = 1
UNION ALL SELECT c.conv_id, c.k, list_transform(range(1, len(e) + 1), lambda s: list_max(list_transform(range(1, len(e) + 1), lambda a: best[a] + m[s][a])) + e[s]),
list_transform(range(1, len(e) + 1), lambda s: list_append(paths[list_position(list_transform(range(1, len(e) + 1), lambda a: best[a] + m[s][a]), list_max(list_transform(range(1, len(e) + 1), lambda a: best[a] + m[s][a])))], s))
FROM v JOIN c ON c.conv_id = v.conv_id AND c.k = v.k + 1 JOIN says ON says.word = c.word, moves),
l AS (SELECT conv_id, paths[list_position(best, list_max(best))] AS path FROM v QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY k DESC) = 1)
SELECT c.conv_id AS sequence, turn AS pos, word, names[path[k]] AS tag FROM l JOIN c USING (conv_id), moves""")
def best_paths(spark, d):
    """Tags of the best path."""
    return sequences.decode(*hmm(spark, d))


@query()
def mixture_clusters(spark, d):
    """Clusters by a mixture of Gaussians on a few dimensions."""
    v = load(spark, d, "embeddings").withColumn("embedding", F.slice("embedding", 1, 4))
    return learning.clusters(learning.features(v, "embedding"), 3, mixture=True).select("vec_id", "cluster")


@query()
def validated_models(spark, d):
    """Mean and deviation of a model's accuracy over folds."""
    rows_ = learning.features(load(spark, d, "embeddings").withColumn("y", (F.col("label") % 2).cast("int")), "embedding", "y")
    return learning.cross_validated(rows_, "ridge", "vec_id").agg(F.avg("accuracy").alias("mean"), F.stddev_samp("accuracy").alias("std"))


@query("""WITH r AS (SELECT DISTINCT c_nationkey % 5 + 1 AS b, c_mktsegment AS m FROM customer) SELECT b::INT AS batch_id, m AS domain, model_name, sentence AS base_sentence, 1 AS sentence_label
FROM r, LATERAL (SELECT 'echo' AS model_name, 'T' || t || ': Write of ' || m || ', batch ' || b AS sentence FROM (VALUES (1), (2), (3)) z(t) UNION ALL SELECT 'loud', upper('Write of ' || m || ', batch ' || b))""")
def generated_batches(spark, d):
    """Sentences of several batches, domains and providers, keyed by a table's rows."""
    runs = load(spark, d, "customer").select((F.col("c_nationkey") % 5 + 1).alias("batch_id"), F.col("c_mktsegment").alias("domain"))
    ask = {"echo": providers.provider("echo"), "loud": lambda prompts: [p.upper() for p in prompts]}
    return providers.batches(runs, ask, "Write of {domain}, batch {batch}", 1)


@query(JUDGED + "SELECT subject AS doc_id, CASE WHEN max(n) > 1 THEN (list(value ORDER BY n DESC, last DESC))[1]::VARCHAR ELSE 'None as all are different labels' END AS vote FROM (SELECT subject, value, count(*) AS n, max(rater) AS last FROM r GROUP BY ALL) GROUP BY subject")
def voted_labels(spark, d):
    """The label that most judges gave."""
    long = frames.stacked(judged(spark, d), "doc_id", ["quality", "long_text", "even_id", "clean"]).withColumnsRenamed({"rater": "model", "value": "label"})
    return providers.voted(long, "doc_id")


ENTAILED = "CASE WHEN n_regionkey = 0 THEN '' WHEN n_nationkey % 3 = 0 THEN 'It won''t rise.' WHEN n_nationkey % 3 = 1 THEN n_name || ' will rise.' ELSE 'Somebody said so.' END"


@query(f"WITH t AS (SELECT n_nationkey, n_name || ' will rise.' AS prediction, {ENTAILED} AS observation FROM nation) SELECT n_nationkey, prediction, observation, CASE WHEN contains(observation, prediction) THEN 'ENTAILMENT' WHEN contains(observation, 'won''t') THEN 'CONTRADICTION' ELSE 'NEUTRAL' END AS entailment FROM t")
def entailed_pairs(spark, d):
    """Pairs of predictions and observations labelled by a provider that gives one of three answers."""
    seen = F.when(F.col("n_regionkey") == 0, "").when(F.col("n_nationkey") % 3 == 0, "It won't rise.").when(F.col("n_nationkey") % 3 == 1, F.concat("n_name", F.lit(" will rise."))).otherwise("Somebody said so.")
    pairs = load(spark, d, "nation").select("n_nationkey", F.concat("n_name", F.lit(" will rise.")).alias("prediction"), seen.alias("observation"))
    asked = pairs.withColumn("_p", tx.composed("Does the second line follow?\n{a}\n{b}", a=F.col("prediction"), b=F.col("observation")))
    return providers.answered(asked, "_p", providers.line_judge, "entailment").drop("_p")


@query("SELECT doc_id, length(text)::FLOAT AS x, (length(text) - length(replace(text, ' ', '')))::FLOAT AS y FROM documents WHERE text IS NOT NULL")
def provided_vectors(spark, d):
    """Vectors from an encoder that the caller names."""
    docs = load(spark, d, "documents").where("text is not null").select("doc_id", "text")
    made = similarity.embedded(docs, "text", lambda texts: [[len(t), t.count(" ")] for t in texts])
    return made.select("doc_id", F.get("embedding", F.lit(0)).alias("x"), F.get("embedding", F.lit(1)).alias("y"))
