"""The operators of this package as registered queries, with the SQL they must agree with."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.centroid_clusters import cluster
from tallyloom.llm.chat_format import format_chats, learned_text, text_parts, turn_texts
from tallyloom.llm.collocations import collocations
from tallyloom.llm.decontamination import decontaminate, n_hit
from tallyloom.llm.license_scan import scan_licences
from tallyloom.llm.license_scan import train as fit_licences
from tallyloom.llm.line_dedup import drop_common_lines
from tallyloom.llm.mixing import mix
from tallyloom.llm.quality_classifier import quality_scores, train
from tallyloom.llm.quality_rules import quality_rules
from tallyloom.llm.quality_rules import train as fit_lines
from tallyloom.llm.simhash import near_duplicates
from tallyloom.llm.token_counts import token_counts
from tallyloom.llm.toxicity import toxicity
from tallyloom.llm.toxicity import train as fit_examples
from tallyloom.llm.url_filters import filter_urls, host_of, path_of, patterns_of
from tallyloom.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """The parquet tables of a folder, read by attribute."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = configure(spark), root

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")


def query(fn):
    """Register ``fn(tables) -> DataFrame`` under its own name."""
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
    return fn


@query
def op8_token_counts(t):
    return token_counts(t.documents, public_tokenizers.path("word_bpe_49k.json"))


@query
def op3_simhash_near_dedup(t):
    found = near_duplicates(t.documents, shingle=3, radius=3)
    bits = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return found.select("doc_id", bits, "component_id")


@query
def op9_benchmark_decontamination(t):
    found = decontaminate(t.documents, t.benchmark, width=10, slop=2, near_terms=3)
    return found.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        n_hit(F.col("spans")).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("items") > 0).alias("contaminated"),
        F.size("near").cast("long").alias("n_near_items"),
    )


@query
def op1_quality_classifier(t):
    return quality_scores(t.documents, train(t.documents, t.labels, fit_rows=6000), threshold=0.7)


@query
def op10_quality_rules(t):
    return quality_rules(t.documents, fit_lines(t.documents, t.labels, fit_rows=2000))


@query
def op7_toxicity(t):
    index = fit_examples(t.documents, t.labels, fit_rows=6000, k=101)
    found = toxicity(t.documents, index, threshold=0.7)
    return found.withColumn("evidence", F.array_join("evidence", ","))


@query
def op4_mixing_sources(t):
    return mix(t.documents, temperature=0.5, seed=11).drop("lang", "n_chars")


SQL["op4_mixing_sources"] = r"""
WITH sized AS (SELECT source, sum(coalesce(strlen(text), 0)) AS size FROM documents GROUP BY source),
weighted AS (SELECT source, size, sqrt(size::DOUBLE) AS weight FROM sized WHERE size > 0),
rated AS (
  SELECT source, (sum(size) OVER ())::DOUBLE * weight / sum(weight) OVER () / size AS rate FROM weighted),
steps AS (
  SELECT source, rate, k, CASE WHEN k = 0 THEN -rate ELSE ln(rate) - ln(k) END AS growth
  FROM rated, LATERAL (SELECT unnest(range(0, ceil(rate + 12 * sqrt(rate) + 20)::BIGINT + 1)) AS k) s),
terms AS (SELECT source, k, exp(sum(growth) OVER (PARTITION BY source ORDER BY k)) AS p FROM steps),
tables AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM terms),
drawn AS (
  SELECT d.doc_id, d.text, d.source,
    ('0x' || substr(md5('11|' || coalesce(d.doc_id::VARCHAR, 'null')), 1, 13))::BIGINT / 4503599627370496.0 AS u
  FROM documents d),
counted AS (
  SELECT doc_id, any_value(text) AS text, d.source, count(*) AS n
  FROM drawn d JOIN tables t ON d.source IS NOT DISTINCT FROM t.source AND t.c <= d.u GROUP BY doc_id, d.source)
SELECT doc_id, text, source, copy,
  md5('shuffle 11|' || coalesce(doc_id::VARCHAR, 'null') || '|' || copy::VARCHAR) AS shuffle_key
FROM counted, LATERAL (SELECT unnest(range(1, n + 1)) AS copy) c
"""


@query
def op2_chat_format(t):
    crafted = t.spark.sql(
        "SELECT -1L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text "
        "FROM VALUES (0L, 'user'), (1L, 'assistant') AS v(turn, role)"
    )
    turns = t.conversations.select("conv_id", "turn", "role", "text").union(crafted)
    chats = format_chats(turns, text_parts(turns.text))
    back = F.transform(turn_texts(F.col("formatted")), lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n")))
    learned = learned_text(F.col("formatted"), F.col("turns"))
    return chats.select(
        "conv_id",
        F.size(back).cast("long").alias("n_turns"),
        F.sha2(F.concat_ws("", back).cast("binary"), 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


SQL["op2_chat_format"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
safe AS (
  SELECT *,
    replace(replace(replace(replace(replace(replace(text, '\', '\\'), '<|', '<\|'), '</s>', '<\/s>'),
      '<s>', '<\s>'), '[/INST]', '[\/INST]'), '[INST]', '[\INST]') AS body,
    replace(replace(replace(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), '</s>', '<\/s>'),
      '<s>', '<\s>'), '[/INST]', '[\/INST]'), '[INST]', '[\INST]') AS head
  FROM turns),
chats AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, body) AS all_text,
    coalesce(string_agg(text, '' ORDER BY turn, role, body) FILTER (role = 'assistant'), '') AS learned,
    sum(length('<|turn|><|body|><|end|>') + length(head) + length(body)) AS formatted_chars
  FROM safe GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(all_text) AS turns_sha256, length(learned) AS loss_chars,
  sha256(learned) AS loss_sha256, formatted_chars::BIGINT AS formatted_chars
FROM chats
"""


def hashed(what, *parts):
    """A number below 2**28 from some columns, which SQL can make as well."""
    digest = F.md5(F.concat_ws("|", F.lit(what), *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, 7), 16, 10).cast("long")


@query
def op5_url_filters(t):
    """Captures get a fetch time of their id; every second pattern of the pages has been on a list."""
    start, days = 1_577_836_800, 1500  # 2020-01-01
    fetched = F.timestamp_seconds(start + F.pmod(hashed("fetch", F.col("page_id").cast("string")), F.lit(days * 86_400)))
    captures = t.pages.select("page_id", "url", fetched.alias("fetch_time"))
    covering = patterns_of(host_of(F.col("url")), path_of(F.col("url")), 3)
    patterns = t.pages.select(F.explode(covering).alias("pattern")).distinct()
    dated = patterns.select("pattern", F.explode(F.sequence(F.lit(1), F.lit(4))).alias("n"))
    number = lambda what: hashed(what, "pattern", F.col("n").cast("string"))  # noqa: E731
    entries = dated.where(F.pmod(hashed("listed", "pattern"), F.lit(2)) == 0).select(
        "pattern",
        F.element_at(F.array(*map(F.lit, ("ads", "adult", "spam"))), (number("list") % 3 + 1).cast("int")).alias("list"),
        F.element_at(F.array(*map(F.lit, ("block", "allow", "remove"))), (number("action") % 3 + 1).cast("int")).alias("action"),
        F.date_from_unix_date((F.lit(start // 86_400) + number("day") % days).cast("int")).alias("day"),
    )
    found = filter_urls(captures, entries, bucket_days=64)
    return found.withColumn("lists", F.array_join("lists", ","))


SQL["op5_url_filters"] = r"""
WITH captures AS (
  SELECT page_id, url,
    make_timestamp((1577836800 + ('0x' || substr(md5('fetch|' || page_id::VARCHAR), 1, 7))::BIGINT % (1500 * 86400)) * 1000000)
      AS fetch_time,
    lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#\\]*)', 1)) AS host,
    list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#\\]*([^?#]*)', 1), '/'),
      lambda s: s <> '') AS segments
  FROM pages),
keyed AS (
  SELECT *, unnest(list_concat(
    list_transform(range(1, greatest(len(string_split(host, '.')) - 1, 1) + 1),
      lambda i: array_to_string(list_slice(string_split(host, '.'), i, len(string_split(host, '.'))), '.')),
    list_transform(range(1, least(len(segments), 3) + 1),
      lambda n: host || '/' || array_to_string(list_slice(segments, 1, n), '/')))) AS key
  FROM captures),
patterns AS (SELECT DISTINCT key AS pattern FROM keyed),
entries AS (
  SELECT pattern, n,
    ['ads', 'adult', 'spam'][('0x' || substr(md5('list|' || pattern || '|' || n::VARCHAR), 1, 7))::BIGINT % 3 + 1] AS list,
    ('0x' || substr(md5('action|' || pattern || '|' || n::VARCHAR), 1, 7))::BIGINT % 3 AS action,
    DATE '2020-01-01' + (('0x' || substr(md5('day|' || pattern || '|' || n::VARCHAR), 1, 7))::BIGINT % 1500)::INTEGER AS day
  FROM patterns, LATERAL (SELECT unnest([1, 2, 3, 4]) AS n) x
  WHERE ('0x' || substr(md5('listed|' || pattern), 1, 7))::BIGINT % 2 = 0),
daily AS (
  SELECT pattern, list, day, min(action) AS action  -- block is 0, allow 1, remove 2
  FROM entries GROUP BY ALL),
spans AS (
  SELECT *, lead(day) OVER (PARTITION BY pattern, list ORDER BY day) AS until FROM daily),
active AS (
  SELECT k.page_id, s.pattern, s.list, s.action, s.day
  FROM keyed k JOIN spans s ON k.key = s.pattern AND s.action < 2 AND k.fetch_time::DATE >= s.day
    AND (s.until IS NULL OR k.fetch_time::DATE < s.until)),
answers AS (
  SELECT page_id, pattern, action, array_to_string(list_sort(list(DISTINCT list)), ',') AS lists, max(day) AS since,
    row_number() OVER (PARTITION BY page_id
      ORDER BY contains(pattern, '/') DESC, length(pattern) DESC, pattern DESC, action) AS place
  FROM active GROUP BY page_id, pattern, action)
SELECT c.page_id, c.url, c.fetch_time, c.host,
  CASE WHEN a.action = 0 THEN 'block' ELSE 'allow' END AS verdict, a.pattern, coalesce(a.lists, '') AS lists, a.since
FROM captures c LEFT JOIN answers a ON c.page_id = a.page_id AND a.place = 1
"""


@query
def op6_license_scan(t):
    found = scan_licences(t.documents, fit_licences(t.documents, sample_docs=4000, sample_rows=4000))
    confirmed = F.filter("findings", lambda f: f["confirmed"])
    return found.select(
        "doc_id",
        "n_paragraphs",
        F.size("findings").cast("long").alias("n_predicted"),
        F.size(confirmed).cast("long").alias("n_confirmed"),
        F.array_join(F.array_sort(F.array_distinct(confirmed["family"])), ",").alias("families"),
        F.transform(confirmed, lambda f: f["paragraph"]).cast("string").alias("paragraphs"),
    )


@query
def op11_phrase_collocations(t):
    return collocations(t.documents, least=100, longest=5, top=2000)


def _grams(longest: int) -> str:
    """Every run of 1 to ``longest`` words of each piece."""
    return " UNION ALL ".join(
        f"SELECT lang, {k} AS size, array_to_string(list_slice(words, i, i + {k - 1}), ' ') AS phrase "
        f"FROM pieces, LATERAL (SELECT unnest(range(1, len(words) - {k - 2})) AS i) x WHERE len(words) >= {k}"
        for k in range(1, longest + 1)
    )


SQL["op11_phrase_collocations"] = rf"""
WITH pieces AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda w: w <> '') AS words
  FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-]')) AS piece
    FROM documents)),
grams AS ({_grams(5)}),
counts AS MATERIALIZED (
  SELECT lang, phrase, any_value(size) AS size, count(*) AS f FROM grams GROUP BY lang, phrase HAVING count(*) >= 100),
sizes AS (SELECT lang, sum(len(words)) AS n FROM pieces GROUP BY lang),
parts AS (
  SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE size >= 2),
covered AS (
  SELECT DISTINCT s.lang, s.phrase FROM parts s JOIN (
    SELECT lang, f, unnest([array_to_string(w[1:size - 1], ' '), array_to_string(w[2:size], ' ')]) AS phrase
    FROM parts WHERE size > 2) b
  ON s.lang = b.lang AND s.phrase = b.phrase AND 100 * b.f >= 100 * s.f),
cuts AS (
  SELECT lang, phrase, f AS a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:size], ' ') AS tail
  FROM parts, LATERAL (SELECT unnest(range(1, size)) AS k) x
  WHERE (lang, phrase) NOT IN (SELECT (lang, phrase) FROM covered)),
scored AS (
  SELECT c.lang, c.phrase, c.k, c.a, h.f AS l, t.f AS r, s.n,
    (1000::HUGEINT * c.a * s.n) // (h.f::HUGEINT * t.f) AS score
  FROM cuts c JOIN counts h ON c.lang = h.lang AND c.head = h.phrase JOIN counts t ON c.lang = t.lang AND c.tail = t.phrase
    JOIN sizes s ON c.lang = s.lang),
best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
  n::BIGINT AS n, score::BIGINT AS score
FROM best QUALIFY rank <= 2000
"""


@query
def op12_line_dedup(t):
    found = drop_common_lines(t.documents, min_docs=10, min_chars=1)
    digest = F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    return found.select("doc_id", "n_lines", "n_dropped", digest)


SQL["op12_line_dedup"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
keyed AS (
  SELECT row, place, lines[place] AS line,
    trim(translate(lines[place], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(32)) AS key
  FROM docs, LATERAL (SELECT unnest(range(1, len(lines) + 1)) AS place) p),
common AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT row) >= 10),
marked AS (SELECT k.*, c.key IS NOT NULL AS gone FROM keyed k LEFT JOIN common c ON k.key = c.key),
texts AS (
  SELECT row, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '') AS kept
  FROM marked GROUP BY row)
SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM texts JOIN docs USING (row)
"""


@query
def op13_centroid_clusters(t):
    found = cluster(t.embeddings, size=64, k=8, rounds=10, scale=1024, seed=3)
    digest = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ",").cast("binary"), 256)
    return found.withColumn("centroid_sha256", digest).drop("centroid")


def _rounds(n: int) -> str:
    """Per round the nearest centroid of each vector, then the moved centroids."""
    steps = []
    for k in range(n + 1):
        steps.append(f"""
far{k} AS (
  SELECT v.row, c.number, sum((v.x - c.x) * (v.x - c.x)) AS distance
  FROM parts v JOIN centroids{k} c ON v.dim = c.dim GROUP BY v.row, c.number),
near{k} AS MATERIALIZED (
  SELECT row, number, distance FROM far{k} QUALIFY row_number() OVER (PARTITION BY row ORDER BY distance, number) = 1)""")
        if k < n:
            steps.append(f"""
sums{k} AS (
  SELECT n.number, v.dim, sum(v.x) AS s, count(*) AS n FROM parts v JOIN near{k} n ON v.row = n.row GROUP BY ALL),
centroids{k + 1} AS MATERIALIZED (
  SELECT c.number, c.dim, coalesce(((s - ((s % n) + n) % n) // n)::BIGINT, c.x) AS x
  FROM centroids{k} c LEFT JOIN sums{k} m ON c.number = m.number AND c.dim = m.dim)""")
    return ",".join(steps)


SQL["op13_centroid_clusters"] = rf"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
parts AS MATERIALIZED (SELECT row, unnest(range(1, 65)) AS dim, unnest(v) AS x FROM kept),
first AS (
  SELECT v, row_number() OVER (ORDER BY sha256('3:' || vec_id::VARCHAR) NULLS LAST, v) - 1 AS number FROM kept
  QUALIFY number < 8),
centroids0 AS MATERIALIZED (SELECT number, unnest(range(1, 65)) AS dim, unnest(v) AS x FROM first),{_rounds(10)},
digests AS (SELECT number, sha256(string_agg(x::VARCHAR, ',' ORDER BY dim)) AS centroid_sha256 FROM centroids10 GROUP BY number)
SELECT k.vec_id, n.number::INTEGER AS cluster, n.distance::BIGINT AS distance,
  (sum(n.distance) OVER (PARTITION BY n.number))::BIGINT AS cluster_inertia, (sum(n.distance) OVER ())::BIGINT AS inertia,
  d.centroid_sha256
FROM near10 n JOIN kept k ON n.row = k.row JOIN digests d ON n.number = d.number
"""
