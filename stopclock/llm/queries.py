"""Queries over the driver's tables, one an operator, with the settings used in production."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopclock.llm import (
    bpe,
    centroids,
    cross_polytope,
    decontaminate,
    pii,
    prefix_hash,
    quality_gam,
    secret_lexer,
    simhash,
    suffix_dedup,
    token_files,
    url_rules,
    whitening,
)
from stopclock.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

MULTI_RANKS = "byte_bpe_multi_50k.tiktoken"
LIBRARY_FILE = "byte_bpe_50k.json"


def query(name: str, sql: str | None = None):
    def add(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_bpe")
def _(spark, d):
    path = public_tokenizers.path(MULTI_RANKS)
    encoded = bpe.encode(table(spark, d, "documents"), path).select("doc_id", "ids")
    decoded = bpe.decode(encoded, path, keep=("doc_id", "ids"))
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


# The rules of the URL filter.
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def _address_sql(source: str, columns: str) -> str:
    rest = "CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) END"
    host = f"translate(regexp_extract(rest, '^[^/?#]*'), '{url_rules.UPPER}', '{url_rules.LOWER}')"
    return f"""SELECT {columns}, coalesce({host}, '') AS host,
      coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
      {host} || regexp_extract(rest, '^[^/?#]*([^#]*)', 1) AS address
    FROM (SELECT *, {rest} AS rest FROM {source})"""


def _url_sql() -> str:
    def text(pattern: str) -> str:
        return "'" + pattern.replace("'", "''") + "'"

    def value(of: str, pattern: str) -> str:
        groups = " || ".join(f"regexp_extract({of}, {text(pattern)}, {g})" for g in (1, 2, 3))
        return f"trim(replace({groups}, '&amp;', '&'))"

    u = url_rules
    sent_to = f"regexp_extract({value('tag', u.CONTENT)}, {text(u.REFRESH_TO)}, 1)"
    found = f"""SELECT host, path, address, link FROM (SELECT host, path, address,
        CASE WHEN regexp_matches(t, {text(u.BAD_ESCAPE)}) THEN t ELSE url_decode(t) END AS link
        FROM (SELECT host, path, address, unnest(regexp_extract_all(page_url, {text(u.REDIRECT)}, 1)) AS t FROM p))
      WHERE regexp_matches(link, {text(u.ABSOLUTE)})
      UNION ALL SELECT host, path, address, {value("tag", u.HREF)} FROM tags WHERE regexp_matches(tag, {text(u.CANONICAL)})
      UNION ALL SELECT host, path, address, {sent_to} FROM tags WHERE regexp_matches(tag, {text(u.REFRESH)})
      UNION ALL SELECT host, path, address, {value("tag", u.CONTENT)} FROM tags WHERE regexp_matches(tag, {text(u.OG_URL)})"""
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
    return f"""WITH RECURSIVE p AS ({_address_sql("pages", "page_id, html, url AS page_url")}),
    tags AS (SELECT host, path, address, unnest(regexp_extract_all(html, {text(u.TAG)})) AS tag FROM p),
    links AS ({found}),
    parts AS (SELECT *, regexp_extract(link, '^[^?#]*') AS file, regexp_extract(link, '^[^?#]*(.*)$', 1) AS rest,
        CASE WHEN starts_with(link, '/') THEN '' WHEN path = '' THEN '/' ELSE regexp_extract(path, '^(.*/)', 1) END AS folder
      FROM links),
    closed AS (SELECT *, string_split(folder || file
        || CASE WHEN regexp_matches(folder || file, '(^|/)[.][.]?$') THEN '/' ELSE '' END, '/')[2:] AS pieces FROM parts),
    targets AS (SELECT address AS u, CASE WHEN regexp_matches(link, {text(u.ABSOLUTE)}) THEN link
        WHEN starts_with(link, '//') THEN 'http:' || link
        WHEN link = '' OR starts_with(link, '#') OR regexp_matches(link, {text(u.OTHER_SCHEME)}) THEN NULL
        WHEN file = '' THEN 'http://' || host || path || rest
        ELSE 'http://' || host || '/' || array_to_string(list_reduce(list_transform(pieces, lambda x: [x]),
          lambda done, x: CASE WHEN x[1] = '.' THEN done WHEN x[1] = '..' THEN done[:-2] ELSE list_concat(done, x) END,
          CAST([] AS VARCHAR[])), '/') || rest END AS url
      FROM closed WHERE address IS NOT NULL),
    edges AS (SELECT u, address AS v FROM ({_address_sql("targets", "u")}) WHERE u <> address),
    both_ways AS (SELECT u, v FROM edges UNION SELECT v, u FROM edges),
    reached AS (SELECT u AS node, u AS other FROM both_ways
      UNION SELECT r.node, b.v FROM reached r JOIN both_ways b ON b.u = r.other),
    classes AS (SELECT node, min(other) AS component FROM reached GROUP BY 1),
    named AS ({_address_sql("(SELECT 'http://' || node AS url, component FROM classes)", "component")}),
    rules(rule_host, rule_path, verdict) AS (VALUES {rules}),
    fit AS (SELECT host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
        arg_max(verdict, length(rule_host || rule_path)) AS verdict
      FROM (SELECT DISTINCT host, path FROM (SELECT host, path FROM p UNION ALL SELECT host, path FROM named)), rules
      WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
      GROUP BY 1, 2),
    decided AS (SELECT component, min(verdict) AS verdict FROM named JOIN fit USING (host, path) GROUP BY 1)
    SELECT page_id, p.host, p.path, rule, coalesce(fit.verdict, decided.verdict, 'allow') AS verdict, component
    FROM p LEFT JOIN fit ON fit.host = p.host AND fit.path = p.path
    LEFT JOIN classes ON classes.node = p.address LEFT JOIN decided USING (component)"""


@query("op2_url_rules", _url_sql())
def _(spark, d):
    rules = spark.createDataFrame(URL_RULES, "rule_host string, rule_path string, verdict string")
    return url_rules.judge(table(spark, d, "pages"), rules)


@query("op3_pii")
def _(spark, d):
    found = pii.find(table(spark, d, "documents"))
    return found.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base_spans", 256).alias("base_sha256"), "spans"
    )


def _contaminated_sql() -> str:
    """All windows that share enough shingles with an item, each counted in full."""

    def words(source: str, columns: str) -> str:
        split = "regexp_split_to_array(lower(coalesce(text, '')), '[ \\t-\\r]+')"
        return f"(SELECT {columns}, list_filter({split}, lambda w: w <> '') AS words FROM {source})"

    size, least = decontaminate.SHINGLE, decontaminate.SIMILARITY
    return f"""WITH b AS (SELECT item_id, words, len(words) AS n, least({size}, len(words)) AS k
      FROM {words("benchmark", "item_id")} WHERE len(words) > 0),
    i AS (SELECT item_id, n, k, unnest(list_transform(range(1, n - k + 2),
        lambda p: array_to_string(words[p:p + k - 1], ' '))) AS sh FROM b),
    c AS (SELECT item_id, n, k, sh, count(*) AS c FROM i GROUP BY ALL),
    d AS (SELECT doc_id, k, words, len(words) - k + 1 AS m FROM {words("documents", "doc_id")},
      (SELECT DISTINCT k FROM b) WHERE len(words) >= k),
    s AS (SELECT doc_id, k, m, unnest(range(m)) AS place,
        unnest(list_transform(range(1, m + 1), lambda p: array_to_string(words[p:p + k - 1], ' '))) AS sh FROM d),
    hit AS MATERIALIZED (SELECT doc_id, item_id, n, place, sh, c, m, n - k + 1 AS size, least(n - k + 1, m) AS held
      FROM s JOIN c USING (k, sh)),
    enough AS (SELECT doc_id, item_id FROM hit GROUP BY ALL
      HAVING count(*) >= (any_value(size) + any_value(held)) * {least} / (1 + {least}) - 1e-9),
    near AS MATERIALIZED (SELECT * FROM hit SEMI JOIN enough USING (doc_id, item_id)),
    start AS (SELECT DISTINCT doc_id, item_id,
        unnest(range(greatest(0, place - held + 1), least(place, m - held) + 1)) AS start FROM near),
    counted AS (SELECT doc_id, item_id, start, n, size, held, least(count(*), any_value(c)) AS shared
      FROM start JOIN near USING (doc_id, item_id) WHERE place BETWEEN start AND start + held - 1
      GROUP BY doc_id, item_id, start, n, size, held, sh),
    likeness AS (SELECT doc_id, item_id, start, n, sum(shared) / (size + held - sum(shared)) AS similarity
      FROM counted GROUP BY doc_id, item_id, start, n, size, held)
    SELECT doc_id, item_id, CAST(arg_max(start, (similarity, -start)) AS INTEGER) AS start,
      CAST(n AS INTEGER) AS n_words, max(similarity) AS similarity
    FROM likeness WHERE similarity >= {least} GROUP BY doc_id, item_id, n"""


@query("op4_decontaminate", _contaminated_sql())
def _(spark, d):
    found = decontaminate.contaminated(table(spark, d, "documents"), table(spark, d, "benchmark"))
    return found.select("doc_id", "item_id", "start", "n_words", "similarity")


@query("op5_quality_gam")
def _(spark, d):
    docs = table(spark, d, "documents")
    model = quality_gam.train(docs, table(spark, d, "labels"))
    return quality_gam.score(docs, model).select(
        "doc_id",
        (quality_gam.fold(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= quality_gam.THRESHOLD).cast("int").alias("predicted"),
    )


@query("op6_secret_lexer")
def _(spark, d):
    found = secret_lexer.find(table(spark, d, "documents"))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans"
    )


@query("op7_prefix_hash")
def _(spark, d):
    pairs = prefix_hash.compare_with_next(table(spark, d, "documents"))
    return pairs.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited_text").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )


@query("op8_simhash")
def _(spark, d):
    marks = simhash.fingerprints(table(spark, d, "documents"), size=3)
    return simhash.connected(marks, radius=3).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


@query("op9_token_files")
def _(spark, d):
    path = scratch_path(spark, "token-files")
    token_files.write(table(spark, d, "documents"), path, public_tokenizers.path(LIBRARY_FILE), end_id=2)
    return token_files.index(spark, path)


@query("op10_suffix_dedup")
def _(spark, d):
    left = suffix_dedup.remove_repeats(table(spark, d, "documents"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def _clusters_sql() -> str:
    """All rounds, one after the other."""
    apart = "CAST(list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT)"
    parts = [
        f"""v AS MATERIALIZED (SELECT row_number() OVER () AS row_id, vec_id,
        list_transform(embedding, lambda e: CAST(floor(1024 * CAST(e AS DOUBLE)) AS BIGINT)) AS x
      FROM embeddings WHERE len(embedding) = {centroids.DIMENSIONS}
        AND len(list_filter(embedding, lambda e: isfinite(e))) = {centroids.DIMENSIONS})""",
        f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{centroids.SEED}:' || vec_id), x) - 1 AS k, x
      FROM v WHERE vec_id IS NOT NULL ORDER BY k LIMIT {centroids.CENTROIDS})""",
    ]
    for r in range(centroids.ROUNDS + 1):
        parts.append(
            f"""a{r} AS MATERIALIZED (SELECT row_id, any_value(v.vec_id) AS vec_id, any_value(v.x) AS x,
        min(({apart}, k)) AS best FROM v, c{r} AS c GROUP BY row_id)"""
        )
        if r < centroids.ROUNDS:
            parts.append(
                f"""c{r + 1} AS MATERIALIZED (WITH e AS (SELECT best[2] AS k, unnest(x) AS e,
          generate_subscripts(x, 1) AS place FROM a{r}),
        s AS (SELECT k, place, sum(e) AS s, count(*) AS n FROM e GROUP BY 1, 2),
        m AS (SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY place) AS x FROM s GROUP BY 1)
        SELECT c.k, coalesce(m.x, c.x) AS x FROM c{r} AS c LEFT JOIN m USING (k))"""
            )
    last = centroids.ROUNDS
    return f"""WITH {", ".join(parts)}
    SELECT vec_id, CAST(best[2] AS INTEGER) AS cluster, best[1] AS distance,
      CAST(sum(best[1]) OVER (PARTITION BY best[2]) AS BIGINT) AS cluster_inertia,
      CAST(sum(best[1]) OVER () AS BIGINT) AS inertia,
      sha256(array_to_string(c.x, ',')) AS centroid_sha256
    FROM a{last} JOIN c{last} AS c ON c.k = best[2]"""


@query("op11_centroids", _clusters_sql())
def _(spark, d):
    found = centroids.cluster(table(spark, d, "embeddings"))
    numbers = F.array_join(F.col("centroid").cast("array<string>"), ",")
    return found.withColumn("centroid_sha256", F.sha2(numbers.cast("binary"), 256)).drop("centroid")


@query("op12_cross_polytope")
def _(spark, d):
    rows = table(spark, d, "embeddings")
    return cross_polytope.search(rows, rows.filter("vec_id % 100 = 0"))


@query("op13_whitening")
def _(spark, d):
    found = whitening.whiten(table(spark, d, "embeddings"))
    # From some 3 million rows on a deviation may outgrow a long: null there, whole in the operator.
    return found.withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))
