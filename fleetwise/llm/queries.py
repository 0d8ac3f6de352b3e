"""The registered queries of the training-data operators, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetwise.llm import decontamination, hard_negatives, hash_forest, language, lexical_search, line_dedup, lm_scoring, mixing, repeats, secret_scan, simhash, token_files, toxicity
from fleetwise.llm.common import crc_mod

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token files, read back: start, length and crc32 of each document's ids."""
    return token_files.encode_and_read_back(table(spark, sf_dir, "documents"), tokenizer_path(), end_id=2)


@query
def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix with weights 5, 2, 1 at 150% of all words takes of each document."""
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source")).select(
        "doc_id", "size", "source_size", "target", "taken")


ORACLES["op10_mix_sources"] = r"""
WITH d AS (SELECT doc_id, source IS NULL AS no_source, coalesce(source, '') AS source_name,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    md5(concat_ws(':', 'mix', coalesce(CAST(doc_id AS VARCHAR), ''), coalesce(md5(text), ''))) AS key FROM documents),
z AS (SELECT no_source, source_name, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY no_source, source_name),
s AS (SELECT *, (CASE (row_number() OVER (ORDER BY no_source, source_name) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END)::DOUBLE AS weight
    FROM z),
l AS (SELECT *, 2.0::DOUBLE * source_size AS lim,
    sum(2.0::DOUBLE * source_size) OVER w AS lims, sum(weight) OVER w AS ws,
    sum(weight) OVER () AS all_w, 1.5::DOUBLE * (sum(source_size) OVER ()) AS total
    FROM s WINDOW w AS (ORDER BY 2.0::DOUBLE * source_size / weight, no_source, source_name ROWS UNBOUNDED PRECEDING)),
c AS (SELECT *, lim * (all_w - ws + weight) <= (total - lims + lim) * weight AS capped FROM l),
o AS (SELECT any_value(total) - coalesce(sum(lim) FILTER (capped), 0) AS rest,
    any_value(all_w) - coalesce(sum(weight) FILTER (capped), 0) AS open_w FROM c),
t AS (SELECT no_source, source_name, source_size,
    CASE WHEN capped THEN lim ELSE weight * (rest / open_w) END AS target FROM c, o),
b AS (SELECT d.*, source_size, target,
    CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS epochs,
    sum(size) OVER (PARTITION BY no_source, source_name ORDER BY key RANGE UNBOUNDED PRECEDING) AS upto,
    sum(size) OVER (PARTITION BY no_source, source_name, key) AS same,
    count(*) OVER (PARTITION BY no_source, source_name, key) AS n
    FROM d JOIN t USING (no_source, source_name)),
r AS (SELECT *, CAST(floor(target) AS BIGINT) - epochs * source_size AS rest FROM b)
SELECT doc_id, size, source_size, target,
    CAST(epochs * size + CASE WHEN upto <= rest THEN size WHEN upto - same <= rest THEN (rest - upto + same) // n ELSE 0 END AS BIGINT) AS taken
FROM r
"""


@query
def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint (3-word shingles) and component (links at 3 bits or fewer) of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words_in_shingle=3, distance=3)
    return found.select("doc_id", simhash.hex_digits(found["fp"]).alias("fingerprint"), "component_id")


TOXIC_FROM = 0.7


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    """Trained on the labels whose id has crc32 mod 3 other than 1."""
    return toxicity.fit(docs, labels.where(crc_mod(F.col("doc_id"), 3) != 1))


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity_model(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (crc_mod(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
                         (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs.where(crc_mod(F.col("doc_id"), 4) != 2))
    return language.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", (crc_mod(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")


@query
def op4_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest vectors found for every vec_id divisible by 50."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return hash_forest.nearest(vectors, F.col("vec_id") % 50 == 0, k=5)


@query
def op6_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What remains of every document without byte strings of 200 that also start elsewhere."""
    return repeats.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query
def op1_benchmark_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item that overlap, with the tokens that agree in the best window."""
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op1_benchmark_overlaps"] = r"""
WITH d AS (SELECT DISTINCT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM documents),
b AS (SELECT DISTINCT item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM benchmark),
dp AS (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS p FROM d WHERE len(w) >= 8),
bp AS (SELECT item_id, w, unnest(range(1, len(w) - 6)) AS p FROM b WHERE len(w) >= 8),
ds AS (SELECT doc_id, p, unnest([concat_ws(' ', 'a', w[p], w[p+1], w[p+3], w[p+6], w[p+7]),
    concat_ws(' ', 'b', w[p], w[p+1], w[p+4], w[p+6], w[p+7])]) AS s FROM dp),
bs AS (SELECT item_id, p, unnest([concat_ws(' ', 'a', w[p], w[p+1], w[p+3], w[p+6], w[p+7]),
    concat_ws(' ', 'b', w[p], w[p+1], w[p+4], w[p+6], w[p+7])]) AS s FROM bp),
h AS (SELECT DISTINCT doc_id, item_id, ds.p - bs.p AS shift FROM ds JOIN bs USING (s)),
m AS (SELECT h.doc_id, h.item_id, shift, least(len(b.w), 13) AS win, len(b.w) AS n,
    list_transform(range(1, len(b.w) + 1), lambda j: CASE WHEN j + shift >= 1 AND d.w[greatest(j + shift, 1)] = b.w[j] THEN 1 ELSE 0 END) AS same
    FROM h JOIN d ON d.doc_id = h.doc_id JOIN b ON b.item_id = h.item_id),
x AS (SELECT doc_id, item_id, win,
    list_max(list_transform(range(1, n - win + 2), lambda j: list_sum(same[j:j + win - 1]))) AS matched FROM m)
SELECT doc_id, item_id, CAST(max(matched) AS BIGINT) AS matched, CAST(max(win) AS BIGINT) AS "window"
FROM x WHERE matched >= 0.8 * win GROUP BY doc_id, item_id
"""


@query
def op2_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-entropy difference of every document; the target is what labels call of quality 1."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return lm_scoring.scored(docs, good)


@query
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class, number of matching classes and fate of every line that has a token."""
    found = line_dedup.matched_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "line_no", "n_links", "removed")


ORACLES["op7_line_dedup"] = r"""
WITH l AS (SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS line_no, string_split(text, chr(10)) AS parts
    FROM documents WHERE text <> ''),
t AS (SELECT doc_id, CAST(line_no AS BIGINT) AS line_no, list_sort(list_distinct(list_filter(
    regexp_split_to_array(lower(parts[line_no + 1]), '[^\p{L}\p{N}]+'), lambda w: w <> ''))) AS w FROM l),
c AS (SELECT w, len(w) AS n, min(struct_pack(doc_id, line_no)) AS first FROM t WHERE len(w) > 0 GROUP BY w),
k AS (SELECT *, row_number() OVER () AS id FROM c),
u AS (SELECT id, n, unnest(w) AS tok FROM k),
f AS (SELECT tok, count(*) AS freq FROM u GROUP BY tok),
r AS (SELECT u.*, row_number() OVER (PARTITION BY id ORDER BY freq, u.tok) AS place FROM u JOIN f ON f.tok = u.tok),
p AS (SELECT * FROM r WHERE place <= n - ceil(0.8 * n - 1e-9) + 1),
q AS (SELECT DISTINCT x.id AS a, y.id AS b FROM p x JOIN p y ON x.tok = y.tok AND x.id <> y.id AND x.n >= 0.8 * y.n - 1e-9 AND y.n >= 0.8 * x.n - 1e-9),
j AS (SELECT q.a, q.b, y.first AS other FROM q JOIN k x ON x.id = q.a JOIN k y ON y.id = q.b
    WHERE len(list_intersect(x.w, y.w)) >= 0.8 * (x.n + y.n - len(list_intersect(x.w, y.w))) - 1e-9),
g AS (SELECT a, count(*) AS n_links, min(other) AS other FROM j GROUP BY a)
SELECT t.doc_id, t.line_no, coalesce(n_links, 0) AS n_links,
    (least(k.first, coalesce(g.other, k.first)) < struct_pack(doc_id := t.doc_id, line_no := t.line_no)) AS removed
FROM t JOIN k ON k.w = t.w LEFT JOIN g ON g.a = k.id
"""


@query
def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers and places of the secrets in every document."""
    found = secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = [r.kind for r in secret_scan.BASE]

    def number(kind: str) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[number(k) for k in base],
        F.sha2(secret_scan.joined(F.filter("secrets", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        secret_scan.joined(F.col("secrets")).alias("spans"))


def _secrets_sql() -> str:
    """Matches of each rule by RE2; a match starts after all that lies between and in the matches before it."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    each = " UNION ALL ".join(
        f"""SELECT r, {i} AS k, {quoted(rule.kind)} AS kind, {rule.least} AS least, {quoted('^' + rule.head if rule.head else '^')} AS head,
        regexp_extract_all(text, {quoted(rule.pattern)}) AS m, regexp_split_to_array(text, {quoted(rule.pattern)}) AS g
        FROM d WHERE regexp_matches(text, {quoted(rule.pattern)})""" for i, rule in enumerate(secret_scan.RULES))
    span = "kind || ':' || start || ':' || stop, ',' ORDER BY start, k"
    n = ", ".join(f"coalesce(count(*) FILTER (kind = '{r.kind}'), 0) AS n_{r.kind}" for r in secret_scan.BASE)
    base = ", ".join(quoted(r.kind) for r in secret_scan.BASE)
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
a AS ({each}),
u AS (SELECT r, k, kind, least, head, m, g, unnest(range(1, len(m) + 1)) AS i FROM a),
s AS (SELECT r, k, kind, least, m[i] AS found, length(regexp_extract(m[i], head)) AS front,
    CAST(list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS start
    FROM u),
f AS (SELECT r, k, kind, start, start + length(found) AS stop FROM s WHERE length(found) - front >= least),
z AS (SELECT r, {n}, string_agg({span}) FILTER (kind IN ({base})) AS base, string_agg({span}) AS spans FROM f GROUP BY r)
SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in secret_scan.BASE)},
    sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN z ON z.r = d.r
"""


ORACLES["op11_secret_scan"] = _secrets_sql()


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every vec_id divisible by 100 and its 5 best rows of the same label."""
    label = F.col("label").cast("long")
    vectors = table(spark, sf_dir, "embeddings").select(
        "vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"))
    return hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0)


ORACLES["op13_hard_negatives"] = """
WITH e AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS c FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS own, CAST(list_inner_product(a.c, b.c) AS BIGINT) AS score
    FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0 AND len(a.c) = len(b.c)),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE own
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.own AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) QUALIFY row_number() OVER w <= 5
"""


@query
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


ORACLES["op12_lexical_search"] = r"""
WITH fold AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS up, 'abcdefghijklmnopqrstuvwxyz' AS low),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, up, low), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents, fold WHERE text IS NOT NULL),
i AS (SELECT row_number() OVER () AS q, * FROM (SELECT DISTINCT item_id, text FROM benchmark)),
b AS (SELECT q, unnest(regexp_extract_all(translate(text, up, low), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM i, fold WHERE text IS NOT NULL),
s AS (SELECT CAST(count(*) AS BIGINT) AS big_n, CAST(sum(len(w)) AS BIGINT) AS big_l FROM d WHERE len(w) > 0),
v AS (SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n, unnest(w) AS term FROM d),
t AS (SELECT r, doc_id, n, term, CAST(count(*) AS BIGINT) AS tf FROM v GROUP BY r, doc_id, n, term),
g AS (SELECT term, CAST(floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS weight
    FROM (SELECT term, CAST(count(*) AS BIGINT) AS df FROM t GROUP BY term), s),
c AS (SELECT q, term, CAST(count(*) AS BIGINT) AS times FROM b GROUP BY q, term),
x AS (SELECT q, r, doc_id, CAST(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * big_n) // big_l))))) AS BIGINT) AS score
    FROM c JOIN t USING (term) JOIN g USING (term), s GROUP BY q, r, doc_id)
SELECT item_id, CAST(row_number() OVER best AS INTEGER) AS rank, doc_id, score
FROM x JOIN i USING (q) WHERE score > 0 WINDOW best AS (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) QUALIFY row_number() OVER best <= 20
"""
