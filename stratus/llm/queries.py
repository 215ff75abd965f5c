"""One query per operator over the whole of its table, with the SQL that checks it.

Every query takes (spark, sf_dir), applies its operator with production
parameters and returns its full result in the contract's columns.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.llm import bpe, exact_dedup, hard_negatives, license_scan, line_dedup, mixing, ngram_join, periodic_runs, piece_bpe, quality, sharding, topk_search, url_filter
from stratus.llm.common import WHITE, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# Production parameters
SHARDS = 24
MIX_WEIGHTS, MIX_SHARE, MIX_MOST = (3, 1, 2), 1.5, 2


def query(name: str, sql: str | None = None):
    def register(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return register


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"


# --------------------------------------------- 1 n-gram Jaccard join
@query(
    "op1_ngram_join",
    r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
         FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
sizes AS (SELECT w.doc_id, count(s) AS n FROM w LEFT JOIN sets ON sets.doc_id = w.doc_id GROUP BY w.doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * i >= 80 * (x.n + y.n - i)),
ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM sizes UNION SELECT reach.a, ways.b FROM reach JOIN ways ON reach.b = ways.a)
SELECT doc_id, n AS n_shingles, (SELECT min(b) FROM reach WHERE a = doc_id) AS component_id FROM sizes
""",
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_components(table(spark, sf_dir, "documents"), width=ngram_join.WIDTH, percent=ngram_join.PERCENT)


# ------------------------------------------------------------- 2 mixing
_MIX_SQL = f"""
WITH sized AS (SELECT doc_id, source, {_WORDS}::BIGINT AS size,
        md5(coalesce(doc_id::VARCHAR, 'null') || '/' || md5(coalesce(text, ''))) AS h FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
s1 AS (SELECT *, ([3.0, 1.0, 2.0]::DOUBLE[])[((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT] AS weight FROM s0),
s2 AS (SELECT *, 2.0::DOUBLE * source_size / weight AS fills_at FROM s1),
s3 AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
        - 2 * coalesce(sum(source_size) OVER (ORDER BY fills_at, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY fills_at, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lv FROM s2),
s4 AS (SELECT *, max(CASE WHEN lv <= fills_at THEN lv END) OVER () AS level FROM s3),
t AS (SELECT source, source_size, least(2.0::DOUBLE * source_size, level * weight) AS target FROM s4),
p AS (SELECT {mixing.BLOCK}::BIGINT AS block),
u0 AS (SELECT t.*, floor(target / source_size)::BIGINT * ceil(source_size::DOUBLE / block)::BIGINT
        + ceil((target - floor(target / source_size) * source_size) / block)::BIGINT AS need FROM t, p WHERE target > 0),
u AS (SELECT *, floor((sum(need) OVER (ORDER BY source ASC NULLS LAST))::DOUBLE / (sum(need) OVER ())::DOUBLE * 4294967296)::BIGINT AS hi FROM u0),
v AS (SELECT *, coalesce(lag(hi) OVER (ORDER BY source ASC NULLS LAST), 0) AS lo FROM u),
slots AS (SELECT slot, (slot % 4294967296) * 2654435769 % 4294967296 AS point
        FROM (SELECT unnest(range((sum(need) + sum(need) // 50 + 16)::BIGINT)) AS slot FROM u0)),
served AS (SELECT v.source, v.source_size, v.target, row_number() OVER (PARTITION BY v.source ORDER BY slot) - 1 AS rank
        FROM slots JOIN v ON point >= lo AND point < hi),
late AS (SELECT v.source, v.source_size, v.target, v.need::BIGINT AS need,
        (SELECT count(*) FROM served s WHERE s.source IS NOT DISTINCT FROM v.source) AS n FROM v),
ranked AS (SELECT * FROM served UNION ALL
        SELECT source, source_size, target, unnest(range(n, need)) AS rank FROM late WHERE n < need),
cut AS (SELECT source, rank % ceil(source_size::DOUBLE / block)::BIGINT AS block_no,
        least(block, source_size - (rank % ceil(source_size::DOUBLE / block)::BIGINT) * block,
              ceil(target)::BIGINT - (rank // ceil(source_size::DOUBLE / block)::BIGINT) * source_size
              - (rank % ceil(source_size::DOUBLE / block)::BIGINT) * block) AS words FROM ranked, p),
placed AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY h, doc_id, size ROWS UNBOUNDED PRECEDING)::BIGINT - size AS start FROM sized),
parts AS (SELECT doc_id, source, size, start, unnest(range((start // block)::BIGINT, ((start + greatest(size, 1) - 1) // block + 1)::BIGINT)) AS block_no, block
        FROM placed, p),
taken AS (SELECT q.doc_id, q.source, q.size, q.start, sum(CASE WHEN c.words > 0 THEN greatest(0,
        least(q.start + q.size, q.block_no * q.block + c.words) - greatest(q.start, q.block_no * q.block)) ELSE 0 END)::BIGINT AS taken
        FROM parts q LEFT JOIN cut c ON q.source IS NOT DISTINCT FROM c.source AND q.block_no = c.block_no AND c.words > 0
        GROUP BY ALL)
SELECT k.doc_id, k.size, t.source_size, t.target, k.taken, k.source FROM taken k JOIN t ON k.source IS NOT DISTINCT FROM t.source
"""


@query("op2_mix_sources", _MIX_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.mix_sources(docs, MIX_WEIGHTS, MIX_SHARE, MIX_MOST).taken()


# -------------------------------------------------------- 3 exact dedup
@query(
    "op3_exact_dedup",
    f"""
WITH d AS (SELECT doc_id, sha256({_LOWER}) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
""",
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


# ---------------------------------------------------------------- 4 BPE
@query("op4_byte_bpe")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = bpe.Tokenizer(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    coded = tokenizer.decode(tokenizer.encode(table(spark, sf_dir, "documents")))
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


# ----------------------------------------------------------- 5 sharding
def _shard_sql(n: int) -> str:
    draws = ", ".join(
        f"((('0x' || substr(md5(k || '/{s}'), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE)" for s in range(n)
    )
    return f"(list_position(l{n}, list_max(l{n})) - 1)::INT", f"[{draws}] AS l{n}"


_SHARD, _LIST = _shard_sql(SHARDS)
_GROWN, _GROWN_LIST = _shard_sql(SHARDS + 1)


@query(
    "op5_sharding",
    f"""
WITH t0 AS (SELECT list(n::BIGINT ORDER BY i) AS tab FROM (
    WITH RECURSIVE c(i, n, k) AS (
        SELECT i, i, 0 FROM range(256) r(i)
        UNION ALL
        SELECT i, CASE WHEN n % 2 = 1 THEN xor(3988292384, n // 2) ELSE n // 2 END, k + 1 FROM c WHERE k < 8)
    SELECT i, n FROM c WHERE k = 8)),
b AS (SELECT doc_id, coalesce(text, '') AS text, hex(encode(coalesce(text, ''))) AS h, coalesce(doc_id::VARCHAR, 'null') AS k FROM documents),
crc AS (SELECT doc_id, k, length(h) // 2 + 8 AS size,
    xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(h), 2),
        lambda i: ('0x' || substr(h, i, 2))::BIGINT)),
        lambda x, y: xor(x // 256, tab[(xor(x, y) % 256) + 1]))) AS text_crc32 FROM b, t0),
l AS (SELECT *, {_LIST}, {_GROWN_LIST} FROM crc),
s AS (SELECT doc_id, size, text_crc32, k, {_SHARD} AS shard, {_GROWN} AS grown_shard FROM l)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY md5(k), doc_id) - 1 AS slot, grown_shard FROM s
""",
)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    placed = sharding.shard_rows(docs, [1.0] * SHARDS, [1.0] * (SHARDS + 1))
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


# --------------------------------------------------------- 6 line dedup
@query(
    "op6_line_dedup",
    rf"""
WITH l0 AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS line_no FROM documents),
l AS (SELECT *, doc_id::HUGEINT * 4294967296 + line_no AS place,
        regexp_extract_all(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM l0),
d AS (SELECT w, array_to_string(w, ' ') AS k, min(place) AS place FROM l WHERE len(w) > 0 GROUP BY w),
v AS (SELECT k, place, k AS variant, -1 AS gap FROM d WHERE len(w) >= {line_dedup.MIN_NEAR}
      UNION ALL
      SELECT k, place, array_to_string(list_concat(w[1:i - 1], w[i + 1:]), ' '), i
      FROM (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM d WHERE len(w) >= {line_dedup.MIN_NEAR})),
g AS (SELECT variant, gap, min(place) AS first FROM v GROUP BY ALL),
h AS (SELECT variant, min(first) FILTER (gap > 0) AS lacking, min(first) FILTER (gap < 0) AS whole FROM g GROUP BY ALL),
near AS (SELECT DISTINCT v.k FROM v JOIN g USING (variant, gap) JOIN h USING (variant)
         WHERE v.place > least(g.first, CASE WHEN v.gap > 0 THEN h.whole ELSE h.lacking END)),
out AS (SELECT l.doc_id, l.line_no, l.line, len(l.w) > 0 AS has_words, near.k IS NOT NULL AS near,
        coalesce(near.k IS NOT NULL OR l.place <> d.place, false) AS gone
        FROM l LEFT JOIN d ON len(l.w) > 0 AND array_to_string(l.w, ' ') = d.k LEFT JOIN near ON near.k = d.k)
SELECT doc_id, count(*) FILTER (has_words) AS n_lines, count(*) FILTER (gone) AS n_dropped, count(*) FILTER (near) AS n_near,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (NOT gone), '')) AS text_sha256
FROM out GROUP BY doc_id
""",
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup.drop_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kept = F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)
    return cut.select("doc_id", "n_lines", "n_dropped", "n_near", kept.alias("text_sha256"))


# -------------------------------------------------------- 7 top-k search
@query(
    "op7_topk_search",
    """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
    FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, rank::INT AS rank, vec_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
""",
)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(table(spark, sf_dir, "embeddings"), k=5, every=50, scale=256.0)


# --------------------------------------------------------- 8 URL filters
# The tables hold no lists and no fetch days.  Both are derived from the
# pages: a page is fetched on a day that its id decides, and a key of the
# pages' URLs is listed, delisted and listed again on days that the digits
# of its own digest decide.
_LISTS = {0: "malware", 1: "phishing", 2: "spam", 3: "allow"}


def derived_entries(pages: DataFrame) -> DataFrame:
    keys = pages.select(F.explode(url_filter.url_keys(url_filter.url_host(F.col("url")), url_filter.url_segment(F.col("url")))).alias("key"))
    digit = lambda at, n: F.conv(F.substring(F.md5(F.col("key").cast("binary")), at, n), 16, 10).cast("int")
    keys = keys.filter("key is not null").distinct().withColumns({"kind": digit(1, 1), "a": digit(2, 3), "b": digit(5, 3), "c": digit(8, 2)})
    keys = keys.filter(F.col("kind").isin(*_LISTS))
    name = F.coalesce(*[F.when(F.col("kind") == k, v) for k, v in _LISTS.items()])
    start = F.col("a") % 1200
    events = F.array(
        F.struct(F.lit("add").alias("action"), start.alias("d")),
        F.struct(F.lit("remove").alias("action"), (start + 1 + F.col("b") % 600).alias("d")),
        F.struct(F.lit("add").alias("action"), (start + 1 + F.col("b") % 600 + F.col("c")).alias("d")),
    )
    e = keys.select(name.alias("list"), "key", F.explode(events).alias("e"))
    return e.select("list", "key", "e.action", F.date_add(F.lit("2020-01-01").cast("date"), F.col("e.d")).alias("day"))


_URL_SQL = rf"""
WITH p AS (SELECT page_id, url, DATE '2020-01-01' + (page_id * 37 % 1826)::INT AS fetched,
        nullif(regexp_replace(regexp_extract(lower(url), '{url_filter.HOST}', 1), '\.+$', ''), '') AS host,
        nullif(regexp_extract(url, '{url_filter.SEGMENT}', 1), '') AS segment FROM pages),
l AS (SELECT *, string_split(host, '.') AS labels FROM p),
k AS (SELECT *, CASE WHEN len(labels) >= 2 THEN list_transform(range(1, len(labels)), lambda i: array_to_string(labels[i:], '.')) ELSE [host] END
        || CASE WHEN segment IS NULL THEN [] ELSE [host || '/' || segment] END AS keys FROM l WHERE host IS NOT NULL),
d AS (SELECT key, ('0x' || substr(md5(key), 1, 1))::INT AS kind, ('0x' || substr(md5(key), 2, 3))::INT AS a,
        ('0x' || substr(md5(key), 5, 3))::INT AS b, ('0x' || substr(md5(key), 8, 2))::INT AS c
        FROM (SELECT DISTINCT unnest(keys) AS key FROM k)),
n AS (SELECT key, ['malware', 'phishing', 'spam', 'allow'][kind + 1] AS list, a % 1200 AS s, 1 + b % 600 AS b, c FROM d WHERE kind < 4),
e AS (SELECT list, key, 'add' AS action, s AS day FROM n UNION ALL SELECT list, key, 'remove', s + b FROM n
      UNION ALL SELECT list, key, 'add', s + b + c FROM n),
g AS (SELECT list, key, day, bool_or(action = 'remove') AS removed FROM e GROUP BY ALL),
i AS (SELECT *, lead(day) OVER (PARTITION BY list, key ORDER BY day) AS until FROM g),
v AS (SELECT list, key, DATE '2020-01-01' + day::INT AS since, DATE '2020-01-01' + until::INT AS until FROM i WHERE NOT removed),
m AS (SELECT page_id, url, v.*, row_number() OVER (PARTITION BY page_id, url ORDER BY length(v.key) DESC, list = 'allow' DESC, v.key DESC, list) AS r
      FROM (SELECT page_id, url, fetched, unnest(keys) AS key FROM k) x JOIN v ON x.key = v.key AND since <= fetched AND (until IS NULL OR fetched < until))
SELECT p.page_id, p.host, strftime(p.fetched, '%Y-%m-%d') AS fetched,
       CASE WHEN m.list IS NULL THEN 'none' WHEN m.list = 'allow' THEN 'allow' ELSE 'block' END AS verdict,
       m.list, m.key AS list_key, strftime(m.since, '%Y-%m-%d') AS since
FROM p LEFT JOIN m ON m.page_id = p.page_id AND m.url = p.url AND m.r = 1
"""


@query("op8_url_filter", _URL_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    fetched = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("page_id") * 37 % 1826).cast("int"))
    out = url_filter.filter_captures(pages.withColumn("fetched", fetched), derived_entries(pages))
    dates = {c: F.date_format(c, "yyyy-MM-dd") for c in ("fetched", "since")}
    return out.withColumns(dates).select("page_id", "host", "fetched", "verdict", "list", "list_key", "since")


# ------------------------------------------------------ 9 license scans
@query("op9_license_scan")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


# ------------------------------------------------ 10 quality classifier
@query("op10_quality")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    forest = quality.train(docs, table(spark, sf_dir, "labels"), quality.SAMPLE)
    scored = quality.score_quality(docs, forest, quality.THRESHOLD)
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


# --------------------------------------------------- 11 hard negatives
@query(
    "op11_hard_negatives",
    """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, list_dot_product(a.e, c.e)::BIGINT AS score, a.label = c.label AS same
    FROM v a JOIN v c ON c.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER w::INT AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 5
""",
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine_negatives(v.withColumn("label", moved), k=5, positives=5, every=100, window=(80, 100), scale=256.0)


# -------------------------------------------------------------- 12 runs
def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text; every tenth document, by crc32 of its id, repeats some words of its own to its end."""
    words = F.array_remove(F.split("text", f"{WHITE}+"), "")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    d = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("words"), F.floor(h / 10).alias("g"))
    d = d.withColumn("n", F.size("words").cast("long")).withColumn("a", F.expr("if(n > 0, g % n, 0)"))
    d = d.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    repeated = F.expr("concat(slice(words, 1, cast(a as int)), slice(flatten(array_repeat("
                      "slice(words, cast(a + 1 as int), cast(p as int)), cast(ceil((n - a) / p) as int))), 1, cast(n - a as int)))")  # fmt: skip
    return d.select("doc_id", F.when(F.col("n") > 0, F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


@query("op12_periodic_runs")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    # exact comparison of length / period; runs come by start, then period, so the first of equals stays
    none = F.struct(*[F.lit(x).cast("long").alias(c) for c, x in (("start", 0), ("length", 0), ("period", 1))])
    best = F.aggregate("runs", none, lambda b, r: F.when(r["length"] * b["period"] > b["length"] * r["period"], r).otherwise(b))
    best = F.when(F.size("runs") > 0, best)
    lines = F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"]))
    out = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), lines.alias("lines"), "collapsed")
    return out.select(
        "doc_id",
        "n_runs",
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join("lines", "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


# ------------------------------------------------------ 13 SentencePiece
@query("op13_sentencepiece")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = piece_bpe.PieceTokenizer(spark, public_tokenizers.path("piece_bpe_32k.model"))
    coded = tokenizer.decode(tokenizer.encode(table(spark, sf_dir, "documents")))
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
