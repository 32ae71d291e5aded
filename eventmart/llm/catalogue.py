"""One query per operator over its whole table, and expected-result SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.llm import (
    bpe,
    conversations,
    factors,
    jaccard,
    lines,
    neighbours,
    packing,
    periodic,
    quality,
    shards,
    suffixes,
    topk,
    urls,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
EXPECTED: dict[str, str] = {}

BLANK = r"\x20\x09-\x0D"
# Fixed values of the URL query: host, path, verdict.
RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def query(name: str, expected: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if expected:
            EXPECTED[name] = expected
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# CRC-32 in SQL: its table of 256 entries, and the value of an ASCII string by it.
CRC_TABLE = """(SELECT list(x ORDER BY i) AS crc_table FROM (SELECT i, list_reduce(
      [i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c % 2 = 1
      THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS x FROM range(256) AS r(i)))"""


def _crc32(text: str) -> str:
    return f"""xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
      string_split({text}, ''), lambda z: ascii(z)::BIGINT)),
      lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255) + 1])), 4294967295::BIGINT)"""


@query("op1_packing")
def op1_packing(spark, sf_dir):
    packed = packing.pack(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def _gram(n: int) -> str:
    rest = "".join(f", lead(word, {k}) OVER o" for k in range(1, n))
    return f"""t{n} AS (SELECT doc_id, i, lead(i, {n - 1}) OVER o AS ends,
        concat_ws(' ', word{rest}) AS gram FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
    a{n} AS (SELECT doc_id, gram FROM t{n} WHERE ends IS NOT NULL
        GROUP BY doc_id, gram HAVING count(*) > 1),
    g{n} AS (SELECT doc_id, i, max(CASE WHEN a{n}.gram IS NOT NULL AND ends IS NOT NULL
          THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i
          ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS covered
        FROM t{n} LEFT JOIN a{n} USING (doc_id, gram))"""


def _gram_sum(n: int, what: str) -> str:
    return f"""(SELECT doc_id, sum({what}) AS s{n} FROM g{n} JOIN w USING (doc_id, i)
        WHERE covered = 1 GROUP BY doc_id)"""


_GRAMS = (quality.WINDOW, *quality.MAX_GRAM_PERCENT)
QUALITY_SQL = f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text,
      regexp_extract_all(coalesce(text, ''), '[^{BLANK}]+') AS ws FROM documents),
    w AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM d),
    l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
      generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d),
    r AS (SELECT doc_id, regexp_extract_all(line, '[^{BLANK}]+') AS lw,
      row_number() OVER (PARTITION BY doc_id, line ORDER BY i) AS nth FROM l),
    r2 AS (SELECT doc_id, count(*) AS n_dup_lines,
      sum(length(array_to_string(lw, ''))) AS n_dup_line_chars
      FROM r WHERE nth > 1 AND len(lw) > 0 GROUP BY doc_id),
    {", ".join(_gram(n) for n in _GRAMS)},
    m AS (SELECT d.doc_id, len(ws)::BIGINT AS n_words,
        length(array_to_string(ws, ''))::BIGINT AS word_chars,
        (length(text) - length(translate(text, '{quality.SYMBOLS}', '')))::BIGINT AS n_symbols,
        coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(s3, 0)::BIGINT AS n_repeat_words,
        coalesce(n_dup_line_chars, 0)::BIGINT AS n_dup_line_chars,
        {", ".join(f"coalesce(s{n}, 0)::BIGINT AS n_dup_{n}gram_chars" for n in _GRAMS[1:])}
      FROM d LEFT JOIN r2 USING (doc_id) LEFT JOIN {_gram_sum(3, "1")} USING (doc_id)
      {" ".join(f"LEFT JOIN {_gram_sum(n, 'length(word)')} USING (doc_id)" for n in _GRAMS[1:])}),
    v AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
    SELECT *, NOT base_failed AND 100 * n_dup_line_chars <= {quality.MAX_LINE_PERCENT} * word_chars
      AND {" AND ".join(f"100 * n_dup_{n}gram_chars <= {p} * word_chars"
                        for n, p in quality.MAX_GRAM_PERCENT.items())} AS kept FROM v"""


@query("op2_quality", QUALITY_SQL)
def op2_quality(spark, sf_dir):
    return quality.judge(table(spark, sf_dir, "documents"))


@query(
    "op3_url_filter",
    f"""WITH rules(rule_host, rule_path, verdict) AS (VALUES {", ".join(map(str, RULES))}),
    p AS (SELECT page_id, url, CASE WHEN contains(url, '://')
        THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
    q AS (SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*'),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
    f AS (SELECT page_id, url, rule_host || rule_path AS rule, verdict FROM q JOIN rules
        ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
        QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC) = 1)
    SELECT q.page_id, q.url, host, path, rule, coalesce(verdict, 'allow') AS verdict
    FROM q LEFT JOIN f USING (page_id)""",
)
def op3_url_filter(spark, sf_dir):
    return urls.judge(table(spark, sf_dir, "pages"), urls.rule_table(spark, RULES))


@query("op4_bpe")
def op4_bpe(spark, sf_dir):
    coded = bpe.encode_decode(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op5_suffix_dedup")  # byte by byte, SQL takes minutes on the smallest tables
def op5_suffix_dedup(spark, sf_dir):
    kept = suffixes.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


@query(
    "op6_line_dedup",
    f"""WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
    k AS (SELECT *, translate(regexp_replace(line, '^[{BLANK}]+|[{BLANK}]+$', '', 'g'),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
    f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key
        HAVING count(DISTINCT doc_id) >= 10)
    SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped, sha256(coalesce(
        string_agg(line, chr(10) ORDER BY i) FILTER (f.key IS NULL), '')) AS kept_sha256
    FROM k LEFT JOIN f USING (key) GROUP BY doc_id""",
)
def op6_line_dedup(spark, sf_dir):
    kept = lines.drop_frequent_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query("op7_sharding")
def op7_sharding(spark, sf_dir):
    placed = shards.assign(table(spark, sf_dir, "documents"))
    return placed.select(
        "*", F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    )


@query(
    "op8_substring_dedup",
    f"""WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^{BLANK}]+') AS ws
        FROM documents),
    s AS (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 34)) AS i FROM d
        WHERE len(ws) >= 35),
    k AS (SELECT doc_id, i, sha256(array_to_string(ws[i:i + 34], ' ')) AS k FROM s),
    w AS (SELECT doc_id, i, count(*) OVER (PARTITION BY k) > 1 AS again FROM k),
    p AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM d),
    c AS (SELECT doc_id, i, word, coalesce(max(again::INT) OVER (
        PARTITION BY doc_id ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW), 0) AS gone
        FROM p LEFT JOIN w USING (doc_id, i)),
    f AS (SELECT doc_id, sum(gone)::BIGINT AS n_removed,
        string_agg(word, ' ' ORDER BY i) FILTER (gone = 0) AS kept FROM c GROUP BY doc_id)
    SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed,
        sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN f USING (doc_id)""",
)
def op8_substring_dedup(spark, sf_dir):
    kept = factors.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query(
    "op9_top_k",
    """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
        FROM embeddings WHERE embedding IS NOT NULL),
    s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
        list_inner_product(q.e, c.e)::BIGINT AS score
        FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT
        AS rank, vec_id, score FROM s QUALIFY rank <= 5""",
)
def op9_top_k(spark, sf_dir):
    return topk.search(table(spark, sf_dir, "embeddings"))


@query(
    "op10_jaccard_join",
    f"""WITH RECURSIVE d AS (SELECT doc_id,
        regexp_extract_all(coalesce(text, ''), '[^{BLANK}]+') AS ws FROM documents),
    m AS (SELECT doc_id, array_to_string(ws, ' ') AS k, ws FROM d WHERE len(ws) > 0),
    t AS (SELECT k, min(doc_id) AS text_id, count(*) AS n_copies, any_value(ws) AS ws
        FROM m GROUP BY k),
    u AS (SELECT text_id, ws, unnest(generate_series(1, greatest(len(ws) - 4, 1))) AS i FROM t),
    g AS (SELECT DISTINCT text_id, array_to_string(ws[i:i + 4], ' ') AS g FROM u),
    n AS (SELECT text_id, count(*) AS n FROM g GROUP BY text_id),
    l AS (SELECT a.text_id AS a, b.text_id AS b, count(*) AS c
        FROM g a JOIN g b ON a.g = b.g AND a.text_id <> b.text_id GROUP BY ALL),
    e AS (SELECT a, b FROM l JOIN n x ON a = x.text_id JOIN n y ON b = y.text_id
        WHERE 100 * c >= 80 * (x.n + y.n - c)),
    r AS (SELECT text_id, text_id AS other FROM t UNION SELECT r.text_id, e.b
        FROM r JOIN e ON r.other = e.a),
    h AS (SELECT text_id, min(other) AS class_id FROM r GROUP BY text_id),
    s AS (SELECT a AS text_id, count(*) AS n_links FROM e GROUP BY a)
    SELECT doc_id, class_id, text_id, n_copies, coalesce(n_links, 0) AS n_links
    FROM m JOIN t USING (k) JOIN h USING (text_id) LEFT JOIN s USING (text_id)
    UNION ALL SELECT doc_id, doc_id, doc_id, 1, 0 FROM d WHERE len(ws) = 0""",
)
def op10_jaccard_join(spark, sf_dir):
    return jaccard.JaccardJoin(table(spark, sf_dir, "documents")).classified()


def _period_scales(scales: int = 14) -> str:
    """A window of 2b - 1 words that next occurs q words on, for q from b to 2b - 1, lies in a
    stretch of smallest period q; hashes of b words are made of two hashes of half as many."""
    parts, unions = [], []
    for scale in range(scales):
        b = 1 << scale
        half = f"h{b // 2}"
        if scale:
            parts.append(f"""h{b} AS (SELECT doc_id, i, CASE WHEN lead(h, {b // 2}) OVER o IS NOT NULL
                THEN hash(h, lead(h, {b // 2}) OVER o) END AS h FROM {half}
                WINDOW o AS (PARTITION BY doc_id ORDER BY i))""")
        unions.append(f"""SELECT doc_id, i, q, {2 * b - 1} AS size FROM (
            SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id, h, h2 ORDER BY i) - i AS q FROM (
              SELECT doc_id, i, h, lead(h, {b - 1}) OVER (PARTITION BY doc_id ORDER BY i) AS h2
              FROM h{b}) WHERE h2 IS NOT NULL) WHERE q >= {b} AND q < {2 * b}""")
    return ", ".join([*parts, f"same AS ({' UNION ALL '.join(unions)})"])


@query(
    "op11_periodic_runs",
    f"""WITH c AS {CRC_TABLE},
    d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^{BLANK}]+') AS ws,
        {_crc32("doc_id::VARCHAR")} AS hash_ FROM documents, c),
    a AS (SELECT doc_id, ws, len(ws) AS n, hash_ % 10 = 0 AND len(ws) > 0 AS again,
        (hash_ // 10) % greatest(len(ws), 1) AS a, 3 + (hash_ // 10) % 8 AS f FROM d),
    t AS (SELECT doc_id, n, CASE WHEN again THEN list_transform(range(n), lambda i: CASE
        WHEN i < a THEN ws[i + 1] ELSE ws[a + (i - a) % (1 + (n - a) // f) + 1] END) ELSE ws END
        AS ws FROM a),
    w AS (SELECT doc_id, unnest(ws) AS word, unnest(range(n)) AS i FROM t),
    h1 AS (SELECT doc_id, i, hash(word) AS h FROM w),
    {_period_scales()},
    s AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS stretch FROM same),
    r AS (SELECT doc_id, min(i) AS start, max(i) - min(i) + size + q AS length, q AS period
        FROM s GROUP BY doc_id, q, size, stretch HAVING length >= greatest(24, 3 * q)),
    b AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY doc_id
        ORDER BY length::DOUBLE / period DESC, start, period) = 1),
    l AS (SELECT doc_id, count(*) AS n_runs, string_agg(
        start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed
        FROM r GROUP BY doc_id),
    g AS (SELECT DISTINCT w.doc_id, i FROM w JOIN r ON w.doc_id = r.doc_id
        AND i >= start + period AND i < start + length),
    k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept
        FROM w ANTI JOIN g USING (doc_id, i) GROUP BY doc_id)
    SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period,
        1000 * length // period AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256,
        sha256(coalesce(kept, '')) AS collapsed_sha256
    FROM t LEFT JOIN l USING (doc_id) LEFT JOIN b USING (doc_id) LEFT JOIN k USING (doc_id)""",
)
def op11_periodic_runs(spark, sf_dir):
    found = periodic.collapse_runs(_repeated_tails(table(spark, sf_dir, "documents")))
    more = lambda a, b: a["length"] * b["period"] > b["length"] * a["period"]
    best = F.reduce(
        "runs", F.get("runs", F.lit(0)), lambda best, x: F.when(more(x, best), x).otherwise(best)
    )
    listed = F.transform(
        "runs", lambda x: F.concat(F.concat_ws(",", x["start"], x["length"], x["period"]), F.lit("\n"))
    )
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"),
    )


def _repeated_tails(documents: DataFrame) -> DataFrame:
    """The contract's input: in one document of ten the words from some place on repeat."""
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda x: x != "")
    cut = documents.select(
        "doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("h")
    ).withColumn("words", F.when(F.col("h") % 10 == 0, words))
    n, g = F.size("words"), F.floor(F.col("h") / 10)
    placed = cut.withColumn("n", n).withColumn("a", F.when(n > 0, g % n).cast("int"))
    period = (1 + F.floor((F.col("n") - F.col("a")) / (3 + g % 8))).cast("int")
    tail = placed.withColumn("p", period).select(
        "doc_id",
        F.when(
            F.col("n") > 0,
            F.expr("""array_join(concat(slice(words, 1, a), slice(flatten(array_repeat(
                slice(words, a + 1, p), cast(ceil((n - a) / p) AS int))), 1, n - a)), ' ')"""),
        ).otherwise(F.col("text")).alias("text"),
    )
    return tail


def _damaged(conversations_: DataFrame) -> DataFrame:
    """The contract's input: rows dropped, emptied, cut, repeated or of another role."""
    space = F.lit(" ")
    rows = conversations_.select(
        "conv_id", "turn",
        F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"),
        (F.crc32(F.concat_ws(
            ":", *(F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn"))
        )) % 20).alias("h"),
    )
    return rows.filter("h <> 0").select(
        "conv_id", "turn",
        F.when(F.col("h") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"),
        F.explode(F.expr("IF(h = 3, array(0, 1), array(0))")).alias("copy"),
    ).drop("copy")


@query(
    "op12_conversation_repair",
    f"""WITH RECURSIVE c AS {CRC_TABLE},
    b AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS h
        FROM conversations, c),
    e AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
        CASE h WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
        unnest(CASE WHEN h = 3 THEN [0, 1] ELSE [0] END) AS copy FROM b WHERE h <> 0),
    n AS (SELECT *, row_number() OVER (PARTITION BY conv_id
        ORDER BY turn NULLS FIRST, role, text, copy) AS i, left(role, 1) AS r,
        rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS s FROM e),
    f AS (SELECT conv_id, turn, role, text, i, r, CASE WHEN s = '' THEN 'blank'
        WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
        WHEN right(s, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
        lag(r) OVER (PARTITION BY conv_id ORDER BY i) || r AS pair FROM n),
    x(q, initials, inserts, q2) AS (VALUES (0, '', 0, 0), (0, 'I', 5, 2), (0, 'II', 10, 3),
        (1, '', 0, 1), (1, 'I', 5, 2), (1, 'II', 10, 3), (2, '', 0, 2), (2, 'I', 5, 3),
        (3, '', 0, 3), (3, 'I', 5, 2)),
    k(r, q, q2) AS (VALUES ('s', 0, 1), ('u', 0, 2), ('u', 1, 2), ('a', 2, 3), ('u', 3, 2)),
    g(q, q2) AS (VALUES (0, 2), (1, 2), (2, 3), (3, 2)),
    m AS (SELECT f.conv_id, i, x.q, 'D' AS edit, inserts + 2 AS cost, initials, x.q2 AS q3
        FROM f, x
      UNION ALL SELECT f.conv_id, i, x.q, 'K', inserts + 5 * (fault IS NOT NULL)::INT, initials, k.q2
        FROM f, x JOIN k ON x.q2 = k.q WHERE f.r = k.r AND (fault IS NULL OR fault = 'truncated')
      UNION ALL SELECT f.conv_id, i, x.q, 'R', inserts + 1 + 5 * (fault IS NOT NULL)::INT, initials,
        g.q2 FROM f, x JOIN g ON x.q2 = g.q WHERE fault IS NULL OR fault = 'truncated'),
    p AS (SELECT DISTINCT conv_id, 0::BIGINT AS i, 0 AS q, 0 AS cost, '' AS audit FROM f
      UNION ALL (SELECT conv_id, i, q3, cost, audit FROM (SELECT p.conv_id, m.i, m.q3,
          p.cost + m.cost AS cost, p.audit || m.initials || m.edit AS audit
        FROM p JOIN m ON p.conv_id IS NOT DISTINCT FROM m.conv_id AND m.i = p.i + 1 AND m.q = p.q)
        QUALIFY row_number() OVER (PARTITION BY conv_id, q3 ORDER BY cost, audit) = 1)),
    z AS (SELECT conv_id, max(i) AS n, sum((fault = 'blank')::INT) AS blank,
        sum((fault = 'duplicate')::INT) AS duplicate, sum((fault = 'truncated')::INT) AS truncated,
        sum((pair NOT IN ('su', 'ua', 'au'))::INT) AS illegal,
        max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps FROM f GROUP BY conv_id),
    o AS (SELECT p.conv_id, p.cost + inserts AS cost, audit || initials AS audit
        FROM p JOIN z ON p.conv_id IS NOT DISTINCT FROM z.conv_id AND p.i = z.n
        JOIN x ON x.q = p.q WHERE x.q2 IN (0, 3)
        QUALIFY row_number() OVER (PARTITION BY p.conv_id ORDER BY p.cost + inserts,
          audit || initials) = 1),
    u AS (SELECT conv_id, unnest(string_split(audit, '')) AS edit,
        unnest(range(length(audit))) AS pos, length(replace(audit, 'D', '')) % 2 AS odd
        FROM o WHERE audit <> ''),
    v AS (SELECT *, sum((edit <> 'I')::INT) OVER w AS row, sum((edit <> 'D')::INT) OVER w - 1 AS place
        FROM u WINDOW w AS (PARTITION BY conv_id ORDER BY pos)),
    y AS (SELECT v.conv_id, sha256(string_agg(CASE WHEN edit = 'K' THEN role
          WHEN (place - odd) % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' ||
          CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY pos)) AS digest
        FROM v LEFT JOIN f ON v.conv_id IS NOT DISTINCT FROM f.conv_id AND v.row = f.i
        WHERE edit <> 'D' GROUP BY v.conv_id)
    SELECT a.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
      coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
      coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
      coalesce(audit, '') AS audit, coalesce(digest, sha256('')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) a
    LEFT JOIN z ON a.conv_id IS NOT DISTINCT FROM z.conv_id
    LEFT JOIN o ON a.conv_id IS NOT DISTINCT FROM o.conv_id
    LEFT JOIN y ON a.conv_id IS NOT DISTINCT FROM y.conv_id""",
)
def op12_conversation_repair(spark, sf_dir):
    given = table(spark, sf_dir, "conversations")
    repair = conversations.ConversationRepair(_damaged(given))
    found = repair.audits().selectExpr("conv_id AS id", "* EXCEPT (conv_id)")
    digests = repair.digests().withColumnRenamed("conv_id", "digest_id")
    every = given.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return (
        every.join(found, F.col("conv_id").eqNullSafe(F.col("id")), "left")
        .join(digests, F.col("conv_id").eqNullSafe(F.col("digest_id")), "left")
        .select(
            "conv_id",
            *(F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in numbers),
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
        )
    )


# Exact neighbours: at the size of the comparison a search finds all of them.
@query(
    "op13_neighbours",
    """WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, sqrt(list_reduce(list_transform(
        range(1, len(q.e) + 1), lambda i: (q.e[i] - c.e[i]) * (q.e[i] - c.e[i])),
        lambda x, y: x + y)) AS score
      FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id)
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id)::INT AS rank,
      vec_id, score FROM s QUALIFY rank <= 10""",
)
def op13_neighbours(spark, sf_dir):
    return neighbours.search(table(spark, sf_dir, "embeddings"))
