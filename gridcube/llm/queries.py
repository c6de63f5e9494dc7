"""The registered queries of the training-data operators and their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridcube.llm import ann, bpe, decontaminate, fingerprint, mixing, pii, quality, repair, sharding, simhash, toxicity, urls, whitening
from gridcube.llm.digests import running_sha256
from gridcube.session import materialize

TOXIC_AT, GOOD_AT = 0.7, 0.3


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_of(column: str):
    """crc32 of a number as text."""
    return F.expr(f"crc32(cast(cast({column} as string) as binary))")


def op1_simhash(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=3)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op2_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), crc_of("id") % 3 != 1)
    return toxicity.score(docs, model, keep=["doc_id"], out="score") \
        .select("doc_id", F.coalesce(crc_of("doc_id") % 3 == 1, F.lit(False)).alias("held_out"), "score",
                F.when(F.col("score") >= TOXIC_AT, 1).otherwise(0).alias("predicted"))


def op3_mixing(spark, sf_dir):
    plan = mixing.copies(table(spark, sf_dir, "documents"))
    return plan.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op4_sharding(spark, sf_dir):
    # the shards are written with their documents; sizes and digests are of what was written
    shards = sharding.write(table(spark, sf_dir, "documents"), 24)
    text = F.coalesce("text", F.lit("")).cast("binary")
    return shards.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
                         F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_ann(spark, sf_dir):
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, 10)


def op6_pii(spark, sf_dir):
    shown = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat(s.kind, F.lit(":"), s.start, F.lit(":"), s.end)), ",")
    count = lambda kind: F.size(F.filter("pii", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")
    found = pii.with_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", *[count(k) for k in pii.BASE],
                        F.sha2(shown(F.filter("pii", lambda s: s.kind.isin(*pii.BASE))), 256).alias("base_sha256"), shown(F.col("pii")).alias("spans"))


def op7_fingerprint(spark, sf_dir):
    return fingerprint.compare_with_next(table(spark, sf_dir, "documents"))


def tokenizer() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op8_bpe(spark, sf_dir):
    ids = bpe.encode(table(spark, sf_dir, "documents"), *tokenizer(), keep=["doc_id"])
    return bpe.decode(ids, *tokenizer()).select(
        "doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_urls(spark, sf_dir):
    return urls.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op10_quality(spark, sf_dir):
    stats = materialize(quality.with_statistics(table(spark, sf_dir, "documents")), "statistics")
    model = quality.fit(stats, table(spark, sf_dir, "labels"), crc_of("id") % 5 != 0)
    return quality.score(stats, model, "score") \
        .select(F.col("id").alias("doc_id"), F.coalesce(crc_of("id") % 5 == 0, F.lit(False)).alias("held_out"), "score",
                F.when(F.col("score") >= GOOD_AT, 1).otherwise(0).alias("predicted"))


def damaged(turns):
    """Conversations with the faults of the test: by crc32(conv_id:turn) % 20 a
    turn is lost (0), emptied (1), robbed of its marks (2), said twice (3) or
    given to the user (4). NULLs are one space there; the turn itself stays NULL."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
                        (F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20).alias("k")).where("k <> 0")
    text = F.when(F.col("k") == 1, "").when(F.col("k") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(F.col("k") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       F.explode(F.array_repeat(F.lit(0), F.when(F.col("k") == 3, 2).otherwise(1))).alias("copy")).drop("copy")


def op11_repair(spark, sf_dir):
    """Audit and digest are put together chunk by chunk where the turns lie; only
    conversations of several chunks are shuffled once more, a row a chunk."""
    turns = table(spark, sf_dir, "conversations")
    fixed = repair.repair(damaged(turns))
    line = F.when(F.col("action") != "D", F.concat("role", F.lit(":"), "text"))
    parts = fixed.turns.groupBy("chunk", "conv", "only").agg(F.sort_array(F.collect_list(F.struct("k", "action", line.alias("line")))).alias("e"))
    lines = F.filter(F.transform("e", lambda e: e.line), lambda x: x.isNotNull())
    parts = materialize(parts.select("conv", "chunk", "only", F.array_join(F.transform("e", lambda e: e.action), "").alias("audit"),
                                     F.when(F.col("only"), F.sha2(F.array_join(lines, "\n"), 256)).alias("sha"),
                                     F.when(~F.col("only") & (F.size(lines) > 0), F.array_join(lines, "\n")).alias("said")), "audits")
    whole = parts.where("only").select("conv", "audit", F.col("sha").alias("repaired_sha256"))
    cut = parts.where("not only")
    audit = cut.groupBy("conv").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("chunk", "audit"))), lambda a: a.audit), "").alias("audit"))
    sha = running_sha256(cut, "conv", "chunk", "said", "\n").withColumnRenamed("sha256", "repaired_sha256")
    whole = whole.unionByName(audit.join(sha.withColumnRenamed("conv", "c"), F.col("conv").eqNullSafe(F.col("c"))).drop("c"))
    every = turns.select("conv_id").distinct()
    zero = F.lit(0).cast("long")
    out = every.join(fixed.conversations, F.col("conv_id").eqNullSafe(F.col("conv")), "left").drop("conv") \
        .join(whole, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
    return out.select("conv_id", *[F.coalesce(c, zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                      F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op12_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"), 32)


def op13_decontaminate(spark, sf_dir):
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10, keep=["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


OP3_SQL = r"""
WITH rows AS (SELECT doc_id, source, md5(coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, ''))) AS h, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
per AS (SELECT source, sum(size)::DOUBLE AS s, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS pos FROM rows GROUP BY source),
w AS (SELECT *, list_extract([3.0, 1.0, 2.0]::DOUBLE[], (pos % 3 + 1)::INT) AS w FROM per),
o AS (SELECT *, row_number() OVER cap AS nth, coalesce(sum(s) OVER (cap ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * 2.0 AS before,
  sum(w) OVER () - coalesce(sum(w) OVER (cap ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest, sum(s) OVER () * 1.5 AS budget
  FROM w WINDOW cap AS (ORDER BY s / w, source NULLS LAST)),
l AS (SELECT *, (budget - before) / rest AS level FROM o),
t AS (SELECT source, s, least((SELECT arg_min(level, nth) FROM l WHERE level * w <= 2.0 * s) * w, 2.0 * s) AS target,
  ('0x' || substr(md5('mix:' || coalesce(source, '')), 1, 5))::BIGINT / 1048576.0::DOUBLE AS u FROM l),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, h) - 1 AS r FROM rows),
c AS (SELECT r.*, t.s, t.target, t.u, CASE WHEN t.s > 0 THEN t.target / t.s ELSE 0 END AS e FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, s::BIGINT AS source_size, target, ((floor(e * (r + 1) + u) - floor(e * r + u)) * size)::BIGINT AS taken FROM c
"""


def _op6_sql() -> str:
    def find(pattern, keep):
        pieces, found = f"string_split_regex(t, '{pattern}')", f"regexp_extract_all(t, '{pattern}')"
        return (f"list_filter(list_transform(range(1, len({found}) + 1), lambda i: {{'m': {found}[i], "
                f"'a': coalesce(list_sum(list_transform({pieces}[:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform({found}[:i - 1], lambda x: length(x))), 0)}}), "
                f"lambda x: {keep})")
    digits = "regexp_replace(x.m, '[^0-9]', '', 'g')"
    at = f"substr({digits}, length({digits}) - j + 1, 1)::INT"
    luhn = (f"length({digits}) BETWEEN 16 AND 19 AND list_sum(list_transform(range(1, length({digits}) + 1), lambda j: "
            f"CASE WHEN j % 2 = 0 THEN {at} * 2 - CASE WHEN {at} > 4 THEN 9 ELSE 0 END ELSE {at} END)) % 10 = 0")
    # 48 characters on either side of the match
    near = "(substr(t, greatest(x.a - 47, 1)::BIGINT, least(x.a, 48)::BIGINT) || chr(10) || substr(t, (x.a + length(x.m) + 1)::BIGINT, 48))"
    context = (f"0.4 + CASE WHEN regexp_matches({near}, '(?i)\\b(?:ssn|social|security)') THEN 0.3 ELSE 0 END"
               f" - CASE WHEN regexp_matches({near}, '(?i)\\b(?:part|order)') THEN 0.3 ELSE 0 END >= 0.6")
    kinds = {"email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true"),
             "ip": (r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", "len(list_filter(string_split(x.m, '.'), lambda y: y::HUGEINT > 255)) = 0"),
             "card": (r"[0-9](?:[\x20-]?[0-9])+", luhn), "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", f"length({digits}) BETWEEN 8 AND 15"),
             # whole runs of digits and hyphens, so that nothing of the kind stands beside the number
             "ssn": (r"[0-9-]+", f"regexp_full_match(x.m, '[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}') AND NOT regexp_matches(x.m, '^(?:000|666|9)|-00-|-0000$') AND {context}")}
    cols = ", ".join(f"list_transform({find(p, keep)}, lambda x: '{k}:' || x.a || ':' || (x.a + length(x.m))) AS {k}" for k, (p, keep) in kinds.items())
    base = "list_concat(list_concat(list_concat(email, ip), card), phone)"
    return (f"WITH f AS (SELECT doc_id, {cols} FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)) "
            f"SELECT doc_id, len(email)::BIGINT AS n_email, len(ip)::BIGINT AS n_ip, len(card)::BIGINT AS n_card, len(phone)::BIGINT AS n_phone, "
            f"sha256(coalesce(array_to_string({base}, ','), '')) AS base_sha256, coalesce(array_to_string(list_concat({base}, ssn), ','), '') AS spans FROM f")


OP9_SQL = r"""
WITH RECURSIVE p AS (SELECT page_id, url, html, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
rules(action, h, r) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
judged AS (SELECT p.page_id, arg_max(h || r, length(h || r)) AS rule, arg_max(action, length(h || r)) AS action
  FROM p JOIN rules ON (p.host = h OR ends_with(p.host, '.' || h)) AND starts_with(p.path, r) GROUP BY p.page_id),
links AS (SELECT regexp_replace(url, '(?s)#.*$', '') AS a, unnest(regexp_extract_all(html, '(?is)<link\b[^>]*rel\s*=\s*["'']?canonical\b[^>]*>')) AS tag FROM pages),
edges AS (SELECT a, regexp_replace(regexp_extract(tag, '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1), '(?s)#.*$', '') AS b FROM links),
both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reach AS (SELECT a, b FROM both_ways UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a),
bad AS (SELECT DISTINCT reach.a FROM reach JOIN p ON regexp_replace(p.url, '(?s)#.*$', '') = reach.b JOIN judged USING (page_id) WHERE judged.action = 'block')
SELECT p.page_id, p.host, p.path, judged.rule, coalesce(judged.action, CASE WHEN bad.a IS NOT NULL THEN 'block' END, 'allow') AS verdict
FROM p LEFT JOIN judged USING (page_id) LEFT JOIN bad ON bad.a = regexp_replace(p.url, '(?s)#.*$', '')
"""

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP13_SQL = rf"""
WITH items AS (SELECT item_id::VARCHAR AS item, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
windows AS (SELECT DISTINCT item, least(len(w), 10) AS size, array_to_string(w[i + 1:i + 10], ' ') AS win
  FROM (SELECT item, w, unnest(range(greatest(len(w) - 9, 1))) AS i FROM items WHERE len(w) > 0)),
docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
grams AS (SELECT r, i, size, array_to_string(w[i + 1:i + size], ' ') AS win FROM (
  SELECT r, w, size, unnest(range(len(w) - size + 1)) AS i FROM docs, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)),
found AS (SELECT r, i, g.size, item FROM grams g JOIN windows v ON g.win = v.win),
words AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + size)) AS j FROM found) GROUP BY r),
ids AS (SELECT r, count(*) AS n_items, array_to_string(list(item ORDER BY item), ',') AS ids FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (r) LEFT JOIN ids USING (r)
"""

QUERIES = {f.__name__: f for f in (op1_simhash, op2_toxicity, op3_mixing, op4_sharding, op5_ann, op6_pii, op7_fingerprint,
                                   op8_bpe, op9_urls, op10_quality, op11_repair, op12_whitening, op13_decontaminate)}
ORACLE = {"op3_mixing": OP3_SQL, "op6_pii": _op6_sql(), "op9_urls": OP9_SQL, "op13_decontaminate": OP13_SQL}
