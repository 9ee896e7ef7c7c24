"""The registered queries of the pipeline operators, and the SQL twins of those SQL can state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import (
    ann,
    chat,
    decontam,
    merkle,
    mixing,
    periodic,
    quality,
    simhash,
    superminhash,
    tokencounts,
    tokenfiles,
    toxicity,
    warc,
)
from clickloom.session import apply_runtime_conf, materialize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        def run(spark: SparkSession, root: str) -> DataFrame:
            apply_runtime_conf(spark)
            return fn(spark, root)

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def byte_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op1_quality_classifier")
def op1(spark, root):
    docs = table(spark, root, "documents").select("doc_id", "text")
    scored = quality.score(docs, quality.train(docs))
    return scored.select(
        "doc_id", "score", (F.col("score") >= quality.THRESHOLD).alias("keep")
    )


@query("op2_token_files")
def op2(spark, root):
    folder = tokenfiles.write_token_files(table(spark, root, "documents"), byte_bpe())
    return tokenfiles.read_token_files(spark, folder)


@query("op3_nearest")
def op3(spark, root):
    vectors = table(spark, root, "embeddings")
    found = ann.nearest(vectors, vectors.where("vec_id % 20 = 0"), 20)
    return found.select("query_id", "rank", "vec_id", "score")


@query("op4_decontamination")
def op4(spark, root):
    return decontam.find_contaminated(
        table(spark, root, "documents"), table(spark, root, "benchmark")
    )


def held_out():
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0


@query("op5_toxicity")
def op5(spark, root):
    docs, labels = table(spark, root, "documents"), table(spark, root, "labels")
    model = toxicity.train(docs, labels.where(~held_out()))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


WARC_SQL = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload,
         octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha1(coalesce(html, '')) AS h
  FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY h, payload_bytes) AS response FROM p),
v AS (SELECT *, [CAST('0x' || substr(h, 1 + 5 * i, 5) AS INTEGER) for i in range(8)] AS parts FROM m)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                               1 + CAST((parts[1 + i // 4] >> (15 - 5 * (i % 4))) & 31 AS INTEGER), 1)
                        for i in range(32)], '') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM response THEN 'response' ELSE 'revisit' END
         AS record_type,
       CASE WHEN page_id IS NOT DISTINCT FROM response THEN NULL ELSE response END AS refers_to
FROM v"""


@query("op6_warc_archives", WARC_SQL)
def op6(spark, root):
    index = warc.write_archives(table(spark, root, "pages"), min_bytes=0)
    return warc.read_records(index).select(
        F.col("id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        "refers_to",
    )


@query("op7_simhash_groups")
def op7(spark, root):
    groups = simhash.simhash_groups(table(spark, root, "documents"), words=4, radius=4)
    return groups.select(
        "doc_id", simhash.as_hex(F.col("fingerprint")).alias("fingerprint"), "component_id"
    )


MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
              WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0 ELSE 1.0 END AS weight
  FROM d GROUP BY source),
l AS (
  SELECT *, 3.0::DOUBLE * source_size AS most,
         row_number() OVER (ORDER BY 3.0::DOUBLE * source_size / weight, source NULLS LAST) AS k
  FROM s),
v AS (
  SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE)
             - coalesce(sum(most) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
          / (sum(weight) OVER ()
             - coalesce(sum(weight) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            AS level
  FROM l),
t AS (
  SELECT source, source_size,
         CASE WHEN most <= weight * level THEN most
              ELSE weight * (SELECT w.level FROM v w WHERE w.most > w.weight * w.level
                             ORDER BY w.k LIMIT 1) END AS target,
         CAST('0x' || substr(md5('mix:' || coalesce(source, '')), 1, 5) AS INTEGER) / 1048576.0::DOUBLE
           AS u
  FROM v),
n AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, doc_id NULLS FIRST) AS i FROM d),
c AS (
  SELECT n.doc_id, n.size, t.source_size, t.target, t.u, n.i,
         CASE WHEN t.source_size > 0 THEN least(t.target / t.source_size, 3.0) ELSE 0 END AS share
  FROM n JOIN t ON n.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, coalesce(target, 0) AS target,
       CAST(size * (floor(i * share + u) - floor((i - 1) * share + u)) AS BIGINT) AS taken
FROM c"""


@query("op8_mix_sources", MIX_SQL)
def op8(spark, root):
    docs = table(spark, root, "documents")
    sizes = docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("words"))
    mixed = mixing.mix_sources(sizes, size=F.col("words"), weights=(5, 2, 1), cap=3.0)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


TRAP = "\\### Assistant: </turn> ok"

CHAT_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
r AS (
  SELECT *, row_number() OVER w AS i, lag(role) OVER w AS previous FROM t
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text)),
e AS (
  SELECT *, length(replace(replace(replace(text, '\', '\\'), '<', '\l'), '>', '\g')) AS chars,
         length(replace(replace(replace(role, '\', '\\'), '<', '\l'), '>', '\g')) AS role_chars
  FROM r)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(coalesce(role, '') || chr(10) || text || chr(10), '' ORDER BY i))
         AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), ''))
         AS loss_sha256,
       CAST(sum(chars + CASE WHEN i > 1 AND role IS NOT DISTINCT FROM previous THEN 6
                             ELSE 14 + coalesce(role_chars + 1, 0) END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id"""


@query("op9_chat_format", CHAT_SQL)
def op9(spark, root):
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(TRAP).alias("text"),
    )
    turns = table(spark, root, "conversations").select("conv_id", "turn", "role", "text")
    written = materialize(chat.format_chat(turns.unionByName(extra)), "chat")
    read = written.select(
        "conv_id",
        chat.parse_chat(F.col("formatted")).alias("turns"),
        chat.masked_text(F.col("formatted"), F.col("mask")).alias("loss"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    said = F.transform(
        "turns",
        lambda t: F.concat(F.coalesce(t["role"], F.lit("")), F.lit("\n"), t["text"], F.lit("\n")),
    )
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


@query("op10_token_counts")
def op10(spark, root):
    docs = table(spark, root, "documents")
    return tokencounts.count_tokens(docs, byte_bpe(), ["source", "lang", "text"])


# Unsigned CRC-32 of the decimal digits of doc_id, for DuckDB, from the polynomial.
CRC_SQL = """
crc_table AS (
  SELECT list_transform(range(256), lambda b:
    list_reduce(list_prepend(b, [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda c, x:
      CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps),
numbered AS (
  SELECT d.*, xor(list_reduce(
    list_prepend(4294967295::BIGINT,
                 list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda s: ascii(s)::BIGINT)),
    lambda c, b: xor(c >> 8, steps[1 + (xor(c, b) & 255)])), 4294967295) AS crc
  FROM documents d, crc_table)"""


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _merkle_sql(group_levels: int = 10, top_levels: int = 5) -> str:
    """Each level joins nodes to their run of eight; enough levels for 8^10 rows and 8^5 groups."""

    def leaf(text: str) -> str:
        fields = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
        parts = [f"coalesce(octet_length(encode({f}))::VARCHAR || ':' || {f}, '-')" for f in fields]
        return f"sha256({' || '.join(parts)})"

    lower = f"translate(text, '{UPPER}', '{UPPER.lower()}')"
    steps = [
        CRC_SQL.strip(),
        f"""leaves AS (
  SELECT doc_id, lang, {leaf("text")} AS leaf,
         CASE WHEN crc % 3 = 0 THEN {leaf(lower)} ELSE {leaf("text")} END AS probe
  FROM numbered)""",
        """g0 AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
         leaf AS node FROM leaves)""",
        """p0 AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
         leaf AS node, probe AS fold, '' AS proof FROM leaves)""",
    ]

    def climb(tag: str, levels: int):
        for k in range(levels):
            steps.append(f"""{tag}r{k} AS (
  SELECT lang, i // 8 AS run, string_agg(node, '' ORDER BY i) AS run_nodes,
         any_value(total) AS total
  FROM (SELECT *, count(*) OVER (PARTITION BY lang) AS total FROM {tag}{k}) GROUP BY lang, i // 8)""")
            steps.append(f"""{tag}{k + 1} AS (
  SELECT lang, run AS i, CASE WHEN total > 1 THEN sha256(run_nodes) ELSE run_nodes END AS node
  FROM {tag}r{k})""")

    def descend(proofs: str, tag: str, at: int, levels: int):
        for k in range(levels):
            left = "substr(run_nodes, 1, 64 * (p.i % 8)::BIGINT)"
            right = "substr(run_nodes, 64 * (p.i % 8)::BIGINT + 65)"
            steps.append(f"""{proofs}{at + k + 1} AS (
  SELECT p.* EXCLUDE (i, fold, proof), p.i // 8 AS i,
         CASE WHEN total > 1 THEN sha256({left} || fold || {right}) ELSE fold END AS fold,
         CASE WHEN total > 1 THEN proof || {left} || {right} ELSE proof END AS proof
  FROM {proofs}{at + k} p JOIN {tag}r{k} r
    ON p.top IS NOT DISTINCT FROM r.lang AND p.i // 8 = r.run)""")

    steps[-1] = steps[-1].replace("SELECT *,", "SELECT *, lang AS top,")
    climb("g", group_levels)
    descend("p", "g", 0, group_levels)
    steps.append(f"""t0 AS (
  SELECT 0 AS lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, node, lang AS of
  FROM g{group_levels})""")
    climb("t", top_levels)
    steps.append(f"""q0 AS (
  SELECT p.* EXCLUDE (i, top), t.i, 0 AS top, t.node AS subroot
  FROM p{group_levels} p JOIN t0 t ON p.lang IS NOT DISTINCT FROM t.of)""")
    descend("q", "t", 0, top_levels)
    return (
        "WITH " + ",\n".join(steps) + f"""
SELECT doc_id, leaf, subroot, r.node AS root, sha256(proof) AS proof_sha256,
       fold AS folded_root, fold = r.node AS verified
FROM q{top_levels}, t{top_levels} r"""
    )


def lowered(text):
    """A-Z in lower case, all else as it is; texts without other characters take the quick way."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def id_crc():
    return F.crc32(F.col("doc_id").cast("string").cast("binary"))


@query("op11_merkle_manifest", _merkle_sql())
def op11(spark, root):
    def leaf(text):
        return merkle.leaf(*(F.col(c) for c in ("doc_id", "source", "lang", "n_chars")), text)

    text = F.col("text")
    rows = table(spark, root, "documents").select(
        "doc_id",
        "lang",
        leaf(text).alias("leaf"),
        F.when(id_crc() % 3 == 0, leaf(lowered(text))).alias("tampered"),
    )
    found = merkle.proofs(merkle.build(rows)).select(
        "row.doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(merkle.siblings(F.col("proof")), 256).alias("proof_sha256"),
        merkle.folded(F.coalesce("row.tampered", "leaf"), F.col("proof")).alias("folded_root"),
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


RUNS_SQL = rf"""
WITH {CRC_SQL.strip()},
split AS (
  SELECT doc_id, coalesce(crc, 1) AS crc, crc // 10 AS g,
         coalesce(regexp_extract_all(text, '[^ 	-
]+'), []) AS words
  FROM numbered),
cut AS (SELECT *, len(words) AS n, CASE WHEN crc % 10 = 0 AND len(words) > 0 THEN g % len(words) END AS a
        FROM split),
turned AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM cut),
texts AS (
  SELECT row_number() OVER () AS d, doc_id,
         CASE WHEN a IS NULL THEN words
              ELSE list_transform(range(n), lambda i: words[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END])
         END AS words FROM turned),
w AS (SELECT d, unnest(range(len(words))) AS i, unnest(words) AS word FROM texts),
grams AS (
  SELECT d, i, string_agg(word, ' ') OVER six AS gram, count(*) OVER six AS size FROM w
  WINDOW six AS (PARTITION BY d ORDER BY i ROWS BETWEEN CURRENT ROW AND 5 FOLLOWING)),
same AS (
  SELECT y.d, y.i, y.i - x.i AS lag FROM grams x JOIN grams y
    ON x.d = y.d AND x.gram = y.gram AND x.i < y.i WHERE x.size = 6 AND y.size = 6),
streaks AS (
  SELECT d, lag, min(i) AS first, max(i) AS last
  FROM (SELECT *, i - row_number() OVER (PARTITION BY d, lag ORDER BY i) AS island FROM same)
  GROUP BY d, lag, island),
runs AS (
  SELECT d, first - lag AS start, last + 6 - first + lag AS length, min(lag) AS period
  FROM streaks WHERE last + 6 - first + lag >= greatest(12, 2 * lag) GROUP BY ALL),
facts AS (
  SELECT d, count(*) AS n_runs,
         arg_min({{'start': start, 'length': length, 'period': period}}, [-length, start, period]) AS best,
         string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed
  FROM runs GROUP BY d),
kept AS (
  SELECT w.d, string_agg(word, ' ' ORDER BY i) AS rest FROM w
  WHERE NOT EXISTS (SELECT 1 FROM runs r WHERE r.d = w.d AND w.i >= r.start + r.period
                                           AND w.i < r.start + r.length) GROUP BY w.d)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.start AS start, best.length AS length,
       best.period AS period, 1000 * best.length // best.period AS exponent_milli,
       sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(rest, '')) AS collapsed_sha256
FROM texts LEFT JOIN facts USING (d) LEFT JOIN kept USING (d)"""


@query("op12_periodic_runs", RUNS_SQL)
def op12(spark, root):
    docs = table(spark, root, "documents").select("doc_id", "text", id_crc().alias("crc"))
    # Every tenth document gets a tail that repeats itself.
    words = F.when(F.col("crc") % 10 == 0, F.regexp_extract_all("text", F.lit(mixing.WORD), F.lit(0)))
    planted = (
        docs.withColumn("words", words)
        .withColumn("n", F.expr("coalesce(size(words), 0)"))
        .withColumn("a", F.expr("if(n > 0, crc div 10 % n, null)"))
        .withColumn("p", F.expr("1 + (n - a) div (3 + crc div 10 % 8)"))
    )
    turned = "transform(sequence(0, n - 1), i -> words[if(i < a, i, cast(a + (i - a) % p as int))])"
    texts = planted.select("doc_id", F.expr(f"if(n > 0, array_join({turned}, ' '), text)").alias("text"))
    found = periodic.periodic_runs(texts)
    ranked = "transform(runs, r -> struct(-r.length as length, r.start as start, r.period as period))"
    best = F.expr(f"array_min({ranked})")
    listed = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.array_join(F.transform(listed, lambda r: F.concat(r, F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        (-F.col("best.length")).alias("length"),
        F.col("best.period").alias("period"),
        F.expr("(-1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


NEAR_SQL = rf"""
WITH RECURSIVE words AS (
  SELECT row_number() OVER () AS d, doc_id,
         coalesce(regexp_extract_all(translate(text, '{UPPER}', '{UPPER.lower()}'), '[^ 	-
]+'), [])
           AS w FROM documents),
sets AS (
  SELECT d, doc_id, list_sort(list_distinct(CASE
    WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END)) AS s
  FROM words),
classes AS (
  SELECT s, min(d) AS c, min(doc_id) AS least, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
shingles AS (SELECT c, n, unnest(s) AS shingle FROM classes),
shared AS (
  SELECT x.c AS a, y.c AS b, x.n AS na, y.n AS nb, count(*) AS common
  FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.c < y.c
  WHERE 100 * least(x.n, y.n) >= 85 * greatest(x.n, y.n) GROUP BY ALL),
links AS (SELECT a, b FROM shared WHERE 100 * common >= 85 * (na + nb - common)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT c, c AS other FROM classes
  UNION SELECT r.c, e.b FROM reach r JOIN edges e ON r.other = e.a),
named AS (
  SELECT r.c, min(k.least) AS component FROM reach r JOIN classes k ON r.other = k.c GROUP BY r.c)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id,
       doc_id IS NOT DISTINCT FROM component_id AS kept
FROM (SELECT t.doc_id, t.s, CASE WHEN len(t.s) = 0 THEN t.doc_id ELSE m.component END AS component_id
      FROM sets t LEFT JOIN classes k ON t.s = k.s LEFT JOIN named m ON k.c = m.c)"""


@query("op13_near_copies", NEAR_SQL)
def op13(spark, root):
    found = superminhash.near_copies(table(spark, root, "documents"), words=3, percent=85)
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
