"""Reasoning texts, names, line sources and streams."""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.functions import names, reasoning
from curatrix.functions.text import approx_tokens
from curatrix.plans.base import QUERIES, Tables, query
from curatrix.sources import lines as L
from curatrix.sources.scratch import new_path
from curatrix.streaming.trace import windowed_kpis

# The words that an intake table lacks are bound here: each document gets one narrating phrase, or none.
PHRASES = ("we saw a compile error here", "fixing the previous attempt", "the error message says", "retrying the compilation", "a test harness", "")
BOUND = "coalesce(['" + "', '".join(PHRASES) + "'][CAST(doc_id % 6 AS INT) + 1], '')"


@query(
    f"""WITH b AS (SELECT doc_id, {BOUND} || chr(10) || coalesce(text, '') AS r, CASE WHEN doc_id % 4 = 0 THEN 'read the error message' ELSE '' END AS q FROM documents),
p AS (SELECT unnest([{", ".join("'" + p.replace("'", "''") + "'" for p in reasoning.LEAKS)}]) AS p)
SELECT doc_id, CAST(count(*) FILTER (regexp_matches(r, p, 'i') AND NOT regexp_matches(q, p, 'i')) AS BIGINT) AS patterns FROM b, p GROUP BY doc_id"""
)
def narration_leaks(t: Tables) -> DataFrame:
    """Leak patterns of a reasoning that its question doesn't match itself."""
    phrase = F.element_at(F.array(*[F.lit(p) for p in PHRASES]), (F.col("doc_id") % 6).cast("int") + 1)
    text, asked = F.concat_ws("\n", phrase, F.coalesce("text", F.lit(""))), F.when(F.col("doc_id") % 4 == 0, "read the error message").otherwise("")
    hits = [F.when(text.rlike(f"(?i){p}") & ~asked.rlike(f"(?i){p}"), 1).otherwise(0) for p in reasoning.LEAKS]
    return t.documents.select("doc_id", sum(hits[1:], hits[0]).cast("long").alias("patterns"))


QUERIES["leak_phrases"] = lambda spark, d: Tables(spark, d).documents.select("doc_id", reasoning.repair_leaks(F.concat_ws("\n", F.element_at(F.array(*[F.lit(p) for p in PHRASES]), (F.col("doc_id") % 6).cast("int") + 1), "text"), F.lit("")).alias("leaks"))


@query("SELECT doc_id, CASE WHEN length(text) <= 400 THEN text ELSE regexp_replace(text[1:111], '\\s+$', '') || chr(10) || '...[truncated reasoning]...' || chr(10) || regexp_replace(text[-260:], '^\\s+', '') END AS clipped FROM documents WHERE text IS NOT NULL")
def clip_middle(t: Tables) -> DataFrame:
    """30 % of the head and the rest of the tail around a marker."""
    return t.documents.where("text is not null").select("doc_id", reasoning.clip_middle(F.col("text"), 400).alias("clipped"))


QUERIES["clip_at_boundary"] = lambda spark, d: Tables(spark, d).documents.select("doc_id", reasoning.clip_at_boundary(F.col("text"), 400).alias("clipped"))
QUERIES["strip_code"] = lambda spark, d: Tables(spark, d).pages.select("page_id", reasoning.strip_code(F.col("html")).alias("prose"))
QUERIES["clean_reasoning"] = lambda spark, d: Tables(spark, d).documents.select("doc_id", reasoning.clean_reasoning(F.col("text"), 2000).alias("reasoning"))


@query("SELECT p_partkey AS part, CASE WHEN p_size <> p_partkey % 50 + 1 THEN 1 ELSE 0 END AS n_wrong, CASE WHEN p_size <> p_partkey % 50 + 1 THEN 'BLOCK_SIZE=' || p_size ELSE '' END AS wrong FROM part")
def constant_mismatches(t: Tables) -> DataFrame:
    """Constants that a reasoning states with a value its code doesn't have."""
    said = F.concat(F.lit("We choose BLOCK_SIZE = "), F.col("p_size").cast("string"), F.lit(" and TILE_K: 8."))
    code = F.concat(F.lit("constexpr int BLOCK_SIZE = "), (F.col("p_partkey") % 50 + 1).cast("string"), F.lit(";"))
    wrong = reasoning.constant_mismatches(said, code)
    return t.part.select(F.col("p_partkey").alias("part"), F.size(wrong).alias("n_wrong"), F.array_join(wrong, ",").alias("wrong"))


@query(
    """WITH b AS (SELECT p_partkey, p_size % 4 AS w, p_partkey % 3 AS u, p_partkey % 7 = 0 AS amd, p_partkey % 5 = 0 AS lim FROM part)
SELECT p_partkey AS part, concat_ws(',', CASE WHEN w <> 1 AND u <> 1 AND NOT amd THEN 'warp_size_32' END, CASE WHEN lim THEN 'threads_per_block_1024' END) AS facts FROM b"""
)
def fact_cards(t: Tables) -> DataFrame:
    """Facts contradicted: a warp's width but of another maker or before a unit, and the block limit."""
    width = F.element_at(F.array(*[F.lit(x) for x in ("16", "32", "64", "128")]), (F.col("p_size") % 4 + 1).cast("int"))
    unit = F.element_at(F.array(*[F.lit(x) for x in (" lanes", " bytes", "")]), (F.col("p_partkey") % 3 + 1).cast("int"))
    said = F.concat(F.lit("The warp size is "), width, unit, F.when(F.col("p_partkey") % 7 == 0, " on AMD").otherwise(""), F.lit(". "), F.when(F.col("p_partkey") % 5 == 0, "At most 2048 threads per block.").otherwise(""))
    return t.part.select(F.col("p_partkey").alias("part"), F.array_join(reasoning.fact_violations(said), ",").alias("facts"))


@query(
    """WITH b AS (SELECT p_partkey, ['float', 'cute', 'tl', ' Cuda-Cpp ', 'triton', 'metal'][CAST(p_partkey % 6 AS INT) + 1] AS d, ['src', 'dst', 'in-out', 'n', 'scalar', 'what'][CAST(p_partkey % 6 AS INT) + 1] AS k, ['row', 'COL', 'stride', 'column-major', 'c', 'x'][CAST(p_partkey % 6 AS INT) + 1] AS l, ['cpu', 'device', ' HOST ', 'gpu', 'h', ''][CAST(p_partkey % 6 AS INT) + 1] AS m, ['exact', 'unique', 'multiset', 'set', 'sorted', ''][CAST(p_partkey % 6 AS INT) + 1] AS c FROM part)
SELECT p_partkey AS part, [NULL, 'cutlass', 'tilelang', 'cuda', 'triton', NULL][CAST(p_partkey % 6 AS INT) + 1] AS dialect, ['input', 'output', 'inout', 'size', 'scalar', 'input'][CAST(p_partkey % 6 AS INT) + 1] AS kind, ['row_major', 'col_major', 'strided', 'col_major', 'contiguous', 'contiguous'][CAST(p_partkey % 6 AS INT) + 1] AS layout,
CASE WHEN lower(trim(m)) IN ('cpu', 'host', 'h') THEN 'host' ELSE 'device' END AS memory, ['elementwise', 'set', 'sorted', 'set', 'sorted', 'elementwise'][CAST(p_partkey % 6 AS INT) + 1] AS compare_mode FROM b"""
)
def name_normalizers(t: Tables) -> DataFrame:
    """Aliases of five vocabularies brought to canonical names."""
    pick = lambda *values: F.element_at(F.array(*[F.lit(v) for v in values]), (F.col("p_partkey") % 6 + 1).cast("int"))
    return t.part.select(
        F.col("p_partkey").alias("part"),
        names.dialect(pick("float", "cute", "tl", " Cuda-Cpp ", "triton", "metal")).alias("dialect"), names.kind(pick("src", "dst", "in-out", "n", "scalar", "what")).alias("kind"),
        names.layout(pick("row", "COL", "stride", "column-major", "c", "x")).alias("layout"), names.memory(pick("cpu", "device", " HOST ", "gpu", "h", "")).alias("memory"),
        names.compare_mode(pick("exact", "unique", "multiset", "set", "sorted", "")).alias("compare_mode"),
    )


@query("SELECT page_id, sha256(lower(trim(regexp_replace(regexp_replace(html, '<[^>]{24,}>', '<>', 'g'), '[ \\t\\n\\r\\f]+', ' ', 'g')))) AS key_sha FROM pages")
def diagnostic_key(t: Tables) -> DataFrame:
    """One key for messages that differ in long template arguments, space or case only."""
    return t.pages.select("page_id", F.sha2(reasoning.diagnostic_key(F.col("html")), 256).alias("key_sha"))


@query("SELECT conv_id, turn, coalesce(CASE WHEN trim(CASE WHEN turn % 3 = 0 THEN ' ' ELSE text END) <> '' THEN trim(text) END, 'from tags') AS reasoning FROM conversations WHERE role = 'assistant' AND text IS NOT NULL AND NOT regexp_matches(text, '<(think|reasoning)>', 'i')")
def assemble_completion(t: Tables) -> DataFrame:
    """The first reasoning that isn't blank, else what the tags of the visible text hold."""
    rows = t.conversations.where("role = 'assistant' and text is not null").where(~F.col("text").rlike("(?i)<(think|reasoning)>"))
    field = F.when(F.col("turn") % 3 == 0, " ").otherwise(F.col("text"))
    _, said = reasoning.assemble_completion(F.concat(F.lit("<think>from tags</think>"), F.col("text")), field)
    return rows.select("conv_id", "turn", said.alias("reasoning"))


@query("SELECT event_id, coalesce(CASE WHEN event_id % 4 <> 0 THEN CAST(value AS BIGINT) END, CAST((length(props) + 3) // 4 AS BIGINT)) AS output_tokens, event_id % 4 = 0 AS estimated FROM events WHERE value IS NOT NULL AND value = floor(value) AND NOT regexp_matches(props, '[^\\x00-\\x7F]') UNION ALL SELECT event_id, CAST((length(props) + 3) // 4 AS BIGINT), true FROM events WHERE (value IS NULL OR value <> floor(value)) AND NOT regexp_matches(props, '[^\\x00-\\x7F]')")
def usage_rollup(t: Tables) -> DataFrame:
    """Tokens that the provider reports, else an estimate from the text."""
    whole = F.col("value").isNotNull() & (F.col("value") == F.floor("value")) & (F.col("event_id") % 4 != 0)
    given = F.when(whole, F.col("value").cast("long"))
    return t.events.where(~F.col("props").rlike(r"[^\x00-\x7F]")).select("event_id", F.coalesce(given, approx_tokens(F.col("props"))).alias("output_tokens"), given.isNull().alias("estimated"))


@query("SELECT event_id AS question_id, 'user ' || user_id AS question FROM events WHERE event_id % 3 <> 0")
def question_scan(t: Tables) -> DataFrame:
    """Questions from lines: blanks, non-objects and blank questions go, the id is the line."""
    line = F.when(F.col("event_id") % 3 != 0, F.to_json(F.struct(F.concat(F.lit(" user "), F.col("user_id").cast("string")).alias("question"), "event_type"))).when(F.col("event_id") % 2 == 0, "  ").otherwise("[1]")
    return L.questions(t.events.select(F.lit("events").alias("file"), F.col("event_id").alias("line"), line.alias("value"))).select("question_id", "question")


@query("SELECT event_type AS file, count(*) FILTER (event_id % 5 <> 0) AS n_lines, count(*) FILTER (event_id % 5 = 1) AS n_corrupt FROM events GROUP BY event_type HAVING count(*) FILTER (event_id % 5 <> 0) > 0")
def line_issues(t: Tables) -> DataFrame:
    """Lines and corrupt lines of each file; blank lines count as neither."""
    line = F.when(F.col("event_id") % 5 == 0, "").when(F.col("event_id") % 5 == 1, "{torn").otherwise(F.to_json(F.struct("event_id", "value")))
    return L.line_issues(t.events.select(F.col("event_type").alias("file"), F.col("event_id").alias("line"), line.alias("value")))


@query("SELECT o_orderkey AS question_id, ['cuda', 'triton', 'cutlass'][CAST(o_orderkey % 3 AS INT) + 1] AS dialect FROM orders WHERE o_orderkey % 4 <> 0")
def solution_files(t: Tables) -> DataFrame:
    """Question and dialect of each source in a work tree."""
    folder = F.element_at(F.array(F.lit(""), F.lit("/triton"), F.lit("/cutlass")), (F.col("o_orderkey") % 3 + 1).cast("int"))
    name = F.when(F.col("o_orderkey") % 4 == 0, "compile.log").otherwise("solution.py")
    return L.solution_files(t.orders.select(F.concat(F.lit("work/"), F.col("o_orderkey").cast("string"), folder, F.lit("/c0_r1/"), name).alias("path"))).select("question_id", "dialect")


@query("WITH m AS (SELECT max(ts) AS top FROM events) SELECT epoch_us(date_trunc('hour', ts)) AS start_us, event_type, count(*) AS n FROM events, m WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= top - INTERVAL 10 MINUTE GROUP BY ALL")
def stream_window_kpis(t: Tables) -> DataFrame:
    """Hourly counts by event type from a stream over the events; windows that the watermark has passed."""
    root = new_path(t.spark, "stream")
    stream = t.spark.readStream.schema(t.events.schema).parquet(f"{t.directory}/events.parque[t]").withColumn("ts", F.col("ts").cast("timestamp"))
    kpis = windowed_kpis(stream, ["event_type"])
    done = kpis.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/state").outputMode("append").trigger(availableNow=True).start()
    done.awaitTermination()
    return t.spark.read.schema(kpis.schema).parquet(f"{root}/out").select(F.unix_micros("start").alias("start_us"), "event_type", "n")
