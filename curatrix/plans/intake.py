"""Intake: classification, budgets, expansion, pending work, identity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.functions import text as X
from curatrix.operators.ordered import running
from curatrix.plans.adapters import QUESTIONS_SQL, questions
from curatrix.plans.base import Tables, query

DIALECTS = ("cuda", "triton", "cutlass", "tilelang")


def _ascii(ladder, default: str, column: str) -> str:
    """The ladder as SQL; patterns of other scripts never meet these questions."""
    return "CASE " + " ".join(f"WHEN regexp_matches({column}, '{p}', 'i') THEN '{n}'" for n, p in ladder) + f" ELSE '{default}' END"


KIND_SQL = f"CASE WHEN regexp_matches(question, '{X.KERNEL}', 'i') THEN 'kernel' WHEN regexp_matches(question, '{X.KNOWLEDGE}', 'i') THEN 'knowledge' ELSE 'kernel' END"
Q = f"WITH {QUESTIONS_SQL}"


@query(f"{Q} SELECT question_id, {KIND_SQL} AS kind, CASE WHEN lang = 'fr' THEN 'field' ELSE 'heuristic' END AS source FROM (SELECT * FROM questions) WHERE lang <> 'fr' UNION ALL SELECT question_id, 'knowledge', 'field' FROM questions WHERE lang = 'fr'")
def classify_kind(t: Tables) -> DataFrame:
    """Explicit fields first (here: French sources are marked as knowledge), then the heuristic."""
    field = F.when(F.col("lang") == "fr", "knowledge")
    return questions(t).select("question_id", F.coalesce(field, X.heuristic_kind(F.col("question"))).alias("kind"), F.when(field.isNotNull(), "field").otherwise("heuristic").alias("source"))


@query(f"{Q} SELECT question_id, {_ascii(X.TOPICS, 'general', 'question')} AS topic FROM questions")
def infer_topic(t: Tables) -> DataFrame:
    return questions(t).select("question_id", X.infer_topic(F.col("question")).alias("topic"))


@query(f"{Q} SELECT question_id, {_ascii(X.FAMILIES, 'elementwise', 'question')} AS family FROM questions")
def operation_family(t: Tables) -> DataFrame:
    return questions(t).select("question_id", X.operation_family(F.col("question")).alias("family"))


@query(f"""{Q}, d AS (SELECT question_id, CASE WHEN topic IN ('formula', 'cute', 'cutlass', 'isa') THEN 'hard' WHEN topic IN ('general', 'worked_example') THEN 'simple' ELSE 'medium' END AS difficulty FROM (SELECT question_id, {_ascii(X.TOPICS, 'general', 'question')} AS topic FROM questions))
SELECT question_id, difficulty, greatest(1, least(3, CASE difficulty WHEN 'simple' THEN 2 WHEN 'hard' THEN 4 ELSE 3 END)) AS max_candidates, greatest(0, least(2, CASE difficulty WHEN 'simple' THEN 1 WHEN 'hard' THEN 3 ELSE 2 END)) AS max_repairs, difficulty <> 'simple' AS use_critic FROM d""")
def difficulty_budget(t: Tables) -> DataFrame:
    d = questions(t).select("question_id", X.knowledge_difficulty(X.infer_topic(F.col("question"))).alias("difficulty"))
    return d.select("question_id", "difficulty", X.budget(F.col("difficulty"), X.CANDIDATES, 3, 1).alias("max_candidates"), X.budget(F.col("difficulty"), X.REPAIRS, 2, 0).alias("max_repairs"), (F.col("difficulty") != "simple").alias("use_critic"))


def jobs(t: Tables) -> DataFrame:
    """Kernel questions once a dialect, knowledge questions once, in one pass."""
    q = F.col("question")
    tracks = F.when(X.heuristic_kind(q) == "kernel", F.array(*map(F.lit, DIALECTS))).otherwise(F.array(F.concat(F.lit("knowledge:"), X.infer_topic(q))))
    return questions(t).select("question_id", F.explode(tracks).alias("track"))


JOBS_SQL = f"""{Q}, kinds AS (SELECT question_id, {KIND_SQL} AS kind, {_ascii(X.TOPICS, 'general', 'question')} AS topic FROM questions),
jobs AS (SELECT question_id, track FROM kinds, (SELECT unnest(['cuda', 'triton', 'cutlass', 'tilelang']) AS track) WHERE kind = 'kernel' UNION ALL SELECT question_id, 'knowledge:' || topic FROM kinds WHERE kind = 'knowledge')"""


@query(f"{JOBS_SQL} SELECT question_id, track FROM jobs")
def expand_jobs(t: Tables) -> DataFrame:
    return jobs(t)


@query(f"{JOBS_SQL}, done AS (SELECT question_id, CASE WHEN question_id % 2 = 0 THEN 'cuda' ELSE 'triton' END AS track FROM questions WHERE question_id % 3 = 0) SELECT j.question_id, j.track FROM jobs j WHERE NOT EXISTS (SELECT 1 FROM done d WHERE d.question_id = j.question_id AND d.track = j.track)")
def pending_jobs(t: Tables) -> DataFrame:
    done = t.documents.where("doc_id % 3 = 0").select(F.col("doc_id").alias("question_id"), F.when(F.col("doc_id") % 2 == 0, "cuda").otherwise("triton").alias("track"))
    return jobs(t).join(done, ["question_id", "track"], "left_anti")


@query("SELECT DISTINCT o_orderkey AS id, lower(trim(coalesce(nullif(o_orderpriority, '5-LOW'), 'cuda'))) AS track FROM orders WHERE o_orderstatus IN ('F', 'O')")
def progress_done_keys(t: Tables) -> DataFrame:
    """Terminal statuses only; a missing dialect counts as cuda."""
    track = F.lower(F.trim(F.coalesce(F.nullif("o_orderpriority", F.lit("5-LOW")), F.lit("cuda"))))
    return t.orders.where(F.col("o_orderstatus").isin("F", "O")).select(F.col("o_orderkey").alias("id"), track.alias("track")).distinct()


@query("SELECT o_orderkey AS job, CAST((row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) - 1) % 3 AS INT) AS slot, o_orderpriority AS provider FROM orders")
def slot_assignment(t: Tables) -> DataFrame:
    """Round-robin over the slots of each provider; places carry over ranges of jobs."""
    jobs = t.orders.select(F.col("o_orderkey").alias("job"), F.col("o_orderpriority").alias("provider"))
    return running(jobs, [F.col("job")], {"place": F.lit(1)}, ["provider"]).select("job", ((F.col("place") - 1) % 3).cast("int").alias("slot"), "provider")


@query("SELECT l_orderkey AS question_id, l_linenumber AS candidate, (31 * l_orderkey + 17 * l_linenumber + 5) % 4 AS variant, CASE WHEN l_linenumber = 1 THEN 0.2::DOUBLE WHEN l_linenumber = 2 THEN 0.6::DOUBLE ELSE 0.9::DOUBLE END AS temperature FROM lineitem")
def prompt_variant_index(t: Tables) -> DataFrame:
    """Deterministic prompt variants; temperature rises with the candidate."""
    c = F.col("l_linenumber")
    return t.lineitem.select(F.col("l_orderkey").alias("question_id"), c.alias("candidate"), F.pmod(31 * F.col("l_orderkey") + 17 * c + 5, F.lit(4)).alias("variant"), F.when(c == 1, 0.2).when(c == 2, 0.6).otherwise(0.9).alias("temperature"))


@query(r"SELECT doc_id AS question_id, sha256(trim(regexp_replace(text, '[\t\n\v\f\r \x{85}\p{Z}]+', ' ', 'g'), ' ')) AS question_hash FROM documents")
def question_identity(t: Tables) -> DataFrame:
    return t.documents.select(F.col("doc_id").alias("question_id"), X.question_hash(F.col("text")).alias("question_hash"))


STRATA = f"""{Q}, s AS (SELECT question_id, {_ascii(X.FAMILIES, 'elementwise', 'question')} AS family, CASE WHEN regexp_matches(question, '{X.SIMPLE}', 'i') THEN 'simple' ELSE 'medium' END AS difficulty, sha256(question) AS h FROM questions)"""


def strata(t: Tables) -> DataFrame:
    q = F.col("question")
    return questions(t).select("question_id", X.operation_family(q).alias("family"), F.when(q.rlike(f"(?i){X.SIMPLE}"), "simple").otherwise("medium").alias("difficulty"), F.sha2("question", 256).alias("h"))


@query(f"{STRATA} SELECT family, difficulty, count(*) AS n, count(DISTINCT h) AS n_distinct FROM s GROUP BY ALL")
def stratum_sizes(t: Tables) -> DataFrame:
    return strata(t).groupBy("family", "difficulty").agg(F.count("*").alias("n"), F.countDistinct("h").alias("n_distinct"))


@query(f"""{STRATA}, r AS (SELECT *, row_number() OVER (PARTITION BY family, difficulty ORDER BY h, question_id) AS depth FROM s),
u AS (SELECT *, row_number() OVER (PARTITION BY h ORDER BY depth, family, difficulty) AS nth FROM r)
SELECT question_id, family, difficulty, depth FROM u WHERE nth = 1 ORDER BY depth, family, difficulty LIMIT 120""")
def stratified_round_robin(t: Tables) -> DataFrame:
    """Round-robin over strata, each text once. A text's depth is the number of rows up to its
    first one in its stratum, in the order of hashes; rows of one text are counted first, and the
    counts run over ranges of hashes. The limit is the sampler's own."""
    texts = strata(t).groupBy("family", "difficulty", "h").agg(F.count("*").alias("n"), F.min("question_id").alias("question_id"))
    upto = running(texts, [F.col("h")], {"upto": F.col("n")}, ["family", "difficulty"])
    depth = (F.col("upto") - F.col("n") + 1).alias("depth")
    return upto.select("question_id", "family", "difficulty", depth).orderBy("depth", "family", "difficulty").limit(120)


@query("SELECT doc_id, ((length(text) - length(regexp_replace(text, '[\\x00-\\x7F]', '', 'g')) + 3) // 4 + length(regexp_replace(text, '[\\x00-\\x7F]', '', 'g'))) AS tokens FROM documents".replace("\\\\", "\\"))
def approx_tokens(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.approx_tokens(F.col("text")).alias("tokens"))


TAGGED_SQL = "tagged AS (SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN '<think>' || text || '</think>' || chr(10) || 'Answer ' || text ELSE 'Plain ' || text || CASE WHEN turn % 3 = 0 THEN '...' ELSE ' ```' END END AS reply FROM conversations)"


def tagged(t: Tables) -> DataFrame:
    text = F.col("text")
    plain = F.concat(F.lit("Plain "), text, F.when(F.col("turn") % 3 == 0, "...").otherwise(" ```"))
    return t.conversations.select("conv_id", "turn", F.when(F.col("turn") % 2 == 0, F.concat(F.lit("<think>"), text, F.lit("</think>\nAnswer "), text)).otherwise(plain).alias("reply"))


@query(f"WITH {TAGGED_SQL} SELECT conv_id, turn, sha256(regexp_replace(regexp_replace(reply, '<think>(.|\\n)*?</think>', '', 'gi'), '^\\s+|\\s+$', '', 'g')) AS visible_sha, CASE WHEN turn % 2 = 0 THEN length(regexp_replace((SELECT c.text FROM conversations c WHERE c.conv_id = tagged.conv_id AND c.turn = tagged.turn), '^\\s+|\\s+$', '', 'g')) ELSE 0 END AS think_chars FROM tagged")
def visible_answer(t: Tables) -> DataFrame:
    r = F.col("reply")
    trimmed = F.regexp_replace(X.strip_thinking(r), r"^\s+|\s+$", "")
    return tagged(t).select("conv_id", "turn", F.sha2(trimmed, 256).alias("visible_sha"), F.length(X.extract_thinking(r)).cast("long").alias("think_chars"))


@query(f"""WITH {TAGGED_SQL}, fenced AS (SELECT conv_id, turn, reply || CASE conv_id % 4 WHEN 0 THEN chr(10) || '```cuda' || chr(10) || 'x = $$y' WHEN 1 THEN chr(10) || '  ```' || chr(10) || 'x' || chr(10) || '```' ELSE '' END AS reply FROM tagged)
SELECT conv_id, turn, regexp_matches(regexp_replace(reply, '\\s+$', ''), '(,|:|;|=|->|\\.\\.\\.)$') AS truncated, len(regexp_extract_all(chr(10) || reply, '\\n[ \\t]*```')) % 2 = 1 AS open_fence, len(regexp_extract_all(reply, '\\$\\$')) % 2 = 1 AS open_equation FROM fenced""")
def answer_integrity(t: Tables) -> DataFrame:
    """Replies cut off, or with a fence or an equation left open; a quarter leaves both open, a quarter closes its fence."""
    form = F.col("conv_id") % 4
    added = F.when(form == 0, "\n```cuda\nx = $$y").when(form == 1, "\n  ```\nx\n```").otherwise("")
    issues = X.integrity_issues(F.concat("reply", added))
    return tagged(t).select("conv_id", "turn", *[F.array_contains(issues, kind).alias(name) for kind, name in (("tail", "truncated"), ("fence", "open_fence"), ("equation", "open_equation"))])
