"""Queries over questions at the entry: which are taken, of what kind, under what names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatrix.functions import names
from curatrix.functions import reasoning as R
from curatrix.functions import text as X
from curatrix.operators import intake as I
from curatrix.plans.adapters import QUESTIONS_SQL, questions
from curatrix.plans.base import Tables, query
from curatrix.plans.intake import KIND_SQL, _ascii

IDS = "3, 4,5,,40,41,42,80, 81,1000001"
_IDS = sorted(I.parsed_ids(IDS))


@query(f"SELECT question_id FROM (SELECT doc_id AS question_id FROM documents ORDER BY doc_id OFFSET 4) WHERE question_id IN ({', '.join(map(str, _IDS))}) AND question_id NOT IN (SELECT doc_id FROM documents WHERE source = (SELECT min(source) FROM documents)) ORDER BY question_id LIMIT 5")
def questions_taken(t: Tables) -> DataFrame:
    """Past the first four, those named that aren't done yet, five at most."""
    first = t.documents.agg(F.min("source").alias("least"))
    done = t.documents.join(F.broadcast(first), F.col("source") == F.col("least")).select(F.col("doc_id").alias("question_id"))
    return I.selected(t.documents.select(F.col("doc_id").alias("question_id")), "question_id", offset=4, ids=I.parsed_ids(IDS), done=done, limit=5)


#: A question's row in JSON, what its field says of the kind, and the topic that it names.
ROWS = (
    ('{"task": " Kernel "}', "kernel", None), ('{"type": "THEORY", "topic": "Arch"}', "knowledge", "architecture"), ('{"task": "odd", "kind": "qa", "topic": " "}', "knowledge", None),
    ('{"other": 1}', None, None), ('{"topic": "knowledge:ptx"}', None, "isa"), ("not json", None, None), (None, None, None), ('{"task": "prose", "type": "cuda", "topic": "nowhere"}', "knowledge", "general"),
)
_LITERAL = lambda v: "NULL" if v is None else f"'{v}'"
_LIST = lambda i: "[" + ", ".join(_LITERAL(r[i]) for r in ROWS) + f"][CAST(question_id % {len(ROWS)} AS INT) + 1]"


def _raw() -> Column:
    return F.element_at(F.array(*[F.lit(r[0]) for r in ROWS]), (F.col("question_id") % len(ROWS) + 1).cast("int"))


@query(f"""WITH {QUESTIONS_SQL}, x AS (SELECT question_id, {_LIST(1)} AS named, coalesce({_LIST(2)}, {_ascii(X.TOPICS, 'general', 'question')}) AS topic, {KIND_SQL} AS guessed FROM questions)
SELECT question_id, 'auto' AS mode, coalesce(named, guessed) AS kind, CASE WHEN coalesce(named, guessed) = 'knowledge' THEN topic ELSE 'general' END AS topic, CASE WHEN named IS NULL THEN 'heuristic' ELSE 'field' END AS source FROM x
UNION ALL SELECT question_id, kind, kind, topic, 'cli' FROM x, (VALUES ('kernel'), ('knowledge')) m(kind)""")
def questions_classified(t: Tables) -> DataFrame:
    """Kind, topic and where the kind is from, by the row's fields and text, and under both forced modes."""
    modes = F.array(*[F.struct(F.lit(m).alias("mode"), I.classified(F.col("question"), F.col("raw"), m).alias("c")) for m in ("auto", "kernel", "knowledge")])
    rows = questions(t).withColumn("raw", _raw()).select("question_id", F.explode(modes).alias("x"))
    return rows.select("question_id", "x.mode", "x.c.kind", "x.c.topic", "x.c.source")


@query("SELECT o_orderkey AS question_id, 'kernel' || '' AS kind, CASE o_orderkey % 3 WHEN 0 THEN 'cuda' WHEN 1 THEN 'triton' ELSE 'cuda' END AS track, length(o_orderpriority) + 2 AS n_chars FROM orders WHERE o_orderkey % 5 > 1".replace("'kernel' || '' AS kind, ", ""))
def legacy_jobs(t: Tables) -> DataFrame:
    """Jobs from older rows: without a question they go, without a dialect they are CUDA's."""
    key = F.col("o_orderkey")
    question = F.when(key % 5 == 0, F.lit(None)).when(key % 5 == 1, " \n").otherwise(F.concat(F.lit("Q "), "o_orderpriority"))
    rows = t.orders.select(key.alias("question_id"), question.alias("question"), F.when(key % 3 == 1, " triton ").when(key % 3 == 2, " ").alias("dialect"))
    return I.jobs(rows).select("question_id", "track", F.length("question").cast("long").alias("n_chars"))


_TRACKS = ("", " Memory", "knowledge:isa", "Knowledge:Cute", "cuda", "triton")


@query(f"""SELECT c_custkey AS id, {['knowledge:general', 'knowledge:memory', 'knowledge:isa', 'knowledge:cute', 'knowledge:cuda', 'knowledge:triton']}[c_custkey % 6 + 1] AS track, {['general', 'memory', 'isa', 'cute', 'general', 'general']}[c_custkey % 6 + 1] AS topic FROM customer""")
def track_names(t: Tables) -> DataFrame:
    """The track of a topic, and the topic of a track; what is no topic is general."""
    name = F.element_at(F.array(*map(F.lit, _TRACKS)), (F.col("c_custkey") % len(_TRACKS) + 1).cast("int"))
    return t.customer.select(F.col("c_custkey").alias("id"), names.track(name).alias("track"), names.topic(name, I.TOPICS).alias("topic"))


@query("""WITH p AS (SELECT conv_id, turn, text, length(text) AS n, conv_id % 4 AS form FROM conversations WHERE text IS NOT NULL AND length(trim(text)) > 0 AND text NOT LIKE '%```%')
SELECT conv_id, turn, concat_ws('; ', CASE WHEN form <> 3 AND n + CASE form WHEN 1 THEN 12 ELSE 0 END < 60 THEN 'short: ' || (n + CASE form WHEN 1 THEN 12 ELSE 0 END) WHEN form = 3 THEN 'no text' END, CASE WHEN form IN (0, 2) THEN 'headings: 1, 2' WHEN form = 1 THEN 'headings: 2' END,
  CASE WHEN form IN (0, 1, 2) AND n + CASE form WHEN 1 THEN 12 WHEN 2 THEN 8 ELSE 0 END > 100 THEN 'budget' END, CASE WHEN form = 2 THEN 'code' END) AS problems FROM p""")
def draft_issues(t: Tables) -> DataFrame:
    """Why an edited draft can't be taken: bare texts, texts with the first of two headings, with code, and none."""
    form = F.col("conv_id") % 4
    rows = t.conversations.where("text is not null and length(trim(text)) > 0 and text not like '%```%'")
    cleaned = F.when(form == 1, F.concat(F.lit("### 1. Aim\n\n"), "text")).otherwise(F.col("text"))
    reply = F.when(form == 3, " \n").when(form == 2, F.concat("text", F.lit("\n```\n``"), F.lit("`"))).otherwise(cleaned)
    return rows.select("conv_id", "turn", F.array_join(R.draft_problems(reply, cleaned, 100, 2, 60), "; ").alias("problems"))


@query("""SELECT event_id AS id, CASE event_id % 6 WHEN 0 THEN 'said ' || event_type WHEN 1 THEN props || event_type || 'long detail' WHEN 2 THEN event_type || 'hidden' WHEN 3 THEN props || 'rest' WHEN 4 THEN 'said ' || event_type || ' at length' ELSE '' END AS reasoning FROM events""")
def provider_reasoning(t: Tables) -> DataFrame:
    """A reply's reasoning: its field, its joined details where longer, else its thinking blocks."""
    form, kind, props = F.col("event_id") % 6, F.col("event_type"), F.col("props")
    part = lambda type_, text=None, thinking=None, reasoning=None: F.struct(F.lit(type_).alias("type"), *[(F.lit(None).cast("string") if v is None else v).alias(n) for n, v in (("text", text), ("thinking", thinking), ("reasoning", reasoning))])
    none = F.array().cast("array<struct<type:string,text:string,thinking:string,reasoning:string>>")
    message = F.when(form == 0, F.concat(F.lit("said "), kind)).when(form == 1, "short").when(form == 4, F.concat(F.lit("said "), kind, F.lit(" at length"))).otherwise(" ")
    details = F.when(form == 1, F.array(part("reasoning.text", props), part("reasoning.text", reasoning=kind), part("x", thinking=F.lit("long detail")))).when(form == 4, F.array(part("reasoning.text", F.lit("less"))))
    blocks = F.when(form == 2, F.array(part("thinking", F.lit("no"), kind), part("text", F.lit("shown")), part("redacted_thinking", thinking=F.lit("hidden")))).when(form == 3, F.array(part("reasoning", props), part("reasoning.text", reasoning=F.lit("rest")))).otherwise(none)
    return t.events.select(F.col("event_id").alias("id"), R.block_reasoning(message, blocks, details).alias("reasoning"))
