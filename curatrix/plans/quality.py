"""Checks of archive rows, and judges: their replies, scores and decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.functions import reasoning
from curatrix.operators import dataset as D
from curatrix.operators import judge as J
from curatrix.plans.base import Tables, query


def archive_lines(t: Tables) -> DataFrame:
    """Archive rows as JSON text, from documents: their number decides on kind, version, system
    text, source and evidence, so that every rule passes, fails and does not apply somewhere."""
    k = F.col("doc_id")
    pick = lambda c, a, b: F.when(c, F.lit(a) if isinstance(a, str) else a).otherwise(F.lit(b) if isinstance(b, str) else b)
    kernel, python = k % 4 != 0, k % 5 == 0
    system = F.when(k % 10 == 0, "You are a Repairer.").when(k % 14 == 0, "Do not explain.").otherwise("Be brief.")
    think = F.when(k % 3 != 0, F.concat(F.lit("<think>\nBLOCK = 64 a tile."), pick(k % 9 == 1, " The previous attempt was slow.", ""), F.lit("\n</think>\n"))).otherwise("")
    body = F.when(python, F.when(k % 15 == 0, "def (").when(k % 35 == 0, "run()").otherwise("import x\nx.run()")).otherwise(F.concat(F.lit("__global__ void k() { int BLOCK = "), pick(k % 11 == 0, "32", "64"), F.lit("; }")))
    source = F.concat(pick(k % 13 == 0, "Here is the code\n", ""), body)
    fenced = pick(k % 2 == 1, F.concat(F.lit("```cuda\n"), source, F.lit("\n```")), source)
    answer = F.concat(F.lit("Answer "), k.cast("string"))
    assistant = F.concat(think, pick(kernel, fenced, answer))
    roles = F.when(k % 29 == 0, F.array(F.lit("assistant"), F.lit("user"))).when(k % 2 == 0, F.array(F.lit("system"), F.lit("user"), F.lit("assistant"))).otherwise(F.array(F.lit("user"), F.lit("assistant")))
    said = lambda r: F.when(r == "system", system).when(r == "user", F.lit("question")).otherwise(assistant)
    messages = F.transform(roles, lambda r: F.struct(r.alias("role"), said(r).alias("content")))
    sha = F.sha2(pick(k % 8 == 0, "other", pick(kernel, F.concat(source, F.lit("\n")), answer)), 256)
    texts = {x: F.lit("x").alias(x) for x in ("sample_key", "question_hash", "dialect", "user_mode")}
    scores = F.struct(*[(k % 10 + 1).alias(x) for x in J.WEIGHTS])
    meta = F.struct(
        pick(k % 3 < 2, "set-2", "set-1").alias("dataset_version"), *texts.values(), pick(kernel, "cuda", "knowledge:isa").alias("track"), pick(kernel, "kernel", "knowledge").alias("task"),
        pick(kernel, pick(python, "python", "cpp"), "prose").alias("language"), pick(k % 7 == 0, "fixed", "none").alias("system_mode"), pick(k % 2 == 0, "strict", "basic").alias("release_tier"),
        k.alias("source_line"), (k % 3).alias("candidate"), (k % 4).alias("repairs"),
        F.struct(F.lit("s").alias("system"), F.lit("u").alias("user"), F.struct(F.lit(1).alias("a")).alias("prompt_variant")).alias("generation"),
        F.struct(F.lit("raw").alias("source"), F.lit("p").alias("policy"), F.when(k % 19 != 0, k).alias("chars"), F.array().cast("array<string>").alias("consistency_issues")).alias("cot"),
        F.struct(F.when(k % 17 != 0, "m").alias("model"), F.lit("p").alias("provider"), F.struct(F.lit(1).alias("a")).alias("prompt_packs"), F.lit("r").alias("run_id"), F.lit("now").alias("created_at")).alias("provenance"),
        F.when(kernel, sha).alias("selected_code_sha256"),
        F.when(kernel, F.struct(pick(k % 9 != 0, "pass", "fail").alias("status"), (k % 6).alias("cases_run"), pick(k % 25 == 0, "", "h").alias("manifest_hash"))).alias("refval"),
        F.when(kernel, F.struct(F.lit("verified").alias("status"))).alias("critic"), F.when(kernel, F.struct(F.lit(7).alias("score"))).alias("judge"),
        F.when(kernel, F.struct(F.lit(3).alias("count"), F.lit(0).alias("selected_candidate"), F.lit(2).alias("eligible_count"), F.array(F.lit("x")).alias("reports"))).alias("candidate_pool"),
        F.when(~kernel, "isa").alias("topic"),
        F.when(~kernel, F.struct(F.lit(True).alias("pass"), F.lit(False).alias("unavailable"), F.lit(False).alias("skipped_llm"), F.lit(False).alias("hard_gate_failed"), F.filter(F.array(F.lit("fix")), lambda x: k % 20 == 0).alias("must_fix"), sha.alias("answer_sha256"), scores.alias("dimensions"), (k % 10 + 1).alias("overall"))).alias("knowledge_judge"),
    )
    return t.documents.select("doc_id", F.when(k % 23 == 0, "{oops").otherwise(F.to_json(F.struct(messages.alias("messages"), meta.alias("metadata")))).alias("value"))


RULES_SQL = """WITH b AS (SELECT doc_id AS k, doc_id % 4 <> 0 AS kernel, doc_id % 5 = 0 AS py, doc_id % 3 < 2 AS v2, doc_id % 3 <> 0 AS think, doc_id % 23 = 0 OR doc_id % 29 = 0 AS broken FROM documents),
c AS (SELECT *, kernel AND (k % 13 = 0 OR (py AND (k % 15 = 0 OR k % 35 = 0))) AS odd_source, think AND k % 9 = 1 AS leak FROM b),
s AS (SELECT k, broken, unnest([
  {'rule': 'H1', 'state': CASE WHEN broken THEN 'fail' ELSE 'pass' END},
  {'rule': 'H2', 'state': CASE WHEN broken THEN 'n/a' WHEN k % 10 = 0 THEN 'fail' ELSE 'pass' END},
  {'rule': 'H3', 'state': CASE WHEN broken OR k % 7 <> 0 THEN 'n/a' WHEN k % 14 = 0 AND k % 10 <> 0 THEN 'fail' ELSE 'pass' END},
  {'rule': 'H4', 'state': CASE WHEN broken OR NOT kernel THEN 'n/a' WHEN odd_source THEN 'fail' ELSE 'pass' END},
  {'rule': 'H5', 'state': CASE WHEN broken OR NOT kernel OR NOT v2 OR odd_source THEN 'n/a' WHEN k % 8 = 0 THEN 'fail' ELSE 'pass' END},
  {'rule': 'H6', 'state': CASE WHEN broken THEN 'n/a' WHEN leak THEN 'fail' ELSE 'pass' END},
  {'rule': 'H7', 'state': CASE WHEN broken OR NOT kernel OR odd_source THEN 'n/a' WHEN leak OR (think AND k % 11 = 0 AND NOT py) THEN 'fail' ELSE 'pass' END},
  {'rule': 'H8', 'state': CASE WHEN broken OR NOT kernel OR k % 2 <> 0 THEN 'n/a' WHEN k % 9 = 0 OR k % 6 < 3 OR k % 25 = 0 THEN 'fail' ELSE 'pass' END},
  {'rule': 'H9', 'state': 'n/a'}, {'rule': 'H10', 'state': 'n/a'}, {'rule': 'H11', 'state': 'n/a'}, {'rule': 'H12', 'state': 'n/a'},
  {'rule': 'H13', 'state': CASE WHEN broken OR NOT v2 THEN 'n/a' WHEN k % 17 = 0 OR k % 19 = 0 OR (NOT kernel AND (k % 8 = 0 OR k % 20 = 0)) THEN 'fail' ELSE 'pass' END}]) AS x FROM c)"""


@query(f"{RULES_SQL} SELECT x.rule AS rule, count(*) FILTER (x.state = 'pass') AS passed, count(*) FILTER (x.state = 'fail') AS failed, count(*) FILTER (x.state = 'n/a') AS not_applicable FROM s GROUP BY ALL")
def dataset_rule_counts(t: Tables) -> DataFrame:
    """Rows that pass, fail or are outside each of the thirteen rules."""
    return D.rule_counts(D.checked_rows(archive_lines(t)))


@query(f"{RULES_SQL} SELECT k AS doc_id, string_agg(x.rule, ',' ORDER BY CAST(x.rule[2:] AS INT)) AS failures FROM s WHERE x.state = 'fail' GROUP BY k")
def dataset_rule_failures(t: Tables) -> DataFrame:
    """The rules that each row fails."""
    failed = F.transform(F.filter("checks", lambda c: c["state"] == "fail"), lambda c: c["rule"])
    return D.checked_rows(archive_lines(t)).where(F.size(failed) > 0).select("doc_id", F.array_join(failed, ",").alias("failures"))


@query(
    """WITH b AS (SELECT doc_id AS k, CASE WHEN doc_id % 3 <> 0 THEN 18 + CASE WHEN doc_id % 9 = 1 THEN 31 ELSE 0 END ELSE 0 END AS chars, doc_id % 4 <> 0 AS kernel FROM documents WHERE doc_id % 23 <> 0 AND doc_id % 29 <> 0)
SELECT CASE WHEN kernel THEN 'cuda' ELSE 'knowledge:isa' END AS track, CASE WHEN k % 2 = 0 THEN 'strict' ELSE 'basic' END AS tier, count(*) AS n, count(*) FILTER (k % 4 > 0) AS repaired, sum(chars) AS cot_chars FROM b GROUP BY ALL"""
)
def dataset_row_metrics(t: Tables) -> DataFrame:
    rows = D.checked_rows(archive_lines(t)).where("well_formed")
    return rows.groupBy("track", "tier").agg(F.count("*").alias("n"), F.count_if("repaired").alias("repaired"), F.sum("cot_chars").alias("cot_chars"))


SHAPES = 6


def judge_replies(t: Tables) -> DataFrame:
    """Replies of a judge, from documents: bare, fenced, behind a thought, with other names,
    with a trailing comma, and without scores."""
    k = F.col("doc_id")
    score = lambda i: (k * (i + 3) % 13).cast("string")
    dims = F.concat(*[x for i, (name, names) in enumerate(J.ALIASES.items()) for x in (F.lit("" if not i else ", "), F.lit('"'), F.when(k % 2 == 0, name).otherwise(names[1]), F.lit('": '), score(i))])
    must = F.when(k % 7 == 0, '["cite it"]').otherwise("[]")
    body = lambda key, end: F.concat(F.lit(f'{{"{key}": {{'), dims, F.lit('}, "must_fix": '), must, F.lit(end))
    shape = k % SHAPES
    reply = (
        F.when(shape == 0, body("dimensions", ', "pass": true}'))
        .when(shape == 1, F.concat(F.lit("My view:\n```json\n"), body("scores", "}"), F.lit("\n```\ndone")))
        .when(shape == 2, F.concat(F.lit('<think>{"draft": "}"}</think>so '), body("dimensions", "}")))
        .when(shape == 3, F.concat(F.lit('first {"a": {"b": 1}} then '), body("dimensions", ",}")))
        .when(shape == 4, F.concat(F.lit("<think>"), body("dimensions", "}"), F.lit("</think>I am sure.")))
        .otherwise('{"verdict": "good"} {"open": ')
    )
    return t.documents.select("doc_id", F.when(F.col("lang") == "en", "Formula").otherwise("isa").alias("topic"), reply.alias("reply"))


_MEAN = lambda kept: " + ".join(f"d{i} * {w / sum(kept.values())!r}::DOUBLE" for i, k in enumerate(J.WEIGHTS) if (w := kept.get(k)))
JUDGED_SQL = f"""WITH d AS (SELECT doc_id, lang = 'en' AS formula, doc_id % 7 = 0 AS must, {', '.join(f"least(10.0, greatest(1.0, doc_id * {i + 3} % 13))::DOUBLE AS d{i}" for i in range(6))} FROM documents WHERE doc_id % {SHAPES} < 5),
o AS (SELECT *, round(CASE WHEN formula THEN {_MEAN(J.WEIGHTS)} ELSE {_MEAN({k: w for k, w in J.WEIGHTS.items() if k != 'derivation'})} END, 4) AS overall FROM d)"""


def _judged(t: Tables) -> DataFrame:
    rows = judge_replies(t).select("doc_id", "topic", J.parsed_reply(F.col("reply")).alias("j")).where("j is not null")
    scores = {k: F.col(f"j.{k}") for k in J.WEIGHTS}
    rows = rows.withColumn("overall", J.overall(scores, F.col("topic")))
    return rows.withColumn("capped", J.capped(F.col("overall"), scores)).withColumn("accepted", J.accepts(F.col("overall"), scores, F.col("j.must_fix"), 5.0, 4.0))


@query(f"SELECT doc_id, CASE WHEN doc_id % {SHAPES} < 5 THEN least(10.0, greatest(1.0, doc_id * 3 % 13))::DOUBLE END AS factual, CASE WHEN doc_id % {SHAPES} < 5 THEN least(10.0, greatest(1.0, doc_id * 8 % 13))::DOUBLE END AS grounding, CASE WHEN doc_id % {SHAPES} < 5 THEN CAST(doc_id % 7 = 0 AS INT) ELSE -1 END AS n_must_fix FROM documents")
def judge_json(t: Tables) -> DataFrame:
    """Scores that the replies hold."""
    rows = judge_replies(t).select("doc_id", J.parsed_reply(F.col("reply")).alias("j"))
    return rows.select("doc_id", "j.factual", "j.grounding", F.coalesce(F.size("j.must_fix"), F.lit(-1)).alias("n_must_fix"))


@query(f"{JUDGED_SQL} SELECT doc_id, overall, least(overall, d0, d1) AS capped FROM o")
def rubric_overall(t: Tables) -> DataFrame:
    """The weighted mean, and the same capped by its two decisive axes."""
    return _judged(t).select("doc_id", "overall", "capped")


@query(f"{JUDGED_SQL} SELECT NOT must AND overall >= 5 AND d0 >= 4 AS accepted, count(*) AS n FROM o GROUP BY ALL")
def rubric_accept(t: Tables) -> DataFrame:
    return _judged(t).groupBy("accepted").agg(F.count("*").alias("n"))


@query(
    """SELECT doc_id, doc_id % 2 <> 0 AND doc_id % 3 <> 0 AND doc_id % 5 <> 0 AND doc_id % 7 <> 0 AND doc_id % 10 + 1 >= 4 AS accepted FROM documents"""
)
def answer_acceptance(t: Tables) -> DataFrame:
    """Whether a saved answer is the reviewed one: flags, hash, threshold and a clean gate."""
    k = F.col("doc_id")
    rows = t.documents.select("doc_id", F.concat(F.lit("Answer "), k.cast("string")).alias("answer"))
    flags = F.struct((k % 2 != 0).alias("gate_ok"), F.lit(True).alias("judge_pass"), F.lit(True).alias("pass"), F.lit(False).alias("unavailable"), (k % 3 == 0).alias("skipped"), F.lit(False).alias("hard_gate_failed"))
    digest = F.when(k % 5 == 0, F.sha2(F.lit("other"), 256)).otherwise(F.sha2("answer", 256))
    gate = F.filter(F.array(F.lit("short")), lambda x: k % 7 == 0)
    value = (k % 10 + 1).cast("double")
    ok = J.accepted_answer(flags, F.col("answer"), digest, value, {"factual": value}, F.array().cast("array<string>"), gate, 4.0, 2.0)
    return rows.select("doc_id", ok.alias("accepted"))


@query("SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'empty' WHEN 1 THEN 'code leak' WHEN 2 THEN 'code leak' ELSE 'pass' END AS status FROM documents")
def recorded_reasoning(t: Tables) -> DataFrame:
    """Whether a recorded reasoning is there and holds no code."""
    k = F.col("doc_id") % 5
    said = F.when(k == 0, " \n ").when(k == 1, F.concat(F.lit("see ```"), F.col("source"))).when(k == 2, F.concat(F.col("source"), F.lit(" #include"))).otherwise(F.concat(F.lit("tiles of "), F.col("source")))
    return t.documents.select("doc_id", reasoning.reasoning_check(said).alias("status"))


NUMBERS = 5


@query(
    f"""WITH d AS (SELECT doc_id AS k FROM documents), h AS (SELECT k, list_filter([(k * 3 + i * (k % 4 + 1)) % {NUMBERS} + 1 for i in range(0, {NUMBERS})], lambda x: (k + x) % 9 <> 0) AS seen FROM d),
m AS (SELECT k, seen, list_filter(range(1, {NUMBERS + 1}), lambda n: NOT list_contains(seen, n)) AS gone, list_filter(range(1, {NUMBERS + 1}), lambda n: list_contains(seen, n)) AS present FROM h),
late AS (SELECT k, gone, list_filter([CASE WHEN i > 1 AND list_position(seen, present[i]) < list_position(seen, present[i - 1]) THEN present[i] END for i in range(1, len(present) + 1)], lambda x: x IS NOT NULL) AS late FROM m)
SELECT k AS doc_id, array_to_string(list_sort(list_distinct(list_concat(gone, late))), ',') AS missing FROM late"""
)
def heading_order(t: Tables) -> DataFrame:
    """Numbered headings that are absent or out of order, in texts whose headings come in an
    order that the document's number decides."""
    k = F.col("doc_id")
    places = F.transform(F.sequence(F.lit(0), F.lit(NUMBERS - 1)), lambda i: (k * 3 + i * (k % 4 + 1)) % NUMBERS + 1)
    marks = F.array(F.lit("## "), F.lit("**"), F.lit(""))
    line = lambda n: F.concat(F.element_at(marks, (n % 3 + 1).cast("int")), n.cast("string"), F.when(n % 2 == 0, ") ").otherwise(". "), F.lit("part\ntext with 7 in it"))
    text = F.array_join(F.transform(F.filter(places, lambda n: (k + n) % 9 != 0), line), "\n")
    return t.documents.select("doc_id", F.array_join(reasoning.missing_headings(text, NUMBERS).cast("array<string>"), ",").alias("missing"))
