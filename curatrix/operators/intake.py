"""Questions at the entry: their kind and topic, and which of them run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curatrix.functions.text import heuristic_kind, infer_topic

# Names of the two kinds in a task field, topics, and other names of topics.
KERNEL_NAMES = ("kernel", "code", "impl", "implementation", "operator", "cuda")
KNOWLEDGE_NAMES = ("knowledge", "theory", "explain", "concept", "prose", "qa", "reason")
TOPICS = ("architecture", "memory", "execution", "formula", "cute", "cutlass", "isa", "api", "worked_example", "general")
TOPIC_NAMES = {
    "arch": "architecture", "sm": "architecture", "gpu": "architecture", "hardware": "architecture", "mem": "memory", "shared": "memory", "coalescing": "memory",
    "occ": "execution", "occupancy": "execution", "scheduler": "execution", "math": "formula", "derive": "formula", "derivation": "formula", "roofline": "formula",
    "cutlass_model": "cutlass", "pipeline": "cutlass", "layout": "cute", "tiler": "cute", "ptx": "isa", "sass": "isa", "runtime": "api", "driver": "api",
    "example": "worked_example", "worked": "worked_example",
}
FIELDS = ("task", "type", "kind")


def field_kind(raw: Column) -> Column:
    """The kind that a row's JSON names in the first of its task fields with a known name."""
    def named(key: str) -> Column:
        name = F.lower(F.trim(F.get_json_object(raw, f"$.{key}")))
        return F.when(name.isin(*KERNEL_NAMES), "kernel").when(name.isin(*KNOWLEDGE_NAMES), "knowledge")

    return F.coalesce(*map(named, FIELDS))


def topic_name(raw: Column) -> Column:
    """The topic that a name or track means; general for others."""
    name = F.regexp_replace(F.lower(F.trim(F.coalesce(raw, F.lit("")))), " ", "_")
    name = F.regexp_replace(name, "^knowledge:", "")
    table = F.create_map(*[F.lit(x) for pair in TOPIC_NAMES.items() for x in pair])
    name = F.coalesce(F.try_element_at(table, name), name)
    return F.when(name.isin(*TOPICS), name).otherwise("general")


def question_topic(question: Column, raw: Column) -> Column:
    """The topic of the JSON's field, where it has one, else that of the text."""
    field = F.get_json_object(raw, "$.topic")
    return F.when(F.trim(field) != "", topic_name(field)).otherwise(infer_topic(F.coalesce(question, F.lit(""))))


def classified(question: Column, raw: Column, mode: str = "auto") -> Column:
    """(kind, topic, source). Modes kernel and knowledge force all rows and keep the topic;
    auto takes the row's field, else the text, and only knowledge keeps a topic."""
    topic = question_topic(question, raw)
    if mode in ("kernel", "knowledge"):
        return F.struct(F.lit(mode).alias("kind"), topic.alias("topic"), F.lit("cli").alias("source"))
    named = field_kind(raw)
    kind = F.coalesce(named, heuristic_kind(F.coalesce(question, F.lit(""))))
    return F.struct(kind.alias("kind"), F.when(kind == "knowledge", topic).otherwise("general").alias("topic"), F.when(named.isNotNull(), "field").otherwise("heuristic").alias("source"))


def parsed_ids(raw: str | None) -> set[int] | None:
    """'1,2, 10' as numbers; nothing given selects all."""
    return {int(x) for x in raw.split(",") if x.strip()} if raw else None


def first_rows(rows: DataFrame, order: str, n: int) -> DataFrame:
    """The first n rows: a limit that sorts each partition's n at most."""
    return rows.orderBy(order).limit(n)


def after_rows(rows: DataFrame, order: str, n: int) -> DataFrame:
    """All rows but the first n, which are few: their last place bounds the rest."""
    if n <= 0:
        return rows
    edge = first_rows(rows.select(order), order, n).agg(F.max(order).alias("__edge"), F.count("*").alias("__n"))
    return rows.crossJoin(F.broadcast(edge)).where((F.col("__n") == n) & (F.col(order) > F.col("__edge"))).drop("__edge", "__n")


def selected(rows: DataFrame, order: str, *, offset: int = 0, ids: set[int] | None = None, done: DataFrame | None = None, limit: int | None = None) -> DataFrame:
    """Rows to run, in this order: skip ``offset``, keep ``ids``, drop the done, stop at ``limit``.
    ``order`` is a unique column; done holds it too."""
    rows = after_rows(rows, order, offset)
    if ids is not None:
        rows = rows.where(F.col(order).isin(*ids)) if ids else rows.limit(0)
    if done is not None:
        rows = rows.join(done.select(order).distinct(), order, "left_anti")
    return rows if limit is None else first_rows(rows, order, limit)


def jobs(rows: DataFrame) -> DataFrame:
    """Job records from older shapes: (question_id, question, dialect or nothing) become kernel
    jobs of that dialect or cuda; what has no question goes."""
    bare = lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)^\s+|\s+$", "")
    track = F.coalesce(F.nullif(bare("dialect"), F.lit("")), F.lit("cuda"))
    return rows.where(bare("question") != "").select(F.col("question_id").cast("long").alias("question_id"), "question", F.lit("kernel").alias("kind"), track.alias("track"), F.lit("tuple").alias("source"))


def global_row_numbers(rows: DataFrame, order: str, name: str = "place", parts: int = 64) -> DataFrame:
    """Places from 0 in the order of a unique number, without one task that sees all rows: its
    quantiles bound the parts, which are counted, and each part numbers its own rows."""
    bounds = rows.agg(F.percentile_approx(order, [i / parts for i in range(1, parts)]).alias("b")).first()["b"] or []
    bucket = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b < F.col(order))) if bounds else F.lit(0)
    dealt = rows.withColumn("__part", bucket)
    counts = {r["__part"]: r["n"] for r in dealt.groupBy("__part").agg(F.count("*").alias("n")).collect()}  # parts rows at most
    before, total = [], 0
    for i in range(len(bounds) + 1):
        before.append(total)
        total += counts.get(i, 0)
    own = F.row_number().over(Window.partitionBy("__part").orderBy(order)) - 1
    start = F.element_at(F.array(*[F.lit(x).cast("long") for x in before]), F.col("__part") + 1)
    return dealt.withColumn(name, start + own).drop("__part")
