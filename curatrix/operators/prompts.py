"""Prompts put together from packs: rows that say which text a track has for a part.

A pack is rows of (track, part, ordinal, text). A job's text of each part is one of those in the
question's language, or of all where none is, at an index that its question and candidate fix,
so that a resumed run picks the same. Packs are joined as tables; nothing is drawn at random.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Temperatures by candidate, and numbers that mix an index.
TEMPERATURES, BY_QUESTION, BY_CANDIDATE = (0.2, 0.5, 0.8), 31, 17
#: Parts of a repair prompt, in order: name, and the heading that it gets.
SECTIONS = (("question", "## Problem"), ("contract", "## Contract"), ("history", "## Earlier attempts"), ("evidence", "## Evidence"), ("body", ""))
NO_QUESTION = "(empty problem)"


def looks_chinese(text: Column) -> Column:
    return F.coalesce(text.rlike("[\\u3400-\\u9fff]"), F.lit(False))


def stable_index(n: Column, question_id: Column, candidate: Column, salt: Column) -> Column:
    return F.pmod(question_id * BY_QUESTION + candidate * BY_CANDIDATE + salt, n)


def temperature(candidate: Column) -> Column:
    """By the candidate's number from 1; further ones have the last."""
    place = F.greatest(F.lit(1), F.least(candidate, F.lit(len(TEMPERATURES)))).cast("int")
    return F.element_at(F.array(*map(F.lit, TEMPERATURES)), place)


def selected_prompts(jobs: DataFrame, pack: DataFrame, salts: dict[str, int]) -> DataFrame:
    """(question_id, candidate, track, question) -> (question_id, candidate, part, ordinal, text)
    for each part that has a salt. A track without a pack has no rows."""
    salt = F.create_map(*[F.lit(x) for pair in salts.items() for x in pair])
    texts = pack.where(F.col("part").isin(*salts)).select("track", "part", "ordinal", "text", looks_chinese(F.col("text")).alias("chinese"))
    texts = texts.withColumn("at", F.row_number().over(Window.partitionBy("track", "part", "chinese").orderBy("ordinal")) - 1)
    texts = texts.withColumn("at_all", F.row_number().over(Window.partitionBy("track", "part").orderBy("ordinal")) - 1)
    sizes = texts.groupBy("track", "part").agg(F.count("*").alias("n"), F.count_if("chinese").alias("n_chinese"))
    asked = jobs.withColumn("__zh", looks_chinese(F.col("question"))).join(sizes, "track")
    matched = F.when(F.col("__zh"), F.col("n_chinese")).otherwise(F.col("n") - F.col("n_chinese"))
    size = F.when(matched > 0, matched).otherwise(F.col("n"))
    index = stable_index(size, F.col("question_id"), F.col("candidate"), F.element_at(salt, F.col("part")))
    asked = asked.select("question_id", "candidate", "track", "part", F.when(matched > 0, F.col("__zh")).alias("chinese"), index.alias("at"))
    own = asked.where("chinese is not null").join(texts.drop("at_all"), ["track", "part", "chinese", "at"])
    any_language = asked.where("chinese is null").drop("chinese").join(texts.drop("at", "chinese").withColumnRenamed("at_all", "at"), ["track", "part", "at"])
    columns = ["question_id", "candidate", "part", "ordinal", "text"]
    return own.select(columns).unionByName(any_language.select(columns))


def _filled(text: Column) -> Column:
    return F.nullif(F.trim(F.coalesce(text, F.lit(""))), F.lit(""))


def repair_prompts(rows: DataFrame, hints: DataFrame, max_chars: int = 6000) -> DataFrame:
    """(question, dialect, error_class, repair_idx, max_repairs, history, evidence, body) -> the
    same with ``prompt``: sections that aren't empty under their headings, the hint of the error
    class (hints has error_class and hint) in the contract. Evidence is cut to what the rest leaves."""
    key = lambda c: F.lower(F.trim(F.coalesce(c, F.lit(""))))
    known = hints.select(key(F.col("error_class")).alias("__class"), F.col("hint").alias("__hint"))
    joined = rows.withColumn("__class", key(F.col("error_class"))).join(known, "__class", "left")
    round_of = F.concat(F.coalesce(F.col("repair_idx").cast("string"), F.lit("?")), F.lit("/"), F.coalesce(F.col("max_repairs").cast("string"), F.lit("?")))
    line = lambda name, value: F.concat(F.lit(f"- {name}: "), value)
    contract = F.concat_ws(
        "\n", line("dialect", F.coalesce("dialect", F.lit("cuda"))), line("error_class", F.coalesce("error_class", F.lit(""))), line("hint", _filled(F.col("__hint"))),
        F.when(F.col("repair_idx").isNotNull() | F.col("max_repairs").isNotNull(), line("repair_round", round_of)),
    )
    values = {"question": F.coalesce(_filled(F.col("question")), F.lit(NO_QUESTION)), "contract": contract, "history": _filled(F.col("history")), "body": _filled(F.col("body"))}
    titled = lambda heading, value: F.concat(F.lit(f"{heading}\n" if heading else ""), value)
    rest = F.concat_ws("\n\n", *[titled(h, values[n]) for n, h in SECTIONS if n != "evidence"])
    heading = dict(SECTIONS)["evidence"]
    room = F.lit(max_chars - len(f"\n\n{heading}\n")) - F.length("__rest")
    evidence = F.when(F.col("__room") > 0, _filled(F.substring(_filled(F.col("evidence")), F.lit(1), F.col("__room"))))
    whole = F.concat_ws("\n\n", *[titled(h, evidence if n == "evidence" else values[n]) for n, h in SECTIONS])
    return joined.withColumn("__rest", rest).withColumn("__room", room).withColumn("prompt", whole).drop("__class", "__hint", "__rest", "__room")
