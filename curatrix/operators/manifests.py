"""Manifests of a reference: read from an extractor's reply, and held against a kernel.

A reply's object is its text, a fenced part of it or what lies between its outermost braces,
the first of them that is one. The object is a VARIANT, so any field may have any type; what
has a wrong one counts as missing. Names of kinds and types become canonical.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatrix.functions import names
from curatrix.functions.text import strip_thinking
from curatrix.operators.rules import abi_issues
from curatrix.operators.runs import manifest_status
from curatrix.operators.signatures import ABI, TENSORS, bound, signature_issues

NO_OBJECT, EMPTY, NO_SOURCE = "response is not a JSON object: ", "empty extractor response", "empty reference_source"
SNIPPET = 180
MANIFEST = f"struct<abi:{ABI},reference_source:string,reference_fn_name:string,problem:string>"


def _is_object(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value), F.lit("")).startswith("OBJECT")


def _get(value: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(value, path, kind)


def reply_object(reply: Column) -> Column:
    """The reply's object as a VARIANT, null where it holds none."""
    whole = F.coalesce(reply, F.lit(""))
    parts = F.array(*[x for text in (strip_thinking(whole), whole) for x in (F.trim(text), F.regexp_extract(text, r"(?is)```(?:json)?\s*(\{.*\})\s*```", 1), F.regexp_extract(text, r"(?s)\{.*\}", 0))])
    return bound(F.filter(F.transform(parts, lambda x: F.try_parse_json(x)), _is_object), lambda found: F.get(found, F.lit(0)))


def _param(p: Column) -> Column:
    kind = names.kind(_get(p, "$.kind"))

    def of(k: Column) -> Column:
        rank = F.when(k.isin(*TENSORS), F.greatest(F.lit(0), F.coalesce(_get(p, "$.rank", "int"), F.lit(1)))).otherwise(0)
        shape = F.coalesce(_get(p, "$.shape_from", "array<string>"), F.array().cast("array<string>"))
        return F.struct(F.coalesce(F.nullif(_get(p, "$.name"), F.lit("")), F.lit("arg")).alias("name"), k.alias("kind"), names.dtype(F.nullif(_get(p, "$.dtype"), F.lit(""))).alias("dtype"), rank.cast("int").alias("rank"), shape.alias("shape_from"))

    return bound(kind, of)


def read_interface_object(value: Column) -> Column:
    """The interface in an object, by canonical names; what is no object among its parameters goes."""
    returns = F.lower(F.trim(F.coalesce(F.nullif(_get(value, "$.returns"), F.lit("")), F.lit("void"))))
    params = F.filter(F.coalesce(_get(value, "$.params", "array<variant>"), F.array().cast("array<variant>")), _is_object)
    entry = F.coalesce(F.nullif(_get(value, "$.entry"), F.lit("")), F.nullif(_get(value, "$.host"), F.lit("")), F.lit("launch"))
    return F.struct(entry.alias("entry"), F.when(returns == "void", "void").otherwise(names.dtype(returns)).alias("returns"), F.transform(params, _param).alias("params"))


def _manifest_of(value: Column) -> Column:
    """(abi, reference_source, reference_fn_name) of an object, whose interface may be the object itself."""
    abi = _get(value, "$.abi", "variant")
    source = F.coalesce(F.nullif(_get(value, "$.reference_source"), F.lit("")), _get(value, "$.reference"), F.lit(""))
    name = F.coalesce(F.nullif(_get(value, "$.reference_fn_name"), F.lit("")), F.lit("reference"))
    return F.struct(bound(F.when(_is_object(abi), abi).otherwise(value), read_interface_object).alias("abi"), source.alias("reference_source"), name.alias("reference_fn_name"))


def read_manifest(reply: Column) -> Column:
    """(abi, reference_source, reference_fn_name, problem); a problem says why there is no object."""
    flat = F.trim(F.regexp_replace(F.coalesce(reply, F.lit("")), r"\s+", " "))
    problem = F.when(flat == "", EMPTY).otherwise(F.concat(F.lit(NO_OBJECT), F.substring(flat, 1, SNIPPET)))

    def of(value: Column) -> Column:
        m = _manifest_of(value)
        return F.struct(F.when(value.isNotNull(), m["abi"]).alias("abi"), F.when(value.isNotNull(), m["reference_source"]).alias("reference_source"), F.when(value.isNotNull(), m["reference_fn_name"]).alias("reference_fn_name"), F.when(value.isNull(), problem).alias("problem"))

    return bound(reply_object(reply), of)


def manifest_issues(manifest: Column) -> Column:
    """Why a reply is no manifest; an empty list if it is one."""
    abi = manifest["abi"]
    source = F.filter(F.array(F.when(F.trim(manifest["reference_source"]) == "", NO_SOURCE)), lambda x: x.isNotNull())
    return F.when(manifest["problem"].isNotNull(), F.array(manifest["problem"])).otherwise(F.concat(abi_issues(abi["entry"], abi["params"], abi["returns"]), source))


def resolved_manifests(rows: DataFrame) -> DataFrame:
    """(question_id, dialect, metadata, code) with status and issues: a manifest that names the
    right question and dialect is held against itself and against the code's signature, and
    ``misfit`` says that it doesn't fit."""
    status = manifest_status(F.col("metadata"), F.col("dialect"), F.col("question_id"))
    entry = F.try_element_at(F.from_json(F.get_json_object("metadata", "$.oracle_manifests"), "map<string,string>"), F.col("dialect"))
    read = rows.withColumn("__status", status).withColumn("__m", F.when(F.col("__status") == "resolved", bound(F.try_parse_json(entry), _manifest_of)))
    fitted = signature_issues(read.where("__status = 'resolved'").withColumn("__abi", F.col("__m.abi").cast(ABI)), "__abi", "code", "issues").drop("__abi")
    others = read.where("__status <> 'resolved'").withColumn("issues", F.array().cast("array<string>"))
    state = F.when((F.col("__status") == "resolved") & (F.size("issues") > 0), "misfit").otherwise(F.col("__status"))
    return fitted.unionByName(others).withColumn("status", state).drop("__status", "__m")
