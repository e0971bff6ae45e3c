"""Validation cases of a kernel interface: which there are, their shapes and their inputs.

An interface is a struct: its type, flags, and params (name, kind, dtype, rank, shape_from,
layout, alias_of). Plans are rows that a small table of templates is exploded and filtered
into; shapes are array expressions. Inputs are filled by CPython's generator, which no SQL
function equals, in ``mapInArrow``.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARAM = "struct<name:string,kind:string,dtype:string,rank:int,shape_from:array<string>,layout:string,alias_of:string>"
ABI = f"struct<dtype:string,layout:string,allows_nan:boolean,in_place:boolean,supports_strided:boolean,supports_broadcast:boolean,supports_inplace:boolean,params:array<{PARAM}>>"
PLAN = "name:string,kind:string,shapes:map<string,array<int>>,strides:map<string,array<int>>,dtypes:map<string,string>,scalars:map<string,double>,seed:long,generate_nan:boolean,generate_denorm:boolean,generate_dup:boolean,large:boolean"
TENSORS = ("input", "output", "inout")
INTEGERS = ("i8", "i32", "i64", "u8", "u16", "u32")
# The cases in order, as (name, kind, n); large and extreme sizes depend on the rank.
CASES = (
    ("n0", "n0", 0),
    ("n1", "n1", 1),
    ("odd_7", "non_tile", 7),
    ("odd_33", "non_tile", 33),
    ("odd_63", "non_tile", 63),
    ("odd_255", "non_tile", 255),
    ("odd_257", "non_tile", 257),
    ("non_pow2_100", "non_pow2", 100),
    ("non_pow2_24", "non_pow2", 24),
    ("large", "large", -1),
    ("extreme", "extreme", -2),
    ("dup", "dup", 32),
    ("strided", "strided", 33),
    ("broadcast", "broadcast", 15),
    ("rectangular", "non_tile", 15),
    ("inplace", "inplace", 33),
    ("row_major_tail", "row_major_tail", 33),
    ("tail_17", "tail", 17),
    ("tail_33", "tail", 33),
    ("non_pow2_1000", "non_pow2", 1000),
    ("odd_511", "non_tile", 511),
)
SMOKE = ("n0", "n1", "odd_7")
FULL_ONLY = ("non_pow2_1000", "odd_511")
# Extents of a filter, and what extreme and repeated inputs are made of.
FILTER_EXTENTS = (3, 5, 7)
EXTREME = (0.0, -0.0, 1.0, -1.0, 1e-20, -1e-20, 1e10, -1e10)
DENORMAL = (1e-40, -1e-40)
REPEATED_FLOATS = (0.0, 1.0, 1.0, 2.0, 2.0, 3.0)
REPEATED_INTEGERS = (1, 1, 2, 2, 3, 4, 4)
HALF_PATTERNS = (0, 1, 255, 0x3400, 0x3800, 0x3C00, 0x4000, 0xBC00, 0xC000)


def case_seed(question_id: Column, name: Column) -> Column:
    """31 bits of a hash: the first eight digest bytes, little-endian."""
    digest = F.sha2(F.concat_ws("|", question_id.cast("string"), F.lit("case"), F.lower(F.trim(name)), F.lit("")), 256)
    low = F.concat(*[F.substring(digest, 2 * i + 1, 2) for i in (3, 2, 1, 0)])
    return F.conv(low, 16, 10).cast("long").bitwiseAND(F.lit(0x7FFFFFFF))


def size_names(abi: Column) -> Column:
    """Size parameters, else the names that shapes mention, else n."""
    named = F.transform(F.filter(abi["params"], lambda p: p["kind"] == "size"), lambda p: p["name"])
    tensors = F.filter(abi["params"], lambda p: p["kind"].isin(*TENSORS))
    meant = F.array_distinct(F.flatten(F.transform(tensors, lambda p: F.coalesce(p["shape_from"], F.array().cast("array<string>")))))
    return F.when(F.size(named) > 0, named).when(F.size(meant) > 0, meant).otherwise(F.array(F.lit("n")))


def _wanted(abi: Column, name: Column, suite: Column, rank: Column, names: Column) -> Column:
    params = abi["params"]
    yes = lambda c: F.coalesce(c, F.lit(False))
    strided = yes(abi["supports_strided"]) | yes(abi["layout"] == "strided") | F.exists(params, lambda p: yes(p["layout"] == "strided"))
    wide = (F.size(names) > 1) | F.exists(params, lambda p: p["kind"].isin(*TENSORS) & (F.size(p["shape_from"]) > 1))
    inplace = yes(abi["supports_inplace"]) | yes(abi["in_place"]) | F.exists(params, lambda p: F.coalesce(p["alias_of"], F.lit("")) != "")
    rules = {"strided": strided, "broadcast": yes(abi["supports_broadcast"]), "rectangular": ~yes(abi["supports_broadcast"]) & wide, "inplace": inplace, "row_major_tail": rank >= 2, "tail_17": rank >= 2, "tail_33": rank < 2}
    fits = F.when(name.isin(*FULL_ONLY), suite == "full")
    for k, rule in rules.items():
        fits = fits.when(name == k, rule)
    return F.when(suite == "smoke", name.isin(*SMOKE)).otherwise(fits.otherwise(F.lit(True)))


def numel(shape: Column) -> Column:
    return F.aggregate(shape, F.lit(1).cast("long"), lambda a, d: a * F.greatest(d, F.lit(0)))


def row_major(shape: Column, unit: Column) -> Column:
    """Strides in elements of a dense layout whose last axis steps by unit."""
    return F.transform(shape, lambda _, i: (unit * numel(F.slice(shape, i + 2, F.size(shape)))).cast("int"))


def storage_numel(shape: Column, strides: Column) -> Column:
    """Elements that a strided tensor spans; a scalar one, an empty tensor none."""
    spans = F.aggregate(F.zip_with(shape, strides, lambda n, s: (n - 1) * s), F.lit(1), lambda a, x: a + x)
    return F.when(F.size(shape) == 0, 1).when(F.exists(shape, lambda d: d == 0), 0).otherwise(spans)


def case_plans(abis: DataFrame, suite: str = "standard", max_elements: int = 4_000_000) -> DataFrame:
    """(question_id, abi) -> one row a case: ordinal, name, kind, n, shapes, strides, dtypes,
    scalars, alias, seed and flags. Names are unique by construction."""
    abi = F.col("abi")
    tensors = F.filter(abi["params"], lambda p: p["kind"].isin(*TENSORS))
    rank = F.greatest(F.coalesce(F.array_max(F.transform(tensors, lambda p: F.coalesce(p["rank"], F.lit(1)))), F.lit(1)), F.lit(1))
    templates = F.array(*[F.struct(F.lit(i).alias("order"), F.lit(a).alias("name"), F.lit(b).alias("kind"), F.lit(c).alias("n")) for i, (a, b, c) in enumerate(CASES)])
    rows = abis.select("question_id", "abi", rank.alias("rank"), size_names(abi).alias("names"))
    fitting = F.filter(templates, lambda t: _wanted(abi, t["name"], F.lit(suite), F.col("rank"), F.col("names")))
    rows = rows.select("*", F.posexplode(fitting).alias("ordinal", "t"))
    side = F.greatest(F.floor(F.sqrt(F.lit(float(min(max_elements, 4_000_000))))), F.lit(2))
    n = F.when(F.col("t.n") == -1, F.when(F.col("rank") <= 1, F.lit(min(max_elements, 1_000_000))).otherwise(side)).when(F.col("t.n") == -2, F.when(F.col("rank") <= 1, 33).otherwise(17)).otherwise(F.col("t.n")).cast("int")
    rows = rows.select("question_id", "abi", "names", "ordinal", F.col("t.name").alias("name"), F.col("t.kind").alias("kind"), n.alias("n"))
    vary = F.col("name").isin("broadcast", "rectangular")
    extent = F.element_at(F.array(*map(F.lit, FILTER_EXTENTS)), (F.col("ordinal") % len(FILTER_EXTENTS) + 1).cast("int"))
    size = F.transform("names", lambda s, i: F.when(s == "kernel_size", extent).when((i > 0) & vary & (F.col("n") > 1), F.greatest(F.floor(F.col("n") / 2).cast("int"), F.lit(1))).otherwise(F.col("n")))
    rows = rows.withColumn("sizes", F.map_from_arrays("names", size))

    def shape(p: Column) -> Column:
        thin = (F.col("name") == "broadcast") & (p["kind"] == "input")
        named = F.transform(p["shape_from"], lambda s: F.coalesce(F.try_element_at(F.col("sizes"), s), F.col("n")))
        last = F.transform(named, lambda d, i: F.when(thin & (F.size(named) >= 2) & (i == F.size(named) - 1) & (d > 1), 1).otherwise(d))
        plain = F.transform(F.sequence(F.lit(1), F.greatest(F.coalesce(p["rank"], F.lit(1)), F.lit(1))), lambda i: F.when(thin & (i > 1), 1).otherwise(F.col("n")))
        return F.transform(F.when(F.size(F.coalesce(p["shape_from"], F.array().cast("array<string>"))) > 0, last).otherwise(plain), lambda d: F.greatest(d, F.lit(0)).cast("int"))

    tensors = F.filter(F.col("abi.params"), lambda p: p["kind"].isin(*TENSORS))
    rows = rows.withColumn("full", F.transform(tensors, lambda p: F.struct(p["name"].alias("name"), p["dtype"].alias("dtype"), shape(p).alias("shape"))))
    # Shapes over the cap shrink alike on all axes, and sizes with them.
    biggest = F.array_max(F.transform("full", lambda x: numel(x["shape"])))
    axes = F.greatest(F.array_max(F.transform("full", lambda x: F.size(x["shape"]))), F.lit(1))
    rows = rows.withColumn("scale", F.when(biggest > max_elements, F.pow(F.lit(float(max_elements)) / biggest, 1.0 / axes)).otherwise(F.lit(1.0)))
    cut = lambda d: F.floor(d * F.col("scale")).cast("int")
    rows = rows.withColumn("full", F.transform("full", lambda x: F.struct(x["name"], x["dtype"], F.transform(x["shape"], cut).alias("shape")))).withColumn("sizes", F.transform_values("sizes", lambda _, v: cut(v)))
    rows = rows.withColumn("seed", case_seed(F.col("question_id"), F.col("name")))
    # Strided cases leave every other element out.
    spread = F.filter(F.transform("full", lambda x: F.struct(x["name"].alias("name"), F.when(F.exists(x["shape"], lambda d: d <= 0), None).otherwise(row_major(x["shape"], F.lit(2))).alias("strides"))), lambda x: x["strides"].isNotNull())
    strides = F.when(F.col("kind") == "strided", F.map_from_entries(spread)).otherwise(F.create_map().cast("map<string,array<int>>"))
    rows = rows.withColumn("strides", strides)
    return rows.select("question_id", "ordinal", "name", "kind", "n", F.map_from_entries(F.transform("full", lambda x: F.struct(x["name"], x["shape"]))).alias("shapes"), "strides", F.map_from_entries(F.transform("full", lambda x: F.struct(x["name"], x["dtype"]))).alias("dtypes"), scalars(F.col("abi"), F.col("sizes"), F.col("seed"), F.col("strides")).alias("scalars"), aliases(F.col("abi"), F.col("kind")).alias("alias"), "seed", ((F.col("kind") == "extreme") & F.coalesce(F.col("abi.allows_nan"), F.lit(False))).alias("generate_nan"), (F.col("kind") == "extreme").alias("generate_denorm"), (F.col("kind") == "dup").alias("generate_dup"), (F.col("kind") == "large").alias("large"))


def scalars(abi: Column, sizes: Column, seed: Column, strides: Column) -> Column:
    """Values of scalar and size parameters; a small part of the seed keeps factors from 1, and
    a strided case passes its tensors' strides."""
    mix = (seed % 97) / 97.0

    def value(p: Column) -> Column:
        name = F.lower(p["name"])
        has = lambda *xs: name.rlike("|".join(xs))
        whole = F.when(has("stride"), 1.0).when(has("scale", "factor"), F.when(mix < 0.5, 2.0).otherwise(3.0)).when(has("threshold"), 1.0).otherwise(1.0 + F.floor(mix * 5))
        real = F.when(has("scale", "alpha", "factor"), F.when(mix < 0.5, 1.5).otherwise(-2.0)).when(has("mu"), 0.0).when(has("sigma"), 1.0).when(has("threshold"), 0.5).otherwise(1.25 + mix)
        fixed = F.when(p["kind"] == "size", F.when(has("stride"), F.lit(1.0)).otherwise(F.coalesce(F.try_element_at(sizes, p["name"]), F.lit(0)).cast("double"))).when(p["dtype"].endswith("_handle"), F.lit(None)).when(p["dtype"] == "bool", F.lit(1.0)).when(p["dtype"].isin(*INTEGERS), whole).otherwise(real)
        tensor = F.regexp_extract(name, r"^(.*?)_(?:row_|col_)?stride$", 1)
        layout = F.try_element_at(F.transform(F.filter(F.map_entries(strides), lambda x: F.lower(x["key"]) == tensor), lambda x: x["value"]), F.lit(1))
        axis = F.when(name.endswith("_col_stride"), 2).otherwise(1)
        rank = F.when(name.endswith("_row_stride") | name.endswith("_col_stride"), 2).otherwise(1)
        given = F.when(F.size(layout) == rank, F.try_element_at(layout, axis))
        return F.coalesce(given.cast("double"), fixed)

    own = F.filter(abi["params"], lambda p: p["kind"].isin("scalar", "size"))
    named = F.transform(own, lambda p: F.struct(p["name"].alias("k"), value(p).alias("v")))
    known = F.transform(own, lambda p: p["name"])
    rest = F.transform(F.filter(F.map_entries(sizes), lambda x: ~F.array_contains(known, x["key"])), lambda x: F.struct(x["key"].alias("k"), x["value"].cast("double").alias("v")))
    return F.map_from_entries(F.concat(rest, named))


def aliases(abi: Column, kind: Column) -> Column:
    """output -> input that shares its memory, in in-place cases: as stated, or else the first
    output and input of one type."""
    none = F.create_map().cast("map<string,string>")
    stated = F.transform(F.filter(abi["params"], lambda p: F.coalesce(p["alias_of"], F.lit("")) != ""), lambda p: F.struct(p["name"], p["alias_of"]))
    outs, ins = F.filter(abi["params"], lambda p: p["kind"].isin("output", "inout")), F.filter(abi["params"], lambda p: p["kind"] == "input")
    pairs = F.flatten(F.transform(outs, lambda o: F.transform(F.filter(ins, lambda i: (i["name"] != o["name"]) & (i["dtype"] == o["dtype"])), lambda i: F.struct(o["name"].alias("o"), i["name"].alias("i")))))
    return F.when(kind != "inplace", none).when(F.size(stated) > 0, F.map_from_entries(stated)).when(F.size(pairs) > 0, F.map_from_entries(F.slice(pairs, 1, 1))).otherwise(none)


def fill(n: int, dtype: str, rng: random.Random, kind: str, dup: bool, denorm: bool, nan: bool) -> list:
    """The values of one input."""
    if dtype == "c64":
        return [complex(rng.random() * 4.0 - 2.0, rng.random() * 4.0 - 2.0) for _ in range(n)]
    if dtype in ("f16", "f32", "f64", "bf16"):
        cycle = REPEATED_FLOATS if dup else (*EXTREME, *(DENORMAL if denorm else ()), *((float("nan"),) if nan else ())) if kind == "extreme" else None
        return [cycle[i % len(cycle)] for i in range(n)] if cycle else [rng.random() * 4.0 - 2.0 for _ in range(n)]
    if dtype == "bool":
        return [bool(i % 2) for i in range(n)]
    if dup:
        return [REPEATED_INTEGERS[i % len(REPEATED_INTEGERS)] for i in range(n)]
    if dtype == "u16":
        return [HALF_PATTERNS[rng.randrange(len(HALF_PATTERNS))] for _ in range(n)]
    most = 8 if dtype in ("i8", "u8") else 50
    return [rng.randrange(0 if dtype.startswith("u") else -most, most + 1) for _ in range(n)]


NUMPY = {"f16": "<f2", "f32": "<f4", "f64": "<f8", "bf16": "<f4", "i8": "i1", "i32": "<i4", "i64": "<i8", "u8": "u1", "u16": "<u2", "u32": "<u4", "bool": "?", "c64": "<c8"}
FILLED = "question_id long, name string, tensor string, dtype string, shape array<int>, data binary"


def filled(plans: DataFrame) -> DataFrame:
    """plans (question_id, name, kind, seed, flags, params: array of (name, kind, dtype, shape)
    in the interface's order) -> one row a tensor with its dense little-endian bytes. Outputs
    are zeros, or their alias's bytes. One tensor is held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                rng, made = random.Random(row["seed"]), {}
                alias = dict(row["alias"] or [])
                for p in row["params"]:
                    n = int(np.prod(p["shape"])) if p["shape"] else 1
                    values = fill(n, p["dtype"], rng, row["kind"], row["generate_dup"], row["generate_denorm"], row["generate_nan"]) if p["kind"] in ("input", "inout") else [0] * n
                    with np.errstate(over="ignore"):
                        made[p["name"]] = np.asarray(values, dtype=NUMPY[p["dtype"]]).tobytes()
                for p in row["params"]:
                    data = made[alias[p["name"]]] if alias.get(p["name"]) in made else made[p["name"]]
                    yield pa.RecordBatch.from_pylist([{"question_id": row["question_id"], "name": row["name"], "tensor": p["name"], "dtype": p["dtype"], "shape": p["shape"], "data": data}], schema=pa.schema([("question_id", pa.int64()), ("name", pa.string()), ("tensor", pa.string()), ("dtype", pa.string()), ("shape", pa.list_(pa.int32())), ("data", pa.binary())]))

    return plans.select("question_id", "name", "kind", "seed", "generate_dup", "generate_denorm", "generate_nan", "alias", "params").mapInArrow(run, FILLED)


def suite_hashes(plans: DataFrame) -> DataFrame:
    """(question_id, n_cases, suite_hash) of the meaning of each question's cases, in their order."""
    meaning = [c for c in plans.columns if c not in ("question_id", "ordinal", "files", "outputs")]
    one = F.struct("ordinal", F.to_json(F.struct(*sorted(meaning))).alias("case"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(one)), lambda x: x["case"]), "\n")
    return plans.groupBy("question_id").agg(F.count("*").alias("n_cases"), F.sha2(text, 256).alias("suite_hash"))
