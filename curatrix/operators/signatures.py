"""Interfaces of kernels: held against a source's signature, and read off a source.

An interface is a struct (entry, returns, params), a parameter a struct (name, kind, dtype,
rank, shape_from). Host functions are found by one pattern over a small, explicit subset of C;
their overloads, and templates with the types that they are instantiated for, become an array
of signatures, and every signature a list of issues. The shortest list is the answer. All of
this is column expressions on the row; Python sources alone are parsed, in Arrow batches.
"""

from __future__ import annotations

import ast

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatrix.functions import names
from curatrix.functions.text import bound
from curatrix.operators.rules import abi_issues

# Types of the C subset, and names that mark sizes, outputs and inputs.
C_TYPES = {
    "void": "void", "float": "f32", "double": "f64", "__half": "f16", "half": "f16", "nv_bfloat16": "bf16", "bfloat16": "bf16",
    "int": "i32", "int32_t": "i32", "uint32_t": "u32", "unsigned int": "u32", "unsigned": "u32", "long long": "i64", "int64_t": "i64", "size_t": "i64",
    "signed char": "i8", "int8_t": "i8", "unsigned char": "u8", "uint8_t": "u8", "uint16_t": "u16", "unsigned short": "u16", "unsigned short int": "u16", "bool": "bool",
    "cublashandle_t": "cublas_handle", "cuffthandle": "cufft_handle", "cufftcomplex": "c64", "cucomplex": "c64", "float2": "c64",
}
SIZE_NAMES = ("n", "m", "k", "size", "numel", "len", "length", "count", "rows", "cols", "h", "w", "height", "width", "batch", "dim", "dim0", "dim1", "dim2", "lda", "ldb", "ldc")
OUTPUT_NAMES = ("out", "output", "dst", "dest", "result", "c", "y", "z", "values", "indices")
INPUT_NAMES = ("a", "b", "x", "src", "input", "left", "right")
TENSORS = ("input", "output", "inout")
_QUALIFIERS = r"\b(?:const|volatile|__restrict__|restrict|__restrict)\b"
_TEMPLATE = r"(?:template\s*<\s*(?:typename|class)\s+([A-Za-z_]\w*)\s*>\s*)?"
_LEAD = r'^\s*(?:extern\s+"C"\s+|(?:__host__|static|inline)\s+)*([A-Za-z_]\w*(?:\s+[A-Za-z_]\w*)*)\s+'
_HOST = r"(?:^|\n)([^\n]{0,80}?)(void|int|float|double|bool|size_t|unsigned|long|uint32_t|int32_t|int64_t|__half|nv_bfloat16)(?:\s+long)?\s+([A-Za-z_]\w*)\s*\(([^;{]*)\)\s*\{"

PARAM = "struct<name:string,kind:string,dtype:string,rank:int,shape_from:array<string>>"
ABI = f"struct<entry:string,returns:string,params:array<{PARAM}>>"


def _one_blank(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def c_type(raw: Column) -> Column:
    """The short name of a type of the subset, else null."""
    table = F.create_map(*[F.lit(x) for pair in C_TYPES.items() for x in pair])
    return F.try_element_at(table, F.lower(_one_blank(F.regexp_replace(F.regexp_replace(raw, _QUALIFIERS, ""), r"\*", " "))))


def split_args(args: Column) -> Column:
    """Arguments between commas that no bracket holds, blanks around them cut, empty ones left out."""
    parts = F.transform(F.split(args, r",(?![^<(\[]*[>)\]])"), lambda x: F.regexp_replace(x, r"^\s+|\s+$", ""))
    return F.filter(parts, lambda x: x != "")


def c_param(raw: Column) -> Column:
    """(name, dtype, pointer, issue) of a parameter; its name is the last word."""
    plain = _one_blank(F.regexp_replace(F.regexp_replace(raw, _QUALIFIERS, " "), r"\*", " "))
    odd = raw.rlike(r"[\[\]()=&]|\.\.\.|->") | ~plain.rlike(r"^\S.* [A-Za-z_]\w*$")
    shape = F.regexp_extract(plain, r"^(.*) (\S+)$", 1)
    dtype = c_type(shape)
    issue = F.when(odd, F.concat(F.lit("unsupported CUDA parameter syntax '"), raw, F.lit("'"))).when(dtype.isNull(), F.concat(F.lit("unsupported CUDA type '"), shape, F.lit("'")))
    return F.struct(F.substring_index(plain, " ", -1).alias("name"), dtype.alias("dtype"), raw.contains("*").alias("pointer"), issue.alias("issue"))


def _quoted(word: Column) -> Column:
    return F.concat(F.lit("\\Q"), F.coalesce(word, F.lit("")), F.lit("\\E"))


def _captured(text: Column, pattern: Column, group: int) -> Column:
    return F.regexp_extract_all(text, pattern, F.lit(group))


def signatures(source: Column, entry: Column) -> Column:
    """(returns, args) of every overload of the entry, then of each instantiated template, in order."""
    pattern = F.concat(F.lit("(?m)" + _TEMPLATE + _LEAD), _quoted(entry), F.lit(r"\s*\(([^()]*)\)\s*[{;]"))
    made_for = F.concat(F.lit(r"(?m)^\s*template\s+[A-Za-z_][\w\s*]*\b"), _quoted(entry), F.lit(r"\s*<\s*([A-Za-z_][\w:]*)\s*>"))
    heads = F.arrays_zip(_captured(source, pattern, 1).alias("of"), _captured(source, pattern, 2).alias("returns"), _captured(source, pattern, 3).alias("args"))
    types = F.array_distinct(_captured(source, made_for, 1))
    view = lambda returns, args: F.struct(returns.alias("returns"), args.alias("args"))

    def replaced(head: Column, concrete: Column) -> Column:
        word = F.concat(F.lit(r"\b"), head["of"], F.lit(r"\b"))
        return view(F.regexp_replace(head["returns"], word, concrete), F.regexp_replace(head["args"], word, concrete))

    def of(h: Column) -> Column:
        # A template that never names its type has nothing to replace.
        general = F.filter(h, lambda x: (x["of"] != "") & F.rlike(F.concat_ws(" ", x["returns"], x["args"]), F.concat(F.lit(r"\b"), x["of"], F.lit(r"\b"))))
        return F.concat(F.transform(h, lambda x: view(x["returns"], x["args"])), F.flatten(F.transform(general, lambda x: F.transform(types, lambda t: replaced(x, t)))))

    return bound(heads, of)


def _flat(*issues: Column) -> Column:
    """Those issues that aren't null."""
    return F.filter(F.array(*issues), lambda x: x.isNotNull())


def _text(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _is_tensor(param: Column) -> Column:
    return param["kind"].isin(*TENSORS)


def _param_issues(place: Column, own: Column, expected: Column) -> Column:
    said = _text("parameter '", expected["name"], "' ")
    return F.when(own["issue"].isNotNull(), F.array(_text("parameter ", place.cast("string"), ": ", own["issue"]))).otherwise(_flat(
        F.when(own["name"] != expected["name"], _text("parameter ", place.cast("string"), " name/order mismatch: source='", own["name"], "' abi='", expected["name"], "'")),
        F.when(own["dtype"] != expected["dtype"], _text(said, "type mismatch: source=", own["dtype"], " abi=", expected["dtype"])),
        F.when(own["pointer"] != _is_tensor(expected), _text(said, "kind mismatch: expected ", F.when(_is_tensor(expected), "pointer").otherwise("scalar"))),
    ))


def _count_issue(n: Column, params: Column) -> Column:
    return F.when(n != F.size(params), _text("parameter count mismatch: source=", n.cast("string"), " abi=", F.size(params).cast("string")))


def _pairs(own: Column, params: Column, issues) -> Column:
    """Issues of the parameters that both sides have, in order."""
    both = F.least(F.size(own), F.size(params))
    at = F.when(both > 0, F.sequence(F.lit(0), both - 1)).otherwise(F.array().cast("array<int>"))
    return F.flatten(F.transform(at, lambda i: issues(i, F.get(own, i), F.get(params, i))))


def _overload_issues(view: Column, abi: Column) -> Column:
    want = F.coalesce(F.nullif(abi["returns"], F.lit("")), F.lit("void"))

    def with_returns(returns: Column) -> Column:
        return _flat(F.when(returns.isNull(), _text("unsupported CUDA return type '", view["returns"], "'")).when(returns != want, _text("return type mismatch: source=", returns, " abi=", want)))

    def with_args(own: Column) -> Column:
        return F.concat(_flat(_count_issue(F.size(own), abi["params"])), _pairs(own, abi["params"], _param_issues))

    args = bound(split_args(view["args"]), lambda x: F.when((F.size(x) == 1) & (x[0] == "void"), F.array().cast("array<string>")).otherwise(x))
    return F.concat(bound(c_type(view["returns"]), with_returns), bound(F.transform(args, c_param), with_args))


def c_signature_issues(abi: Column, source: Column) -> Column:
    """Issues of the overload that comes nearest; the first of equals."""
    def best(views: Column) -> Column:
        judged = F.transform(views, lambda v, i: bound(_overload_issues(v, abi), lambda x: F.struct(F.size(x).alias("n"), i.alias("i"), x.alias("issues"))))
        return F.when(F.size(views) == 0, F.array(_text("unsupported or missing CUDA signature for entry '", abi["entry"], "'"))).otherwise(F.array_min(judged)["issues"])

    return bound(signatures(source, abi["entry"]), best)


PYTHON = "error string, found boolean, plain boolean, returns string, params array<struct<name:string,annotation:string>>"


def python_signature(source: Column, entry: Column) -> Column:
    """The named top-level function's parameters and annotations: null where there is none, '' where it is no plain name."""
    return F.pandas_udf(_python_signatures, PYTHON)(source, entry)


def _python_signatures(sources: pd.Series, entries: pd.Series) -> pd.DataFrame:
    def dotted(node: ast.AST | None) -> str | None:
        if node is None:
            return None
        text = ast.unparse(node)
        return text if all(x.isidentifier() for x in text.split(".")) else ""

    def read(source: str, entry: str) -> tuple:
        try:
            body = ast.parse(source).body
        except (SyntaxError, ValueError) as fault:
            return (str(fault), False, False, None, [])
        f = next((x for x in body if isinstance(x, (ast.FunctionDef, ast.AsyncFunctionDef)) and x.name == entry), None)
        if f is None:
            return (None, False, False, None, [])
        plain = not (f.args.vararg or f.args.kwarg or f.args.kwonlyargs or f.args.posonlyargs)
        return (None, True, plain, dotted(f.returns), [{"name": a.arg, "annotation": dotted(a.annotation)} for a in f.args.args])

    return pd.DataFrame([read(s or "", e or "") for s, e in zip(sources, entries, strict=True)], columns=["error", "found", "plain", "returns", "params"])


def _annotated(annotation: Column) -> Column:
    """(kind, dtype): unknown without an annotation, unsupported for forms outside the subset."""
    low = F.lower(annotation)
    scalar = F.when(low.isin("int", "builtins.int"), "i32").when(low.isin("float", "builtins.float"), "f32").when(low.isin("bool", "builtins.bool"), "bool")
    tensor = low.endswith("tensor") | low.endswith("ndarray") | low.isin("array", "buffer")
    kind = F.when(low.isNull(), "unknown").when(scalar.isNotNull(), "scalar").when(tensor, "tensor").otherwise("unsupported")
    return F.struct(kind.alias("kind"), scalar.alias("dtype"))


def _python_param_issues(place: Column, own: Column, expected: Column) -> Column:
    said = _text("parameter '", expected["name"], "' ")

    def of(a: Column) -> Column:
        return _flat(
            F.when(own["name"] != expected["name"], _text("parameter ", place.cast("string"), " name/order mismatch: source='", own["name"], "' abi='", expected["name"], "'")),
            F.when(a["kind"] == "unsupported", _text("unsupported Python annotation for parameter '", expected["name"], "'")),
            F.when(_is_tensor(expected) & (a["kind"] == "scalar"), _text(said, "expected tensor annotation")),
            F.when(~_is_tensor(expected) & (a["kind"] == "tensor"), _text(said, "expected scalar annotation")),
            F.when(a["dtype"] != expected["dtype"], _text(said, "type mismatch: source=", a["dtype"], " abi=", expected["dtype"])),
        )

    return bound(_annotated(own["annotation"]), of)


def python_signature_issues(abi: Column, read: Column) -> Column:
    """Issues of what ``python_signature`` read."""
    want = F.coalesce(F.nullif(abi["returns"], F.lit("")), F.lit("void"))
    returned = _annotated(read["returns"])
    compared = F.concat(
        _flat(_count_issue(F.size(read["params"]), abi["params"])),
        _pairs(read["params"], abi["params"], _python_param_issues),
        _flat(
            F.when(returned["kind"] == "unsupported", "unsupported Python return annotation"),
            F.when((want != "void") & (returned["dtype"] != want), _text("return type mismatch: source=", returned["dtype"], " abi=", want)),
        ),
    )
    return (
        F.when(read["error"].isNotNull(), F.array(_text("Python syntax error: ", read["error"])))
        .when(~read["found"], F.array(_text("missing Python function '", abi["entry"], "'")))
        .when(~read["plain"], F.array(F.lit("unsupported Python signature: varargs/keyword-only/positional-only parameters")))
        .otherwise(compared)
    )


def signature_issues(rows: DataFrame, abi: str = "abi", source: str = "source", name: str = "issues") -> DataFrame:
    """rows with the issues of a C or Python source under an interface, then those of the
    interface itself; an empty list says that they agree. A null source is an empty one."""
    text, entry = F.coalesce(source, F.lit("")), F.coalesce(F.col(abi)["entry"], F.lit(""))
    python = F.rlike(text, F.concat(F.lit(r"(?m)^\s*(?:async\s+)?def\s+"), _quoted(entry), F.lit(r"\s*\(")))
    form = F.when(entry == "", "no entry").when(~F.contains(text, entry), "absent").when(python, "python").otherwise("c")
    formed = rows.withColumn("__form", form)
    # Only Python sources reach the parser.
    read = formed.withColumn("__read", F.when(F.col("__form") == "python", python_signature(F.when(F.col("__form") == "python", text), entry)))
    found = (
        F.when(F.col("__form") == "no entry", F.array(F.lit("empty entry name")))
        .when(F.col("__form") == "absent", F.array(_text("entry '", entry, "' not found in source")))
        .when(F.col("__form") == "python", python_signature_issues(F.col(abi), F.col("__read")))
        .otherwise(c_signature_issues(F.col(abi), text))
    )
    own = abi_issues(F.col(abi)["entry"], F.col(abi)["params"], F.col(abi)["returns"])
    return read.withColumn("__found", found).withColumn(name, F.concat("__found", F.array_except(own, F.col("__found")))).drop("__form", "__read", "__found")


def _read_param(raw: Column) -> Column:
    """A parameter's kind and type by its form and name."""
    text = F.regexp_replace(F.regexp_replace(raw, r"\b__restrict__\b|\brestrict\b|\b__restrict\b", ""), r"^\s+|\s+$", "")
    low = F.lower(text)
    plain = _one_blank(F.regexp_replace(F.regexp_replace(text, r"[*&]", " "), r"\b(?:const|volatile)\b", " "))
    name = F.substring_index(plain, " ", -1)
    shape = F.coalesce(F.nullif(F.trim(F.regexp_extract(plain, r"^(.*) \S+$", 1)), F.lit("")), F.lit("int"))
    dtype = F.when(low.rlike("size_t|long long|int64"), "i64").when(low.rlike(r"__half|(?:^|\s)half(?:\s|$)"), "f16").when(low.contains("bfloat16"), "bf16").otherwise(names.dtype(shape))
    lname = F.lower(name)
    size = lname.rlike("(?:" + "|".join(SIZE_NAMES) + ")$")
    written = ~text.rlike(r"\bconst\b") & (lname.rlike("|".join(OUTPUT_NAMES)) | ~lname.isin(*INPUT_NAMES))
    pointer = text.contains("*")
    kind = F.when(pointer, F.when(written, "output").otherwise("input")).otherwise(F.when(size, "size").otherwise("scalar"))
    return F.when(~text.isin("", "void"), F.struct(name.alias("name"), kind.alias("kind"), F.when(~pointer & size, "i32").otherwise(dtype).alias("dtype"), F.when(pointer, 1).otherwise(0).alias("rank")))


def read_interface(source: Column) -> Column:
    """The interface of a CUDA source's host function, null if none is plausible: of functions
    with parameters that run on the host, one that launches a kernel, else any; the last of equals.
    Tensors get the first size as theirs."""
    text = F.coalesce(source, F.lit(""))
    heads = F.arrays_zip(*[_captured(text, F.lit("(?m)" + _HOST), i).alias(n) for i, n in ((1, "prefix"), (2, "returns"), (3, "name"), (4, "args"))])
    bodies = F.split(text, "(?m)" + _HOST, -1)  # what follows each head, up to the next

    def candidate(h: Column, i: Column, rest: Column) -> Column:
        params = F.filter(F.transform(split_args(h["args"]), _read_param), lambda p: p.isNotNull())
        return F.struct(F.contains(F.get(rest, i + 1), F.lit("<<<")).alias("launches"), i.alias("i"), h["name"].alias("entry"), h["returns"].alias("returns"), params.alias("params"), h["prefix"].rlike("__global__|__device__").alias("device"))

    def chosen(c: Column) -> Column:
        host = F.filter(c, lambda x: (x["entry"] != "main") & ~x["device"] & (F.size(x["params"]) > 0))
        return F.array_max(F.transform(host, lambda x: F.struct(x["launches"].alias("launches"), x["i"].alias("i"), x["entry"].alias("entry"), x["returns"].alias("returns"), x["params"].alias("params"))))

    def finished(c: Column) -> Column:
        sizes = F.slice(F.transform(F.filter(c["params"], lambda p: p["kind"] == "size"), lambda p: p["name"]), 1, 1)
        none = F.array().cast("array<string>")
        params = F.transform(c["params"], lambda p: F.struct(p["name"].alias("name"), p["kind"].alias("kind"), p["dtype"].alias("dtype"), p["rank"].alias("rank"), F.when(_is_tensor(p), sizes).otherwise(none).alias("shape_from")))
        tensors = F.transform(F.filter(c["params"], _is_tensor), lambda p: p["dtype"])
        named = F.concat(F.array(c["entry"]), F.transform(c["params"], lambda p: p["name"]))
        return F.when(c.isNotNull(), F.struct(
            c["entry"].alias("entry"), F.when(c["returns"] == "void", "void").otherwise(names.dtype(c["returns"])).alias("returns"), params.alias("params"),
            F.coalesce(F.get(tensors, F.lit(0)), F.lit("f32")).alias("dtype"), F.exists(named, lambda n: F.lower(n).rlike("union|hist")).alias("sort_outputs"),
        ))

    listed = bound(heads, lambda h: bound(bodies, lambda rest: F.transform(h, lambda x, i: candidate(x, i, rest))))
    return bound(bound(listed, chosen), finished)
