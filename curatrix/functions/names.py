"""Canonical names of dialects, types, kinds, layouts and tracks."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Aliases of canonical names.
DIALECTS = {"cu": "cuda", "cuda-cpp": "cuda", "cuda_cpp": "cuda", "cute": "cutlass", "cutlass/cute": "cutlass", "cutlass_cute": "cutlass", "cutlass4": "cutlass", "cutlass4.x": "cutlass", "cutlass-4": "cutlass", "python-triton": "triton", "triton-lang": "triton", "tl": "tilelang", "tile-lang": "tilelang", "tile_lang": "tilelang"}
KNOWN_DIALECTS = ("cuda", "cutlass", "triton", "tilelang")
KINDS = {"in": "input", "src": "input", "out": "output", "dst": "output", "result": "output", "in_out": "inout", "in-out": "inout", "ptr": "input", "tensor": "input", "n": "size", "dim": "size", "shape": "size", "len": "size", "length": "size", "count": "size"}
KNOWN_KINDS = ("input", "output", "inout", "scalar", "size")
LAYOUTS = {"c": "contiguous", "row": "row_major", "rowmajor": "row_major", "col": "col_major", "column": "col_major", "column_major": "col_major", "stride": "strided"}
KNOWN_LAYOUTS = ("contiguous", "row_major", "col_major", "strided")
COMPARE_MODES = {"exact": "elementwise", "elem": "elementwise", "sort": "sorted", "sorted_flat": "sorted", "multiset": "sorted", "unique": "set", "set_union": "sorted"}
KNOWN_COMPARE_MODES = ("elementwise", "sorted", "set")

DTYPES = {
    "float": "f32", "float32": "f32", "fp32": "f32", "f32": "f32", "double": "f64", "float64": "f64", "fp64": "f64", "f64": "f64",
    "half": "f16", "float16": "f16", "fp16": "f16", "f16": "f16", "__half": "f16", "bfloat16": "bf16", "bf16": "bf16", "nv_bfloat16": "bf16",
    "int": "i32", "int32": "i32", "int32_t": "i32", "i32": "i32", "int64": "i64", "int64_t": "i64", "long": "i64", "longlong": "i64", "long long": "i64", "i64": "i64", "size_t": "i64",
    "int8": "i8", "int8_t": "i8", "signed char": "i8", "char": "i8", "i8": "i8", "uint8": "u8", "uint8_t": "u8", "unsigned char": "u8", "u8": "u8",
    "uint16": "u16", "uint16_t": "u16", "unsigned short": "u16", "unsigned short int": "u16", "u16": "u16", "uint32": "u32", "uint32_t": "u32", "unsigned": "u32", "unsigned int": "u32", "u32": "u32",
    "bool": "bool", "cublashandle_t": "cublas_handle", "cublas_handle": "cublas_handle", "cuffthandle": "cufft_handle", "cufft_handle": "cufft_handle",
    "cufftcomplex": "c64", "cucomplex": "c64", "float2": "c64", "complex64": "c64", "c64": "c64",
}


def dtype(raw: Column) -> Column:
    """The short name of a C, numpy or plain type name; f32 for unknown ones."""
    plain = F.lower(F.trim(F.coalesce(raw, F.lit("f32"))))
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(DTYPES.items())])
    joined = F.regexp_replace(F.regexp_replace(F.regexp_replace(plain, " ", ""), "::", ""), "std", "")
    return F.coalesce(F.try_element_at(table, joined), F.try_element_at(table, plain), F.lit("f32"))


def _canonical(raw: Column, aliases: dict[str, str], known: tuple[str, ...], default: str | None, empty: str) -> Column:
    name = F.lower(F.trim(F.coalesce(raw, F.lit(empty))))
    name = F.when(name == "", empty).otherwise(name)
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(aliases.items())])
    name = F.coalesce(F.try_element_at(table, name), name)
    return F.when(name.isin(*known), name).otherwise(F.lit(default))


def dialect(raw: Column) -> Column:
    """Null for an unknown dialect; the caller decides whether that is an error."""
    return _canonical(F.regexp_replace(raw, " ", ""), DIALECTS, KNOWN_DIALECTS, None, "")


def kind(raw: Column) -> Column:
    return _canonical(raw, KINDS, KNOWN_KINDS, "input", "input")


def layout(raw: Column) -> Column:
    return _canonical(F.regexp_replace(raw, "-", "_"), LAYOUTS, KNOWN_LAYOUTS, "contiguous", "contiguous")


def memory(raw: Column) -> Column:
    return F.when(F.lower(F.trim(raw)).isin("cpu", "host", "h"), "host").otherwise("device")


def compare_mode(raw: Column) -> Column:
    return _canonical(raw, COMPARE_MODES, KNOWN_COMPARE_MODES, "elementwise", "elementwise")


def track(topic: Column) -> Column:
    """The key of a topic's knowledge track; a key stays as it is."""
    name = F.lower(F.trim(F.coalesce(topic, F.lit(""))))
    return F.when(name == "", "knowledge:general").when(F.startswith(name, F.lit("knowledge:")), name).otherwise(F.concat(F.lit("knowledge:"), name))


def topic(track: Column, known: tuple[str, ...]) -> Column:
    """The topic of a track; what is neither a knowledge track nor a known topic is general."""
    name = F.lower(F.trim(F.coalesce(track, F.lit(""))))
    rest = F.regexp_extract(name, r"(?s)^knowledge:(.*)$", 1)
    return F.when(rest != "", rest).when(name.isin(*known), name).otherwise("general")
