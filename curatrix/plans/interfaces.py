"""Queries that hold kernel interfaces against sources. A part gives a source and its
interface; which of fourteen forms the source takes goes by its key, its types by its size.
The oracles say what is wrong from the form and the types, without reading the source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatrix.functions import names
from curatrix.operators.signatures import ABI, read_interface, signature_issues
from curatrix.plans.base import Tables, query

TYPES = (("float", "f32"), ("double", "f64"), ("int", "i32"), ("unsigned char", "u8"))
OTHERS = (("double", "f64"), ("float", "f32"), ("float", "f32"), ("float", "f32"))
#: E: entry, T: type, O: another type.
SOURCES = (
    "__global__ void k(T* c) {}\nvoid E(const T* a, T* c, int n) {\n  k<<<1, n>>>(c);\n}\n",
    "void E(const T* a, T* out2, int n) {}\n",
    "void E(const O* __restrict__ a, T* c, int n) {}\n",
    "void E(const T* a, T c, int n);\n",
    "void E(const T* a, T* c) {}\n",
    "template <typename U>\nvoid E(const U* a, U* c, int n) {}\ntemplate void E<O>(const O*, O*, int);\ntemplate void E<T>(const T*, T*, int);\n",
    "template <class U>\nvoid E(const U* a, U* c, int n) {}\n",
    "template <class U>\nvoid E(const U* a, U* c, int n) {}\nvoid E(const T* a, T* c, int n) {}\n",
    'extern "C" int E(const T* a, T* c, int n) {\n  return 0;\n}\n',
    "void other(const T* a) {}\n",
    "void E(const T* a, T* c, int n = 4) {}\n",
    "// E is made elsewhere\n",
    "import numpy as np\n\ndef E(a: np.ndarray, c, n: int):\n    return c\n",
    "def E(a: int, c: np.ndarray, m: float):\n    return c\n",
)
_SQL = f"""p AS (SELECT p_partkey AS part, p_partkey % {len(SOURCES)} AS form, 'launch_' || p_partkey AS e, {[s for _, s in TYPES]}[p_size % 4 + 1] AS t, {[s for _, s in OTHERS]}[p_size % 4 + 1] AS o FROM part)"""


def _of_size(values: tuple) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), F.col("p_size") % 4 + 1)


def _source(forms: tuple[str, ...]) -> Column:
    text = F.element_at(F.array(*map(F.lit, forms)), (F.col("p_partkey") % len(forms) + 1).cast("int"))
    for mark, value in ((r"\bE\b", F.concat(F.lit("launch_"), F.col("p_partkey").cast("string"))), (r"\bT\b", _of_size(tuple(n for n, _ in TYPES))), (r"\bO\b", _of_size(tuple(n for n, _ in OTHERS)))):
        text = F.regexp_replace(text, F.lit(mark), value)
    return text


def interfaces(t: Tables) -> DataFrame:
    short, none = _of_size(tuple(s for _, s in TYPES)), F.array().cast("array<string>")
    param = lambda name, kind, dtype, rank: F.struct(F.lit(name).alias("name"), F.lit(kind).alias("kind"), dtype.alias("dtype"), F.lit(rank).alias("rank"), (F.array(F.lit("n")) if rank else none).alias("shape_from"))
    params = F.array(param("a", "input", short, 1), param("c", "output", short, 1), param("n", "size", F.lit("i32"), 0))
    abi = F.struct(F.concat(F.lit("launch_"), F.col("p_partkey").cast("string")).alias("entry"), F.lit("void").alias("returns"), params.alias("params")).cast(ABI)
    return t.part.select(F.col("p_partkey").alias("part"), abi.alias("abi"), _source(SOURCES).alias("source"))


@query(f"""WITH {_SQL} SELECT part, CASE form
  WHEN 1 THEN 'parameter 1 name/order mismatch: source=''out2'' abi=''c''' WHEN 2 THEN 'parameter ''a'' type mismatch: source=' || o || ' abi=' || t
  WHEN 3 THEN 'parameter ''c'' kind mismatch: expected pointer' WHEN 4 THEN 'parameter count mismatch: source=2 abi=3'
  WHEN 5 THEN CASE WHEN t = 'u8' THEN 'parameter 0: unsupported CUDA type ''U''; parameter 1: unsupported CUDA type ''U''' ELSE '' END WHEN 6 THEN 'parameter 0: unsupported CUDA type ''U''; parameter 1: unsupported CUDA type ''U''' WHEN 8 THEN 'return type mismatch: source=i32 abi=void'
  WHEN 9 THEN 'entry ''' || e || ''' not found in source' WHEN 10 THEN 'parameter 2: unsupported CUDA parameter syntax ''int n = 4'''
  WHEN 11 THEN 'unsupported or missing CUDA signature for entry ''' || e || ''''
  WHEN 13 THEN 'parameter ''a'' expected tensor annotation; ' || CASE WHEN t <> 'i32' THEN 'parameter ''a'' type mismatch: source=i32 abi=' || t || '; ' ELSE '' END || 'parameter 2 name/order mismatch: source=''m'' abi=''n''; parameter ''n'' type mismatch: source=f32 abi=i32'
  ELSE '' END AS issues, form IN (0, 7, 12) OR form = 5 AND t <> 'u8' AS agrees FROM p""")
def interface_issues(t: Tables) -> DataFrame:
    """What is wrong with each source under its interface. Templates are instantiated for types of one word only."""
    found = signature_issues(interfaces(t))
    return found.select("part", F.array_join("issues", "; ").alias("issues"), (F.size("issues") == 0).alias("agrees"))


#: Translation units for reading an interface off them.
UNITS = (
    "__global__ void k(const T* a, T* c, int n) {\n}\nvoid E(const T* a, T* c, int n) {\n  k<<<1, n>>>(a, c, n);\n}\nint main() {\n  E(0, 0, 0);\n}\n",
    "__global__ void E(const T* a, T* c) {\n}\n",
    "void E(T* x, T* y, int rows, int cols, T alpha) {\n  k<<<1, rows>>>(y);\n}\nvoid check(T* y, size_t n) {\n}\n",
    "static inline void check(T* y) {\n}\nT E(const T* left, T* hist, long long total) {\n  return 0;\n}\n",
    "// nothing here\n",
    "void E() {\n}\nint main(int argc) {\n}\n",
)


@query(f"""WITH p AS (SELECT p_partkey AS part, p_partkey % {len(UNITS)} AS form, 'launch_' || p_partkey AS e, {[s for _, s in TYPES]}[p_size % 4 + 1] AS t FROM part)
SELECT part, CASE WHEN form IN (0, 2) OR form = 3 AND t <> 'u8' THEN e WHEN form = 3 THEN e END AS entry, CASE form WHEN 0 THEN 'void' WHEN 2 THEN 'void' WHEN 3 THEN CASE WHEN t = 'u8' THEN 'u32' ELSE t END END AS returns,
  CASE form WHEN 0 THEN 'a input ' || t || ' n, c output ' || t || ' n, n size i32 ' WHEN 2 THEN 'x input ' || t || ' rows, y output ' || t || ' rows, rows size i32 , cols size i32 , alpha scalar ' || t || ' '
    WHEN 3 THEN 'left input ' || t || ' , hist output ' || t || ' , total scalar i64 ' END AS params, CASE WHEN form IN (0, 2) THEN FALSE WHEN form = 3 THEN TRUE END AS sort_outputs
FROM p WHERE NOT (form = 3 AND t = 'u8')""")
def interfaces_read(t: Tables) -> DataFrame:
    """The interface that each unit's host function shows. A return type of two words is outside
    the subset and left to the tests."""
    rows = t.part.where((F.col("p_partkey") % len(UNITS) != 3) | (F.col("p_size") % 4 != 3))
    abi = rows.select(F.col("p_partkey").alias("part"), read_interface(_source(UNITS)).alias("abi"))
    shown = F.array_join(F.transform("abi.params", lambda p: F.concat_ws(" ", p["name"], p["kind"], p["dtype"], F.array_join(p["shape_from"], ","))), ", ")
    return abi.select("part", "abi.entry", "abi.returns", shown.alias("params"), "abi.sort_outputs")


_WORDS = ("float", " Double ", "std::size_t", "unsigned int", "long long", "nv_bfloat16", "cufftComplex", "complex64", "nothing", "")
_SHORT = ("f32", "f64", "i64", "u32", "i64", "bf16", "c64", "c64", "f32", "f32")


@query(f"SELECT l_orderkey AS job, l_linenumber AS line, {list(_SHORT)}[(l_orderkey + l_linenumber) % 10 + 1] AS dtype, CASE (l_orderkey + l_linenumber) % 3 WHEN 0 THEN 'cuda' WHEN 1 THEN 'tilelang' END AS dialect FROM lineitem")
def type_names(t: Tables) -> DataFrame:
    """Short names of types, and dialects by their aliases; an unknown dialect has none."""
    n = F.col("l_orderkey") + F.col("l_linenumber")
    word = F.element_at(F.array(*map(F.lit, _WORDS)), (n % 10 + 1).cast("int"))
    alias = F.element_at(F.array(F.lit("CU"), F.lit(" tile_lang"), F.lit("opencl")), (n % 3 + 1).cast("int"))
    return t.lineitem.select(F.col("l_orderkey").alias("job"), F.col("l_linenumber").alias("line"), names.dtype(word).alias("dtype"), names.dialect(alias).alias("dialect"))
