"""Interfaces against sources, and read off sources: hand-worked cases."""

import pytest
from pyspark.sql import functions as F

from curatrix.operators.signatures import ABI, read_interface, signature_issues

ADD = """
#include <cuda_runtime.h>
__global__ void add_kernel(const float* a, const float* b, float* c, int n) {
  int i = blockIdx.x * blockDim.x + threadIdx.x;
  if (i < n) c[i] = a[i] + b[i];
}
void launch_add(const float* a, const float* b, float* c, int n) {
  int t = 256;
  int g = (n + t - 1) / t;
  if (n > 0) add_kernel<<<g, t>>>(a, b, c, n);
}
"""


def param(text):
    name, kind, dtype = text.split()
    return {"name": name, "kind": kind, "dtype": dtype, "rank": int(kind not in ("scalar", "size")), "shape_from": []}


def abi(entry, *params, returns="void"):
    return {"entry": entry, "returns": returns, "params": [param(p) for p in params]}


VECTOR = ("a input f32", "b input f32", "c output f32", "n size i32")
SCALE = ("A input f32", "C output f32", "alpha scalar f32", "M size i32")
TEMPLATE = """
template <typename T>
void scale(const T* A, T* C, T alpha, int M) {}
"""

CASES = [
    ("equal", abi("launch_add", *VECTOR), ADD, []),
    ("not there", abi("launch_add", *VECTOR), "__global__ void other() {}", ["entry 'launch_add' not found in source"]),
    ("count and type", abi("launch_add", *VECTOR), ADD.replace("const float* b", "double* b").replace(", int n)", ")"), ["parameter count mismatch: source=3 abi=4", "parameter 'b' type mismatch: source=f64 abi=f32"]),
    ("name", abi("launch_add", *VECTOR), ADD.replace("float* c, int n) {\n  int t", "float* out, int n) {\n  int t"), ["parameter 2 name/order mismatch: source='out' abi='c'"]),
    ("kind", abi("f", "n output i32"), "void f(int n) {}", ["parameter 'n' kind mismatch: expected pointer"]),
    ("returns", abi("f", "x output f32"), "int f(float *x);", ["return type mismatch: source=i32 abi=void"]),
    ("odd return", abi("f", "x output f32"), "thing f(float *x);", ["unsupported CUDA return type 'thing'"]),
    ("syntax", abi("f", "x output f32", "n size i32"), "void f(float *x, int n = 4) {}", ["parameter 1: unsupported CUDA parameter syntax 'int n = 4'"]),
    ("type", abi("f", "x output f32"), "void f(wide_t *x) {}", ["parameter 0: unsupported CUDA type 'wide_t'"]),
    ("no signature", abi("f", "x output f32"), "// calls f\n", ["unsupported or missing CUDA signature for entry 'f'"]),
    ("several words", abi("f", "x output u16", "k scalar i64", "h scalar cublas_handle"), 'extern "C" static void f(unsigned short int * __restrict__ x, const long long k, cublasHandle_t h);', []),
    ("void alone", abi("f", returns="f32"), "float f(void) {}", ["no parameters"]),
    ("template", abi("scale", *SCALE), TEMPLATE, ["parameter 0: unsupported CUDA type 'T'", "parameter 1: unsupported CUDA type 'T'", "parameter 2: unsupported CUDA type 'T'"]),
    ("instantiated", abi("scale", *SCALE), TEMPLATE + "template void scale<double>(const double*, double*, double, int);\ntemplate void scale<float>(const float*, float*, float, int);\n", []),
    ("for another type", abi("scale", *SCALE), TEMPLATE + "template void scale<double>(const double*, double*, double, int);\n", ["parameter 0: unsupported CUDA type 'T'", "parameter 1: unsupported CUDA type 'T'", "parameter 2: unsupported CUDA type 'T'"]),
    ("overload", abi("scale", *SCALE), TEMPLATE + "void scale(const float* A, float* C, float alpha, int M) {}\n", []),
    ("python", abi("launch", "x input f32", "n size i32"), "def launch(x: torch.Tensor, n: int):\n    return x\n", ["no output"]),
    ("python forms", abi("launch", "x input f32", "n size i32", "o output f32"), "def launch(x: list[float], n: float, out: int) -> dict[str, int]:\n    pass\n", ["unsupported Python annotation for parameter 'x'", "parameter 'n' type mismatch: source=f32 abi=i32", "parameter 2 name/order mismatch: source='out' abi='o'", "parameter 'o' expected tensor annotation", "parameter 'o' type mismatch: source=i32 abi=f32", "unsupported Python return annotation"]),
    ("python stars", abi("launch", "x output f32"), "async def launch(*x): pass\n", ["unsupported Python signature: varargs/keyword-only/positional-only parameters"]),
    ("python nested", abi("launch", "x output f32"), "class A:\n    def launch(x): pass\n", ["missing Python function 'launch'"]),
    ("no entry", abi("", "x output f32"), "void f() {}", ["empty entry name", "entry"]),
    ("no source", abi("f", "x output f32"), None, ["entry 'f' not found in source"]),
]


def test_issues(spark):
    rows = spark.createDataFrame([(name, a, s) for name, a, s, _ in CASES], f"name string, abi {ABI}, source string")
    got = {r["name"]: r["issues"] for r in signature_issues(rows).collect()}
    for name, _, _, want in CASES:
        assert got[name] == want, name
    broken = spark.createDataFrame([("b", abi("launch", "x output f32"), "def launch(x:\n")], f"name string, abi {ABI}, source string")
    assert signature_issues(broken).first()["issues"][0].startswith("Python syntax error: ")


READ = [
    (ADD, ("launch_add", "void", [("a", "input", "f32"), ("b", "input", "f32"), ("c", "output", "f32"), ("n", "size", "i32")])),
    ("void row_sum(const unsigned short* A, unsigned short* sums, int rows, int cols) {\n  k<<<rows, 32>>>(A, sums, cols);\n}\n", ("row_sum", "void", [("A", "input", "u16"), ("sums", "output", "u16"), ("rows", "size", "i32"), ("cols", "size", "i32")])),
    ("int main(int argc) {}\nfloat dot(float* x, float *src, const __half *h, float alpha, size_t total) {\n  return 0;\n}\n", ("dot", "f32", [("x", "input", "f32"), ("src", "output", "f32"), ("h", "input", "f16"), ("alpha", "scalar", "f32"), ("total", "scalar", "i64")])),
    ("void first(float* y, int n) {\n  k<<<1, 1>>>(y);\n}\nvoid second(float* y, int n) {\n}\n", ("first", "void", [("y", "output", "f32"), ("n", "size", "i32")])),
    ("void first(float* y, int n) {\n}\nvoid second(float* y, int n) {\n}\n", ("second", "void", [("y", "output", "f32"), ("n", "size", "i32")])),
    ("__global__ void k(float* x) {\n}\n", None), ("void f() {\n}\n", None), ("", None), (None, None),
]


@pytest.mark.parametrize("at", range(len(READ)))
def test_interfaces_read_off_sources(spark, at):
    source, want = READ[at]
    got = spark.createDataFrame([(source,)], "source string").select(read_interface(F.col("source")).alias("abi")).first()["abi"]
    if want is None:
        assert got is None
        return
    assert (got["entry"], got["returns"], [(p["name"], p["kind"], p["dtype"]) for p in got["params"]]) == want
    sizes = [p["name"] for p in got["params"] if p["kind"] == "size"][:1]
    assert all(p["shape_from"] == (sizes if p["rank"] else []) for p in got["params"])
