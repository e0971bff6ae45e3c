"""Text functions as column expressions."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ordered families of operations, the first match wins.
FAMILIES = (
    ("gemm", r"\b(gemm|matmul|matrix multiplication|wmma|tensor core)\b"),
    ("reduction", r"\b(reduc|sum|max|min|argmax|argmin|softmax|scan|prefix)"),
    ("transpose", r"\b(transpose|permute|reorder|strided)\b"),
    ("sort", r"\b(sort|top[- ]?k|histogram|set[- ]?union)\b"),
    ("convolution", r"\b(conv|convolution)\b"),
    ("memory", r"\b(memcpy|copy|gather|scatter|broadcast|atomic)\b"),
)
# Ordered topics of knowledge questions, the first match wins.
TOPICS = (
    ("formula", r"\bderive\b|推导|occupancy formula|roofline|arithmetic intensity|公式|量纲|prove that"),
    ("cute", r"cute::|cute layout|layout algebra|\btiler\b|mma atom|copy atom|\bcosize\b|\bshape\b.+\bstride\b"),
    ("cutlass", r"cutlass (?:pipeline|collective|mainloop|epilogue)|collective builder"),
    ("isa", r"\bptx\b|\bsass\b|instruction set"),
    ("api", r"cuda runtime|cuda driver api|stream semantics|cudaMalloc|cuda streams?|cudaEvent|asynchronous execution|kernel launch"),
    ("memory", r"coalesc|bank conflict|shared memory bank|\bl2 cache\b|\btma\b|访存合并|memory hierarchy|local memory|constant memory|unified memory|pinned host|pageable|read-only cach|texture (?:or read-only )?cach|structure of arrays|array of structures|\bAoS\b|\bSoA\b|memory alignment|global memory transactions"),
    ("execution", r"\boccupancy\b|latency hiding|warp scheduler|issue slot|\bSIMT\b|branch divergence|warp execution|threads per block|block dimensions|tiling in CUDA"),
    ("architecture", r"streaming multiprocessor|\bsm architecture\b|tensor core|gpu architecture|\bhopper\b|\bampere\b|\bblackwell\b|warp 调度|threadIdx|blockIdx|gridDim|thread organization|threads, blocks, and grids"),
)
# What marks a kernel task and a knowledge question.
KERNEL = r"solution\.cu|include/solution_header|function signature|your implementation should|\bimplement a\b|\bnvcc\b|__global__|write your implementation|实现一个|编写.{0,12}kernel"
KNOWLEDGE = r"\bexplain\b|\bwhy does\b|\bwhat is\b|\bderive\b|occupancy formula|memory hierarchy|cute layout|roofline|请解释|请推导|为什么|什么是|工作原理|公式推导"
SIMPLE = r"\b(add|scale|relu|copy|fill|axpy|element[- ]?wise|vector add|saxpy)\b"
HARD = r"gemm|matmul|conv(?:olution)?|softmax|attention|scan|reduc(?:e|tion)|transpose|sort|fft|wmma|tensor[ -]?core|cute|cutlass|histogram|prefix|warp.?shuffle"
#: The same words in Chinese.
HARD_ZH = "矩阵乘(?:法|积)?|矩阵相乘|卷积|注意力|扫描|前缀和|归约|规约|转置|排序|快速傅里叶|直方图|线程束洗牌"
SIMPLE_ZH = "向量加(?:法)?|逐元素(?:加法|相加|计算)?|元素级(?:加法|相加|计算)?|(?:逐个|每个)元素(?:相加|加法)|缩放(?:向量)?|填充(?:数组|向量)?|复制(?:数组|向量)?|激活函数"
HARD_TOPICS, SIMPLE_TOPICS = ("formula", "cute", "cutlass", "isa"), ("general", "worked_example")
CANDIDATES, REPAIRS = {"simple": 2, "medium": 3, "hard": 4}, {"simple": 1, "medium": 2, "hard": 3}


def alternatives(pattern: str) -> list[tuple[str, str]]:
    """The alternatives of a pattern, each with the longest plain text that its matches must hold ('' for none)."""
    around = re.fullmatch(r"(\\b)\((.*)\)((?:\\b)?)", pattern)
    before, body, after = around.groups() if around else ("", pattern, "")
    out = []
    for x in re.split(r"\|(?![^(]*\))", body):
        plain = max(re.split(r"\\b|\(\?:.*?\)\??|\[.*?\]\??|\.\{.*?\}|\.\+|\\\.|.\?", x), key=len)
        out.append((plain.lower() if re.fullmatch(r"[^\\()\[\]{}*+?|.^$]+", plain) else "", before + x + after))
    return out


def matches(text: Column, lowered: Column, pattern: str) -> Column:
    """Case-blind match. An alternative's regular expression runs only on texts that hold its plain part, and not
    at all if it is plain as a whole."""

    def one(plain: str, whole: str) -> Column:
        found = text.rlike(f"(?i){whole}")
        return found if not plain else lowered.contains(plain) if plain == whole.lower() else lowered.contains(plain) & found

    return reduce(lambda a, b: a | b, [one(*x) for x in alternatives(pattern)])


def _bound(value: Column, use) -> Column:
    """use(value), with the value computed once however often it is used."""
    return F.transform(F.array(value), use)[0]


def first_match(text: Column, ladder, default: str) -> Column:
    def climb(lowered: Column) -> Column:
        out = F.lit(default)
        for name, pattern in reversed(ladder):
            out = F.when(matches(text, lowered, pattern), name).otherwise(out)
        return out

    return _bound(F.lower(text), climb)


def operation_family(question: Column) -> Column:
    return first_match(question, FAMILIES, "elementwise")


def infer_topic(question: Column) -> Column:
    return first_match(question, TOPICS, "general")


def heuristic_kind(question: Column) -> Column:
    """Kernel wins conflicts and unknowns."""
    return first_match(question, (("kernel", KERNEL), ("knowledge", KNOWLEDGE)), "kernel")


def kernel_difficulty(question: Column) -> Column:
    """Hard words beat simple ones; neither is medium."""
    return _bound(F.coalesce(question, F.lit("")), lambda q: F.when(q.rlike(f"(?i){HARD}|{HARD_ZH}"), "hard").when(q.rlike(f"(?i){SIMPLE}|{SIMPLE_ZH}"), "simple").otherwise("medium"))


def knowledge_difficulty(topic: Column) -> Column:
    name = F.lower(F.trim(F.coalesce(topic, F.lit("general"))))
    return _bound(name, lambda x: F.when(x.isin(*HARD_TOPICS), "hard").when(x.isin(*SIMPLE_TOPICS), "simple").otherwise("medium"))


def budget(difficulty: Column, ladder: dict[str, int], cap: int, least: int) -> Column:
    value = F.lit(ladder["medium"])
    for name, n in ladder.items():
        value = F.when(difficulty == name, n).otherwise(value)
    return F.greatest(F.lit(least), F.least(F.lit(cap), value))


def approx_tokens(text: Column) -> Column:
    """(ascii + 3) // 4 and one for every other character."""
    other = F.length(F.regexp_replace(text, r"[\x00-\x7F]", ""))
    return F.coalesce(F.floor((F.length(text) - other + 3) / 4) + other, F.lit(0)).cast("long")


def bound(value: Column, f) -> Column:
    """f of a value that is computed once."""
    return F.transform(F.array(value), f)[0]


def collapse_blank_lines(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"\n{3,}", "\n\n"), r"(?U)^\s+|\s+$", "")


def strip_thinking(text: Column) -> Column:
    return F.regexp_replace(text, r"(?is)<(?:think|reasoning)>.*?</(?:think|reasoning)>", "")


def extract_thinking(text: Column) -> Column:
    parts = F.regexp_extract_all(text, F.lit(r"(?is)<(?:think|reasoning)>(.*?)</(?:think|reasoning)>"), F.lit(1))
    return F.array_join(F.filter(F.transform(parts, lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", "")), lambda x: x != ""), "\n\n")


def integrity_issues(answer: Column) -> Column:
    """Signs of an unfinished answer."""
    body = F.regexp_replace(F.coalesce(answer, F.lit("")), r"(?U)\s+$", "")
    tail = body.rlike(r"(?:,|:|;|=|->|→|\.\.\.|…)$")
    fence = F.regexp_count(body, F.lit(r"(?m)^[ \t]*```")) % 2 == 1
    equation = (F.regexp_count(body, F.lit(r"\$\$")) % 2 == 1) | (F.regexp_count(body, F.lit(r"\\\[")) != F.regexp_count(body, F.lit(r"\\\]")))
    return F.filter(F.array(F.when(tail, "tail"), F.when(fence, "fence"), F.when(equation, "equation")), lambda x: x.isNotNull())


def question_hash(question: Column) -> Column:
    """sha256 of whitespace-collapsed text; NFC is the caller's (no builtin has it)."""
    return F.sha2(F.regexp_replace(F.regexp_replace(question, r"(?U)\s+", " "), r"^ | $", ""), 256)
