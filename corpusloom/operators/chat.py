"""Chat examples from source files: building, checking, grouping."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import pycode
from corpusloom.functions.names import resolved_path
from corpusloom.workspace import spread

# The policy that every example begins with, in our own words for the same contract.
SYSTEM_POLICY = (
    "You write clean, runnable PyTorch vision models. Answer with one fenced Python block that defines exactly one nn.Module, and no other text. "
    "Use torch, torch.nn and torch.nn.functional only; no pretrained models, files, network or printing. "
    "Keep to the stated limits and the channels-first input shape. Training tricks belong to the trainer, not to the module."
)
# Image classification sets and their shapes; those of at most 32 pixels serve small families.
DATASETS = (("MNIST", "1x28x28"), ("CIFAR-10", "3x32x32"), ("CIFAR-100", "3x32x32"), ("SVHN", "3x32x32"), ("Imagenette", "3x224x224"), ("Places365", "3x256x256"), ("CelebA-Gender", "3x224x224"))
SMALL_SHAPES = ("1x28x28", "3x32x32")
SMALL_FAMILIES = ("mobile", "vgg")
TRICKS = ("label_smoothing", "cosine_lr", "mixup<=0.2", "cutmix<=0.2", "ema", "grad_clip<=3.0", "warmup<=500_iters", "dropout<=0.5", "stochastic_depth<=0.2")
PARAMETER_BUCKETS = (100_000, 300_000, 800_000, 1_500_000, 3_000_000, 6_000_000, 12_000_000, 25_000_000, 50_000_000)
ROLES = ("system", "user", "assistant")
#: How a message is rendered: its role, then its content.
TEMPLATE = "<|%s|>\n%s\n"

META = "source_path string, group_key string, has_module boolean, family string, param_estimate bigint, class_names array<string>, calls array<string>, type string"
ROW = f"id string, messages array<struct<role string, content string>>, meta struct<{META}>"


def parameter_cap(estimate: Column) -> Column:
    """The least bucket that holds 1.3 times the estimate (at least 50,000), or the largest."""
    need = F.floor(F.greatest(F.coalesce(estimate, F.lit(50_000)), F.lit(50_000)) * 1.3)
    buckets = F.array(*map(F.lit, PARAMETER_BUCKETS))
    return F.coalesce(F.try_element_at(F.filter(buckets, lambda b: b >= need), F.lit(1)), F.lit(PARAMETER_BUCKETS[-1])).cast("long")


def _pick(pool: tuple, *key: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in pool]), (F.pmod(F.xxhash64(*key), F.lit(len(pool))) + 1).cast("int"))


def prompt(family: Column, estimate: Column, key: Column, seed: int) -> Column:
    """The task text: a set that suits the family, a limit and three tricks, all drawn by a hash of the key."""
    shown = tuple(f"{n} ({s}" for n, s in DATASETS)
    small = tuple(f"{n} ({s}" for n, s in DATASETS if s in SMALL_SHAPES)
    data = F.when(family.isin(*SMALL_FAMILIES), _pick(small, F.lit(seed), key)).otherwise(_pick(shown, F.lit(seed), key))
    drawn = F.array_sort(F.slice(F.transform(F.array_sort(F.transform(F.array(*map(F.lit, TRICKS)), lambda t: F.struct(F.xxhash64(F.lit(seed), key, t).alias("h"), t.alias("t")))), lambda x: x["t"]), 1, 3))
    return F.concat(
        F.lit("Write a PyTorch network that classifies images.\nData: "), data, F.lit(", channels first).\nIt may have up to "), parameter_cap(estimate).cast("string"),
        F.lit(" parameters and must answer quickly on small devices.\nBuild it from standard layers, without pretrained weights.\nThe trainer may use: "), F.array_join(drawn, ", "),
        F.lit(".\nAnswer with a single Python block that defines the whole nn.Module, for example class Net(nn.Module)."),
    )


def summaries(files: DataFrame) -> DataFrame:
    """Adds to ``(path, text)`` what the parser finds (null for unreadable code) and the masked variant."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("has_module", pa.bool_()), ("family", pa.string()), ("param_estimate", pa.int64()), ("class_names", pa.list_(pa.string())), ("calls", pa.list_(pa.string()))])
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found = [pycode.summary(t) for t in texts]
            masked = [pycode.masked_forward(t) if f and f["has_module"] else None for t, f in zip(texts, found)]
            keys = [os.path.abspath(p) for p in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys), pa.array(found, kind), pa.array(masked, pa.string())], names=["path", "text", "group_key", "s", "masked"])

    return spread(files.select("path", "text")).mapInArrow(look, "path string, text string, group_key string, s struct<has_module boolean, family string, param_estimate bigint, class_names array<string>, calls array<string>>, masked string")


def build_examples(files: DataFrame, infill: bool = True, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """``(examples, unreadable)``: one full example for each file with a module class, and one with its forward masked.

    Ids are hashes of path, type and seed, so a run can be repeated. Unreadable files are returned with their reason.
    """
    seen = summaries(files)
    message = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))

    def example(kind: str, user: Column, answer: Column) -> Column:
        key = F.sha2(F.concat_ws("\u0001", "group_key", F.lit(kind), F.lit(str(seed))), 256)
        fields = [F.col("path").alias("source_path"), F.col("group_key"), *[F.col(f"s.{c}").alias(c) for c in ("has_module", "family", "param_estimate", "class_names", "calls")], F.lit(kind).alias("type")]
        return F.struct(key.alias("id"), F.array(message("system", F.lit(SYSTEM_POLICY)), message("user", user), message("assistant", answer)).alias("messages"), F.struct(*fields).alias("meta"))

    task = prompt(F.col("s.family"), F.col("s.param_estimate"), F.col("group_key"), seed)
    fenced = F.concat(F.lit("```python\n"), F.regexp_replace("text", r"^\s+|\s+$", ""), F.lit("\n```"))
    both = [example("full", task, fenced)] + ([F.when(F.col("masked").isNotNull(), example("infill", F.col("masked"), F.col("text")))] if infill else [])
    rows = seen.filter("s.has_module").select(F.explode(F.array_compact(F.array(*both))).alias("e")).select("e.*")
    return rows, seen.filter("s is null").select("path", F.lit("parse_fail").alias("reason"))


def checked(rows: DataFrame, fix_fences: bool = True, require_parse: bool = True, require_module: bool = True) -> DataFrame:
    """Adds ``drop_reason`` (null for what passes) and puts the answer into one block.

    The first reason of: bad_schema_len, bad_roles, no_code_fence, parse_fail, no_nn_module. Null messages count as none.
    """

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            answers, reasons = [], []
            for answer in batch.column(1).to_pylist():
                reason = None
                if answer is not None:
                    answer = pycode.one_block(answer) if fix_fences else answer
                    code = pycode.fenced_code(answer)
                    if code is None:
                        reason = "no_code_fence"
                    elif require_parse and pycode._tree(code) is None:
                        reason = "parse_fail"
                    elif require_module and not pycode.has_module_class(code):
                        reason = "no_nn_module"
                answers.append(answer)
                reasons.append(reason)
            rest = [batch.column(i) for i in range(2, batch.num_columns)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(answers, pa.string()), *rest, pa.array(reasons, pa.string())], names=["id", "_answer", *rest_names, "_found"])

    rest_names = ["messages", "meta", "_shape"]
    shape = schema_reason(F.col("messages"))
    answer = F.when(shape.isNull(), F.coalesce(F.col("messages")[2]["content"], F.lit("")))
    ready = rows.select("id", answer.alias("_answer"), "messages", "meta", shape.alias("_shape"))
    kinds = {f.name: f.dataType.simpleString() for f in ready.schema}
    done = spread(ready).mapInArrow(check, f"id {kinds['id']}, _answer string, messages {kinds['messages']}, meta {kinds['meta']}, _shape string, _found string")
    replaced = F.transform("messages", lambda m, i: F.struct(m["role"].alias("role"), F.when((i == 2) & F.col("_answer").isNotNull(), F.col("_answer")).otherwise(m["content"]).alias("content")))
    return done.select("id", replaced.alias("messages"), "meta", F.coalesce("_shape", "_found").alias("drop_reason"))


def schema_reason(messages: Column) -> Column:
    roles = F.transform(messages, lambda m: m["role"])
    return F.when(F.coalesce(F.size(messages), F.lit(0)) != 3, "bad_schema_len").when(~F.coalesce(roles == F.array(*map(F.lit, ROLES)), F.lit(False)), "bad_roles")


def group_key(meta: Column, id_: Column, base: str = "/data") -> Column:
    """The row's group as it is written, else its resolved source (so two spellings of one path are one group), else one of its own."""
    said = F.when(F.trim(meta["group_key"]) != "", meta["group_key"])
    return F.coalesce(said, resolved_path(meta["source_path"], base), F.concat(F.lit("NA::"), id_))


def fixed_answers(rows: DataFrame) -> DataFrame:
    """``(id, messages)`` with every assistant message reduced to its first block, unparsed; the light validator for rows of any shape."""

    def fix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [None if ms is None else [m and {**m, "content": pycode.first_block(m["content"] or "") if m["role"] == "assistant" else m["content"]} for m in ms] for ms in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(done, pa.list_(pa.struct([("role", pa.string()), ("content", pa.string())])))], names=["id", "messages"])

    return spread(rows.select("id", "messages")).mapInArrow(fix, "id string, messages array<struct<role string, content string>>")


def rendered(rows: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """``(id, prompt, assistant, meta)``: all but the last message by a local template; no foreign code is loaded."""
    shown = F.transform(F.slice("messages", F.lit(1), F.greatest(F.size("messages") - 1, F.lit(0))), lambda m: F.format_string(template, F.coalesce(m["role"], F.lit("")), F.coalesce(m["content"], F.lit(""))))
    return rows.select("id", F.concat(F.array_join(shown, ""), F.lit("<|assistant|>\n")).alias("prompt"), F.try_element_at("messages", F.lit(-1))["content"].alias("assistant"), "meta")
