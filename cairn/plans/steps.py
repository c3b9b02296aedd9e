"""Declarative step chains.

A step chain is a list of ``{"step", "params", "input", "output"}``; steps pass
DataFrames by variable name, so the whole chain stays one lazy plan that Catalyst
optimises end to end (no hand-off files between steps).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..operators import columns, filters, flatten, latest, merge, reshape, text
from ..operators.coerce import coerce_schema
from ..sinks import writers
from ..sources import files, pages, tables
from ..streaming import watermark
from .rfm import rfm_analysis

StepFn = Callable[..., object]

STEPS: dict[str, StepFn] = {}


def register_step(name: str, fn: StepFn) -> StepFn:
    STEPS[name] = fn
    return fn


def register_source(name: str, fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A source: ``fn(spark, **params) -> DataFrame``."""
    return register_step(name, lambda spark, _inputs, **p: fn(spark, **p))


def register_sink(name: str, fn: Callable[..., None]) -> Callable[..., None]:
    """A sink: ``fn(df, **params) -> None`` (D3)."""
    return register_step(name, lambda spark, inputs, **p: fn(inputs[0], **p))


def register_transform(name: str, fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A transformation: ``fn(df, **params) -> DataFrame``."""
    return register_step(name, lambda spark, inputs, **p: fn(inputs[0], **p))


def apply_transformation(
    df: DataFrame, fn: Callable, schema: StructType | str
) -> DataFrame:
    """User code over batches of rows (D2): ``fn(pandas.DataFrame) -> pandas.DataFrame``
    applied per Arrow batch with ``mapInPandas``; may change the row count."""

    def run(batches):
        for pdf in batches:
            yield fn(pdf)

    return df.mapInPandas(run, schema)


def run_steps(
    spark: SparkSession,
    steps: Sequence[Mapping],
    inputs: Mapping[str, DataFrame] | None = None,
) -> dict[str, object]:
    """Run the steps in order; returns every named output."""
    env: dict[str, object] = dict(inputs or {})
    for i, s in enumerate(steps):
        name = s["step"]
        if name not in STEPS:
            raise KeyError(f"step {i}: unknown step {name!r}")
        ins = s.get("input")
        ins = [] if ins is None else [ins] if isinstance(ins, str) else list(ins)
        missing = [v for v in ins if v not in env]
        if missing:
            raise KeyError(f"step {i} ({name}): inputs not defined: {missing}")
        out = STEPS[name](spark, [env[v] for v in ins], **dict(s.get("params", {})))
        if s.get("output"):
            env[s["output"]] = out
    return env


def run_steps_file(spark: SparkSession, path: str) -> dict[str, object]:
    """Run a step chain stored as JSON: ``[{"step", "params", "input", "output"}]``."""
    import json

    with open(path, encoding="utf-8") as fh:
        steps = json.load(fh)
    if not isinstance(steps, list):
        raise ValueError("a step chain file holds a JSON list of steps")
    return run_steps(spark, steps)


def _extract(spark, state_path, **params):
    from ..streaming.watermark import WatermarkStore
    from .extraction import extract_increment

    return extract_increment(spark, state=WatermarkStore(spark, state_path), **params)


def _union_view(spark, **params):
    from .standardization import standardized_union_view

    return standardized_union_view(spark, **params)


# Built-in steps: sources
for _name, _fn in {
    "read_table": tables.read_table,
    "read_sql": tables.read_sql,
    "read_file": files.read_file,
    "read_objects": files.read_objects,
    "read_folder": files.read_folder,
    "read_pages": pages.read_pages,
    "read_listing": pages.read_listing,
    "load_file_to_table": writers.load_file_to_table,
    "extract_increment": _extract,
    "standardized_union_view": _union_view,
}.items():
    register_source(_name, _fn)
# transformations
register_transform("remove_columns", columns.remove_columns)
register_transform("drop_by_prefix", columns.drop_by_prefix)
register_transform("strip_prefixes", columns.strip_prefixes)
register_transform("rename_columns", columns.rename_columns)
register_transform("prepare_columns", columns.prepare_columns)
register_transform("text_transform", columns.text_transform)
register_transform("clean_strings", columns.clean_strings)
register_transform("flatten_columns", flatten.flatten_columns)
register_transform("unpivot_columns", reshape.unpivot_columns)
register_transform("standardize", reshape.standardize)
register_transform("filter_by_params", filters.filter_by_params)
register_transform("exclude_by_params", filters.exclude_by_params)
register_transform("latest_per_key", latest.latest_per_key)
register_transform("coerce_schema", coerce_schema)
register_transform("extract_text", text.extract_text)
register_transform("objects_to_rows", files.objects_to_rows)
register_transform("apply_transformation", apply_transformation)
register_transform("incremental_filter", watermark.incremental_filter)
register_transform("next_watermark", watermark.next_watermark)
register_transform("lookup_one", filters.lookup_one)
register_transform("rfm_analysis", rfm_analysis)
register_step(
    "concat_by_name", lambda spark, inputs: reshape.concat_by_name(inputs)
)
register_step(
    "union_all", lambda spark, inputs, by_name=False: reshape.union_all(inputs, by_name)
)
register_step(
    "merge_upsert",
    lambda spark, inputs, source=None, **p: merge.merge_upsert(
        inputs[0], inputs[1] if len(inputs) > 1 else source, **p
    ),
)
# sinks; write_objects gives the result of each object as its output
register_sink("save_table", writers.save_table)
register_sink("write_by_date", writers.write_by_date)
register_sink("create_view", writers.create_view)
register_sink("write_objects", writers.write_objects)
