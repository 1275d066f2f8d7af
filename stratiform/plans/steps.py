"""Declared pipelines: a list of steps, each a name and its settings, as one chain of DataFrame transformations.

Nothing runs until the result is used, so Catalyst sees the whole chain: filters move down to the scan and unused columns go.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.functions import clock, rules, text, vectors
from stratiform.operators import context, curation, imaging, ordering, phases, rollup, tables
from stratiform.sources import tables as sources
from stratiform.sources.publish import published, resolved

Step = Callable[[DataFrame, Mapping], DataFrame]


def _date(df: DataFrame, s: Mapping) -> DataFrame:
    found = {c: F.col(c) for c in s["candidates"] if c in df.columns}
    if not found:
        return df
    value, source = clock.first_of(found, clock.date)
    return df.withColumns({"date": value, "date_source": source})


def _time(df: DataFrame, s: Mapping) -> DataFrame:
    found = {c: F.col(c) for c in s["candidates"] if c in df.columns}
    if not found:
        return df
    value, source = clock.first_of(found, clock.clock)
    return df.withColumns({"time": value, "time_source": source})


def _exclude_text(df: DataFrame, s: Mapping) -> DataFrame:
    if s["column"] not in df.columns:
        return df
    pattern = "|".join(s["words"])
    return df.filter(~F.coalesce(text.uniform(F.col(s["column"])).rlike(pattern), F.lit(False)))


def _axis(df: DataFrame, s: Mapping) -> DataFrame:
    if s["column"] not in df.columns:
        return df
    p = vectors.plane(F.col(s["column"]), s.get("threshold", 10.0))
    df = df.withColumns({"plane": p["plane"], "angle": p["angle"], "axis": p["axis"]})
    return df.filter(F.col("axis") == s["keep"]) if s.get("keep") else df


def _hook(df: DataFrame, s: Mapping) -> DataFrame:
    """A function of Columns to one Column or, by name, several."""
    out = s["function"](*(F.col(c) for c in s["inputs"]))
    return tables.derive(df, {s["outputs"][0]: out} if isinstance(out, Column) else {n: out[n] for n in s["outputs"]}, s.get("mode", "overwrite"))


def _spacing(df: DataFrame, s: Mapping) -> DataFrame:
    return df.withColumn("PixelSpacingXY", vectors.part(vectors.parsed(F.col(s["column"])), 1)) if s["column"] in df.columns else df


def _columns(df: DataFrame, s: Mapping, change: Callable[[Column], Column], to: str = "{}") -> DataFrame:
    """A change of those of the columns that are there."""
    return df.withColumns({to.format(c): change(F.col(f"`{c}`")) for c in s["columns"] if c in df.columns})


def _curated(df: DataFrame, s: Mapping) -> DataFrame:
    return context.curate(df, s["exam"], s["volume"], s["config"], s.get("texts", curation.TEXT_COLUMNS))["curated"]


def _finalize(df: DataFrame, s: Mapping) -> DataFrame:
    df = tables.in_order(rollup.drop_all_null(df, s.get("protect", ())), s.get("first", ()))
    return ordering.final_order(df, *s["order"]) if s.get("order") else df


STEPS: dict[str, tuple[Step, tuple[str, ...]]] = {
    "filter": (lambda df, s: rules.filtered(df, [s], s.get("on_missing", "skip")), ("kind", "rules")),
    "add_date": (_date, ("candidates",)),
    "add_time": (_time, ("candidates",)),
    "exclude_text": (_exclude_text, ("column", "words")),
    "acquisition_axis": (_axis, ("column",)),
    "pixel_spacing": (_spacing, ("column",)),
    "hook": (_hook, ("function", "inputs", "outputs")),
    "volume_id": (lambda df, s: df.withColumn(s.get("name", "volume_id"), rollup.stable_id([c for c in s["columns"] if c in df.columns])), ("columns",)),
    "split_stacks": (lambda df, s: rollup.split_stacks(df, s["keys"], s["slice_key"], s["order"], s["volume"], s.get("min_slices", 8), s.get("min_fraction", 0.7)), ("keys", "slice_key", "order", "volume")),
    "merge_fragments": (lambda df, s: rollup.merge_fragments(df, s["group"], s["volume"], s["z"], s.get("tolerance", 1e-3)), ("group", "volume", "z")),
    "group_volumes": (lambda df, s: rollup.volumes(df, s["key"], s["columns"], s.get("earliest")), ("key", "columns")),
    "visit_order": (lambda df, s: ordering.visit_order(df, s["patient"], s["study"], s["date"]), ("patient", "study", "date")),
    "acquisition_order": (lambda df, s: ordering.acquisition_order(df, s["study"], s["volume"], s["stamp"], s["numbers"], s["tie"]), ("study", "volume", "stamp", "numbers", "tie")),
    "expand_list": (lambda df, s: tables.expanded(df, s["column"], s["size"]), ("column", "size")),
    "phase": (lambda df, s: phases.resolve(df, s["config"]), ("config",)),
    "row_expression": (lambda df, s: df.filter(F.expr(s["expression"])), ("expression",)),
    "select": (lambda df, s: df.select(*(f"`{c}`" for c in s["columns"] if c in df.columns)), ("columns",)),
    "sop_class": (lambda df, s: imaging.supported(df, s["modality"], s["storage"], s["modalities"], s["classes"]), ("modality", "storage", "modalities", "classes")),
    "parse_image_type": (lambda df, s: _columns(df, s, lambda c: text.image_type_tokens(c.cast("string")), "{}_tokens"), ("columns",)),
    "normalize_string": (lambda df, s: _columns(df, s, text.uniform), ("columns",)),
    "standardize_iop": (lambda df, s: _columns(df, s, lambda c: vectors.standardised(vectors.parsed(c))), ("columns",)),
    "compute_volume_length": (lambda df, s: df.withColumn(s.get("name", "volume_length"), rollup.volume_length(*(F.col(s[k]) for k in ("count", "thickness", "spacing")))), ("count", "thickness", "spacing")),
    "modality_curation": (_curated, ("exam", "volume", "config")),
    "finalize": (_finalize, ()),
}


def validated(steps: Sequence[Mapping]) -> list[Mapping]:
    for i, s in enumerate(steps):
        if s.get("type") not in STEPS:
            raise ValueError(f"step {i}: unknown type {s.get('type')!r}")
        absent = [k for k in STEPS[s["type"]][1] if k not in s]
        if absent:
            raise ValueError(f"step {i} ({s['type']}) needs {absent}")
        if s["type"] == "filter":
            rules.validated(s, f"step {i}")
            if s["kind"] not in ("keep", "discard"):
                raise ValueError(f"step {i}: kind must be 'keep' or 'discard'")
    return list(steps)


@dataclass(frozen=True)
class Need:
    """What a step reads (it fails without), reads if it is there, and makes; `only`: what is left after it, if not all."""

    reads: tuple[str, ...]
    optional: tuple[str, ...] = ()
    makes: tuple[str, ...] = ()
    only: tuple[str, ...] | None = None


def names_in(expression: str) -> list[str]:
    """The columns that an SQL expression names, by Spark's own parser: fields of a column count as the column."""
    spark = SparkSession.active()
    found: dict[str, None] = {}

    def visit(node, bound: frozenset[str]) -> None:  # noqa: ANN001  a JVM expression
        kind = node.getClass().getSimpleName()
        if kind in ("UnresolvedAttribute", "UnresolvedNamedLambdaVariable") and (name := node.nameParts().head()) not in bound:
            found[name] = None
        parts = node.children()
        if kind == "LambdaFunction":
            arguments = node.arguments()
            visit(node.function(), bound | {arguments.apply(i).nameParts().head() for i in range(arguments.size())})
        else:
            for i in range(parts.size()):
                visit(parts.apply(i), bound)

    visit(spark._jsparkSession.sessionState().sqlParser().parseExpression(expression), frozenset())
    return list(found)


def _rules_of(groups: Sequence[Mapping]) -> list[str]:
    return [r["column"] for g in groups for r in g.get("rules", ())]


def _chain(config: Mapping) -> tuple[list[str], list[str]]:
    """What a chain of phase strategies reads, and what it reads if it is there."""
    reads, optional = [], ["phase_applicability_reason", "Modality"]
    for s in config.get("strategies", ()):
        reads += _rules_of(s.get("assignments", ()))
        optional += [*s.get("columns", ()), *([s["column"]] if s.get("column") else []), *s.get("confidence_columns", ())]
        optional += ["rule_phase", "rule_phase_confidence", "rule_phase_reason"] if s.get("type") == "rules" else []
    return reads, optional


_PHASE = ("phase", "phase_status", "phase_source", "phase_strategy", "phase_confidence", "phase_reason")
_VOLUME = ("Modality", "ImageType", "Rows", "Columns", "n_files", "n_rows_in_volume", "SliceThickness", "PixelSpacing", "RepetitionTime", "EchoTime", "ContrastBolusAgentPhase", "acquisition_id", "acquisition_order", "time_seconds", "time", "elapsed")


def need_of(s: Mapping) -> Need:
    """The columns of one step, from its settings."""
    kind, get = s["type"], lambda *keys: tuple(c for k in keys for c in ([s[k]] if isinstance(s.get(k), str) else s.get(k) or ()) if isinstance(c, str))
    if kind == "filter":
        rules_ = tuple(_rules_of([s]))
        return Need(rules_ if s.get("on_missing") == "raise" else (), () if s.get("on_missing") == "raise" else rules_)
    if kind in ("add_date", "add_time"):
        name = kind.removeprefix("add_")
        return Need((), get("candidates"), (name, f"{name}_source"))
    if kind in ("exclude_text", "acquisition_axis", "pixel_spacing"):
        return Need((), get("column"), {"acquisition_axis": ("plane", "angle", "axis"), "pixel_spacing": ("PixelSpacingXY",)}.get(kind, ()))
    if kind == "hook":
        return Need(get("inputs"), (), get("outputs"))
    if kind in ("volume_id", "parse_image_type", "normalize_string", "standardize_iop"):
        made = (s.get("name", "volume_id"),) if kind == "volume_id" else tuple(f"{c}_tokens" for c in get("columns")) if kind == "parse_image_type" else ()
        return Need((), get("columns"), made)
    if kind == "row_expression":
        return Need(tuple(names_in(s["expression"])))
    if kind == "select":
        return Need((), get("columns"), (), get("columns"))
    if kind == "group_volumes":
        earliest = s.get("earliest") or {}
        return Need((*get("key", "columns"), *earliest, *earliest.values()), (), ("n_files", *(f"{c}_one" for c in get("columns"))))
    if kind in ("phase", "modality_curation"):
        reads, optional = _chain(s["config"])
        if kind == "phase":
            return Need(tuple(reads), tuple(optional), _PHASE)
        made = (*_PHASE, "rule_phase", "selection_slot", "selection_score", "protocol", "component")
        return Need((*get("exam", "volume"), *(c for c in reads if c not in made)), (*s.get("texts", curation.TEXT_COLUMNS), *optional, *_VOLUME), made)
    if kind == "finalize":
        return Need((), (*get("first"), *get("protect"), *get("order")))
    if kind == "expand_list":
        return Need(get("column"), (), tuple(f"{s['column']}_value_{i}" for i in range(1, s["size"] + 1)))
    made = {
        "compute_volume_length": (s.get("name", "volume_length"),), "visit_order": ("visit_order", "delay_since_prev_exam", "delay_since_first_exam"), "split_stacks": ("n_detected",),
        "acquisition_order": ("acquisition_order", "delay_since_prev_volume", "delay_since_first_volume"),
    }
    keys = ("keys", "slice_key", "order", "volume", "group", "z", "patient", "study", "date", "stamp", "numbers", "tie", "modality", "storage", "count", "thickness", "spacing")
    return Need(get(*keys), (), made.get(kind, ()))


def inputs_of(steps: Sequence[Mapping]) -> list[str]:
    """Columns that the steps read, or may read, and no earlier step makes."""
    made, needed = set(), []
    for need in map(need_of, steps):
        needed += [n for n in dict.fromkeys((*need.reads, *need.optional)) if n not in made and n not in needed]
        made |= set(need.makes)
    return needed


def missing(steps: Sequence[Mapping], columns: Sequence[str]) -> list[tuple[int, str, str]]:
    """(step, its type, column) for each column that a step reads though neither the table has it nor an earlier step makes it, or one has dropped it."""
    there, found = set(columns), []
    for i, s in enumerate(steps):
        need = need_of(s)
        found += [(i, s["type"], c) for c in need.reads if c not in there]
        there |= set(need.makes)
        there = there & set(need.only) if need.only is not None else there
    return found


def dependencies(steps: Sequence[Mapping]) -> list[tuple[int, int, str]]:
    """(step, earlier step, column): which step reads what of which; -1 stands for the files."""
    maker: dict[str, int] = {}
    edges = []
    for i, s in enumerate(steps):
        need = need_of(s)
        edges += [(i, maker.get(c, -1), c) for c in dict.fromkeys((*need.reads, *(c for c in need.optional if c in maker)))]
        maker |= dict.fromkeys(need.makes, i)
    return edges


def checked(steps: Sequence[Mapping], columns: Sequence[str]) -> None:
    """An error that names every step and column that is missing, before any data is read."""
    absent = missing(validated(steps), columns)
    if absent:
        raise ValueError("; ".join(f"step {i} ({kind}) needs the column {c!r}" for i, kind, c in absent))


def run(df: DataFrame, steps: Sequence[Mapping]) -> DataFrame:
    for s in validated(steps):
        df = STEPS[s["type"]][0](df, s)
    return df


def clean(spark: SparkSession, paths: Sequence[str], steps: Sequence[Mapping], out: str, columns: Sequence[str] = (), kind: str = "parquet") -> DataFrame:
    """End to end: steps, and by the files' headers their columns, are checked before anything is read, the files united, the steps run, the columns (all, if none are named) saved as a whole, and read again."""
    validated(steps)
    checked(steps, sorted({c for path in paths for c in sources.header_of(spark, resolved(spark, path))}))
    df = run(sources.read_all(spark, paths, inputs_of(steps)), steps)
    sources.save(df.select(*(f"`{c}`" for c in columns if c in df.columns)) if columns else df, out, kind)
    return published(spark, out)
