"""Filters, projections and reports for tables of imaging series and volumes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratiform.functions import clock
from stratiform.functions import text as T
from stratiform.functions.rules import blank, number
from stratiform.functions.vectors import parsed, part, plane
from stratiform.operators import voxels as X
from stratiform.operators.phases import phase_evidence
from stratiform.operators.tables import ensure_columns

#: Fixed: words that mark series of other body parts.
OTHER_ORGANS = ("pelvis", "crane", "rachis", "prostate", "phlebo", "meckel", "femur", "orl")

# ---------------------------------------------------------------- filters


def supported(df: DataFrame, modality: str, storage: str, modalities: Sequence[str], classes: Sequence[str]) -> DataFrame:
    return df.filter(T.modality(F.col(modality)).isin(*modalities) & F.coalesce(F.col(storage).isin(*classes), F.lit(True)))


def without_listed(df: DataFrame, cells: str, codes: Sequence[str]) -> DataFrame:
    """Rows whose list (or text of a list) names none of the codes; null stays."""
    return df.filter(~F.coalesce(F.col(cells).cast("string").rlike("|".join(codes)), F.lit(False)))


def without_scouts(df: DataFrame, columns: Sequence[str], words: Sequence[str] = ("localizer", "scout")) -> DataFrame:
    """Rows in which no column contains a word; rows null in any column go too."""
    df = df.dropna(subset=list(columns))
    return df.filter(~reduce(lambda a, b: a | b, [F.contains(F.lower(c), F.lit(w)) for c in columns for w in words]))


def without_text(df: DataFrame, columns: Sequence[str], word: str) -> DataFrame:
    """Rows in which no column contains the word in any case; null does not."""
    return df.filter(~reduce(lambda a, b: a | b, [F.coalesce(F.contains(F.lower(c), F.lit(word)), F.lit(False)) for c in columns]))


def without_other_organs(df: DataFrame, column: str, words: Sequence[str] = OTHER_ORGANS) -> DataFrame:
    return df.withColumn(column, T.uniform(F.col(column))).filter(~F.col(column).rlike("|".join(words)))


def on_axis(df: DataFrame, orientation: str, threshold: float = 10.0, keep: str = "Z") -> DataFrame:
    p = plane(F.col(orientation), threshold)
    return df.withColumns({"plane": p["plane"], "angle": p["angle"], "axis": p["axis"]}).filter(F.col("axis") == keep)


def unresolved(df: DataFrame) -> DataFrame:
    """Unresolved rows by status, or, in older tables without one, those whose phase is blank or OTHER."""
    return df.filter("phase_status = 'UNRESOLVED'") if "phase_status" in df.columns else df.filter(blank(F.col("phase")) | (F.upper("phase") == "OTHER"))


def identity_problems(df: DataFrame, keys: Sequence[str], scan: str) -> DataFrame:
    """One row: blank keys, rows, distinct scan ids."""
    return df.agg(F.count_if(reduce(lambda a, b: a | b, map(blank, map(F.col, keys)))).alias("blank_keys"), F.count("*").alias("rows"), F.count_distinct(scan).alias("scans"))


# ---------------------------------------------------------------- projections


def protocol_name(c: Column) -> Column:
    """A series name without phase, dynamic, ordinal and duration tokens."""
    patterns = [T.token(T.VOCABULARY[n]) for n in ("native", "portal", "arterial", "delayed", "post_contrast", "dynamic")]
    c = clock.without_durations(c)
    for p in (T.token(T.ORDINAL), *patterns):
        c = F.regexp_replace(c, p, " ")
    return F.lower(F.trim(F.regexp_replace(c, r"[\s_]+", " ")))


def spacing(c: Column) -> Column:
    """(x, y, mean, area) of a pixel spacing text."""
    v = parsed(c, 2)
    x, y = part(v, 1), part(v, 2)
    return F.when(v.isNotNull(), F.struct(x.alias("x"), y.alias("y"), ((x + y) / 2).alias("mean"), (x * y).alias("area")))


def first_number(c: Column, many: bool = False) -> Column:
    """A number from a text or, the least, from a list."""
    return F.array_min(F.filter(F.transform(c, number), lambda x: x.isNotNull())) if many else number(c)


def site_key(c: Column, centres: Mapping[str, str], arms: Mapping[str, str]) -> Column:
    """`123_AB^AB-7-C`: equal parts around ^ collapse, a digit prefix goes, then centre-number-arm if both codes are known, else null."""
    pieces = F.array_distinct(F.transform(F.split(c, r"\^"), lambda p: F.trim(p)))
    one = F.when(F.size(F.filter(pieces, lambda p: p != "")) == 1, F.element_at(F.filter(pieces, lambda p: p != ""), 1))
    bare = F.regexp_replace(one, r"^\d{3}_", "")
    part_ = lambda i: F.regexp_extract(F.upper(bare), r"^([A-Z]+)[-_ ]?0*(\d+)[-_ ]?([A-Z])?$", i)
    table = lambda m: F.create_map(*[F.lit(x) for kv in m.items() for x in kv])
    ok = F.map_contains_key(table(centres), part_(1)) & (part_(2) != "") & ((part_(3) == "") | F.map_contains_key(table(arms), part_(3)))
    return F.when(ok, F.concat_ws("-", part_(1), part_(2), F.nullif(part_(3), F.lit(""))))


def evidence_summary(columns: Sequence[str]) -> Column:
    return F.array_join(F.filter(F.array(*(F.when(~blank(F.col(c)), F.concat(F.lit(f"{c}="), F.col(c).cast("string"))) for c in columns)), lambda x: x.isNotNull()), "; ")


def folder_of(paths: Column, override: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(override), F.lit("")), F.regexp_extract(F.try_element_at(paths, F.lit(1)), "^(.*)/[^/]*$", 1))


def backed_up(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """source_<c> keeps the original of each column; where a copy exists already it is the original and restores the column."""
    out = {}
    for c in columns:
        kept = f"source_{c}"
        out[c if kept in df.columns else kept] = F.col(kept if kept in df.columns else c)
    return df.withColumns(out)


def regions(df: DataFrame, key: str) -> DataFrame:
    """key, roi, path for each mask_<roi>_path column that is filled."""
    names = [c for c in df.columns if c.startswith("mask_") and c.endswith("_path") and len(c) > len("mask_" + "_path")]
    if not names:
        return df.select(key, F.lit(None).cast("string").alias("roi"), F.lit(None).cast("string").alias("path")).limit(0)
    cells = F.array(*(F.struct(F.lit(c[5:-5]).alias("roi"), F.col(c).alias("path")) for c in names))
    return df.select(key, F.explode(cells).alias("r")).select(key, "r.*").filter(~blank(F.col("path")))


def region_plan(found: DataFrame, key: str, sizes: DataFrame | None = None) -> DataFrame:
    """Per organ whether its tumour is taken out: pairs of x and x_tumor. With the masks' voxel counts (key, roi, n) an empty tumour is as good as none, and an empty organ too."""
    if sizes is not None:
        found = found.join(sizes.filter("n > 0").select(key, "roi"), [key, "roi"], "left_semi")
    organ = F.regexp_replace("roi", "_tumor$", "")
    both = found.groupBy(key, organ.alias("organ")).agg(F.max((F.col("roi") == organ).cast("int")).alias("_o"), F.max((F.col("roi") != organ).cast("int")).alias("_t"))
    return both.select(key, "organ", F.when((F.col("_o") == 1) & (F.col("_t") == 1), "organ_minus_tumor").when(F.col("_o") == 1, "organ").otherwise("tumor").alias("plan"))


def output_columns(tasks: Mapping[str, Sequence[str]]) -> dict[str, str]:
    """Logical outputs of segmentation tasks to their columns; two that share one column are an error."""
    out: dict[str, str] = {}
    for outputs in tasks.values():
        for name in outputs:
            column = f"mask_{name.removeprefix('mask_').removesuffix('_path')}_path"
            if out.get(name, column) != column or (column in out.values() and name not in out):
                raise ValueError(f"two outputs for {column}")
            out[name] = column
    return out


def quality_table(df: DataFrame, columns: Mapping[str, str], details: str, stages: Sequence[str], errors: DataFrame, key: str) -> DataFrame:
    """A fixed list of columns, each stage's status from a JSON column, and the row's messages."""
    df = ensure_columns(df, {c: "string" for c in columns})
    found = [F.coalesce(F.get_json_object(details, f"$.{s}.status"), F.lit("not_run")).alias(f"{s}_status") for s in stages]
    messages = errors.groupBy(key).agg(F.array_join(F.sort_array(F.collect_list("message")), " | ").alias("errors"))
    return df.join(messages, key, "left").select(key, *(F.col(c).alias(n) for c, n in columns.items()), *found, "errors")


# ---------------------------------------------------------------- orders and reports


def viewer_order(df: DataFrame, phase: str, columns: Sequence[str], tie: str) -> DataFrame:
    """By phase (in order of injection), then texts without case, blanks last."""
    place = F.array_position(F.array(*map(F.lit, ("NATIVE", "ARTERIAL", "PORTAL_VENOUS", "DELAYED", "HEPATOBILIARY"))), F.upper(phase))
    keys = [x for c in columns for x in (blank(F.col(c)), F.lower(c))]
    return df.orderBy(F.when(F.coalesce(place, F.lit(0)) == 0, 99).otherwise(place), *keys, tie)


def by_modality(df: DataFrame, modality: str = "Modality") -> dict[str, DataFrame]:
    """CT, MR and other rows; without the column all are CT."""
    if modality not in df.columns:
        return {"CT": df, "MR": df.limit(0), "OTHER": df.limit(0)}
    m = T.modality(F.col(modality))
    return {"CT": df.filter(m == "CT"), "MR": df.filter(m == "MR"), "OTHER": df.filter(~F.coalesce(m.isin("CT", "MR"), F.lit(False)))}


def coverage_distribution(df: DataFrame, exam: Sequence[str], label: str, most: int = 4) -> DataFrame:
    """How many exams have 0 to `most` distinct labels."""
    n = df.groupBy(*exam).agg(F.count_distinct(label).alias("n")).groupBy("n").agg(F.count("*").alias("exams"))
    every = df.sparkSession.range(most + 1).select(F.col("id").alias("n"))
    return every.join(n, "n", "left").select("n", F.coalesce("exams", F.lit(0)).alias("exams"))


def stage_funnel(stages: Mapping[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, [df.agg(F.lit(name).alias("stage"), F.count("*").alias("rows")) for name, df in stages.items()])


def native_default(df: DataFrame, exam: Sequence[str], phase: str, text: str) -> DataFrame:
    """In exams without any phase evidence an unlabelled volume is native."""
    some = F.max(F.coalesce(phase_evidence(F.col(text)), F.lit(False)).cast("int")).over(W.partitionBy(*exam))
    return df.withColumn(phase, F.when(F.col(phase).isNull() & (some == 0), "NATIVE").otherwise(F.col(phase)))


def numbered_context(df: DataFrame, group: Sequence[str], text: str, label: str | None = None) -> DataFrame:
    """Whether a row's protocol has numbered volumes, how many numbers there are, and, with the labels given, whether a numbered volume's label
    conflicts: it says NATIVE where a volume of the protocol without a number is native."""
    number_ = T.ordinal(F.col(text))
    w = W.partitionBy(*group, "_protocol")
    df = df.withColumns({"_protocol": protocol_name(F.col(text)), "_n": number_})
    out = {"in_numbered_protocol": F.max(F.col("_n").isNotNull().cast("int")).over(w) == 1, "numbers": F.size(F.collect_set("_n").over(w))}
    if label is not None:
        native = F.coalesce(F.col(label) == "NATIVE", F.lit(False))
        out["numbered_conflict"] = F.col("_n").isNotNull() & native & (F.max((native & F.col("_n").isNull()).cast("int")).over(w) == 1)
    return df.withColumns(out).drop("_protocol", "_n")


def group_status(df: DataFrame, group: str, partial: str, ranked_by: Sequence, ok: Column, least: int = 2) -> DataFrame:
    """Registration groups: the reference (whole organs before partial ones), contributors, and a status."""
    w = W.partitionBy(group).orderBy(F.col(partial).cast("int"), *ranked_by)
    rows = df.withColumns({"_r": F.row_number().over(w), "_ok": F.coalesce(ok, F.lit(False))})
    g = rows.groupBy(group).agg(F.max(F.when(F.col("_r") == 1, F.col(ranked_by[-1]))).alias("reference"), F.count("*").alias("members"), F.count_if("_ok").alias("contributors"))
    return g.withColumn("status", F.when(F.col("members") == 1, "single").when(F.col("contributors") >= least, "consensus").otherwise("reference_only"))


# ---------------------------------------------------------------- masks by name


def mask_program(masks: DataFrame, grid: DataFrame, operations: Sequence[Mapping], geometry: DataFrame | None = None) -> DataFrame:
    """Named masks through an ordered list of operations {op, inputs, output, ...}; outputs can be inputs of later ones.

    Errors, before anything runs: inputs that no earlier step gives, voxels outside the grid, and, with `geometry` (scan_id, mask and any columns that
    describe a mask's lattice), an operation whose inputs lie on unlike lattices in a scan; an output has the lattice of its first input.
    """
    have = {r["mask"] for r in masks.select("mask").distinct().collect()}  # names, not voxels
    origin: dict[str, str] = {name: name for name in have}
    for i, o in enumerate(operations):
        absent = [x for x in o["inputs"] if x not in origin]
        if absent:
            raise ValueError(f"{o['output']} needs {absent}, which no earlier step gives")
        sources = sorted({origin[x] for x in o["inputs"]})
        if geometry is not None and len(sources) > 1:
            rows = geometry.filter(F.col("mask").isin(sources)).groupBy("scan_id").agg(F.count_distinct(F.struct(*(c for c in geometry.columns if c not in ("scan_id", "mask")))).alias("n"))
            unlike = rows.filter("n > 1").orderBy("scan_id").limit(5).collect()
            if unlike:
                raise ValueError(f"operation {i} ({o['op']}): {o['inputs']} lie on unlike lattices in {', '.join(str(r['scan_id']) for r in unlike)}")
        origin[o["output"]] = origin[o["inputs"][0]]
    strange = masks.join(grid.select(X.VOXEL), X.VOXEL, "left_anti").select("scan_id", "mask").limit(1).collect()
    if strange:
        raise ValueError(f"{strange[0]['mask']} of {strange[0]['scan_id']} has voxels outside the grid")
    for o in operations:
        if o["op"] in ("union", "intersection", "xor", "difference", "not"):
            out = X.combine(masks, o["inputs"], o["op"], grid)
        else:
            one = masks.filter(F.col("mask") == o["inputs"][0]).select(X.VOXEL)
            out = {"largest": X.largest_component, "fill": lambda m: X.fill_holes(m, grid)}.get(o["op"], lambda m: X.morphology(m, grid, o["op"], o["radius"], o.get("spacing", (1, 1, 1)), o.get("iterations", 1)))(one)  # noqa: B023
        masks = masks.filter(F.col("mask") != o["output"]).unionByName(out.withColumn("mask", F.lit(o["output"])).select(masks.columns))
    return masks


def fragments(mask: DataFrame, reference: DataFrame) -> DataFrame:
    """Per scan: components, size of the largest, share of the rest, change of volume against a reference."""
    sizes = X.labelled(mask, 1).groupBy("scan_id", "label").agg(F.count("*").alias("n"))
    one = sizes.groupBy("scan_id").agg(F.count("*").alias("components"), F.max("n").alias("largest"), F.sum("n").alias("voxels"))
    ref = reference.groupBy("scan_id").agg(F.count("*").alias("_ref"))
    return one.join(ref, "scan_id", "left").select("scan_id", "components", "largest", (1 - F.col("largest") / F.col("voxels")).alias("fragments"), F.try_divide(F.col("voxels") - F.col("_ref"), F.col("_ref")).alias("change"))
