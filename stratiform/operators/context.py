"""MR phases from an exam's other volumes: the rules of curation and ordering in a fixed order, each a window over one protocol.

A group is one protocol of one exam, a few volumes, so no window or collected list grows with the table.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratiform.functions import text as T
from stratiform.functions.rules import number
from stratiform.operators import curation as C
from stratiform.operators import phases as P
from stratiform.operators.ordering import chronology
from stratiform.shared import spread, written

#: Fixed: families of dynamic T1 protocols; the first that the text names counts.
FAMILIES = {
    "DIXON": C._DIXON, "GRASP": "grasp", "VIBE": "vibe|twist|dynava", "LAVA": "lava", "THRIVE": "e?thrive", "IDEAL": "idea(?:l)?", "DISCO": "disco", "SPGR": "fspgr|spgr", "TFE": "tfe", "FLASH": "flash",
}
#: Fixed: components that cannot be a native volume, and how well others suit.
NO_NATIVE = ("FAT", "FAT_FRACTION", "R2STAR", "DIXON_ALL")
COMPONENT_RANK = {"WATER": 4, "IN_PHASE": 3, "UNKNOWN": 2}
#: The exam stands first in every key, so that one shuffle by exam serves all windows.
PROTOCOL = ("_exam", "protocol")
KEY = (*PROTOCOL, "component", "_dynamic_series")
#: How sure a source is, and what it says.
SOURCES = {
    "strategy_context": ("", "a strategy ahead of the rules"),
    "dicom_phase": ("high", "the contrast-phase tag"),
    "dicom_phase_conflict": ("low", "the contrast-phase tag names several phases"),
    "explicit_text": ("high", "the text"),
    "acquisition_phase": ("high", "another reconstruction of the same acquisition"),
    "container_order": ("medium", "the place among the volumes of a container of several phases"),
    "exam_context": ("fallback", "the best separate volume of a protocol without a native one"),
    "generic_dynamic": ("inferred", "the place between known phases of a dynamic series"),
    "group_pre_post_order": ("inferred", "the first acquisition of a group with a text that says both before and after contrast"),
    "ordinal_phase_conflict": ("low", "a numbered volume is no native beside a native"),
    "native_no_perfusion_evidence": ("fallback", "no evidence of contrast"),
    "none": ("low", "no phase evidence"),
}


def family(text: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, pattern in reversed(FAMILIES.items()):
        out = F.when(text.rlike(T.token(pattern)), name).otherwise(out)
    return F.coalesce(out, F.lit("UNSPECIFIED_T1"))


def with_protocol(df: DataFrame, exam: Sequence[str], texts: Sequence[str] = C.TEXT_COLUMNS) -> DataFrame:
    """Adds protocol (exam, family, plane, projection, subtraction: what volumes must share to be compared) and component (its Dixon part).

    The family is read from the first text that names a sequence. Blank and null parts of the key are equal.
    """
    names_sequence = T.token(*C.SEQUENCES.values(), *FAMILIES.values(), T.VOCABULARY["localizer"], T.VOCABULARY["key_images"])
    text = C._first(df, texts, lambda c: F.when(c.rlike(names_sequence), c)).cast("string")
    plane = F.upper(F.trim(C._col(df, "acquisition_plane")))
    plane = F.when(plane.isin(*C.PLANE_SCORE), plane).otherwise(F.coalesce(C._col(df, "plane"), F.lit("UNKNOWN")))
    flag = lambda name: F.coalesce(C._col(df, name, "boolean").cast("boolean"), F.lit(False))
    return df.withColumns({
        "protocol": F.struct(
            *(F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")).alias(c) for c in exam), F.coalesce(family(text), F.lit("UNSPECIFIED_T1")).alias("family"), plane.alias("plane"),
            flag("is_mip_mpr").alias("projection"), flag("is_subtraction").alias("subtraction"),
        ),
        "component": F.coalesce(C._col(df, "dixon_component"), F.lit("NOT_DIXON")),
    })


def container(text: Column) -> Column:
    """What a text names if it stands for several phases: arterial with portal, these with delayed, or a mask with arterial phases."""
    arterial, portal = T.has(text, "arterial"), T.has(text, "portal")
    liver = F.coalesce(text.rlike(T.token(C.MR_TERMS.rules[0].terms)), F.lit(False))
    mask = F.coalesce(text.rlike(T.token("mas(?:k|que?)")), F.lit(False))
    return F.when(arterial & portal & T.has(text, "delayed") & ~liver, "art_port_late").when(arterial & portal, "art_port").when(mask & arterial, "mask_multiart")


def placed(kind: Column, rank: Column, n: Column) -> Column:
    """The phase of the rank-th of n volumes of a container; null where its place does not tell."""
    late = F.when(rank == 1, "ARTERIAL").when(rank == n, "DELAYED").when(n == 3, "PORTAL_VENOUS")
    two = F.when(rank == 1, "ARTERIAL").when(rank == n, "PORTAL_VENOUS")
    mask = F.when(rank == 1, "NATIVE").otherwise("ARTERIAL")
    return F.when((kind == "art_port_late") & (n > 1), late).when((kind == "art_port") & (n > 1), two).when(kind == "mask_multiart", mask)


def tag_phase(c: Column) -> Column:
    """(phase, conflict) of the values of a contrast-phase tag; values that name nothing are left out."""

    def named(x: Column) -> Column:
        out = F.when(F.coalesce(x.rlike(T.token(C.MR_TERMS.native)), F.lit(False)), "NATIVE")
        for rule in C.MR_TERMS.rules:
            out = out.when(F.coalesce(x.rlike(T.token(rule.terms)), F.lit(False)), rule.label)
        return out

    found = F.array_distinct(F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), r"\\"), named), lambda x: x.isNotNull()))
    return F.struct(F.when(F.size(found) == 1, F.element_at(found, 1)).alias("phase"), (F.size(found) > 1).alias("conflict"))


def _ruled(df: DataFrame, source: str, rule: Callable[[DataFrame], DataFrame], only: Column | None = None) -> DataFrame:
    """Runs a rule on _label. Labels that it changes are kept, with their source, where `only` holds; elsewhere the label stays."""
    out = rule(df.withColumn("_before", F.col("_label")))
    taken = ~F.col("_label").eqNullSafe(F.col("_before")) & (F.lit(True) if only is None else F.coalesce(only, F.lit(False)))
    out = out.withColumn("_taken", taken).withColumn("_source", F.when(F.col("_taken"), source).otherwise(F.col("_source")))
    return out.withColumn("_label", F.when(F.col("_taken"), F.col("_label")).otherwise(F.col("_before"))).drop("_before", "_taken")


def _contained(df: DataFrame) -> DataFrame:
    """Containers by place: in their series if it has several volumes, else among the single volumes of the protocol and component,

    by the first of acquisition order and time that is complete and distinct there.
    """
    kind = F.col("_kind")
    many = F.coalesce(F.col("_in_series") > 1, F.lit(False))
    alone = W.partitionBy(*PROTOCOL, "component", "_kind", many)
    n, rank = F.count("*").over(alone), F.lit(None).cast("int")
    for c in ("_seconds_of_day", "_order"):
        distinct = (F.count(c).over(alone) == n) & (F.size(F.collect_set(c).over(alone)) == n)
        rank = F.when(distinct, F.row_number().over(alone.orderBy(c))).otherwise(rank)
    rank = F.when((n == 1) & (kind == "mask_multiart"), F.lit(1)).otherwise(rank)
    df = df.withColumns({"_many": many, "_rank": F.when(many, F.col("_place")).otherwise(rank), "_of": F.when(many, F.col("_in_series")).otherwise(n)})
    by_place = F.when(kind.isNotNull() & F.col("_label").isNull(), placed(kind, F.col("_rank"), F.col("_of")))
    return df.withColumn("_label", F.coalesce("_label", by_place)).drop("_many", "_rank", "_of")


def _native(df: DataFrame) -> DataFrame:
    """The best separate candidate of a protocol without a native volume, if other acquisitions are known phases (one at least) or dynamic ones (two)."""
    w = W.partitionBy(*PROTOCOL)
    known = F.col("_label").isin("ARTERIAL", "PORTAL_VENOUS", "DELAYED")
    df = df.withColumns({"_known": F.max(known.cast("int")).over(w) == 1, "_others": F.collect_set(F.when(known | (F.col("_dynamic") & F.col("_t1")), F.col("_acquisition"))).over(w)})
    enough = F.size(F.array_union("_others", F.array("_acquisition"))) >= F.when(F.col("_known"), 2).otherwise(3)
    df = df.withColumn("_fits", F.coalesce(F.col("_candidate") & F.col("_label").isNull() & ~F.col("_dynamic") & enough & (F.size("_others") > 0), F.lit(False)))
    return C.missing_native(df, PROTOCOL, "_acquisition", "_label", F.col("_fits"), [F.desc("_quality"), F.desc("_part"), F.col("_volume")], least=1).drop("_known", "_others", "_fits")


def _folded(df: DataFrame) -> DataFrame:
    """Dynamic volumes by the template, between the known phases of their protocol and component."""
    liver = F.col("_label").eqNullSafe("HEPATOBILIARY")  # long after the series
    df = df.withColumn("_dynamic_series", F.col("_t1") & (F.col("_dynamic") | F.col("_label").isNotNull()) & ~liver)
    df = chronology(df, KEY, "_seconds_of_day", "_order")
    df = df.withColumn("_elapsed", F.col("_seconds_of_day") - F.min("_seconds_of_day").over(W.partitionBy(*KEY)))
    df = C.fold_phases(df, KEY, "chronology", "_label", "_elapsed")
    return df.withColumn("_label", F.coalesce("_label", F.when(F.col("_dynamic") & F.col("_dynamic_series"), F.col("folded_phase")))).drop("folded_phase", "chronology", "_elapsed", "_dynamic_series")


def in_context(df: DataFrame, exam: Sequence[str], volume: str, texts: Sequence[str] = C.TEXT_COLUMNS, chain: Mapping | None = None) -> DataFrame:
    """Annotated MR volumes (annotate_mr) with phases that only their exam tells: rule_phase and mri_perfusion_source, _confidence and _reason are replaced.

    With a chain of strategies those ahead of its rules are evaluated first: what they resolve is known to the other volumes of the exam, while the
    rules' own finding for such a volume stays what its tag and text say, for the chain to choose from.

    In this order, a later rule seeing what the earlier ones found: the contrast-phase tag and the text; labels shared by reconstructions of one
    acquisition; containers by place; a missing native volume; the template fold over dynamic series; a missing native again; groups with a text that
    says both before and after contrast; numbered volumes, which are no natives beside a native; natives for want of any evidence. Volumes other than
    T1 stay OTHER. Optional columns: acquisition_id, acquisition_order, time_seconds, volume_order_in_series, n_volumes_in_series,
    ContrastBolusAgentPhase, Rows, Columns, FrameOfReferenceUID. Rows that repeat all of an exam and volume are separate volumes of one time.
    """
    names = df.columns
    known = P.ahead(df, chain, "rules") if chain else None
    df = with_protocol(df.withColumn("_ahead", known if known is not None else F.lit(None).cast(P.WON)), exam, texts).withColumn("_tag", tag_phase(C._col(df, "ContrastBolusAgentPhase")))
    text, t1 = F.coalesce(F.col("_evidence"), F.lit("")), F.col("mri_sequence") == "T1"
    ordinal, derived = T.ordinal(text), F.col("is_subtraction") | F.col("is_mip_mpr") | F.col("is_quant_or_report")
    kind = F.when(t1 & ~derived, container(text))
    told = F.when((F.col("rule_phase") != "OTHER") & kind.isNull(), F.col("rule_phase"))
    blank = lambda c: F.nullif(F.trim(c.cast("string")), F.lit(""))
    pure_post = C.pure_post(text)
    df = df.withColumns({
        "_t1": t1, "_text": text, "_kind": kind, "_ordinal": ordinal, "_volume": F.col(volume).cast("string"), "_acquisition": F.coalesce(blank(C._col(df, "acquisition_id")), blank(F.col(volume)), F.lit("")),
        "_dynamic": T.has(text, "dynamic") | ordinal.isNotNull(), "_order": number(C._col(df, "acquisition_order")), "_seconds_of_day": number(C._col(df, "time_seconds")),
        "_place": number(C._col(df, "volume_order_in_series")), "_in_series": number(C._col(df, "n_volumes_in_series")),
        "_candidate": t1 & ~derived & ~pure_post & ordinal.isNull() & kind.isNull() & ~F.col("_tag.conflict") & ~F.col("component").isin(*NO_NATIVE),
        "_quality": F.when(F.col("plane") == "AXIAL", 4).otherwise(0) + F.when(F.col("is_3d_gre"), 3).otherwise(0) + F.when(F.col("is_breath_hold"), 1).otherwise(0),
        "_part": C._scores(F.col("component"), COMPONENT_RANK, 0),
        "_label": F.when(t1 & ~F.col("_tag.conflict"), F.coalesce("_tag.phase", told)),
    }).withColumn("_source", F.when(F.col("_t1") & F.col("_tag.conflict"), "dicom_phase_conflict").when(F.col("_label").isNull(), "none").when(F.col("_tag.phase").isNotNull(), "dicom_phase").otherwise("explicit_text"))
    own = {f"_own{c}": F.col(c) for c in ("_label", "_source")}
    told_before = F.col("_t1") & F.col("_ahead").isNotNull()
    df = df.withColumns({**own, "_anchored": told_before}).withColumns({"_label": F.when(F.col("_anchored"), F.col("_ahead.phase")).otherwise(F.col("_label")), "_source": F.when(F.col("_anchored"), "strategy_context").otherwise(F.col("_source"))})
    free = (F.col("_source") != "dicom_phase_conflict") & ~F.col("_anchored")
    guards = ["mri_sequence", *(c for c in ("Rows", "Columns", "FrameOfReferenceUID") if c in names)]
    exam_of = F.struct(*(F.col(f"protocol.{c}") for c in exam))
    df = spread(df.withColumn("_exam", exam_of), "_exam")
    df = _ruled(df, "acquisition_phase", lambda d: C.share_labels(d, ["_exam", "_acquisition"], "_label", F.col("_source").isin("explicit_text", "dicom_phase", "strategy_context"), guards), free & F.col("_t1"))
    df = _ruled(df, "container_order", _contained, free & F.col("_t1"))
    df = _ruled(df, "exam_context", _native, free)
    df = _ruled(df, "generic_dynamic", _folded, free & F.col("_t1"))
    df = _ruled(df, "exam_context", _native, free)
    seen = F.max((F.col("_t1") & (F.col("_label") == "NATIVE") & F.col("_ordinal").isNull()).cast("int")).over(W.partitionBy(*PROTOCOL)) == 1
    df = df.withColumn("_numbered", F.col("_t1") & F.col("_ordinal").isNotNull() & F.coalesce(seen, F.lit(False)))
    df = df.withColumn("_group", F.struct("_t1", "component", F.coalesce("plane", F.lit("")), F.coalesce(derived, F.lit(False))))
    df = _ruled(df, "group_pre_post_order", lambda d: C.pre_post_native(d, ["_exam", "_group"], "_text", "_label", ["_seconds_of_day", "_order"]), free & F.col("_t1") & ~derived & ~F.col("_numbered") & F.col("_before").isNull())
    df = _ruled(df, "ordinal_phase_conflict", lambda d: d.withColumn("_label", F.when(~(F.col("_numbered") & (F.col("_label") == "NATIVE")), F.col("_label"))))
    nothing = (F.col("_source") == "none") & F.col("_candidate") & ~P.phase_evidence(F.col("_text"), C.MR_TERMS) & (F.coalesce(blank(C._col(df, "ContrastBolusAgentPhase")), F.lit("")) == "")
    df = _ruled(df, "native_no_perfusion_evidence", lambda d: d.withColumn("_label", F.when(F.col("_label").isNull() & nothing, "NATIVE").otherwise(F.col("_label"))))
    label, source = (F.when(F.col("_anchored"), F.col(f"_own{c}")).otherwise(F.col(c)) for c in ("_label", "_source"))
    says = lambda i: F.create_map(*[F.lit(x) for name, said in SOURCES.items() for x in (name, said[i])])[source]
    detail = F.when(F.col("_text") != "", F.concat(F.lit("; "), F.col("_text"))).otherwise("")
    out = {"rule_phase": F.coalesce(label, F.lit("OTHER")), "mri_perfusion_source": source, "mri_perfusion_confidence": says(0), "mri_perfusion_reason": F.concat(says(1), detail), "numbered_postcontrast": F.col("_numbered")}
    return df.withColumns(out).select(*names, *(c for c in ("protocol", "component", "numbered_postcontrast") if c not in names))


def curate(df: DataFrame, exam: Sequence[str], volume: str, chain: Mapping, texts: Sequence[str] | Mapping[str, Sequence[str]] = C.TEXT_COLUMNS) -> dict[str, DataFrame]:
    """CT and MR volumes through annotation, MR context, phase resolution, scoring and selection; the annotated table is written once.

    `texts` are the text columns in order of precedence, or such lists by modality; a modality that isn't named has the usual ones.
    """
    of = lambda m: texts.get(m, C.TEXT_COLUMNS) if isinstance(texts, Mapping) else texts
    df = spread(df, *exam)  # before the texts are read: a small file has many rows
    modality = T.modality(F.coalesce(C._col(df, "Modality"), F.lit("CT")))
    ct = P.resolve(C.annotate_ct(df.filter(modality == "CT"), of("CT")), chain)
    ct = ct.withColumns({"selection_slot": F.col("phase"), "selection_score": C.score_ct(ct)})
    mr = C.tie_breakers(C.score_mr(P.resolve(in_context(C.annotate_mr(df.filter(modality == "MR"), of("MR")), exam, volume, of("MR"), chain), chain)))
    both = written(ct.unionByName(mr, allowMissingColumns=True), "curated")
    long, wide = C.select(both, exam, [*C.CT_SLOTS, *C.MR_SLOTS], volume, C.mr_order())  # CT volumes have no MR tie-breakers: their score decides
    slot = F.col("selection_slot")
    parts = {"t1_candidates": slot.startswith("T1_"), "t2_candidates": slot == "T2", "dwi_candidates": slot == "DWI"}
    return {"curated": both, "long": long, "wide": wide, "unresolved": both.filter("phase_status = 'UNRESOLVED'"), **{name: long.filter(c) for name, c in parts.items()}}
