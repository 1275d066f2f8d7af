"""CT and MR volume curation: features, sequences, scores, selection slots and the selection itself. Projections only, but for the selection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratiform.functions import text as T
from stratiform.functions.clock import durations
from stratiform.functions.rules import number
from stratiform.operators import phases as P
from stratiform.operators.imaging import spacing
from stratiform.operators.ordering import first_acquisition
from stratiform.operators.rollup import wide

TEXT_COLUMNS = ("SeriesDescription", "ProtocolName", "ImageComments")
SEP = T.SEP

#: Fixed: MR vocabulary.
_GADOLINIUM = r"gd|gad|gado|gadopdc|gadolinium|eovist|primovist|gadoxetate|gadoxetic"
_DIXON = rf"(?:[mqe]{SEP})?dixon"
_T1_GRE = rf"vibe|lava|e?thrive|twist|grasp|dynava|fspgr|spgr|tfe|twist{SEP}vibe|lava{SEP}flex|{_DIXON}|idea(?:l)?|disco"
_T2_SINGLE = rf"haste|e?ss{SEP}fse|ss{SEP}tse|ssh|single{SEP}shot{SEP}(?:fse|tse|(?:fast|turbo){SEP}spin{SEP}echo)"
_T2_FAST = rf"tse|fse|frfse|(?:fast|turbo){SEP}spin{SEP}echo"
_T2_MULTI = rf"{_T2_FAST}|f?blade|propeller|prop|multivane|space|cube|vista"
SEQUENCES = {
    "DWI": rf"dwi|dw{SEP}epi|diff(?:usion)?|dif|(?:e|d)?adc|apparent{SEP}diffusion{SEP}coefficient|trace|ivim|dti|ep2d|b{SEP}(?:={SEP})?\d{{1,4}}",
    "T1": rf"t1(?:{SEP}weighted)?|3d{SEP}t1|{_T1_GRE}|multi{SEP}{T.ARTERIAL}|{_GADOLINIUM}|post{SEP}(?:iv|{_GADOLINIUM}|{T.CONTRAST})|(?:post|ce){SEP}t1",
    "T2": rf"t2(?:{SEP}weighted)?|{_T2_MULTI}|{_T2_SINGLE}|conventional{SEP}(?:se|spin{SEP}echo)|spir|spair|aspir|bhte",
}
_QUANT = rf"{T.VOCABULARY['quantitative']}|fat{SEP}fraction|fatfrac|pdff|ff|r2\*|r2{SEP}star|t2(?:\*|{SEP}star){SEP}map"
#: Fixed: MR terms of phases, the hepatobiliary phase with its delays, and terms of T2 features.
CT_TERMS = P.terms(arterial=rf"ct{SEP}a")
MR_TERMS = P.terms(
    native=rf"(?:pr[eé]|sans|non){SEP}(?:{_GADOLINIUM})|mas(?:k|que)",
    post=_GADOLINIUM,
    first=(P.Rule("HEPATOBILIARY", rf"bili|hepato{SEP}(?:biliary|biliaire)|hbp|bhp|voie{SEP}biliaire", ((1200, 1200), (7200, 10799))),),
    by_delay="HEPATOBILIARY",
)
T2_FEATURES = {
    "is_t2_fatsat": rf"fs|fat{SEP}sat(?:urated)?|spair|spir|stir|tirm",
    "is_t2_motion_robust": rf"f?blade|propeller|prop|multivane|radial|{T.VOCABULARY['respiratory']}",
    "is_t2_haste_ssfse": _T2_SINGLE,
    "is_t2_tse_fse": rf"{_T2_FAST}|sense|te{SEP}\d+|fast{SEP}spin|turbo{SEP}spin",
    "is_t2_mrcp_biliary": r"mrcp|cpre|bili(?:aire|ary)?|chol|cholangio?",
}
#: Fixed: MR phase priority adds one phase; planes' share of a score.
MR_PRIORITY = {**P.PRIORITY, "HEPATOBILIARY": 90}
PLANE_SCORE = {"AXIAL": 50, "CORONAL": 20, "SAGITTAL": 5}
MR_SLOTS = ("T2", "DWI", "T1_NATIVE", "T1_ARTERIAL", "T1_PORTAL_VENOUS", "T1_DELAYED", "T1_HEPATOBILIARY")
CT_SLOTS = ("NATIVE", "ARTERIAL", "PORTAL_VENOUS", "DELAYED")


def _texts(df: DataFrame, names: Sequence[str]) -> dict[str, Column]:
    return {n: F.col(n) for n in names if n in df.columns}


def _col(df: DataFrame, name: str, kind: str = "string") -> Column:
    return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast(kind)


def _first(df: DataFrame, names: Sequence[str], decide) -> Column:
    """The first text column for which `decide` is not null decides."""
    found = [decide(c) for c in _texts(df, names).values()]
    return F.coalesce(*found) if found else F.lit(None)


def _any(df: DataFrame, names: Sequence[str], pattern: str) -> Column:
    return F.coalesce(_first(df, names, lambda c: F.when(c.rlike(pattern), True)), F.lit(False))


def _scores(c: Column, table: Mapping[str, float], other: float) -> Column:
    out = F.lit(float(other))
    for k, v in table.items():
        out = F.when(c == k, float(v)).otherwise(out)
    return out


def _with_evidence(df: DataFrame, texts: Sequence[str], of: P.Terms) -> DataFrame:
    """_evidence, the text that decides on the phase, the column it is from, and its durations: columns of their own, so that each is computed once."""
    found = _texts(df, texts)
    told = T.first_with(found, lambda c: P.phase_evidence(c, of)) if found else F.lit(None).cast("struct<column:string,text:string>")
    df = df.withColumn("_told", told).withColumns({"_evidence": F.col("_told.text"), "_evidence_column": F.col("_told.column")}).drop("_told")
    return df.withColumn("_seconds", F.when(F.col("_evidence").rlike("[0-9]"), durations(F.col("_evidence"))).otherwise(F.array().cast("array<double>")))


def annotate_ct(df: DataFrame, texts: Sequence[str] = TEXT_COLUMNS) -> DataFrame:
    """rule_phase with confidence, applicability reason and CT features."""
    kind = _first(df, texts, lambda c: F.when(T.has(c, "localizer"), "LOCALIZER").when(T.has(c, "bolus_monitoring"), "BOLUS_MONITORING").when(P.phase_evidence(c) | T.plane(c).isNotNull(), "ACQUISITION"))
    plane = _first(df, texts, T.plane)
    rows, cols = number(_col(df, "Rows")), number(_col(df, "Columns"))
    slices = F.coalesce(number(_col(df, "n_rows_in_volume")), number(_col(df, "n_files")))
    image_type = F.lower(F.coalesce(_col(df, "ImageType").cast("string"), F.lit("")))
    phase = P.phase_of(F.col("_evidence"), CT_TERMS, F.col("_seconds"))
    df = _with_evidence(df, texts, CT_TERMS).withColumns({
        "_kind": kind, "is_axial": F.coalesce((plane == "AXIAL") | (plane.isNull() & (rows == cols)), F.lit(False)), "is_original": T.has(image_type, "original") & T.has(image_type, "primary"),
        "is_derived_low_value": _any(df, texts, T.token(T.VOCABULARY["derived"])), "_rows": rows, "_cols": cols, "_slices": slices, "_thickness": number(_col(df, "SliceThickness")), "_phase": phase,
    })
    reason = F.when(F.col("_kind").isin("LOCALIZER", "BOLUS_MONITORING"), F.col("_kind"))
    return df.withColumns({
        "is_localizer": F.coalesce(F.col("_kind") == "LOCALIZER", F.lit(False)), "phase_applicability_reason": reason,
        "rule_phase": F.when(reason.isNotNull(), "OTHER").otherwise(F.coalesce("_phase", F.lit("OTHER"))),
        "rule_phase_confidence": F.when(reason.isNotNull(), "not_applicable").when(F.col("_phase").isNotNull(), "high").otherwise("low"),
    }).drop("_kind", "_phase", "_evidence", "_evidence_column", "_seconds")


def score_ct(df: DataFrame, phase: str = "phase") -> Column:
    """Priority of the phase, explicit choice, plane, original, matrix, slices, thickness, penalties."""
    score = _scores(T.label_or_other(F.col(phase)), P.PRIORITY, 0)
    score += P.selection_bonus(df) if "phase_status" in df.columns else F.lit(0)
    yes = lambda c, a, b=0.0: F.when(c, a).otherwise(b)
    rows, cols, n, t = F.col("_rows"), F.col("_cols"), F.col("_slices"), F.col("_thickness")
    score += yes(F.col("is_axial"), 40.0) + yes(F.col("is_original"), 30.0)
    score += F.when(rows.isNull() | cols.isNull(), 0.0).when((rows == 512) & (cols == 512), 20.0).otherwise(-10.0)
    score += F.when(n >= 80, 20.0).when(n < 20, -50.0).otherwise(0.0) + F.when(t <= 3, 10.0).when(t > 7, -10.0).otherwise(0.0)
    return (score + yes(F.col("is_localizer"), -500.0) + yes(F.col("is_derived_low_value"), -200.0)).cast("double")


def annotate_mr(df: DataFrame, texts: Sequence[str] = TEXT_COLUMNS) -> DataFrame:
    """mri_sequence with confidence, T2 family, plane and feature flags, row-level phase."""
    modality = F.upper(F.trim(F.coalesce(_col(df, "Modality"), F.lit(""))))

    def sequence(c: Column) -> Column:
        out = F.when(T.has(c, "localizer"), "LOCALIZER").when((modality == "KO") | T.has(c, "key_images"), "KEY_IMAGES")
        for name, pattern in SEQUENCES.items():
            out = out.when(c.rlike(T.token(pattern)), name)
        return out

    by_text = _first(df, texts, sequence)
    tr, te = number(_col(df, "RepetitionTime")), number(_col(df, "EchoTime"))
    by_time = F.when((tr < 800) & (te < 35), "T1").when((tr > 1500) & (te > 60), "T2")
    seq = F.coalesce(by_text, F.when(modality == "KO", "KEY_IMAGES"), by_time, F.lit("OTHER"))
    family = _first(df, texts, lambda c: F.when(c.rlike(T.token(_T2_SINGLE)), "single_shot").when(c.rlike(T.token(_T2_MULTI)), "multi_shot"))
    df = _with_evidence(df, texts, MR_TERMS).withColumns({
        "mri_sequence": seq, "mri_sequence_confidence": F.when(by_text.isNotNull() | (modality == "KO"), "high").when(by_time.isNotNull(), "medium").otherwise("low"), "_family": family,
        "plane": _first(df, texts, T.plane), "is_3d_gre": _any(df, texts, T.token(_T1_GRE)), "is_dynamic_t1_text": _any(df, texts, T.token(T.VOCABULARY["dynamic"])),
        "is_breath_hold": _any(df, texts, T.token(T.VOCABULARY["breath_hold"])), "is_resp_triggered": _any(df, texts, T.token(T.VOCABULARY["respiratory"])),
        "is_subtraction": _any(df, texts, T.token(T.VOCABULARY["subtraction"])), "is_mip_mpr": _any(df, texts, T.token(T.VOCABULARY["mip_mpr"])), "is_quant_or_report": _any(df, texts, T.token(_QUANT)),
        **{name: _any(df, texts, T.token(pattern)) for name, pattern in T2_FEATURES.items()},
        "dixon_component": dixon(df, texts), "_phase": P.phase_of(F.col("_evidence"), MR_TERMS, F.col("_seconds")),
    })
    return df.withColumns({
        "mri_t2_acquisition_family": F.when(F.col("mri_sequence") == "T2", F.col("_family")),
        "phase_applicability_reason": F.when(F.col("mri_sequence") == "LOCALIZER", "LOCALIZER").when(F.col("mri_sequence") != "T1", "NON_T1"),
        "rule_phase": F.when(F.col("mri_sequence") == "T1", F.coalesce("_phase", F.lit("OTHER"))).otherwise("OTHER"),
        "mri_perfusion_source": F.when((F.col("mri_sequence") == "T1") & F.col("_phase").isNotNull(), "explicit_text").otherwise("none"),
        "mri_perfusion_confidence": F.when((F.col("mri_sequence") == "T1") & F.col("_phase").isNotNull(), "high").otherwise("low"),
        "mri_perfusion_reason": F.when((F.col("mri_sequence") == "T1") & F.col("_phase").isNotNull(), F.concat(F.lit("matched "), F.lower("_phase"), F.lit(" in "), F.col("_evidence_column"), F.lit("="), F.col("_evidence"))).otherwise("no phase evidence"),
    }).drop("_family", "_phase", "_seconds", "_evidence_column")


#: Fixed: image-type tokens of Dixon components.
DIXON_TOKENS = {"WATER": ("W", "WATER"), "FAT": ("F", "FAT"), "IN_PHASE": ("IP", "IN_PHASE"), "OUT_PHASE": ("OP", "OPP", "OUT_PHASE", "OPP_PHASE")}


def dixon(df: DataFrame, texts: Sequence[str] = TEXT_COLUMNS) -> Column:
    """Component by name suffix and by image type; null without evidence, UNKNOWN when they contradict."""
    suffix = r"(?i)[_ -]({})(?:$|[\s_.-])"
    by_text = _first(df, texts, lambda c: F.when(c.rlike(suffix.format("w|water")), "WATER").when(c.rlike(suffix.format("f|fat")), "FAT").when(c.rlike(suffix.format("in|ip")), "IN_PHASE").when(c.rlike(suffix.format("opp|op|out")), "OUT_PHASE"))
    tokens = T.image_type_tokens(_col(df, "ImageType").cast("string"))
    found = F.filter(F.array(*(F.when(F.size(F.array_intersect(tokens, F.array(*map(F.lit, names)))) > 0, F.lit(kind)) for kind, names in DIXON_TOKENS.items())), lambda x: x.isNotNull())
    by_type = F.when(F.size(found) == 1, F.element_at(found, 1)).when(F.size(found) > 1, "UNKNOWN")
    return F.when(by_text.isNull(), by_type).when(by_type.isNull() | (by_text == by_type), by_text).otherwise("UNKNOWN")


def score_mr(df: DataFrame, phase: str = "phase", source_priority: Mapping[str, float] | None = None, dixon_priority: Mapping[str, float] | None = None) -> DataFrame:
    """selection_slot and selection_score by sequence; the priorities of sources and components are parameters."""
    yes = lambda name, a: F.when(F.col(name), float(a)).otherwise(0.0)
    label = T.label_or_other(F.col(phase))
    plane = _scores(F.col("plane"), PLANE_SCORE, 30)
    common = yes("is_resp_triggered", 8) + yes("is_breath_hold", 5) + yes("is_mip_mpr", -100)
    t1 = _scores(label, MR_PRIORITY, 0) + (P.selection_bonus(df) if "phase_status" in df.columns else F.lit(0)) + _scores(F.col("mri_perfusion_source"), source_priority or {}, 0) + plane + yes("is_3d_gre", 25)
    t1 += F.when(F.col("is_dynamic_t1_text") & (F.col("mri_perfusion_source") == "explicit_text"), 5.0).otherwise(0.0)
    t1 += _scores(F.col("dixon_component"), dixon_priority or {}, 0) + common + yes("is_subtraction", -150) + yes("is_quant_or_report", -200)
    t2 = plane + yes("is_t2_fatsat", 35) + _scores(F.col("mri_t2_acquisition_family"), {"multi_shot": 20, "single_shot": 10}, 0) + common + yes("is_t2_mrcp_biliary", -60) + yes("is_quant_or_report", -150)
    dwi = 70 + F.when(F.col("plane") == "AXIAL", 10.0).otherwise(0.0) + 10 + yes("is_mip_mpr", -50)
    seq = F.col("mri_sequence")
    return df.withColumns({
        "selection_slot": F.when(seq.isin("T2", "DWI"), seq).when(seq == "T1", F.concat(F.lit("T1_"), label)).otherwise("OTHER"),
        "selection_score": F.when(seq == "T1", t1).when(seq == "T2", t2).when(seq == "DWI", dwi).cast("double"),
    })


def preferred_delay(phase: Column, evidence: Column, elapsed: Column) -> Column:
    """Whether a delayed volume is 300 to 600 s after injection, by its text, else by elapsed time."""
    found = F.array_distinct(durations(evidence))
    by_text = F.when(F.size(found) > 0, (F.size(found) == 1) & F.get(found, F.lit(0)).between(300, 600))
    return F.coalesce((phase == "DELAYED") & F.coalesce(by_text, elapsed.between(300, 600)), F.lit(False))


def tie_breakers(df: DataFrame) -> DataFrame:
    """Adds what decides between MR volumes: whether a delayed one is in the preferred window, rows, thickness, extent along z, volume, time."""
    rows, thickness = F.coalesce(number(_col(df, "n_rows_in_volume")), number(_col(df, "n_files"))), number(_col(df, "SliceThickness"))
    inside = preferred_delay(_col(df, "phase"), _col(df, "_evidence").cast("string"), number(_col(df, "elapsed")))
    area = spacing(_col(df, "PixelSpacing").cast("string"))["area"]
    df = df.withColumns({"delay_preferred": inside, "rows_in_volume": rows, "slice_thickness": thickness, "z_coverage": rows * thickness, "time_seconds": number(_col(df, "time"))})
    return df.withColumn("volume_mm3", F.col("z_coverage") * area)


def mr_order() -> list[Column]:
    """MR candidates, best first: preferred delay, score, volume, thin slices, extent, rows, early ones. Unknown values come last."""
    down = lambda c: F.desc_nulls_last(c)
    return [down("delay_preferred"), down("selection_score"), down("volume_mm3"), F.asc_nulls_last("slice_thickness"), down("z_coverage"), down("rows_in_volume"), F.asc_nulls_last("time_seconds")]


def select(df: DataFrame, exam: Sequence[str], slots: Sequence[str], volume: str, order: Sequence[Column] | None = None, least: float = -500.0) -> tuple[DataFrame, DataFrame]:
    """Ranked candidates of the slots, and one wide row per exam with each slot's winner and the other candidates. Best first by `order` (by score, if not given), then by volume."""
    # the test is a column, kept above the window: as a filter it would be pushed down and compute the scores twice
    ok = df.withColumn("_ok", F.coalesce(F.col("selection_slot").isin(*slots) & (F.col("selection_score") > least), F.lit(False)))
    by = W.partitionBy(*exam, "selection_slot").orderBy(F.desc("_ok"), *(order or [F.desc("selection_score")]), volume)
    ranked = ok.withColumn("candidate_rank", F.when(F.col("_ok"), F.row_number().over(by))).filter("candidate_rank is not null").drop("_ok")
    return ranked, wide(ranked, exam, "selection_slot", slots, F.col(volume), "candidate_rank", F.concat(F.col(volume).cast("string"), F.lit(" ("), F.format_string("%.1f", "selection_score"), F.lit(")")))


def share_labels(df: DataFrame, acquisition: Sequence[str], label: str, authoritative: Column, guards: Sequence[str]) -> DataFrame:
    """Rows of one acquisition without a label take its one authoritative label if all guard columns agree."""
    w = W.partitionBy(*acquisition)
    anchor = F.when(authoritative, F.col(label))
    same = F.lit(True)
    for g in guards:
        same = same & F.coalesce(F.min(g).over(w) == F.max(g).over(w), F.lit(True))
    one = (F.min(anchor).over(w) == F.max(anchor).over(w)) & same
    return df.withColumn(label, F.when(F.col(label).isNull() & one, F.min(anchor).over(w)).otherwise(F.col(label)))


def missing_native(df: DataFrame, group: Sequence[str], acquisition: str, phase: str, candidate: Column, quality: Sequence[Column], least: int = 2) -> DataFrame:
    """In groups with enough distinct acquisitions and no native phase the best candidate becomes native."""
    w = W.partitionBy(*group)
    has = F.max((F.coalesce(F.col(phase), F.lit("")) == "NATIVE").cast("int")).over(w) == 1
    enough = F.size(F.collect_set(acquisition).over(w)) >= least
    first = F.row_number().over(w.orderBy(F.desc(F.coalesce(candidate, F.lit(False))), *quality)) == 1
    return df.withColumn(phase, F.when(~has & enough & first & F.coalesce(candidate, F.lit(False)), "NATIVE").otherwise(F.col(phase)))


def pure_post(text: Column) -> Column:
    """A text that says after contrast, and nothing of before. The name of an agent alone says neither."""
    native = F.coalesce(text.rlike(T.token(MR_TERMS.native)), F.lit(False))
    return P.post_contrast(text) & ~native & ~P.mixed(text, MR_TERMS)


def pre_post_native(df: DataFrame, group: Sequence[str], text: str, phase: str, orders: Sequence[str]) -> DataFrame:
    """In groups with a text that says both before and after contrast, the first acquisition (ties are all first) becomes native.

    Not if a first one has another phase, or a purely post-contrast text. Explicit phases of other rows stay.
    """
    c = F.coalesce(F.col(text), F.lit(""))
    df = df.withColumns({"_mixed": P.mixed(c, MR_TERMS).cast("int"), "_post": pure_post(c).cast("int")})
    df = first_acquisition(df, group, orders)
    w = W.partitionBy(*group)
    label = T.label_or_other(F.col(phase))
    wrong = F.max((F.col("is_first") & (~label.isin("OTHER", "NATIVE") | (F.col("_post") == 1))).cast("int")).over(w) == 1
    hit = F.col("is_first") & (F.max("_mixed").over(w) == 1) & ~wrong
    return df.withColumn("_hit", hit).withColumn(phase, F.when(F.col("_hit"), "NATIVE").otherwise(F.col(phase))).drop("_mixed", "_post", "_hit", "is_first")


#: The order of phases after injection, for the fold.
TEMPLATE = ("NATIVE", "ARTERIAL", "PORTAL_VENOUS", "DELAYED")


def fold_phases(df: DataFrame, group: Sequence[str], order: str, known: str, elapsed: str) -> DataFrame:
    """Rows of a group in order: known phases are anchors; others take the next phase of the template that is later than the

    one before, allowed by their elapsed time, and not beyond the next anchor. A group is one exam's dynamic series (a few volumes): its rows are
    listed, folded and dealt out again, without a join, so rows dealt by a part of the group's key stay where they are.
    """
    place = F.array_position(F.array(*map(F.lit, TEMPLATE)), F.col(known))
    w = W.partitionBy(*group).orderBy(order)
    bound = F.min(F.when(place > 0, place)).over(w.rowsBetween(1, W.unboundedFollowing))
    rows = df.withColumns({"_place": F.nullif(place, F.lit(0)).cast("int"), "_bound": F.coalesce(bound.cast("int"), F.lit(5))})
    listed = rows.groupBy(*group).agg(F.collect_list(F.struct(*(F.col(f"`{c}`") for c in rows.columns if c not in group))).alias("_rows"))
    given = F.transform("_rows", lambda x, i: F.struct(x[order].alias("at"), i.alias("i"), x["_place"].alias("place"), x["_bound"].alias("bound"), x[elapsed].alias("sec")))
    items = F.array_sort(F.filter(given, lambda x: x["at"].isNotNull()))  # a row without a place is no step
    without = F.transform(F.filter(given, lambda x: x["at"].isNull()), lambda x: F.struct(x["i"].alias("i"), F.lit(None).cast("int").alias("phase")))
    zero = F.struct(F.lit(0).alias("last"), F.array().cast("array<struct<i:int,phase:int>>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        nxt = acc["last"] + 1
        sec = x["sec"]
        timed = F.lit(None).cast("int")
        for i, name in enumerate(TEMPLATE, 1):
            if name in P.WINDOWS:
                timed = F.when(sec.between(*P.WINDOWS[name]), i).otherwise(timed)
        guess = F.when(timed >= nxt, timed).when(sec.isNull() | (acc["last"] == 0), nxt)
        got = F.coalesce(x["place"], F.when((guess < x["bound"]) & (guess <= len(TEMPLATE)), guess))
        return F.struct(F.coalesce(got, acc["last"]).cast("int").alias("last"), F.concat(acc["out"], F.array(F.struct(x["i"].alias("i"), got.cast("int").alias("phase")))).alias("out"))

    phases = F.array_sort(F.concat(F.aggregate(items, zero, step, lambda acc: acc["out"]), without))
    flat = listed.select(*group, F.explode(F.arrays_zip(F.col("_rows").alias("row"), phases.alias("found"))).alias("_x"))
    whole = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in group))  # null keys are equal to none
    folded = F.when(whole, F.try_element_at(F.array(*map(F.lit, TEMPLATE)), F.col("_x.found.phase")))
    return flat.select(*(c if c in group else F.col(f"_x.row.`{c}`").alias(c) for c in df.columns), folded.alias("folded_phase"))
