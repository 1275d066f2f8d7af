"""Text normalisation and whole-token vocabulary tests as Column expressions."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed: accented letters and what stands for them in normalised text.
ACCENTED = "àâäáãåéèêëíìîïóòôöõúùûüçñÿ"
PLAIN = "aaaaaaeeeeiiiiooooouuuucny"

#: Fixed: vocabulary as regular expressions; SEP stands for optional separators. Names are whole terms, case does not matter.
SEP = r"[\s_.+\-/]*"
INJECTION = r"inj(?:ect(?:ed|ion|e|ee|é|ée)?)?|iv"
CONTRAST = rf"contrast(?:ed|[eé]e?)?|c\+|pdc|pdc\+|pdc{SEP}enhanced|enhanced"
ARTERIAL = r"art(?:erial|[eé]riel(?:le)?)?"
VOCABULARY = {
    "localizer": rf"loc|loca|locali[sz]er|scout|scouts|survey|topogram|tomogramme|surview|rep[eéè]rage|calibration|cal{SEP}body|test|phantom|dummy",
    "key_images": rf"key{SEP}(?:images?|objects?)|key{SEP}object{SEP}selection|ko|kos|kin|kon|snapshot|screen(?:{SEP}saves?)?|capture|processed(?:{SEP}images?)?|images?{SEP}cl[eé]s?|objets?{SEP}cl[eé]s?",
    "subtraction": r"s?sub(?:traction)?|s?soustr(?:ac|a)tion|s?sous",
    "mip_mpr": rf"mip|minip|mpr|vr|vrt|volume{SEP}render(?:ing|ed)?|reformat(?:ted)?|multiplanar{SEP}reconstruction|recon(?:struction)?",
    "quantitative": rf"quant|carto|maps?|mapping|reports?|results?|reading|histo|iron{SEP}reports?|elasto|error|dose(?:{SEP}reports?)?",
    "axial": r"ax|axi|axial(?:e)?|tra|trans|transvers(?:e|al(?:e)?)",
    "coronal": r"cor|coro|coronal(?:e)?|ecor",
    "sagittal": r"sag|sagi|sagittal(?:e)?",
    "breath_hold": rf"bh|mbh|apn[eé]e|breath{SEP}hold",
    "respiratory": rf"pace|trigger(?:ed)?|resp(?:i)?|rtr|rt|nav(?:igator)?|respiratory{SEP}(?:trigger(?:ed)?|gat(?:ed|ing))",
    "native": (
        rf"native|natif|un{SEP}enhanced|non{SEP}enhanced|pr[eé](?:{SEP}(?:{CONTRAST}|{INJECTION}))?|avant(?:{SEP}(?:{INJECTION}))?|sans(?:{SEP}(?:iv|{INJECTION}|{CONTRAST}))?"
        rf"|without{SEP}(?:{CONTRAST}|{INJECTION})|non{SEP}(?:{INJECTION}|{CONTRAST})|wo{SEP}(?:{INJECTION}|{CONTRAST})|ss{SEP}(?:iv|i)|si|siv|spc|blanc|c-|w/o(?:{SEP}(?:{INJECTION}|{CONTRAST}))?|wo|w/o"
    ),
    "arterial": rf"{ARTERIAL}|artery|aort(?:e|ic|ique)|hepatic{SEP}arter(?:y|ial)?|(?:early|late|multi){SEP}{ARTERIAL}|ta",
    "portal": rf"port(?:al(?:e)?|o)?|porte|porto{SEP}venous|portal{SEP}venous|vein(?:e)?|venous|veneux|veineux|veineuse|vx|vp|pv|phase{SEP}p",
    "delayed": rf"tard(?:if|ive)?|delay(?:ed)?|d[eé]lai|late|equilibrium|[eé]quilibre|eq|interstit(?:iel|ial)|phase{SEP}d",
    "post_contrast": rf"post(?:{SEP}(?:{CONTRAST}|{INJECTION}))?|avec(?:{SEP}(?:{CONTRAST}|{INJECTION}))?|with(?:{SEP}(?:{CONTRAST}|{INJECTION}))?|w(?:{SEP}(?:{CONTRAST}|{INJECTION}))?|{CONTRAST}|{INJECTION}|enhanced|c\+|\+c",
    "dynamic": rf"dyn(?:amic|amique)?|dce|dsc|pwi|perf(?:usion)?|multi{SEP}phas(?:e|ic|ique)|mph|m{SEP}ph|ph{SEP}\d+|4d|multi{SEP}{ARTERIAL}|bolus|time{SEP}resolved",
    "bolus_monitoring": rf"smart{SEP}prep|bolus{SEP}(?:monitor(?:ing)?|track(?:ing)?)|monitoring",
    "original": "original",
    "primary": "primary",
}
#: Fixed: a numbered phase; its first group is the number.
ORDINAL = rf"ph(?:ase)?{SEP}([1-9]\d*)(?!\d)"
VOCABULARY["derived"] = "|".join(VOCABULARY[n] for n in ("key_images", "subtraction", "mip_mpr", "quantitative"))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value evaluated once for a row, however often `use` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def token(*patterns: str) -> str:
    """A whole term in any case; letters and digits of any script are inside a term, underscores are not."""
    return rf"(?iu)(?<![\p{{L}}\p{{N}}])(?:{'|'.join(patterns)})(?![\p{{L}}\p{{N}}])"


def has(text: Column, name: str) -> Column:
    return F.coalesce(text.rlike(token(VOCABULARY[name])), F.lit(False))


def uniform(c: Column) -> Column:
    """Lower-cased ASCII with single spaces; first the characters . and 0 are stripped from the right end; null is empty."""
    s = F.rtrim(F.coalesce(c.cast("string"), F.lit("")), F.lit(".0"))
    return F.translate(F.lower(F.trim(F.regexp_replace(s, r"\s+", " "))), ACCENTED, PLAIN)


def clean(c: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), r"\s+", " ")))


def label(c: Column) -> Column:
    """Upper case, runs of anything but A-Z and 0-9 as one underscore, none at the ends; blank is null."""
    s = F.regexp_replace(F.regexp_replace(F.upper(F.trim(c.cast("string"))), "[^A-Z0-9]+", "_"), "^_+|_+$", "")
    return F.nullif(s, F.lit(""))


def label_or_other(c: Column) -> Column:
    return F.coalesce(F.nullif(F.upper(F.trim(c.cast("string"))), F.lit("")), F.lit("OTHER"))


def modality(c: Column) -> Column:
    up = F.upper(F.trim(c))
    return F.when(up == "MRI", "MR").otherwise(up)


def plane(text: Column) -> Column:
    return F.when(has(text, "axial"), "AXIAL").when(has(text, "coronal"), "CORONAL").when(has(text, "sagittal"), "SAGITTAL")


def first_with(columns: Mapping[str, Column], evidence) -> Column:
    """(column, text) of the first column in order whose text has evidence; later ones are ignored, texts are never joined."""
    return F.coalesce(*(F.when(F.coalesce(evidence(c), F.lit(False)), F.struct(F.lit(n).alias("column"), c.cast("string").alias("text"))) for n, c in columns.items()))


def series_text(columns: Sequence[Column]) -> Column:
    return F.concat_ws(" | ", *(F.nullif(F.trim(c.cast("string")), F.lit("")) for c in columns))


def ordinal(text: Column) -> Column:
    """The number of `Ph 2`, `phase_3`."""
    return F.regexp_extract(text, token(ORDINAL), 1).try_cast("int")


def image_type_tokens(c: Column) -> Column:
    parts = F.split(F.regexp_replace(c, r"[\[\]'\"()]", ""), r"[\\,;]+")
    up = F.transform(parts, lambda x: F.regexp_replace(F.upper(F.trim(x)), r"[\s-]+", "_"))
    return F.filter(up, lambda x: x != "")


def display(c: Column, width: int = 40) -> Column:
    s = F.regexp_replace(c.cast("string"), r"\n", " ")
    return F.when(F.length(s) > width, F.concat(F.substring(s, 1, width), F.lit("…"))).otherwise(s)


def mask_name(c: Column) -> Column:
    """`mask_x_path`, `x.nii.gz`, `mask_x` as `x`; names with separators or dots are null."""
    s = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.trim(c), r"\.nii(\.gz)?$", ""), r"_path$", ""), "^mask_", "")
    return F.when((s != "") & ~s.rlike(r"[/\\.]"), s)


def safe_member(c: Column) -> Column:
    """A relative name inside an archive: forward slashes, no drive, no root, no `..`; others are null."""
    s = F.regexp_replace(F.regexp_replace(c, r"\\", "/"), r"^(\./)+", "")
    ok = (s != "") & ~s.startswith("/") & ~s.rlike("^[A-Za-z]:") & F.forall(F.split(s, "/"), lambda p: p != "..")
    return F.when(ok, s)


def path_component(c: Column) -> Column:
    s = F.regexp_replace(F.url_encode(c.cast("string")), r"\+", "%20")
    return F.when(s.isin(".", ".."), F.regexp_replace(s, r"\.", "%2E")).otherwise(s)


def digits_key(c: Column) -> Column:
    """All digit runs without leading zeros, joined by -; a text without digits stays."""
    runs = F.regexp_extract_all(c, F.lit(r"(\d+)"), 1)
    short = F.transform(runs, lambda t: F.when(F.ltrim(t, F.lit("0")) == "", "0").otherwise(F.ltrim(t, F.lit("0"))))
    return F.when(F.size(runs) > 0, F.array_join(short, "-")).otherwise(c)


def path_part(c: Column, k: int, deeper_than: int) -> Column:
    """The k-th part of a path (from 0) if it has more than so many; slashes of either kind."""
    parts = F.filter(F.split(F.regexp_replace(c, r"\\", "/"), "/"), lambda p: p != "")
    return F.when(F.size(parts) > deeper_than, F.try_element_at(parts, F.lit(k + 1)))


def first_text(*columns: Column) -> Column:
    return F.coalesce(*(F.nullif(F.trim(c.cast("string")), F.lit("")) for c in columns))


def group_label(columns: Mapping[str, Column]) -> Column:
    return F.concat_ws(", ", *(F.when(F.trim(c.cast("string")) != "", F.concat(F.lit(f"{n}="), F.trim(c.cast("string")))) for n, c in columns.items()))
