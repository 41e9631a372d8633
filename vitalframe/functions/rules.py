"""Rule tables and their compiler to Spark expressions.

A label family is: include patterns (all must match), an exclude pattern,
rewrites applied in order (each sees the label left by the one before;
a rewrite fires when all of its patterns match and its ``unless`` pattern, if
any, does not), and optional final keep and drop patterns. ``normalise_labels`` evaluates every family on each row in ONE
projection and explodes the surviving results: one scan, however many
families, and a row that passes several families yields several rows (as the
reference's union of per-family subsets does).
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalframe.functions.scalar import strip_bounds


@dataclass(frozen=True)
class Family:
    include: tuple[str, ...]
    exclude: str | None = None
    rewrites: tuple[tuple, ...] = ()  # (patterns, new label) or (patterns, new label, unless)
    keep: str | None = None
    drop: str | None = None
    name: str = ""


def _all_detect(label: Column, patterns: Sequence[str]) -> Column:
    cond = F.lit(True)
    for p in patterns:
        cond = cond & label.rlike(p)
    return cond


def family_label(label: Column, fam: Family) -> Column:
    """The family's normalised label, or NULL when the row is not in the family."""
    out = label
    for pats, new, *unless in fam.rewrites:
        hit = _all_detect(out, pats)
        for p in unless:
            hit = hit & ~out.rlike(p)
        out = F.when(hit, F.lit(new)).otherwise(out)
    ok = _all_detect(label, fam.include)
    if fam.exclude:
        ok = ok & ~label.rlike(fam.exclude)
    if fam.keep:
        ok = ok & out.rlike(fam.keep)
    if fam.drop:
        ok = ok & ~out.rlike(fam.drop)
    return F.when(F.coalesce(ok, F.lit(False)), out)


def normalise_labels(df: DataFrame, families: Sequence[Family], label: str = "label",
                     out: str = "measure") -> DataFrame:
    lab = F.col(label)
    arr = F.array(*[family_label(lab, f) for f in families])
    x = df.withColumn("_labels", F.filter(arr, lambda v: v.isNotNull()))
    return x.withColumn(out, F.explode("_labels")).drop("_labels")


def rewrite(c: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """``gsub`` chain: regex replacements applied in order."""
    for pattern, repl in rules:
        c = F.regexp_replace(c, pattern, repl)
    return c


def classify(rules: Sequence[tuple[Column | str, str, str]], default: str | None) -> Column:
    """First matching (column, regex, class) rule wins; NULL inputs never match."""
    expr = None
    for c, pattern, cls in rules:
        cc = F.col(c) if isinstance(c, str) else c
        cond = F.coalesce(cc.rlike(pattern), F.lit(False))
        expr = F.when(cond, F.lit(cls)) if expr is None else expr.when(cond, F.lit(cls))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def map_values(c: Column | str, mapping: dict, default=None) -> Column:
    cc = F.col(c) if isinstance(c, str) else c
    expr = None
    for k, v in mapping.items():
        expr = F.when(cc == F.lit(k), F.lit(v)) if expr is None else expr.when(cc == F.lit(k), F.lit(v))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


# ---------------------------------------------------------------------------
# Fixed values (must equal the reference for equal results)
# ---------------------------------------------------------------------------

# MIMIC chart labels -> vital measures, one family per group
MIMIC_VITAL_FAMILIES = (
    Family(("Heart|Respi|SpO2|O2 saturation|Resp Rate",),
           "Alarm|Rhythm|Sound|Pattern|Set|Effort|PAR-|Desat",
           ((("Heart",), "HF"), (("Resp", "Total"), "Freq gesamt"), (("Resp", "spontan"), "Freq spontan"),
            (("Resp", "Rate"), "AF"), (("O2 saturation",), "SpO2")), name="heart_resp"),
    Family(("Arterial", "BP|Pressure"), "Alarm|CO2|IABP",
           ((("Arterial", "Systolic|syst"), "syst"), (("Arterial", "Diast|diast"), "diast"),
            (("Arterial", "Mean|mean"), "mittl")), name="arterial"),
    Family(("Intra Cra|ICP|Cereb|CPP",), "Line|Alarm|-ventr",
           ((("Intra", "Press"), "ICP"), (("Cereb", "Press"), "CPP")), keep="^(ICP|CPP)$", name="icp_cpp"),
    Family(("Airway|Peak|Inspired|PEEP", "Pressure|Fract|PEEP"), "Cuff|Auto|Total",
           ((("PEEP",), "PEEP"), (("Mean", "Press"), "Pmean"), (("Peak", "Press"), "Ppeak"),
            (("Insp", "O2"), "FiO2")), name="airway"),
    Family(("GCS|Eye|Verba|Motor Res|Total",), "Level|Care|Rate",
           ((("Eye",), "GCS_auge"), (("Verb",), "GCS_verbal"), (("Motor",), "GCS_motor"),
            (("GCS", "Total"), "GCS_total")), keep="GCS", name="gcs"),
    Family(("Temperature C|NBP|Non Invasive Blood",), "CCO|Alarm",
           ((("Temp",), "Temp"), (("NBP|Non", "mean|Mean"), "mittl_NBD"), (("NBP|Non", "syst|Syst"), "syst_NBD"),
            (("NBP|Non", "diast|Diast"), "diast_NBD")), name="temp_nbp"),
    Family(("Minute Volume|Volum|Tida|Insp",), "High|Alarm|Stroke|Lumen|Gas|O2",
           ((("Minute",), "AMV total"), (("Tidal", "Volume"), "AZV"), (("Insp", "Time"), "t insp"),
            (("Insp", "Ratio"), "I_E")), keep="AZV|AMV|t insp|I_E", name="ventilation"),
    Family(("RAS|Pup",), None,
           ((("Resp", "Right"), "Lichtreaktion re"), (("Resp", "Left"), "Lichtreaktion li"),
            (("Size", "Right"), "Pupille re"), (("Size", "Left"), "Pupille li"),
            (("Goal",), "RASS_Ziel"), (("RAS",), "RASS", "Ziel")), drop="Pupils", name="rass_pupils"),
)

# blood-gas analytes: include list, then renames in order
BGA_INCLUDE = ("Glucose", "pH", "Sodium", "Potassium", "Hemoglobin", "Chloride", "Base Excess", "pCO2", "pO2",
               "Bicarbonate", "Anion Gap", "Carbox", "Calcium", "Lac", "Bili", "Oxygen")
BGA_RENAMES_1 = (("Base Excess", "SBE"), ("Calcium, Total", "Ca"), ("Oxygen Saturation", "sO2"),
                 ("Anion Gap", "Anionen_Lücke"))
BGA_RENAMES_2 = (("Carboxyhemoglobin", "FCOHb"), ("Bilirubin", "Bili"), ("Potassium", "K"), ("Sodium", "Na"),
                 ("pCO2", "PCO2"), ("pO2", "PO2"), ("Oxygen Saturation", "sO2"), ("Oxygen", "FO2"),
                 ("Chloride", "Cl"), ("Glucose", "Glu"), ("Hemoglobin", "Hb_BGA"), ("Bicarbonate", "HCO3"),
                 ("Lactate", "Lac"))

# drug keyword lists and the order in which classes are tried (first match wins)
DRUG_KEYWORDS = {
    "Opioid": ("Fent", "fent", "Morph", "morph", "Code", "Codein", "Dilaudid"),
    "Benzodiazepin": ("Lora", "Mida", "mida", "lora", "Ativa"),
    "Katecholamin": ("Neosynephrine", "Norep", "Phenylephrine", "Epineph", "Dopamin", "Dobuta"),
    "Calcium Blocker": ("Nicard",),
    "Alpha Blocker": ("Clonid", "Labet", "Dexmed"),
    "Direkter Vasodilatator": ("Dihydral", "Nitro", "nitro", "Apresoline", "apresol"),
    "Barbiturat": ("Pentobarb", "Allonal", "Amytal Sodium", "Brevital", "Butabarb", "Butalan", "Buticaps",
                   "Butisol Sodium", "Luminal", "Mebaral", "Mephyltaletten", "Nembutal", "Nembutal Sodium",
                   "Oramon", "Pentothal", "Phemiton", "Prominal", "Sarisol", "Seconal", "Somnifaine",
                   "Surital", "Brevi", "Metho"),
    "Narkotikum": ("Propo", "Ketam"),
}
DRUG_CLASS_ORDER = ("Narkotikum", "Opioid", "Benzodiazepin", "Katecholamin", "Alpha Blocker",
                    "Calcium Blocker", "Direkter Vasodilatator", "Barbiturat")
DRUG_CLASS_DEFAULT = "NaN"
# eICU adds one catecholamine keyword
EICU_EXTRA_KEYWORDS = {"Katecholamin": ("ephrine",)}

# rate-unit and drug-name clean-up (in order)
RATE_UNIT_RULES = (("/", ""), ("hour", "hr"))
DRUG_NAME_RULES = (("Labetalol", "Labetolol"), ("Pentobarbitol", "Pentobarbital"), ("-k", ""))

# MIMIC diagnosis: (column, regex, class), first match wins, code and title rules interleaved
MIMIC_DIAGNOSIS_RULES = (
    ("code", "^433|^434", "Stroke"), ("title", "CV|Crbl", "Stroke"),
    ("code", "^80", "TBI"), ("title", "Traum|scalp|contus", "TBI"),
    ("code", "^430", "SAH"), ("title", "Subarach", "SAH"),
    ("code", "^431|^432", "ICH"), ("title", "Subdural|Brain hem", "ICH"),
    ("code", "^19", "Tumor"), ("title", "Tumor|neoplasm|Ben neo|neo brain|Benign neo", "Tumor"),
)
MIMIC_DIAGNOSIS_DEFAULT = "MISC"
# priority when a stay has several diagnoses (lowest first); unlisted classes get 1
MIMIC_DIAGNOSIS_PRIORITY = {"SAH": 2, "ICH": 4, "Stroke": 3, "TBI": 1, "MISC": 5}
MIMIC_DIAGNOSIS_PRIORITY_DEFAULT = 1

# eICU free-text admission diagnosis, first match wins
EICU_DIAGNOSIS_RULES = (
    ("text", "stroke", "Stroke"), ("text", "trauma|Trauma", "TBI"), ("text", "hematoma", "ICH"),
    ("text", "Subarachnoid", "SAB"), ("text", "subdural", "SDH"), ("text", "Neoplasm|tumor|Tumor", "Tumor"),
    ("text", "Sepsis|sepsis", "Sepsis"), ("text", "aortic|Aortic|myocardial", "Aorta"),
)
EICU_DIAGNOSIS_DEFAULT = "other"
EICU_DIAGNOSIS_REMAP = {"SAB": "SAH", "SDH": "ICH", "Sepsis": "MISC", "Aorta": "MISC", "other": "MISC"}
DIAGNOSIS_CODES = {"Stroke": 1, "TBI": 2, "SAH": 3, "ICH": 4, "Tumor": 5, "MISC": 6}

# lab unit conversions: (label regex, unit regex or None, factor), applied in order;
# a NULL unit never matches (base grepl)
UNIT_CONVERSIONS = (
    ("CRP", "/dL|/dl", 10.0),
    ("Albumin|Eiweiß|Fibrin", "/dL|/dl", 10.0),
    ("Albumin|Eiweiß|Fibrin", "mg|mG|MG", 1.0 / 1000.0),
    ("Magnesium", None, 0.441),
    ("Phosphat", None, 0.323),
)

# labels that only name the measure after conversion
UNIT_RELABELS = (("CRP", "CRP"),)
EICU_UNIT_CONVERSIONS = tuple((lab, unit.replace("MG", "MG|Mg") if unit else None, factor)
                              for lab, unit, factor in UNIT_CONVERSIONS)

# cross-source label patches applied before sources are unioned
# (a label containing the pattern becomes the new label), in order
LABEL_PATCHES = (("AST", "AST"), ("ALT", "ALT"), ("Alk", "Alk"), ("Tropo", "Troponin"),
                 ("pankreas", "pankreasspez"), ("Phospha", "Phosphat"), ("FO2", "FiO2"))

# early-time guards (minutes): (label regex, lowest kept rel_time)
# vitals: only GCS components; labs and blood gases: all rows; drugs: all rows
EARLY_TIME_GUARDS_MIMIC_VITAL = (("auge|motor|verbal", -300),)
EARLY_TIME_GUARDS_EICU_VITAL = (("auge|motor|verbal|total", -300),)
EARLY_TIME_GUARDS_LAB = ((".", -300),)
EARLY_TIME_GUARDS_DRUG = ((".", -200),)


def drug_class(label: Column | str, keywords: dict | None = None) -> Column:
    """Drug class by keyword, classes tried in the fixed order."""
    kw = dict(DRUG_KEYWORDS)
    for k, extra in (keywords or {}).items():
        kw[k] = tuple(kw.get(k, ())) + tuple(extra)
    rules = [(label, "|".join(kw[c]), c) for c in DRUG_CLASS_ORDER]
    return classify(rules, DRUG_CLASS_DEFAULT)


def any_keyword(label: Column | str) -> Column:
    """Row is a drug of any of the listed classes (one alternation, one regex)."""
    c = F.col(label) if isinstance(label, str) else label
    pattern = "|".join(k for c_ in DRUG_CLASS_ORDER for k in DRUG_KEYWORDS[c_])
    return F.coalesce(c.rlike(pattern), F.lit(False))


def convert_units(df: DataFrame, label: str = "measure", unit: str = "unit", value: str = "value",
                  rules: Sequence[tuple[str, str | None, float]] = UNIT_CONVERSIONS,
                  relabel: Sequence[tuple[str, str]] = UNIT_RELABELS) -> DataFrame:
    """Apply unit conversions, then relabels, as one projection (no split/transform/union)."""
    v = F.col(value)
    lab, u = F.col(label), F.col(unit)
    for lab_re, unit_re, factor in rules:
        hit = F.coalesce(lab.rlike(lab_re), F.lit(False))
        if unit_re is not None:
            hit = hit & F.coalesce(u.rlike(unit_re), F.lit(False))
        v = F.when(hit, v * F.lit(factor)).otherwise(v)
    return df.withColumns({value: v, label: patch_labels(lab, relabel)})


def convert_units_eicu(df: DataFrame, label: str = "measure", unit: str = "unit", value: str = "value",
                       text: str = "value_text", drop_measures: str | None = None) -> DataFrame:
    """The second source's variant: CRP is read from the text result without its
    bounds, and milligrams may be written ``Mg``. Labels matching ``drop_measures``
    are left out (the reference loses protein and fibrinogen rows here)."""
    lab = F.col(label)
    crp = F.coalesce(lab.rlike("CRP"), F.lit(False))
    x = df.withColumn(value, F.when(crp, strip_bounds(text)).otherwise(F.col(value)))
    if drop_measures:
        x = x.filter(~F.coalesce(lab.rlike(drop_measures), F.lit(False)))
    return convert_units(x, label, unit, value, EICU_UNIT_CONVERSIONS)


def patch_labels(c: Column | str, patches: Sequence[tuple[str, str]] = LABEL_PATCHES) -> Column:
    """Relabel: a label matching a patch pattern becomes that patch's label (in order).

    One flat case expression: what later patches make of a new label is known beforehand, so no step repeats the one before it."""
    old = F.col(c) if isinstance(c, str) else c
    out = None
    for i, (pattern, new) in enumerate(patches):
        for later, newer in patches[i + 1:]:
            new = newer if re.search(later, new) else new
        out = (F.when if out is None else out.when)(old.rlike(pattern), F.lit(new))
    return old if out is None else out.otherwise(old)


@dataclass(frozen=True)
class RenameList:
    """A label list: keep labels containing any ``include`` keyword, drop those
    matching ``exclude`` (before renaming), rename (regex replacements in
    order), drop those matching ``exclude_after``, rename again; optionally
    require a numeric value."""
    include: tuple[str, ...]
    renames: tuple[tuple[str, str], ...] = ()
    exclude: str | None = None
    exclude_after: str | None = None
    renames_after: tuple[tuple[str, str], ...] = ()
    require_value: bool = False


def rename_list_label(label: Column, rl: RenameList, value: Column | None = None) -> Column:
    """The list's normalised label, or NULL when the row is not in the list."""
    ok = F.coalesce(label.rlike("|".join(rl.include)), F.lit(False))
    if rl.exclude:
        ok = ok & ~F.coalesce(label.rlike(rl.exclude), F.lit(False))
    mid = rewrite(label, rl.renames)
    if rl.exclude_after:
        ok = ok & ~F.coalesce(mid.rlike(rl.exclude_after), F.lit(False))
    if rl.require_value and value is not None:
        ok = ok & value.isNotNull()
    return F.when(ok, rewrite(mid, rl.renames_after))


def rename_lists(df: DataFrame, lists: Sequence[RenameList], label: str = "label", out: str = "measure",
                 value: str | None = None) -> DataFrame:
    """Apply several label lists in ONE pass; a row in two lists yields two
    rows (the reference unions the per-list subsets)."""
    v = F.col(value) if value else None
    arr = F.array(*[rename_list_label(F.col(label), rl, v) for rl in lists])
    return df.withColumn(out, F.explode(F.filter(arr, lambda x: x.isNotNull())))


# ---- fixed values: laboratory and blood-gas label lists ----------------------
MIMIC_BGA = RenameList(BGA_INCLUDE, BGA_RENAMES_1, exclude_after=" ", renames_after=BGA_RENAMES_2)

MIMIC_LAB_1 = RenameList(
    ("MC", "Hct", "RBC", "RDW", "WBC", "INR", "PTT", "Baso", "Chole", "Eos", "Fibri", "Mono", "Lymphs", "Polys",
     "Amyl", "Phosph", "Plat", "Thy", "Leuk"),
    (("Fibrinogen, Functional", "Fibrinogen"), ("Cholesterol, Total", "Cholesterin"),
     ("Thyroid Stimulating Hormone", "TSH"), ("Platelet Count", "Thrombocyten")),
    exclude_after=" |7|NRBC|siderin|Thy", require_value=True,
    renames_after=((r"INR\(PT\)", "INR"), ("WBC", "Leukocyten"), ("RBC", "Erythrocyten"), ("Basophils", "Basophile"),
                   ("Eosinophils", "Eosinophile"), ("Lymphs", "Lymphocyten"), ("RDW", "EVB"),
                   ("fibrinogen", "Fibrinogen"), ("PTT", "aPTT"), ("Hct", "Hk"), ("Monocytes", "Monocyten"),
                   ("Monos", "Monocyten"), ("Polys", "Neutrophile"), ("Amylase", "pankreasspez"),
                   ("Phosphate", "Phosphat")))

MIMIC_LAB_2 = RenameList(
    ("Albu", "C-", "Alk", "ALT", "AST", "Crea", "Dim", "Prot", "T3", "T4", "Dehy", "Lipase", "Magn", "Triglycerid",
     "Trop", "Urea", "Glut", "PT", "Hema"),
    (("C-Reactive Protein", "CRP"), (r"Triiodothyronine \(T3\)", "fT3"), (r"INR\(PT\)", "INR"),
     (r"Thyroxine \(T4\)", "fT4"), (r"Alanine Aminotransferase \(ALT\)", "ALT"),
     (r"Asparate Aminotransferase \(AST\)", "AST"), (r"Lactate Dehydrogenase \(LD\)", "LDH"),
     (r"Creatine Kinase \(CK\)", "CK"), ("Creatine Kinase, MB Isoenzyme", "CK-MB"), ("Troponin T", "Troponin"),
     ("Urea Nitrogen", "Harnstoff-N"), ("Gamma Glutamyltransferase", "GGT"), ("Alkaline Phosphatase", "Alk")),
    exclude_after=" |<|PTT", require_value=True,
    renames_after=(("Hematocrit", "Hk"),
                   ("PT", "TZ"), ("Creatinine", "Kreatinin"), ("D-Dimer", "D-Dimere"), ("Protein", "Eiweiß"),
                   ("Triglycerides", "Triglyceride")))

EICU_BGA = RenameList(
    ("Carbox", "calc", "chlori", "HCO", "bili", "glucose", "Hgb", "Base", "potass", "sodiu", "O2", "pH", "lactat",
     "bicar", "anion"),
    (("Carboxyhemoglobin", "FCOHb"), ("calcium", "Ca"), ("ionized Ca", "Ca"), ("total bilirubin", "Bili"),
     ("potassium", "K"), ("bicarbonate", "HCO3"), ("anion gap", "Anionen_Lücke"), ("sodium", "Na"),
     ("paCO2", "PCO2"), ("paO2", "PO2"), ("O2 Sat", "sO2"), (r"\ \(%\)", ""), ("FiO2", "FO2"), ("chloride", "Cl"),
     ("bedside ", ""), ("glucose", "Glu"), ("Hgb", "Hb_BGA"), ("Base Excess", "SBE"), ("lactate", "Lac")),
    exclude="-hs|pre|direct| in | ratio|urina|Tot|LPM|Conten|CSF|Defic")

EICU_LAB_1 = RenameList(
    ("MC", "Hct", "RBC", "RDW", "WBC", "INR", "PTT", "baso", "chole", "eos", "fibri", "mono", "lymphs", "poly",
     "amyl", "phosph", "plat", "TSH"),
    (("PT - INR", "INR"), ("WBC x 1000", "Leukocyten"), ("RBC", "Erythrocyten"), ("-basos", "Basophile"),
     ("total cholesterol", "Cholesterin"), ("-eos", "Eosinophile"), ("-lymphs", "Lymphocyten"), ("RDW", "EVB"),
     ("fibrinogen", "Fibrinogen"), ("PTT", "aPTT"), ("Hct", "Hk"), ("-monos", "Monocyten"),
     ("-polys", "Neutrophile"), ("amylase", "pankreasspez"), ("phosphate", "Phosphat"),
     ("platelets x 1000", "Thrombocyten")),
    exclude="ionized|-hs|pre|direct| in | ratio")

EICU_LAB_2 = RenameList(
    ("albumin", "CRP", "alk", "ALT", "AST", "crea", "CPK", "dim", "total prot", "CPK-MB", "T3", "T4", "LDH",
     "lipase", "magn", "trig", "trop", "BUN", "PT"),
    (("albumin", "Albumin"), ("alkaline phos.", "Alk"), (r"\ \(SGPT\)|\ \(SGOT\)", ""), ("CPK", "CK"),
     ("creatinine", "Kreatinin"), ("total protein", "Eiweiß"), ("T3", "fT3"), ("T4", "fT4"), ("lipase", "Lipase"),
     ("magnesium", "Magnesium"), ("triglycerides", "Triglyceride"), ("PT", "TZ"), ("BUN", "Harnstoff-N"),
     ("troponin - I", "Troponin")),
    exclude="ionized|pre|direct| in | ratio|INDEX|urin|3RU|free | - T|-hs|- INR|PTT")

# eICU respiratory charting labels (whole-label rewrites)
EICU_RESP_FAMILIES = (
    Family(("PEEP|RR |RASS|FiO|Total RR",), "Respiratory|CPAP|Set|Spont|above|Unable",
           ((("RASS",), "RASS"), (("RR", "patient"), "Freq spontan"), (("Total RR",), "Freq gesamt")), name="resp"),
    Family(("Mean Airway Pressure|Peak Insp. Pressure",), None,
           ((("Mean Airway Pressure",), "Pmean"), (("Peak Insp. Pressure",), "Ppeak")), name="airway"),
)
# eICU nurse-charting GCS components; one charted row may match several
EICU_GCS_PATTERNS = {"GCS_auge": "Eyes", "GCS_verbal": "Verbal", "GCS_motor": "Motor", "GCS_total": "GCS Total"}
