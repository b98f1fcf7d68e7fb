"""Closed vocabularies and marker presets."""

# Categories, relations and schools that tags may use.
CATEGORIES = ["ontological", "epistemological", "soteriological", "ethical", "practice", "cosmological"]
RELATIONS = [
    "IS_IDENTICAL_TO", "IS_DISTINCT_FROM", "IS_QUALIFIED_ASPECT_OF", "IS_SIMULTANEOUSLY_ONE_AND_DIFFERENT", "PRESUPPOSES", "SUBLATES", "LEADS_TO",
    "OBSTRUCTS", "IS_CAUSE_OF", "IS_MANIFESTATION_OF", "RECONCILES", "CONTRADICTS_IN_SCHOOL", "DEFINED_AS",
]
SCHOOLS = [
    "advaita", "vishishtadvaita", "dvaita", "dvaitadvaita", "achintya_bhedabheda", "neo_vedanta", "samkhya", "yoga", "nyaya", "vaisheshika", "mimamsa",
    "theravada", "jain_digambara", "jain_shvetambara", "jain_common", "kashmir_shaivism", "general",
]
CONFIDENCE = {"high": 2, "medium": 1, "low": 0}

# Marker patterns of prose that quotes, refutes, or is a dialogue.
QUOTATION = [
    r"as it is said", r"the scripture (declares|says|states)", r"thus the (sruti|smriti|veda|upanishad)", r"as the (sruti|smriti) (says|declares)",
    r"it is (stated|written|taught) (in|that)", r"the text (says|declares|states)", r"\bsmriti\b", r"\bsruti\b",
]
REFUTATION = [
    r"this view is (wrong|untenable|refuted|mistaken)", r"the opponent (argues|maintains|holds|says)", r"we reply", r"this (objection|argument) (is|cannot)",
    r"\bprima facie\b", r"\bpurvapaksha\b", r"some (say|maintain|hold) that.{0,80}but", r"it might be (said|argued|objected)", r"this (cannot|does not) (be|hold|stand)",
]
DIALOGUE = [
    r"why didn.t you answer", r"why (did|does) (the|he|she) not answer", r"sir, (why|what|how)", r"neither .{0,40} nor (no longer|not)",
    r"still exists.{0,20}after death", r"no longer exists.{0,20}after death", r"the (jain|wanderer|ascetic|brahmin) of the .{0,30} clan", r"is fueled by",
    r"i (don.t|do not) (say|declare|assert) that",
]

# Markers of this project's own prose, for the same operators.
PROSE = {"quotation": [r"as the aphorism says", r"according to the forest books"], "refutation": [r"it is objected", r"some say .{0,80}, yet"], "dialogue": [r"how could", r"the seeker asks"]}
