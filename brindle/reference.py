"""Reference data: sites, code maps, analytes with codes and units, drugs, condition prefixes.

The values here are the network's own; a folder of JSON files named like the fields below replaces
them field by field. Tables are a few dozen rows, so they are broadcast wherever they are joined.
"""

from __future__ import annotations

import hashlib
import json
import os
from dataclasses import asdict, dataclass, field, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Clinics as (id, name, region, first three digits of the ZIP, city).
SITES = [
    ["S01", "Alder Clinic", "North", "701", "Northfield"],
    ["S02", "Birch Clinic", "North", "701", "Northfield"],
    ["S03", "Cedar Clinic", "North", "702", "Riverton"],
    ["S04", "Dogwood Clinic", "East", "702", "Riverton"],
    ["S05", "Elm Clinic", "East", "703", "Easton"],
    ["S06", "Fir Clinic", "East", "703", "Easton"],
    ["S07", "Ginkgo Clinic", "South", "703", "Easton"],
    ["S08", "Hazel Clinic", "South", "704", "Southport"],
    ["S09", "Ironwood Clinic", "South", "701", "Northfield"],
    ["S10", "Juniper Clinic", "West", "702", "Riverton"],
    ["S11", "Linden Clinic", "West", "704", "Southport"],
    ["S12", "Maple Clinic", "West", "703", "Easton"],
]
# Supplier codes (upper case) by map and canonical value.
CODES = {
    "appointment_status": {
        "completed": ["COMPLETED", "KEPT", "ARRIVED", "CHK-OUT", "CHECKED OUT"],
        "no_show": ["NO SHOW", "NO-SHOW", "NOSHOW", "NS"],
        "cancelled": ["CANCELLED", "CANCELED", "CXL", "PT CANCEL", "CLINIC CANCEL"],
        "scheduled": ["SCHEDULED", "BOOKED"],
    },
    "visit_type": {
        "office": ["OFFICE", "OFFICE VISIT", "OV"],
        "telehealth": ["TELEHEALTH", "VIDEO", "TELE"],
        "behavioral_health": ["BH", "BEHAVIORAL HEALTH"],
        "nurse": ["NURSE", "RN VISIT"],
        "mobile": ["MOBILE", "MOBILE UNIT", "VAN"],
    },
    "admin_mode": {"in_person": ["IN_PERSON", "IN PERSON"], "telehealth": ["TELEHEALTH", "VIDEO"], "portal": ["PORTAL"]},
    "claim_status": {"P": ["P", "PAID"], "R": ["R", "REVERSED", "REV"]},
    "sex": {"F": ["F", "FEMALE"], "M": ["M", "MALE"], "X": ["X"], "U": ["U", "UNKNOWN"]},
    "payer_type": {
        "commercial": ["COMMERCIAL", "COMM"],
        "government": ["GOVERNMENT", "GOVT", "PUBLIC"],
        "marketplace": ["MARKETPLACE", "EXCHANGE"],
        "self_pay": ["SELF PAY", "SELF-PAY", "SELFPAY", "UNINSURED"],
    },
    "language": {
        "en": ["EN", "ENG", "ENGLISH"], "es": ["ES", "SPA", "SPANISH"], "zh": ["ZH", "CHI", "CHINESE"], "ru": ["RU", "RUS", "RUSSIAN"], "bn": ["BN", "BEN", "BENGALI"],
        "ht": ["HT", "HAT", "HAITIAN CREOLE"], "ar": ["AR", "ARA", "ARABIC"], "fr": ["FR", "FRE", "FRENCH"], "ko": ["KO", "KOR", "KOREAN"],
    },
    "race": {
        "American Indian or Alaska Native": ["AMERICAN INDIAN OR ALASKA NATIVE"],
        "Asian": ["ASIAN"],
        "Black or African American": ["BLACK OR AFRICAN AMERICAN"],
        "Middle Eastern or North African": ["MIDDLE EASTERN OR NORTH AFRICAN"],
        "Native Hawaiian or Pacific Islander": ["NATIVE HAWAIIAN OR OTHER PACIFIC ISLANDER"],
        "White": ["WHITE"],
        "Multiracial": ["MULTIPLE", "TWO OR MORE RACES"],
    },
    "ethnicity": {"Hispanic or Latino": ["HISPANIC OR LATINO", "HISPANIC"], "Not Hispanic or Latino": ["NOT HISPANIC OR LATINO", "NON-HISPANIC"]},
}
# Analytes as (name, standard unit, plausible from, to), their codes with default units, conversions by unit.
ANALYTES = [["HBA1C", "%", "3.0", "20.0"], ["LDL", "mg/dL", "10.0", "400.0"]]
LAB_CODES = [["4548-4", "HBA1C", "%"], ["59261-8", "HBA1C", "mmol/mol"], ["13457-7", "LDL", "mg/dL"]]
LAB_UNITS = [["HBA1C", "%", "none"], ["HBA1C", "mmol/mol", "ifcc_to_ngsp"], ["LDL", "mg/dL", "none"]]
# Drugs by class.
DRUGS = {
    "diabetes_oral": ["metformin", "glipizide", "glimepiride", "sitagliptin"],
    "ras_antagonist": ["lisinopril", "losartan", "valsartan", "enalapril"],
    "statin": ["atorvastatin", "simvastatin", "rosuvastatin", "pravastatin"],
}
# Problem-list prefixes.
CONDITIONS = [["E11", "diabetes_t2"], ["E78", "hyperlipidemia"], ["F32", "depression"], ["F33", "depression"], ["I10", "hypertension"]]


@dataclass(frozen=True)
class Reference:
    sites: list = field(default_factory=lambda: SITES)
    codes: dict = field(default_factory=lambda: CODES)
    analytes: list = field(default_factory=lambda: ANALYTES)
    lab_codes: list = field(default_factory=lambda: LAB_CODES)
    lab_units: list = field(default_factory=lambda: LAB_UNITS)
    drugs: dict = field(default_factory=lambda: DRUGS)
    conditions: list = field(default_factory=lambda: CONDITIONS)

    @classmethod
    def load(cls, folder: str | None) -> Reference:
        """What the JSON files of a folder say, and the network's own values for the rest."""
        said = {}
        for f in fields(cls):
            path = os.path.join(folder or "", f"{f.name}.json")
            if folder and os.path.exists(path):
                with open(path, encoding="utf-8") as file:
                    said[f.name] = json.load(file)
        return cls(**said)

    @property
    def digest(self) -> str:
        """Changes whenever any value does, so that runs know what to check again."""
        return hashlib.sha256(json.dumps(asdict(self), sort_keys=True).encode()).hexdigest()

    def mapping(self, name: str) -> dict[str, str]:
        """Code to canonical value; codes that aren't listed are never guessed."""
        return {code: value for value, codes in self.codes[name].items() for code in codes}

    @property
    def site_ids(self) -> list[str]:
        return [s[0] for s in self.sites]

    @property
    def drug_names(self) -> list[str]:
        return [d for ds in self.drugs.values() for d in ds]

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        """A reference table, to be broadcast."""
        rows, schema = {
            "sites": (self.sites, "site_id string, site_name string, region string, zip3 string, city string"),
            "lab_codes": (self.lab_codes, "code string, analyte string, default_unit string"),
            "lab_units": (self.lab_units, "unit_of string, unit string, conversion string"),
            "analytes": ([(a, u, lo, hi) for a, u, lo, hi in self.analytes], "limits_of string, standard_unit string, low string, high string"),
            "drugs": ([(d, c) for c, ds in self.drugs.items() for d in ds], "drug string, drug_class string"),
            "conditions": (self.conditions, "prefix string, condition_group string"),
            "code_map": ([(m, code, value) for m, values in self.codes.items() for value, codes in values.items() for code in codes], "map_name string, raw_value string, canonical string"),
        }[name]
        return F.broadcast(spark.createDataFrame([tuple(r) for r in rows], schema))


def tree_digest(folder: str) -> str:
    """A digest of names and bytes of all files below a folder."""
    out = hashlib.sha256()
    for at, folders, names in os.walk(folder):
        folders.sort()
        for name in sorted(names):
            path = os.path.join(at, name)
            out.update(os.path.relpath(path, folder).encode() + b"\0")
            with open(path, "rb") as f:
                out.update(hashlib.file_digest(f, "sha256").digest())
    return out.hexdigest()
