"""Category recoding and grouped codes."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Descent codes of a victim.
DESCENT_NAMES = {
    "A": "Other Asian",
    "B": "Black",
    "C": "Chinese",
    "D": "Cambodian",
    "F": "Filipino",
    "G": "Guamanian",
    "H": "Hispanic",
    "I": "Native American",
    "J": "Japanese",
    "K": "Korean",
    "L": "Laotian",
    "O": "Other",
    "P": "Pac. Islander",
    "S": "Samoan",
    "U": "Hawaiian",
    "V": "Vietnamese",
    "W": "White",
    "X": "Unknown",
    "Z": "Asian Indian",
}

# Method-of-operation codes by group.
MO_CODE_GROUPS = {
    "Victim_Related": {"0101": "Aid victim", "0102": "Blind", "0103": "Crippled", "0108": "Infirm"},
    "Criminal_Action": {
        "0344": "Orders vict to rear room",
        "0401": "Force used",
        "0405": "Bound",
        "0406": "Brutal Assault",
        "0410": "Covered victim's face",
        "0416": "Hit-Hit w/ weapon",
        "0421": "Threaten to kill",
        "0432": "Intimidation",
        "0506": "Forced to fondle suspect",
    },
    "Crime_Context": {
        "0601": "Business",
        "0602": "Family",
        "0604": "Reproductive Health Services",
        "0605": "Traffic Accident related",
        "0906": "Gangs",
        "0907": "Narcotics",
        "0910": "Public Transit",
        "0913": "Victim knew Suspect",
        "0947": "Estes Robbery",
    },
    "Suspect_Activities": {"1004": "Assistant", "1026": "Use phone/toilet"},
    "Victim_Characteristics": {
        "1202": "Aged/Disabled",
        "1208": "Illegal Alien",
        "1218": "Homeless/Transient",
        "1253": "Bus Driver",
    },
    "Vehicle_Involvement": {
        "1300": "Vehicle involved",
        "1303": "Hid in rear seat",
        "1307": "Breaks window",
        "1309": "Susp uses vehicle",
    },
    "Evidence": {
        "1402": "Evidence Booked",
        "1407": "Bullets/Casings",
        "1410": "Gun Shot Residue",
        "1419": "Firearm booked",
        "1501": "Other MO",
    },
    "Relationship": {"1803": "Co-worker", "1816": "Gang member", "1822": "Stranger"},
    "Suspect_Condition": {
        "2000": "Domestic violence",
        "2001": "On drugs",
        "2002": "Intoxicated",
        "2004": "Homeless/transient",
        "2005": "Uses wheelchair",
        "2025": "Bisexual",
        "2028": "Repeat shoplifter",
        "2038": "Restraining order",
        "2039": "Costumed character",
        "2042": "Short-term rental",
    },
    "Collision_Type": {
        "3001": "Veh vs Non-collision",
        "3002": "Officer Involved",
        "3003": "Veh vs Ped",
        "3004": "Veh vs Veh",
        "3005": "Veh vs Veh other road",
        "3006": "Veh vs Parked Veh",
        "3007": "Veh vs Train",
        "3008": "Veh vs Bike",
        "3009": "Veh vs M/C",
        "3010": "Veh vs Animal",
        "3011": "Veh vs Fixed Object",
        "3012": "Veh vs Other Object",
        "3013": "M/C vs Veh",
        "3014": "M/C vs Fixed Object",
        "3015": "M/C vs Other",
        "3016": "Bike vs Veh",
        "3017": "Bike vs Train",
        "3018": "Bike vs Other",
        "3019": "Train vs Veh",
        "3020": "Train vs Train",
        "3021": "Train vs Bike",
        "3022": "Train vs Ped",
        "3023": "Train vs Fixed Object",
    },
    "Injury_Level": {
        "3024": "Severe Injury",
        "3025": "Visible Injury",
        "3026": "Complaint of Injury",
        "3027": "Fatal Injury",
        "3028": "Non Injury",
    },
    "Hit_Run_Property": {
        "3029": "Hit and Run Felony",
        "3030": "Hit and Run Misd",
        "3032": "Private Property - Yes",
        "3033": "Private Property - No",
        "3034": "City Property - Yes",
        "3035": "City Property - No",
    },
    "Location_Type": {"3036": "At Intersection - Yes", "3037": "At Intersection - No"},
    "DUI_Racing": {
        "3038": "DUI Felony",
        "3039": "DUI Misdemeanor",
        "3040": "Street Racing",
        "3062": "Bicyclist in Lane",
        "3063": "Unknown 3063",
        "3064": "Unknown 3064",
    },
    "Collision_Factor": {
        "3101": "PCF In Narrative",
        "3102": "Improper Driving",
        "3103": "Other Than Driver",
        "3104": "Unknown",
    },
    "Traffic_Class": {
        "3401": "Type of Collision",
        "3501": "Ped Actions",
        "3601": "Special Information",
        "3602": "Unlicensed motorist",
        "3603": "Bike vs opened door",
        "3701": "Movement Preceding",
        "3801": "Sobriety",
    },
}

# Coarser injury classes used as the model target.
INJURY_REGROUP = {"Complaint of Injury": "Visible Injury", "Fatal Injury": "Severe Injury"}

UNKNOWN = "unknown"


def literal_map(mapping: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def lookup(value: Column, mapping: Mapping[str, str]) -> Column:
    """Dictionary lookup; a missing key gives NULL. For dictionaries written in code only."""
    return F.try_element_at(literal_map(mapping), value)


def recode(value: Column, mapping: Mapping[str, str]) -> Column:
    """Replace listed values and keep every other value."""
    return F.coalesce(lookup(value, mapping), value)


def split_codes(value: Column) -> Column:
    """Split text on runs of white space and on commas; NULL gives an empty array."""
    return F.coalesce(F.split(value, r"\s+|,"), F.array().cast("array<string>"))


def digit_runs(value: Column) -> Column:
    """All runs of digits in a text; NULL gives an empty array."""
    return F.coalesce(F.regexp_extract_all(value, F.lit(r"(\d+)"), F.lit(1)), F.array().cast("array<string>"))


def first_group_label(codes: Column, group: Mapping[str, str], default: str = UNKNOWN) -> Column:
    """Label of the first code that belongs to ``group``, ``default`` when there is none."""
    first = F.get(F.filter(codes, lambda code: code.isin(*group)), 0)
    return F.coalesce(lookup(first, group), F.lit(default))


def code_group_columns(
    codes: Column, groups: Mapping[str, Mapping[str, str]] = MO_CODE_GROUPS
) -> dict[str, Column]:
    """One label column per code group, for ``withColumns``."""
    return {name: first_group_label(codes, group) for name, group in groups.items()}
