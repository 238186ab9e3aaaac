"""Column names, schemas and rule tables of the road-incident data model.

Everything here is data: the raw 29-column layout of the crash file, the
rename map and drop list of the cleaning pipeline, and the contributing
factor buckets. Steps in ``operators`` and ``plans`` read these tables
instead of spelling names inline.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- raw file -----------------------------------------------------------------

CRASH_DATE = "CRASH DATE"
CRASH_TIME = "CRASH TIME"
BOROUGH = "BOROUGH"
ZIP_CODE = "ZIP CODE"
COLLISION_ID = "COLLISION_ID"

PERSONS_INJURED = "NUMBER OF PERSONS INJURED"
PERSONS_KILLED = "NUMBER OF PERSONS KILLED"
PEDS_INJURED = "NUMBER OF PEDESTRIANS INJURED"
PEDS_KILLED = "NUMBER OF PEDESTRIANS KILLED"
CYCLISTS_INJURED = "NUMBER OF CYCLIST INJURED"
CYCLISTS_KILLED = "NUMBER OF CYCLIST KILLED"
MOTORISTS_INJURED = "NUMBER OF MOTORIST INJURED"
MOTORISTS_KILLED = "NUMBER OF MOTORIST KILLED"

INJURED_COLUMNS = [PERSONS_INJURED, PEDS_INJURED, CYCLISTS_INJURED, MOTORISTS_INJURED]
KILLED_COLUMNS = [PERSONS_KILLED, PEDS_KILLED, CYCLISTS_KILLED, MOTORISTS_KILLED]
COUNT_COLUMNS = [c for pair in zip(INJURED_COLUMNS, KILLED_COLUMNS) for c in pair]

FACTOR_COLUMNS = [f"CONTRIBUTING FACTOR VEHICLE {i}" for i in range(1, 6)]
VEHICLE_COLUMNS = [f"VEHICLE TYPE CODE {i}" for i in range(1, 6)]

# Column order of the raw file. The source file does not fix an order; this one
# is ours and is only used when a schema has to be spelled out (CSV reads).
RAW_COLUMNS = [
    CRASH_DATE, CRASH_TIME, BOROUGH, ZIP_CODE,
    "LATITUDE", "LONGITUDE", "LOCATION",
    "ON STREET NAME", "CROSS STREET NAME", "OFF STREET NAME",
    PERSONS_INJURED, PERSONS_KILLED, PEDS_INJURED, PEDS_KILLED,
    CYCLISTS_INJURED, CYCLISTS_KILLED, MOTORISTS_INJURED, MOTORISTS_KILLED,
    *FACTOR_COLUMNS,
    COLLISION_ID,
    *VEHICLE_COLUMNS,
]


def raw_schema() -> T.StructType:
    """All-string schema of the raw file: every cast is done later, on purpose,
    with null-on-failure semantics (inference would turn ``H:mm`` times into
    timestamps and blank zips into failures)."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])


# --- cleaning pipeline --------------------------------------------------------

# The columns removed after feature derivation. "date" and "hour"
# are helper columns made by the pipeline itself.
DROP_COLUMNS = [
    "CRASH DATE", "CRASH TIME", "LATITUDE", "LONGITUDE", "LOCATION",
    "ON STREET NAME", "CROSS STREET NAME", "OFF STREET NAME",
    "CONTRIBUTING FACTOR VEHICLE 4", "CONTRIBUTING FACTOR VEHICLE 5",
    "VEHICLE TYPE CODE 1", "VEHICLE TYPE CODE 2", "VEHICLE TYPE CODE 3",
    "VEHICLE TYPE CODE 4", "VEHICLE TYPE CODE 5", "date", "hour",
]

# Raw name -> clean name.
RENAME_MAP = {
    "BOROUGH": "borough",
    "ZIP CODE": "zip_code",
    "NUMBER OF PERSONS INJURED": "injured_persons",
    "NUMBER OF PERSONS KILLED": "killed_persons",
    "NUMBER OF PEDESTRIANS INJURED": "injured_peds",
    "NUMBER OF PEDESTRIANS KILLED": "killed_peds",
    "NUMBER OF CYCLIST INJURED": "injured_cyclists",
    "NUMBER OF CYCLIST KILLED": "killed_cyclists",
    "NUMBER OF MOTORIST INJURED": "injured_motorists",
    "NUMBER OF MOTORIST KILLED": "killed_motorists",
    "CONTRIBUTING FACTOR VEHICLE 1": "factor_v1",
    "CONTRIBUTING FACTOR VEHICLE 2": "factor_v2",
    "CONTRIBUTING FACTOR VEHICLE 3": "factor_v3",
    "COLLISION_ID": "crash_id",
}

# Factor columns that get a default and a bucket label (1 to 3; 4 and 5 are dropped).
BUCKETED_FACTORS = FACTOR_COLUMNS[:3]
FACTOR_DEFAULT = "Unspecified"

# Contributing-factor buckets, label -> member values, in the
# order the rules are applied. Matching is exact and case-sensitive; both
# spellings of some entries are real members, as are the codes "1" and "80".
FACTOR_BUCKETS: dict[str, list[str]] = {
    "Personal Motorist Issue": [
        "Alcohol Involvement", "Illnes", "Lost Consciousness", "Fell Asleep",
        "Drugs (illegal)", "Fatigued/Drowsy", "Physical Disability",
        "Prescription Medication", "Drugs (Illegal)", "Illness",
    ],
    "Vehicle Failure": [
        "Steering Failure", "Other Vehicular", "Accelerator Defective",
        "Brakes Defective", "Backing Unsafely", "Tinted Windows",
        "Other Lighting Defects", "Tire Failure/Inadequate", "Headlights Defective",
        "Windshield Inadequate", "Vehicle Vandalism", "Shoulders Defective/Improper",
    ],
    "External Force / Reaction": [
        "Pavement Slippery", "Unspecified", "Reaction to Uninvolved Vehicle",
        "Traffic Control Disregarded", "Oversized Vehicle",
        "Pedestrian/Bicyclist/Other Pedestrian Error/Confusion",
        "View Obstructed/Limited", "Glare", "Obstruction/Debris", "Animals Action",
        "Pavement Defective", "Driverless/Runaway Vehicle",
        "Lane Marking Improper/Inadequate",
        "Traffic Control Device Improper/Non-Working", "Tow Hitch Defective",
        "Reaction to Other Uninvolved Vehicle", "1",
    ],
    "Driver Distraction": [
        "Driver Inattention/Distraction", "Passenger Distraction",
        "Outside Car Distraction", "Eating or Drinking", "Cell Phone (hands-free)",
        "Cell Phone (hand-Held)", "Using On Board Navigation Device",
        "Other Electronic Device", "Listening/Using Headphones", "Texting",
        "Cell Phone (hand-held)",
    ],
    "Poor Driving": [
        "Aggressive Driving/Road Rage", "Following Too Closely", "Passing Too Closely",
        "Failure to Yield Right-of-Way", "Driver Inexperience",
        "Passing or Lane Usage Improper", "Turning Improperly", "Unsafe Lane Changing",
        "Unsafe Speed", "Failure to Keep Right", "80",
    ],
}

# Time-of-day segments as (exclusive upper hour bound, label),
# first match wins; anything else, a null hour included, is the last label.
TIME_SEGMENTS = [(6, "night"), (12, "morning"), (18, "afternoon")]
TIME_SEGMENT_OTHERWISE = "evening"

DATE_FORMAT = "MM/dd/yyyy"

# Highest vehicle count kept by the cleaning filter (strictly below 4).
MAX_VEHICLES_EXCLUSIVE = 4

CLEAN_COLUMNS = [
    "borough", "zip_code",
    "injured_persons", "killed_persons", "injured_peds", "killed_peds",
    "injured_cyclists", "killed_cyclists", "injured_motorists", "killed_motorists",
    "factor_v1", "factor_v2", "factor_v3", "crash_id",
    "year", "month", "day_of_week", "time_segment",
    "total_injured", "total_killed", "fatality_rate", "total_cars",
]
