"""Crosswalk key standardisation against shipped input/expected-output pairs."""

import os

from blocklot.plans import crosswalks
from blocklot.session import scratch_path
from blocklot.sources import tables

# Rows of published crosswalks (raw) and their standardised form.
COMMUNITY_TO_SCHOOL_RAW = """BoroCD,SchoolDist
410,27.0
480,30.0
104,2.0
107,3.0
595,31.0
317,18.0
409,27.0
413,29.0
483,27.0
226,10.0
313,21.0
356,
484,
"""
COMMUNITY_TO_SCHOOL_EXPECTED = [(410, 27), (480, 30), (104, 2), (107, 3), (595, 31), (317, 18), (409, 27),
                                (413, 29), (483, 27), (226, 10), (313, 21), (356, None), (484, None)]

COUNCIL_TO_TRACT_RAW = """CounDist,CT2020
3,009700
25,028300
42,105801
45,078000
20,120100
21,038100
22,011700
8,
32,
"""
COUNCIL_TO_TRACT_EXPECTED = [(3, "009700"), (25, "028300"), (42, "105801"), (45, "078000"), (20, "120100"),
                             (21, "038100"), (22, "011700"), (8, None), (32, None)]


def _csv(spark, name, text):
    path = scratch_path(spark, "tests", name)
    local = path[len("file:"):] if path.startswith("file:") else path
    os.makedirs(os.path.dirname(local), exist_ok=True)
    with open(local, "w") as f:
        f.write(text)
    return path


def test_community_to_school(spark):
    # A numeric CSV column with blanks is read as double, as a type-guessing reader would.
    path = _csv(spark, "community_to_school.csv", COMMUNITY_TO_SCHOOL_RAW)
    df = tables.read_csv(spark, path, "BoroCD bigint, SchoolDist double")
    out = crosswalks.standardise_crosswalk(df, {"BoroCD": "community_district", "SchoolDist": "school_district"})
    assert out.columns == ["community_district", "school_district"]
    assert [tuple(r) for r in out.collect()] == COMMUNITY_TO_SCHOOL_EXPECTED


def test_council_to_tract_numbers(spark):
    # Tract codes read as numbers lose their leading zeros; the standardiser restores them.
    path = _csv(spark, "council_to_tract.csv", COUNCIL_TO_TRACT_RAW)
    df = tables.read_csv(spark, path, "CounDist bigint, CT2020 double")
    out = crosswalks.standardise_crosswalk(df, {"CounDist": "council_district", "CT2020": "census_tract"})
    assert [tuple(r) for r in out.collect()] == COUNCIL_TO_TRACT_EXPECTED


def test_council_to_tract_text(spark):
    path = _csv(spark, "council_to_tract_text.csv", COUNCIL_TO_TRACT_RAW)
    df = tables.read_csv(spark, path, "CounDist string, CT2020 string")
    out = crosswalks.standardise_crosswalk(df, {"CounDist": "council_district", "CT2020": "census_tract"})
    assert [tuple(r) for r in out.collect()] == COUNCIL_TO_TRACT_EXPECTED


def test_missing_rename_ignored(spark):
    path = _csv(spark, "council_to_tract2.csv", COUNCIL_TO_TRACT_RAW)
    df = tables.read_csv(spark, path, "CounDist bigint, CT2020 double")
    out = crosswalks.standardise_crosswalk(df, {"NotThere": "x", "CounDist": "council_district"})
    assert out.columns == ["council_district", "CT2020"]
