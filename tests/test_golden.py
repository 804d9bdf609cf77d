"""Facts from the reference's exported reports, re-entered by hand as constants."""
from pyspark.sql import functions as F

from courtview.functions.numeric import weighted_rate

TEAM_ROWS = [  # (views, engagements, exported weighted rate)
    (968253, 25229, 0.0261), (522137, 19913, 0.0381), (450322, 13093, 0.0291), (242575, 2060, 0.0085),
    (38170, 1899, 0.0498), (84903, 7102, 0.0836), (51126, 4480, 0.0876),
]
EXEC = {"views": 3662798, "likes": 116562, "comments": 9901, "engagements": 126463, "wer": 0.0345}


def test_team_rates_are_ratios_of_sums(spark):
    df = spark.createDataFrame(TEAM_ROWS, "v long, e long, w double")
    for r in df.select(weighted_rate(F.col("e"), F.col("v")).alias("r"), "w").collect():
        assert r.r == r.w


def test_executive_row(spark):
    assert EXEC["likes"] + EXEC["comments"] == EXEC["engagements"]
    df = spark.createDataFrame([(EXEC["engagements"], EXEC["views"])], "e long, v long")
    assert df.select(weighted_rate(F.col("e"), F.col("v"))).first()[0] == EXEC["wer"]


CONTENT_ROWS = [  # (type, videos, views, engagements, exported weighted rate)
    ("Shorts", 138, 2348309, 83415, 0.0355), ("Other", 104, 708559, 29089, 0.0411),
    ("Interview/Press", 41, 372426, 6888, 0.0185), ("Highlights/Recap", 33, 209256, 6203, 0.0296),
    ("Behind the Scenes", 4, 24248, 868, 0.0358),
]


def test_content_rows_add_up_to_the_executive_row(spark):
    assert sum(r[1] for r in CONTENT_ROWS) == 320
    assert sum(r[2] for r in CONTENT_ROWS) == EXEC["views"]
    assert sum(r[3] for r in CONTENT_ROWS) == EXEC["engagements"]
    df = spark.createDataFrame(CONTENT_ROWS, "t string, n long, v long, e long, w double")
    for r in df.select(weighted_rate(F.col("e"), F.col("v")).alias("r"), "w").collect():
        assert r.r == r.w
