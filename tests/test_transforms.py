"""Golden rows for the two feature derivations and the pre-join."""

import math

from larder.operators import demographic_features, prejoin, ticket_features

TICKET_SCHEMA = "PassengerId string, Ticket string, Fare double, Cabin string, Embarked string, Pclass string, Parch string"
TICKET_ROWS = [
    ("1", "Q/7 40412", 7.25, None, "S", "3", "0"),
    ("2", "Zx 55120", 71.2833, "C19", "C", "1", "0"),
    ("3", "HARBOR/K2. 9000417", 7.925, None, "S", "3", "0"),
    ("4", "662201", 53.1, "C7", "S", "1", "0"),
    ("5", "662305", 26.55, "C1 C2 C3", "S", "1", "0"),
    ("6", "PIER/O.K. 77001", 0.5, "F G12", None, "3", "0"),
    ("7", "W./T. 8123", 2.5, "", "Q", "3", "2"),
    ("8", None, None, "A  B", "S", "2", "1"),
]
# Hand-worked: TicketChars, CabinChar, CabinMulti, FareRounded
TICKET_EXPECTED = {
    "1": ("Q", None, "0", 7.0),
    "2": ("ZX", "C", "1", 71.0),
    "3": ("HARBOR", None, "0", 8.0),
    "4": (None, "C", "1", 53.0),
    "5": (None, "C", "3", 27.0),
    "6": ("PIER", "F", "2", 1.0),
    "7": ("W", "", "1", 3.0),
    "8": (None, "A", "3", None),
}


def test_ticket_features_golden(spark, ansi):
    df = spark.createDataFrame(TICKET_ROWS, TICKET_SCHEMA)
    out = ticket_features(df)
    assert out.columns == ["PassengerId", "Fare", "Embarked", "Pclass", "Parch",
                           "TicketChars", "CabinChar", "CabinMulti", "FareRounded"]
    got = {r["PassengerId"]: (r["TicketChars"], r["CabinChar"], r["CabinMulti"], r["FareRounded"])
           for r in out.collect()}
    assert got == TICKET_EXPECTED
    assert dict(out.dtypes)["FareRounded"] == "double"


DEMO_SCHEMA = "PassengerId string, Name string, Sex string, Age double, SibSp string"
DEMO_ROWS = [
    ("1", "Okafor, Mr. Ben Tal", "male", 22.0, "1"),
    ("2", "Lindqvist, Mrs. Arne Ulf (Maja Berit Holm)", "female", 38.0, "1"),
    ("3", 'Tanaka, Mrs. Ryo (Emi "Sky" Mori)', "female", float("nan"), "0"),
    ("4", "Novak, Petr (Eva-Jana)", None, 4.5, "0"),
    ("5", None, "male", None, "2"),
    ("6", "Nobody (Li An)", "female", 0.5, "0"),
]
# Hand-worked: Age, NamePrefix, NameSecondary, NameMultiple
DEMO_EXPECTED = {
    "1": (22.0, "Mr", None, "0"),
    "2": (38.0, "Mrs", "Maja Berit Holm", "1"),
    "3": (None, "Mrs", None, "0"),
    "4": (4.5, "", None, "0"),
    "5": (None, None, None, "0"),
    "6": (0.5, "", "Li An", "1"),
}


def test_demographic_features_golden(spark, ansi):
    df = spark.createDataFrame(DEMO_ROWS, DEMO_SCHEMA)
    out = demographic_features(df)
    assert out.columns == ["PassengerId", "Name", "Sex", "Age", "SibSp", "NamePrefix", "NameSecondary", "NameMultiple"]
    got = {r["PassengerId"]: (r["Age"], r["NamePrefix"], r["NameSecondary"], r["NameMultiple"]) for r in out.collect()}
    assert got == DEMO_EXPECTED
    assert not any(isinstance(v[0], float) and math.isnan(v[0]) for v in got.values())


def test_bracket_regex_runs_once(spark):
    df = spark.createDataFrame(DEMO_ROWS, DEMO_SCHEMA)
    plan = demographic_features(df)._jdf.queryExecution().optimizedPlan().toString()
    top = plan.splitlines()[0]
    # the flag reads the bracket column; the regex is not repeated for it
    assert "isnotnull(NameSecondary" in top and "regexp_extract" not in top


def test_prejoin_inner_drops_half_known_keys(spark):
    a = spark.createDataFrame([("1", 1.0), ("2", 2.0)], "k string, a double")
    b = spark.createDataFrame([("2", "x"), ("3", "y")], "k string, b string")
    out = prejoin(a, b, ["k"])
    assert [tuple(r) for r in out.collect()] == [("2", 2.0, "x")]
