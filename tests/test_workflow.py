"""The whole workflow through the client: raw CSV -> feature tables -> training -> bundle -> scoring by id."""

from pyspark.sql import functions as F

from larder.client import FeatureClient
from larder.operators import FeatureLookup, demographic_features, ticket_features
from larder.operators.model import train_and_save
from larder.session import scratch_path
from larder.sources import make_schema, read_tables

TICKET = make_schema([("PassengerId", "string"), ("Ticket", "string"), ("Fare", "double"), ("Cabin", "string"),
                      ("Embarked", "string"), ("Pclass", "string"), ("Parch", "string")])
DEMO = make_schema([("PassengerId", "string"), ("Name", "string"), ("Sex", "string"), ("Age", "double"),
                    ("SibSp", "string")])
LABELS = make_schema([("PassengerId", "string"), ("Survived", "int")])


def _write_csv(spark, header, lines):
    path = scratch_path(spark, "wf-csv")
    spark.sparkContext.parallelize([header + "\n" + "\n".join(lines) + "\n"], 1).saveAsTextFile(path)
    return path


def _raw(spark):
    tickets, demos, labels = [], [], []
    titles = ["Mr", "Mrs", "Miss", "Master"]
    for i in range(1, 121):
        cabin = "" if i % 3 else ("C23 C25" if i % 2 else f"B{i}")
        tickets.append(f"{i},{'PC ' if i % 4 == 0 else ''}{1000 + i},{(i % 17) * 3.5},{cabin},{'SCQ'[i % 3]},{1 + i % 3},{i % 4}")
        if i % 10:   # some passengers have no demographic row
            name = f'"Doe{i}, {titles[i % 4]}. John{" (Ann Lee)" if i % 5 == 0 else ""}"'
            age = "" if i % 7 == 0 else str(20 + i % 30)
            demos.append(f"{i},{name},{'male' if i % 2 else 'female'},{age},{i % 3}")
        labels.append(f"{i},{1 if (i % 3 == 0 or i % 4 == 0) else 0}")
    paths = {"ticket": _write_csv(spark, "PassengerId,Ticket,Fare,Cabin,Embarked,Pclass,Parch", tickets),
             "demographic": _write_csv(spark, "PassengerId,Name,Sex,Age,SibSp", demos),
             "labels": _write_csv(spark, "PassengerId,Survived", labels)}
    return read_tables(spark, paths, {"ticket": TICKET, "demographic": DEMO, "labels": LABELS})


def test_workflow(spark, db):
    fc = FeatureClient(spark)
    raw = _raw(spark)
    tf, dfeat = raw["ticket"].transform(ticket_features), raw["demographic"].transform(demographic_features)
    t_name, d_name = f"{db}.ticket_features", f"{db}.demographic_features"
    assert fc.create_table(t_name, "PassengerId", tf.schema, "Ticket features") is True
    assert fc.create_table(d_name, "PassengerId", dfeat.schema, "Demographic features") is True
    assert fc.create_table(t_name, "PassengerId", tf.schema) is False
    fc.write_table(t_name, tf)
    fc.write_table(d_name, dfeat)
    fc.write_table(t_name, tf)                     # a second merge of the same rows changes nothing
    assert fc.read_table(t_name).count() == 120 and fc.read_table(d_name).count() == 108

    lookups = [FeatureLookup(t_name, ["CabinChar", "CabinMulti", "Embarked", "FareRounded", "Parch", "Pclass"],
                             "PassengerId"),
               FeatureLookup(d_name, ["Age", "NameMultiple", "NamePrefix", "Sex", "SibSp"], "PassengerId")]
    ts = fc.create_training_set(raw["labels"], lookups, label="Survived")
    data = ts.load_df()
    assert data.count() == 120
    assert data.where(F.col("NamePrefix").isNull()).count() == 12          # no demographic row
    path, metrics = train_and_save(
        spark, ts, scratch_path(spark, "wf-model"), "PassengerId",
        categorical=["NamePrefix", "Sex", "CabinChar", "CabinMulti", "Embarked", "Parch", "Pclass", "SibSp"],
        numeric=["Age", "FareRounded"], binary=["NameMultiple"], max_iter=5, max_depth=3)
    assert {(r["part"], r["metric"]) for r in metrics.collect()} == {
        (p, m) for p in ("training", "testing") for m in ("precision", "recall", "f1")}

    ids = raw["labels"].select("PassengerId").orderBy("PassengerId").limit(20)
    ids = ids.unionByName(spark.createDataFrame([("9999",)], "PassengerId string"))
    scored = fc.score_batch(path, ids)
    assert scored.count() == 21
    assert scored.where(F.col("PassengerId") == "9999").first()["prediction"] in (0.0, 1.0)
    assert fc.load_model(path).spec["label"] == "Survived"
    assert fc.drop_table(t_name) and not fc.table_exists(t_name)
