"""Clusters are spread over tasks by their number, and their settings made once."""

import re
from collections import Counter

from pyspark.sql import functions as F

from fleetplan.functions import jsonvalue as J
from fleetplan.operators import address, config, nodes, validate
from fleetplan.plans import views
from fleetplan.plans.fleet import Fleet
from fleetplan.session import ensure_checkpoint_dir
from fleetplan.sources.fixed_values import REDACTED, SECRET_KEYS, VARIABLE_CONTRACT

from .conftest import SF_SMALL


def test_clusters_are_spread_by_their_number(spark, monkeypatch):
    whole = views.fleet_seed(spark, SF_SMALL)
    rows = whole.count()
    monkeypatch.setattr(views, "CLUSTERS_PER_TASK", 10)
    seed = views.fleet_seed(spark, SF_SMALL)
    assert seed.rdd.getNumPartitions() == -(-rows // 10)
    assert max(len(p) for p in seed.rdd.glom().collect()) < 40
    assert seed.count() == rows and seed.exceptAll(whole).count() == 0


def test_settings_are_written_once_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(views, "CLUSTERS_PER_TASK", 10)
    fleet = Fleet(spark, SF_SMALL)
    files = fleet.settings.inputFiles()
    assert len(files) > 5 and all(ensure_checkpoint_dir(spark) in f for f in files)
    assert {f for f in fleet.plan.inputFiles() if "/settings-" in f} == set(files)


def test_refused_clusters_of_one_name_do_not_multiply_in_the_plan(spark, tmp_path):
    # every 50th cluster takes its name from c_name, which no run may start on
    for name in ("nation", "region"):
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    rows = spark.range(0, 4000).selectExpr("id AS c_custkey", "'Customer#1' AS c_name", "0 AS c_nationkey", "'MACHINERY' AS c_mktsegment")
    rows.write.parquet(str(tmp_path / "customer.parquet"))
    fleet = Fleet(spark, str(tmp_path))
    assert fleet.plan.count() <= 4000
    whole = address.plan_addresses(fleet.fleet)
    assert whole.count() > 4000
    for made in (lambda plan: nodes.name_nodes(plan), address.check_plan, lambda plan: config.variables_long(plan)):
        assert made(fleet.plan).exceptAll(made(whole)).count() == made(whole).exceptAll(made(fleet.plan)).count() == 0


def test_supplied_variables_are_made_once_for_the_contract(spark):
    made = spark.sparkContext.accumulator(0)

    def passed(value):
        made.add(1)
        return value

    number = next(n for n, kind, *_ in VARIABLE_CONTRACT if kind == "number")
    values = {n: "[]" if kind == "list(string)" else "1" for n, kind, *_ in VARIABLE_CONTRACT}
    rows = [("good", n, v) for n, v in values.items()]
    rows += [("twice", n, "x" if n == number else v) for n, v in values.items()] * 2
    rows += [("other", "nobody_knows", "1"), (None, None, None)]
    through = F.udf(passed, "string").asNondeterministic()
    supplied = spark.createDataFrame(rows, "cluster_name string, variable string, value string").withColumn("variable", through("variable"))
    found = Counter((r.cluster_name, r.variable, r.rule) for r in validate.check_contract(supplied).collect())
    assert made.value == len(rows)
    required = [n for n, _, needed, _ in VARIABLE_CONTRACT if needed]
    missing = {(cluster, n, "missing_required"): 1 for cluster in ("other", None) for n in required}
    assert found == Counter({("twice", number, "not_a_number"): 2, ("other", "nobody_knows", "undeclared"): 1, **missing})


def test_document_values_are_computed_once(spark):
    rows = spark.createDataFrame([(1, "x", None), (2, None, "null"), (3, None, None)], "k int, a string, b string")
    docs = rows.select("k", views._document(("a", J.quote("a")), ("b", F.col("b"))).alias("doc"))
    assert {r.k: r.doc for r in docs.collect()} == {1: {"a": '"x"'}, 2: {"b": "null"}, 3: {}}
    made = config.redacted_documents(views.cluster_docs(views.fleet_seed(spark, SF_SMALL)))
    spark.conf.set("spark.sql.debug.maxToStringFields", 1000)
    try:
        plan = made._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    # seven values are quoted; the lambda reads a finished map and holds none of them
    assert plan.count("regexp_replace(") == 7 and re.search(r"transform_values\(doc#\d+, ", plan)


def test_only_documents_with_secrets_are_rewritten(spark):
    secret = {k: '"s"' for k in SECRET_KEYS}
    rows = [("all", {**secret, "site": '"a"'}), ("empty", {SECRET_KEYS[0]: '""', "x": "null"}), ("none", {"site": '"a"', "y": None}), ("blank", {}), ("null", None)]
    docs = config.redacted_documents(spark.createDataFrame(rows, "cluster_name string, doc map<string,string>"))
    expected = dict(rows) | {"all": dict.fromkeys(SECRET_KEYS, REDACTED) | {"site": '"a"'}}
    assert {r.cluster_name: r.doc for r in docs.collect()} == expected
