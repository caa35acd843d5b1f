"""Benchmark: headline queries on the benchmark fleet (one cluster per order,
150,000 clusters at sf0.1) at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Each query is fully executed (written to a no-op sink) and timed end to end,
planning included; the value is the sum over the queries. The per-cluster
settings and the address plan are checkpointed once (their own timed step) and
the queries after it read the checkpoint, as a job reusing it would.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from fleetplan.operators import address, config, dns, nodes, readiness, registration, runs, validate  # noqa: E402
from fleetplan.plans.fleet import Fleet  # noqa: E402
from fleetplan.session import local_session, write_table  # noqa: E402


def headline(spark, sf_dir):
    f = Fleet(spark, sf_dir, base="orders")
    c = Fleet(spark, sf_dir, base="customer")
    kept = {}

    def recorded():
        """The recorded state that the differences are taken against: last
        week's records, stored, with some names gone and some values old."""
        now = dns.forward_records(f.plan)
        r = F.crc32(F.col("name").cast("binary"))
        old = now.where(r % 7 != 0).withColumn("value", F.when(r % 5 == 0, F.lit("10.0.0.1")).otherwise(F.col("value")))
        kept["records"] = write_table(old, "bench-recorded")
        return kept["records"]

    def supplied():
        kept["supplied"] = write_table(f.supplied, "bench-supplied")
        return kept["supplied"]

    return {
        # the per-cluster settings, with the documents, and the address plan,
        # written once (timed here); every later query reads them
        "fleet_checkpoint": lambda: f.materialize().settings,
        "effective_config": lambda: f.effective,
        "address_plan": lambda: address.addresses(f.plan),
        "node_roster": lambda: nodes.size_nodes(f.plan),
        "record_set": lambda: f.records,
        "inventory_lookup": lambda: nodes.resolve_inventory(f.settings, f.inventory)[0],
        "node_specs": lambda: nodes.node_specs(f.plan, f.inventory),
        "check_names": lambda: validate.check_names(f.identity),
        "check_plan": lambda: address.check_plan(f.plan),
        "context": lambda: f.context,
        "variables": lambda: config.variables_long(f.plan),
        # the variable files as supplied: an input, written once (timed here)
        "supplied": supplied,
        "check_contract": lambda: validate.check_contract(kept["supplied"]),
        "check_counts": lambda: validate.check_counts(kept["supplied"]),
        "install": lambda: config.to_install_struct(f.plan, f.files),
        "phase_plan": lambda: runs.phase_plan(c.runs, c.settings),
        "missing_tools": lambda: validate.missing_tools(c.runs, c.settings, c.host_tools),
        "time_to_available": lambda: readiness.time_to_available(c.polls, 2880),
        "pending_per_poll": lambda: readiness.pending_per_poll(c.polls),
        "join_multiline": lambda: runs.join_multiline(runs.parse_logs(c.log_lines)),
        "registration": lambda: registration.registration_candidates(c.runs, c.settings, c.env),
        "recorded_state": recorded,
        "diff_records": lambda: runs.diff_state(dns.forward_records(f.plan), kept["records"], ["cluster_name", "name"], ["value"]),
    }


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")))
    times, rows = {}, {}
    for name, build in headline(spark, sf_dir).items():
        t0 = time.time()
        df = build()
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "fleet_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else None,
        "cpus": cpus,
        "spark": spark.version,
        "fleet_base": "orders (150,000 clusters at sf0.1) and customer",
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
