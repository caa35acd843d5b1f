"""A fleet and its derived tables, built lazily from the driver tables.

``Fleet(spark, sf_dir)`` wires the operators the way a user would: the three
layers merge into the effective configuration, allocation answers complete the
segments, the plan feeds the roster, the roster feeds the records. Nothing is
computed until a table is asked for; each property is one lazy DataFrame. The
site profiles and the settings of the clusters are written when they are asked
for first, and read back.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import address, config, dns, nodes
from ..operators.validate import planning_allowed
from ..session import write_table
from ..sources.fixed_values import CODE_DEFAULTS
from . import views


class Fleet:
    def __init__(self, spark: SparkSession, sf_dir: str, base: str = "customer"):
        self.spark = spark
        self.sf_dir = sf_dir
        self.base = base

    # inputs -----------------------------------------------------------------
    @cached_property
    def seed(self) -> DataFrame:
        return views.fleet_seed(self.spark, self.sf_dir, self.base)

    @cached_property
    def docs(self) -> DataFrame:
        """Cluster documents, one row per cluster (cluster_name, doc)."""
        return config.redacted_documents(views.cluster_docs(self.seed))

    @cached_property
    def clusters(self) -> DataFrame:
        """The cluster layer as long rows (cluster_name, key, value)."""
        return self.docs.select("cluster_name", F.explode("doc").alias("key", "value"))

    @cached_property
    def sites(self) -> DataFrame:
        return views.site_layer(self.spark, self.sf_dir)

    @cached_property
    def defaults(self) -> DataFrame:
        return views.defaults_layer(self.spark)

    @cached_property
    def env(self) -> DataFrame:
        return views.env_table(self.spark, self.sf_dir)

    @cached_property
    def allocs(self) -> DataFrame:
        return views.allocations(self.seed)

    @cached_property
    def inventory(self) -> DataFrame:
        return views.inventory(self.spark, self.sf_dir, self.seed)

    @cached_property
    def files(self) -> DataFrame:
        return views.host_files(self.spark, self.sf_dir)

    @cached_property
    def runs(self) -> DataFrame:
        return views.runs(self.spark, self.sf_dir, self.seed)

    @cached_property
    def artifacts(self) -> DataFrame:
        return views.artifacts(self.seed)

    @cached_property
    def host_tools(self) -> DataFrame:
        return views.host_tools(self.spark, self.sf_dir)

    @cached_property
    def spoke(self) -> DataFrame:
        return views.spoke(self.seed)

    @cached_property
    def polls(self) -> DataFrame:
        return views.polls(self.spark, self.sf_dir)

    @cached_property
    def attempts(self) -> DataFrame:
        return views.attempts(self.spark, self.sf_dir)

    @cached_property
    def log_lines(self) -> DataFrame:
        return views.log_lines(self.spark, self.sf_dir)

    # configuration ------------------------------------------------------------
    @cached_property
    def identity(self) -> DataFrame:
        return config.fleet_identity(self.docs)

    @cached_property
    def profiles(self) -> DataFrame:
        """The merged profile of every site, with code defaults, written once."""
        return config.stored_profiles(config.site_profiles(self.defaults, self.sites, self.env, CODE_DEFAULTS))

    @cached_property
    def effective(self) -> DataFrame:
        """C1 + C3: layers merged, reference keys resolved."""
        return config.merge_layers(self.docs, self.defaults, self.sites, profiles=self.profiles.where("layer <> 'code'"))

    @cached_property
    def settings(self) -> DataFrame:
        """Wide settings row per cluster (C1 + C3 + C5 for the planning keys),
        written once: clusters with and without a segment go different ways from
        here, and a lazy filter on the segment would make every document again,
        on each way, before the rows are spread."""
        return write_table(config.merge_settings(self.docs, self.defaults, self.sites, profiles=self.profiles), "settings")

    def materialize(self) -> "Fleet":
        """Cut lineage at the per-cluster settings, which hold the documents too,
        and at the address plan made from them: what every output reads. The
        settings are stored already; the plan is written once as a table in the
        shared folder named by ``spark.checkpoint.dir`` (it survives executor
        loss; never a local checkpoint) and read back. Outputs then plan and
        compile their own expressions alone."""
        derived = ("docs", "identity", "effective", "settings", "settings_long", "fleet", "plan", "nodes", "records", "clusters", "context")
        settings = self.settings
        for name in derived:
            self.__dict__.pop(name, None)
        self.__dict__["settings"] = settings
        self.__dict__["docs"] = settings.select("cluster_name", "doc")
        self.__dict__["plan"] = write_table(self.plan, "plan")
        return self

    # addressing and roster ------------------------------------------------------
    @cached_property
    def fleet(self) -> DataFrame:
        """Settings rows with the segment completed by the allocation answers."""
        return address.apply_allocations(self.settings, self.allocs)

    @cached_property
    def plan(self) -> DataFrame:
        """The address plan of the clusters that may have one. Consumers take
        nothing from refused clusters, so these don't wait for an allocation:
        their names may be shared by many (the answers are joined by name). The
        settings are stored, so the filter copies no expression."""
        allowed = self.settings.where(planning_allowed())
        return address.plan_addresses(address.apply_allocations(allowed, self.allocs))

    @cached_property
    def nodes(self) -> DataFrame:
        return nodes.name_nodes(self.plan)

    @cached_property
    def records(self) -> DataFrame:
        return dns.record_set(self.plan)

    @cached_property
    def settings_long(self) -> DataFrame:
        """Effective configuration with code defaults, long form."""
        return config.merge_layers(self.docs, self.defaults, self.sites, profiles=self.profiles)

    @cached_property
    def context(self) -> DataFrame:
        return config.build_context(self.plan, self.profiles)

    @cached_property
    def supplied(self) -> DataFrame:
        """Variable files as supplied (C7 with the fixture's defects)."""
        return views.supplied_variables(config.variables_long(self.plan))
