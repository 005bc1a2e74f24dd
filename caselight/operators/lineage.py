"""Reachability in a lineage graph and the models that mention a column.

For given roots ``downstream`` lists what they reach. For all nodes at once ``Reach`` keeps what a node reaches as bits, 64
neighbouring nodes in one number, and makes all pairs, classes or counts of them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T
from pyspark.storagelevel import StorageLevel

from caselight.session import remove, shared_dir


def downstream(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """Every (root, node) with a path from root to node; ``edges`` has parent and child, ``roots`` has root.

    The graph may have cycles; a root is its own descendant only if a cycle leads back to it. Each round follows the
    edges of the nodes found last, for all roots together, and ends when nothing new turns up. A round's nodes are
    written to the shared folder and read from there: the plan stays short, a lost executor costs one round at most,
    and Spark knows the size of what it joins, so it broadcasts small rounds only.
    """
    spark = edges.sparkSession
    path = shared_dir(spark, "lineage")
    edges = edges.select("parent", "child").distinct().persist(StorageLevel.MEMORY_AND_DISK)
    ddl = T.StructType([
        T.StructField("root", roots.schema["root"].dataType), T.StructField("node", edges.schema["child"].dataType)
    ])
    try:
        number = 0
        found = roots.select("root", F.col("root").alias("parent")).join(edges, "parent").select(
            "root", F.col("child").alias("node")).distinct()
        while True:
            new = Observation()
            found.observe(new, F.count(F.lit(1)).alias("rows")).write.parquet(f"{path}/round={number}")
            if new.get["rows"] == 0:
                break
            frontier = spark.read.schema(ddl).parquet(f"{path}/round={number}")
            seen = spark.read.schema(ddl).parquet(*[f"{path}/round={n}" for n in range(number + 1)])
            steps = frontier.join(edges, F.col("node") == F.col("parent")).select("root", F.col("child").alias("node"))
            found = steps.distinct().join(seen, ["root", "node"], "left_anti")
            number += 1
    finally:
        edges.unpersist()
    return spark.read.schema(ddl).parquet(*[f"{path}/round={n}" for n in range(number + 1)])


def source_ids(sources: DataFrame, wanted: DataFrame) -> DataFrame:
    """Look up sources by (source_name, name); the flag ``source_found`` tells unknown ones."""
    return wanted.join(sources.select("source_name", "name", "unique_id"), ["source_name", "name"], "left").withColumn(
        "source_found", F.col("unique_id").isNotNull()
    )


def code_of(raw_code: Column, compiled_code: Column) -> Column:
    """A model's text; the raw text counts first."""
    return F.coalesce(F.nullif(raw_code, F.lit("")), compiled_code, F.lit(""))


def mentions(raw_code: Column, compiled_code: Column, column: Column) -> Column:
    """Whether a model's text contains a column name, without regard to case."""
    return F.lower(code_of(raw_code, compiled_code)).contains(F.lower(column))


def impacted_models(edges: DataFrame, nodes: DataFrame, changes: DataFrame) -> DataFrame:
    """Models downstream of each changed source and whether their text mentions the changed column.

    ``changes`` has root and column_name (null when no single column changed); ``nodes`` has unique_id, resource_type,
    name, raw_code and compiled_code.
    """
    reached = downstream(edges, changes.select("root").distinct())
    models = nodes.where(F.col("resource_type") == "model").select("unique_id", "name", "raw_code", "compiled_code")
    hits = reached.join(models, reached["node"] == models["unique_id"]).join(changes.select("root", "column_name"), "root")
    named = mentions(F.col("raw_code"), F.col("compiled_code"), F.col("column_name"))
    return hits.select("root", "name", "column_name", F.coalesce(named, F.lit(False)).alias("references_column"))


def numbered(nodes: DataFrame, path: str) -> DataFrame:
    """(node, number) of a column ``node`` without repeats: numbers from 0 without gaps, in the order of the nodes.

    Neighbours in that order get neighbouring numbers, so that what a node reaches fills few blocks of bits. Only the sizes of
    the sorted partitions, one row each, meet on the driver.
    """
    spark = nodes.sparkSession
    place = F.monotonically_increasing_id()
    nodes.orderBy("node").select("node", F.shiftright(place, 33).alias("part"), place.bitwiseAND((1 << 33) - 1).alias("at")).write.parquet(path)
    stored = spark.read.parquet(path)
    sizes = {row["part"]: row["count"] for row in stored.groupBy("part").count().collect()}
    starts, total = [], 0
    for part in sorted(sizes):
        starts.append((part, total))
        total += sizes[part]
    offsets = spark.createDataFrame(starts, "part bigint, start bigint")
    return stored.join(F.broadcast(offsets), "part").select("node", (F.col("start") + F.col("at")).alias("number"))


@dataclass(frozen=True)
class Reach:
    """What every node that feeds another one reaches: ``numbers`` (node, number), ``blocks`` (number, block, bits).

    Bit b of block k says that the node reaches node number 64 * k + b; blocks without a bit are left out.
    """

    numbers: DataFrame
    blocks: DataFrame

    @classmethod
    def of(cls, edges: DataFrame) -> Reach:
        """Follow the edges (parent, child) from all nodes together; cycles are allowed.

        Each round passes the bits found last to the parents and keeps those that are new there; it ends when none is, after
        as many rounds as the longest of all shortest paths has edges. The bits of a round are merged in the map tasks and
        written to the shared folder, so a lost executor costs one round; the folders of the rounds are deleted at the end.
        """
        spark = edges.sparkSession
        path = shared_dir(spark, "reach")
        pairs = edges.where("parent IS NOT NULL AND child IS NOT NULL").select("parent", "child").distinct()
        pairs.write.parquet(f"{path}/pairs")
        pairs = spark.read.parquet(f"{path}/pairs")
        nodes = pairs.select(F.col("parent").alias("node")).union(pairs.select("child")).distinct()
        numbers = numbered(nodes, f"{path}/nodes")
        numbers.write.parquet(f"{path}/numbers")
        numbers = spark.read.parquet(f"{path}/numbers")
        to = lambda name: numbers.select(F.col("node").alias(name), F.col("number").alias(f"{name}_number"))
        pairs.join(to("parent"), "parent").join(to("child"), "child").select(
            F.col("parent_number").alias("number"), F.col("child_number").alias("child")).write.parquet(f"{path}/edges")
        pairs = spark.read.parquet(f"{path}/edges")

        found = pairs.groupBy("number", F.shiftright("child", 6).alias("block")).agg(F.bit_or(
            F.expr("shiftleft(1L, cast(child & 63 as int))")).alias("bits"))
        number = 0
        while True:
            new = Observation()
            found.observe(new, F.count(F.lit(1)).alias("rows")).write.parquet(f"{path}/rounds/round={number}")
            if new.get["rows"] == 0:
                break
            ddl = "number bigint, block bigint, bits bigint"
            rounds = [spark.read.schema(ddl).parquet(f"{path}/rounds/round={n}") for n in range(number + 1)]
            passed = rounds[-1].withColumnRenamed("number", "child").join(pairs, "child").groupBy("number", "block").agg(
                F.bit_or("bits").alias("bits"))
            known = rounds[0]
            for one in rounds[1:]:
                known = known.unionByName(one)
            known = known.groupBy("number", "block").agg(F.bit_or("bits").alias("known"))
            fresh = F.col("bits").bitwiseAND(F.bitwise_not(F.coalesce("known", F.lit(0).cast("bigint"))))
            found = passed.join(known, ["number", "block"], "left").select("number", "block", fresh.alias("bits")).where("bits <> 0")
            number += 1
        everything = spark.read.schema("number bigint, block bigint, bits bigint").parquet(f"{path}/rounds")
        everything.groupBy("number", "block").agg(F.bit_or("bits").alias("bits")).write.parquet(f"{path}/blocks")
        remove(spark, f"{path}/pairs", f"{path}/nodes", f"{path}/edges", f"{path}/rounds")
        return cls(numbers, spark.read.parquet(f"{path}/blocks"))

    def classes(self) -> DataFrame:
        """(node, class_id, class_size, n_reached): nodes that reach the same nodes, named by the least of them.

        All nodes of a cycle are in one class. What a node reaches is told apart by its number of nodes and two hashes of
        the blocks, 128 bits together.
        """
        marks = self.blocks.groupBy("number").agg(
            F.sum(F.bit_count("bits")).alias("n_reached"), F.bit_xor(F.xxhash64("block", "bits")).alias("x"),
            F.bit_xor(F.xxhash64("bits", "block", F.lit(1))).alias("y"))
        named = marks.join(self.numbers, "number").drop("number")
        same = ["n_reached", "x", "y"]
        groups = named.groupBy(*same).agg(F.min("node").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
        return named.join(groups, same).select("node", "class_id", "class_size", "n_reached")

    def pairs(self) -> DataFrame:
        """Every (root, node) with a path from root to node, as ``downstream`` gives it for all roots that feed a node."""
        to = lambda name, number: self.numbers.select(F.col("node").alias(name), F.col("number").alias(number))
        reached = self.blocks.select("number", F.explode(_members("block", "bits")).alias("reached"))
        return reached.join(to("root", "number"), "number").join(to("node", "reached"), "reached").select("root", "node")

    def _models(self, nodes: DataFrame) -> DataFrame:
        """The models among ``nodes`` with their number and their code in lower case."""
        code = F.lower(code_of(F.col("raw_code"), F.col("compiled_code"))).alias("code")
        return nodes.where(F.col("resource_type") == "model").select("unique_id", "name", code).join(
            self.numbers.withColumnRenamed("node", "unique_id"), "unique_id")

    def impacted(self, nodes: DataFrame, changes: DataFrame) -> DataFrame:
        """What ``impacted_models`` gives, one row for each change and each model that its root reaches.

        Blocks meet the bits of the models, and those of the models that mention the column, before pairs are made of them,
        so no text of a model moves with a pair.
        """
        models = self._models(nodes).withColumn("block", F.shiftright("number", 6))
        bit = F.bit_or(F.expr("shiftleft(1L, cast(number & 63 as int))"))
        all_models = models.groupBy("block").agg(bit.alias("models"))
        roots = changes.select("root", "column_name").join(
            self.numbers.select(F.col("node").alias("root"), "number"), "root").withColumn("column", F.lower("column_name"))
        columns = roots.where("column <> ''").select(F.col("column").alias("name")).distinct()
        mentioned = mentioning(models.select("number", "code"), columns).withColumn("block", F.shiftright("number", 6)).groupBy(
            F.col("name").alias("column"), "block").agg(bit.alias("hits"))
        met = roots.join(self.blocks, "number").join(all_models, "block").join(mentioned, ["column", "block"], "left")
        bits = F.col("bits").bitwiseAND(F.col("models"))
        hits = F.when(F.col("column") == "", bits).otherwise(F.coalesce(F.col("hits"), F.lit(0).cast("bigint")))
        found = met.select("root", "column_name", hits.alias("hits"), F.explode(_members("block", bits)).alias("number"))
        named = F.expr("(shiftrightunsigned(hits, cast(number & 63 as int)) & 1) = 1")
        return found.join(models.select("number", "name"), "number").select(
            "root", "name", "column_name", named.alias("references_column"))

    def impact(self, nodes: DataFrame, changes: DataFrame) -> DataFrame:
        """(root, column_name, n_models, n_referencing) of each change: models it reaches, and those whose text mentions
        the column. ``nodes`` and ``changes`` are as for ``impacted_models``; no pair of root and model is made."""
        models = self._models(nodes)
        place = [F.shiftright("number", 6).alias("block")]
        bit = F.bit_or(F.expr("shiftleft(1L, cast(number & 63 as int))"))
        all_models = models.groupBy(*place).agg(bit.alias("models"))
        roots = changes.select("root", "column_name").distinct().join(
            self.numbers.select(F.col("node").alias("root"), "number"), "root")
        columns = roots.where(F.length("column_name") > 0).select(F.lower("column_name").alias("name")).distinct()
        mentioned = mentioning(models.select("number", "code"), columns).groupBy("name", *place).agg(bit.alias("hits"))
        met = roots.join(self.blocks, "number").join(all_models, "block", "left").withColumn(
            "name", F.lower("column_name")).join(mentioned, ["name", "block"], "left")
        count = lambda other: F.coalesce(F.sum(F.bit_count(F.col("bits").bitwiseAND(F.col(other)))), F.lit(0))
        return met.groupBy("root", "column_name").agg(count("models").alias("n_models"), count("hits").alias("n_referencing"))


def _members(block: str, bits: Column | str) -> Column:
    """The numbers of the nodes whose bits are set in a block."""
    bits = F.col(bits) if isinstance(bits, str) else bits
    numbers = F.sequence(F.lit(0).cast("bigint"), F.lit(63).cast("bigint"))
    inside = F.filter(numbers, lambda i: bits.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), i.cast("int"))) != 0)
    return F.transform(inside, lambda i: F.col(block) * 64 + i)


def mentioning(models: DataFrame, columns: DataFrame) -> DataFrame:
    """(number, name) of the models (number, code) whose lower-case code contains a name, by an equality join.

    Each code is cut into its pieces of the lengths that the names have, so the work is the length of the code times the
    number of different lengths; only these lengths meet on the driver.
    """
    lengths = [row[0] for row in columns.select(F.length("name")).distinct().collect()]
    if not lengths:
        return models.select("number", F.lit("").alias("name")).limit(0)

    def pieces(n: int) -> Column:
        every = F.transform(F.sequence(F.lit(1), F.length("code") - (n - 1)), lambda i: F.substr(F.col("code"), i, F.lit(n)))
        return F.when(F.length("code") >= n, every).otherwise(F.array().cast("array<string>"))

    cut = models.select("number", F.explode(F.array_distinct(F.flatten(F.array(*map(pieces, lengths))))).alias("name"))
    return cut.join(columns, "name")


def drift_changes(diffs: DataFrame, sources: DataFrame) -> DataFrame:
    """(schema_name, table_name, root, column_name) of the tables whose columns changed, from ``monitors.schema_diff``.

    ``sources`` has source_name, name and unique_id. The column is the removed one if exactly one was added and one removed,
    else null; tables that are no source are left out.
    """
    single = (F.size("added") == 1) & (F.size("removed") == 1)
    wanted = diffs.where("has_prior_snapshot AND has_drift").select(
        F.col("schema_name").alias("source_name"), F.col("table_name").alias("name"),
        F.when(single, F.col("removed")[0]).alias("column_name"))
    found = source_ids(sources, wanted).where("source_found")
    return found.select(F.col("source_name").alias("schema_name"), F.col("name").alias("table_name"),
                        F.col("unique_id").alias("root"), "column_name")


def impact_by_table(edges: DataFrame, nodes: DataFrame, changes: DataFrame) -> DataFrame:
    """(schema_name, table_name, models, referencing) of the tables of ``drift_changes``: sorted names of the models
    downstream, and of those that mention the changed column."""
    hits = impacted_models(edges, nodes, changes.select("root", "column_name").distinct())
    per_table = changes.join(hits, (changes["root"] == hits["root"]) & changes["column_name"].eqNullSafe(hits["column_name"]))
    return per_table.groupBy("schema_name", "table_name").agg(
        F.array_sort(F.collect_set("name")).alias("models"),
        F.array_sort(F.collect_set(F.when(F.col("references_column"), F.col("name")))).alias("referencing"))
