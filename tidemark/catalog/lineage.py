"""Dependencies between datasets, with the orders, customers, suppliers and places of the tables as datasets."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.registry import query, table
from tidemark.operators import graph
from tidemark.operators.align import stack_series
from tidemark.sources import metadata

# An order needs its customer in full, its suppliers as a named input, and its parts only loaded; customers and suppliers
# need their nation; a nation loads its region.
REFERENCES = """refs AS (
  SELECT 'order/' || o_orderkey AS dataset, 'dep_ts' AS parameter, 'customer/' || o_custkey AS depends_on FROM orders
  UNION ALL SELECT 'order/' || l_orderkey, 'load_dep_ts', 'part/' || l_partkey FROM lineitem
  UNION ALL SELECT 'order/' || l_orderkey, 'swin', 'supplier/' || l_suppkey FROM lineitem
  UNION ALL SELECT 'customer/' || c_custkey, 'ta', 'nation/' || c_nationkey FROM customer
  UNION ALL SELECT 'supplier/' || s_suppkey, 'dep_ts', 'nation/' || s_nationkey FROM supplier
  UNION ALL SELECT 'nation/' || n_nationkey, 'load_dep_ts', 'region/' || n_regionkey FROM nation),
edges AS (SELECT dataset, depends_on, bool_and(parameter = 'load_dep_ts') AS load_only FROM refs GROUP BY 1, 2)"""


def _named(prefix: str, column: str):
    return F.concat(F.lit(f"{prefix}/"), F.col(column))


def references(spark, folder):
    links = (
        ("orders", ("order", "o_orderkey"), "dep_ts", ("customer", "o_custkey")),
        ("lineitem", ("order", "l_orderkey"), "load_dep_ts", ("part", "l_partkey")),
        ("lineitem", ("order", "l_orderkey"), "swin", ("supplier", "l_suppkey")),
        ("customer", ("customer", "c_custkey"), "ta", ("nation", "c_nationkey")),
        ("supplier", ("supplier", "s_suppkey"), "dep_ts", ("nation", "s_nationkey")),
        ("nation", ("nation", "n_nationkey"), "load_dep_ts", ("region", "n_regionkey")),
    )
    return stack_series(
        [
            table(spark, folder, name).select(
                _named(*dataset).alias("dataset"), F.lit(parameter).alias("parameter"), _named(*needed).alias("depends_on")
            )
            for name, dataset, parameter, needed in links
        ]
    )


def edges(spark, folder):
    return graph.dependency_edges(references(spark, folder))


@query("lineage_edges", f"WITH {REFERENCES} SELECT dataset, depends_on, load_only FROM edges")
def lineage_edges(spark, folder):
    return edges(spark, folder)


@query(
    "lineage_closure",
    f"""WITH RECURSIVE {REFERENCES}, reach(dataset) AS (
      SELECT 'order/' || o_orderkey FROM orders WHERE o_orderstatus = 'O'
      UNION SELECT e.depends_on FROM reach r JOIN edges e ON e.dataset = r.dataset WHERE NOT e.load_only)
    SELECT dataset, FALSE AS load_only FROM reach
    UNION ALL SELECT DISTINCT e.depends_on, TRUE FROM reach r JOIN edges e ON e.dataset = r.dataset
    WHERE e.load_only AND e.depends_on NOT IN (SELECT dataset FROM reach)""",
)
def lineage_closure(spark, folder):
    """What the open orders need."""
    orders = table(spark, folder, "orders").where("o_orderstatus = 'O'")
    return graph.dependency_closure(edges(spark, folder), orders.select(_named("order", "o_orderkey").alias("dataset")))


@query(
    "lineage_layers",
    f"""WITH RECURSIVE {REFERENCES}, nodes AS (SELECT dataset FROM edges UNION SELECT depends_on FROM edges),
    deep(dataset, layer) AS (
      SELECT dataset, 0 FROM nodes WHERE dataset NOT IN (SELECT dataset FROM edges)
      UNION SELECT e.dataset, d.layer + 1 FROM deep d JOIN edges e ON e.depends_on = d.dataset)
    SELECT dataset, max(layer)::INT AS layer FROM deep GROUP BY dataset""",
)
def lineage_layers(spark, folder):
    refs = references(spark, folder)
    # The references of a dataset are brought together once, for its edges and for their walk.
    return graph.layers(graph.dependency_edges(refs.repartition("dataset")), refs)


@query(
    "lineage_failed",
    f"""WITH RECURSIVE {REFERENCES}, bad(dataset) AS (
      SELECT 'supplier/' || s_suppkey FROM supplier WHERE s_acctbal < 2000
      UNION SELECT e.dataset FROM bad b JOIN edges e ON e.depends_on = b.dataset)
    SELECT dataset FROM bad""",
)
def lineage_failed(spark, folder):
    """Suppliers with little money fail, and with them every order they supply."""
    bad = table(spark, folder, "supplier").where("s_acctbal < 2000").select(_named("supplier", "s_suppkey").alias("dataset"))
    return graph.failed_with_descendants(edges(spark, folder), bad)


_STEPS = """steps AS (SELECT l_orderkey AS dataset, l_linenumber AS index, l_partkey AS configuration FROM lineitem)"""


def _steps(spark, folder):
    """Line items as the steps of their order's plan. Generated line numbers repeat, which a plan must not."""
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("dataset"),
        F.col("l_linenumber").alias("index"),
        F.col("l_partkey").alias("configuration"),
    )


@query(
    "plan_order",
    f"""WITH {_STEPS}, once AS (SELECT dataset, index, min(configuration) AS configuration FROM steps GROUP BY 1, 2)
    SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY index)::INT AS position FROM once""",
)
def plan_order(spark, folder):
    once = _steps(spark, folder).groupBy("dataset", "index").agg(F.min("configuration").alias("configuration"))
    return graph.plan_order(once)


@query(
    "plan_duplicate_index",
    f"WITH {_STEPS} SELECT dataset, index, count(*) AS n FROM steps GROUP BY 1, 2 HAVING count(*) > 1",
)
def plan_duplicate_index(spark, folder):
    return graph.duplicate_plan_indices(_steps(spark, folder))


# --- Sites and datasets ------------------------------------------------------------------------------------------

# Customers as sites: open from their first order, closed after the last if they are in debt.
SITES = """sites AS (SELECT 'C' || c_custkey AS site, n_name AS network, min(o_orderdate) AS "start",
    CASE WHEN c_acctbal < 0 THEN max(o_orderdate) END AS "end"
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_regionkey <> 4 LEFT JOIN orders ON o_custkey = c_custkey
  GROUP BY c_custkey, c_acctbal, n_name)"""


def sites(spark, folder):
    orders = table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("c_custkey"))
    lives = orders.agg(F.min("o_orderdate").alias("start"), F.max("o_orderdate").alias("last"))
    nations = table(spark, folder, "nation").where("n_regionkey <> 4")
    nations = nations.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("network"))
    joined = table(spark, folder, "customer").join(nations, "c_nationkey", "left").join(lives, "c_custkey", "left")
    return joined.select(
        F.concat(F.lit("C"), "c_custkey").alias("site"),
        "network",
        "start",
        F.when(F.col("c_acctbal") < 0, F.col("last")).alias("end"),
    )


@query(
    "sites_active",
    f"""WITH {SITES} SELECT * FROM sites WHERE ("start" IS NULL OR "start" < TIMESTAMP '1996-07-01')
    AND ("end" IS NULL OR "end" > TIMESTAMP '1996-01-01')""",
)
def sites_active(spark, folder):
    return metadata.active_sites(sites(spark, folder), "1996-01-01 00:00:00", "1996-06-30 00:00:00")


NETWORK = "NATION_3"


@query("sites_in_network", f"WITH {SITES} SELECT * FROM sites WHERE network = '{NETWORK}'")
def sites_in_network(spark, folder):
    return metadata.network_sites(sites(spark, folder), NETWORK)


@query(
    "sites_named_in_network",
    f"""WITH {SITES} SELECT * FROM sites WHERE (network IS NULL OR network = '{NETWORK}')
    AND site IN (SELECT 'C' || o_custkey FROM orders WHERE o_totalprice > 400000)""",
)
def sites_named_in_network(spark, folder):
    """Sites named by a list, here the customers of large orders."""
    large = table(spark, folder, "orders").where("o_totalprice > 400000")
    named = large.select(F.concat(F.lit("C"), F.col("o_custkey")).alias("site"))
    return metadata.network_sites(sites(spark, folder), NETWORK, named)


# Parts as datasets: their brand is the site, their type the variable.
_DATASETS = """d AS (SELECT 'P' || p_partkey AS dataset, p_brand AS site, p_type AS variable,
  CASE WHEN p_size < 20 THEN 'PT30M' WHEN p_size < 40 THEN 'PT1H' ELSE 'P1D' END AS periodicity,
  CASE WHEN p_retailprice > 910 THEN 'processed' ELSE 'raw' END AS processing_level FROM part)"""


def _datasets(spark, folder):
    size = F.col("p_size")
    return table(spark, folder, "part").select(
        F.concat(F.lit("P"), "p_partkey").alias("dataset"),
        F.col("p_brand").alias("site"),
        F.col("p_type").alias("variable"),
        F.when(size < 20, "PT30M").when(size < 40, "PT1H").otherwise("P1D").alias("periodicity"),
        F.when(F.col("p_retailprice") > 910, "processed").otherwise("raw").alias("processing_level"),
    )


@query(
    "select_datasets",
    f"""WITH {_DATASETS} SELECT * FROM d WHERE processing_level = 'processed' AND periodicity IN ('PT30M', 'P1D')
      AND site IN (SELECT p_brand FROM part JOIN lineitem ON l_partkey = p_partkey WHERE l_quantity > 49)""",
)
def select_datasets(spark, folder):
    large = table(spark, folder, "lineitem").where("l_quantity > 49").select(F.col("l_partkey").alias("p_partkey"))
    brands = table(spark, folder, "part").join(large, "p_partkey", "left_semi").select(F.col("p_brand").alias("site"))
    return metadata.select_datasets(_datasets(spark, folder), brands, periodicities=["PT30M", "P1D"])


@query(
    "select_datasets_by_id",
    f"WITH {_DATASETS} SELECT * FROM d WHERE dataset IN (SELECT 'P' || l_partkey FROM lineitem WHERE l_discount > 0.09)",
)
def select_datasets_by_id(spark, folder):
    discounted = table(spark, folder, "lineitem").where("l_discount > 0.09")
    ids = discounted.select(F.concat(F.lit("P"), "l_partkey").alias("dataset"))
    return metadata.select_datasets(_datasets(spark, folder), ids=ids)


@query(
    "site_year_windows",
    f"""WITH {SITES}, lived AS (SELECT site, "start"::DATE AS a, least(coalesce("end"::DATE, DATE '2000-06-30'),
      DATE '2000-06-30') AS b FROM sites WHERE "start" IS NOT NULL),
    years AS (SELECT site, a, b, unnest(generate_series(year(a), year(b))) AS y FROM lived WHERE a <= b)
    SELECT site, greatest(a, make_date(y, 1, 1)) AS "start", least(b, make_date(y, 12, 31)) AS "end" FROM years""",
)
def site_year_windows(spark, folder):
    return metadata.site_years(sites(spark, folder), "2000-06-30")


@query(
    "clamp_start",
    f"""WITH {SITES}, n AS (SELECT network, count(*) FILTER ("start" IS NULL) AS unknown, min("start") AS first
      FROM sites WHERE network IS NOT NULL GROUP BY 1)
    SELECT network, CASE WHEN unknown > 0 THEN TIMESTAMP '1995-01-10' ELSE
      greatest(TIMESTAMP '1995-01-10', date_trunc('day', first)::TIMESTAMP) END AS "start" FROM n""",
)
def clamp_start(spark, folder):
    return metadata.clamped_start(sites(spark, folder).where("network is not null"), "1995-01-10 00:00:00", ["network"])
